"""Registered queries: flag tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import flags
from ..functions.seawater import absolute_salinity, density_of, heat_stages, with_seawater
from ..operators import cleaning, qc
from ..operators.ordered import Runs
from ..schema import (
    CASCADE_VARIABLES,
    DRIFT_LIMITS,
    GLOBAL_RANGE,
    QC_VARIABLES,
    SPIKE_LIMITS,
    STUCK_VARIABLES,
)
from ..session import materialise
from .common import SCREENED_CTE, rounded, sql
from .fixture import l0
from .registry import query

NOW = 2_000_000_000  # run-time literal standing in for the present, so results do not change from day to day


def screened(spark, sf_dir):
    """Aligned series after the two value screens, missing values remembered."""
    return qc.mark_missing(cleaning.blank_absurd_temperature(cleaning.blank_null_island(l0(spark, sf_dir))))


def flag_columns(df):
    return df.select("glider_id", "t_s", *[c for c in df.columns if c.endswith("_QC")])


# -- SQL building blocks -----------------------------------------------------------------------
START_SQL = ", ".join(f"CASE WHEN {v} IS NULL THEN 9 ELSE 1 END AS {v}_QC" for v in QC_VARIABLES)
START_CTE = f"st AS (SELECT *, {START_SQL} FROM cl)"
W = "WINDOW w AS (PARTITION BY glider_id ORDER BY t_s), wp AS (PARTITION BY glider_id, profile_index ORDER BY t_s)"


def raised(qc_text: str, mask: str, flag: int) -> str:
    return f"CASE WHEN ({qc_text}) <> 9 AND COALESCE({mask}, false) THEN GREATEST(({qc_text}), {flag}) ELSE ({qc_text}) END"


def raised_all(verdicts):
    """Flag text per variable after merging (mask text, flag, variables)."""
    text = {}
    for v in QC_VARIABLES:
        mine = ", ".join(f"CASE WHEN {mask} THEN {flag} ELSE 0 END" for mask, flag, names in verdicts if v in names)
        text[v] = f"CASE WHEN {v}_QC = 9 THEN 9 ELSE greatest({v}_QC, {mine}) END" if mine else f"{v}_QC"
    return text


def flags_sql(verdicts, source="st", ctes=()):
    text = raised_all(verdicts)
    cols = ", ".join(f"{t} AS {v}_QC" for v, t in text.items())
    return sql(f"SELECT glider_id, t_s, {cols} FROM {source}", SCREENED_CTE, START_CTE, *ctes)


def range_sql(v):
    low, high = GLOBAL_RANGE[v]
    return f"({v} < {low} OR {v} > {high})"


def spike_sql(v):
    above, below = SPIKE_LIMITS[v]
    return (
        f"abs({v} - (lead({v}) OVER wp + lag({v}) OVER wp)/2.0) - abs((lead({v}) OVER wp - lag({v}) OVER wp)/2.0)"
        f" > CASE WHEN pressure < 500 THEN {above} ELSE {below} END"
    )


RANGE_VERDICTS = [(range_sql(v), 4, [v]) for v in GLOBAL_RANGE] + [("pressure < -5.0", 4, ["temperature", "salinity"])]
DEEP_VERDICT = ("pressure > 1100.0", 3, ["pressure", "temperature", "salinity"])  # limit for 1000 dbar
SPIKE_CTE = f"sp AS (SELECT *, {', '.join(f'{spike_sql(v)} AS spike_{v}' for v in SPIKE_LIMITS)} FROM st {W})"
STUCK_CTE = (
    "sk0 AS (SELECT *, row_number() OVER w AS rn1, count(*) OVER (PARTITION BY glider_id) AS nn, "
    + ", ".join(f"CASE WHEN {v} = lag({v}) OVER w THEN 1 ELSE 0 END AS same_{v}" for v in STUCK_VARIABLES)
    + f" FROM st {W}), sk AS (SELECT *, "
    + ", ".join(
        f"(rn1 > 10 AND rn1 <= nn - 10 AND sum(same_{v}) OVER (PARTITION BY glider_id ORDER BY t_s ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) >= 10) AS stuck_{v}"
        for v in STUCK_VARIABLES
    )
    + " FROM sk0)"
)
SPEED_CTE = """fx AS (SELECT glider_id, t_s, latitude, longitude FROM st WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
fm AS (SELECT glider_id, avg(latitude) AS ml FROM fx GROUP BY 1),
lg AS (SELECT *, lag(t_s) OVER w AS pt,
  sqrt(pow((latitude - lag(latitude) OVER w)*111320, 2) + pow((longitude - lag(longitude) OVER w)*111320*cos(radians(ml)), 2))
  / CASE WHEN t_s - lag(t_s) OVER w <= 0 THEN 1.0 ELSE t_s - lag(t_s) OVER w END AS v
  FROM fx JOIN fm USING (glider_id) WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)),
fast AS (SELECT glider_id, t_s FROM lg WHERE v > 3.0 UNION SELECT glider_id, pt FROM lg WHERE v > 3.0)"""
SPEED_MASK = "EXISTS (SELECT 1 FROM fast WHERE fast.glider_id = {0}.glider_id AND fast.t_s = {0}.t_s)"


def reversal_sql(threshold: float, source: str, minimum: int = 4) -> str:
    """(glider_id, t_s) of pressure reversals: the two halves of a profile walked from its middle."""
    return f"""rv0 AS (SELECT glider_id, profile_index, t_s, pressure AS p,
  row_number() OVER (PARTITION BY glider_id, profile_index ORDER BY t_s) - 1 AS i,
  count(*) OVER (PARTITION BY glider_id, profile_index) AS n
  FROM {source} WHERE pressure IS NOT NULL),
rv AS (SELECT glider_id, t_s FROM (SELECT *, i >= n // 2 AS lo,
  min(p) OVER (PARTITION BY glider_id, profile_index, i >= n // 2 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS mn,
  max(p) OVER (PARTITION BY glider_id, profile_index, i >= n // 2 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
  FROM rv0 WHERE n >= {minimum}) WHERE (NOT lo AND p >= mn + {threshold}) OR (lo AND p <= mx - {threshold}))"""


REVERSAL_MASK = "EXISTS (SELECT 1 FROM rv WHERE rv.glider_id = {0}.glider_id AND rv.t_s = {0}.t_s)"
DRIFT_CTE = (
    "dm AS (SELECT glider_id, profile_index, max(depth) AS bottom FROM st GROUP BY 1, 2), "
    + ", ".join(
        f"""d_{v} AS (SELECT glider_id, profile_index, avg({v}) AS m FROM st JOIN dm USING (glider_id, profile_index)
  WHERE {v} IS NOT NULL AND depth > bottom - 100 GROUP BY 1, 2 HAVING count(*) >= 3),
e_{v} AS (SELECT glider_id, profile_index FROM (SELECT *, row_number() OVER w AS k,
  median(m) OVER (PARTITION BY glider_id ORDER BY profile_index ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS med
  FROM d_{v} WINDOW w AS (PARTITION BY glider_id ORDER BY profile_index)) WHERE k > 5 AND abs(m - med) > {limit})"""
        for v, limit in DRIFT_LIMITS.items()
    )
)
DRIFT_MASK = "EXISTS (SELECT 1 FROM e_{1} WHERE e_{1}.glider_id = {0}.glider_id AND e_{1}.profile_index = {0}.profile_index)"


def seawater_ctes(source: str, out: str, extra: str = "") -> str:
    """CTE chain adding sigma0 and rho to `source`; one stage per CTE."""
    valid = (
        "CASE WHEN (pressure < 100 AND (temperature > 80 OR temperature < -12)) OR (pressure >= 100 AND "
        "(temperature > 40 OR temperature < -12)) THEN NULL ELSE temperature END"
    )
    ctes = [
        f"{out}_0 AS (SELECT *, {valid} AS z_t, CASE WHEN salinity IS NOT NULL THEN {absolute_salinity('salinity')} END AS sa{extra} FROM {source})"
    ]
    stages = heat_stages("z_t", "pressure", "sa", "z_")
    for k, (name, text) in enumerate(stages):
        ctes.append(f"{out}_{k + 1} AS (SELECT *, {text} AS {name} FROM {out}_{k})")
    ctes.append(
        f"{out} AS (SELECT *, z_ct AS potential_temperature, {density_of('sa', 'z_ct', 'pressure')} AS rho, "
        f"{density_of('sa', 'z_ct', '0e0')} - 1000 AS sigma0 FROM {out}_{len(stages)})"
    )
    return ", ".join(ctes)


SIGMA_CTE = seawater_ctes("st", "sg")
INVERSION_CTE = (
    SIGMA_CTE
    + """, iv AS (SELECT glider_id, t_s, ((lead(pressure) OVER wp - pressure > 1 AND lead(sigma0) OVER wp - sigma0 < -0.03)
  OR (lead(pressure) OVER wp - pressure < -1 AND lead(sigma0) OVER wp - sigma0 > 0.03)) AS inversion FROM sg
  WINDOW wp AS (PARTITION BY glider_id, profile_index ORDER BY t_s))"""
)


# -- single tests --------------------------------------------------------------------------------
@query("qc_initial_flags", sql(f"SELECT glider_id, t_s, {', '.join(v + '_QC' for v in QC_VARIABLES)} FROM st", SCREENED_CTE, START_CTE))
def initial(spark, sf_dir):
    return flag_columns(qc.start_flags(screened(spark, sf_dir)))


@query("qc_impossible_date", flags_sql([(f"t_s < 852076800 OR t_s > {NOW - 292_000_000}", 4, QC_VARIABLES)]))
def date(spark, sf_dir):
    limit = F.lit(NOW - 292_000_000)
    return flag_columns(qc.raise_all(qc.start_flags(screened(spark, sf_dir)), [(qc.impossible_date(limit), 4, QC_VARIABLES)]))


LOCATION_SOURCE = "(SELECT * REPLACE (latitude*7.3 AS latitude, longitude*2.5715 AS longitude) FROM st)"


@query(
    "qc_impossible_location",
    flags_sql([("abs(latitude) > 90", 4, ["latitude"]), ("abs(longitude) > 180", 4, ["longitude"])], LOCATION_SOURCE),
)
def location(spark, sf_dir):
    # positions stretched so that some leave the globe
    base = qc.start_flags(screened(spark, sf_dir)).withColumns(
        {"latitude": F.col("latitude") * 7.3, "longitude": F.col("longitude") * 2.5715}
    )
    verdicts = [(qc.impossible_location(c), 4, [c]) for c in ("latitude", "longitude")]
    return flag_columns(qc.raise_all(base, verdicts))


@query("qc_impossible_speed", flags_sql([(SPEED_MASK.format("st"), 3, QC_VARIABLES)], ctes=(SPEED_CTE,)))
def speed(spark, sf_dir):
    masked = qc.neighbour_masks(qc.start_flags(screened(spark, sf_dir)), ("speed",))
    return flag_columns(qc.raise_all(masked, [(F.col("speed"), 3, QC_VARIABLES)]))


@query("qc_global_range", flags_sql(RANGE_VERDICTS))
def global_range(spark, sf_dir):
    verdicts = [(qc.out_of_range(v), 4, [v]) for v in GLOBAL_RANGE]
    verdicts.append((F.col("pressure") < -5.0, 4, ["temperature", "salinity"]))
    return flag_columns(qc.raise_all(qc.start_flags(screened(spark, sf_dir)), verdicts))


@query("qc_pressure_reversal", flags_sql([(REVERSAL_MASK.format("st"), 3, ["pressure"])], ctes=(reversal_sql(50.0, "st"),)))
def reversal(spark, sf_dir):
    base = screened(spark, sf_dir)
    joined = qc.start_flags(base).join(qc.pressure_reversals(base), ["glider_id", "seq"], "left")
    return flag_columns(qc.raise_all(joined, [(F.col("reversal"), 3, ["pressure"])]))


@query("qc_spike", flags_sql([(f"spike_{v}", 4, [v]) for v in SPIKE_LIMITS], "sp", (SPIKE_CTE,)))
def spike(spark, sf_dir):
    masked = qc.neighbour_masks(qc.start_flags(screened(spark, sf_dir)), ("spike",))
    return flag_columns(qc.raise_all(masked, [(F.col(f"spike_{v}"), 4, [v]) for v in SPIKE_LIMITS]))


# values held over 25-row blocks so that some stick
HELD_SQL = "st AS (SELECT * REPLACE ({}) FROM st_moving)".format(
    ", ".join(f"CASE WHEN seq % 100 < 15 THEN 7.0 ELSE {v} END AS {v}" for v in ("temperature", "salinity"))
)


@query(
    "qc_stuck_value",
    flags_sql([(f"stuck_{v}", 4, [v]) for v in STUCK_VARIABLES], "sk", (STUCK_CTE,)).replace(
        START_CTE, START_CTE.replace("st AS", "st_moving AS") + ", " + HELD_SQL
    ),
)
def stuck(spark, sf_dir):
    base = qc.start_flags(screened(spark, sf_dir)).withColumns(
        {v: F.when(F.col("seq") % 100 < 15, F.lit(7.0)).otherwise(F.col(v)) for v in ("temperature", "salinity")}
    )
    masked = qc.neighbour_masks(base, ("stuck",))
    return flag_columns(qc.raise_all(masked, [(F.col(f"stuck_{v}"), 4, [v]) for v in STUCK_VARIABLES]))


@query(
    "qc_density_inversion",
    flags_sql(
        [("inversion", 4, ["temperature", "salinity", "density"])], "st JOIN iv USING (glider_id, t_s)", (INVERSION_CTE,)
    ),
)
def inversion(spark, sf_dir):
    base = with_seawater(qc.start_flags(screened(spark, sf_dir)))
    masked = qc.neighbour_masks(base, ("inversion",))
    return flag_columns(qc.raise_all(masked, [(F.col("inversion"), 4, ["temperature", "salinity", "density"])]))


DRIFT_SOURCE = START_CTE.replace("st AS", "st_calm AS") + (
    ", st AS (SELECT * REPLACE (salinity + CASE WHEN profile_index % 7 = 3 THEN 2.0 ELSE 0.0 END AS salinity,"
    " temperature + CASE WHEN profile_index % 11 = 9 THEN 5.0 ELSE 0.0 END AS temperature) FROM st_calm)"
)


@query(
    "qc_sensor_drift",
    flags_sql([(DRIFT_MASK.format("st", v), 3, [v]) for v in DRIFT_LIMITS], ctes=(DRIFT_CTE,)).replace(START_CTE, DRIFT_SOURCE),
)
def drift(spark, sf_dir):
    # whole profiles shifted so that some drift
    base = qc.start_flags(screened(spark, sf_dir)).withColumns(
        {
            "salinity": F.col("salinity") + F.when(F.col("profile_index") % 7 == 3, 2.0).otherwise(0.0),
            "temperature": F.col("temperature") + F.when(F.col("profile_index") % 11 == 9, 5.0).otherwise(0.0),
        }
    )
    joined = base.join(qc.drifting_profiles(base), ["glider_id", "profile_index"], "left")
    return flag_columns(qc.raise_all(joined, [(F.col(f"drift_{v}"), 3, [v]) for v in DRIFT_LIMITS]))


@query("qc_deepest_pressure", flags_sql([DEEP_VERDICT]))
def deepest(spark, sf_dir):
    limit = qc.deepest_allowed(F.lit(1000.0))
    return flag_columns(
        qc.raise_all(qc.start_flags(screened(spark, sf_dir)), [(F.col("pressure") > limit, 3, DEEP_VERDICT[2])])
    )


# pressure_QC depends on the range test first, then the cascades run
def cascades_sql(text, source, ctes):
    cols = ", ".join(f"{t} AS {v}_QC" for v, t in text.items())
    first = f"ca0 AS (SELECT glider_id, t_s, {cols} FROM {source})"
    second = ", ".join(
        f"{raised(v + '_QC', 'pressure_QC IN (4, 9)', 4) if v in CASCADE_VARIABLES else v + '_QC'} AS {v}_QC" for v in QC_VARIABLES
    )
    last = ", ".join(
        f"CASE WHEN temperature_QC = 9 THEN 9 ELSE {raised('salinity_QC', 'temperature_QC = 4', 4)} END AS salinity_QC"
        if v == "salinity"
        else f"{v}_QC"
        for v in QC_VARIABLES
    )
    ctes = [*ctes, first, f"ca1 AS (SELECT glider_id, t_s, {second} FROM ca0)", f"fl AS (SELECT glider_id, t_s, {last} FROM ca1)"]
    return ctes


@query(
    "qc_cascades",
    sql(
        f"SELECT glider_id, t_s, {', '.join(v + '_QC' for v in QC_VARIABLES)} FROM fl",
        *cascades_sql(raised_all(RANGE_VERDICTS), "st", (SCREENED_CTE, START_CTE)),
    ),
)
def cascades(spark, sf_dir):
    verdicts = [(qc.out_of_range(v), 4, [v]) for v in GLOBAL_RANGE]
    return flag_columns(qc.apply_cascades(qc.raise_all(qc.start_flags(screened(spark, sf_dir)), verdicts)))


# -- all tests ----------------------------------------------------------------------------------
FULL_CTES = cascades_sql(
    raised_all(
        [
            (SPEED_MASK.format("x"), 3, QC_VARIABLES),
            *RANGE_VERDICTS,
            (REVERSAL_MASK.format("x"), 3, ["pressure"]),
            *[(f"spike_{v}", 4, [v]) for v in SPIKE_LIMITS],
            *[(f"stuck_{v}", 4, [v]) for v in STUCK_VARIABLES],
            ("inversion", 4, ["temperature", "salinity", "density"]),
            *[(DRIFT_MASK.format("x", v), 3, [v]) for v in DRIFT_LIMITS],
            DEEP_VERDICT,
        ]
    ),
    "(SELECT * FROM sp JOIN iv USING (glider_id, t_s) JOIN (SELECT glider_id, t_s, "
    + ", ".join(f"stuck_{v}" for v in STUCK_VARIABLES)
    + " FROM sk) USING (glider_id, t_s)) x",
    (SCREENED_CTE, START_CTE, SPEED_CTE, reversal_sql(50.0, "st"), SPIKE_CTE, STUCK_CTE, INVERSION_CTE, DRIFT_CTE),
)


def flagged(spark, sf_dir):
    """Screened series with the flags of every test."""
    # the tests read the series several times: write it once, as a production table would be
    return qc.flag_series(materialise(with_seawater(screened(spark, sf_dir))), 1000.0, F.lit(NOW))


@query("qc_all_tests", sql(f"SELECT glider_id, t_s, {', '.join(v + '_QC' for v in QC_VARIABLES)} FROM fl", *FULL_CTES))
def all_tests(spark, sf_dir):
    return flag_columns(flagged(spark, sf_dir))


SLICE_CTES = cascades_sql(
    raised_all([*RANGE_VERDICTS, *[(f"spike_{v}", 4, [v]) for v in SPIKE_LIMITS], DEEP_VERDICT]),
    "sp",
    (SCREENED_CTE, START_CTE, SPIKE_CTE),
)


@query(
    "qc_share_good",
    sql(
        "SELECT glider_id, variable, count(*) AS n, "
        + ", ".join(f"CAST(sum(CASE WHEN qc = {k} THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}" for k in (1, 2, 3, 4, 9))
        + ", round(100.0*sum(CASE WHEN qc IN (1, 2) THEN 1 ELSE 0 END)/count(*), 2) AS pct_good FROM ("
        + " UNION ALL ".join(f"SELECT glider_id, '{v}' AS variable, {v}_QC AS qc FROM fl" for v in QC_VARIABLES)
        + ") GROUP BY 1, 2",
        *SLICE_CTES,
    ),
)
def share_good(spark, sf_dir):
    base = qc.neighbour_masks(qc.start_flags(screened(spark, sf_dir)), ("spike",))
    verdicts = [(qc.out_of_range(v), 4, [v]) for v in GLOBAL_RANGE]
    verdicts += [(F.col(f"spike_{v}"), 4, [v]) for v in SPIKE_LIMITS]
    verdicts.append((F.col("pressure") > qc.deepest_allowed(F.lit(1000.0)), 3, DEEP_VERDICT[2]))
    done = qc.apply_cascades(qc.raise_all(base, verdicts))
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}_QC").alias("qc")) for v in QC_VARIABLES])
    long = done.select("glider_id", F.explode(pairs).alias("x")).select("glider_id", "x.*")
    count_if = lambda *k: F.sum(F.col("qc").isin(*k).cast("int"))
    return long.groupBy("glider_id", "variable").agg(
        F.count(F.lit(1)).alias("n"),
        *[count_if(k).alias(f"n_{k}") for k in (1, 2, 3, 4, 9)],
        F.round(100.0 * count_if(1, 2) / F.count(F.lit(1)), 2).alias("pct_good"),
    )


@query(
    "flag_merge",
    sql(
        "SELECT glider_id, t_s, CASE WHEN q <> 9 AND a THEN greatest(q, 3) ELSE q END AS raised, "
        "CASE WHEN a THEN greatest(q, 3) ELSE q END AS raised_max FROM (SELECT glider_id, t_s, seq % 3 = 1 AS a, "
        "CASE seq % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 9 END AS q FROM l0)"
    ),
)
def flag_merge(spark, sf_dir):
    q = F.element_at(F.array(*[F.lit(k).cast("tinyint") for k in (1, 2, 3, 4, 9)]), (F.col("seq") % 5 + 1).cast("int"))
    base = l0(spark, sf_dir).withColumn("q", q)
    mask = F.col("seq") % 3 == 1
    return base.select(
        "glider_id",
        "t_s",
        flags.raise_flag(F.col("q"), mask, 3).alias("raised"),
        flags.raise_max(F.col("q"), mask, 3).alias("raised_max"),
    )
