"""Registered queries: profile tests and derived parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.seawater import (
    absolute_salinity, density_of, depth_from_pressure, derive_variables, literal, practical_salinity, series, with_seawater,
)
from ..operators import derived as dv
from ..operators import profile_qc as pq
from ..operators.median_distance import median_distance_spikes
from ..operators.publish import per_kilogram
from .common import L0_CTE, rounded, sql
from .fixture import l0
from .queries_qc import seawater_ctes
from .registry import query

TESTED = ["pressure", "temperature", "salinity", "oxygen_concentration", "cdom"]
# some profiles hold one value, some jump, one glider sticks in pressure for a profile
ALTERED = {
    "temperature": "CASE WHEN profile_index % 9 = 4 THEN 12.5 ELSE temperature END",
    "salinity": "CASE WHEN profile_index % 8 = 3 AND seq % 40 >= 25 THEN salinity + 6.0 WHEN seq % 19 = 0 THEN NULL ELSE salinity END",
    "pressure": "CASE WHEN profile_index % 14 = 6 THEN 250.0 WHEN seq % 33 = 7 THEN pressure + 40 ELSE pressure END",
}
AL_CTE = (
    "al0 AS (SELECT * REPLACE (" + ", ".join(f"{t} AS {v}" for v, t in ALTERED.items()) + ") FROM l0), al AS (SELECT *, "
    + ", ".join(f"CASE WHEN {v} IS NULL THEN 9 ELSE 1 END AS {v}_QC" for v in TESTED) + " FROM al0)"
)
F8 = """f8n AS (SELECT glider_id, profile_index, seq, pressure AS p, row_number() OVER (PARTITION BY glider_id, profile_index ORDER BY seq) AS i, count(*) OVER (PARTITION BY glider_id, profile_index) // 2 AS m, count(*) OVER (PARTITION BY glider_id, profile_index) AS n FROM al WHERE pressure IS NOT NULL),
f8 AS (SELECT glider_id, seq FROM (SELECT *, min(p) FILTER (WHERE i <= m) OVER (PARTITION BY glider_id, profile_index ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS mn, max(p) FILTER (WHERE i >= m) OVER (PARTITION BY glider_id, profile_index ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM f8n WHERE n > 1) WHERE (i < m AND p >= mn) OR (i > m AND p <= mx))"""


def f12(v, limit):
    return f"""r_{v} AS (SELECT *, sum(o) OVER (PARTITION BY glider_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM (SELECT glider_id, seq, {v} AS v,
  CASE WHEN {v} IS NOT NULL AND lag({v}) OVER w IS NOT NULL THEN 0 ELSE 1 END AS o, coalesce(abs({v} - lag({v}) OVER w) > {limit}, false) OR coalesce(abs(lead({v}) OVER w - {v}) > {limit}, false) AS j FROM al WINDOW w AS (PARTITION BY glider_id, profile_index ORDER BY seq))),
q_{v} AS (SELECT glider_id, seq, CASE WHEN j THEN 4 ELSE 3 END AS k FROM r_{v} JOIN (SELECT DISTINCT glider_id, run FROM r_{v} WHERE j) USING (glider_id, run) WHERE v IS NOT NULL)"""


F12 = ", ".join(f12(v, m) for v, m in pq.JUMP_LIMITS.items())
F13 = "f13 AS (SELECT glider_id, profile_index, " + ", ".join(f"coalesce(count({v}) > 1 AND min({v}) = max({v}), false) AS c_{v}" for v in TESTED) + " FROM al GROUP BY 1, 2)"
AFTER13 = (
    "g13 AS (SELECT al.* REPLACE ("
    + ", ".join(
        f"greatest({v}_QC, CASE WHEN c_{v} AND al.{v} IS NOT NULL THEN 4 ELSE 0 END, "
        + {"pressure": "CASE WHEN f8.seq IS NOT NULL THEN 4 ELSE 0 END", "temperature": "coalesce(qt.k, 0)", "salinity": "coalesce(qs.k, 0)"}.get(v, "0") + f") AS {v}_QC"
        for v in TESTED
    )
    + "), f8.seq IS NOT NULL AS failed_8, qt.k IS NOT NULL OR qs.k IS NOT NULL AS failed_12, "
    + " OR ".join(f"(c_{v} AND al.{v} IS NOT NULL)" for v in TESTED)
    + " AS failed_13, c_pressure FROM al JOIN f13 USING (glider_id, profile_index) LEFT JOIN f8 ON f8.glider_id = al.glider_id AND f8.seq = al.seq LEFT JOIN q_temperature qt ON qt.glider_id = al.glider_id AND qt.seq = al.seq LEFT JOIN q_salinity qs ON qs.glider_id = al.glider_id AND qs.seq = al.seq)"
)
GOOD = "gg AS (SELECT glider_id, profile_index, seq, pressure, temperature, salinity FROM g13 WHERE pressure IS NOT NULL AND pressure_QC <> 4 AND temperature IS NOT NULL AND temperature_QC <> 4 AND salinity IS NOT NULL AND salinity_QC <> 4)"
F14 = (
    seawater_ctes("gg", "sw")
    + ", pr AS (SELECT glider_id, seq, lead(seq) OVER w AS seq2, sa, potential_temperature AS ct, lead(sa) OVER w AS sa2, lead(potential_temperature) OVER w AS ct2, (pressure + lead(pressure) OVER w)/2 AS pm FROM sw WINDOW w AS (PARTITION BY glider_id, profile_index ORDER BY seq)), "
    + f"pv AS (SELECT * FROM pr WHERE {density_of('sa', 'ct', 'pm')} - {density_of('sa2', 'ct2', 'pm')} >= 0.03), f14 AS (SELECT glider_id, seq FROM pv UNION SELECT glider_id, seq2 FROM pv)"
)
DONE = (
    "ft AS (SELECT g13.* REPLACE ("
    + ", ".join(
        f"greatest({v}_QC, " + ("CASE WHEN f14.seq IS NOT NULL THEN 4 ELSE 0 END, " if v in ("temperature", "salinity") else "")
        + f"CASE WHEN (failed_8 OR c_pressure) AND pressure_QC = 4 AND {v} IS NOT NULL THEN 4 ELSE 0 END) AS {v}_QC"
        for v in TESTED
    )
    + "), f14.seq IS NOT NULL AS failed_14 FROM g13 LEFT JOIN f14 ON f14.glider_id = g13.glider_id AND f14.seq = g13.seq)"
)
TESTS = (L0_CTE, AL_CTE, F8, F12, F13, AFTER13, GOOD, F14, DONE)


def altered(spark, sf):
    base = l0(spark, sf).withColumns({v: F.expr(t) for v, t in ALTERED.items()})
    # the tests write and shuffle the rows: no column that none of them reads
    base = base.select("glider_id", "profile_index", "t_s", "seq", *TESTED)
    return base.withColumns({f"{v}_QC": F.when(F.col(v).isNull(), 9).otherwise(1) for v in TESTED})


@query("profile_pressure_increasing", sql("SELECT DISTINCT glider_id, seq FROM f8", *TESTS[:3]))
def increasing(spark, sf):
    return pq.pressure_not_increasing(altered(spark, sf)).drop("stalled")


@query("profile_digit_rollover", sql("SELECT glider_id, seq, k AS rollover FROM q_salinity", L0_CTE, AL_CTE, F12))
def rollover(spark, sf):
    return pq.digit_rollover(altered(spark, sf), "salinity")


@query("profile_constant", sql("SELECT glider_id, profile_index, " + ", ".join(f"c_{v} AS constant_{v}" for v in TESTED) + " FROM f13", L0_CTE, AL_CTE, F13))
def constant(spark, sf):
    out = pq.constant_profiles(altered(spark, sf), TESTED)
    return out.withColumns({f"constant_{v}": F.coalesce(f"constant_{v}", F.lit(False)) for v in TESTED})


@query("profile_tests", sql("SELECT glider_id, seq, " + ", ".join(f"{v}_QC" for v in TESTED) + ", failed_8, failed_12, failed_13, failed_14 FROM ft", *TESTS))
def tests(spark, sf):
    out = pq.profile_tests(altered(spark, sf), TESTED)
    return out.select("glider_id", "seq", *[f"{v}_QC" for v in TESTED], *[f"failed_{k}" for k in (8, 12, 13, 14)])


WORD = "lpad(upper(to_hex(CAST({0} AS UBIGINT))), 16, '0')"


@query("profile_test_report", sql(
    f"SELECT glider_id, profile_index, '{(1 << 8) + (1 << 12) + (1 << 13) + (1 << 14):016X}' AS done_hex, " + WORD.format(" + ".join(f"CASE WHEN bool_or(failed_{k}) THEN {1 << k} ELSE 0 END" for k in (8, 12, 13, 14))) + " AS failed_hex FROM ft GROUP BY 1, 2", *TESTS))
def report(spark, sf):
    return pq.report_tests(pq.profile_tests(altered(spark, sf), TESTED))


REPORT_SQL = "rp AS (SELECT glider_id, profile_index, 1 + seq % 3 AS d, bit_or(CAST(1 AS UBIGINT) << CAST(1 + (seq*5) % 20 AS INT)) AS w FROM l0 GROUP BY 1, 2, 3)"


@query("profile_failed_tests", sql("SELECT glider_id, profile_index, " + ", ".join(f"CAST((arg_max(w, d) >> {k}) & 1 AS INT) AS test_{k}" for k in range(1, 21)) + " FROM rp GROUP BY 1, 2", L0_CTE, REPORT_SQL))
def failed(spark, sf):
    from ..functions.flags import hex_of_tests

    k = (1 + (F.col("seq") * 5) % 20).cast("int")
    reports = l0(spark, sf).groupBy("glider_id", "profile_index", (1 + F.col("seq") % 3).alias("date")).agg(hex_of_tests(F.collect_set(k)).alias("failed_hex"))
    return pq.failed_tests(reports, list(range(1, 21)))


@query("profile_tests_with_oxygen", sql("SELECT glider_id, seq, oxygen_concentration_QC, pressure_QC FROM ft WHERE glider_id <> 'G1'", *TESTS))
def rerun(spark, sf):
    base = altered(spark, sf)
    # one deployment loses its oxygen
    gone = base.withColumn("oxygen_concentration", F.when(F.col("glider_id") != "G1", F.col("oxygen_concentration")))
    return pq.rerun_with_oxygen(gone, TESTED).select("glider_id", "seq", "oxygen_concentration_QC", "pressure_QC")


# -- seawater ------------------------------------------------------------------------------------------
@query("seawater_state", sql("SELECT glider_id, t_s, round(sa, 6) AS absolute_salinity, round(potential_temperature, 6) AS potential_temperature, round(rho, 6) AS rho, round(sigma0, 6) AS sigma0 FROM sw", L0_CTE, seawater_ctes("l0", "sw")))
def state(spark, sf):
    return rounded(with_seawater(l0(spark, sf)).select("glider_id", "t_s", "absolute_salinity", "potential_temperature", "rho", "sigma0"))


@query("derive_variables", sql(
    "SELECT glider_id, t_s, round(dep, 4) AS depth, round(salinity, 6) AS salinity, round(potential_temperature, 6) AS potential_temperature, round(rho, 6) AS density, round(sigma0 + 1000, 6) AS potential_density FROM sw", L0_CTE,
    f"dr AS (SELECT * REPLACE ({practical_salinity('(conductivity*10e0)', 'temperature', 'pressure')} AS salinity), {depth_from_pressure('pressure', '12.0')} AS dep FROM l0)", seawater_ctes("dr", "sw")))
def derive(spark, sf):
    out = derive_variables(l0(spark, sf).withColumn("mean_lat", F.lit(12.0)))
    out = out.withColumn("depth", F.round("depth", 4))
    return rounded(out.select("glider_id", "t_s", "depth", "salinity", "potential_temperature", "density", "potential_density"))


# -- calibrated parameters ---------------------------------------------------------------------------------
COEF = {"slope": 1.5, "offset": -0.25, "dark": 0.05, "scale": 1.2, "chi": 1.076, "angle": 124.0, "soc": 2.5e-4, "a": -3.0e-3, "b": 1.5e-4, "c": -2.5e-6, "e": 0.036, "reference_salinity": 2.0}


def calibration(spark, sf, parameter):
    """Coefficients per glider; one glider has none."""
    gliders = l0(spark, sf).select("glider_id").distinct().filter("glider_id <> 'G2'")
    return gliders.select("glider_id", F.lit(parameter).alias("parameter"), F.create_map(*[F.lit(x) for kv in COEF.items() for x in kv]).alias("coef"))


HAS = "glider_id <> 'G2'"


@query("derive_rescale", sql(f"SELECT glider_id, t_s, round(CASE WHEN {HAS} THEN cdom*1.5 - 0.25 END, 6) AS rescaled FROM l0"))
def rescale(spark, sf):
    return rounded(dv.rescale(l0(spark, sf), calibration(spark, sf, "cdom"), "cdom", "rescaled").select("glider_id", "t_s", "rescaled"))


@query("derive_salinity", sql(f"SELECT glider_id, t_s, round(coalesce(CASE WHEN seq % 2 = 0 THEN salinity END, {practical_salinity('(conductivity*10e0)', 'temperature', 'pressure')}), 6) AS salinity FROM l0"))
def salinity(spark, sf):
    base = l0(spark, sf).withColumn("salinity", F.when(F.col("seq") % 2 == 0, F.col("salinity")))
    return rounded(dv.fill_salinity(base).select("glider_id", "t_s", "salinity"))


@query("derive_counts", sql(f"SELECT glider_id, t_s, round(CASE WHEN {HAS} THEN (chlorophyll - 0.05)*1.2 END, 6) AS chla FROM l0"))
def counts(spark, sf):
    return rounded(dv.counts_to_units(l0(spark, sf), calibration(spark, sf, "chlorophyll"), "chlorophyll", "chla").select("glider_id", "t_s", "chla"))


CTD_SQL = """cs AS (SELECT x.glider_id, x.t_s, x.backscatter_700 AS beta, """ + ", ".join(
    f"CASE WHEN a.t_s = x.t_s THEN a.{c} ELSE a.{c} + (b.{c} - a.{c})*((x.t_s - a.t_s)/CAST(b.t_s - a.t_s AS double)) END AS {c}" for c in ("temperature", "salinity")
) + """ FROM (SELECT * FROM l0 WHERE backscatter_700 IS NOT NULL) x ASOF LEFT JOIN (SELECT * FROM l0 WHERE temperature IS NOT NULL) a ON a.glider_id = x.glider_id AND a.t_s <= x.t_s ASOF LEFT JOIN (SELECT * FROM l0 WHERE temperature IS NOT NULL) b ON b.glider_id = x.glider_id AND b.t_s >= x.t_s)"""


for band in (470, 532, 700, 880):
    STAGES = dv.seawater_scattering("temperature", "salinity", float(band), "124e0")
    CHAIN = ", ".join(f"bs_{k + 1} AS (SELECT *, {text} AS {name} FROM {'cs' if k == 0 else f'bs_{k}'})" for k, (name, text) in enumerate(STAGES))

    @query(f"derive_backscatter_{band}", sql(f"SELECT glider_id, t_s, round(CASE WHEN {HAS} THEN 2*pi()*1.076*((beta - 0.05)*1.2 - beta_sw) END, 9) AS bbp FROM bs_{len(STAGES)}", L0_CTE, CTD_SQL, CHAIN))
    def scatter(spark, sf, band=band):
        out = dv.backscatter(l0(spark, sf), calibration(spark, sf, "backscatter_700"), "backscatter_700", float(band), "bbp")
        return rounded(out.select("glider_id", "t_s", "bbp"), 9)


LOC_SQL = "lc AS (SELECT * REPLACE (CASE WHEN seq % 50 = 3 THEN 95.0 ELSE 12.0 END AS latitude, 70.0 AS longitude) FROM l0)"


def placed(spark, sf):
    return l0(spark, sf).withColumns({"latitude": F.when(F.col("seq") % 50 == 3, 95.0).otherwise(12.0), "longitude": F.lit(70.0)})


TS = "ln((298.15 - temperature)/(273.15 + temperature))"
FREQ = f"44.6596*2.5e-4*(oxygen_concentration*10 - 0.25)*exp({series(dv.SOLUBILITY_A, TS)} + salinity*{series(dv.SOLUBILITY_B, TS)} + {literal(dv.SOLUBILITY_C0)}*salinity*salinity)*(1 - 3e-3*temperature + 1.5e-4*temperature*temperature - 2.5e-6*temperature*temperature*temperature)*exp(0.036*pressure/(273.15 + temperature))"
DENSE = (L0_CTE, LOC_SQL, seawater_ctes("lc", "sw"))
AT = "abs(latitude) <= 90"


@query("derive_oxygen_frequency", sql(f"SELECT glider_id, t_s, round(CASE WHEN {HAS} AND {AT} AND temperature < 40 THEN {FREQ}/((sigma0 + 1000)/1000) END, 5) AS doxy FROM (SELECT * REPLACE (CASE WHEN temperature < 40 THEN temperature END AS temperature) FROM sw)", *DENSE))
def frequency(spark, sf):
    base = placed(spark, sf).withColumns({"frequency": F.col("oxygen_concentration") * 10, "temperature": F.when(F.col("temperature") < 40, F.col("temperature"))})
    return rounded(dv.oxygen_from_frequency(base, calibration(spark, sf, "frequency"), "frequency", "doxy").select("glider_id", "t_s", "doxy"), 5)


def vap(s):
    return f"1013.25*exp(24.4543 - 67.4509*(100/(temperature + 273.15)) - 4.8489*ln((temperature + 273.15)/100) - 5.44e-4*{s})"


MOLAR = f"oxygen_concentration*((1013.25 - {vap('0')})/(1013.25 - {vap('salinity')}))*exp((salinity - ref)*{series(dv.MOLAR_B, TS)} + {literal(dv.MOLAR_C0)}*(salinity*salinity - ref*ref))*(1 + (0.00025*temperature + 0.0328)*pressure/1000)"


@query("derive_oxygen_molar", sql(f"SELECT glider_id, t_s, round(CASE WHEN {AT} THEN {MOLAR}/((sigma0 + 1000)/1000) END, 5) AS doxy FROM (SELECT * REPLACE (CASE WHEN temperature < 40 THEN temperature END AS temperature), CASE WHEN {HAS} THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS ref FROM sw)", *DENSE))
def molar(spark, sf):
    base = placed(spark, sf).withColumns({"molar": F.col("oxygen_concentration"), "temperature": F.when(F.col("temperature") < 40, F.col("temperature"))})
    return rounded(dv.oxygen_from_molar(base, calibration(spark, sf, "molar"), "molar", "doxy").select("glider_id", "t_s", "doxy"), 5)


@query("derive_nitrate", sql(f"SELECT glider_id, t_s, round(CASE WHEN {AT} THEN cdom*3/((sigma0 + 1000)/1000) END, 6) AS nitrate FROM sw", *DENSE))
def nitrate(spark, sf):
    base = placed(spark, sf).withColumn("molar", F.col("cdom") * 3)
    return rounded(dv.nitrate_per_kilogram(base, "molar", "nitrate").select("glider_id", "t_s", "nitrate"))


@query("derive_oxygen_per_kilogram", sql("SELECT glider_id, t_s, round(CASE WHEN d/1000 > 0.5 THEN oxygen_concentration/(d/1000) END, 6) AS doxy FROM (SELECT *, CASE WHEN seq % 20 = 3 THEN 400.0 ELSE density END AS d FROM l0)"))
def per_kg(spark, sf):
    d = F.when(F.col("seq") % 20 == 3, 400.0).otherwise(F.col("density"))
    return rounded(l0(spark, sf).select("glider_id", "t_s", per_kilogram(F.col("oxygen_concentration"), d).alias("doxy")))


@query("median_distance_spikes")
def spikes(spark, sf):
    """Tested against a plain loop over profiles (tests/test_median_distance.py)."""
    return median_distance_spikes(l0(spark, sf))
