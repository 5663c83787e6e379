"""Quality-flag tests on an aligned series.

Every test has a function giving its mask; `flag_series` evaluates all of them and merges the
verdicts (the worst one wins, missing stays missing). Masks depend on values only, so their
order is irrelevant; the two cascades read flags and come last.

Input: one row per (glider_id, t_s), `seq` counting the rows of a glider in time order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import METRES_PER_DEGREE
from ..functions.flags import initial_flag, raise_flag, worse_of
from ..schema import (
    CASCADE_VARIABLES,
    DRIFT_LIMITS,
    GLOBAL_RANGE,
    QC_VARIABLES,
    SPIKE_LIMITS,
    STUCK_VARIABLES,
)
from .ordered import Runs, number_rows, stats_join

FIRST_DATE = 852_076_800  # 1997-01-01T00:00:00Z
MISSING_SUFFIX = "__was_missing"
STUCK_ROWS = 10


def flagged_variables(df: DataFrame) -> list[str]:
    return [v for v in QC_VARIABLES if v in df.columns]


def mark_missing(df: DataFrame) -> DataFrame:
    """Remember which values were absent before any correction removed more of them."""
    return df.withColumns({v + MISSING_SUFFIX: F.col(v).isNull() for v in flagged_variables(df)})


def start_flags(df: DataFrame) -> DataFrame:
    """Initial flags: 9 missing from the start, 4 removed since, 1 otherwise."""
    marked = {v: v + MISSING_SUFFIX for v in flagged_variables(df)}
    return df.withColumns(
        {
            v + "_QC": initial_flag(F.col(v), F.col(m) if m in df.columns else F.col(v).isNull())
            for v, m in marked.items()
        }
    ).drop(*marked.values())


# -- masks that read one row -----------------------------------------------------------
def impossible_date(now: Column | None = None) -> Column:
    limit = F.unix_timestamp(F.current_timestamp()) if now is None else now
    return (F.col("t_s") < FIRST_DATE) | (F.col("t_s") > limit)


def impossible_location(coordinate: str) -> Column:
    return F.abs(F.col(coordinate)) > (90.0 if coordinate == "latitude" else 180.0)


def out_of_range(variable: str) -> Column:
    low, high = GLOBAL_RANGE[variable]
    return (F.col(variable) < low) | (F.col(variable) > high)


def deepest_allowed(configured: Column) -> Column:
    """Configured maximum pressure plus a tolerance that shrinks from 150 % to 10 %."""
    percent = F.when(configured <= 10, F.lit(150.0)).otherwise(150.0 - (configured - 10) * (140.0 / 990.0))
    return configured + F.when(configured > 1000, F.lit(100.0)).otherwise(configured * percent / 100.0)


# -- masks that read neighbours --------------------------------------------------------
def spike(runs: Runs, variable: str) -> Column:
    """Value off the line through its two neighbours in the same profile."""
    same = (runs.lag("profile_index") == F.col("profile_index")) & (
        runs.lead("profile_index") == F.col("profile_index")
    )
    a, b, c = runs.lag(variable), F.col(variable), runs.lead(variable)
    size = F.abs(b - (c + a) / 2.0) - F.abs((c - a) / 2.0)
    above, below = SPIKE_LIMITS[variable]
    return same & (size > F.when(F.col("pressure") < 500, F.lit(above)).otherwise(F.lit(below)))


def stuck(runs: Runs, variable: str, repeat: Column) -> Column:
    """Ten equal steps around the row; the first and last ten rows of a glider are exempt."""
    steps = F.sum(repeat).over(runs.w.rowsBetween(-(STUCK_ROWS // 2), STUCK_ROWS // 2 - 1))
    inner = (F.col("seq") >= STUCK_ROWS) & runs.lead("seq", STUCK_ROWS).isNotNull()
    return inner & (steps >= STUCK_ROWS)


def inversion(runs: Runs, threshold: float = 0.03) -> Column:
    """Density falling with depth between the row and the next one of its profile."""
    dp = runs.lead("pressure") - F.col("pressure")
    ds = runs.lead("sigma0") - F.col("sigma0")
    same = runs.lead("profile_index") == F.col("profile_index")
    return same & (((dp > 1) & (ds < -threshold)) | ((dp < -1) & (ds > threshold)))


def speed(runs: Runs, max_speed: float = 3.0) -> Column:
    """Row at either end of a leg between consecutive fixes faster than `max_speed`.

    `runs` carries `fix` both ways; `fix_lat` is the glider's mean latitude over its fixes.
    """
    here = F.struct("t_s", "latitude", "longitude")

    def too_fast(a: Column, b: Column) -> Column:
        dy = (b["latitude"] - a["latitude"]) * METRES_PER_DEGREE
        dx = (b["longitude"] - a["longitude"]) * METRES_PER_DEGREE * F.cos(F.radians("fix_lat"))
        dt = b["t_s"] - a["t_s"]
        return F.sqrt(dy * dy + dx * dx) / F.when(dt <= 0, F.lit(1.0)).otherwise(dt) > max_speed

    runs.with_columns({"__fix_before": runs.before("fix"), "__fix_after": runs.after("fix")})
    hit = F.coalesce(too_fast(F.col("__fix_before"), here), F.lit(False)) | F.coalesce(
        too_fast(here, F.col("__fix_after")), F.lit(False)
    )
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & hit


def fix() -> Column:
    return F.when(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct("t_s", "latitude", "longitude")
    )


def mean_fix_latitude(df: DataFrame) -> DataFrame:
    return df.filter(F.col("longitude").isNotNull()).groupBy("glider_id").agg(F.avg("latitude").alias("fix_lat"))


def neighbour_masks(df: DataFrame, tests: tuple[str, ...] = ("speed", "spike", "stuck", "inversion")) -> DataFrame:
    """Boolean columns of the tests that need neighbouring rows, from one shuffle."""
    tests = tuple(t for t in tests if t != "inversion" or "sigma0" in df.columns)
    if "speed" in tests:
        df = stats_join(df, mean_fix_latitude(df), ["glider_id"])
    stuck_on = [v for v in STUCK_VARIABLES if v in df.columns]
    runs = Runs(
        df,
        before=STUCK_ROWS // 2 + 1 if "stuck" in tests else 1,
        after=STUCK_ROWS if "stuck" in tests else 1,
        prev={"fix": fix()} if "speed" in tests else None,
        nxt={"fix": fix()} if "speed" in tests else None,
    )
    masks = {}
    if "stuck" in tests:
        runs.with_columns(
            {f"__same_{v}": F.coalesce((F.col(v) == runs.lag(v)).cast("int"), F.lit(0)) for v in stuck_on}
        )
        masks |= {f"stuck_{v}": stuck(runs, v, F.col(f"__same_{v}")) for v in stuck_on}
    if "spike" in tests:
        masks |= {f"spike_{v}": spike(runs, v) for v in SPIKE_LIMITS if v in df.columns}
    if "inversion" in tests:
        masks["inversion"] = inversion(runs)
    if "speed" in tests:
        masks["speed"] = speed(runs)
    runs.with_columns({k: F.coalesce(m, F.lit(False)) for k, m in masks.items()})
    return runs.done(*[f"__same_{v}" for v in stuck_on], "fix_lat", "__fix_before", "__fix_after")


# -- masks that read the whole profile ---------------------------------------------------
def halves(df: DataFrame, value: str, extra: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Valid rows of each profile as two sequences leading away from its middle row.

    `step` counts from the middle; `climb` is the value signed so that it should grow along
    `step`. Each half is its own key, numbered from 0.
    """
    keys = ["glider_id", "profile_index"]
    valid = df.filter(F.col(value).isNotNull() & F.col("profile_index").isNotNull()).select(*keys, "t_s", *extra, value)
    numbered = number_rows(valid, keys, ["t_s"], F.floor(F.col("t_s") / 86_400), out="__i")
    sized = numbered.join(numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), keys)
    middle = F.floor(F.col("__n") / 2)
    lower = F.col("__i") >= middle
    return sized.select(
        *keys,
        *extra,
        lower.alias("half"),
        F.col("__n").alias("levels"),
        F.when(lower, F.col("__i") - middle).otherwise(middle - 1 - F.col("__i")).alias("step"),
        F.when(lower, F.col(value)).otherwise(-F.col(value)).alias("climb"),
    )


def pressure_reversals(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    """(glider_id, seq) of rows running back by `threshold` dbar; profiles of 4 levels or more."""
    enough = df.groupBy("glider_id").agg(F.count("pressure").alias("__valid")).filter("__valid >= 10")
    usable = stats_join(df.select("glider_id", "profile_index", "t_s", "seq", "pressure"), enough, ["glider_id"], "inner")
    runs = Runs(
        halves(usable, "pressure").filter("levels >= 4"),
        keys=["glider_id", "profile_index", "half"],
        seq="step",
        peak={"climb": F.col("climb")},
    )
    runs.with_columns({"reversal": F.col("climb") <= runs.peak_before("climb") - threshold})
    return runs.done().filter("reversal").select("glider_id", "seq", "reversal")


def drifting_profiles(df: DataFrame) -> DataFrame:
    """Profiles whose deep mean left the median of the five before: (glider, profile, variable)."""
    keys = ["glider_id", "profile_index"]
    variables = [v for v in DRIFT_LIMITS if v in df.columns]
    base = df.filter(F.col("profile_index").isNotNull() & F.col("depth").isNotNull())
    bottom = base.groupBy(*keys).agg(F.max("depth").alias("__bottom"))
    deep = base.join(bottom, keys).filter(F.col("depth") > F.col("__bottom") - 100)
    means = (
        deep.select(*keys, F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("v")) for v in variables])).alias("x"))
        .filter("x.v IS NOT NULL")
        .groupBy(*keys, "x.variable")
        .agg(F.avg("x.v").alias("deep_mean"), F.count(F.lit(1)).alias("n"))
        .filter("n >= 3")
        .drop("n")
    )
    numbered = number_rows(
        means, ["glider_id", "variable"], ["profile_index"], F.floor(F.col("profile_index") / 10_000), out="__p"
    )
    runs = Runs(numbered, keys=["glider_id", "variable"], seq="__p", before=5)
    earlier = F.sort_array(F.array(*[runs.lag("deep_mean", k) for k in range(1, 6)]))
    limit = reduce(lambda acc, v: acc.when(F.col("variable") == v, F.lit(DRIFT_LIMITS[v])), variables, F)
    runs.with_columns({"drift": F.abs(F.col("deep_mean") - earlier[2]) > limit})
    return (
        runs.done()
        .filter((F.col("__p") >= 5) & F.col("drift"))
        .groupBy(*keys)
        .agg(*[F.bool_or(F.col("variable") == v).alias(f"drift_{v}") for v in variables])
    )


# -- all tests ---------------------------------------------------------------------------
def cascade_pressure(qc: dict[str, Column]) -> dict[str, Column]:
    """Pressure bad or missing makes every variable measured at it bad."""
    if "pressure" not in qc:
        return qc
    lost = qc["pressure"].isin(4, 9)
    return {v: raise_flag(q, lost, 4) if v in CASCADE_VARIABLES else q for v, q in qc.items()}


def cascade_temperature(qc: dict[str, Column]) -> dict[str, Column]:
    """Salinity follows a bad temperature to 4 and a missing one to 9, even from 4."""
    if "temperature" not in qc or "salinity" not in qc:
        return qc
    t = qc["temperature"]
    follow = F.when(t == 9, F.lit(9).cast("tinyint")).otherwise(raise_flag(qc["salinity"], t == 4, 4))
    return {**qc, "salinity": follow}


def apply_cascades(df: DataFrame) -> DataFrame:
    """Both cascades on existing flag columns."""
    for rule in (cascade_pressure, cascade_temperature):
        qc = {c[:-3]: F.col(c) for c in df.columns if c.endswith("_QC")}
        df = df.withColumns({v + "_QC": q for v, q in rule(qc).items()})
    return df


def raise_all(df: DataFrame, verdicts: list[tuple[Column, int, list[str]]]) -> DataFrame:
    """Merge (mask, flag, variables) verdicts into the flag columns.

    The worst verdict of each variable is found first, so a flag is compared once however many
    tests judge it.
    """
    merged = {}
    for c in df.columns:
        mine = [F.when(mask, F.lit(flag)) for mask, flag, names in verdicts if c.endswith("_QC") and c[:-3] in names]
        if mine:
            merged[c] = worse_of(F.col(c), F.greatest(*mine, F.lit(0)))
    return df.withColumns(merged)


def flag_series(df: DataFrame, max_depth: Column | float = 1000.0, now: Column | None = None) -> DataFrame:
    """Flags of all variables after every test and both cascades."""
    base = start_flags(df)
    flags = [c for c in base.columns if c.endswith("_QC")]
    every = [c[:-3] for c in flags]
    masked = neighbour_masks(base)
    helpers = [c for c in masked.columns if c not in base.columns]
    masked = masked.join(pressure_reversals(df), ["glider_id", "seq"], "left")
    drift = drifting_profiles(df)
    helpers += ["reversal", *[c for c in drift.columns if c.startswith("drift_")]]
    masked = stats_join(masked, drift, ["glider_id", "profile_index"])

    limit = deepest_allowed(max_depth if isinstance(max_depth, Column) else F.lit(float(max_depth)))
    verdicts = [
        (impossible_date(now), 4, every),
        (impossible_location("latitude"), 4, ["latitude"]),
        (impossible_location("longitude"), 4, ["longitude"]),
        (F.col("speed"), 3, every),
        *[(out_of_range(v), 4, [v]) for v in GLOBAL_RANGE if v in every],
        (F.col("pressure") < GLOBAL_RANGE["pressure"][0], 4, ["temperature", "salinity"]),
        (F.col("reversal"), 3, ["pressure"]),
        *[(F.col(f"spike_{v}"), 4, [v]) for v in SPIKE_LIMITS if v in every],
        *[(F.col(f"stuck_{v}"), 4, [v]) for v in STUCK_VARIABLES if v in every],
        *([(F.col("inversion"), 4, ["temperature", "salinity", "density"])] if "inversion" in helpers else []),
        *[(F.col(c), 3, [c[6:]]) for c in helpers if c.startswith("drift_")],
        (F.col("pressure") > limit, 3, ["pressure", "temperature", "salinity"]),
    ]
    return apply_cascades(raise_all(masked, verdicts)).drop(*helpers)
