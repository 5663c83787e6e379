"""Tests on extracted profiles. Flags merge by plain maximum; tests run in a fixed order.

Input: glider_id, profile_index, t_s, seq, values and `<v>_QC` integer flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import list_of_hex, hex_of_tests
from ..functions.seawater import density_of, with_seawater
from ..session import materialise
from .ordered import Runs, number_by_time, number_rows, stats_join

PROFILE = ["glider_id", "profile_index"]
JUMP_LIMITS = {"temperature": 10.0, "salinity": 5.0}  # fixed values
BAD = 4


def _bad(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def _raise(df: DataFrame, flag_of: dict[str, tuple[Column, int]]) -> DataFrame:
    return df.withColumns(
        {f"{v}_QC": F.when(m, F.greatest(F.col(f"{v}_QC"), F.lit(k))).otherwise(F.col(f"{v}_QC")) for v, (m, k) in flag_of.items()}
    )


def assess_present(df: DataFrame, variables: list[str]) -> DataFrame:
    """Present values count as good until a test says otherwise."""
    return df.withColumns(
        {f"{v}_QC": F.when(F.col(v).isNotNull(), F.greatest(F.col(f"{v}_QC").cast("int"), F.lit(1))).otherwise(F.col(f"{v}_QC").cast("int")) for v in variables}
    )


def pressure_not_increasing(df: DataFrame, value: str = "pressure") -> DataFrame:
    """(glider_id, seq) of levels that do not leave the middle of the profile monotonically."""
    valid = df.filter(F.col(value).isNotNull() & F.col("profile_index").isNotNull()).select(*PROFILE, "t_s", "seq", value)
    numbered = number_rows(valid, PROFILE, ["t_s"], F.floor(F.col("t_s") / 86_400), out="__i")
    sized = numbered.join(numbered.groupBy(*PROFILE).agg(F.count(F.lit(1)).alias("__n")), PROFILE).filter("__n > 1")
    middle = F.floor(F.col("__n") / 2) - 1
    down = F.struct(F.lit(True).alias("down"), (F.col("__i") - middle).alias("step"), F.col(value).alias("climb"))
    up = F.struct(F.lit(False).alias("down"), (middle - F.col("__i")).alias("step"), (-F.col(value)).alias("climb"))
    # the middle level starts both walks
    walks = F.when(F.col("__i") == middle, F.array(down, up)).when(F.col("__i") > middle, F.array(down)).otherwise(F.array(up))
    halves = sized.select(*PROFILE, "seq", F.explode(walks).alias("w")).select(*PROFILE, "seq", "w.*").withColumnRenamed("seq", "row")
    runs = Runs(halves.withColumnRenamed("step", "seq"), keys=[*PROFILE, "down"], peak={"climb": F.col("climb")})
    runs.with_columns({"stalled": F.col("climb") <= runs.peak_before("climb")})
    return runs.done().filter("stalled").select("glider_id", F.col("row").alias("seq"), "stalled").distinct()


def digit_rollover(df: DataFrame, variable: str) -> DataFrame:
    """(glider_id, seq, rollover): 4 at both sides of a jump, 3 for the rest of its run.

    A run is a stretch of a profile without missing or bad values.
    """
    limit = JUMP_LIMITS[variable]
    ok = F.col(variable).isNotNull() & (F.col(f"{variable}_QC") != BAD)
    base = df.select(*PROFILE, "seq", F.when(ok, F.col(variable)).alias("v"))
    runs = Runs(base, before=1, after=1)
    same = lambda other: runs.__getattribute__(other)("profile_index") == F.col("profile_index")
    before = F.coalesce(same("lag") & (F.abs(F.col("v") - runs.lag("v")) > limit), F.lit(False))
    after = F.coalesce(same("lead") & (F.abs(runs.lead("v") - F.col("v")) > limit), F.lit(False))
    joins = F.coalesce(same("lag") & F.col("v").isNotNull() & runs.lag("v").isNotNull(), F.lit(False))
    runs.with_columns({"jump": before | after, "opens": (~joins).cast("int")})
    ids = Runs(materialise(runs.done()), total={"opens": F.col("opens")})
    ids.with_columns({"run": ids.cumulative("opens")})
    rows = ids.done("opens").filter("v IS NOT NULL")
    jumped = rows.filter("jump").select("glider_id", "run").distinct()
    hit = rows.join(jumped, ["glider_id", "run"], "left_semi")
    return hit.select("glider_id", "seq", F.when(F.col("jump"), 4).otherwise(3).alias("rollover"))


def constant_profiles(df: DataFrame, variables: list[str]) -> DataFrame:
    """(glider, profile, constant_<v>...) of profiles with two or more equal values and no other."""
    return df.filter(F.col("profile_index").isNotNull()).groupBy(*PROFILE).agg(
        *[((F.count(v) > 1) & (F.min(v) == F.max(v))).alias(f"constant_{v}") for v in variables]
    )


def density_inversions(df: DataFrame, threshold: float = 0.03) -> DataFrame:
    """(glider_id, seq) of both levels of a pair whose upper one is denser, at their mid pressure."""
    good = F.lit(True)
    for v in ("pressure", "temperature", "salinity"):
        good = good & F.col(v).isNotNull() & (F.col(f"{v}_QC") != BAD)
    kept = df.filter(good & F.col("profile_index").isNotNull()).select(*PROFILE, "t_s", F.col("seq").alias("row"), "pressure", "temperature", "salinity")
    state = with_seawater(number_by_time(kept))
    runs = Runs(state, before=1, after=1)

    def denser(lag: bool) -> Column:
        other = runs.lag if lag else runs.lead
        mid = "(pressure + __p2)/2e0"
        mine, theirs = density_of("absolute_salinity", "potential_temperature", f"({mid})"), density_of("__sa2", "__ct2", f"({mid})")
        runs.with_columns({"__p2": other("pressure"), "__sa2": other("absolute_salinity"), "__ct2": other("potential_temperature"), "__pr2": other("profile_index")})
        runs.with_columns({"__mine": F.expr(mine), "__theirs": F.expr(theirs)})
        drop = F.col("__theirs") - F.col("__mine") if lag else F.col("__mine") - F.col("__theirs")
        runs.with_columns({f"__hit_{lag}": F.coalesce((F.col("__pr2") == F.col("profile_index")) & (drop >= threshold), F.lit(False))})
        return F.col(f"__hit_{lag}")

    hit = denser(True) | denser(False)
    return runs.done().filter(hit).select("glider_id", F.col("row").alias("seq"), F.lit(True).alias("inverted"))


def profile_tests(df: DataFrame, variables: list[str]) -> DataFrame:
    """All profile tests in order; adds `failed_8`, `failed_12`, `failed_13`, `failed_14` per row."""
    base = materialise(assess_present(df, variables))
    first = base.join(pressure_not_increasing(base), ["glider_id", "seq"], "left").withColumn("failed_8", _bad("stalled"))
    first = _raise(first, {"pressure": (F.col("failed_8"), 4)}).drop("stalled").withColumn("failed_12", F.lit(False))
    for v in JUMP_LIMITS:
        first = first.join(digit_rollover(base, v), ["glider_id", "seq"], "left")
        hit = F.coalesce(F.col("rollover"), F.lit(0))
        first = first.withColumns(
            {f"{v}_QC": F.greatest(F.col(f"{v}_QC"), hit), "failed_12": F.col("failed_12") | (hit > 0)}
        ).drop("rollover")
    constant = constant_profiles(base, variables).filter(" OR ".join(f"constant_{v}" for v in variables))
    first = stats_join(first, materialise(constant), PROFILE)
    stuck = {v: _bad(f"constant_{v}") & F.col(v).isNotNull() for v in variables}
    any_stuck = F.lit(False)
    for m in stuck.values():
        any_stuck = any_stuck | m
    first = first.withColumns({"failed_13": any_stuck, "__stuck_pressure": _bad("constant_pressure") if "pressure" in variables else F.lit(False)})
    second = materialise(_raise(first, {v: (m, 4) for v, m in stuck.items()}).drop(*[f"constant_{v}" for v in variables]))
    out = second.join(density_inversions(second), ["glider_id", "seq"], "left").withColumn("failed_14", _bad("inverted"))
    out = _raise(out, {v: (F.col("failed_14"), 4) for v in ("temperature", "salinity")}).drop("inverted")
    lost = (F.col("failed_8") | F.col("__stuck_pressure")) & (F.col("pressure_QC") == BAD)
    return _raise(out, {v: (lost & F.col(v).isNotNull(), 4) for v in variables}).drop("__stuck_pressure")


def report_tests(df: DataFrame) -> DataFrame:
    """Done and failed test lists per profile as hexadecimal words."""
    numbers = [8, 12, 13, 14]
    failed = [F.when(F.bool_or(F.col(f"failed_{k}")), F.lit(k)) for k in numbers]
    compact = lambda items: F.array_compact(F.array(*items))
    done = F.array(*[F.lit(k) for k in numbers])
    return df.filter(F.col("profile_index").isNotNull()).groupBy(*PROFILE).agg(
        hex_of_tests(done).alias("done_hex"), hex_of_tests(compact(failed)).alias("failed_hex")
    )


def failed_tests(reports: DataFrame, numbers: list[int]) -> DataFrame:
    """Latest report per (glider, profile) as one column per test number."""
    last = reports.groupBy(*PROFILE).agg(F.max_by("failed_hex", "date").alias("hex"))
    tests = list_of_hex(F.col("hex"))
    return last.select(*PROFILE, *[F.array_contains(tests, k).cast("int").alias(f"test_{k}") for k in numbers])


def rerun_with_oxygen(df: DataFrame, variables: list[str], oxygen: str = "oxygen_concentration") -> DataFrame:
    """The profile tests again, for deployments that carry oxygen only."""
    carrying = df.groupBy("glider_id").agg(F.bool_or(F.col(oxygen).isNotNull()).alias("has")).filter("has").select("glider_id")
    return profile_tests(stats_join(df, carrying, ["glider_id"], "left_semi"), variables)
