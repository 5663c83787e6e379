"""Profiles, phases, gaps and distances along a glider's time axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import planar_metres, quotient
from ..session import materialise
from .align import profile_place
from .greedy import keep_spaced
from .ordered import DAY, Runs, exact_quantiles, number_by_time, number_rows, stats_join
from .sections import uneven_gradient

PROFILE = ["glider_id", "profile_index"]
# --- fixed values: phases -----------------------------------------------------------------
SURFACE_DRIFT, DESCENT, SUBSURFACE_DRIFT, INFLEXION, ASCENT, INCONSISTENT = 0, 1, 2, 3, 4, 6
PROFILE_SMOOTH_SECONDS, PROFILE_MIN_SECONDS = 100.0, 300


def ground_distance(df: DataFrame) -> DataFrame:
    """Cumulative planar distance in metres over valid fixes; rows without a fix keep the last value."""
    mean = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").groupBy("glider_id").agg(F.avg("latitude").alias("__lat"))
    fix = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct("latitude", "longitude"))
    runs = Runs(stats_join(df, mean, ["glider_id"]), prev={"fix": fix})
    runs.with_columns({"__p": runs.before("fix")})
    leg = planar_metres(F.col("__p.latitude"), F.col("__p.longitude"), F.col("latitude"), F.col("longitude"), F.col("__lat"))
    legs = materialise(runs.with_columns({"__leg": F.coalesce(leg, F.lit(0.0))}).done("__p", "__lat"))
    sums = Runs(legs, total={"leg": F.col("__leg")})
    sums.with_columns({"distance_over_ground": sums.cumulative("leg")})
    return sums.done("__leg")


def fill_pressure(df: DataFrame, scale: float = 1.0) -> DataFrame:
    """Interior gaps of pressure filled linearly in time (flag 8); open ends stay missing (9)."""
    row = F.when(F.col("pressure").isNotNull(), F.struct("t_s", (F.col("pressure") * scale).alias("p")))
    runs = Runs(df, prev={"row": row}, nxt={"row": row})
    runs.with_columns({"__p": runs.before("row"), "__n": runs.after("row")})
    a, b = F.col("__p"), F.col("__n")
    line = a["p"] + (b["p"] - a["p"]) * quotient(F.col("t_s") - a["t_s"], b["t_s"] - a["t_s"])
    filled = F.coalesce(F.col("pressure") * scale, line)
    flag = F.when(F.col("pressure").isNotNull(), 0).when(filled.isNotNull(), 8).otherwise(9)
    runs.with_columns({"pressure_filled": filled, "pressure_filled_QC": flag})
    return runs.done("__p", "__n")


def time_gaps(df: DataFrame, hours: float = 48.0) -> DataFrame:
    """Consecutive rows more than `hours` apart, times cut to whole hours."""
    hour = lambda c: F.floor(c / 3600) * 3600
    runs = Runs(df, after=1)
    runs.with_columns({"gap_end": hour(runs.lead("t_s")), "gap_start": hour(F.col("t_s"))})
    wide = F.col("gap_end") - F.col("gap_start") > hours * 3600
    return runs.done().filter(wide).select(
        "glider_id", "gap_start", "gap_end", ((F.col("gap_end") - F.col("gap_start")) / 3600.0).alias("gap_hours")
    )


def box_mean(df: DataFrame, value: str, width: Column, out: str) -> DataFrame:
    """Zero-padded box mean of `width` rows (a column constant per glider): sum / width.

    The frame reaches from -(n-1-r) to +r rows with r = (n-1) div 2. Each exact decimal prefix sum
    is sent to the two rows whose frames it ends, so the width costs nothing and only sums move;
    a frame beyond the last row ends with the glider's total.
    """
    amount = F.col(value).cast("decimal(20,9)")
    runs = Runs(df.withColumn("__n", width), total={"v": amount})
    runs.with_columns({"__sum": runs.cumulative("v")})
    sums = materialise(runs.done())
    n, r = F.col("__n").cast("bigint"), F.floor((F.col("__n") - 1) / 2)
    to = lambda seq, ends: F.struct(seq.alias("seq"), F.lit(ends).alias("ends"), F.col("__sum").alias("s"))
    moved = sums.select("glider_id", F.explode(F.array(to(F.col("seq") - r, True), to(F.col("seq") + n - r, False))).alias("x")).select("glider_id", "x.*")
    frames = moved.filter("seq >= 0").groupBy("glider_id", "seq").agg(
        F.max(F.when(F.col("ends"), F.col("s"))).alias("__at_hi"), F.max(F.when(~F.col("ends"), F.col("s"))).alias("__at_lo")
    )
    whole = sums.groupBy("glider_id").agg(F.max_by("__sum", "seq").alias("__whole"))
    joined = stats_join(sums.join(frames, ["glider_id", "seq"], "left"), whole, ["glider_id"])
    total = (F.coalesce("__at_hi", "__whole") - F.coalesce(F.col("__at_lo"), F.lit(0).cast("decimal(30,9)"))).cast("double")
    return joined.withColumn(out, total / F.col("__n")).drop("__at_hi", "__at_lo", "__whole", "__sum", "__n")


def time_gradient(df: DataFrame, value: str, out: str) -> DataFrame:
    """d(value)/dt on the uneven time axis, one-sided at both ends of a glider."""
    runs = Runs(df, before=1, after=1)
    slope = uneven_gradient(runs.lag(value), F.col(value), runs.lead(value), runs.lag("t_s"), F.col("t_s"), runs.lead("t_s"))
    return runs.with_columns({out: slope}).done()


def detect_profiles(df: DataFrame) -> DataFrame:
    """Add `profile_index` and `profile_direction` from pressure alone.

    A profile starts where the sign of the smoothed dP/dt changes to non-zero at least 300 s
    after the start of the current one.
    """
    base = df.drop("profile_index", "profile_direction")
    # a record of fewer than 100 pressures keeps its rows, without profiles
    enough = base.groupBy("glider_id").agg(F.count("pressure").alias("__p")).filter("__p >= 100").select("glider_id")
    usable = stats_join(base, enough, ["glider_id"], "left_semi")
    short = base.join(enough, ["glider_id"], "left_anti")
    row = F.when(F.col("pressure").isNotNull(), F.struct("t_s", "pressure"))
    runs = Runs(usable, before=1, prev={"row": row}, nxt={"row": row})
    runs.with_columns({"__a": runs.before("row"), "__b": runs.after("row"), "__dt": F.col("t_s") - runs.lag("t_s")})
    a, b = F.col("__a"), F.col("__b")
    line = a["pressure"] + (b["pressure"] - a["pressure"]) * quotient(F.col("t_s") - a["t_s"], b["t_s"] - a["t_s"])
    filled = F.coalesce(F.col("pressure"), line, a["pressure"], b["pressure"])
    rows = materialise(runs.done().withColumn("__f", filled).drop("__a", "__b"))
    step = exact_quantiles(rows, ["glider_id"], {"dt": (F.col("__dt"), [0.5])})
    count = rows.groupBy("glider_id").agg(F.count(F.lit(1)).alias("__rows"))
    width = F.greatest(F.lit(1), F.floor(PROFILE_SMOOTH_SECONDS / F.greatest(F.col("dt")[0], F.lit(0.1))))
    widths = step.join(count, "glider_id").select("glider_id", F.least(width, F.floor(F.col("__rows") / 2)).alias("__width"))
    smooth = box_mean(stats_join(rows, widths, ["glider_id"]), "__f", F.col("__width"), "__s").drop("__width", "__f", "__dt")
    slopes = time_gradient(smooth, "__s", "__slope").withColumn("profile_direction", F.signum("__slope").cast("int"))
    turns = Runs(slopes, before=1)
    turn = (F.col("profile_direction") != turns.lag("profile_direction")) & (F.col("profile_direction") != 0)
    marked = materialise(turns.with_columns({"__turn": F.coalesce(turn, F.lit(False))}).done("__s", "__slope"))

    candidates = materialise(number_by_time(marked.filter("__turn OR seq = 0").select("glider_id", "t_s", "seq").withColumnRenamed("seq", "__row")))
    kept = keep_spaced(candidates, PROFILE_MIN_SECONDS)
    starts = candidates.join(kept, ["glider_id", "seq"]).select("glider_id", F.col("__row").alias("seq")).filter("seq > 0").withColumn("__start", F.lit(1))
    joined = marked.join(starts, ["glider_id", "seq"], "left")
    counted = Runs(joined, total={"start": F.col("__start")})
    counted.with_columns({"profile_index": counted.cumulative("start")})
    return counted.done("__start", "__turn").unionByName(short, allowMissingColumns=True)


def buoyancy_phase(df: DataFrame, engine: str = "buoyancy", zero_is_ascent: bool = False) -> DataFrame:
    """Phase from the sign of the engine volume filled in time; same phases numbered from 1."""
    row = F.when(F.col(engine).isNotNull(), F.struct("t_s", F.col(engine).alias("v")))
    runs = Runs(df, before=1, prev={"row": row}, nxt={"row": row})
    runs.with_columns({"__p": runs.before("row"), "__n": runs.after("row")})
    p, n = F.col("__p"), F.col("__n")
    line = p["v"] + (n["v"] - p["v"]) * quotient(F.col("t_s") - p["t_s"], n["t_s"] - p["t_s"])
    v = F.coalesce(F.col(engine), line)
    up = v >= 0 if zero_is_ascent else v > 0
    runs.with_columns({"phase": F.when(up, ASCENT).when(v < 0, DESCENT).otherwise(-128)})
    return number_phases(runs.done("__p", "__n"), first=1)


def number_phases(df: DataFrame, phase: str = "phase", first: int = 0) -> DataFrame:
    """Consecutive rows of the same phase share a number."""
    runs = Runs(df, before=1)
    runs.with_columns({"__change": F.coalesce((F.col(phase) != runs.lag(phase)).cast("int"), F.lit(0))})
    sums = Runs(materialise(runs.done()), total={"change": F.col("__change")})
    sums.with_columns({"phase_number": sums.cumulative("change") + first})
    return sums.done("__change")


def extract_profiles(df: DataFrame, min_pressure: float = 10.0) -> DataFrame:
    """Descents (D) and ascents (A) reaching `min_pressure`, numbered from 1 per glider."""
    moving = df.filter(F.col("phase").isin(DESCENT, ASCENT))
    table = moving.groupBy("glider_id", "phase_number", "phase").agg(
        F.max("pressure").alias("max_pressure"), F.count(F.lit(1)).alias("levels"), F.min("t_s").alias("t_first"), F.max("t_s").alias("t_last")
    )
    kept = table.filter(F.col("max_pressure") >= min_pressure)
    numbered = number_rows(kept, ["glider_id"], ["phase_number"], F.floor(F.col("phase_number") / 10_000), out="profile_number")
    return numbered.select(
        "glider_id", (F.col("profile_number") + 1).alias("profile_number"), "phase_number",
        F.when(F.col("phase") == DESCENT, "D").otherwise("A").alias("direction"),
        "max_pressure", "levels", "t_first", "t_last",
    )


def gps_fixes(df: DataFrame) -> DataFrame:
    """First position of each profile; gliders without profiles give all their positions."""
    valid = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    per = valid.filter(F.col("profile_index").isNotNull()).groupBy(*PROFILE).agg(
        F.min_by(F.struct("t_s", "latitude", "longitude"), "t_s").alias("fix")
    ).select("glider_id", "fix.*")
    none = valid.join(per.select("glider_id").distinct(), "glider_id", "left_anti").select("glider_id", "t_s", "latitude", "longitude")
    return per.unionByName(none)


def time_in_profile(df: DataFrame) -> DataFrame:
    """Row time minus the mean time of its profile, in days."""
    mean = df.groupBy(*PROFILE).agg(F.avg("t_s").alias("__mean"))
    return df.join(mean, PROFILE).withColumn("mtime", (F.col("t_s") - F.col("__mean")) / float(DAY)).drop("__mean")


def segment_lines(df: DataFrame) -> DataFrame:
    """Points of each phase's line, one row each, with their position in it."""
    points = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    keys = ["glider_id", "phase", "phase_number"]
    return number_rows(points.select(*keys, "t_s", "longitude", "latitude"), keys, ["t_s"], F.floor(F.col("t_s") / DAY), out="position")


def trajectory_features(df: DataFrame) -> DataFrame:
    """Points of all geometry of a trajectory: `line` (a phase's fixes), `gps` (the surface fixes) and `profile` (one per profile).

    One row per point: glider_id, feature, its parent's keys (phase and phase_number, or
    profile_index), position in the parent, the parent's time span, time and place.
    """
    none = lambda kind: F.lit(None).cast(kind)
    keys = ["glider_id", "phase", "phase_number"]
    points = segment_lines(df)
    spans = segment_summary(points).drop("n_points")
    lines = stats_join(points, spans, keys).select(
        "glider_id", F.lit("line").alias("feature"), F.col("phase").cast("int").alias("phase"), F.col("phase_number").cast("bigint").alias("phase_number"), none("bigint").alias("profile_index"),
        "position", "t_first", "t_last", F.col("t_s").cast("double").alias("t_s"), "longitude", "latitude",
    )
    fixes = number_by_time(gps_fixes(df)).select(
        "glider_id", F.lit("gps").alias("feature"), none("int").alias("phase"), none("bigint").alias("phase_number"), none("bigint").alias("profile_index"),
        F.col("seq").alias("position"), F.col("t_s").alias("t_first"), F.col("t_s").alias("t_last"), F.col("t_s").cast("double").alias("t_s"), "longitude", "latitude",
    )
    within = df.filter("profile_index IS NOT NULL")
    span = within.groupBy(*PROFILE).agg(F.min("t_s").alias("t_first"), F.max("t_s").alias("t_last"))
    profiles = profile_place(within).join(span, PROFILE).filter("latitude IS NOT NULL").select(
        "glider_id", F.lit("profile").alias("feature"), none("int").alias("phase"), none("bigint").alias("phase_number"), F.col("profile_index").cast("bigint").alias("profile_index"),
        F.lit(0).cast("bigint").alias("position"), "t_first", "t_last", F.col("profile_time").alias("t_s"), "longitude", "latitude",
    )
    return lines.unionByName(fixes).unionByName(profiles)


def write_features(features: DataFrame, path: str) -> None:
    """Features in Parquet, one folder per glider and kind, in order of parents; tasks are split by time."""
    tasks = features.repartition("glider_id", "feature", F.floor(F.col("t_first") / (30 * DAY)))
    tasks.sortWithinPartitions("glider_id", "feature", "t_first", "phase_number", "profile_index", "position").write.mode("overwrite").partitionBy("glider_id", "feature").parquet(path)


def segment_summary(points: DataFrame) -> DataFrame:
    """One row per line: first and last time and number of points."""
    return points.groupBy("glider_id", "phase", "phase_number").agg(
        F.min("t_s").alias("t_first"), F.max("t_s").alias("t_last"), F.count(F.lit(1)).alias("n_points")
    )
