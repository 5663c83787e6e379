"""Row filters and value screens applied before any test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DISPLAY_NAMES, DISPLAY_RANGE, FACTORY_BOX, PLAUSIBLE_MAX, SCIENCE_RANGE
from ..session import materialise
from .ordered import Runs, exact_quantiles, number_by_time, number_rows, stats_join, with_quantiles

HALF_YEAR = 182.5 * 86_400


def _blank(df: DataFrame, condition: Column, *columns: str) -> DataFrame:
    bad = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(~bad, F.col(c)) for c in columns})


def _inside(lat: str, lon: str, box: tuple[float, float, float, float]) -> Column:
    south, north, west, east = box
    return (F.col(lat) > south) & (F.col(lat) < north) & (F.col(lon) > west) & (F.col(lon) < east)


def crop_time(df: DataFrame, deployment: DataFrame) -> DataFrame:
    """Keep rows between the deployment's `start` and `end`; either bound may be NULL."""
    bounds = deployment.select("glider_id", "start", "end")
    keep = F.coalesce(F.col("t_s") >= F.col("start"), F.lit(True)) & F.coalesce(F.col("t_s") <= F.col("end"), F.lit(True))
    return stats_join(df, bounds, ["glider_id"]).filter(keep).drop("start", "end")


def drop_factory_box(df: DataFrame, box: tuple[float, float, float, float] = FACTORY_BOX) -> DataFrame:
    """Drop rows strictly inside the box; rows without a position stay."""
    return df.filter(~F.coalesce(_inside("latitude", "longitude", box), F.lit(False)))


def blank_null_island(df: DataFrame) -> DataFrame:
    return _blank(df, (F.col("latitude") == 0) & (F.col("longitude") == 0), "latitude", "longitude")


def blank_factory_waypoints(df: DataFrame, box: tuple[float, float, float, float] = FACTORY_BOX) -> DataFrame:
    return _blank(
        df, _inside("waypoint_latitude", "waypoint_longitude", box), "waypoint_latitude", "waypoint_longitude"
    )


def blank_absurd_temperature(df: DataFrame, low: float = -2.5, high: float = 35.0) -> DataFrame:
    return _blank(df, (F.col("temperature") < low) | (F.col("temperature") > high), "temperature")


def keep_modal_years(df: DataFrame) -> DataFrame:
    """Keep the most frequent year of each glider (smallest on ties) and the year before it."""
    year = F.year(F.timestamp_seconds("t_s"))
    counts = df.groupBy("glider_id", year.alias("y")).agg(F.count(F.lit(1)).alias("n"))
    modal = counts.groupBy("glider_id").agg(F.max(F.struct("n", -F.col("y")))["col2"].alias("mode_y"))
    kept = stats_join(df, modal.withColumn("mode_y", -F.col("mode_y")), ["glider_id"])
    return kept.filter(year.isin(F.col("mode_y"), F.col("mode_y") - 1)).drop("mode_y")


def drop_wrong_hemisphere(df: DataFrame, gate: float = 10.0) -> DataFrame:
    """Where the median latitude is `gate` degrees or more off the equator, drop fixes across it."""
    middle = with_quantiles(df, {"mid": (F.col("latitude"), [0.5])})
    mid = F.col("mid")[0]
    wrong = (F.abs(mid) >= gate) & (F.signum("latitude") * F.signum(mid) < 0)
    return middle.filter(~F.coalesce(wrong, F.lit(False))).drop("mid", "mid_n")


def leading_test_dives(df: DataFrame) -> DataFrame:
    """(glider_id, first_deep) of gliders whose profiles before `first_deep` are test dives."""
    profiles = (
        df.filter(F.col("profile_index").isNotNull())
        .groupBy("glider_id", "profile_index")
        .agg(F.coalesce(F.max("depth"), F.lit(0.0)).alias("deepest"))
    )
    real = exact_quantiles(profiles, ["glider_id"], {"real": (F.col("deepest"), [0.75])}).select(
        "glider_id", F.col("real")[0].alias("real"), F.col("real_n").alias("n_profiles")
    )
    usable = real.filter("n_profiles >= 5 AND real >= 20")
    cut = F.greatest(F.least(F.col("real") * 0.2, F.col("real") - 10.0), F.lit(5.0))
    judged = stats_join(profiles, usable, ["glider_id"], "inner").withColumn("shallow", F.col("deepest") < cut)
    deep = judged.groupBy("glider_id").agg(
        F.min(F.when(F.col("deepest") >= F.col("real") * 0.5, F.col("profile_index"))).alias("first_deep")
    )
    leading = stats_join(judged, deep, ["glider_id"]).filter(F.col("profile_index") < F.col("first_deep"))
    return (
        leading.groupBy("glider_id", "first_deep")
        .agg(F.avg(F.col("shallow").cast("double")).alias("share"))
        .filter("share >= 0.7")
        .drop("share")
    )


def strip_test_dives(df: DataFrame) -> DataFrame:
    """Remove the leading block of shallow profiles."""
    joined = stats_join(df, leading_test_dives(df), ["glider_id"])
    before = F.coalesce(F.col("profile_index") < F.col("first_deep"), F.lit(False))
    return joined.filter(~before).drop("first_deep")


OPTICS = ("chlorophyll", "cdom", "backscatter_700")


def channel_likeness(df: DataFrame, variables: tuple[str, ...] = OPTICS) -> DataFrame:
    """How much each optical channel resembles pressure: one row per (glider, variable)."""
    pairs = [F.struct(F.lit(v).alias("variable"), F.col(v).alias("v")) for v in variables if v in df.columns]
    long = df.select("glider_id", "pressure", F.explode(F.array(*pairs)).alias("x")).filter(
        "x.v IS NOT NULL AND pressure IS NOT NULL"
    )
    v = F.col("x.v")
    same = F.avg((F.abs(v - F.col("pressure")) < 1e-3).cast("double"))
    out = long.groupBy("glider_id", "x.variable").agg(
        F.count(F.lit(1)).alias("n"),
        same.alias("share_identical"),
        F.min(v).alias("v_min"),
        F.max(v).alias("v_max"),
        F.corr(v, "pressure").alias("corr"),
    )
    pressure_like = (F.col("v_max") > 10) & (F.col("v_min") >= -2) & (F.col("v_max") - F.col("v_min") > 50)
    share = F.col("share_identical")
    return out.withColumn(
        "corrupted", (F.col("n") >= 100) & ((share > 0.5) | ((share > 0.1) & pressure_like))
    )


def blank_mismapped_channels(df: DataFrame) -> DataFrame:
    """Remove every value of an optical channel that holds pressure."""
    names = [v for v in OPTICS if v in df.columns]
    bad = channel_likeness(df).filter("corrupted").groupBy("glider_id").agg(
        *[F.bool_or(F.col("variable") == v).alias(f"__bad_{v}") for v in names]
    )
    joined = stats_join(df, bad, ["glider_id"])
    return joined.withColumns(
        {v: F.when(~F.coalesce(F.col(f"__bad_{v}"), F.lit(False)), F.col(v)) for v in names}
    ).drop(*[f"__bad_{v}" for v in names])


def pre_clean(df: DataFrame, deployment: DataFrame | None = None) -> DataFrame:
    """All cleaning steps in order; `seq` is renumbered over the rows that stay."""
    if deployment is not None:
        df = crop_time(df, deployment)
    df = blank_factory_waypoints(blank_null_island(drop_factory_box(df)))
    # each of the next steps reads the rows twice: once for its statistics, once to apply them
    df = materialise(keep_modal_years(blank_absurd_temperature(df)))
    df = materialise(drop_wrong_hemisphere(df))
    return number_by_time(strip_test_dives(df).drop("seq"))


# -- sensor streams: (glider_id, sensor, t, v) --------------------------------------------
def filter_gps(raw: DataFrame, sensors: tuple[str, str] = ("latitude", "longitude")) -> DataFrame:
    """Plausible fixes; with 50 or more, also within quartiles +- 5 IQR (5 degrees if IQR < 0.1)."""
    limit = F.when(F.col("sensor") == sensors[0], F.lit(90.0)).otherwise(F.lit(180.0))
    gps = raw.filter(F.col("sensor").isin(*sensors)).filter((F.abs("v") > 0.01) & (F.abs("v") < limit))
    spread = with_quantiles(gps, {"q": (F.col("v"), [0.25, 0.75])}, ["glider_id", "sensor"])
    iqr = F.col("q")[1] - F.col("q")[0]
    reach = F.when(iqr < 0.1, F.lit(5.0)).otherwise(5.0 * iqr)
    inside = (F.col("v") >= F.col("q")[0] - reach) & (F.col("v") <= F.col("q")[1] + reach)
    return spread.filter((F.col("q_n") < 50) | inside).drop("q", "q_n")


def filter_science(raw: DataFrame) -> DataFrame:
    """Samples of the limited sensors inside their range; other sensors unchanged."""
    keep = F.lit(True)
    for sensor, (low, high, closed) in SCIENCE_RANGE.items():
        under = F.col("v") <= high if closed else F.col("v") < high
        keep = keep & ((F.col("sensor") != sensor) | ((F.col("v") >= low) & under))
    return raw.filter(keep)


def keep_valid_years(raw: DataFrame, first: int = 2000, last: int = 2035, t: str = "t") -> DataFrame:
    year = F.year(F.timestamp_seconds(t))
    return raw.filter((year >= first) & (year <= last))


def keep_deployment_window(raw: DataFrame, deployment: DataFrame, margin_days: float = 7.0, t: str = "t") -> DataFrame:
    """Stamps within the deployment +- margin where it is known."""
    margin = margin_days * 86_400
    joined = stats_join(raw, deployment.select("glider_id", "start", "end"), ["glider_id"])
    inside = F.coalesce(F.col(t) >= F.col("start") - margin, F.lit(True)) & F.coalesce(
        F.col(t) <= F.col("end") + margin, F.lit(True)
    )
    return joined.filter(inside).drop("start", "end")


# -- decoder clean-up ----------------------------------------------------------------------
def blank_sentinels(df: DataFrame, columns: list[str], sentinels: tuple[float, ...] = (9999.0, -9999.0)) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(*sentinels), F.col(c)) for c in columns})


def drop_zero_fixes(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce((F.col("latitude") == 0) & (F.col("longitude") == 0), F.lit(False)))


def blank_half_positions(df: DataFrame) -> DataFrame:
    half = F.col("latitude").isNull() != F.col("longitude").isNull()
    return _blank(df, half, "latitude", "longitude")


def drop_before_deployment(df: DataFrame) -> DataFrame:
    """If a glider has exactly one gap of more than half a year, drop all rows before it ends."""
    runs = Runs(df, before=1)
    runs.with_columns({"__gap": F.col("t_s") - runs.lag("t_s") > HALF_YEAR})
    gaps = (
        runs.done().filter("__gap").groupBy("glider_id").agg(F.count(F.lit(1)).alias("n"), F.max("t_s").alias("resume"))
    )
    joined = stats_join(df, gaps.filter("n = 1").drop("n"), ["glider_id"])
    return joined.filter(F.col("resume").isNull() | (F.col("t_s") >= F.col("resume"))).drop("resume")


def drop_empty_rows(df: DataFrame, measured: list[str]) -> DataFrame:
    return df.filter(F.col("t_s").isNotNull() & F.coalesce(*[F.col(c) for c in measured]).isNotNull())


def clamp_display_range(df: DataFrame) -> DataFrame:
    """Values a display should not show become missing, whichever of its names a quantity has."""
    limits = {name: r for v, r in DISPLAY_RANGE.items() for name in (v, *DISPLAY_NAMES.get(v, ())) if name in df.columns}
    return df.withColumns({v: F.when(F.col(v).between(low, high), F.col(v)) for v, (low, high) in limits.items()})


def uncalibrated_channels(df: DataFrame) -> DataFrame:
    """Largest value per channel against the largest plausible one."""
    names = [v for v in PLAUSIBLE_MAX if v in df.columns]
    tops = df.groupBy("glider_id").agg(*[F.max(v).alias(v) for v in names])
    rows = [F.struct(F.lit(v).alias("variable"), F.col(v).alias("v_max"), F.lit(PLAUSIBLE_MAX[v]).alias("plausible_max")) for v in names]
    return (
        tops.select("glider_id", F.explode(F.array(*rows)).alias("x"))
        .select("glider_id", "x.*")
        .filter("v_max IS NOT NULL")
        .withColumn("uncalibrated", F.col("v_max") > F.col("plausible_max"))
    )


def pick_buoyancy(df: DataFrame, oil: str = "oil_volume", ballast: str = "ballast") -> DataFrame:
    """Deployments that carry any oil volume use it, the others their ballast."""
    deep = df.groupBy("glider_id").agg(F.bool_or(F.col(oil).isNotNull()).alias("__deep"))
    return (
        stats_join(df, deep, ["glider_id"])
        .withColumn("buoyancy", F.when(F.col("__deep"), F.col(oil)).otherwise(F.col(ballast)))
        .drop("__deep")
    )


# -- order and duplicates ------------------------------------------------------------------
def chronological(df: DataFrame) -> DataFrame:
    """Rows of a glider in time order inside bounded, day-wise partitions."""
    day = F.floor(F.col("t_s") / 86_400)
    return df.repartition("glider_id", day).sortWithinPartitions("glider_id", "t_s")


def dedupe_time(df: DataFrame, keep: str = "first", row_id: str = "row_id") -> DataFrame:
    """One row per (glider, time): the first or the last by `row_id`; rows without `row_id` come last.

    A limit on a rank is taken before the shuffle too, so a stamp that very many rows share costs
    one row a task.
    """
    order = F.col(row_id).asc_nulls_last() if keep == "first" else F.col(row_id).desc_nulls_last()
    rank = F.row_number().over(Window.partitionBy("glider_id", "t_s").orderBy(order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def drop_near_duplicates(stamps: DataFrame, t: str = "t", closer_than: float = 0.01) -> DataFrame:
    """Drop a stamp that follows its predecessor by `closer_than` seconds or less."""
    numbered = number_rows(stamps.distinct(), ["glider_id"], [t], F.floor(F.col(t) / 86_400), out="__s")
    runs = Runs(numbered, seq="__s", before=1)
    runs.with_columns({"__close": F.col(t) - runs.lag(t) <= closer_than})
    return runs.done().filter(~F.coalesce(F.col("__close"), F.lit(False))).drop("__s", "__close")


def distinct_fixes(df: DataFrame) -> DataFrame:
    """First fix of each position truncated to 3 decimals."""
    cut = lambda c: F.when(F.col(c) < 0, F.ceil(F.col(c) * 1000)).otherwise(F.floor(F.col(c) * 1000)) / 1000.0
    return (
        df.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
        .groupBy("glider_id", cut("latitude").alias("latitude"), cut("longitude").alias("longitude"))
        .agg(F.min("t_s").alias("t_s"))
    )


def largest_source(df: DataFrame, source: str = "source_file") -> DataFrame:
    """Per glider only the rows of the source holding most rows (ties: smallest name)."""
    sizes = df.groupBy("glider_id", source).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.groupBy("glider_id").agg(F.min(F.struct(-F.col("n"), F.col(source)))[source].alias(source))
    return stats_join(df, best, ["glider_id", source], "left_semi")
