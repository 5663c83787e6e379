"""Section products computed from a profile grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import quotient
from ..session import materialise
from .grid import PROFILE, mask_gaps, with_neighbours
from .ordered import Runs, exact_quantiles, narrowed_quantiles, number_rows, stats_join, with_quantiles


def mixed_layer_depth(grid: DataFrame, extent: DataFrame, variable: str = "temperature", step: float = 0.2) -> DataFrame:
    """First centre below 10 m that differs from the 10 m value by more than `step`; else the deepest."""
    cells = stats_join(grid.filter(F.col("variable") == variable), extent, ["glider_id"])
    at = F.least(F.lit(9), F.col("cells") - 1)  # centre 9.5 m, the shallower of the two nearest 10 m
    ref = cells.groupBy(*PROFILE).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(
            F.max(F.when(F.col("cell") == at, F.col("value"))), F.avg(F.when(F.col("cell") <= at + 1, F.col("value")))
        ).alias("ref"),
    )
    joined = cells.join(ref.filter("n >= 5 AND ref IS NOT NULL"), PROFILE)
    changed = (F.col("depth") > 10) & (F.abs(F.col("value") - F.col("ref")) > step)
    return joined.groupBy(*PROFILE).agg(
        F.coalesce(F.min(F.when(changed, F.col("depth"))), F.max("depth")).alias("mixed_layer_depth")
    )


ISO_DEFAULTS = {True: [28.0, 25.0, 20.0, 15.0, 10.0], False: [1024.0, 1025.0, 1025.5, 1026.0, 1026.5]}  # fixed values


def iso_levels(grid: DataFrame, variable: str, falling: bool) -> DataFrame:
    """(glider_id, level): evenly spaced levels inside the 5-95 % range of the cells."""
    q = exact_quantiles(grid.filter(F.col("variable") == variable), ["glider_id"], {"q": (F.col("value"), [0.05, 0.95])})
    low, high = F.col("q")[0], F.col("q")[1]
    spread = high - low
    wide, digits = (1.0, 1) if falling else (0.5, 2)
    a, b = low + spread * 0.15, high - spread * 0.15
    many = F.array(*[F.round(a + (b - a) * (k / 4.0), digits) for k in range(5)])
    few = F.array(*[F.round(x, 2) for x in (low + 0.1, (low + high) / 2, high - 0.1)])
    levels = F.when(F.col("q_n") <= 100, F.array(*[F.lit(v) for v in ISO_DEFAULTS[falling]])).when(spread > wide, many).otherwise(few)
    return q.select("glider_id", F.explode(F.array_distinct(levels)).alias("level"))


def iso_depth(grid: DataFrame, levels: DataFrame, variable: str, falling: bool) -> DataFrame:
    """Depth of the first crossing of each level per profile, interpolated between filled cells."""
    along = Window.partitionBy(*PROFILE).orderBy("cell")
    whole = Window.partitionBy(*PROFILE)
    cells = (
        grid.filter(F.col("variable") == variable)
        .withColumns(
            {
                "v0": F.lag("value").over(along),
                "d0": F.lag("depth").over(along),
                "n": F.count(F.lit(1)).over(whole),
                "surface": F.first("value").over(along),
            }
        )
        .filter("n >= 3")
    )
    joined = stats_join(cells, levels.groupBy("glider_id").agg(F.collect_set("level").alias("levels")), ["glider_id"], "inner")
    crossed = joined.withColumn("level", F.explode("levels"))
    sign = 1.0 if falling else -1.0
    past = (F.col("value") - F.col("level")) * sign < 0
    present = (F.col("surface") - F.col("level")) * sign > 0
    # only the first cell past the level is interpolated: further down neighbours may be equal
    at = F.min_by(F.struct("v0", "d0", "value", "depth"), "cell")
    line = F.col("at.d0") + quotient(F.col("level") - F.col("at.v0"), F.col("at.value") - F.col("at.v0")) * (F.col("at.depth") - F.col("at.d0"))
    return (
        crossed.filter(present & past)
        .groupBy(*PROFILE, "level")
        .agg(at.alias("at"))
        .select(*PROFILE, "level", line.alias("iso_depth"))
        .filter("iso_depth IS NOT NULL")
    )


def depth_anomaly(grid: DataFrame, columns: DataFrame, usable: DataFrame) -> DataFrame:
    """Value minus its mean over time at each depth, with the 95 % limit of its size."""
    shown = trimmed(grid, columns, usable)
    cells = ["glider_id", "variable", "cell"]
    means = materialise(shown.groupBy(*cells).agg(F.avg("value").alias("mean")))
    anomaly = stats_join(shown, means, cells, "inner").withColumn("anomaly", F.col("value") - F.col("mean"))
    out = with_quantiles(anomaly, {"q": (F.abs("anomaly"), [0.95])}, ["glider_id", "variable"])
    return out.withColumn("anomaly_limit", F.col("q")[0]).drop("q", "q_n", "mean")


def trimmed(grid: DataFrame, columns: DataFrame, usable: DataFrame) -> DataFrame:
    """Cells down to the usable depth outside gap columns."""
    kept = stats_join(grid, usable, ["glider_id", "variable"]).filter(F.col("depth") <= F.col("usable_depth"))
    return mask_gaps(kept, columns)


def uneven_gradient(back: Column, here: Column, ahead: Column, x0: Column, x: Column, x1: Column) -> Column:
    """Second-order derivative estimate on uneven steps; one-sided where a neighbour row is absent.

    `back`/`ahead` are values, `x0`/`x1` their coordinates (NULL where there is no row).
    """
    hs, hd = x - x0, x1 - x
    inner = quotient(hs * hs * ahead + (hd * hd - hs * hs) * here - hd * hd * back, hs * hd * (hs + hd))
    return F.when(x0.isNull(), quotient(ahead - here, hd)).when(x1.isNull(), quotient(here - back, hs)).otherwise(inner)


def vertical_gradient(grid: DataFrame, columns: DataFrame, usable: DataFrame, limit: float | None = None) -> DataFrame:
    """d(value)/d(depth) of each cell, down to `limit` if one is given; a missing neighbour cell gives no result."""
    cap = usable if limit is None else usable.withColumn("usable_depth", F.least(F.lit(limit), F.col("usable_depth")))
    told = [c for c in ("above", "below") if c in grid.columns]
    # only what is needed is kept; the centre of a cell follows from its number. A neighbour below the limit
    # counts for no cell: the last one is taken to have none, and the cells before it reach no further
    kept = trimmed(grid, columns, cap).select(*PROFILE, "variable", "cell", "value", *told, F.floor(F.col("usable_depth") - 0.5).alias("last"))
    shown, cell = with_neighbours(kept), F.col("cell")
    x = cell + 0.5
    x0, x1 = F.when(cell > 0, x - 1.0), F.when(cell < F.col("last"), x + 1.0)
    slope = uneven_gradient(F.col("above"), F.col("value"), F.col("below"), x0, x, x1)
    return shown.withColumn("gradient", slope).filter("gradient IS NOT NULL").select(*PROFILE, "variable", "cell", "gradient")


def profile_envelope(grid: DataFrame) -> DataFrame:
    """Minimum, quartiles and maximum per depth cell."""
    q = narrowed_quantiles(grid, ["glider_id", "variable", "cell"], "value", [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["v_min", "p25", "median", "p75", "v_max"]
    return q.select("glider_id", "variable", "cell", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def surface_series(grid: DataFrame, columns: DataFrame, extent: DataFrame) -> DataFrame:
    """Mean near-surface value per column and its 5-column running mean with repeated ends."""
    limit = F.least(F.greatest(F.lit(15.0), 0.05 * (F.col("cells") - 0.5)), F.lit(50.0))
    near = stats_join(grid, extent, ["glider_id"]).filter(F.col("depth") <= limit)
    means = near.groupBy(*PROFILE, "variable").agg(F.avg("value").alias("surface"))
    names = means.select("glider_id", "variable").distinct()
    every = columns.join(names, "glider_id").join(means, [*PROFILE, "variable"], "left")
    runs = Runs(every, keys=["glider_id", "variable"], seq="col", before=2, after=2)
    runs.with_columns(
        {f"__o{k + 2}": runs.lag("surface", -k) if k < 0 else runs.lead("surface", k) for k in (-2, -1, 1, 2)}
        | {f"__x{k}": runs.lead("col", k) for k in (1, 2)}
    )
    me, col = F.col("surface"), F.col("col")
    tail1, tail2 = F.col("__x1").isNull(), F.col("__x2").isNull()
    frame = [
        F.when(col == 0, me).when(col == 1, F.col("__o1")).otherwise(F.col("__o0")),
        F.when(col == 0, me).otherwise(F.col("__o1")),
        me,
        F.when(tail1, me).otherwise(F.col("__o3")),
        F.when(tail1, me).when(tail2, F.col("__o3")).otherwise(F.col("__o4")),
    ]
    total = sum((F.coalesce(f, F.lit(0.0)) for f in frame), F.lit(0.0))
    count = sum((f.isNotNull().cast("int") for f in frame), F.lit(0))
    runs.with_columns({"smoothed": F.when(me.isNotNull(), total / count)})
    return runs.done().filter("surface IS NOT NULL").select(*PROFILE, "variable", "time", "surface", "smoothed")


def section(
    grid: DataFrame, columns: DataFrame, usable: DataFrame, variables: list[str], floor_zero: bool = False, steps: int = 8
) -> DataFrame:
    """Trimmed, gap-masked cells of the chosen variables with display limits and overlay levels."""
    chosen = grid.filter(F.col("variable").isin(*variables))
    if floor_zero:
        chosen = chosen.withColumn("value", F.greatest(F.col("value"), F.lit(0.0)))
    shown = trimmed(chosen, columns, usable).drop("usable_depth")
    out = with_quantiles(shown, {"q": (F.col("value"), [0.02, 0.05, 0.95, 0.98])}, ["glider_id", "variable"])
    low, high = F.col("q")[1], F.col("q")[2]
    return out.select(
        *PROFILE, "variable", "cell", "value",
        F.col("q")[0].alias("low"), F.col("q")[3].alias("high"),
        F.floor(F.round(quotient(F.col("value") - low, high - low) * (steps - 1), 9)).alias("contour"),
    )


DEPTH_BANDS = [(0.0, 50.0), (50.0, 200.0), (200.0, 500.0), (500.0, 1100.0)]  # fixed values


def good_ts(df: DataFrame) -> DataFrame:
    """Rows with temperature and salinity flagged 1 or 2, with time scaled to 0..1 per glider."""
    good = df.filter(
        F.col("temperature").isNotNull() & F.col("salinity").isNotNull() & F.col("temperature_QC").isin(1, 2) & F.col("salinity_QC").isin(1, 2)
    )
    span = good.groupBy("glider_id").agg(F.min("t_s").alias("t0"), F.max("t_s").alias("t1"))
    scaled = (F.col("t_s") - F.col("t0")) / F.greatest(F.col("t1") - F.col("t0"), F.lit(1))
    return stats_join(good, span, ["glider_id"]).withColumn("time_scaled", scaled).drop("t0", "t1")


def drawn(rate: float, *parts: str) -> Column:
    """True for a share `rate` of rows, decided by each row's own hash: the same at every size, in every run."""
    if rate >= 1.0:
        return F.lit(True)
    hashed = F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in parts])), 1, 8)
    return hashed < F.lit(f"{int(rate * 2**32):08x}")


def stratified_ts(df: DataFrame, rates: Sequence[float] = (1.0,) * (len(DEPTH_BANDS) + 1)) -> DataFrame:
    """T-S rows with their depth band, sampled at a rate per band; the last rate is for rows outside the bands."""
    band = F.lit(len(DEPTH_BANDS))
    kept = drawn(rates[-1], "glider_id", "t_s")
    for i, (low, high) in enumerate(DEPTH_BANDS):
        inside = F.coalesce((F.col("depth") >= low) & (F.col("depth") < high), F.lit(False))
        band = F.when(inside, F.lit(i)).otherwise(band)
        kept = F.when(inside, drawn(rates[i], "glider_id", "t_s")).otherwise(kept)
    return good_ts(df).withColumn("band", band).filter(kept)


def uniform_cells(grid: DataFrame, rate: float = 1.0) -> DataFrame:
    """Grid cells that hold both temperature and salinity, sampled at a rate."""
    return (
        grid.filter(F.col("variable").isin("temperature", "salinity"))
        .groupBy(*PROFILE, "cell")
        .agg(
            F.max(F.when(F.col("variable") == "temperature", F.col("value"))).alias("temperature"),
            F.max(F.when(F.col("variable") == "salinity", F.col("value"))).alias("salinity"),
        )
        .filter("temperature IS NOT NULL AND salinity IS NOT NULL")
        .filter(drawn(rate, *PROFILE, "cell"))
    )


def track(df: DataFrame) -> DataFrame:
    """Valid positions with time scaled to 0..1."""
    fixes = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").select("glider_id", "t_s", "latitude", "longitude")
    span = fixes.groupBy("glider_id").agg(F.min("t_s").alias("t0"), F.max("t_s").alias("t1"))
    scaled = (F.col("t_s") - F.col("t0")) / F.greatest(F.col("t1") - F.col("t0"), F.lit(1))
    return stats_join(fixes, span, ["glider_id"]).withColumn("time_scaled", scaled).drop("t0", "t1")


def track_extent(df: DataFrame) -> DataFrame:
    """Bounding box of the track padded by max(2 degrees, 20 %)."""
    fixes = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    out = fixes.groupBy("glider_id").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("min", F.min), ("max", F.max))]
    )
    cols = []
    for c in ("latitude", "longitude"):
        pad = F.greatest(F.lit(2.0), 0.2 * (F.col(f"max_{c}") - F.col(f"min_{c}")))
        cols += [(F.col(f"min_{c}") - pad).alias(f"low_{c}"), (F.col(f"max_{c}") + pad).alias(f"high_{c}")]
    return out.select("glider_id", *cols)
