"""Depth and time-depth grids in long form: one row per filled cell.

`cell` numbers the depth bins from 0; the centre of cell i is (i + 0.5) * bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import quotient
from ..session import materialise
from .ordered import exact_quantiles, stats_join

PROFILE = ["glider_id", "profile_index"]
#: samples that one task of `profile_grid` holds, about
TASK_SAMPLES = 200_000
GAP_SECONDS = 48 * 3600


def long_values(df: DataFrame, variables: list[str], keep: list[str], apply_qc: bool = False) -> DataFrame:
    """Present values of `variables` as rows; with `apply_qc` only those flagged 1 or 2."""

    def value(v: str) -> Column:
        usable = apply_qc and f"{v}_QC" in df.columns
        return F.when(F.col(f"{v}_QC").isin(1, 2), F.col(v)) if usable else F.col(v)

    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), value(v).cast("double").alias("value")) for v in variables])
    return df.select(*keep, F.explode(pairs).alias("x")).select(*keep, "x.variable", "x.value").filter("value IS NOT NULL")


def grid_extent(df: DataFrame, *more: Column) -> DataFrame:
    """Number of 1 m cells per glider: down to the deepest sample, 1000 if that is under 10 m."""
    deepest = F.max("depth")
    return df.groupBy("glider_id").agg(
        F.ceil(F.when(deepest >= 10, deepest).otherwise(1000.0)).cast("bigint").alias("cells"), *more
    )


def profile_times(df: DataFrame) -> DataFrame:
    """Grid columns: mean whole second of each profile."""
    return df.filter(F.col("profile_index").isNotNull()).groupBy(*PROFILE).agg(F.avg(F.floor("t_s")).alias("time"))


def profile_grid(
    df: DataFrame, variables: list[str], apply_qc: bool = False, min_points: int = 4, min_share: float = 0.15
) -> DataFrame:
    """Profiles on 1 m cells: linear between samples, or nearest cell for sparse profiles."""
    return segment_cells(profile_segments(df, variables, apply_qc, min_points, min_share))


def profile_segments(
    df: DataFrame,
    variables: list[str],
    apply_qc: bool = False,
    min_points: int = 4,
    min_share: float = 0.15,
    neighbours: bool = False,
) -> DataFrame:
    """The profile grid before its cells are filled: the cells `first` to `last` lie between two points.

    A row is (keys, first, last, sparse, d0, v0, d1, v1); with `neighbours` also the values of the filled cells
    before the first and after the last one (`above`, `below`). There are at most as many rows as samples, and
    `segment_cells` makes the cells of a row from that row alone, so a written table of segments serves many readers.

    Equal depths are averaged, then each half-metre slot keeps its shallowest and deepest point.
    A cell centre is a slot border, so the slots on either side hold exactly the two points that
    interpolate it, and no step sees more rows per profile than there are slots.
    """
    keys = [*PROFILE, "variable"]
    # a row per glider, with its number of samples: tasks grow in number with them, so that none grows
    counted = materialise(grid_extent(df, sum(F.count(v) for v in variables).alias("__samples")))
    samples = counted.agg(F.sum("__samples")).first()[0] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-samples // TASK_SAMPLES))
    points = (
        long_values(df, variables, [*PROFILE, "depth"], apply_qc)
        .filter(F.col("profile_index").isNotNull() & F.col("depth").isNotNull())
        # the only shuffle: all that follows groups by profile and variable, and cells don't move. A number is
        # named because adaptive execution would join partitions by their bytes, which are few before cells are filled
        .repartition(tasks, *keys)
        .groupBy(*keys, "depth")
        .agg(F.avg("value").alias("value"))
    )
    point = F.struct(F.col("depth").alias("d"), F.col("value").alias("v"))
    slots = points.groupBy(*keys, (F.ceil(F.col("depth") * 2) - 1).alias("slot")).agg(
        F.min(point).alias("top"), F.max(point).alias("bottom"), F.count(F.lit(1)).alias("n")
    )
    everything = Window.partitionBy(*keys)
    along = everything.orderBy("slot")
    framed = stats_join(slots, counted.drop("__samples"), ["glider_id"]).withColumns(
        {
            "points": F.sum("n").over(everything),
            "span": F.max("bottom.d").over(everything) - F.min("top.d").over(everything),
            "next_slot": F.lead("slot").over(along),
            "next_top": F.lead("top").over(along),
        }
    )
    reach = F.col("cells") - 1
    sparse = F.coalesce((F.col("points") < min_points) | ((reach > 0) & (quotient(F.col("span"), reach) < min_share)), F.lit(False))
    half = lambda c: F.ceil(c / 2.0)
    first = F.greatest(half(F.col("slot")), F.lit(0))
    on_centre = (F.col("slot") % 2 == 0) & (F.col("bottom.d") == F.col("slot") / 2.0 + 0.5)
    last = F.when(F.col("next_slot").isNotNull(), half(F.col("next_slot")) - 1).when(on_centre, first).otherwise(-1)
    last = F.least(last, reach)
    near = lambda c: F.least(F.greatest(F.floor(c / 2.0), F.lit(0)), reach)
    nearest = near(F.col("slot"))
    # a sparse profile may reach one cell from two slots: the deeper one stays
    hidden = F.coalesce(near(F.col("next_slot")) == nearest, F.lit(False))
    out = (
        framed.withColumn("sparse", sparse)
        .withColumns(
            {
                "first": F.when(F.col("sparse"), nearest).otherwise(first),
                "last": F.when(F.col("sparse"), F.when(hidden, nearest - 1).otherwise(nearest)).otherwise(last),
            }
        )
        .filter(F.col("first") <= F.col("last"))
        .select(
            *keys, "slot", "first", "last", "sparse",
            F.col("bottom.d").alias("d0"), F.col("bottom.v").alias("v0"),
            F.col("next_top.d").alias("d1"), F.col("next_top.v").alias("v1"),
        )
    )
    if neighbours:
        ends = out.withColumns({"__top": value_at(F.col("first")), "__end": value_at(F.col("last"))})
        out = ends.withColumns(
            {
                "above": F.when(F.lag("last").over(along) == F.col("first") - 1, F.lag("__end").over(along)),
                "below": F.when(F.lead("first").over(along) == F.col("last") + 1, F.lead("__top").over(along)),
            }
        ).drop("__top", "__end")
    return out.drop("slot")


def value_at(cell: Column) -> Column:
    """Value of a cell of a segment, from the segment's columns."""
    centre = cell + 0.5
    line = F.col("v0") + (F.col("v1") - F.col("v0")) * quotient(centre - F.col("d0"), F.col("d1") - F.col("d0"))
    return F.when(F.col("sparse") | (F.col("d0") == centre), F.col("v0")).otherwise(line)


def segment_cells(segments: DataFrame) -> DataFrame:
    """One row per cell of the segments; with the values of its neighbour cells (`above`, `below`) if the segments know theirs."""
    cell = F.col("cell")
    out = segments.withColumn("cell", F.explode(F.sequence("first", "last")))
    columns = [(cell + 0.5).alias("depth"), value_at(cell).alias("value")]
    if "above" in segments.columns:
        columns += [
            F.when(cell == F.col("first"), F.col("above")).otherwise(value_at(cell - 1)).alias("above"),
            F.when(cell == F.col("last"), F.col("below")).otherwise(value_at(cell + 1)).alias("below"),
        ]
    return out.select(*PROFILE, "variable", "cell", *columns)


def with_neighbours(grid: DataFrame) -> DataFrame:
    """Cells with the values of the cells before and after them (`above`, `below`), NULL where there is none.

    A grid that has them stays as it is: no cell moves.
    """
    if "above" in grid.columns:
        return grid
    along = Window.partitionBy(*PROFILE, "variable").orderBy("cell")
    return grid.withColumns(
        {
            "above": F.when(F.lag("cell").over(along) == F.col("cell") - 1, F.lag("value").over(along)),
            "below": F.when(F.lead("cell").over(along) == F.col("cell") + 1, F.lead("value").over(along)),
        }
    )


def time_grid(
    df: DataFrame, variables: list[str], apply_qc: bool = False, depth_bin: float = 1.0, hours: float = 3.0
) -> DataFrame:
    """Means per time bin (3 h, shorter for short records) and depth bin."""
    if "depth" not in df.columns:
        df = df.withColumn("depth", F.col("pressure"))
    deep = exact_quantiles(df, ["glider_id"], {"deep": (F.col("depth"), [0.995])})
    span = df.groupBy("glider_id").agg(F.min("t_s").alias("t0"), F.max("t_s").alias("t1"))
    limit = F.when(F.col("deep")[0] >= 10, F.col("deep")[0]).otherwise(1000.0)
    duration = F.col("t1") - F.col("t0")
    shape = span.join(deep, "glider_id").select(
        "glider_id",
        "t0",
        duration.alias("duration"),
        F.floor(F.least(F.lit(hours * 3600), F.greatest(duration / 5, F.lit(60.0)))).alias("bin_s"),
        F.ceil(limit / depth_bin).alias("n_depth"),
    )
    long = long_values(df, variables, ["glider_id", "t_s", "depth"], apply_qc).filter("depth IS NOT NULL")
    joined = stats_join(long, shape, ["glider_id"])
    last = F.greatest(F.ceil(F.col("duration") / F.col("bin_s")) - 1, F.lit(0))
    column = F.least(F.floor((F.col("t_s") - F.col("t0")) / F.col("bin_s")), last)
    cell = F.least(F.greatest(F.floor(F.col("depth") / depth_bin), F.lit(0)), F.col("n_depth") - 1)
    return (
        joined.groupBy(
            "glider_id", "variable",
            (F.col("t0") + column * F.col("bin_s") + F.floor(F.col("bin_s") / 2)).alias("time"),
            cell.alias("cell"),
        )
        .agg(F.avg("value").alias("value"))
    )


def retention(df: DataFrame, variables: list[str]) -> DataFrame:
    """Share of assessed samples kept, removed and missing per (glider, variable)."""
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}_QC").alias("qc")) for v in variables if f"{v}_QC" in df.columns])
    share = lambda *k: 100.0 * F.sum(F.col("qc").isin(*k).cast("int")) / F.count(F.lit(1))
    return (
        df.select("glider_id", F.explode(pairs).alias("x"))
        .select("glider_id", "x.*")
        .filter("qc > 0")
        .groupBy("glider_id", "variable")
        .agg(
            F.count(F.lit(1)).alias("assessed"),
            share(1, 2).alias("pct_good"),
            share(3, 4).alias("pct_removed"),
            share(9).alias("pct_missing"),
            share(3, 4, 9).alias("pct_not_shown"),
        )
    )


def column_table(df: DataFrame) -> DataFrame:
    """Grid columns with their position and the gap to the column before.

    One row per profile; ordered windows over it run per glider.
    """
    from .ordered import Runs, number_rows

    columns = number_rows(profile_times(df), ["glider_id"], ["profile_index"], F.floor(F.col("profile_index") / 10_000), out="col")
    runs = Runs(columns, seq="col", before=1)
    runs.with_columns({"after_gap": F.coalesce(F.col("time") - runs.lag("time") > GAP_SECONDS, F.lit(False))})
    return runs.done()


def mask_gaps(grid: DataFrame, columns: DataFrame) -> DataFrame:
    """Drop the cells of a column that follows a gap of more than 48 h."""
    gaps = materialise(columns.filter("after_gap").select(*PROFILE))
    return stats_join(grid, gaps, PROFILE, "left_anti")


def suppress_sparse_cells(grid: DataFrame, columns: DataFrame) -> DataFrame:
    """Drop depth cells filled in fewer than max(10 %, 3) of the profiles, from 6 profiles on."""
    filled = grid.groupBy("glider_id", "variable", "cell").agg(F.count(F.lit(1)).alias("filled"))
    profiles = columns.groupBy("glider_id").agg(F.count(F.lit(1)).alias("profiles"))
    thin = stats_join(filled, profiles, ["glider_id"]).filter(
        (F.col("profiles") > 5) & (F.col("filled") < F.greatest(F.col("profiles") * 0.1, F.lit(3.0)))
    )
    cells = ["glider_id", "variable", "cell"]
    return stats_join(grid, materialise(thin.select(*cells)), cells, "left_anti")


def display_limits(grid: DataFrame) -> DataFrame:
    """2nd and 98th percentile of the cells per (glider, variable)."""
    q = exact_quantiles(grid, ["glider_id", "variable"], {"q": (F.col("value"), [0.02, 0.98])})
    return q.select("glider_id", "variable", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def usable_depth(grid: DataFrame, columns: DataFrame, extent: DataFrame, share: float = 0.1) -> DataFrame:
    """Deepest cell filled in 10 % of the profiles plus padding; else the deepest filled cell."""
    filled = grid.groupBy("glider_id", "variable", "cell").agg(F.count(F.lit(1)).alias("filled"))
    profiles = columns.groupBy("glider_id").agg(F.count(F.lit(1)).alias("profiles"))
    per = stats_join(filled, profiles, ["glider_id"], "inner").groupBy("glider_id", "variable").agg(
        F.max(F.when(F.col("filled") / F.col("profiles") >= share, F.col("cell") + 0.5)).alias("good"),
        F.max(F.col("cell") + 0.5).alias("any"),
    )
    pad = F.col("good") + F.greatest(F.lit(10.0), F.col("good") * 0.05)
    limit = F.coalesce(F.least(pad, F.col("cells") - 0.5), F.col("any"))
    return stats_join(per, extent, ["glider_id"], "inner").select("glider_id", "variable", limit.alias("usable_depth"))
