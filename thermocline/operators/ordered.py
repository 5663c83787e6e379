"""Exact ordered and quantile operators for keys of any size.

One deployment may hold a large share of all rows, so nothing here sorts, collects or
aggregates the distinct values of a whole key in one task:

* `number_rows` gives every row its position inside its key from per-bucket counts.
* `Runs` cuts a numbered key into runs of equal length. Fixed frames get halo rows from the
  neighbouring runs; unbounded frames (last valid value, running sum) get a carried value
  computed from one summary row per run.
* `exact_quantiles` counts values in bins and ranks only the values of the bins that hold a rank;
  `narrowed_quantiles` does so for many keys, with few bins for each.
* `stats_join` joins per-key statistics; small ones are broadcast, and no row moves for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, run_rows

GLIDER = ("glider_id",)
DAY = 86_400


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    out: str = "seq",
) -> DataFrame:
    """Add the 0-based position of each row inside its key.

    `bucket` must be non-decreasing along `order`; rows are ranked inside (key, bucket) and
    shifted by the number of rows in earlier buckets.
    """
    keys = list(keys)
    marked = df.withColumn("__bucket", bucket)
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*keys, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    return (
        marked.join(offsets.hint("shuffle_hash"), [*keys, "__bucket"], "left")
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("__offset"))
        .drop("__bucket", "__offset")
    )


def number_by_time(df: DataFrame, keys: Sequence[str] = GLIDER, t: str = "t_s", seconds: int = DAY) -> DataFrame:
    """`number_rows` in time order, one bucket per day of data."""
    return number_rows(df, keys, [t], F.floor(F.col(t) / seconds))


class Runs:
    """A frame cut into runs of consecutive rows per key, ready for window expressions.

    `prev` and `nxt` name value expressions whose last (next) non-null value has to be known
    across run borders; `total` names expressions with a running sum, `peak` those with a running maximum. `seq` must count rows
    from 0 without holes inside each key.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str] = GLIDER,
        seq: str = "seq",
        before: int = 0,
        after: int = 0,
        prev: dict[str, Column] | None = None,
        nxt: dict[str, Column] | None = None,
        total: dict[str, Column] | None = None,
        peak: dict[str, Column] | None = None,
        rows: int | None = None,
    ):
        self.prev, self.nxt, self.total, self.peak = prev or {}, nxt or {}, total or {}, peak or {}
        keys = list(keys)
        n = max(rows or run_rows(df.sparkSession), before + 1, after + 1)
        s = F.col(seq)
        own = F.floor(s / n)
        framed = df.withColumn("__home", own)
        if before or after:
            none = F.array().cast("array<bigint>")
            targets = [F.array(own)]
            if before:
                targets.append(F.when(s % n >= n - before, F.array(own + 1)).otherwise(none))
            if after:
                targets.append(F.when((s % n < after) & (own > 0), F.array(own - 1)).otherwise(none))
            framed = framed.withColumn("__run", F.explode(F.concat(*targets)))
        else:
            framed = framed.withColumn("__run", F.col("__home"))

        if self.prev or self.total or self.peak or self.nxt:
            framed = framed.join(self._carried(df, keys, s, n, before, after).hint("shuffle_hash"), [*keys, "__run"], "left")
        self.df = framed
        self.w = Window.partitionBy(*keys, "__run").orderBy(seq)
        self.back = Window.partitionBy(*keys, "__run").orderBy(F.desc(seq))

    def _carried(self, df: DataFrame, keys: list[str], s: Column, n: int, before: int, after: int) -> DataFrame:
        """One row per (key, run) with what is carried into it from both sides; df is read once."""
        past = [f"__prev_{k}" for k in self.prev], [f"__total_{k}" for k in self.total], [f"__peak_{k}" for k in self.peak]
        future = [f"__next_{k}" for k in self.nxt]
        # rows before a run end where its halo begins, rows after it begin where its halo ends
        cells = df.groupBy(*keys, F.floor((s + before) / n).alias("__up"), F.floor((s - after) / n).alias("__down")).agg(
            *[F.max_by(e, F.when(e.isNotNull(), s)).alias(c) for c, e in zip(past[0], self.prev.values())],
            *[F.sum(e).alias(c) for c, e in zip(past[1], self.total.values())],
            *[F.max(e).alias(c) for c, e in zip(past[2], self.peak.values())],
            *[F.min_by(e, F.when(e.isNotNull(), s)).alias(c) for c, e in zip(future, self.nxt.values())],
        )
        sides = [F.lit(True)] * any(past) + [F.lit(False)] * bool(future)
        side = F.col("__earlier")
        told = cells.withColumn("__earlier", F.explode(F.array(*sides))).select(
            *keys,
            F.when(side, F.col("__up") + 1).otherwise(F.col("__down") - 1).alias("__run"),
            F.when(side, F.col("__down")).otherwise(F.col("__up")).alias("__cell"),
            *[F.when(side, F.col(c)).alias(c) for names in past for c in names],
            *[F.when(~side, F.col(c)).alias(c) for c in future],
        )
        place = lambda c: F.when(F.col(c).isNotNull(), F.col("__cell"))
        per_run = told.groupBy(*keys, "__run").agg(
            *[F.max_by(c, place(c)).alias(c) for c in past[0]],
            *[F.sum(c).alias(c) for c in past[1]],
            *[F.max(c).alias(c) for c in past[2]],
            *[F.min_by(c, place(c)).alias(c) for c in future],
        )
        upto = Window.partitionBy(*keys).orderBy("__run").rowsBetween(Window.unboundedPreceding, 0)
        # frames that end at the last row are evaluated backwards: growing frames cost one pass
        onward = Window.partitionBy(*keys).orderBy(F.desc("__run")).rowsBetween(Window.unboundedPreceding, 0)
        return per_run.select(
            *keys,
            "__run",
            *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in past[0]],
            *[F.sum(c).over(upto).alias(c) for c in past[1]],
            *[F.max(c).over(upto).alias(c) for c in past[2]],
            *[F.last(c, ignorenulls=True).over(onward).alias(c) for c in future],
        )

    # -- window expressions -------------------------------------------------------------
    def lag(self, col: str | Column, k: int = 1) -> Column:
        return F.lag(col, k).over(self.w)

    def lead(self, col: str | Column, k: int = 1) -> Column:
        return F.lead(col, k).over(self.w)

    def before(self, name: str) -> Column:
        """Last non-null value strictly before the row."""
        inside = F.last(self.prev[name], ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(inside, F.col(f"__prev_{name}"))

    def upto(self, name: str) -> Column:
        """Last non-null value at or before the row."""
        return F.coalesce(self.prev[name], self.before(name))

    def after(self, name: str) -> Column:
        """First non-null value strictly after the row."""
        inside = F.last(self.nxt[name], ignorenulls=True).over(self.back.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(inside, F.col(f"__next_{name}"))

    def onward(self, name: str) -> Column:
        """First non-null value at or after the row."""
        return F.coalesce(self.nxt[name], self.after(name))

    def cumulative(self, name: str) -> Column:
        """Sum of the expression up to and including the row."""
        inside = F.sum(self.total[name]).over(self.w.rowsBetween(Window.unboundedPreceding, 0))
        return F.coalesce(inside, F.lit(0)) + F.coalesce(F.col(f"__total_{name}"), F.lit(0))

    def peak_before(self, name: str) -> Column:
        """Largest value strictly before the row."""
        inside = F.max(self.peak[name]).over(self.w.rowsBetween(Window.unboundedPreceding, -1))
        return F.greatest(inside, F.col(f"__peak_{name}"))

    def with_columns(self, cols: dict[str, Column]) -> Runs:
        self.df = self.df.withColumns(cols)
        return self

    def done(self, *drop: str) -> DataFrame:
        """Rows of the run itself (halo rows dropped) without helper columns."""
        helpers = [c for c in self.df.columns if c.startswith(("__prev_", "__next_", "__total_", "__peak_"))]
        return self.df.filter(F.col("__run") == F.col("__home")).drop("__run", "__home", *helpers, *drop)


#: Columns of which a fleet holds so few values that a table with a row for each of their combinations is small at any number of rows.
FEW = {"glider_id", "variable", "sensor"}


def stats_join(df: DataFrame, stats: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-key statistics table.

    Tables per glider and variable are broadcast by a hint: adaptive execution shuffles `df` before it
    measures anything, and keeps the shuffled join where nearly all partitions are empty, as they are
    with few keys; one task then sorts a glider. Other tables are left to Spark: written ones
    (`session.materialise`) are broadcast if their files are small, and nothing of `df` moves.
    """
    return df.join(F.broadcast(stats) if set(on) <= FEW else stats, list(on), how)


#: A quantile's bracket is counted in so many bins of equal width; only values of the bins that hold its rank are ranked.
BINS = 4096
#: The first and the last of them are cut again, so many times for each halving of the distance to that end of the bracket.
CUTS = 64
LOWEST, HIGHEST = -1_000_000, 1_000_000


def bin_of(v: Column, lo: Column, hi: Column) -> Column:
    """A number that never falls as `v` rises from `lo` to `hi`.

    Outliers at the ends of a bracket leave nearly all values in its first or last bin, which is
    why these are cut by the logarithm of the distance.
    """
    up, down = (v - lo) / (hi - lo), (hi - v) / (hi - lo)
    cut = lambda x: F.floor(F.log2(x) * CUTS)
    return (
        F.when(hi <= lo, 0)
        .when(up <= 0, LOWEST)
        .when(up < 1 / BINS, cut(up))
        .when(down <= 0, HIGHEST)
        .when(down < 1 / BINS, BINS - cut(down))
        .otherwise(F.floor(up * BINS))
        .cast("int")
    )


#: Values are counted in so many bins for each doubling of their size.
OCTAVE = 65_536


def coarse_bin(v: Column, octave: int) -> Column:
    """A number that never falls as `v` rises; it hangs on the value alone, so outliers don't widen any bin."""
    size = F.abs(v)
    # logarithms of doubles lie between -1075 and 1024
    place = F.floor(F.log2(size) * octave) + 1100 * octave
    return F.when(F.isnan(v), 3000 * octave).when(v == 0, 0).when(size == float("inf"), F.signum(v) * 2500 * octave).otherwise(F.signum(v) * place).cast("bigint")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    specs: dict[str, tuple[Column, Sequence[float]]],
    octave: int = OCTAVE,
) -> DataFrame:
    """Exact linear-interpolated quantiles per key.

    `specs` maps an output name to (value expression, quantiles). The result has one row per
    key with `<name>` (array of quantile values) and `<name>_n` (number of values). NULLs are
    ignored. All values are counted in bins of `octave` to a doubling; the bin or two that hold a rank
    bracket it with certainty. Their values are counted by value, those counts by finer bins, and only the
    bin or two of these that hold the rank are ranked, so no task sorts a key. The brackets are written,
    one row per key, so that the first count runs once. `narrowed_quantiles` is for many keys.
    """
    keys = list(keys)
    names = list(specs)
    values = df.select(*keys, *[specs[k][0].cast("double").alias(f"__v{i}") for i, k in enumerate(names)])
    if len(names) == 1:
        long = values.select(*keys, F.lit(0).alias("__i"), F.col("__v0").alias("__v"))
    else:
        told = F.array(*[F.struct(F.lit(i).alias("__i"), F.col(f"__v{i}").alias("__v")) for i in range(len(names))])
        long = values.select(*keys, F.explode(told).alias("__x")).select(*keys, "__x.*")
    # values that are missing have a bin of their own, NULL, and keep their key
    counts = long.groupBy(*keys, "__i", coarse_bin(F.col("__v"), octave).alias("__bin")).agg(
        F.count("__v").alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
    )
    whole = Window.partitionBy(*keys, "__i")
    placed = counts.withColumns({"__n": F.sum("__c").over(whole), "__upto": F.sum("__c").over(whole.orderBy("__bin"))})
    before, n = F.col("__upto") - F.col("__c"), F.col("__n")
    held, aggs = F.col("__c") > 0, []
    for i, k in enumerate(names):
        mine = held & (F.col("__i") == i)
        aggs.append(F.coalesce(F.max(F.when(F.col("__i") == i, n)), F.lit(0)).alias(f"__n{i}"))
        for j, q in enumerate(specs[k][1]):
            rank = F.floor(F.lit(float(q)) * (n - 1))
            holds = mine & (F.col("__upto") > rank) & (before <= rank + 1)
            # the least and the largest value are known
            low = F.max(F.when(mine, F.col("__hi"))) if q >= 1 else F.min(F.when(mine if q <= 0 else holds, F.col("__lo")))
            high = low if q >= 1 or q <= 0 else F.max(F.when(holds, F.col("__hi")))
            skipped = F.lit(0) if q >= 1 or q <= 0 else F.min(F.when(holds, before))
            aggs += [low.alias(f"__lo{i}_{j}"), high.alias(f"__hi{i}_{j}"), skipped.cast("bigint").alias(f"__skip{i}_{j}")]
    brackets = materialise(placed.groupBy(*keys).agg(*aggs))

    joined = stats_join(values, brackets, keys, "inner")
    picks, any_held = [], F.lit(False)
    for i, k in enumerate(names):
        for j, q in enumerate(specs[k][1]):
            v, lo, hi = F.col(f"__v{i}"), F.col(f"__lo{i}_{j}"), F.col(f"__hi{i}_{j}")
            place = F.lit(float(q)) * (F.col(f"__n{i}") - 1)
            inside = F.coalesce(v.between(lo, hi), F.lit(False))
            any_held = any_held | inside
            end = q >= 1 or q <= 0
            picks.append(
                F.when(
                    inside,
                    F.struct(
                        F.lit(i).alias("i"),
                        F.lit(j).alias("j"),
                        (F.lit(0) if end else F.floor(place) - F.col(f"__skip{i}_{j}")).cast("bigint").alias("rank"),
                        (F.lit(0.0) if end else place - F.floor(place)).alias("part"),
                        v.alias("v"),
                        bin_of(v, lo, hi).alias("bin"),
                    ),
                )
            )
    counted = (
        joined.filter(any_held)
        .select(*keys, F.explode(F.array(*picks)).alias("p"))
        .filter("p IS NOT NULL")
        .groupBy(*keys, "p.i", "p.j", "p.rank", "p.part", "p.bin", "p.v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    spot = [*keys, "i", "j"]
    bins = counted.groupBy(*spot, "bin", "rank").agg(F.sum("c").alias("c"))
    bins = bins.withColumn("upto_bin", F.sum("c").over(Window.partitionBy(*spot).orderBy("bin")))
    bins = bins.withColumn("before", F.col("upto_bin") - F.col("c")).filter((F.col("upto_bin") > F.col("rank")) & (F.col("before") <= F.col("rank") + 1))
    ranked = stats_join(counted, bins.select(*spot, "bin", "before"), [*spot, "bin"], "inner").withColumn(
        "upto", F.col("before") + F.sum("c").over(Window.partitionBy(*spot, "bin").orderBy(F.col("v").asc_nulls_first()))
    )
    low = F.min(F.when(F.col("upto") > F.col("rank"), F.struct("upto", "v")))["v"]
    high = F.min(F.when(F.col("upto") > F.col("rank") + 1, F.struct("upto", "v")))["v"]
    part = F.first("part")
    point = (
        ranked.groupBy(*keys, "i", "j")
        .agg(low.alias("low"), high.alias("high"), part.alias("part"))
        .withColumn(
            "q",
            F.when(
                F.col("low").isNull() | (F.col("high").isNull() & (F.col("part") > 0)),
                F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"),
            )
            .when(F.col("part") == 0, F.col("low"))
            .otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part")),
        )
    )
    wide = point.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("q"))).alias(f"__q{i}_{j}")
            for i, k in enumerate(names)
            for j in range(len(specs[k][1]))
        ]
    )
    sizes = brackets.select(*keys, *[F.col(f"__n{i}").alias(f"{k}_n") for i, k in enumerate(names)])
    return sizes.join(wide, keys, "left").select(
        *keys,
        *[c for i, k in enumerate(names) for c in (
            F.array(*[F.col(f"__q{i}_{j}") for j in range(len(specs[k][1]))]).alias(k),
            F.col(f"{k}_n"),
        )],
    )


#: `narrowed_quantiles` counts in so many bins for each doubling first, then cuts a bin into so many parts at a time ...
WIDE, PARTS = 64, 64
#: ... as long as the bins left hold more than this share of all values, at most so often.
SHARE, ROUNDS = 0.1, 5
#: Tables of so many rows at most are broadcast by a hint.
SMALL_ROWS = 200_000


def narrowed_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles for many keys: (keys, q, q_n), as `exact_quantiles` gives them.

    With many keys a count by fine bins moves nearly every value. Here bins are few for each key: the first
    count is coarse, and only bins that hold a rank whose value isn't yet known are cut again, each between its
    own least and largest value. A bin knows these two and the number of values before it, so a rank at
    either end of a bin, or in a bin of equal values, is known. `df` is read once for each round and should be
    written; a round moves a row for each part of a bin, the last one the values of the bins that are left.
    """
    keys = list(keys)
    spot = [*keys, "__n", "__before"]
    # no negative zeros
    values = df.select(*keys, (F.col(value).cast("double") + 0.0).alias("__v"))
    place = [F.lit(float(q)) * (F.col("__n") - 1) for q in quantiles]
    ranks = F.array_distinct(F.array(*[f(p) for p in place for f in (F.floor, F.ceil)]))

    def ranked(bins: DataFrame, explode=F.explode) -> DataFrame:
        """A row for each rank that lies in a bin, with its value if that is known."""
        before, upto = F.col("__before"), F.col("__before") + F.col("__c")
        inside = F.filter(ranks, lambda r: (r >= before) & (r < upto))
        rank, low, high = F.col("__rank"), F.col("__lo"), F.col("__hi")
        known = F.when((rank == before) | (low == high), low).when(rank == upto - 1, high)
        return bins.withColumn("__rank", explode(inside)).withColumn("__q", known)

    # values that are missing have a bin of their own, NULL, and keep their key
    counts = values.groupBy(*keys, coarse_bin(F.col("__v"), WIDE).alias("__bin")).agg(*counted("__v"))
    whole = Window.partitionBy(*keys)
    placed = counts.withColumns({"__n": F.sum("__c").over(whole), "__before": F.sum("__c").over(whole.orderBy("__bin")) - F.col("__c")})
    spots = materialise(ranked(placed.drop("__bin"), F.explode_outer))
    found = spots
    total = spots.groupBy(*keys).agg(F.max("__n").alias("__n")).agg(F.sum("__n")).first()[0] or 0
    for left in reversed(range(ROUNDS)):
        held = spots.filter("__rank IS NOT NULL AND __q IS NULL").select(*spot, "__c", "__lo", "__hi").distinct()
        # written, so that the numbers stay: cells are grouped by a bin's number in place of its key
        held = materialise(held.withColumn("__id", F.monotonically_increasing_id()))
        # a row for each key, as joins with one match for a row are faster; a key has two bins for a quantile at most
        told = held.groupBy(*[F.col(k).alias(f"__on_{k}") for k in keys]).agg(
            F.sort_array(F.collect_list(F.struct("__lo", "__hi", "__id"))).alias("__bins"), F.count(F.lit(1)).alias("__k"), F.sum("__c").alias("__c")
        )
        missing = sum(F.col(f"__on_{k}").isNull().cast("int") for k in keys)
        rows, most, within, nulls = told.agg(F.count(F.lit(1)), F.max("__k"), F.sum("__c"), F.sum(missing)).first()
        if not rows:
            break
        same = F.lit(True)
        for k in keys:
            # an equal sign is faster
            same &= F.col(k).eqNullSafe(F.col(f"__on_{k}")) if nulls else F.col(k) == F.col(f"__on_{k}")
        told = told.select(*[f"__on_{k}" for k in keys], *[F.get("__bins", F.lit(i)).alias(f"__b{i}") for i in range(most)])
        mine = F.coalesce(*[F.when(F.col("__v").between(F.col(f"__b{i}.__lo"), F.col(f"__b{i}.__hi")), F.col(f"__b{i}")) for i in range(most)])
        near = values.join(F.broadcast(told) if rows <= SMALL_ROWS else told, same).select("__v", mine.alias("__b")).filter("__b IS NOT NULL").select("__v", "__b.*")
        v, low, high = F.col("__v"), F.col("__lo"), F.col("__hi")
        # the parts of the last round are single values
        part = v if not left or within <= SHARE * total else F.floor((v - low) / (high - low) * PARTS)
        parts = near.groupBy("__id", part.alias("__part")).agg(*counted("__v"))
        upto = F.sum("__c").over(Window.partitionBy("__id").orderBy("__part"))
        shifted = parts.withColumn("__past", upto - F.col("__c")).drop("__part")
        known = held.select("__id", *spot)
        cut = shifted.join(F.broadcast(known) if rows <= SMALL_ROWS else known, "__id")
        spots = materialise(ranked(cut.withColumn("__before", F.col("__before") + F.col("__past")).drop("__id", "__past")))
        found = found.unionByName(spots)
    ends = []
    for j, p in enumerate(place):
        for name, f in (("low", F.floor), ("high", F.ceil)):
            ends.append(F.max(F.when(F.col("__rank") == f(p), F.col("__q"))).alias(f"__{name}{j}"))
    points = found.groupBy(*keys, "__n").agg(*ends)
    lost = F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    qs = []
    for j, p in enumerate(place):
        low, high, rest = F.col(f"__low{j}"), F.col(f"__high{j}"), p - F.floor(p)
        line = F.when(rest == 0, low).otherwise(low + (high - low) * rest)
        qs.append(F.when((F.col("__n") > 0) & (low.isNull() | high.isNull()), lost).when(F.col("__n") > 0, line))
    return points.select(*keys, F.array(*qs).alias("q"), F.col("__n").alias("q_n"))


def counted(v: str) -> list[Column]:
    """Number, least and largest of the values of a bin."""
    return [F.count(v).alias("__c"), F.min(v).alias("__lo"), F.max(v).alias("__hi")]


def with_quantiles(
    df: DataFrame, specs: dict[str, tuple[Column, Sequence[float]]], keys: Sequence[str] = GLIDER
) -> DataFrame:
    """`df` with the arrays of `exact_quantiles` attached to every row."""
    return stats_join(df, exact_quantiles(df, keys, specs), keys)
