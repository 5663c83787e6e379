"""Greedy spacing over sorted times, without one task that sees a whole key.

A time is kept if it lies `apart` or more after the last one kept. That is a chain, but a run of
consecutive times only depends on the last time kept before it, and as a function of that it is
small: steps (bound, exit), where a carried time up to `bound` leaves the run as `exit`, the first
step that holds counting, and one beyond all bounds leaves as it came. Such functions are made run
by run, composed in groups, level by level, until a key has one group; then the carried times are
handed back down, and each run keeps its times. All of it is column functions over arrays of
RUN times or GROUP functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, run_rows

#: Times of a run, at most, and functions composed by one task at a time.
RUN, GROUP = 512, 256
_STEPS = "array<struct<bound:bigint,exit:bigint>>"
#: Carried before the first time of a key: everything lies far enough after it.
_BEFORE = -(2**62)


def _step(bound: Column, leaves: Column) -> Column:
    return F.struct(bound.cast("bigint").alias("bound"), leaves.cast("bigint").alias("exit"))


def _apply(steps: Column, carried: Column) -> Column:
    return F.coalesce(F.get(F.filter(steps, lambda s: s["bound"] >= carried), 0)["exit"], carried)


def _shortest(steps: Column) -> Column:
    """The same function without steps that leave as the next one does."""
    return F.filter(steps, lambda s, k: ~s["exit"].eqNullSafe(F.get(steps, k + 1)["exit"]))


def _functions(runs: DataFrame, apart: int) -> DataFrame:
    """Add `steps` to runs of sorted `times`: one for each time that can be the first one kept.

    What a lambda function uses is a column: an expression would be evaluated once for each time.
    """
    times, first = F.col("times"), F.col("first")
    following = F.filter(times, lambda t: t >= first + apart)
    entries = F.concat(F.filter(times, lambda t: t < first + apart), F.slice(following, 1, 1))
    leaves = lambda e: F.aggregate(times, e, lambda last, t: F.when(t - last >= apart, t).otherwise(last))
    steps = F.transform(F.array_distinct(entries), lambda e: _step(e - apart, leaves(e)))
    return runs.withColumn("steps", steps).withColumn("steps", _shortest(F.col("steps"))).drop("times", "first")


def _composed(functions: Column) -> Column:
    """One function for several, in order: beyond the bounds of the earlier ones a later one decides."""

    def then(f: Column, g: Column) -> Column:
        reach = F.coalesce(F.array_max(F.transform(f, lambda s: s["bound"])), F.lit(_BEFORE))
        return _shortest(F.concat(F.transform(f, lambda s: _step(s["bound"], _apply(g, s["exit"]))), F.filter(g, lambda s: s["bound"] > reach)))

    return F.aggregate(functions, F.array().cast(_STEPS), lambda f, g: then(f, g["steps"]))


def _handed(functions: Column, carried: Column) -> Column:
    """(run, carried time at its beginning) for the functions of a group, in order."""
    start = F.struct(carried.alias("carried"), F.array().cast("array<struct<run:bigint,carried:bigint>>").alias("runs"))
    return F.aggregate(
        functions,
        start,
        lambda a, g: F.struct(_apply(g["steps"], a["carried"]).alias("carried"), F.concat(a["runs"], F.array(F.struct(g["run"].alias("run"), a["carried"].alias("carried")))).alias("runs")),
    )["runs"]


def keep_spaced(df: DataFrame, apart: int, key: str = "glider_id", t: str = "t_s", seq: str = "seq") -> DataFrame:
    """Rows (key, seq) of df that a greedy pass in the order of seq keeps; the first of a key always.

    t is an integer that doesn't fall along seq, and seq counts the key's rows from 0 without holes.
    """
    n = min(RUN, run_rows(df.sparkSession))
    rows = df.select(key, F.floor(F.col(seq) / n).alias("run"), F.struct(F.col(seq).cast("bigint").alias("seq"), F.col(t).cast("bigint").alias("t")).alias("row"))
    runs = rows.groupBy(key, "run").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    runs = materialise(runs.withColumns({"times": F.col("rows.t"), "first": F.col("rows")[0]["t"]}))
    grouped = lambda level: level.groupBy(key, F.floor(F.col("run") / GROUP).alias("group")).agg(F.array_sort(F.collect_list(F.struct("run", "steps"))).alias("functions"))
    levels = [grouped(_functions(runs.select(key, "run", "times", "first"), apart))]
    while (most := levels[-1].agg(F.max("group")).first()[0]) is not None and most > 0:
        levels[-1] = materialise(levels[-1])
        levels.append(grouped(levels[-1].select(key, F.col("group").alias("run"), _composed(F.col("functions")).alias("steps"))))
    carried = None
    for level in reversed(levels):
        if carried is None:
            level = level.withColumn("carried", F.lit(_BEFORE).cast("bigint"))
        else:
            level = level.join(carried.withColumnRenamed("run", "group"), [key, "group"])
        carried = level.select(key, F.explode(_handed(F.col("functions"), F.col("carried"))).alias("r")).select(key, "r.run", "r.carried")
    begin = F.struct(F.col("carried").alias("last"), F.array().cast("array<bigint>").alias("kept"))
    kept = F.aggregate(
        "rows",
        begin,
        lambda a, r: F.when(r["t"] - a["last"] >= apart, F.struct(r["t"].alias("last"), F.concat(a["kept"], F.array(r["seq"])).alias("kept"))).otherwise(a),
    )["kept"]
    return runs.drop("times", "first").join(carried, [key, "run"]).select(key, F.explode(kept).alias(seq))
