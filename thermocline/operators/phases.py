"""Phases of a dive cycle from pressure alone.

Rows are judged by their vertical speed against a threshold taken from the deployment's own
speed histogram; everything after that works on tables of runs of equal phase.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import quotient
from ..session import materialise
from .greedy import keep_spaced
from .ordered import DAY, Runs, exact_quantiles, number_by_time, stats_join
from .segments import ASCENT, DESCENT, INCONSISTENT, INFLEXION, SUBSURFACE_DRIFT, SURFACE_DRIFT

# --- fixed values ------------------------------------------------------------------------------
DEFAULT, NO_NUMBER = -128, 99_999
MAX_PRESSURE, MAX_SPEED, SPEED_BIN = 2_500.0, 100.0, 0.5
MODE_SHARE, MODE_FRACTION = 80.0, 0.25
MIN_LEVELS, MONO_SHARE = 10, 0.7
SPEED_SECONDS, MAX_SPEED_SECONDS, MIN_SECONDS = 30, 300, 300.0  # records of high rate: speeds over spans of time, runs by duration
SURFACE_PRESSURE, INFLEXION_SECONDS, MERGE_PRESSURE = 2.0, 600.0, 10.0


def plausible_rows(df: DataFrame) -> DataFrame:
    """Rows with pressure whose forward speed is neither zero nor above 100 cm/s; `row` is the old seq."""
    valid = df.filter(F.col("pressure").isNotNull() & (F.abs("pressure") <= MAX_PRESSURE))
    numbered = number_by_time(valid.select("glider_id", "t_s", F.col("seq").alias("row"), "pressure"))
    runs = Runs(numbered, after=1)
    runs.with_columns({"__v": quotient((runs.lead("pressure") - F.col("pressure")) * 100, runs.lead("t_s") - F.col("t_s"))})
    slow = F.col("__v").isNull() | ((F.abs("__v") <= MAX_SPEED) & (F.col("__v") != 0))
    return number_by_time(runs.done().filter(slow).drop("__v", "seq"))


def speed_threshold(speeds: DataFrame) -> DataFrame:
    """(glider_id, threshold): a quarter of the slowest of the fewest bins that cover 80 % less the
    share of the zero bin."""
    bins = speeds.filter("speed IS NOT NULL").groupBy("glider_id", F.floor(F.col("speed") / SPEED_BIN + 0.5).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    whole = Window.partitionBy("glider_id")
    share = bins.withColumn("share", 100.0 * F.col("n") / F.sum("n").over(whole))
    zero = F.coalesce(F.sum(F.when(F.col("bin") == 0, F.col("share"))).over(whole), F.lit(0.0))
    earlier = whole.orderBy(F.desc("n"), "bin").rowsBetween(Window.unboundedPreceding, -1)
    moving = share.withColumn("zero", zero).filter("bin <> 0").withColumn("before", F.coalesce(F.sum("share").over(earlier), F.lit(0.0)))
    used = moving.filter((F.col("before") == 0) | (F.col("before") < MODE_SHARE - F.col("zero")))
    return used.groupBy("glider_id").agg((F.min(F.abs("bin")) * SPEED_BIN * MODE_FRACTION).alias("threshold"))


def label_runs(df: DataFrame, out: str, *breaks: str) -> DataFrame:
    """Number stretches of rows over which every column of `breaks` stays the same."""
    runs = Runs(df, before=1)
    change = F.lit(False)
    for c in breaks:
        change = change | F.coalesce(F.col(c) != runs.lag(c), F.lit(False))
    runs.with_columns({"__change": change.cast("int")})
    ids = Runs(runs.done(), total={"change": F.col("__change")})
    ids.with_columns({out: ids.cumulative("change")})
    return ids.done("__change")


def span_speeds(rows: DataFrame) -> DataFrame:
    """Add `speed`: the mean speed of the span of 30 s or more that a row ends or lies in.

    A span ends at the first row 30 s or more after its beginning, where the next one begins; a
    row more than 300 s after the beginning is one too far, if there are rows between: then the
    span ends at the last of them, and another one spans the gap. What is left at the end of a
    record is a span of its own. The first row of a record has no speed.
    """
    kept = keep_spaced(rows, SPEED_SECONDS).withColumn("__kept", F.lit(True))
    last = rows.groupBy("glider_id").agg(F.max("seq").alias("__last"))
    marked = stats_join(rows.join(kept, ["glider_id", "seq"], "left"), last, ["glider_id"])
    start = F.when(F.col("__kept"), F.col("t_s"))
    runs = Runs(marked, after=1, prev={"start": start})
    far = runs.lead("__kept") & (runs.lead("t_s") - runs.upto("start") > MAX_SPEED_SECONDS)
    runs.with_columns({"__cut": F.coalesce(F.col("__kept"), F.lit(False)) | F.coalesce(far, F.lit(False)) | (F.col("seq") == F.col("__last"))})
    cuts = materialise(runs.done("__kept", "__last"))
    cut = F.when(F.col("__cut"), F.struct("t_s", "pressure"))
    spans = Runs(cuts, prev={"cut": cut}, nxt={"cut": cut})
    spans.with_columns({"__a": spans.before("cut"), "__b": spans.onward("cut")})
    a, b = F.col("__a"), F.col("__b")
    return spans.with_columns({"speed": quotient((b["pressure"] - a["pressure"]) * 100, b["t_s"] - a["t_s"])}).done("__a", "__b", "__cut")


def least_levels(rows: DataFrame) -> DataFrame:
    """(glider_id, __least): as many rows as the median sampling period (that of the periods over 0, if it is 0) puts into 300 s."""
    runs = Runs(rows, before=1)
    steps = runs.with_columns({"__dt": F.col("t_s") - runs.lag("t_s")}).done()
    period = exact_quantiles(steps, ["glider_id"], {"all": (F.col("__dt"), [0.5]), "some": (F.when(F.col("__dt") > 0, F.col("__dt")), [0.5])})
    median = F.when(F.col("all")[0] > 0, F.col("all")[0]).otherwise(F.col("some")[0])
    return period.select("glider_id", quotient(F.lit(MIN_SECONDS), median).alias("__least"))


def moving_phases(rows: DataFrame, min_levels: int = MIN_LEVELS, by_duration: bool = False) -> DataFrame:
    """Descent and ascent by speed; shorter runs than `min_levels` (by duration: than 300 s of rows) fall back to the default."""
    timed = span_speeds(rows) if by_duration else rows
    runs = Runs(timed, before=1, after=1)
    speed = F.col("speed") if by_duration else quotient((F.col("pressure") - runs.lag("pressure")) * 100, F.col("t_s") - runs.lag("t_s"))
    forward = quotient((runs.lead("pressure") - F.col("pressure")) * 100, runs.lead("t_s") - F.col("t_s"))
    # by duration the first row joins the second one's span, if it lies on its side
    ahead = F.when(F.signum(forward) == F.signum(runs.lead("speed")), runs.lead("speed")) if by_duration else forward
    speeds = materialise(runs.with_columns({"__ahead": ahead, "speed": speed}).done())
    judged = stats_join(speeds, speed_threshold(speeds), ["glider_id"])
    v = F.coalesce("speed", "__ahead")  # the first row moves like the second one
    phase = F.when(v > F.col("threshold"), DESCENT).when(v < -F.col("threshold"), ASCENT).otherwise(DEFAULT)
    labelled = materialise(label_runs(judged.withColumn("phase", phase).drop("speed", "__ahead", "threshold"), "move", "phase"))
    counted = labelled.groupBy("glider_id", "move").agg(F.count(F.lit(1)).alias("__n"))
    if by_duration:
        short = stats_join(counted, least_levels(rows), ["glider_id"]).filter(F.col("__n") < F.col("__least")).drop("__least")
    else:
        short = counted.filter(F.col("__n") < min_levels)
    joined = labelled.join(short, ["glider_id", "move"], "left")
    return joined.withColumn("phase", F.when(F.col("__n").isNull(), F.col("phase")).otherwise(DEFAULT)).drop("move", "__n")


def deployment_parts(rows: DataFrame) -> DataFrame:
    """Add `part` and `direction`: records moving one way only are cut where half the shortest
    profile passes without a row, others at gaps of half a year."""
    share = rows.groupBy("glider_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("phase") == DESCENT).cast("int")).alias("d"), F.sum((F.col("phase") == ASCENT).cast("int")).alias("a")
    )
    mono = share.filter(F.greatest("d", "a") / F.col("n") > MONO_SHARE).select(
        "glider_id", F.when(F.col("d") > F.col("a"), DESCENT).otherwise(ASCENT).alias("one_way")
    )
    same = stats_join(rows, mono, ["glider_id"], "inner").filter("phase = one_way").drop("seq")
    walk = Runs(number_by_time(same), before=1)
    turned = F.when(F.col("one_way") == DESCENT, F.col("pressure") < walk.lag("pressure")).otherwise(F.col("pressure") > walk.lag("pressure"))
    walk.with_columns({"__turn": F.coalesce(turned, F.lit(False)).cast("int")})
    ids = Runs(walk.done(), total={"turn": F.col("__turn")})
    ids.with_columns({"__leg": ids.cumulative("turn")})
    legs = ids.done().groupBy("glider_id", "one_way", "__leg").agg((F.max("t_s") - F.min("t_s")).alias("d"))
    shortest = legs.groupBy("glider_id", "one_way").agg(F.min("d").alias("__shortest"))
    joined = stats_join(rows, shortest, ["glider_id"])
    limit = F.least(F.coalesce("__shortest", F.lit(365 * DAY)), F.lit(365 * DAY)) / 2
    runs = Runs(joined, before=1)
    runs.with_columns({"__cut": F.coalesce((F.col("t_s") - runs.lag("t_s") > limit).cast("int"), F.lit(0))})
    ids = Runs(runs.done(), total={"cut": F.col("__cut")})
    ids.with_columns({"part": ids.cumulative("cut")})
    return ids.done("__cut", "__shortest").withColumn("direction", F.when(F.col("one_way") == DESCENT, -1).when(F.col("one_way") == ASCENT, 1).otherwise(0)).drop("one_way")


def resolve_unmoving(rows: DataFrame) -> DataFrame:
    """Surface drift, subsurface drift, inflexion or inconsistent for the rows that do not move."""
    labelled = materialise(label_runs(rows, "run", "phase", "part"))
    surface = F.abs("pressure") < SURFACE_PRESSURE
    at = lambda m: F.when(m, F.col("seq"))
    table = labelled.groupBy("glider_id", "run", "phase").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b"), (F.max("t_s") - F.min("t_s")).alias("duration"),
        F.count(at(surface)).alias("n_surface"), F.min(at(surface)).alias("s0"), F.max(at(surface)).alias("s1"), F.max(at(~surface)).alias("d1"),
        F.min(at(~surface)).alias("d0"),
    )
    ends = labelled.groupBy("glider_id").agg(F.max("run").alias("last_run"))
    table = table.filter(F.col("phase") == DEFAULT).drop("phase").join(ends, "glider_id")
    first, last = F.col("run") == 0, F.col("run") == F.col("last_run")
    long = F.when(F.col("duration") <= INFLEXION_SECONDS, INFLEXION).when(F.col("n_surface") == F.col("n"), SURFACE_DRIFT).otherwise(SUBSURFACE_DRIFT)
    tail = (F.col("n_surface") > 0) & (F.col("s1") == F.col("b")) & (F.col("n_surface") == F.col("b") - F.col("s0") + 1)
    head = (F.col("n_surface") > 0) & (F.col("s0") == F.col("a")) & (F.col("n_surface") == F.col("s1") - F.col("a") + 1)
    deep_head = (F.col("d0") == F.col("a")) & (F.col("n") - F.col("n_surface") == F.col("d1") - F.col("a") + 1)
    rule = table.select(
        "glider_id", "run",
        F.when(first, F.when(tail, SURFACE_DRIFT)).when(last & head, SURFACE_DRIFT).otherwise(long).alias("at_surface"),
        F.when(first, F.when(deep_head, -1)).when(last & head, None).otherwise(long).alias("below"),
    )
    joined = labelled.join(rule, ["glider_id", "run"], "left")
    opening = F.when(F.col("direction") <= 0, INCONSISTENT).otherwise(INFLEXION)
    below = F.when(F.col("below") == -1, opening).otherwise(F.col("below"))
    settled = F.coalesce(F.when(surface, F.col("at_surface")).otherwise(below), F.lit(DEFAULT))
    return joined.withColumn("phase", F.when(F.col("phase") == DEFAULT, settled).otherwise(F.col("phase"))).drop("run", "at_surface", "below", "direction")


def merge_moving(rows: DataFrame) -> DataFrame:
    """Join neighbouring runs of the same direction that resume within 10 dbar of where the first
    stopped; what lies between them belongs to the joined run."""
    moving = rows.filter(F.col("phase").isin(DESCENT, ASCENT)).groupBy("glider_id", "phase_number", "phase").agg(
        F.min("seq").alias("a"), F.max("seq").alias("b"), F.min("t_s").alias("t_s"),
        F.min_by("pressure", "seq").alias("p0"), F.max_by("pressure", "seq").alias("p1"),
    )
    order = Runs(number_by_time(moving), before=1)
    near = F.when(F.col("phase") == DESCENT, order.lag("p1") <= F.col("p0") + MERGE_PRESSURE).otherwise(order.lag("p1") >= F.col("p0") - MERGE_PRESSURE)
    same = F.coalesce((order.lag("phase") == F.col("phase")) & near, F.lit(False))
    order.with_columns({"__new": (~same).cast("int")})
    ids = Runs(order.done(), total={"new": F.col("__new")})
    ids.with_columns({"group": ids.cumulative("new")})
    groups = ids.done().groupBy("glider_id", "group").agg(
        F.min("a").alias("seq"), F.max("b").alias("__b"), F.min("phase_number").alias("__number"), F.first("phase").alias("__phase")
    )
    marked = rows.join(groups.drop("group"), ["glider_id", "seq"], "left")
    mark = F.when(F.col("__b").isNotNull(), F.struct("__b", "__number", "__phase"))
    runs = Runs(marked, prev={"mark": mark})
    runs.with_columns({"__m": runs.upto("mark")})
    inside = F.coalesce(F.col("seq") <= F.col("__m.__b"), F.lit(False))
    return runs.done().withColumns(
        {
            "phase": F.when(inside, F.col("__m.__phase")).otherwise(F.col("phase")),
            "phase_number": F.when(inside, F.col("__m.__number")).otherwise(F.col("phase_number")),
        }
    ).drop("__b", "__number", "__phase", "__m")


def detect_phases(df: DataFrame, min_levels: int = MIN_LEVELS, by_duration: bool = False) -> DataFrame:
    """Add `phase` and `phase_number` to (glider_id, t_s, seq, pressure); `by_duration` for records of high rate."""
    rows = materialise(plausible_rows(df))
    resolved = resolve_unmoving(deployment_parts(moving_phases(rows, min_levels, by_duration)))
    numbered = materialise(label_runs(resolved, "phase_number", "phase", "part"))
    merged = merge_moving(numbered).select("glider_id", F.col("row").alias("seq"), "phase", "phase_number")
    joined = materialise(df.drop("phase", "phase_number").join(merged, ["glider_id", "seq"], "left"))
    # rows left out take the phase of the row after them
    dropped = joined.filter("pressure IS NOT NULL AND phase IS NULL").select("glider_id").distinct().withColumn("__fill", F.lit(True))
    known = F.when(F.col("phase") != DEFAULT, F.struct("phase", "phase_number"))
    runs = Runs(stats_join(joined, dropped, ["glider_id"]), nxt={"known": known})
    runs.with_columns({"__k": F.when(F.col("__fill") & F.col("pressure").isNotNull(), runs.onward("known"))})
    return runs.done().withColumns(
        {
            "phase": F.coalesce("__k.phase", "phase", F.lit(DEFAULT)),
            "phase_number": F.coalesce("__k.phase_number", "phase_number", F.lit(NO_NUMBER).cast("bigint")),
        }
    ).drop("__k", "__fill")
