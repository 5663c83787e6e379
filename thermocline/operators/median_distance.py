"""Median-distance spike test on profiles, with frames by value of pressure.

Levels of a profile are taken from the surface down. A level is doubtful where the vertical
gradient is too large or turns too sharply. The running median looks over a frame of pressure whose
half-width grows with depth, at as many sound levels above as below; where the profile gives it too
few, it is the level itself, and doubtful levels take the median of the last sound one. Around the
median's curve an envelope is drawn at a distance measured in scaled pressure and scaled value; a
value outside is a spike if its density is outside too, or missing.

All windows of a profile run in the one partitioning by profile. A profile is a dive: its levels
are few, and a frame holds those within 251 or 420 dbar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import quotient
from .ordered import stats_join

PROFILE = ["glider_id", "profile_index"]

# --- fixed values ------------------------------------------------------------------------------
WIDTH_LEVELS, WIDTHS = (150.0, 500.0, 1000.0, 1500.0), (110.0, 180.0, 400.0, 500.0)
GRADIENT_LEVELS = (60.0, 150.0, 500.0, 1000.0, 2100.0)
# largest gradient, and largest gradient on both sides of a change of sign, per dbar above, between and below the levels
GRADIENT = {
    "temperature": (5.0, 3.5, 0.5, 0.15, 0.05, 0.0004),
    "salinity": (1.0, 1.0, 0.08, 0.02, 0.004, 0.0002),
    "density": (1.5, 0.07, 0.07, 0.005, 0.005, 0.0004),
}
TURN = {
    "temperature": (0.08, 0.08, 0.03, 0.01, 0.003, 0.0004),
    "salinity": (0.01, 0.01, 0.005, 0.0001, 0.0002, 0.0002),
    "density": (0.006, 0.006, 0.001, 0.0004, 0.0004, 0.0004),
}
# distance from the median by zone of WIDTH_LEVELS[1:], as a share of the value's extent
DISTANCE = {"temperature": (0.15, 0.15, 0.1, 0.1), "salinity": (0.08, 0.08, 0.07, 0.07), "density": (0.08, 0.08, 0.04, 0.04)}
ALONE, ALONE_EQUATOR = (0.22, 0.22, 0.15, 0.1), (0.6, 0.18, 0.15, 0.1)  # temperature of profiles without salinity
EQUATOR = 10.0
EXTENT = {"temperature": (4.0, 10.0), "salinity": (1.0, 5.0), "density": (1.0, 6.0)}
DEPTH_SCALE, DEEP, MIN_VALUES = 700.0, 1950.0, 6
DENSITY_DROP, TEMPERATURE_RISE, GENTLE_RISE = -0.001, 0.5, 0.1


def _by_level(p: Column, levels: tuple[float, ...], values: tuple[float, ...]) -> Column:
    """values[k] down to levels[k], the last one below all levels."""
    out = F.lit(values[-1])
    for level, value in reversed(list(zip(levels, values))):
        out = F.when(p < level, F.lit(value)).otherwise(out)
    return out


def _by_variable(tables: dict[str, Column]) -> Column:
    out = F.lit(None).cast("double")
    for name, c in tables.items():
        out = F.when(F.col("variable") == name, c).otherwise(out)
    return out


def _half_width(p: Column) -> Column:
    """Values lie in the frame of a level if they are less than this from it."""
    width = F.lit(WIDTHS[-1])
    for z0, z1, w0, w1 in reversed(list(zip(WIDTH_LEVELS, WIDTH_LEVELS[1:], WIDTHS, WIDTHS[1:]))):
        width = F.when(p < z1, w0 + (w1 - w0) * ((p - z0) / (z1 - z0))).otherwise(width)
    width = F.when(p < WIDTH_LEVELS[0], WIDTHS[0]).otherwise(width)
    return F.ceil(width / 2) + 1


def doubtful_levels(values: DataFrame) -> DataFrame:
    """Add i (from 1), gradient and `out` to (profile, variable, seq, p, v, n)."""
    w = Window.partitionBy(*PROFILE, "variable").orderBy("p", "seq")
    p = F.col("p")
    dp, dv = p - F.lag("p").over(w), F.col("v") - F.lag("v").over(w)
    close = (F.abs(dv) < 0.01) & (F.abs(dp) < 5)
    step = F.when(close, 0.0).when(dp == 0, F.signum(dv) * float("inf")).otherwise(quotient(dv, dp))
    rows = values.withColumns({"i": F.row_number().over(w), "g": step})
    rows = rows.withColumns(
        {
            "g": F.coalesce("g", F.lead("g").over(w)),
            "steep": _by_variable({v: _by_level(p, GRADIENT_LEVELS, t) for v, t in GRADIENT.items()}),
            "sharp": _by_variable({v: _by_level(p, GRADIENT_LEVELS, t) for v, t in TURN.items()}),
        }
    )
    g, following = F.col("g"), F.lead("g").over(w)
    turn = (F.abs(g) > F.col("sharp")) & (F.abs(following) > F.lead("sharp").over(w)) & (F.signum(g) == -F.signum(following))
    rows = rows.withColumn("turn", F.coalesce(turn & (F.col("i") > 1), F.lit(False)))
    first = F.when(F.col("i") == 1, F.lead("turn").over(w)).otherwise(F.col("turn"))
    odd = ((F.col("variable") == "density") & (g < DENSITY_DROP)) | ((F.col("variable") == "temperature") & (g > TEMPERATURE_RISE))
    return rows.withColumn("out", first | odd | (F.abs(g) > F.col("steep"))).drop("turn", "sharp")


def running_median(rows: DataFrame) -> DataFrame:
    """Add `median` to the rows of `doubtful_levels`."""
    key = [*PROFILE, "variable"]
    w = Window.partitionBy(*key).orderBy("p", "seq")
    reach = int(WIDTHS[-1] / 2) + 1
    frame = Window.partitionBy(*key).orderBy("p").rangeBetween(-reach, reach)
    me, out = F.struct("p", "i", "v"), F.col("out")
    rows = rows.withColumns({"near": F.collect_list(F.when(~out, me)).over(frame), "half": _half_width(F.col("p"))})
    # few of the widest frame lie in a level's own; sort_array compares by generated code, array_sort by a lambda
    rows = rows.withColumn("near", F.sort_array(F.filter("near", lambda x: F.abs(x["p"] - F.col("p")) < F.col("half"))))
    rows = rows.withColumns({"above": F.filter("near", lambda x: x["p"] < F.col("p")), "below": F.filter("near", lambda x: x["p"] > F.col("p"))})
    rows = rows.withColumn("side", F.least(F.size("above"), F.size("below")))
    own = F.when(out, F.slice(F.array(me), 1, 0)).otherwise(F.array(me))
    even = F.concat(F.slice("above", F.size("above") - F.col("side") + 1, F.col("side")), own, F.slice("below", 1, F.col("side")))
    rows = rows.withColumn("used", F.when(F.col("side") > 0, even).when(F.size("near") == 0, F.array(me)).otherwise(F.col("near")))
    rows = rows.withColumn("used", F.when(F.size("used") % 2 == 0, F.concat(F.slice("used", 1, 1), F.col("used"))).otherwise(F.col("used")))
    size = F.size("used")
    at = lambda k: F.coalesce(F.get("used", k)["i"] == F.col("i"), F.lit(False))
    rows = rows.withColumns(
        {
            "middle": F.sort_array(F.col("used.v"))[F.floor(size / 2).cast("int")],
            "ends": ~out & ~F.lag("out").over(w) & (at(size - 1) | at(size - 2)),
            "begins": ~out & ~F.lead("out").over(w) & (at(F.lit(0)) | at(F.lit(1))) & ~((F.col("variable") == "temperature") & (F.col("g") > GENTLE_RISE)),
        }
    ).drop("near", "above", "below", "side", "used", "half")
    # below 1950 dbar a level too far from the last one above counts as that one's median
    deep = F.col("p") >= DEEP
    rows = rows.withColumn("last", F.last(F.when(F.col("p") < DEEP, F.struct("p", "v", "middle")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    drop = F.abs(quotient(F.col("v") - F.col("last.v"), F.col("p") - F.col("last.p"))) > F.col("steep")
    sound = F.when(deep & F.coalesce(drop, F.lit(False)), F.col("last.middle")).when(deep | F.coalesce(F.col("ends"), F.lit(False)) | F.coalesce(F.col("begins"), F.lit(False)), F.col("v")).otherwise(F.col("middle"))
    rows = rows.withColumn("sound", F.when(~out, sound))
    before = F.last("sound", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("median", F.coalesce(before, F.first("sound", ignorenulls=True).over(whole), F.first("v").over(whole))).drop("sound", "middle", "ends", "begins", "last", "steep")


def outside_envelope(rows: DataFrame) -> DataFrame:
    """Levels of (profile, variable, seq, p, v, median, alone, equator) that leave the envelope of the median's curve."""
    key = [*PROFILE, "variable"]
    w = Window.partitionBy(*key).orderBy("p", "seq")
    whole = Window.partitionBy(*key)
    extent = F.max("median").over(whole) - F.min("median").over(whole)
    extent = F.greatest(F.least(extent, _by_variable({v: F.lit(b[1]) for v, b in EXTENT.items()})), _by_variable({v: F.lit(b[0]) for v, b in EXTENT.items()}))
    rows = rows.withColumns({"extent": extent, "x1": F.lead("median").over(w), "p1": F.lead("p").over(w), "zone": _by_level(F.col("p"), WIDTH_LEVELS[1:], (0.0, 1.0, 2.0, 3.0)).cast("int")})

    def distance(k: int) -> Column:
        temperature = F.when(~F.col("alone"), DISTANCE["temperature"][k]).when(F.col("equator"), ALONE_EQUATOR[k]).otherwise(ALONE[k])
        return _by_variable({v: temperature if v == "temperature" else F.lit(t[k]) for v, t in DISTANCE.items()})

    borders = (-1e9, *WIDTH_LEVELS[1:], 1e9)
    zones = F.array(*[F.struct(F.lit(k).alias("k"), distance(k).alias("d"), F.lit(borders[k]).alias("top"), F.lit(borders[k + 1]).alias("bottom")) for k in range(4)])
    # the largest reach of the own point of the curve is where it stands: levels within it are never outside, and
    # the curve is drawn only for the zones of the others
    own = F.get(zones, F.col("zone"))["d"]
    here = F.col("extent") * F.sqrt(own * own)
    far = (F.col("v") > F.col("median") + here) | (F.col("v") < F.col("median") - here) | F.isnan(F.col("p") - F.col("p"))
    rows = rows.withColumn("wanted", F.collect_set(F.when(F.coalesce(far, F.lit(True)), F.col("zone"))).over(whole)).filter(F.size("wanted") > 0)
    # a zone's levels see the points of the curve within its distance, those on long segments included
    seen = F.filter(zones, lambda z: F.array_contains("wanted", z["k"]) & (F.coalesce("p1", "p") >= z["top"] - z["d"] * DEPTH_SCALE) & (F.col("p") <= z["bottom"] + z["d"] * DEPTH_SCALE))
    parts = rows.withColumn("far", F.coalesce(far, F.lit(True))).withColumn("z", F.explode(seen))
    dx, dp, d, lx = F.col("x1") - F.col("median"), F.col("p1") - F.col("p"), F.col("z.d"), F.col("extent")
    between = F.coalesce(F.floor(F.sqrt(dx * dx + (dp * lx / DEPTH_SCALE) ** 2) / (d * lx) - 0.2), F.lit(0)).cast("int")
    parts = parts.withColumn("between", between)
    share = lambda j: j / (F.col("between") + 1)
    added = F.when(
        F.col("between") > 0,
        F.transform(F.sequence(F.lit(1), F.col("between")), lambda j: F.struct((F.col("p") + dp * share(j)).alias("cp"), (F.col("median") + dx * share(j)).alias("cx"), F.lit(False).alias("level"))),
    ).otherwise(F.array().cast("array<struct<cp:double,cx:double,level:boolean>>"))
    me = F.struct(F.col("p").alias("cp"), F.col("median").alias("cx"), ((F.col("zone") == F.col("z.k")) & F.col("far")).alias("level"))
    points = parts.withColumn("c", F.explode(F.concat(F.array(me), added))).select(*key, "seq", "v", "extent", d.alias("d"), F.col("z.k").alias("k"), "c.*")
    reach = int(ALONE_EQUATOR[0] * DEPTH_SCALE)
    frame = Window.partitionBy(*key, "k").orderBy("cp").rangeBetween(-reach, reach)
    points = points.withColumn("near", F.collect_list(F.struct("cp", "cx")).over(frame)).filter("level")
    off = lambda q: (F.col("cp") - q["cp"]) / DEPTH_SCALE
    close = F.filter("near", lambda q: F.abs(off(q)) <= F.col("d"))
    arm = lambda q: F.col("extent") * F.sqrt(F.greatest(F.col("d") * F.col("d") - off(q) * off(q), F.lit(0.0)))
    points = points.withColumn("near", close)
    points = points.withColumns({"high": F.array_max(F.transform("near", lambda q: q["cx"] + arm(q))), "low": F.array_min(F.transform("near", lambda q: q["cx"] - arm(q)))})
    return points.filter((F.col("v") > F.col("high")) | (F.col("v") < F.col("low"))).select(*key, "seq")


def median_distance_spikes(df: DataFrame) -> DataFrame:
    """(glider_id, profile_index, seq, spike_temperature, spike_salinity) for the levels of profiles.

    A spike is NULL where the profile has at most 5 values of the variable: not assessed. Rows
    without pressure or outside profiles aren't levels; a missing value is no spike.
    """
    profile = Window.partitionBy(*PROFILE)
    held = lambda c: F.count(c).over(profile)
    levels = df.filter("profile_index IS NOT NULL AND pressure IS NOT NULL").select(
        *PROFILE, "seq", F.col("pressure").cast("double").alias("p"), "temperature", "salinity", "density",
        held("temperature").alias("n_temperature"), held("salinity").alias("n_salinity"), held("density").alias("n_density"),
        F.coalesce(F.abs(F.avg("latitude").over(profile)) <= EQUATOR, F.lit(True)).alias("equator"),
    )
    items = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("v"), F.col(f"n_{v}").alias("n")) for v in GRADIENT])
    values = levels.select(*PROFILE, "seq", "p", (F.col("n_salinity") == 0).alias("alone"), "equator", F.explode(items).alias("x")).select("*", "x.*").drop("x")
    assessed = values.filter((F.col("v").isNotNull()) & (F.col("n") >= MIN_VALUES))
    outside = outside_envelope(running_median(doubtful_levels(assessed)))
    found = outside.groupBy(*PROFILE, "seq").agg(*[F.bool_or(F.col("variable") == v).alias(f"__{v}") for v in GRADIENT])
    joined = stats_join(levels, found, [*PROFILE, "seq"])
    confirmed = F.coalesce("__density", F.lit(False)) | F.col("density").isNull()
    return joined.select(
        *PROFILE, "seq", *[F.when(F.col(f"n_{v}") >= MIN_VALUES, F.coalesce(f"__{v}", F.lit(False)) & confirmed).alias(f"spike_{v}") for v in ("temperature", "salinity")]
    )
