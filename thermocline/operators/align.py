"""Joins on time: alignment, interpolation, nearest rows, positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import geodesic_metres, lerp, quotient
from ..session import materialise
from .ordered import DAY, Runs, exact_quantiles, number_rows, stats_join, with_quantiles

PROFILE = ["glider_id", "profile_index"]


# -- equal stamps ---------------------------------------------------------------------------
def full_time_join(left: DataFrame, right: DataFrame, suffixes: tuple[str, str] = ("_l0", "_l1"), keys=("glider_id", "t_s")) -> DataFrame:
    """Full outer join on the stamp; `side` tells where it came from."""
    keys = list(keys)
    a = left.select(*keys, *[F.col(c).alias(c + suffixes[0]) for c in left.columns if c not in keys], F.lit(1).alias("__a"))
    b = right.select(*keys, *[F.col(c).alias(c + suffixes[1]) for c in right.columns if c not in keys], F.lit(1).alias("__b"))
    side = F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").otherwise("both")
    return a.join(b, keys, "full").withColumn("side", side).drop("__a", "__b")


def side_counts(joined: DataFrame) -> DataFrame:
    return joined.groupBy("glider_id", "side").agg(F.count(F.lit(1)).alias("n"))


def matched(left: DataFrame, right: DataFrame, variables: list[str]) -> DataFrame:
    """Rows with the same stamp on both sides."""
    a = left.select("glider_id", "t_s", *[F.col(v).alias(f"{v}_l0") for v in variables])
    b = right.select("glider_id", "t_s", *[F.col(v).alias(f"{v}_l1") for v in variables])
    return a.join(b, ["glider_id", "t_s"])


def stamp_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Stamps of either side with the set they belong to."""
    both = left.select("glider_id", "t_s").distinct().withColumn("l", F.lit(True)).join(
        right.select("glider_id", "t_s").distinct().withColumn("r", F.lit(True)), ["glider_id", "t_s"], "full"
    )
    kind = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").otherwise("both")
    return both.select("glider_id", "t_s", kind.alias("member"))


def join_clocks(eng: DataFrame, sci: DataFrame, whole_seconds: bool = True) -> DataFrame:
    """Full outer join of two clocks of one vehicle; each clock fills the other's gaps."""
    key = (lambda c: F.floor(F.col(c) + 0.5)) if whole_seconds else F.col
    a = eng.withColumn("__k", key("t")).withColumnRenamed("t", "t_eng")
    b = sci.withColumn("__k", key("t")).withColumnRenamed("t", "t_sci")
    return (
        a.join(b, ["glider_id", "__k"], "full")
        .withColumns({"t_eng": F.coalesce("t_eng", "t_sci"), "t_sci": F.coalesce("t_sci", "t_eng")})
        .drop("__k")
    )


def one_axis(blocks: list[DataFrame], keys=("glider_id", "t_s")) -> DataFrame:
    """Blocks with their own clocks on the union of all stamps; no stamp is dropped.

    The blocks are stacked and folded by stamp in one shuffle, however many there are. Of rows of
    a block at one stamp, each column keeps its largest value. A column name belongs to one block.
    """
    keys = list(keys)
    names = [c for b in blocks for c in b.columns if c not in keys]
    if len(set(names)) < len(names):
        raise ValueError(f"columns in more than one block: {sorted({c for c in names if names.count(c) > 1})}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names]) if names else stacked.distinct()


# -- interpolation ---------------------------------------------------------------------------
def sync_sensors(raw: DataFrame, sensors: list[str], closer_than: float = 0.01) -> DataFrame:
    """All sensors on the union of their stamps: (glider_id, t, <sensor>...).

    Values are interpolated linearly in time, never outside the record and never where the
    nearest sample is farther than max(5 median steps, 30 s); sensors with a single sample give
    nothing.
    """
    wide = raw.filter(F.col("sensor").isin(*sensors) & F.col("v").isNotNull()).groupBy("glider_id", "t").agg(
        *[F.min(F.when(F.col("sensor") == s, F.col("v"))).alias(s) for s in sensors]
    )
    axis = number_rows(wide, ["glider_id"], ["t"], F.floor(F.col("t") / DAY))
    point = {s: F.when(F.col(s).isNotNull(), F.struct(F.col("t").alias("t"), F.col(s).alias("v"))) for s in sensors}
    runs = Runs(axis, before=1, prev=point, nxt=point)
    runs.with_columns(
        {f"__p_{s}": runs.before(s) for s in sensors}
        | {f"__n_{s}": runs.after(s) for s in sensors}
        | {"__step": F.col("t") - runs.lag("t")}
    )
    framed = materialise(runs.done())
    steps = {f"__dt_{s}": (F.when(F.col(s).isNotNull(), F.col("t") - F.col(f"__p_{s}")["t"]), [0.5]) for s in sensors}
    joined = with_quantiles(framed, steps)
    out = {}
    for s in sensors:
        p, n, t = F.col(f"__p_{s}"), F.col(f"__n_{s}"), F.col("t")
        gap = F.greatest(5.0 * F.col(f"__dt_{s}")[0], F.lit(30.0))
        near = F.least(t - p["t"], n["t"] - t) <= gap
        line = F.when(near & p.isNotNull() & n.isNotNull(), p["v"] + (n["v"] - p["v"]) * quotient(t - p["t"], n["t"] - p["t"]))
        out[s] = F.when(F.col(f"__dt_{s}_n") >= 1, F.coalesce(F.col(s), line))
    kept = joined.withColumns(out).filter(F.coalesce(F.col("__step") > closer_than, F.lit(True)))
    return kept.select("glider_id", "t", *sensors)


def ctd_at_samples(df: DataFrame, sensor: str) -> DataFrame:
    """Pressure, temperature and salinity interpolated at the times of a sensor's samples."""
    names = ["pressure", "temperature", "salinity"]
    row = F.when(F.col("pressure").isNotNull() & F.col("temperature").isNotNull(), F.struct("t_s", *names))
    runs = Runs(df, prev={"ctd": row}, nxt={"ctd": row})
    runs.with_columns({"__p": runs.upto("ctd"), "__n": runs.onward("ctd")})
    t, p, n = F.col("t_s"), F.col("__p"), F.col("__n")
    return runs.done().filter(F.col(sensor).isNotNull()).select(
        "glider_id", "t_s", sensor, *[lerp(t, p["t_s"], p[c], n["t_s"], n[c]).alias(f"{c}_at") for c in names]
    )


def merge_stamps(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """Rows and fixes of a glider on one numbered axis; at equal times the fix comes first."""
    fix = F.struct(F.col("t_s").alias("t"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    a = fixes.select("glider_id", "t_s", fix.alias("__fix"), F.lit(None).cast("bigint").alias("__row"))
    b = rows.select("glider_id", "t_s", F.lit(None).cast(a.schema["__fix"].dataType).alias("__fix"), F.col("__row"))
    return number_rows(a.unionByName(b), ["glider_id"], ["t_s", F.col("__row").asc_nulls_first()], F.floor(F.col("t_s") / DAY), out="__i")


def positions(df: DataFrame, gps: DataFrame, only_good: bool = True) -> DataFrame:
    """Position of every row: own fix (method 3), interpolated between fixes (method 2, flag 8).

    `df` needs glider_id, t_s, seq, latitude, longitude; `gps` glider_id, t_s, latitude,
    longitude, qc. If all rows of a glider lie outside its fixes, the nearest end fix is used.
    """
    own = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").select("glider_id", "t_s", "latitude", "longitude")
    good = gps.filter(F.col("qc").isin(1, 2)) if only_good else gps
    fixes = good.select("glider_id", "t_s", "latitude", "longitude").unionByName(own).dropDuplicates(["glider_id", "t_s"])
    fix = {"fix": F.col("__fix")}
    runs = Runs(merge_stamps(df.withColumn("__row", F.col("seq")), fixes), seq="__i", prev=fix, nxt=fix)
    runs.with_columns({"__p": runs.before("fix"), "__n": runs.after("fix")})
    t, p, n = F.col("t_s"), F.col("__p"), F.col("__n")
    placed = runs.done().filter(F.col("__row").isNotNull()).select(
        "glider_id",
        F.col("__row").alias("seq"),
        F.coalesce(lerp(t, p["t"], p["lat"], n["t"], n["lat"]), F.when(t == p["t"], p["lat"])).alias("__lat"),
        F.coalesce(lerp(t, p["t"], p["lon"], n["t"], n["lon"]), F.when(t == p["t"], p["lon"])).alias("__lon"),
        F.coalesce(p, n).alias("__end"),
    )
    placed = materialise(placed)
    any_inside = placed.groupBy("glider_id").agg(F.bool_or(F.col("__lat").isNotNull()).alias("__inside"))
    joined = stats_join(df.join(placed, ["glider_id", "seq"], "left"), any_inside, ["glider_id"])
    is_own = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    lat = F.when(is_own, F.col("latitude")).when(F.col("__inside"), F.col("__lat")).otherwise(F.col("__end.lat"))
    lon = F.when(is_own, F.col("longitude")).when(F.col("__inside"), F.col("__lon")).otherwise(F.col("__end.lon"))
    return joined.select(
        "glider_id", "t_s", "seq",
        lat.alias("latitude"), lon.alias("longitude"),
        F.when(is_own, 1).when(lat.isNotNull(), 8).otherwise(9).alias("position_qc"),
        F.when(is_own, 3).when(lat.isNotNull(), 2).alias("positioning_method"),
    )


# -- nearest rows ------------------------------------------------------------------------------
def attach_to_levels(df: DataFrame, sensor: str, is_level: Column) -> DataFrame:
    """CTD levels with the nearest sample of a sensor; rows that are no level are dropped.

    A sample goes to the nearest level in time (the later one on a tie); a level keeps its
    closest sample (the earlier one on a tie).
    """
    level = F.when(is_level, F.struct("t_s", "seq"))
    runs = Runs(df, prev={"level": level}, nxt={"level": level})
    runs.with_columns({"__p": runs.upto("level"), "__n": runs.onward("level")})
    back, ahead = F.col("t_s") - F.col("__p.t_s"), F.col("__n.t_s") - F.col("t_s")
    later = F.col("__p").isNull() | (ahead <= back)
    near = F.when(later & F.col("__n").isNotNull(), F.col("__n")).otherwise(F.col("__p"))
    samples = runs.done().filter(F.col(sensor).isNotNull()).withColumn("__level", near).filter("__level IS NOT NULL")
    best = samples.groupBy("glider_id", F.col("__level.seq").alias("seq")).agg(
        F.min_by(sensor, F.struct(F.abs(F.col("t_s") - F.col("__level.t_s")), F.col("t_s"))).alias(sensor)
    )
    return df.filter(is_level).drop(sensor).join(best, ["glider_id", "seq"], "left")


def profile_place(df: DataFrame) -> DataFrame:
    """Mean time of each profile and the position of the located row nearest to it."""
    mean = df.groupBy(*PROFILE).agg(F.avg("t_s").alias("profile_time"))
    located = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").join(mean, PROFILE)
    place = located.groupBy(*PROFILE).agg(
        F.min_by(F.struct("latitude", "longitude"), F.struct(F.abs(F.col("t_s") - F.col("profile_time")), F.col("t_s"))).alias("at")
    )
    return mean.join(place, PROFILE, "left").select(*PROFILE, "profile_time", "at.latitude", "at.longitude")


def surface_current_place(dives: DataFrame, fixes: DataFrame) -> DataFrame:
    """First fix from the end of a dive to the next start, else interpolated at the end.

    `dives`: glider_id, dive, start, end (dives of a glider do not overlap).
    """
    numbered = number_rows(dives, ["glider_id"], ["start"], F.floor(F.col("start") / DAY), out="__d")
    after = Runs(numbered, seq="__d", after=1)
    after.with_columns({"__next": after.lead("start")})
    ends = after.done().select("glider_id", "dive", F.col("end").alias("t_s"), "__next", F.col("__d").alias("__row"))
    fix = {"fix": F.col("__fix")}
    runs = Runs(merge_stamps(ends, fixes), seq="__i", prev=fix, nxt=fix)
    runs.with_columns({"__p": runs.before("fix"), "__n": runs.after("fix")})
    placed = runs.done().filter("__row IS NOT NULL").select("glider_id", "__row", "__p", "__n")
    joined = ends.join(placed, ["glider_id", "__row"])
    t, p, n = F.col("t_s"), F.col("__p"), F.col("__n")
    first = F.when(p["t"] == t, p).when(n["t"] < F.coalesce(F.col("__next"), n["t"] + 1), n)
    out = {
        "t": F.coalesce(first["t"], t),
        "latitude": F.coalesce(first["lat"], lerp(t, p["t"], p["lat"], n["t"], n["lat"])),
        "longitude": F.coalesce(first["lon"], lerp(t, p["t"], p["lon"], n["t"], n["lon"])),
    }
    return joined.select("glider_id", "dive", *[c.alias(k) for k, c in out.items()])


def subsurface_current_place(df: DataFrame) -> DataFrame:
    """Median time of a dive, position of the located row nearest to it, mean pressure as depth."""
    mid = exact_quantiles(df, PROFILE, {"t": (F.col("t_s"), [0.5])}).select(*PROFILE, F.col("t")[0].alias("t"))
    depth = df.groupBy(*PROFILE).agg(F.avg("pressure").alias("depth"))
    located = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").join(mid, PROFILE)
    place = located.groupBy(*PROFILE).agg(
        F.min_by(F.struct("latitude", "longitude"), F.struct(F.abs(F.col("t_s") - F.col("t")), F.col("t_s"))).alias("at")
    )
    return mid.join(depth, PROFILE).join(place, PROFILE, "left").select(*PROFILE, "t", "depth", "at.latitude", "at.longitude")


def position_on_land(df: DataFrame, elevation: DataFrame, step: float, lat0: float = -90.0, lon0: float = -180.0) -> DataFrame:
    """Flag 4 where the mean of the four surrounding elevation nodes is 0 or more, else 1.

    `elevation` holds (i_lat, i_lon, z) on nodes `lat0 + i*step`; longitude indices wrap at
    360 degrees. Distinct positions are looked up once.
    """
    around = int(round(360.0 / step))
    spots = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").select("latitude", "longitude").distinct()
    i = F.floor((F.col("latitude") - lat0) / step)
    j = F.floor((F.col("longitude") - lon0) / step)
    corners = F.array(
        *[F.struct((i + a).alias("i_lat"), F.pmod(j + b, F.lit(around)).alias("i_lon")) for a in (0, 1) for b in (0, 1)]
    )
    nodes = spots.select("latitude", "longitude", F.explode(corners).alias("c")).select("latitude", "longitude", "c.*")
    height = nodes.join(elevation, ["i_lat", "i_lon"]).groupBy("latitude", "longitude").agg(F.avg("z").alias("z"))
    judged = height.select("latitude", "longitude", F.when(F.col("z") >= 0, 4).otherwise(1).alias("land_qc"))
    return df.join(judged, ["latitude", "longitude"], "left")


def subsurface_speed(df: DataFrame, fixes: DataFrame, apart: int = 600, limit: float = 3.0) -> DataFrame:
    """Rows too fast for the nearest surface fix more than `apart` seconds away; no fix fails too.

    `df`: glider_id, t_s, seq, latitude, longitude.
    """
    fix = {"fix": F.col("__fix")}
    stamps = materialise(df.select("glider_id", "t_s", "seq"))

    def nearest(shift: int, forward: bool) -> DataFrame:
        probe = stamps.select("glider_id", (F.col("t_s") + shift).alias("t_s"), F.col("seq").alias("__row"))
        runs = Runs(materialise(merge_stamps(probe, fixes)), seq="__i", **({"nxt": fix} if forward else {"prev": fix}))
        runs.with_columns({"__f": runs.after("fix") if forward else runs.before("fix")})
        return runs.done().filter("__row IS NOT NULL").select("glider_id", F.col("__row").alias("seq"), "__f")

    # strictly more than `apart` seconds: the backward probe steps one further second back
    back = nearest(-apart - 1, False).withColumnRenamed("__f", "__back")
    ahead = nearest(apart, True).withColumnRenamed("__f", "__ahead")
    joined = df.join(back, ["glider_id", "seq"], "left").join(ahead, ["glider_id", "seq"], "left")
    b, a, t = F.col("__back"), F.col("__ahead"), F.col("t_s")
    near = F.when(a.isNull() | (t - b["t"] <= a["t"] - t), b).otherwise(a)
    speed = quotient(geodesic_metres(F.col("latitude"), F.col("longitude"), near["lat"], near["lon"]), F.abs(t - near["t"]))
    return joined.withColumn("speed", speed).withColumn("too_fast", near.isNull() | (F.col("speed") > limit)).drop("__back", "__ahead")
