"""Aggregation reports. Each returns a table; nothing is printed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import planar_metres, quotient
from ..schema import FACTORY_BOX
from ..session import materialise
from .cleaning import OPTICS, channel_likeness
from .corrections import median_despike, remove_iqr_outliers
from .ordered import DAY, Runs, exact_quantiles, number_rows, stats_join, with_quantiles

PROFILE = ["glider_id", "profile_index"]
SENSORS = ["temperature", "salinity", "oxygen_concentration", "chlorophyll", "cdom", "backscatter_700"]


def count_if(mask: Column) -> Column:
    return F.sum(F.coalesce(mask, F.lit(False)).cast("bigint"))


def long_form(df: DataFrame, variables: list[str], keep: list[str], flags: bool = False) -> DataFrame:
    """Every row of every variable, missing values included: variable, v and qc."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(v).alias("variable"), F.col(v).cast("double").alias("v"),
                (F.col(f"{v}_QC") if flags and f"{v}_QC" in df.columns else F.lit(None)).cast("int").alias("qc"),
            )
            for v in variables
            if v in df.columns
        ]
    )
    return df.select(*keep, F.explode(pairs).alias("x")).select(*keep, "x.*")


# -- flags -------------------------------------------------------------------------------------
def qc_summary(measurement: DataFrame) -> DataFrame:
    """Counts per flag of (glider, family, variable); variables without flags give NULL sums."""
    flag = lambda k: F.sum((F.col("qc_flag") == k).cast("bigint"))
    return measurement.groupBy("glider_id", "family", "variable_name").agg(
        F.count(F.lit(1)).alias("n"),
        *[flag(k).alias(f"n_{k}") for k in (1, 2, 3, 4, 9)],
        F.count("value_adjusted").alias("n_adjusted"),
        F.round(100.0 * F.sum(F.col("qc_flag").isin(1, 2).cast("bigint")) / F.count(F.lit(1)), 2).alias("pct_good"),
    )


def flag_summary(df: DataFrame, variables: list[str]) -> DataFrame:
    n = F.count(F.lit(1))
    names = {1: "good", 2: "probably_good", 3: "probably_bad", 4: "bad", 9: "missing"}
    rows = long_form(df, variables, ["glider_id"], flags=True).filter("qc IS NOT NULL")
    counts = [count_if(F.col("qc") == k).alias(f"n_{name}") for k, name in names.items()]
    shares = [(100.0 * count_if(F.col("qc") == k) / n).alias(f"pct_{name}") for k, name in names.items()]
    return rows.groupBy("glider_id", "variable").agg(n.alias("n"), *counts, *shares)


def flag_cross_table(df: DataFrame, a: str = "temperature", b: str = "salinity") -> DataFrame:
    return df.groupBy("glider_id", F.col(f"{a}_QC").cast("int").alias(f"{a}_QC"), F.col(f"{b}_QC").cast("int").alias(f"{b}_QC")).agg(
        F.count(F.lit(1)).alias("n")
    )


def flag_conflicts(df: DataFrame) -> DataFrame:
    """Rows breaking the cascade rules, per glider and rule; rules without a row are left out."""
    t, s, p = F.col("temperature_QC"), F.col("salinity_QC"), F.col("pressure_QC")
    rules = {
        "temperature bad, salinity not": ("critical", (t == 4) & ~s.isin(4, 9)),
        "temperature missing, salinity not": ("warning", (t == 9) & (s != 9)),
        **{
            f"pressure bad or missing, {v} not": ("critical", p.isin(4, 9) & ~F.col(f"{v}_QC").isin(4, 9))
            for v in ("temperature", "salinity", "oxygen_concentration", "chlorophyll")
            if f"{v}_QC" in df.columns
        },
    }
    wide = df.groupBy("glider_id").agg(*[count_if(m).alias(f"__{i}") for i, (_, m) in enumerate(rules.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.lit(sev).alias("severity"), F.col(f"__{i}").alias("n"))
            for i, (name, (sev, _)) in enumerate(rules.items())
        ]
    )
    return wide.select("glider_id", F.explode(rows).alias("x")).select("glider_id", "x.*").filter("n > 0")


def flag_integrity(l0: DataFrame, l1: DataFrame, variables: list[str]) -> DataFrame:
    """Missing flags of L1 against the missing values of L0, scaled to the rows L1 kept."""
    a = long_form(l0, variables, ["glider_id"]).groupBy("glider_id", "variable").agg(
        count_if(F.col("v").isNull()).alias("l0_missing"), F.count(F.lit(1)).alias("l0_total")
    )
    b = long_form(l1, variables, ["glider_id"], flags=True).filter("qc IS NOT NULL").groupBy("glider_id", "variable").agg(
        count_if(F.col("qc") == 9).alias("l1_missing"), count_if(F.col("qc").isin(3, 4)).alias("l1_bad"),
        count_if(F.col("qc").isin(1, 2)).alias("l1_good"), F.count(F.lit(1)).alias("l1_total"),
    )
    expected = F.bround(F.col("l0_missing") * quotient(F.col("l1_total"), F.col("l0_total"))).cast("bigint")
    tolerance = F.greatest(F.lit(200), F.floor(0.02 * F.col("l1_total")))
    extra = F.col("extra_missing")
    return (
        a.join(b, ["glider_id", "variable"])
        .withColumn("extra_missing", F.col("l1_missing") - expected)
        .withColumn("verdict", F.when(extra > tolerance, "missing without cause").when(extra < -tolerance, "reclaimed").otherwise("ok"))
    )


# -- coverage and cadence -------------------------------------------------------------------------
def daily_coverage(df: DataFrame, variables: list[str]) -> DataFrame:
    """Per day and variable: share flagged 1 or 2, or present where there are no flags."""
    day = F.floor(F.col("t_s") / DAY).alias("day")
    good = F.when(F.col("qc").isNull(), F.col("v").isNotNull()).otherwise(F.col("qc").isin(1, 2))
    return long_form(df.withColumn("day", day), variables, ["glider_id", "day"], flags=True).groupBy(
        "glider_id", "day", "variable"
    ).agg(F.avg(good.cast("double")).alias("share"))


def coverage(df: DataFrame, variables: list[str]) -> DataFrame:
    return long_form(df, variables, ["glider_id"]).groupBy("glider_id", "variable").agg(
        F.count("v").alias("present"), F.count(F.lit(1)).alias("total"),
        (100.0 * F.count("v") / F.count(F.lit(1))).alias("pct_present"),
    )


def cadence(df: DataFrame, variables: list[str]) -> DataFrame:
    """Median positive gap between valid rows per variable and its ratio to that of all rows."""
    names = ["", *variables]
    valid = {v: F.when(F.lit(True) if not v else F.col(v).isNotNull(), F.col("t_s")) for v in names}
    runs = Runs(df.select("glider_id", "t_s", "seq", *variables), prev={v or "all": e for v, e in valid.items()})
    gap = {v: valid[v] - runs.before(v or "all") for v in names}
    runs.with_columns({f"__g{i}": gap[v] for i, v in enumerate(names)})
    gaps = runs.done()
    q = exact_quantiles(
        gaps, ["glider_id"], {f"q{i}": (F.when(F.col(f"__g{i}") > 0, F.col(f"__g{i}")), [0.5]) for i in range(len(names))}
    )
    base = F.coalesce(F.col("q0")[0], F.lit(1.0))
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"q{i}")[0].alias("median_gap")) for i, v in enumerate(names) if v])
    out = q.select("glider_id", base.alias("__base"), F.explode(rows).alias("x")).select("glider_id", "__base", "x.*")
    ratio = F.col("median_gap") / F.greatest(F.col("__base"), F.lit(1.0))
    return out.filter("median_gap IS NOT NULL").select(
        "glider_id", "variable", "median_gap", ratio.alias("ratio"), (ratio > 3).alias("sub_sampled")
    )


# -- deployment level ------------------------------------------------------------------------------
def track_summary(df: DataFrame) -> DataFrame:
    """Rows, span, profiles, deepest sample and the length of the track through profile means."""
    base = df.groupBy("glider_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("t_s").alias("t_first"), F.max("t_s").alias("t_last"),
        ((F.max("t_s") - F.min("t_s")) / float(DAY)).alias("days"), F.max("depth").alias("max_depth"),
    )
    profiles = df.filter(F.col("profile_index").isNotNull()).groupBy(*PROFILE).agg(
        F.avg(F.when(F.col("longitude").isNotNull(), F.col("latitude"))).alias("lat"),
        F.avg(F.when(F.col("latitude").isNotNull(), F.col("longitude"))).alias("lon"),
    )
    n = profiles.groupBy("glider_id").agg(F.count(F.lit(1)).alias("n_profiles"), F.avg("lat").alias("mean_lat"))
    placed = number_rows(profiles.filter("lat IS NOT NULL"), ["glider_id"], ["profile_index"], F.floor(F.col("profile_index") / 10_000))
    runs = Runs(stats_join(placed, n, ["glider_id"]), before=1)
    dy = (F.col("lat") - runs.lag("lat")) * 111.32
    dx = (F.col("lon") - runs.lag("lon")) * 111.32 * F.cos(F.radians("mean_lat"))
    runs.with_columns({"leg": F.sqrt(dy * dy + dx * dx)})
    length = runs.done().groupBy("glider_id").agg(F.coalesce(F.sum("leg"), F.lit(0.0)).alias("track_km"))
    return base.join(n.drop("mean_lat"), "glider_id", "left").join(length, "glider_id", "left")


def meta_row(deployment: DataFrame, l0: DataFrame, l1: DataFrame) -> DataFrame:
    """One row per deployment: declared bounds first, then those of L1, then of L0."""

    def facts(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy("glider_id").agg(
            F.min("t_s").alias(f"start_{tag}"), F.max("t_s").alias(f"end_{tag}"), F.max("pressure").alias(f"pressure_{tag}"),
            F.countDistinct("profile_index").alias(f"n_profiles_{tag}"), F.count(F.lit(1)).alias(f"n_{tag}"),
        )

    joined = facts(l0, "l0").join(facts(l1, "l1"), "glider_id", "full").join(deployment.select("glider_id", "start", "end"), "glider_id", "left")
    return joined.select(
        "glider_id",
        F.coalesce("start", "start_l1", "start_l0").alias("deployment_start"),
        F.coalesce("end", "end_l1", "end_l0").alias("deployment_end"),
        F.coalesce("pressure_l1", "pressure_l0").alias("max_depth_dbar"),
        "n_profiles_l0", "n_profiles_l1", F.coalesce("n_l0", F.lit(0)).alias("n_observations"),
    )


def deployment_parameters(fixes: DataFrame, declared_depth: DataFrame | None = None) -> DataFrame:
    """Bounds, hemisphere switch and factory box of each deployment from its fixes.

    Fewer than 5 fixes give global bounds and no filtering: `n_fixes` 0, medians NULL.
    """
    few = F.coalesce(F.col("la_n") < 5, F.lit(True))
    q = exact_quantiles(
        fixes, ["glider_id"], {"la": (F.col("latitude"), [0.05, 0.5, 0.95]), "lo": (F.col("longitude"), [0.05, 0.5, 0.95])}
    )
    bounds, limits = [], {"la": 90.0, "lo": 180.0}
    for c in ("la", "lo"):
        a, b = F.col(c)[0], F.col(c)[2]
        pad = F.greatest(F.lit(2.0), (b - a) * 0.15)
        low, high = F.lit(-limits[c]), F.lit(limits[c])
        bounds += [
            F.when(few, low).otherwise(F.greatest(F.round(a - pad, 2), low)).alias(f"{c}_min"),
            F.when(few, high).otherwise(F.least(F.round(b + pad, 2), high)).alias(f"{c}_max"),
        ]
    base = q.select(
        "glider_id", F.when(few, 0).otherwise(F.col("la_n")).alias("n_fixes"), *bounds,
        F.when(~few, F.col("la")[1]).alias("median_lat"), F.when(~few, F.col("lo")[1]).alias("median_lon"),
        (~few & (F.abs(F.col("la")[1]) > 5.0)).alias("clean_hemisphere"),
    )
    south, north, west, east = FACTORY_BOX
    la, lo = F.col("latitude"), F.col("longitude")
    far = F.sqrt(F.pow(la - F.col("median_lat"), 2) + F.pow(lo - F.col("median_lon"), 2)) > 10
    spread = stats_join(fixes, base.select("glider_id", "median_lat", "median_lon"), ["glider_id"], "inner").groupBy("glider_id").agg(
        F.avg((la.between(south, north) & lo.between(west, east)).cast("double")).alias("__in"),
        F.sum(far.cast("int")).alias("__far"),
        *[f(F.when(far, c)).alias(n) for c, k in ((la, "la"), (lo, "lo")) for f, n in ((F.min, f"__{k}0"), (F.max, f"__{k}1"))],
    )
    kind = F.when(F.col("n_fixes") == 0, "none").when(F.col("__in") > 0.05, "default").when(F.col("__far") > 3, "cluster").otherwise("none")
    edge = lambda default, cluster: F.when(F.col("factory_box") == "default", default).when(F.col("factory_box") == "cluster", cluster)
    out = base.join(spread, "glider_id").withColumn("factory_box", kind).withColumns(
        {
            "factory_south": edge(F.lit(south), F.col("__la0") - 1), "factory_north": edge(F.lit(north), F.col("__la1") + 1),
            "factory_west": edge(F.lit(west), F.col("__lo0") - 1), "factory_east": edge(F.lit(east), F.col("__lo1") + 1),
        }
    ).drop("__in", "__far", "__la0", "__la1", "__lo0", "__lo1")
    if declared_depth is None:
        return out.withColumn("max_depth_dbar", F.lit(1000.0))
    given = declared_depth.select("glider_id", F.when(F.col("max_depth_dbar") > 10, F.col("max_depth_dbar")).alias("__d"))
    return out.join(given, "glider_id", "left").withColumn("max_depth_dbar", F.coalesce("__d", F.lit(1000.0))).drop("__d")


# -- comparisons ------------------------------------------------------------------------------------
def compare_series(l0: DataFrame, l1: DataFrame, variables: list[str]) -> DataFrame:
    """Counts and ranges on each side, and differences on rows with the same stamp."""
    side = lambda df, tag: long_form(df, variables, ["glider_id"]).groupBy("glider_id", "variable").agg(
        F.count("v").alias(f"n_{tag}"), F.min("v").alias(f"min_{tag}"), F.max("v").alias(f"max_{tag}")
    )
    a = long_form(l0, variables, ["glider_id", "t_s"]).drop("qc").withColumnRenamed("v", "v0")
    b = long_form(l1, variables, ["glider_id", "t_s"]).drop("qc").withColumnRenamed("v", "v1")
    size = F.abs(F.col("v1") - F.col("v0"))
    diff = a.join(b, ["glider_id", "t_s", "variable"]).groupBy("glider_id", "variable").agg(
        F.count(size).alias("n_pairs"), F.max(size).alias("max_diff"), F.avg(size).alias("mean_diff")
    )
    return side(l0, "l0").join(side(l1, "l1"), ["glider_id", "variable"], "full").join(diff, ["glider_id", "variable"], "left").withColumn(
        "change", F.col("n_l1") - F.col("n_l0")
    )


def compare_methods(l0: DataFrame, l1: DataFrame, variables: list[str]) -> DataFrame:
    """A simple screen (3 IQR, then running median of 5) on L0 against the values L1 calls good."""
    simple = median_despike(remove_iqr_outliers(l0, variables, 3.0), {v: 5 for v in variables})
    a = simple.select("glider_id", "t_s", *[F.col(f"{v}_median").alias(v) for v in variables])
    b = l1.select("glider_id", "t_s", *[F.when(F.col(f"{v}_QC") == 1, F.col(v)).alias(v) for v in variables])
    own = lambda df, tag: long_form(df, variables, ["glider_id"]).groupBy("glider_id", "variable").agg(
        F.count("v").alias(f"n_{tag}"), (100.0 * F.count("v") / F.count(F.lit(1))).alias(f"pct_{tag}"),
        F.min("v").alias(f"min_{tag}"), F.max("v").alias(f"max_{tag}"),
    )
    la = long_form(a, variables, ["glider_id", "t_s"]).drop("qc").withColumnRenamed("v", "va").filter("va IS NOT NULL")
    lb = long_form(b, variables, ["glider_id", "t_s"]).drop("qc").withColumnRenamed("v", "vb").filter("vb IS NOT NULL")
    d = F.col("va") - F.col("vb")
    enough = F.count(F.lit(1)) >= 100
    pairs = la.join(lb, ["glider_id", "t_s", "variable"]).groupBy("glider_id", "variable").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.when(enough, F.avg(d)).alias("mean_diff"), F.when(enough, F.stddev_pop(d)).alias("std_diff"),
        F.when(enough, 100.0 * F.avg((F.abs(d) < 0.01).cast("double"))).alias("pct_within_0_01"),
        F.when(enough, 100.0 * F.avg((F.abs(d) < 1.0).cast("double"))).alias("pct_within_1"),
    )
    return own(a, "simple").join(own(b, "good"), ["glider_id", "variable"], "full").join(pairs, ["glider_id", "variable"], "left")


# -- failures ----------------------------------------------------------------------------------------
def sensor_failures(df: DataFrame, variables: list[str], mission: DataFrame | None = None) -> DataFrame:
    """Variables that fall silent well before the mission ends: last value, days lost, early coverage."""
    total = df.groupBy("glider_id").agg(F.count(F.lit(1)).alias("__n"), F.min("t_s").alias("t0"), F.max("t_s").alias("t1"))
    if mission is not None:
        total = stats_join(total.drop("t0", "t1"), mission.select("glider_id", "t0", "t1"), ["glider_id"], "inner")
    rows = stats_join(long_form(df, variables, ["glider_id", "t_s"]).drop("qc"), total, ["glider_id"], "inner")
    inside = F.col("t_s").between(F.col("t0"), F.col("t1"))
    early = inside & (F.col("t_s") <= F.col("t0") + F.floor((F.col("t1") - F.col("t0")) / 3))
    there = F.col("v").isNotNull()
    stats = rows.groupBy("glider_id", "variable", "__n", "t0", "t1").agg(
        count_if(there).alias("valid"), count_if(there & inside).alias("valid_inside"),
        F.max(F.when(there & inside, F.col("t_s"))).alias("last_valid"),
        (count_if(there & early) / F.greatest(count_if(early), F.lit(1))).alias("early_coverage"),
    )
    days = (F.col("t1") - F.col("last_valid")) / float(DAY)
    span = (F.col("t1") - F.col("t0")) / float(DAY)
    return (
        stats.withColumn("days_from_end", days)
        .filter((F.col("valid") >= F.greatest(F.col("__n") * 0.005, F.lit(5.0))) & (F.col("valid_inside") >= 5))
        .filter((F.col("days_from_end") > F.greatest(span * 0.15, F.lit(5.0))) & (F.col("early_coverage") > 0.05))
        .select("glider_id", "variable", "last_valid", "days_from_end", "early_coverage")
    )


def shared_stops(failures: DataFrame, order: list[str], within: int = 60) -> DataFrame:
    """Failures whose last values lie within a minute of the first member of a group.

    At most one entry per variable and glider takes part, so the array stays as short as `order`.
    """
    rank = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("variable"))
    entry = F.struct(rank.alias("k"), F.col("variable").alias("variable"), F.col("last_valid").alias("t"))
    arrays = failures.groupBy("glider_id").agg(F.sort_array(F.collect_list(entry)).alias("items"))
    group_type = "array<struct<t:bigint,members:array<string>>>"
    folded = F.aggregate(
        "items",
        F.array().cast(group_type),
        lambda acc, x: F.when(
            F.exists(acc, lambda g: F.abs(g["t"] - x["t"]) <= within),
            # the first group that fits takes the variable
            F.transform(
                acc,
                lambda g, i: F.when(
                    i == F.array_position(F.transform(acc, lambda h: F.abs(h["t"] - x["t"]) <= within), True) - 1,
                    F.struct(g["t"].alias("t"), F.concat(g["members"], F.array(x["variable"])).alias("members")),
                ).otherwise(g),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(x["t"].alias("t"), F.array(x["variable"]).alias("members"))))),
    )
    groups = arrays.select("glider_id", F.explode(folded).alias("g")).filter(F.size("g.members") > 1)
    core = F.arrays_overlap("g.members", F.array(*[F.lit(v) for v in ("temperature", "salinity", "pressure")]))
    return groups.select(
        "glider_id", F.col("g.t").alias("stopped_at"), F.array_join("g.members", ",").alias("variables"),
        F.when(core, "mission gap").otherwise("several sensors").alias("kind"),
    )


def oxygen_failure(df: DataFrame) -> DataFrame:
    """Deployments with more than 100 bad oxygen rows over 5 days making up 5 %."""
    bad = F.col("oxygen_concentration_QC") == 4
    t = F.when(bad, F.col("t_s"))
    out = df.groupBy("glider_id").agg(
        count_if(bad).alias("n_bad"), ((F.max(t) - F.min(t)) / float(DAY)).alias("span_days"),
        F.countDistinct(F.floor(t / DAY)).alias("bad_days"), (count_if(bad) / F.count(F.lit(1))).alias("share"),
    )
    return out.filter("n_bad > 100 AND span_days > 5 AND share > 0.05")


# -- diagnostics --------------------------------------------------------------------------------------
def gps_diagnostics(df: DataFrame) -> DataFrame:
    la, lo = F.col("latitude"), F.col("longitude")
    fix = F.when(la.isNotNull() & lo.isNotNull(), F.struct("profile_index", "latitude", "longitude"))
    base = df.groupBy("glider_id").agg(
        F.count(F.lit(1)).alias("n"), count_if(la.isNull()).alias("lat_missing"), count_if(lo.isNull()).alias("lon_missing"),
        count_if(F.abs(la) > 90).alias("lat_impossible"), count_if(F.abs(lo) > 180).alias("lon_impossible"),
        F.countDistinct(F.when(lo.isNotNull(), F.round(la, 6))).alias("lat_distinct"),
        F.countDistinct(F.when(la.isNotNull(), F.round(lo, 6))).alias("lon_distinct"),
        F.avg(F.when(lo.isNotNull(), la)).alias("__mean"),
    )
    valid = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL").select("glider_id", "latitude", "longitude")
    mid = with_quantiles(valid, {"m": (la, [0.5]), "k": (lo, [0.5])})
    deg = F.sqrt(F.pow(la - F.col("m")[0], 2) + F.pow((lo - F.col("k")[0]) * F.cos(F.radians(F.col("m")[0])), 2))
    far = mid.withColumn("deg", deg)
    spread = exact_quantiles(far, ["glider_id"], {"d": (F.col("deg"), [0.5, 0.99, 1.0])})
    count = far.groupBy("glider_id").agg(count_if(F.col("deg") > 10).alias("n_far"))
    runs = Runs(stats_join(df, base.select("glider_id", "__mean"), ["glider_id"]), prev={"fix": fix})
    runs.with_columns({"__p": runs.before("fix")})
    p = F.col("__p")
    km = planar_metres(p["latitude"], p["longitude"], la, lo, F.col("__mean")) / 1000.0
    jumps = runs.done().groupBy("glider_id").agg(
        count_if((p["profile_index"] == F.col("profile_index")) & (km > 50)).alias("n_jumps")
    )
    d = F.col("d")
    return (
        base.drop("__mean").join(spread, "glider_id", "left").join(count, "glider_id", "left").join(jumps, "glider_id", "left")
        .withColumns({"p50_km": d[0] * 111.32, "p99_km": d[1] * 111.32, "max_km": d[2] * 111.32})
        .drop("d", "d_n")
    )


def ts_diagnostics(df: DataFrame) -> DataFrame:
    t, s = F.col("temperature"), F.col("salinity")
    both = t.isNotNull() & s.isNotNull()
    pair = F.when(both, F.struct("profile_index", "temperature", "salinity"))
    base = df.groupBy("glider_id").agg(
        F.count(F.lit(1)).alias("n"), count_if(both).alias("n_pairs"),
        F.min(t).alias("t_min"), F.max(t).alias("t_max"), F.min(s).alias("s_min"), F.max(s).alias("s_max"),
        count_if(t < -2.5).alias("t_low"), count_if(t > 40).alias("t_high"), count_if(s < 2).alias("s_low"), count_if(s > 41).alias("s_high"),
        (1 - quotient(F.countDistinct(F.when(both, F.round(t, 6))), count_if(both))).alias("t_stuck"),
        (1 - quotient(F.countDistinct(F.when(both, F.round(s, 5))), count_if(both))).alias("s_stuck"),
    )
    runs = Runs(df, prev={"pair": pair})
    runs.with_columns({"__p": F.when(both, runs.before("pair"))})
    p = F.col("__p")
    same = p["profile_index"] == F.col("profile_index")
    jumps = runs.done().groupBy("glider_id").agg(
        count_if(same & (F.abs(t - p["temperature"]) > 10)).alias("t_jumps"), count_if(same & (F.abs(s - p["salinity"]) > 5)).alias("s_jumps")
    )
    warm = with_quantiles(df.filter(both).select("glider_id", "temperature", "salinity"), {"w": (t, [0.9])}).filter(t >= F.col("w")[0])
    warm = warm.groupBy("glider_id").agg(
        F.first(F.col("w")[0]).alias("warm_cut"), F.min(s).alias("warm_s_min"), F.max(s).alias("warm_s_max"), F.avg(s).alias("warm_s_mean")
    )
    return base.join(jumps, "glider_id", "left").join(warm, "glider_id", "left")


def profile_inventory(df: DataFrame) -> DataFrame:
    """Direction, mean date, levels, ends of each profile; anomaly: same direction within an hour."""
    prof = df.filter(F.col("profile_index").isNotNull()).groupBy(*PROFILE).agg(
        F.when(F.avg("profile_direction") > 0, "D").otherwise("A").alias("direction"),
        F.avg("t_s").alias("mean_time"), F.count(F.lit(1)).alias("levels"),
        F.min_by("pressure", "t_s").alias("first_pressure"), F.max_by("pressure", "t_s").alias("last_pressure"),
        F.min("t_s").alias("t_first"), F.max("t_s").alias("t_last"),
    )
    runs = Runs(number_rows(prof, ["glider_id"], ["t_first"], F.floor(F.col("t_first") / DAY)), before=1)
    same = (runs.lag("direction") == F.col("direction")) & (F.col("t_first") - runs.lag("t_last") <= 3600)
    runs.with_columns({"anomaly": F.coalesce(same, F.lit(False))})
    return runs.done("seq")


def profile_quality(df: DataFrame, variables: list[str]) -> DataFrame:
    """Letter A-F per profile and parameter from the share of good flags."""
    rows = long_form(df.filter(F.col("profile_index").isNotNull()), variables, PROFILE, flags=True).filter("qc IS NOT NULL AND qc <> 9")
    stats = rows.groupBy(*PROFILE, "variable").agg(
        count_if(F.col("qc") != 0).alias("judged"), (100.0 * F.avg(F.col("qc").isin(1, 2, 5, 8).cast("double"))).alias("share")
    )
    s = F.col("share")
    letter = (
        F.when(F.col("judged") == 0, " ").when(s == 0, "F").when(s < 25, "E").when(s < 50, "D").when(s < 75, "C").when(s < 100, "B").otherwise("A")
    )
    return stats.select(*PROFILE, "variable", letter.alias("quality"))


def sensor_issues(l0: DataFrame, l1: DataFrame, variables: list[str]) -> DataFrame:
    """What stopped early in each deployment: (glider_id, kind, variables, last_valid, days_from_end, share).

    The mission is the span of `l1`. Sensors that stop within a minute are one event (`mission gap`
    or `several sensors`); the others are a `sensor failure` each, with their early coverage as
    `share`. Oxygen that stays is `oxygen flagged bad` where `oxygen_failure` says so, with the
    share of bad rows. At most a row per variable and glider, and one more.
    """
    mission = l1.groupBy("glider_id").agg(F.min("t_s").alias("t0"), F.max("t_s").alias("t1"))
    # a row per variable and glider, read three times
    failures = materialise(sensor_failures(l0, variables, mission))
    stops = shared_stops(failures, variables)
    grouped = stops.select("glider_id", F.explode(F.split("variables", ",")).alias("variable"))
    none = F.lit(None).cast("double")
    out = stops.select("glider_id", "kind", "variables", F.col("stopped_at").alias("last_valid"), none.alias("days_from_end"), none.alias("share"))
    alone = failures.join(grouped, ["glider_id", "variable"], "left_anti").select(
        "glider_id", F.lit("sensor failure").alias("kind"), F.col("variable").alias("variables"),
        "last_valid", "days_from_end", F.col("early_coverage").alias("share"),
    )
    out = out.unionByName(alone)
    if "oxygen_concentration_QC" not in l1.columns:
        return out
    silent = failures.filter("variable = 'oxygen_concentration'").select("glider_id")
    bad = oxygen_failure(l1).join(silent, "glider_id", "left_anti").select(
        "glider_id", F.lit("oxygen flagged bad").alias("kind"), F.lit("oxygen_concentration").alias("variables"),
        F.lit(None).cast("bigint").alias("last_valid"), none.alias("days_from_end"), "share",
    )
    return out.unionByName(bad)


def deployment_summary(l0: DataFrame, l1: DataFrame) -> DataFrame:
    """One row per deployment: track facts, figures of its gaps, and nested coverage, flags and sensor issues.

    The lists are bounded by the variables. Gaps are not: their rows are `time_gaps`, here are
    their number, their hours and the longest.
    """
    from .segments import time_gaps

    nest = lambda df, name: df.groupBy("glider_id").agg(
        F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c != "glider_id"]))).alias(name)
    )
    variables = [v for v in SENSORS if v in l0.columns]
    gaps = time_gaps(l0).groupBy("glider_id").agg(
        F.count(F.lit(1)).alias("n_gaps"), F.sum("gap_hours").alias("gap_hours"), F.max("gap_hours").alias("longest_gap_hours")
    )
    return (
        track_summary(l0)
        .join(nest(coverage(l0, variables), "coverage"), "glider_id", "left")
        .join(nest(flag_summary(l1, variables), "flags"), "glider_id", "left")
        .join(gaps, "glider_id", "left")
        .join(nest(sensor_issues(l0, l1, variables), "issues"), "glider_id", "left")
        .fillna(0, ["n_gaps", "gap_hours", "longest_gap_hours"])
    )


# -- verification ---------------------------------------------------------------------------------------
def early_stops(df: DataFrame, variables: list[str]) -> DataFrame:
    """Variables silent over the last 10 % of a record and over 3 days: (glider_id, check, severity, n), n in whole days.

    Four or more that stop within a minute of the first of them are one note. Otherwise each is a
    warning, if temperature or salinity is among them; other sensors alone may rest.
    """
    t = F.col("t_s")
    names = [v for v in variables if v in df.columns]
    seen = df.groupBy("glider_id").agg(
        F.min(t).alias("t0"), F.max(t).alias("t1"),
        *[F.count(v).alias(f"n_{v}") for v in names], *[F.max(F.when(F.col(v).isNotNull(), t)).alias(f"last_{v}") for v in names],
    )
    entries = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"n_{v}").alias("n"), F.col(f"last_{v}").alias("last")) for v in names])
    least = F.greatest((F.col("t1") - F.col("t0")) * 0.10, F.lit(3.0 * DAY))
    stopped = F.filter(entries, lambda x: (x["n"] >= 10) & (F.col("t1") - x["last"] > least))
    out = seen.select("glider_id", "t1", stopped.alias("s")).filter(F.size("s") > 0)
    days = lambda last: F.floor((F.col("t1") - last) / DAY).cast("bigint").alias("n")
    first = F.col("s")[0]["last"]
    together = (F.size("s") >= 4) & F.forall("s", lambda x: F.abs(x["last"] - first) <= 60)
    core = F.exists("s", lambda x: x["variable"].isin("temperature", "salinity"))
    note = F.array(F.struct(F.lit("all sensors stopped").alias("check"), F.lit("note").alias("severity"), days(first)))
    each = F.transform("s", lambda x: F.struct(F.concat(x["variable"], F.lit(" stopped early")).alias("check"), F.lit("warning").alias("severity"), days(x["last"])))
    return out.select("glider_id", F.explode(F.when(together, note).when(core, each)).alias("x")).select("glider_id", "x.*")


def level_issues(l0: DataFrame, l1: DataFrame) -> DataFrame:
    """Levels that do not fit: other numbers of rows (n: the difference), or no common stamp (n: rows of L1).

    Deployments with both levels only; one without L1 is a matter of the fleet's listing.
    """
    keys = ["glider_id", "t_s"]
    rows = lambda df, name: df.groupBy("glider_id").agg(F.count(F.lit(1)).alias(name))
    common = l1.select(*keys).join(l0.select(*keys), keys, "left_semi").groupBy("glider_id").agg(F.count(F.lit(1)).alias("common"))
    sizes = rows(l0, "n0").join(rows(l1, "n1"), "glider_id").join(common, "glider_id", "left")
    differ, apart = F.abs(F.col("n1") - F.col("n0")), F.when(F.col("common").isNull(), F.col("n1"))
    return issue_rows(sizes, {"row counts of levels differ": ("warning", differ), "no common stamps of levels": ("critical", apart)})


def issue_rows(table: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """(glider_id, check, severity, n) of a table with a row per glider, where n > 0."""
    items = F.array(*[F.struct(F.lit(k).alias("check"), F.lit(sev).alias("severity"), n.cast("bigint").alias("n")) for k, (sev, n) in checks.items()])
    return table.select("glider_id", F.explode(items).alias("x")).select("glider_id", "x.*").filter("n > 0")


def verification_issues(df: DataFrame, l0: DataFrame | None = None) -> DataFrame:
    """Union of the violations found by the diagnostics: (glider_id, check, severity, n).

    Optical channels that hold pressure (n: pairs), sensors that stopped, positions, temperature
    and salinity, flags; with `l0` also the comparison of both levels.
    """
    gps, ts = gps_diagnostics(df), ts_diagnostics(df)
    half = F.when(F.col("lat_missing") > F.col("n") * 0.5, F.col("lat_missing"))
    out = issue_rows(gps, {
        "latitude mostly missing": ("critical", half), "latitude impossible": ("warning", F.col("lat_impossible")),
        "longitude impossible": ("warning", F.col("lon_impossible")), "far from track": ("warning", F.col("n_far")),
        "position jumps": ("warning", F.col("n_jumps")),
    }).unionByName(issue_rows(ts, {
        "temperature low": ("warning", F.col("t_low")), "temperature high": ("warning", F.col("t_high")),
        "salinity low": ("warning", F.col("s_low")), "salinity high": ("warning", F.col("s_high")),
        "temperature jumps": ("warning", F.col("t_jumps")), "salinity jumps": ("warning", F.col("s_jumps")),
    }))
    conflicts = flag_conflicts(df).select("glider_id", F.col("rule").alias("check"), "severity", "n")
    out = out.unionByName(conflicts).unionByName(early_stops(df, ["temperature", "salinity", "pressure", *SENSORS[2:]]))
    if any(v in df.columns for v in OPTICS):
        same = channel_likeness(df).filter("n >= 100 AND share_identical > 0.5")
        out = out.unionByName(
            same.select("glider_id", F.concat("variable", F.lit(" identical to pressure")).alias("check"), F.lit("critical").alias("severity"), "n")
        )
    return out if l0 is None else out.unionByName(level_issues(l0, df))


def fleet_listing(meta: DataFrame, summary: DataFrame) -> DataFrame:
    """Deployments in name order with their status and summary."""
    status = F.when(F.col("n_rows").isNull(), "not processed").otherwise("processed")
    return meta.join(summary.select("glider_id", "n_rows", "n_profiles", "track_km"), "glider_id", "left").withColumn("status", status).orderBy("glider_id")
