"""Corrections of optics, oxygen and the physical channels."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import is_day, quotient, solar_hour
from ..schema import PHYSICAL_GUARD
from ..session import materialise
from .ordered import Runs, exact_quantiles, number_rows, stats_join, with_quantiles

PROFILE = ["glider_id", "profile_index"]
OXYGEN_TAU = 30.0
MAD_SCALE = 1.4826


# -- outliers ------------------------------------------------------------------------------
def remove_iqr_outliers(df: DataFrame, variables: list[str], multiplier: float = 1.5) -> DataFrame:
    """Values outside quartile +- m IQR of the deployment become missing (from 10 values on)."""
    joined = with_quantiles(df, {f"__q_{v}": (F.col(v), [0.25, 0.75]) for v in variables})
    cleaned = {}
    for v in variables:
        low, high = F.col(f"__q_{v}")[0], F.col(f"__q_{v}")[1]
        reach = multiplier * (high - low)
        keep = (F.col(f"__q_{v}_n") < 10) | F.col(v).between(low - reach, high + reach)
        cleaned[v] = F.when(keep, F.col(v))
    return joined.withColumns(cleaned).drop(*[c for v in variables for c in (f"__q_{v}", f"__q_{v}_n")])


# -- running median --------------------------------------------------------------------------
def mirrored(off: Callable[[int], Column], k: int, head: Column, tail: Column) -> Column:
    """Neighbour at offset `k`, reflected where it would leave the sequence.

    `head` and `tail` are the distances of the row from the first and the last row.
    """
    out = off(k)
    for d in range(abs(k)):
        inward = -1 - 2 * d - k if k < 0 else 1 + 2 * d - k
        out = F.when((head if k < 0 else tail) == d, off(inward)).otherwise(out)
    return out


def median_despike(df: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Add `<v>_median` (where the input is present) and `<v>_spike` for each variable.

    Interior gaps are filled along the row number first; missing rows before the first and
    after the last value take no part. Fewer values than the window: values unchanged, spikes 0.
    """
    seqs = F.col("seq")
    ends = df.groupBy("glider_id").agg(
        *[
            agg
            for v in windows
            for agg in (
                F.count(v).alias(f"__n_{v}"),
                F.min(F.when(F.col(v).isNotNull(), seqs)).alias(f"__a_{v}"),
                F.max(F.when(F.col(v).isNotNull(), seqs)).alias(f"__b_{v}"),
            )
        ]
    )
    half = max(windows.values()) // 2
    point = {v: F.when(F.col(v).isNotNull(), F.struct(seqs.alias("s"), F.col(v).alias("v"))) for v in windows}
    runs = Runs(stats_join(df, ends, ["glider_id"]), before=half, after=half, prev=point, nxt=point)
    runs.with_columns({f"__lo_{v}": runs.before(v) for v in windows} | {f"__hi_{v}": runs.after(v) for v in windows})
    filled = {}
    for v in windows:
        lo, hi = F.col(f"__lo_{v}"), F.col(f"__hi_{v}")
        share = quotient(seqs - lo["s"], hi["s"] - lo["s"])
        filled[f"__f_{v}"] = F.coalesce(F.col(v), lo["v"] + (hi["v"] - lo["v"]) * share)
    runs.with_columns(filled)
    offsets = {}
    for v, w in windows.items():
        for k in range(-(w // 2), w // 2 + 1):
            name = f"__o_{v}_{k + w // 2}"
            offsets[name] = runs.lag(f"__f_{v}", -k) if k < 0 else runs.lead(f"__f_{v}", k) if k else F.col(f"__f_{v}")
    runs.with_columns(offsets)
    out = {}
    for v, w in windows.items():
        h = w // 2
        head, tail = seqs - F.col(f"__a_{v}"), F.col(f"__b_{v}") - seqs
        around = [mirrored(lambda k, v=v, h=h: F.col(f"__o_{v}_{k + h}"), k, head, tail) for k in range(-h, h + 1)]
        median = F.sort_array(F.array(*around))[h]
        enough, present = F.col(f"__n_{v}") >= w, F.col(v).isNotNull()
        out[f"{v}_median"] = F.when(present, F.when(enough, median).otherwise(F.col(v)))
        out[f"{v}_spike"] = F.when(~enough, F.lit(0.0)).when(present, F.col(v) - median)
    runs.with_columns(out)
    return runs.done(
        *filled, *offsets, *[f"__{k}_{v}" for v in windows for k in ("lo", "hi", "n", "a", "b")]
    )


def screen_spikes(df: DataFrame, variables: list[str], window: int = 5) -> DataFrame:
    """Range guard and median spike screen; `<v>_guarded` keeps the range-guarded values."""
    guards = {
        f"{v}_guarded": F.when(F.col(v).between(*PHYSICAL_GUARD[v]), F.col(v)) for v in variables
    }
    names = list(guards)
    work = materialise(median_despike(df.withColumns(guards), {g: window for g in names}))
    size = {g: F.abs(F.col(f"{g}_spike")) for g in names}
    joined = with_quantiles(work, {f"__m_{g}": (F.when(size[g] > 0, size[g]), [0.5]) for g in names})
    screened = {}
    for v, g in zip(variables, names, strict=True):
        spike = (F.col(f"__m_{g}_n") > 10) & (size[g] > 3.0 * MAD_SCALE * F.col(f"__m_{g}")[0])
        screened[v] = F.when(~F.coalesce(spike, F.lit(False)), F.col(g))
    helpers = [c for g in names for c in (f"__m_{g}", f"__m_{g}_n", f"{g}_median", f"{g}_spike")]
    return joined.withColumns(screened).drop(*helpers)


# -- smoothing -------------------------------------------------------------------------------
SMOOTH_ROWS = 11


def quadratic_weights(rows: int = SMOOTH_ROWS) -> np.ndarray:
    """Row i: weights that evaluate, at point i, the least-squares parabola through `rows` points."""
    x = np.vander(np.arange(rows) - rows // 2, 3, increasing=True).astype(float)
    return x @ np.linalg.solve(x.T @ x, x.T)


def smooth_profiles(df: DataFrame, variables: dict[str, str]) -> DataFrame:
    """Local parabolas over the valid values of each profile: (glider_id, seq, <output>...).

    `variables` maps inputs to output names. Profiles with fewer than 11 values stay as they are.
    """
    pairs = F.array(*[F.struct(F.lit(o).alias("name"), F.col(v).alias("v")) for v, o in variables.items()])
    long = df.select(*PROFILE, "seq", F.explode(pairs).alias("x")).select(*PROFILE, "seq", "x.name", "x.v").filter("v IS NOT NULL")
    keys = ["glider_id", "name"]
    numbered = number_rows(long, keys, ["seq"], F.floor(F.col("seq") / 50_000), out="__i")
    spans = numbered.groupBy(*keys, "profile_index").agg(F.min("__i").alias("__a"), F.count(F.lit(1)).alias("__n"))
    reach = SMOOTH_ROWS - 1
    runs = Runs(numbered.join(spans, [*keys, "profile_index"]), keys=keys, seq="__i", before=reach, after=reach)
    offset = {f"__o{k + reach}": runs.lag("v", -k) if k < 0 else runs.lead("v", k) for k in range(-reach, reach + 1) if k}
    runs.with_columns(offset | {f"__o{reach}": F.col("v")})
    weights, mid = quadratic_weights(), SMOOTH_ROWS // 2
    i = F.col("__i") - F.col("__a")
    row = i - F.least(F.greatest(i - mid, F.lit(0)), F.col("__n") - SMOOTH_ROWS)

    # by position, not by a branch for each row of the fit: the generated code would be too long to be compiled
    runs.with_columns({"__o": F.array(*[F.col(f"__o{k}") for k in range(2 * reach + 1)]), "__row": row.cast("int")})
    table, row = F.array(*[F.lit(float(x)) for x in weights.flat]), F.col("__row")
    fit = sum((F.get("__o", reach - row + j) * F.get(table, row * SMOOTH_ROWS + j) for j in range(SMOOTH_ROWS)), F.lit(0.0))
    smooth = F.when(F.col("__n") < SMOOTH_ROWS, F.col("v")).otherwise(fit)
    runs.with_columns({"__s": F.when(F.col("profile_index").isNull(), F.col("v")).otherwise(smooth)})
    return runs.done().groupBy("glider_id", "seq").agg(
        *[F.max(F.when(F.col("name") == o, F.col("__s"))).alias(o) for o in variables.values()]
    )


# -- horizontal differences --------------------------------------------------------------------
def horizontal_outliers(
    df: DataFrame, variable: str = "salinity", max_share: float = 0.3, multiplier: float = 8.0
) -> DataFrame:
    """Profiles that differ from a neighbouring profile in too many 10 m bins: (glider, profile)."""
    valid = df.filter(
        F.col(variable).isNotNull() & F.col("depth").isNotNull() & F.col("profile_index").isNotNull()
    )
    level = F.greatest(F.ceil(F.col("depth") / 10) - 1, F.lit(0)).alias("level")
    means = materialise(valid.groupBy(*PROFILE, level).agg(F.avg(variable).alias("m"), F.count(F.lit(1)).alias("n")))
    order = number_rows(
        means.groupBy(*PROFILE).agg(F.sum("n").alias("rows")),
        ["glider_id"], ["profile_index"], F.floor(F.col("profile_index") / 10_000), out="rank",
    )
    ranked = means.join(order, PROFILE)
    after = ranked.select("glider_id", "level", (F.col("rank") - 1).alias("rank"), F.col("m").alias("m2"), F.col("profile_index").alias("next_profile"))
    diffs = materialise(
        ranked.join(after, ["glider_id", "level", "rank"]).withColumn("d", F.abs(F.col("m2") - F.col("m")))
    )
    size = order.groupBy("glider_id").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("profiles"))
    usable = size.filter("rows >= 20 AND profiles >= 5").select("glider_id")
    centred = with_quantiles(stats_join(diffs, usable, ["glider_id"], "inner"), {"mid": (F.col("d"), [0.5])}).filter("mid_n >= 10")
    spread = with_quantiles(centred, {"mad": (F.abs(F.col("d") - F.col("mid")[0]), [0.5])})
    limit = F.col("mid")[0] + multiplier * MAD_SCALE * F.col("mad")[0]
    pairs = (
        spread.groupBy("glider_id", "profile_index", "next_profile")
        .agg(F.count(F.lit(1)).alias("bins"), F.avg((F.col("d") > limit).cast("double")).alias("share"))
        .filter((F.col("bins") >= 3) & (F.col("share") > max_share))
    )
    both = pairs.select("glider_id", F.explode(F.array("profile_index", "next_profile")).alias("profile_index"))
    return both.distinct()


def physics_chain(df: DataFrame) -> DataFrame:
    """Spike screen, smoothing and the salinity check; adds `<v>_processed`."""
    variables = [v for v in PHYSICAL_GUARD if v in df.columns]
    screened = materialise(screen_spikes(df, variables))
    smooth = smooth_profiles(screened, {f"{v}_guarded": f"{v}_processed" for v in variables})
    out = screened.drop(*[f"{v}_guarded" for v in variables]).join(smooth, ["glider_id", "seq"], "left")
    if "oxygen_concentration" in variables:
        o2 = F.col("oxygen_concentration_processed")
        out = out.withColumn("oxygen_concentration_processed", F.when(o2 < 0, F.lit(0.0)).otherwise(o2))
    if "salinity" in variables:
        bad = horizontal_outliers(screened).withColumn("__bad", F.lit(True))
        hit = F.coalesce(F.col("__bad"), F.lit(False)) & F.coalesce(F.col("depth") > 100.0, F.lit(False))
        out = stats_join(out, bad, PROFILE)
        out = out.withColumns({c: F.when(~hit, F.col(c)) for c in ("salinity", "salinity_processed")}).drop("__bad")
    return out


# -- optics --------------------------------------------------------------------------------------
def subtract_dark_count(df: DataFrame, variables: list[str], percentile: float = 5.0) -> DataFrame:
    """Subtract the low percentile of deep values; the depth range follows the deployment."""
    depth = F.col("depth")
    shallow = with_quantiles(
        df, {f"__d_{v}": (F.when(F.col(v).isNotNull(), depth), [0.7, 0.9]) for v in variables}
    )
    specs = {}
    for v in variables:
        p70, p90 = F.col(f"__d_{v}")[0], F.col(f"__d_{v}")[1]
        specs[f"__deep_{v}"] = (F.when(depth.between(F.greatest(p70, F.lit(50.0)), p90), F.col(v)), [percentile / 100.0])
        specs[f"__last_{v}"] = (F.when(depth >= p90, F.col(v)), [percentile / 100.0])
    joined = with_quantiles(shallow, specs)
    out = {}
    for v in variables:
        few = F.col(f"__deep_{v}_n") < 5
        dark = F.when(few, F.col(f"__last_{v}")[0]).otherwise(F.col(f"__deep_{v}")[0])
        n = F.when(few, F.col(f"__last_{v}_n")).otherwise(F.col(f"__deep_{v}_n"))
        apply = (F.col(f"__d_{v}_n") >= 10) & (n >= 3) & depth.isNotNull()
        out[v] = F.when(apply, F.col(v) - dark).otherwise(F.col(v))
    helpers = [f"__{k}_{v}{s}" for v in variables for k in ("d", "deep", "last") for s in ("", "_n")]
    return joined.withColumns(out).drop(*helpers)


def particle_backscatter(
    beta: Column, temperature: Column, salinity: Column, wavelength: float = 700.0, chi: float = 1.076
) -> Column:
    """Volume scattering minus a seawater term, as particulate backscatter."""
    seawater = 1.38e-4 * (500.0 / wavelength) ** 4.32 * (1 + 0.3 * salinity / 37.0) * (1 + (temperature - 20) * 0.002)
    return 2 * np.pi * chi * (beta - seawater)


def bad_profiles(df: DataFrame, variable: str, multiplier: float = 2.0) -> DataFrame:
    """Profiles whose deep mean exceeds the median by 2 standard deviations: (glider, profile)."""
    v, depth = F.col(variable), F.col("depth")
    joined = with_quantiles(df, {"__p": (depth, [0.6]), "__valid": (F.when(depth.isNotNull() & F.col("profile_index").isNotNull(), v), [0.5])})
    deep = joined.filter(v.isNotNull() & (F.col("__valid_n") >= 10) & (depth > F.greatest(F.col("__p")[0], F.lit(100.0))))
    means = materialise(
        deep.filter(F.col("profile_index").isNotNull())
        .groupBy(*PROFILE)
        .agg(F.avg(v).alias("m"), F.count(F.lit(1)).alias("n"))
        .filter("n >= 3")
    )
    spread = means.groupBy("glider_id").agg(F.stddev_pop("m").alias("sd"))
    judged = stats_join(with_quantiles(means, {"mid": (F.col("m"), [0.5])}), spread, ["glider_id"])
    return judged.filter(
        (F.col("mid_n") >= 5) & (F.col("m") > F.col("mid")[0] + multiplier * F.col("sd"))
    ).select(*PROFILE)


def correct_quenching(
    df: DataFrame, chl: str = "chlorophyll_corrected", bbp: str = "backscatter_700_corrected"
) -> DataFrame:
    """Raise daytime near-surface chlorophyll to the night-time ratio with backscatter."""
    lon = df.groupBy("glider_id").agg(F.avg("longitude").alias("__lon"))
    c, b, depth = F.col(chl), F.col(bbp), F.col("depth")
    valid = c.isNotNull() & b.isNotNull() & depth.isNotNull() & F.col("profile_index").isNotNull()
    base = stats_join(df, lon, ["glider_id"]).withColumns(
        {"__valid": valid, "__day": is_day(solar_hour(F.col("t_s"), F.col("__lon"))).cast("int"), "__ratio": F.when(b > 1e-5, c / b)}
    )
    rows = base.filter("__valid").select(*PROFILE, "__day", "__ratio", depth.alias("depth"))
    night_ratio = F.when((F.col("depth") >= 20) & (F.col("depth") <= 200), F.col("__ratio"))
    profile = materialise(rows.groupBy(*PROFILE).agg(F.count(F.lit(1)).alias("n"), F.avg("__day").alias("day")).filter("n >= 5"))
    night = exact_quantiles(stats_join(rows, profile.filter("day <= 0.5"), PROFILE, "left_semi"), PROFILE, {"r": (night_ratio, [0.5])})
    night = night.filter((F.col("r_n") >= 3) & (F.col("r")[0] > 0)).select(*PROFILE, F.col("r")[0].alias("ratio"))
    total = rows.groupBy("glider_id").agg(F.count(F.lit(1)).alias("__rows"))
    ref = exact_quantiles(night, ["glider_id"], {"ref": (F.col("ratio"), [0.5])}).filter("ref_n >= 3")
    ref = ref.select("glider_id", F.col("ref")[0].alias("__ref")).join(total.filter("__rows >= 50"), "glider_id", "left_semi")
    with_ref = stats_join(base, ref, ["glider_id"])
    deepest = (
        stats_join(with_ref.filter("__valid"), profile.filter("day > 0.5"), PROFILE, "left_semi")
        .filter((depth < 200) & (F.col("__ratio") < 0.5 * F.col("__ref")))
        .groupBy(*PROFILE)
        .agg(F.max("depth").alias("__quench"))
    )
    raised = F.col("__valid") & (depth < F.col("__quench")) & (b > 1e-5)
    out = stats_join(with_ref, deepest, PROFILE)
    return out.withColumn(chl, F.when(raised, F.greatest(c, b * F.col("__ref"))).otherwise(c)).drop(
        "__lon", "__valid", "__day", "__ratio", "__ref", "__quench"
    )


def optics_chain(df: DataFrame) -> DataFrame:
    """Outliers, dark count, running median, bad profiles and quenching; adds `<v>_corrected`.

    The raw columns only lose outliers and bad profiles.
    """
    names = [v for v in ("chlorophyll", "cdom", "backscatter_700") if v in df.columns]
    clean = materialise(remove_iqr_outliers(df, names, 3.0))
    corrected = [f"{v}_corrected" for v in names]
    has_ts = "temperature" in df.columns and "salinity" in df.columns
    start = {c: F.col(v) for v, c in zip(names, corrected, strict=True)}
    if "backscatter_700" in names and has_ts:
        start["backscatter_700_corrected"] = particle_backscatter(
            F.col("backscatter_700"), F.col("temperature"), F.col("salinity")
        )
    work = clean.withColumns(start)
    work = subtract_dark_count(work, [c for c in corrected if has_ts or c != "backscatter_700_corrected"])
    floor = {c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in corrected if not c.startswith("backscatter")}
    # the running median reads its input several times: not the statistics under it
    work = median_despike(materialise(work.withColumns(floor)), {c: 7 for c in corrected})
    work = work.withColumns({c: F.col(f"{c}_median") for c in corrected})
    work = materialise(work.drop(*[f"{c}_{s}" for c in corrected for s in ("median", "spike")]))
    for v in ("backscatter_700", "chlorophyll"):
        if v in names:
            bad = bad_profiles(work, f"{v}_corrected").withColumn("__bad", F.lit(True))
            joined = stats_join(work, bad, PROFILE)
            work = joined.withColumns({c: F.when(F.col("__bad").isNull(), F.col(c)) for c in (v, f"{v}_corrected")}).drop("__bad")
    if "chlorophyll" in names and "backscatter_700" in names:
        work = correct_quenching(materialise(work))
    return work


# -- oxygen -----------------------------------------------------------------------------------------
def oxygen_lag(df: DataFrame, tau: float = OXYGEN_TAU) -> DataFrame:
    """First-order sensor lag: value + tau * rate inside a profile, gaps of up to 60 s."""
    runs = Runs(df, before=1)
    o2 = F.col("oxygen_concentration")
    dt = F.floor("t_s") - F.floor(runs.lag("t_s"))
    same = ~F.coalesce(runs.lag("profile_index") != F.col("profile_index"), F.lit(True)) 
    rate = F.when((dt > 0) & (dt <= 60) & same, (o2 - runs.lag("oxygen_concentration")) / dt)
    runs.with_columns({"__rate": F.coalesce(rate, F.lit(0.0))})
    value = o2 + tau * F.col("__rate")
    return runs.done().withColumn(
        "oxygen_concentration_lag_corrected", F.when(value < 0, F.lit(0.0)).otherwise(value)
    ).drop("__rate")
