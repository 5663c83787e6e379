"""Registered queries: corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators import corrections as co
from ..session import materialise
from .common import L0_CTE, SCREENED_CTE, SIZED_CTE, rounded, sized, sql
from .fixture import l0
from .registry import query

OPTICS = ["chlorophyll", "cdom", "backscatter_700"]
PHYSICS = ["temperature", "salinity", "oxygen_concentration"]


def screened(spark, sf):
    return cl.blank_absurd_temperature(cl.blank_null_island(l0(spark, sf)))


def iqr_cte(source, out, variables, m):
    cols = ", ".join(f"CASE WHEN n_{v} < 10 OR {v} BETWEEN q1_{v} - {m}*(q3_{v} - q1_{v}) AND q3_{v} + {m}*(q3_{v} - q1_{v}) THEN {v} END AS {v}" for v in variables)
    stats = ", ".join(f"count({v}) AS n_{v}, quantile_cont({v}, 0.25) AS q1_{v}, quantile_cont({v}, 0.75) AS q3_{v}" for v in variables)
    return f"{out} AS (SELECT {source}.* REPLACE ({cols}) FROM {source} JOIN (SELECT glider_id, {stats} FROM {source} GROUP BY 1) USING (glider_id))"


@query(
    "correct_iqr_outliers",
    sql("SELECT glider_id, t_s, " + ", ".join(f"round({v}, 6) AS {v}" for v in OPTICS) + " FROM iq", L0_CTE, iqr_cte("l0", "iq", OPTICS, 1.5)),
)
def iqr(spark, sf):
    return rounded(co.remove_iqr_outliers(l0(spark, sf), OPTICS).select("glider_id", "t_s", *OPTICS))


def despike_cte(source, tag, v, w):
    """CTEs ending in `<tag>`: glider_id, seq, med (where present), spike."""
    h = w // 2
    return f"""{tag}_e AS (SELECT glider_id, count({v}) AS n, min(seq) FILTER (WHERE {v} IS NOT NULL) AS a, max(seq) FILTER (WHERE {v} IS NOT NULL) AS b FROM {source} GROUP BY 1),
{tag}_f AS (SELECT glider_id, seq, v, a, b, n, CASE WHEN v IS NOT NULL THEN v ELSE pv + (nv - pv)*(seq - ps)/(CAST(ns AS double) - ps) END AS f FROM (
  SELECT glider_id, seq, {v} AS v, a, b, n,
  last_value({v} IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN {v} IS NOT NULL THEN seq END IGNORE NULLS) OVER p AS ps,
  first_value({v} IGNORE NULLS) OVER q AS nv, first_value(CASE WHEN {v} IS NOT NULL THEN seq END IGNORE NULLS) OVER q AS ns
  FROM {source} JOIN {tag}_e USING (glider_id) WHERE seq BETWEEN a AND b
  WINDOW p AS (PARTITION BY glider_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY glider_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
{tag}_m AS (SELECT x.glider_id, x.seq, median(y.f) AS m FROM (SELECT *, unnest(range({-h}, {h + 1})) AS k FROM {tag}_f) x JOIN {tag}_f y ON y.glider_id = x.glider_id
  AND y.seq = CASE WHEN x.seq + k < x.a THEN 2*x.a - 1 - (x.seq + k) WHEN x.seq + k > x.b THEN 2*x.b + 1 - (x.seq + k) ELSE x.seq + k END GROUP BY 1, 2),
{tag} AS (SELECT s.glider_id, s.seq, CASE WHEN {v} IS NOT NULL THEN CASE WHEN n >= {w} THEN m ELSE {v} END END AS med,
  CASE WHEN n < {w} THEN 0.0 ELSE {v} - m END AS spike FROM {source} s LEFT JOIN {tag}_m USING (glider_id, seq) JOIN {tag}_e USING (glider_id))"""


# a shortened record with missing rows at both ends and inside
ENDS_SQL = "en AS (SELECT * REPLACE (CASE WHEN seq < 5 OR seq >= n_rows - 9 THEN NULL ELSE temperature END AS temperature) FROM sz)"


@query(
    "correct_median_despike",
    sql(
        """SELECT glider_id, t_s, round(a.med, 6) AS temperature_median, round(a.spike, 6) AS temperature_spike, round(b.med, 6) AS chlorophyll_median, round(b.spike, 6) AS chlorophyll_spike
        FROM en JOIN a USING (glider_id, seq) JOIN b USING (glider_id, seq)""",
        L0_CTE, SIZED_CTE, ENDS_SQL, despike_cte("en", "a", "temperature", 5), despike_cte("en", "b", "chlorophyll", 7),
    ),
)
def despike(spark, sf):
    t = F.col("temperature")
    base = sized(l0(spark, sf)).withColumn("temperature", F.when((F.col("seq") >= 5) & (F.col("seq") < F.col("n_rows") - 9), t)).drop("n_rows")
    out = co.median_despike(base, {"temperature": 5, "chlorophyll": 7})
    return rounded(out.select("glider_id", "t_s", "temperature_median", "temperature_spike", "chlorophyll_median", "chlorophyll_spike"))


GUARD = ", ".join(
    f"CASE WHEN {v} BETWEEN {lo} AND {hi} THEN {v} END AS {v}_guarded" for v, (lo, hi) in co.PHYSICAL_GUARD.items()
)
SCREEN_CTES = (
    f"gd AS (SELECT *, {GUARD} FROM cl)",
    *[despike_cte("gd", f"ds_{v}", f"{v}_guarded", 5) for v in PHYSICS],
    ", ".join(
        f"th_{v} AS (SELECT glider_id, CASE WHEN count(*) > 10 THEN 3.0*1.4826*quantile_cont(abs(spike), 0.5) END AS lim FROM ds_{v} WHERE abs(spike) > 0 GROUP BY 1)"
        for v in PHYSICS
    ),
    "scr AS (SELECT gd.* REPLACE ("
    + ", ".join(f"CASE WHEN coalesce(abs(ds_{v}.spike) > th_{v}.lim, false) THEN NULL ELSE gd.{v}_guarded END AS {v}" for v in PHYSICS)
    + ") FROM gd "
    + " ".join(f"JOIN ds_{v} ON ds_{v}.glider_id = gd.glider_id AND ds_{v}.seq = gd.seq LEFT JOIN th_{v} ON th_{v}.glider_id = gd.glider_id" for v in PHYSICS)
    + ")",
)


@query(
    "correct_spike_screen",
    sql("SELECT glider_id, t_s, " + ", ".join(f"round({v}, 6) AS {v}" for v in PHYSICS) + " FROM scr", SCREENED_CTE, *SCREEN_CTES),
)
def spike_screen(spark, sf):
    return rounded(co.screen_spikes(screened(spark, sf), PHYSICS).select("glider_id", "t_s", *PHYSICS))


HAT = ", ".join(f"({i}, {j}, {float(w):.17e})" for i, row in enumerate(co.quadratic_weights()) for j, w in enumerate(row))


def smooth_cte(source, tag, v):
    return f"""{tag}_v AS (SELECT glider_id, profile_index, seq, {v} AS v, row_number() OVER (PARTITION BY glider_id, profile_index ORDER BY seq) - 1 AS i,
  count(*) OVER (PARTITION BY glider_id, profile_index) AS n FROM {source} WHERE {v} IS NOT NULL),
{tag} AS (SELECT glider_id, seq, v AS s FROM {tag}_v WHERE n < 11 UNION ALL SELECT x.glider_id, x.seq, sum(h.w*y.v) FROM (SELECT *, least(greatest(i - 5, 0), n - 11) AS base FROM {tag}_v WHERE n >= 11) x
  JOIN hat h ON h.i = x.i - base JOIN {tag}_v y ON y.glider_id = x.glider_id AND y.profile_index = x.profile_index AND y.i = base + h.j GROUP BY 1, 2)"""


HAT_CTE = f"hat(i, j, w) AS (VALUES {HAT})"
SMOOTH_CTES = (HAT_CTE, *[smooth_cte("gd", f"sm_{v}", f"{v}_guarded") for v in PHYSICS])


@query(
    "correct_profile_smoothing",
    sql(
        "SELECT glider_id, t_s, round(t.s, 6) AS temperature_processed, round(c.s, 6) AS chlorophyll_processed FROM l0 LEFT JOIN t USING (glider_id, seq) LEFT JOIN c USING (glider_id, seq)",
        L0_CTE, HAT_CTE, smooth_cte("l0", "t", "temperature"), smooth_cte("l0", "c", "chlorophyll"),
    ),
)
def smoothing(spark, sf):
    base = l0(spark, sf)
    smooth = co.smooth_profiles(base, {"temperature": "temperature_processed", "chlorophyll": "chlorophyll_processed"})
    return rounded(base.select("glider_id", "t_s", "seq").join(smooth, ["glider_id", "seq"], "left").drop("seq"))


HORIZONTAL_CTE = """hb AS (SELECT glider_id, profile_index, greatest(ceil(depth/10) - 1, 0) AS lv, avg(salinity) AS m, count(*) AS n FROM {0} WHERE salinity IS NOT NULL AND depth IS NOT NULL GROUP BY 1, 2, 3),
hr AS (SELECT glider_id, profile_index, sum(n) AS n, row_number() OVER (PARTITION BY glider_id ORDER BY profile_index) AS k FROM hb GROUP BY 1, 2),
hd AS (SELECT x.glider_id, rx.profile_index AS pa, ry.profile_index AS pb, abs(y.m - x.m) AS d FROM hb x JOIN hr rx USING (glider_id, profile_index)
  JOIN hr ry ON ry.glider_id = x.glider_id AND ry.k = rx.k + 1 JOIN hb y ON y.glider_id = x.glider_id AND y.profile_index = ry.profile_index AND y.lv = x.lv),
hm AS (SELECT glider_id, quantile_cont(d, 0.5) AS med, count(*) AS n FROM hd GROUP BY 1),
hl AS (SELECT glider_id, med + {2}*1.4826*quantile_cont(abs(d - med), 0.5) AS lim FROM hd JOIN hm USING (glider_id) WHERE n >= 10 GROUP BY 1, med),
hp AS (SELECT glider_id, pa, pb FROM hd JOIN hl USING (glider_id) GROUP BY 1, 2, 3 HAVING count(*) >= 3 AND avg(CASE WHEN d > lim THEN 1.0 ELSE 0.0 END) > {1}),
hx AS (SELECT glider_id, pa AS profile_index FROM hp UNION SELECT glider_id, pb FROM hp)"""


@query("correct_horizontal_outliers", sql("SELECT glider_id, profile_index FROM hx", SCREENED_CTE, HORIZONTAL_CTE.format("cl", 0.1, 3.0)))
def horizontal(spark, sf):
    return co.horizontal_outliers(screened(spark, sf), max_share=0.1, multiplier=3.0)


@query(
    "correct_physics_chain",
    sql(
        """SELECT scr.glider_id, t_s, round(temperature, 6) AS temperature, round(oxygen_concentration, 6) AS oxygen_concentration,
        round(CASE WHEN hx.profile_index IS NOT NULL AND depth > 100 THEN NULL ELSE salinity END, 6) AS salinity,
        round(a.s, 6) AS temperature_processed, round(CASE WHEN hx.profile_index IS NOT NULL AND depth > 100 THEN NULL ELSE b.s END, 6) AS salinity_processed,
        round(CASE WHEN c.s < 0 THEN 0 ELSE c.s END, 6) AS oxygen_concentration_processed
        FROM scr LEFT JOIN sm_temperature a USING (glider_id, seq) LEFT JOIN sm_salinity b USING (glider_id, seq) LEFT JOIN sm_oxygen_concentration c USING (glider_id, seq)
        LEFT JOIN hx ON hx.glider_id = scr.glider_id AND hx.profile_index = scr.profile_index""",
        SCREENED_CTE, *SCREEN_CTES, *SMOOTH_CTES, HORIZONTAL_CTE.format("scr", 0.3, 8.0),
    ),
)
def physics(spark, sf):
    out = co.physics_chain(materialise(screened(spark, sf)))
    return rounded(out.select("glider_id", "t_s", *PHYSICS, *[f"{v}_processed" for v in PHYSICS]))


def dark_cte(source, out, variables):
    ctes, cols, joins = [], [], ""
    for v in variables:
        ctes.append(
            f"""dk_{v} AS (SELECT glider_id, n, coalesce(CASE WHEN nd >= 5 THEN d5 END, CASE WHEN nl >= 3 THEN l5 END) AS dark FROM (
  SELECT glider_id, n, count(*) FILTER (WHERE depth >= greatest(p70, 50) AND depth <= p90) AS nd, quantile_cont({v}, 0.05) FILTER (WHERE depth >= greatest(p70, 50) AND depth <= p90) AS d5,
  count(*) FILTER (WHERE depth >= p90) AS nl, quantile_cont({v}, 0.05) FILTER (WHERE depth >= p90) AS l5
  FROM {source} JOIN (SELECT glider_id, count(*) AS n, quantile_cont(depth, 0.7) AS p70, quantile_cont(depth, 0.9) AS p90 FROM {source} WHERE {v} IS NOT NULL AND depth IS NOT NULL GROUP BY 1) USING (glider_id)
  WHERE {v} IS NOT NULL AND depth IS NOT NULL GROUP BY 1, 2))"""
        )
        cols.append(f"CASE WHEN dk_{v}.n >= 10 AND dk_{v}.dark IS NOT NULL AND depth IS NOT NULL THEN {v} - dk_{v}.dark ELSE {v} END AS {v}")
        joins += f" LEFT JOIN dk_{v} ON dk_{v}.glider_id = {source}.glider_id"
    return ", ".join(ctes) + f", {out} AS (SELECT {source}.* REPLACE ({', '.join(cols)}) FROM {source}{joins})"


@query(
    "correct_dark_count",
    sql("SELECT glider_id, t_s, round(chlorophyll, 6) AS chlorophyll, round(cdom, 6) AS cdom FROM dk", L0_CTE, dark_cte("l0", "dk", ["chlorophyll", "cdom"])),
)
def dark(spark, sf):
    return rounded(co.subtract_dark_count(l0(spark, sf), ["chlorophyll", "cdom"]).select("glider_id", "t_s", "chlorophyll", "cdom"))


BBP_SQL = "2*pi()*1.076*(backscatter_700 - 1.38e-4*pow(500.0/700.0, 4.32)*(1 + 0.3*salinity/37.0)*(1 + (temperature - 20)*0.002))"


@query("correct_backscatter", sql(f"SELECT glider_id, t_s, round({BBP_SQL}, 9) AS bbp FROM cl", SCREENED_CTE))
def backscatter(spark, sf):
    bbp = co.particle_backscatter(F.col("backscatter_700"), F.col("temperature"), F.col("salinity"))
    return rounded(screened(spark, sf).select("glider_id", "t_s", bbp.alias("bbp")), 9)


def bad_cte(source, tag, v):
    return f"""{tag}_p AS (SELECT glider_id, greatest(quantile_cont(depth, 0.6), 100) AS cut FROM {source} GROUP BY 1),
{tag}_m AS (SELECT glider_id, profile_index, avg({v}) AS m FROM {source} JOIN {tag}_p USING (glider_id) WHERE {v} IS NOT NULL AND depth > cut GROUP BY 1, 2 HAVING count(*) >= 3),
{tag} AS (SELECT glider_id, profile_index FROM {tag}_m JOIN (SELECT glider_id, quantile_cont(m, 0.5) + 2*stddev_pop(m) AS lim, count(*) AS n FROM {tag}_m GROUP BY 1) USING (glider_id) WHERE n >= 5 AND m > lim)"""


@query("correct_bad_profiles", sql("SELECT glider_id, profile_index FROM b", L0_CTE, bad_cte("l0", "b", "cdom")))
def bad(spark, sf):
    return co.bad_profiles(l0(spark, sf), "cdom")


# night and day follow the mean longitude; shading lowers chlorophyll near the surface
QUENCH_SQL = "qs AS (SELECT * REPLACE (CASE WHEN longitude = 0 THEN NULL ELSE longitude END AS longitude, CASE WHEN depth < 80 AND profile_index % 3 = 0 THEN chlorophyll*0.2 ELSE chlorophyll END AS chlorophyll) FROM l0)"


def quench_cte(source, out, chl, bbp):
    return f"""qn_l AS (SELECT glider_id, coalesce(avg(longitude), 75.0) AS lon FROM {source} GROUP BY 1),
qn_b AS (SELECT {source}.*, {chl} AS c, {bbp} AS b, {chl} IS NOT NULL AND {bbp} IS NOT NULL AND depth IS NOT NULL AS ok,
  CASE WHEN {bbp} > 1e-5 THEN {chl}/{bbp} END AS ratio, ((t_s % 86400)/3600.0 + lon/15.0) - 24*floor(((t_s % 86400)/3600.0 + lon/15.0)/24) AS h FROM {source} JOIN qn_l USING (glider_id)),
qn_p AS (SELECT glider_id, profile_index, avg(CASE WHEN h > 6 AND h < 18 THEN 1.0 ELSE 0.0 END) AS day FROM qn_b WHERE ok GROUP BY 1, 2 HAVING count(*) >= 5),
qn_n AS (SELECT glider_id, profile_index, quantile_cont(ratio, 0.5) AS r FROM qn_b JOIN qn_p USING (glider_id, profile_index) WHERE ok AND day <= 0.5 AND depth BETWEEN 20 AND 200 AND ratio IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3),
qn_r AS (SELECT glider_id, quantile_cont(r, 0.5) AS ref FROM qn_n WHERE r > 0 AND glider_id IN (SELECT glider_id FROM qn_b WHERE ok GROUP BY 1 HAVING count(*) >= 50) GROUP BY 1 HAVING count(*) >= 3),
qn_q AS (SELECT glider_id, profile_index, max(depth) AS deep FROM qn_b JOIN qn_p USING (glider_id, profile_index) JOIN qn_r USING (glider_id) WHERE ok AND day > 0.5 AND depth < 200 AND ratio < 0.5*ref GROUP BY 1, 2),
{out} AS (SELECT qn_b.* REPLACE (CASE WHEN ok AND depth < deep AND b > 1e-5 THEN greatest(c, b*ref) ELSE c END AS {chl}) FROM qn_b LEFT JOIN qn_r USING (glider_id) LEFT JOIN qn_q ON qn_q.glider_id = qn_b.glider_id AND qn_q.profile_index = qn_b.profile_index)"""


@query("correct_quenching", sql("SELECT glider_id, t_s, round(chlorophyll, 6) AS chlorophyll FROM qn", L0_CTE, QUENCH_SQL, quench_cte("qs", "qn", "chlorophyll", "backscatter_700")))
def quenching(spark, sf):
    shaded = F.when((F.col("depth") < 80) & (F.col("profile_index") % 3 == 0), F.col("chlorophyll") * 0.2)
    base = l0(spark, sf).withColumns(
        {"longitude": F.when(F.col("longitude") != 0, F.col("longitude")), "chlorophyll": shaded.otherwise(F.col("chlorophyll"))}
    )
    return rounded(co.correct_quenching(base, "chlorophyll", "backscatter_700").select("glider_id", "t_s", "chlorophyll"))


OPTICS_CTES = (
    SCREENED_CTE,
    iqr_cte("cl", "oq", OPTICS, 3.0),
    f"o1 AS (SELECT *, chlorophyll AS kc, cdom AS kd, {BBP_SQL} AS kb FROM oq)",
    dark_cte("o1", "o2", ["kc", "kd", "kb"]),
    "o3 AS (SELECT * REPLACE (CASE WHEN kc < 0 THEN 0.0 ELSE kc END AS kc, CASE WHEN kd < 0 THEN 0.0 ELSE kd END AS kd) FROM o2)",
    *[despike_cte("o3", f"om_{k}", k, 7) for k in ("kc", "kd", "kb")],
    "o4 AS (SELECT o3.* REPLACE (om_kc.med AS kc, om_kd.med AS kd, om_kb.med AS kb) FROM o3 JOIN om_kc USING (glider_id, seq) JOIN om_kd USING (glider_id, seq) JOIN om_kb USING (glider_id, seq))",
    bad_cte("o4", "ob_b", "kb"),
    "o5 AS (SELECT o4.* REPLACE (CASE WHEN ob_b.glider_id IS NULL THEN kb END AS kb, CASE WHEN ob_b.glider_id IS NULL THEN backscatter_700 END AS backscatter_700) FROM o4 LEFT JOIN ob_b ON ob_b.glider_id = o4.glider_id AND ob_b.profile_index = o4.profile_index)",
    bad_cte("o5", "ob_c", "kc"),
    "o6 AS (SELECT o5.* REPLACE (CASE WHEN ob_c.glider_id IS NULL THEN kc END AS kc, CASE WHEN ob_c.glider_id IS NULL THEN chlorophyll END AS chlorophyll) FROM o5 LEFT JOIN ob_c ON ob_c.glider_id = o5.glider_id AND ob_c.profile_index = o5.profile_index)",
    quench_cte("o6", "o7", "kc", "kb"),
)


@query(
    "correct_optics_chain",
    sql(
        "SELECT glider_id, t_s, round(chlorophyll, 6) AS chlorophyll, round(cdom, 6) AS cdom, round(backscatter_700, 6) AS backscatter_700, round(kc, 5) AS chlorophyll_corrected, round(kd, 5) AS cdom_corrected, round(kb, 6) AS backscatter_700_corrected FROM o7",
        *OPTICS_CTES,
    ),
)
def optics(spark, sf):
    out = co.optics_chain(materialise(screened(spark, sf)))
    digits = {"chlorophyll_corrected": 5, "cdom_corrected": 5}
    names = [*OPTICS, *[f"{v}_corrected" for v in OPTICS]]
    return out.select("glider_id", "t_s", *[F.round(c, digits.get(c, 6)).alias(c) for c in names])


LAG_CTE = """ol AS (SELECT *, CASE WHEN v < 0 THEN 0 ELSE v END AS lag_corrected FROM (SELECT *, oxygen_concentration + 30.0*coalesce(CASE WHEN t_s - lag(t_s) OVER w BETWEEN 1 AND 60
  AND profile_index = lag(profile_index) OVER w THEN (oxygen_concentration - lag(oxygen_concentration) OVER w)/(t_s - lag(t_s) OVER w) END, 0) AS v FROM {0} WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)))"""


@query("correct_oxygen_lag", sql("SELECT glider_id, t_s, round(lag_corrected, 6) AS oxygen_concentration_lag_corrected FROM ol", L0_CTE, LAG_CTE.format("l0")))
def oxygen(spark, sf):
    return rounded(co.oxygen_lag(l0(spark, sf)).select("glider_id", "t_s", "oxygen_concentration_lag_corrected"))
