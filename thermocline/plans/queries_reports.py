"""Registered queries: aggregation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators import reports as rp
from .common import L0_CTE, SCREENED_CTE, SIZED_CTE, rounded, sized, sql
from .fixture import l0
from .queries_cleaning import DEPLOYMENT_SQL, deployment
from .queries_corrections import despike_cte, iqr_cte
from .queries_grid import simple_flag_ctes, simple_flags
from .registry import query

V = rp.SENSORS
FLAGS = simple_flag_ctes()
FULLQ = "fa AS (SELECT cl.*, fl.* EXCLUDE (glider_id, t_s) FROM cl JOIN fl USING (glider_id, t_s))"


def union(source, variables, keep="glider_id", flags=False):
    return " UNION ALL ".join(
        f"SELECT {keep}, '{v}' AS variable, {v} AS v{f', {v}_QC AS qc' if flags else ''} FROM {source}" for v in variables
    )


def cnt(cond):
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


@query(
    "report_flag_summary",
    sql(
        "SELECT glider_id, variable, count(*) AS n, "
        + ", ".join(f"{cnt(f'qc = {k}')} AS n_{n}, round(100.0*{cnt(f'qc = {k}')}/count(*), 6) AS pct_{n}" for k, n in ((1, "good"), (2, "probably_good"), (3, "probably_bad"), (4, "bad"), (9, "missing")))
        + f" FROM ({union('fa', V, flags=True)}) GROUP BY 1, 2",
        *FLAGS, FULLQ,
    ),
)
def flag_summary(spark, sf):
    return rounded(rp.flag_summary(simple_flags(spark, sf), V))


@query("report_flag_cross_table", sql("SELECT glider_id, temperature_QC, salinity_QC, count(*) AS n FROM fl GROUP BY 1, 2, 3", *FLAGS))
def cross(spark, sf):
    return rp.flag_cross_table(simple_flags(spark, sf))


BROKEN = "br AS (SELECT glider_id, t_s, CASE WHEN t_s % 7 = 0 THEN 4 WHEN t_s % 7 = 1 THEN 9 ELSE temperature_QC END AS t, salinity_QC AS s, CASE WHEN t_s % 11 = 3 THEN 9 ELSE pressure_QC END AS p, oxygen_concentration_QC AS o, chlorophyll_QC AS c FROM fl)"


@query(
    "report_flag_conflicts",
    sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT glider_id, '{rule}' AS rule, '{sev}' AS severity, {cnt(c)} AS n FROM br GROUP BY 1"
            for rule, sev, c in (
                ("temperature bad, salinity not", "critical", "t = 4 AND s NOT IN (4, 9)"),
                ("temperature missing, salinity not", "warning", "t = 9 AND s <> 9"),
                ("pressure bad or missing, temperature not", "critical", "p IN (4, 9) AND t NOT IN (4, 9)"),
                ("pressure bad or missing, salinity not", "critical", "p IN (4, 9) AND s NOT IN (4, 9)"),
                ("pressure bad or missing, oxygen_concentration not", "critical", "p IN (4, 9) AND o NOT IN (4, 9)"),
                ("pressure bad or missing, chlorophyll not", "critical", "p IN (4, 9) AND c NOT IN (4, 9)"),
            )
        )
        + ") WHERE n > 0",
        *FLAGS, BROKEN,
    ),
)
def conflicts(spark, sf):
    t = F.col("t_s")
    base = simple_flags(spark, sf).withColumns(
        {
            "temperature_QC": F.when(t % 7 == 0, 4).when(t % 7 == 1, 9).otherwise(F.col("temperature_QC")),
            "pressure_QC": F.when(t % 11 == 3, 9).otherwise(F.col("pressure_QC")),
        }
    )
    return rp.flag_conflicts(base)


@query(
    "report_flag_integrity",
    sql(
        f"""SELECT *, CASE WHEN extra_missing > tol THEN 'missing without cause' WHEN extra_missing < -tol THEN 'reclaimed' ELSE 'ok' END AS verdict FROM (
        SELECT glider_id, variable, l0_missing, l0_total, l1_missing, l1_bad, l1_good, l1_total, l1_missing - CAST(round_even(l0_missing*(CAST(l1_total AS double)/l0_total), 0) AS BIGINT) AS extra_missing, greatest(200, floor(0.02*l1_total)) AS tol
        FROM (SELECT glider_id, variable, {cnt('v IS NULL')} AS l0_missing, count(*) AS l0_total FROM ({union('l0', V)}) GROUP BY 1, 2)
        JOIN (SELECT glider_id, variable, {cnt('qc = 9')} AS l1_missing, {cnt('qc IN (3, 4)')} AS l1_bad, {cnt('qc IN (1, 2)')} AS l1_good, count(*) AS l1_total FROM ({union('(SELECT * FROM fa WHERE t_s % 45 <> 0)', V, flags=True)}) GROUP BY 1, 2) USING (glider_id, variable))""".replace("SELECT *, CASE", "SELECT * EXCLUDE (tol), CASE"),
        *FLAGS, FULLQ,
    ),
)
def integrity(spark, sf):
    return rp.flag_integrity(l0(spark, sf), simple_flags(spark, sf).filter("t_s % 45 <> 0"), V)


@query(
    "report_daily_coverage",
    sql(
        f"SELECT glider_id, day, variable, round(avg(CASE WHEN qc IN (1, 2) THEN 1.0 ELSE 0.0 END), 6) AS share FROM ({union('(SELECT *, CAST(floor(t_s/86400) AS BIGINT) AS day FROM fa)', V, 'glider_id, day', True)}) GROUP BY 1, 2, 3",
        *FLAGS, FULLQ,
    ),
)
def daily(spark, sf):
    return rounded(rp.daily_coverage(simple_flags(spark, sf), V))


@query("report_coverage", sql(f"SELECT glider_id, variable, count(v) AS present, count(*) AS total, round(100.0*count(v)/count(*), 6) AS pct_present FROM ({union('l0', V)}) GROUP BY 1, 2"))
def coverage(spark, sf):
    return rounded(rp.coverage(l0(spark, sf), V))


@query(
    "report_cadence",
    sql(
        f"""SELECT glider_id, variable, median_gap, round(median_gap/greatest(b, 1), 6) AS ratio, median_gap/greatest(b, 1) > 3 AS sub_sampled FROM (SELECT glider_id, variable, quantile_cont(CAST(g AS DOUBLE), 0.5) AS median_gap FROM (SELECT glider_id, variable, t_s - lag(t_s) OVER (PARTITION BY glider_id, variable ORDER BY t_s) AS g FROM ({union('l0', V, 'glider_id, t_s')}) WHERE v IS NOT NULL) WHERE g > 0 GROUP BY 1, 2)
        JOIN (SELECT glider_id, quantile_cont(g, 0.5) AS b FROM (SELECT glider_id, t_s - lag(t_s) OVER (PARTITION BY glider_id ORDER BY t_s) AS g FROM l0) WHERE g > 0 GROUP BY 1) USING (glider_id)"""
    ),
)
def cadence(spark, sf):
    return rounded(rp.cadence(l0(spark, sf), V))


TRACK_CTE = """tp AS (SELECT glider_id, profile_index, avg(latitude) AS lat, avg(longitude) AS lon FROM cl GROUP BY 1, 2),
tl AS (SELECT glider_id, sqrt(pow((lat - lag(lat) OVER w)*111.32, 2) + pow((lon - lag(lon) OVER w)*111.32*cos(radians(ml)), 2)) AS leg FROM (SELECT *, avg(lat) OVER (PARTITION BY glider_id) AS ml FROM tp) WHERE lat IS NOT NULL WINDOW w AS (PARTITION BY glider_id ORDER BY profile_index)),
ts AS (SELECT a.*, n_profiles, round(coalesce(track_km, 0), 6) AS track_km FROM (SELECT glider_id, count(*) AS n_rows, min(t_s) AS t_first, max(t_s) AS t_last, round((max(t_s) - min(t_s))/86400.0, 6) AS days, max(depth) AS max_depth FROM cl GROUP BY 1) a JOIN (SELECT glider_id, count(*) AS n_profiles FROM tp GROUP BY 1) USING (glider_id) JOIN (SELECT glider_id, sum(leg) AS track_km FROM tl GROUP BY 1) USING (glider_id))"""


@query("report_track_summary", sql("SELECT * REPLACE (CAST(days AS DOUBLE) AS days) FROM ts", SCREENED_CTE, TRACK_CTE))
def track_summary(spark, sf):
    return rounded(rp.track_summary(cl.blank_null_island(l0(spark, sf))))


@query(
    "report_meta_row",
    sql(
        """SELECT glider_id, coalesce("start", s1, s0) AS deployment_start, coalesce("end", e1, e0) AS deployment_end, coalesce(p1, p0) AS max_depth_dbar, n0 AS n_profiles_l0, n1 AS n_profiles_l1, c0 AS n_observations
        FROM (SELECT glider_id, min(t_s) AS s0, max(t_s) AS e0, max(pressure) AS p0, count(DISTINCT profile_index) AS n0, count(*) AS c0 FROM l0 GROUP BY 1) FULL JOIN (SELECT glider_id, min(t_s) AS s1, max(t_s) AS e1, max(pressure) AS p1, count(DISTINCT profile_index) AS n1 FROM l0 WHERE profile_index > 3 AND pressure < 2000 GROUP BY 1) USING (glider_id) LEFT JOIN dep USING (glider_id)""",
        L0_CTE, DEPLOYMENT_SQL,
    ),
)
def meta(spark, sf):
    base = l0(spark, sf)
    return rp.meta_row(deployment(base), base, base.filter("profile_index > 3 AND pressure < 2000"))


FAR = "fx AS (SELECT glider_id, latitude + CASE WHEN seq % 400 = 0 THEN 29.0 ELSE 0 END AS latitude, longitude - CASE WHEN seq % 400 = 0 AND glider_id = 'G1' THEN 141 ELSE 0 END AS longitude FROM l0 WHERE latitude <> 0 UNION ALL SELECT 'G3', latitude, longitude FROM l0 WHERE latitude <> 0 AND glider_id = 'G2' AND seq < 100)"


@query(
    "deployment_parameters",
    sql(
        """SELECT b.glider_id, CASE WHEN few THEN 0 ELSE n END AS n_fixes, CASE WHEN few THEN -90 ELSE greatest(round(a5 - greatest(2, (a95 - a5)*0.15), 2), -90) END AS la_min, CASE WHEN few THEN 90 ELSE least(round(a95 + greatest(2, (a95 - a5)*0.15), 2), 90) END AS la_max, CASE WHEN few THEN -180 ELSE greatest(round(o5 - greatest(2, (o95 - o5)*0.15), 2), -180) END AS lo_min, CASE WHEN few THEN 180 ELSE least(round(o95 + greatest(2, (o95 - o5)*0.15), 2), 180) END AS lo_max,
        CASE WHEN NOT few THEN round(a50, 6) END AS median_lat, CASE WHEN NOT few THEN round(o50, 6) END AS median_lon, NOT few AND abs(a50) > 5 AS clean_hemisphere, k AS factory_box, round(CASE k WHEN 'default' THEN 40.0 WHEN 'cluster' THEN x0 - 1 END, 6) AS factory_south, round(CASE k WHEN 'default' THEN 43.0 WHEN 'cluster' THEN x1 + 1 END, 6) AS factory_north,
        round(CASE k WHEN 'default' THEN -72.0 WHEN 'cluster' THEN y0 - 1 END, 6) AS factory_west, round(CASE k WHEN 'default' THEN -69.0 WHEN 'cluster' THEN y1 + 1 END, 6) AS factory_east, CAST(1000 AS DOUBLE) AS max_depth_dbar
        FROM b JOIN (SELECT glider_id, CASE WHEN bool_or(few) THEN 'none' WHEN avg(CASE WHEN latitude BETWEEN 40 AND 43 AND longitude BETWEEN -72 AND -69 THEN 1.0 ELSE 0.0 END) > 0.05 THEN 'default' WHEN count(*) FILTER (WHERE f) > 3 THEN 'cluster' ELSE 'none' END AS k, min(latitude) FILTER (WHERE f) AS x0, max(latitude) FILTER (WHERE f) AS x1, min(longitude) FILTER (WHERE f) AS y0, max(longitude) FILTER (WHERE f) AS y1
        FROM (SELECT fx.*, few, sqrt(pow(latitude - a50, 2) + pow(longitude - o50, 2)) > 10 AS f FROM fx JOIN b USING (glider_id)) GROUP BY 1) USING (glider_id)""",
        L0_CTE, FAR,
        "b AS (SELECT glider_id, count(*) AS n, count(*) < 5 AS few, quantile_cont(latitude, 0.05) AS a5, quantile_cont(latitude, 0.5) AS a50, quantile_cont(latitude, 0.95) AS a95, quantile_cont(longitude, 0.05) AS o5, quantile_cont(longitude, 0.5) AS o50, quantile_cont(longitude, 0.95) AS o95 FROM fx GROUP BY 1)",
    ),
)
def parameters(spark, sf):
    far = F.when(F.col("seq") % 400 == 0, 29.0).otherwise(0.0)
    west = F.when((F.col("seq") % 400 == 0) & (F.col("glider_id") == "G1"), 141).otherwise(0)
    fixes = l0(spark, sf).filter("latitude <> 0")
    moved = fixes.select("glider_id", (F.col("latitude") + far).alias("latitude"), (F.col("longitude") - west).alias("longitude"))
    # a record too short for bounds of its own stands beside the gliders
    short = fixes.filter("glider_id = 'G2' AND seq < 100").select(F.lit("G3").alias("glider_id"), "latitude", "longitude")
    fixes = moved.unionByName(short)
    return rounded(rp.deployment_parameters(fixes))


SHIFT = "l1 AS (SELECT glider_id, t_s, CASE WHEN seq % 10 = 0 THEN NULL ELSE temperature + 0.001*(seq % 7) END AS temperature, salinity*1.01 AS salinity FROM l0 WHERE seq % 13 <> 2)"


@query(
    "compare_series",
    sql(
        f"""SELECT *, n_l1 - n_l0 AS change FROM (SELECT glider_id, variable, count(v) AS n_l0, round(min(v), 6) AS min_l0, round(max(v), 6) AS max_l0 FROM ({union('l0', V[:2])}) GROUP BY 1, 2) JOIN (SELECT glider_id, variable, count(v) AS n_l1, round(min(v), 6) AS min_l1, round(max(v), 6) AS max_l1 FROM ({union('l1', V[:2])}) GROUP BY 1, 2) USING (glider_id, variable)
        JOIN (SELECT glider_id, variable, count(abs(b.v - a.v)) AS n_pairs, round(max(abs(b.v - a.v)), 6) AS max_diff, round(avg(abs(b.v - a.v)), 6) AS mean_diff FROM ({union('l0', V[:2], 'glider_id, t_s')}) a JOIN ({union('l1', V[:2], 'glider_id, t_s')}) b USING (glider_id, t_s, variable) GROUP BY 1, 2) USING (glider_id, variable)""",
        L0_CTE, SHIFT,
    ),
)
def compare(spark, sf):
    base = l0(spark, sf)
    t = F.when(F.col("seq") % 10 != 0, F.col("temperature") + 0.001 * (F.col("seq") % 7))
    other = base.filter("seq % 13 <> 2").withColumns({"temperature": t, "salinity": F.col("salinity") * 1.01})
    return rounded(rp.compare_series(base, other, V[:2]))


@query(
    "compare_methods",
    sql(
        f"""SELECT * FROM (SELECT glider_id, variable, count(v) AS n_simple, round(100.0*count(v)/count(*), 6) AS pct_simple, round(min(v), 6) AS min_simple, round(max(v), 6) AS max_simple FROM ({union('sx', V[:2])}) GROUP BY 1, 2)
        JOIN (SELECT glider_id, variable, count(v) AS n_good, round(100.0*count(v)/count(*), 6) AS pct_good, round(min(v), 6) AS min_good, round(max(v), 6) AS max_good FROM ({union('gx', V[:2])}) GROUP BY 1, 2) USING (glider_id, variable)
        LEFT JOIN (SELECT glider_id, variable, count(*) AS n_pairs, round(CASE WHEN count(*) >= 100 THEN avg(a.v - b.v) END, 6) AS mean_diff, round(CASE WHEN count(*) >= 100 THEN stddev_pop(a.v - b.v) END, 6) AS std_diff, round(CASE WHEN count(*) >= 100 THEN 100*avg(CASE WHEN abs(a.v - b.v) < 0.01 THEN 1.0 ELSE 0 END) END, 6) AS pct_within_0_01, round(CASE WHEN count(*) >= 100 THEN 100*avg(CASE WHEN abs(a.v - b.v) < 1 THEN 1.0 ELSE 0 END) END, 6) AS pct_within_1
          FROM (SELECT * FROM ({union('sx', V[:2], 'glider_id, t_s')}) WHERE v IS NOT NULL) a JOIN (SELECT * FROM ({union('gx', V[:2], 'glider_id, t_s')}) WHERE v IS NOT NULL) b USING (glider_id, t_s, variable) GROUP BY 1, 2) USING (glider_id, variable)""",
        *FLAGS, FULLQ, iqr_cte("l0", "mq", V[:2], 3.0), despike_cte("mq", "ma", "temperature", 5), despike_cte("mq", "mb", "salinity", 5),
        "sx AS (SELECT l0.glider_id, t_s, ma.med AS temperature, mb.med AS salinity FROM l0 JOIN ma USING (glider_id, seq) JOIN mb USING (glider_id, seq)), gx AS (SELECT glider_id, t_s, CASE WHEN temperature_QC = 1 THEN temperature END AS temperature, CASE WHEN salinity_QC = 1 THEN salinity END AS salinity FROM fa)",
    ),
)
def methods(spark, sf):
    return rounded(rp.compare_methods(l0(spark, sf), simple_flags(spark, sf), V[:2]))


# variables that fall silent: share of the rows before it, and rows more
SILENT = {"temperature": (0.45, 0), "salinity": (0.45, 0), "oxygen_concentration": (0.24, 0), "cdom": (0.24, 2)}
SILENT_SQL = "si AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN seq < floor({share}*n_rows::DOUBLE) + {more} THEN {v} END AS {v}" for v, (share, more) in SILENT.items()) + ") FROM sz)"
FAIL_CTE = f"""fr AS (SELECT glider_id, variable, count(v) AS nv, max(t_s) FILTER (WHERE v IS NOT NULL) AS last_valid, count(*) AS n, max(t1) AS t1, max(t0) AS t0,
 count(v) FILTER (WHERE t_s <= t0 + floor((t1 - t0)/3))/CAST(greatest(count(*) FILTER (WHERE t_s <= t0 + floor((t1 - t0)/3)), 1) AS double) AS early
 FROM ({union('si', V, 'glider_id, t_s')}) JOIN (SELECT glider_id, min(t_s) AS t0, max(t_s) AS t1 FROM si GROUP BY 1) USING (glider_id) GROUP BY 1, 2),
fi AS (SELECT glider_id, variable, last_valid, (t1 - last_valid)/86400.0::DOUBLE AS days_from_end, early AS early_coverage FROM fr WHERE nv >= greatest(n*0.005, 5) AND (t1 - last_valid)/86400.0 > greatest((t1 - t0)/86400.0*0.15, 5) AND early > 0.05)"""


def silent(spark, sf):
    stops = {v: F.floor(share * F.col("n_rows").cast("double")) + more for v, (share, more) in SILENT.items()}
    return sized(l0(spark, sf)).withColumns({v: F.when(F.col("seq") < at, F.col(v)) for v, at in stops.items()}).drop("n_rows")


@query("report_sensor_failures", sql("SELECT glider_id, variable, last_valid, round(days_from_end, 6) AS days_from_end, round(early_coverage, 6) AS early_coverage FROM fi", L0_CTE, SIZED_CTE, SILENT_SQL, FAIL_CTE))
def failures(spark, sf):
    return rounded(rp.sensor_failures(silent(spark, sf), V))


RANKS = "[" + ", ".join(f"'{v}'" for v in V) + "]"
STOP_CTES = (
    f"it AS (SELECT glider_id, variable, last_valid AS t, row_number() OVER (PARTITION BY glider_id ORDER BY list_position({RANKS}, variable)) AS k FROM fi)",
    """sh AS (SELECT glider_id, 0::BIGINT AS k, []::BIGINT[] AS heads FROM (SELECT DISTINCT glider_id FROM it) UNION ALL
        SELECT it.glider_id, it.k, CASE WHEN len(list_filter(heads, lambda h: abs(h - t) <= 60)) > 0 THEN heads ELSE list_append(heads, t) END FROM sh JOIN it ON it.glider_id = sh.glider_id AND it.k = sh.k + 1)""",
)


@query(
    "report_shared_stops",
    # a variable joins the first head within a minute of it, else becomes a head; one step a variable
    sql(
        """SELECT glider_id, head AS stopped_at, string_agg(variable, ',' ORDER BY k) AS variables, CASE WHEN bool_or(variable IN ('temperature', 'salinity', 'pressure')) THEN 'mission gap' ELSE 'several sensors' END AS kind FROM
        (SELECT it.*, list_filter(heads, lambda h: abs(h - t) <= 60)[1] AS head FROM it JOIN sh USING (glider_id, k)) GROUP BY 1, 2 HAVING count(*) > 1""",
        L0_CTE, SIZED_CTE, SILENT_SQL, FAIL_CTE,
        *STOP_CTES,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def stops(spark, sf):
    return rp.shared_stops(rp.sensor_failures(silent(spark, sf), V), V)


@query(
    "report_oxygen_failure",
    sql(
        f"SELECT * FROM (SELECT glider_id, {cnt('q = 4')} AS n_bad, round((max(t_s) FILTER (WHERE q = 4) - min(t_s) FILTER (WHERE q = 4))/86400.0, 6)::DOUBLE AS span_days, count(DISTINCT CASE WHEN q = 4 THEN t_s // 86400 END) AS bad_days, round({cnt('q = 4')}/CAST(count(*) AS double), 6) AS share FROM (SELECT glider_id, t_s, CASE WHEN seq % 9 = 0 THEN 4 ELSE 1 END AS q FROM l0) GROUP BY 1) WHERE n_bad > 100 AND span_days > 5 AND share > 0.05"
    ),
)
def oxygen(spark, sf):
    return rounded(rp.oxygen_failure(l0(spark, sf).withColumn("oxygen_concentration_QC", F.when(F.col("seq") % 9 == 0, 4).otherwise(1))))


@query(
    "diagnose_gps",
    sql(
        f"""SELECT a.*, p50_km, p99_km, max_km, n_far, n_jumps FROM (SELECT glider_id, count(*) AS n, {cnt('latitude IS NULL')} AS lat_missing, {cnt('longitude IS NULL')} AS lon_missing, {cnt('abs(latitude) > 90')} AS lat_impossible, {cnt('abs(longitude) > 180')} AS lon_impossible, count(DISTINCT round(latitude, 6)) AS lat_distinct, count(DISTINCT round(longitude, 6)) AS lon_distinct FROM l0 GROUP BY 1) a
        JOIN (SELECT glider_id, round(quantile_cont(d, 0.5)*111.32, 6) AS p50_km, round(quantile_cont(d, 0.99)*111.32, 6) AS p99_km, round(max(d)*111.32, 6) AS max_km, {cnt('d > 10')} AS n_far FROM (SELECT glider_id, sqrt(pow(latitude - m, 2) + pow((longitude - k)*cos(radians(m)), 2)) AS d FROM l0 JOIN (SELECT glider_id, quantile_cont(latitude, 0.5) AS m, quantile_cont(longitude, 0.5) AS k FROM l0 WHERE latitude IS NOT NULL GROUP BY 1) USING (glider_id) WHERE latitude IS NOT NULL) GROUP BY 1) USING (glider_id)
        JOIN (SELECT glider_id, {cnt('pp = p AND sqrt(pow(dy*111.32, 2) + pow(dx*111.32*cos(radians(ml)), 2)) > 50')} AS n_jumps FROM (SELECT glider_id, profile_index // 3 AS p, lag(profile_index // 3) OVER w AS pp, latitude - lag(latitude) OVER w AS dy, longitude - lag(longitude) OVER w AS dx, avg(latitude) OVER (PARTITION BY glider_id) AS ml FROM l0 WHERE latitude IS NOT NULL WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)) GROUP BY 1) USING (glider_id)"""
    ),
)
def gps(spark, sf):
    # three profiles counted as one, so that fixes of a profile can jump
    return rounded(rp.gps_diagnostics(l0(spark, sf).withColumn("profile_index", F.floor(F.col("profile_index") / 3))))


@query(
    "diagnose_ts",
    sql(
        f"""SELECT a.*, t_jumps, s_jumps, warm_cut, warm_s_min, warm_s_max, warm_s_mean FROM (SELECT glider_id, count(*) AS n, {cnt('temperature IS NOT NULL AND salinity IS NOT NULL')} AS n_pairs, round(min(temperature), 6) AS t_min, round(max(temperature), 6) AS t_max, round(min(salinity), 6) AS s_min, round(max(salinity), 6) AS s_max, {cnt('temperature < -2.5')} AS t_low, {cnt('temperature > 40')} AS t_high, {cnt('salinity < 2')} AS s_low, {cnt('salinity > 41')} AS s_high,
        round(1 - count(DISTINCT round(temperature, 6))/CAST(count(temperature) AS double), 6) AS t_stuck, round(1 - count(DISTINCT CASE WHEN temperature IS NOT NULL THEN round(salinity, 5) END)/CAST(count(temperature) AS double), 6) AS s_stuck FROM l0 GROUP BY 1) a
        JOIN (SELECT glider_id, {cnt('pp = profile_index AND abs(temperature - pt) > 10')} AS t_jumps, {cnt('pp = profile_index AND abs(salinity - ps) > 5')} AS s_jumps FROM (SELECT *, lag(profile_index) OVER w AS pp, lag(temperature) OVER w AS pt, lag(salinity) OVER w AS ps FROM l0 WHERE temperature IS NOT NULL WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)) GROUP BY 1) USING (glider_id)
        JOIN (SELECT glider_id, round(max(c), 6) AS warm_cut, round(min(salinity), 6) AS warm_s_min, round(max(salinity), 6) AS warm_s_max, round(avg(salinity), 6) AS warm_s_mean FROM l0 JOIN (SELECT glider_id, quantile_cont(temperature, 0.9) AS c FROM l0 GROUP BY 1) USING (glider_id) WHERE temperature >= c GROUP BY 1) USING (glider_id)"""
    ),
)
def ts(spark, sf):
    return rounded(rp.ts_diagnostics(l0(spark, sf)))


@query(
    "report_profile_inventory",
    sql(
        """SELECT *, coalesce(lag(direction) OVER w = direction AND t_first - lag(t_last) OVER w <= 3600, false) AS anomaly FROM (SELECT glider_id, profile_index, CASE WHEN avg(d) > 0 THEN 'D' ELSE 'A' END AS direction, round(avg(t_s), 3) AS mean_time, count(*) AS levels, arg_min(pressure, t_s) AS first_pressure, arg_max(pressure, t_s) AS last_pressure, min(t_s) AS t_first, max(t_s) AS t_last
        FROM (SELECT *, CASE WHEN profile_index % 10 = 3 THEN 1 ELSE profile_direction END AS d FROM l0) GROUP BY 1, 2) WINDOW w AS (PARTITION BY glider_id ORDER BY t_first)"""
    ),
)
def inventory(spark, sf):
    base = l0(spark, sf).withColumn("profile_direction", F.when(F.col("profile_index") % 10 == 3, 1).otherwise(F.col("profile_direction")))
    return rounded(rp.profile_inventory(base), 3)


@query(
    "report_profile_quality",
    sql(
        f"""SELECT glider_id, profile_index, variable, CASE WHEN j = 0 THEN ' ' WHEN s = 0 THEN 'F' WHEN s < 25 THEN 'E' WHEN s < 50 THEN 'D' WHEN s < 75 THEN 'C' WHEN s < 100 THEN 'B' ELSE 'A' END AS quality FROM (SELECT glider_id, profile_index, variable, {cnt('qc <> 0')} AS j, 100*avg(CASE WHEN qc IN (1, 2, 5, 8) THEN 1.0 ELSE 0 END) AS s FROM ({union('fa', V[:4], 'glider_id, profile_index', True)}) WHERE qc <> 9 GROUP BY 1, 2, 3)""",
        *FLAGS, FULLQ,
    ),
)
def quality(spark, sf):
    return rp.profile_quality(simple_flags(spark, sf), V[:4])


# sensors fall silent on two gliders; on the third, a ninth of the oxygen is flagged bad
QUIET_SQL = "si AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN glider_id = 'G2' OR seq < floor({share}*n_rows::DOUBLE) + {more} THEN {v} END AS {v}" for v, (share, more) in SILENT.items()) + ") FROM (SELECT *, count(*) OVER (PARTITION BY glider_id) AS n_rows FROM cl))"
OXYGEN_Q = "CASE WHEN glider_id = 'G2' AND seq % 9 = 0 THEN 4 ELSE oxygen_concentration_QC END"
ISSUE_CTES = (
    *STOP_CTES,
    "hd AS (SELECT it.*, list_filter(heads, lambda h: abs(h - t) <= 60)[1] AS head, count(*) OVER (PARTITION BY it.glider_id, list_filter(heads, lambda h: abs(h - t) <= 60)[1]) AS members FROM it JOIN (SELECT glider_id, arg_max(heads, k) AS heads FROM sh GROUP BY 1) USING (glider_id))",
    f"ob AS (SELECT glider_id, {cnt('q = 4')} AS n_bad, (max(t_s) FILTER (WHERE q = 4) - min(t_s) FILTER (WHERE q = 4))/86400.0::DOUBLE AS span, {cnt('q = 4')}/CAST(count(*) AS DOUBLE) AS share FROM (SELECT glider_id, t_s, {OXYGEN_Q} AS q FROM fa) GROUP BY 1)",
    """iss AS (SELECT glider_id, CASE WHEN bool_or(variable IN ('temperature', 'salinity', 'pressure')) THEN 'mission gap' ELSE 'several sensors' END AS kind, string_agg(variable, ',' ORDER BY k) AS variables, head AS last_valid, NULL::DOUBLE AS days_from_end, NULL::DOUBLE AS share FROM hd WHERE members > 1 GROUP BY glider_id, head
        UNION ALL SELECT glider_id, 'sensor failure', variable, last_valid, round(days_from_end, 6), round(early_coverage, 6) FROM fi JOIN hd USING (glider_id, variable) WHERE members = 1
        UNION ALL SELECT glider_id, 'oxygen flagged bad', 'oxygen_concentration', NULL, NULL, round(share, 6) FROM ob WHERE n_bad > 100 AND span > 5 AND share > 0.05 AND glider_id NOT IN (SELECT glider_id FROM fi WHERE variable = 'oxygen_concentration'))""",
)


def quiet(spark, sf):
    """Both levels: silent sensors in the raw one, bad oxygen in the flagged one."""
    stops = {v: F.floor(share * F.col("n_rows").cast("double")) + more for v, (share, more) in SILENT.items()}
    base = sized(cl.blank_absurd_temperature(cl.blank_null_island(l0(spark, sf))))
    cut = {v: F.when((F.col("glider_id") == "G2") | (F.col("seq") < at), F.col(v)) for v, at in stops.items()}
    return base.withColumns(cut).drop("n_rows"), simple_flags(spark, sf).withColumn("oxygen_concentration_QC", F.expr(OXYGEN_Q))


@query("report_sensor_issues", sql("SELECT * FROM iss", *FLAGS, FULLQ, QUIET_SQL, FAIL_CTE, *ISSUE_CTES).replace("WITH ", "WITH RECURSIVE ", 1))
def sensor_issues(spark, sf):
    return rounded(rp.sensor_issues(*quiet(spark, sf), V))


LISTS = {  # nested lists as text: one entry a variable or issue
    "coverage": "concat(variable, ':', present, '/', total)",
    "flags": "concat(variable, ':', n, '/', n_good, '/', n_bad, '/', n_missing)",
    "issues": "concat(kind, ':', variables, ':', coalesce(CAST(last_valid AS STRING), '-'))",
}


@query(
    "deployment_summary",
    sql(
        "SELECT ts.* REPLACE (CAST(days AS DOUBLE) AS days), coalesce(n_gaps, 0) AS n_gaps, coalesce(gap_hours, 0)::DOUBLE AS gap_hours, coalesce(longest_gap_hours, 0)::DOUBLE AS longest_gap_hours, coverage, flags, coalesce(issues, '') AS issues FROM ts "
        "LEFT JOIN (SELECT glider_id, count(*) AS n_gaps, sum(b - a)/3600.0 AS gap_hours, max(b - a)/3600.0 AS longest_gap_hours FROM gaps GROUP BY 1) USING (glider_id) "
        f"JOIN (SELECT glider_id, string_agg({LISTS['coverage']}, ' ' ORDER BY variable) AS coverage FROM (SELECT glider_id, variable, count(v) AS present, count(*) AS total FROM ({union('si', V)}) GROUP BY 1, 2) GROUP BY 1) USING (glider_id) "
        f"JOIN (SELECT glider_id, string_agg({LISTS['flags']}, ' ' ORDER BY variable) AS flags FROM (SELECT glider_id, variable, count(*) AS n, {cnt('qc = 1')} AS n_good, {cnt('qc = 4')} AS n_bad, {cnt('qc = 9')} AS n_missing FROM ({union(f'(SELECT * REPLACE ({OXYGEN_Q} AS oxygen_concentration_QC) FROM fa)', V, flags=True)}) WHERE qc IS NOT NULL GROUP BY 1, 2) GROUP BY 1) USING (glider_id) "
        f"LEFT JOIN (SELECT glider_id, string_agg({LISTS['issues']}, ' ' ORDER BY kind, variables) AS issues FROM iss GROUP BY 1) USING (glider_id)",
        *FLAGS, FULLQ, QUIET_SQL, FAIL_CTE, *ISSUE_CTES, TRACK_CTE,
        "gaps AS (SELECT * FROM (SELECT glider_id, t_s // 3600 * 3600 AS a, lead(t_s) OVER (PARTITION BY glider_id ORDER BY t_s) // 3600 * 3600 AS b FROM cl) WHERE b - a > 172800)",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def summary(spark, sf):
    out = rp.deployment_summary(*quiet(spark, sf))
    text = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: LIST_ENTRY[c](x)), " "), F.lit(""))
    return rounded(out.withColumns({c: text(c) for c in LIST_ENTRY}))


LIST_ENTRY = {
    "coverage": lambda x: F.concat(x["variable"], F.lit(":"), x["present"], F.lit("/"), x["total"]),
    "flags": lambda x: F.concat(x["variable"], F.lit(":"), x["n"], F.lit("/"), x["n_good"], F.lit("/"), x["n_bad"], F.lit("/"), x["n_missing"]),
    "issues": lambda x: F.concat(x["kind"], F.lit(":"), x["variables"], F.lit(":"), F.coalesce(x["last_valid"].cast("string"), F.lit("-"))),
}


def issue(name, severity, body):
    return f"SELECT glider_id, '{name}' AS \"check\", '{severity}' AS severity, n FROM ({body}) WHERE n > 0"


PAIRS = "SELECT *, lag(profile_index) OVER w AS pp, lag(temperature) OVER w AS pt, lag(salinity) OVER w AS ps FROM fa WHERE temperature IS NOT NULL AND salinity IS NOT NULL WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)"
FIXES = "SELECT *, lag(profile_index) OVER w AS pp, latitude - lag(latitude) OVER w AS dy, longitude - lag(longitude) OVER w AS dx, avg(latitude) OVER (PARTITION BY glider_id) AS ml FROM fa WHERE latitude IS NOT NULL AND longitude IS NOT NULL WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)"
SPREAD = "SELECT glider_id, sqrt(pow(latitude - m, 2) + pow((longitude - k)*cos(radians(m)), 2)) AS d FROM fa JOIN (SELECT glider_id, quantile_cont(latitude, 0.5) AS m, quantile_cont(longitude, 0.5) AS k FROM fa WHERE latitude IS NOT NULL GROUP BY 1) USING (glider_id) WHERE latitude IS NOT NULL"
count_over = lambda cond, source: f"SELECT glider_id, {cnt(cond)} AS n FROM {source} GROUP BY 1"
ISSUES = [
    issue("latitude mostly missing", "critical", f"SELECT glider_id, CASE WHEN {cnt('latitude IS NULL')} > 0.5*count(*) THEN {cnt('latitude IS NULL')} END AS n FROM fa GROUP BY 1"),
    issue("latitude impossible", "warning", count_over("abs(latitude) > 90", "fa")),
    issue("longitude impossible", "warning", count_over("abs(longitude) > 180", "fa")),
    issue("far from track", "warning", count_over("d > 10", f"({SPREAD})")),
    issue("position jumps", "warning", count_over("pp = profile_index AND sqrt(pow(dy*111.32, 2) + pow(dx*111.32*cos(radians(ml)), 2)) > 50", f"({FIXES})")),
    issue("temperature low", "warning", count_over("temperature < -2.5", "fa")),
    issue("temperature high", "warning", count_over("temperature > 40", "fa")),
    issue("salinity low", "warning", count_over("salinity < 2", "fa")),
    issue("salinity high", "warning", count_over("salinity > 41", "fa")),
    issue("temperature jumps", "warning", count_over("pp = profile_index AND abs(temperature - pt) > 10", f"({PAIRS})")),
    issue("salinity jumps", "warning", count_over("pp = profile_index AND abs(salinity - ps) > 5", f"({PAIRS})")),
    issue("temperature bad, salinity not", "critical", count_over("temperature_QC = 4 AND salinity_QC NOT IN (4, 9)", "fa")),
    issue("temperature missing, salinity not", "warning", count_over("temperature_QC = 9 AND salinity_QC <> 9", "fa")),
    *[
        issue(f"pressure bad or missing, {v} not", "critical", count_over(f"pressure_QC IN (4, 9) AND {v}_QC NOT IN (4, 9)", "fa"))
        for v in ("temperature", "salinity", "oxygen_concentration", "chlorophyll")
    ],
    *[
        issue(f"{v} identical to pressure", "critical", f"SELECT glider_id, CASE WHEN avg(CASE WHEN abs({v} - pressure) < 1e-3 THEN 1.0 ELSE 0 END) > 0.5 AND count(*) >= 100 THEN count(*) END AS n FROM fa WHERE {v} IS NOT NULL AND pressure IS NOT NULL GROUP BY 1")
        for v in ("chlorophyll", "cdom", "backscatter_700")
    ],
    issue("all sensors stopped", "note", "SELECT glider_id, CASE WHEN max(k) >= 4 AND max(abs(last - head)) <= 60 THEN max((t1 - head) // 86400) END AS n FROM es GROUP BY 1"),
    """SELECT glider_id, variable || ' stopped early' AS "check", 'warning' AS severity, (t1 - last) // 86400 AS n FROM es WHERE glider_id IN (SELECT glider_id FROM es GROUP BY 1 HAVING bool_or(variable IN ('temperature', 'salinity')) AND NOT (max(k) >= 4 AND max(abs(last - head)) <= 60))""",
]
WATCHED = ("temperature", "salinity", "pressure", *V[2:])
STOPPED_CTE = (
    "es AS (SELECT *, row_number() OVER w AS k, first_value(last) OVER w AS head FROM ("
    + " UNION ALL ".join(f"SELECT glider_id, '{v}' AS variable, {i} AS place, count({v}) AS n, max(t_s) FILTER (WHERE {v} IS NOT NULL) AS last, min(t_s) AS t0, max(t_s) AS t1 FROM fa GROUP BY 1" for i, v in enumerate(WATCHED))
    + ") WHERE n >= 10 AND t1 - last > greatest((t1 - t0)*0.1, 259200) WINDOW w AS (PARTITION BY glider_id ORDER BY place))"
)


@query("verification_issues", sql(" UNION ALL ".join(ISSUES), *FLAGS, FULLQ, STOPPED_CTE))
def issues(spark, sf):
    return rp.verification_issues(simple_flags(spark, sf))


# one glider falls silent as a whole and has pressure for chlorophyll, one loses two sensors, one has levels without a common stamp
FAULTS = {
    "chlorophyll": "CASE WHEN glider_id = 'G0' THEN pressure ELSE chlorophyll END",
    **{v: f"CASE WHEN glider_id <> 'G0' OR seq < floor(0.5*n_rows) THEN {v} END" for v in ("salinity", "cdom", "backscatter_700")},
    "temperature": "CASE WHEN glider_id = 'G2' OR seq < floor(0.5*n_rows) THEN temperature END",
    "oxygen_concentration": "CASE WHEN seq < floor(0.5*n_rows) THEN oxygen_concentration END",
}


@query(
    "verification_issues_levels",
    sql(
        " UNION ALL ".join([
            *[q.replace("FROM fa", "FROM vf") for q in ISSUES],
            issue("row counts of levels differ", "warning", "SELECT glider_id, abs(n1 - n0) AS n FROM lc"),
            issue("no common stamps of levels", "critical", "SELECT glider_id, CASE WHEN common = 0 THEN n1 END AS n FROM lc"),
        ]),
        *FLAGS, FULLQ,
        "vf AS (SELECT * REPLACE (" + ", ".join(f"{e} AS {v}" for v, e in FAULTS.items()) + ") FROM (SELECT *, count(*) OVER (PARTITION BY glider_id) AS n_rows FROM fa))",
        STOPPED_CTE.replace("FROM fa", "FROM vf"),
        "lw AS (SELECT glider_id, t_s + CASE WHEN glider_id = 'G2' THEN 1000000000 ELSE 0 END AS t_s FROM l0 WHERE glider_id = 'G2' OR seq % 13 <> 2)",
        f"lc AS (SELECT glider_id, n0, n1, common FROM (SELECT glider_id, count(*) AS n0 FROM lw GROUP BY 1) JOIN (SELECT glider_id, count(*) AS n1, {cnt('(glider_id, t_s) IN (SELECT (glider_id, t_s) FROM lw)')} AS common FROM vf GROUP BY 1) USING (glider_id))",
    ),
)
def issues_levels(spark, sf):
    flagged = sized(simple_flags(spark, sf))
    shifted = F.col("t_s") + F.when(F.col("glider_id") == "G2", 1_000_000_000).otherwise(0)
    raw = l0(spark, sf).filter("glider_id = 'G2' OR seq % 13 <> 2").withColumn("t_s", shifted)
    return rp.verification_issues(flagged.withColumns({v: F.expr(e) for v, e in FAULTS.items()}).drop("n_rows"), raw)


@query(
    "fleet_listing",
    sql("SELECT glider_id, max_depth_dbar, CASE WHEN glider_id = 'G1' THEN 'not processed' ELSE 'processed' END AS status, CASE WHEN glider_id <> 'G1' THEN n_rows END AS n_rows, CASE WHEN glider_id <> 'G1' THEN n_profiles END AS n_profiles, CASE WHEN glider_id <> 'G1' THEN track_km END AS track_km FROM (SELECT glider_id, max(pressure) AS max_depth_dbar FROM cl GROUP BY 1) LEFT JOIN ts USING (glider_id)", SCREENED_CTE, TRACK_CTE),
)
def fleet(spark, sf):
    base = cl.blank_null_island(l0(spark, sf))
    meta = base.groupBy("glider_id").agg(F.max("pressure").alias("max_depth_dbar"))
    return rounded(rp.fleet_listing(meta, rp.track_summary(base.filter("glider_id <> 'G1'"))))
