"""Registered queries: segments of a glider's time axis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import segments as sg
from ..operators.cleaning import blank_null_island
from ..session import table_path
from .common import L0_CTE, SCREENED_CTE, rounded, sql
from .fixture import l0
from .registry import query


@query(
    "ground_distance",
    sql(
        """SELECT glider_id, t_s, round(sum(coalesce(leg, 0)) OVER (PARTITION BY glider_id ORDER BY t_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS distance_over_ground FROM cl LEFT JOIN (
        SELECT glider_id, t_s, sqrt(pow((latitude - lag(latitude) OVER w)*111320, 2) + pow((longitude - lag(longitude) OVER w)*111320*cos(radians(avg(latitude) OVER (PARTITION BY glider_id))), 2)) AS leg
        FROM cl WHERE latitude IS NOT NULL WINDOW w AS (PARTITION BY glider_id ORDER BY t_s)) USING (glider_id, t_s)""",
        SCREENED_CTE,
    ),
)
def distance(spark, sf):
    return rounded(sg.ground_distance(blank_null_island(l0(spark, sf))).select("glider_id", "t_s", "distance_over_ground"), 3)


HOLES = "CASE WHEN seq % 9 < 4 OR seq < 13 THEN NULL ELSE pressure END"


@query(
    "fill_pressure",
    sql(
        """SELECT x.glider_id, x.t_s, round(CASE WHEN x.p IS NOT NULL THEN x.p*10 ELSE 10*a.p + (10*b.p - 10*a.p)*((x.t_s - a.t_s)/CAST(b.t_s - a.t_s AS double)) END + 3e-8, 6) AS pressure_filled, CASE WHEN x.p IS NOT NULL THEN 0 WHEN a.p IS NOT NULL AND b.p IS NOT NULL THEN 8 ELSE 9 END AS pressure_filled_QC
        FROM h x ASOF LEFT JOIN (SELECT * FROM h WHERE p IS NOT NULL) a ON a.glider_id = x.glider_id AND a.t_s < x.t_s ASOF LEFT JOIN (SELECT * FROM h WHERE p IS NOT NULL) b ON b.glider_id = x.glider_id AND b.t_s > x.t_s""",
        L0_CTE, f"h AS (SELECT glider_id, t_s, {HOLES} AS p FROM l0)",
    ),
)
def fill(spark, sf):
    out = sg.fill_pressure(l0(spark, sf).withColumn("pressure", F.expr(HOLES)), 10.0)
    return out.select("glider_id", "t_s", F.round(F.col("pressure_filled") + 3e-8, 6).alias("pressure_filled"), "pressure_filled_QC")


@query(
    "time_gaps",
    sql(
        "SELECT glider_id, a AS gap_start, b AS gap_end, (b - a)/3600.0::DOUBLE AS gap_hours FROM (SELECT glider_id, t_s // 3600 * 3600 AS a, lead(t_s) OVER (PARTITION BY glider_id ORDER BY t_s) // 3600 * 3600 AS b FROM l0) WHERE b - a > 172800"
    ),
)
def gaps(spark, sf):
    return sg.time_gaps(l0(spark, sf))


WIDTHS = {"G0": 6, "G1": 7, "G2": 25}


@query(
    "box_mean",
    sql(
        " UNION ALL ".join(
            f"SELECT glider_id, t_s, round(sum(depth) OVER (PARTITION BY glider_id ORDER BY t_s ROWS BETWEEN {n - 1 - (n - 1) // 2} PRECEDING AND {(n - 1) // 2} FOLLOWING)/{n}.0 + 3e-8, 6) AS depth_mean FROM l0 WHERE glider_id = '{g}'"
            for g, n in WIDTHS.items()
        )
    ),
)
def box(spark, sf):
    width = F.when(F.col("glider_id") == "G0", 6).when(F.col("glider_id") == "G1", 7).otherwise(25)
    out = sg.box_mean(l0(spark, sf).select("glider_id", "t_s", "seq", "depth"), "depth", width, "depth_mean")
    return out.select("glider_id", "t_s", F.round(F.col("depth_mean") + 3e-8, 6).alias("depth_mean"))


@query(
    "time_gradient",
    sql(
        """SELECT glider_id, t_s, round(CASE WHEN t0 IS NULL THEN (v1 - v)/(t1 - t_s) WHEN t1 IS NULL THEN (v - v0)/(t_s - t0)
        ELSE (pow(t_s - t0, 2)*v1 + (pow(t1 - t_s, 2) - pow(t_s - t0, 2))*v - pow(t1 - t_s, 2)*v0)/(CAST(t_s - t0 AS double)*(t1 - t_s)*(t1 - t0)) END, 6) AS slope
        FROM (SELECT glider_id, t_s, salinity AS v, lag(t_s) OVER w AS t0, lead(t_s) OVER w AS t1, lag(salinity) OVER w AS v0, lead(salinity) OVER w AS v1 FROM l0 WINDOW w AS (PARTITION BY glider_id ORDER BY t_s))"""
    ),
)
def gradient(spark, sf):
    return rounded(sg.time_gradient(l0(spark, sf), "salinity", "slope").select("glider_id", "t_s", "slope"))


# greedy starts by recursion over the candidates: the next one 300 s or more after the last start
DETECT_CTE = """f AS (SELECT glider_id, seq, t_s, count(*) OVER (PARTITION BY glider_id) AS n, pressure AS p FROM l0),
dt AS (SELECT glider_id, least(greatest(1, floor(100/greatest(quantile_cont(d, 0.5), 0.1))), floor(max(n)/2)) AS w FROM (SELECT glider_id, n, t_s - lag(t_s) OVER (PARTITION BY glider_id ORDER BY t_s) AS d FROM f) GROUP BY 1),
sm AS (SELECT x.glider_id, x.seq, x.t_s, sum(CAST(y.p AS DECIMAL(20,9)))/max(w) AS s FROM f x JOIN dt USING (glider_id) JOIN f y ON y.glider_id = x.glider_id AND y.seq BETWEEN x.seq - (w - 1 - floor((w - 1)/2)) AND x.seq + floor((w - 1)/2) GROUP BY 1, 2, 3),
gr AS (SELECT glider_id, seq, t_s, CAST(sign(CASE WHEN t0 IS NULL THEN s1 - s WHEN t1 IS NULL THEN s - s0 ELSE pow(t_s - t0, 2)*s1 + (pow(t1 - t_s, 2) - pow(t_s - t0, 2))*s - pow(t1 - t_s, 2)*s0 END) AS INT) AS dir FROM
  (SELECT *, lag(t_s) OVER w AS t0, lead(t_s) OVER w AS t1, lag(s) OVER w AS s0, lead(s) OVER w AS s1 FROM sm WINDOW w AS (PARTITION BY glider_id ORDER BY seq))),
cd AS (SELECT glider_id, seq, t_s FROM (SELECT *, lag(dir) OVER (PARTITION BY glider_id ORDER BY seq) AS pd FROM gr) WHERE dir <> pd AND dir <> 0),
ch AS (SELECT glider_id, 0 AS seq, min(t_s) AS t_s FROM l0 GROUP BY 1 UNION ALL SELECT c.glider_id, c.seq, c.t_s FROM ch JOIN LATERAL (SELECT * FROM cd WHERE cd.glider_id = ch.glider_id AND cd.t_s >= ch.t_s + 300 ORDER BY cd.t_s LIMIT 1) c ON true)"""


@query(
    "detect_profiles",
    "WITH RECURSIVE " + L0_CTE + ", " + DETECT_CTE + " SELECT glider_id, t_s, CAST(sum(CASE WHEN ch.seq > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY glider_id ORDER BY t_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS profile_index, dir AS profile_direction FROM gr LEFT JOIN ch USING (glider_id, seq, t_s)",
)
def detect(spark, sf):
    return sg.detect_profiles(l0(spark, sf)).select("glider_id", "t_s", "profile_index", "profile_direction")


ENGINE = "CASE WHEN seq % 6 = 1 THEN CASE WHEN seq % 40 < 3 THEN 0.0 ELSE pitch*8 END END"
PHASE_CTE = f"""en AS (SELECT *, {ENGINE} AS v FROM l0),
ep AS (SELECT x.* EXCLUDE (v), CASE WHEN z > 0 THEN 4 WHEN z < 0 THEN 1 ELSE -128 END AS phase FROM (SELECT x.*, CASE WHEN x.v IS NOT NULL THEN x.v ELSE a.v + (b.v - a.v)*((x.t_s - a.t_s)/CAST(b.t_s - a.t_s AS double)) END AS z
  FROM en x ASOF LEFT JOIN (SELECT * FROM en WHERE v IS NOT NULL) a ON a.glider_id = x.glider_id AND a.t_s < x.t_s ASOF LEFT JOIN (SELECT * FROM en WHERE v IS NOT NULL) b ON b.glider_id = x.glider_id AND b.t_s > x.t_s) x),
ph AS (SELECT *, CAST(1 + sum(ch) OVER (PARTITION BY glider_id ORDER BY t_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS phase_number FROM (SELECT *, CASE WHEN phase <> lag(phase) OVER (PARTITION BY glider_id ORDER BY t_s) THEN 1 ELSE 0 END AS ch FROM ep))"""


def phased(spark, sf):
    return sg.buoyancy_phase(l0(spark, sf).withColumn("buoyancy", F.expr(ENGINE)))


@query("buoyancy_phase", sql("SELECT glider_id, t_s, phase, phase_number FROM ph", L0_CTE, PHASE_CTE))
def phase(spark, sf):
    return phased(spark, sf).select("glider_id", "t_s", "phase", "phase_number")


@query(
    "number_phases",
    sql(
        "SELECT glider_id, t_s, CAST(sum(ch) OVER (PARTITION BY glider_id ORDER BY t_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS phase_number FROM (SELECT *, CASE WHEN profile_direction <> lag(profile_direction) OVER (PARTITION BY glider_id ORDER BY t_s) THEN 1 ELSE 0 END AS ch FROM l0)"
    ),
)
def numbered(spark, sf):
    return sg.number_phases(l0(spark, sf), "profile_direction").select("glider_id", "t_s", "phase_number")


@query(
    "extract_profiles",
    sql(
        """SELECT glider_id, row_number() OVER (PARTITION BY glider_id ORDER BY phase_number) AS profile_number, phase_number, CASE WHEN phase = 1 THEN 'D' ELSE 'A' END AS direction, max_pressure, levels, t_first, t_last FROM (
        SELECT glider_id, phase_number, phase, max(pressure) AS max_pressure, count(*) AS levels, min(t_s) AS t_first, max(t_s) AS t_last FROM ph WHERE phase IN (1, 4) GROUP BY 1, 2, 3) WHERE max_pressure >= 300""",
        L0_CTE, PHASE_CTE,
    ),
)
def profiles(spark, sf):
    return sg.extract_profiles(phased(spark, sf), 300.0)


@query(
    "gps_fixes",
    sql(
        "SELECT glider_id, min(t_s) AS t_s, arg_min(latitude, t_s) AS latitude, arg_min(longitude, t_s) AS longitude FROM cl WHERE latitude IS NOT NULL AND glider_id <> 'G1' GROUP BY glider_id, profile_index UNION ALL SELECT glider_id, t_s, latitude, longitude FROM cl WHERE latitude IS NOT NULL AND glider_id = 'G1'",
        SCREENED_CTE,
    ),
)
def fixes(spark, sf):
    base = blank_null_island(l0(spark, sf)).withColumn("profile_index", F.when(F.col("glider_id") != "G1", F.col("profile_index")))
    return sg.gps_fixes(base)


@query("time_in_profile", sql("SELECT glider_id, t_s, round((t_s - avg(t_s) OVER (PARTITION BY glider_id, profile_index))/86400.0, 9) AS mtime FROM l0"))
def mtime(spark, sf):
    return rounded(sg.time_in_profile(l0(spark, sf)).select("glider_id", "t_s", "mtime"), 9)


LINE_CTE = "sl AS (SELECT glider_id, phase, phase_number, t_s, longitude, latitude, row_number() OVER p - 1 AS position FROM (SELECT * REPLACE (CASE WHEN seq % 3 < 2 THEN 12.0 + 0.001*seq END AS latitude, 70.0 + 0.001*seq AS longitude) FROM ph) WHERE latitude IS NOT NULL WINDOW p AS (PARTITION BY glider_id, phase, phase_number ORDER BY t_s))"


def line_points(spark, sf):
    base = phased(spark, sf).withColumns(
        {"latitude": F.when(F.col("seq") % 3 < 2, 12.0 + 0.001 * F.col("seq")), "longitude": 70.0 + 0.001 * F.col("seq")}
    )
    return sg.segment_lines(base)


@query(
    "segment_lines",
    sql("SELECT glider_id, phase, phase_number, position, t_s, round(longitude::DOUBLE, 6) AS longitude, round(latitude::DOUBLE, 6) AS latitude FROM sl", L0_CTE, PHASE_CTE, LINE_CTE),
)
def lines(spark, sf):
    return rounded(line_points(spark, sf).select("glider_id", "phase", "phase_number", "position", "t_s", "longitude", "latitude"))


@query(
    "segment_summary",
    sql("SELECT glider_id, phase, phase_number, min(t_s) AS t_first, max(t_s) AS t_last, count(*) AS n_points FROM sl GROUP BY 1, 2, 3", L0_CTE, PHASE_CTE, LINE_CTE),
)
def line_summary(spark, sf):
    return sg.segment_summary(line_points(spark, sf))


@query("detect_phases")
def phases(spark, sf):
    from ..operators.phases import detect_phases

    return detect_phases(l0(spark, sf).select("glider_id", "t_s", "seq", "pressure"))


@query("detect_phases_by_duration")
def phases_by_duration(spark, sf):
    """Tested against plain loops (tests/test_phases_by_duration.py)."""
    from ..operators.phases import detect_phases

    return detect_phases(l0(spark, sf).select("glider_id", "t_s", "seq", "pressure"), by_duration=True)


FEATURE_BASE = "fb AS (SELECT * REPLACE (CASE WHEN seq % 3 < 2 THEN 12.0 + 0.001*seq END AS latitude, 70.0 + 0.001*seq AS longitude) FROM ph)"


@query(
    "trajectory_features",
    sql(
        """SELECT glider_id, 'line' AS feature, phase, phase_number, NULL::BIGINT AS profile_index, position, min(t_s) OVER w AS t_first, max(t_s) OVER w AS t_last, t_s::DOUBLE AS t_s, round(longitude::DOUBLE, 6) AS longitude, round(latitude::DOUBLE, 6) AS latitude FROM sl WINDOW w AS (PARTITION BY glider_id, phase, phase_number)
        UNION ALL SELECT glider_id, 'gps', NULL, NULL, NULL, row_number() OVER (PARTITION BY glider_id ORDER BY t) - 1, t, t, t::DOUBLE, round(lo::DOUBLE, 6), round(la::DOUBLE, 6) FROM (SELECT glider_id, min(t_s) AS t, arg_min(latitude, t_s) AS la, arg_min(longitude, t_s) AS lo FROM fb WHERE latitude IS NOT NULL GROUP BY glider_id, profile_index)
        UNION ALL SELECT glider_id, 'profile', NULL, NULL, profile_index, 0, a, b, round(mt, 6), round(pt.lo::DOUBLE, 6), round(pt.la::DOUBLE, 6) FROM (SELECT glider_id, profile_index, a, b, mt, arg_min({'la': latitude, 'lo': longitude}, (abs(t_s - mt), t_s)) AS pt FROM fb JOIN (SELECT glider_id, profile_index, min(t_s) AS a, max(t_s) AS b, avg(t_s) AS mt FROM fb GROUP BY 1, 2) USING (glider_id, profile_index) WHERE latitude IS NOT NULL GROUP BY 1, 2, 3, 4, 5)""",
        L0_CTE, PHASE_CTE, LINE_CTE, FEATURE_BASE,
    ),
)
def features(spark, sf):
    base = phased(spark, sf).withColumns(
        {"latitude": F.when(F.col("seq") % 3 < 2, 12.0 + 0.001 * F.col("seq")), "longitude": 70.0 + 0.001 * F.col("seq")}
    )
    path = table_path(spark)
    sg.write_features(sg.trajectory_features(base), path)
    return rounded(spark.read.parquet(path))
