"""Registered queries: cleaning, order, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators.ordered import number_by_time
from .common import L0_CTE, SIZED_CTE, r, rounded, sized, sql
from .fixture import l0
from .registry import query

KEYS = "glider_id, t_s"

# one deployment row per glider: open at one end for one of them
DEPLOYMENT_SQL = """dep AS (SELECT glider_id, CASE WHEN glider_id <> 'G1' THEN min(t_s) + 600 END AS "start",
  CASE WHEN glider_id <> 'G2' THEN max(t_s) - 900 END AS "end", 1000.0 AS max_depth_dbar FROM l0 GROUP BY 1)"""


def deployment(base):
    return base.groupBy("glider_id").agg(
        F.when(F.col("glider_id") != "G1", F.min("t_s") + 600).alias("start"),
        F.when(F.col("glider_id") != "G2", F.max("t_s") - 900).alias("end"),
        F.lit(1000.0).alias("max_depth_dbar"),
    )


@query(
    "clean_time_crop",
    sql(
        'SELECT glider_id, t_s FROM l0 JOIN dep USING (glider_id) WHERE coalesce(t_s >= "start", true) AND coalesce(t_s <= "end", true)',
        L0_CTE, DEPLOYMENT_SQL,
    ),
)
def time_crop(spark, sf):
    base = l0(spark, sf)
    return cl.crop_time(base, deployment(base)).select("glider_id", "t_s")


WAY = "waypoint_latitude > 40 AND waypoint_latitude < 43 AND waypoint_longitude > -72 AND waypoint_longitude < -69"


@query(
    "clean_factory_box",
    sql(
        f"SELECT glider_id, t_s, waypoint_latitude, waypoint_longitude FROM l0 WHERE NOT coalesce({WAY}, false)",
    ),
)
def factory_box(spark, sf):
    # the waypoint plays the position: only it enters the box in this data
    base = l0(spark, sf).select(
        "glider_id", "t_s", F.col("waypoint_latitude").alias("latitude"), F.col("waypoint_longitude").alias("longitude")
    )
    return cl.drop_factory_box(base).withColumnsRenamed(
        {"latitude": "waypoint_latitude", "longitude": "waypoint_longitude"}
    )


@query(
    "clean_null_island",
    sql(
        "SELECT glider_id, t_s, CASE WHEN latitude = 0 AND longitude = 0 THEN NULL ELSE latitude END AS latitude, "
        "CASE WHEN latitude = 0 AND longitude = 0 THEN NULL ELSE longitude END AS longitude FROM l0"
    ),
)
def null_island(spark, sf):
    return cl.blank_null_island(l0(spark, sf)).select("glider_id", "t_s", "latitude", "longitude")


@query(
    "clean_waypoint_box",
    sql(
        f"SELECT glider_id, t_s, CASE WHEN {WAY} THEN NULL ELSE waypoint_latitude END AS waypoint_latitude, "
        f"CASE WHEN {WAY} THEN NULL ELSE waypoint_longitude END AS waypoint_longitude FROM l0"
    ),
)
def waypoint_box(spark, sf):
    return cl.blank_factory_waypoints(l0(spark, sf)).select("glider_id", "t_s", "waypoint_latitude", "waypoint_longitude")


@query(
    "clean_absurd_temperature",
    sql("SELECT glider_id, t_s, round(CASE WHEN temperature < -2.5 OR temperature > 35 THEN NULL ELSE temperature END, 6) AS temperature FROM l0"),
)
def absurd_temperature(spark, sf):
    return cl.blank_absurd_temperature(l0(spark, sf)).select("glider_id", "t_s", r("temperature").alias("temperature"))


# the series spread over several years: 40 days of steps become years
YEARS_SQL = "yr AS (SELECT * REPLACE (t_s + (profile_index % 5)*31536000 AS t_s) FROM l0)"


@query(
    "clean_modal_year",
    sql(
        """SELECT glider_id, t_s, seq FROM (SELECT *, year(make_timestamp(t_s*1000000)) AS y FROM yr)
        JOIN (SELECT glider_id, y AS m FROM (SELECT glider_id, y, row_number() OVER (PARTITION BY glider_id ORDER BY n DESC, y) AS k
          FROM (SELECT glider_id, year(make_timestamp(t_s*1000000)) AS y, count(*) AS n FROM yr GROUP BY 1, 2)) WHERE k = 1)
        USING (glider_id) WHERE y = m OR y = m - 1""",
        L0_CTE, YEARS_SQL,
    ),
)
def modal_year(spark, sf):
    base = l0(spark, sf).withColumn("t_s", F.col("t_s") + (F.col("profile_index") % 5) * 31_536_000)
    return cl.keep_modal_years(base).select("glider_id", "t_s", "seq")


@query(
    "clean_hemisphere",
    sql(
        """SELECT glider_id, t_s, latitude FROM hs JOIN (SELECT glider_id, quantile_cont(latitude, 0.5) AS m FROM hs GROUP BY 1) USING (glider_id)
        WHERE NOT coalesce(abs(m) >= 10 AND latitude * m < 0, false)""",
        L0_CTE, "hs AS (SELECT * REPLACE (CASE WHEN seq % 9 = 0 THEN -latitude ELSE latitude END AS latitude) FROM l0 WHERE latitude IS NULL OR latitude <> 0)",
    ),
)
def hemisphere(spark, sf):
    base = l0(spark, sf).filter("latitude IS NULL OR latitude <> 0").withColumn(
        "latitude", F.when(F.col("seq") % 9 == 0, -F.col("latitude")).otherwise(F.col("latitude"))
    )
    return cl.drop_wrong_hemisphere(base).select("glider_id", "t_s", "latitude")


SHALLOW_SQL = "sh AS (SELECT * REPLACE (CASE WHEN profile_index < 6 THEN depth/20.0 ELSE depth END AS depth) FROM l0)"


@query(
    "clean_test_dives",
    sql(
        """SELECT glider_id, t_s FROM sh LEFT JOIN strip USING (glider_id) WHERE NOT coalesce(profile_index < first_deep, false)""",
        L0_CTE, SHALLOW_SQL,
        """pr AS (SELECT glider_id, profile_index, coalesce(max(depth), 0.0) AS d FROM sh GROUP BY 1, 2),
        rl AS (SELECT glider_id, quantile_cont(d, 0.75) AS q, count(*) AS n FROM pr GROUP BY 1),
        fd AS (SELECT glider_id, q, min(profile_index) FILTER (WHERE d >= 0.5*q) AS first_deep FROM pr JOIN rl USING (glider_id) WHERE n >= 5 AND q >= 20 GROUP BY 1, 2),
        strip AS (SELECT glider_id, first_deep FROM pr JOIN fd USING (glider_id) WHERE profile_index < first_deep GROUP BY 1, 2, q
          HAVING avg(CASE WHEN d < greatest(least(q*0.2, q - 10), 5) THEN 1.0 ELSE 0.0 END) >= 0.7)""",
    ),
)
def test_dives(spark, sf):
    base = l0(spark, sf).withColumn("depth", F.when(F.col("profile_index") < 6, F.col("depth") / 20.0).otherwise(F.col("depth")))
    return cl.strip_test_dives(base).select("glider_id", "t_s")


MISMAP_SQL = "mm AS (SELECT * REPLACE (CASE WHEN glider_id = 'G1' AND seq % 4 < 3 AND chlorophyll IS NOT NULL THEN pressure ELSE chlorophyll END AS chlorophyll) FROM l0)"


def mismapped(spark, sf):
    swap = (F.col("glider_id") == "G1") & (F.col("seq") % 4 < 3) & F.col("chlorophyll").isNotNull()
    return l0(spark, sf).withColumn("chlorophyll", F.when(swap, F.col("pressure")).otherwise(F.col("chlorophyll")))


LIKE_SQL = """lk AS (SELECT glider_id, variable, count(*) AS n, round(avg(CASE WHEN abs(v - pressure) < 1e-3 THEN 1.0 ELSE 0.0 END), 6) AS share_identical,
  round(min(v), 6) AS v_min, round(max(v), 6) AS v_max, round(corr(v, pressure), 6) AS corr FROM (
  SELECT glider_id, pressure, 'chlorophyll' AS variable, chlorophyll AS v FROM mm UNION ALL SELECT glider_id, pressure, 'cdom', cdom FROM mm
  UNION ALL SELECT glider_id, pressure, 'backscatter_700', backscatter_700 FROM mm) WHERE v IS NOT NULL AND pressure IS NOT NULL GROUP BY 1, 2),
  lq AS (SELECT *, n >= 100 AND (share_identical > 0.5 OR (share_identical > 0.1 AND v_max > 10 AND v_min >= -2 AND v_max - v_min > 50)) AS corrupted FROM lk)"""


@query("clean_channel_likeness", sql("SELECT * FROM lq", L0_CTE, MISMAP_SQL, LIKE_SQL))
def channel_likeness(spark, sf):
    return rounded(cl.channel_likeness(mismapped(spark, sf)))


@query(
    "clean_mismapped_channel",
    sql(
        "SELECT glider_id, t_s, "
        + ", ".join(
            f"round(CASE WHEN (SELECT bool_or(corrupted) FROM lq WHERE lq.glider_id = mm.glider_id AND variable = '{v}') THEN NULL ELSE {v} END, 6) AS {v}"
            for v in cl.OPTICS
        )
        + " FROM mm",
        L0_CTE, MISMAP_SQL, LIKE_SQL,
    ),
)
def mismapped_channel(spark, sf):
    return rounded(cl.blank_mismapped_channels(mismapped(spark, sf)).select("glider_id", "t_s", *cl.OPTICS))


@query(
    "clean_chain",
    sql(
        """SELECT glider_id, t_s, row_number() OVER (PARTITION BY glider_id ORDER BY t_s) - 1 AS seq, latitude, round(temperature, 6) AS temperature,
        waypoint_latitude FROM c2 LEFT JOIN strip USING (glider_id) WHERE NOT coalesce(profile_index < first_deep, false)""",
        L0_CTE, SHALLOW_SQL.replace("sh AS", "s0 AS"),
        f"""c0 AS (SELECT * REPLACE (CASE WHEN latitude = 0 AND longitude = 0 THEN NULL ELSE latitude END AS latitude,
          CASE WHEN latitude = 0 AND longitude = 0 THEN NULL ELSE longitude END AS longitude,
          CASE WHEN {WAY} THEN NULL ELSE waypoint_latitude END AS waypoint_latitude,
          CASE WHEN temperature < -2.5 OR temperature > 35 THEN NULL ELSE temperature END AS temperature) FROM s0),
        sh AS (SELECT c0.* FROM c0 JOIN (SELECT glider_id, y AS m FROM (SELECT glider_id, y, row_number() OVER (PARTITION BY glider_id ORDER BY n DESC, y) AS k
          FROM (SELECT glider_id, year(make_timestamp(t_s*1000000)) AS y, count(*) AS n FROM c0 GROUP BY 1, 2)) WHERE k = 1) USING (glider_id)
          WHERE year(make_timestamp(t_s*1000000)) IN (m, m - 1)), c2 AS (SELECT * FROM sh),
        pr AS (SELECT glider_id, profile_index, coalesce(max(depth), 0.0) AS d FROM sh GROUP BY 1, 2),
        rl AS (SELECT glider_id, quantile_cont(d, 0.75) AS q, count(*) AS n FROM pr GROUP BY 1),
        fd AS (SELECT glider_id, q, min(profile_index) FILTER (WHERE d >= 0.5*q) AS first_deep FROM pr JOIN rl USING (glider_id) WHERE n >= 5 AND q >= 20 GROUP BY 1, 2),
        strip AS (SELECT glider_id, first_deep FROM pr JOIN fd USING (glider_id) WHERE profile_index < first_deep GROUP BY 1, 2, q
          HAVING avg(CASE WHEN d < greatest(least(q*0.2, q - 10), 5) THEN 1.0 ELSE 0.0 END) >= 0.7)""",
    ),
)
def chain(spark, sf):
    base = l0(spark, sf).withColumn("depth", F.when(F.col("profile_index") < 6, F.col("depth") / 20.0).otherwise(F.col("depth")))
    return cl.pre_clean(base).select("glider_id", "t_s", "seq", "latitude", r("temperature").alias("temperature"), "waypoint_latitude")


# -- sensor streams ------------------------------------------------------------------------
RAW_SQL = """raw AS (SELECT glider_id, t_s + 0.5 AS t, 'latitude' AS sensor, latitude + CASE WHEN seq % 1000 = 0 THEN 40.0 ELSE 0.0 END AS v FROM l0
 UNION ALL SELECT glider_id, t_s + 0.5, 'longitude', longitude FROM l0
 UNION ALL SELECT glider_id, CAST(t_s AS double), 'temperature', temperature FROM l0
 UNION ALL SELECT glider_id, CAST(t_s AS double), 'conductivity', conductivity*2 FROM l0
 UNION ALL SELECT glider_id, CAST(t_s AS double), 'pressure', pressure/10.0 FROM l0
 UNION ALL SELECT glider_id, t_s + 3.0, 'oxygen', oxygen_concentration FROM l0 WHERE seq % 4 = 1 AND seq % 400 < 300)"""


def sensor_raw(spark, sf):
    """Ragged sensor streams: one row per (glider, sensor, t)."""
    t = F.col("t_s").cast("double")
    oxygen = F.when((F.col("seq") % 4 == 1) & (F.col("seq") % 400 < 300), F.col("oxygen_concentration"))
    jump = F.when(F.col("seq") % 1000 == 0, 40.0).otherwise(0.0)
    parts = [
        (t + 0.5, "latitude", F.col("latitude") + jump),
        (t + 0.5, "longitude", F.col("longitude")),
        (t, "temperature", F.col("temperature")),
        (t, "conductivity", F.col("conductivity") * 2),
        (t, "pressure", F.col("pressure") / 10.0),
        (t + 3.0, "oxygen", oxygen),
    ]
    structs = F.array(*[F.struct(tt.alias("t"), F.lit(s).alias("sensor"), v.alias("v")) for tt, s, v in parts])
    return l0(spark, sf).select("glider_id", F.explode(structs).alias("x")).select("glider_id", "x.*").filter("v IS NOT NULL")


RAW = (L0_CTE, "raw AS (SELECT * FROM (" + RAW_SQL[len("raw AS (") : -1] + ") WHERE v IS NOT NULL)")


@query(
    "gps_stream_filter",
    sql(
        """SELECT glider_id, t, sensor, round(v, 6) AS v FROM g JOIN s USING (glider_id, sensor)
        WHERE n < 50 OR v BETWEEN q1 - w AND q3 + w""",
        *RAW,
        """g AS (SELECT * FROM raw WHERE sensor IN ('latitude', 'longitude') AND abs(v) > 0.01 AND abs(v) < CASE sensor WHEN 'latitude' THEN 90 ELSE 180 END),
        s AS (SELECT *, CASE WHEN q3 - q1 < 0.1 THEN 5.0 ELSE 5.0*(q3 - q1) END AS w FROM (SELECT glider_id, sensor, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM g GROUP BY 1, 2))""",
    ),
)
def gps_filter(spark, sf):
    return cl.filter_gps(sensor_raw(spark, sf)).select("glider_id", "t", "sensor", r("v").alias("v"))


@query(
    "science_stream_filter",
    sql(
        """SELECT glider_id, t, sensor, round(v, 6) AS v FROM raw WHERE CASE sensor WHEN 'temperature' THEN v >= -2 AND v <= 40
        WHEN 'conductivity' THEN v >= 0.005 AND v < 10 WHEN 'pressure' THEN v >= -0.2 AND v < 200 ELSE true END""",
        *RAW,
    ),
)
def science_filter(spark, sf):
    return cl.filter_science(sensor_raw(spark, sf)).select("glider_id", "t", "sensor", r("v").alias("v"))


@query(
    "clean_valid_years",
    sql(
        """SELECT glider_id, t_s FROM (SELECT glider_id, t_s + (profile_index % 9 - 6)*157680000 AS t_s FROM l0)
        WHERE year(make_timestamp(t_s*1000000)) BETWEEN 2000 AND 2035"""
    ),
)
def valid_years(spark, sf):
    base = l0(spark, sf).select("glider_id", (F.col("t_s") + (F.col("profile_index") % 9 - 6) * 157_680_000).alias("t_s"))
    return cl.keep_valid_years(base, t="t_s")


@query(
    "clean_deployment_window",
    sql(
        'SELECT glider_id, t FROM (SELECT glider_id, t_s + (seq % 41 - 20)*86400 AS t FROM l0) JOIN dep USING (glider_id) '
        'WHERE coalesce(t >= "start" - 604800, true) AND coalesce(t <= "end" + 604800, true)',
        L0_CTE, DEPLOYMENT_SQL,
    ),
)
def deployment_window(spark, sf):
    base = l0(spark, sf)
    shifted = base.select("glider_id", (F.col("t_s") + (F.col("seq") % 41 - 20) * 86_400).alias("t"))
    return cl.keep_deployment_window(shifted, deployment(base))


# -- decoder clean-up ---------------------------------------------------------------------------
SENT = "CASE WHEN seq % 50 = 7 THEN 9999.0 WHEN seq % 50 = 9 THEN -9999.0 ELSE {0} END"


@query(
    "decode_sentinels",
    sql(
        "SELECT glider_id, t_s, "
        + ", ".join(f"round(CASE WHEN abs({SENT.format(c)}) = 9999 THEN NULL ELSE {c} END, 6) AS {c}" for c in ("temperature", "salinity"))
        + " FROM l0 WHERE NOT coalesce(latitude = 0 AND longitude = 0, false)"
    ),
)
def sentinels(spark, sf):
    base = l0(spark, sf).withColumns({c: F.expr(SENT.format(c)) for c in ("temperature", "salinity")})
    out = cl.drop_zero_fixes(cl.blank_sentinels(base, ["temperature", "salinity"]))
    return rounded(out.select("glider_id", "t_s", "temperature", "salinity"))


HALF = "CASE WHEN seq % 80 = 0 THEN NULL ELSE longitude END"


@query(
    "decode_half_positions",
    sql(
        f"SELECT glider_id, t_s, CASE WHEN lon IS NULL THEN NULL ELSE latitude END AS latitude, CASE WHEN latitude IS NULL THEN NULL ELSE lon END AS longitude FROM (SELECT *, {HALF} AS lon FROM l0)"
    ),
)
def half_positions(spark, sf):
    base = l0(spark, sf).withColumn("longitude", F.expr(HALF))
    return cl.blank_half_positions(base).select("glider_id", "t_s", "latitude", "longitude")


GAPPED = "t_s + CASE WHEN seq >= floor(0.06*CAST(n_rows AS DOUBLE)) THEN 20000000 ELSE 0 END + CASE WHEN seq >= floor(0.18*CAST(n_rows AS DOUBLE)) AND glider_id = 'G2' THEN 20000000 ELSE 0 END"


@query(
    "decode_pre_deployment_block",
    sql(
        """SELECT glider_id, t_s FROM g LEFT JOIN (SELECT glider_id, max(t_s) AS resume FROM
        (SELECT *, t_s - lag(t_s) OVER (PARTITION BY glider_id ORDER BY t_s) AS gap FROM g) WHERE gap > 15768000 GROUP BY 1 HAVING count(*) = 1) USING (glider_id)
        WHERE resume IS NULL OR t_s >= resume""",
        L0_CTE, SIZED_CTE, f"g AS (SELECT glider_id, {GAPPED} AS t_s FROM sz)",
    ),
)
def pre_deployment(spark, sf):
    base = sized(l0(spark, sf)).select("glider_id", "seq", F.expr(GAPPED).alias("t_s"))
    return cl.drop_before_deployment(base).select("glider_id", "t_s")


@query("decode_empty_rows", sql("SELECT glider_id, t_s FROM l0 WHERE t_s IS NOT NULL AND coalesce(temperature, chlorophyll, cdom) IS NOT NULL"))
def empty_rows(spark, sf):
    return cl.drop_empty_rows(l0(spark, sf), ["temperature", "chlorophyll", "cdom"]).select("glider_id", "t_s")


OTHER_NAMES = {n: (v, cl.DISPLAY_RANGE[v]) for v, names in cl.DISPLAY_NAMES.items() for n in names}


@query(
    "display_range_clamp",
    sql(
        "SELECT glider_id, t_s, "
        + ", ".join(f"round(CASE WHEN {v} BETWEEN {lo} AND {hi} THEN {v} END, 6) AS {v}" for v, (lo, hi) in cl.DISPLAY_RANGE.items())
        + ", " + ", ".join(f"round(CASE WHEN seq % 7 <> 2 AND {v} BETWEEN {lo} AND {hi} THEN {v} END, 6) AS {n}" for n, (v, (lo, hi)) in OTHER_NAMES.items())
        + " FROM l0"
    ),
)
def display_clamp(spark, sf):
    # the other names hold a fill value in every seventh row
    base = l0(spark, sf).withColumns({n: F.when(F.col("seq") % 7 == 2, -9999.0).otherwise(F.col(v)) for n, (v, _) in OTHER_NAMES.items()})
    return rounded(cl.clamp_display_range(base).select("glider_id", "t_s", *cl.DISPLAY_RANGE, *OTHER_NAMES))


@query(
    "uncalibrated_channels",
    sql(
        "SELECT *, v_max > plausible_max AS uncalibrated FROM ("
        + " UNION ALL ".join(f"SELECT glider_id, '{v}' AS variable, round(max({v}), 6) AS v_max, CAST({m} AS DOUBLE) AS plausible_max FROM l0 GROUP BY 1" for v, m in cl.PLAUSIBLE_MAX.items())
        + ")"
    ),
)
def uncalibrated(spark, sf):
    return rounded(cl.uncalibrated_channels(l0(spark, sf)))


OIL = "CASE WHEN glider_id = 'G0' AND seq % 3 = 0 THEN pitch*8 END"


@query(
    "pick_buoyancy_source",
    sql(f"SELECT glider_id, t_s, round(CASE WHEN glider_id = 'G0' THEN {OIL} ELSE pitch*5 END, 6) AS buoyancy FROM l0"),
)
def buoyancy(spark, sf):
    base = l0(spark, sf).withColumns({"oil_volume": F.expr(OIL), "ballast": F.col("pitch") * 5})
    return rounded(cl.pick_buoyancy(base).select("glider_id", "t_s", "buoyancy"))


# -- order and duplicates -----------------------------------------------------------------------
@query("order_chronological", sql("SELECT glider_id, t_s, row_number() OVER (PARTITION BY glider_id ORDER BY t_s) - 1 AS seq FROM l0"))
def chronological(spark, sf):
    return number_by_time(cl.chronological(l0(spark, sf)).drop("seq")).select("glider_id", "t_s", "seq")


DUP = "t_s - CASE WHEN seq % 10 IN (3, 4) THEN 15*(seq % 10 - 2) ELSE 0 END"
for keep, order in (("first", "ASC"), ("last", "DESC")):

    @query(
        f"dedupe_time_{keep}",
        sql(
            f"SELECT glider_id, t_s, row_id, pressure FROM (SELECT *, row_number() OVER (PARTITION BY glider_id, t_s ORDER BY row_id {order}) AS k FROM (SELECT glider_id, {DUP} AS t_s, seq AS row_id, pressure FROM l0)) WHERE k = 1"
        ),
    )
    def dedupe(spark, sf, keep=keep):
        base = l0(spark, sf).select("glider_id", F.expr(DUP).alias("t_s"), F.col("seq").alias("row_id"), "pressure")
        return cl.dedupe_time(base, keep)


NEAR = "t_s + CASE WHEN seq % 6 = 2 THEN -14.995 ELSE 0.0 END"


@query(
    "drop_near_duplicates",
    sql(
        f"SELECT glider_id, t FROM (SELECT glider_id, t, t - lag(t) OVER (PARTITION BY glider_id ORDER BY t) AS d FROM (SELECT glider_id, CAST({NEAR} AS DOUBLE) AS t FROM l0)) WHERE NOT coalesce(d <= 0.01, false)"
    ),
)
def near_duplicates(spark, sf):
    return cl.drop_near_duplicates(l0(spark, sf).select("glider_id", F.expr(NEAR).cast("double").alias("t")))


@query(
    "distinct_fixes",
    sql(
        "SELECT glider_id, trunc(latitude*1000)/1000.0 AS latitude, trunc(longitude*1000)/1000.0 AS longitude, min(t_s) AS t_s FROM (SELECT glider_id, t_s, latitude + 0.0004 AS latitude, -longitude - 0.0004 AS longitude FROM l0 WHERE latitude IS NOT NULL AND longitude IS NOT NULL) GROUP BY 1, 2, 3"
    ),
)
def fixes(spark, sf):
    base = l0(spark, sf).withColumns({"latitude": F.col("latitude") + 0.0004, "longitude": -F.col("longitude") - 0.0004})
    return cl.distinct_fixes(base)


SOURCE = "concat('load_', CAST(profile_index % 4 AS {0}))"


@query(
    "largest_source",
    sql(
        f"""SELECT glider_id, t_s, source_file FROM s JOIN (SELECT glider_id, source_file FROM (SELECT glider_id, source_file, row_number() OVER (PARTITION BY glider_id ORDER BY count(*) DESC, source_file) AS k FROM s GROUP BY 1, 2) WHERE k = 1) USING (glider_id, source_file)""",
        L0_CTE, f"s AS (SELECT glider_id, t_s, {SOURCE.format('varchar')} AS source_file FROM l0)",
    ),
)
def largest(spark, sf):
    base = l0(spark, sf).select("glider_id", "t_s", F.expr(SOURCE.format("string")).alias("source_file"))
    return cl.largest_source(base)
