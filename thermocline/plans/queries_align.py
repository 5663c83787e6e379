"""Registered queries: joins on time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align as al
from .common import L0_CTE, SIZED_CTE, rounded, sized, sql
from .fixture import l0
from .queries_cleaning import RAW, sensor_raw
from .registry import query


def left_right(spark, sf):
    """Two versions of the series that overlap: the second lacks some stamps and has others."""
    base = l0(spark, sf)
    right = base.filter("seq % 7 <> 3").withColumns(
        {"t_s": F.col("t_s") + F.when(F.col("seq") % 11 == 5, 1).otherwise(0), "temperature": F.col("temperature") + 0.5}
    )
    return base.select("glider_id", "t_s", "temperature"), right.select("glider_id", "t_s", "temperature")


LR = (L0_CTE, "rt AS (SELECT glider_id, t_s + CASE WHEN seq % 11 = 5 THEN 1 ELSE 0 END AS t_s, temperature + 0.5 AS temperature FROM l0 WHERE seq % 7 <> 3)")
SIDE = "CASE WHEN b.glider_id IS NULL THEN 'left' WHEN a.glider_id IS NULL THEN 'right' ELSE 'both' END"


@query(
    "align_full_outer",
    sql(f"SELECT glider_id, t_s, round(a.temperature, 6) AS temperature_l0, round(b.temperature, 6) AS temperature_l1, {SIDE} AS side FROM l0 a FULL JOIN rt b USING (glider_id, t_s)", *LR),
)
def full_outer(spark, sf):
    return rounded(al.full_time_join(*left_right(spark, sf)))


@query("align_side_counts", sql(f"SELECT glider_id, {SIDE} AS side, count(*) AS n FROM l0 a FULL JOIN rt b USING (glider_id, t_s) GROUP BY 1, 2", *LR))
def counts(spark, sf):
    return al.side_counts(al.full_time_join(*left_right(spark, sf)))


@query("align_matched", sql("SELECT glider_id, t_s, round(a.temperature, 6) AS temperature_l0, round(b.temperature, 6) AS temperature_l1 FROM l0 a JOIN rt b USING (glider_id, t_s)", *LR))
def matched(spark, sf):
    return rounded(al.matched(*left_right(spark, sf), ["temperature"]))


@query(
    "stamp_sets",
    sql("SELECT glider_id, t_s, CASE WHEN b.glider_id IS NULL THEN 'only_left' WHEN a.glider_id IS NULL THEN 'only_right' ELSE 'both' END AS member FROM l0 a FULL JOIN rt b USING (glider_id, t_s)", *LR),
)
def sets(spark, sf):
    return al.stamp_sets(*left_right(spark, sf))


CLOCKS = ("CAST(t_s AS DOUBLE) + 0.25", "t_s + CASE WHEN seq % 5 = 2 THEN 1.0 ELSE 0.125 END")
for whole in (True, False):
    key = "floor({0} + 0.5)" if whole else "{0}"

    @query(
        f"join_clocks_{'whole_seconds' if whole else 'exact'}",
        sql(
            f"SELECT glider_id, coalesce(e.t, s.t) AS t_eng, coalesce(s.t, e.t) AS t_sci, pitch, round(temperature, 6) AS temperature FROM (SELECT *, {key.format('t')} AS k FROM e) e FULL JOIN (SELECT *, {key.format('t')} AS k FROM s) s USING (glider_id, k)",
            L0_CTE,
            f"e AS (SELECT glider_id, {CLOCKS[0]} AS t, pitch FROM l0 WHERE seq % 3 <> 1), s AS (SELECT glider_id, CAST({CLOCKS[1]} AS DOUBLE) AS t, temperature FROM l0)",
        ),
    )
    def clocks(spark, sf, whole=whole):
        base = l0(spark, sf)
        eng = base.filter("seq % 3 <> 1").select("glider_id", (F.col("t_s").cast("double") + 0.25).alias("t"), "pitch")
        sci = base.select("glider_id", F.expr(CLOCKS[1]).cast("double").alias("t"), "temperature")
        return al.join_clocks(eng, sci, whole).withColumn("temperature", F.round("temperature", 6))


@query(
    "align_one_axis",
    sql(
        "SELECT glider_id, t_s, pressure, lat_gps, current_speed FROM (SELECT glider_id, t_s FROM l0 UNION SELECT glider_id, t_s FROM g UNION SELECT glider_id, t_s FROM c) LEFT JOIN l0 USING (glider_id, t_s) LEFT JOIN g USING (glider_id, t_s) LEFT JOIN c USING (glider_id, t_s)",
        L0_CTE, "g AS (SELECT glider_id, t_s + 2 AS t_s, latitude AS lat_gps FROM l0 WHERE latitude <> 0), c AS (SELECT glider_id, t_s + seq % 2 AS t_s, pitch*2 AS current_speed FROM l0 WHERE seq % 40 = 39)",
    ),
)
def axis(spark, sf):
    base = l0(spark, sf)
    gps = base.filter("latitude <> 0").select("glider_id", (F.col("t_s") + 2).alias("t_s"), F.col("latitude").alias("lat_gps"))
    cur = base.filter("seq % 40 = 39").select("glider_id", (F.col("t_s") + F.col("seq") % 2).alias("t_s"), (F.col("pitch") * 2).alias("current_speed"))
    return al.one_axis([base.select("glider_id", "t_s", "pressure"), gps, cur])


SENSORS = ["temperature", "oxygen", "latitude"]
SYNC = [
    """ax AS (SELECT glider_id, t FROM (SELECT glider_id, t, t - lag(t) OVER (PARTITION BY glider_id ORDER BY t) AS d FROM (SELECT DISTINCT glider_id, t FROM raw WHERE sensor IN ('temperature', 'oxygen', 'latitude'))) WHERE coalesce(d > 0.01, true))"""
]
for s in SENSORS:
    SYNC.append(
        f"""sm_{s} AS (SELECT glider_id, t, v, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM raw WHERE sensor = '{s}' WINDOW w AS (PARTITION BY glider_id ORDER BY t)),
gp_{s} AS (SELECT glider_id, greatest(5*quantile_cont(t2 - t, 0.5), 30) AS gap FROM sm_{s} GROUP BY 1 HAVING count(*) >= 2),
in_{s} AS (SELECT ax.glider_id, ax.t, CASE WHEN ax.t = x.t THEN v WHEN least(ax.t - x.t, t2 - ax.t) <= gap THEN v + (v2 - v)*((ax.t - x.t)/(t2 - x.t)) END AS {s} FROM ax ASOF JOIN sm_{s} x ON ax.glider_id = x.glider_id AND ax.t >= x.t JOIN gp_{s} g ON g.glider_id = ax.glider_id)"""
    )


@query(
    "sync_sensors",
    sql(
        "SELECT glider_id, t, " + ", ".join(f"round({s} + 3e-8, 6) AS {s}" for s in SENSORS) + " FROM ax " + " ".join(f"LEFT JOIN in_{s} USING (glider_id, t)" for s in SENSORS),
        *RAW, *SYNC,
    ),
)
def sync(spark, sf):
    out = al.sync_sensors(sensor_raw(spark, sf), SENSORS)
    return out.select("glider_id", "t", *[F.round(F.col(s) + 3e-8, 6).alias(s) for s in SENSORS])


@query(
    "ctd_at_samples",
    sql(
        """SELECT x.glider_id, x.t_s, round(x.backscatter_700, 6) AS backscatter_700, """
        + ", ".join(f"round(CASE WHEN a.t_s = x.t_s THEN a.{c} ELSE a.{c} + (b.{c} - a.{c})*((x.t_s - a.t_s)/CAST(b.t_s - a.t_s AS double)) END, 6) AS {c}_at" for c in ("pressure", "temperature", "salinity"))
        + """ FROM (SELECT * FROM c WHERE backscatter_700 IS NOT NULL) x ASOF LEFT JOIN (SELECT * FROM c WHERE pressure IS NOT NULL AND temperature IS NOT NULL) a ON a.glider_id = x.glider_id AND a.t_s <= x.t_s
        ASOF LEFT JOIN (SELECT * FROM c WHERE pressure IS NOT NULL AND temperature IS NOT NULL) b ON b.glider_id = x.glider_id AND b.t_s >= x.t_s""",
        L0_CTE, "c AS (SELECT * REPLACE (CASE WHEN seq % 4 <> 0 THEN temperature END AS temperature) FROM l0)",
    ),
)
def ctd(spark, sf):
    base = l0(spark, sf).withColumn("temperature", F.when(F.col("seq") % 4 != 0, F.col("temperature")))
    return rounded(al.ctd_at_samples(base, "backscatter_700"))


GPS_CTE = "gps AS (SELECT glider_id, t_s + 7 AS t_s, latitude + 0.01 AS latitude, longitude - 0.01 AS longitude, CASE WHEN seq % 3 = 0 THEN 4 ELSE 1 END AS qc FROM sz WHERE latitude <> 0 AND glider_id <> 'G2' AND seq >= floor(0.03*n_rows::DOUBLE) AND seq < floor(0.9*n_rows::DOUBLE) AND seq % 320 < 200), own AS (SELECT * REPLACE (CASE WHEN latitude <> 0 AND seq % 400 = 0 AND glider_id <> 'G2' THEN latitude END AS latitude, CASE WHEN latitude <> 0 AND seq % 400 = 0 AND glider_id <> 'G2' THEN longitude END AS longitude) FROM l0), late AS (SELECT * FROM gps UNION ALL SELECT glider_id, max(t_s) + 1000, 12.25, 70.75, 1 FROM l0 WHERE glider_id = 'G2' GROUP BY 1)"


def gps_tables(spark, sf):
    """(rows, fixes): few own fixes; one glider has a single fix after its last row."""
    base = l0(spark, sf)
    other = (F.col("latitude") != 0) & (F.col("glider_id") != "G2")
    n = F.col("n_rows").cast("double")
    inside = (F.col("seq") >= F.floor(0.03 * n)) & (F.col("seq") < F.floor(0.9 * n)) & (F.col("seq") % 320 < 200)
    gps = sized(base).filter(other & inside).select(
        "glider_id", (F.col("t_s") + 7).alias("t_s"), (F.col("latitude") + 0.01).alias("latitude"), (F.col("longitude") - 0.01).alias("longitude"),
        F.when(F.col("seq") % 3 == 0, 4).otherwise(1).alias("qc"),
    )
    late = base.filter("glider_id = 'G2'").groupBy("glider_id").agg((F.max("t_s") + 1000).alias("t_s")).withColumns(
        {"latitude": F.lit(12.25), "longitude": F.lit(70.75), "qc": F.lit(1)}
    )
    own = other & (F.col("seq") % 400 == 0)
    rows = base.withColumns({c: F.when(own, F.col(c)) for c in ("latitude", "longitude")})
    return rows, gps.unionByName(late)


@query(
    "positions_at_rows",
    sql(
        """SELECT glider_id, t_s, seq, round(CASE WHEN is_own THEN latitude WHEN ins THEN ilat ELSE elat END + 3e-8, 6) AS latitude, round(CASE WHEN is_own THEN longitude WHEN ins THEN ilon ELSE elon END + 3e-8, 6) AS longitude,
        CASE WHEN is_own THEN 1 WHEN CASE WHEN ins THEN ilat ELSE elat END IS NOT NULL THEN 8 ELSE 9 END AS position_qc, CASE WHEN is_own THEN 3 WHEN CASE WHEN ins THEN ilat ELSE elat END IS NOT NULL THEN 2 END AS positioning_method
        FROM (SELECT *, bool_or(ilat IS NOT NULL) OVER (PARTITION BY glider_id) AS ins FROM pl)""",
        L0_CTE, SIZED_CTE, GPS_CTE,
        """fx AS (SELECT glider_id, t_s, latitude, longitude FROM late WHERE qc IN (1, 2) UNION SELECT glider_id, t_s, latitude, longitude FROM own WHERE latitude IS NOT NULL),
        pl AS (SELECT o.*, o.latitude IS NOT NULL AS is_own, coalesce(a.latitude, b.latitude) AS elat, coalesce(a.longitude, b.longitude) AS elon,
          CASE WHEN a.t_s = o.t_s THEN a.latitude ELSE a.latitude + (b.latitude - a.latitude)*((o.t_s - a.t_s)/CAST(b.t_s - a.t_s AS double)) END AS ilat,
          CASE WHEN a.t_s = o.t_s THEN a.longitude ELSE a.longitude + (b.longitude - a.longitude)*((o.t_s - a.t_s)/CAST(b.t_s - a.t_s AS double)) END AS ilon
          FROM own o ASOF LEFT JOIN fx a ON a.glider_id = o.glider_id AND a.t_s <= o.t_s ASOF LEFT JOIN fx b ON b.glider_id = o.glider_id AND b.t_s > o.t_s)""",
    ),
)
def positions(spark, sf):
    out = al.positions(*gps_tables(spark, sf))
    return rounded(out.withColumns({c: F.col(c) + 3e-8 for c in ("latitude", "longitude")}))


@query(
    "attach_samples_to_levels",
    sql(
        """SELECT l.glider_id, l.seq, l.t_s, l.pressure, round(b.v, 6) AS cdom FROM lv l LEFT JOIN (SELECT glider_id, lt, arg_min(cdom, (d, t_s)) AS v FROM (
        SELECT s.glider_id, s.t_s, s.cdom, CASE WHEN a.t_s IS NULL OR b.t_s - s.t_s <= s.t_s - a.t_s THEN b.t_s ELSE a.t_s END AS lt, abs(s.t_s - CASE WHEN a.t_s IS NULL OR b.t_s - s.t_s <= s.t_s - a.t_s THEN b.t_s ELSE a.t_s END) AS d
        FROM (SELECT * FROM l0 WHERE cdom IS NOT NULL) s ASOF LEFT JOIN lv a ON a.glider_id = s.glider_id AND a.t_s <= s.t_s ASOF LEFT JOIN lv b ON b.glider_id = s.glider_id AND b.t_s >= s.t_s) GROUP BY 1, 2) b ON b.glider_id = l.glider_id AND b.lt = l.t_s""",
        L0_CTE, "lv AS (SELECT * FROM l0 WHERE seq % 4 = 2)",
    ),
)
def attach(spark, sf):
    out = al.attach_to_levels(l0(spark, sf), "cdom", F.col("seq") % 4 == 2)
    return rounded(out.select("glider_id", "seq", "t_s", "pressure", "cdom"))


@query(
    "profile_place",
    sql(
        "SELECT glider_id, profile_index, round(mt, 3) AS profile_time, pt.latitude AS latitude, pt.longitude AS longitude FROM (SELECT glider_id, profile_index, avg(t_s) AS mt FROM l0 GROUP BY 1, 2) LEFT JOIN (SELECT glider_id, profile_index, arg_min({'latitude': latitude, 'longitude': longitude}, (abs(t_s - mt), t_s)) AS pt FROM l0 JOIN (SELECT glider_id, profile_index, avg(t_s) AS mt FROM l0 GROUP BY 1, 2) USING (glider_id, profile_index) WHERE latitude IS NOT NULL GROUP BY 1, 2) USING (glider_id, profile_index)"
    ),
)
def place(spark, sf):
    return al.profile_place(l0(spark, sf)).withColumn("profile_time", F.round("profile_time", 3))


DIVE_CTE = """dv AS (SELECT glider_id, profile_index AS dive, min(t_s) AS "start", max(t_s) - 200 AS "end" FROM l0 GROUP BY 1, 2), fx AS (SELECT glider_id, t_s - 100 AS t_s, latitude, longitude FROM l0 WHERE latitude <> 0 AND profile_index % 5 <> 2)"""


@query(
    "surface_current_place",
    sql(
        """SELECT d.glider_id, d.dive, CASE WHEN n.t_s < coalesce(nxt, n.t_s + 1) THEN n.t_s ELSE "end" END AS t,
        round(CASE WHEN n.t_s < coalesce(nxt, n.t_s + 1) THEN n.latitude ELSE p.latitude + (n.latitude - p.latitude)*("end" - p.t_s)/CAST(n.t_s - p.t_s AS double) END, 6) AS latitude,
        round(CASE WHEN n.t_s < coalesce(nxt, n.t_s + 1) THEN n.longitude ELSE p.longitude + (n.longitude - p.longitude)*("end" - p.t_s)/CAST(n.t_s - p.t_s AS double) END, 6) AS longitude
        FROM (SELECT *, lead("start") OVER (PARTITION BY glider_id ORDER BY "start") AS nxt FROM dv) d ASOF LEFT JOIN fx n ON n.glider_id = d.glider_id AND n.t_s >= d."end" ASOF LEFT JOIN fx p ON p.glider_id = d.glider_id AND p.t_s < d."end" """,
        L0_CTE, DIVE_CTE,
    ),
)
def surface_place(spark, sf):
    base = l0(spark, sf)
    dives = base.groupBy("glider_id", F.col("profile_index").alias("dive")).agg(F.min("t_s").alias("start"), (F.max("t_s") - 200).alias("end"))
    fixes = base.filter("latitude <> 0 AND profile_index % 5 <> 2").select("glider_id", (F.col("t_s") - 100).alias("t_s"), "latitude", "longitude")
    return rounded(al.surface_current_place(dives, fixes))


@query(
    "subsurface_current_place",
    sql(
        """SELECT glider_id, profile_index, round(t, 3) AS t, round(depth, 6) AS depth, pt.latitude AS latitude, pt.longitude AS longitude FROM md LEFT JOIN (SELECT glider_id, profile_index, arg_min({'latitude': latitude, 'longitude': longitude}, (abs(t_s - t), t_s)) AS pt FROM l0 JOIN md USING (glider_id, profile_index) WHERE latitude IS NOT NULL GROUP BY 1, 2) USING (glider_id, profile_index)""",
        L0_CTE, "md AS (SELECT glider_id, profile_index, quantile_cont(t_s, 0.5) AS t, avg(pressure) AS depth FROM l0 GROUP BY 1, 2)",
    ),
)
def subsurface_place(spark, sf):
    out = al.subsurface_current_place(l0(spark, sf))
    return out.withColumns({"t": F.round("t", 3), "depth": F.round("depth", 6)})


STEP = 0.25
ELEVATION_SQL = f"""sp AS (SELECT DISTINCT latitude, longitude, CAST(floor((latitude + 90)/{STEP}) AS BIGINT) AS i, CAST(floor((longitude + 180)/{STEP}) AS BIGINT) AS j FROM lo WHERE latitude IS NOT NULL),
cn AS (SELECT latitude, longitude, i + a AS i_lat, (j + b) % 1440 AS i_lon FROM (SELECT *, unnest([0, 1]) AS a FROM (SELECT *, unnest([0, 1]) AS b FROM sp))),
el AS (SELECT DISTINCT i_lat, i_lon, CAST((i_lat*7 + i_lon*3) % 50 - 24 AS DOUBLE) AS z FROM cn)"""


@query(
    "position_on_land",
    sql(
        "SELECT glider_id, t_s, land_qc FROM lo LEFT JOIN (SELECT latitude, longitude, CASE WHEN avg(z) >= 0 THEN 4 ELSE 1 END AS land_qc FROM cn JOIN el USING (i_lat, i_lon) GROUP BY 1, 2) USING (latitude, longitude)",
        L0_CTE, "lo AS (SELECT glider_id, t_s, latitude, longitude + CASE WHEN profile_index % 4 = 0 THEN 109.9 ELSE 0 END AS longitude FROM l0)", ELEVATION_SQL,
    ),
)
def on_land(spark, sf):
    rows = l0(spark, sf).select(
        "glider_id", "t_s", "latitude", (F.col("longitude") + F.when(F.col("profile_index") % 4 == 0, 109.9).otherwise(0.0)).alias("longitude")
    )
    i, j = F.floor((F.col("latitude") + 90) / STEP), F.floor((F.col("longitude") + 180) / STEP)
    node = F.explode(F.array(*[F.struct((i + a).alias("i_lat"), F.pmod(j + b, F.lit(1440)).alias("i_lon")) for a in (0, 1) for b in (0, 1)]))
    elevation = rows.filter("latitude IS NOT NULL").select(node.alias("n")).select("n.*").distinct().withColumn(
        "z", ((F.col("i_lat") * 7 + F.col("i_lon") * 3) % 50 - 24).cast("double")
    )
    return al.position_on_land(rows, elevation, STEP).select("glider_id", "t_s", "land_qc")


RAD_LAT1, RAD_LAT2 = "atan((1 - 1/298.257223563)*tan(radians(la)))", "atan((1 - 1/298.257223563)*tan(radians(fla)))"


@query(
    "subsurface_speed",
    sql(
        """SELECT glider_id, t_s, seq, round(CAST(latitude AS DOUBLE), 4) AS latitude, round(CAST(longitude AS DOUBLE), 4) AS longitude, round(v, 4) AS speed, coalesce(v > 3, true) AS too_fast FROM (
        SELECT *, la AS latitude, lo AS longitude, CASE WHEN sg = 0 THEN 0 ELSE 6378137.0*(sg - (1/298.257223563)/2*((sg - sin(sg))*pow(sin((b1 + b2)/2)*cos((b2 - b1)/2), 2)/pow(cos(sg/2), 2) + (sg + sin(sg))*pow(cos((b1 + b2)/2)*sin((b2 - b1)/2), 2)/pow(sin(sg/2), 2))) END/abs(t_s - ft) AS v
        FROM (SELECT *, 2*asin(sqrt(least(1, pow(sin((b2 - b1)/2), 2) + cos(b1)*cos(b2)*pow(sin(radians(flo - lo)/2), 2)))) AS sg FROM (SELECT *, """
        + RAD_LAT1 + " AS b1, " + RAD_LAT2
        + """ AS b2 FROM (SELECT *, CASE WHEN nb THEN bt ELSE att END AS ft, CASE WHEN nb THEN bla ELSE ala END AS fla, CASE WHEN nb THEN blo ELSE alo END AS flo FROM (SELECT x.*, b.t_s AS bt, a.t_s AS att, b.latitude AS bla, a.latitude AS ala, b.longitude AS blo, a.longitude AS alo,
        a.t_s IS NULL OR coalesce(x.t_s - b.t_s <= a.t_s - x.t_s, false) AS nb
        FROM (SELECT glider_id, t_s, seq, 12.0 + profile_index*0.0012 AS la, 70.0 + profile_index*0.001 AS lo FROM l0) x ASOF LEFT JOIN fx b ON b.glider_id = x.glider_id AND b.t_s < x.t_s - 600 ASOF LEFT JOIN fx a ON a.glider_id = x.glider_id AND a.t_s > x.t_s + 600)))))""",
        L0_CTE, "fx AS (SELECT glider_id, t_s, latitude, longitude FROM l0 WHERE latitude <> 0 AND glider_id <> 'G1')",
    ),
)
def subsurface_speed(spark, sf):
    base = l0(spark, sf)
    fixes = base.filter("latitude <> 0 AND glider_id <> 'G1'").select("glider_id", "t_s", "latitude", "longitude")
    rows = base.select("glider_id", "t_s", "seq", (12.0 + F.col("profile_index") * 0.0012).alias("latitude"), (70.0 + F.col("profile_index") * 0.001).alias("longitude"))
    return rounded(al.subsurface_speed(rows, fixes), 4)
