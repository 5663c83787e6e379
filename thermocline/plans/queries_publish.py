"""Registered queries: normal form, loads and exchange tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr, flags
from ..operators import cleaning as cl
from ..operators import corrections as co
from ..operators import publish as pb
from ..operators import second_format as sx
from ..operators.reports import qc_summary
from .common import L0_CTE, SCREENED_CTE, rounded, sql
from .fixture import l0
from .queries_corrections import LAG_CTE
from .queries_grid import simple_flag_ctes, simple_flags
from .queries_reports import FULLQ, cnt
from ..session import table_path
from .registry import query

FLAGS = simple_flag_ctes()
NAMES = {v: n for v, (n, _) in pb.STANDARD_NAMES.items()}
BGC = ("oxygen_concentration", "chlorophyll", "cdom", "backscatter_700", "nitrate")


def l1(spark, sf):
    """Flagged series with a lag-corrected oxygen column."""
    return co.oxygen_lag(simple_flags(spark, sf))


L1 = (*FLAGS, FULLQ, LAG_CTE.format("fa"))
KEY = "CAST(('0x' || substr(sha256(glider_id || '|' || strftime(make_timestamp(t_s*1000000), '%Y-%m-%dT%H:%M:%S.%f')), 1, 16))::UBIGINT % 9223372036854775808::UBIGINT AS BIGINT)"
MEASURED = ("pressure", "temperature", "salinity", "oxygen_concentration", "chlorophyll", "cdom", "backscatter_700", "density", "conductivity")
# both levels lack some stamps; nitrate is in the raw one alone, without a flag and mostly without a value
NITRATE = "CASE WHEN seq % 4 = 0 THEN 5.0 + 0.001*seq END"
PAIR_CTES = (
    f"rw AS (SELECT glider_id, t_s, {', '.join(MEASURED)}, CAST({NITRATE} AS DOUBLE) AS nitrate FROM l0 WHERE seq % 11 <> 3)",
    f"lv AS (SELECT glider_id, t_s, {', '.join(v + '_QC' for v in MEASURED if v != 'conductivity')}, lag_corrected FROM ol WHERE seq % 13 <> 5)",
    "pr AS (SELECT * FROM rw FULL JOIN lv USING (glider_id, t_s))",
)
LONG = " UNION ALL ".join(
    f"SELECT {KEY} AS observation_id, glider_id, t_s, '{'bgc' if v in BGC else 'core'}' AS family, '{NAMES.get(v, v)}' AS variable_name, {v} AS value, "
    + (f"{v}_QC" if v not in ("conductivity", "nitrate") else "NULL::INT")
    + f" AS qc_flag, {'lag_corrected' if v == 'oxygen_concentration' else 'NULL::DOUBLE'} AS value_adjusted, NULL::INT AS adjusted_qc_flag FROM pr"
    for v in (*MEASURED, "nitrate")
)
LONG_CTE = ", ".join((*PAIR_CTES, f"ml AS ({LONG})"))


def long_rows(spark, sf):
    raw = l0(spark, sf).filter("seq % 11 <> 3").select("glider_id", "t_s", *MEASURED, F.expr(NITRATE).cast("double").alias("nitrate"))
    return pb.measurements(l1(spark, sf).filter("seq % 13 <> 5"), raw)


@query("observation_key", sql(f"SELECT glider_id, t_s, {KEY} AS observation_id FROM l0"))
def key(spark, sf):
    return l0(spark, sf).select("glider_id", "t_s", pb.row_key().alias("observation_id"))


@query("key_collisions", sql(f"SELECT observation_id, count(*) AS n FROM (SELECT DISTINCT {KEY} AS observation_id, glider_id, t_s FROM l0) GROUP BY 1 HAVING count(*) > 1"))
def collisions(spark, sf):
    return pb.key_collisions(l0(spark, sf))


@query("measurement_long", sql("SELECT * REPLACE (round(value, 6) AS value, round(value_adjusted, 6) AS value_adjusted) FROM ml", *L1, LONG_CTE))
def long(spark, sf):
    return rounded(long_rows(spark, sf))


@query("observation_table", sql(f"SELECT {KEY} AS observation_id, glider_id, t_s, depth AS depth_m, pressure, latitude, longitude, profile_index AS profile_id, profile_direction, NULL::DOUBLE AS heading, round(pitch, 6) AS pitch, NULL::DOUBLE AS roll, waypoint_latitude, waypoint_longitude, NULL::DOUBLE AS distance_over_ground FROM l0"))
def observation(spark, sf):
    base = l0(spark, sf)
    return rounded(pb.observations(base.drop("pitch"), base.select("glider_id", "t_s", "pitch", "pressure")))


@query("qc_summary_view", sql(
    "SELECT glider_id, family, variable_name, count(*) AS n, " + ", ".join(f"CAST(sum(CAST(qc_flag = {k} AS INT)) AS BIGINT) AS n_{k}" for k in (1, 2, 3, 4, 9))
    + ", count(value_adjusted) AS n_adjusted, round(100.0*sum(CAST(qc_flag IN (1, 2) AS INT))/count(*), 2) AS pct_good FROM ml GROUP BY 1, 2, 3", *L1, LONG_CTE))
def summary(spark, sf):
    return qc_summary(long_rows(spark, sf))


@query("measurement_full_view", sql(f"SELECT o.observation_id, o.glider_id, o.t_s, depth_m, family, variable_name, round(value, 6) AS value, qc_flag FROM (SELECT {KEY} AS observation_id, glider_id, t_s, depth AS depth_m FROM l0) o JOIN ml USING (observation_id)", *L1, LONG_CTE))
def full(spark, sf):
    out = pb.measurement_full(pb.observations(l0(spark, sf)), long_rows(spark, sf))
    return rounded(out.select("observation_id", "glider_id", "t_s", "depth_m", "family", "variable_name", "value", "qc_flag"))


@query("union_families_view", sql("SELECT observation_id, family, variable_name, round(value, 6) AS value FROM ml", *L1, LONG_CTE))
def families(spark, sf):
    m = long_rows(spark, sf)
    split = {f: m.filter(F.col("family") == f).drop("family") for f in ("core", "bgc")}
    return rounded(pb.union_families(split["core"], split["bgc"]).select("observation_id", "family", "variable_name", "value"))


WIDE = ["TEMP", "DOXY"]


@query("wide_view", sql(
    f"SELECT o.observation_id, o.t_s, " + ", ".join(f"round(max(value) FILTER (WHERE variable_name = '{n}'), 6) AS {n}, round(max(value_adjusted) FILTER (WHERE variable_name = '{n}'), 6) AS {n}_ADJUSTED, max(qc_flag) FILTER (WHERE variable_name = '{n}') AS {n}_QC, max(adjusted_qc_flag) FILTER (WHERE variable_name = '{n}') AS {n}_ADJUSTED_QC" for n in WIDE)
    + f" FROM (SELECT {KEY} AS observation_id, t_s FROM l0) o LEFT JOIN ml USING (observation_id) GROUP BY 1, 2", *L1, LONG_CTE))
def wide(spark, sf):
    out = pb.wide_measurements(pb.observations(l0(spark, sf)), long_rows(spark, sf), WIDE)
    return rounded(out.select("observation_id", "t_s", *[n + s for n in WIDE for s in ("", "_ADJUSTED", "_QC", "_ADJUSTED_QC")]))


@query("example_observation", sql(
    "SELECT observation_id, p AS priority FROM (SELECT observation_id, CASE " + " ".join(f"WHEN bool_or(family = 'core' AND {c}) AND bool_or(family = 'bgc' AND {c}) THEN {k}" for k, c in ((1, "qc_flag IS NOT NULL AND value_adjusted IS NOT NULL"), (2, "qc_flag IS NOT NULL"), (3, "value IS NOT NULL")))
    + " END AS p FROM ml GROUP BY 1) WHERE p IS NOT NULL ORDER BY p, observation_id LIMIT 1", *L1, LONG_CTE))
def example(spark, sf):
    return pb.example_observation(long_rows(spark, sf))


@query("idempotent_load", sql(
    f"SELECT observation_id, glider_id, t_s, value FROM (SELECT {KEY} AS observation_id, glider_id, t_s, CASE WHEN seq % 3 = 0 THEN pressure + 1 ELSE pressure END AS value FROM l0 WHERE seq % 3 = 0 OR seq % 5 <> 1)"))
def load(spark, sf):
    base = l0(spark, sf).select(pb.row_key().alias("observation_id"), "glider_id", "t_s", F.col("pressure").alias("value"), "seq")
    old = base.filter("seq % 5 <> 1").drop("seq")
    new = base.filter("seq % 3 = 0").drop("seq").withColumn("value", F.col("value") + 1)
    once = pb.upsert(old, new, ["observation_id"])
    return pb.upsert(once, new, ["observation_id"])


@query("written_load", sql(
    f"SELECT observation_id, glider_id, t_s, value FROM (SELECT {KEY} AS observation_id, glider_id, t_s, CASE WHEN seq % 3 = 0 THEN pressure + 1 ELSE pressure END AS value FROM l0 WHERE seq % 3 = 0 OR seq % 5 <> 1)"))
def written_load(spark, sf):
    base = l0(spark, sf).select(pb.row_key().alias("observation_id"), "glider_id", "t_s", F.col("pressure").alias("value"), "seq")
    path, new = table_path(spark), base.filter("seq % 3 = 0").drop("seq").withColumn("value", F.col("value") + 1)
    pb.load_parquet(base.filter("seq % 5 <> 1").drop("seq"), path, ["observation_id"])
    for _ in range(2):
        pb.load_parquet(new, path, ["observation_id"])
    return spark.read.parquet(path).select("observation_id", "glider_id", "t_s", "value")


@query("profile_rows_qc", sql(
    "SELECT glider_id, profile_index, t_s, round(CASE WHEN temperature_QC IN (3, 4) THEN NULL ELSE temperature END, 6) AS temperature, round(CASE WHEN pressure_QC IN (3, 4) THEN NULL ELSE pressure END, 6) AS pressure, CASE WHEN avg(profile_direction) OVER (PARTITION BY glider_id, profile_index) > 0 THEN 'dive' ELSE 'climb' END AS direction FROM fa", *FLAGS, FULLQ))
def profile_rows(spark, sf):
    out = pb.profile_rows(simple_flags(spark, sf), ["temperature", "pressure"], apply_qc=True)
    return rounded(out.select("glider_id", "profile_index", "t_s", "temperature", "pressure", "direction"))


@query("written_profiles", sql(
    "SELECT glider_id, profile_index, t_s, round(CASE WHEN temperature_QC IN (3, 4) THEN NULL ELSE temperature END, 6) AS temperature, round(CASE WHEN pressure_QC IN (3, 4) THEN NULL ELSE pressure END, 6) AS pressure, CASE WHEN avg(profile_direction) OVER (PARTITION BY glider_id, profile_index) > 0 THEN 'dive' ELSE 'climb' END AS direction FROM fa", *FLAGS, FULLQ))
def written_profiles(spark, sf):
    path = table_path(spark)
    pb.write_profiles(pb.profile_rows(simple_flags(spark, sf), ["temperature", "pressure"], apply_qc=True), path)
    return rounded(spark.read.parquet(path).select("glider_id", "profile_index", "t_s", "temperature", "pressure", "direction"))


@query("delimited_export", sql(
    "SELECT glider_id, strftime(make_timestamp(t_s*1000000), '%Y/%m/%d %H:%M:%S') AS DATE, latitude AS LATITUDE, longitude AS LONGITUDE, round(temperature, 6) AS TEMP, temperature_QC AS TEMP_QC, conductivity AS CNDC, 0 AS CNDC_QC FROM fa".replace("conductivity AS", "round(conductivity, 6) AS"), *FLAGS, FULLQ))
def export(spark, sf):
    return rounded(pb.export_rows(simple_flags(spark, sf), {"temperature": "TEMP", "conductivity": "CNDC"}))


OX = "CASE WHEN density/1000 > 0.5 THEN {0}/(density/1000) END"


@query("exchange_table", sql(
    "SELECT glider_id, t_s AS TIME, " + ", ".join(
        f"round(coalesce({OX.format('oxygen_concentration') if v == 'oxygen_concentration' else v}, 99999), 6) AS {n}, {v + '_QC' if v != 'conductivity' else 0} AS {n}_QC, "
        + (f"round(coalesce(CASE WHEN wide THEN {OX.format('oxygen_concentration')} ELSE {OX.format('lag_corrected')} END, 99999), 6)" if v == "oxygen_concentration" else "CAST(99999 AS DOUBLE)")
        + f" AS {n}_ADJUSTED, {v + '_QC' if v != 'conductivity' else 0} AS {n}_ADJUSTED_QC, CAST(99999 AS DOUBLE) AS {n}_ADJUSTED_ERROR"
        for v, n in NAMES.items() if v != "density")
    + f" FROM ol JOIN (SELECT glider_id, max({OX.format('lag_corrected')}) - min({OX.format('lag_corrected')}) > 1.2*(max({OX.format('oxygen_concentration')}) - min({OX.format('oxygen_concentration')})) AS wide FROM ol GROUP BY 1) USING (glider_id)", *L1))
def exchange(spark, sf):
    return rounded(pb.exchange_table(l1(spark, sf)))


@query("exchange_positions", sql("SELECT glider_id, t_s AS TIME, coalesce(latitude, 99999) AS LATITUDE, coalesce(longitude, 99999) AS LONGITUDE, latitude_QC AS POSITION_QC FROM fa", *FLAGS, FULLQ))
def positions(spark, sf):
    return pb.exchange_positions(simple_flags(spark, sf))


@query("exchange_gps", sql("SELECT glider_id, CAST(min(t_s) AS DOUBLE) AS TIME_GPS, arg_min(latitude, t_s) AS LATITUDE_GPS, arg_min(longitude, t_s) AS LONGITUDE_GPS FROM cl WHERE latitude IS NOT NULL AND glider_id <> 'G2' GROUP BY glider_id, profile_index UNION ALL SELECT DISTINCT glider_id, 99999::DOUBLE, 99999::DOUBLE, 99999::DOUBLE FROM cl WHERE glider_id = 'G2'", SCREENED_CTE))
def gps(spark, sf):
    base = cl.blank_null_island(l0(spark, sf))
    return pb.exchange_gps(base.withColumns({c: F.when(F.col("glider_id") != "G2", F.col(c)) for c in ("latitude", "longitude")}))


DIR = "CASE WHEN seq % 10 = 0 THEN NULL WHEN seq % 10 = 1 THEN 0 ELSE profile_direction END"
NUM = "CASE WHEN seq % 10 = 2 THEN NULL ELSE profile_index END"


@query("phase_from_direction", sql(f"SELECT glider_id, t_s, CASE WHEN d IS NULL THEN -128 WHEN d > 0 THEN 1 WHEN d < 0 THEN 4 ELSE 2 END AS PHASE, coalesce(p, 99999) AS PHASE_NUMBER FROM (SELECT glider_id, t_s, {DIR} AS d, {NUM} AS p FROM l0)"))
def phase(spark, sf):
    base = l0(spark, sf).withColumns({"profile_direction": F.expr(DIR), "profile_index": F.expr(NUM)})
    return pb.phase_from_direction(base).select("glider_id", "t_s", "PHASE", "PHASE_NUMBER")


@query("sensor_table", sql(
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT DISTINCT glider_id, '{s}' AS slot, '{n}' AS sensor, " + (f"CASE WHEN glider_id = 'G1' THEN 'maker of G1' ELSE '{m}' END" if s == "ctd" else f"'{m}'") + f" AS maker, '{o}' AS model, '' AS serial FROM l0" for s, n, m, o in pb.DEFAULT_SENSORS) + ")"))
def sensors(spark, sf):
    dep = l0(spark, sf).select("glider_id").distinct()
    meta = F.when(F.col("glider_id") == "G1", F.create_map(F.lit("ctd_maker"), F.concat(F.lit("maker of "), "glider_id")))
    return pb.sensor_table(dep.withColumn("metadata", meta))


PARAMS = ["temperature", "oxygen_concentration", "cdom", "nitrate"]


@query("parameter_table", sql("SELECT * FROM (SELECT DISTINCT glider_id FROM l0), (VALUES ('TEMP', 'CTD', 'R'), ('DOXY', 'AANDERAA_OPTODE', 'R'), ('CDOM', 'ECO_FLBBCD', 'R'), ('nitrate', 'CTD', 'R')) AS p(parameter, sensor, data_mode)"))
def parameters(spark, sf):
    return pb.parameter_table(l0(spark, sf).select("glider_id").distinct(), PARAMS)


@query("coverage_attributes", sql("SELECT *, glider_id || '_' || strftime(make_timestamp(time_coverage_start*1000000), '%Y%m%d') AS id FROM (SELECT glider_id, min(latitude) AS geospatial_lat_min, max(latitude) AS geospatial_lat_max, min(longitude) AS geospatial_lon_min, max(longitude) AS geospatial_lon_max, min(t_s) AS time_coverage_start, max(t_s) AS time_coverage_end FROM cl GROUP BY 1)", SCREENED_CTE))
def attributes(spark, sf):
    return pb.coverage_attributes(cl.blank_null_island(l0(spark, sf)))


@query("creation_flags", sql(
    "SELECT glider_id, t_s, CASE WHEN glider_id <> 'G1' AND temperature IS NOT NULL THEN 0 ELSE q END AS temperature_QC, CASE WHEN glider_id = 'G2' THEN 'A' ELSE 'R' END AS temperature_mode FROM (SELECT *, CASE WHEN glider_id = 'G1' AND seq % 2 = 0 THEN 1 ELSE -128 END AS q FROM l0)"))
def created(spark, sf):
    base = l0(spark, sf).withColumns(
        {"temperature_QC": F.when((F.col("glider_id") == "G1") & (F.col("seq") % 2 == 0), 1).otherwise(-128), "temperature_adjusted": F.when(F.col("glider_id") == "G2", F.col("temperature"))}
    )
    return pb.creation_flags(base, ["temperature"]).select("glider_id", "t_s", "temperature_QC", "temperature_mode")


@query("profile_product", sql(
    "SELECT glider_id, profile_index, CASE WHEN avg(profile_direction) > 0 THEN 'D' ELSE 'A' END AS direction, count(*) AS levels, 'R' AS temperature_mode, CASE WHEN glider_id = 'G0' THEN 'A' ELSE 'R' END AS salinity_mode, CASE WHEN glider_id = 'G0' THEN 'A' ELSE 'R' END AS data_mode, round(avg(t_s), 3) AS profile_time, max(latitude) AS latitude, max(longitude) AS longitude FROM l0 GROUP BY 1, 2"))
def product(spark, sf):
    base = l0(spark, sf).withColumn("salinity_adjusted", F.when(F.col("glider_id") == "G0", F.col("salinity")))
    return rounded(pb.profile_product(base, ["temperature", "salinity"]), 3)


MAP_SQL = "mp AS (SELECT DISTINCT variable_name AS source, CASE WHEN variable_name IN ('TEMP', 'PSAL') THEN 'sea_' || lower(variable_name) WHEN variable_name = 'CDOM' THEN 'TBD' END AS target FROM ml WHERE variable_name IN ('TEMP', 'PSAL', 'CDOM'))"


def mapping(m):
    target = F.when(F.col("variable_name") == "CDOM", "TBD").otherwise(F.concat(F.lit("sea_"), F.lower("variable_name")))
    return m.filter(F.col("variable_name").isin("TEMP", "PSAL", "CDOM")).select(F.col("variable_name").alias("source"), target.alias("target")).distinct()


@query("second_exchange", sql("SELECT observation_id, coalesce(target, variable_name) AS variable_name, round(value, 6) AS value FROM ml LEFT JOIN mp ON source = variable_name WHERE coalesce(target <> 'TBD', true)", *L1, LONG_CTE, MAP_SQL))
def second(spark, sf):
    m = long_rows(spark, sf)
    return rounded(pb.second_exchange(m, mapping(m)).select("observation_id", "variable_name", "value"))


@query("mapped_names", sql("SELECT variable_name, CASE WHEN target = 'TBD' THEN 'unmapped:' || variable_name ELSE coalesce(target, variable_name) END AS variable_name_mapped, count(*) AS n FROM ml LEFT JOIN mp ON source = variable_name GROUP BY 1, 2", *L1, LONG_CTE, MAP_SQL))
def mapped(spark, sf):
    m = long_rows(spark, sf)
    return pb.mapped_names(m, mapping(m), "variable_name").groupBy("variable_name", "variable_name_mapped").agg(F.count(F.lit(1)).alias("n"))


# -- second format on one axis ---------------------------------------------------------------------------
ROLES = [  # role, source, target, vocabulary
    ("parameter", "TEMP", "SEA_TEMP", "v:temp"), ("parameter", "PSAL", "SEA_PSAL", "v:psal"), ("parameter", "CDOM", "TBD", ""),
    ("parameter", "DOXY", "SEA_TEMP", ""), ("parameter", "CHLA", "SEA_CHLA", "v:chla"), ("parameter", "WATERCURRENTS_U", "CURRENT_U", ""),
    ("parameter", "WATERCURRENTS_QC", "CURRENT_QC", ""), ("parameter", "SURF_WATERCURRENTS_U", "SURFACE_U", ""), ("parameter", "WATERCURRENTS_V", "", ""),
    ("sensor_type", "CTD", "ctd probe", "v:ctd"), ("sensor_type", "ECO_FLBBCD", "TBD", ""), ("sensor_maker", "Sea-Bird Scientific", "sea-bird", "v:sbe"),
    ("sensor_model", "GPCTD", "gp ctd", ""), ("platform_model", "model-0", "deep model", ""), ("platform_model", "model-1", "TBD", ""),
    ("platform_maker", "maker", "the maker", ""), ("platform_maker", "maker", "TBD", ""),
]


def roles(spark):
    return spark.createDataFrame(ROLES, "role string, source string, target string, vocabulary string")


# every ninth row has nothing, every 17th no flag; fixes and surface currents have stamps of their own
HAS = "seq % 9 <> 4"
EXCHANGED = {
    **{n: f"CASE WHEN {HAS} THEN coalesce({v}, 99999) ELSE 99999 END" for n, v in (
        ("LONGITUDE", "longitude"), ("LATITUDE", "latitude"), ("PRES", "pressure"), ("TEMP", "temperature"), ("PSAL", "salinity"), ("CDOM", "cdom"), ("DOXY", "oxygen_concentration"))},
    **{f"{n}_QC": f"CASE WHEN {HAS} AND seq % 17 <> 0 THEN {v}_QC ELSE -128 END" for n, v in (("PRES", "pressure"), ("TEMP", "temperature"), ("CDOM", "cdom"), ("DOXY", "oxygen_concentration"))},
    "PHASE": f"CASE WHEN {HAS} AND seq % 5 > 0 THEN 1 + seq % 5 ELSE -128 END",
}
AXIS_CTES = (
    "m AS (SELECT glider_id, t_s AS t, " + ", ".join(f"CAST(nullif({e}, {-128 if n.endswith('_QC') or n == 'PHASE' else 99999}) AS DOUBLE) AS {n}" for n, e in EXCHANGED.items() if n not in ("CDOM", "CDOM_QC", "DOXY", "DOXY_QC")) + " FROM fa)",
    "g AS (SELECT glider_id, t_s + 2 AS t, CAST(t_s + 2 AS DOUBLE) AS TIME_GPS, longitude AS LONGITUDE_GPS, latitude AS LATITUDE_GPS FROM fa WHERE latitude IS NOT NULL)",
    "c AS (SELECT glider_id, t_s AS t, round(pitch*2, 6) AS CURRENT_U, CASE WHEN seq % 80 <> 79 THEN 1.0::DOUBLE END AS CURRENT_QC FROM fa WHERE seq % 40 = 39)",
    "w AS (SELECT glider_id, t_s + 3 AS t, round(pitch*3, 6) AS SURFACE_U FROM fa WHERE seq % 100 = 99)",
    """ax AS (SELECT glider_id, CAST(t AS DOUBLE) AS TIME, round(LONGITUDE, 6) AS LONGITUDE, round(LATITUDE, 6) AS LATITUDE, round(PRES, 6) AS DEPTH, PRES_QC AS DEPTH_QC, PHASE, round(TEMP, 6) AS SEA_TEMP, TEMP_QC AS SEA_TEMP_QC, round(PSAL, 6) AS SEA_PSAL,
        TIME_GPS, round(LONGITUDE_GPS, 6) AS LONGITUDE_GPS, round(LATITUDE_GPS, 6) AS LATITUDE_GPS, CURRENT_U, CURRENT_QC, SURFACE_U
        FROM m FULL JOIN g USING (glider_id, t) FULL JOIN c USING (glider_id, t) FULL JOIN w USING (glider_id, t)
        WHERE coalesce(LONGITUDE, LATITUDE, PRES, PRES_QC, PHASE, TEMP, TEMP_QC, PSAL, TIME_GPS, CURRENT_U, CURRENT_QC, SURFACE_U) IS NOT NULL)""",
)


def second_axis(spark, sf):
    base = simple_flags(spark, sf)
    fill = lambda c: F.coalesce(c, F.lit(pb.FILL))
    fixes = base.filter("latitude IS NOT NULL").select(
        "glider_id", (F.col("t_s") + 2).cast("double").alias("TIME_GPS"), fill(F.col("longitude")).alias("LONGITUDE_GPS"), F.col("latitude").alias("LATITUDE_GPS")
    )
    empty = base.select("glider_id").distinct().select("glider_id", *[F.lit(pb.FILL).alias(c) for c in fixes.columns[1:]])
    blocks = {
        "measurement": base.select("glider_id", F.col("t_s").alias("TIME"), *[F.expr(e).alias(n) for n, e in EXCHANGED.items()]),
        "gps": fixes.unionByName(empty),
        "currents": base.filter("seq % 40 = 39").select(
            "glider_id", F.col("t_s").alias("WATERCURRENTS_TIME"), (F.col("pitch") * 2).alias("WATERCURRENTS_U"), F.lit(1.0).alias("WATERCURRENTS_V"),
            F.lit(5.0).alias("WATERCURRENTS_DEPTH"), F.expr("CASE WHEN seq % 80 <> 79 THEN 1 ELSE -128 END").alias("WATERCURRENTS_QC")),
        "surface": base.filter("seq % 100 = 99").select("glider_id", (F.col("t_s") + 3).alias("SURF_WATERCURRENTS_TIME"), (F.col("pitch") * 3).alias("SURF_WATERCURRENTS_U")),
    }
    return rounded(sx.second_table(blocks, roles(spark)))


@query("second_exchange_axis", sql("SELECT * FROM ax", *FLAGS, FULLQ, *AXIS_CTES))
def exchange_axis(spark, sf):
    return second_axis(spark, sf)


@query("second_exchange_attributes", sql("SELECT glider_id, " + ", ".join(f"least(min({a}), min({b})) AS geospatial_{n}_min, greatest(max({a}), max({b})) AS geospatial_{n}_max" for n, a, b in (("lat", "LATITUDE", "LATITUDE_GPS"), ("lon", "LONGITUDE", "LONGITUDE_GPS"), ("vertical", "DEPTH", "DEPTH"))) + ", strftime(make_timestamp(CAST(min(TIME) AS BIGINT)*1000000), '%Y%m%dT%H%M%S') AS time_coverage_start, strftime(make_timestamp(CAST(max(TIME) AS BIGINT)*1000000), '%Y%m%dT%H%M%S') AS time_coverage_end FROM ax GROUP BY 1", *FLAGS, FULLQ, *AXIS_CTES))
def exchange_attributes(spark, sf):
    return sx.second_attributes(second_axis(spark, sf))


SECOND_PARAMETERS = ["pressure", "temperature", "salinity", "chlorophyll", "cdom"]


@query("second_exchange_sensors", sql(
    """SELECT * FROM (SELECT DISTINCT glider_id FROM l0), (VALUES ('DEPTH', 'ctd probe', 'v:ctd', 'sea-bird', 'v:sbe', 'gp ctd'), ('SEA_TEMP', 'ctd probe', 'v:ctd', 'sea-bird', 'v:sbe', 'gp ctd'), ('SEA_PSAL', 'ctd probe', 'v:ctd', 'sea-bird', 'v:sbe', 'gp ctd'), ('SEA_CHLA', 'unmapped:ECO_FLBBCD', '', 'sea-bird', 'v:sbe', 'unmapped:FLBBCD')) AS p(parameter, sensor_type, sensor_type_vocabulary, sensor_maker, sensor_maker_vocabulary, sensor_model),
    LATERAL (SELECT '' AS sensor_model_vocabulary, '' AS serial, CASE WHEN sensor_type = 'ctd probe' THEN day ELSE '' END AS calibration_date FROM dv WHERE dv.glider_id = l0.glider_id)""".replace("FROM (SELECT DISTINCT glider_id FROM l0)", "FROM (SELECT DISTINCT glider_id FROM l0) AS l0"),
    L0_CTE, "dv AS (SELECT glider_id, strftime(make_timestamp(min(t_s)*1000000), '%Y-%m-%d') AS day FROM l0 GROUP BY 1)"))
def exchange_sensors(spark, sf):
    base = l0(spark, sf)
    dep = base.select("glider_id").distinct()
    entry = lambda n, date: F.struct(F.lit(n).alias("parameter"), date.alias("date"))
    ends = base.groupBy("glider_id").agg(F.min("t_s").alias("a"), F.max("t_s").alias("b"))
    done = F.array(entry("TEMP", expr.epoch_to_compact(F.col("b"))), entry("PSAL", expr.epoch_to_compact(F.col("a"))), entry("PRES", F.lit("not a date")))
    dates = ends.select("glider_id", F.explode(done).alias("x")).select("glider_id", "x.*")
    return sx.second_sensors(pb.parameter_table(dep, SECOND_PARAMETERS), pb.sensor_table(dep), roles(spark), dates)


@query("second_exchange_platform", sql("SELECT glider_id, CASE glider_id WHEN 'G0' THEN 'deep model' WHEN 'G1' THEN 'unmapped:model-1' ELSE 'unmapped:model-2' END AS platform_model, 'the maker' AS platform_maker FROM (SELECT DISTINCT glider_id FROM l0)"))
def exchange_platform(spark, sf):
    dep = l0(spark, sf).select("glider_id").distinct()
    return sx.second_platform(dep.select("glider_id", F.concat(F.lit("model-"), F.substring("glider_id", 2, 9)).alias("platform_model"), F.lit("maker").alias("platform_maker")), roles(spark))


# -- delimited text, written and read back -----------------------------------------------------------------
def reread(df, date="DATE"):
    path = table_path(df.sparkSession)
    pb.write_delimited(df, path, date)
    return pb.read_delimited(df.sparkSession, path, df)


DATE_SQL = "strftime(make_timestamp(CAST({0} AS BIGINT)*1000000), '%Y/%m/%d %H:%M:%S')"


@query("written_export_adjusted", sql(
    f"SELECT glider_id, {DATE_SQL.format('t_s')} AS DATE, latitude AS LATITUDE, longitude AS LONGITUDE, round(temperature, 6) AS TEMP, temperature_QC AS TEMP_QC, round(oxygen_concentration, 6) AS DOXY, oxygen_concentration_QC AS DOXY_QC, round(lag_corrected, 6) AS DOXY_ADJUSTED, oxygen_concentration_QC AS DOXY_ADJUSTED_QC FROM ol", *L1))
def export_adjusted(spark, sf):
    return reread(rounded(pb.export_adjusted(l1(spark, sf), {"temperature": "TEMP", "oxygen_concentration": "DOXY"})))


@query("written_export_second", sql(
    f"SELECT * REPLACE ({DATE_SQL.format('TIME')} AS TIME, coalesce({DATE_SQL.format('TIME_GPS')}, '-1') AS TIME_GPS, "
    + ", ".join(f"round({c}, 3) AS {c}" for c in ("LATITUDE", "LONGITUDE", "LATITUDE_GPS", "LONGITUDE_GPS")) + ", " + ", ".join(f"CAST({c} AS INT) AS {c}" for c in ("DEPTH_QC", "SEA_TEMP_QC", "CURRENT_QC", "PHASE")) + ") FROM ax", *FLAGS, FULLQ, *AXIS_CTES))
def export_second(spark, sf):
    return reread(sx.export_second(second_axis(spark, sf)), "TIME")


# -- scalar expressions ---------------------------------------------------------------------------------
@query("expressions_position", sql(
    "SELECT glider_id, t_s, round(sgn*(floor(abs(v)/100) + (abs(v) - 100*floor(abs(v)/100))/60.0), 6) AS degrees, round(CASE WHEN seq % 2 = 0 THEN -1 ELSE 1 END*sgn*(floor(abs(v)/100) + (abs(v) - 100*floor(abs(v)/100))/60.0), 6) AS with_hemisphere FROM (SELECT *, 1234.5 + seq % 60 - CASE WHEN seq % 3 = 0 THEN 3000 ELSE 0 END AS v, CASE WHEN 1234.5 + seq % 60 - CASE WHEN seq % 3 = 0 THEN 3000 ELSE 0 END < 0 THEN -1 ELSE 1 END AS sgn FROM l0)".replace("1234.5 +", "1234.5::DOUBLE +")))
def position(spark, sf):
    v = F.lit(1234.5) + F.col("seq") % 60 - F.when(F.col("seq") % 3 == 0, 3000).otherwise(0)
    hemi = F.when(F.col("seq") % 2 == 0, "S").otherwise("N")
    return rounded(l0(spark, sf).select("glider_id", "t_s", expr.ddmm_to_degrees(v).alias("degrees"), expr.ddmm_to_degrees(v, hemi).alias("with_hemisphere")))


@query("expressions_dates", sql(
    "SELECT glider_id, t_s, round((t_s + 631152000)/86400.0::DOUBLE, 6) AS julian, t_s::DOUBLE AS back, strftime(make_timestamp(t_s*1000000), '%Y%m%d%H%M%S') AS compact, CASE WHEN seq % 4 <> 0 THEN t_s END AS parsed, strftime(make_timestamp(t_s*1000000), '%Y-%m-%dT%H:%M:%SZ') AS iso, CASE WHEN seq % 3 <> 0 THEN strftime(make_timestamp(t_s*1000000), '%Y-%m-%dT%H:%M:%SZ') END AS checked, round(((t_s % 86400)/3600.0 + 70.0/15) % 24, 6)::DOUBLE AS solar, ((t_s % 86400)/3600.0 + 70.0/15) % 24 > 6 AND ((t_s % 86400)/3600.0 + 70.0/15) % 24 < 18 AS is_day FROM l0"))
def dates(spark, sf):
    t = F.col("t_s")
    compact = expr.epoch_to_compact(t)
    iso = expr.epoch_to_iso(t)
    hour = expr.solar_hour(t, F.lit(70.0))
    return l0(spark, sf).select(
        "glider_id", "t_s", F.round(expr.epoch_to_julian(t), 6).alias("julian"), F.round(expr.julian_to_epoch(expr.epoch_to_julian(t)), 3).alias("back"),
        compact.alias("compact"), expr.compact_to_epoch(F.when(F.col("seq") % 4 == 0, "no date").otherwise(compact)).alias("parsed"), iso.alias("iso"),
        expr.valid_iso(F.when(F.col("seq") % 3 == 0, "not a date").otherwise(iso)).alias("checked"), F.round(hour, 6).alias("solar"), expr.is_day(hour).alias("is_day"),
    )


@query("expressions_test_lists", sql(
    "SELECT glider_id, profile_index, list_sort(list(DISTINCT k)) AS tests, lpad(upper(to_hex(bit_or(CAST(1 AS UBIGINT) << k))), 16, '0') AS word FROM (SELECT glider_id, profile_index, CAST(1 + (seq*7) % 63 AS INT) AS k FROM l0) GROUP BY 1, 2"))
def test_lists(spark, sf):
    k = (1 + (F.col("seq") * 7) % 63).cast("int")
    word = flags.hex_of_tests(F.collect_set(k))
    out = l0(spark, sf).groupBy("glider_id", "profile_index").agg(word.alias("word"))
    return out.withColumn("tests", flags.list_of_hex(F.col("word")))


@query("expressions_names", sql("SELECT variable_name, family, count(*) AS n FROM ml GROUP BY 1, 2", *L1, LONG_CTE))
def names(spark, sf):
    return long_rows(spark, sf).groupBy("variable_name", "family").agg(F.count(F.lit(1)).alias("n"))


@query("coverage_attributes_tests", sql(
    "SELECT glider_id, min(t_s) AS time_coverage_start, string_agg(DISTINCT 'TEST' || lpad(CAST(1 + (seq*5 + ascii(glider_id[2])) % 23 AS VARCHAR), 3, '0'), ' ' ORDER BY 'TEST' || lpad(CAST(1 + (seq*5 + ascii(glider_id[2])) % 23 AS VARCHAR), 3, '0')) AS rtqc_tests_applied FROM l0 WHERE seq % 4 = 1 OR seq = 0 GROUP BY 1"))
def attributes_tests(spark, sf):
    from ..functions.flags import hex_of_tests

    base = l0(spark, sf).filter("seq % 4 = 1 OR seq = 0")
    k = (1 + (F.col("seq") * 5 + F.ascii(F.substring("glider_id", 2, 1))) % 23).cast("int")
    reports = base.groupBy("glider_id", "profile_index").agg(hex_of_tests(F.collect_set(k)).alias("done_hex"))
    return pb.coverage_attributes(base, reports).select("glider_id", "time_coverage_start", "rtqc_tests_applied")
