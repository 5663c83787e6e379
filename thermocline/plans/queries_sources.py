"""Registered queries: sources and metadata. Lines and metadata are made from the series by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metadata as md
from ..sources import readers as rd
from .common import L0_CTE, SIZED_CTE, rounded, sized, sql
from .fixture import l0
from ..session import table_path
from .registry import query

V = ["temperature", "chlorophyll", "cdom", "density"]


@query("scan_series", sql("SELECT glider_id, t_s, pressure FROM l0 WHERE glider_id IN ('G0', 'G2')"))
def scan(spark, sf):
    path = table_path(spark)
    l0(spark, sf).select("glider_id", "t_s", "pressure", "temperature").write.partitionBy("glider_id").parquet(path)
    return rd.scan_series(spark, path, ["G0", "G2"], ["glider_id", "t_s", "pressure"])


# one log per glider; rows before 2000 and two gaps of more than a day
LOG_T = "CASE WHEN seq % 50 = 7 THEN 900000000 + seq ELSE t_s + CASE WHEN seq >= floor(0.1*CAST(n_rows AS DOUBLE)) THEN 100000 ELSE 0 END END"


def payload_lines(spark, sf):
    base = sized(l0(spark, sf)).withColumn("t_s", F.expr(LOG_T))
    stamp = F.date_format(F.timestamp_seconds("t_s"), "dd/MM/yyyy HH:mm:ss")
    wide = F.when(F.col("seq") % 2 == 0, F.concat(stamp, F.lit(".500"))).otherwise(stamp)
    row = F.concat_ws(";", wide, F.col("pressure").cast("string"), F.coalesce(F.col("salinity").cast("string"), F.lit("")), F.when(F.col("seq") % 3 == 0, "").otherwise(F.col("seq").cast("string")))
    head = F.lit("PLD-REALTIMECLOCK;NAV-PRESSURE;GPCTD-SALINITY;NAV-COUNT")
    data = base.select(F.col("glider_id").alias("source_file"), row.alias("line"))
    return data.unionByName(base.select(F.col("glider_id").alias("source_file"), head.alias("line")).distinct())


@query("parse_payload_log", sql(
    f"""SELECT source_file, t, NAV_PRESSURE, NAV_COUNT FROM pl LEFT JOIN (SELECT source_file, max(t) AS cut FROM (SELECT *, t - lag(t) OVER (PARTITION BY source_file ORDER BY t) AS g FROM pl) WHERE g > 86400 GROUP BY 1) USING (source_file) WHERE cut IS NULL OR t >= cut""",
    L0_CTE, SIZED_CTE, f"pl AS (SELECT glider_id AS source_file, {LOG_T} + CASE WHEN seq % 2 = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS t, pressure AS NAV_PRESSURE, CASE WHEN seq % 3 <> 0 THEN seq::DOUBLE END AS NAV_COUNT FROM sz WHERE {LOG_T} >= 946684800)"))
def payload(spark, sf):
    out = rd.parse_payload(payload_lines(spark, sf))
    return out.select("source_file", "t", F.col("values")["NAV_PRESSURE"].alias("NAV_PRESSURE"), F.col("values")["NAV_COUNT"].alias("NAV_COUNT"))


@query("parse_segments", sql(
    "SELECT segment, t, variable, v FROM (SELECT glider_id || '_' || (profile_index // 20) AS segment, t_s::DOUBLE AS t, unnest(['sci_p', 'sci_n']) AS variable, unnest([pressure, CASE WHEN seq % 4 <> 0 THEN seq::DOUBLE END]) AS v FROM l0) WHERE v IS NOT NULL"))
def segments(spark, sf):
    base = l0(spark, sf).withColumns(
        {"segment": F.concat_ws("_", "glider_id", F.floor(F.col("profile_index") / 20).cast("string")), "odd": F.floor(F.col("profile_index") / 20) % 2 == 1}
    )
    count = F.when(F.col("seq") % 4 == 0, "NaN").otherwise(F.col("seq").cast("string"))
    # odd segments order their columns differently
    p, t = F.col("pressure").cast("string"), F.col("t_s").cast("string")
    line = F.when(F.col("odd"), F.concat_ws("  ", p, t, count)).otherwise(F.concat_ws(" ", t, p, count))
    data = base.select("segment", line.alias("line"))
    names = F.when(F.col("odd"), F.array(*[F.lit(x) for x in ("sci_p = 1;", "time = 2;", "sci_n = 3;")])).otherwise(
        F.array(*[F.lit(x) for x in ("time = 1;", "sci_p = 2;", "sci_n = 3;")])
    )
    headers = base.select("segment", "odd").distinct().select("segment", F.explode(names).alias("line"))
    return rd.parse_segments(headers, data, "time")


@query("parse_gps_lines", sql(
    "SELECT source_file, round(CASE WHEN seq % 2 = 0 THEN -1 ELSE 1 END*(12 + m/60.0), 6) AS latitude, round(CASE WHEN seq % 3 = 0 THEN -1 ELSE 1 END*(70 + m/60.0), 6) AS longitude FROM (SELECT glider_id AS source_file, seq, seq % 60 + 0.25::DOUBLE AS m FROM l0 WHERE seq % 4 <> 1)"))
def gps(spark, sf):
    m = F.col("seq") % 60 + 0.25
    line = F.concat(
        F.lit("GPS Location:  "), F.format_string("%.2f", 1200.0 + m), F.when(F.col("seq") % 2 == 0, " S ").otherwise(" N "),
        F.format_string("%.2f", 7000.0 + m), F.when(F.col("seq") % 3 == 0, " W").otherwise(" E"), F.lit(" measured 2.1 secs ago"),
    )
    noise = F.when(F.col("seq") % 4 == 1, F.concat(F.lit("sensor line "), F.col("seq").cast("string"))).otherwise(line)
    return rounded(rd.parse_gps(l0(spark, sf).select(F.col("glider_id").alias("source_file"), noise.alias("line"))))


FILES = "SELECT glider_id, 'f' || (profile_index % 12) AS source_file, t_s + CASE WHEN profile_index % 12 = 5 THEN 90000000 ELSE 0 END AS t FROM l0"


@query("source_contamination", sql(
    """SELECT glider_id, source_file, t0, t1 FROM sp JOIN (SELECT glider_id, arg_min(m, (-n, m)) AS m FROM (SELECT glider_id, strftime(make_timestamp(t0*1000000), '%Y-%m') AS m, count(*) AS n FROM sp GROUP BY 1, 2) GROUP BY 1) USING (glider_id)
    WHERE t0 < epoch(CAST(m || '-01' AS TIMESTAMP)) - 2592000 OR t1 > epoch(CAST(m || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH) + 2592000""",
    L0_CTE, f"sp AS (SELECT glider_id, source_file, min(t) AS t0, max(t) AS t1 FROM ({FILES}) GROUP BY 1, 2)"))
def contamination(spark, sf):
    base = l0(spark, sf).select(
        "glider_id", F.concat(F.lit("f"), (F.col("profile_index") % 12).cast("string")).alias("source_file"),
        (F.col("t_s") + F.when(F.col("profile_index") % 12 == 5, 90_000_000).otherwise(0)).alias("t"),
    )
    return rd.contaminating_files(base)


AV_CTE = "av AS (SELECT glider_id, v AS variable, bool_or(coalesce(x <> 0, false)) AS available FROM (SELECT glider_id, unnest(['temperature', 'chlorophyll', 'cdom', 'density']) AS v, unnest([temperature, CASE WHEN glider_id = 'G1' THEN 0 ELSE chlorophyll END, CASE WHEN glider_id <> 'G2' THEN cdom END, density]) AS x FROM l0) GROUP BY 1, 2)"


def availability(spark, sf):
    base = l0(spark, sf).withColumns({"chlorophyll": F.when(F.col("glider_id") == "G1", 0.0).otherwise(F.col("chlorophyll")), "cdom": F.when(F.col("glider_id") != "G2", F.col("cdom"))})
    return rd.available_data(base, V)


@query("available_data", sql("SELECT * FROM av", L0_CTE, AV_CTE))
def available(spark, sf):
    return availability(spark, sf)


def declared_links(spark, sf):
    links = F.array(*[F.struct(F.lit(a).alias("variable"), F.lit(b).alias("parameter")) for a, b in (("temperature", "TEMP"), ("cdom", "CDOM"), ("nitrate", "NITRATE"))])
    out = l0(spark, sf).select("glider_id").distinct().select("glider_id", F.explode(links).alias("x")).select("glider_id", "x.*")
    return out.withColumn("parameter", F.when((F.col("glider_id") == "G1") & (F.col("variable") == "cdom"), "FLUO").otherwise(F.col("parameter")))


LINK_CTE = "lk AS (SELECT glider_id, v AS variable, CASE WHEN glider_id = 'G1' AND v = 'cdom' THEN 'FLUO' ELSE p END AS parameter FROM (SELECT DISTINCT glider_id FROM l0), (VALUES ('temperature', 'TEMP'), ('cdom', 'CDOM'), ('nitrate', 'NITRATE')) AS x(v, p))"


@query("mapping_report", sql("SELECT glider_id, variable, parameter, CASE WHEN a.glider_id IS NULL THEN 'no data' WHEN parameter IS NULL THEN 'not mapped' ELSE 'mapped' END AS status FROM (SELECT * FROM av WHERE available) a FULL JOIN lk USING (glider_id, variable)", L0_CTE, AV_CTE, LINK_CTE))
def mapping(spark, sf):
    return md.mapping_report(availability(spark, sf), declared_links(spark, sf))


@query("link_report", sql("SELECT glider_id, variable, parameter AS declared, e AS expected, CASE WHEN e IS NULL THEN 'unknown variable' WHEN parameter IS NULL THEN 'never declared' ELSE 'different parameter' END AS status FROM lk FULL JOIN (SELECT DISTINCT variable, CASE variable WHEN 'temperature' THEN 'TEMP' WHEN 'cdom' THEN 'CDOM' ELSE upper(variable) END AS e FROM av) USING (variable) WHERE e IS NULL OR parameter IS NULL OR e <> parameter", L0_CTE, AV_CTE, LINK_CTE))
def links(spark, sf):
    v = F.col("variable")
    reference = availability(spark, sf).select(v, F.when(v == "temperature", "TEMP").when(v == "cdom", "CDOM").otherwise(F.upper(v)).alias("parameter")).distinct()
    return md.link_report(declared_links(spark, sf), reference)


META_CTE = "m1 AS (SELECT glider_id, 'P' || (profile_index % 5) AS parameter, 'coef' || (profile_index % 3) AS field, CAST(max(profile_index) AS VARCHAR) AS value FROM l0 GROUP BY 1, 2, 3), m2 AS (SELECT glider_id, 'P' || (profile_index % 5) AS parameter, 'coef' || (profile_index % 4) AS field, CAST(max(profile_index) AS VARCHAR) AS value FROM l0 GROUP BY 1, 2, 3)"


@query("metadata_diff", sql("SELECT glider_id, parameter, field, a.value AS value_1, b.value AS value_2, CASE WHEN b.glider_id IS NULL THEN 'only in 1' WHEN a.glider_id IS NULL THEN 'only in 2' ELSE 'differ' END AS status FROM m1 a FULL JOIN m2 b USING (glider_id, parameter, field) WHERE b.glider_id IS NULL OR a.glider_id IS NULL OR a.value <> b.value", L0_CTE, META_CTE))
def diff(spark, sf):
    def meta(k):
        p = F.col("profile_index")
        keys = (F.concat(F.lit("P"), (p % 5).cast("string")).alias("parameter"), F.concat(F.lit("coef"), (p % k).cast("string")).alias("field"))
        return l0(spark, sf).groupBy("glider_id", *keys).agg(F.max(p).cast("string").alias("value"))

    return md.metadata_diff(meta(3), meta(4))


FIELDS = {
    "sensor": "CASE WHEN glider_id = 'G2' THEN 'ODD_SENSOR' ELSE 'CTD' END", "sensor_of:TEMP": "'CTD'",
    "positioning": "CASE WHEN glider_id = 'G0' THEN 'GPS' ELSE 'SEXTANT' END", "deployment_start": "CASE WHEN glider_id = 'G1' THEN '20241301000000' ELSE '20240101000000' END",
    "latitude": "CASE WHEN max(pressure) > 0 AND glider_id = 'G0' THEN '95.5' ELSE '12.5' END", "operator": "CASE WHEN glider_id = 'G2' THEN ' ' ELSE 'someone' END",
}
VOCABULARY = [("sensor", "CTD"), ("sensor", "ECO"), ("positioning", "GPS"), ("positioning", "IRIDIUM")]


@query("vocabulary_violations", sql(
    """SELECT glider_id, field, value, 'not in vocabulary' AS rule FROM kv WHERE field IN ('sensor', 'positioning') AND NOT EXISTS (SELECT 1 FROM vc WHERE vc.field = kv.field AND vc.value = kv.value)
    UNION ALL SELECT glider_id, f, NULL, 'required' FROM (SELECT DISTINCT glider_id FROM kv), (VALUES ('sensor'), ('operator'), ('institution')) AS r(f) WHERE NOT EXISTS (SELECT 1 FROM kv WHERE kv.glider_id = glider_id AND field = f AND trim(value) <> '' AND kv.glider_id = kv.glider_id) AND f = 'institution'
    UNION ALL SELECT glider_id, 'operator', NULL, 'required' FROM kv WHERE field = 'operator' AND trim(value) = ''
    UNION ALL SELECT glider_id, field, value, 'date' FROM kv WHERE field = 'deployment_start' AND (NOT regexp_full_match(value, '\\d{14}') OR try_strptime(value, '%Y%m%d%H%M%S') IS NULL)
    UNION ALL SELECT glider_id, field, value, 'range' FROM kv WHERE field = 'latitude' AND NOT TRY_CAST(value AS DOUBLE) BETWEEN -90 AND 90
    UNION ALL SELECT glider_id, field, value, 'unknown sensor' FROM kv WHERE field = 'sensor_of:TEMP' AND value NOT IN (SELECT k2.value FROM kv k2 WHERE k2.field = 'sensor' AND k2.glider_id = kv.glider_id)""",
    L0_CTE, "kv AS (" + " UNION ALL ".join(f"SELECT glider_id, '{f}' AS field, {t} AS value FROM l0 GROUP BY glider_id" for f, t in FIELDS.items()) + ")",
    "vc(field, value) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in VOCABULARY) + ")"))
def vocabulary(spark, sf):
    tops = l0(spark, sf).groupBy("glider_id").agg(*[F.expr(t).alias(f"f{i}") for i, t in enumerate(FIELDS.values())])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f{i}").alias("value")) for i, f in enumerate(FIELDS)])
    kv = tops.select("glider_id", F.explode(rows).alias("x")).select("glider_id", "x.*")
    allowed = spark.createDataFrame(VOCABULARY, "field string, value string")
    return md.vocabulary_violations(kv, allowed, ["sensor", "operator", "institution"], ["deployment_start"], {"latitude": (-90.0, 90.0)})


# documents: one per glider, G2's cut off; coefficients by profile
DOCS_CTE = "ds AS (SELECT glider_id, max(profile_index) AS p, CASE WHEN glider_id = 'G0' THEN '95.5' ELSE '12.5' END AS la FROM l0 GROUP BY 1)"
DOC_ROWS = """dr AS (SELECT glider_id, unnest(['', '', 'sensor:CTD', 'sensor:CTD', 'TEMP', 'TEMP', 'TEMP', 'TEMP', 'DOXY', 'DOXY']) AS parameter, unnest(['positioning', 'latitude', 'name', 'maker', 'sensor', 'unit', 'calibration.slope', 'calibration.offset', 'sensor', 'unit']) AS field,
  unnest([CASE WHEN glider_id = 'G0' THEN 'GPS' ELSE 'SEXTANT' END, la, 'CTD', NULL, 'CTD', 'degC', p::VARCHAR, '0.25', 'OPTODE', NULL]) AS value FROM ds WHERE glider_id <> 'G2')"""


def documents(spark, sf):
    base = l0(spark, sf).groupBy("glider_id").agg(F.max("profile_index").alias("p"))
    la = F.when(F.col("glider_id") == "G0", "95.5").otherwise("12.5")
    facts = F.struct(F.when(F.col("glider_id") == "G0", "GPS").otherwise("SEXTANT").alias("positioning"), la.alias("latitude"))
    sensors = F.array(F.struct(F.lit("CTD").alias("name"), F.lit(None).cast("string").alias("maker")))
    slope = F.struct(F.col("p").alias("slope"), F.lit(0.25).alias("offset"))
    temperature = F.struct(F.lit("TEMP").alias("name"), F.lit("CTD").alias("sensor"), F.lit("degC").alias("unit"), slope.alias("calibration"))
    oxygen = F.struct(F.lit("DOXY").alias("name"), F.lit("OPTODE").alias("sensor"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("struct<slope:bigint,offset:double>").alias("calibration"))
    text = F.to_json(F.struct(facts.alias("metadata"), sensors.alias("sensors"), F.array(temperature, oxygen).alias("parameters")), {"ignoreNullFields": "false"})
    return base.select("glider_id", F.when(F.col("glider_id") == "G2", F.substring(text, 1, 30)).otherwise(text).alias("document"))


@query("metadata_documents", sql("SELECT glider_id, parameter, field, value FROM dr", L0_CTE, DOCS_CTE, DOC_ROWS))
def document_rows(spark, sf):
    return md.metadata_rows(documents(spark, sf))


@query("metadata_document_diff", sql(
    "SELECT glider_id, parameter, field, value AS value_1, CASE WHEN field = 'calibration.slope' THEN '7' ELSE value END AS value_2, 'differ' AS status FROM dr WHERE field = 'calibration.slope' AND value <> '7' UNION ALL SELECT glider_id, parameter, field, value, NULL, 'only in 1' FROM dr WHERE field = 'calibration.offset'",
    L0_CTE, DOCS_CTE, DOC_ROWS))
def document_diff(spark, sf):
    first = documents(spark, sf)
    second = first.withColumn("document", F.regexp_replace("document", r'"slope":\d+,"offset":0.25', '"slope":7'))
    return md.document_diff(first, second)


@query("metadata_document_violations", sql(
    """SELECT glider_id, field, value, 'not in vocabulary' AS rule FROM dr WHERE field = 'positioning' AND value <> 'GPS'
    UNION ALL SELECT glider_id, 'operator', NULL, 'required' FROM ds WHERE glider_id <> 'G2'
    UNION ALL SELECT glider_id, field, value, 'range' FROM dr WHERE field = 'latitude' AND value = '95.5'
    UNION ALL SELECT glider_id, 'sensor_of:DOXY', value, 'unknown sensor' FROM dr WHERE parameter = 'DOXY' AND field = 'sensor'
    UNION ALL SELECT glider_id, 'document', '{"metadata":{"positioning":"SE', 'malformed document' FROM ds WHERE glider_id = 'G2'""",
    L0_CTE, DOCS_CTE, DOC_ROWS))
def document_faults(spark, sf):
    allowed = spark.createDataFrame(VOCABULARY, "field string, value string")
    return md.document_violations(documents(spark, sf), allowed, ["operator", "sensor"], ["deployment_start"], {"latitude": (-90.0, 90.0)})


@query("stack_segments", sql(
    """SELECT glider_id, t_s::DOUBLE AS t_s, CASE g WHEN 0 THEN temperature END AS temperature, CASE g WHEN 1 THEN cdom WHEN 2 THEN profile_index::DOUBLE END AS Cdom, CASE g WHEN 2 THEN seq::VARCHAR WHEN 1 THEN 'none' END AS mark FROM (SELECT *, profile_index % 3 AS g FROM l0)"""))
def stacked(spark, sf):
    base = l0(spark, sf)
    part = lambda k: base.filter(F.col("profile_index") % 3 == k)
    tables = [
        part(0).select("t_s", "glider_id", "temperature"),
        part(1).select("glider_id", F.col("t_s").cast("double").alias("t_s"), F.col("cdom").alias("Cdom"), F.lit("none").alias("mark")),
        part(2).select(F.col("seq").cast("int").alias("mark"), "glider_id", F.col("profile_index").alias("cdom"), "t_s"),
    ]
    paths = [table_path(spark) for _ in tables]
    for table, path in zip(tables, paths):
        table.write.parquet(path)
    return rd.read_segments(spark, paths)
