"""Metadata checks: mappings, links, vocabularies. Metadata are key-value tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import stats_join


def mapping_report(available: DataFrame, mapping: DataFrame) -> DataFrame:
    """Raw variables against the mapping: `mapped`, `not mapped` (data only), `no data` (mapping only).

    `available`: glider_id, variable, available. `mapping`: glider_id, variable, parameter.
    """
    have = available.filter("available").select("glider_id", "variable", F.lit(True).alias("__d"))
    joined = have.join(mapping, ["glider_id", "variable"], "full")
    status = F.when(F.col("__d").isNull(), "no data").when(F.col("parameter").isNull(), "not mapped").otherwise("mapped")
    return joined.select("glider_id", "variable", "parameter", status.alias("status"))


def link_report(declared: DataFrame, reference: DataFrame) -> DataFrame:
    """Declared raw-to-standard links that disagree with the reference list."""
    a = declared.select("glider_id", "variable", F.col("parameter").alias("declared"))
    b = reference.select("variable", F.col("parameter").alias("expected"))
    joined = a.join(b, "variable", "full")
    status = (
        F.when(F.col("expected").isNull(), "unknown variable").when(F.col("declared").isNull(), "never declared")
        .when(F.col("declared") != F.col("expected"), "different parameter")
    )
    return joined.withColumn("status", status).filter("status IS NOT NULL")


def metadata_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Fields (deployment, parameter, field, value) present on one side only or differing."""
    keys = ["glider_id", "parameter", "field"]
    a = first.select(*keys, F.col("value").alias("value_1"), F.lit(True).alias("__1"))
    b = second.select(*keys, F.col("value").alias("value_2"), F.lit(True).alias("__2"))
    status = (
        F.when(F.col("__2").isNull(), "only in 1").when(F.col("__1").isNull(), "only in 2")
        .when(~F.col("value_1").eqNullSafe(F.col("value_2")), "differ")
    )
    return a.join(b, keys, "full").withColumn("status", status).filter("status IS NOT NULL").drop("__1", "__2")


def vocabulary_violations(metadata: DataFrame, vocabulary: DataFrame, required: list[str], dates: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows of deployment metadata that break a rule: (glider_id, field, value, rule).

    `metadata`: glider_id, field, value. `vocabulary`: field, value (allowed values of the listed
    fields). `sensor_of:<parameter>` fields must name a value of field `sensor`.
    """
    base = metadata.select("glider_id", "field", "value")
    listed = stats_join(base, vocabulary.select("field").distinct(), ["field"], "left_semi")
    unknown = stats_join(listed, vocabulary.select("field", "value"), ["field", "value"], "left_anti").withColumn("rule", F.lit("not in vocabulary"))
    # the required fields a deployment lacks
    have = base.filter(F.col("field").isin(*required) & (F.trim("value") != "")).groupBy("glider_id").agg(F.collect_set("field").alias("__have"))
    gliders = base.select("glider_id").distinct().join(have, "glider_id", "left")
    lacking = F.array_except(F.array(*[F.lit(f) for f in required]), F.coalesce("__have", F.array().cast("array<string>")))
    missing = gliders.select("glider_id", F.explode(lacking).alias("field"), F.lit(None).cast("string").alias("value"), F.lit("required").alias("rule"))
    bad_date = base.filter(
        F.col("field").isin(*dates) & (~F.col("value").rlike(r"^\d{14}$") | F.try_to_timestamp("value", F.lit("yyyyMMddHHmmss")).isNull())
    ).withColumn("rule", F.lit("date"))
    number = F.col("value").try_cast("double")
    outside = F.lit(False)
    for field, (low, high) in ranges.items():
        outside = outside | ((F.col("field") == field) & ~F.coalesce(number.between(low, high), F.lit(False)))
    bad_range = base.filter(outside).withColumn("rule", F.lit("range"))
    sensors = base.filter("field = 'sensor'").select("glider_id", "value")
    orphans = base.filter(F.col("field").startswith("sensor_of:")).join(sensors, ["glider_id", "value"], "left_anti").withColumn("rule", F.lit("unknown sensor"))
    out = unknown.unionByName(missing)
    for part in (bad_date, bad_range, orphans):
        out = out.unionByName(part)
    return out.select("glider_id", "field", "value", "rule")


#: What is read of a metadata document: facts, sensors, and parameters with their calibration.
DOCUMENT = (
    "metadata map<string,string>, sensors array<map<string,string>>, "
    "parameters array<struct<name:string, sensor:string, unit:string, calibration:map<string,string>>>, _corrupt_record string"
)
MALFORMED = "malformed document"


def _read(documents: DataFrame) -> DataFrame:
    read = documents.select("glider_id", "document", F.from_json("document", DOCUMENT, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("d"))
    return read.withColumn("bad", F.col("document").isNull() | F.col("d").isNull() | F.col("d._corrupt_record").isNotNull())


def metadata_rows(documents: DataFrame) -> DataFrame:
    """(glider_id, parameter, field, value) of JSON documents (glider_id, document).

    Facts of the deployment have the parameter '', those of a sensor its name; a parameter's
    calibration coefficients are fields `calibration.<name>`. Malformed documents give no rows:
    `document_violations` names them. Null values are facts too.
    """
    read = _read(documents).filter("NOT bad")
    fact = lambda parameter, field, value: F.struct(parameter.alias("parameter"), field.alias("field"), value.alias("value"))
    none = F.array().cast("array<struct<parameter:string,field:string,value:string>>")
    entries = lambda m, parameter, prefix="": F.coalesce(F.transform(F.map_entries(m), lambda e: fact(parameter, F.concat(F.lit(prefix), e["key"]), e["value"])), none)
    facts = entries(F.col("d.metadata"), F.lit(""))
    sensors = F.flatten(F.coalesce(F.transform("d.sensors", lambda s: entries(s, F.concat(F.lit("sensor:"), F.coalesce(s["name"], F.lit(""))))), F.array(none)))
    parameters = F.flatten(
        F.coalesce(
            F.transform(
                "d.parameters",
                lambda p: F.concat(F.array(fact(p["name"], F.lit("sensor"), p["sensor"]), fact(p["name"], F.lit("unit"), p["unit"])), entries(p["calibration"], p["name"], "calibration.")),
            ),
            F.array(none),
        )
    )
    return read.select("glider_id", F.explode(F.concat(facts, sensors, parameters)).alias("f")).select("glider_id", "f.*")


def document_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """`metadata_diff` of JSON documents, calibration coefficients included."""
    return metadata_diff(metadata_rows(first), metadata_rows(second))


def document_violations(documents: DataFrame, vocabulary: DataFrame, required: list[str], dates: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """`vocabulary_violations` of JSON documents; malformed ones are violations themselves. Every parameter's sensor must be one of the document's."""
    rows = metadata_rows(documents)
    field = (
        F.when(F.col("parameter").startswith("sensor:") & (F.col("field") == "name"), "sensor")
        .when(F.col("parameter").startswith("sensor:"), F.concat(F.lit("sensor_"), "field"))
        .when((F.col("parameter") != "") & (F.col("field") == "sensor"), F.concat(F.lit("sensor_of:"), "parameter"))
        .when(F.col("parameter") != "", F.concat("field", F.lit(":"), "parameter"))
        .otherwise(F.col("field"))
    )
    found = vocabulary_violations(rows.select("glider_id", field.alias("field"), "value"), vocabulary, required, dates, ranges)
    bad = _read(documents).filter("bad").select("glider_id", F.lit("document").alias("field"), F.substring("document", 1, 80).alias("value"), F.lit(MALFORMED).alias("rule"))
    return found.unionByName(bad)
