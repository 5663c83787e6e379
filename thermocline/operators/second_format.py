"""The second exchange format: one time axis, mapped names, sensors, and its delimited text.

Names go through a mapping table (role, source, target, vocabulary). The target `TBD`, an empty
one, or a missing row means that the format has no such name. Of several rows for one source the
least target counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .align import one_axis
from .ordered import stats_join
from .publish import FILL, PHASES

# --- fixed values: the blocks' clocks, and the columns that need no mapping ----------------------------
CLOCKS = {"measurement": "TIME", "gps": "TIME_GPS", "currents": "WATERCURRENTS_TIME", "surface": "SURF_WATERCURRENTS_TIME"}
OWN_NAMES = {
    "LONGITUDE": "LONGITUDE", "LATITUDE": "LATITUDE", "PRES": "DEPTH", "TIME_GPS": "TIME_GPS",
    "LONGITUDE_GPS": "LONGITUDE_GPS", "LATITUDE_GPS": "LATITUDE_GPS", "PHASE": "PHASE",
}
FLAG_FILL = PHASES["none"]
NO_NAME = "TBD"


def known(mapping: DataFrame, role: str) -> DataFrame:
    """(source, target, vocabulary) of a role, one row for each source that has a target."""
    rows = mapping.filter((F.col("role") == role) & (F.col("target") != NO_NAME) & (F.trim("target") != ""))
    return rows.groupBy("source").agg(F.min(F.struct("target", "vocabulary")).alias("m")).select("source", "m.*")


def without_fill(name: str) -> Column:
    """A column as doubles, fill values as NULL."""
    flag = name.endswith("_QC") or name == "PHASE"
    value = F.col(name).cast("double")
    return F.when(value != (FLAG_FILL if flag else FILL), value)


def output_names(blocks: dict[str, DataFrame], mapping: DataFrame) -> dict[str, dict[str, str]]:
    """Source and target of the columns that stay, by block; a target belongs to the first that asks for it.

    Of the mapping only rows for columns of the blocks pass the driver.
    """
    asked = sorted({c for df in blocks.values() for c in df.columns})
    targets = {r.source: r.target for r in known(mapping.filter(F.col("source").isin(*asked)), "parameter").collect()}
    out: dict[str, dict[str, str]] = {b: {} for b in blocks}
    taken: set[str] = {"TIME", "glider_id"}
    for b in ("gps", "currents", "surface", "measurement"):
        if b not in blocks:
            continue
        # columns with a name of their own come first; a flag follows its parameter, or has a name itself
        columns = [c for c in blocks[b].columns if c != "glider_id" and (c != CLOCKS[b] or c in OWN_NAMES)]
        for c in sorted(columns, key=lambda c: (c.removesuffix("_QC") not in OWN_NAMES, c.endswith("_QC"))):
            base = c.removesuffix("_QC")
            if c != base and base in columns:
                target = out[b][base] + "_QC" if base in out[b] else None
            else:
                target = OWN_NAMES.get(c) or targets.get(c)
            if target and target not in taken:
                out[b][c] = target
                taken.add(target)
    return out


def second_table(blocks: dict[str, DataFrame], mapping: DataFrame) -> DataFrame:
    """Measurements, GPS fixes and currents, each with its own clock, as one table: glider_id, TIME and mapped names.

    `blocks`: by the names of `CLOCKS`, in exchange columns. Rows without a stamp and rows without
    any value go; names without target go. Rows of a block at one stamp count as one, each column
    with its largest value.
    """
    names = output_names(blocks, mapping)
    parts = []
    for b, df in blocks.items():
        rows = df.select(
            "glider_id", without_fill(CLOCKS[b]).alias("TIME"), *[without_fill(c).alias(n) for c, n in names[b].items()]
        )
        parts.append(rows.filter("TIME IS NOT NULL"))
    out = one_axis(parts, ("glider_id", "TIME"))
    values = [c for c in out.columns if c not in ("glider_id", "TIME")]
    return out.filter(F.coalesce(*values).isNotNull()) if values else out.limit(0)


def mapped_role(df: DataFrame, mapping: DataFrame, role: str, column: str, prefix: str = "unmapped:") -> DataFrame:
    """`column` through the mapping of `role`, its vocabulary beside it; a name without target stays, behind a prefix."""
    names = known(mapping, role).select(F.col("source").alias(column), F.col("target").alias("__target"), F.col("vocabulary").alias(f"{column}_vocabulary"))
    blank = F.col(column).isNull() | (F.trim(column) == "")
    name = F.when(blank, F.lit("")).otherwise(F.coalesce("__target", F.concat(F.lit(prefix), F.col(column))))
    return stats_join(df, names, [column]).withColumns({column: name, f"{column}_vocabulary": F.coalesce(f"{column}_vocabulary", F.lit(""))}).drop("__target")


def second_platform(deployment: DataFrame, mapping: DataFrame, prefix: str = "unmapped:") -> DataFrame:
    """Model and maker of each platform under the second vocabulary."""
    out = deployment.select("glider_id", "platform_model", "platform_maker")
    for role in ("platform_model", "platform_maker"):
        out = mapped_role(out, mapping, role, role, prefix).drop(f"{role}_vocabulary")
    return out


def second_sensors(
    parameters: DataFrame, sensors: DataFrame, mapping: DataFrame, derivations: DataFrame | None = None, prefix: str = "unmapped:"
) -> DataFrame:
    """The sensor behind each mapped parameter: type, maker, model, serial and calibration date.

    `derivations`: (glider_id, parameter, date as yyyyMMddHHmmss). The earliest valid date of any of
    its parameters is taken for the calibration of a sensor. Of sensors that repeat a name the first
    by slot counts; a parameter whose sensor isn't listed keeps the sensor's name only.
    """
    own = F.create_map(*[F.lit(x) for k, v in OWN_NAMES.items() for x in (k, v)])
    base = parameters.select("glider_id", F.col("parameter").alias("source"), "sensor").distinct()
    named = stats_join(base, known(mapping, "parameter"), ["source"]).withColumn("parameter", F.coalesce(own[F.col("source")], "target")).filter("parameter IS NOT NULL")
    first = sensors.groupBy("glider_id", "sensor").agg(F.min(F.struct("slot", "maker", "model", "serial")).alias("s")).select(
        "glider_id", "sensor", F.col("s.maker").alias("sensor_maker"), F.col("s.model").alias("sensor_model"), F.col("s.serial").alias("serial")
    )
    out = named.select("glider_id", "parameter", "sensor").join(first, ["glider_id", "sensor"], "left")
    if derivations is None:
        out = out.withColumn("calibration_date", F.lit(""))
    else:
        day = F.try_to_timestamp(F.col("date"), F.lit("yyyyMMddHHmmss"))
        dates = base.join(derivations.select("glider_id", F.col("parameter").alias("source"), day.alias("__day")), ["glider_id", "source"])
        dates = dates.groupBy("glider_id", "sensor").agg(F.date_format(F.min("__day"), "yyyy-MM-dd").alias("calibration_date"))
        out = out.join(dates, ["glider_id", "sensor"], "left").withColumn("calibration_date", F.coalesce("calibration_date", F.lit("")))
    out = out.withColumnRenamed("sensor", "sensor_type").withColumn("serial", F.coalesce("serial", F.lit("")))
    for role in ("sensor_type", "sensor_maker", "sensor_model"):
        out = mapped_role(out, mapping, role, role, prefix)
    return out


def second_attributes(table: DataFrame) -> DataFrame:
    """Extent of each deployment's table in place (both kinds of fixes), depth and time."""
    def extent(names: list[str], name: str) -> list[Column]:
        there = [F.col(c) for c in names if c in table.columns] or [F.lit(None).cast("double")]
        one = lambda f, row: f(row(*there)) if len(there) > 1 else f(there[0])
        return [one(F.min, F.least).alias(f"{name}_min"), one(F.max, F.greatest).alias(f"{name}_max")]

    stamp = lambda c: F.date_format(F.timestamp_seconds(F.floor(c)), "yyyyMMdd'T'HHmmss")
    return table.groupBy("glider_id").agg(
        *extent(["LATITUDE", "LATITUDE_GPS"], "geospatial_lat"), *extent(["LONGITUDE", "LONGITUDE_GPS"], "geospatial_lon"),
        *extent(["DEPTH"], "geospatial_vertical"),
        stamp(F.min("TIME")).alias("time_coverage_start"), stamp(F.max("TIME")).alias("time_coverage_end"),
    )


def export_second(table: DataFrame) -> DataFrame:
    """Delimited layout of the second table: dates as text (`-1` if missing), positions to three decimals, whole flags."""
    cols = []
    for c in table.columns:
        if c in ("TIME", "TIME_GPS"):
            text = F.date_format(F.timestamp_seconds(F.floor(c)), "yyyy/MM/dd HH:mm:ss")
            cols.append(F.coalesce(text, F.lit("-1")).alias(c))
        elif c.removesuffix("_GPS") in ("LATITUDE", "LONGITUDE"):
            cols.append(F.round(c, 3).alias(c))
        elif c.endswith("_QC") or c == "PHASE":
            cols.append(F.col(c).cast("int").alias(c))
        else:
            cols.append(F.col(c))
    return table.select(*cols)
