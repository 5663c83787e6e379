"""Text and Parquet sources.

Every parser works on a table of lines (source_file, line), so files of any number and size are
split by Spark; `read_lines` supplies such a table from a folder.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import ddmm_to_degrees
from ..operators.ordered import DAY, Runs, number_rows, stats_join

FIRST_STAMP = 946_684_800  # 2000-01-01T00:00:00Z
# --- fixed values: patterns ----------------------------------------------------------------
GPS_LINE = r"GPS Location:\s+(-?\d+\.?\d*)\s+([NS])\s+(-?\d+\.?\d*)\s+([EW])"
HEADER_COLUMNS = ("Timestamp", "PLD_REALTIMECLOCK")
COLUMN_LINE = r"^\s*(?:global\s+)?(\w+)\s*=\s*(\d+)\s*;?\s*$"


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))


def scan_series(spark: SparkSession, path: str, gliders: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Aligned series from a Parquet table partitioned by glider; both filters reach the scan."""
    df = spark.read.parquet(path)
    if gliders:
        df = df.filter(F.col("glider_id").isin(*gliders))
    return df.select(*columns) if columns else df


def parse_payload(lines: DataFrame) -> DataFrame:
    """Semicolon-separated payload logs: (source_file, t, values).

    Each file carries its own header; names have `-` turned into `_`. Rows before 2000 go, then
    everything up to the last gap of more than 24 h in the file.
    """
    cells = F.transform(F.split("line", ";"), lambda c: F.trim(c))
    parsed = lines.filter(F.trim("line") != "").withColumn("cells", cells)
    names = F.transform("cells", lambda c: F.regexp_replace(c, "-", "_"))
    is_header = F.regexp_replace(F.col("cells")[0], "-", "_").isin(*HEADER_COLUMNS)
    headers = parsed.filter(is_header).groupBy("source_file").agg(F.min(names).alias("names"))
    rows = stats_join(parsed.filter(~is_header), headers, ["source_file"], "inner")
    stamp = F.coalesce(
        F.try_to_timestamp(F.col("cells")[0], F.lit("dd/MM/yyyy HH:mm:ss.SSS")), F.try_to_timestamp(F.col("cells")[0], F.lit("dd/MM/yyyy HH:mm:ss"))
    )
    width = F.least(F.size("names"), F.size("cells"))
    numbers = F.transform(F.slice("cells", F.lit(2), width - 1), lambda c: F.when(c != "", c).try_cast("double"))
    table = rows.select(
        "source_file", (F.unix_micros(stamp) / 1e6).alias("t"), F.map_from_arrays(F.slice("names", F.lit(2), width - 1), numbers).alias("values")
    ).filter(F.col("t") >= FIRST_STAMP)
    ordered = number_rows(table.select("source_file", "t"), ["source_file"], ["t"], F.floor(F.col("t") / DAY), out="__i")
    runs = Runs(ordered, keys=["source_file"], seq="__i", before=1)
    runs.with_columns({"__gap": F.col("t") - runs.lag("t")})
    cut = runs.done().filter(F.col("__gap") > DAY).groupBy("source_file").agg(F.max("t").alias("__cut"))
    return stats_join(table, cut, ["source_file"]).filter(F.col("__cut").isNull() | (F.col("t") >= F.col("__cut"))).drop("__cut")


def parse_segments(headers: DataFrame, data: DataFrame, stamp: str) -> DataFrame:
    """Segment tables whose header names the column of each variable: long (segment, t, variable, v).

    `headers` and `data` are lines with a `segment` column; `stamp` is the variable holding time.
    """
    names = headers.select(
        "segment", F.regexp_extract("line", COLUMN_LINE, 1).alias("variable"), F.regexp_extract("line", COLUMN_LINE, 2).alias("column")
    ).filter("variable <> ''").withColumn("column", F.col("column").cast("int"))
    cells = F.split(F.trim("line"), r"\s+")
    rows = data.filter(F.trim("line") != "").withColumn("cells", cells)
    t_col = names.filter(F.col("variable") == stamp).select("segment", F.col("column").alias("__t"))
    timed = stats_join(rows, t_col, ["segment"], "inner").withColumn("t", F.element_at("cells", F.col("__t")).try_cast("double"))
    long = timed.select("segment", "t", F.posexplode("cells").alias("pos", "cell")).withColumn("column", F.col("pos") + 1)
    value = F.col("cell").try_cast("double")
    joined = stats_join(long, names.filter(F.col("variable") != stamp), ["segment", "column"], "inner")
    return joined.select("segment", "t", "variable", F.when(~F.isnan(value), value).alias("v")).filter("v IS NOT NULL")


def parse_gps(lines: DataFrame) -> DataFrame:
    """Decimal positions of `GPS Location:` lines; positions within half a degree of an axis go."""
    part = lambda k: F.regexp_extract("line", GPS_LINE, k)
    found = lines.filter(F.col("line").rlike(GPS_LINE)).select(
        "source_file",
        ddmm_to_degrees(part(1).cast("double"), part(2)).alias("latitude"),
        ddmm_to_degrees(part(3).cast("double"), part(4)).alias("longitude"),
    )
    return found.filter((F.abs("latitude") > 0.5) & (F.abs("longitude") > 0.5))


def source_window(raw: DataFrame, margin_days: float = 30.0) -> DataFrame:
    """Most frequent start month over the files of each glider, widened by the margin."""
    month = F.date_format(F.timestamp_seconds("t0"), "yyyy-MM")
    starts = file_spans(raw).withColumn("month", month)
    best = starts.groupBy("glider_id", "month").agg(F.count(F.lit(1)).alias("n")).groupBy("glider_id").agg(
        F.min(F.struct((-F.col("n")).alias("k"), "month"))["month"].alias("month")
    )
    first = F.unix_timestamp(F.to_timestamp(F.concat("month", F.lit("-01")), "yyyy-MM-dd"))
    last = F.unix_timestamp(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1).cast("timestamp"))
    return best.select("glider_id", (first - margin_days * DAY).alias("w0"), (last + margin_days * DAY).alias("w1"))


def file_spans(raw: DataFrame) -> DataFrame:
    return raw.groupBy("glider_id", "source_file").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))


def contaminating_files(raw: DataFrame, window: DataFrame | None = None, margin_days: float = 30.0) -> DataFrame:
    """Files whose span leaves the window of their glider; an explicit window overrides."""
    bounds = window if window is not None else source_window(raw, margin_days)
    joined = stats_join(file_spans(raw), bounds.select("glider_id", "w0", "w1"), ["glider_id"], "inner")
    return joined.filter((F.col("t0") < F.col("w0")) | (F.col("t1") > F.col("w1"))).drop("w0", "w1")


def available_data(df: DataFrame, variables: list[str]) -> DataFrame:
    """Whether a variable has any value that is neither missing nor zero, per deployment."""
    cols = [F.bool_or(F.coalesce(F.col(v) != 0, F.lit(False))).alias(v) for v in variables]
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("available")) for v in variables])
    return df.groupBy("glider_id").agg(*cols).select("glider_id", F.explode(rows).alias("x")).select("glider_id", "x.*")


# numbers from narrow to wide: fractions make a double, other numbers a long, any other mixture a string
_WHOLE, _FRACTION = {"tinyint", "smallint", "int", "bigint"}, {"float", "double"}


def common_type(kinds: set[str]) -> str:
    """The type that holds values of all these types of one column."""
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= _WHOLE:
        return "bigint"
    return "double" if kinds <= _WHOLE | _FRACTION else "string"


def stack_segments(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables with different columns, missing ones NULL.

    Columns are one by name in any case of letters, spelt as in the first name in order, and come
    sorted; conflicting types follow `common_type`. So the result doesn't hang on the tables' order.
    """
    kinds: dict[str, set[str]] = {}
    names: dict[str, set[str]] = {}
    for table in tables:
        for f in table.schema:
            kinds.setdefault(f.name.lower(), set()).add(f.dataType.simpleString())
            names.setdefault(f.name.lower(), set()).add(f.name)
    kind = {k: common_type(v - {"void"} or {"string"}) for k, v in kinds.items()}

    def whole(table: DataFrame) -> DataFrame:
        own = {c.lower(): c for c in table.columns}
        return table.select(*[(F.col(f"`{own[k]}`") if k in own else F.lit(None)).cast(kind[k]).alias(min(names[k])) for k in sorted(kind)])

    return functools.reduce(DataFrame.union, map(whole, tables))


def read_segments(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Segment tables in Parquet, each with a schema of its own, stacked; a schema costs the driver one footer."""
    return stack_segments([spark.read.parquet(p) for p in paths])
