"""Normal-form tables, exchange tables and idempotent loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import iso_micros, observation_id
from ..functions.flags import hex_to_word
from ..schema import ADJUSTED_SUFFIXES, BGC_VARIABLES, CONTEXT, FLAG_SUFFIX, STANDARD_NAMES
from .ordered import stats_join
from .segments import gps_fixes

PROFILE = ["glider_id", "profile_index"]
# --- fixed values: exchange tables ------------------------------------------------------------
FILL = 99_999.0
PHASES = {"subsurface": 2, "descent": 1, "ascent": 4, "none": -128}
ADJUSTED_SOURCE = {
    "temperature": "temperature_processed", "salinity": "salinity_processed",
    "oxygen_concentration": "oxygen_concentration_lag_corrected", "chlorophyll": "chlorophyll_corrected",
    "cdom": "cdom_corrected", "backscatter_700": "backscatter_700_corrected",
}
DEFAULT_SENSORS = [  # slot, name, maker, model
    ("ctd", "CTD", "Sea-Bird Scientific", "GPCTD"),
    ("optode", "AANDERAA_OPTODE", "Aanderaa", "4831"),
    ("optics", "ECO_FLBBCD", "Sea-Bird Scientific", "FLBBCD"),
]
PARAMETER_SENSOR = {
    "PRES": "ctd", "TEMP": "ctd", "PSAL": "ctd", "CNDC": "ctd", "DOXY": "optode",
    "CHLA": "optics", "CDOM": "optics", "BBP700": "optics", "TURBIDITY": "optics",
}


# -- normal form ------------------------------------------------------------------------------------
def measured_variables(df: DataFrame) -> list[str]:
    """Numeric columns that are neither context, flags nor derived from another column.

    Pressure counts as both context and measurement.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    derived = (FLAG_SUFFIX, *ADJUSTED_SUFFIXES)
    context = set(CONTEXT) - {"pressure"}
    return [c for c in df.columns if c in numeric and c not in context and not c.endswith(derived)]


def adjusted_column(df: DataFrame, variable: str) -> str | None:
    return next((variable + s for s in ADJUSTED_SUFFIXES if variable + s in df.columns), None)


def standard_name(variable: Column) -> Column:
    """Standard short name; unknown variables keep their own."""
    names = F.create_map(*[F.lit(x) for k, (n, _) in STANDARD_NAMES.items() for x in (k, n)])
    return F.coalesce(names[variable], variable)


def family(variable: Column) -> Column:
    return F.when(variable.isin(*BGC_VARIABLES), "bgc").otherwise("core")


def row_key() -> Column:
    return observation_id(F.col("glider_id"), iso_micros(F.col("t_s")))


def paired(l0: DataFrame, l1: DataFrame) -> DataFrame:
    """The two levels side by side on the union of their stamps: measured columns from L0, all flags and adjusted columns from L1."""
    keys = ["glider_id", "t_s"]
    raw = measured_variables(l0)
    only = [v for v in measured_variables(l1) if v not in raw]
    beside = [c for c in l1.columns if c.endswith((FLAG_SUFFIX, *ADJUSTED_SUFFIXES))]
    out = l0.select(*keys, *raw).join(l1.select(*keys, *beside), keys, "full")
    return out.withColumns({v: F.lit(None).cast("double") for v in only})


def measurements(df: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Long form: one row per (observation, variable), also where nothing was measured.

    `df` is the flagged level. With `raw`, values come from it alone and flags and adjusted values
    from `df`, aligned on time. Without a flag column of its own, a value or an adjusted value has
    the flag NULL: not assessed is not the same as missing.
    """
    base = df if raw is None else paired(raw, df)
    cells = []
    for v in measured_variables(base):
        adjusted = adjusted_column(base, v)
        none = F.lit(None)
        flag = lambda c: F.col(c + FLAG_SUFFIX) if c and c + FLAG_SUFFIX in base.columns else none
        cells.append(
            F.struct(
                F.lit(v).alias("variable"), F.col(v).cast("double").alias("value"), flag(v).cast("int").alias("qc_flag"),
                (F.col(adjusted) if adjusted else none).cast("double").alias("value_adjusted"),
                flag(adjusted).cast("int").alias("adjusted_qc_flag"),
            )
        )
    long = base.select(row_key().alias("observation_id"), "glider_id", "t_s", F.explode(F.array(*cells)).alias("x"))
    return long.select(
        "observation_id", "glider_id", "t_s", family(F.col("x.variable")).alias("family"), standard_name(F.col("x.variable")).alias("variable_name"),
        "x.value", "x.qc_flag", "x.value_adjusted", "x.adjusted_qc_flag",
    )


# fixed values: the columns of the observation table
OBSERVATION_FIELDS = {  # column here: column of the series
    "depth_m": "depth", "pressure": "pressure", "latitude": "latitude", "longitude": "longitude", "profile_id": "profile_index",
    "profile_direction": "profile_direction", "heading": "heading", "pitch": "pitch", "roll": "roll",
    "waypoint_latitude": "waypoint_latitude", "waypoint_longitude": "waypoint_longitude", "distance_over_ground": "distance_over_ground",
}


def observations(l0: DataFrame, l1: DataFrame | None = None) -> DataFrame:
    """Context of each sample; a column comes from L0 if L0 has it, else from L1."""
    keys = ["glider_id", "t_s"]
    from_l1 = [s for s in OBSERVATION_FIELDS.values() if l1 is not None and s not in l0.columns and s in l1.columns]
    base = l0 if l1 is None else l0.join(l1.select(*keys, *from_l1), keys, "full")
    fields = [F.col(s).alias(n) if s in base.columns else F.lit(None).cast("double").alias(n) for n, s in OBSERVATION_FIELDS.items()]
    return base.select(row_key().alias("observation_id"), *keys, *fields)


def measurement_full(observation: DataFrame, measurement: DataFrame) -> DataFrame:
    return observation.join(measurement.drop("glider_id", "t_s"), "observation_id")


def union_families(core: DataFrame, bgc: DataFrame) -> DataFrame:
    return core.withColumn("family", F.lit("core")).unionByName(bgc.withColumn("family", F.lit("bgc")))


def wide_measurements(observation: DataFrame, measurement: DataFrame, names: list[str]) -> DataFrame:
    """Every observation with X, X_ADJUSTED, X_QC and X_ADJUSTED_QC columns."""
    hit = lambda n, c: F.max(F.when(F.col("variable_name") == n, F.col(c)))
    cells = measurement.filter(F.col("variable_name").isin(*names)).groupBy("observation_id").agg(
        *[
            hit(n, c).alias(n + s)
            for n in names
            for c, s in (("value", ""), ("value_adjusted", "_ADJUSTED"), ("qc_flag", "_QC"), ("adjusted_qc_flag", "_ADJUSTED_QC"))
        ]
    )
    return observation.join(cells, "observation_id", "left")


def example_observation(measurement: DataFrame) -> DataFrame:
    """The observation that shows most: core and bgc rows with flag and adjusted value, else with
    flags, else with values; the smallest key among equals."""
    flagged, adjusted = F.col("qc_flag").isNotNull(), F.col("value_adjusted").isNotNull()
    levels = {1: flagged & adjusted, 2: flagged, 3: F.col("value").isNotNull()}
    per = measurement.groupBy("observation_id").agg(
        *[F.bool_or((F.col("family") == f) & m).alias(f"{f}_{k}") for k, m in levels.items() for f in ("core", "bgc")]
    )
    priority = F.lit(None).cast("int")
    for k in (3, 2, 1):
        priority = F.when(F.col(f"core_{k}") & F.col(f"bgc_{k}"), F.lit(k)).otherwise(priority)
    best = per.select("observation_id", priority.alias("priority")).filter("priority IS NOT NULL")
    return best.agg(F.min(F.struct("priority", "observation_id")).alias("b")).select("b.observation_id", "b.priority").filter("observation_id IS NOT NULL")


def key_collisions(df: DataFrame) -> DataFrame:
    """Keys shared by different (glider, stamp) pairs."""
    pairs = df.select(row_key().alias("observation_id"), "glider_id", "t_s").distinct()
    return pairs.groupBy("observation_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# -- loads ---------------------------------------------------------------------------------------------
def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; of rows that share a key the choice hangs on their values alone."""
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(*[c for c in rows.columns if c not in keys]))
    return rows.withColumn("__one", F.row_number().over(order)).filter("__one = 1").drop("__one")


def upsert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Table after loading `rows`: new keys added, known keys replaced; loading twice changes nothing."""
    new = one_per_key(rows, keys)
    return table.join(new.select(*keys), keys, "left_anti").select(*table.columns).unionByName(new.select(*table.columns))


def load_parquet(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Idempotent load into a table partitioned by glider and 30 days; only the periods in `rows` are rewritten.

    A folder a day would hold a few hundred rows of a slow record: the files, not the rows, were the work.
    A key fixes its glider and time, as observation keys do. The merged rows are written aside first, so a lost executor never re-reads files that are
    being replaced.
    """
    from pyspark.errors import AnalysisException

    from ..session import materialise

    spark = rows.sparkSession
    period = F.floor(F.col("t_s") / (30 * 86_400)) if "t_s" in rows.columns else F.lit(0)
    parts = ["glider_id", "load_period"]
    try:
        table = spark.read.parquet(path).select(*rows.columns, "load_period")
        touched = stats_join(table, rows.select("glider_id", period.alias("load_period")).distinct(), parts, "left_semi")
        merged = upsert(touched.select(*rows.columns), rows, keys)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        merged = one_per_key(rows, keys)
    done = materialise(merged).withColumn("load_period", period)
    (
        done.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path)
    )


# -- profiles and grids as files -------------------------------------------------------------------------
def profile_rows(df: DataFrame, variables: list[str], apply_qc: bool = False) -> DataFrame:
    """Profiles with a direction label; with `apply_qc` values flagged 3 or 4 are removed."""
    cleaned = {}
    for v in variables:
        if apply_qc and f"{v}_QC" in df.columns:
            cleaned[v] = F.when(~F.coalesce(F.col(f"{v}_QC").isin(3, 4), F.lit(False)), F.col(v))
    base = df.filter(F.col("profile_index").isNotNull()).withColumns(cleaned)
    label = base.groupBy(*PROFILE).agg(F.when(F.avg("profile_direction") > 0, "dive").otherwise("climb").alias("direction"))
    return base.join(label, PROFILE)


def write_profiles(df: DataFrame, path: str) -> None:
    """Profiles in Parquet, one folder per glider and thousand profiles, sorted by profile."""
    tasks = df.withColumn("profile_bucket", F.floor(F.col("profile_index") / 1_000)).repartition("glider_id", "profile_bucket")
    tasks.sortWithinPartitions(*PROFILE, "t_s").write.mode("overwrite").partitionBy("glider_id", "profile_bucket").parquet(path)


#: Retention as the grid's files carry it: of `retention`, without what its parts add up to.
PROVENANCE = {"assessed": "qc_n_assessed", "pct_good": "qc_pct_good", "pct_removed": "qc_pct_removed", "pct_missing": "qc_pct_missing"}


def write_grid(grid: DataFrame, path: str, retention: DataFrame | None = None) -> None:
    """Grid in Parquet, one folder per glider and variable, tasks split by profile.

    Flags can't survive binning, so the retention of each (glider, variable) travels with its
    cells, in columns that are constant in a file and cost nothing there. A variable without flags,
    or a grid without retention, has no provenance.
    """
    if retention is not None:
        kept = retention.select("glider_id", "variable", *[F.col(c).alias(n) for c, n in PROVENANCE.items()])
        grid = stats_join(grid, kept, ["glider_id", "variable"])
    tasks = grid.repartition("glider_id", "variable", F.floor(F.col("profile_index") / 1_000))
    tasks.sortWithinPartitions(*PROFILE, "cell").write.mode("overwrite").partitionBy("glider_id", "variable").parquet(path)


def grid_retention(written: DataFrame) -> DataFrame:
    """Retention of each (glider, variable) from the files of `write_grid` alone; none for those written without."""
    if not set(PROVENANCE.values()) <= set(written.columns):
        return written.sparkSession.createDataFrame([], "glider_id string, variable string, assessed long, pct_good double, pct_removed double, pct_missing double")
    own = written.groupBy("glider_id", "variable").agg(*[F.first(n, ignorenulls=True).alias(c) for c, n in PROVENANCE.items()])
    return own.filter("assessed IS NOT NULL").withColumns({"glider_id": F.col("glider_id").cast("string"), "variable": F.col("variable").cast("string")})


def export_rows(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Delimited-export layout: date, position, phase, then each parameter with its flag."""
    cols = [F.date_format(F.timestamp_seconds("t_s"), "yyyy/MM/dd HH:mm:ss").alias("DATE"), F.col("latitude").alias("LATITUDE"), F.col("longitude").alias("LONGITUDE")]
    if "phase" in df.columns:
        cols += [F.col("phase").alias("PHASE"), F.col("phase_number").alias("PHASE_NUMBER")]
    for v, n in names.items():
        flag = F.col(f"{v}_QC") if f"{v}_QC" in df.columns else F.lit(0)
        cols += [F.col(v).alias(n), flag.cast("int").alias(f"{n}_QC")]
    return df.select("glider_id", *cols)


def export_adjusted(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The same layout with X_ADJUSTED and its flag behind each parameter that has adjusted values.

    An adjusted column without flags of its own has the flag of its parameter, as in the exchange table.
    """
    out, extra = df, {}
    for v, n in names.items():
        extra[v] = n
        adjusted = adjusted_column(df, v)
        if adjusted:
            own = F.col(adjusted + FLAG_SUFFIX) if adjusted + FLAG_SUFFIX in df.columns else F.col(v + FLAG_SUFFIX) if v + FLAG_SUFFIX in df.columns else F.lit(0)
            out = out.withColumn(adjusted + FLAG_SUFFIX, own)
            extra[adjusted] = n + "_ADJUSTED"
    return export_rows(out, extra)


# quotes are doubled and blanks kept; NULL and an empty text are both an empty field, read as NULL
DELIMITED = {"sep": ";", "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_delimited(df: DataFrame, path: str, date: str = "DATE") -> None:
    """Delimited text, one folder per glider and month, each file in order of `date` (yyyy/MM/...).

    No task holds more than a month of a glider. Values are written in full, not cut to six digits.
    Line breaks inside a text become blanks, so that files can be split when read.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != "glider_id"]
    df = df.withColumns({c: F.translate(c, "\r\n", "  ") for c in texts})
    month = F.coalesce(F.replace(F.substring(date, 1, 7), F.lit("/"), F.lit("-")), F.lit("none"))
    tasks = df.withColumn("month", month).repartition("glider_id", "month").sortWithinPartitions("glider_id", "month", date)
    tasks.write.mode("overwrite").options(**DELIMITED).partitionBy("glider_id", "month").csv(path)


def read_delimited(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What `write_delimited` has written, in the columns and types of `like`."""
    schema = T.StructType([f for f in like.schema if f.name != "glider_id"] + [T.StructField("glider_id", T.StringType()), T.StructField("month", T.StringType())])
    return spark.read.options(**DELIMITED).schema(schema).csv(path).select(*like.columns)


# -- exchange tables -----------------------------------------------------------------------------------
def per_kilogram(value: Column, density: Column) -> Column:
    """Micromoles per litre to per kilogram; NULL for implausible densities."""
    kg = density / 1000.0
    return F.when(kg > 0.5, value / kg)


def exchange_table(df: DataFrame, is_l1: bool = True) -> DataFrame:
    """Standard names, fill values, flags (0 where untested) and adjusted columns.

    The adjusted column falls back to the raw values where its span exceeds theirs by 20 %.
    """
    names = {v: n for v, (n, _) in STANDARD_NAMES.items() if v in df.columns and v != "density"}
    if "oxygen_concentration" in names and "density" in df.columns:
        # value and adjusted value share the unit change
        o2 = {c: per_kilogram(F.col(c), F.col("density")) for c in ("oxygen_concentration", ADJUSTED_SOURCE["oxygen_concentration"]) if c in df.columns}
        df = df.withColumns(o2)
    fill = lambda c: F.coalesce(c.cast("double"), F.lit(FILL))
    sources = {v: s for v, s in ADJUSTED_SOURCE.items() if is_l1 and v in names and s in df.columns}
    if sources:
        span = lambda c: F.max(c) - F.min(c)
        wide = df.groupBy("glider_id").agg(
            *[F.coalesce(span(s) > span(v) * 1.2, F.lit(False)).alias(f"__wide_{v}") for v, s in sources.items()]
        )
        df = stats_join(df, wide, ["glider_id"])
    cols: list[Column] = [F.col("t_s").alias("TIME")]
    for v, n in names.items():
        cols.append(fill(F.col(v)).alias(n))
        if not is_l1:
            continue
        flag = F.col(f"{v}_QC").cast("int") if f"{v}_QC" in df.columns else F.lit(0)
        adjusted = F.when(F.col(f"__wide_{v}"), F.col(v)).otherwise(F.col(sources[v])) if v in sources else F.lit(None)
        cols += [
            flag.alias(f"{n}_QC"), fill(adjusted).alias(f"{n}_ADJUSTED"), flag.alias(f"{n}_ADJUSTED_QC"),
            F.lit(FILL).alias(f"{n}_ADJUSTED_ERROR"),
        ]
    return df.select("glider_id", *cols)


def exchange_positions(df: DataFrame, is_l1: bool = True) -> DataFrame:
    flag = F.col("latitude_QC").cast("int") if is_l1 and "latitude_QC" in df.columns else F.lit(1)
    return df.select(
        "glider_id", F.col("t_s").alias("TIME"), F.coalesce("latitude", F.lit(FILL)).alias("LATITUDE"),
        F.coalesce("longitude", F.lit(FILL)).alias("LONGITUDE"), flag.alias("POSITION_QC"),
    )


def exchange_gps(df: DataFrame) -> DataFrame:
    """Surface fixes; a glider without any gets one row of fill values."""
    fixes = gps_fixes(df).select("glider_id", F.col("t_s").cast("double").alias("TIME_GPS"), F.col("latitude").alias("LATITUDE_GPS"), F.col("longitude").alias("LONGITUDE_GPS"))
    empty = df.select("glider_id").distinct().join(fixes.select("glider_id").distinct(), "glider_id", "left_anti")
    return fixes.unionByName(empty.select("glider_id", *[F.lit(FILL).alias(c) for c in fixes.columns[1:]]))


def phase_from_direction(df: DataFrame) -> DataFrame:
    d = F.col("profile_direction")
    phase = (
        F.when(d.isNull(), PHASES["none"]).when(d > 0, PHASES["descent"]).when(d < 0, PHASES["ascent"]).otherwise(PHASES["subsurface"])
    )
    return df.withColumns(
        {"PHASE": phase, "PHASE_NUMBER": F.coalesce(F.col("profile_index").cast("bigint"), F.lit(int(FILL)).cast("bigint"))}
    )


def sensor_table(deployment: DataFrame) -> DataFrame:
    """Sensors per deployment; `metadata` (map) overrides name, maker, model and serial."""
    meta = F.col("metadata") if "metadata" in deployment.columns else F.lit(None).cast("map<string,string>")
    rows = [
        F.struct(
            F.lit(slot).alias("slot"), F.coalesce(meta[f"{slot}_sensor_name"], F.lit(name)).alias("sensor"),
            F.coalesce(meta[f"{slot}_maker"], F.lit(maker)).alias("maker"), F.coalesce(meta[f"{slot}_model"], F.lit(model)).alias("model"),
            F.coalesce(meta[f"{slot}_serial"], F.lit("")).alias("serial"),
        )
        for slot, name, maker, model in DEFAULT_SENSORS
    ]
    return deployment.select("glider_id", F.explode(F.array(*rows)).alias("s")).select("glider_id", "s.*")


def parameter_table(deployment: DataFrame, variables: list[str]) -> DataFrame:
    """Parameters with the sensor that provides them and data mode R."""
    names = [STANDARD_NAMES.get(v, (v, ""))[0] for v in variables]
    fixed = {slot: name for slot, name, _, _ in DEFAULT_SENSORS}
    rows = [
        F.struct(F.lit(n).alias("parameter"), F.lit(fixed[PARAMETER_SENSOR.get(n, "ctd")]).alias("sensor"), F.lit("R").alias("data_mode"))
        for n in names
    ]
    return deployment.select("glider_id", F.explode(F.array(*rows)).alias("p")).select("glider_id", "p.*")


def coverage_attributes(df: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """Bounding box, time coverage and id of each glider; with test `reports` also the list of applied tests."""
    at = lambda f, c: f(F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.col(c)))
    out = df.groupBy("glider_id").agg(
        at(F.min, "latitude").alias("geospatial_lat_min"), at(F.max, "latitude").alias("geospatial_lat_max"),
        at(F.min, "longitude").alias("geospatial_lon_min"), at(F.max, "longitude").alias("geospatial_lon_max"),
        F.min("t_s").alias("time_coverage_start"), F.max("t_s").alias("time_coverage_end"),
    ).withColumn("id", F.concat("glider_id", F.lit("_"), F.date_format(F.timestamp_seconds("time_coverage_start"), "yyyyMMdd")))
    return out if reports is None else stats_join(out, applied_tests(reports), ["glider_id"])


def applied_tests(reports: DataFrame) -> DataFrame:
    """(glider_id, rtqc_tests_applied): the numbers of all tests done on any profile or product of a glider, in order.

    `reports`: glider_id, done_hex (16 hexadecimal digits, bit k for test k). Words are combined by
    a bitwise OR that tasks do before any shuffle.
    """
    words = reports.groupBy("glider_id").agg(F.bit_or(hex_to_word(F.col("done_hex"))).alias("word"))
    numbers = F.filter(F.sequence(F.lit(1), F.lit(63)), lambda k: F.call_function("bit_get", F.col("word"), k) == 1)
    names = F.transform(numbers, lambda k: F.concat(F.lit("TEST"), F.lpad(k.cast("string"), 3, "0")))
    return words.select("glider_id", F.array_join(names, " ").alias("rtqc_tests_applied"))


def creation_flags(df: DataFrame, variables: list[str]) -> DataFrame:
    """Flag columns holding only defaults become 0 where the value is present; data mode per glider."""
    touched = df.groupBy("glider_id").agg(
        *[F.bool_or(F.col(f"{v}_QC") >= 0).alias(f"__t_{v}") for v in variables],
        *[F.bool_or(F.col(f"{v}_adjusted").isNotNull()).alias(f"__a_{v}") for v in variables if f"{v}_adjusted" in df.columns],
    )
    out = stats_join(df, touched, ["glider_id"])
    cols = {}
    for v in variables:
        default = ~F.coalesce(F.col(f"__t_{v}"), F.lit(False))
        cols[f"{v}_QC"] = F.when(default & F.col(v).isNotNull(), F.lit(0)).otherwise(F.col(f"{v}_QC").cast("int"))
        adjusted = F.coalesce(F.col(f"__a_{v}"), F.lit(False)) if f"__a_{v}" in out.columns else F.lit(False)
        cols[f"{v}_mode"] = F.when(adjusted, "A").otherwise("R")
    return out.withColumns(cols).drop(*[c for c in out.columns if c.startswith(("__t_", "__a_"))])


def profile_product(df: DataFrame, variables: list[str]) -> DataFrame:
    """One row per profile: direction, data modes, date, place, levels."""
    from .align import profile_place

    base = df.filter(F.col("profile_index").isNotNull())
    has = {v: adjusted_column(df, v) for v in variables}
    mode = {v: F.bool_or(F.col(a).isNotNull()) if a else F.bool_or(F.lit(False)) for v, a in has.items()}
    rows = base.groupBy(*PROFILE).agg(
        F.when(F.avg("profile_direction") > 0, "D").otherwise("A").alias("direction"),
        F.count(F.lit(1)).alias("levels"), *[F.when(m, "A").otherwise("R").alias(f"{v}_mode") for v, m in mode.items()],
    )
    any_adjusted = F.greatest(*[(F.col(f"{v}_mode") == "A").cast("int") for v in variables], F.lit(0)) == 1
    return rows.withColumn("data_mode", F.when(any_adjusted, "A").otherwise("R")).join(profile_place(base), PROFILE)


def mapped_names(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Names through a mapping table (source, target); `TBD` keeps the original behind a prefix."""
    joined = stats_join(df, mapping.select(F.col("source").alias(column), "target"), [column])
    target = F.when(F.col("target") == "TBD", F.concat(F.lit("unmapped:"), F.col(column))).otherwise(F.coalesce("target", F.col(column)))
    return joined.withColumn(f"{column}_mapped", target).drop("target")


def second_exchange(measurement: DataFrame, mapping: DataFrame) -> DataFrame:
    """Measurement rows under the second vocabulary; parameters mapped to `TBD` are dropped."""
    joined = stats_join(measurement, mapping.select(F.col("source").alias("variable_name"), "target"), ["variable_name"])
    return joined.filter(F.coalesce(F.col("target") != "TBD", F.lit(True))).withColumn("variable_name", F.coalesce("target", "variable_name")).drop("target")
