"""Glider tables derived from the driver's `events` table.

The driver supplies no glider data, so the registered queries read an aligned series made
from `events` with arithmetic only. `COLUMNS` is text both engines understand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import number_rows

# rn: position in the glider's time order; k: position in a 40-row profile; p0: nominal pressure; u: noise in [0, 1)
COLUMNS = {
    "t_s": "1704067200 + 15*rn + CAST(floor(rn/800.0) AS bigint)*200000",
    "profile_index": "prof",
    "profile_direction": "CASE WHEN prof % 2 = 0 THEN 1 ELSE -1 END",
    "pressure": "CAST(CASE WHEN value > 300 THEN 2500.0 WHEN value > 270 THEN 1500.0 ELSE p0 END AS double)",
    "depth": "CAST(p0*0.99 AS double)",
    "temperature": "CAST(CASE WHEN event_type = 'error' AND value < 20 THEN NULL WHEN value > 250 THEN 60.0 "
    "ELSE 28.0 - 0.03*p0 + 0.2*u + CASE WHEN value BETWEEN 150 AND 165 THEN 5.0 ELSE 0.0 END END AS double)",
    "salinity": "CAST(34.0 + 0.003*p0 + 0.05*u + CASE WHEN value BETWEEN 200 AND 250 THEN 3.0 ELSE 0.0 END AS double)",
    "oxygen_concentration": "CAST(220.0 - 0.3*p0 + 5.0*u AS double)",
    "chlorophyll": "CAST(CASE WHEN rn % 3 = 0 THEN 2.0/(1.0 + 0.05*p0) + 0.1*u END AS double)",
    "cdom": "CAST(CASE WHEN rn % 3 = 1 THEN 1.5 + 0.001*p0 + 0.2*u + CASE WHEN value > 180 THEN 40.0 ELSE 0.0 END END AS double)",
    "backscatter_700": "CAST(CASE WHEN rn % 3 = 0 THEN 0.001 + 0.0005*u END AS double)",
    "density": "CAST(CASE WHEN value BETWEEN 120 AND 130 THEN 1025.0 ELSE 1022.0 + 0.0045*p0 + 0.3*u END AS double)",
    "conductivity": "CAST(5.2 - 0.0035*p0 + 0.02*u AS double)",
    "latitude": "CAST(CASE WHEN k = 0 THEN CASE WHEN value > 150 THEN 0.0 WHEN value > 100 THEN 12.5 "
    "ELSE 12.0 + 0.001*prof END END AS double)",
    "longitude": "CAST(CASE WHEN k = 0 THEN CASE WHEN value > 150 THEN 0.0 ELSE 70.0 + 0.001*prof END END AS double)",
    "waypoint_latitude": "CAST(CASE WHEN k < 2 THEN CASE WHEN u < 0.1 THEN 41.6 ELSE 12.8 END END AS double)",
    "waypoint_longitude": "CAST(CASE WHEN k < 2 THEN CASE WHEN u < 0.1 THEN -70.6 ELSE 70.9 END END AS double)",
    "pitch": "CAST(CASE WHEN prof % 2 = 0 THEN -26.0 ELSE 26.0 END + u AS double)",
}

L0_SQL = (
    "SELECT concat('G', CAST(g AS varchar)) AS glider_id, rn AS seq, "
    + ", ".join(f"{text} AS {name}" for name, text in COLUMNS.items())
    + " FROM (SELECT *, CASE WHEN prof % 2 = 0 THEN 5.0 + 12.5*k ELSE 5.0 + 12.5*(39-k) END AS p0 FROM "
    "(SELECT *, CAST(floor(rn/40.0) AS bigint) AS prof, rn % 40 AS k FROM "
    "(SELECT user_id % 3 AS g, event_type, value, value - floor(value) AS u, "
    "row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) - 1 AS rn FROM events)))"
)


#: rows of a glider that one task numbers, about
BUCKET_ROWS = 10_000


def l0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aligned series: one row per (glider, time), `seq` counting rows per glider."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates and keys are defined in UTC
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "event_type", "value", (F.col("user_id") % 3).alias("g")
    )
    # buckets grow in number with the rows, so that none grows
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.groupBy("g").agg(F.min(micros).alias("__lo"), F.max(micros).alias("__hi"), F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).alias("__n"))
    placed = events.join(F.broadcast(span), "g")
    share = (micros - F.col("__lo")) / (F.col("__hi") - F.col("__lo") + 1)
    ranked = number_rows(placed, ["g"], ["ts", "event_id"], F.floor(share * F.col("__n")), out="rn").drop("__lo", "__hi", "__n")
    base = (
        ranked.withColumn("u", F.expr("value - floor(value)"))
        .withColumn("prof", F.expr("CAST(floor(rn/40.0) AS bigint)"))
        .withColumn("k", F.expr("rn % 40"))
        .withColumn("p0", F.expr("CASE WHEN prof % 2 = 0 THEN 5.0 + 12.5*k ELSE 5.0 + 12.5*(39-k) END"))
    )
    return base.select(
        F.expr("concat('G', CAST(g AS string))").alias("glider_id"),
        F.col("rn").cast("bigint").alias("seq"),
        *[F.expr(text).alias(name) for name, text in COLUMNS.items()],
    )
