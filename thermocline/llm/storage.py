"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from thermocline.session import table_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: what follows doesn't repeat what made it, and lost executors lose nothing.

    The folder is the one spark.checkpoint.dir names; without it a local master (tests) uses a
    private one and any other gets an error. Tables go when the process ends. name is for readers.
    """
    spark = df.sparkSession
    path = f"{table_path(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have, one for each of names."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
