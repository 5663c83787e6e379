"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import stats_join
from .fixture import L0_SQL

L0_CTE = f"l0 AS ({L0_SQL})"

# the two value screens of the minimum slice
SCREENED_CTE = (
    L0_CTE
    + """, cl AS (SELECT * REPLACE (
  CASE WHEN latitude = 0 AND longitude = 0 THEN NULL ELSE latitude END AS latitude,
  CASE WHEN latitude = 0 AND longitude = 0 THEN NULL ELSE longitude END AS longitude,
  CASE WHEN temperature < -2.5 OR temperature > 35 THEN NULL ELSE temperature END AS temperature) FROM l0)"""
)


# the series with the number of rows of its glider
SIZED_CTE = "sz AS (SELECT *, count(*) OVER (PARTITION BY glider_id) AS n_rows FROM l0)"


def sized(df: DataFrame) -> DataFrame:
    """`df` with the number of rows of each glider, for marks set at a share of the series."""
    return stats_join(df, df.groupBy("glider_id").agg(F.count(F.lit(1)).alias("n_rows")), ["glider_id"], "inner")


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join(ctes or (L0_CTE,)) + " " + body


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded so that the order of a sum does not show."""
    names = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})


def r(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
