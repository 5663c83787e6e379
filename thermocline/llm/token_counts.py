"""Exact histogram of encoded lengths, and what its suffix sums answer for every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from thermocline.llm import bpe
from thermocline.llm.storage import stored

#: Lengths a window task sums; the blocks' own sums are one row each.
BLOCK = 1024


def histogram(docs: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """Columns length, n_docs. Null and empty texts have length 0; repeated rows count each. Counted before the shuffle."""
    return bpe.encoded_lengths(docs, vocabulary_path, text, "length").groupBy("length").agg(F.count("*").alias("n_docs"))


def answers(lengths: DataFrame) -> DataFrame:
    """One row a distinct length, in no order; from a histogram (length, n_docs). Empty in, empty out.

    after: the next smaller length, -1 for the smallest. The row answers every limit L with
    after < L <= length: n_docs_from documents reach L, and the total of all documents cut at L is
    n_tokens_all - n_tokens_from + L * n_docs_from; truncated_total is that for L = length.
    n_docs_to counts documents up to length: the quantile q is the smallest length with
    n_docs_to >= q * n_docs_all.

    Suffix sums go by blocks of lengths: one row a block meets in one task, and no window sees
    more than BLOCK lengths.
    """
    lengths = stored(lengths, "lengths").withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("n_docs") * F.col("length")
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = (
        lengths.groupBy("block")
        .agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"), F.max("length").alias("last"))
        .select(
            "block",
            F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
            F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_later"),
            F.sum("docs").over(whole).alias("n_docs_all"),
            F.sum("tokens").over(whole).alias("n_tokens_all"),
            F.max("last").over(earlier).alias("last_before"),
        )
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("block").orderBy("length")
    return (
        lengths.withColumns({"docs": F.sum("n_docs").over(inside), "tokens": F.sum(tokens).over(inside), "within": F.lag("length").over(before)})
        .join(blocks, "block")
        .withColumns({"n_docs_from": F.col("docs") + F.col("docs_later"), "n_tokens_from": F.col("tokens") + F.col("tokens_later")})
        .select(
            "length",
            F.coalesce("within", "last_before", F.lit(-1)).cast("long").alias("after"),
            "n_docs",
            "n_docs_from",
            "n_tokens_from",
            (F.col("n_docs_all") - F.col("n_docs_from") + F.col("n_docs")).alias("n_docs_to"),
            "n_docs_all",
            "n_tokens_all",
            (F.col("n_tokens_all") - F.col("n_tokens_from") + F.col("length") * F.col("n_docs_from")).alias("truncated_total"),
        )
    )


def at_limits(answered: DataFrame, limits: list[int]) -> DataFrame:
    """Columns context_limit, n_cut (documents longer than it), truncated_total: one row a limit of at least 0.

    A limit beyond every length gives the whole total. No row if there are no documents.
    """
    covered = F.filter(F.array(*(F.lit(int(x)).cast("long") for x in limits)), lambda x: (F.col("after") < x) & ((x <= F.col("length")) | (F.col("n_docs_from") == F.col("n_docs"))))
    limit, beyond = F.col("context_limit"), F.col("context_limit") > F.col("length")
    return answered.select("*", F.explode(covered).alias("context_limit")).select(
        limit,
        F.when(beyond, 0).when(limit == F.col("length"), F.col("n_docs_from") - F.col("n_docs")).otherwise(F.col("n_docs_from")).alias("n_cut"),
        F.when(beyond, F.col("n_tokens_all")).otherwise(F.col("n_tokens_all") - F.col("n_tokens_from") + limit * F.col("n_docs_from")).alias("truncated_total"),
    )


def quantiles(answered: DataFrame, shares: list[float]) -> DataFrame:
    """Columns share, length: the smallest length that at least this share of documents doesn't exceed. No row if there are no documents."""
    shares_of = F.filter(F.array(*(F.lit(float(s)) for s in shares)), lambda s: F.col("n_docs_to") >= s * F.col("n_docs_all"))
    return answered.select(F.explode(shares_of).alias("share"), "length").groupBy("share").agg(F.min("length").alias("length"))
