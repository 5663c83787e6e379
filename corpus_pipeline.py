"""From raw documents to token ids: toxic documents go, then boilerplate lines, near-duplicates and documents with benchmark passages; the rest is encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermocline.llm import bpe, decontamination, line_dedup, minhash, toxicity
from thermocline.llm.queries import WORD_BPE
from thermocline.llm.registry import table
from thermocline.llm.rows import col_of, others
from thermocline.llm.storage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. Null and empty texts stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are on over 5 % of their source's documents; n_chars follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs, n_lines="line_dedup_lines", n_dropped="line_dedup_dropped").drop("line_dedup_lines", "line_dedup_dropped")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))
    return cleaned.select(*map(col_of, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id; null and empty texts stay."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, with digests of them and of what they decode to. Null and empty texts have no ids."""
    kept = others(docs, "text", "ids", "decoded")
    coded = bpe.encode(docs, WORD_BPE, decoded="decoded")
    added = {
        "ids": F.col("ids"),
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }
    return coded.select(*(col_of(c) for c in kept if c not in added), *(v.alias(k) for k, v in added.items()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL can express neither the classifier nor the encoder; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
