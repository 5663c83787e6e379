import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for results or inside
        T.StructField("ids", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("gone_id", T.LongType()),
        T.StructField("a.b", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text[, source]) with clashing extra columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, "x", None, "y", 7, "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    long = "word " * 40_000 + "x" * 50_000
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "tie"), (6, "tie"), (7, "twice"), (7, "twice"), (None, "no key here at all"), (8, "é ß Σ İ \u0001 \U0001F600 ' \" \\ \x1c end")]
