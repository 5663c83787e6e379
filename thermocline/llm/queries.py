"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermocline.llm import balltree, bitsliced, bpe, chat, decontamination, html_extract, line_dedup, minhash, pii, repair, secrets, token_counts, toxicity
from thermocline.llm.spans import count_of, joined, of_kinds
from thermocline.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

#: Tokenizer file of ops 2 and 10 and of the pipeline.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document."""
    return bpe.tokens(table(spark, sf_dir, "documents"), WORD_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op3_line_dedup",
    """WITH split AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (SELECT source, doc_id, unnest(list_distinct(list_transform(lines, lambda x: trim(x, ' ')))) AS line FROM split),
totals AS (SELECT source, count(*) AS n_host FROM documents GROUP BY source),
dropped AS (SELECT l.source, l.line FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source WHERE l.line <> ''
  GROUP BY l.source, l.line, t.n_host HAVING count(*) >= 2 AND count(*) > 0.05 * t.n_host),
lists AS (SELECT source, list(line) AS gone FROM dropped GROUP BY source),
kept AS (SELECT s.doc_id, s.source, s.lines, s.text, l.gone,
  list_filter(s.lines, lambda x: l.gone IS NULL OR NOT list_contains(l.gone, trim(x, ' '))) AS rest
  FROM split s LEFT JOIN lists l ON s.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, source, CASE WHEN gone IS NULL THEN text ELSE array_to_string(rest, chr(10)) END AS text,
  coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(rest), 0)::BIGINT AS n_dropped FROM kept""",
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines on over 5 % of its source's documents."""
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, quantile ranks and truncated totals of all documents, a row for every distinct length."""
    return token_counts.answers(token_counts.histogram(table(spark, sf_dir, "documents"), WORD_BPE))


@query("op7_minhash")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document, over links of similarity 0.75 or more on five-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def _words_sql(name: str, key: str) -> str:
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, regexp_extract_all({small}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM {name}"


@query(
    "op6_decontamination",
    f"""WITH d AS ({_words_sql('documents', 'doc_id')}), b AS ({_words_sql('benchmark', 'item_id')}),
win AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(ws) >= k)),
hit AS (SELECT DISTINCT doc_id, i, k, item_id FROM dw JOIN win USING (k, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.ws), 0)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document; held-out ones give no label to the model."""
    scored = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score", "predicted")


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [count_of("spans", k).alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(of_kinds("spans", pii.BASE)), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secrets.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [count_of("spans", k).alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(of_kinds("spans", secrets.BASE)), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query(
    "op9_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5""",
)
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all vectors, by quantised inner product, to every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op8_html")
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op12_repair")
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return repair.reports(repair.damage(table(spark, sf_dir, "conversations")))


@query("op13_chat")
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, read back from its formatted windows."""
    text = F.lit("</s>[INST] ok [/INST]")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    read = chat.read_back(chat.windows(turns)).select(
        "conv_id",
        F.struct(
            "part",
            "span",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
            F.array_join("targets", "").alias("targets"),
        ).alias("w"),
        F.size("turns").alias("n"),
        F.char_length("formatted").alias("chars"),
    )
    # the digests are of whole conversations, so each must be one value here; the windows need not
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"), F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    targets = F.array_join("ws.targets", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("ws.said", ""), 256).alias("turns_sha256"), F.char_length(targets).cast("long").alias("loss_chars"), F.sha2(targets, 256).alias("loss_sha256"), "formatted_chars"
    )


_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_SMALL}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


@query(
    "op11_lexical",
    f"""WITH d AS (SELECT doc_id, unnest(ws) AS t, len(ws) AS n FROM (SELECT doc_id, {_TERMS} AS ws FROM documents)),
tf AS (SELECT doc_id, t, n, count(*) AS tf FROM d GROUP BY doc_id, t, n),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM (SELECT len({_TERMS}) AS n FROM documents) WHERE n > 0),
w AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY t, big_n),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // l))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), total GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10""",
)
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that fit each benchmark item best."""
    return balltree.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
