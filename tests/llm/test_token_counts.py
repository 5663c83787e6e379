from tokenizers import Tokenizer

from thermocline.llm import token_counts
from thermocline.llm.queries import QUERIES, WORD_BPE


def expected(lengths):
    total = sum(lengths)
    distinct = sorted(set(lengths))
    return {
        x: dict(
            after=distinct[k - 1] if k else -1,
            n_docs=lengths.count(x),
            n_docs_from=sum(n >= x for n in lengths),
            n_tokens_from=sum(n for n in lengths if n >= x),
            n_docs_to=sum(n <= x for n in lengths),
            n_docs_all=len(lengths),
            n_tokens_all=total,
            truncated_total=sum(min(n, x) for n in lengths),
        )
        for k, x in enumerate(distinct)
    }


def answers_of(spark, lengths):
    hist = spark.createDataFrame([(n, lengths.count(n)) for n in set(lengths)], "length long, n_docs long")
    return token_counts.answers(hist)


def test_answers_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 4)
    lengths = [0, 0, 1, 3, 4, 4, 4, 9, 17, 17, 100]
    out = answers_of(spark, lengths)
    got = {r["length"]: {k: v for k, v in r.asDict().items() if k != "length"} for r in out.collect()}
    assert got == expected(lengths)
    limits = [0, 1, 2, 4, 5, 16, 17, 99, 100, 101, 10**9]
    at = {r["context_limit"]: (r["n_cut"], r["truncated_total"]) for r in token_counts.at_limits(out, limits).collect()}
    assert at == {x: (sum(n > x for n in lengths), sum(min(n, x) for n in lengths)) for x in limits}
    shares = [0.01, 0.1, 0.5, 0.9, 1.0]
    quantiles = {r["share"]: r["length"] for r in token_counts.quantiles(out, shares).collect()}
    assert quantiles == {s: next(x for x in sorted(set(lengths)) if sum(n <= x for n in lengths) >= s * len(lengths)) for s in shares}


def test_empty(spark, make_docs):
    out = token_counts.answers(token_counts.histogram(make_docs([]), WORD_BPE))
    assert out.count() == 0
    assert token_counts.at_limits(out, [5]).count() == 0


def test_odd_rows(make_docs, odd_rows):
    library = Tokenizer.from_file(WORD_BPE)
    lengths = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in odd_rows]
    got = {r["length"]: r["n_docs"] for r in token_counts.histogram(make_docs(odd_rows), WORD_BPE).collect()}
    assert got == {n: lengths.count(n) for n in lengths}


def test_query(spark, sf):
    library = Tokenizer.from_file(WORD_BPE)
    lengths = [len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["length"]: {k: v for k, v in r.asDict().items() if k != "length"} for r in QUERIES["op10_token_counts"](spark, sf).collect()}
    assert got == expected(lengths)
