"""The pipeline's stages, each on odd rows and against a plain version on its own input."""

import corpus_pipeline
from tokenizers import Tokenizer

from thermocline.llm import decontamination, minhash
from thermocline.llm.queries import WORD_BPE


def test_stages_on_odd_rows(spark, make_docs, odd_rows, sf):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    for rows in (odd_rows, []):
        docs = make_docs(rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == len(rows)


def test_run(spark, sf):
    """From the second stage on, the stages' rules hold on what is left; the first keeps what its query doesn't mark."""
    from thermocline.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    marked = {r["doc_id"] for r in QUERIES["op1_toxicity"](spark, sf).collect() if r["predicted"]}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.where(~docs.doc_id.isin(*marked)) if marked else docs
    cleaned = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_boilerplate(spark, docs, sf).collect()}
    assert cleaned.keys() == texts.keys() - marked

    sets = {k: frozenset(minhash.shingle_set(minhash.words_of(t)).tolist()) for k, t in cleaned.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    left = {k for k in keys if find(k) == k}

    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        windows |= decontamination.windows_of(decontamination.words_of(r["text"]), decontamination.WINDOW)
    sizes = {len(w) for w in windows}

    def clean(text):
        hashes = decontamination._hashes(decontamination.words_of(text)).tolist()
        return not any(tuple(hashes[k : k + n]) in windows for n in sizes for k in range(len(hashes) - n + 1))

    left = {k for k in left if clean(cleaned[k])}
    library = Tokenizer.from_file(WORD_BPE)
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {k: library.encode(cleaned[k] or "", add_special_tokens=False).ids for k in left}
