import random

import pytest
from tokenizers import Tokenizer

from thermocline.llm import bpe
from thermocline.llm.queries import QUERIES, WORD_BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def test_words_as_the_library(library):
    rnd = random.Random(1)
    letters = [chr(c) for c in [*range(1, 0x600), *range(0x1C80, 0x2200), *range(0x3040, 0x30FF), 0x10428, 0x1F600, 0xA7CB]]
    texts = ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(300)]
    texts += ["".join(rnd.choice("abcdefghijAEIOUΣσéèthe 'sdmtrevl0123!?.<|>") for _ in range(80)) for _ in range(300)]
    texts += ["<|endoftext|>a<|startoftext|> é<|endoftext|>x", "", " ", "a" * 3000, "ab" * 2000, "ΑΣ ΣΑΣ İ ǅ", "a\x1cb\x1d c", "é ́"]
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(WORD_BPE)))
    values, ends = encoder.ids(texts)
    for k, text in enumerate(texts):
        assert values[ends[k] : ends[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder.counts(texts).tolist() == (ends[1:] - ends[:-1]).tolist()


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(WORD_BPE)))
    for text in ("one two three four five", "five six", "one two"):
        assert encoder.ids([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows(make_docs, odd_rows, library, monkeypatch):
    docs = make_docs(odd_rows)
    out = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE)
    assert out.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert r["a.b"] == "z"
    assert bpe.encode(make_docs([]), WORD_BPE).count() == 0


def test_query(spark, sf, library):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op2_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
