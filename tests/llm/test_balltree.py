"""Ranked search against scores of every pair."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from thermocline.llm import balltree

ITEMS = "item_id long, text string, `a.b` int"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counts = [(d, Counter(plain_words(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_words(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        found += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def own(spark, docs, items, k=10):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, score string, rank int").repartition(3)
    got = balltree.top_documents(frame, spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("tree_rows,leaf_rows,block_terms", [(2048, 16, 8192), (7, 2, 5)])
def test_equals_all_pairs(spark, monkeypatch, odd_rows, tree_rows, leaf_rows, block_terms):
    monkeypatch.setattr(balltree, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(balltree, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(balltree, "BLOCK_TERMS", block_terms)
    rng = np.random.default_rng(5)
    docs = odd_rows + [(100 + k, " ".join(f"W{int(x)}" for x in rng.zipf(1.4, 30) % 50)) for k in range(80)]
    docs += [(300 + k, "copy of one w1 w2 text") for k in range(30)] + [(2**60 + 1, "w3 rare")]
    items = [(1, "w1 w2, W3!"), (2, "copy TEXT"), (3, "never seen"), (4, None), (5, ""), (6, "tie twice key"), (6, "rare rare"), (None, "word é ß"), (8, " ".join(f"w{k}" for k in range(50)))]
    assert own(spark, docs, items) == brute(docs, items)


def test_nothing_to_search(spark):
    assert own(spark, [], [(1, "x")]) == [] and own(spark, [(1, "x")], []) == [] and own(spark, [(1, None), (2, "")], [(1, "x")]) == []


def test_keys_of_other_types(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three")], "key string, text string")
    items = spark.createDataFrame([("q", "One")], "name string, text string")
    assert [tuple(r)[:3] for r in balltree.top_documents(docs, items, key="key", item="name").collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_bounds_hold_and_prune(monkeypatch):
    monkeypatch.setattr(balltree, "LEAF_ROWS", 4)
    rng = np.random.default_rng(1)
    vocabulary = [f"t{k}" for k in range(60)]
    items = [[f"t{k}" for k in rng.choice(np.arange(20) + 20 * (n % 3), 8, replace=False)] for n in range(30)]
    block = balltree.Block(items, {t: int(w) for t, w in zip(vocabulary, rng.integers(1, 9000, 60))}, 100, 1000)
    rows = [np.sort(rng.choice(np.arange(20) + 20 * (n % 3), 6, replace=False)) for n in range(200)]
    values = [rng.integers(1, 10**10, 6) for _ in rows]
    tree = balltree.Tree(np.arange(201) * 6, np.concatenate(rows), np.concatenate(values), list(range(200)), block.group)
    below = {}

    def leaves(node):
        if node not in below:
            below[node] = tree.rows[node] if tree.children[node] is None else np.concatenate([leaves(c) for c in tree.children[node]])
        return below[node]

    assert sorted(leaves(0)) == list(range(200))
    scored = 0
    for q in block.queries(3):
        exact = tree.scores(np.arange(200), q.wanted)
        bounds = tree.bounds(q)
        for node, members in below.items():
            assert bounds[node] >= exact[members].max()
            assert tree.least[node] == members.min()
        q.search(tree)
        scored += q.scored
        assert sorted(((e[0], e[3]) for e in q.best), reverse=True) == sorted(((int(s), k) for k, s in enumerate(exact) if s in sorted(exact)[-3:] and s > 0), reverse=True)
    assert scored < 30 * 200 * 0.6


def test_equal_vectors_have_no_radius():
    block = balltree.Block([["a", "b"]], {"a": 7, "b": 11}, 10, 100)
    tree = balltree.Tree(np.arange(51) * 2, np.tile([0, 1], 50), np.tile([10**10 + 1, 3], 50), list(range(50)), block.group)
    assert tree.radii.max() == 0 and len(tree.rows) == 1
