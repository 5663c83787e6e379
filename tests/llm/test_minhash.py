import random

from thermocline.llm import minhash
from thermocline.llm.components import components


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain(rows):
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        sets[key] = frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)]) if words else frozenset()
    keys = sorted(sets)
    links = [(a, b) for a in keys for b in keys if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = union_find(keys, links)
    return {k: (len(sets[k]), of[k], of[k] == k) for k in keys}


def corpus(seed, n, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(90)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 10_000)}"
        rows.append((k * 3 + 1, " ".join(words)))
    return rows


def check(make_docs, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(make_docs(rows)).collect()}
    assert got == plain(rows)


def test_groups_as_all_pairs(make_docs):
    rows = corpus(1, 60, 6) + [(1000 + k, f"only words of document number {k} stand in this text {k * 7}") for k in range(20)]
    rows += [(2000 + k, "five words make one shingle") for k in range(5)] + [(3000, "Five  WORDS make\none shingle"), (3001, "few words"), (3002, "FEW words"), (3003, "few  words x")]
    rows += [(4000, None), (4001, ""), (4002, " \t\n"), (4003, "a b c d e " * 20_000)]
    check(make_docs, rows)


def test_blocks_of_large_groups(make_docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    check(make_docs, corpus(2, 80, 5))


def test_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(odd_rows)
    by = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in rows}
    assert by[1, 0] == (1, True) and by[2, 0] == (2, True) and by[3, 0] == (3, True)
    assert by[5, 1] == (5, True) and by[6, 1] == (5, False) and by[7, 1] == (7, True)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "7", "8", "None"])
    assert minhash.near_duplicates(make_docs([])).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(5, k) for k in range(200, 260)]
    more = [(rnd.randint(300, 360), rnd.randint(300, 360)) for _ in range(40)]
    edges = chain + hub + more + [(1, 1), (7, 3), (3, 7)]
    rnd.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find({x for e in edges for x in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
