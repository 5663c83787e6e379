import random

import numpy as np

from thermocline.llm import bitsliced


def plain(rows, asked, k=5):
    """By all pairs: every row counts, those of a query's own id don't meet it, and its rows share the ranks."""
    good = [
        (key, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for key, v in rows
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = {}
    for q in asked:
        mine = [v for key, v in good if key == q]
        scored = sorted((-min(max(sum(a * b for a, b in zip(own, v)), -(2**63)), 2**63 - 1), key) for own in mine for key, v in good if key != q and len(v) == len(own))
        out.update({(q, r): (key, -s) for r, (s, key) in enumerate(scored[:k], 1)})
    return out


def run(spark, rows, k=5):
    frame = spark.createDataFrame([(key, v, "other") for key, v in rows], "vec_id long, embedding array<float>, score string")
    got = bitsliced.top_k(frame, frame.where("vec_id % 50 = 0"), k).collect()
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got}


def test_as_all_scores(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "BLOCK_VECTORS", 100)
    monkeypatch.setattr(bitsliced, "BLOCK_QUERIES", 4)
    rnd = random.Random(1)
    rows = [(k, [rnd.gauss(0, 0.2) for _ in range(8)]) for k in range(420)]
    rows += [(1000 + k, [0.5] * 8) for k in range(150)]  # ties in number
    rows += [(2000, None), (2050, [0.1, None] + [0.0] * 6), (2100, [float("nan")] * 8), (2150, [float("inf")] + [0.0] * 7), (None, [0.5] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [0.5, -1.0]), (3050, [0.0, 0.0]), (4000, []), (4001, []), (5000, [9.0])]
    rows += [(0, rows[0][1]), (50, [0.25] * 8), (77, [9.0] * 8), (77, [-9.0] * 8)]  # repeated ids
    rows += [(6000, [300_000.0] + [0.0] * 7), (6001, [-300_000.0] + [1.0] * 7), (6050, [3e38] * 8), (6051, [1e30] + [0.5] * 7)]  # beyond slices and 64 bits
    asked = {k for k, _ in rows if k is not None and k % 50 == 0}
    assert run(spark, rows) == plain(rows, asked)


def test_few_and_none(spark):
    assert run(spark, []) == {}
    assert run(spark, [(50, [1.0])]) == {}
    assert run(spark, [(50, [1.0]), (7, [-2.5]), (3, [0.001])]) == {(50, 1): (3, 0), (50, 2): (7, -640 * 256)}


def test_sums():
    rnd = np.random.default_rng(2)
    matrix = rnd.integers(0, 500, (130, 6))
    slices = bitsliced.slice_bitmaps(matrix, 9)
    for query in rnd.integers(-40, 40, (20, 6)):
        sums = bitsliced.sum_slices(slices, query)
        total = sum(abs(q) * (matrix[:, d] if q > 0 else 511 - matrix[:, d]) for d, q in enumerate(query))
        bits = [np.unpackbits(s.view(np.uint8), bitorder="little")[:130] for s in sums]
        assert (sum(b.astype(np.int64) << k for k, b in enumerate(bits)) == total).all() if bits else (total == 0).all()
