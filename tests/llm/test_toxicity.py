import numpy as np

from thermocline.llm import toxicity

CLEAN = "the garden was quiet and the river ran past the old house where people talked about weather".split()
BAD = ["idiot", "moron", "worthless", "clown"]


def labelled(n=160):
    rows, labels = [], []
    for k in range(n):
        words = [CLEAN[(k * 7 + j * 3) % len(CLEAN)] for j in range(30)]
        if k % 4 == 0:
            words[3], words[9] = BAD[k // 4 % 4], BAD[(k // 4 + 1) % 4]
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    return rows, labels


def test_scores(spark, make_docs):
    rows, labels = labelled()
    more = [(1000, "the quiet 1d10t by the river"), (1001, "you m.o.r.o.n and you clooown"), (1002, "an i d i o t in the garden"), (1003, "people talked about the weather"), (1004, None), (1005, ""), (1006, "the river " * 30_000), (1003, "people talked about the weather"), (None, "a moron and a clown")]
    docs = make_docs(rows + more)
    table = spark.createDataFrame([*labels, (5, None), (None, 1), (3, 0), (4, 1), (9999, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, table)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    got = out.select("doc_id", "text", "score", "predicted").collect()
    assert len(got) == len(rows) + len(more)
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["predicted"] == int(k % 4 == 0) for k, _ in rows)
    assert [by[k]["predicted"] for k in (1000, 1001, 1002, 1003, 1004, 1005, 1006, None)] == [1, 1, 1, 0, 0, 0, 0, 1]
    assert all(0 <= r["score"] <= 1 for r in got) and by[1004]["score"] == by[1005]["score"]
    kept = toxicity.drop_toxic(docs, table)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if not r["predicted"]}


def test_held_out_labels_are_not_read(spark):
    labels = spark.createDataFrame([(k, 1) for k in range(200)], "doc_id long, toxic int")
    import zlib

    assert {r["doc_id"] for r in toxicity.training_labels(labels).collect()} == {k for k in range(200) if zlib.crc32(str(k).encode()) % 4 != 2}


def test_without_labels_or_documents(spark, make_docs):
    rows, labels = labelled(8)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(make_docs(rows), none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(make_docs(rows), one).collect())
    assert toxicity.toxicity(make_docs([]), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_counts_of_runs(make_docs):
    text = ["ab cd", None, "", "éÉ, x"]
    got = {r["gram"]: r["n"] for r in toxicity.gram_counts(make_docs([(k, t) for k, t in enumerate(text)])).collect()}
    assert sum(got.values()) > 0
    spelled = " ab cd ee x "
    codes = [0, 0] + [0 if c == " " else ord(c) - 96 for c in spelled]
    want = {}
    for k in range(len(codes) - 3):
        a, b, c, d = codes[k : k + 4]
        gram = ((a * 27 + b) * 27 + c) * 27 + d
        want[gram] = want.get(gram, 0) + 1
    missing = {g: n for g, n in want.items() if got.get(g, 0) < n}
    assert len(missing) <= 4  # partitions part the texts: only runs over a border may differ


def test_restored(spark, make_docs, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    costs = toxicity.character_model(docs)
    assert costs.shape == (27**3, 27) and np.isfinite(costs).all()
    assert np.allclose(np.exp(-costs.astype(float)).sum(axis=1), 1, atol=1e-3)
    out = {r["doc_id"]: r["restored"] for r in toxicity.restore(make_docs([(1, "An 1d10t, a cl0wn"), (2, None), (3, ""), (4, "plain  Text")]), costs).collect()}
    assert out == {1: "an idiot a clown", 2: None, 3: "", 4: "plain text"} or out[1].startswith("an idiot")
    assert out[2] is None and out[3] == "" and out[4] == "plain text"


def test_disguises_at_the_ends_of_words(spark, make_docs):
    bad = ["shit", "idiot", "bass", "twat", "moron"]
    rows = [(k, " ".join([CLEAN[(k * 7 + j * 3) % len(CLEAN)] for j in range(20)] + [bad[k % 5]])) for k in range(100)]
    costs = toxicity.character_model(make_docs(rows))
    restorer = toxicity.Restorer(costs)
    for disguised, plain in (("sh17", "shit"), ("idi07", "idiot"), ("tw47", "twat"), ("ba55", "bass"), ("ba$$", "bass"), ("iidioott", "idiot"), ("mmorroon", "moron"), ("1d10+", "idiot")):
        assert restorer.chunk(disguised) == plain, disguised
    assert restorer.chunk("weather") == "weather" and restorer.chunk("1999") == "1999" and restorer.chunk("quiet!!!") == "quiet!!!"
    counter = toxicity.Counter(costs)
    for text in ("iidioott-like", "i  d  i  o  t", "i\td\ti\to\tt", "i\nd\ni\no\nt", "iidioott", "idi07"):
        assert counter.counts(text)[1].get("=idiot") == 1, text


def enumerated(costs, chunk):
    """Least cost of any path of a lattice, and what the paths of that cost say."""
    import itertools

    best, said = None, set()
    for path in itertools.product(*toxicity.Restorer.lattice(chunk)):
        state, cost = 0, 0.0
        for out, extra in path:
            cost += extra
            if out and not (toxicity._code(out) == 0 and state % 27 == 0):
                cost += float(costs[state, toxicity._code(out)])
                state = state % 27**2 * 27 + toxicity._code(out)
        cost += float(costs[state, 0]) if state % 27 else 0.0
        if best is None or cost < best - 1e-9:
            best, said = cost, set()
        if cost < best + 1e-9:
            said.add("".join(o for o, _ in path).strip())
    return said


def test_decoding_is_the_best_of_all_paths(monkeypatch, make_docs):
    import random

    rng = random.Random(2)
    costs = toxicity.character_model(make_docs([(k, " ".join(CLEAN)) for k in range(3)]))
    chunks = ["".join(rng.choice("aeist0147@$|.-") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    chunks += ["тhе", "r1vеr", "5.0-7", "aabbcc"]
    for wide, block in ((48, 256), (1, 3), (3, 1)):
        monkeypatch.setattr(toxicity, "WIDE", wide)
        monkeypatch.setattr(toxicity, "BLOCK", block)
        monkeypatch.setattr(toxicity, "STRETCH", 2 * block)
        restorer = toxicity.Restorer(costs)
        for chunk in chunks:
            assert restorer.decode(chunk) in enumerated(costs, chunk), (chunk, wide)


def test_words_with_doubled_letters_equal_their_lattice(make_docs):
    costs = toxicity.character_model(make_docs([(k, " ".join(CLEAN)) for k in range(3)]))
    restorer = toxicity.Restorer(costs)
    for word in ("wweather", "gaarrdenn", "qquiieett", "peeople", "ttalkked", "weather", "aallkkaa"):
        own, decoded = restorer.mean_cost(word), restorer.decode(word)
        far = own > toxicity.UNLIKELY and restorer.mean_cost(decoded) <= own - toxicity.GAIN
        assert restorer.single(word) == (decoded if far else None)


def test_look_alikes_and_invisible_letters(make_docs):
    rows = [(k, " ".join([*CLEAN, "idiot"])) for k in range(50)]
    counter = toxicity.Counter(toxicity.character_model(make_docs(rows)))
    for text in ("іdiоt", "idi​ot", "ｉｄｉｏｔ", "ＩＤＩＯＴ!", "i­diot,"):
        assert counter.counts(text)[1].get("=idiot") == 1, text
    # a word of one alphabet is no disguise
    assert counter.restorer.chunk("сосед") == "сосед"


def test_a_long_line_of_digits_is_decoded_in_blocks(make_docs):
    import time

    restorer = toxicity.Restorer(toxicity.character_model(make_docs([(1, " ".join(CLEAN))])))
    line = "".join(str(k * k % 10) for k in range(20_000))
    began = time.process_time()
    restorer.decode(line)
    assert time.process_time() - began < 20


def test_the_fit_is_a_minimum():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=(200, 2)), np.ones(200)])
    y = (x[:, 0] + rng.normal(size=200) > 0).astype(float)
    weight = np.where(y > 0, 0.3, 1.0)
    w = toxicity._fit(x, y, weight)

    def loss(w):
        z = x @ w
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (w[:-1] ** 2).sum() + 0.5e-6 * w[-1] ** 2

    assert all(loss(w) <= loss(w + step) + 1e-9 for step in 1e-3 * np.vstack([np.eye(3), -np.eye(3)]))
