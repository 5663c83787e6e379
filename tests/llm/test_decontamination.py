import pytest

from thermocline.llm import decontamination
from thermocline.llm.decontamination import words_of


def plain(docs, items, width=10):
    out = []
    for key, text in docs:
        words, hit, names = words_of(text), set(), set()
        for item, item_text in items:
            own = words_of(item_text)
            size = min(len(own), width)
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
            for k in range(len(words) - size + 1):
                if size and tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    if item is not None:
                        names.add(str(item))
        out.append((str(key), len(words), len(hit), sorted(names)))
    return sorted(out)


PASSAGE = "Alpha beta, gamma delta EPSILON zeta eta theta iota kappa lambda mu nu xi"


def rows():
    docs = [(1, f"x y {PASSAGE} z"), (2, PASSAGE.lower() + " " + PASSAGE), (3, "alpha beta gamma delta"), (4, "short item"), (5, "a short item here, Short-Item"), (6, None), (7, ""), (8, "-- !!"), (9, "filler " * 30_000 + PASSAGE), (1, "again"), (1, f"{PASSAGE}"), (None, "short item"), (10, "é ü short ITEM ñ")]
    docs += [(20 + k, "the the the the the the the the the the the the") for k in range(3)]
    items = [(1, PASSAGE), (2, "short item"), (10, "short  item!"), (3, None), (4, ""), (5, "the " * 11), (None, "alpha beta gamma delta"), (6, "not in any document at all this one is long enough"), (1, PASSAGE)]
    return docs, items


def found(spark, make_docs, docs, items, **how):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.matches(make_docs(docs), benchmark, **how).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in out), out


def test_as_loops(spark, make_docs):
    docs, items = rows()
    got, out = found(spark, make_docs, docs, items)
    assert got == plain(docs, items)
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in out if r["doc_id"] == 5}
    assert spans == {5: [(1, 3), (4, 6)]}


def test_blocks_of_items_and_open_vocabulary(spark, make_docs, monkeypatch):
    docs, items = rows()
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 12)
    monkeypatch.setattr(decontamination, "RESTRICT_TERMS", 3)
    assert found(spark, make_docs, docs, items)[0] == plain(docs, items)


def test_proximity(spark, make_docs):
    docs = [(1, "one two three four"), (2, "one big two three and four"), (3, "four x x x x x three two one"), (4, "one two three")]
    items = [(9, "one two three four")]
    exact, _ = found(spark, make_docs, docs, items)
    assert [x[3] for x in exact] == [["9"], [], [], []]
    near, _ = found(spark, make_docs, docs, items, near=2)
    assert [x[3] for x in near] == [["9"], ["9"], [], []]
    with pytest.raises(ValueError):
        found(spark, make_docs, docs, items, near=600)


def test_empty_tables(spark, make_docs):
    docs, items = rows()
    assert found(spark, make_docs, [], items)[0] == []
    assert all(x[2] == 0 for x in found(spark, make_docs, docs, [])[0])


def test_drop(spark, make_docs):
    docs, items = rows()
    frame = make_docs(docs)
    out = decontamination.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == frame.columns
    assert sorted({str(r["doc_id"]) for r in out.collect()}) == ["6", "7", "8", "None"]
