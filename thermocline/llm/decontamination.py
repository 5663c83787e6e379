"""Benchmark passages in training documents, by a stored positional inverted index."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from thermocline.llm.rows import col_of, map_arrow, own_memory, slices
from thermocline.llm.storage import fresh, stored

#: Words of a window.
WINDOW = 10
#: Places left free between the documents of a shard, so that no match spans two.
GAP = 1024
#: Distinct terms up to which the index is restricted to the benchmark's; beyond, it holds every term.
RESTRICT_TERMS = 4_000_000
#: Words of benchmark items searched for at once; more go in further blocks.
BLOCK_WORDS = 1_000_000
#: Word hashes a worker remembers; past it the memory starts anew.
REMEMBERED = 150_000

#: Everything in ASCII but digits and small letters parts words.
_PARTS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_memory: dict[bytes, int] = {}


def words_of(text: str | None) -> list[bytes]:
    """Words of digits, letters a-z and whatever isn't ASCII; A-Z in lower case. UTF-8."""
    return text.encode().lower().translate(_PARTS).split() if text else []


def _hashes(words: list[bytes]) -> np.ndarray:
    own_memory(__name__, _memory.clear)
    if len(_memory) > REMEMBERED:
        _memory.clear()
    for w in set(words).difference(_memory):
        _memory[w] = xxhash.xxh3_64_intdigest(w) - 2**63
    return np.fromiter(map(_memory.__getitem__, words), np.int64, len(words))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def positional_index(docs: DataFrame, key: str = "doc_id", text: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """Postings by shards of documents: shard, ids and n_words (a document each), terms (hashes, sorted), counts, postings.

    A shard holds documents of a bounded number of characters, or one long document. postings lists
    the places of the first term, then of the next; a document's places begin where those before
    it end, and GAP later. terms (one column of texts) restricts the index to their words.
    """
    spark = docs.sparkSession
    known = None
    if terms is not None:
        column = col_of(terms.columns[0])
        distinct = map_arrow(terms.select(column.alias("t")), _distinct_hashes, "hash long").distinct()
        n = distinct.count()
        if n <= RESTRICT_TERMS:
            known = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in distinct.collect()], np.int64)))
    schema = "shard string, ids array<bigint>, n_words array<int>, terms array<bigint>, counts array<int>, postings array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = [words_of(t) for t in part.column(1).to_pylist()]
                sizes = np.array([len(w) for w in words], np.int64)
                hashes = _hashes(list(chain.from_iterable(words)))
                places = np.arange(len(hashes)) + np.repeat(np.arange(len(sizes)) * GAP, sizes)
                if known is not None:
                    keep = _among(hashes, known.value)
                    hashes, places = hashes[keep], places[keep]
                order = np.argsort(hashes, kind="stable")
                terms, counts = np.unique(hashes, return_counts=True)
                row = [part.column(0).to_numpy(zero_copy_only=False).tolist() if part.column(0).null_count == 0 else part.column(0).to_pylist(), sizes, terms, counts, places[order]]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, k)) for x, k in zip(row, kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *lists], names=["shard", "ids", "n_words", "terms", "counts", "postings"])

    return map_arrow(docs.select(col_of(key).cast("long").alias("id"), col_of(text).alias("text")), run, schema)


def _distinct_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = {w for t in batch.column(0).to_pylist() for w in words_of(t)}
        yield pa.RecordBatch.from_arrays([pa.array(_hashes(list(words)))], names=["hash"])


def windows_of(words: list[bytes], width: int) -> set[tuple[int, ...]]:
    """Windows of an item as term hashes: of fewer words than width, the one window they make."""
    hashes = _hashes(words).tolist()
    return {tuple(hashes[k : k + width]) for k in range(max(1, len(hashes) - width + 1))} if words else set()


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of consecutive numbers in sorted places."""
    breaks = np.flatnonzero(np.diff(places) > 1)
    return places[np.concatenate([[0], breaks + 1])], places[np.concatenate([breaks, [len(places) - 1]])] + 1


def _search(index: DataFrame, items: list[tuple[str, str | None]], width: int, near: int) -> DataFrame:
    """Columns shard, place (of the document in it), starts, ends (of hit words), items."""
    windows: dict[tuple[int, ...], set[int]] = {}
    for number, (_, text) in enumerate(items):
        for w in windows_of(words_of(text), width):
            windows.setdefault(w, set()).add(number)
    spark = index.sparkSession
    terms = spark.createDataFrame([(t,) for t in sorted({t for w in windows for t in w})], "wanted long")
    counts = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n"))
    frequency = {r["term"]: r["n"] for r in counts.join(terms, F.col("term") == F.col("wanted"), "left_semi").collect()}
    # by rarest term; a window with a term that no document has can't occur
    plan: dict[int, list[tuple[list[tuple[int, int]], int, list[int]]]] = {}
    for window, numbers in windows.items():
        if all(t in frequency for t in window):
            order = sorted(((t, k) for k, t in enumerate(window)), key=lambda x: (frequency[x[0]], x))
            plan.setdefault(order[0][0], []).append((order, len(window), sorted(numbers)))
    shared = spark.sparkContext.broadcast((plan, [i for i, _ in items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, names = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                shard, sizes, terms, counts, postings = (batch.column(c)[k] for c in range(5))
                sizes, terms, counts, postings = (x.values.to_numpy() for x in (sizes, terms, counts, postings))
                ends = np.cumsum(counts)
                where = dict(zip(terms.tolist(), zip((ends - counts).tolist(), ends.tolist())))
                covered: list[np.ndarray] = []
                found: list[tuple[np.ndarray, list[int]]] = []
                for term in plan.keys() & where.keys():
                    for order, size, numbers in plan[term]:
                        a, b = where[term]
                        starts = postings[a:b] - order[0][1]
                        for other, offset in order[1:]:
                            a, b = where.get(other, (0, 0))
                            listed = postings[a:b]
                            if near:
                                low = np.searchsorted(listed, starts + (offset - near))
                                starts = starts[low < np.searchsorted(listed, starts + (offset + near), "right")]
                            else:
                                starts = starts[_among(starts + offset, listed)]
                            if not len(starts):
                                break
                        else:
                            covered.append((starts[:, None] + np.arange(size)).ravel())
                            found.append((starts, numbers))
                if not found:
                    continue
                firsts = np.cumsum(sizes + GAP) - sizes - GAP
                starts, stops = _runs(np.unique(np.concatenate(covered)))
                of = np.searchsorted(firsts, starts, "right") - 1
                in_doc: dict[int, set[int]] = {}
                for at, numbers in found:
                    for d in np.unique(np.searchsorted(firsts, np.maximum(at, 0), "right") - 1).tolist():
                        in_doc.setdefault(d, set()).update(numbers)
                places = sorted(in_doc)
                spans = [(np.maximum(starts[of == d] - firsts[d], 0), np.minimum(stops[of == d] - firsts[d], sizes[d])) for d in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * len(places)),
                        pa.array(places, pa.int32()),
                        pa.array([s.tolist() for s, _ in spans], pa.list_(pa.int32())),
                        pa.array([e.tolist() for _, e in spans], pa.list_(pa.int32())),
                        pa.array([sorted({names[n] for n in in_doc[d]} - {None}) for d in places], pa.list_(pa.string())),
                    ],
                    names=["shard", "place", "starts", "ends", "items"],
                )

    return map_arrow(index.select("shard", "n_words", "terms", "counts", "postings"), run, "shard string, place int, starts array<int>, ends array<int>, items array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WINDOW, near: int = 0) -> DataFrame:
    """One row a document: key, n_words, spans (array of start, end in words; merged), n_hit (words in spans), items (sorted).

    An item's windows are its runs of width words, or all its words if fewer. near = 0 finds them
    as exact phrases; a larger one finds a window wherever each of its words is at most near places
    off its own, and the span is that of the window. A window's lists are intersected from the
    rarest term of the corpus on. Null, empty and wordless documents have 0 words, no spans and
    no items; wordless items match nothing; a null item id is found but not listed. Rows that
    repeat a key give a row each.

    Items are searched for in blocks of a bounded number of words; only a block and the
    frequencies of its terms pass the driver. Documents never move: a shard's matches join its row.
    """
    if near >= GAP // 2:
        raise ValueError(f"near must be below {GAP // 2}")
    index = stored(positional_index(docs, key, text, benchmark.select(col_of(item_text))), "postings")
    asked = benchmark.select(col_of(item).cast("string").alias("i"), col_of(item_text).alias("t"))
    total = asked.agg(F.sum(F.size(F.split("t", r"[\s]+")))).first()[0] or 0
    blocks = 1 + total // BLOCK_WORDS
    found = None
    for k in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k) if blocks > 1 else asked
        hits = _search(index, [(r["i"], r["t"]) for r in part.collect()], width, near)
        found = hits if found is None else found.union(hits)
    if blocks > 1:
        found = found.groupBy("shard", "place").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")))
    pieces = F.array_sort(F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    # spans of blocks may overlap: of sorted spans, each either extends the last or follows it
    merged = F.aggregate(
        pieces,
        nothing,
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["start"] <= F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    ) if blocks > 1 else pieces
    found = stored(found.select(F.col("shard").alias("shard_"), "place", merged.alias("spans"), F.array_sort(F.array_distinct("items")).alias("items")), "matches")
    rows = index.select("shard", F.posexplode(F.arrays_zip("ids", "n_words")).alias("at", "doc"))
    return rows.join(found, (F.col("shard") == F.col("shard_")) & (F.col("at") == F.col("place")), "left").select(
        F.col("doc.ids").alias(key),
        F.col("doc.n_words").cast("long").alias("n_words"),
        F.coalesce("spans", nothing).alias("spans"),
        F.aggregate(F.coalesce("spans", nothing), F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"])).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that hold a benchmark window as an exact phrase; all columns stay. Rows that repeat a key go together."""
    (gone,) = fresh(docs, "gone_id")
    hit = stored(matches(docs, benchmark, key, text).where("n_hit > 0").select(F.col(key).alias(gone)).distinct(), "contaminated")
    return docs.join(hit, col_of(key).cast("long") == F.col(gone), "left_anti")
