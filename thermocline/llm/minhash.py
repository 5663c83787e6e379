"""Near-duplicate documents: universal hash minima, banding, signature and set verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from thermocline.llm.components import components
from thermocline.llm.rows import col_of, grouped, map_arrow, own_memory, slices
from thermocline.llm.storage import fresh, stored

SHINGLE_WORDS = 5
#: Linked from this Jaccard similarity on, in hundredths.
SIMILARITY = 75
BANDS, ROWS = 32, 4
#: Pairs whose signatures agree in fewer places than this share go without a look at their sets:
#: at the similarity asked for, a pair's share is lower with a probability of 3 in 100,000.
AGREEMENT = 0.6
#: Members of a bucket or group that one task compares at a time.
BLOCK = 1024
#: Word hashes a worker remembers; past it the memory starts anew.
REMEMBERED = 150_000

_memory: dict[bytes, int] = {}


def _family() -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift hashes h(x) = (a x + b mod 2^64) >> 32 with odd a, a universal family; a fixed seed."""
    random = np.random.default_rng(5)
    a = random.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    return a, random.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    own_memory(__name__, _memory.clear)
    if len(_memory) > REMEMBERED:
        _memory.clear()
    for w in set(words).difference(_memory):
        _memory[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_memory.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of fewer words, the one of the whole sequence."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = _word_hashes(words)
    width = min(n, SHINGLE_WORDS)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out = (out ^ hashes[k : n - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    if n < SHINGLE_WORDS:
        out ^= np.uint64(n)
    return np.unique(out)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Minimum of each hash of the family over a set that isn't empty."""
    a, b = family
    least = np.full(len(a), 2**64 - 1, np.uint64)
    for k in range(0, len(shingles), 2048):
        part = shingles[k : k + 2048]
        values = part[None, :] * a[:, None]
        values += b[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns id, words_key (null without words), n_shingles, bands (a hash each), sketch (a byte of each minimum)."""
    schema = "id long, words_key binary, n_shingles long, bands array<bigint>, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, sizes, bands, sketches = [], [], [], []
                for t in part.column(1).to_pylist():
                    words = words_of(t)
                    if not words:
                        keys.append(None), sizes.append(0), bands.append(None), sketches.append(None)
                        continue
                    shingles = shingle_set(words)
                    least = signature(shingles, family)
                    keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    sizes.append(len(shingles))
                    bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), seed=k) - 2**63 for k, row in enumerate(least.reshape(BANDS, ROWS))])
                    sketches.append((least & np.uint32(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                    names=["id", "words_key", "n_shingles", "bands", "sketch"],
                )

    return map_arrow(docs.select(col_of(key).cast("long").alias("id"), col_of(text).alias("text")), run, schema)


def shingle_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns id, shingles (sorted hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingle_set(words_of(t)).view(np.int64) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["id", "shingles"])

    return map_arrow(docs.select(col_of(key).cast("long").alias("id"), col_of(text).alias("text")), run, "id long, shingles array<bigint>")


def _agreeing(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    """True for each row of sketches that agrees with one well enough; bytes also agree by chance, once in 256."""
    share = (sketches == one).mean(axis=1)
    return (share - 1 / 256) / (1 - 1 / 256) >= AGREEMENT


def _trees(ids: np.ndarray, sketches: np.ndarray, side: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the graph of agreeing pairs, by breadth-first search.

    A node is compared with those not reached yet only, so a group of copies goes in a few steps.
    """
    left = np.arange(len(ids))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = _agreeing(sketches[left], sketches[node])
            for other in left[near]:
                yield int(ids[node]), int(ids[other])
                queue.append(other)
            left = left[~near]


def _bytes_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _blocked(rows: DataFrame, group: list[str], size: str) -> DataFrame:
    """rows with block_a, block_b: a group of at most BLOCK rows is one block pair; of a larger one, every row meets every block once, in one of the pairs it belongs to."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.least(own, k).alias("a"), F.greatest(own, k).alias("b")))
    return rows.withColumn("pair", F.explode(pairs)).withColumns({"block_a": F.col("pair.a"), "block_b": F.col("pair.b")}).drop("pair")


def candidates(signed: DataFrame) -> DataFrame:
    """Distinct edges (a, b), a < b, that connect whatever shares a band and agrees in its signature.

    Only a spanning forest of each bucket leaves its task. Buckets of one are gone before sketches
    are shuffled; a bucket of more than BLOCK members is compared in pairs of blocks.
    """
    spread = signed.select("id", F.posexplode("bands").alias("band", "hash"))
    shared = spread.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("band").alias("band_"), F.col("hash").alias("hash_"), "n")
    members = spread.join(shared, F.expr("band = band_ AND hash = hash_")).select("id", F.col("hash").alias("bucket"), "band", "n")
    members = members.join(signed.select(F.col("id").alias("id_"), "sketch"), F.col("id") == F.col("id_"))
    keys = ["band", "bucket", "block_a", "block_b"]
    blocks = _blocked(members, ["band", "bucket"], "n").select(*keys, "id", "sketch").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for _, (ids, sketches) in grouped(batches, len(keys)):
            ids, matrix = ids.to_numpy(), _bytes_matrix(sketches)
            found.update((min(e), max(e)) for e in _trees(ids, matrix, ids))
            if len(found) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
                found = set()
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return map_arrow(blocks, run, "a long, b long").distinct()


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= SIMILARITY * (len(a) + len(b) - common)


def _rest(edges: DataFrame, labels: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between documents of different labels whose candidate edges have all failed so far.

    edges: those failed, whose ends differ in label. Labels they connect make a family; its pairs
    are all compared, but those inside its largest label, in blocks; of the links found, a task
    returns those that join labels not joined yet.
    """
    family = components(edges.select("label_a", "label_b"))
    label_sizes = labels.groupBy("component").agg(F.count("*").alias("n_label"))
    groups = family.join(label_sizes.withColumnRenamed("component", "node"), "node").withColumnRenamed("component", "family")
    main = groups.groupBy("family").agg(F.max(F.struct("n_label", "node")).alias("top"), F.sum("n_label").alias("n_all"))
    main = main.select(F.col("family").alias("family_"), F.col("top.node").alias("main"), F.col("top.n_label").alias("n_main"), (F.col("n_all") - F.col("top.n_label")).alias("n_rest"))
    # two documents whose one edge has failed need no second look
    groups = groups.join(main.where("n_main + n_rest > 2"), F.col("family") == F.col("family_")).drop("family_")
    docs = labels.withColumnRenamed("component", "label").join(groups, F.col("label") == F.col("node")).select("family", F.col("id_of").alias("id"), "label", (F.col("label") == F.col("main")).alias("is_main"), "n_main", "n_rest")
    hashed = F.xxhash64("id")
    n_main, n_rest = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_main", "n_rest"))
    own = F.pmod(hashed, F.when(F.col("is_main"), n_main).otherwise(n_rest)).cast("int")
    tag = lambda a, b, kind: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), F.lit(kind).alias("kind"))
    with_main = F.transform(F.sequence(F.lit(0), n_main - 1), lambda k: tag(k, own, 0))
    with_rest = F.transform(F.sequence(F.lit(0), n_rest - 1), lambda k: tag(F.least(own, k), F.greatest(own, k), 1))
    from_main = F.transform(F.sequence(F.lit(0), n_rest - 1), lambda k: tag(own, k, 0))
    placed = docs.withColumn("pair", F.explode(F.when(F.col("is_main"), from_main).otherwise(F.concat(with_main, with_rest))))
    placed = placed.select("family", F.col("pair.a").alias("block_a"), F.col("pair.b").alias("block_b"), F.col("pair.kind").alias("kind"), "id", "label")
    keys = ["family", "block_a", "block_b", "kind"]
    full = placed.join(signed.select(F.col("id").alias("id_"), "sketch"), F.col("id") == F.col("id_")).join(sets.withColumnRenamed("id", "of"), F.col("id") == F.col("of"))
    blocks = full.select(*keys, "id", "label", "sketch", "shingles").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (ids, own_labels, sketches, shingles) in grouped(batches, len(keys)):
            ids, own_labels, matrix = ids.to_numpy(), own_labels.to_numpy().copy(), _bytes_matrix(sketches)
            values, ends = shingles.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(shingles).to_numpy())])
            links = []
            for k in range(1, len(ids)):
                others = np.flatnonzero(own_labels[:k] != own_labels[k])
                for j in others[_agreeing(matrix[others], matrix[k])]:
                    if own_labels[j] != own_labels[k] and _similar(values[ends[j] : ends[j + 1]], values[ends[k] : ends[k + 1]]):
                        links.append((int(ids[j]), int(ids[k])))
                        own_labels[own_labels == own_labels[j]] = own_labels[k]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return map_arrow(blocks, run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, n_shingles, component_id, kept (key = component_id).

    Documents of one word sequence are one class, which its smallest key stands for. Of the
    classes, bands and signatures give edges that keep connected whatever may be linked; edges are
    confirmed on the full sets of shingle hashes (64 bits, chance collisions aside); where some
    fail, all other pairs of the parts they connected are compared too. No pair inside a group is
    listed, no group meets in one task, and no partner is capped.

    Null, empty and blank texts have 0 shingles, no links and stay. Rows that repeat a key with the
    same text get the same answer. A row without a key is kept only if no row of its class has one.
    """
    signed = stored(signatures(docs, key, text), "signatures")
    classes = signed.where("words_key IS NOT NULL").groupBy("words_key").agg(F.min("id").alias("head"))
    classes = stored(classes.where("head IS NOT NULL"), "classes")
    # by key and class, as a key may repeat
    heads = signed.join(classes.withColumnRenamed("words_key", "key_"), F.expr("words_key = key_ AND id = head")).groupBy("id").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    heads = stored(heads, "heads")
    edges = stored(candidates(heads), "candidates")
    wanted = stored(edges.select(F.explode(F.array("a", "b")).alias("wanted")).distinct(), "wanted")
    chosen = docs.select(col_of(key).cast("long").alias("id"), col_of(text).alias("text")).join(wanted, F.col("id") == F.col("wanted"), "left_semi")
    sets = stored(shingle_sets(chosen, "id", "text").groupBy("id").agg(F.first("shingles").alias("shingles")), "sets")
    common = F.size(F.array_intersect("set_a", "set_b"))
    checked = (
        edges.join(sets.select(F.col("id").alias("id_a"), F.col("shingles").alias("set_a")), F.col("a") == F.col("id_a"))
        .join(sets.select(F.col("id").alias("id_b"), F.col("shingles").alias("set_b")), F.col("b") == F.col("id_b"))
        .select("a", "b", (100 * common >= SIMILARITY * (F.size("set_a") + F.size("set_b") - common)).alias("linked"))
    )
    checked = stored(checked, "checked")
    links = checked.where("linked").select("a", "b")
    nodes = wanted.select(F.col("wanted").alias("a"), F.col("wanted").alias("b"))
    labels = stored(components(links.union(nodes)), "labels")
    failed = checked.where("NOT linked").join(labels.select(F.col("node").alias("a"), F.col("component").alias("label_a")), "a").join(labels.select(F.col("node").alias("b"), F.col("component").alias("label_b")), "b")
    failed = stored(failed.where("label_a <> label_b").select("label_a", "label_b").distinct(), "failed")
    more = stored(_rest(failed, labels.select(F.col("node").alias("id_of"), "component"), heads, sets), "more-links")
    joined = more.join(labels.select(F.col("node").alias("a"), F.col("component").alias("label_a")), "a").join(labels.select(F.col("node").alias("b"), F.col("component").alias("label_b")), "b")
    merged = components(joined.select("label_a", "label_b"))
    final = labels.join(merged.select(F.col("node").alias("component"), F.col("component").alias("further")), "component", "left").select(F.col("node").alias("head_"), F.coalesce("further", "component").alias("of_head"))
    by_class = classes.join(final, F.col("head") == F.col("head_"), "left").select(F.col("words_key").alias("key_"), F.coalesce("of_head", "head").alias("component_id"))
    by_class = stored(by_class, "class-components")
    return signed.join(by_class, F.col("words_key") == F.col("key_"), "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("component_id", "id").eqNullSafe(F.col("id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that near_duplicates() doesn't keep; all columns stay. Rows that repeat a key stay or go together."""
    (gone,) = fresh(docs, "gone_id")
    found = stored(near_duplicates(docs, key, text).where("NOT kept").select(F.col(key).alias(gone)).distinct(), "duplicates")
    return docs.join(found, col_of(key).cast("long") == F.col(gone), "left_anti")
