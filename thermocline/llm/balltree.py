"""Ranked lexical search: exact inner products over sparse ball trees.

A document's vector has, for each of its terms, the term's weight times a saturated count; a query
is the set of an item's terms, so a score is the sum of the document's components at those terms.
`term_table` stores the terms and counts of every document once, whatever will be asked. Items are
taken in blocks of at most BLOCK_TERMS terms; for a block, each task cuts its documents into groups
of TREE_ROWS, builds a ball tree over the group's vectors in the block's terms, and searches it for
every item of the block, best node first. The lowest score of an item's k best so far is carried
from tree to tree.

A node has an integer centroid c and radii: whole numbers not below any distance from c to a vector
below the node. Terms are cut into groups, by the cluster of items that uses them most and by
weight, and distances are taken in each group apart: no score below the node exceeds the sum of c
over the item's terms plus, for each group, the root of the number of its terms in that group times
its radius. All roundings go up. Balls are split where the vectors' sums over one cluster of terms
differ most. A node whose bound can't beat the k-th score is never opened; at a leaf, scores are
exact 64-bit sums.

Documents are never moved: a task gives k rows for each item, and the last choice is a window that
Spark limits before its shuffle.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from thermocline.llm.rows import col_of, map_arrow, own_memory, slices
from thermocline.llm.storage import stored

#: Words of letters, digits and everything beyond ASCII; only A-Z are lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Saturation of counts, in 64-bit integers: SCALE * tf div (1000 * tf + 8 * m), m = 100 - 90 + 90 * n * N div L.
SCALE, B_SLOPE = 1_000_000_000, 90
#: Distinct terms of a block of items; an item of more is a block alone.
BLOCK_TERMS = 8192
#: Documents of a tree, and of a leaf.
TREE_ROWS, LEAF_ROWS = 2048, 16
#: Groups of terms that have a radius each: clusters of items, and levels of weight in each.
CLUSTERS, LEVELS = 16, 16
GROUPS = CLUSTERS * LEVELS


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(_LOWER)) if text else []


def term_table(rows: DataFrame, key: str) -> DataFrame:
    """key, n (terms with repeats), terms (distinct) and tfs of every row; null and empty texts have n 0. Whole texts, one long text at a time."""
    numbered = rows.select(col_of("text").cast("string").alias("text"), col_of(key).alias("key"))
    kind = numbered.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memory(__name__)
        for batch in batches:
            for part in slices(batch, 0):
                counts = [Counter(words(t)) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        pa.array([sum(c.values()) for c in counts], pa.int64()),
                        pa.array([list(c) for c in counts], pa.list_(pa.string())),
                        pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                    ],
                    names=["key", "n", "terms", "tfs"],
                )

    return map_arrow(numbered, run, f"key {kind.simpleString()}, n long, terms array<string>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _root_up(x: float) -> int:
    """A whole number not below the root of x, x being a sum of squares rounded by a few parts in 10^12 at most."""
    return math.ceil(math.sqrt(x) * (1 + 1e-9)) + 1 if x > 0 else 0


@functools.total_ordering
class _Last:
    """An id in descending order, null after all others: of equal scores the least id is the best."""

    __slots__ = ("id",)

    def __init__(self, value):
        self.id = value

    def __eq__(self, other):
        return self.id == other.id

    def __lt__(self, other):
        return other.id is not None and (self.id is None or self.id > other.id)


class Tree:
    """Balls over a group of sparse vectors (row k has the entries starts[k] to starts[k + 1] of terms and values)."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, ids: list, group: np.ndarray):
        self.starts, self.terms, self.values, self.ids = starts, terms, values, ids
        self.group, self.n_terms = group, len(group)
        by_id = sorted(range(len(ids)), key=lambda k: _Last(ids[k]), reverse=True)
        self.place_of_id = np.empty(len(ids), dtype=np.int64)
        self.place_of_id[by_id] = np.arange(len(ids))
        self.best_id = [ids[k] for k in by_id]
        self.rows: list[np.ndarray | None] = []  # of leaves
        self.children: list[tuple[int, int] | None] = []
        self.least: list = []  # best id below a node
        self._centroids, self._radii = [], []
        self._grow(np.arange(len(ids)))
        self.centroids, self.radii = np.array(self._centroids), np.array(self._radii)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and for each the number of its row among them."""
        n = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        first = np.cumsum(n) - n
        return np.arange(n.sum()) - first[owner] + self.starts[rows][owner], owner

    def _grow(self, rows: np.ndarray) -> int:
        places, owner = self.entries(rows)
        t, v = self.terms[places], self.values[places].astype(np.float64)
        centroid = np.rint(np.bincount(t, v, self.n_terms) / len(rows))
        distances = self._distances(len(rows), owner, t, v, centroid)
        node = len(self.rows)
        self._centroids.append(centroid)
        self._radii.append([_root_up(x) for x in distances.max(axis=0)])
        self.least.append(self.best_id[self.place_of_id[rows].min()])
        self.rows.append(rows)
        self.children.append(None)
        if len(rows) > LEAF_ROWS and distances.any():
            low = self._low(len(rows), owner, t, v)
            self.rows[node] = None
            self.children[node] = (self._grow(rows[low]), self._grow(rows[~low]))
        return node

    def _distances(self, n: int, owner, t, v, centroid) -> np.ndarray:
        """Squared distances of rows from the centroid by group, rounded up."""
        slot = owner * GROUPS + self.group[t]
        count = lambda weights: np.bincount(slot, weights, n * GROUPS).reshape(n, GROUPS)
        c = centroid[t]
        at_own = count((v - c) ** 2)
        squares = np.bincount(self.group, centroid * centroid, GROUPS)
        # what the centroid has elsewhere: nothing, if the row has all of its terms
        missing = np.bincount(self.group, centroid != 0, GROUPS) - count(c != 0)
        elsewhere = np.where(missing > 0.5, np.maximum(squares - count(c * c), 0) + squares * 1e-11, 0)
        return at_own + elsewhere

    def _low(self, n: int, owner, t, v) -> np.ndarray:
        """Rows whose sum over the cluster of terms where sums differ most is at most the mean; halves, if that would leave few on a side."""
        sums = np.bincount(owner * CLUSTERS + self.group[t] // LEVELS, v, n * CLUSTERS).reshape(n, CLUSTERS)
        widest = sums[:, sums.var(axis=0).argmax()]
        low = widest <= widest.mean()
        if min(low.sum(), n - low.sum()) * 16 < n:
            low = np.zeros(n, dtype=bool)
            low[np.argsort(widest, kind="stable")[: n // 2]] = True
        return low

    def bounds(self, item: Item) -> np.ndarray:
        """No score below a node exceeds its bound."""
        middle = self.centroids[:, item.terms].sum(axis=1)
        # whole numbers below 2^53 add up exactly; beyond, and for the roots, the factor covers the rounding
        middle = np.where(middle < 2**52, middle, middle * (1 + 1e-9))
        return middle + np.ceil((self.radii @ item.roots) * (1 + 1e-9))

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        places, _ = self.entries(rows)
        sums = np.concatenate(([0], np.cumsum(np.where(wanted[self.terms[places]], self.values[places], 0))))
        ends = np.cumsum(self.starts[rows + 1] - self.starts[rows])
        return sums[ends] - sums[np.concatenate(([0], ends[:-1]))]


class Item:
    """An item's terms in its block, and its k best documents so far, the worst first."""

    def __init__(self, terms: np.ndarray, group: np.ndarray, k: int):
        self.terms, self.k = terms, k
        self.wanted = np.zeros(len(group), dtype=bool)
        self.wanted[terms] = True
        self.roots = np.sqrt(np.bincount(group[terms], minlength=GROUPS))
        self.best: list[tuple] = []
        self.scored = self.entered = 0  # documents whose score was worked out; that were among the best for a time

    def hopeless(self, bound: float, least) -> bool:
        """Whether no document of at most that score, and of no better id, can be among the k best."""
        return bound < 1 if len(self.best) < self.k else (bound, _Last(least)) <= self.best[0][:2]

    def search(self, tree: Tree) -> None:
        bounds = tree.bounds(self)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if self.hopeless(-bound, tree.least[node]):
                if len(self.best) == self.k and -bound < self.best[0][0]:
                    return  # and so is all that's left
            elif tree.children[node]:
                for child in tree.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
            else:
                rows = tree.rows[node]
                scores = tree.scores(rows, self.wanted)
                self.scored += len(rows)
                for k in np.flatnonzero(scores >= (self.best[0][0] if len(self.best) == self.k else 1)):
                    score, row = int(scores[k]), rows[k]
                    if not self.hopeless(score, tree.ids[row]):
                        self.entered += 1
                        entry = (score, _Last(tree.ids[row]), self.entered, tree.ids[row])
                        (heapq.heappush if len(self.best) < self.k else heapq.heapreplace)(self.best, entry)


class Block:
    """Items and their terms' weights, as each task gets them."""

    def __init__(self, items: list[list[str]], weights: dict[str, int], n_docs: int, n_terms: int):
        self.n_docs, self.length = n_docs, n_terms
        self.vocabulary = sorted(weights, key=lambda t: (weights[t], t))
        self.weights = np.array([weights[t] for t in self.vocabulary], dtype=np.int64)
        place = {t: n for n, t in enumerate(self.vocabulary)}
        self.items = [np.array([place[t] for t in terms], dtype=np.int64) for terms in items]
        level = np.arange(len(self.vocabulary)) * LEVELS // len(self.vocabulary)
        self.group = self._clusters() * LEVELS + level

    def _clusters(self) -> np.ndarray:
        """For each term the cluster of items that has it most often; items go to the most similar of CLUSTERS items that are far from each other."""
        terms, lengths = np.concatenate(self.items), np.array([len(i) for i in self.items])
        owner = np.repeat(np.arange(len(self.items)), lengths)
        nearest, cluster, centre = np.full(len(self.items), -1.0), np.zeros(len(self.items), dtype=np.int64), 0
        for n in range(min(CLUSTERS, len(self.items))):
            has = np.zeros(len(self.vocabulary))
            has[self.items[centre]] = 1
            shared = np.bincount(owner, has[terms], len(self.items)) / np.sqrt(lengths * lengths[centre])
            cluster, nearest = np.where(shared > nearest, n, cluster), np.maximum(shared, nearest)
            centre = int(nearest.argmin())
        return np.bincount(cluster[owner] * len(self.vocabulary) + terms, minlength=CLUSTERS * len(self.vocabulary)).reshape(CLUSTERS, -1).argmax(axis=0)

    def queries(self, k: int) -> list[Item]:
        return [Item(terms, self.group, k) for terms in self.items]

    def rows(self, batch: pa.RecordBatch, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Starts, terms, components and ids of a batch's documents that hold a term of the block."""
        terms, tfs = batch.column("terms"), batch.column("tfs")
        at = pc.index_in(terms.flatten(), value_set=values).fill_null(-1).to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        own = at >= 0
        owner, at, tf = owner[own], at[own], tfs.flatten().to_numpy()[own]
        # Python integers: 90 * n * N may pass 64 bits on large corpora
        m = np.array([100 - B_SLOPE + B_SLOPE * n * self.n_docs // self.length if n else 1 for n in batch.column("n").to_pylist()], dtype=np.int64)
        components = self.weights[at] * (SCALE * tf // (1000 * tf + 8 * m[owner]))
        own = components > 0
        owner, at, components = owner[own], at[own], components[own]
        counts = np.bincount(owner, minlength=len(lengths))
        held = np.flatnonzero(counts)
        ids = batch.column("key").to_pylist()
        return np.concatenate(([0], np.cumsum(counts[held]))), at, components, [ids[k] for k in held]


def _grouped(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple]:
    """Documents of several batches as the parts of trees of TREE_ROWS each."""
    values = pa.array(block.vocabulary, pa.string())
    held: list[tuple] = []
    n = 0
    for batch in batches:
        starts, terms, components, ids = block.rows(batch, values)
        done = 0
        while done < len(ids):
            take = min(len(ids) - done, TREE_ROWS - n)
            a, b = starts[done], starts[done + take]
            held.append((starts[done : done + take + 1] - a, terms[a:b], components[a:b], ids[done : done + take]))
            n, done = n + take, done + take
            if n == TREE_ROWS:
                yield _joined(held)
                held, n = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[tuple]) -> tuple:
    lengths = np.concatenate([np.diff(p[0]) for p in parts])
    return np.concatenate(([0], np.cumsum(lengths))), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), [i for p in parts for i in p[3]]


def _document_counts(index: DataFrame, terms: list[str]) -> dict[str, int]:
    """How many documents hold each of the terms of a block; each task gives one row per term."""
    vocabulary = pa.array(terms, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            at = pc.index_in(batch.column("terms").flatten(), value_set=vocabulary).drop_null().to_numpy(zero_copy_only=False)
            found += np.bincount(at, minlength=len(found))
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(found[held], pa.int64())], names=["term", "df"])

    counted = map_arrow(index.select("terms"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {terms[r["term"]]: r["df"] for r in counted.collect()}


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[str]]]]:
    """(key, distinct terms) of items that have terms, in blocks of at most BLOCK_TERMS terms or one item; the driver holds one block."""
    block, held = [], set()
    for row in items.where("n > 0").select("key", "terms").toLocalIterator():
        new = held.union(row["terms"])
        if block and len(new) > BLOCK_TERMS:
            yield block
            block, new = [], set(row["terms"])
        block.append((row["key"], row["terms"]))
        held = new
    if block:
        yield block


def _search(index: DataFrame, block: Block, keys: list, k: int, schema: str, kinds: tuple[pa.DataType, pa.DataType], counts: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memory(__name__)
        queries = block.queries(k)
        trees = rows = 0
        for starts, terms, values, ids in _grouped(batches, block):
            tree = Tree(starts, terms, values, ids, block.group)
            trees, rows = trees + 1, rows + len(ids)
            for q in queries:
                q.search(tree)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (trees, rows * len(queries), sum(q.scored for q in queries))], names=["trees", "pairs", "scored"])
            return
        found = [(n, keys[n], e[3], e[0]) for n, q in enumerate(queries) for e in q.best]
        columns = list(zip(*found)) if found else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *kinds, pa.int64()))], names=["q", "item", "id", "score"])

    return map_arrow(index, run, schema)


def _prepared(docs: DataFrame, items: DataFrame, key: str, item: str):
    """The stored index, and for each block of items its terms' weights and the items' keys."""
    index = stored(term_table(docs, key), "lexical-terms")
    total = index.where("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    asked = term_table(items, item)
    return index, (
        (Block([t for _, t in b], {t: weight(total["n"], found.get(t, 0)) for t in terms}, total["n"], total["l"]), [key for key, _ in b])
        for b in (_blocks(asked) if total["n"] else ())
        for terms in [sorted({t for _, ts in b for t in ts})]
        for found in [_document_counts(index, terms)]
    )


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """The k documents of the highest score above 0 for each row of items: item key, rank (from 1), document key, score.

    Equal scores go by ascending document key, null last. Rows without terms are in no result.
    Repeated document keys are documents of their own, repeated item keys items of their own.
    Other columns of either table are ignored. No items, or no documents, give no rows.
    """
    spark = docs.sparkSession
    index, blocks = _prepared(docs, items, key, item)
    kinds = [f.dataType for f in (items.select(col_of(item)).schema[0], docs.select(col_of(key)).schema[0])]
    schema = f"q long, item {kinds[0].simpleString()}, id {kinds[1].simpleString()}, score long"
    arrow = tuple(to_arrow_type(t) for t in kinds)
    best: list[DataFrame] = []
    for block, keys in blocks:
        found = _search(index, block, keys, k, schema, arrow, False)
        for by in (["q", F.spark_partition_id() % 64], ["q"]):
            order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
            found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best.append(stored(found, "lexical-best"))
    out = functools.reduce(DataFrame.unionByName, best) if best else spark.createDataFrame([], f"{schema}, rank int")
    return out.select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def work(docs: DataFrame, items: DataFrame, k: int = 10) -> dict[str, int]:
    """Trees, pairs of item and document with a common block, and pairs whose score was worked out: what the bounds save."""
    index, blocks = _prepared(docs, items, "doc_id", "item_id")
    rows = [_search(index, b, keys, k, "trees long, pairs long, scored long", (), True).groupBy().sum().first() for b, keys in blocks]
    return {name: sum(r[n] for r in rows) for n, name in enumerate(("trees", "pairs", "scored"))}
