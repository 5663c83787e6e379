"""Exact top-k by integer inner product over a bit-sliced index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from thermocline.llm.rows import col_of, grouped, map_arrow
from thermocline.llm.storage import stored

SCALE = 256
#: Vectors of an index block, and queries that meet a block at once; both are expected numbers.
BLOCK_VECTORS, BLOCK_QUERIES = 16_384, 1024
#: Vectors with a quantised component of this size or more are scored with whole numbers of any length, in blocks of EXACT_BLOCK.
SLICED_LIMIT, EXACT_BLOCK = 2**26, 1024
#: Scores beyond 64 bits count as these.
_LEAST, _MOST = -(2**63), 2**63 - 1


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Columns id, dim, values (floor of SCALE times each component, as double); vectors that are null or hold a null or non-finite component are left out."""
    fine = F.forall(col_of(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(col_of(key).isNotNull() & col_of(vector).isNotNull() & F.coalesce(fine, F.lit(False)))
    # floor() gives a long; what is beyond whole numbers' 53 bits has no fraction
    scaled = lambda x: x.cast("double") * SCALE
    values = F.transform(col_of(vector), lambda x: F.when(F.abs(scaled(x)) < 2.0**53, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    return rows.select(col_of(key).cast("long").alias("id"), F.size(col_of(vector)).alias("dim"), values.alias("values"))


def _packed(rows: DataFrame, size: int, slices: bool, sliced: bool = True) -> DataFrame:
    """One row a block of about size vectors: dim, block, n_blocks, ids, values (row by row, int32, or double if not sliced), and with slices also low, bits and the slices' bitmaps."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("n_blocks")).withColumnRenamed("dim", "dim_")
    placed = rows.join(counts, F.col("dim") == F.col("dim_")).select("dim", F.pmod(F.xxhash64("id", "values"), F.col("n_blocks")).cast("int").alias("block"), "n_blocks", "id", "values")
    blocks = placed.repartition("dim", "block").sortWithinPartitions("dim", "block", "id", "values")
    schema = "dim int, block int, n_blocks int, ids binary, packed binary, low int, bits int, slices binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, block), (n_blocks, ids, values) in grouped(batches, 2):
            ids, matrix = ids.to_numpy(), values.flatten().to_numpy().reshape(len(ids), int(dim))
            matrix = np.ascontiguousarray(matrix, np.int32 if sliced else np.float64)
            low = bits = 0
            bitmaps = b""
            if slices:
                low = int(matrix.min()) if matrix.size else 0
                bits = (int(matrix.max()) - low).bit_length() if matrix.size else 0
                bitmaps = slice_bitmaps(matrix - low, bits).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x)], pa.int32()) for x in (dim, block, n_blocks[0].as_py())]
                + [pa.array([x], pa.binary()) for x in (ids.tobytes(), matrix.tobytes())]
                + [pa.array([x], pa.int32()) for x in (low, bits)]
                + [pa.array([bitmaps], pa.binary())],
                names=["dim", "block", "n_blocks", "ids", "packed", "low", "bits", "slices"],
            )

    return map_arrow(blocks, run, schema)


def slice_bitmaps(matrix: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps [dimension, bit, word] of a matrix of numbers of at least 0: bit r of a bitmap is that bit of row r's number."""
    n, dim = matrix.shape
    words = -(-n // 64)
    out = np.zeros((dim, bits, words * 8), np.uint8)
    for b in range(bits):
        out[:, b, : -(-n // 8)] = np.packbits((matrix >> b & 1).astype(np.uint8).T, axis=1, bitorder="little")
    return out.view(np.uint64)


def _bits(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def sum_slices(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Slices, least significant first, of the sum over dimensions of |q| times u, or times its complement where q < 0.

    Each set bit of |q| adds the dimension's slices at its weight. Bitmaps of one weight are added
    three at a time, all triples at once: full adders leave one of the weight and one of the next.
    """
    dim, bits, words = slices.shape
    full = np.uint64(2**64 - 1)
    columns: dict[int, list[np.ndarray]] = {}
    for d in np.flatnonzero(query):
        own = slices[d] if query[d] > 0 else slices[d] ^ full
        for j in _bits(abs(int(query[d]))):
            for b in range(bits):
                columns.setdefault(j + b, []).append(own[b])
    out, carried, weight = [], np.zeros((0, words), np.uint64), 0
    last = max(columns, default=-1)
    while weight <= last or len(carried):
        own = columns.get(weight)
        stack = np.concatenate([np.stack(own), carried]) if own else carried
        carries = []
        while len(stack) > 2:
            third = len(stack) // 3
            a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            stack = np.concatenate([half ^ c, stack[3 * third :]])
        if len(stack) == 2:
            carries.append((stack[0] & stack[1])[None])
            stack = (stack[0] ^ stack[1])[None]
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        carried = np.concatenate(carries) if carries else np.zeros((0, words), np.uint64)
        weight += 1
    return out


def _places(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
    """Rows of a bitmap in order, the first ones only if a number is given."""
    found: list[int] = []
    for w in np.flatnonzero(bitmap).tolist():
        found.extend(w * 64 + b for b in _bits(int(bitmap[w])))
        if most is not None and len(found) >= most:
            return np.array(found[:most], np.int64)
    return np.array(found, np.int64)


def top_rows(sums: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest sums among alive, from the most significant slice down; of equal sums at the border, the first rows."""
    sure, open_ = np.zeros_like(alive), alive.copy()
    for bitmap in reversed(sums):
        ahead = open_ & bitmap
        n = int(np.bitwise_count(sure | ahead).sum())
        if n > k:
            open_ = ahead
        else:
            sure |= ahead
            open_ &= ~bitmap
            if n == k:
                open_[:] = 0
                break
    chosen = _places(sure)
    return np.concatenate([chosen, _places(open_, k - len(chosen))]) if k > len(chosen) else chosen


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Columns query_id, rank (from 1), vec_id, score: each query's k largest inner products with other ids, ties to the smaller id.

    queries is a part of vectors, or like it. A query meets vectors of its own dimension, all of
    them; fewer than k others give fewer rows, none gives none. Rows that repeat an id are all
    candidates for other ids; those of a query share its ranks. Every pair of an index block and a
    query block is one bounded task, and gives k rows a query. The few vectors with components too
    large for slices meet all others in exact whole numbers.
    """
    wide = F.exists("values", lambda x: F.abs(x) >= SLICED_LIMIT)
    index, asked = quantised(vectors, key, vector), quantised(queries, key, vector)
    large = stored(index.where(wide), "large-vectors")
    found = _sliced_pairs(index.where(~wide), asked.where(~wide), k)
    if not large.isEmpty():
        found = found.unionByName(_exact_pairs(large, asked, k)).unionByName(_exact_pairs(index.where(~wide), asked.where(wide), k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _crossed(index: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index and query blocks, each once for every block of the other of its dimension."""
    n_index = index.groupBy("dim").agg(F.first("n_blocks").alias("n_index")).withColumnRenamed("dim", "dim_")
    n_asked = asked.groupBy("dim").agg(F.first("n_blocks").alias("n_asked")).withColumnRenamed("dim", "dim_")
    left = index.join(n_asked, F.col("dim") == F.col("dim_")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("n_asked") - 1)))
    right = asked.join(n_index, F.col("dim") == F.col("dim_")).withColumnRenamed("block", "query_block").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_index") - 1)))
    return left, right


_PAIRS = "query_id long, vec_id long, score long"
_BLOCK_KEYS = ["dim", "block", "query_block"]


def _exact_pairs(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k best of index for every query, by Python's whole numbers."""
    left, right = _crossed(stored(_packed(index, EXACT_BLOCK, False, False), "exact-blocks"), stored(_packed(asked, EXACT_BLOCK, False, False), "exact-queries"))

    def unpacked(table: pa.Table, dim: int) -> tuple[list[int], list[list[int]]]:
        ids = np.frombuffer(table.column("ids")[0].as_py(), np.int64)
        rows = np.frombuffer(table.column("packed")[0].as_py(), np.float64).reshape(len(ids), dim)
        return ids.tolist(), [[int(x) for x in row] for row in rows.tolist()]

    def run(block: pa.Table, group: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if block.num_rows and group.num_rows:
            dim = block.column("dim")[0].as_py()
            ids, rows = unpacked(block, dim)
            for q, query in zip(*unpacked(group, dim)):
                scores = [(-min(max(sum(a * b for a, b in zip(row, query)), _LEAST), _MOST), i) for i, row in zip(ids, rows) if i != q]
                out.extend((q, i, -s) for s, i in heapq.nsmallest(k, scores))
        return pa.table([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"])

    return left.select(*_BLOCK_KEYS, "ids", "packed").groupBy(*_BLOCK_KEYS).cogroup(right.select(*_BLOCK_KEYS, "ids", "packed").groupBy(*_BLOCK_KEYS)).applyInArrow(run, _PAIRS)


def _sliced_pairs(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of an index block for every query, by its bit slices."""
    whole = F.transform("values", lambda x: x.cast("int"))
    index = stored(_packed(vectors.withColumn("values", whole), BLOCK_VECTORS, True), "bit-slices")
    asked = stored(_packed(queries.withColumn("values", whole), BLOCK_QUERIES, False), "query-blocks")
    left, right = _crossed(index, asked)

    def run(block: pa.Table, group: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if block.num_rows and group.num_rows:
            row = {c: block.column(c)[0].as_py() for c in ("dim", "ids", "packed", "bits", "slices")}
            ids, dim = np.frombuffer(row["ids"], np.int64), row["dim"]
            matrix = np.frombuffer(row["packed"], np.int32).reshape(len(ids), dim)
            words = -(-len(ids) // 64)
            slices = np.frombuffer(row["slices"], np.uint64).reshape(dim, row["bits"], words)
            every = np.zeros(words * 64, np.uint8)
            every[: len(ids)] = 1
            every = np.packbits(every, bitorder="little").view(np.uint64)
            query_ids = np.frombuffer(group.column("ids")[0].as_py(), np.int64)
            query_rows = np.frombuffer(group.column("packed")[0].as_py(), np.int32).reshape(len(query_ids), dim)
            for q, query in zip(query_ids.tolist(), query_rows):
                alive = every.copy()
                for at in range(int(np.searchsorted(ids, q)), int(np.searchsorted(ids, q, "right"))):
                    alive[at // 64] &= ~np.uint64(1 << at % 64)
                rows = top_rows(sum_slices(slices, query), alive, k)
                scores = matrix[rows].astype(np.int64) @ query.astype(np.int64)
                out[0].extend([q] * len(rows)), out[1].extend(ids[rows].tolist()), out[2].extend(scores.tolist())
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return left.select(*_BLOCK_KEYS, "ids", "packed", "bits", "slices").groupBy(*_BLOCK_KEYS).cogroup(right.select(*_BLOCK_KEYS, "ids", "packed").groupBy(*_BLOCK_KEYS)).applyInArrow(run, _PAIRS)
