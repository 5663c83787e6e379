"""Columns added to rows by Arrow batches, whatever the other columns are called."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bytes of texts handled at once in a task; a longer text is handled alone.
SLICE_BYTES = 1_500_000


_held: dict[str, Callable[[], None]] = {}


def own_memory(owner: str, free: Callable[[], None] | None = None) -> None:
    """Called where an operator's task begins: what other operators still remember in this worker process is freed.

    Workers outlive tasks, and so would the memories of all operators of a pipeline together.
    """
    for other in [o for o in _held if o != owner]:
        _held.pop(other)()
    if free is not None:
        _held[owner] = free


#: Rows of an Arrow batch, at most: texts and pages may be long, and a batch is held whole on both sides.
BATCH_ROWS = 500


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow() with short batches: lowers the session's spark.sql.execution.arrow.maxRecordsPerBatch to BATCH_ROWS where it is larger."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def col_of(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of df but those named, in any case of letters."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def slices(batch: pa.RecordBatch, column: int | str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of bytes in a column of texts, one long text alone at most."""
    texts = batch.column(column if isinstance(column, int) else batch.schema.get_field_index(column))
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, n in enumerate(lengths):
        if k > start and held + n > SLICE_BYTES:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += int(n)
    if len(lengths) > start:
        yield batch.slice(start, len(lengths) - start)


def parts(batch: pa.RecordBatch, column: int, texts: bool) -> Iterator[pa.RecordBatch]:
    if texts:
        yield from slices(batch, column)
    else:
        for start in range(0, batch.num_rows, 256):
            yield batch.slice(start, 256)


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[pa.Array]]]:
    """Groups of rows with equal values in the first n_keys columns, from sorted batches; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None

    def out() -> tuple[tuple, list[pa.Array]]:
        table = pa.Table.from_batches(held).combine_chunks()
        return last, [c.chunk(0) for c in table.columns[n_keys:]]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for values in keys:
            new[1:] |= values[1:] != values[:-1]
        starts = [*np.flatnonzero(new), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(values[a] for values in keys)
            if held and key != last:
                yield out()
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield out()


def add_columns(df: DataFrame, inputs: list[str], added: dict[str, T.DataType], make: Callable[[], Callable[..., list[pa.Array]]], texts: bool = True) -> DataFrame:
    """df with columns computed from inputs, replacing those of their names.

    make() gives a task its function: from the input columns of a part of the rows, as Arrow
    arrays, to the arrays of the added columns. Parts are bounded by the texts of the first input,
    or by a number of rows. Columns travel under numbers, so their names may be anything.
    """
    kept = others(df, *added)
    numbered = df.select(*(col_of(c).alias(f"c{k}") for k, c in enumerate(kept)))
    places = [kept.index(c) for c in inputs]
    schema = T.StructType([*numbered.schema.fields, *(T.StructField(f"n{k}", t) for k, t in enumerate(added.values()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memory(make.__module__)
        compute = make()
        for batch in batches:
            for part in parts(batch, places[0], texts):
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(*(part.column(p) for p in places))], names=names)

    out = map_arrow(numbered, run, schema)
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(kept)), *(F.col(f"n{k}").alias(c) for k, c in enumerate(added)))
