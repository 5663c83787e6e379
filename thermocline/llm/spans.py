"""Columns of found spans, shared by the scanners of personal data and of secrets."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from thermocline.llm.rows import add_columns

SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)])
_ARROW = pa.list_(pa.struct([pa.field("kind", pa.string()), pa.field("start", pa.int32()), pa.field("end", pa.int32())]))

Spans = list[tuple[str, int, int]]


class Covered:
    """What a set of spans covers, merged and sorted once: a look costs the logarithm of their number."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def rest(self, start: int, end: int) -> list[tuple[int, int]]:
        """The parts of start to end that aren't covered."""
        out, at = [], start
        for k in range(bisect_right(self.ends, start), len(self.starts)):
            if self.starts[k] >= end:
                break
            if self.starts[k] > at:
                out.append((at, self.starts[k]))
            at = self.ends[k]
        if at < end:
            out.append((at, end))
        return out

    def touches(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.starts) and self.starts[k] < end


def scan(docs: DataFrame, make: Callable[[], Callable[[str], Spans]], text: str, spans: str) -> DataFrame:
    """docs with an array of (kind, start, end) added, or replaced if it is there; make() gives a task its scanner. Null texts count as empty."""

    def start():
        find = make()
        return lambda texts: [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] if t else [] for t in texts.to_pylist()], _ARROW)]

    return add_columns(docs, [text], {spans: T.ArrayType(SPAN)}, start)


def of_kinds(spans: str, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: Column | str) -> Column:
    """kind:start:end of each span in the array's order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(of_kinds(spans, (kind,))).cast("long")
