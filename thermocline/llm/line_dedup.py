"""Site-relative line frequency: lines on more than a given share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from thermocline.llm.rows import col_of
from thermocline.llm.storage import fresh, stored

#: A line on more than this share of a host's pages is dropped.
BOILERPLATE_RATIO = 0.05
#: A line on one page repeats nothing, however few pages its host has.
MIN_PAGES = 2


def _split(text: str) -> Column:
    return F.split(col_of(text), "\n", -1)


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(" "))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = BOILERPLATE_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Columns host, line, n_pages, n_host: the lines to drop.

    A line counts once a page, without the blanks around it; empty lines never count. Pages with
    null or empty texts count in their host's total; null is a host like others. A host has at
    most (mean lines a page) / ratio such lines, so the result stays small however large a host.

    Counting is by 64-bit hash, combined before the shuffle; the lines of the few hashes that
    pass are counted again by their text, so a collision can't drop a line.
    """
    lines = pages.select(col_of(host).alias("host"), F.explode(F.array_distinct(F.transform(_split(text), _trim))).alias("line")).where("line <> ''").withColumn("hash", F.xxhash64("line"))
    totals = pages.groupBy(col_of(host).alias("host")).agg(F.count("*").alias("n_host"))
    over = (F.col("n_pages") >= min_pages) & (F.col("n_pages") > ratio * F.col("n_host"))

    def frequent(key: str, counted: DataFrame) -> DataFrame:
        counts = counted.groupBy("host", key).agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)
        return counts.join(totals.withColumnRenamed("host", "host_"), F.expr("host <=> host_")).where(over).select("host", key, "n_pages", "n_host")

    # written, so that the next join knows its size before it shuffles any line
    hashes = stored(frequent("hash", lines.select("host", "hash")).select(F.col("host").alias("host_"), F.col("hash").alias("hash_")), "line-hashes")
    return frequent("line", lines.join(hashes, F.expr("host <=> host_ AND hash = hash_"), "left_semi").select("host", "line"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = BOILERPLATE_RATIO, min_pages: int = MIN_PAGES, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """pages with boilerplate lines gone from text, and the number of lines before and of those dropped.

    Kept lines stay as they are, in order. Null texts stay null with 0 lines; a text of boilerplate
    alone becomes empty. Columns named n_lines and n_dropped are replaced; all others pass through.
    """
    own_host, lines_of = fresh(pages, "host_of_lines", "boilerplate_lines")
    lists = stored(boilerplate(pages, host, text, ratio, min_pages).groupBy(F.col("host").alias(own_host)).agg(F.collect_list("line").alias(lines_of)), "line-lists")
    out = pages.join(lists, col_of(host).eqNullSafe(F.col(own_host)), "left")
    kept = F.filter(_split(text), lambda line: ~F.array_contains(F.col(lines_of), _trim(line)))
    has = F.col(lines_of).isNotNull()
    count = F.coalesce(F.size(_split(text)), F.lit(0)).cast("long")
    changed = {
        text: F.when(has, F.array_join(kept, "\n")).otherwise(col_of(text)),
        n_lines: F.when(col_of(text).isNull(), 0).otherwise(count).cast("long"),
        n_dropped: F.when(has & col_of(text).isNotNull(), count - F.size(kept)).otherwise(0).cast("long"),
    }
    names = [c for c in pages.columns if c not in (n_lines, n_dropped)] + [n_lines, n_dropped]
    return out.select(*(changed[c].alias(c) if c in changed else col_of(c) for c in names))
