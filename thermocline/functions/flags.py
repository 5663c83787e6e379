"""Quality-flag expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MISSING, VERDICTS


def raise_flag(qc: Column, mask: Column, flag: int) -> Column:
    """The worse of the present verdict and `flag` where `mask` holds; missing stays missing."""
    if flag not in VERDICTS:
        raise ValueError(f"a test can only give one of {VERDICTS}, not {flag}")
    hit = F.coalesce(mask, F.lit(False))
    milder = ~qc.isin(*VERDICTS) | (qc < flag)
    return F.when(hit & (qc != MISSING) & milder, F.lit(flag).cast("tinyint")).otherwise(qc)


def worse_of(qc: Column, verdict: Column) -> Column:
    """`raise_flag` with a verdict per row; 0 means no verdict."""
    milder = ~qc.isin(*VERDICTS) | (qc < verdict)
    return F.when((verdict > 0) & (qc != MISSING) & milder, verdict.cast("tinyint")).otherwise(qc)


def raise_max(qc: Column, mask: Column, flag: int) -> Column:
    """Plain maximum, as used for profile tests."""
    return F.when(F.coalesce(mask, F.lit(False)), F.greatest(qc, F.lit(flag).cast("tinyint"))).otherwise(qc)


def initial_flag(value: Column, was_missing: Column) -> Column:
    """9 where the cleaned input had no value, 4 where a correction removed it, else 1."""
    return (
        F.when(was_missing, F.lit(9)).when(value.isNull(), F.lit(4)).otherwise(F.lit(1)).cast("tinyint")
    )


# --- test lists as 64-bit words in 16 hexadecimal digits --------------------------------
def hex_of_tests(tests: Column) -> Column:
    word = F.aggregate(
        F.array_distinct(tests),
        F.lit(0).cast("bigint"),
        lambda acc, k: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), k.cast("int"))),
    )
    return F.lpad(F.hex(word), 16, "0")


def hex_to_word(text: Column) -> Column:
    high = F.conv(F.substring(text, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(text, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def list_of_hex(text: Column) -> Column:
    word = hex_to_word(text)
    return F.filter(
        F.sequence(F.lit(1), F.lit(63)), lambda k: F.call_function("bit_get", word, k) == 1
    )
