"""Tables with different columns, in any order, are one table."""

import itertools

from thermocline.operators.publish import applied_tests
from thermocline.sources.readers import common_type, stack_segments


def test_order_is_free(spark):
    tables = [
        spark.createDataFrame([(1, 2.5, "x")], "t int, Temp double, a string"),
        spark.createDataFrame([(2, 7)], "t long, temp int"),
        spark.createDataFrame([(3.5, True, None)], "t float, flag boolean, a int"),
    ]
    seen = set()
    for order in itertools.permutations(tables):
        out = stack_segments(order)
        seen.add((tuple(out.dtypes), tuple(sorted(map(tuple, out.collect()), key=str))))
    assert len(seen) == 1
    dtypes, rows = next(iter(seen))
    assert dtypes == (("a", "string"), ("flag", "boolean"), ("t", "double"), ("Temp", "double"))
    assert set(rows) == {("x", None, 1.0, 2.5), (None, None, 2.0, 7.0), (None, True, 3.5, None)}
    assert stack_segments([tables[0].limit(0)]).count() == 0


def test_common_types():
    assert common_type({"int", "bigint"}) == "bigint" and common_type({"int", "float"}) == "double"
    assert common_type({"boolean", "int"}) == "string" and common_type({"timestamp"}) == "timestamp"


def test_applied_tests_unite_words(spark):
    words = [("a", 1 << 2 | 1 << 40), ("a", 1 << 2 | 1 << 5), ("b", 0), ("b", 1 << 63)]
    frame = spark.createDataFrame([(g, f"{w:016X}") for g, w in words], "glider_id string, done_hex string")
    assert {r[0]: r[1] for r in applied_tests(frame).collect()} == {"a": "TEST002 TEST005 TEST040", "b": "TEST063"}
