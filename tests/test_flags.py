"""Flag merging and the interaction of tests on a toy profile."""

import math

import pytest
from pyspark.sql import functions as F

from thermocline.functions.flags import list_of_hex, raise_flag, hex_of_tests
from thermocline.operators import qc


def merged(spark, flags, masks):
    rows = [(i, f, *m) for i, (f, *m) in enumerate(zip(flags, *[m for m, _ in masks], strict=True))]
    names = [f"m{k}" for k in range(len(masks))]
    df = spark.createDataFrame(rows, "i int, q tinyint, " + ", ".join(f"{n} boolean" for n in names))
    for n, (_, flag) in zip(names, masks, strict=True):
        df = df.withColumn("q", raise_flag(F.col("q"), F.col(n), flag))
    return [r.q for r in df.orderBy("i").collect()]


def test_merge_rules(spark):
    assert merged(spark, [1, 1, 1], [([True, True, False], 4)]) == [4, 4, 1]
    assert merged(spark, [4, 3, 1], [([True] * 3, 3)]) == [4, 3, 3]
    assert merged(spark, [9, 9, 1], [([True] * 3, 3), ([False, True, True], 4)]) == [9, 9, 4]
    assert merged(spark, [1, 2, 0], [([True] * 3, 3), ([True] * 3, 3)]) == [3, 3, 3]
    # order of the masks does not matter
    a, b = ([True, False, True], 4), ([True, True, False], 3)
    assert merged(spark, [1, 1, 9], [a, b]) == merged(spark, [1, 1, 9], [b, a]) == [4, 3, 9]
    with pytest.raises(ValueError):
        raise_flag(F.lit(1), F.lit(True), 9)


def test_hex_round_trip(spark):
    df = spark.createDataFrame([([8, 12, 63],), ([1],), ([],)], "k array<int>")
    rows = df.select("k", hex_of_tests(F.col("k")).alias("h")).select("k", "h", list_of_hex(F.col("h")).alias("back")).collect()
    assert [r.h for r in rows] == ["8000000000001100", "0000000000000002", "0000000000000000"]
    assert all(sorted(r.k) == r.back for r in rows)


def toy(spark, n=200, **edits):
    rows = []
    for i in range(n):
        row = {"glider_id": "A", "t_s": 1_704_067_200 + 10 * i, "seq": i, "profile_index": 0, "pressure": 500.0 * i / (n - 1),
               "depth": 495.0 * i / (n - 1), "temperature": 20.0 + 0.001 * (i % 7), "salinity": 35.0 + 0.0001 * (i % 5), "latitude": 12.0, "longitude": 70.0}
        for key, changes in edits.items():
            if i in changes:
                row[key] = changes[i]
        rows.append(tuple(row.values()))
    schema = "glider_id string, t_s bigint, seq bigint, profile_index bigint, pressure double, depth double, temperature double, salinity double, latitude double, longitude double"
    return spark.createDataFrame(rows, schema)


def flags_of(df, limit=1000.0):
    out = qc.flag_series(qc.mark_missing(df), limit, F.lit(2_000_000_000))
    return {r.seq: r for r in out.collect()}


def test_range_verdict_survives_depth_test(spark):
    rows = flags_of(toy(spark, pressure={50: 2500.0}))
    assert (rows[50].pressure_QC, rows[50].temperature_QC, rows[50].salinity_QC) == (4, 4, 4)
    assert rows[60].pressure_QC == 1


def test_speed_flags_both_ends_and_spares_missing(spark):
    rows = flags_of(toy(spark, latitude={100: 40.0}, salinity={100: None}))
    assert [rows[i].latitude_QC for i in (98, 99, 100, 101, 102)] == [1, 3, 3, 3, 1]
    assert rows[100].salinity_QC == 9
    assert rows[100].temperature_QC == 3


def test_location_and_absent_position(spark):
    rows = flags_of(toy(spark, n=50, latitude={10: None, 11: 999.0}))
    assert rows[10].latitude_QC == 9
    assert rows[11].latitude_QC == 4


def test_missing_pressure_cascades(spark):
    rows = flags_of(toy(spark, n=50, pressure={5: None}, temperature={5: None}))
    assert (rows[5].pressure_QC, rows[5].temperature_QC, rows[5].salinity_QC) == (9, 9, 9)
    rows = flags_of(toy(spark, n=50, pressure={5: None}))
    assert rows[5].temperature_QC == 4


def test_stuck_values_spare_the_ends(spark):
    rows = flags_of(toy(spark, n=60, temperature={i: 18.0 for i in range(60)}))
    assert sorted(i for i, r in rows.items() if r.temperature_QC == 4) == list(range(10, 50))


def test_deepest_allowed(spark):
    got = spark.range(1).select(*[qc.deepest_allowed(F.lit(v)) for v in (10.0, 1000.0, 2000.0)]).first()
    assert [round(x, 6) for x in got] == [25.0, 1100.0, 2100.0]
    assert math.isclose(got[1], 1100.0)
