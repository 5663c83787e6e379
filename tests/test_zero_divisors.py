"""One odd deployment (equal stamps, constant variables, no pairs) must not stop the job."""

import pytest
from pyspark.sql import functions as F

from thermocline.operators import phases, reports, sections, segments


@pytest.fixture(scope="module")
def doubled(spark):
    """Dives with two rows at every tenth stamp, pressure missing around some of them."""
    rows, seq = [], 0
    for k in range(400):
        for _ in range(2 if k % 10 == 0 else 1):
            p = abs(k % 80 - 40) * 5.0 + (seq % 2) * 0.5
            rows.append(("G", 1_700_000_000 + 20 * k, seq, None if k % 10 in (9, 0) and k % 20 < 10 else p))
            seq += 1
    return spark.createDataFrame(rows, "glider_id string, t_s long, seq long, pressure double")


def test_equal_stamps(doubled):
    n = doubled.count()
    filled = segments.fill_pressure(doubled)
    assert filled.count() == n and filled.filter("pressure_filled IS NULL").count() < n / 2
    assert segments.detect_profiles(doubled).count() == n
    assert phases.detect_phases(doubled).count() == n
    assert segments.time_gradient(doubled, "pressure", "slope").filter("slope IS NULL").count() > 0
    assert segments.buoyancy_phase(doubled.withColumn("buoyancy", F.col("pressure"))).count() == n


def series(spark, rows):
    names = "glider_id string, t_s long, seq long, profile_index int, pressure double, depth double, temperature double, salinity double, latitude double, longitude double"
    return spark.createDataFrame([(g, 1_700_000_000 + k, k, k // 20, float(k), float(k), t, s, 10.0, 70.0) for g, k, t, s in rows], names)


def test_no_pair_of_temperature_and_salinity(spark):
    df = series(spark, [("bad", k, 10.0 if k % 2 else None, None if k % 2 else 35.0) for k in range(40)] + [("good", k, 10.0 + k, 35.0) for k in range(40)])
    got = {r.glider_id: r for r in reports.ts_diagnostics(df).collect()}
    assert got["bad"].n_pairs == 0 and got["bad"].t_stuck is None
    assert got["good"].t_stuck == 0.0


def test_level_crossed_once_then_constant(spark):
    values = [20.0, 18.0, 12.0, 12.0, 12.0, 12.0]
    cells = spark.createDataFrame([("G", 0, "temperature", k, k + 0.5, v) for k, v in enumerate(values)], "glider_id string, profile_index int, variable string, cell long, depth double, value double")
    levels = spark.createDataFrame([("G", 15.0)], "glider_id string, level double")
    assert [r.iso_depth for r in sections.iso_depth(cells, levels, "temperature", True).collect()] == [2.0]


def test_constant_variable_has_no_contours(spark):
    cells = spark.createDataFrame([("G", p, "temperature", k, k + 0.5, 7.0) for p in range(3) for k in range(5)], "glider_id string, profile_index int, variable string, cell long, depth double, value double")
    times = spark.createDataFrame([("G", p, 1_700_000_000 + p, False) for p in range(3)], "glider_id string, profile_index int, time long, after_gap boolean")
    usable = spark.createDataFrame([("G", "temperature", 4.5)], "glider_id string, variable string, usable_depth double")
    got = sections.section(cells, times, usable, ["temperature"]).collect()
    assert len(got) == 15 and all(r.contour is None for r in got)
