"""Grouping of sensors that stop together, decided in order of appearance."""

from thermocline.operators import reports as rp
from thermocline.operators import segments as sg
from thermocline.operators.reports import SENSORS, shared_stops


def test_shared_stops(spark):
    rows = [
        ("A", "temperature", 1000), ("A", "salinity", 1050), ("A", "oxygen_concentration", 1070),  # the third is 70 s from the first
        ("A", "chlorophyll", 5000), ("A", "cdom", 5060), ("A", "backscatter_700", 1130),
        ("B", "cdom", 10), ("B", "chlorophyll", 20), ("C", "cdom", 1),
    ]
    df = spark.createDataFrame(rows, "glider_id string, variable string, last_valid bigint")
    got = sorted(tuple(r) for r in shared_stops(df, SENSORS).collect())
    assert got == [
        ("A", 1000, "temperature,salinity", "mission gap"),
        ("A", 1070, "oxygen_concentration,backscatter_700", "several sensors"),
        ("A", 5000, "chlorophyll,cdom", "several sensors"),
        ("B", 20, "chlorophyll,cdom", "several sensors"),
    ]


def test_few_fixes_give_global_bounds(spark):
    fixes = spark.createDataFrame([("A", 12.0 + k / 100, 70.0) for k in range(9)] + [("B", 12.0, 70.0)] * 4, "glider_id string, latitude double, longitude double")
    out = {r.glider_id: r for r in rp.deployment_parameters(fixes).collect()}
    assert out["A"].n_fixes == 9 and out["A"].clean_hemisphere
    b = out["B"]
    assert (b.n_fixes, b.la_min, b.la_max, b.lo_min, b.lo_max) == (0, -90.0, 90.0, -180.0, 180.0)
    assert b.median_lat is None and not b.clean_hemisphere and b.factory_box == "none"


def test_short_records_keep_their_rows(spark):
    rows = [("A", 15 * k, k, float(abs(100 - k % 200))) for k in range(900)] + [("B", 15 * k, k, 5.0) for k in range(60)]
    out = sg.detect_profiles(spark.createDataFrame(rows, "glider_id string, t_s bigint, seq bigint, pressure double")).collect()
    assert sum(r.glider_id == "A" for r in out) == 900
    assert [(r.profile_index, r.profile_direction) for r in out if r.glider_id == "B"] == [(None, None)] * 60


DAYS = 86400


def record(glider, last, days=30):
    """Hourly rows; each variable has values up to its last hour."""
    names = ["temperature", "salinity", "pressure", "oxygen_concentration", "chlorophyll", "cdom", "backscatter_700"]
    hours = days * 24
    return [(glider, h * 3600, *[1.0 + h % 7 if h <= last.get(v, hours) else None for v in names]) for h in range(hours + 1)], names


def series(spark, *records):
    rows, names = [], []
    for glider, last in records:
        more, names = record(glider, last)
        rows += more
    return spark.createDataFrame(rows, "glider_id string, t_s long, " + ", ".join(f"{v} double" for v in names)), names


def test_early_stops(spark):
    df, names = series(
        spark,
        ("all", {"temperature": 240, "salinity": 240, "cdom": 240, "chlorophyll": 240}),  # one event
        ("some", {"temperature": 240, "cdom": 400}), ("rest", {"cdom": 240, "chlorophyll": 400}),  # no core sensor: may rest
        ("late", {"temperature": 720 - 72}), ("few", {"temperature": 8}), ("never", {"temperature": -1}),
    )
    got = sorted(tuple(r) for r in rp.early_stops(df, names).collect())
    assert got == [("all", "all sensors stopped", "note", 20), ("some", "cdom stopped early", "warning", 13), ("some", "temperature stopped early", "warning", 20)]
    assert rp.early_stops(df.limit(0), names).count() == 0


def test_levels_that_do_not_fit(spark):
    a = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("B", 2), ("C", 1), ("D", 1)], "glider_id string, t_s long")
    b = spark.createDataFrame([("A", 1), ("A", 2), ("B", 5), ("B", 6), ("C", 1), ("C", 2), ("C", 3), ("E", 1)], "glider_id string, t_s long")
    assert sorted(tuple(r) for r in rp.level_issues(a, b).collect()) == [
        ("B", "no common stamps of levels", "critical", 2), ("C", "row counts of levels differ", "warning", 2)
    ]


def test_sensor_issues_take_events_first(spark):
    from pyspark.sql import functions as F

    df, _ = series(
        spark,
        ("A", {"temperature": 240, "salinity": 240, "cdom": 300}), ("B", {"oxygen_concentration": 300}), ("C", {}), ("D", {"chlorophyll": 240, "cdom": 240}),
    )
    bad = df.withColumn("oxygen_concentration_QC", F.when(F.col("glider_id").isin("B", "C") & (F.col("t_s") % 14400 == 0), 4).otherwise(1))
    got = sorted((r.glider_id, r.kind, r.variables, r.last_valid) for r in rp.sensor_issues(df, bad, SENSORS).collect() if r.kind != "oxygen flagged bad")
    assert got == [
        ("A", "mission gap", "temperature,salinity", 240 * 3600), ("A", "sensor failure", "cdom", 300 * 3600),
        ("B", "sensor failure", "oxygen_concentration", 300 * 3600), ("D", "several sensors", "chlorophyll,cdom", 240 * 3600),
    ]
    oxygen = [r for r in rp.sensor_issues(df, bad, SENSORS).collect() if r.kind == "oxygen flagged bad"]
    assert [(r.glider_id, r.variables) for r in oxygen] == [("C", "oxygen_concentration")]  # that of B is silent already
    assert rp.sensor_issues(df, df, SENSORS).count() == 4
