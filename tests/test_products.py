"""Grid, retention, phases, loads and text sources on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from thermocline.operators import grid as gr
from thermocline.operators import publish as pb
from thermocline.operators import sections as se
from thermocline.operators.align import position_on_land, sync_sensors
from thermocline.operators.phases import detect_phases
from thermocline.operators.segments import ASCENT, DESCENT, INFLEXION, SUBSURFACE_DRIFT, detect_profiles
from thermocline.sources import readers as rd


def test_retention(spark):
    flags = [4] * 40 + [9] * 20 + [1] * 340
    df = spark.createDataFrame([("A", i, float(i), q) for i, q in enumerate(flags)], "glider_id string, t_s bigint, temperature double, temperature_QC int")
    row = gr.retention(df, ["temperature", "salinity"]).first()
    assert (row.pct_good, row.pct_removed, row.pct_missing, row.pct_not_shown) == (85.0, 10.0, 5.0, 15.0)
    assert gr.retention(df, ["temperature"]).count() == 1


def test_grid_interpolates_and_places(spark):
    dense = [("A", 0, d, 10.0 + d) for d in (1.0, 2.0, 2.0, 7.25, 10.5)] + [("A", 0, 2.0, 15.0)]
    sparse = [("A", 1, 3.0, 1.0), ("A", 1, 3.4, 2.0), ("A", 1, 4.0, 3.0)]
    rows = [(g, p, 100 * p, d, v) for g, p, d, v in dense + sparse]
    df = spark.createDataFrame(rows, "glider_id string, profile_index bigint, t_s bigint, depth double, temperature double")
    out = {(r.profile_index, r.cell): r.value for r in gr.profile_grid(df, ["temperature"]).collect()}
    at_two = (12.0 + 12.0 + 15.0) / 3
    assert out[(0, 1)] == pytest.approx((11.0 + at_two) / 2)
    assert out[(0, 2)] == pytest.approx(at_two + (17.25 - at_two) * 0.5 / 5.25)
    assert out[(0, 10)] == 20.5 and (0, 0) not in out
    # cells hold (i, i+1]; the deeper of two points in one cell stays
    assert {k: v for k, v in out.items() if k[0] == 1} == {(1, 2): 1.0, (1, 3): 3.0}
    values = {p: [v for (q, _), v in out.items() if q == p] for p in (0, 1)}
    assert min(values[0]) >= 11.0 and max(values[0]) <= 20.5


def test_sampling_is_whole_and_deterministic(spark):
    rows = [("A", i, float(i % 600), 1.0, 35.0, 1, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "glider_id string, t_s bigint, depth double, temperature double, salinity double, temperature_QC int, salinity_QC int")
    assert {r.band: r["count"] for r in se.stratified_ts(df).groupBy("band").count().collect()} == {0: 250, 1: 750, 2: 1500, 3: 500}
    rates = (1.0, 0.5, 0.1, 0.5, 1.0)
    one = {r.t_s for r in se.stratified_ts(df, rates).collect()}
    counts = {r.band: r["count"] for r in se.stratified_ts(df, rates).groupBy("band").count().collect()}
    assert counts[0] == 250 and 300 < counts[1] < 450 and 100 < counts[2] < 200 and 200 < counts[3] < 300
    # a row's lot doesn't hang on the other rows
    assert {r.t_s for r in se.stratified_ts(df.filter("t_s < 1500"), rates).collect()} == {t for t in one if t < 1500}
    deep = spark.createDataFrame([("A", 1, 1500.0, 1.0, 35.0, 1, 1), ("A", 2, None, 1.0, 35.0, 1, 1)], df.schema)
    assert [r.band for r in se.stratified_ts(deep).collect()] == [4, 4]


def test_load_twice_is_load_once(spark, tmp_path):
    def rows(items):
        return spark.createDataFrame(items, "observation_id bigint, t_s bigint, value double, glider_id string")

    path = str(tmp_path / "measurement")
    first, second = rows([(1, 0, 1.0, "A"), (2, 9, 2.0, "A"), (3, 5, 3.0, "B")]), rows([(2, 9, 9.0, "A"), (4, 8, 4.0, "A")])
    pb.load_parquet(first, path, ["observation_id"])
    pb.load_parquet(second, path, ["observation_id"])
    once = sorted((r.observation_id, r.value) for r in spark.read.parquet(path).collect())
    pb.load_parquet(second, path, ["observation_id"])
    assert sorted((r.observation_id, r.value) for r in spark.read.parquet(path).collect()) == once
    assert once == [(1, 1.0), (2, 9.0), (3, 3.0), (4, 4.0)]


def test_observation_key_matches_python(spark):
    import hashlib

    df = spark.createDataFrame([("G1", 1_704_067_215)], "glider_id string, t_s bigint")
    digest = hashlib.sha256(b"G1|2024-01-01T00:00:15.000000").digest()
    assert df.select(pb.row_key()).first()[0] == int.from_bytes(digest[:8], "big") & (2**63 - 1)


def saw(spark, cycles=3, hold=0):
    """Dives to 300 dbar and back at 15 cm/s, a reading every 15 s, optionally holding at depth."""
    rows, t = [], 1_704_067_200
    for _ in range(cycles):
        shape = [5 + 2.25 * k for k in range(130)]
        levels = shape + [shape[-1] + 0.01 * (k % 2) for k in range(hold)] + shape[::-1]
        for p in levels:
            rows.append(("A", t, len(rows), p))
            t += 15
    return spark.createDataFrame(rows, "glider_id string, t_s bigint, seq bigint, pressure double")


def test_profiles_alternate(spark):
    out = detect_profiles(saw(spark)).groupBy("profile_index").agg(F.count("*").alias("n"), F.avg("profile_direction").alias("d")).orderBy("profile_index").collect()
    assert len(out) == 6
    assert [r.d > 0 for r in out] == [True, False] * 3


def test_phases_find_dives_climbs_and_holds(spark):
    out = detect_phases(saw(spark, cycles=2, hold=60)).groupBy("phase_number").agg(F.first("phase").alias("phase"), F.count("*").alias("n")).orderBy("phase_number").collect()
    kinds = [r.phase for r in out if r.n >= 10]
    assert kinds == [DESCENT, SUBSURFACE_DRIFT, ASCENT, DESCENT, SUBSURFACE_DRIFT, ASCENT]
    short = detect_phases(saw(spark, cycles=2, hold=20))
    phases = {r.phase for r in short.collect()}
    assert INFLEXION in phases and SUBSURFACE_DRIFT not in phases


def test_sync_leaves_holes(spark):
    rows = [("A", "temp", float(t), float(t)) for t in [0, 10, 20, 30, 1000, 1010]] + [("A", "oxy", t + 5.0, 1.0) for t in range(0, 1000, 100)]
    df = spark.createDataFrame(rows, "glider_id string, sensor string, t double, v double")
    out = {r.t: r for r in sync_sensors(df, ["temp", "oxy"]).collect()}
    got = {t: r["oxy"] for t, r in out.items()}
    assert got[10.0] == 1.0 and got[1000.0] is None


def test_land_wraps_at_the_date_line(spark):
    # nodes every 90 degrees; the position lies between longitude 90 and 180 = -180
    nodes = spark.createDataFrame([(1, 3, -10.0), (2, 3, -10.0), (1, 0, 30.0), (2, 0, 30.0)], "i_lat bigint, i_lon bigint, z double")
    df = spark.createDataFrame([(10.0, 179.0), (None, None)], "latitude double, longitude double")
    out = {r.latitude: r.land_qc for r in position_on_land(df, nodes, 90.0).collect()}
    assert out == {10.0: 4, None: None}


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "PLD-REALTIMECLOCK;NAV-DEPTH\n01/01/1999 00:00:00;1\n01/01/2024 00:00:00;2\n03/01/2024 00:00:00.250;3\n03/01/2024 00:00:10;\n"
    )
    (tmp_path / "b.csv").write_text("Timestamp;X-1;NAV-DEPTH\n05/02/2024 00:00:00;7;8\n")
    out = rd.parse_payload(rd.read_lines(spark, str(tmp_path), "*.csv")).orderBy("t").collect()
    assert [(r.t, r["values"]) for r in out] == [
        (1704240000.25, {"NAV_DEPTH": 3.0}), (1704240010.0, {"NAV_DEPTH": None}), (1707091200.0, {"X_1": 7.0, "NAV_DEPTH": 8.0})
    ]
    (tmp_path / "x.log").write_text("GPS Location:  1230.50 N -7030.00 E measured\nother\nGPS Location:  3412.00 S 1815.00 W\n")
    got = rd.parse_gps(rd.read_lines(spark, str(tmp_path), "*.log")).orderBy("latitude").collect()
    assert [(round(r.latitude, 4), round(r.longitude, 4)) for r in got] == [(-34.2, -18.25), (12.5083, -70.5)]
