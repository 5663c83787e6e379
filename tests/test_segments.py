"""Grids kept as segments, gradients without moving cells, and quantiles of many keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermocline.operators import ordered
from thermocline.operators import sections as se
from thermocline.operators.grid import profile_grid, profile_segments, segment_cells, with_neighbours
from thermocline.plans import queries_grid


def samples(spark):
    rng = np.random.default_rng(7)
    rows = [("G", p, float(d), float(rng.normal())) for p in range(6) for d in np.sort(rng.uniform(0.2, 60, 25 + 9 * p))]
    # sample on a centre; above the surface; sparse ones with neighbours, two slots in one cell and a hole
    rows += [("G", 6, d, d / 3) for d in (-0.4, 0.5, 1.5, 9.5, 30.0)]
    rows += [("G", 7, d, d) for d in (3.2, 4.1, 4.9)] + [("G", 8, 5.2, 1.0), ("G", 8, 5.8, 2.0), ("G", 8, 9.2, 3.0)]
    return spark.createDataFrame(rows, "glider_id string, profile_index long, depth double, v double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_segments_know_the_neighbours_of_their_cells(spark):
    df = samples(spark)
    plain = with_neighbours(profile_grid(df, ["v"]))
    cells = segment_cells(profile_segments(df, ["v"], neighbours=True))
    assert with_neighbours(cells) is cells
    rows = lambda g: sorted(map(tuple, g.select("profile_index", "cell", "depth", "value", "above", "below").collect()), key=str)
    got = rows(cells)
    assert got == rows(plain) and len(got) > 300
    sparse = {(r[0], r[1]): r[4:] for r in got if r[0] > 6}
    assert sparse == {(7, 3): (None, 4.9), (7, 4): (3.2, None), (8, 5): (None, None), (8, 9): (None, None)}


@pytest.mark.parametrize("limit", [None, 30.0, 4.7, 0.7])
def test_gradient_is_the_same_with_and_without_segments(spark, limit):
    df = samples(spark)
    columns = df.select("glider_id", "profile_index", (F.col("profile_index") == 2).alias("after_gap")).distinct()
    usable = spark.createDataFrame([("G", "v", 41.3)], "glider_id string, variable string, usable_depth double")
    cells = segment_cells(profile_segments(df, ["v"], neighbours=True))
    fast, slow = (se.vertical_gradient(g, columns, usable, limit) for g in (cells, profile_grid(df, ["v"])))
    got = sorted(map(tuple, fast.collect()))
    assert got == sorted(map(tuple, slow.collect()))
    # the last cell shown has a one-sided gradient, also that of a sparse profile
    assert 2 not in {r[1] for r in got} and bool(got) == (limit != 0.7) and any(r[1] == 7 for r in got) == (limit == 4.7)


def events(spark, path):
    made = spark.range(2000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"),
        F.col("id").alias("user_id"), F.lit("click").alias("event_type"), (F.col("id") * 7.13 % 97).alias("value"),
    )
    made.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_gradient_moves_no_cell(spark, tmp_path):
    text = plan(queries_grid.gradient(spark, events(spark, tmp_path)))
    # joins of small tables only
    assert "Window" not in text and "Sort" not in text and "hashpartitioning" not in text


def test_envelope_counts_few_bins_for_a_key(spark, monkeypatch, tmp_path):
    asked, coarse = [], ordered.coarse_bin
    monkeypatch.setattr(ordered, "coarse_bin", lambda v, octave: asked.append(octave) or coarse(v, octave))
    out = queries_grid.envelope(spark, events(spark, tmp_path))
    assert asked and max(asked) <= 64
    row = out.filter("glider_id = 'G0' AND variable = 'salinity' AND cell = 100").first()
    assert row.v_min <= row.p25 <= row.median <= row.p75 <= row.v_max and row.v_min < row.v_max


@pytest.mark.parametrize("share, rounds, parts", [(0.1, 5, 64), (0.0, 9, 3), (0.0, 2, 4), (1.0, 5, 64)])
def test_quantiles_of_many_keys(spark, monkeypatch, share, rounds, parts):
    for name, value in {"SHARE": share, "ROUNDS": rounds, "PARTS": parts}.items():
        monkeypatch.setattr(ordered, name, value)
    rng = np.random.default_rng(3)
    told = {
        ("A", 0): 1025 + rng.normal(0, 1e-3, 700),
        ("A", 1): np.concatenate([rng.normal(0, 1, 300), [-9999.0] * 20, [9999.0] * 20, [0.0, -0.0]]),
        ("A", 2): rng.integers(0, 4, 200).astype(float),
        ("B", 0): np.array([5.0]),
        ("B", 1): np.array([1.0, 1.0 + 1e-15, 1.0 + 2e-15, 2.0]),
        (None, 1): rng.uniform(1.0, 1.01, 90),
    }
    rows = [(*k, float(x)) for k, vs in told.items() for x in vs] + [("B", 1, None), ("C", 0, None)]
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {tuple(r[:2]): r for r in ordered.narrowed_quantiles(spark.createDataFrame(rows, "k string, cell long, v double"), ["k", "cell"], "v", qs).collect()}
    assert set(got) == {*told, ("C", 0)}
    for k, vs in told.items():
        assert np.allclose(got[k].q, np.quantile(vs, qs), rtol=0, atol=1e-12) and got[k].q_n == len(vs)
    assert got["C", 0].q == [None] * 5 and got["C", 0].q_n == 0
