"""Greedy spacing in runs against the loop it stands for."""

import random

import pytest

from thermocline.operators import greedy, segments
from thermocline.operators.greedy import keep_spaced


def loop(times, apart):
    kept, last = [], None
    for k, t in enumerate(times):
        if last is None or t - last >= apart:
            kept.append(k)
            last = t
    return kept


@pytest.mark.parametrize("run,group", [(512, 256), (7, 3), (1, 2)])
def test_equals_the_loop(spark, monkeypatch, run, group):
    monkeypatch.setattr(greedy, "RUN", run)
    monkeypatch.setattr(greedy, "GROUP", group)
    rng = random.Random(run)
    keys = {"one": [5], "none apart": list(range(90)), "ties": sorted(rng.choice(range(40)) * 20 for _ in range(70))}
    for k in range(6):
        t, times = 0, []
        for _ in range(rng.choice([1, 30, 150])):
            t += rng.choice([0, 1, 1, 3, 60, 299, 300, 301, 5000])
            times.append(t)
        keys[f"k{k}"] = times
    frame = spark.createDataFrame([(g, k, t) for g, ts in keys.items() for k, t in enumerate(ts)], "glider_id string, seq long, t_s long")
    got = {}
    for r in keep_spaced(frame, 300).collect():
        got.setdefault(r.glider_id, []).append(r.seq)
    assert {g: sorted(s) for g, s in got.items()} == {g: loop(ts, 300) for g, ts in keys.items()}
    assert keep_spaced(frame.limit(0), 300).count() == 0


def test_profiles_of_noisy_pressure_of_one_glider(spark):
    """Every other row turns, so that one glider is one chain of candidates."""
    spark.conf.set("spark.thermocline.runRows", "100")
    try:
        rng = random.Random(4)
        rows = [("G", 1_700_000_000 + 45 * k, k, 100 + 80 * ((k // 20) % 2 * 2 - 1) + rng.uniform(-60, 60)) for k in range(900)]
        got = {r.seq: r for r in segments.detect_profiles(spark.createDataFrame(rows, "glider_id string, t_s long, seq long, pressure double")).collect()}
    finally:
        spark.conf.set("spark.thermocline.runRows", "16")
    index, start, before = 0, rows[0][1], None
    for k, (_, t, _, _) in enumerate(rows):
        way = got[k].profile_direction
        if before is not None and way != before and way != 0 and t - start >= 300:
            index, start = index + 1, t
        assert got[k].profile_index == index
        before = way
    assert index > 50


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([("G", k, k * 100) for k in range(50)], "glider_id string, seq long, t_s long")
    plan = keep_spaced(frame, 300)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
