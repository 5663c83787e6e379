"""Phases of high-rate records: span speeds and run lengths by duration against plain loops."""

import random

from thermocline.operators import phases
from thermocline.operators.ordered import number_by_time


def spans(ts, ps):
    """Speed of each row but the first: slopes of consecutive spans."""
    speed, start, n = [None] * len(ts), 0, len(ts)
    while start < n - 1:
        stop = start + 1
        while stop < n and ts[stop] - ts[start] < 30:
            stop += 1
        stop = min(stop, n - 1)
        if ts[stop] - ts[start] > 300 and stop - start > 1:
            stop -= 1
        for k in range(start + 1, stop + 1):
            dt = ts[stop] - ts[start]
            speed[k] = (ps[stop] - ps[start]) * 100 / dt if dt else None
        start = stop
    return speed


def record(seed, n):
    rng = random.Random(seed)
    t, rows = 1_700_000_000, []
    for k in range(n):
        t += rng.choice([1, 1, 2, 2, 4, 29, 31, 290, 400] if rng.random() < 0.1 else [1, 2, 2])
        rows.append((t, abs(k % 400 - 200) * 0.6 + rng.uniform(-0.4, 0.4)))
    return rows


def test_span_speeds_match_a_loop(spark):
    data = {f"G{s}": record(s, n) for s, n in ((1, 300), (2, 77), (3, 2), (4, 1), (5, 40))}
    frame = number_by_time(spark.createDataFrame([(g, t, p) for g, rows in data.items() for t, p in rows], "glider_id string, t_s long, pressure double"))
    got = {(r.glider_id, r.seq): r.speed for r in phases.span_speeds(frame).collect()}
    for g, rows in data.items():
        want = spans(*map(list, zip(*rows)))
        for k, w in enumerate(want):
            v = got[g, k]
            assert (v is None) == (w is None) and (v is None or abs(v - w) < 1e-9), (g, k, v, w)


def test_least_levels_skip_a_median_of_zero(spark):
    rows = [("a", 10 * k, k) for k in range(9)] + [("z", [0, 0, 0, 0, 4, 4, 8][k], k) for k in range(7)]
    frame = spark.createDataFrame([(g, 1_700_000_000 + t, s, 1.0) for g, t, s in rows], "glider_id string, t_s long, seq long, pressure double")
    assert {r[0]: r[1] for r in phases.least_levels(frame).collect()} == {"a": 30.0, "z": 75.0}


def test_short_dives_fall_back_by_duration_not_by_levels(spark):
    """At 1 Hz a dive of 200 rows lasts 200 s: by levels it is one, by duration it is none; dives of 400 s are both."""
    ps = [abs(k % 800 - 400) * 0.3 for k in range(4000)] + [60 + (k if k < 200 else 400 - k) * 0.3 for k in range(400)]
    frame = spark.createDataFrame([("G", 1_700_000_000 + k, k, p + 5) for k, p in enumerate(ps)], "glider_id string, t_s long, seq long, pressure double")
    spark.conf.set("spark.thermocline.runRows", "100000")
    try:
        levels = {r.seq: r.phase for r in phases.detect_phases(frame).collect()}
        spans_ = {r.seq: r.phase for r in phases.detect_phases(frame, by_duration=True).collect()}
    finally:
        spark.conf.set("spark.thermocline.runRows", "16")
    assert levels[1000] == spans_[1000] and levels[1400] == spans_[1400] and {levels[1000], levels[1400]} == {phases.DESCENT, phases.ASCENT}
    assert levels[4300] in (phases.DESCENT, phases.ASCENT)
    assert spans_[4300] not in (phases.DESCENT, phases.ASCENT)
