"""The median-distance spike test against a plain loop over one profile at a time."""

import math
import random

import pytest

from thermocline.operators import median_distance as md


def pick(p, levels, values):
    for level, value in zip(levels, values):
        if p < level:
            return value
    return values[-1]


def half_width(p):
    z, w = md.WIDTH_LEVELS, md.WIDTHS
    if p < z[0]:
        width = w[0]
    elif p >= z[3]:
        width = w[3]
    else:
        k = max(n for n in range(3) if p >= z[n])
        width = w[k] + (w[k + 1] - w[k]) * (p - z[k]) / (z[k + 1] - z[k])
    return math.ceil(width / 2) + 1


def sign(x):
    return (x > 0) - (x < 0)


def plain(variable, levels, distances):
    """Which of the (p, v) levels, by p, are outside the envelope."""
    n = len(levels)
    ps, vs = [p for p, _ in levels], [v for _, v in levels]
    g = [None] * n
    for k in range(1, n):
        dv, dp = vs[k] - vs[k - 1], ps[k] - ps[k - 1]
        g[k] = 0.0 if abs(dv) < 0.01 and abs(dp) < 5 else math.copysign(math.inf, dv) if dp == 0 else dv / dp
    g[0] = g[1]
    steep = [pick(p, md.GRADIENT_LEVELS, md.GRADIENT[variable]) for p in ps]
    sharp = [pick(p, md.GRADIENT_LEVELS, md.TURN[variable]) for p in ps]
    out = [False] * n
    for k in range(1, n - 1):
        out[k] = abs(g[k]) > sharp[k] and abs(g[k + 1]) > sharp[k + 1] and sign(g[k]) == -sign(g[k + 1])
    out[0] = out[1]
    for k in range(n):
        out[k] |= variable == "density" and g[k] < -0.001 or variable == "temperature" and g[k] > 0.5 or abs(g[k]) > steep[k]
    raw, own = [None] * n, [False] * n
    for k in range(n):
        near = [j for j in range(n) if abs(ps[j] - ps[k]) < half_width(ps[k]) and not out[j]]
        above, below = [j for j in near if ps[j] < ps[k]], [j for j in near if ps[j] > ps[k]]
        m = min(len(above), len(below))
        if m:
            near = above[-m:] + [k] * (k in near) + below[:m]
        near = near or [k]
        if len(near) % 2 == 0:
            near = near[:1] + near
        raw[k] = sorted(vs[j] for j in near)[len(near) // 2]
        if k > 0 and not out[k] and not out[k - 1] and k in near[-2:]:
            own[k] = True
        if k < n - 1 and not out[k] and not out[k + 1] and k in near[:2] and not (variable == "temperature" and g[k] > 0.1):
            own[k] = True
        if ps[k] >= 1950 and not out[k]:
            shallow = [j for j in range(n) if ps[j] < 1950]
            if shallow and abs((vs[k] - vs[shallow[-1]]) / (ps[k] - ps[shallow[-1]])) > steep[k]:
                raw[k], own[k] = raw[shallow[-1]], False
            else:
                own[k] = True
    med = [vs[k] if own[k] else raw[k] for k in range(n)]
    sound = [k for k in range(n) if not out[k]]
    last = sound[0] if sound else 0
    final = list(med)
    for k in range(n):
        last = k if not out[k] else last
        final[k] = med[last] if sound else vs[0]
    low, high = md.EXTENT[variable]
    lx = max(min(max(final) - min(final), high), low)
    found = []
    for k in range(n):
        d = pick(ps[k], md.WIDTH_LEVELS[1:], distances)
        curve = list(zip(ps, final))
        for (p0, x0), (p1, x1) in zip(curve[:n], curve[1:n]):
            m = math.floor(math.hypot(x1 - x0, (p1 - p0) * lx / 700) / (d * lx) - 0.2)
            curve = curve + [(p0 + (p1 - p0) * j / (m + 1), x0 + (x1 - x0) * j / (m + 1)) for j in range(1, m + 1)]
        arms = [(x, lx * math.sqrt(d * d - ((ps[k] - p) / 700) ** 2)) for p, x in curve if abs(ps[k] - p) / 700 <= d]
        found.append(vs[k] > max(x + a for x, a in arms) or vs[k] < min(x - a for x, a in arms))
    return found


def expected(rows):
    """spikes by seq of one profile's (seq, p, t, s, d, lat)."""
    rows = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0]))
    spikes, assessed = {}, {}
    lats = [r[5] for r in rows if r[5] is not None]
    equator = not lats or abs(sum(lats) / len(lats)) <= 10
    alone = all(r[3] is None for r in rows)
    for c, variable in ((2, "temperature"), (3, "salinity"), (4, "density")):
        held = [r for r in rows if r[c] is not None]
        assessed[variable] = len(held) > 5
        d = (md.ALONE_EQUATOR if equator else md.ALONE) if variable == "temperature" and alone else md.DISTANCE[variable]
        marks = plain(variable, [(r[1], r[c]) for r in held], d) if len(held) > 5 else []
        spikes[variable] = {r[0] for r, m in zip(held, marks) if m}
    return {
        r[0]: tuple((r[0] in spikes[v] and (r[4] is None or r[0] in spikes["density"])) if assessed[v] else None for v in ("temperature", "salinity"))
        for r in rows
    }


def profile(seed):
    rng = random.Random(seed)
    n = rng.choice([4, 6, 12, 60, 60, 90])
    depth = rng.choice([80, 400, 1100, 2300])
    rows, p = [], 0.0
    for k in range(n):
        p += rng.choice([0, 0.4, 1, 1, 2]) * depth / n
        t = 4 + 20 * math.exp(-p / 300) + rng.uniform(-0.02, 0.02)
        s = 35 + 1.5 * math.exp(-p / 500) + rng.uniform(-0.003, 0.003)
        d = 1022 + 5 * (1 - math.exp(-p / 400)) + rng.uniform(-0.002, 0.002)
        if rng.random() < 0.12:
            jump = rng.choice([-1, 1]) * rng.choice([0.3, 2, 6])
            t, s, d = t + jump, s - jump / 3, d - jump * rng.choice([0, 0.3])
        gone = rng.random()
        rows.append([k, None if gone < 0.03 else round(p, 3), None if 0.03 < gone < 0.08 else t, None if 0.06 < gone < 0.1 or seed % 5 == 0 else s, None if gone > 0.93 or seed % 7 == 0 else d, None if k % 9 else (5.0 if seed % 2 else 40.0)])
    if seed % 3 == 0:
        ps = [r[1] for r in rows][::-1]
        for r, q in zip(rows, ps):
            r[1] = q
    return rows


@pytest.mark.parametrize("block", range(3))
def test_spikes_match_a_plain_loop(spark, block):
    profiles = {k: profile(k) for k in range(block * 12, block * 12 + 12)}
    frame = spark.createDataFrame(
        [("G", k, *r) for k, rows in profiles.items() for r in rows], "glider_id string, profile_index int, seq int, pressure double, temperature double, salinity double, density double, latitude double"
    )
    got = {}
    for r in md.median_distance_spikes(frame).collect():
        got.setdefault(r.profile_index, {})[r.seq] = (r.spike_temperature, r.spike_salinity)
    for k, rows in profiles.items():
        assert got.get(k, {}) == expected(rows), k
    assert any(True in marks for rows in got.values() for marks in rows.values())


def test_few_values_and_no_rows(spark):
    schema = "glider_id string, profile_index int, seq int, pressure double, temperature double, salinity double, density double, latitude double"
    frame = spark.createDataFrame([("G", 1, k, float(k), 10.0 + 9 * (k == 2), None, None, 0.0) for k in range(5)], schema)
    assert {(r.spike_temperature, r.spike_salinity) for r in md.median_distance_spikes(frame).collect()} == {(None, None)}
    assert md.median_distance_spikes(frame.limit(0)).count() == 0
