"""Ordered operators against plain Python, with runs far shorter than the keys."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thermocline.operators.ordered import Runs, exact_quantiles, number_by_time, stats_join


def frame(spark, n=200, seed=3):
    rng = random.Random(seed)
    rows = []
    for g in ("A", "B"):
        t = 1_700_000_000
        for _ in range(n if g == "A" else n // 4):
            t += rng.choice([1, 5, 60, 90_000])
            rows.append((g, t, rng.choice([None, round(rng.uniform(-5, 5), 3)])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "glider_id string, t_s bigint, v double"), sorted(rows)


def test_number_by_time_counts_rows(spark):
    df, rows = frame(spark)
    got = {(r.glider_id, r.t_s): r.seq for r in number_by_time(df).collect()}
    for g in ("A", "B"):
        assert [got[(g, t)] for x, t, _ in rows if x == g] == list(range(sum(x == g for x, _, _ in rows)))


def test_carried_windows_match_python(spark):
    df, rows = frame(spark)
    value = F.when(F.col("v").isNotNull(), F.struct("t_s", "v"))
    runs = Runs(number_by_time(df), before=3, after=2, prev={"v": value}, nxt={"v": value}, total={"v": F.col("v")}, peak={"v": F.col("v")}, rows=7)
    runs.with_columns(
        {"p": runs.before("v")["v"], "n": runs.after("v")["v"], "s": runs.cumulative("v"), "m": runs.peak_before("v"), "l3": runs.lag("t_s", 3), "f2": runs.lead("t_s", 2)}
    )
    got = {(r.glider_id, r.t_s): r for r in runs.done().collect()}
    assert len(got) == len(rows)
    for g in ("A", "B"):
        mine = [(t, v) for x, t, v in rows if x == g]
        for i, (t, _) in enumerate(mine):
            r = got[(g, t)]
            before = [v for _, v in mine[:i] if v is not None]
            after = [v for _, v in mine[i + 1 :] if v is not None]
            assert r.p == (before[-1] if before else None)
            assert r.n == (after[0] if after else None)
            assert r.m == (max(before) if before else None)
            assert r.s == pytest.approx(sum(v for _, v in mine[: i + 1] if v is not None))
            assert r.l3 == (mine[i - 3][0] if i >= 3 else None)
            assert r.f2 == (mine[i + 2][0] if i + 2 < len(mine) else None)


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_exact_quantiles_match_numpy(spark, accuracy):
    rng = np.random.default_rng(5)
    values = {"A": np.round(rng.exponential(10, 3000), 1), "B": rng.normal(0, 1, 77), "C": np.array([4.5])}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("A", None), ("D", None)]
    df = spark.createDataFrame(rows, "glider_id string, v double")
    qs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = {r.glider_id: r for r in exact_quantiles(df, ["glider_id"], {"q": (F.col("v"), qs)}, accuracy).collect()}
    for g, vs in values.items():
        assert got[g].q_n == len(vs)
        assert np.allclose(got[g].q, np.quantile(vs, qs), rtol=1e-12)
    assert got["D"].q_n == 0 and got["D"].q == [None] * len(qs)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=40), st.floats(0, 1))
def test_quantile_property(spark, values, q):
    df = spark.createDataFrame([("A", v) for v in values], "glider_id string, v double")
    row = exact_quantiles(df, ["glider_id"], {"q": (F.col("v"), [q])}).first()
    assert row.q[0] == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_stats_join_both_ways(spark):
    df = spark.range(20).withColumn("k", F.col("id") % 3)
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    small = sorted(map(tuple, stats_join(df, stats, ["k"]).collect()))
    spark.conf.set("spark.thermocline.broadcastRows", "1")
    try:
        assert sorted(map(tuple, stats_join(df, stats, ["k"]).collect())) == small
    finally:
        spark.conf.unset("spark.thermocline.broadcastRows")


def test_outliers_leave_no_full_bin(spark):
    from thermocline.operators.ordered import bin_of

    values = spark.range(20_000).select((F.rand(3)).alias("v"))
    for lo, hi in ((0.0, 1e9), (-1e9, 1.0), (0.0, 1.0)):
        bins = values.withColumn("b", bin_of(F.col("v"), F.lit(lo), F.lit(hi)))
        largest = bins.groupBy("b").count().agg(F.max("count")).first()[0]
        assert largest < 1_000
        ordered = [r.b for r in bins.orderBy("v").collect()]
        assert ordered == sorted(ordered)


@pytest.mark.parametrize("ends", [(-1e12, 1e9), (0.5, 1e9), (-1e9, 0.5)])
def test_quantiles_beside_outliers(spark, ends):
    rng = np.random.default_rng(7)
    vs = np.concatenate([rng.normal(0, 1, 3000), np.array(ends)])
    df = spark.createDataFrame([("A", float(v)) for v in vs], "glider_id string, v double")
    qs = [0.0, 0.003, 0.5, 0.995, 1.0]
    got = exact_quantiles(df, ["glider_id"], {"q": (F.col("v"), qs)}, 100).first().q
    assert np.allclose(got, np.quantile(vs, qs), rtol=1e-12)


def test_stamps_that_repeat(spark):
    from thermocline.operators.cleaning import dedupe_time

    df = spark.createDataFrame([("A", 1, None, "n"), ("A", 1, 5, "five"), ("A", 1, 9, "nine"), ("A", None, 2, "two"), ("B", 1, None, "alone")], "glider_id string, t_s long, row_id long, x string")
    assert {r.x for r in dedupe_time(df).collect()} == {"five", "two", "alone"}
    assert {r.x for r in dedupe_time(df, "last").collect()} == {"nine", "two", "alone"}
    assert "WindowGroupLimit" in dedupe_time(df)._jdf.queryExecution().toString()
