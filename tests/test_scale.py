"""Plans that move no more than they have to, and quantiles that need no sketch."""

import numpy as np
from pyspark.sql import functions as F

from thermocline.operators import corrections, greedy, grid, median_distance
from thermocline.operators.grid import profile_grid
from thermocline.operators.ordered import coarse_bin, exact_quantiles, stats_join
from thermocline.operators.publish import load_parquet
from thermocline.operators.reports import sensor_failures
from thermocline.plans import queries_profiles


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_per_glider_are_broadcast(spark):
    df = spark.range(1000).select(F.concat(F.lit("G"), F.col("id") % 3).alias("glider_id"), F.col("id").alias("t_s"), F.col("id").cast("double").alias("v"))
    assert "SortMergeJoin" not in plan(stats_join(df, df.groupBy("glider_id").agg(F.max("v").alias("top")), ["glider_id"]))
    assert "SortMergeJoin" not in plan(sensor_failures(df, ["v"]))


def test_cells_of_a_profile_are_not_sorted_or_moved(spark):
    rows = [("G", p, float(d), float(d + p)) for p in range(2) for d in range(1, 40)]
    # a sparse profile with two slots in cell 5: the deeper one stays
    rows += [("G", 2, 5.2, 1.0), ("G", 2, 5.8, 2.0), ("G", 2, 9.2, 3.0)]
    grid = profile_grid(spark.createDataFrame(rows, "glider_id string, profile_index long, depth double, v double"), ["v"])
    text = plan(grid)
    moves = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "profile_index" in line]
    assert len(moves) == 1 and "row_number" not in text
    got = {(r.profile_index, r.cell): r.value for r in grid.collect()}
    assert {c: v for (p, c), v in got.items() if p == 2} == {5: 2.0, 9: 3.0}
    assert got[0, 10] == 10.5 and len([1 for p, _ in got if p == 0]) == 38


def test_bins_hang_on_the_value_alone(spark):
    numbers = sorted([0.0, -1e-300, 1e-300, 5.0, 5.01, -5.0, 1e300, -1e300, float("inf"), float("-inf")])
    bins = [r.b for r in spark.createDataFrame([(v,) for v in numbers], "v double").select("v", coarse_bin(F.col("v"), 4096).alias("b")).orderBy("v").collect()]
    assert bins == sorted(bins) and len(set(bins)) == len(numbers)


def test_quantiles_between_outliers_and_of_keys_without_values(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([1025 + rng.normal(0, 1e-3, 3000), [-9999.0] * 40, [9999.0] * 40])
    rows = [("G0", float(x)) for x in v] + [("G1", None)]
    qs = [0.0, 0.02, 0.25, 0.5, 0.95, 1.0]
    q = exact_quantiles(spark.createDataFrame(rows, "glider_id string, v double"), ["glider_id"], {"q": (F.col("v"), qs)})
    # no sketch whose bracket could miss a rank
    assert "percentile_approx" not in q._jdf.queryExecution().optimizedPlan().toString()
    got = {r.glider_id: r for r in q.collect()}
    assert np.allclose(got["G0"].q, np.quantile(v, qs), rtol=0, atol=1e-12) and got["G0"].q_n == len(v)
    assert got["G1"].q == [None] * len(qs) and got["G1"].q_n == 0


def test_a_slow_record_needs_few_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).select(F.col("id").alias("k"), F.lit("G").alias("glider_id"), (F.col("id") * 86_400).alias("t_s"), F.lit(1.0).alias("value"))
    load_parquet(rows, path, ["k"])
    load_parquet(rows.withColumn("value", F.lit(2.0)).filter("k < 35"), path, ["k"])
    assert len(list((tmp_path / "t").glob("glider_id=G/*"))) == 2
    assert {r.k: r.value for r in spark.read.parquet(path).collect()} == {k: 2.0 if k < 35 else 1.0 for k in range(40)}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_of_the_grid_grow_in_number_with_the_samples(spark, monkeypatch):
    monkeypatch.setattr(grid, "TASK_SAMPLES", 10)
    rows = [("G", p, float(d), float(d + p)) for p in range(2) for d in range(1, 40)]
    made = profile_grid(spark.createDataFrame(rows, "glider_id string, profile_index long, depth double, v double"), ["v"])
    # 78 samples, 4 partitions by the settings
    assert "RepartitionByExpression [glider_id" in optimized(made) and ", 8" in optimized(made).split("RepartitionByExpression")[1].split("\n")[0]
    assert made.count() == 76


def test_levels_near_the_median_draw_no_curve(spark):
    rows = [("G", p, "temperature", k, float(5 * k), 20.0 - 0.1 * k + (9.0 if p == 1 and k == 6 else 0.0), 20.0 - 0.1 * k, False, False) for p in range(2) for k in range(1, 13)]
    names = "glider_id string, profile_index long, variable string, seq long, p double, v double, median double, alone boolean, equator boolean"
    out = median_distance.outside_envelope(spark.createDataFrame(rows, names))
    assert "collect_set" in optimized(out)
    assert [(r.profile_index, r.seq) for r in out.collect()] == [(1, 6)]


def test_lambda_functions_over_times_evaluate_no_expression_again(spark):
    times = [0, 10, 25, 31, 40, 70]
    runs = spark.createDataFrame([("G", 0, times, times[0])], "glider_id string, run long, times array<bigint>, first bigint")
    steps = greedy._functions(runs, 30)
    assert optimized(steps).count("transform(") == 1
    # what a time carried from before the run leaves as, by a plain walk
    def walk(carried):
        for t in times:
            if t - carried >= 30:
                carried = t
        return carried

    got = steps.first().steps
    for carried in range(-60, 1):
        assert next((s.exit for s in got if s.bound >= carried), carried) == walk(carried)


def test_smoothing_has_one_formula_for_all_rows_of_the_fit(spark):
    rows = [("G", 0, k, float(3 * k * k - k)) for k in range(30)]
    smooth = corrections.smooth_profiles(spark.createDataFrame(rows, "glider_id string, profile_index long, seq long, v double"), {"v": "s"})
    assert optimized(smooth).count(" * ") < 60
    assert np.allclose([r.s for r in smooth.orderBy("seq").collect()], [r[3] for r in rows], rtol=0, atol=1e-8)


def test_profile_tests_move_only_the_columns_they_read(spark, tmp_path):
    events = spark.range(90).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"),
        F.col("id").alias("user_id"), F.lit("click").alias("event_type"), (F.col("id") * 1.5).alias("value"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    made = queries_profiles.altered(spark, str(tmp_path))
    tested = queries_profiles.TESTED
    assert set(made.columns) == {"glider_id", "profile_index", "t_s", "seq", *tested, *[f"{v}_QC" for v in tested]}
