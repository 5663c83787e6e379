"""Registered queries: grids and section products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators import grid as gr
from ..operators import sections as se
from ..operators.publish import grid_retention, write_grid
from ..session import materialise, table_path
from .common import SCREENED_CTE, rounded, sql
from .fixture import l0
from .queries_qc import FULL_CTES, SLICE_CTES, START_CTE, flagged
from .registry import query

VARIABLES = ["temperature", "salinity", "density", "chlorophyll"]


def thinned(spark, sf):
    """Screened series with some sparse and some short profiles."""
    base = cl.blank_absurd_temperature(cl.blank_null_island(l0(spark, sf)))
    keep = (F.col("profile_index") % 13 != 5) | (F.col("seq") % 17 == 0)
    near = (F.col("profile_index") % 17 != 6) | (F.col("depth") < 60)
    return base.withColumn("salinity", F.when(keep & near, F.col("salinity")))


THIN_CTE = "th AS (SELECT * REPLACE (CASE WHEN (profile_index % 13 <> 5 OR seq % 17 = 0) AND (profile_index % 17 <> 6 OR depth < 60) THEN salinity END AS salinity) FROM cl)"


def grid_cte(source: str, variables: list[str], flags: bool = False, values: str | None = None) -> str:
    good = lambda v: f" AND {v}_QC IN (1, 2)" if flags else ""
    union = " UNION ALL ".join(
        f"SELECT glider_id, profile_index, depth, '{v}' AS variable, {v} AS value FROM {source} WHERE {v} IS NOT NULL AND depth IS NOT NULL AND profile_index IS NOT NULL{good(v)}"
        for v in variables
    )
    return f"""ge AS (SELECT glider_id, CAST(ceil(CASE WHEN max(depth) >= 10 THEN max(depth) ELSE 1000 END) AS BIGINT) AS cells FROM {source} GROUP BY 1),
gp AS (SELECT glider_id, profile_index, variable, depth AS d, avg(value) AS v FROM ({values or union}) GROUP BY 1, 2, 3, 4),
gs AS (SELECT *, lead(d) OVER w AS d2, lead(v) OVER w AS v2, count(*) OVER p AS n, max(d) OVER p - min(d) OVER p AS span FROM gp JOIN ge USING (glider_id)
  WINDOW w AS (PARTITION BY glider_id, profile_index, variable ORDER BY d), p AS (PARTITION BY glider_id, profile_index, variable)),
gt AS (SELECT *, n < 4 OR (cells > 1 AND span/(cells - 1) < 0.15) AS sparse FROM gs),
grid AS (SELECT glider_id, profile_index, variable, c AS cell, c + 0.5 AS depth, CASE WHEN c + 0.5 = d THEN v ELSE v + (v2 - v)*((c + 0.5 - d)/(d2 - d)) END AS value
  FROM (SELECT *, unnest(range(CAST(greatest(ceil(d - 0.5), 0) AS BIGINT), CASE WHEN d2 IS NULL THEN CASE WHEN d - 0.5 = floor(d - 0.5) THEN CAST(d + 0.5 AS BIGINT) ELSE 0 END ELSE least(CAST(ceil(d2 - 0.5) AS BIGINT), cells) END)) AS c FROM gt WHERE NOT sparse) WHERE c < cells
  UNION ALL SELECT glider_id, profile_index, variable, c, c + 0.5, max_by(v, d) FROM (SELECT *, CAST(least(greatest(ceil(d) - 1, 0), cells - 1) AS BIGINT) AS c FROM gt WHERE sparse) GROUP BY 1, 2, 3, 4),
gc AS (SELECT *, row_number() OVER (PARTITION BY glider_id ORDER BY profile_index) - 1 AS col, coalesce(time - lag(time) OVER (PARTITION BY glider_id ORDER BY profile_index) > 172800, false) AS after_gap
  FROM (SELECT glider_id, profile_index, avg(t_s) AS time FROM {source} GROUP BY 1, 2)),
gm AS (SELECT grid.* FROM grid JOIN gc USING (glider_id, profile_index) WHERE NOT after_gap),
gu AS (SELECT glider_id, variable, coalesce(least(good + greatest(10, good*0.05), cells - 0.5), anyd) AS usable FROM (
  SELECT glider_id, variable, max(cell + 0.5) FILTER (WHERE k/np >= 0.1) AS good, max(cell + 0.5) AS anyd FROM (SELECT glider_id, variable, cell, CAST(count(*) AS double) AS k FROM grid GROUP BY 1, 2, 3)
  JOIN (SELECT glider_id, count(*) AS np FROM gc GROUP BY 1) USING (glider_id) GROUP BY 1, 2) JOIN ge USING (glider_id))"""


GRID = (SCREENED_CTE, THIN_CTE, grid_cte("th", VARIABLES))


def gridded(spark, sf):
    """(grid, columns, extent), the grid written once for the products that read it repeatedly."""
    base = thinned(spark, sf)
    return (
        materialise(gr.profile_grid(base, VARIABLES)),
        materialise(gr.column_table(base)),
        materialise(gr.grid_extent(base)),
    )


def segmented(spark, sf, neighbours=False):
    """`gridded` for products over all cells: what the grid reads and its segments are written, cells are made where they are read."""
    base = materialise(thinned(spark, sf).select("glider_id", "profile_index", "t_s", "depth", *VARIABLES))
    return (
        gr.segment_cells(materialise(gr.profile_segments(base, VARIABLES, neighbours=neighbours))),
        materialise(gr.column_table(base)),
        materialise(gr.grid_extent(base)),
    )


def usable_depths(grid, cols, extent):
    """Written once: the products read it more than once."""
    return materialise(gr.usable_depth(grid, cols, extent))


@query("grid_profiles", sql("SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, CAST(depth AS DOUBLE) AS depth, round(value, 6) AS value FROM grid", *GRID))
def profiles(spark, sf):
    return rounded(gr.profile_grid(thinned(spark, sf), VARIABLES))


@query("written_grid", sql("SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, CAST(depth AS DOUBLE) AS depth, round(value, 6) AS value FROM grid", *GRID))
def written_grid(spark, sf):
    path = table_path(spark)
    write_grid(gr.profile_grid(thinned(spark, sf), VARIABLES), path)
    return rounded(spark.read.parquet(path).select("glider_id", "profile_index", "variable", "cell", "depth", "value"))


@query(
    "grid_profiles_qc",
    sql("SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, round(value, 6) AS value FROM grid", *SLICE_CTES, "gq AS (SELECT cl.glider_id, profile_index, depth, temperature, salinity, cl.t_s, temperature_QC, salinity_QC FROM cl JOIN fl USING (glider_id, t_s))", grid_cte("gq", ["temperature", "salinity"], True)),
)
def profiles_qc(spark, sf):
    from ..operators import qc
    from ..schema import GLOBAL_RANGE, SPIKE_LIMITS
    from .queries_qc import DEEP_VERDICT, screened

    base = qc.neighbour_masks(qc.start_flags(screened(spark, sf)), ("spike",))
    verdicts = [(qc.out_of_range(v), 4, [v]) for v in GLOBAL_RANGE]
    verdicts += [(F.col(f"spike_{v}"), 4, [v]) for v in SPIKE_LIMITS]
    verdicts.append((F.col("pressure") > qc.deepest_allowed(F.lit(1000.0)), 3, DEEP_VERDICT[2]))
    done = qc.apply_cascades(qc.raise_all(base, verdicts))
    return rounded(gr.profile_grid(done, ["temperature", "salinity"], apply_qc=True).drop("depth"))


@query("grid_columns", sql("SELECT glider_id, profile_index, round(time, 3) AS time, col, after_gap FROM gc", *GRID))
def columns(spark, sf):
    return rounded(gr.column_table(thinned(spark, sf)), 3)


@query(
    "grid_time_bins",
    sql(
        """SELECT glider_id, variable, CAST(t0 + least(floor((t_s - t0)/bs), greatest(ceil(dur/bs) - 1, 0))*bs + floor(bs/2) AS BIGINT) AS time, CAST(least(floor(depth), nd - 1) AS BIGINT) AS cell, round(avg(value) + 3e-8, 6) AS value
        FROM (SELECT glider_id, t_s, depth, 'temperature' AS variable, temperature AS value FROM th UNION ALL SELECT glider_id, t_s, depth, 'salinity', salinity FROM th)
        JOIN (SELECT glider_id, min(t_s) AS t0, CAST(max(t_s) - min(t_s) AS double) AS dur, floor(least(10800, greatest((max(t_s) - min(t_s))/5.0, 60))) AS bs,
          CASE WHEN quantile_cont(depth, 0.995) >= 10 THEN ceil(quantile_cont(depth, 0.995)) ELSE 1000 END AS nd FROM th GROUP BY 1) USING (glider_id) WHERE value IS NOT NULL AND depth IS NOT NULL GROUP BY 1, 2, 3, 4""",
        SCREENED_CTE, THIN_CTE,
    ),
)
def time_bins(spark, sf):
    # the shift keeps exact halves off the rounding border
    return gr.time_grid(thinned(spark, sf), ["temperature", "salinity"]).withColumn("value", F.round(F.col("value") + 3e-8, 6))


@query("grid_gap_mask", sql("SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, round(value, 6) AS value FROM gm", *GRID))
def gap_mask(spark, sf):
    grid, cols, _ = gridded(spark, sf)
    return rounded(gr.mask_gaps(grid, cols).drop("depth"))


@query(
    "grid_sparse_cells",
    sql(
        """SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, round(value, 6) AS value FROM grid JOIN (SELECT glider_id, variable, cell, count(*) AS k FROM grid GROUP BY 1, 2, 3) USING (glider_id, variable, cell)
        JOIN (SELECT glider_id, count(*) AS np FROM gc GROUP BY 1) USING (glider_id) WHERE NOT (np > 5 AND k < greatest(np*0.1, 3))""",
        *GRID,
    ),
)
def sparse_cells(spark, sf):
    grid, cols, _ = gridded(spark, sf)
    return rounded(gr.suppress_sparse_cells(grid, cols).select("glider_id", "profile_index", "variable", "cell", "value"))


@query("grid_display_limits", sql("SELECT glider_id, variable, round(quantile_cont(value, 0.02), 6) AS low, round(quantile_cont(value, 0.98), 6) AS high FROM grid GROUP BY 1, 2", *GRID))
def limits(spark, sf):
    return rounded(gr.display_limits(gridded(spark, sf)[0]))


@query("grid_usable_depth", sql("SELECT glider_id, variable, round(CAST(usable AS DOUBLE), 6) AS usable_depth FROM gu", *GRID))
def usable(spark, sf):
    return rounded(gr.usable_depth(*gridded(spark, sf)))


@query(
    "section_mixed_layer_depth",
    sql(
        """SELECT glider_id, profile_index, CAST(coalesce(min(depth) FILTER (WHERE depth > 10 AND abs(value - ref) > 0.2), max(depth)) AS DOUBLE) AS mixed_layer_depth
        FROM (SELECT * FROM grid WHERE variable = 'temperature') JOIN (SELECT glider_id, profile_index, coalesce(max(value) FILTER (WHERE cell = least(9, cells - 1)), avg(value) FILTER (WHERE cell <= least(9, cells - 1) + 1)) AS ref
          FROM grid JOIN ge USING (glider_id) WHERE variable = 'temperature' GROUP BY 1, 2 HAVING count(*) >= 5) USING (glider_id, profile_index) WHERE ref IS NOT NULL GROUP BY 1, 2""",
        *GRID,
    ),
)
def mld(spark, sf):
    grid, _, extent = gridded(spark, sf)
    return se.mixed_layer_depth(grid, extent)


def iso_sql(variable, falling):
    wide, digits = ("1.0", 1) if falling else ("0.5", 2)
    op, gone = ("<", "<=") if falling else (">", ">=")
    default = str(se.ISO_DEFAULTS[falling])
    return (
        f"""iq AS (SELECT glider_id, count(*) AS n, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM grid WHERE variable = '{variable}' GROUP BY 1),
il AS (SELECT DISTINCT glider_id, CAST(unnest(CASE WHEN n <= 100 THEN {default} WHEN hi - lo > {wide} THEN [round(lo + (hi - lo)*0.15 + ((hi - (hi - lo)*0.15) - (lo + (hi - lo)*0.15))*k/4.0, {digits}) for k in [0, 1, 2, 3, 4]]
  ELSE [round(lo + 0.1, 2), round((lo + hi)/2, 2), round(hi - 0.1, 2)] END) AS DOUBLE) AS level FROM iq),
ic AS (SELECT *, lag(value) OVER w AS v0, lag(depth) OVER w AS d0, count(*) OVER (PARTITION BY glider_id, profile_index) AS n, first_value(value) OVER w AS surf FROM grid WHERE variable = '{variable}'
  WINDOW w AS (PARTITION BY glider_id, profile_index ORDER BY cell)),
ix AS (SELECT *, row_number() OVER (PARTITION BY glider_id, profile_index, level ORDER BY cell) AS k FROM ic JOIN il USING (glider_id) WHERE n >= 3 AND NOT surf {gone} level AND value {op} level)""",
        f"SELECT glider_id, profile_index, round(level, 3) AS level, round(d0 + (level - v0)/(value - v0)*(depth - d0), 4) AS iso_depth FROM ix WHERE k = 1",
    )


for variable, falling in (("temperature", True), ("density", False)):
    CTE, BODY = iso_sql(variable, falling)

    @query(f"section_iso_depth_{variable}", sql(BODY, *GRID, CTE))
    def iso(spark, sf, variable=variable, falling=falling):
        grid = gridded(spark, sf)[0]
        out = se.iso_depth(grid, se.iso_levels(grid, variable, falling), variable, falling)
        return out.select("glider_id", "profile_index", F.round("level", 3).alias("level"), F.round("iso_depth", 4).alias("iso_depth"))


ANOMALY_CTE = "ga AS (SELECT *, value - avg(value) OVER (PARTITION BY glider_id, variable, cell) AS anomaly FROM gm JOIN gu USING (glider_id, variable) WHERE depth <= usable)"


@query(
    "section_depth_anomaly",
    sql(
        "SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, round(anomaly + 3e-8, 6) AS anomaly, round(lim, 6) AS anomaly_limit FROM ga JOIN (SELECT glider_id, variable, quantile_cont(abs(anomaly), 0.95) AS lim FROM ga GROUP BY 1, 2) USING (glider_id, variable)",
        *GRID, ANOMALY_CTE,
    ),
)
def anomaly(spark, sf):
    grid, cols, extent = gridded(spark, sf)
    out = se.depth_anomaly(grid, cols, usable_depths(grid, cols, extent))
    return rounded(out.withColumn("anomaly", F.col("anomaly") + 3e-8).select("glider_id", "profile_index", "variable", "cell", "anomaly", "anomaly_limit"))


@query(
    "section_vertical_gradient",
    sql(
        """SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, round(g, 6) AS gradient FROM (SELECT *, CASE WHEN cell = 0 THEN nx - value WHEN cell = floor(lim - 0.5) THEN value - pv ELSE (nx - pv)/2 END AS g FROM (
        SELECT *, CASE WHEN lag(cell) OVER w = cell - 1 THEN lag(value) OVER w END AS pv, CASE WHEN lead(cell) OVER w = cell + 1 THEN lead(value) OVER w END AS nx FROM (SELECT gm.*, least(600, usable) AS lim FROM gm JOIN gu USING (glider_id, variable)) WHERE depth <= lim
        WINDOW w AS (PARTITION BY glider_id, profile_index, variable ORDER BY cell))) WHERE g IS NOT NULL""",
        *GRID,
    ),
)
def gradient(spark, sf):
    grid, cols, extent = segmented(spark, sf, neighbours=True)
    return rounded(se.vertical_gradient(grid, cols, usable_depths(grid, cols, extent), limit=600.0))


@query(
    "section_envelope",
    sql(
        "SELECT glider_id, variable, CAST(cell AS BIGINT) AS cell, round(min(value), 6) AS v_min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS v_max FROM grid GROUP BY 1, 2, 3",
        *GRID,
    ),
)
def envelope(spark, sf):
    return rounded(se.profile_envelope(segmented(spark, sf)[0]))


@query(
    "section_surface_series",
    sql(
        """SELECT x.glider_id, x.profile_index, x.variable, round(x.time, 3) AS time, round(x.surface, 6) AS surface, round(avg(y.surface), 6) AS smoothed FROM (SELECT *, unnest([-2, -1, 0, 1, 2]) AS k FROM ss WHERE surface IS NOT NULL) x
        JOIN ss y ON y.glider_id = x.glider_id AND y.variable = x.variable AND y.col = least(greatest(x.col + k, 0), x.mc) GROUP BY 1, 2, 3, 4, 5""",
        *GRID,
        """sv AS (SELECT glider_id, profile_index, variable, avg(value) AS surface FROM grid JOIN ge USING (glider_id) WHERE depth <= least(greatest(15, 0.05*(cells - 0.5)), 50) GROUP BY 1, 2, 3),
        ss AS (SELECT gc.glider_id, gc.profile_index, n.variable, time, col, surface, max(col) OVER (PARTITION BY gc.glider_id) AS mc FROM gc JOIN (SELECT DISTINCT glider_id, variable FROM sv) n USING (glider_id) LEFT JOIN sv ON sv.glider_id = gc.glider_id AND sv.profile_index = gc.profile_index AND sv.variable = n.variable)""",
    ),
)
def surface(spark, sf):
    grid, cols, extent = gridded(spark, sf)
    out = se.surface_series(grid, cols, extent)
    return out.withColumns({"time": F.round("time", 3), "surface": F.round("surface", 6), "smoothed": F.round("smoothed", 6)})


@query(
    "section_extract",
    sql(
        """SELECT glider_id, profile_index, variable, CAST(cell AS BIGINT) AS cell, round(v, 6) AS value, round(p2, 6) AS low, round(p98, 6) AS high, CAST(floor(round((v - p5)/(p95 - p5)*7, 9)) AS BIGINT) AS contour
        FROM sx JOIN (SELECT glider_id, variable, quantile_cont(v, 0.02) AS p2, quantile_cont(v, 0.05) AS p5, quantile_cont(v, 0.95) AS p95, quantile_cont(v, 0.98) AS p98 FROM sx GROUP BY 1, 2) USING (glider_id, variable)""",
        *GRID, "sx AS (SELECT *, greatest(value, 0) AS v FROM gm JOIN gu USING (glider_id, variable) WHERE depth <= usable AND variable IN ('temperature', 'chlorophyll'))",
    ),
)
def extract(spark, sf):
    grid, cols, extent = gridded(spark, sf)
    return rounded(se.section(grid, cols, usable_depths(grid, cols, extent), ["temperature", "chlorophyll"], floor_zero=True))


FLAG_JOIN = "fq AS (SELECT cl.*, temperature_QC, salinity_QC, latitude_QC FROM cl JOIN fl USING (glider_id, t_s))"
GOOD_TS = "gt0 AS (SELECT * FROM fq WHERE temperature IS NOT NULL AND salinity IS NOT NULL AND temperature_QC IN (1, 2) AND salinity_QC IN (1, 2))"


def simple_flags(spark, sf):
    """Series flagged by range and depth only: enough for products that just read flags."""
    from ..operators import qc
    from ..schema import GLOBAL_RANGE
    from .queries_qc import screened

    base = qc.raise_all(qc.start_flags(screened(spark, sf)), [(qc.out_of_range(v), 4, [v]) for v in GLOBAL_RANGE])
    # written once, like the stored series: filters on flags then read columns, not nested expressions
    return materialise(qc.apply_cascades(base))


def simple_flag_ctes():
    from .queries_qc import RANGE_VERDICTS, cascades_sql, raised_all

    ctes = cascades_sql(raised_all(RANGE_VERDICTS[:-1]), "st", (SCREENED_CTE, START_CTE))
    return (*ctes, FLAG_JOIN)


@query(
    "section_ts_table",
    sql(
        """SELECT glider_id, t_s, round(temperature, 6) AS temperature, round(salinity, 6) AS salinity, depth, round((t_s - t0)/greatest(CAST(t1 - t0 AS double), 1), 6) AS time_scaled
        FROM gt0 JOIN (SELECT glider_id, min(t_s) AS t0, max(t_s) AS t1 FROM gt0 GROUP BY 1) USING (glider_id)""",
        *simple_flag_ctes(), GOOD_TS,
    ),
)
def ts_table(spark, sf):
    return rounded(se.good_ts(simple_flags(spark, sf)).select("glider_id", "t_s", "temperature", "salinity", "depth", "time_scaled"))


SAMPLE_RATES = (1.0, 0.5, 0.25, 0.1, 0.75)
HASH = "substr(md5(concat_ws('|', {})), 1, 8)"


@query(
    "sample_stratified",
    sql(
        "SELECT glider_id, t_s, band, temperature, salinity FROM (SELECT *, CASE WHEN depth >= 0 AND depth < 50 THEN 0 WHEN depth >= 50 AND depth < 200 THEN 1 WHEN depth >= 200 AND depth < 500 THEN 2 WHEN depth >= 500 AND depth < 1100 THEN 3 ELSE 4 END AS band FROM gt0) WHERE "
        + " OR ".join(f"(band = {i}" + ("" if r >= 1 else f" AND {HASH.format('glider_id, t_s')} < '{int(r * 2**32):08x}'") + ")" for i, r in enumerate(SAMPLE_RATES)),
        *simple_flag_ctes(), GOOD_TS,
    ),
)
def stratified(spark, sf):
    return se.stratified_ts(simple_flags(spark, sf), SAMPLE_RATES).select("glider_id", "t_s", "band", "temperature", "salinity")


@query(
    "sample_uniform_cells",
    sql(
        f"SELECT glider_id, profile_index, CAST(cell AS BIGINT) AS cell FROM grid WHERE variable IN ('temperature', 'salinity') GROUP BY 1, 2, 3 HAVING count(*) = 2 AND {HASH.format('glider_id, profile_index, CAST(cell AS BIGINT)')} < '{int(0.3 * 2**32):08x}'",
        *GRID,
    ),
)
def uniform(spark, sf):
    cells = se.uniform_cells(gridded(spark, sf)[0], 0.3)
    return cells.select("glider_id", "profile_index", F.col("cell").cast("bigint").alias("cell"))


FIX_CTE = "fx AS (SELECT glider_id, t_s, latitude, longitude FROM cl WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"


@query(
    "track_table",
    sql(
        "SELECT glider_id, t_s, latitude, longitude, round((t_s - t0)/greatest(CAST(t1 - t0 AS double), 1), 6) AS time_scaled FROM fx JOIN (SELECT glider_id, min(t_s) AS t0, max(t_s) AS t1 FROM fx GROUP BY 1) USING (glider_id)",
        SCREENED_CTE, FIX_CTE,
    ),
)
def track(spark, sf):
    return rounded(se.track(cl.blank_null_island(l0(spark, sf))))


@query(
    "track_extent",
    sql(
        "SELECT glider_id, "
        + ", ".join(f"round(min({c}) - greatest(2.0, 0.2*(max({c}) - min({c}))), 6) AS low_{c}, round(max({c}) + greatest(2.0, 0.2*(max({c}) - min({c}))), 6) AS high_{c}" for c in ("latitude", "longitude"))
        + " FROM fx GROUP BY 1",
        SCREENED_CTE, FIX_CTE,
    ),
)
def extent(spark, sf):
    return rounded(se.track_extent(cl.blank_null_island(l0(spark, sf))))


@query(
    "qc_retention",
    sql(
        "SELECT glider_id, variable, count(*) AS assessed, "
        + ", ".join(f"round(100.0*sum(CASE WHEN qc IN {k} THEN 1 ELSE 0 END)/count(*), 6) AS {n}" for n, k in (("pct_good", "(1, 2)"), ("pct_removed", "(3, 4)"), ("pct_missing", "(9)"), ("pct_not_shown", "(3, 4, 9)")))
        + " FROM (SELECT glider_id, 'temperature' AS variable, temperature_QC AS qc FROM fl UNION ALL SELECT glider_id, 'salinity', salinity_QC FROM fl) WHERE qc > 0 GROUP BY 1, 2",
        *simple_flag_ctes(),
    ),
)
def retention(spark, sf):
    return rounded(gr.retention(simple_flags(spark, sf), ["temperature", "salinity"]))


@query(
    "written_grid_retention",
    sql(
        "SELECT glider_id, variable, count(*) AS assessed, "
        + ", ".join(f"round(100.0*sum(CASE WHEN qc IN {k} THEN 1 ELSE 0 END)/count(*), 6) AS {n}" for n, k in (("pct_good", "(1, 2)"), ("pct_removed", "(3, 4)"), ("pct_missing", "(9)")))
        + " FROM (SELECT glider_id, 'temperature' AS variable, temperature_QC AS qc FROM fl UNION ALL SELECT glider_id, 'salinity', salinity_QC FROM fl) WHERE qc > 0 GROUP BY 1, 2",
        *simple_flag_ctes(),
    ),
)
def written_retention(spark, sf):
    """Retention read back from the files of a written grid alone."""
    flagged = simple_flags(spark, sf)
    path = table_path(spark)
    write_grid(gr.profile_grid(flagged, ["temperature", "salinity"], apply_qc=True), path, gr.retention(flagged, ["temperature", "salinity"]))
    return rounded(grid_retention(spark.read.parquet(path)))
