"""Named queries: sources, calendar, scaling, features, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import calendar, metrics
from panelcast.operators import evaluate, features, grid, quality, scaling
from panelcast.plans.catalog import query
from panelcast.plans.oracle import ALIGNED, METRIC_SQL, SCORES, SMOOTHED, base, r, with_
from panelcast.plans.prepare import prepared_panel, regular_panel, smoothed_predictions
from panelcast.session import materialize, scratch_path
from panelcast.sources import panels, stores


def rounded(df, digits: int = 6, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _scores(spark, d, source="supplier", names=None):
    return evaluate.evaluate_models(None, smoothed_predictions(prepared_panel(spark, d, source)), names)


def _twice(df, label):
    """A table that its query reads twice: written, so that the facts are read once.

    It has at most one row per series and period (and model).
    """
    return materialize(df, label)


# --- 2.1 sources, sinks, stores ---------------------------------------------

@query("panel_from_facts", "WITH " + base("nation") + " SELECT series_id, ds, y FROM obs")
def _(spark, d):
    return panels.orders_by_nation(spark, d)


@query("panel_from_facts_hourly", "WITH " + base("hourly") + " SELECT series_id, ds, y FROM obs")
def _(spark, d):
    return panels.events_by_type(spark, d, "H")


@query("read_series_csv", with_("nation") + "SELECT series_id, ds, y FROM panel")
def _(spark, d):
    folder = scratch_path(spark, "series-csv")
    stores.write_per_series(regular_panel(spark, d, "nation"), folder)
    return panels.read_series_csv(spark, folder, named_by="folder")


CONFIG_SQL = """cfg AS (SELECT DISTINCT series_id, '%Y-%m-%d' AS format, 'W-MON' AS freq, 'week' AS freq_type FROM obs)"""


def _config_documents(spark, d):
    """One JSON document per series; the format is left to its default."""
    series = panels.orders_by_nation(spark, d).select("series_id").distinct()
    entry = F.struct(F.lit("W-MON").alias("freq"), F.lit("week").alias("freq_type"))
    return series.select(F.to_json(F.map_from_arrays(F.array("series_id"), F.array(entry))).alias("value"))


@query("read_series_config", "WITH " + base("nation") + "," + CONFIG_SQL + " SELECT * FROM cfg")
def _(spark, d):
    return stores.parse_series_config(_config_documents(spark, d))


@query("upsert_series_config", "WITH " + base("nation") + "," + CONFIG_SQL + """
SELECT series_id, format, CASE WHEN series_id < 'K' THEN 'D' ELSE freq END AS freq,
  CASE WHEN series_id < 'K' THEN 'day' ELSE freq_type END AS freq_type FROM cfg
UNION ALL SELECT 'total ' || series_id, format, freq, freq_type FROM cfg""")
def _(spark, d):
    current = stores.parse_series_config(_config_documents(spark, d))
    changed = current.where("series_id < 'K'").withColumns({"freq": F.lit("D"), "freq_type": F.lit("day")})
    added = current.withColumn("series_id", F.concat(F.lit("total "), "series_id"))
    return stores.upsert_series_config(current, changed.unionByName(added))


@query("dq_gate", with_("supplier", """verdict AS (SELECT series_id FROM obs GROUP BY 1
  HAVING count(*) >= 156 AND count(y) > 0)""") +
       "SELECT o.series_id, o.ds, o.y FROM obs o SEMI JOIN verdict v ON o.series_id = v.series_id")
def _(spark, d):
    panel = panels.shipments_by_supplier(spark, d)
    return quality.dq_gate(panel, quality.dq_verdict(panel))


@query("dq_verdict", with_("supplier") + """SELECT series_id, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_duplicates,
  CAST(0 AS BIGINT) AS n_off_grid, count(*) >= 156 AS enough_rows, count(y) > 0 AS has_values,
  count(ds) = count(*) AS all_dated, count(*) >= 156 AND count(y) > 0 AND count(ds) = count(*) AS ok FROM obs GROUP BY 1""")
def _(spark, d):
    return quality.dq_verdict(panels.shipments_by_supplier(spark, d))


def _wide_sql(kind):
    return with_("supplier", SMOOTHED, recursive=True) + f"""SELECT p.series_id, p.ds, round(p.y, 2) AS y_true,
  {r("max(CASE WHEN model = 'hw_simple' THEN yhat END)", 4)} AS hw_simple,
  {r("max(CASE WHEN model = 'hw_trend' THEN yhat END)", 4)} AS hw_trend
FROM split p LEFT JOIN preds q ON q.series_id = p.series_id AND q.ds = p.ds AND q.kind = '{kind}'
WHERE p.split = '{'train' if kind == 'fitted' else 'test'}' GROUP BY 1, 2, 3"""


def _wide(spark, d, kind):
    prepared = _twice(prepared_panel(spark, d), "prepared")
    actuals = prepared.where(F.col("split") == ("train" if kind == "fitted" else "test"))
    export = stores.export_fits_wide if kind == "fitted" else stores.export_forecasts_wide
    wide = export(actuals, smoothed_predictions(prepared), ["hw_simple", "hw_trend"])
    return rounded(rounded(wide, 2, "y_true"), 4, "hw_simple", "hw_trend")


query("export_fits_wide", _wide_sql("fitted"))(lambda spark, d: _wide(spark, d, "fitted"))
query("export_forecasts_wide", _wide_sql("forecast"))(lambda spark, d: _wide(spark, d, "forecast"))

SCORES_SQL = with_("supplier", SMOOTHED, ALIGNED, SCORES, recursive=True)


@query("export_metrics", SCORES_SQL + "SELECT * FROM scores")
def _(spark, d):
    scores = _twice(rounded(_scores(spark, d), 4, "error_std"), "scores")
    return stores.export_metrics(scores.where("phase = 'training'").drop("phase"),
                                 scores.where("phase = 'testing'").drop("phase"))


@query("union_results", SCORES_SQL + "SELECT * FROM scores")
def _(spark, d):
    scores = _twice(rounded(_scores(spark, d), 4, "error_std"), "scores")
    return stores.union_results(scores.where("model = 'hw_simple'"), scores.where("model = 'hw_trend'"))


STAMPS = ["2024-01-01_10-00-00", "2024-01-02_10-00-00", "2024-01-03_10-00-00"]


def _search_log(spark, d):
    """Three log rows per series: scores of two fixed smoothers at three stamps."""
    scores = _scores(spark, d, "nation").where("phase = 'testing'")
    rows = scores.select("series_id", "model", "error_std",
                         F.explode(F.array(*[F.lit(s) for s in STAMPS])).alias("date"))
    run = F.substring("date", 10, 1)
    params = F.create_map(F.lit("trend"), F.when(F.col("model") == "hw_trend", "add"), F.lit("run"), run)
    return rows.select("date", "model", params.alias("best_params"),
                       (F.col("error_std") + run.cast("int")).alias("best_score"),
                       F.struct(F.lit(0).cast("bigint").alias("n_samples"),
                                F.concat_ws("_", "series_id", "model").alias("dataset_name_and_type"))
                       .alias("dataset_info"))


NATION_SCORES_SQL = with_("nation", SMOOTHED, ALIGNED, SCORES, recursive=True)


@query("append_search_log", NATION_SCORES_SQL + """
SELECT series_id || '_' || model AS dataset, model, stamp AS date, round(error_std + k, 4) AS best_score
FROM scores, (VALUES ('2024-01-01_10-00-00', 1), ('2024-01-02_10-00-00', 2), ('2024-01-03_10-00-00', 3)) v(stamp, k)
WHERE phase = 'testing'""")
def _(spark, d):
    path = scratch_path(spark, "search-log")
    log = _search_log(spark, d)
    stores.append_search_log(log.where("model = 'hw_simple'"), path)
    stores.append_search_log(log.where("model = 'hw_trend'"), path)
    return stores.read_search_log(spark, path).select(
        F.col("dataset_info.dataset_name_and_type").alias("dataset"), "model", "date",
        F.round("best_score", 4).alias("best_score"))


@query("latest_best_params", NATION_SCORES_SQL + """
SELECT series_id || '_' || model AS dataset, model, '2024-01-03_10-00-00' AS date, round(error_std + 3, 4) AS best_score,
  CASE WHEN model = 'hw_trend' THEN 'run=3;trend=add' ELSE 'run=3' END AS best_params
FROM scores WHERE phase = 'testing'""")
def _(spark, d):
    best = stores.latest_best_params(_search_log(spark, d))
    entries = F.transform(F.map_entries("best_params"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return best.select("dataset", "model", "date", F.round("best_score", 4).alias("best_score"),
                       F.array_join(F.array_sort(entries), ";").alias("best_params"))


BACK_SQL = """back AS (SELECT a.series_id, a.ds, a.y, a.yhat FROM aligned a WHERE a.model = 'hw_trend' AND a.kind = 'forecast'),
fut AS (SELECT e.series_id, CAST(b.hi + INTERVAL (7 * k) DAY AS DATE) AS ds, (e.l + (k + 52) * e.g) * s.scale + s.center AS yhat,
  CASE WHEN k <= 13 THEN 'high' WHEN k <= 30 THEN 'medium' ELSE 'low' END AS confidence
  FROM ends e JOIN bounds b USING (series_id) JOIN stats s USING (series_id),
  (SELECT unnest(generate_series(1, 52)) AS k) WHERE e.model = 'hw_trend')"""
BACK_FUTURE_SQL = with_("supplier", SMOOTHED, ALIGNED, BACK_SQL, recursive=True)


def _back_and_future(spark, d):
    """Hold-out rows of the trend smoother and the 52 steps after them."""
    both = smoothed_predictions(prepared_panel(spark, d), 104).where("model = 'hw_trend' AND kind = 'forecast'")
    rows = _twice(both, "back-and-future")
    back = evaluate.known(rows.where("ds <= last"))
    step = F.datediff("ds", "last") / 7
    label = F.when(step <= 13, "high").when(step <= 30, "medium").otherwise("low")
    future = rows.where("ds > last").drop("y").withColumn("confidence", label)
    return back, future


@query("union_backtest_future", BACK_FUTURE_SQL + f"""
SELECT series_id, ds, round(y, 2) AS y, {r("yhat", 4)} AS yhat, CAST(NULL AS VARCHAR) AS confidence FROM back
UNION ALL SELECT series_id, ds, NULL, {r("yhat", 4)}, confidence FROM fut""")
def _(spark, d):
    back, future = _back_and_future(spark, d)
    both = stores.union_backtest_future(back.select("series_id", "ds", "y", "yhat"),
                                        future.select("series_id", "ds", "yhat", "confidence"))
    return rounded(rounded(both, 4, "yhat"), 2, "y")


# --- 2.2 projections, filters, scalar functions -------------------------------

@query("normalize_names", """SELECT replace(lower(c_mktsegment), ' ', '_') AS project, count(*) AS marketsegment_n
FROM customer GROUP BY 1""")
def _(spark, d):
    t = panels.read_table(spark, d, "customer").withColumnRenamed("c_mktsegment", "Market Segment")
    clean = panels.normalize_names(t)
    return (clean.groupBy(panels.project_name(F.col("marketsegment")).alias("project"))
            .agg(F.count("*").alias("marketsegment_n")))


@query("parse_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds FROM orders")
def _(spark, d):
    """Order dates written in four formats, each row naming its own."""
    formats = ["%Y-%m-%d", "%m/%d/%y", "%d.%m.%Y", "%Y/%m/%d"]
    kind = F.element_at(F.array(*[F.lit(f) for f in formats]), (F.pmod("o_orderkey", F.lit(4)) + 1).cast("int"))
    day, text = F.col("o_orderdate").cast("date"), F.lit(None).cast("string")
    for f in formats:
        text = F.when(F.col("format") == f, F.date_format(day, calendar.spark_pattern(f))).otherwise(text)
    rows = panels.read_table(spark, d, "orders").withColumn("format", kind).withColumn("date", text)
    return panels.parse_dates(rows, formats=formats).select("o_orderkey", "ds")


@query("drop_missing", with_("supplier") + "SELECT series_id, ds, y FROM spine WHERE y IS NOT NULL")
def _(spark, d):
    return grid.drop_missing(grid.calendar_spine(panels.shipments_by_supplier(spark, d)))


@query("filter_date_range", with_("supplier") + """SELECT series_id, ds, y FROM panel
WHERE ds BETWEEN DATE '1997-01-06' AND DATE '1998-12-28'""")
def _(spark, d):
    return grid.filter_date_range(regular_panel(spark, d), "1997-01-06", "1998-12-28")


@query("calendar_features", """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend FROM orders""")
def _(spark, d):
    t = panels.read_table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ds"))
    return features.calendar_features(t).drop("ds")


FREQ_SQL = """freqs AS (SELECT n_name AS series_id, CASE n_nationkey % 6 WHEN 0 THEN 'D' WHEN 1 THEN 'W-MON' WHEN 2 THEN 'w-sun'
  WHEN 3 THEN 'M' WHEN 4 THEN 'Q' ELSE 'Y' END AS freq, CASE n_nationkey % 6 WHEN 0 THEN 'day' WHEN 1 THEN 'week'
  WHEN 2 THEN 'week' WHEN 3 THEN 'month' WHEN 4 THEN 'quarter' ELSE 'year' END AS freq_type FROM nation)"""


def _freqs(spark, d):
    kinds = [("D", "day"), ("W-MON", "week"), ("w-sun", "week"), ("M", "month"), ("Q", "quarter"), ("Y", "year")]
    i = (F.pmod("n_nationkey", F.lit(6)) + 1).cast("int")
    return panels.read_table(spark, d, "nation").select(
        F.col("n_name").alias("series_id"),
        F.element_at(F.array(*[F.lit(k) for k, _ in kinds]), i).alias("freq"),
        F.element_at(F.array(*[F.lit(t) for _, t in kinds]), i).alias("freq_type"))


@query("season_periods_map", "WITH " + FREQ_SQL + """ SELECT series_id, CAST(unnest(CASE freq_type WHEN 'day' THEN [7, 30, 120, 365]
 WHEN 'week' THEN [4, 12, 52] WHEN 'month' THEN [3, 12] WHEN 'quarter' THEN [4] ELSE [1] END) AS INTEGER) AS season FROM freqs""")
def _(spark, d):
    return _freqs(spark, d).select("series_id", F.explode(calendar.season_periods(F.col("freq_type"))).alias("season"))


@query("lag_periods_map", "WITH " + FREQ_SQL + """ SELECT series_id, CAST(unnest(CASE upper(freq) WHEN 'D' THEN [1, 2, 3, 4, 5, 6, 7, 30, 365]
 WHEN 'W-MON' THEN [1, 2, 3, 4, 52] WHEN 'W-SUN' THEN [1, 2, 3, 4, 52] WHEN 'M' THEN [1, 2, 3, 12]
 WHEN 'Q' THEN [1, 2, 4] ELSE [1, 2, 3] END) AS INTEGER) AS lag FROM freqs""")
def _(spark, d):
    return _freqs(spark, d).select("series_id", F.explode(calendar.lag_periods(F.col("freq"))).alias("lag"))


@query("bayes_season_length", "WITH " + FREQ_SQL + """ SELECT series_id, CAST(CASE WHEN freq = 'D' THEN 365 WHEN freq = 'M' THEN 12
 ELSE 52 END AS INTEGER) AS season FROM freqs""")
def _(spark, d):
    return _freqs(spark, d).select("series_id", calendar.bayes_season_length(F.col("freq")).alias("season"))


@query("time_index", with_("supplier") + """SELECT series_id, ds, CAST(t AS INTEGER) AS t,
CAST(t % 52 AS INTEGER) AS season_index FROM scaled""")
def _(spark, d):
    return grid.time_index(regular_panel(spark, d), 52).drop("y")


@query("confidence_label", """SELECT l_orderkey, l_linenumber, CASE WHEN 2 * 1.96 * sqrt(l_quantity) / l_quantity < 0.2 THEN 'high'
WHEN 2 * 1.96 * sqrt(l_quantity) / l_quantity < 0.4 THEN 'medium' ELSE 'low' END AS confidence FROM lineitem""")
def _(spark, d):
    half, y = 1.96 * F.sqrt("l_quantity"), F.col("l_quantity")
    return panels.read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", evaluate.confidence_label(y, y - half, y + half).alias("confidence"))


@query("missing_mask", with_("supplier") +
       "SELECT series_id, ds, coalesce(y, -9999.0) AS y, y IS NULL AS is_missing FROM spine")
def _(spark, d):
    return grid.missing_mask(grid.calendar_spine(panels.shipments_by_supplier(spark, d)))


# --- 2.3 joins -----------------------------------------------------------------

@query("calendar_spine", with_("supplier") + "SELECT series_id, ds, y FROM spine")
def _(spark, d):
    return grid.calendar_spine(panels.shipments_by_supplier(spark, d))


@query("align_actual_forecast", with_("supplier", SMOOTHED, ALIGNED, recursive=True) + f"""SELECT series_id, model, ds, kind,
round(y, 2) AS y, {r("yhat", 4)} AS yhat FROM aligned WHERE kind = 'forecast'""")
def _(spark, d):
    prepared = _twice(prepared_panel(spark, d), "prepared")
    predicted = smoothed_predictions(prepared).where("kind = 'forecast'").drop("center", "scale", "last")
    return rounded(rounded(evaluate.align_actual_forecast(prepared, predicted), 4, "yhat"), 2, "y")


@query("apply_scale_stats", with_("supplier") + """SELECT p.series_id, ds, y, round(center, 6) AS center,
round(scale, 6) AS scale FROM panel p JOIN stats s ON s.series_id = p.series_id""")
def _(spark, d):
    panel = _twice(regular_panel(spark, d), "panel")
    return rounded(scaling.apply_scale_stats(panel, scaling.robust_scale_fit(panel)), 6, "center", "scale")


# --- 2.4 aggregations ------------------------------------------------------------

@query("robust_scale_fit", with_("supplier") +
       "SELECT series_id, round(center, 6) AS center, round(scale, 6) AS scale FROM stats")
def _(spark, d):
    return rounded(scaling.robust_scale_fit(regular_panel(spark, d)), 6, "center", "scale")


@query("robust_scale_transform", with_("supplier") + f"SELECT series_id, ds, {r('z')} AS z FROM scaled")
def _(spark, d):
    return scaling.robust_scale(regular_panel(spark, d)).select("series_id", "ds", F.round("z", 6).alias("z"))


@query("robust_scale_inverse", with_("supplier") + f"SELECT series_id, ds, {r('z * scale + center', 4)} AS z FROM scaled")
def _(spark, d):
    scaled = scaling.robust_scale(regular_panel(spark, d))
    return scaling.robust_scale_inverse(scaled, "z").select("series_id", "ds", F.round("z", 4).alias("z"))


@query("series_profile", with_("supplier") + """SELECT series_id, count(*) AS n, min(ds) AS first_ds, max(ds) AS last_ds,
round(quantile_cont(y, 0.5), 4) AS median_y, round(sum(y), 2) AS sum_y FROM panel GROUP BY 1""")
def _(spark, d):
    return rounded(rounded(grid.series_profile(regular_panel(spark, d)), 4, "median_y"), 2, "sum_y")


@query("argmin_model", SCORES_SQL + """SELECT * FROM scores WHERE phase = 'testing' AND weighted_mape IS NOT NULL
ORDER BY weighted_mape, model, series_id LIMIT 1""")
def _(spark, d):
    return evaluate.argmin_model(rounded(_scores(spark, d), 4, "error_std").where("phase = 'testing'"))


# --- 2.5 windows -----------------------------------------------------------------

@query("forward_fill", with_("supplier") + "SELECT series_id, ds, y FROM panel")
def _(spark, d):
    return grid.forward_fill(grid.calendar_spine(panels.shipments_by_supplier(spark, d)))


LAGS = (1, 2, 3, 4, 52)
LAG_SQL = """lagged AS (SELECT series_id, ds, z, t, split, lag(z, 1) OVER w AS lag_1, lag(z, 2) OVER w AS lag_2,
 lag(z, 3) OVER w AS lag_3, lag(z, 4) OVER w AS lag_4, lag(z, 52) OVER w AS lag_52, CAST(month(ds) AS INTEGER) AS month,
 CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, CAST(day(ds) AS INTEGER) AS day_of_month,
 CAST(isodow(ds) >= 6 AS INTEGER) AS is_weekend FROM split WINDOW w AS (PARTITION BY series_id ORDER BY ds))"""
FEATURE_LIST = ", ".join(r(f"lag_{k}") + f" AS lag_{k}" for k in LAGS) + ", month, day_of_week, day_of_month, is_weekend"


@query("lag_features", with_("supplier", LAG_SQL) +
       f"SELECT series_id, ds, {FEATURE_LIST} FROM lagged WHERE lag_52 IS NOT NULL")
def _(spark, d):
    out = features.lag_features(scaling.robust_scale(regular_panel(spark, d)))
    names = [f"lag_{k}" for k in LAGS]
    return rounded(out, 6, *names).select("series_id", "ds", *names, *features.CALENDAR_NAMES)


@query("holdout_split", with_("supplier") + "SELECT series_id, ds, y, split FROM split")
def _(spark, d):
    return grid.holdout_split(regular_panel(spark, d))


RUNNING_SQL = r("""avg(CASE WHEN y = 0 AND yhat <> 0 THEN 100.0 WHEN y = 0 THEN NULL
 ELSE least(100.0, abs((y - yhat) / y) * 100) END)
 OVER (PARTITION BY series_id, model ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", 4)


@query("running_abs_pct_error", with_("supplier", SMOOTHED, ALIGNED, recursive=True) +
       f"SELECT series_id, model, ds, {RUNNING_SQL} AS running_error FROM aligned WHERE kind = 'forecast'")
def _(spark, d):
    forecasts = smoothed_predictions(prepared_panel(spark, d)).where("kind = 'forecast'")
    rows = evaluate.running_abs_pct_error(evaluate.known(forecasts))
    return rows.select("series_id", "model", "ds", F.round("running_error", 4).alias("running_error"))


@query("future_calendar", with_("supplier") + """SELECT series_id, CAST(k AS INTEGER) AS step,
CAST(hi + INTERVAL (7 * k) DAY AS DATE) AS ds FROM bounds, (SELECT unnest(generate_series(1, 52)) AS k)""")
def _(spark, d):
    return grid.future_calendar(regular_panel(spark, d))


STEP_LAGS = ", ".join(r(f"coalesce(max(CASE WHEN t = n - {k} THEN z END), 0.0)") + f" AS lag_{k}" for k in LAGS)


@query("forecast_step_features", with_("supplier") + f"""SELECT series_id, CAST(max(ds) + INTERVAL 7 DAY AS DATE) AS ds, {STEP_LAGS},
CAST(month(max(ds) + INTERVAL 7 DAY) AS INTEGER) AS month, CAST(0 AS INTEGER) AS day_of_week,
CAST(day(max(ds) + INTERVAL 7 DAY) AS INTEGER) AS day_of_month, CAST(0 AS INTEGER) AS is_weekend FROM scaled GROUP BY 1""")
def _(spark, d):
    arrays = grid.as_arrays(scaling.robust_scale(regular_panel(spark, d)), "z")
    return rounded(features.forecast_step_features(arrays), 6, *[f"lag_{k}" for k in LAGS])


@query("tail_steps", with_("supplier", SMOOTHED, recursive=True) + f"""SELECT series_id, model, ds, {r("yhat", 4)} AS yhat FROM
(SELECT *, row_number() OVER (PARTITION BY series_id, model ORDER BY ds DESC) AS k FROM preds) WHERE k <= 13""")
def _(spark, d):
    out = grid.tail_steps(smoothed_predictions(prepared_panel(spark, d)), 13)
    return out.select("series_id", "model", "ds", F.round("yhat", 4).alias("yhat"))


@query("sort_series", with_("supplier") + """SELECT series_id, ds, y,
CAST(row_number() OVER (PARTITION BY series_id ORDER BY ds) AS INTEGER) AS position FROM obs""")
def _(spark, d):
    rows = grid.as_arrays(panels.shipments_by_supplier(spark, d))
    return (rows.select("series_id", F.posexplode(F.arrays_zip("ds", "y")).alias("p", "v"))
            .select("series_id", "v.ds", "v.y", (F.col("p") + 1).alias("position")))


# --- 2.6 ranking, 2.8 evaluation ---------------------------------------------------

@query("rank_models", SCORES_SQL + """SELECT series_id, phase, model, weighted_mape,
CAST(rank() OVER (PARTITION BY series_id, phase ORDER BY weighted_mape NULLS LAST, model) AS INTEGER) AS rank FROM scores""")
def _(spark, d):
    return evaluate.rank_models(_scores(spark, d)).select("series_id", "phase", "model", "weighted_mape", "rank")


def _register_metric_query(name, column):
    sql = (with_("supplier", SMOOTHED, ALIGNED, recursive=True)
           + f"SELECT series_id, model, phase, {METRIC_SQL[column]} AS {column} FROM aligned GROUP BY 1, 2, 3")
    digits = {"error_std": 4, "value_weighted_error": 6}.get(column)

    @query(name, sql)
    def _(spark, d):
        out = _scores(spark, d, names=[column])
        return rounded(out, digits, column) if digits else out


for _name, _column in (("metric_mape", "mape"), ("metric_smape", "smape"),
                       ("metric_cum_error", "cumulative_error_percentage"),
                       ("metric_weighted_mape", "weighted_mape"), ("metric_error_std", "error_std"),
                       ("metric_value_weighted_error", "value_weighted_error")):
    _register_metric_query(_name, _column)


@query("evaluate_models", SCORES_SQL + "SELECT * FROM scores")
def _(spark, d):
    return rounded(_scores(spark, d), 4, "error_std")


BEST_SQL = SCORES_SQL + """SELECT series_id, model AS best_model, {by} FROM (SELECT *, row_number() OVER (PARTITION BY series_id
ORDER BY {by}, model) AS k FROM scores WHERE phase = 'testing' AND {by} IS NOT NULL) WHERE k = 1"""


@query("best_model", BEST_SQL.replace("{by}", "weighted_mape"))
def _(spark, d):
    return evaluate.best_model(_scores(spark, d))


@query("best_model_by_mape", BEST_SQL.replace("{by}", "mape"))
def _(spark, d):
    return evaluate.best_model(_scores(spark, d), by="mape")


@query("training_mape", with_("supplier", SMOOTHED, recursive=True) + f"""SELECT p.series_id, p.model,
printf('%.5e', avg(abs(s.z - (p.yhat - s.center) / s.scale) / greatest(abs(s.z), 2.220446049250313e-16))) AS training_mape
FROM preds p JOIN scaled s ON s.series_id = p.series_id AND s.ds = p.ds
WHERE p.kind = 'fitted' GROUP BY 1, 2""")
def _(spark, d):
    fitted = smoothed_predictions(prepared_panel(spark, d)).where("kind = 'fitted'")
    # A row at the median (z = 0) is divided by the floor, so the mean has any magnitude: six digits are compared.
    scaled = lambda c: (F.col(c) - F.col("center")) / F.col("scale")
    rows = fitted.withColumns({"z": scaled("y"), "zhat": scaled("yhat")})
    return rows.groupBy("series_id", "model").agg(
        F.format_string("%.5e", metrics.training_mape(F.col("z"), F.col("zhat"))).alias("training_mape"))


@query("register_metric", with_("supplier", SMOOTHED, ALIGNED, recursive=True) + """SELECT series_id, model, phase,
round(max(abs(y - yhat)), 4) AS worst_error FROM aligned GROUP BY 1, 2, 3""")
def _(spark, d):
    metrics.register_metric("worst_error", lambda y, yhat: F.round(F.max(F.abs(y - yhat)), 4))
    return _scores(spark, d, names=["worst_error"])
