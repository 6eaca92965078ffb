import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions import calendar
from panelcast.operators import grid, quality, scaling
from panelcast.sources import panels, stores

PANDAS_FREQ = {"D": "D", "W-MON": "W-MON", "W-SUN": "W-SUN", "M": "ME", "Q": "QE", "Y": "YE"}


@pytest.mark.parametrize("freq", list(PANDAS_FREQ))
def test_grid_and_future_dates_match_pandas(spark, freq):
    wanted = pd.date_range("1999-01-01", periods=70, freq=PANDAS_FREQ[freq])
    first, last = wanted[0].date(), wanted[-1].date()
    panel = spark.createDataFrame([("a", first, 1.0), ("a", last, 2.0)], "series_id string, ds date, y double")
    got = [r.ds for r in grid.calendar_spine(panel, freq).orderBy("ds").collect()]
    assert got == [d.date() for d in wanted]
    ahead = pd.date_range(wanted[-1], periods=6, freq=PANDAS_FREQ[freq])[1:]
    future = grid.future_calendar(panel, 5, freq).orderBy("step").collect()
    assert [r.ds for r in future] == [d.date() for d in ahead]
    assert [r.step for r in future] == [1, 2, 3, 4, 5]


def test_off_grid_bounds_follow_the_first_and_last_date(spark):
    """Grid from the first grid date at or after the start to the last at or before the end."""
    rows = [("a", dt.date(2024, 1, 3), 1.0), ("a", dt.date(2024, 1, 15), 2.0), ("a", dt.date(2024, 1, 31), 3.0)]
    panel = spark.createDataFrame(rows, "series_id string, ds date, y double")
    got = {r.ds: r.y for r in grid.calendar_spine(panel).collect()}
    wanted = pd.date_range("2024-01-03", "2024-01-31", freq="W-MON")
    assert sorted(got) == [d.date() for d in wanted]
    assert got[dt.date(2024, 1, 15)] == 2.0 and sum(v is not None for v in got.values()) == 1
    filled = {r.ds: r.y for r in grid.forward_fill(grid.calendar_spine(panel)).collect()}
    assert filled[dt.date(2024, 1, 8)] is None and filled[dt.date(2024, 1, 29)] == 2.0


def test_gaps_duplicates_and_gate(spark, make_panel):
    dates = pd.date_range("2018-01-01", periods=200, freq="W-MON")
    rng = np.random.default_rng(1)
    missing = set(rng.choice(np.arange(1, 199), 20, replace=False))
    rows = [("gaps", d.date(), float(i)) for i, d in enumerate(dates) if i not in missing]
    rows += [("gaps", dt.date(2018, 3, 7), 5.0), ("gaps", dt.date(2018, 4, 11), 6.0), rows[3]]
    panel = spark.createDataFrame(rows, "series_id string, ds date, y double").unionByName(
        make_panel({"short": range(155), "enough": range(156)}))
    verdict = {r.series_id: r for r in quality.dq_verdict(panel).collect()}
    assert verdict["gaps"].n_off_grid == 2 and verdict["gaps"].n_duplicates == 1
    assert not verdict["short"].ok and verdict["enough"].ok
    kept = quality.dq_gate(panel, quality.dq_verdict(panel)).select("series_id").distinct().collect()
    assert {r[0] for r in kept} == {"gaps", "enough"}
    with pytest.raises(Exception, match="short"):
        quality.dq_gate(panel, quality.dq_verdict(panel), strict=True).collect()
    merged = grid.collapse_duplicates(panel.where("series_id = 'gaps'"))
    assert merged.agg(F.max("n_rows")).first()[0] == 2
    assert grid.regularize(merged.drop("n_rows")).count() == 200


def test_scaling_inverse_constant_and_train_only(make_panel):
    panel = make_panel({"flat": [7.0] * 60, "walk": np.random.default_rng(2).normal(size=80).cumsum()})
    stats = {r.series_id: r for r in scaling.robust_scale_fit(panel).collect()}
    assert stats["flat"].scale == 1.0 and stats["flat"].center == 7.0
    scaled = scaling.robust_scale(panel)
    back = scaling.robust_scale_inverse(scaled, "z")
    assert back.where("abs(z - y) > 1e-9").count() == 0
    joined = scaling.robust_scale_transform(scaling.apply_scale_stats(panel, scaling.robust_scale_fit(panel)))
    assert joined.join(scaled.withColumnRenamed("z", "w"), ["series_id", "ds"]).where("abs(z - w) > 1e-12").count() == 0
    split = grid.holdout_split(panel, 20)
    train = np.array([r.y for r in split.where("split = 'train' AND series_id = 'walk'").collect()])
    only = {r.series_id: r for r in scaling.robust_scale_fit(split, "train").collect()}
    assert only["walk"].center == pytest.approx(np.median(train))
    assert split.where("split = 'test'").groupBy("series_id").count().where("count <> 20").count() == 0


def test_missing_mask(spark):
    rows = [("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 8), None),
            ("a", dt.date(2024, 1, 15), float("inf")), ("b", dt.date(2024, 1, 1), -9999.0)]
    panel = spark.createDataFrame(rows, "series_id string, ds date, y double")
    got = {(r.series_id, r.ds): r for r in grid.missing_mask(panel).collect()}
    assert got["a", dt.date(2024, 1, 8)].y == -9999.0 and got["a", dt.date(2024, 1, 15)].is_missing
    assert not got["b", dt.date(2024, 1, 1)].is_missing
    clash = panel.unionByName(spark.createDataFrame([("b", dt.date(2024, 1, 8), None)], panel.schema))
    with pytest.raises(Exception, match="sentinel"):
        grid.missing_mask(clash).collect()


def test_csv_folder_and_config(spark, tmp_path):
    for name, text in {"one series.csv": "date,Numbers\n2024-01-01,1.5\n2024-01-08,2.5\n",
                       "two.csv": "date,v\n2024-01-01,3\n", "bad.csv": "when,a,b\n2024-01-01,1,2\n",
                       "notes.txt": "hello\n"}.items():
        (tmp_path / name).write_text(text)
    rows = {(r.series_id, str(r.ds)): r.y for r in panels.read_series_csv(spark, str(tmp_path)).collect()}
    assert rows["one series", "2024-01-01"] == 1.5 and rows["two", "2024-01-01"] == 3.0
    layout = {r.series_id: r for r in panels.read_series_csv_layout(spark, str(tmp_path)).collect()}
    assert layout["one series"].first_column == "date" and layout["one series"].n_value_columns == 1
    assert layout["bad"].first_column == "when" and layout["bad"].n_value_columns == 2
    assert not layout["notes.txt"].is_csv
    verdict = quality.dq_verdict(panels.read_series_csv(spark, str(tmp_path)), min_rows=1,
                                 layout=panels.read_series_csv_layout(spark, str(tmp_path)))
    assert {r.series_id: r.ok for r in verdict.collect()} == {
        "one series": True, "two": True, "bad": False, "notes.txt": False}
    config = tmp_path / "config.json"
    config.write_text('{"two": {"freq": "D", "freq_type": "day"}, "x": {"format": "%d/%m/%Y", "freq": "M", "freq_type": "month"}}')
    got = {r.series_id: (r.format, r.freq) for r in stores.read_series_config(spark, str(config)).collect()}
    assert got == {"two": ("%Y-%m-%d", "D"), "x": ("%d/%m/%Y", "M")}
    assert stores.read_series_config(spark, str(tmp_path / "none.json")).count() == 0


def test_two_digit_years_and_bad_dates(spark):
    rows = [("03/07/95", "%m/%d/%y"), ("03/07/24", "%m/%d/%y"), ("31.12.2020", "%d.%m.%Y"), ("nonsense", "%Y-%m-%d")]
    df = spark.createDataFrame(rows, "date string, format string")
    got = [str(r.ds) for r in panels.parse_dates(df).collect()]
    assert got == ["1995-03-07", "2024-03-07", "2020-12-31", "None"]


def test_search_log_keeps_nulls_on_request(spark, tmp_path):
    rows = [("2024-01-01_00-00-00", "ets", {"trend": "add"}, 1.0, (10, "a_ets")),
            ("2024-01-02_00-00-00", "ETS", {"trend": None, "p": "1"}, 2.0, (10, "a_ets"))]
    log = spark.createDataFrame(rows, "date string, model string, best_params map<string,string>, best_score double, "
                                      "dataset_info struct<n_samples:bigint,dataset_name_and_type:string>")
    path = str(tmp_path / "log")
    stores.append_search_log(log, path)
    stores.append_search_log(log.limit(1), path)
    back = stores.read_search_log(spark, path)
    assert back.count() == 3
    assert stores.latest_best_params(back).first().best_params == {"p": "1"}
    assert stores.latest_best_params(back, keep_null=True).first().best_params == {"p": "1", "trend": None}


def test_step_is_inferred(make_panel):
    panel = make_panel({"weekly": range(30)}).unionByName(make_panel({"daily": range(30)}, freq="D"))
    assert {r.series_id: r.step_days for r in grid.infer_step_days(panel).collect()} == {"weekly": 7, "daily": 1}


def test_lag_map_covers_weekly_spellings(spark):
    df = spark.createDataFrame([("W-Mon",), ("w-sun",), ("D",), ("B",)], "freq string")
    got = {r.freq: list(r.l) for r in df.select("freq", calendar.lag_periods(F.col("freq")).alias("l")).collect()}
    assert got["W-Mon"] == got["w-sun"] == [1, 2, 3, 4, 52] and got["B"] == [1, 2, 3, 4, 5]
    assert got["D"] == calendar.lags_of("D")


def test_a_series_with_most_of_the_facts(spark):
    """Sums are combined before the exchange, so a hot key leaves few rows."""
    facts = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("k"),
        F.timestamp_add("DAY", (F.col("id") % 400).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ts"),
        F.lit(1.0).alias("v"))
    panel = panels.panel_from_facts(facts, F.col("k"), F.col("ts"), F.col("v"))
    assert panel.agg(F.sum("y")).first()[0] == 20000
    assert panel.where("series_id = 'hot'").count() <= 59
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")


def test_unreadable_dates_and_values_are_not_lost(spark, tmp_path):
    (tmp_path / "good.csv").write_text("date,v\n2024-01-01,1\n2024-01-08,n/a\n")
    (tmp_path / "own.csv").write_text("date,v\n01/02/24,3\n")
    config = spark.createDataFrame([("own", "%m/%d/%y")], "series_id string, format string")
    rows = panels.read_series_csv(spark, str(tmp_path), config=config).collect()
    assert sorted((r.series_id, str(r.ds), r.y) for r in rows if r.y is not None) == [("good", "2024-01-01", 1.0), ("own", "2024-01-02", 3.0)]
    with pytest.raises(Exception, match="does not follow"):
        panels.read_series_csv(spark, str(tmp_path)).collect()
    verdict = {r.series_id: r for r in quality.dq_verdict(panels.read_series_csv(spark, str(tmp_path), strict=False), min_rows=1).collect()}
    assert verdict["good"].ok and not verdict["own"].ok and not verdict["own"].all_dated
    (tmp_path / "bad.csv").write_text("date,v\n2024-01-01,oops\n")
    with pytest.raises(Exception, match="no number"):
        panels.read_series_csv(spark, str(tmp_path), config=config).collect()


def test_a_panel_is_not_merged_into_few_tasks(make_panel):
    """Shuffled rows are small, and merged by bytes they would all be the work of one task."""
    panel = make_panel({str(k): np.arange(20.0) for k in range(40)})
    tasks = grid.regularize(panel).select("series_id").distinct().select(F.spark_partition_id()).distinct().count()
    assert tasks > 4
