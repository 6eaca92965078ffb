import datetime as dt
import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions import statespace_scalar as scalar
from panelcast.models import horizon, statespace as ss
from panelcast.operators.grid import as_arrays
from panelcast.streaming import online
from conftest import seasonal


def level(n=300, missing=.1, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.normal(size=n).cumsum() * .3 + rng.normal(size=n)
    y[rng.random(n) < missing] = np.nan
    return y


@pytest.fixture(scope="module")
def gappy(make_panel):
    panel = make_panel({"a": level(), "b": level(200, seed=1), "c": level(200, 0, seed=2)})
    return as_arrays(panel.withColumn("z", F.when(~F.isnan("y"), F.col("y"))), "z")


PARTS = [ss.level_trend(1, .3), ss.noise(1.0)]


def test_jvm_filter_equals_general_filter_with_gaps(gappy):
    kf = scalar.filter_array(F.col("z"), F.lit(.09), F.lit(1.0), F.lit(0.0), F.lit(1.0))
    rows = gappy.withColumn("kf", kf).withColumn("sm", scalar.smoother_array(F.col("kf"), F.lit(.09))).collect()
    states = ss.kf_states(gappy, PARTS, kinds=("filtered", "predicted", "smoothed")).toPandas()
    for r in rows:
        for kind, names in (("filtered", ("a_filt", "p_filt")), ("predicted", ("a_pred", "p_pred"))):
            part = states[(states.series_id == r.series_id) & (states.kind == kind)].sort_values("ds")
            assert np.allclose([s[names[0]] for s in r.kf], [v[0] for v in part.state])
            assert np.allclose([s[names[1]] for s in r.kf], [v[0] for v in part["cov"]])
        part = states[(states.series_id == r.series_id) & (states.kind == "smoothed")].sort_values("ds")
        assert np.allclose([s["a_smooth"] for s in r.sm], [v[0] for v in part.state])
        gaps = [i for i, z in enumerate(r.z) if z is None]
        assert all(r.kf[i]["loglik"] == 0 for i in gaps)
        assert all(r.kf[i]["p_filt"] > r.kf[i - 1]["p_filt"] for i in gaps if i - 1 in gaps)


def test_shared_passes_equal_single_series(gappy):
    """Series with the same gaps share gains; the result is that of each alone."""
    together = ss.kf_states(gappy, PARTS).toPandas().sort_values(["series_id", "kind", "ds"])
    alone = pd.concat([ss.kf_states(gappy.where(F.col("series_id") == s), PARTS).toPandas() for s in "abc"])
    alone = alone.sort_values(["series_id", "kind", "ds"])
    assert np.allclose(np.stack(together.state), np.stack(alone.state))


def test_column_methods_agree(spark):
    rng = np.random.default_rng(3)
    n = 80
    dates = [dt.date(2020, 1, 6) + dt.timedelta(weeks=i) for i in range(n)]
    one, two = level(n, 0), level(n, 0, 1)
    gaps = [None if rng.random() < .2 else float(v) for v in two]
    rows = spark.createDataFrame([("a", dates, [float(v) for v in one], gaps)],
                                 "series_id string, ds array<date>, z1 array<double>, z2 array<double>")
    parts, h = [ss.level_trend(2, (.2, .05))], [.5, .8]
    got = {m: ss.kf_columns(rows, ["z1", "z2"], parts, h, m).toPandas() for m in ("sequential", "standard", "cholesky")}
    for other in ("standard", "cholesky"):
        assert np.allclose(np.stack(got["sequential"].state), np.stack(got[other].state), atol=1e-6)
        assert np.allclose(got["sequential"].loglik, got[other].loglik, atol=1e-6)
    with pytest.raises(Exception, match="one observed column"):
        ss.kf_columns(rows, ["z1", "z2"], parts, h, "single").collect()


def test_steady_gain(gappy):
    q, h = .09, 1.0
    p = (q + np.sqrt(q * q + 4 * q * h)) / 2
    assert ss.steady_gain(PARTS)[0] == pytest.approx(p / (p + h))
    assert ss.steady_gain([ss.level_trend(2, (.2, .1)), ss.noise(1.0)]).shape == (2,)


def test_components_add_up(make_arrays):
    arrays = make_arrays({"a": seasonal(120, 12, noise=.1), "b": seasonal(100, 12, noise=.2, seed=1)})
    parts = [ss.level_trend(2, (.1, .01)), ss.season_dummy(12, .01), ss.autoregressive([.4], .1), ss.noise(.2)]
    out = ss.decompose(arrays, parts).groupBy("series_id", "ds").agg(F.sum("mean").alias("total"))
    truth = arrays.select("series_id", F.explode(F.arrays_zip("ds", "z")).alias("p")).select("series_id", "p.*")
    assert out.join(truth, ["series_id", "ds"]).where("abs(total - z) > 1e-9").count() == 0
    assert out.count() == 220


def test_component_matrices():
    dummy = ss.build(json.dumps([ss.season_dummy(4)]))
    state, total = np.array([1.0, -2.0, .5]), []
    for _ in range(8):
        total.append(state[0])
        state = dummy["T"] @ state
    assert sum(total[:4]) == pytest.approx(0) and total[:4] == pytest.approx(total[4:])
    wave = ss.build(json.dumps([ss.season_fourier(12, 2)]))
    assert np.allclose(np.linalg.matrix_power(wave["T"], 12), np.eye(4))
    turn = ss.build(json.dumps([ss.cycle(10, .9)]))
    assert np.allclose(np.linalg.matrix_power(turn["T"], 10), .9 ** 10 * np.eye(2))
    masked = ss.autoregressive([.5], 1.0, mask=[0, 0, 1])
    assert ss.build(json.dumps([masked]))["T"][0].tolist() == [0, 0, .5]
    with pytest.raises(ValueError, match="repeat"):
        ss.build(json.dumps([ss.level_trend(1), ss.level_trend(2)]))
    ar = ss.build(json.dumps([ss.autoregressive([.6], 2.0)]))
    var = 0.0
    for _ in range(200):
        var = ar["T"][0, 0] ** 2 * var + ar["Q"][0, 0]
    assert var == pytest.approx(4 / (1 - .36))


def test_noise_free_season_and_trend(make_panel):
    panel = make_panel({"a": np.tile([1.0, 4.0, -2.0, 5.0], 12)}).withColumn("z", F.col("y"))
    effects = [r.effect for r in ss.season_means(panel, 4).orderBy("season_index").collect()]
    assert effects == pytest.approx([-1.0, 2.0, -4.0, 3.0])
    line = make_panel({"a": 3 + .5 * np.arange(40)}).withColumn("z", F.col("y"))
    assert ss.trend_regression(line).where("abs(mean - z) > 1e-9").count() == 0


def test_regression_columns_equal_least_squares(make_panel):
    rng = np.random.default_rng(8)
    y = rng.normal(size=90)
    panel = make_panel({"a": y}).withColumn("z", F.col("y"))
    columns = ss.fourier_columns(F.row_number().over(ss.by_date()) - 1, 12, 2)
    rows = panel.withColumns(columns)
    got = ss.regress(rows, list(columns)).first().coef
    t = np.arange(90)
    x = np.column_stack([np.ones(90)] + [f(2 * np.pi * j * t / 12) for j in (1, 2) for f in (np.cos, np.sin)])
    assert got == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0])


def test_fixed_and_drifting_regressors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(150, 2))
    y = x @ [1.5, -2.0] + .1 * rng.normal(size=150)
    dates = [dt.date(2020, 1, 6) + dt.timedelta(weeks=i) for i in range(150)]
    rows = spark.createDataFrame([("a", dates, y.tolist(), x.tolist())],
                                 "series_id string, ds array<date>, z array<double>, x array<array<double>>")
    last = ss.kf_filter(rows, [ss.regression(2, 0.0), ss.noise(.1)], exog="x").orderBy(F.desc("ds")).first()
    assert last.state == pytest.approx([1.5, -2.0], abs=.05)


def test_forecast_variance_and_start(gappy):
    out = ss.ss_forecast(gappy, PARTS, 5).where("series_id = 'c'").orderBy("step").collect()
    steps = [r.var for r in out]
    assert np.diff(steps) == pytest.approx([.09] * 4) and len({round(r.mean, 9) for r in out}) == 1
    assert all(r.lower < r.mean < r.upper for r in out)


def test_impulse_response(spark):
    rows = spark.createDataFrame([("a", .5)], "series_id string, phi double")
    parts = lambda row: [ss.level_trend(2, (1.0, 1.0))]
    out = ss.ss_irf(rows, parts, steps=4).where("shock = 1 AND state = 0").orderBy("step").collect()
    assert [r.value for r in out] == [0, 1, 2, 3]
    path = ss.ss_irf(rows, lambda row: [ss.autoregressive([row["phi"]], 1.0)], trajectory=[[1.0], [1.0], [0.0]]).orderBy("step")
    assert [r.value for r in path.collect()] == [1.0, 1.5, .75]
    scaled = ss.ss_irf(rows, lambda row: [ss.autoregressive([.5], 3.0)], steps=1, shock_size=None).first()
    assert scaled.value == pytest.approx(3.0)


def test_stream_over_many_batches_equals_batch(spark, tmp_path):
    """Several micro-batches, one after the other, in time order."""
    n, rng = 120, np.random.default_rng(10)
    stamps = pd.date_range("2024-01-01", periods=n, freq="h")
    rows = pd.DataFrame({"series_id": np.repeat(["a", "b"], n), "ds": np.tile(stamps, 2), "y": rng.normal(size=2 * n)})
    source = str(tmp_path / "in")
    for i, part in enumerate(np.array_split(np.arange(n), 4)):
        keep = rows[rows.ds.isin(stamps[part])].sample(frac=1, random_state=i)
        spark.createDataFrame(keep, "series_id string, ds timestamp_ntz, y double").coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    stream = (spark.readStream.schema("series_id string, ds timestamp_ntz, y double")
              .option("maxFilesPerTrigger", 1).parquet(source))
    got = online.run_available(online.stream_anomaly(online.stream_kf_update(stream, .1, .5), 1.5),
                               str(tmp_path / "out"), str(tmp_path / "state")).toPandas()
    assert len(got) == 2 * n
    arrays = spark.createDataFrame(rows).groupBy("series_id").agg(
        F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("p")).select("series_id", F.col("p.ds").alias("ds"), F.col("p.y").alias("z"))
    kf = scalar.filter_array(F.col("z"), F.lit(.1), F.lit(.5), F.lit(0.0), F.lit(1.0))
    for r in arrays.withColumn("kf", kf).collect():
        part = got[got.series_id == r.series_id].sort_values("ds")
        assert np.allclose(part.a_filt, [s["a_filt"] for s in r.kf])
        assert np.allclose(part.loglik, [s["loglik"] for s in r.kf])
        assert list(part.is_anomaly) == [bool(abs(s["v"]) > 1.5 * np.sqrt(s["f"])) for s in r.kf]


def test_late_events_are_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "event_type string, ts timestamp, value double"
    # The watermark of one batch filters the batch after the next.
    for rows in ([("a", dt.datetime(2024, 1, 1, 10, 5), 1.0), ("a", dt.datetime(2024, 1, 1, 15, 0), 2.0)],
                 [("a", dt.datetime(2024, 1, 1, 15, 30), 3.0)],
                 [("a", dt.datetime(2024, 1, 1, 10, 30), 50.0), ("a", dt.datetime(2024, 1, 1, 20, 0), 4.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are taken in order of their modification second
    stream = online.read_event_stream(spark, source, schema, files_per_trigger=1)
    got = online.run_available(online.stream_bucket(stream, lateness="1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert {(r.ds.hour, r.y) for r in got.collect()} == {(10, 1.0), (15, 5.0)}


def test_methods_agree_and_the_steady_one_is_their_limit(gappy):
    parts = [ss.level_trend(2, (.3, .1)), ss.noise(1.0)]
    found = {m: ss.kf_filter(gappy, parts, m).toPandas().sort_values(["series_id", "ds"]) for m in ss.METHODS}
    for method in ("single", "cholesky"):
        assert np.allclose(np.stack(found[method]["state"]), np.stack(found["standard"]["state"]))
        assert np.allclose(np.stack(found[method]["cov"]), np.stack(found["standard"]["cov"]))
        assert np.allclose(found[method]["loglik"], found["standard"]["loglik"])
    full = {m: f[f.series_id == "c"] for m, f in found.items()}
    apart = np.abs(np.stack(full["steady_state"]["state"]) - np.stack(full["standard"]["state"])).max(1)
    assert apart[0] > 1e-3 and apart[-1] < 1e-4
    with pytest.raises(ValueError):
        ss.kf_filter(gappy, parts, "other")


def test_parts_of_a_pattern_do_not_change_the_result(spark, make_arrays, monkeypatch):
    arrays = make_arrays({f"s{i}": level(60, 0, seed=i) for i in range(7)})
    whole = ss.kf_states(arrays, PARTS).orderBy("series_id", "kind", "ds").collect()
    series = [np.array(r.z) for r in arrays.collect()]
    monkeypatch.setattr(ss, "PART_BYTES", 8 * 60 * 2)
    assert [len(members) for members, *_ in ss.run_patterns(json.dumps(PARTS), series)] == [2, 2, 2, 1]
    assert ss.kf_states(arrays, PARTS).orderBy("series_id", "kind", "ds").collect() == whole


def test_intercepts_shift_states_and_observations(gappy):
    """A constant growth and an offset are the plain model on the series without them."""
    parts = [ss.autoregressive([.5], .3), ss.noise(1.0)]
    c, d = .4, 2.0
    plain = ss.kf_states(gappy, parts, kinds=("filtered", "smoothed")).orderBy("series_id", "kind", "ds").toPandas()
    drift = F.transform("z", lambda v, i: v + d + c * (1 - F.pow(F.lit(.5), i)) / .5)
    moved = gappy.withColumn("z", drift)
    got = ss.kf_states(moved, [*parts, ss.intercepts([c], d)], kinds=("filtered", "smoothed")).orderBy("series_id", "kind", "ds").toPandas()
    at = plain.groupby(["series_id", "kind"]).cumcount().to_numpy()
    assert np.allclose(np.stack(got.state)[:, 0], np.stack(plain.state)[:, 0] + c * (1 - .5 ** at) / .5)
    assert np.allclose(got.loglik, plain.loglik) and np.allclose(np.stack(got["cov"]), np.stack(plain["cov"]))
    with pytest.raises(ValueError):
        ss.build(json.dumps([*parts, ss.intercepts([1.0, 2.0])]))


def _starts(spark, rows):
    return spark.createDataFrame(rows, "series_id string, start date")


def test_forecast_from_any_date_equals_the_recursion(spark, gappy):
    parts = [ss.level_trend(2, (.3, .1)), ss.season_fourier(12, 2, .05), ss.intercepts([.1, 0, 0, 0, 0, .2], 1.5), ss.noise(1.0)]
    states = ss.kf_states(gappy, parts, kinds=("filtered",))
    first = dt.date(2020, 1, 6)
    rows = [("a", first + dt.timedelta(weeks=100)), ("a", first + dt.timedelta(weeks=120, days=3)), ("b", dt.date(2030, 1, 1)),
            ("c", first - dt.timedelta(days=1))]
    got = horizon.forecast_from(states, parts, _starts(spark, rows), periods=30).toPandas()
    assert sorted({(r.series_id, r.start) for r in got.itertuples()}) == sorted(rows[:3])  # no state of c before its start
    system = ss.build(json.dumps(parts))
    for series, start in rows[:3]:
        mine = states.where((F.col("series_id") == series) & (F.col("ds") <= F.lit(start))).orderBy(F.desc("ds")).first()
        a, p, ds, wanted = np.array(mine.state), np.array(mine["cov"]).reshape(6, 6), mine.ds, []
        while len(wanted) < 30:
            a, p, ds = system["T"] @ a + system["c"], system["T"] @ p @ system["T"].T + system["Q"], ds + dt.timedelta(weeks=1)
            if ds > start:
                wanted.append((ds, system["Z"] @ a + 1.5, system["Z"] @ p @ system["Z"] + 1.0))
        part = got[(got.series_id == series) & (got.start == start)].sort_values("step")
        assert list(part.step) == list(range(1, 31)) and list(part.ds) == [w[0] for w in wanted]
        assert np.allclose(part["mean"], [w[1] for w in wanted]) and np.allclose(part["var"], [w[2] for w in wanted])
        assert (part.lower < part["mean"]).all()


def test_forecast_from_reaches_its_end_and_checks_arguments(spark, gappy):
    states = ss.kf_states(gappy, PARTS, kinds=("filtered",))
    start = _starts(spark, [("a", dt.date(2020, 3, 2))])
    got = horizon.forecast_from(states, PARTS, start, end="2020-03-31").orderBy("step").collect()
    assert [r.ds.day for r in got] == [9, 16, 23, 30]
    assert horizon.forecast_from(states, PARTS, start, end="2020-03-02").count() == 0
    assert horizon.forecast_from(states.limit(0), PARTS, start, periods=3).count() == 0
    for wrong in ({}, {"periods": 3, "end": "2021-01-01"}, {"periods": 3, "exog": start}):
        with pytest.raises(ValueError):
            horizon.forecast_from(states, PARTS, start, **wrong)


def test_forecast_with_future_regressors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 2))
    dates = [dt.date(2020, 1, 6) + dt.timedelta(weeks=i) for i in range(90)]
    y = x[:80] @ [1.5, -2.0] + rng.normal(size=80).cumsum() * .1
    rows = spark.createDataFrame([("a", dates[:80], y.tolist(), x[:80].tolist())],
                                 "series_id string, ds array<date>, z array<double>, x array<array<double>>")
    parts = [ss.level_trend(1, .1), ss.regression(2, .05), ss.autoregressive([.4], .1), ss.noise(.2)]
    states = ss.kf_states(rows, parts, kinds=("filtered",), exog="x")
    future = spark.createDataFrame([("a", d, v.tolist()) for d, v in zip(dates[80:89], x[80:])], "series_id string, ds date, x array<double>")
    got = horizon.forecast_from(states, parts, _starts(spark, [("a", dates[79])]), periods=10, exog=future).orderBy("step").collect()
    last, system = states.orderBy(F.desc("ds")).first(), ss.build(json.dumps(parts))
    a, p = np.array(last.state), np.array(last["cov"]).reshape(4, 4)
    for i, r in enumerate(got[:9]):
        a, p = system["T"] @ a, system["T"] @ p @ system["T"].T + system["Q"]
        z = np.array([1.0, *x[80 + i], 1.0])
        assert (r["mean"], r["var"]) == pytest.approx((z @ a, z @ p @ z + system["H"]))
    assert got[9]["mean"] is None and got[9]["var"] is None


def test_a_planted_cycle_is_found_at_any_length(make_arrays):
    t, rng = np.arange(300), np.random.default_rng(0)
    lengths = {"a": 17.0, "b": 37.3, "c": 71.0, "d": 8.4}
    series = {s: .01 * t + 2 * np.sin(2 * np.pi * t / n) + .3 * rng.normal(size=300) for s, n in lengths.items()}
    series |= {"short": np.array([1.0, 2.0]), "flat": np.ones(30)}
    arrays = make_arrays(series)
    got = {r.series_id: r.length for r in ss.best_cycle(arrays).select("series_id", "length").distinct().collect()}
    assert all(abs(got[s] / n - 1) < .06 for s, n in lengths.items()), got
    gaps = np.where(rng.random(300) < .3, None, series["b"])
    power = ss.periodogram(arrays.limit(0).unionByName(arrays.where("series_id = 'b'").withColumn(
        "z", F.array(*[F.lit(None if v is None else float(v)) for v in gaps]))), finer=4).orderBy(F.desc("power")).first()
    assert abs(power.length / 37.3 - 1) < .06


def test_a_worker_keeps_passes_by_bytes_and_fits_without_covariances(monkeypatch):
    monkeypatch.setattr(ss, "_passes", {})
    monkeypatch.setattr(ss, "CACHE_BYTES", 1 << 20)
    z = np.sin(np.arange(200.0) / 8)
    for k in range(12):
        params = {"sigma_level": str(0.01 * (k + 1)), "sigma_season": "0.001"}
        before = list(ss._passes)
        _, score, _ = ss.fit_structural(z, params, 12)
        assert list(ss._passes) == before
        ((_, _, _, means, _),) = ss.run_patterns(json.dumps(ss.structural(params, 12)), [z])
        assert score == -(means["loglik"].sum() + sum(-0.5 * (float(v) / ss.PRIOR_SIGMA) ** 2 for v in params.values()))
        assert 0 < sum(v.nbytes for kept in ss._passes.values() for v in kept.values()) <= 1 << 20
