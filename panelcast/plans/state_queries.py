"""Named queries: state space and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelcast.functions import statespace_scalar as scalar
from panelcast.models import arima, horizon, statespace as ss
from panelcast.operators import grid, scaling
from panelcast.plans.catalog import query
from panelcast.plans.core_queries import rounded
from panelcast.plans.model_queries import AR_SQL, _ar1
from panelcast.plans.oracle import r, two_state, with_
from panelcast.plans.prepare import regular_panel
from panelcast.session import materialize, scratch_path
from panelcast.sources import panels
from panelcast.streaming import online

Q, H = 1 / 9, 1 / 2        # variances of the local level used in the checks


def _scaled(spark, d, source="nation") -> DataFrame:
    return scaling.robust_scale(regular_panel(spark, d, source))


def _arrays(spark, d, source="nation") -> DataFrame:
    return grid.as_arrays(_scaled(spark, d, source), "z")


def _gappy_arrays(spark, d) -> DataFrame:
    """The unfilled spine, scaled by the statistics of the filled panel."""
    spine = grid.calendar_spine(panels.orders_by_nation(spark, d))
    stats = scaling.robust_scale_fit(grid.forward_fill(spine))
    return grid.as_arrays(scaling.robust_scale_transform(scaling.apply_scale_stats(spine, stats)), "z")


def _filtered(arrays, steady=False) -> DataFrame:
    q, h = F.lit(Q), F.lit(H)
    out = (scalar.steady_array(F.col("z"), q, h, F.lit(0.0)) if steady
           else scalar.filter_array(F.col("z"), q, h, F.lit(0.0), F.lit(1.0)))
    return arrays.withColumn("kf", out)


def _step_rows(arrays_kf) -> DataFrame:
    rows = arrays_kf.select("series_id", F.explode(F.arrays_zip("ds", "kf")).alias("r"))
    return rows.select("series_id", "r.ds", "r.kf.*")


STEP_NAMES = ["a_pred", "p_pred", "v", "f", "a_filt", "p_filt", "loglik"]


def _step_output(rows):
    return rounded(rows, 6, *STEP_NAMES).select("series_id", "ds", *STEP_NAMES)


ZS = "zs AS (SELECT series_id, ds, z, t FROM scaled)"
GAPPY = """zs AS (SELECT p.series_id, p.ds, (p.y - s.center) / s.scale AS z,
  row_number() OVER (PARTITION BY p.series_id ORDER BY p.ds) - 1 AS t FROM spine p JOIN stats s ON s.series_id = p.series_id)"""
LEVEL = """kf AS (SELECT series_id, CAST(-1 AS BIGINT) AS t, CAST(NULL AS DATE) AS ds, CAST(0 AS DOUBLE) AS a_pred, CAST(1 AS DOUBLE) AS p_pred,
  CAST(NULL AS DOUBLE) AS v, CAST(1 AS DOUBLE) AS f, CAST(0 AS DOUBLE) AS a_filt, CAST(1 AS DOUBLE) AS p_filt, CAST(0 AS DOUBLE) AS loglik,
  CAST(0 AS DOUBLE) AS a_next, CAST(1 AS DOUBLE) AS p_next FROM (SELECT DISTINCT series_id FROM zs)
 UNION ALL
 SELECT series_id, t, ds, a, p, z - a, f, CASE WHEN z IS NULL THEN a ELSE a + p / f * (z - a) END AS af,
  CASE WHEN z IS NULL THEN p ELSE (1 - p / f) * (1 - p / f) * p + p / f * p / f * 0.5 END + 1e-8 AS pf,
  CASE WHEN z IS NULL THEN 0.0 ELSE -0.5 * (ln(2 * pi()) + ln(f) + (z - a) * (z - a) / f) END,
  af, pf + CAST(1 AS DOUBLE) / 9
 FROM (SELECT k.series_id, k.t + 1 AS t, x.ds, k.a_next AS a, k.p_next AS p, k.p_next + 0.5 + 1e-8 AS f, x.z
       FROM kf k JOIN zs x ON x.series_id = k.series_id AND x.t = k.t + 1))"""
STEP_LIST = ", ".join(f"{r(n)} AS {n}" for n in STEP_NAMES)


@query("kf_local_level", with_("nation", ZS, LEVEL, recursive=True) + f"SELECT series_id, ds, {STEP_LIST} FROM kf WHERE t >= 0")
def _(spark, d):
    return _step_output(_step_rows(_filtered(_arrays(spark, d))))


@query("kf_missing", with_("nation", GAPPY, LEVEL, recursive=True) + f"SELECT series_id, ds, {STEP_LIST} FROM kf WHERE t >= 0")
def _(spark, d):
    return _step_output(_step_rows(_filtered(_gappy_arrays(spark, d))))


@query("kf_missing_general", with_("nation", GAPPY, LEVEL, recursive=True) +
       f"SELECT series_id, ds, {r('a_filt')} AS level, {r('p_filt')} AS var, {r('loglik')} AS loglik FROM kf WHERE t >= 0")
def _(spark, d):
    parts = [ss.level_trend(1, Q ** 0.5), ss.noise(H ** 0.5)]
    rows = ss.kf_filter(_gappy_arrays(spark, d), parts)
    return rounded(rows.select("series_id", "ds", F.col("state")[0].alias("level"), F.col("cov")[0].alias("var"),
                               "loglik"), 6, "level", "var", "loglik")


@query("kf_loglik", with_("nation", ZS, LEVEL, recursive=True) + "SELECT series_id, round(sum(loglik), 5) AS loglik FROM kf WHERE t >= 0 GROUP BY 1")
def _(spark, d):
    total = F.aggregate("kf", F.lit(0.0), lambda a, s: a + s["loglik"])
    return _filtered(_arrays(spark, d)).select("series_id", F.round(total, 5).alias("loglik"))


STEADY = """k AS (SELECT (CAST(1 AS DOUBLE) / 9 + sqrt(CAST(1 AS DOUBLE) / 81 + 4 * 0.5 / 9)) / 2 AS p),
kf AS (SELECT series_id, CAST(-1 AS BIGINT) AS t, CAST(NULL AS DATE) AS ds, CAST(0 AS DOUBLE) AS a_pred, CAST(NULL AS DOUBLE) AS v,
  CAST(0 AS DOUBLE) AS a_filt, CAST(0 AS DOUBLE) AS loglik, p FROM (SELECT DISTINCT series_id FROM zs), k
 UNION ALL SELECT k.series_id, x.t, x.ds, k.a_filt, x.z - k.a_filt, k.a_filt + k.p / (k.p + 0.5) * (x.z - k.a_filt),
  -0.5 * (ln(2 * pi()) + ln(k.p + 0.5) + (x.z - k.a_filt) * (x.z - k.a_filt) / (k.p + 0.5)), k.p
  FROM kf k JOIN zs x ON x.series_id = k.series_id AND x.t = k.t + 1)"""


@query("kf_steady_state", with_("nation", ZS, STEADY, recursive=True) + f"""SELECT series_id, ds, {r('a_pred')} AS a_pred,
{r('p')} AS p_pred, {r('v')} AS v, {r('p + 0.5')} AS f, {r('a_filt')} AS a_filt, {r('p * (1 - p / (p + 0.5))')} AS p_filt,
{r('loglik')} AS loglik FROM kf WHERE t >= 0""")
def _(spark, d):
    return _step_output(_step_rows(_filtered(_arrays(spark, d), steady=True)))


SMOOTH = """ends AS (SELECT series_id, max(t) AS last_t FROM kf GROUP BY 1),
sm AS (SELECT k.series_id, k.t, k.a_filt AS a, k.p_filt AS p FROM kf k JOIN ends e ON e.series_id = k.series_id AND e.last_t = k.t
 UNION ALL
 SELECT k.series_id, k.t, k.a_filt + k.p_filt / (k.p_filt + CAST(1 AS DOUBLE) / 9 + 1e-8) * (s.a - k.a_filt),
  k.p_filt + power(k.p_filt / (k.p_filt + CAST(1 AS DOUBLE) / 9 + 1e-8), 2) * (s.p - (k.p_filt + CAST(1 AS DOUBLE) / 9 + 1e-8))
 FROM sm s JOIN kf k ON k.series_id = s.series_id AND k.t = s.t - 1 WHERE s.t > 0)"""
SMOOTHER_SQL = with_("nation", ZS, LEVEL, SMOOTH, recursive=True) + f"""SELECT s.series_id, z.ds, {r('s.a')} AS a_smooth, {r('s.p')} AS p_smooth
FROM sm s JOIN zs z ON z.series_id = s.series_id AND z.t = s.t"""


@query("kf_smoother", SMOOTHER_SQL)
def _(spark, d):
    rows = _filtered(_arrays(spark, d)).withColumn("sm", scalar.smoother_array(F.col("kf"), F.lit(Q)))
    out = rows.select("series_id", F.explode(F.arrays_zip("ds", "sm")).alias("r")).select("series_id", "r.ds", "r.sm.*")
    return rounded(out, 6, "a_smooth", "p_smooth")


@query("kf_smoother_general", SMOOTHER_SQL)
def _(spark, d):
    rows = ss.kf_states(_arrays(spark, d), [ss.level_trend(1, Q ** 0.5), ss.noise(H ** 0.5)], kinds=("smoothed",))
    return rounded(rows.select("series_id", "ds", F.col("state")[0].alias("a_smooth"), F.col("cov")[0].alias("p_smooth")),
                   6, "a_smooth", "p_smooth")


# Level and slope with two disturbances, all written out.
TREND = """kf AS (SELECT series_id, CAST(-1 AS BIGINT) AS t, CAST(NULL AS DATE) AS ds, CAST(0 AS DOUBLE) AS a1, CAST(0 AS DOUBLE) AS a2,
  CAST(1 AS DOUBLE) AS p11, CAST(0 AS DOUBLE) AS p12, CAST(1 AS DOUBLE) AS p22, CAST(0 AS DOUBLE) AS loglik,
  CAST(0 AS DOUBLE) AS f1, CAST(0 AS DOUBLE) AS f2, CAST(1 AS DOUBLE) AS v11, CAST(0 AS DOUBLE) AS v12, CAST(1 AS DOUBLE) AS v22
  FROM (SELECT DISTINCT series_id FROM zs)
 UNION ALL
 SELECT series_id, t, ds, f1 + f2, f2, m11 + 2 * m12 + m22 + CAST(1 AS DOUBLE) / 9, m12 + m22, m22 + CAST(1 AS DOUBLE) / 49, ll, f1, f2, m11, m12, m22
 FROM (SELECT series_id, t, ds, a1 + k1 * (z - a1) AS f1, a2 + k2 * (z - a1) AS f2,
   (1 - k1) * p11 * (1 - k1) + 0.5 * k1 * k1 + 1e-8 AS m11, (1 - k1) * p11 * (-k2) + (1 - k1) * p12 + 0.5 * k1 * k2 AS m12,
   (p12 - k2 * p11) * (-k2) + (p22 - k2 * p12) + 0.5 * k2 * k2 + 1e-8 AS m22,
   -0.5 * (ln(2 * pi()) + ln(f) + (z - a1) * (z - a1) / f) AS ll
  FROM (SELECT k.series_id, x.t, x.ds, x.z, k.a1, k.a2, k.p11, k.p12, k.p22, k.p11 + 0.5 + 1e-8 AS f,
     k.p11 / (k.p11 + 0.5 + 1e-8) AS k1, k.p12 / (k.p11 + 0.5 + 1e-8) AS k2
    FROM kf k JOIN zs x ON x.series_id = k.series_id AND x.t = k.t + 1)))"""
TREND_PARTS = [ss.level_trend(2, (1 / 3, 1 / 7)), ss.noise(H ** 0.5)]


def _trend_rows(arrays, parts, method):
    rows = ss.kf_filter(arrays, parts, method)
    out = rows.select("series_id", "ds", F.col("state")[0].alias("level"), F.col("state")[1].alias("slope"),
                      F.col("cov")[0].alias("var_level"), F.col("cov")[1].alias("cov_level_slope"),
                      F.col("cov")[3].alias("var_slope"), "obs_mean", "obs_var", "loglik")
    return rounded(out, 6, *out.columns[2:])


def _trend_list(intercept="0"):
    return f"""SELECT series_id, ds, {r('f1')} AS level, {r('f2')} AS slope,
{r('v11')} AS var_level, {r('v12')} AS cov_level_slope, {r('v22')} AS var_slope, {r(f'f1 + {intercept}')} AS obs_mean, {r('v11 + 0.5')} AS obs_var,
{r('loglik')} AS loglik FROM kf WHERE t >= 0"""


@query("kf_filter", with_("nation", ZS, TREND, recursive=True) + _trend_list())
def _(spark, d):
    return _trend_rows(_arrays(spark, d), TREND_PARTS, "standard")


@query("kf_filter_cholesky", with_("nation", ZS, TREND, recursive=True) + _trend_list())
def _(spark, d):
    """The same rows from the triangular root of the covariance."""
    return _trend_rows(_arrays(spark, d), TREND_PARTS, "cholesky")


@query("kf_filter_intercepts", with_("nation", ZS, two_state("kf", [[1.0, 1.0], [0.0, 1.0]], (1.0, 0.0), ("1.0 / 9", "1.0 / 49"), 0.5,
                                                             c=(0.02, -0.01), d=0.3), recursive=True) + _trend_list("0.3"))
def _(spark, d):
    return _trend_rows(_arrays(spark, d), [*TREND_PARTS, ss.intercepts([0.02, -0.01], 0.3)], "standard")


@query("kf_filter_steady", with_("nation", ZS, STEADY, recursive=True) + f"""SELECT series_id, ds, {r('a_filt')} AS level,
{r('p * (1 - p / (p + 0.5))')} AS var, {r('loglik')} AS loglik FROM kf WHERE t >= 0""")
def _(spark, d):
    """The constant gain for any components, here those of the local level."""
    rows = ss.kf_filter(_arrays(spark, d), [ss.level_trend(1, Q ** 0.5), ss.noise(H ** 0.5)], "steady_state")
    return rounded(rows.select("series_id", "ds", F.col("state")[0].alias("level"), F.col("cov")[0].alias("var"), "loglik"),
                   6, "level", "var", "loglik")


MULTI = """WITH RECURSIVE w AS (SELECT CAST(c_nationkey AS VARCHAR) AS series_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS ds,
  sum(o_totalprice) AS y, CAST(count(*) AS DOUBLE) AS c FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
st AS (SELECT series_id, median(y) AS my, stddev_samp(y) AS sy, median(c) AS mc, stddev_samp(c) AS sc FROM w GROUP BY 1),
zs AS (SELECT w.series_id, ds, (y - my) / sy AS z1, (c - mc) / sc AS z2,
  row_number() OVER (PARTITION BY w.series_id ORDER BY ds) - 1 AS t FROM w JOIN st ON st.series_id = w.series_id),
kf AS (SELECT series_id, CAST(-1 AS BIGINT) AS t, CAST(NULL AS DATE) AS ds, CAST(0 AS DOUBLE) AS a, CAST(1 AS DOUBLE) AS p,
  CAST(0 AS DOUBLE) AS level, CAST(0 AS DOUBLE) AS loglik FROM (SELECT DISTINCT series_id FROM zs)
 UNION ALL
 SELECT series_id, t, ds, a2, p2 + 1e-8 + 0.04, a2, -0.5 * (2 * ln(2 * pi()) + ln(p + 0.5) + ln(p1 + 0.7)
   + (z1 - a) * (z1 - a) / (p + 0.5) + (z2 - a1) * (z2 - a1) / (p1 + 0.7))
 FROM (SELECT *, a1 + p1 / (p1 + 0.7) * (z2 - a1) AS a2, p1 - p1 * p1 / (p1 + 0.7) AS p2
  FROM (SELECT k.series_id, x.t, x.ds, x.z1, x.z2, k.a, k.p, k.a + k.p / (k.p + 0.5) * (x.z1 - k.a) AS a1,
    k.p - k.p * k.p / (k.p + 0.5) AS p1 FROM kf k JOIN zs x ON x.series_id = k.series_id AND x.t = k.t + 1)))"""


@query("kf_multivariate", MULTI + f" SELECT series_id, ds, {r('level', 5)} AS level, {r('loglik', 5)} AS loglik FROM kf WHERE t >= 0")
def _(spark, d):
    """Order value and order count per nation seen as two views of one level."""
    facts = panels.read_table(spark, d, "orders")
    both = (facts.groupBy("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "week").alias("ds"))
            .agg(F.sum("o_totalprice").alias("y"), F.count("*").cast("double").alias("c"))
            .join(panels.read_table(spark, d, "customer").select("c_custkey", "c_nationkey"),
                  F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("c_nationkey").cast("string").alias("series_id"), "ds")
            .agg(F.sum("y").alias("y"), F.sum("c").alias("c")))
    every = grid.whole()
    scaled = both.withColumns({c: (F.col(v) - F.median(v).over(every)) / F.stddev(v).over(every)
                               for c, v in (("z1", "y"), ("z2", "c"))})
    points = F.sort_array(F.collect_list(F.struct("ds", "z1", "z2")))
    arrays = scaled.groupBy("series_id").agg(points.alias("p")).select(
        "series_id", F.col("p.ds").alias("ds"), F.col("p.z1").alias("z1"), F.col("p.z2").alias("z2"))
    out = ss.kf_columns(arrays, ["z1", "z2"], [ss.level_trend(1, 0.2)], [0.5, 0.7])
    return rounded(out.select("series_id", "ds", F.col("state")[0].alias("level"), "loglik"), 5, "level", "loglik")


@query("ss_forecast", with_("nation", ZS, LEVEL, recursive=True) + f"""SELECT k.series_id, CAST(h AS INTEGER) AS step,
CAST(k.ds + INTERVAL (7 * h) DAY AS DATE) AS ds, {r('k.a_filt')} AS mean, {r('k.p_filt + h * CAST(1 AS DOUBLE) / 9 + 0.5')} AS var
FROM kf k JOIN (SELECT series_id, max(t) AS t FROM kf GROUP BY 1) e ON e.series_id = k.series_id AND e.t = k.t,
(SELECT unnest(generate_series(1, 52)) AS h)""")
def _(spark, d):
    parts = [ss.level_trend(1, Q ** 0.5), ss.noise(H ** 0.5)]
    rows = ss.ss_forecast(_arrays(spark, d), parts, 52)
    return rounded(rows, 6, "mean", "var").select("series_id", "step", "ds", "mean", "var")


# Two starts, one between dates of the grid and one after the last date of every series.
STARTS, END = ("1996-01-03", "2003-06-02"), "2004-01-01"


@query("ss_forecast_from", with_("nation", ZS, LEVEL, recursive=True) + f"""SELECT k.series_id, CAST(e.start AS DATE) AS start,
CAST((x.ds - CAST(date_trunc('week', e.start) AS DATE)) / 7 AS INTEGER) AS step, x.ds, {r('k.a_filt')} AS mean,
{r('k.p_filt + (x.ds - k.ds) / 7 * CAST(1 AS DOUBLE) / 9 + 0.5', 5)} AS var
FROM (SELECT series_id, start, max(ds) AS ds FROM kf, (VALUES (DATE '{STARTS[0]}'), (DATE '{STARTS[1]}')) s(start)
  WHERE t >= 0 AND ds <= start GROUP BY 1, 2) e
JOIN kf k ON k.series_id = e.series_id AND k.ds = e.ds
JOIN (SELECT CAST(unnest(generate_series(TIMESTAMP '1992-01-06', TIMESTAMP '{END}', INTERVAL 7 DAY)) AS DATE) AS ds) x ON x.ds > e.start""")
def _(spark, d):
    """A table of states serves forecasts from any date up to an end, for several starts at once."""
    parts, arrays = [ss.level_trend(1, Q ** 0.5), ss.noise(H ** 0.5)], _arrays(spark, d)
    states = materialize(ss.kf_states(arrays, parts, kinds=("filtered",)).select("series_id", "ds", "state", "cov"), "states")
    starts = states.select("series_id").distinct().select(
        "series_id", F.explode(F.array(*[F.lit(s).cast("date") for s in STARTS])).alias("start"))
    out = horizon.forecast_from(states, parts, starts, end=END).select("series_id", "start", "step", "ds", "mean", "var")
    return rounded(rounded(out, 6, "mean"), 5, "var")


@query("ss_conditional", with_("nation", ZS, LEVEL, SMOOTH, recursive=True) + f"""SELECT series_id, ds, kind, {r('m')} AS state,
{r('p')} AS var, {r('m')} AS obs_mean, {r('p + 0.5')} AS obs_var FROM (
 SELECT series_id, ds, 'filtered' AS kind, a_filt AS m, p_filt AS p FROM kf WHERE t >= 0
 UNION ALL SELECT series_id, ds, 'predicted', a_pred, p_pred FROM kf WHERE t >= 0
 UNION ALL SELECT s.series_id, z.ds, 'smoothed', s.a, s.p FROM sm s JOIN zs z ON z.series_id = s.series_id AND z.t = s.t)""")
def _(spark, d):
    parts = [ss.level_trend(1, Q ** 0.5), ss.noise(H ** 0.5)]
    rows = ss.kf_states(_arrays(spark, d), parts, kinds=("filtered", "predicted", "smoothed"))
    out = rows.select("series_id", "ds", "kind", F.col("state")[0].alias("state"), F.col("cov")[0].alias("var"),
                      "obs_mean", "obs_var")
    return rounded(out, 6, *out.columns[3:])


@query("ss_irf", with_("nation", AR_SQL) + f"""SELECT series_id, CAST(k AS INTEGER) AS step, {r('power(phi, k)')} AS value
FROM fit, (SELECT unnest(generate_series(0, 39)) AS k)""")
def _(spark, d):
    _, best = _ar1(spark, d, "nation", twice=False)
    rows = best.select("series_id", F.col("coef")[2].alias("phi"))
    out = ss.ss_irf(rows, lambda row: [ss.autoregressive([row["phi"]], 1.0)])
    return out.where("state = 0").select("series_id", "step", F.round("value", 6).alias("value"))


@query("ss_extract_components", with_("nation", ZS) + f"""SELECT series_id, ds, 'trend' AS component, {r('z')} AS value FROM zs
UNION ALL SELECT series_id, ds, 'season', {r('2 * z + z / 3')} FROM zs""")
def _(spark, d):
    # Given states (z, 10, 2z, -1, z/3): trend sees the first, season weighs the last three by 1, 0, 1.
    z = F.col("z")
    states = _scaled(spark, d).select("series_id", "ds", F.array(z, F.lit(10.0), 2 * z, F.lit(-1.0), z / 3).alias("state"))
    out = ss.ss_extract_components(states, {"trend": (0, [1, 0]), "season": (2, [1, 0, 1])})
    return rounded(out, 6, "value")


@query("trend_line", with_("nation") + f"""SELECT s.series_id, s.ds, {r('f.a + f.b * s.t')} AS mean FROM scaled s
JOIN (SELECT series_id, regr_intercept(z, t) AS a, regr_slope(z, t) AS b FROM scaled GROUP BY 1) f ON f.series_id = s.series_id""")
def _(spark, d):
    return ss.trend_regression(_scaled(spark, d)).select("series_id", "ds", F.round("mean", 6).alias("mean"))


def _decomposed(spark, d, parts):
    return ss.decompose(_arrays(spark, d), parts)


def _part(spark, d, name, parts, digits=6):
    rows = _decomposed(spark, d, parts).where(F.col("component") == name)
    return rounded(rows.select("series_id", "ds", "mean", "var"), digits, "mean", "var")


SMOOTH_TREND = with_("nation", ZS, two_state("kf", [[1.0, 1.0], [0.0, 1.0]], (1.0, 0.0), ("1.0 / 9", "1.0 / 49"), 0.5), recursive=True)


@query("decompose_level_trend", SMOOTH_TREND + f"SELECT series_id, ds, {r('s1')} AS mean, {r('w11')} AS var FROM kf_sm")
def _(spark, d):
    """The smoothed level of a model of level and slope."""
    return _part(spark, d, "trend", TREND_PARTS)


@query("decompose_noise", SMOOTH_TREND + f"SELECT series_id, ds, {r('z - s1')} AS mean, 0.5 AS var FROM kf_sm")
def _(spark, d):
    return _part(spark, d, "noise", TREND_PARTS)


@query("decompose_season_dummy", with_("nation", ZS, two_state("kf", [[-1.0, -1.0], [1.0, 0.0]], (1.0, 0.0), (0.04, 0.0), 0.5),
                                       recursive=True) + f"SELECT series_id, ds, {r('s1')} AS mean, {r('w11')} AS var FROM kf_sm")
def _(spark, d):
    """The smoothed season of three periods whose effects add up to a disturbance."""
    return _part(spark, d, "season_3", [ss.season_dummy(3, 0.2), ss.noise(H ** 0.5)])


def _turn(length, damping="1.0"):
    cos, sin = (f"{damping} * {f}(2 * pi() / {length})" for f in ("cos", "sin"))
    return [[cos, sin], [f"-{sin}", cos]]


@query("decompose_season_fourier", with_("nation", ZS, two_state("kf", _turn(52), (1.0, 0.0), (0.01, 0.01), 0.5), recursive=True) +
       f"SELECT series_id, ds, {r('s1')} AS mean, {r('w11')} AS var FROM kf_sm")
def _(spark, d):
    """The smoothed yearly wave of one drifting harmonic."""
    return _part(spark, d, "fourier_52", [ss.season_fourier(52, 1, 0.1), ss.noise(H ** 0.5)])


@query("decompose_cycle_given", with_("nation", ZS, two_state("kf", _turn(39, "0.9"), (1.0, 0.0), (0.04, 0.04), 0.5), recursive=True) +
       f"SELECT series_id, ds, {r('s1')} AS mean, {r('w11')} AS var FROM kf_sm")
def _(spark, d):
    """The smoothed damped cycle of a given length."""
    return _part(spark, d, "cycle", [ss.cycle(39, 0.9, 0.2), ss.noise(H ** 0.5)])


@query("decompose_level_trend_noisy")
def _(spark, d):
    return _decomposed(spark, d, [ss.level_trend(2, (0.1, 0.01)), ss.noise(0.5)])


@query("trend_line_noise", with_("nation") + f"""SELECT s.series_id, s.ds, {r('s.z - (f.a + f.b * s.t)')} AS noise FROM scaled s
JOIN (SELECT series_id, regr_intercept(z, t) AS a, regr_slope(z, t) AS b FROM scaled GROUP BY 1) f ON f.series_id = s.series_id""")
def _(spark, d):
    rows = ss.trend_regression(_scaled(spark, d))
    return rows.select("series_id", "ds", F.round(F.col("z") - F.col("mean"), 6).alias("noise"))


# The same filter and smoother for a first-order autoregression of 0.6.
AR_STATE = """kf AS (SELECT series_id, CAST(-1 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS z, CAST(0 AS DOUBLE) AS af, CAST(1 AS DOUBLE) AS pf,
  CAST(0 AS DOUBLE) AS a, CAST(1 AS DOUBLE) AS p FROM (SELECT DISTINCT series_id FROM zs)
 UNION ALL SELECT series_id, t, z, a1, p1, 0.6 * a1, 0.36 * p1 + 0.25 FROM (SELECT k.series_id, x.t, x.z,
   k.a + k.p / (k.p + 0.25 + 1e-8) * (x.z - k.a) AS a1, power(1 - k.p / (k.p + 0.25 + 1e-8), 2) * k.p
     + power(k.p / (k.p + 0.25 + 1e-8), 2) * 0.25 + 1e-8 AS p1
   FROM kf k JOIN zs x ON x.series_id = k.series_id AND x.t = k.t + 1)),
ends AS (SELECT series_id, max(t) AS last_t FROM kf GROUP BY 1),
sm AS (SELECT k.series_id, k.t, k.z, k.af AS a, k.pf AS p FROM kf k JOIN ends e ON e.series_id = k.series_id AND e.last_t = k.t
 UNION ALL SELECT series_id, t, z, af + g * (a - 0.6 * af), pf + g * g * (p - ph) FROM (SELECT k.series_id, k.t, k.z, k.af, k.pf, s.a, s.p,
   0.36 * k.pf + 0.25 + 1e-8 AS ph, 0.6 * k.pf / (0.36 * k.pf + 0.25 + 1e-8) AS g
   FROM sm s JOIN kf k ON k.series_id = s.series_id AND k.t = s.t - 1 WHERE s.t > 0))"""


@query("decompose_ar", with_("nation", ZS, AR_STATE, recursive=True) + f"""SELECT s.series_id, c.component, x.ds,
{r("CASE WHEN c.component = 'ar' THEN s.a ELSE s.z - s.a END")} AS mean, {r("CASE WHEN c.component = 'ar' THEN s.p ELSE 0.25 END")} AS var
FROM sm s JOIN zs x ON x.series_id = s.series_id AND x.t = s.t, (VALUES ('ar'), ('noise')) c(component)""")
def _(spark, d):
    return rounded(_decomposed(spark, d, [ss.autoregressive([0.6], 0.5), ss.noise(0.5)]), 6, "mean", "var")


@query("season_means", with_("nation") + f"""SELECT series_id, CAST(i AS INTEGER) AS season_index,
{r('m - avg(m) OVER (PARTITION BY series_id)')} AS effect FROM (SELECT series_id, t % 52 AS i, avg(z) AS m FROM scaled GROUP BY 1, 2)""")
def _(spark, d):
    return rounded(ss.season_means(_scaled(spark, d), 52), 6, "effect")


@query("decompose_season_dummy_noisy")
def _(spark, d):
    return _decomposed(spark, d, [ss.level_trend(1, 0.1), ss.season_dummy(4, 0.05), ss.noise(0.5)])


FOURIER = ", ".join(f"{r(f'{f}(t * 2 * pi() * {j} / 52)')} AS {f}_{j}" for j in (1, 2, 3) for f in ("cos", "sin"))


@query("season_fourier_columns", with_("nation") + f"SELECT series_id, ds, {FOURIER} FROM scaled")
def _(spark, d):
    """The design columns of three harmonics."""
    rows = grid.time_index(regular_panel(spark, d, "nation"), 52)
    columns = ss.fourier_columns(F.col("t"), 52, 3)
    return rounded(rows.withColumns(columns), 6, *columns).select("series_id", "ds", *columns)


@query("decompose_season_fourier_fit")
def _(spark, d):
    """Least squares on the design columns: the season without noise."""
    rows = grid.time_index(_scaled(spark, d), 52)
    columns = ss.fourier_columns(F.col("t"), 52, 3)
    rows = rows.withColumns(columns)
    coef = ss.regress(rows, list(columns))
    season = sum((F.col("coef")[i + 1] * F.col(c) for i, c in enumerate(columns)), F.lit(0.0))
    return rows.join(coef, "series_id").select("series_id", "ds", season.alias("mean"))


@query("decompose_season_fourier_noisy")
def _(spark, d):
    return _decomposed(spark, d, [ss.level_trend(1, 0.1), ss.season_fourier(52, 3, 0.01), ss.noise(0.5)])


@query("decompose_cycle")
def _(spark, d):
    """Length and damping chosen by likelihood among the peaks of the series' periodogram, then the smoother."""
    return ss.best_cycle(_arrays(spark, d))


@query("cycle_periodogram", with_("nation") + f"""SELECT series_id, CAST(k AS DOUBLE) AS wave, {r('CAST(n AS DOUBLE) / k')} AS length,
{r('(power(sum(v * cos(2 * pi() * k * t / n)), 2) + power(sum(v * sin(2 * pi() * k * t / n)), 2)) / n')} AS power
FROM (SELECT s.series_id, s.t, s.n, s.z - f.a - f.b * s.t AS v FROM scaled s
  JOIN (SELECT series_id, regr_intercept(z, t) AS a, regr_slope(z, t) AS b FROM scaled GROUP BY 1) f ON f.series_id = s.series_id) x,
 (SELECT unnest(generate_series(1, 2000)) AS k) WHERE k <= n / 3.0 GROUP BY series_id, k, n""")
def _(spark, d):
    return rounded(ss.periodogram(_arrays(spark, d)), 6, "length", "power")


REG_SQL = """w AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS ds,
  round(sum(o_totalprice), 2) AS y, count(*) AS x FROM orders GROUP BY 1, 2)"""


def _weekly_with_counts(spark, d):
    return (panels.read_table(spark, d, "orders")
            .groupBy(F.col("o_orderpriority").alias("series_id"), F.trunc(F.col("o_orderdate").cast("date"), "week").alias("ds"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("y"), F.count("*").cast("double").alias("x")))


@query("regress_exog", f"WITH {REG_SQL} SELECT series_id, round(regr_intercept(y, x), 1) AS intercept, round(regr_slope(y, x), 1) AS slope FROM w GROUP BY 1")
def _(spark, d):
    coef = ss.regress(_weekly_with_counts(spark, d), ["x"], "y")
    return coef.select("series_id", F.round(F.col("coef")[0], 1).alias("intercept"), F.round(F.col("coef")[1], 1).alias("slope"))


@query("regress_exog_drifting")
def _(spark, d):
    """Coefficients that follow random walks: a time-varying observation vector."""
    rows = scaling.robust_scale(_weekly_with_counts(spark, d)).withColumn("x", F.array(F.lit(1.0), F.col("x") / 10))
    points = F.sort_array(F.collect_list(F.struct("ds", "z", "x")))
    arrays = rows.groupBy("series_id").agg(points.alias("p")).select(
        "series_id", F.col("p.ds").alias("ds"), F.col("p.z").alias("z"), F.col("p.x").alias("x"))
    return ss.kf_filter(arrays, [ss.regression(2, 0.05), ss.noise(0.5)], exog="x").select("series_id", "ds", "state", "loglik")


SUM_PARTS = [ss.level_trend(2, (0.1, 0.01)), ss.season_fourier(52, 2, 0.01), ss.autoregressive([0.3], 0.1), ss.noise(0.5)]


@query("decompose_sum", with_("nation", ZS) + f"SELECT series_id, ds, {r('z')} AS total, CAST(4 AS BIGINT) AS n_components FROM zs")
def _(spark, d):
    """The smoothed components and the noise add up to the series."""
    rows = _decomposed(spark, d, SUM_PARTS).groupBy("series_id", "ds")
    return rounded(rows.agg(F.sum("mean").alias("total"), F.count("*").alias("n_components")), 6, "total")


@query("decompose_sum_parts")
def _(spark, d):
    return _decomposed(spark, d, SUM_PARTS)


@query("seasonal_difference", with_("nation") + f"""SELECT series_id, ds, {r('u - lag(u, 52) OVER w')} AS w FROM
 (SELECT series_id, ds, t, z - lag(z) OVER (PARTITION BY series_id ORDER BY ds) AS u FROM scaled)
 WINDOW w AS (PARTITION BY series_id ORDER BY ds) QUALIFY t >= 53""")
def _(spark, d):
    out = arima.seasonal_difference(_scaled(spark, d), 1, 1, 52)
    return out.select("series_id", "ds", F.round("w", 6).alias("w"))


# --- streaming --------------------------------------------------------------------------------

HOURLY = """b AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ds, round(sum(value), 2) AS y,
 count(*) AS n FROM events GROUP BY 1, 2)"""


def _events_folder(spark, d, slices=4):
    """The event table as a source of several files in order of time, of which a micro-batch takes one."""
    folder, events = scratch_path(spark, "events"), panels.read_table(spark, d, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    for k in range(slices if first else 0):
        part = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")))
                               / F.greatest(F.unix_micros(F.lit(last).cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")),
                                            F.lit(1)) * slices), F.lit(slices - 1))
        events.where(part == k).coalesce(1).write.mode("append").parquet(folder)
    return folder


def _bucketed(spark, d):
    events = online.read_event_stream(spark, _events_folder(spark, d), files_per_trigger=1)
    return online.bucket_available(events, scratch_path(spark, "buckets"), scratch_path(spark, "bucket-state"), lateness="2 hours")


@query("stream_bucket", f"WITH {HOURLY} SELECT series_id, ds, y, n FROM b")
def _(spark, d):
    return _bucketed(spark, d)


STREAM_KF = f"""WITH RECURSIVE {HOURLY},
zs AS (SELECT series_id, ds, y AS z, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS t FROM b),
""" + LEVEL.replace("CAST(NULL AS DATE)", "CAST(NULL AS TIMESTAMP)")


def _updated(spark, d):
    """Second stage: the written buckets are the source of the stateful filter, a few files at a time in any order."""
    buckets = _bucketed(spark, d)
    folder = scratch_path(spark, "bucket-table")
    buckets.repartitionByRange(3, "ds").write.parquet(folder)
    stream = spark.readStream.schema(buckets.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    updated = online.run_available(online.stream_kf_update(stream, Q, H, kept_steps=1_000), scratch_path(spark, "level"),
                                   scratch_path(spark, "level-state"))
    return online.latest_steps(updated)


@query("stream_kf_update", STREAM_KF + f"SELECT series_id, ds, {STEP_LIST} FROM kf WHERE t >= 0")
def _(spark, d):
    return _step_output(_updated(spark, d))


@query("stream_anomaly", STREAM_KF + "SELECT series_id, ds, abs(v) > 3 * sqrt(f) AS is_anomaly FROM kf WHERE t >= 0")
def _(spark, d):
    return online.stream_anomaly(_updated(spark, d)).select("series_id", "ds", "is_anomaly")
