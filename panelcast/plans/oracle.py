"""Building blocks of the check SQL (DuckDB dialect)."""

from __future__ import annotations

# Observed panels: one row per series and period.
OBSERVED = {
    "priority": """SELECT o_orderpriority AS series_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS ds,
        round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1, 2""",
    "nation": """SELECT n_name AS series_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS ds,
        round(sum(o_totalprice), 2) AS y FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "supplier": """SELECT CAST(l_suppkey AS VARCHAR) AS series_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS ds,
        round(sum(l_quantity), 2) AS y FROM lineitem GROUP BY 1, 2""",
    "hourly": """SELECT event_type AS series_id, date_trunc('hour', ts) AS ds,
        round(sum(value), 2) AS y FROM events GROUP BY 1, 2""",
}


def r(expr: str, digits: int = 6) -> str:
    """Rounded, with negative zero turned into zero."""
    return f"CASE WHEN round({expr}, {digits}) = 0 THEN 0.0 ELSE round({expr}, {digits}) END"


def base(source: str) -> str:
    """CTEs obs, spine, panel (filled), stats, scaled (with split and t), hist."""
    return f"""obs AS ({OBSERVED[source]}),
bounds AS (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM obs GROUP BY 1),
grid AS (SELECT series_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
    INTERVAL 7 DAY)) AS DATE) AS ds FROM bounds),
spine AS (SELECT g.series_id, g.ds, o.y FROM grid g LEFT JOIN obs o ON o.series_id = g.series_id AND o.ds = g.ds),
panel AS (SELECT series_id, ds, last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y FROM spine),
quart AS (SELECT series_id, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS center,
    quantile_cont(y, 0.75) AS q3 FROM panel GROUP BY 1),
stats AS (SELECT series_id, center, CASE WHEN q3 = q1 THEN 1.0 ELSE q3 - q1 END AS scale FROM quart),
scaled AS (SELECT p.series_id, p.ds, p.y, s.center, s.scale, (p.y - s.center) / s.scale AS z,
    row_number() OVER (PARTITION BY p.series_id ORDER BY p.ds) - 1 AS t,
    count(*) OVER (PARTITION BY p.series_id) AS n FROM panel p JOIN stats s ON s.series_id = p.series_id),
split AS (SELECT *, CASE WHEN t >= n - 52 THEN 'test' ELSE 'train' END AS split FROM scaled)"""


def with_(source: str, *more: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join([base(source), *more]) + "\n"


# Simple and linear-trend smoothing with fixed weights on the training rows:
# fitted rows, then 52 forecasts, back in original units.
SMOOTHED = """spec AS (SELECT * FROM (VALUES ('hw_simple', CAST(1 AS DOUBLE) / 3, CAST(0 AS DOUBLE)),
    ('hw_trend', CAST(1 AS DOUBLE) / 3, CAST(1 AS DOUBLE) / 30)) v(model, a, b)),
train AS (SELECT series_id, ds, z, t, center, scale FROM split WHERE split = 'train'),
first2 AS (SELECT series_id, max(CASE WHEN t = 0 THEN z END) AS z0, max(CASE WHEN t = 1 THEN z END) AS z1
    FROM train GROUP BY 1),
run AS (SELECT f.series_id, s.model, s.a, s.b, CAST(0 AS BIGINT) AS t, z0 AS l,
    CASE WHEN s.model = 'hw_trend' THEN z1 - z0 ELSE 0.0 END AS g, CAST(NULL AS DOUBLE) AS fit
    FROM first2 f CROSS JOIN spec s
  UNION ALL
  SELECT r.series_id, r.model, r.a, r.b, r.t + 1, (r.l + r.g) + r.a * (x.z - (r.l + r.g)),
    r.g + r.b * (x.z - (r.l + r.g)), r.l + r.g
    FROM run r JOIN train x ON x.series_id = r.series_id AND x.t = r.t),
ends AS (SELECT series_id, model, max_by(l, t) AS l, max_by(g, t) AS g, max(t) AS last_t FROM run GROUP BY 1, 2),
preds AS (SELECT r.series_id, r.model, x.ds, 'fitted' AS kind, r.fit * x.scale + x.center AS yhat
    FROM run r JOIN train x ON x.series_id = r.series_id AND x.t = r.t - 1 WHERE r.fit IS NOT NULL
  UNION ALL
  SELECT x.series_id, e.model, x.ds, 'forecast' AS kind, (e.l + (x.t - e.last_t + 1) * e.g) * x.scale + x.center
    FROM split x JOIN ends e ON e.series_id = x.series_id WHERE x.split = 'test')"""

METRIC_SQL = {
    "mape": "CASE WHEN count(*) FILTER (WHERE y = 0) = 0 THEN round(avg(abs(y - yhat) / y), 2) END",
    "smape": """round(avg(CASE WHEN (abs(y) + abs(yhat)) / 2 <> 0
        THEN abs(y - yhat) / ((abs(y) + abs(yhat)) / 2) ELSE 0.0 END), 2)""",
    "cumulative_error_percentage": "round(abs(sum(y) - sum(yhat)) / abs(sum(y)), 2)",
    "weighted_mape": """CASE WHEN count(*) FILTER (WHERE y = 0) = 0
        THEN round(sum(abs(y - yhat)) / sum(abs(y)), 2) END""",
    "error_std": "round(stddev_pop(y - yhat), 4)",
    "value_weighted_error": "round(sum(abs(y - yhat) * abs(y)) / sum(y * y), 6)",
}
ALIGNED = """aligned AS (SELECT p.series_id, p.model, p.ds, p.kind,
    CASE WHEN p.kind = 'fitted' THEN 'training' ELSE 'testing' END AS phase, q.y, p.yhat
    FROM preds p JOIN panel q ON q.series_id = p.series_id AND q.ds = p.ds)"""
SCORES = """scores AS (SELECT series_id, model, phase, """ + ", ".join(
    f"{METRIC_SQL[m]} AS {m}" for m in
    ("mape", "smape", "cumulative_error_percentage", "weighted_mape", "error_std")) + """
    FROM aligned GROUP BY 1, 2, 3)"""


def two_state(name: str, step, z, q, h: float, p0=(1.0, 1.0), c=(0.0, 0.0), d: float = 0.0) -> str:
    """Filter (CTE ``name``) and smoother (``name_sm``) of a model of two states over zs, every product written out.

    ``step`` is the transition by rows, ``q`` the variances of its disturbances.
    Filtered means and covariances are f1, f2, v11, v12, v22; smoothed ones s1, s2, w11, w12, w22.
    """
    num = lambda v: f"CAST({v!r} AS DOUBLE)" if not isinstance(v, str) else f"({v})"
    (t11, t12), (t21, t22) = [[num(v) for v in row] for row in step]
    z1, z2, q1, q2, h, c1, c2, d = [num(v) for v in (*z, *q, h, *c, d)]
    moved = lambda a, b, p: f"{a[0]} * {b[0]} * {p}11 + ({a[0]} * {b[1]} + {a[1]} * {b[0]}) * {p}12 + {a[1]} * {b[1]} * {p}22"
    first, second = (t11, t12), (t21, t22)
    e1, e2 = ("e11", "e12"), ("e21", "e22")
    g1, g2 = ("g11", "g12"), ("g21", "g22")
    return f"""{name} AS (SELECT series_id, CAST(-1 AS BIGINT) AS t, CAST(NULL AS DATE) AS ds, CAST(0 AS DOUBLE) AS z,
  CAST(0 AS DOUBLE) AS a1, CAST(0 AS DOUBLE) AS a2, {num(p0[0])} AS p11, CAST(0 AS DOUBLE) AS p12, {num(p0[1])} AS p22,
  CAST(0 AS DOUBLE) AS f1, CAST(0 AS DOUBLE) AS f2, CAST(1 AS DOUBLE) AS v11, CAST(0 AS DOUBLE) AS v12, CAST(1 AS DOUBLE) AS v22,
  CAST(0 AS DOUBLE) AS loglik FROM (SELECT DISTINCT series_id FROM zs)
 UNION ALL
 SELECT series_id, t, ds, z, {t11} * f1 + {t12} * f2 + {c1}, {t21} * f1 + {t22} * f2 + {c2},
  {moved(first, first, "v")} + {q1}, {moved(first, second, "v")}, {moved(second, second, "v")} + {q2},
  f1, f2, v11, v12, v22, ll
 FROM (SELECT series_id, t, ds, z, a1 + k1 * u AS f1, a2 + k2 * u AS f2,
   {moved(e1, e1, "p")} + {h} * k1 * k1 + 1e-8 AS v11, {moved(e1, e2, "p")} + {h} * k1 * k2 AS v12,
   {moved(e2, e2, "p")} + {h} * k2 * k2 + 1e-8 AS v22, -0.5 * (ln(2 * pi()) + ln(f) + u * u / f) AS ll
  FROM (SELECT *, 1 - k1 * {z1} AS e11, -k1 * {z2} AS e12, -k2 * {z1} AS e21, 1 - k2 * {z2} AS e22
   FROM (SELECT *, b1 / f AS k1, b2 / f AS k2, z - a1 * {z1} - a2 * {z2} - {d} AS u
    FROM (SELECT *, {z1} * b1 + {z2} * b2 + {h} + 1e-8 AS f
     FROM (SELECT k.series_id, x.t, x.ds, x.z, k.a1, k.a2, k.p11, k.p12, k.p22,
       k.p11 * {z1} + k.p12 * {z2} AS b1, k.p12 * {z1} + k.p22 * {z2} AS b2
      FROM {name} k JOIN zs x ON x.series_id = k.series_id AND x.t = k.t + 1)))))),
{name}_end AS (SELECT series_id, max(t) AS t FROM {name} GROUP BY 1),
{name}_sm AS (SELECT k.series_id, k.t, k.ds, k.z, k.f1 AS s1, k.f2 AS s2, k.v11 AS w11, k.v12 AS w12, k.v22 AS w22
  FROM {name} k JOIN {name}_end e ON e.series_id = k.series_id AND e.t = k.t
 UNION ALL
 SELECT series_id, t, ds, z, f1 + g11 * r1 + g12 * r2, f2 + g21 * r1 + g22 * r2,
  v11 + {moved(g1, g1, "d")}, v12 + {moved(g1, g2, "d")}, v22 + {moved(g2, g2, "d")}
 FROM (SELECT *, (m11 * h22 - m12 * h12) / det AS g11, (m12 * h11 - m11 * h12) / det AS g12,
   (m21 * h22 - m22 * h12) / det AS g21, (m22 * h11 - m21 * h12) / det AS g22, w11 - h11 AS d11, w12 - h12 AS d12, w22 - h22 AS d22
  FROM (SELECT *, h11 * h22 - h12 * h12 AS det
   FROM (SELECT k.series_id, k.t, k.ds, k.z, k.f1, k.f2, k.v11, k.v12, k.v22, s.w11, s.w12, s.w22,
     s.s1 - k.a1 AS r1, s.s2 - k.a2 AS r2, k.p11 + 1e-8 AS h11, k.p12 AS h12, k.p22 + 1e-8 AS h22,
     k.v11 * {t11} + k.v12 * {t12} AS m11, k.v11 * {t21} + k.v12 * {t22} AS m12,
     k.v12 * {t11} + k.v22 * {t12} AS m21, k.v12 * {t21} + k.v22 * {t22} AS m22
    FROM {name}_sm s JOIN {name} k ON k.series_id = s.series_id AND k.t = s.t - 1 WHERE s.t > 0))))"""
