"""Regressions and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.joined import GRID, tier_grid
from sensorloom.catalog.registry import R, query, rounded
from sensorloom.catalog.series import MEANS
from sensorloom.catalog.views import CLIMATE, HOUR, READINGS, TIER, WEEK, Tables
from sensorloom.config import VELOCITIES
from sensorloom.functions.columns import floor_time, shift
from sensorloom.operators import models as M
from sensorloom.operators.aggregates import r_squared, station_mean
from sensorloom.operators.intervals import grid_left_join, make_grid
from sensorloom.operators.reshape import pivot_series
from sensorloom.session import written

FULL = "full_tier AS (SELECT * FROM grid LEFT JOIN tier USING (Tree, Cable, Timestamp))"


def full_tier(t: Tables):
    d = t.tier_wide()
    return grid_left_join(tier_grid(d), d)


@query("ols_pair", f"""WITH {TIER}, m AS (SELECT Tree, Cable, regr_slope(outer_vel, middle_vel) AS b, regr_intercept(outer_vel, middle_vel) AS a FROM tier GROUP BY 1, 2)
  SELECT Tree, Cable, Timestamp, {R('outer_vel')} AS outer_vel, {R('a + b * middle_vel')} AS yhat FROM tier JOIN m USING (Tree, Cable)""")
def _(t: Tables):
    d = M.gap_fill_simple(t.tier_wide(), "outer_vel", "middle_vel", ["Tree", "Cable"])
    return rounded(d.select("Tree", "Cable", "Timestamp", "outer_vel", "yhat"), "outer_vel", "yhat")


_GAPS = """marked AS (SELECT *, row_number() OVER (PARTITION BY Tree, Cable ORDER BY Timestamp) AS i FROM full_tier),
lost AS (SELECT *, i - row_number() OVER (PARTITION BY Tree, Cable ORDER BY i) AS k FROM marked WHERE outer_vel IS NULL AND middle_vel IS NULL AND inner_vel IS NULL),
gaps AS (SELECT Tree, Cable, row_number() OVER (PARTITION BY Tree, Cable ORDER BY min(Timestamp)) AS gap, min(Timestamp) AS s, max(Timestamp) AS e FROM lost GROUP BY Tree, Cable, k)"""
_WINDOW = "win AS (SELECT Tree, Cable, gap, s, e, unnest(generate_series(s - INTERVAL 7 DAY, e, INTERVAL 1 HOUR)) AS Timestamp FROM gaps)"
_PAIR = """pair AS (SELECT w.*, a.outer_vel AS y, b.outer_vel AS x1, b.middle_vel AS x2, b.inner_vel AS x3 FROM win w
  LEFT JOIN full_tier a ON a.Tree = w.Tree AND a.Cable = w.Cable AND a.Timestamp = w.Timestamp
  LEFT JOIN full_tier b ON b.Tree = w.Tree AND b.Cable = w.Cable % 3 + 1 AND b.Timestamp = w.Timestamp),
cand AS (""" + " UNION ALL ".join(f"SELECT Tree, Cable, gap, s, e, Timestamp, y, x{i} AS x, '{c}_sib' AS Sensor FROM pair" for i, c in enumerate(VELOCITIES, 1)) + """),
fit AS (SELECT Tree, Cable, gap, Sensor, count(*) AS n, corr(y, x) AS r, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
  FROM cand WHERE y IS NOT NULL AND x IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5 AND min(x) < max(x) AND min(y) < max(y)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Tree, Cable, gap ORDER BY r DESC, Sensor) AS rn FROM fit) WHERE rn = 1),
pred AS (SELECT c.Tree, c.Cable, c.Timestamp, a + b * x AS yhat, c.Sensor FROM cand c JOIN best USING (Tree, Cable, gap, Sensor)
  WHERE y IS NULL AND x IS NOT NULL AND c.Timestamp BETWEEN s AND e)"""


@query("fill_from_best", f"""WITH {TIER}, {GRID}, {FULL}, {_GAPS}, {_WINDOW}, {_PAIR}
  SELECT Tree, Cable, Timestamp, {R('outer_vel')} AS outer_vel, {R('coalesce(outer_vel, yhat)')} AS filled, Sensor AS source
  FROM full_tier LEFT JOIN pred USING (Tree, Cable, Timestamp)""")
def _(t: Tables):
    d = full_tier(t)
    siblings = d.select("Tree", "Cable").distinct().withColumn("Sibling", (F.col("Cable") % 3 + 1).cast("int"))
    out = M.fill_from_best(d, siblings, step=HOUR, min_pairs=5, span=WEEK)
    return rounded(out.select("Tree", "Cable", "Timestamp", "outer_vel", "filled", "source"), "outer_vel", "filled")


# Four readings of one tree side by side: dense enough for complete margins.
_DENSE = """dense AS (SELECT event_type AS Tree, date_trunc('hour', ts) AS Timestamp, avg(value) AS m, max(value) AS x,
    CASE WHEN count(*) >= 2 THEN min(value) END AS o FROM events GROUP BY 1, 2),
dgrid AS (SELECT Tree, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS Timestamp FROM (SELECT Tree, min(Timestamp) AS lo, max(Timestamp) AS hi FROM dense GROUP BY 1)),
dn AS (SELECT g.Tree, g.Timestamp, o, m, x, row_number() OVER (PARTITION BY g.Tree ORDER BY g.Timestamp) AS i FROM dgrid g LEFT JOIN dense USING (Tree, Timestamp)),
dl AS (SELECT *, i - row_number() OVER (PARTITION BY Tree ORDER BY i) AS k FROM dn WHERE o IS NULL),
dg AS (SELECT Tree, row_number() OVER (PARTITION BY Tree ORDER BY min(i)) AS gap, min(i) AS i0, max(i) AS i1 FROM dl GROUP BY Tree, k),
dw AS (SELECT g.Tree, g.gap, g.i0, g.i1, n.Timestamp, n.o, n.m, n.x FROM dg g JOIN dn n ON n.Tree = g.Tree AND n.i BETWEEN g.i0 - 2 AND g.i1 + 2),
dc AS (SELECT *, m AS v, 'middle_vel' AS Sensor FROM dw UNION ALL SELECT *, x AS v, 'inner_vel' AS Sensor FROM dw),
df AS (SELECT Tree, gap, Sensor, regr_slope(o, v) AS b, regr_intercept(o, v) AS a, corr(o, v) AS r FROM dc GROUP BY Tree, gap, Sensor, i0, i1
  HAVING count(*) = i1 - i0 + 5 AND count(*) FILTER (WHERE o IS NULL) = i1 - i0 + 1 AND count(*) FILTER (WHERE o IS NULL AND v IS NULL) = 0
    AND count(*) FILTER (WHERE v IS NULL) <= 1
    AND min(CASE WHEN v IS NOT NULL THEN o END) < max(CASE WHEN v IS NOT NULL THEN o END) AND min(CASE WHEN o IS NOT NULL THEN v END) < max(CASE WHEN o IS NOT NULL THEN v END)),
dbest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Tree, gap ORDER BY abs(r) DESC, Sensor) AS rn FROM df) WHERE rn = 1)"""


@query("fill_from_context", f"""WITH {_DENSE} SELECT c.Tree, CAST(c.gap AS BIGINT) AS gap, c.Timestamp, c.Sensor, {R('a + b * v')} AS filled
  FROM dc c JOIN dbest USING (Tree, gap, Sensor) WHERE o IS NULL""")
def _(t: Tables):
    return context_fill(t)


def context_fill(t: Tables, unit: int = HOUR):
    slot = floor_time(t.events, "ts", "minute")
    slot = shift(slot, -F.pmod(F.unix_timestamp(slot), F.lit(unit)))
    d = t.events.groupBy(F.col("event_type").alias("Tree"), slot.alias("Timestamp")).agg(
        F.when(F.count(F.lit(1)) >= 2, F.min("value")).alias("outer_vel"), F.avg("value").alias("middle_vel"), F.max("value").alias("inner_vel")
    )
    grid = make_grid(d.groupBy("Tree").agg(F.min("Timestamp").alias("lo"), F.max("Timestamp").alias("hi")), "lo", "hi", ["Tree"], unit)
    full = grid_left_join(grid, d, ["Tree", "Timestamp"])
    return rounded(M.fill_from_context(full, rows=2, keys=["Tree"], span=WEEK), "filled")


_PIVOT = """wide AS (SELECT Cable, Timestamp, max(Velocity) FILTER (WHERE Tree = 'T0') AS x, max(Velocity) FILTER (WHERE Tree = 'T1') AS y FROM readings GROUP BY 1, 2),
pairs AS (SELECT *, CAST(hour(Timestamp) AS INTEGER) AS Hour FROM wide WHERE x IS NOT NULL AND y IS NOT NULL),
dm AS (SELECT *, x - avg(x) OVER (PARTITION BY Cable, Hour) AS dx, y - avg(y) OVER (PARTITION BY Cable, Hour) AS dy FROM pairs),
sl AS (SELECT Cable, sum(dx * dy) / nullif(sum(dx * dx), 0) AS slope, CASE WHEN sum(dx * dx) > 0 THEN 1 ELSE 0 END AS k FROM dm GROUP BY 1)"""


def _neighbours(t: Tables):
    return pivot_series(t.readings_long(), ["T0", "T1"], ("Cable", "Timestamp"))


@query("ols_hour_factor", f"""WITH {READINGS}, {_PIVOT} SELECT p.Cable, Hour, {R('slope')} AS slope, {R('avg(y) - slope * avg(x)')} AS intercept
  FROM pairs p JOIN sl ON sl.Cable = p.Cable GROUP BY p.Cable, Hour, slope""")
def _(t: Tables):
    return rounded(M.ols_hour_factor(_neighbours(t), "T1", "T0", ["Cable"]), "slope", "intercept")


@query("ols_hour_anova", f"""WITH {READINGS}, {_PIVOT},
  res AS (SELECT d.Cable, sum((dy - coalesce(slope, 0) * dx) * (dy - coalesce(slope, 0) * dx)) AS rss, count(*) AS n, count(DISTINCT Hour) AS h, max(k) AS k
    FROM dm d JOIN sl ON sl.Cable = d.Cable GROUP BY 1),
  one AS (SELECT Cable, regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x) AS ssx, regr_syy(y, x) AS tyy FROM pairs GROUP BY 1),
  a AS (SELECT Cable, rss, n - h - k AS dfr, h - 2 + k AS dfh, ssx, tyy - ssx - rss AS ssh FROM res JOIN one USING (Cable)),
  b AS (SELECT *, CASE WHEN dfr > 0 AND rss > 0 THEN rss / dfr END AS ms FROM a)
  SELECT Cable, 'x' AS term, CAST(1 AS BIGINT) AS df, round(ssx, 4) AS sum_sq, round(ssx, 4) AS mean_sq, {R('ssx / ms')} AS f_value FROM b
  UNION ALL SELECT Cable, 'hour', dfh, round(ssh, 4), CASE WHEN dfh > 0 THEN round(ssh / dfh, 4) END, CASE WHEN dfh > 0 THEN {R('ssh / dfh / ms')} END FROM b
  UNION ALL SELECT Cable, 'residuals', dfr, round(rss, 4), CASE WHEN dfr > 0 THEN round(rss / dfr, 4) END, NULL FROM b""")
def _(t: Tables):
    d = rounded(M.hour_factor_anova(_neighbours(t), "T1", "T0", ["Cable"]), "f_value")
    return d.withColumns({"sum_sq": F.round("sum_sq", 4), "mean_sq": F.round("mean_sq", 4)})


_WEATHER = f"{TIER}, {CLIMATE}, {MEANS}, d AS (SELECT t.Tree, Cable, Timestamp, outer_vel AS y, VPD AS p, Wetness AS q, VPD * Wetness AS pq FROM tier t LEFT JOIN means USING (Tree, Timestamp))"
# Regress out one predictor after the other (successive residuals), unlike the Spark side.
_STEPS = """c AS (SELECT * FROM d WHERE y IS NOT NULL AND p IS NOT NULL AND q IS NOT NULL),
m0 AS (SELECT Tree, avg(y) AS my, avg(p) AS mp, avg(q) AS mq, avg(pq) AS mpq FROM c GROUP BY 1),
r0 AS (SELECT c.Tree, y - my AS y, p - mp AS p, q - mq AS q, pq - mpq AS pq FROM c JOIN m0 USING (Tree)),
k1 AS (SELECT Tree, sum(p * q) / sum(p * p) AS q_p, sum(p * pq) / sum(p * p) AS pq_p, sum(p * y) / sum(p * p) AS y_p FROM r0 GROUP BY 1),
r1 AS (SELECT r0.Tree, q - q_p * p AS q, pq - pq_p * p AS pq, y - y_p * p AS y FROM r0 JOIN k1 USING (Tree)),
k2 AS (SELECT Tree, sum(q * pq) / sum(q * q) AS pq_q, sum(q * y) / sum(q * q) AS y_q FROM r1 GROUP BY 1),
r2 AS (SELECT r1.Tree, pq - pq_q * q AS pq, y - y_q * q AS y FROM r1 JOIN k2 USING (Tree)),
k3 AS (SELECT Tree, sum(pq * y) / sum(pq * pq) AS b3 FROM r2 GROUP BY 1),
co AS (SELECT Tree, b3, y_q - b3 * pq_q AS b2, y_p - b3 * pq_p - (y_q - b3 * pq_q) * q_p AS b1, my, mp, mq, mpq FROM k1 JOIN k2 USING (Tree) JOIN k3 USING (Tree) JOIN m0 USING (Tree)),
coef AS (SELECT Tree, my - b1 * mp - b2 * mq - b3 * mpq AS b0, b1, b2, b3 FROM co)"""


def weather_tier(t: Tables):
    return t.tier_wide().select("Tree", "Cable", "Timestamp", "outer_vel").join(station_mean(t.microclimate()), ["Tree", "Timestamp"], "left")


@query("ols_interaction", f"WITH {_WEATHER}, {_STEPS} SELECT Tree, {R('b0')} AS intercept, {R('b1')} AS coef_VPD, {R('b2')} AS coef_Wetness, {R('b3')} AS coef_interaction FROM coef")
def _(t: Tables):
    m = M.ols_interaction(weather_tier(t), "outer_vel", "VPD", "Wetness", ["Tree"])
    return rounded(m, "intercept", "coef_VPD", "coef_Wetness", "coef_interaction")


@query("predict_interaction", f"""WITH {_WEATHER}, {_STEPS} SELECT Tree, Cable, Timestamp, {R('b0 + b1 * p + b2 * q + b3 * pq')} AS pred FROM d JOIN coef USING (Tree)""")
def _(t: Tables):
    d = weather_tier(t)
    out = M.predict_interaction(d, M.ols_interaction(d, "outer_vel", "VPD", "Wetness", ["Tree"]), "VPD", "Wetness", ["Tree"])
    return rounded(out.select("Tree", "Cable", "Timestamp", "pred"), "pred")


@query("train_test_split", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, CASE WHEN CAST('0x' || md5('222|' || Tree || '|' || Cable || '|' || strftime(Timestamp, '%Y-%m-%d %H:%M:%S'))[1:8] AS BIGINT) % 4 < 3
  THEN 'train' ELSE 'test' END AS part FROM tier""")
def _(t: Tables):
    train, test = M.train_test_split(t.tier_wide().select("Tree", "Cable", "Timestamp"), ["Tree", "Cable", "Timestamp"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# What two engines' forests share: which rows get a prediction, and that a mean of targets lies between them.
@query("forest_regress", f"""WITH {TIER}, {CLIMATE}, {MEANS}, d AS (SELECT t.Tree, Cable, Timestamp, outer_vel, Solar, VPD, Wetness FROM tier t LEFT JOIN means USING (Tree, Timestamp)
    WHERE CAST('0x' || md5('222|' || t.Tree || '|' || Cable || '|' || strftime(Timestamp, '%Y-%m-%d %H:%M:%S'))[1:8] AS BIGINT) % 4 = 3)
  SELECT Tree, CAST(count(*) AS BIGINT) AS predicted, true AS inside, true AS fits FROM d WHERE Solar IS NOT NULL AND VPD IS NOT NULL AND Wetness IS NOT NULL GROUP BY 1""")
def _(t: Tables):
    train, test = M.train_test_split(written(weather_tier(t), "weather"), ["Tree", "Cable", "Timestamp"])
    pred = written(M.forest_regress(train, test, "outer_vel", ("Solar", "VPD", "Wetness")), "forest")
    lo, hi = train.agg(F.min("outer_vel")).scalar(), train.agg(F.max("outer_vel")).scalar()
    pred = pred.withColumn("inside", F.col("pred").between(lo - 1e-9, hi + 1e-9))
    facts = pred.groupBy("Tree").agg(F.count(F.lit(1)).alias("predicted"), F.every("inside").alias("inside"))
    r2 = r_squared(pred, "outer_vel", "pred", ["Tree"]).select("Tree", F.col("r2").between(0, 1).alias("fits"))
    return facts.join(r2, "Tree", "left").select("Tree", "predicted", "inside", F.coalesce("fits", F.lit(True)).alias("fits"))
