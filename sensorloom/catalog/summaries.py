"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.registry import R, query, r6, rounded
from sensorloom.catalog.views import CLIMATE, TIER, ZEROES, Tables
from sensorloom.catalog.joined import HOUR, PERIODS, SLOTS
from sensorloom.config import VELOCITIES
from sensorloom.operators import aggregates as A
from sensorloom.operators import baseline as B
from sensorloom.operators.filters import duplicated_rows
from sensorloom.operators.models import gap_fill_simple

_WEATHER = ("Solar", "VPD", "Wetness")
_SUNDAY = "date_trunc('week', Timestamp + INTERVAL 1 DAY) - INTERVAL 1 DAY"


@query("station_mean", f"""WITH {CLIMATE} SELECT Tree, Timestamp, {', '.join(f"{R(f'avg({c})')} AS {c}" for c in _WEATHER)}
  FROM climate WHERE Station <> 'S5' GROUP BY 1, 2""")
def _(t: Tables):
    return rounded(A.station_mean(t.microclimate()), *_WEATHER)


@query("covariate_mean", f"""WITH {CLIMATE} SELECT Timestamp, {', '.join(f"{R(f'avg({c})')} AS {c}" for c in _WEATHER)}
  FROM (SELECT DISTINCT Timestamp, Solar, VPD, Wetness FROM climate) GROUP BY 1""")
def _(t: Tables):
    return rounded(A.covariate_mean(t.microclimate(), _WEATHER), *_WEATHER)


@query("window_means", f"""WITH {TIER}, {ZEROES}, {PERIODS}, {SLOTS} SELECT Tree, Cable, CAST(grp AS BIGINT) AS "Group",
  {', '.join(f"{R(f'avg({c})')} AS {c}" for c in VELOCITIES)} FROM tier JOIN slots USING (Tree, Timestamp) GROUP BY Tree, Cable, grp""")
def _(t: Tables):
    d = t.tier_wide()
    slots = B.expand_periods(B.number_periods(t.zeroes(), d), HOUR)
    return rounded(A.window_means(d.join(slots, ["Tree", "Timestamp"])), *VELOCITIES)


_UNITS = {"15min": "Timestamp", "hour": "date_trunc('hour', Timestamp)", "day": "date_trunc('day', Timestamp)", "week": _SUNDAY}


@query("resample", f"WITH {TIER} " + " UNION ALL ".join(
    f"SELECT Tree, Cable, CAST({e} AS TIMESTAMP) AS Timestamp, '{u}' AS unit, {', '.join(f'{R(f'avg({c})')} AS {c}' for c in VELOCITIES)} FROM tier GROUP BY 1, 2, 3"
    for u, e in _UNITS.items()))
def _(t: Tables):
    d, out = t.tier_wide(), None
    for unit in _UNITS:
        part = A.resample(d, unit).withColumn("unit", F.lit(unit))
        out = part if out is None else out.unionByName(part)
    return rounded(out, *VELOCITIES)


@query("resample_shipments", f"""SELECT l_returnflag AS flag, CAST(date_trunc('week', l_shipdate + INTERVAL 1 DAY) - INTERVAL 1 DAY AS TIMESTAMP) AS l_shipdate,
  {R('avg(l_quantity)')} AS l_quantity, {R('avg(l_extendedprice)')} AS l_extendedprice FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    d = t.table("lineitem").withColumnRenamed("l_returnflag", "flag")
    return rounded(A.resample(d, "week", ("l_quantity", "l_extendedprice"), ("flag",), "l_shipdate"), "l_quantity", "l_extendedprice")


@query("summary_table", " UNION ALL ".join(
    f"SELECT l_returnflag, l_linestatus, '{c}' AS measure, {R(f'min({c})')} AS min, {R(f'avg({c})')} AS mean, {R(f'max({c})')} AS max, "
    f"round(sum({c}), 2) AS total, {R(f'max({c}) - min({c})')} AS Change FROM lineitem GROUP BY 1, 2" for c in ("l_quantity", "l_discount", "l_extendedprice")))
def _(t: Tables):
    d = A.summary_table(t.table("lineitem"), ("l_quantity", "l_discount", "l_extendedprice"), ("l_returnflag", "l_linestatus"))
    return rounded(d, "min", "mean", "max", "Change").withColumn("total", F.round("total", 2))


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t: Tables):
    return A.duplicate_keys(t.table("lineitem"), ("l_orderkey", "l_linenumber"))


@query("duplicated_rows", """SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn > 1""")
def _(t: Tables):
    return duplicated_rows(t.events.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


@query("extent", """SELECT 'T' || (user_id % 4) AS Tree, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1""")
def _(t: Tables):
    return A.extent(t.events.withColumn("Tree", F.concat(F.lit("T"), F.col("user_id") % 4)), time="ts")


@query("distinct_rows", """SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem""")
def _(t: Tables):
    return t.table("lineitem").select("l_orderkey", "l_linenumber").distinct()


_PROBS = (0.0, 0.33, 0.66, 1.0)


@query("quantile_breaks", f"""WITH q AS (SELECT event_type, quantile_cont(epoch_us(ts) / 1000000.0, [0, 0.33, 0.66, 1.0]) AS q, quantile_cont(value, [0.05, 0.95]) AS l,
    (max(value) - min(value)) * 0.05 AS margin FROM events GROUP BY 1)
  SELECT event_type, round(q[1], 3) AS t0, round(q[2], 3) AS t33, round(q[3], 3) AS t66, round(q[4], 3) AS t100, {R('l[1]')} AS lo, {R('l[2]')} AS hi, {R('margin')} AS margin FROM q""")
def _(t: Tables):
    d = t.events.select("event_type", (F.unix_timestamp("ts") + F.date_format("ts", "SSSSSS").cast("double") / 1e6).alias("at"), "value")
    # Both columns at once, as two rows.
    long = d.select("event_type", F.explode(F.array(F.struct(F.lit("at").alias("col"), F.col("at").alias("v")), F.struct(F.lit("value").alias("col"), F.col("value").alias("v")))).alias("r")).select("event_type", "r.*")
    q = A.quantiles(long, "v", (*_PROBS, 0.05, 0.95), ["event_type", "col"])
    pick = lambda col, p: F.max(F.when((F.col("col") == col) & (F.col("prob") == p), F.col("value")))
    return q.groupBy("event_type").agg(
        *[F.round(pick("at", p), 3).alias(n) for p, n in zip(_PROBS, ("t0", "t33", "t66", "t100"))],
        r6(pick("value", 0.05)).alias("lo"), r6(pick("value", 0.95)).alias("hi"), r6((pick("value", 1.0) - pick("value", 0.0)) * 0.05).alias("margin"))


@query("quantiles_of_copies", f"""SELECT l_returnflag, CAST(q.p AS DOUBLE) AS prob, {R('v')} AS value FROM (
    SELECT l_returnflag, unnest([0.1, 0.5, 0.9]) AS p, unnest(quantile_cont(l_quantity, [0.1, 0.5, 0.9])) AS v FROM lineitem GROUP BY 1) q""")
def _(t: Tables):
    return rounded(A.quantiles(t.table("lineitem"), "l_quantity", (0.1, 0.5, 0.9), ["l_returnflag"], accuracy=500), "value")


@query("trim_percentile", f"""WITH {TIER}, b AS (SELECT Tree, {', '.join(f"quantile_cont({c}, 0.005) AS lo_{c}, quantile_cont({c}, 0.995) AS hi_{c}" for c in VELOCITIES)} FROM tier GROUP BY 1)
  SELECT Tree, Cable, Timestamp, {', '.join(f"CASE WHEN {c} BETWEEN lo_{c} AND hi_{c} THEN {R(c)} END AS {c}" for c in VELOCITIES)} FROM tier JOIN b USING (Tree)""")
def _(t: Tables):
    return rounded(A.trim_percentile(t.tier_wide(), 0.005, 0.995), *VELOCITIES)


@query("pairwise_corr", f"""WITH {TIER} SELECT Tree, 'middle_vel' AS Sensor, {R('corr(outer_vel, middle_vel)')} AS corr, CAST(regr_count(outer_vel, middle_vel) AS BIGINT) AS pairs FROM tier GROUP BY 1
  UNION ALL SELECT Tree, 'inner_vel', {R('corr(outer_vel, inner_vel)')}, CAST(regr_count(outer_vel, inner_vel) AS BIGINT) FROM tier GROUP BY 1""")
def _(t: Tables):
    return rounded(A.pairwise_corr(t.tier_wide(), "outer_vel", ("middle_vel", "inner_vel"), ["Tree"]), "corr")


_CORRS = f"""c AS (SELECT Tree, Cable, 'middle_vel' AS Sensor, corr(outer_vel, middle_vel) AS corr FROM tier GROUP BY 1, 2
  UNION ALL SELECT Tree, Cable, 'inner_vel', corr(outer_vel, inner_vel) FROM tier GROUP BY 1, 2)"""


@query("best_neighbour", f"""WITH {TIER}, {_CORRS}
  SELECT Tree, Cable, 'signed' AS kind, Sensor, {R('corr')} AS corr FROM (SELECT *, row_number() OVER (PARTITION BY Tree, Cable ORDER BY corr DESC, Sensor) AS rn FROM c WHERE corr IS NOT NULL AND NOT isnan(corr)) WHERE rn = 1
  UNION ALL SELECT Tree, Cable, 'absolute', Sensor, {R('corr')} FROM (SELECT *, row_number() OVER (PARTITION BY Tree, Cable ORDER BY abs(corr) DESC, Sensor) AS rn FROM c WHERE corr IS NOT NULL AND NOT isnan(corr)) WHERE rn = 1""")
def _(t: Tables):
    corrs = A.pairwise_corr(t.tier_wide(), "outer_vel", ("middle_vel", "inner_vel"), ["Tree", "Cable"])
    out = A.best_neighbour(corrs, ["Tree", "Cable"]).withColumn("kind", F.lit("signed"))
    return rounded(out.unionByName(A.best_neighbour(corrs, ["Tree", "Cable"], absolute=True).withColumn("kind", F.lit("absolute"))), "corr")


@query("missing_counts", f"""WITH {TIER} SELECT Tree, CAST(count(*) AS BIGINT) AS rows, {', '.join(f'CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}_missing' for c in VELOCITIES)} FROM tier GROUP BY 1""")
def _(t: Tables):
    return A.missing_counts(t.tier_wide(), VELOCITIES, ["Tree"])


@query("r_squared", f"""WITH {TIER}, m AS (SELECT Tree, regr_slope(outer_vel, middle_vel) AS b, regr_intercept(outer_vel, middle_vel) AS a FROM tier GROUP BY 1)
  SELECT Tree, {R('pow(corr(outer_vel, a + b * middle_vel), 2)')} AS r2 FROM tier JOIN m USING (Tree) GROUP BY 1""")
def _(t: Tables):
    d = gap_fill_simple(t.tier_wide(), "outer_vel", "middle_vel")
    return rounded(A.r_squared(d, "outer_vel", "yhat", ["Tree"]), "r2")
