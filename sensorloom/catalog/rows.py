"""Projections, filters, orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.registry import R, RV, query, r6, rounded
from sensorloom.catalog.views import ACTIONS, CLIMATE, HOURLY, INTERVALS, PORT_ROWS, READINGS, TIER, ZEROES, Tables
from sensorloom.config import BASE_PREFIX, VELOCITIES
from sensorloom.functions import columns as C
from sensorloom.operators import filters as X
from sensorloom.operators.intervals import mask_dormancy
from sensorloom.operators.joins import drop_listed
from sensorloom.operators.ports import select_ports, wired_cables, wired_probes, wiring_map, wiring_to_ports

_START, _END = "2024-01-05 00:00:00", "2024-01-12 12:00:00"


@query("select_ports", f"""WITH {PORT_ROWS}
  SELECT Tree, Timestamp, port, {R('base')} AS temperature, 'Base.temp' AS type FROM ports""")
def _(t: Tables):
    wide = select_ports(t.ports_wide(), BASE_PREFIX, "Base.temp", keep=("Tree",))
    ports = [f"Port{i}" for i in range(1, 65)]
    long = wide.unpivot(["Tree", "Timestamp", "type"], ports, "name", "temperature")
    return long.select("Tree", "Timestamp", F.substring("name", 5, 2).cast("int").alias("port"), r6("temperature").alias("temperature"), "type")


@query("null_outside", f"""WITH {TIER}
  SELECT Tree, Cable, Timestamp, {', '.join(f"CASE WHEN {c} BETWEEN 10 AND 90 THEN {R(c)} END AS {c}" for c in VELOCITIES)} FROM tier""")
def _(t: Tables):
    return rounded(C.apply_across(t.tier_wide(), VELOCITIES, lambda c: C.null_outside(c, 10, 90)), *VELOCITIES)


@query("apply_across", """SELECT l_orderkey, l_linenumber, l_quantity * 2 AS l_quantity, l_extendedprice * 2 AS l_extendedprice,
  l_discount * 2 AS l_discount, l_tax * 2 AS l_tax FROM lineitem""")
def _(t: Tables):
    d = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return C.apply_across(d, C.numeric_columns(d, exclude=("l_orderkey", "l_linenumber")), lambda c: c * 2)


@query("drop_all_null_cols", """SELECT 'E' || label AS Tree, CAST(c AS INTEGER) AS Cable, CAST(6 * c - 5 AS INTEGER) AS start
  FROM (SELECT DISTINCT label FROM embeddings), (SELECT unnest(range(1, 9)) AS c) WHERE NOT (c = 8 AND label % 2 = 1)""")
def _(t: Tables):
    return wired_cables(t.station_info())


@query("probe_keys", """SELECT 'E' || label AS Tree, CAST(c AS INTEGER) AS Cable, p AS Placement, c || p AS probe,
  CAST(6 * c - 5 + CASE p WHEN 'U' THEN 0 ELSE 3 END AS INTEGER) AS start
  FROM (SELECT DISTINCT label FROM embeddings), (SELECT unnest(range(1, 9)) AS c), (SELECT unnest(['U', 'L']) AS p)
  WHERE NOT (c = 8 AND label % 2 = 1)""")
def _(t: Tables):
    return wired_probes(t.station_info())


@query("wiring_to_ports", f"""SELECT 'E' || label AS Tree, vec_id, CAST(c AS INTEGER) AS Cable, CAST(k AS INTEGER) AS place,
  {R('15 + 40 * CAST(embedding[6 * c - 6 + k] AS DOUBLE)')} AS base
  FROM embeddings, (SELECT unnest(range(1, 9)) AS c), (SELECT unnest(range(1, 7)) AS k) WHERE NOT (c = 8 AND label % 2 = 1)""")
def _(t: Tables):
    wired = t.ports().select("Tree", "vec_id", "base").join(wiring_map(t.station_info()), "Tree")
    d = wiring_to_ports(wired, ("base",))
    d = d.select("Tree", "vec_id", "Cable", F.posexplode("base").alias("pos", "base"))
    return d.select("Tree", "vec_id", "Cable", (F.col("pos") + 1).alias("place"), r6("base").alias("base"))


@query("recode_action", f"""WITH {ACTIONS}, a AS (SELECT *, CASE WHEN file_pos % 7 = 0 THEN NULL ELSE Action END AS act FROM actions)
  SELECT Tree, Cable, Timestamp, CASE WHEN act IN ('M', 'R', 'MR') THEN 'AddOne' ELSE act END AS Action FROM a WHERE act IS NOT NULL""")
def _(t: Tables):
    d = t.actions().withColumn("Action", F.when(F.col("file_pos") % 7 != 0, F.col("Action")))
    return d.withColumn("Action", C.recode_action("Action")).where(F.col("Action").isNotNull()).drop("file_pos")


@query("recode_position", """SELECT event_id, CASE event_type WHEN 'click' THEN 'outer_vel' WHEN 'view' THEN 'middle_vel'
  WHEN 'purchase' THEN 'inner_vel' WHEN 'signup' THEN 'None' END AS Use FROM events""")
def _(t: Tables):
    names = {"click": "Outer", "view": "Middle", "purchase": "Inner", "signup": "NA"}
    return t.events.select("event_id", C.recode_position(C.mapped("event_type", names), "None").alias("Use"))


@query("classify_note", """SELECT p_partkey, CASE WHEN contains(p_name, 'red') AND contains(p_name, 'ing') THEN 'MR'
  WHEN contains(p_name, 'red') THEN 'M' WHEN contains(p_name, 'ing') THEN 'R' END AS action FROM part""")
def _(t: Tables):
    return t.table("part").select("p_partkey", C.classify_note("p_name", "red", "ing").alias("action"))


@query("replace_null", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, {R('coalesce(outer_vel, 0)')} AS outer_vel,
  {R('coalesce(middle_vel, -1)')} AS middle_vel, {R('inner_vel')} AS inner_vel FROM tier""")
def _(t: Tables):
    return rounded(t.tier_wide().fillna({"outer_vel": 0.0, "middle_vel": -1.0}), *VELOCITIES)


@query("null_where", f"""WITH {TIER} SELECT Tree, Cable, Timestamp,
  CASE WHEN coalesce(middle_vel > 50, false) THEN NULL ELSE {R('outer_vel')} END AS outer_vel FROM tier""")
def _(t: Tables):
    d = t.tier_wide().withColumn("outer_vel", C.null_where("outer_vel", F.col("middle_vel") > 50))
    return rounded(d.select("Tree", "Cable", "Timestamp", "outer_vel"), "outer_vel")


@query("filter_date_range", f"""SELECT event_id, ts, value, 'closed' AS kind FROM events WHERE ts BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'
  UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice, 'half open' FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'""")
def _(t: Tables):
    a = X.filter_date_range(t.events.select("event_id", "ts", "value"), _START, _END, "ts").withColumn("kind", F.lit("closed"))
    o = t.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    b = X.filter_date_range(o, "1997-01-01 00:00:00", "1997-02-01 00:00:00", "o_orderdate", half_open=True)
    return a.union(b.withColumn("kind", F.lit("half open")))


@query("recent_window", """SELECT event_id, ts FROM events, (SELECT max(ts) AS m FROM events)
  WHERE ts >= m - INTERVAL 11 DAY AND ts < m - INTERVAL 1 DAY""")
def _(t: Tables):
    return X.recent_window(t.events.select("event_id", "ts"), 1, 10, "ts")


@query("filter_cable_prefix", f"""WITH {HOURLY} SELECT Cable, Timestamp, {R('Velocity')} AS Velocity FROM hourly WHERE Cable[1] = 'c'
  UNION ALL SELECT Cable, Timestamp, {R('Velocity')} FROM hourly WHERE contains(Cable, 'ie')""")
def _(t: Tables):
    d = t.series_hourly()
    return rounded(X.filter_cable_prefix(d, "c").union(d.where(F.col("Cable").contains("ie"))), "Velocity")


@query("filter_equals", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier WHERE Tree IN ('T0', 'T2') AND Cable = 2""")
def _(t: Tables):
    return rounded(t.tier_wide().where(F.col("Tree").isin("T0", "T2") & (F.col("Cable") == 2)), *VELOCITIES)


@query("filter_not_null", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()}, 'any' AS kind FROM tier
  WHERE outer_vel IS NOT NULL AND middle_vel IS NOT NULL AND inner_vel IS NOT NULL
  UNION ALL SELECT Tree, Cable, Timestamp, {RV()}, 'outer' FROM tier WHERE outer_vel IS NOT NULL""")
def _(t: Tables):
    d = rounded(t.tier_wide(), *VELOCITIES)
    return d.dropna("any").withColumn("kind", F.lit("any")).union(d.dropna(subset=["outer_vel"]).withColumn("kind", F.lit("outer")))


@query("drop_known_issues", f"""WITH {ZEROES}, firsts AS (SELECT Tree, min(periodBegin) AS periodBegin FROM zeroes GROUP BY 1)
  SELECT * FROM zeroes z WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.Tree = z.Tree AND f.periodBegin = z.periodBegin)""")
def _(t: Tables):
    z = t.zeroes()
    return drop_listed(z, z.groupBy("Tree").agg(F.min("periodBegin").alias("periodBegin")), ("Tree", "periodBegin"))


@query("quality_voltage", """SELECT vec_id, 'nonzero' AS kind FROM embeddings WHERE vec_id % 11 <> 0
    AND 15 + 40 * CAST(embedding[2] AS DOUBLE) + 8 * abs(CAST(embedding[2] AS DOUBLE)) <> 0
  UNION ALL SELECT vec_id, 'above' FROM embeddings WHERE vec_id % 11 <> 0
    AND 15 + 40 * CAST(embedding[2] AS DOUBLE) + 8 * abs(CAST(embedding[2] AS DOUBLE)) > 12""")
def _(t: Tables):
    d = t.ports_wide().select(F.col("Record_Number").alias("vec_id"), "Big_Battery_Voltage")
    a = X.quality_voltage(d).select("vec_id", F.lit("nonzero").alias("kind"))
    return a.union(X.quality_voltage(d, above=12.0).select("vec_id", F.lit("above").alias("kind")))


@query("mask_dormancy", f"""WITH {TIER}, {INTERVALS}
  SELECT DISTINCT Tree, Cable, Timestamp, CASE WHEN EXISTS (SELECT 1 FROM intervals i WHERE i.Tree = t.Tree AND i.Cable = t.Cable
    AND t.Timestamp BETWEEN i."Start" AND i."End") THEN NULL ELSE {R('outer_vel')} END AS outer_vel FROM tier t""")
def _(t: Tables):
    d = t.tier_wide().select("Tree", "Cable", "Timestamp", "outer_vel")
    return rounded(mask_dormancy(d, t.intervals(), start="Start", end="End", span=7 * 86400), "outer_vel")


@query("any_flag_filter", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, CASE WHEN outer_vel > 200 THEN 'high' END AS outer_flag,
  CASE WHEN middle_vel > 200 THEN 'high' END AS middle_flag FROM tier WHERE outer_vel > 200 OR middle_vel > 200""")
def _(t: Tables):
    d = t.tier_wide().select(
        "Tree", "Cable", "Timestamp", F.when(F.col("outer_vel") > 200, "high").alias("outer_flag"), F.when(F.col("middle_vel") > 200, "high").alias("middle_flag")
    )
    return X.any_flag_filter(d, "outer_flag", "middle_flag")


@query("all_missing_flag", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, CAST(CASE WHEN outer_vel IS NULL AND middle_vel IS NULL
  AND inner_vel IS NULL THEN 1 ELSE 0 END AS INTEGER) AS allMissing FROM tier""")
def _(t: Tables):
    return t.tier_wide().select("Tree", "Cable", "Timestamp", C.all_missing(*VELOCITIES).alias("allMissing"))


@query("reorder_rename_drop", """SELECT c_nationkey AS nation, c_custkey AS "key", c_name AS name FROM customer""")
def _(t: Tables):
    d = t.table("customer").drop("c_acctbal", "c_mktsegment").withColumnsRenamed({"c_custkey": "key", "c_name": "name", "c_nationkey": "nation"})
    return d.select("nation", "key", "name")


# --- order and top-k ----------------------------------------------------------

@query("sort_tier", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier
  ORDER BY outer_vel NULLS LAST, Tree, Cable, Timestamp""")
def _(t: Tables):
    return X.sort_tier(rounded(t.tier_wide(), *VELOCITIES), "outer_vel", "Tree", "Cable", "Timestamp")


@query("last_k", """SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-25 00:00:00') WHERE rn <= 5""")
def _(t: Tables):
    return X.last_k(t.events.select("user_id", "event_id", "ts"), 5, ["user_id"], ["ts", "event_id"], "2024-01-25 00:00:00")


@query("head_tail", """(SELECT event_id, ts, 'head' AS part FROM events ORDER BY ts, event_id LIMIT 6)
  UNION ALL (SELECT event_id, ts, 'tail' FROM events ORDER BY ts DESC, event_id DESC LIMIT 6)""")
def _(t: Tables):
    head, tail = X.head_tail(t.events.select("event_id", "ts"), ["ts", "event_id"])
    return head.withColumn("part", F.lit("head")).union(tail.withColumn("part", F.lit("tail")))


@query("nearest_point", f"""WITH {READINGS} SELECT Tree, Cable, Timestamp, {R('Velocity')} AS Velocity FROM readings
  WHERE Velocity IS NOT NULL ORDER BY sqrt(pow((epoch(Timestamp) - epoch(TIMESTAMP '2024-01-15 06:30:00')) / 3600.0, 2) + pow(Velocity - 70, 2)),
  Tree, Cable, Timestamp LIMIT 1""")
def _(t: Tables):
    d = X.nearest_point(t.readings_long(), "2024-01-15 06:30:00", 70.0, per_second=1 / 3600, ties=("Tree", "Cable", "Timestamp"))
    return rounded(d, "Velocity")


@query("box_select", f"""WITH {READINGS} SELECT Tree, Cable, Timestamp, {R('Velocity')} AS Velocity FROM readings
  WHERE Timestamp BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}' AND Velocity BETWEEN 20 AND 60""")
def _(t: Tables):
    return rounded(X.box_select(t.readings_long(), _START, _END, 20, 60), "Velocity")


@query("group_min_filter", f"""WITH {CLIMATE} SELECT Tree, Station, Timestamp, {R('VPD')} AS VPD FROM
  (SELECT *, min(Timestamp) OVER (PARTITION BY Tree, Station) AS least FROM climate) WHERE Timestamp = least""")
def _(t: Tables):
    d = t.microclimate().select("Tree", "Station", "Timestamp", "VPD")
    return rounded(X.group_min_filter(d, ["Tree", "Station"], "Timestamp", "Timestamp"), "VPD")
