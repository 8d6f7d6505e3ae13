"""Grids, intervals and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.registry import R, RV, query, r6, rounded
from sensorloom.catalog.views import ACTIONS, CLIMATE, HOUR, HOURLY, INTERVALS, READINGS, TIER, WEEK, ZEROES, Tables
from sensorloom.config import VELOCITIES
from sensorloom.functions.columns import recode_position
from sensorloom.operators import baseline as B
from sensorloom.operators import intervals as I
from sensorloom.operators import joins as J
from sensorloom.operators.aggregates import covariate_mean
from sensorloom.operators.models import gap_fill_simple
from sensorloom.operators.ordered import row_index
from sensorloom.operators.reshape import melt_positions
from sensorloom.operators.series import expand_gaps, segment_ids, small_gaps
from sensorloom.plans.tiers import final_dataset
from sensorloom.session import written

GRID = """grid AS (
  SELECT Tree, Cable, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS Timestamp
  FROM (SELECT Tree, Cable, min(Timestamp) AS lo, max(Timestamp) AS hi FROM tier GROUP BY 1, 2))"""
PERIODS = """starts AS (SELECT Tree, min(Timestamp) AS t0 FROM tier GROUP BY 1),
periods AS (
  SELECT z.*, row_number() OVER (PARTITION BY z.Tree ORDER BY periodBegin) AS grp
  FROM zeroes z JOIN starts s ON s.Tree = z.Tree AND z.periodBegin >= s.t0)"""
SLOTS = """slots AS (SELECT Tree, grp, unnest(generate_series(periodBegin, periodEnd, INTERVAL 1 HOUR)) AS Timestamp FROM periods)"""
BAD = """bad AS (SELECT DISTINCT Tree, Cable, Position, unnest(generate_series("Start", "End", INTERVAL 1 HOUR)) AS Timestamp FROM intervals)"""
LONG = "long AS (" + " UNION ALL ".join(f"SELECT Tree, Cable, Timestamp, '{c}' AS Position, {c} AS Velocity FROM tier" for c in VELOCITIES) + ")"


def spans(df):
    return df.groupBy("Tree", "Cable").agg(F.min("Timestamp").alias("lo"), F.max("Timestamp").alias("hi"))


def tier_grid(df):
    return I.make_grid(spans(df), "lo", "hi", step=HOUR)


@query("make_grid", f"WITH {TIER}, {GRID} SELECT * FROM grid")
def _(t: Tables):
    return tier_grid(t.tier_wide())


@query("grid_left_join", f"WITH {TIER}, {GRID} SELECT Tree, Cable, Timestamp, {RV()} FROM grid LEFT JOIN tier USING (Tree, Cable, Timestamp)")
def _(t: Tables):
    d = t.tier_wide()
    return rounded(I.grid_left_join(tier_grid(d), d), *VELOCITIES)


@query("expand_intervals", f"WITH {INTERVALS}, {BAD} SELECT * FROM bad")
def _(t: Tables):
    return I.expand_intervals(t.intervals(), keep=("Tree", "Cable", "Position"), step=HOUR)


@query("mask_intervals", f"""WITH {TIER}, {INTERVALS}, {BAD}, {LONG}
  SELECT Tree, Cable, Timestamp, Position, CASE WHEN hit IS NULL THEN {R('Velocity')} END AS Velocity,
  CAST(coalesce(hit, 0) AS INTEGER) AS bad_data
  FROM long LEFT JOIN (SELECT *, 1 AS hit FROM bad) USING (Tree, Cable, Position, Timestamp)""")
def _(t: Tables):
    d = I.mask_intervals(melt_positions(t.tier_wide()), t.intervals(), step=HOUR, flag="bad_data")
    return rounded(d, "Velocity")


@query("mask_between", f"""WITH {TIER}, {INTERVALS}, {LONG} SELECT Tree, Cable, Timestamp, Position,
  CASE WHEN EXISTS (SELECT 1 FROM intervals i WHERE i.Tree = l.Tree AND i.Cable = l.Cable AND i.Position = l.Position
    AND l.Timestamp BETWEEN i."Start" + INTERVAL 10 MINUTE AND i."End") THEN NULL ELSE {R('Velocity')} END AS Velocity FROM long l""")
def _(t: Tables):
    off = t.intervals().withColumn("Start", F.col("Start") + F.expr("INTERVAL 10 MINUTES"))
    return rounded(I.mask_intervals(melt_positions(t.tier_wide()), off, align=True, span=WEEK), "Velocity")


@query("mask_wide", f"""WITH {TIER}, {INTERVALS}, {BAD} SELECT Tree, Cable, Timestamp, {', '.join(
    f"CASE WHEN EXISTS (SELECT 1 FROM bad b WHERE b.Tree = t.Tree AND b.Cable = t.Cable AND b.Timestamp = t.Timestamp AND b.Position = '{c}') THEN NULL ELSE {R(c)} END AS {c}"
    for c in VELOCITIES)} FROM tier t""")
def _(t: Tables):
    return rounded(I.mask_wide(t.tier_wide(), t.intervals(), VELOCITIES, step=HOUR), *VELOCITIES)


@query("interval_lookup", f"""WITH {TIER}, {ZEROES}, {PERIODS}, {SLOTS}
  SELECT Tree, Cable, Timestamp, CAST(grp AS BIGINT) AS "Group", {RV()} FROM tier JOIN slots USING (Tree, Timestamp)""")
def _(t: Tables):
    d = t.tier_wide()
    slots = B.expand_periods(B.number_periods(t.zeroes(), d, span=WEEK), HOUR)
    return rounded(J.interval_lookup(d, slots, ("Tree", "Timestamp")), *VELOCITIES)


@query("join_actions", f"""WITH {TIER}, {ACTIONS} SELECT Tree, Cable, Timestamp, {RV()}, Action FROM tier LEFT JOIN actions USING (Tree, Cable, Timestamp)""")
def _(t: Tables):
    return rounded(J.join_actions(t.tier_wide(), t.actions().drop("file_pos")), *VELOCITIES)


@query("join_interval_start", f"""WITH {TIER}, {ZEROES}, {PERIODS} SELECT t.Tree, Cable, Timestamp, CAST(grp AS BIGINT) AS "Group"
  FROM tier t LEFT JOIN periods p ON p.Tree = t.Tree AND p.periodBegin = t.Timestamp""")
def _(t: Tables):
    d = t.tier_wide()
    periods = B.number_periods(t.zeroes(), d, span=WEEK)
    return J.join_interval_start(d.select("Tree", "Cable", "Timestamp"), periods.select("Tree", "periodBegin", "Group"))


# The first row's period does not count, and a period counts only from a row at its begin on.
GROUPED = """firsts AS (SELECT Tree, min(Timestamp) AS t0 FROM full_tier GROUP BY 1),
hits AS (SELECT p.Tree, p.periodBegin, p.grp FROM periods p JOIN firsts f ON f.Tree = p.Tree AND p.periodBegin > f.t0),
grouped AS (
  SELECT t.*, coalesce(h.grp, 0) AS grp0, h.periodBegin AS since
  FROM full_tier t ASOF LEFT JOIN (
    SELECT DISTINCT x.Tree, x.Cable, h.periodBegin, h.grp FROM hits h JOIN full_tier x ON x.Tree = h.Tree AND x.Timestamp = h.periodBegin) h
  ON h.Tree = t.Tree AND h.Cable = t.Cable AND t.Timestamp >= h.periodBegin)"""


@query("asof_group", f"""WITH {TIER}, {ZEROES}, {PERIODS}, full_tier AS (SELECT * FROM tier), {GROUPED}
  SELECT Tree, Cable, Timestamp, CAST(grp0 AS BIGINT) AS "Group" FROM grouped""")
def _(t: Tables):
    d = t.tier_wide()
    periods = written(B.number_periods(t.zeroes(), d, span=WEEK), "periods")
    return B.asof_group(d.select("Tree", "Cable", "Timestamp"), periods, span=WEEK)


@query("join_baseline", f"""WITH {TIER}, g AS (SELECT *, day(Timestamp) AS grp FROM tier),
  m AS (SELECT Tree, Cable, grp, avg(outer_vel) AS o FROM g WHERE grp < 20 GROUP BY 1, 2, 3)
  SELECT Tree, Cable, Timestamp, grp AS "Group", {R('o')} AS baseline_outer FROM g LEFT JOIN m USING (Tree, Cable, grp)""")
def _(t: Tables):
    g = t.tier_wide().withColumn("Group", F.dayofmonth("Timestamp").cast("long"))
    values = g.where("Group < 20").groupBy("Tree", "Cable", "Group").agg(F.avg("outer_vel").alias("baseline_outer"))
    return rounded(B.join_baseline(g.select("Tree", "Cable", "Timestamp", "Group"), values), "baseline_outer")


@query("join_microclimate", f"""WITH {TIER}, {CLIMATE}, mc AS (SELECT Timestamp, avg(Solar) AS Solar, avg(VPD) AS VPD, avg(Wetness) AS Wetness FROM
    (SELECT DISTINCT Timestamp, Solar, VPD, Wetness FROM climate) GROUP BY 1)
  SELECT Tree, Cable, Timestamp, {R('outer_vel')} AS outer_vel, {R('Solar')} AS Solar, {R('VPD')} AS VPD, {R('Wetness')} AS Wetness
  FROM tier LEFT JOIN mc USING (Timestamp)""")
def _(t: Tables):
    cols = ("Solar", "VPD", "Wetness")
    d = J.join_on_time(t.tier_wide().select("Tree", "Cable", "Timestamp", "outer_vel"), covariate_mean(t.microclimate(), cols))
    return rounded(d, "outer_vel", *cols)


# Gaps of the hourly grid per event type.
HOURLY_GRID = """hgrid AS (
  SELECT Cable, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS Timestamp
  FROM (SELECT Cable, min(Timestamp) AS lo, max(Timestamp) AS hi FROM hourly GROUP BY 1)),
hfull AS (SELECT Cable, Timestamp, Velocity, row_number() OVER (PARTITION BY Cable ORDER BY Timestamp) AS i FROM hgrid LEFT JOIN hourly USING (Cable, Timestamp)),
hruns AS (
  SELECT Cable, i - row_number() OVER (PARTITION BY Cable ORDER BY i) AS k, i, Timestamp FROM hfull WHERE Velocity IS NULL),
hgaps AS (
  SELECT Cable, row_number() OVER (PARTITION BY Cable ORDER BY min(Timestamp)) AS gap, min(Timestamp) AS first_missing, max(Timestamp) AS last_missing,
    count(*) AS length, min(i) AS i0, max(i) AS i1 FROM hruns GROUP BY Cable, k)"""
SMALL = """small AS (SELECT Cable, row_number() OVER (PARTITION BY Cable ORDER BY first_missing) AS gap, length,
  first_missing - INTERVAL 1 HOUR AS s, last_missing + INTERVAL 1 HOUR AS e FROM hgaps WHERE length <= 5)"""


def hourly_grid(t: Tables, unit: int = HOUR):
    d = t.series_hourly(unit)
    grid = I.make_grid(d.groupBy("Cable").agg(F.min("Timestamp").alias("lo"), F.max("Timestamp").alias("hi")), "lo", "hi", ("Cable",), unit)
    return I.grid_left_join(grid, d, ("Cable", "Timestamp"))


@query("join_gap_index", f"""WITH {HOURLY}, {HOURLY_GRID} SELECT Cable, CAST(gap AS BIGINT) AS sameSlot, CAST(i1 AS BIGINT) AS "index", last_missing AS Timestamp FROM hgaps""")
def _(t: Tables):
    """The time at the row number on which each missing run ends."""
    d = hourly_grid(t)
    ends = segment_ids(d, ["Cable"], "Velocity", span=WEEK).groupBy("Cable", "sameSlot").agg(F.max("missingLoc").alias("index"))
    return J.join_on_time(ends, row_index(d.select("Cable", "Timestamp"), ["Cable"], "Timestamp", span=WEEK), ("Cable", "index"))


@query("join_gap_rows", f"""WITH {HOURLY}, {HOURLY_GRID}, {SMALL}, rows AS (SELECT Cable, gap, unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS Timestamp FROM small)
  SELECT Cable, Timestamp, {R('Velocity')} AS Velocity, CAST(gap AS BIGINT) AS gap FROM hfull LEFT JOIN rows USING (Cable, Timestamp)""")
def _(t: Tables):
    d = hourly_grid(t)
    gaps = expand_gaps(small_gaps(d, ["Cable"], "Velocity", step=HOUR, span=WEEK), ["Cable"], HOUR)
    return rounded(J.join_on_time(d, gaps, ("Cable", "Timestamp")), "Velocity")


@query("neighbour_join", f"""WITH {TIER} SELECT a.Tree, a.Cable, a.Timestamp, {R('a.outer_vel')} AS outer_vel, {R('b.outer_vel')} AS outer_vel_sib, {R('b.inner_vel')} AS inner_vel_sib
  FROM tier a LEFT JOIN tier b ON b.Tree = a.Tree AND b.Timestamp = a.Timestamp AND b.Cable = a.Cable % 3 + 1""")
def _(t: Tables):
    d = t.tier_wide()
    own = d.select("Tree", "Cable", (F.col("Cable") % 3 + 1).alias("Sibling"), "Timestamp", "outer_vel")
    other = d.withColumnRenamed("Cable", "Sibling")
    out = J.neighbour_join(own, other, ("outer_vel", "inner_vel"), ("Tree", "Sibling", "Timestamp")).drop("Sibling")
    return rounded(out, "outer_vel", "outer_vel_sib", "inner_vel_sib")


_GUIDE = """guide AS (SELECT DISTINCT Tree, Cable, CASE (Cable + CAST(Tree[2:] AS INTEGER)) % 4 WHEN 0 THEN 'outer_vel' WHEN 1 THEN 'middle_vel' WHEN 2 THEN 'inner_vel' ELSE 'None' END AS use,
  CASE WHEN Cable = 1 THEN NULL ELSE TIMESTAMP '2024-01-10 00:00:00' END AS starting FROM tier)"""


def guide(t: Tables):
    """Which depth to use per sensor, and since when."""
    pick = (F.col("Cable") + F.substring("Tree", 2, 9).cast("int")) % 4
    return t.tier_wide().select("Tree", "Cable").distinct().select(
        "Tree", "Cable", F.get(F.array(F.lit("Outer"), F.lit("Middle"), F.lit("Inner"), F.lit("NA")), pick).alias("Use"),
        F.when(F.col("Cable") != 1, F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).alias("Starting"),
    )


@query("guide_join", f"""WITH {TIER}, {LONG}, {_GUIDE} SELECT Tree, Cable, Timestamp, Position, {R('Velocity')} AS Velocity FROM long JOIN guide USING (Tree, Cable)
  WHERE Position = use AND (starting IS NULL OR Timestamp >= starting)""")
def _(t: Tables):
    return rounded(J.guide_join(melt_positions(t.tier_wide()), guide(t).withColumn("Use", recode_position("Use", "None"))), "Velocity")


@query("final_dataset", f"""WITH {TIER}, {LONG}, {_GUIDE} SELECT Tree, Cable, Timestamp, Position, {R('Velocity')} AS Velocity FROM long JOIN guide USING (Tree, Cable)
  WHERE Position = use AND (starting IS NULL OR Timestamp >= starting) AND Timestamp >= TIMESTAMP '2024-01-05 00:00:00'""")
def _(t: Tables):
    return rounded(final_dataset(t.tier_wide(), guide(t), "2024-01-05 00:00:00"), "Velocity")


@query("flag_overlay_join", f"""WITH {TIER}, {LONG}, {ACTIONS} SELECT Tree, Cable, Timestamp, Position, {R('Velocity')} AS Velocity FROM actions JOIN long USING (Tree, Cable, Timestamp)""")
def _(t: Tables):
    return rounded(J.flag_overlay(t.actions(), t.tier_wide(), VELOCITIES), "Velocity")


@query("join_predictions", f"""WITH {TIER}, m AS (SELECT Tree, regr_slope(outer_vel, middle_vel) AS b, regr_intercept(outer_vel, middle_vel) AS a FROM tier GROUP BY 1)
  SELECT Tree, Cable, Timestamp, {R('outer_vel')} AS outer_vel, CASE WHEN outer_vel IS NULL THEN {R('a + b * middle_vel')} END AS ypreds FROM tier JOIN m USING (Tree)""")
def _(t: Tables):
    d = t.tier_wide()
    new = gap_fill_simple(d, "outer_vel", "middle_vel").where("outer_vel IS NULL AND yhat IS NOT NULL")
    new = new.select("Tree", "Cable", "Timestamp", F.col("yhat").alias("ypreds"))
    out = J.join_on_time(d.select("Tree", "Cable", "Timestamp", "outer_vel"), new, ("Tree", "Cable", "Timestamp"))
    return rounded(out, "outer_vel", "ypreds")


@query("semi_time", f"""WITH {READINGS}, {CLIMATE} SELECT Tree, Cable, Timestamp, {R('Velocity')} AS Velocity FROM readings
  WHERE Timestamp IN (SELECT Timestamp FROM climate WHERE Solar > 0)""")
def _(t: Tables):
    return rounded(J.semi_time(t.readings_long(), t.microclimate().where("Solar > 0")), "Velocity")


@query("dimension_join", f"""SELECT c_custkey, n_name, r_name, {R('c_acctbal')} AS c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""")
def _(t: Tables):
    d = t.table("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_acctbal")
    named = t.table("nation").withColumnRenamed("n_regionkey", "r_regionkey").join(t.table("region"), "r_regionkey")
    return J.salted_join(d, named, ["n_nationkey"], "c_custkey", "inner").select("c_custkey", "n_name", "r_name", r6("c_acctbal").alias("c_acctbal"))
