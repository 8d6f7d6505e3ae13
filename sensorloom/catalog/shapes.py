"""Reshaping and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.registry import R, RV, query, r6, rounded
from sensorloom.catalog.views import HOURLY, INTERVALS, READINGS, TIER, Tables
from sensorloom.config import VELOCITIES
from sensorloom.functions import columns as C
from sensorloom.operators import reshape as S
from sensorloom.operators.aggregates import summary_table
from sensorloom.operators.ports import ports_as_arrays, pulse_delta

_MELT = " UNION ALL ".join(f"SELECT Tree, Cable, Timestamp, '{c}' AS Position, {R(c)} AS Velocity FROM tier" for c in VELOCITIES)


@query("melt_positions", f"WITH {TIER} {_MELT}")
def _(t: Tables):
    return rounded(S.melt_positions(t.tier_wide()), "Velocity")


@query("cast_positions", f"WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier")
def _(t: Tables):
    return rounded(S.cast_positions(S.melt_positions(t.tier_wide())), *VELOCITIES)


@query("pivot_series", f"""WITH {READINGS} SELECT Cable, Timestamp, {', '.join(f"{R(f'max(Velocity) FILTER (WHERE Tree = {chr(39)}T{i}{chr(39)})')} AS T{i}" for i in range(4))}
  FROM readings GROUP BY 1, 2""")
def _(t: Tables):
    trees = ["T0", "T1", "T2", "T3"]
    return rounded(S.pivot_series(t.readings_long(), trees, ("Cable", "Timestamp")), *trees)


def _marks(t: Tables):
    """Bad windows as a sheet has them: one mark column per cable and depth."""
    names = {"Outer": "outer_vel", "Middle": "middle_vel", "Inner": "inner_vel"}
    return t.intervals().select("Tree", "Start", "End", *[
        F.when((F.col("Cable") == i) & (F.col("Position") == v), "x").alias(f"Cable{i}_{k}") for i in range(1, 9) for k, v in names.items()
    ])


@query("melt_bad_windows", f"""WITH {INTERVALS} SELECT Tree, Cable, Position, "Start", "End" FROM intervals""")
def _(t: Tables):
    return S.melt_bad_windows(_marks(t))


# One visit per day of a month; every event counts for the visit of its day.
NOTE_DATES = [f"2024-01-{day:02d} x" for day in range(1, 32)]


@query("melt_date_columns", """WITH s AS (SELECT 'T' || (user_id % 4) AS Tree, CAST(1 + event_id % 9 AS INTEGER) AS c, day(ts) AS dy, count(*) AS n
    FROM events GROUP BY 1, 2, 3)
  SELECT Tree, CAST(c AS VARCHAR) AS Cable, make_timestamp(2024, 1, dy, 10, 0, 0) AS Timestamp, 'n' || n || ';seen' AS Action FROM s WHERE c <= 8""")
def _(t: Tables):
    return S.melt_date_columns(note_sheet(t), NOTE_DATES)


def note_sheet(t: Tables):
    """A maintenance sheet: parts down, visit dates across, notes in the cells."""
    d = t.events
    part = F.concat(F.lit("Cable "), (1 + F.col("event_id") % 9).cast("string"))
    count = lambda day: F.count_if(F.dayofmonth("ts") == day)
    return d.groupBy(F.concat(F.lit("T"), F.col("user_id") % 4).alias("Tree"), part.alias("Part")).agg(*[
        F.when(count(int(name[8:10])) > 0, F.concat(F.lit("n"), count(int(name[8:10])), F.lit(";seen"))).alias(name) for name in NOTE_DATES
    ])


@query("split_column", """SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_brand, '#', 2) AS brand_no,
  p_type[1:1] AS head, p_type[2:] AS rest FROM part""")
def _(t: Tables):
    head, rest = C.split_at("p_type", 1)
    return t.table("part").select("p_partkey", C.first_piece("p_name", " ").alias("first"), F.split("p_brand", "#").getItem(1).alias("brand_no"), head.alias("head"), rest.alias("rest"))


@query("unite_columns", f"""WITH {TIER} SELECT DISTINCT Tree, Cable || 'a' AS lettered, 'Cable' || Cable AS name, 'outer_vel' || '_C' || Cable AS suffixed FROM tier""")
def _(t: Tables):
    return t.tier_wide().select(
        "Tree", C.unite("Cable", F.lit("a")).alias("lettered"), C.unite(F.lit("Cable"), "Cable").alias("name"),
        C.unite(F.lit("outer_vel"), C.unite(F.lit("C"), "Cable"), sep="_").alias("suffixed"),
    ).distinct()


_SUMMARY = " UNION ALL ".join(
    f"SELECT Tree, Cable, '{c}' AS measure, {R(f'min({c})')} AS min, {R(f'avg({c})')} AS mean, {R(f'max({c})')} AS max, "
    f"{R(f'sum({c})')} AS total, {R(f'max({c}) - min({c})')} AS Change FROM tier GROUP BY 1, 2" for c in VELOCITIES
)


@query("melt_summary", f"WITH {TIER} {_SUMMARY}")
def _(t: Tables):
    return rounded(summary_table(t.tier_wide()), "min", "mean", "max", "total", "Change")


@query("melt_corr_row", f"""WITH c AS (SELECT corr(l_extendedprice, l_quantity) AS l_quantity, corr(l_extendedprice, l_discount) AS l_discount,
    corr(l_extendedprice, l_tax) AS l_tax FROM lineitem)
  SELECT 'l_quantity' AS Sensor, {R('l_quantity')} AS corr FROM c UNION ALL SELECT 'l_discount', {R('l_discount')} FROM c
  UNION ALL SELECT 'l_tax', {R('l_tax')} FROM c""")
def _(t: Tables):
    names = ("l_quantity", "l_discount", "l_tax")
    row = t.table("lineitem").agg(*[F.corr("l_extendedprice", c).alias(c) for c in names])
    return rounded(S.melt_corr_row(row, names), "corr")


@query("nest_groups", f"""WITH {HOURLY}, n AS (SELECT Cable, CAST(Timestamp AS DATE) AS day, list(Velocity ORDER BY Timestamp) AS v FROM hourly GROUP BY 1, 2)
  SELECT Cable, day, CAST(len(v) AS BIGINT) AS n, {R('list_max(v) - list_min(v)')} AS spread, {R('v[1]')} AS first, {R('v[len(v)]')} AS last FROM n""")
def _(t: Tables):
    """The rows of a group as one array, worked on and given back as facts of the array; a day bounds its size."""
    d = t.series_hourly().groupBy("Cable", F.to_date("Timestamp").alias("day")).agg(F.array_sort(F.collect_list(F.struct("Timestamp", "Velocity"))).alias("rows"))
    v = F.col("rows.Velocity")
    return d.select("Cable", "day", F.size("rows").cast("long").alias("n"), r6(F.array_max(v) - F.array_min(v)).alias("spread"), r6(F.get(v, F.lit(0))).alias("first"), r6(F.element_at(v, -1)).alias("last"))


@query("row_aligned_bind", f"""SELECT vec_id, CAST(i AS INTEGER) AS port, {R('8 * abs(CAST(embedding[i] AS DOUBLE))')} AS rise
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i)""")
def _(t: Tables):
    d = pulse_delta(ports_as_arrays(t.ports_wide(), keep=("Record_Number",)), limits=None)
    d = d.select(F.col("Record_Number").alias("vec_id"), F.posexplode("delta").alias("pos", "rise"))
    return d.select("vec_id", (F.col("pos") + 1).alias("port"), r6("rise").alias("rise"))


# --- stacking -------------------------------------------------------------------

@query("union_all", """SELECT c_custkey AS "key", c_name AS name, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def _(t: Tables):
    c = t.table("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = t.table("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return S.union_all(c, s)


@query("union_distinct", """SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier""")
def _(t: Tables):
    return S.union_distinct(t.table("customer").select(F.col("c_nationkey").alias("nation")), t.table("supplier").select(F.col("s_nationkey").alias("nation")))


@query("sheet_union", """SELECT event_id, user_id, value, CASE event_type WHEN 'click' THEN 'ET' WHEN 'view' THEN 'FB' WHEN 'error' THEN 'TV' WHEN 'signup' THEN 'FC' ELSE 'TR' END AS sheet
  FROM events""")
def _(t: Tables):
    d = t.events.select("event_id", "user_id", "value", "event_type")
    sheets = {"ET": "click", "FB": "view", "TV": "error", "FC": "signup", "TR": "purchase"}
    return S.sheet_union({k: d.where(F.col("event_type") == v).drop("event_type") for k, v in sheets.items()}, "sheet")
