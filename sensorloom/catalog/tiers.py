"""Whole tiers and the dashboard behind one name each."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.domain import DELTAS, RATIOS, VELOCITY
from sensorloom.catalog.joined import BAD, GROUPED, HOUR, SLOTS
from sensorloom.catalog.registry import R, RV, query, rounded
from sensorloom.catalog.series import BUMPED, CLIPPED, EVENTS, FLAGGED, LETTERED, RULE, ZERO_SQL, hampel_sql, lettered_tier
from sensorloom.catalog.shapes import NOTE_DATES, note_sheet
from sensorloom.catalog.sources import FOLDER_KEY, LINES, line_facts, LINE_COLS, logger_files
from sensorloom.catalog.views import ACTIONS, INTERVALS, PORT_ROWS, TIER, WEEK, WIRED, Tables
from sensorloom.config import VELOCITIES
from sensorloom.functions.columns import path_key
from sensorloom.operators.outliers import split_flags
from sensorloom.plans import tiers as P
from sensorloom.plans.dashboard import dashboard_view
from sensorloom.session import scratch_dir, written
from sensorloom.sources.tiers import export_slice

_OLD_LOG = """old_log AS (SELECT Tree, max(Timestamp) AS last_import FROM lines WHERE Record_Number < 200 AND Tree <> 'ET3' GROUP BY 1)"""


def _import(t: Tables):
    """An import that is run twice, as after a failure, with the log of before."""
    known = t.ports().where("vec_id < 200").select(F.concat(F.lit("ET"), F.substring("Tree", 2, 9)).alias("Tree"), "Timestamp")
    log = known.where("Tree <> 'ET3'").groupBy("Tree").agg(F.max("Timestamp").alias("last_import"))
    raw = scratch_dir(t.spark, "raw")
    files = logger_files(t)
    P.import_raw(t.spark, files, log, raw, path_key("path", FOLDER_KEY))
    return raw, *P.import_raw(t.spark, files, log, raw, path_key("path", FOLDER_KEY))


@query("tier_raw", f"""WITH {LINES}, {_OLD_LOG} SELECT {LINE_COLS} FROM lines LEFT JOIN old_log USING (Tree) WHERE last_import IS NULL OR Timestamp > last_import""")
def _(t: Tables):
    return line_facts(t.spark.read.parquet(_import(t)[0]))


@query("tier_raw_log", f"WITH {LINES} SELECT Tree, max(Timestamp) AS last_import FROM lines GROUP BY 1")
def _(t: Tables):
    return _import(t)[1]


@query("tier_raw_report", f"""WITH {LINES}, {_OLD_LOG}, b AS (SELECT Tree, last_import, count(*) FILTER (WHERE last_import IS NULL OR Timestamp > last_import) AS n,
    min(Timestamp) FILTER (WHERE last_import IS NULL OR Timestamp > last_import) AS first FROM lines LEFT JOIN old_log USING (Tree) GROUP BY 1, 2)
  SELECT Tree, CAST(n AS BIGINT) AS rows, CAST(0 AS BIGINT) AS duplicates, round((epoch(first) - epoch(last_import)) / 86400.0, 1) AS missing_days,
    CASE WHEN n = 0 THEN 'no import needed' WHEN last_import IS NULL THEN 'new series' ELSE 'imported' END AS status FROM b""")
def _(t: Tables):
    return _import(t)[2]


_L1_GRID = """spans AS (SELECT Tree, min(Timestamp) AS lo, max(Timestamp) AS hi FROM ports GROUP BY 1),
cables AS (SELECT DISTINCT Tree, Cable FROM wired),
l1 AS (SELECT g.Tree, g.Cable, g.Timestamp, outer_vel, middle_vel, inner_vel FROM
  (SELECT Tree, Cable, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS Timestamp FROM spans JOIN cables USING (Tree)) g
  LEFT JOIN velocity USING (Tree, Cable, Timestamp))"""


@query("tier_l1", f"""WITH {PORT_ROWS}, {WIRED}, {DELTAS}, {RATIOS}, {VELOCITY}, {_L1_GRID} SELECT Tree, Cable, Timestamp, {RV()} FROM l1""")
def _(t: Tables):
    """Built in two increments: a first tier from the early records, then the rest on top of it."""
    ports, station = t.ports().drop("vec_id"), t.station_info()
    early = F.col("Timestamp") <= F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    return rounded(P.build_l1(ports, station, P.build_l1(ports.where(early), station)), *VELOCITIES)


_L2 = f"""{TIER}, {ACTIONS}, {INTERVALS}, {BAD}, {EVENTS}, src AS (SELECT Tree, Cable, Timestamp, {', '.join(
    f"CASE WHEN EXISTS (SELECT 1 FROM bad b WHERE b.Tree = t.Tree AND b.Cable = t.Cable AND b.Timestamp = t.Timestamp AND b.Position = '{c}') THEN NULL ELSE {c} END AS {c}"
    for c in VELOCITIES)} FROM tier t), {LETTERED},
  named AS (SELECT * REPLACE (Cable || substr('abcd', CAST(no AS INTEGER) + 1, 1) AS Cable) FROM lettered), {hampel_sql('named', 'Tree, Cable', list(VELOCITIES))}"""
_FLAG = ", ".join(f"CASE WHEN odd_{c} THEN 'outlier.Hampel' END AS {c.removesuffix('_vel')}_flag" for c in VELOCITIES)


def _l2(t: Tables):
    return P.build_l2(t.tier_wide(), t.intervals(), t.actions(), step=HOUR, gridded=False, span=WEEK, block=512)


@query("tier_l2", f"""WITH {_L2} SELECT Tree, Cable, Timestamp, {', '.join(f"{R(f'CASE WHEN odd_{c} THEN m_{c} ELSE {c} END')} AS {c}" for c in VELOCITIES)} FROM ho""")
def _(t: Tables):
    return rounded(split_flags(_l2(t))[0], *VELOCITIES)


@query("tier_l2_flags", f"""WITH {_L2}, f AS (SELECT Tree, Cable, Timestamp, {_FLAG} FROM ho) SELECT * FROM f WHERE coalesce(outer_flag, middle_flag, inner_flag) IS NOT NULL""")
def _(t: Tables):
    return split_flags(_l2(t))[1]


@query("tier_zeroes", f"WITH {ZERO_SQL}, {CLIPPED} SELECT * FROM clipped")
def _(t: Tables):
    return P.build_zeroes(t.microclimate(), RULE, span=WEEK)


# The first period of each tree is on the exclusion list.
_L3 = f"""{TIER}, {ACTIONS}, {ZERO_SQL}, {CLIPPED},
  zeroes AS (SELECT * FROM clipped c WHERE periodBegin > (SELECT min(periodBegin) FROM clipped x WHERE x.Tree = c.Tree)),
  full_tier AS (SELECT * FROM tier WHERE Tree IN (SELECT Tree FROM clipped)), starts AS (SELECT Tree, min(Timestamp) AS t0 FROM full_tier GROUP BY 1),
  periods AS (SELECT z.*, row_number() OVER (PARTITION BY z.Tree ORDER BY periodBegin) AS grp FROM zeroes z JOIN starts s ON s.Tree = z.Tree AND z.periodBegin >= s.t0),
  {SLOTS}, {GROUPED}, {BUMPED}, {FLAGGED}"""


def _l3(t: Tables):
    zeroes = written(P.build_zeroes(t.microclimate(), RULE, span=WEEK), "zeroes")
    excluded = zeroes.groupBy("Tree").agg(F.min("periodBegin").alias("periodBegin"))
    return P.build_l3(written(lettered_tier(t), "l2"), zeroes, t.actions(), excluded, HOUR, WEEK)


@query("tier_l3", f"""WITH {_L3} SELECT Tree, Cable, Timestamp, {R('outer_vel - coalesce(bo, 0)')} AS outer_vel, {R('middle_vel - coalesce(bm, 0)')} AS middle_vel,
  {R('inner_vel - coalesce(bi, 0)')} AS inner_vel FROM joined""")
def _(t: Tables):
    return rounded(_l3(t)[0], *VELOCITIES)


@query("tier_l3_flags", f"WITH {_L3} SELECT * FROM flags WHERE coalesce(baseline_inner, baseline_middle, baseline_outer) IS NOT NULL")
def _(t: Tables):
    return _l3(t)[1]


@query("maintenance_table", """WITH s AS (SELECT 'T' || (user_id % 4) AS Tree, CAST(1 + event_id % 9 AS INTEGER) AS c, day(ts) AS dy, count(*) AS n
    FROM events GROUP BY 1, 2, 3)
  SELECT Tree, CAST(c AS VARCHAR) AS Cable, make_timestamp(2024, 1, dy, 10, 0, 0) AS Timestamp, 'n' || n AS Action FROM s WHERE c <= 8""")
def _(t: Tables):
    return P.maintenance_table(note_sheet(t), NOTE_DATES)


_RECENT = """newest AS (SELECT max(Timestamp) AS m FROM ports),
recent AS (SELECT wired.* FROM wired, newest WHERE vec_id % 11 <> 0 AND Timestamp >= m - INTERVAL 4 DAY AND Timestamp < m - INTERVAL 1 DAY)"""


@query("diagnostic_velocity", f"""WITH {PORT_ROWS}, {WIRED}, {_RECENT}, deltas AS (SELECT *, after - base AS delta FROM recent), {RATIOS}, {VELOCITY}
  SELECT Tree, Cable, Timestamp, {RV()} FROM velocity""")
def _(t: Tables):
    return rounded(P.diagnostic_tables(t.ports_wide(), t.station_info(), 1, 3)[1], *VELOCITIES)


@query("diagnostic_probes", f"""WITH {PORT_ROWS}, {WIRED}, {_RECENT} """ + " UNION ALL ".join(
    f"SELECT Tree, Cable, '{p}' AS Placement, Timestamp, '{kind}' AS type, "
    + ", ".join(f"{R(f'max({c}) FILTER (WHERE place = {o + i})')} AS \"{n}\"" for i, n in enumerate(("Outer", "Middle", "Inner")))
    + " FROM recent GROUP BY Tree, Cable, Timestamp" for p, o in (("U", 0), ("L", 3)) for kind, c in (("Base.temp", "base"), ("After.pulse", "after"))))
def _(t: Tables):
    return rounded(P.diagnostic_tables(t.ports_wide(), t.station_info(), 1, 3)[0], "Outer", "Middle", "Inner")


_SLICE = f"""{TIER}, s AS (SELECT Tree, Cable, date_trunc('day', Timestamp) AS Timestamp, avg(outer_vel) AS outer_vel, avg(middle_vel) AS middle_vel, avg(inner_vel) AS inner_vel
  FROM tier WHERE Tree = 'T1' AND Cable = 2 AND Timestamp BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1, 2, 3)"""


def _view(t: Tables):
    return dashboard_view(t.tier_wide(), "T1", "2", "2024-01-03 00:00:00", "2024-01-24 00:00:00", "day")


@query("dashboard_slice", f"WITH {_SLICE} " + " UNION ALL ".join(
    f"SELECT Tree, Cable, CAST(Timestamp AS TIMESTAMP) AS Timestamp, '{c}' AS Position, {R(c)} AS Velocity FROM s" for c in VELOCITIES))
def _(t: Tables):
    return rounded(_view(t).long, "Velocity")


@query("dashboard_summary", f"WITH {_SLICE} " + " UNION ALL ".join(
    f"SELECT Tree, Cable, '{c}' AS measure, {R(f'min({c})')} AS min, {R(f'avg({c})')} AS mean, {R(f'max({c})')} AS max, {R(f'sum({c})')} AS total, "
    f"{R(f'max({c}) - min({c})')} AS Change FROM s GROUP BY 1, 2" for c in VELOCITIES))
def _(t: Tables):
    return rounded(_view(t).summary, "min", "mean", "max", "total", "Change")


_STYLES = {"head": "strftime(Timestamp, '%Y-%m-%dT%H:%M:%SZ')", "tail": "strftime(Timestamp, '%Y-%m-%dT%H:%M:%SZ')", "iso": "strftime(Timestamp, '%Y-%m-%dT%H:%M:%SZ')", "text": "strftime(Timestamp, '%Y-%m-%d')"}


@query("dashboard_tables", f"WITH {_SLICE}, n AS (SELECT *, row_number() OVER (ORDER BY Timestamp) AS a, row_number() OVER (ORDER BY Timestamp DESC) AS z FROM s) " + " UNION ALL ".join(
    f"SELECT Tree, Cable, {style} AS Timestamp, {RV()}, '{name}' AS part FROM n" + {"head": " WHERE a <= 6", "tail": " WHERE z <= 6"}.get(name, "") for name, style in _STYLES.items()))
def _(t: Tables):
    """First and last rows of a view, and both of its exports."""
    v = _view(t)
    parts = {"head": export_slice(v.head), "tail": export_slice(v.tail), "iso": v.iso, "text": v.text}
    out = None
    for name, d in parts.items():
        d = d.withColumn("part", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return rounded(out, *VELOCITIES)


@query("backfill", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, CASE WHEN Tree = 'T2' AND Timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'
    THEN {R('outer_vel * 2')} ELSE {R('outer_vel')} END AS outer_vel, {R('middle_vel')} AS middle_vel, {R('inner_vel')} AS inner_vel FROM tier""")
def _(t: Tables):
    """Five days of a tree arrive late; they are processed anew, which doubles a value, and put in their place."""
    d = t.tier_wide()
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 00:00:00", "2024-01-15 00:00:00"))
    late = (F.col("Tree") == "T2") & F.col("Timestamp").between(lo, hi)
    log = d.groupBy("Tree").agg(F.max("Timestamp").alias("last_import"))
    double = lambda rows, points: rows.withColumn("outer_vel", F.col("outer_vel") * 2)
    return rounded(P.backfill(d.where(~late), d.where(~late), d.where(late), log, double, step=HOUR)[0], *VELOCITIES)
