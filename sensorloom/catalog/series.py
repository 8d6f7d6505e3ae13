"""Ordered work: letters, carry-forward, runs, gaps, outliers, zero periods, baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.joined import GRID, GROUPED, HOURLY_GRID, PERIODS, SLOTS, SMALL, hourly_grid, tier_grid
from sensorloom.catalog.registry import R, query, rounded
from sensorloom.catalog.views import ACTIONS, CLIMATE, HOUR, HOURLY, TIER, WEEK, ZEROES, Tables
from sensorloom.config import VELOCITIES, ZeroRule
from sensorloom.functions.columns import cable_number, recode_action, unite
from sensorloom.operators import baseline as B
from sensorloom.operators import series as S
from sensorloom.operators.aggregates import resample, station_mean, summary_table
from sensorloom.operators.intervals import grid_left_join
from sensorloom.operators.ordered import lag_lead, locf, row_index
from sensorloom.operators.outliers import hampel, split_flags
from sensorloom.session import written

DAYS2 = 2 * 86400
KEY = ["Tree", "Cable"]
RULE = ZeroRule(wetness_below=60.0, solar=0.0, vpd_below=60.0, vpd_below_loose=75.0, loose_trees=("T1", "T2"), min_rows=3, step_seconds=HOUR)

EVENTS = """letters AS (
  SELECT Tree, Cable, Timestamp, CASE WHEN Action IN ('M', 'R', 'MR') THEN 'AddOne' ELSE Action END AS Action, file_pos,
    row_number() OVER (PARTITION BY Tree, Cable ORDER BY file_pos) AS n FROM actions WHERE Action IS NOT NULL)"""
LETTERED = """lfirst AS (SELECT Tree, Cable, min(Timestamp) AS t0 FROM src GROUP BY 1, 2),
lettered AS (
  SELECT t.*, coalesce(last_value(CASE WHEN l.n <= 3 AND t.Timestamp > f.t0 THEN l.n END IGNORE NULLS) OVER
    (PARTITION BY t.Tree, t.Cable ORDER BY t.Timestamp ROWS UNBOUNDED PRECEDING), 0) AS no
  FROM src t LEFT JOIN letters l USING (Tree, Cable, Timestamp) JOIN lfirst f USING (Tree, Cable))"""


@query("letter_events", f"""WITH {ACTIONS}, {EVENTS} SELECT Tree, Cable, Timestamp, Action, file_pos, CAST(CASE WHEN n <= 3 THEN n END AS INTEGER) AS letter_no,
  CASE n WHEN 1 THEN 'b' WHEN 2 THEN 'c' WHEN 3 THEN 'd' END AS letter FROM letters""")
def _(t: Tables):
    return S.letter_events(t.actions(), span=1000)


@query("letter_series", f"""WITH {TIER}, {ACTIONS}, {EVENTS}, src AS (SELECT Tree, Cable, Timestamp FROM tier), {LETTERED}
  SELECT Tree, Cable, Timestamp, CAST(no AS INTEGER) AS letter_no, substr('abcd', CAST(no AS INTEGER) + 1, 1) AS letter FROM lettered""")
def _(t: Tables):
    return S.letter_series(t.tier_wide().select("Tree", "Cable", "Timestamp"), S.letter_events(t.actions()))


@query("locf", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, {', '.join(
    f"{R(f'last_value({c} IGNORE NULLS) OVER (PARTITION BY Tree, Cable ORDER BY Timestamp ROWS UNBOUNDED PRECEDING)')} AS {c}" for c in VELOCITIES)} FROM tier""")
def _(t: Tables):
    return rounded(locf(t.tier_wide(), KEY, "Timestamp", VELOCITIES, DAYS2), *VELOCITIES)


def _periods_sql(source: str) -> str:
    return f"""z AS (SELECT Tree, Timestamp, CASE WHEN Timestamp - lag(Timestamp) OVER (PARTITION BY Tree ORDER BY Timestamp) = INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens
  FROM {source} WHERE Wetness < 60 AND Solar = 0 AND VPD < CASE WHEN Tree IN ('T1', 'T2') THEN 75 ELSE 60 END),
zr AS (SELECT *, sum(opens) OVER (PARTITION BY Tree ORDER BY Timestamp) AS k FROM z),
zp AS (SELECT Tree, min(Timestamp) AS periodBegin, max(Timestamp) AS periodEnd FROM zr GROUP BY Tree, k HAVING count(*) >= 3)"""


MEANS = """means AS (SELECT Tree, Timestamp, avg(Solar) AS Solar, avg(VPD) AS VPD, avg(Wetness) AS Wetness FROM climate WHERE Station <> 'S5' GROUP BY 1, 2)"""
ZERO_SQL = f"{CLIMATE}, {MEANS}, {_periods_sql('means')}"
CLIPPED = """clipped AS (
  SELECT Tree, b AS periodBegin, e AS periodEnd FROM (
    SELECT Tree,
      CASE WHEN hour(periodBegin) BETWEEN 6 AND 17 THEN date_trunc('day', periodBegin) + INTERVAL 18 HOUR ELSE periodBegin END AS b,
      CASE WHEN periodEnd > date_trunc('day', periodEnd) + INTERVAL 6 HOUR AND hour(periodEnd) < 18
           THEN date_trunc('day', periodEnd) + INTERVAL 6 HOUR ELSE periodEnd END AS e
    FROM zp) WHERE e - b >= INTERVAL 3 HOUR)"""


@query("zero_periods", f"WITH {ZERO_SQL} SELECT * FROM zp")
def _(t: Tables):
    return B.zero_periods(station_mean(t.microclimate()), RULE, span=DAYS2)


@query("clip_night", f"WITH {ZERO_SQL}, {CLIPPED} SELECT * FROM clipped")
def _(t: Tables):
    return B.clip_night(B.zero_periods(station_mean(t.microclimate()), RULE, span=DAYS2))


@query("number_periods", f"""WITH {TIER}, {ZEROES}, {PERIODS} SELECT Tree, periodBegin, periodEnd, CAST(grp AS BIGINT) AS "Group" FROM periods""")
def _(t: Tables):
    return B.number_periods(t.zeroes(), t.tier_wide(), span=WEEK).drop("dataStart")


def baseline_sql(tier: str, cable: str = "Cable", step: str = "1 HOUR") -> str:
    return f"""bm AS (SELECT t.Tree, t.{cable} AS Cable, s.grp, avg(outer_vel) AS o, avg(middle_vel) AS m, avg(inner_vel) AS i
  FROM {tier} t JOIN slots s USING (Tree, Timestamp) GROUP BY 1, 2, 3),
b0 AS (SELECT Tree, Cable, 0 AS grp, coalesce(o, 0) AS o, coalesce(m, 0) AS m, coalesce(i, 0) AS i FROM
  (SELECT *, row_number() OVER (PARTITION BY Tree, Cable ORDER BY grp) AS rn FROM bm) WHERE rn = 1),
bv AS (SELECT Tree, Cable, grp, {', '.join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY Tree, Cable ORDER BY grp ROWS UNBOUNDED PRECEDING) AS {n}"
       for c, n in (('o', 'bo'), ('m', 'bm'), ('i', 'bi')))} FROM (SELECT * FROM bm UNION ALL SELECT * FROM b0))"""


@query("baseline_values", f"""WITH {TIER}, {ZEROES}, {PERIODS}, {SLOTS}, {baseline_sql('tier')}
  SELECT Tree, Cable, CAST(grp AS BIGINT) AS "Group", {R('bo')} AS baseline_outer, {R('bm')} AS baseline_middle, {R('bi')} AS baseline_inner FROM bv""")
def _(t: Tables):
    d = t.tier_wide()
    periods = written(B.number_periods(t.zeroes(), d, span=WEEK), "periods")
    return rounded(B.baseline_values(d, periods, HOUR, span=5), *B.BASELINES)


BUMPED = """acts AS (SELECT Tree, Cable, Timestamp, max(CASE WHEN Action IN ('M', 'R', 'MR') THEN 1 ELSE 0 END) AS moved FROM actions WHERE Action IS NOT NULL GROUP BY 1, 2, 3),
lastg AS (SELECT Tree, max(grp) AS g FROM periods GROUP BY 1),
bumped AS (
  SELECT g.*, CASE WHEN coalesce(st, 0) = 1 AND grp0 < lastg.g THEN grp0 + 1 ELSE grp0 END AS grp FROM (
    SELECT g.*, last_value(CASE WHEN g.since = g.Timestamp THEN 0 WHEN g.Timestamp > f.t0 THEN a.moved END IGNORE NULLS) OVER
      (PARTITION BY g.Tree, g.Cable ORDER BY g.Timestamp ROWS UNBOUNDED PRECEDING) AS st
    FROM grouped g JOIN firsts f USING (Tree) LEFT JOIN acts a USING (Tree, Cable, Timestamp)) g LEFT JOIN lastg ON lastg.Tree = g.Tree)"""


def _grouped(t: Tables):
    d = t.tier_wide()
    periods = written(B.number_periods(t.zeroes(), d, span=WEEK), "periods")
    acts = t.actions().withColumn("Action", recode_action("Action"))
    return B.bump_group(d.withColumn("cable_no", F.col("Cable")), periods, acts, span=WEEK), periods, d


@query("bump_group", f"""WITH {TIER}, {ACTIONS}, {ZEROES}, {PERIODS}, full_tier AS (SELECT * FROM tier), {GROUPED}, {BUMPED}
  SELECT Tree, Cable, Timestamp, CAST(grp AS BIGINT) AS "Group" FROM bumped""")
def _(t: Tables):
    return _grouped(t)[0].select("Tree", "Cable", "Timestamp", "Group")


# An installation (cable and letter) has its own baselines; the period is that of the cable.
FLAGGED = f"""{EVENTS}, src AS (SELECT * FROM tier), {LETTERED},
  l2 AS (SELECT * REPLACE (Cable || substr('abcd', CAST(no AS INTEGER) + 1, 1) AS Cable), Cable AS cable_no FROM lettered),
  {baseline_sql('l2')},
  joined AS (SELECT l2.*, u.grp, bo, bm, bi FROM l2 JOIN bumped u ON u.Tree = l2.Tree AND u.Cable = l2.cable_no AND u.Timestamp = l2.Timestamp
    LEFT JOIN bv ON bv.Tree = l2.Tree AND bv.Cable = l2.Cable AND bv.grp = u.grp),
  flags AS (SELECT Tree, Cable, Timestamp, CASE WHEN bi IS NULL THEN 'no_bl_val' END AS baseline_inner, CASE WHEN bm IS NULL THEN 'no_bl_val' END AS baseline_middle,
    CASE WHEN bo IS NULL THEN 'no_bl_val' END AS baseline_outer FROM joined)"""


def lettered_tier(t: Tables):
    """The tier with installations told apart, as the outlier filter gets it."""
    d = S.letter_series(t.tier_wide(), S.letter_events(t.actions(), span=1000))
    return d.withColumn("Cable", unite("Cable", "letter")).select("Tree", "Cable", "Timestamp", *VELOCITIES)


@query("baseline_flags", f"""WITH {TIER}, {ACTIONS}, {ZEROES}, {PERIODS}, {SLOTS}, full_tier AS (SELECT * FROM tier), {GROUPED}, {BUMPED}, {FLAGGED}
  SELECT * FROM flags WHERE coalesce(baseline_inner, baseline_middle, baseline_outer) IS NOT NULL""")
def _(t: Tables):
    d = written(lettered_tier(t), "l2")
    periods = written(B.number_periods(t.zeroes(), d, span=WEEK), "periods")
    acts = t.actions().withColumn("Action", recode_action("Action"))
    grouped = B.bump_group(d.withColumn("cable_no", cable_number("Cable")), periods, acts, span=WEEK)
    return B.baseline_flags(B.join_baseline(grouped, B.baseline_values(d, periods, HOUR, span=5), like=d))


def hampel_sql(source: str, keys: str, cols: list[str]) -> str:
    """Full 49-row windows only; missing values do not count."""
    w = f"(PARTITION BY {keys} ORDER BY Timestamp ROWS BETWEEN 24 PRECEDING AND 24 FOLLOWING)"
    lists = ", ".join(f"list_filter(list({c}) OVER {w}, lambda x: x IS NOT NULL) AS w_{c}" for c in cols)
    meds = ", ".join(f"list_aggregate(w_{c}, 'median') AS m_{c}" for c in cols)
    mads = ", ".join(f"1.4826 * list_aggregate(list_transform(w_{c}, lambda x: abs(x - m_{c})), 'median') AS d_{c}" for c in cols)
    odd = ", ".join(f"coalesce(full_rows = 49 AND abs({c} - m_{c}) > 3 * d_{c}, false) AS odd_{c}" for c in cols)
    return f"""hw AS (SELECT *, count(*) OVER {w} AS full_rows, {lists} FROM {source}),
hm AS (SELECT *, {meds} FROM hw), hd AS (SELECT *, {mads} FROM hm), ho AS (SELECT *, {odd} FROM hd)"""


@query("hampel", f"""WITH {TIER}, {hampel_sql('tier', 'Tree, Cable', list(VELOCITIES))}
  SELECT Tree, Cable, Timestamp, {', '.join(f"{R(f'CASE WHEN odd_{c} THEN m_{c} ELSE {c} END')} AS {c}, CASE WHEN odd_{c} THEN 'outlier.Hampel' END AS {c.removesuffix('_vel')}_flag" for c in VELOCITIES)} FROM ho""")
def _(t: Tables):
    return rounded(hampel(t.tier_wide(), span=WEEK, block=256), *VELOCITIES)


@query("hampel_events", f"""WITH e AS (SELECT event_type AS Cable, ts AS Timestamp, value FROM events), {hampel_sql('e', 'Cable', ['value'])}
  SELECT Cable, Timestamp, {R('CASE WHEN odd_value THEN m_value ELSE value END')} AS value, CASE WHEN odd_value THEN 'outlier.Hampel' END AS value_flag FROM ho""")
def _(t: Tables):
    d = t.events.select(F.col("event_type").alias("Cable"), F.col("ts").alias("Timestamp"), "value")
    return rounded(hampel(d, ["Cable"], cols=["value"], span=WEEK, block=1024), "value")


@query("write_flags", f"""WITH {TIER}, {hampel_sql('tier', 'Tree, Cable', list(VELOCITIES))},
  f AS (SELECT Tree, Cable, Timestamp, {', '.join(f"CASE WHEN odd_{c} THEN 'outlier.Hampel' END AS {c.removesuffix('_vel')}_flag" for c in VELOCITIES)} FROM ho)
  SELECT * FROM f WHERE coalesce(outer_flag, middle_flag, inner_flag) IS NOT NULL""")
def _(t: Tables):
    return split_flags(hampel(t.tier_wide(), span=WEEK))[1]


# --- gaps -----------------------------------------------------------------------

@query("run_lengths", f"""WITH {HOURLY}, {HOURLY_GRID} SELECT Cable, CAST(gap AS BIGINT) AS gap, first_missing, last_missing, CAST(length AS BIGINT) AS length FROM hgaps""")
def _(t: Tables):
    return S.run_lengths(hourly_grid(t), ["Cable"], "Velocity", span=DAYS2)


@query("run_lengths_wide", f"""WITH {TIER}, {GRID}, f AS (SELECT Tree, Cable, Timestamp, outer_vel FROM grid LEFT JOIN tier USING (Tree, Cable, Timestamp)),
  n AS (SELECT *, row_number() OVER (PARTITION BY Tree, Cable ORDER BY Timestamp) AS i FROM f),
  m AS (SELECT *, i - row_number() OVER (PARTITION BY Tree, Cable ORDER BY i) AS k FROM n WHERE outer_vel IS NULL)
  SELECT Tree, Cable, row_number() OVER (PARTITION BY Tree, Cable ORDER BY min(Timestamp)) AS gap, min(Timestamp) AS first_missing, max(Timestamp) AS last_missing,
    CAST(count(*) AS BIGINT) AS length FROM m GROUP BY Tree, Cable, k""")
def _(t: Tables):
    d = t.tier_wide()
    return S.run_lengths(grid_left_join(tier_grid(d), d), KEY, "outer_vel", span=DAYS2)


@query("small_gaps", f"""WITH {HOURLY}, {HOURLY_GRID}, {SMALL} SELECT Cable, CAST(gap AS BIGINT) AS gap, CAST(length AS BIGINT) AS length, s AS "Start", e AS "End" FROM small""")
def _(t: Tables):
    return S.small_gaps(hourly_grid(t), ["Cable"], "Velocity", step=HOUR, span=DAYS2)


@query("gap_context", f"""WITH {HOURLY}, {HOURLY_GRID} SELECT f.Cable, CAST(g.gap AS BIGINT) AS gap, CAST(g.length AS BIGINT) AS length, CAST(f.i AS BIGINT) AS "index", f.Timestamp, {R('f.Velocity')} AS Velocity
  FROM hgaps g JOIN hfull f ON f.Cable = g.Cable AND f.i BETWEEN g.i0 - 12 AND g.i1 + 12""")
def _(t: Tables):
    return rounded(S.gap_context(hourly_grid(t), ["Cable"], "Velocity", span=DAYS2), "Velocity")


@query("segment_ids", f"""WITH {HOURLY}, {HOURLY_GRID} SELECT f.Cable, f.Timestamp, CAST(f.i AS BIGINT) AS missingLoc, CAST(g.gap AS BIGINT) AS sameSlot
  FROM hgaps g JOIN hfull f ON f.Cable = g.Cable AND f.i BETWEEN g.i0 AND g.i1""")
def _(t: Tables):
    return S.segment_ids(hourly_grid(t), ["Cable"], "Velocity", span=DAYS2)


@query("impute_single", f"""WITH {HOURLY}, {HOURLY_GRID}, n AS (SELECT f.*, g.length, lag(Velocity) OVER w AS d, lead(Velocity) OVER w AS u
    FROM hfull f LEFT JOIN hgaps g ON f.Cable = g.Cable AND f.i BETWEEN g.i0 AND g.i1 WINDOW w AS (PARTITION BY f.Cable ORDER BY f.i))
  SELECT Cable, Timestamp, {R('Velocity')} AS Velocity, {R('CASE WHEN length = 1 THEN (d + u) / 2 ELSE Velocity END')} AS imputedY,
  CAST(CASE WHEN length = 1 THEN 1 ELSE 0 END AS INTEGER) AS imputed FROM n""")
def _(t: Tables):
    return rounded(S.impute_single(hourly_grid(t), ["Cable"], span=DAYS2), "Velocity", "imputedY")


@query("interpolate_small", f"""WITH {HOURLY}, {HOURLY_GRID}, n AS (SELECT f.*, g.length, g.i0, g.i1 FROM hfull f LEFT JOIN hgaps g ON f.Cable = g.Cable AND f.i BETWEEN g.i0 AND g.i1),
  j AS (SELECT n.*, a.Velocity AS v0, b.Velocity AS v1 FROM n LEFT JOIN hfull a ON a.Cable = n.Cable AND a.i = n.i0 - 1 LEFT JOIN hfull b ON b.Cable = n.Cable AND b.i = n.i1 + 1)
  SELECT Cable, Timestamp, {R('Velocity')} AS Velocity, {R('CASE WHEN length <= 5 AND v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (i - i0 + 1) / (i1 - i0 + 2) ELSE Velocity END')} AS filled,
  CAST(CASE WHEN length <= 5 AND v0 IS NOT NULL AND v1 IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS interpolated FROM j""")
def _(t: Tables):
    return rounded(S.interpolate_small(hourly_grid(t), ["Cable"], span=DAYS2), "Velocity", "filled")


@query("lag_lead", """SELECT conv_id, turn, role, lag(role) OVER w AS down1, lead(role) OVER w AS up1 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)""")
def _(t: Tables):
    d = t.table("conversations").select("conv_id", "turn", "role", "text")
    return lag_lead(d, ["conv_id"], ["turn", "role", "text"], "role", span=4).drop("text")


@query("row_index", """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS "index" FROM events""")
def _(t: Tables):
    return row_index(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], span=WEEK).drop("ts")


@query("flagship_summary", f"""WITH {HOURLY}, {HOURLY_GRID}, n AS (SELECT f.*, g.length, lag(Velocity) OVER w AS d, lead(Velocity) OVER w AS u
    FROM hfull f LEFT JOIN hgaps g ON f.Cable = g.Cable AND f.i BETWEEN g.i0 AND g.i1 WINDOW w AS (PARTITION BY f.Cable ORDER BY f.i)),
  p AS (SELECT Cable, date_trunc('day', Timestamp) AS Timestamp, avg(CASE WHEN length = 1 THEN (d + u) / 2 ELSE Velocity END) AS v FROM n GROUP BY 1, 2)
  SELECT Cable, 'imputedY' AS measure, {R('min(v)')} AS min, {R('avg(v)')} AS mean, {R('max(v)')} AS max, {R('sum(v)')} AS total, {R('max(v) - min(v)')} AS Change FROM p GROUP BY 1""")
def _(t: Tables):
    return flagship(t)


def flagship(t: Tables, unit: int = HOUR):
    """Grid, single gaps filled, daily means, summary per series."""
    filled = S.impute_single(hourly_grid(t, unit), ["Cable"], span=WEEK)
    daily = resample(filled, "day", ("imputedY",), ("Cable",))
    return rounded(summary_table(daily, ("imputedY",), ("Cable",)), "min", "mean", "max", "total", "Change")
