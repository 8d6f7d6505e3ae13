"""From port temperatures to velocities, and the baseline arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.registry import R, query, r6, rounded
from sensorloom.catalog.views import PORT_ROWS, TIER, WIRED, Tables
from sensorloom.config import VELOCITIES
from sensorloom.operators import ports as P
from sensorloom.operators.aggregates import battery_rate
from sensorloom.operators.baseline import subtract_baseline
from sensorloom.operators.reshape import union_all

_IN = "CASE WHEN {c} BETWEEN 5 AND 30 THEN {c} END"
DELTAS = f"""raw_deltas AS (
  SELECT *, {_IN.format(c='after')} - {_IN.format(c='base')} AS d0 FROM wired),
deltas AS (SELECT *, CASE WHEN d0 BETWEEN 0.05 AND 3 THEN d0 END AS delta FROM raw_deltas)"""
# Depth 0, 1, 2 = outer, middle, inner: place 0..2 over place 3..5.
RATIOS = """ratios AS (
  SELECT Tree, Cable, Timestamp,
    max(delta) FILTER (WHERE place = 0) / nullif(max(delta) FILTER (WHERE place = 3), 0) AS r_outer,
    max(delta) FILTER (WHERE place = 1) / nullif(max(delta) FILTER (WHERE place = 4), 0) AS r_middle,
    max(delta) FILTER (WHERE place = 2) / nullif(max(delta) FILTER (WHERE place = 5), 0) AS r_inner
  FROM deltas GROUP BY 1, 2, 3)"""


def vel(c: str) -> str:
    return f"CASE WHEN {c} > 0 THEN 0.0019 / 0.5 * 3600 * ln({c}) END"


VELOCITY = f"""velocity AS (
  SELECT Tree, Cable, Timestamp, {vel('r_outer')} AS outer_vel, {vel('r_middle')} AS middle_vel, {vel('r_inner')} AS inner_vel FROM ratios)"""


@query("pulse_delta", f"""WITH {PORT_ROWS}, p AS (SELECT *, {_IN.format(c='after')} - {_IN.format(c='base')} AS d FROM ports)
  SELECT Tree, Timestamp, port, CASE WHEN d BETWEEN 0.05 AND 3 THEN {R('d')} END AS delta FROM p""")
def _(t: Tables):
    d = P.pulse_delta(P.ports_as_arrays(t.ports_wide())).select("Tree", "Timestamp", F.posexplode("delta").alias("pos", "delta"))
    return d.select("Tree", "Timestamp", (F.col("pos") + 1).alias("port"), r6("delta").alias("delta"))


@query("probe_ratio", f"""WITH {PORT_ROWS}, {WIRED}, {DELTAS}, {RATIOS}
  SELECT Tree, Cable, Timestamp, {R('r_outer')} AS outer, {R('r_middle')} AS middle, {R('r_inner')} AS inner FROM ratios""")
def _(t: Tables):
    wired = t.ports().drop("vec_id").join(P.wiring_map(t.station_info()), "Tree")
    d = P.wiring_to_ports(P.pulse_delta(wired).select("Tree", "Timestamp", "wiring", "delta"))
    return rounded(P.probe_ratio(d), "outer", "middle", "inner")


@query("heat_velocity", f"""WITH {PORT_ROWS}, {WIRED}, {DELTAS}, {RATIOS}, {VELOCITY}
  SELECT Tree, Cable, Timestamp, {R('outer_vel')} AS outer_vel, {R('middle_vel')} AS middle_vel, {R('inner_vel')} AS inner_vel FROM velocity""")
def _(t: Tables):
    return rounded(P.cable_velocities(t.ports(), t.station_info()), *VELOCITIES)


@query("stack_cables", f"""WITH {PORT_ROWS}, {WIRED}, {DELTAS}, {RATIOS}, {VELOCITY} SELECT Tree, Cable, CAST(count(*) AS BIGINT) AS rows,
  {R('sum(outer_vel)')} AS outer_total, {R('min(middle_vel)')} AS middle_low, {R('max(inner_vel)')} AS inner_high FROM velocity GROUP BY 1, 2""")
def _(t: Tables):
    d = P.cable_velocities(t.ports(), t.station_info())
    facts = d.groupBy("Tree", "Cable").agg(
        F.count("Timestamp").alias("rows"), F.sum("outer_vel").alias("outer_total"), F.min("middle_vel").alias("middle_low"), F.max("inner_vel").alias("inner_high"))
    return rounded(facts, "outer_total", "middle_low", "inner_high")


_PROBES = " UNION ALL ".join(
    f"SELECT Tree, Cable, '{p}' AS Placement, Timestamp, '{kind}' AS type, "
    + ", ".join(f"{R(f'max({c}) FILTER (WHERE place = {o + i})')} AS \"{n}\"" for i, n in enumerate(("Outer", "Middle", "Inner")))
    + " FROM wired GROUP BY Tree, Cable, Timestamp"
    for p, o in (("U", 0), ("L", 3)) for kind, c in (("Base.temp", "base"), ("After.pulse", "after"))
)


@query("before_after_probe", f"WITH {PORT_ROWS}, {WIRED} {_PROBES}")
def _(t: Tables):
    return rounded(P.before_after_probe(t.ports(), t.station_info()), "Outer", "Middle", "Inner")


@query("subtract_baseline", f"""WITH {TIER}, m AS (SELECT Tree, Cable, min(outer_vel) AS o, min(middle_vel) FILTER (WHERE Cable <> 2) AS m, min(inner_vel) AS i FROM tier GROUP BY 1, 2)
  SELECT Tree, Cable, Timestamp, {R('outer_vel - coalesce(o, 0)')} AS outer_vel, {R('middle_vel - coalesce(m, 0)')} AS middle_vel,
  {R('inner_vel - coalesce(i, 0)')} AS inner_vel FROM tier JOIN m USING (Tree, Cable)""")
def _(t: Tables):
    d = t.tier_wide()
    lows = d.groupBy("Tree", "Cable").agg(
        F.min("outer_vel").alias("baseline_outer"), F.min(F.when(F.col("Cable") != 2, F.col("middle_vel"))).alias("baseline_middle"), F.min("inner_vel").alias("baseline_inner")
    )
    return rounded(subtract_baseline(d.join(lows, ["Tree", "Cable"])), *VELOCITIES)


@query("battery_rate", f"""WITH {PORT_ROWS}, v AS (SELECT Tree, Timestamp, max(CASE WHEN vec_id % 11 = 0 THEN 0.0 ELSE after END) FILTER (WHERE port = 2) AS v FROM ports GROUP BY 1, 2),
  x AS (SELECT Tree, (epoch(max(Timestamp)) - epoch(min(Timestamp))) / 86400.0 AS days, max(v) - min(v) AS dv FROM v
    WHERE Timestamp >= TIMESTAMP '2024-01-02 00:00:00' GROUP BY 1)
  SELECT Tree, {R('days')} AS days, {R('dv / nullif(days / 7, 0)')} AS volts_per_week FROM x""")
def _(t: Tables):
    return rounded(battery_rate(t.ports_wide(), "2024-01-02 00:00:00"), "days", "volts_per_week")


@query("select_ports_both", f"""WITH {PORT_ROWS} SELECT Tree, Timestamp, 'Base.temp' AS type, {R('sum(base)')} AS total FROM ports GROUP BY 1, 2
  UNION ALL SELECT Tree, Timestamp, 'After.pulse', {R('sum(after)')} FROM ports GROUP BY 1, 2""")
def _(t: Tables):
    wide = t.ports_wide()
    both = union_all(
        P.select_ports(wide, "wood_temperature", "Base.temp", keep=("Tree",)), P.select_ports(wide, "after_heat", "After.pulse", keep=("Tree",))
    )
    total = F.aggregate(F.array(*[f"Port{i}" for i in range(1, 65)]), F.lit(0.0), lambda a, x: a + x)
    return both.select("Tree", "Timestamp", "type", r6(total).alias("total"))
