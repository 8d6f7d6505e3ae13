"""The given tables in the roles of sensor tables, in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.config import AFTER_PREFIX, BASE_PREFIX, PORTS
from sensorloom.functions.columns import floor_time, shift

HOUR = 3600
# Pieces of a week, so that on a month of data the borders between pieces count.
WEEK = 7 * 86400
CABLE_OF = {"click": 1, "view": 2, "purchase": 3, "signup": 4, "error": 5}


class Tables:
    """Lazily read tables of one folder and the views on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def _hour(self) -> Column:
        return floor_time(self.events, "ts", "hour")

    def readings_long(self) -> DataFrame:
        """(Tree, Cable, Timestamp, Velocity), hourly, with long gaps."""
        return self.events.groupBy(
            _tree().alias("Tree"), cable_of_type().alias("Cable"), self._hour().alias("Timestamp")
        ).agg(F.avg("value").alias("Velocity"))

    def series_hourly(self, unit: int = HOUR) -> DataFrame:
        """(Cable, Timestamp, Velocity), one series per event type."""
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        slot = shift(epoch, F.floor(F.unix_timestamp("ts") / F.lit(unit)) * F.lit(unit))
        return self.events.groupBy(F.col("event_type").alias("Cable"), slot.alias("Timestamp")).agg(F.avg("value").alias("Velocity"))

    def tier_wide(self) -> DataFrame:
        """(Tree, Cable, Timestamp, outer_vel, middle_vel, inner_vel)."""
        def mean(kind: str) -> Column:
            return F.avg(F.when(F.col("event_type") == kind, F.col("value")))
        return self.events.groupBy(_tree().alias("Tree"), _cable().alias("Cable"), self._hour().alias("Timestamp")).agg(
            mean("click").alias("outer_vel"), mean("view").alias("middle_vel"), mean("purchase").alias("inner_vel")
        )

    def microclimate(self) -> DataFrame:
        """(Tree, Station, Timestamp, Solar, VPD, Wetness); Solar counts large errors and is mostly 0."""
        bright = (F.col("event_type") == "error") & (F.col("value") > 200)
        return self.events.groupBy(
            _tree().alias("Tree"), F.concat(F.lit("S"), F.col("user_id") % 6).alias("Station"), self._hour().alias("Timestamp")
        ).agg(
            F.count_if(bright).cast("double").alias("Solar"), F.avg("value").alias("VPD"),
            F.avg(F.when(F.col("event_type").isin("click", "view"), F.col("value"))).alias("Wetness"),
        )

    def actions(self) -> DataFrame:
        """(Tree, Cable, Timestamp, Action, file_pos), one action per sensor and hour."""
        codes = F.array(*[F.lit(c) for c in ("M", "R", "MR", "H", "W")])
        action = F.get(codes, (F.col("user_id") % 5).cast("int"))
        d = self.events.where((F.col("event_type") == "error") & (F.col("value") > 200))
        return d.groupBy(_tree().alias("Tree"), _cable().alias("Cable"), self._hour().alias("Timestamp")).agg(
            F.min_by(action, F.col("event_id")).alias("Action"), F.min("event_id").alias("file_pos")
        )

    def intervals(self) -> DataFrame:
        """(Tree, Cable, Position, Start, End), six hours each, overlapping."""
        d = self.events.where((F.col("event_type") == "error") & (F.col("value") > 80))
        positions = F.array(F.lit("outer_vel"), F.lit("middle_vel"), F.lit("inner_vel"))
        return d.select(
            _tree().alias("Tree"), _cable().alias("Cable"), F.get(positions, (F.col("event_id") % 3).cast("int")).alias("Position"),
            self._hour().alias("Start"), shift(self._hour(), 6 * HOUR).alias("End"),
        )

    def zeroes(self) -> DataFrame:
        """(periodBegin, periodEnd, Tree): hours of large purchases and the four hours after them."""
        d = self.events.where((F.col("event_type") == "purchase") & (F.col("value") > 150))
        return d.select(self._hour().alias("periodBegin"), shift(self._hour(), 4 * HOUR).alias("periodEnd"), _tree().alias("Tree")).distinct()

    def import_log(self) -> DataFrame:
        """(Tree, last_import) of the trees T0..T2, from the first twenty days."""
        limit = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
        d = self.events.where((F.col("ts") < limit) & (F.col("user_id") % 4 != 3))
        return d.groupBy(_tree().alias("Tree")).agg(F.max("ts").alias("last_import"))

    def records(self) -> DataFrame:
        """(Tree, Timestamp, value) raw records to the minute; several may share a minute."""
        return self.events.select(_tree().alias("Tree"), floor_time(self.events, "ts", "minute").alias("Timestamp"), "event_id", "value")

    def ports(self) -> DataFrame:
        """(Tree, Timestamp, base, after): 64 port temperatures before and after a pulse."""
        d = self.table("embeddings")
        start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        return d.select(
            F.concat(F.lit("E"), F.col("label")).alias("Tree"), shift(start, F.col("vec_id") * 900).alias("Timestamp"),
            F.transform("embedding", lambda e: 15 + 40 * e.cast("double")).alias("base"),
            F.transform("embedding", lambda e: 15 + 40 * e.cast("double") + 8 * F.abs(e.cast("double"))).alias("after"),
            "vec_id",
        )

    def ports_wide(self) -> DataFrame:
        """The port temperatures as a logger writes them: one column per port, and housekeeping."""
        d = self.ports()
        return d.select(
            "Tree", "Timestamp", F.col("vec_id").alias("Record_Number"),
            F.get("base", F.lit(0)).alias("Panel_Temperature"),
            F.when(F.col("vec_id") % 11 == 0, 0.0).otherwise(F.get("after", F.lit(1))).alias("Big_Battery_Voltage"),
            F.get("base", F.lit(2)).alias("Small_Battery_Voltage"),
            *[F.get("base", F.lit(i)).alias(f"{BASE_PREFIX}_Avg_{i + 1}") for i in range(PORTS)],
            *[F.get("after", F.lit(i)).alias(f"{AFTER_PREFIX}_Avg_{i + 1}") for i in range(PORTS)],
        )

    def station_info(self) -> DataFrame:
        """(Tree, Cable1..Cable8); cable 8 is not wired on odd trees."""
        d = self.table("embeddings").select("label").distinct()
        spans = [F.lit(f"{6 * c - 5}:{6 * c}") for c in range(1, 8)]
        return d.select(
            F.concat(F.lit("E"), F.col("label")).alias("Tree"), *[s.alias(f"Cable{c}") for c, s in enumerate(spans, 1)],
            F.when(F.col("label") % 2 == 0, "43:48").alias("Cable8"),
        )


def _tree() -> Column:
    return F.concat(F.lit("T"), F.col("user_id") % 4)


def _cable() -> Column:
    return (1 + F.col("user_id") % 3).cast("int")


def cable_of_type() -> Column:
    out = F.lit(None).cast("int")
    for kind, number in CABLE_OF.items():
        out = F.when(F.col("event_type") == kind, number).otherwise(out)
    return out


# --- the same views in SQL --------------------------------------------------

_TREE = "'T' || (user_id % 4)"
_CABLE = "CAST(1 + user_id % 3 AS INTEGER)"
_H = "date_trunc('hour', ts)"

READINGS = f"""readings AS (
  SELECT {_TREE} AS Tree, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
         WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS INTEGER) AS Cable, {_H} AS Timestamp, avg(value) AS Velocity
  FROM events GROUP BY 1, 2, 3)"""
HOURLY = f"""hourly AS (
  SELECT event_type AS Cable, {_H} AS Timestamp, avg(value) AS Velocity FROM events GROUP BY 1, 2)"""
TIER = f"""tier AS (
  SELECT {_TREE} AS Tree, {_CABLE} AS Cable, {_H} AS Timestamp,
         avg(value) FILTER (WHERE event_type = 'click') AS outer_vel,
         avg(value) FILTER (WHERE event_type = 'view') AS middle_vel,
         avg(value) FILTER (WHERE event_type = 'purchase') AS inner_vel
  FROM events GROUP BY 1, 2, 3)"""
CLIMATE = f"""climate AS (
  SELECT {_TREE} AS Tree, 'S' || (user_id % 6) AS Station, {_H} AS Timestamp,
         CAST(count(*) FILTER (WHERE event_type = 'error' AND value > 200) AS DOUBLE) AS Solar, avg(value) AS VPD,
         avg(value) FILTER (WHERE event_type IN ('click', 'view')) AS Wetness
  FROM events GROUP BY 1, 2, 3)"""
ACTIONS = f"""actions AS (
  SELECT Tree, Cable, Timestamp, Action, event_id AS file_pos FROM (
    SELECT *, row_number() OVER (PARTITION BY Tree, Cable, Timestamp ORDER BY event_id) AS rn FROM (
      SELECT {_TREE} AS Tree, {_CABLE} AS Cable, {_H} AS Timestamp, event_id,
             CASE user_id % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'R' WHEN 2 THEN 'MR' WHEN 3 THEN 'H' ELSE 'W' END AS Action
      FROM events WHERE event_type = 'error' AND value > 200)) WHERE rn = 1)"""
INTERVALS = f"""intervals AS (
  SELECT {_TREE} AS Tree, {_CABLE} AS Cable,
         CASE event_id % 3 WHEN 0 THEN 'outer_vel' WHEN 1 THEN 'middle_vel' ELSE 'inner_vel' END AS Position,
         {_H} AS "Start", {_H} + INTERVAL 6 HOUR AS "End"
  FROM events WHERE event_type = 'error' AND value > 80)"""
ZEROES = f"""zeroes AS (
  SELECT DISTINCT {_H} AS periodBegin, {_H} + INTERVAL 4 HOUR AS periodEnd, {_TREE} AS Tree
  FROM events WHERE event_type = 'purchase' AND value > 150)"""
LOG = f"""log AS (
  SELECT {_TREE} AS Tree, max(ts) AS last_import FROM events
  WHERE ts < TIMESTAMP '2024-01-20 00:00:00' AND user_id % 4 <> 3 GROUP BY 1)"""
RECORDS = f"""records AS (
  SELECT {_TREE} AS Tree, date_trunc('minute', ts) AS Timestamp, event_id, value FROM events)"""
PORT_ROWS = """ports AS (
  SELECT 'E' || label AS Tree, label, vec_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(vec_id * 900) AS Timestamp,
         CAST(i AS INTEGER) AS port, 15 + 40 * CAST(embedding[i] AS DOUBLE) AS base,
         15 + 40 * CAST(embedding[i] AS DOUBLE) + 8 * abs(CAST(embedding[i] AS DOUBLE)) AS after
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i))"""
# Cable and depth of each port; cable 8 is not wired on odd trees.
WIRED = """wired AS (
  SELECT *, CAST((port - 1) // 6 + 1 AS INTEGER) AS Cable, (port - 1) % 6 AS place FROM ports
  WHERE port <= 48 AND NOT ((port - 1) // 6 = 7 AND label % 2 = 1))"""
