"""Readers, writers and the incremental import, on files written from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.catalog.registry import R, RV, query, rounded
from sensorloom.catalog.views import INTERVALS, LOG, RECORDS, TIER, ZEROES, Tables
from sensorloom.config import AFTER_PREFIX, BASE_PREFIX, PORTS, VELOCITIES
from sensorloom.functions.columns import path_key
from sensorloom.session import scratch_dir, written
from sensorloom.sources import incremental as N
from sensorloom.sources import logger as L
from sensorloom.sources import tiers as W
from sensorloom.streaming.imports import stream_import, stream_resample

FIELDS = [
    "TIMESTAMP", *L.RENAMES, *[f"{BASE_PREFIX}_Avg({i})" for i in range(1, PORTS + 1)], *[f"{AFTER_PREFIX}_Avg({i})" for i in range(1, PORTS + 1)],
]
FOLDER_KEY = r"Tree=([^/]+)/"


def logger_lines(t: Tables) -> DataFrame:
    """(Tree, value): the ports table as logger text, with headers, lost values and repeated lines."""
    d, number = t.ports(), F.col("vec_id")
    text = lambda array, first: F.transform(array, lambda v, i: F.when((number + i + first) % 13 == 0, "NAN").otherwise(v.cast("string")))
    volts = F.when(number % 11 == 0, 0.0).otherwise(F.get("after", F.lit(1)))
    line = F.concat_ws(
        ",", F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss"), number.cast("string"), F.get("base", F.lit(0)).cast("string"),
        volts.cast("string"), F.get("base", F.lit(2)).cast("string"), text("base", 0), text("after", PORTS),
    )
    rows = d.select(tree_of("Tree").alias("Tree"), F.explode(F.array_repeat(line, F.when(number % 5 == 0, 2).otherwise(1))).alias("value"))
    quoted = ",".join(f'"{n}"' for n in FIELDS)
    heads = F.array(*[F.lit(h) for h in ('"TOA5","logger"', quoted, '"TS","RN","Deg C"', '"","","Avg"')])
    return t.station_info().select(tree_of("Tree").alias("Tree"), F.explode(heads).alias("value")).unionByName(rows)


def tree_of(c: str):
    """E7 -> ET7, the form of a station's file name."""
    return F.concat(F.lit("ET"), F.substring(c, 2, 9))


def logger_files(t: Tables) -> str:
    path = scratch_dir(t.spark, "logger")
    logger_lines(t).write.partitionBy("Tree").text(path)
    return path


# One row per record: what the text holds after lost values are gone.
LINES = """lines AS (
  SELECT 'ET' || label AS Tree, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(vec_id * 900) AS Timestamp, CAST(vec_id AS DOUBLE) AS Record_Number,
    15 + 40 * CAST(embedding[1] AS DOUBLE) AS Panel_Temperature,
    CASE WHEN vec_id % 11 = 0 THEN 0.0 ELSE 15 + 40 * CAST(embedding[2] AS DOUBLE) + 8 * abs(CAST(embedding[2] AS DOUBLE)) END AS Big_Battery_Voltage,
    list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (vec_id + i - 1) % 13 = 0 THEN 0 ELSE 15 + 40 * CAST(embedding[i] AS DOUBLE) END)) AS base_total,
    CAST(len(list_filter(range(0, 128), lambda i: (vec_id + i) % 13 = 0)) AS INTEGER) AS lost
  FROM embeddings)"""
LINE_COLS = f"Tree, Timestamp, Record_Number, {R('Panel_Temperature')} AS Panel_Temperature, {R('Big_Battery_Voltage')} AS Big_Battery_Voltage, {R('base_total')} AS base_total, lost"


def line_facts(d: DataFrame) -> DataFrame:
    base = [c for c in d.columns if c.startswith(BASE_PREFIX)]
    after = [c for c in d.columns if c.startswith(AFTER_PREFIX)]
    total = F.aggregate(F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in base]), F.lit(0.0), lambda a, x: a + x)
    lost = F.size(F.filter(F.array(*[F.col(f"`{c}`") for c in base + after]), lambda x: x.isNull()))
    d = d.select("Tree", "Timestamp", "Record_Number", "Panel_Temperature", "Big_Battery_Voltage", total.alias("base_total"), lost.alias("lost"))
    return rounded(d, "Panel_Temperature", "Big_Battery_Voltage", "base_total")


@query("read_logger", f"WITH {LINES} SELECT {LINE_COLS} FROM lines")
def _(t: Tables):
    d = L.read_logger(t.spark, logger_files(t))
    return line_facts(L.format_logger(d, path_key("path", FOLDER_KEY)))


@query("stream_resample", f"""WITH {TIER} SELECT Tree, Cable, date_trunc('day', Timestamp) AS Timestamp, {', '.join(f"{R(f'avg({c})')} AS {c}" for c in VELOCITIES)} FROM tier GROUP BY 1, 2, 3""")
def _(t: Tables):
    """The tier arrives in two lots, by time; the second run of the stream goes on from the state of the first."""
    d = t.tier_wide().select("Tree", "Cable", "Timestamp", *VELOCITIES)
    arrived, out, state = (scratch_dir(t.spark, n) for n in ("arrived", "daily", "stream-state"))
    d = written(d, "tier")
    middle = d.agg(F.min("Timestamp") + (F.max("Timestamp") - F.min("Timestamp")) / 2).scalar()
    # A row far ahead closes the last days.
    ahead = d.agg(F.max("Timestamp").alias("t")).select(F.lit("ahead").alias("Tree"), F.lit(0).alias("Cable"), (F.col("t") + F.make_dt_interval(days=F.lit(30))).alias("Timestamp"))
    for lot in (d.where(F.col("Timestamp") <= middle), d.where(F.col("Timestamp") > middle), ahead):
        lot.write.mode("append").parquet(arrived)
        stream = stream_resample(t.spark.readStream.schema(d.schema).parquet(arrived), VELOCITIES, "1 day", "1 day")
        run = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
    daily = t.spark.read.schema(stream.schema).parquet(out).where("Tree <> 'ahead'")
    return rounded(daily, *VELOCITIES)


@query("format_logger", f"WITH {LINES} SELECT {LINE_COLS} FROM lines")
def _(t: Tables):
    lines = logger_lines(t)
    return line_facts(L.format_logger(L.parse_lines(lines, FIELDS, keep=("Tree",)).withColumnRenamed("Tree", "path"), F.col("path")))


@query("drop_leading_rows", f"WITH {LINES} SELECT Tree, CAST(count(*) AS BIGINT) AS records, min(Timestamp) AS first, sum(Record_Number) AS numbers FROM lines GROUP BY 1")
def _(t: Tables):
    d = L.parse_lines(logger_lines(t), FIELDS, keep=("Tree",)).groupBy("Tree")
    return d.agg(F.count("Timestamp").alias("records"), F.min("Timestamp").alias("first"), F.sum("RECORD").alias("numbers"))


@query("stream_import", f"WITH {LINES} SELECT {LINE_COLS} FROM lines")
def _(t: Tables):
    source, raw, state = logger_files(t), scratch_dir(t.spark, "raw"), scratch_dir(t.spark, "state")
    stream_import(t.spark, f"{source}/*", raw, state, FIELDS, max_files=8, tree=path_key("path", FOLDER_KEY))
    return line_facts(t.spark.read.parquet(raw))


@query("scan_tier", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def _(t: Tables):
    d = W.scan_tier(t.spark, f"{t.dir}/orders.parquet")
    return d.select("o_orderkey", "o_custkey", "o_totalprice")


@query("scan_tier_csv", f"WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier")
def _(t: Tables):
    path = scratch_dir(t.spark, "csv")
    W.write_export(W.export_slice(t.tier_wide()), path)
    return rounded(W.scan_tier(t.spark, path, schemas.L1, "csv"), *VELOCITIES)


@query("scan_dir_union", f"WITH {ZEROES} SELECT * FROM zeroes")
def _(t: Tables):
    path = scratch_dir(t.spark, "zeroes")
    z = t.zeroes().select("periodBegin", "periodEnd", "Tree")
    z.unionByName(z.where("Tree = 'T1'")).repartition(4, "Tree").write.option("header", "true").csv(path)
    return W.scan_dir_union(t.spark, path, schemas.ZEROES)


@query("typed_sheet_scan", f"""WITH {INTERVALS} SELECT Tree, Cable, "Start", "End" FROM intervals""")
def _(t: Tables):
    path = scratch_dir(t.spark, "sheet")
    t.intervals().select("Tree", "Cable", "Position", "Start", "End").write.option("header", "true").csv(path)
    kinds = {"Tree": "STRING", "Cable": "INT", "Position": None, "Start": "TIMESTAMP_NTZ", "End": "TIMESTAMP_NTZ"}
    return W.typed_sheet_scan(t.spark, path, kinds)


def _written(t: Tables) -> str:
    path = scratch_dir(t.spark, "tier")
    W.write_tier(t.tier_wide(), path)
    return path


@query("write_tier", f"WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier")
def _(t: Tables):
    return rounded(t.spark.read.schema(schemas.L1).parquet(_written(t)), *VELOCITIES)


@query("append_raw", f"WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier")
def _(t: Tables):
    path, d = scratch_dir(t.spark, "raw"), t.tier_wide()
    early = F.col("Timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    W.append_raw(d.where(early), path)
    W.append_raw(d.where(~early), path)
    return rounded(t.spark.read.schema(schemas.L1).parquet(path), *VELOCITIES)


# T3 is rolled back to before its first row.
_ROLLED = "WHERE Tree <> 'T3' AND NOT (Tree IN ('T1', 'T2') AND Timestamp > TIMESTAMP '2024-01-20 00:00:00')"


@query("rollback_tier", f"WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier {_ROLLED}")
def _(t: Tables):
    path, trees = _written(t), ["T1", "T2"]
    d = t.spark.read.schema(schemas.L1).parquet(path)
    W.replace_keys(N.rollback_tier(d.where(F.col("Tree").isin(trees)), "2024-01-20 00:00:00", trees), path, trees)
    W.replace_keys(N.rollback_tier(d.where("Tree = 'T3'"), "2000-01-01 00:00:00", ["T3"]), path, ["T3"])
    return rounded(t.spark.read.schema(schemas.L1).parquet(path), *VELOCITIES)


@query("rollback_log", f"""WITH {LOG} SELECT Tree, CASE WHEN Tree IN ('T1', 'T2') THEN TIMESTAMP '2024-01-10 00:00:00' ELSE last_import END AS last_import FROM log""")
def _(t: Tables):
    return N.rollback_log(t.import_log(), "2024-01-10 00:00:00", ["T1", "T2"])


@query("export_slice", f"""WITH {TIER}, s AS (SELECT * FROM tier WHERE Timestamp BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-06 00:00:00')
  SELECT Tree, Cable, strftime(Timestamp, '%Y-%m-%dT%H:%M:%SZ') AS Timestamp, {RV()}, 'iso' AS style FROM s WHERE Tree = 'T1' AND Cable = 2
  UNION ALL SELECT Tree, Cable, CASE WHEN hour(Timestamp) = 0 THEN strftime(Timestamp, '%Y-%m-%d') ELSE strftime(Timestamp, '%Y-%m-%d %H:%M:%S') END, {RV()}, 'text' FROM s""")
def _(t: Tables):
    d, start, end = t.tier_wide(), "2024-01-03 00:00:00", "2024-01-06 00:00:00"
    iso = W.export_slice(W.slice_tier(d, start, end, "T1", "2")).withColumn("style", F.lit("iso"))
    text = W.export_slice(W.slice_tier(d, start, end), "text").withColumn("style", F.lit("text"))
    return rounded(iso.unionByName(text), *VELOCITIES)


# --- incremental ------------------------------------------------------------------

@query("new_series_bootstrap", f"WITH {RECORDS}, {LOG} SELECT Tree, Timestamp, event_id FROM records WHERE Tree NOT IN (SELECT Tree FROM log)")
def _(t: Tables):
    return N.new_series(t.records(), t.import_log()).select("Tree", "Timestamp", "event_id")


@query("skip_missing_input", f"WITH {RECORDS}, {LOG} SELECT Tree, Timestamp, event_id FROM records WHERE Tree IN (SELECT Tree FROM log)")
def _(t: Tables):
    return N.skip_missing_input(t.records(), t.import_log()).select("Tree", "Timestamp", "event_id")


@query("incremental_filter", f"WITH {RECORDS}, {LOG} SELECT Tree, Timestamp, event_id FROM records JOIN log USING (Tree) WHERE Timestamp > last_import")
def _(t: Tables):
    return N.incremental_filter(t.records(), t.import_log()).select("Tree", "Timestamp", "event_id")


@query("import_batch", f"WITH {RECORDS}, {LOG} SELECT Tree, Timestamp, event_id FROM records LEFT JOIN log USING (Tree) WHERE last_import IS NULL OR Timestamp > last_import")
def _(t: Tables):
    return N.import_batch(t.records(), t.import_log()).select("Tree", "Timestamp", "event_id")


@query("import_log_upsert", f"""WITH {RECORDS}, {LOG}, n AS (SELECT Tree, max(Timestamp) AS new FROM records WHERE Tree <> 'T1' GROUP BY 1)
  SELECT Tree, coalesce(new, last_import) AS last_import FROM log FULL JOIN n USING (Tree)""")
def _(t: Tables):
    return N.import_log_upsert(t.import_log(), N.import_ends(t.records().where("Tree <> 'T1'")))


@query("import_log_refresh", f"""WITH {RECORDS} SELECT Tree, max(Timestamp) AS last_import FROM records GROUP BY 1""")
def _(t: Tables):
    return N.import_log_refresh(t.import_log(), t.records())


@query("import_report", f"""WITH {RECORDS}, {LOG}, b AS (SELECT Tree, count(*) AS n, count(*) - count(DISTINCT Timestamp) AS dup, min(Timestamp) AS first
    FROM records LEFT JOIN log USING (Tree) WHERE last_import IS NULL OR Timestamp > last_import GROUP BY 1)
  SELECT Tree, CAST(coalesce(n, 0) AS BIGINT) AS rows, CAST(coalesce(dup, 0) AS BIGINT) AS duplicates,
    round((floor(epoch(first)) - floor(epoch(last_import))) / 86400.0, 1) AS missing_days,
    CASE WHEN n IS NULL THEN 'no import needed' WHEN last_import IS NULL THEN 'new series' ELSE 'imported' END AS status
  FROM (SELECT DISTINCT Tree FROM records) LEFT JOIN b USING (Tree) LEFT JOIN log USING (Tree)""")
def _(t: Tables):
    return N.import_report(t.records(), t.import_log())


@query("backfill_merge", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, {RV()} FROM tier""")
def _(t: Tables):
    d = t.tier_wide()
    at = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    old, reread = d.where((F.col("Tree") != "T2") | (F.col("Timestamp") < at)), d.where((F.col("Tree") == "T2"))
    return rounded(N.backfill_merge(old, reread), *VELOCITIES)


@query("backfill_window_replace", f"""WITH {TIER} SELECT Tree, Cable, Timestamp, CASE WHEN Tree = 'T2' AND Timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'
    THEN {R('outer_vel * 2')} ELSE {R('outer_vel')} END AS outer_vel, {R('middle_vel')} AS middle_vel, {R('inner_vel')} AS inner_vel FROM tier""")
def _(t: Tables):
    d = t.tier_wide()
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 00:00:00", "2024-01-15 00:00:00"))
    redone = d.where((F.col("Tree") == "T2") & F.col("Timestamp").between(lo, hi)).withColumn("outer_vel", F.col("outer_vel") * 2)
    extents = redone.groupBy("Tree").agg(F.min("Timestamp").alias("first"), F.max("Timestamp").alias("last"))
    return rounded(N.backfill_window_replace(d, redone, extents), *VELOCITIES)
