from __future__ import annotations

import os
from datetime import datetime

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.operators.aggregates import resample, summary_table
from sensorloom.plans.tiers import build_l1, import_raw, maintenance_table
from sensorloom.sources import incremental as N
from sensorloom.sources import logger as L
from sensorloom.sources import tiers as W
from sensorloom.streaming.imports import stream_import

HEAD = ['"TOA5","x","y"', '"TIMESTAMP","RECORD","Panel_Temperature_Avg","Big_Battery_Voltage_Min","Small_Battery_Voltage_Min","Wood_1"', '"TS","RN","Deg C","Volts","Volts","Deg C"', '"","","Avg","Min","Min","Avg"']


def logger_file(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(HEAD + records) + "\n")


@pytest.fixture
def folder(tmp_path):
    logger_file(tmp_path / "in", "ET3_Data_Table.dat", [
        '"2024-01-01 00:15:30",2,20.5,12.1,3,NAN', '"2024-01-01 00:00:00",1,20,12,3,"NAN"', '"2024-01-01 00:00:00",1,20,12,3,"NAN"', '"2024-01-01 00:30",3,junk,0,,7',
    ])
    return str(tmp_path / "in")


def test_read_and_format(spark, folder):
    d = L.format_logger(L.read_logger(spark, folder))
    assert d.columns == ["Tree", "Timestamp", "Record_Number", "Panel_Temperature", "Big_Battery_Voltage", "Small_Battery_Voltage", "Wood_1"]
    assert rows(d, "Timestamp") == [
        ("ET3", at(0), 1.0, 20.0, 12.0, 3.0, None), ("ET3", at(1), 2.0, 20.5, 12.1, 3.0, None), ("ET3", at(2), 3.0, None, 0.0, None, 7.0),
    ]


def test_layouts_are_united_by_name(spark, tmp_path, folder):
    with open(os.path.join(folder, "ET4_Data_Table.dat"), "w") as f:
        f.write("\n".join([HEAD[0], HEAD[1].replace("Wood_1", "Wood_2"), *HEAD[2:], '"2024-01-01 00:00:00",1,20,12,3,5']) + "\n")
    with pytest.raises(ValueError, match="several"):
        L.header_names(L.read_lines(spark, folder))
    d = L.format_logger(L.read_logger(spark, folder))
    assert rows(d.select("Tree", "Timestamp", "Wood_1", "Wood_2"), "Tree", "Timestamp") == [
        ("ET3", at(0), None, None), ("ET3", at(1), None, None), ("ET3", at(2), 7.0, None), ("ET4", at(0), None, 5.0)]


def test_import_in_two_steps_equals_one(spark, folder, tmp_path):
    log = spark.createDataFrame([], schemas.IMPORT_LOG)
    raw, once = str(tmp_path / "raw"), str(tmp_path / "once")
    log1, report = import_raw(spark, folder, log, raw)
    assert rows(report) == [("ET3", 3, 0, None, "new series")]
    log1 = spark.createDataFrame(log1.collect(), schemas.IMPORT_LOG)
    logger_file(folder, "ET3_Data_Table_2.dat", ['"2024-01-01 00:30",3,junk,0,,7', '"2024-01-03 00:30",4,21,12,3,8'])
    log2, report = import_raw(spark, folder, log1, raw)
    assert rows(report) == [("ET3", 1, 0, 2.0, "imported")]
    import_raw(spark, folder, log, once)
    a, b = (spark.read.parquet(p).drop("batch").distinct() for p in (raw, once))
    assert rows(a, "Timestamp") == rows(b.select(*a.columns), "Timestamp") and a.count() == 4
    assert rows(log2) == [("ET3", datetime(2024, 1, 3, 0, 30))]
    again, report = import_raw(spark, folder, spark.createDataFrame(log2.collect(), schemas.IMPORT_LOG), raw)
    assert rows(report) == [("ET3", 0, 0, None, "no import needed")] and spark.read.parquet(raw).count() == 4


def test_the_same_import_twice_equals_once(spark, folder, tmp_path):
    raw, log_path = str(tmp_path / "raw"), str(tmp_path / "log")
    log = spark.createDataFrame([], schemas.IMPORT_LOG)
    for _ in range(2):
        import_raw(spark, folder, log, raw, log_path=log_path)
    assert spark.read.parquet(raw).count() == 3 and rows(spark.read.parquet(log_path)) == [("ET3", at(2))]


def test_imports_of_other_files_from_one_log_stand_beside_each_other(spark, folder, tmp_path):
    raw, other = str(tmp_path / "raw"), str(tmp_path / "other")
    log = spark.createDataFrame([], schemas.IMPORT_LOG)
    import_raw(spark, folder, log, raw)
    os.makedirs(other)
    logger_file(other, "ET3_Data_Table_2.dat", ['"2024-01-03 00:30",4,21,12,3,8'])
    import_raw(spark, other, log, raw)
    assert spark.read.parquet(raw).count() == 4
    # Run again with one more file, both take the place of what was there.
    logger_file(other, "ET3_Data_Table_3.dat", ['"2024-01-04 00:30",5,21,12,3,8'])
    import_raw(spark, other, log, raw)
    assert sorted(r.Record_Number for r in spark.read.parquet(raw).collect()) == [1, 2, 3, 4, 5]


def test_names_come_from_the_first_part_of_a_file(spark, folder):
    lines = L.read_lines(spark, folder)
    # A line like that of names further on in a file is no header.
    later = lines.where("value like '%TIMESTAMP%'").selectExpr("path", "block + 1000 AS block", "'TIMESTAMP,RECORD,Fake' AS value")
    assert L.header_names(lines.union(later)) == L.header_names(lines)


def test_stream_loses_no_late_file(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    for i, day in enumerate(("2024-06-02", "2024-06-01", "2024-01-02", "2024-01-01")):
        logger_file(folder, f"ET{i}_Data_Table.dat", [f'"{day} 00:00:00",1,20,12,3,5', f'"{day} 00:00:20",2,20,12,3,5', f'"{day} 00:00:20",2,20,12,3,5'])
        os.utime(os.path.join(folder, f"ET{i}_Data_Table.dat"), (1_700_000_000 + i, 1_700_000_000 + i))
    raw = str(tmp_path / "raw")
    stream_import(spark, folder, raw, str(tmp_path / "state"), L.header_names(L.read_lines(spark, folder)), max_files=1)
    batch = L.format_logger(L.read_logger(spark, folder))
    got = spark.read.parquet(raw).select(*batch.columns)
    order = ("Tree", "Timestamp", "Record_Number")
    assert got.count() == 8 and rows(got, *order) == rows(batch, *order)


def test_overwriting_empties_a_key(spark, tmp_path):
    path, d = str(tmp_path / "l1"), spark.createDataFrame(TIER, schemas.L1)
    W.write_tier(d, path)
    back = spark.read.schema(schemas.L1).parquet(path)
    W.replace_keys(N.rollback_tier(back.where("Tree = 'T1'"), "2000-01-01 00:00:00", ["T1"]), path, ["T1"])
    assert rows(spark.read.schema(schemas.L1).parquet(path).groupBy("Tree").count(), "Tree") == [("T2", 5)]


def test_a_run_without_flags_removes_old_ones(spark, tmp_path):
    from sensorloom.plans.tiers import save_l2

    tier, flags = str(tmp_path / "tier"), str(tmp_path / "flags")
    for mark in ("odd", None):
        d = spark.createDataFrame([(*r, mark if r[0] == "T1" else "odd", None, None) for r in TIER], schemas.L1.simpleString().removeprefix("struct<").removesuffix(">") + ",outer_flag string,middle_flag string,inner_flag string")
        save_l2(d, tier, flags)
    assert rows(spark.read.parquet(flags).groupBy("Tree").count()) == [("T2", 5)] and spark.read.parquet(tier).count() == 10


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from sensorloom.session import scratch_dir

    unset = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: unset)
    with pytest.raises(RuntimeError, match="share"):
        scratch_dir(SimpleNamespace(conf=unset, sparkContext=context), "x")


def test_stream_equals_batch_and_resumes(spark, folder, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    names = L.header_names(L.read_lines(spark, folder))
    stream_import(spark, folder, raw, state, names)
    logger_file(folder, "ET4_Data_Table.dat", ['"2024-01-01 00:00:00",1,20,12,3,5'])
    stream_import(spark, folder, raw, state, names)
    batch = L.format_logger(L.read_logger(spark, folder))
    got = spark.read.parquet(raw).select(*batch.columns)
    assert rows(got, "Tree", "Timestamp") == rows(batch, "Tree", "Timestamp") and got.count() == 4


TIER = [("T1", 1, at(i), float(i), None, 1.0) for i in range(5)] + [("T2", 1, at(i), float(i), None, 1.0) for i in range(5)]


def test_overwrite_replaces_only_its_trees(spark, tmp_path):
    path, d = str(tmp_path / "l1"), spark.createDataFrame(TIER, schemas.L1)
    W.write_tier(d, path)
    back = spark.read.schema(schemas.L1).parquet(path)
    W.replace_keys(N.rollback_tier(back.where("Tree = 'T1'"), "2024-01-01 00:30:00", ["T1"]), path)
    got = spark.read.schema(schemas.L1).parquet(path)
    assert rows(got.groupBy("Tree").count(), "Tree") == [("T1", 3), ("T2", 5)]


def test_rolled_back_log_and_backfill(spark):
    log = spark.createDataFrame([("T1", at(9)), ("T2", at(9))], schemas.IMPORT_LOG)
    assert rows(N.rollback_log(log, "2024-01-01 01:00:00", ["T1"]), "Tree") == [("T1", at(4)), ("T2", at(9))]
    d = spark.createDataFrame(TIER, schemas.L1)
    extents = spark.createDataFrame([("T1", at(1), at(2))], "Tree string, first timestamp_ntz, last timestamp_ntz")
    redone = spark.createDataFrame([("T1", 1, at(1), 50.0, None, None)], schemas.L1)
    got = N.backfill_window_replace(d, redone, extents)
    assert [r[3] for r in rows(got.where("Tree = 'T1'"), "Timestamp")] == [0.0, 50.0, 3.0, 4.0]
    assert rows(N.restart_points(extents)) == [("T1", at(0), at(2))]
    assert N.backfill_merge(d, d).count() == d.count()


def test_csv_round_trip_and_names(spark, tmp_path):
    d, path = spark.createDataFrame(TIER, schemas.L1), str(tmp_path / "csv")
    W.write_export(W.export_slice(d), path, single_file=True)
    assert rows(W.scan_tier(spark, path, schemas.L1, "csv"), "Tree", "Timestamp") == rows(d, "Tree", "Timestamp")
    assert W.export_name("Tree", "2024-01-01 00:00", "2024-02-01", "T1") == "T1_Tree_2024-01-01_2024-02-01.csv"
    assert W.export_name("All_trees", "2024-01-01", "2024-02-01") == "AllTrees_2024-01-01_2024-02-01.csv"
    with pytest.raises(ValueError):
        W.export_slice(d, "xls")
    text = rows(W.export_slice(d, "text").select("Timestamp"), "Timestamp")
    assert text[0] == ("2024-01-01",) and text[-1] == ("2024-01-01 01:00:00",)


def test_weeks_start_on_sunday(spark):
    days = [datetime(2024, 1, d, 12) for d in (6, 7, 8)]
    d = spark.createDataFrame([("T", 1, t, 1.0, None, 3.0) for t in days], schemas.L1)
    got = resample(d, "week")
    assert rows(got.select("Timestamp", "middle_vel"), "Timestamp") == [(datetime(2023, 12, 31), None), (datetime(2024, 1, 7), None)]


def test_summary_of_an_all_missing_measure(spark):
    got = summary_table(spark.createDataFrame(TIER, schemas.L1)).where("Tree = 'T1'").drop("Tree", "Cable")
    assert rows(got, "measure") == [("inner_vel", 1.0, 1.0, 1.0, 5.0, 0.0), ("middle_vel", None, None, None, None, None), ("outer_vel", 0.0, 2.0, 4.0, 10.0, 4.0)]


def test_l1_in_two_increments_equals_one(spark):
    base = [20.0] * 64
    after = [20.0 + 0.1 * (i % 6 + 1) for i in range(64)]
    hot = [99.0] * 64
    data = [("T1", at(i), base, hot if i == 2 else after) for i in (0, 1, 2, 5, 6)] + [("T1", at(5.5), base, after)]
    ports = spark.createDataFrame(data, "Tree string, Timestamp timestamp_ntz, base array<double>, after array<double>")
    station = spark.createDataFrame([("T1", "1:6", None, "7:12", None, None, None, None, None)], schemas.STATION_INFO)
    once = build_l1(ports, station)
    first = build_l1(ports.where(F.col("Timestamp") <= at(1)), station)
    twice = build_l1(ports, station, first)
    key = ("Cable", "Timestamp")
    assert rows(once, *key) == rows(twice, *key)
    assert once.count() == 14 and rows(once.select("Cable").distinct(), "Cable") == [(1,), (3,)]
    assert rows(once.where("outer_vel IS NULL AND Cable = 1").select("Timestamp"), "Timestamp") == [(at(2),), (at(3),), (at(4),)]


def test_maintenance_notes(spark):
    sheet = spark.createDataFrame([("A", "Cable 3", "Moved and replaced", "M2;x"), ("A", "Cable 4", "cleaned", None)], ["Tree", "Part", "2023-05-04", "2023-06-01"])
    dates = sheet.columns[2:]
    assert [r[3] for r in rows(maintenance_table(sheet, dates), "Cable", "Timestamp")] == ["Moved and replaced", "M2", "cleaned"]
    assert [r[3] for r in rows(maintenance_table(sheet, dates, classify=True), "Cable", "Timestamp")] == ["MR", None, None]


def test_stream_of_tier_rows_resamples_like_a_batch(spark, tmp_path):
    from sensorloom.streaming.imports import stream_resample

    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    data = [("T1", 1, at(i), float(i), None, 1.0) for i in range(40)]
    d = spark.createDataFrame(data, schemas.L1)
    d.write.parquet(path)
    stream = stream_resample(spark.readStream.schema(schemas.L1).parquet(path), ["outer_vel"], "1 hour")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(out)
    # The last hours stay open until later data moves the watermark on.
    want = resample(d, "hour", ["outer_vel"]).where(F.col("Timestamp") < at(32))
    assert rows(got.where(F.col("Timestamp") < at(32)).select("Tree", "Cable", "Timestamp", "outer_vel"), "Timestamp") == rows(want, "Timestamp")


def test_a_row_behind_the_watermark_is_lost_and_one_within_it_is_not(spark, tmp_path):
    from sensorloom.streaming.imports import stream_resample

    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    lots = [[at(0), at(1), at(40)], [at(2), at(33)], [at(120)]]
    for lot in lots:
        spark.createDataFrame([("T1", 1, t, 1.0, None, None) for t in lot], schemas.L1).write.mode("append").parquet(path)
        stream = stream_resample(spark.readStream.schema(schemas.L1).parquet(path), ["outer_vel"], "2 hours")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    # The second lot finds the hour of its first row closed; that of its second is open, as is the state it goes on from.
    got = [r.Timestamp for r in spark.read.schema(stream.schema).parquet(out).orderBy("Timestamp").collect()]
    assert got == [at(0), at(32), at(40)]


def test_span_follows_the_busiest_day(spark):
    from sensorloom.operators.ordered import span_for

    d = spark.range(1000).select(F.lit("T1").alias("Tree"), (F.timestamp_seconds(F.col("id") * 60)).cast("timestamp_ntz").alias("Timestamp"))
    assert span_for(d, ["Tree"], "Timestamp", rows=100) == 8640
    assert span_for(d.limit(0), ["Tree"], "Timestamp") == 10 * 365 * 86400
