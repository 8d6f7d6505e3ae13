from __future__ import annotations

from datetime import datetime

from conftest import at, rows
from pyspark.sql import functions as F

from sensorloom.config import VELOCITIES
from sensorloom.operators import intervals as I
from sensorloom.operators import joins as J
from sensorloom.operators.reshape import cast_positions, melt_bad_windows, melt_date_columns, melt_positions

KEYS = "Tree string, Cable int"


def test_grid_has_every_slot(spark):
    spans = spark.createDataFrame([("A", 1, at(0), at(5000)), ("B", 2, at(3), at(3)), ("C", 1, at(3), at(2))], KEYS + ", lo timestamp_ntz, hi timestamp_ntz")
    grid = I.make_grid(spans, "lo", "hi")
    assert rows(grid.groupBy("Tree").agg(F.count("*"), F.min("Timestamp"), F.max("Timestamp")), "Tree") == [("A", 5001, at(0), at(5000)), ("B", 1, at(3), at(3))]
    assert grid.distinct().count() == grid.count()


def test_grid_join_drops_rows_off_the_grid(spark):
    spans = spark.createDataFrame([("A", 1, at(0), at(2))], KEYS + ", lo timestamp_ntz, hi timestamp_ntz")
    data = spark.createDataFrame([("A", 1, at(1), 5.0), ("A", 1, at(1.5), 6.0)], KEYS + ", Timestamp timestamp_ntz, v double")
    got = I.grid_left_join(I.make_grid(spans, "lo", "hi"), data)
    assert [r[3] for r in rows(got, "Timestamp")] == [None, 5.0, None]


LONG = KEYS + ", Position string, Timestamp timestamp_ntz, Velocity double"
BAD = KEYS + ", Position string, Start timestamp_ntz, End timestamp_ntz"


def test_window_off_the_grid_masks_nothing_unless_aligned(spark):
    d = spark.createDataFrame([("A", 1, "outer_vel", at(i), 1.0) for i in range(6)], LONG)
    bad = spark.createDataFrame([("A", 1, "outer_vel", at(1.5), at(3)), ("A", 1, "outer_vel", at(2.5), at(4.1))], BAD)
    assert I.mask_intervals(d, bad).where("Velocity IS NULL").count() == 0
    got = I.mask_intervals(d, bad, align=True, span=1800, flag="bad")
    assert [(r.Velocity, r.bad) for r in got.orderBy("Timestamp").collect()] == [(1.0, 0), (1.0, 0), (None, 1), (None, 1), (None, 1), (1.0, 0)]


def test_overlapping_windows_count_once(spark):
    d = spark.createDataFrame([("A", 1, "outer_vel", at(i), float(i)) for i in range(6)], LONG)
    bad = spark.createDataFrame([("A", 1, "outer_vel", at(1), at(3)), ("A", 1, "outer_vel", at(2), at(4)), ("A", 2, "outer_vel", at(0), at(5))], BAD)
    got = rows(I.mask_intervals(d, bad).select("Velocity"), "Timestamp")
    assert [g[0] for g in got] == [0.0, None, None, None, None, 5.0]


def test_wide_mask_equals_long_mask(spark):
    wide = spark.createDataFrame([("A", 1, at(i), 1.0, 2.0, 3.0) for i in range(8)], KEYS + ", Timestamp timestamp_ntz, outer_vel double, middle_vel double, inner_vel double")
    bad = spark.createDataFrame([("A", 1, "outer_vel", at(1), at(3)), ("A", 1, "inner_vel", at(2), at(2))], BAD)
    long_way = cast_positions(I.mask_intervals(melt_positions(wide), bad))
    assert rows(I.mask_wide(wide, bad, VELOCITIES), "Timestamp") == rows(long_way, "Timestamp")


def test_cast_undoes_melt(spark):
    wide = spark.createDataFrame([("A", 1, at(i), float(i), None, -1.0) for i in range(5)], KEYS + ", Timestamp timestamp_ntz, outer_vel double, middle_vel double, inner_vel double")
    assert rows(cast_positions(melt_positions(wide)), "Timestamp") == rows(wide, "Timestamp")


def test_dormancy_is_closed(spark):
    d = spark.createDataFrame([("A", 1, at(i), 1.0) for i in (0, 1, 2, 3, 3)], KEYS + ", Timestamp timestamp_ntz, outer_vel double")
    z = spark.createDataFrame([("A", 1, at(1), at(2))], KEYS + ", Dormant timestamp_ntz, Returned timestamp_ntz")
    assert [r[3] for r in rows(I.mask_dormancy(d, z, span=900), "Timestamp")] == [1.0, None, None, 1.0]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    right = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z")], "k long, s string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = J.salted_join(left, right, ["k"], "n", how)
        assert rows(got, *got.columns) == rows(left.join(right, "k", how).select(*got.columns), *got.columns)


def test_only_hot_keys_are_repeated(spark):
    # One key holds nine tenths of the rows; keys may be null.
    left = spark.range(2000).select(F.when(F.col("id") % 10 < 9, 7).when(F.col("id") % 10 == 9, F.col("id")).alias("k"), F.col("id").alias("n"))
    left = left.union(spark.createDataFrame([(None, -1)], left.schema))
    right = left.select("k").distinct().select("k", (F.coalesce("k", F.lit(0)) * 2).alias("s"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = J.salted_join(left, right, ["k"], "n", how, salts=8)
        assert rows(got, *got.columns) == rows(left.join(right, "k", how).select(*got.columns), *got.columns)
    hot = left.limit(1).select(J.hot_keys(left.select("k"), ["k"], 8)).first()[0]
    assert hot == [spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]]
    # The plan makes one copy of each right row but that of the hot key, which gets eight.
    with_copies = J.salted_join(right.withColumn("n", F.lit(1)), right, ["k"], "n", "inner", salts=8, like=left)
    assert with_copies.count() == right.where("k is not null").count()
    is_hot = F.array_contains(J.hot_keys(left.select("k"), ["k"], 8), F.xxhash64("k"))
    assert right.select(F.explode(F.sequence(F.lit(0), F.when(is_hot, 7).otherwise(0)))).count() == right.count() + 7


def test_guide_picks_position_and_date(spark):
    d = spark.createDataFrame([("A", 1, at(i), p, 1.0) for i in range(3) for p in ("outer_vel", "inner_vel")], KEYS + ", Timestamp timestamp_ntz, Position string, Velocity double")
    g = spark.createDataFrame([("A", 1, "inner_vel", at(1))], KEYS + ", Use string, Starting timestamp_ntz")
    assert [(r[2], r[3]) for r in rows(J.guide_join(d, g), "Timestamp")] == [(at(1), "inner_vel"), (at(2), "inner_vel")]


def test_bad_window_sheet(spark):
    sheet = spark.createDataFrame([("A", at(0), at(4), "x", None, "y")], "Tree string, Start timestamp_ntz, End timestamp_ntz, Cable1_Outer string, Cable1_Middle string, Cable8_Inner string")
    assert rows(melt_bad_windows(sheet).select("Tree", "Cable", "Position"), "Cable") == [("A", 1, "outer_vel"), ("A", 8, "inner_vel")]


def test_date_columns(spark):
    sheet = spark.createDataFrame([("A", "Cable 3", "M; loose", None), ("A", "Logger", "ok", "ok")], ["Tree", "Part", "2023-05-04 note", "2023-06-01"])
    got = rows(melt_date_columns(sheet, sheet.columns[2:]))
    assert got == [("A", "3", datetime(2023, 5, 4, 10), "M; loose")]
