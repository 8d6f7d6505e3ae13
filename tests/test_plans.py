from __future__ import annotations

import random

from conftest import at, rows

from sensorloom import schemas
from sensorloom.plans.tiers import build_l2, save_l2

BAD = "Tree string, Cable int, Position string, Start timestamp_ntz, End timestamp_ntz"
ACTIONS = "Tree string, Cable int, Timestamp timestamp_ntz, Action string, file_pos long"


def test_l2_on_a_grid_by_time_equals_by_row_number(spark, tmp_path):
    rng = random.Random(5)
    value = lambda: None if rng.random() < 0.1 else (80.0 if rng.random() < 0.05 else round(rng.gauss(5, 1), 2))
    l1 = spark.createDataFrame([("T1", c, at(i), value(), value(), value()) for c in (1, 2) for i in range(260)], schemas.L1)
    bad = spark.createDataFrame([("T1", 1, "outer_vel", at(30), at(60)), ("T1", 2, "inner_vel", at(0), at(5))], BAD)
    actions = spark.createDataFrame([("T1", 1, at(120), "M", 1), ("T1", 2, at(50), "H", 2)], ACTIONS)
    by_time = build_l2(l1, bad, actions, block=128)
    by_row = build_l2(l1, bad, actions, gridded=False, block=100)
    key = ("Cable", "Timestamp")
    assert rows(by_time, *key) == rows(by_row, *key) and by_time.count() == 520
    labels = by_time.groupBy("Cable").count()
    assert rows(labels, "Cable") == [("1a", 120), ("1b", 140), ("2a", 50), ("2b", 210)]
    masked = by_time.where("Cable = '1a' AND outer_vel IS NULL AND Timestamp BETWEEN TIMESTAMP_NTZ '2024-01-01 07:30:00' AND TIMESTAMP_NTZ '2024-01-01 15:00:00'")
    assert masked.count() == 31

    tier_path, flag_path = str(tmp_path / "l2"), str(tmp_path / "flags")
    save_l2(by_time, tier_path, flag_path)
    tier, flags = spark.read.parquet(tier_path), spark.read.parquet(flag_path)
    assert tier.count() == 520 and set(tier.columns) == set(schemas.L2.fieldNames())
    assert flags.count() == by_time.where("coalesce(outer_flag, middle_flag, inner_flag) IS NOT NULL").count() > 0
