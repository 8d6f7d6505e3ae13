"""Zero periods, night clipping, period numbers, the bump after a sensor change."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from sensorloom.config import ZeroRule
from sensorloom.operators import baseline as B
from sensorloom.plans.tiers import build_l3, build_zeroes

CLIMATE = "Tree string, Timestamp timestamp_ntz, Solar double, VPD double, Wetness double"
TIER = "Tree string, Cable string, Timestamp timestamp_ntz, outer_vel double, middle_vel double, inner_vel double"
ZEROES = "periodBegin timestamp_ntz, periodEnd timestamp_ntz, Tree string"
ACTIONS = "Tree string, Cable int, Timestamp timestamp_ntz, Action string"


def weather(spark, *stretches, tree="FB1", vpd=0.01):
    data = [(tree, at(i), 0.0, vpd, 1.0) for lo, n in stretches for i in range(lo, lo + n)]
    return spark.createDataFrame(data, CLIMATE)


@pytest.mark.parametrize("span", [3600, 30 * 86400])
def test_thirteen_rows_make_a_period_and_twelve_do_not(spark, span):
    d = weather(spark, (0, 13), (20, 12), (40, 14))
    assert rows(B.zero_periods(d, span=span).select("periodBegin", "periodEnd"), "periodBegin") == [(at(0), at(12)), (at(40), at(53))]


def test_threshold_depends_on_the_tree(spark):
    d = weather(spark, (0, 13), vpd=0.06).unionByName(weather(spark, (0, 13), tree="ET1", vpd=0.06))
    assert rows(B.zero_periods(d).select("Tree")) == [("ET1",)]


def test_conditions_are_strict_and_missing_breaks(spark):
    d = weather(spark, (0, 14)).withColumn("Wetness", F.when(F.col("Timestamp") != at(7), F.col("Wetness")))
    assert rows(B.zero_periods(d)) == []
    assert rows(B.zero_periods(weather(spark, (0, 13), vpd=0.05))) == []
    assert rows(B.zero_periods(weather(spark))) == []


def day(h, m=0, d=2):
    return datetime(2024, 1, d, h, m)


@pytest.mark.parametrize("begin,end,want", [
    (day(5, 45, 1), day(5, 0), (day(5, 45, 1), day(5, 0))),
    (day(6, 0, 1), day(5, 0), (day(18, 0, 1), day(5, 0))),
    (day(17, 59, 1), day(5, 0), (day(18, 0, 1), day(5, 0))),
    (day(18, 0, 1), day(6, 0), (day(18, 0, 1), day(6, 0))),
    (day(22, 0, 1), day(6, 15), (day(22, 0, 1), day(6, 0))),
    (day(22, 0, 1), day(17, 45), (day(22, 0, 1), day(6, 0))),
    (day(22, 0, 1), day(18, 0), (day(22, 0, 1), day(18, 0))),
    (day(4, 0), day(8, 0), None),
    (day(7, 0), day(10, 30), None),
    (day(1, 0), day(4, 0), (day(1, 0), day(4, 0))),
])
def test_clip_night(spark, begin, end, want):
    d = spark.createDataFrame([(begin, end, "T")], ZEROES)
    assert rows(B.clip_night(d).select("periodBegin", "periodEnd")) == ([want] if want else [])


def test_periods_are_nights_of_three_to_twelve_hours(spark):
    """Whatever the weather, clipped periods lie in the night and do not overlap."""
    d = weather(spark, (0, 40), (50, 200), (300, 13), (330, 30)).withColumn("Station", F.lit("S1"))
    got = rows(build_zeroes(d).select("periodBegin", "periodEnd"), "periodBegin")
    assert got
    for i, (b, e) in enumerate(got):
        assert (e - b).total_seconds() >= 3 * 3600
        assert not 6 <= b.hour < 18 and not (e.hour, e.minute) > (6, 0) or e.hour >= 18
        assert i == 0 or got[i - 1][1] < b


def test_number_periods_from_the_start_of_the_data(spark):
    z = spark.createDataFrame([(at(-5), at(0), "T"), (at(30), at(40), "T"), (at(10), at(20), "T")], ZEROES)
    tier = spark.createDataFrame([("T", "1a", at(0), 1.0, 1.0, 1.0)], TIER)
    assert rows(B.number_periods(z, tier).select("Group", "periodBegin"), "Group") == [(1, at(10)), (2, at(30))]


def bump_case(spark, action, steps=500, letter_at=80):
    """One cable, periods at 10 and 400, an action at 80; the cable's label changes there."""
    data = [("FB1", "4a" if i < letter_at else "4b", at(i), 5.0, 6.0, 7.0) for i in range(steps)]
    tier = spark.createDataFrame(data, TIER)
    zeroes = spark.createDataFrame([(at(10), at(24), "FB1"), (at(400), at(420), "FB1")], ZEROES)
    actions = spark.createDataFrame([("FB1", 4, at(letter_at), action)], ACTIONS)
    return build_l3(tier, zeroes, actions, span=100 * 900)


def test_a_move_uses_the_next_period(spark):
    tier, flags = bump_case(spark, "R")
    assert flags.count() == 0
    assert rows(tier.select("outer_vel", "middle_vel", "inner_vel").distinct()) == [(0.0, 0.0, 0.0)]


def test_another_action_leaves_rows_without_a_baseline(spark):
    tier, flags = bump_case(spark, "H")
    got = flags.agg(F.count("*"), F.min("Timestamp"), F.max("Timestamp"), F.min("Cable"), F.max("Cable")).first()
    assert tuple(got) == (320, at(80), at(399), "4b", "4b")
    assert rows(flags.select("baseline_inner", "baseline_middle", "baseline_outer").distinct()) == [("no_bl_val",) * 3]
    assert tier.where("outer_vel = 5.0").count() == 320


def test_action_on_a_period_start_is_lost_and_last_period_is_not_passed(spark):
    tier = spark.createDataFrame([("T", "1", at(i), 1.0, 1.0, 1.0) for i in range(30)], TIER).withColumn("cable_no", F.lit(1))
    periods = spark.createDataFrame([("T", at(5), at(6), 1), ("T", at(20), at(21), 2)], "Tree string, periodBegin timestamp_ntz, periodEnd timestamp_ntz, Group long")
    acts = spark.createDataFrame([("T", 1, at(5), "AddOne"), ("T", 1, at(25), "AddOne")], ACTIONS)
    groups = [r[0] for r in rows(B.bump_group(tier, periods, acts, span=4500).select("Group"), "Timestamp")]
    assert groups == [0] * 5 + [1] * 15 + [2] * 10
    acts = spark.createDataFrame([("T", 1, at(8), "AddOne"), ("T", 1, at(9), "H")], ACTIONS)
    groups = [r[0] for r in rows(B.bump_group(tier, periods, acts, span=4500).select("Group"), "Timestamp")]
    assert groups == [0] * 5 + [1] * 3 + [2] + [1] * 11 + [2] * 10


def test_period_on_the_first_row_counts_as_zero(spark):
    tier = spark.createDataFrame([("T", "1a", at(i), 1.0, 1.0, 1.0) for i in range(8)], TIER)
    periods = spark.createDataFrame([("T", at(0), at(2), 1), ("T", at(5), at(6), 2)], "Tree string, periodBegin timestamp_ntz, periodEnd timestamp_ntz, Group long")
    assert [r[0] for r in rows(B.asof_group(tier, periods, span=1800).select("Group"), "Timestamp")] == [0] * 5 + [2] * 3


def test_baseline_values_copy_the_first_and_carry_over_missing(spark):
    data = [("T", "1a", at(i), 4.0 if i < 5 else None, None if i < 5 else 3.0, float(i)) for i in range(10)]
    tier = spark.createDataFrame(data, TIER)
    periods = spark.createDataFrame([("T", at(1), at(3), 1), ("T", at(6), at(8), 2)], "Tree string, periodBegin timestamp_ntz, periodEnd timestamp_ntz, Group long")
    got = rows(B.baseline_values(tier, periods, span=1).select("Group", "baseline_outer", "baseline_middle", "baseline_inner"), "Group")
    assert got == [(0, 4.0, 0.0, 2.0), (1, 4.0, 0.0, 2.0), (2, 4.0, 3.0, 7.0)]


def test_trees_without_periods_are_skipped_and_listed_periods_dropped(spark):
    tier = spark.createDataFrame([(t, "1a", at(i), 5.0, 5.0, 5.0) for t in ("FB2", "XX9") for i in range(60)], TIER)
    begins = [at(5), at(20), at(40)]
    zeroes = spark.createDataFrame([(b, b + (at(3) - at(0)), "FB2") for b in begins], ZEROES)
    excluded = spark.createDataFrame([("FB2", at(5)), ("FB2", at(20))], "Tree string, periodBegin timestamp_ntz")
    out, flags = build_l3(tier, zeroes, spark.createDataFrame([], ACTIONS), excluded)
    assert rows(out.select("Tree").distinct()) == [("FB2",)]
    assert flags.count() == 0 and out.count() == 60


def test_rule_defaults():
    assert ZeroRule().min_rows == 13 and ZeroRule().step_seconds == 900
