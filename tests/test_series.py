"""Letters, gaps, imputation, outliers on small frames."""

from __future__ import annotations

import random
import statistics

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.operators import series as S
from sensorloom.operators.outliers import hampel, split_flags

LONG = "Tree string, Cable int, Timestamp timestamp_ntz, Velocity double"
KEYS = ["Tree", "Cable"]


def series(spark, values, tree="T1", cable=1):
    return spark.createDataFrame([(tree, cable, at(i), v) for i, v in enumerate(values)], LONG)


@pytest.fixture(scope="module")
def gaps8(spark):
    return series(spark, [None, 2.0, 4.0, None, 8.0, None, None, 14.0])


def test_impute_single(gaps8):
    got = rows(S.impute_single(gaps8, KEYS, span=1800).select("imputedY", "imputed"), "Timestamp")
    assert got == [(None, 1), (2.0, 0), (4.0, 0), (6.0, 1), (8.0, 0), (None, 0), (None, 0), (14.0, 0)]


def test_interpolate_small(gaps8):
    got = [r[0] for r in rows(S.interpolate_small(gaps8, KEYS, span=1800).select("filled"), "Timestamp")]
    assert got == [None, 2.0, 4.0, 6.0, 8.0, 10.0, 12.0, 14.0]
    short = [r[0] for r in rows(S.interpolate_small(gaps8, KEYS, longest=1).select("filled"), "Timestamp")]
    assert short == [None, 2.0, 4.0, 6.0, 8.0, None, None, 14.0]


def test_run_lengths_and_small_gaps(gaps8):
    assert rows(S.run_lengths(gaps8, KEYS, "Velocity", span=1800).select("gap", "first_missing", "last_missing", "length"), "gap") == [
        (1, at(0), at(0), 1), (2, at(3), at(3), 1), (3, at(5), at(6), 2)
    ]
    small = S.small_gaps(gaps8, KEYS, "Velocity", longest=1)
    assert rows(small.select("gap", "length", "Start", "End"), "gap") == [(1, 1, at(-1), at(1)), (2, 1, at(2), at(4))]
    padded = S.expand_gaps(small, KEYS)
    assert rows(padded.select("gap", "Timestamp"), "gap", "Timestamp") == [(1, at(-1)), (1, at(0)), (1, at(1)), (2, at(2)), (2, at(3)), (2, at(4))]


def test_lengths_sum_to_missing(spark):
    rng = random.Random(3)
    values = [None if rng.random() < 0.5 else 1.0 for _ in range(200)]
    got = S.run_lengths(series(spark, values), KEYS, "Velocity", span=7200).agg(F.sum("length")).first()[0]
    assert got == values.count(None)


def test_segments_and_context(gaps8):
    assert rows(S.segment_ids(gaps8, KEYS, "Velocity", span=1800).select("missingLoc", "sameSlot"), "missingLoc") == [(1, 1), (4, 2), (6, 3), (7, 3)]
    ctx = S.gap_context(gaps8, KEYS, "Velocity", rows=1, span=1800)
    assert rows(ctx.select("gap", "index"), "gap", "index") == [(1, 1), (1, 2), (2, 3), (2, 4), (2, 5), (3, 5), (3, 6), (3, 7), (3, 8)]


def test_no_gaps_gives_nothing(spark):
    d = series(spark, [1.0, 2.0])
    assert rows(S.run_lengths(d, KEYS, "Velocity")) == []
    assert rows(S.small_gaps(d, KEYS, "Velocity")) == []


ACTIONS = "Tree string, Cable int, Timestamp timestamp_ntz, Action string, file_pos long"


def test_letters_follow_file_order_and_stop_at_d(spark):
    # The second action has no time: it uses up letter c. The fourth has no letter.
    actions = spark.createDataFrame([
        ("T1", 1, at(2), "M", 10), ("T1", 1, None, "H", 20), ("T1", 1, at(4), "R3", 30), ("T1", 1, at(6), "MR", 40), ("T1", 1, at(1), None, 5),
    ], ACTIONS)
    events = S.letter_events(actions, span=7)
    assert rows(events.select("Action", "letter"), "file_pos") == [("AddOne", "b"), ("H", "c"), ("R3", "d"), ("AddOne", None)]
    got = S.letter_series(series(spark, [1.0] * 8), events)
    assert "".join(r[0] for r in rows(got.select("letter"), "Timestamp")) == "aabbdddd"


def test_first_row_is_a_even_on_an_action(spark):
    actions = spark.createDataFrame([("T1", 1, at(0), "M", 1), ("T1", 1, at(2), "R", 2)], ACTIONS)
    got = S.letter_series(series(spark, [1.0] * 4), S.letter_events(actions))
    assert "".join(r[0] for r in rows(got.select("letter"), "Timestamp")) == "aacc"


def brute_hampel(values, half=24, a=3.0):
    out = []
    for i, v in enumerate(values):
        window = values[i - half: i + half + 1] if i >= half and i + half < len(values) else []
        known = [x for x in window if x is not None]
        if v is None or not known:
            out.append((v, None))
            continue
        m = statistics.median(known)
        mad = 1.4826 * statistics.median(abs(x - m) for x in known)
        out.append((m, "outlier.Hampel") if abs(v - m) > a * mad else (v, None))
    return out


@pytest.mark.parametrize("block,step", [(64, None), (100, 900), (4096, None)])
def test_hampel_equals_brute_force(spark, block, step):
    rng = random.Random(11)
    values = [None if rng.random() < 0.1 else (100.0 if rng.random() < 0.03 else round(rng.gauss(5, 1), 3)) for _ in range(400)]
    d = series(spark, values).withColumnRenamed("Velocity", "outer_vel")
    d = d.withColumns({"middle_vel": F.lit(None).cast("double"), "inner_vel": F.lit(1.0)})
    got = hampel(d, block=block, step=step, span=86400)
    have = rows(got.select("outer_vel", "outer_flag"), "Timestamp")
    assert have == brute_hampel(values)
    assert got.where("middle_vel IS NOT NULL OR middle_flag IS NOT NULL OR inner_flag IS NOT NULL").count() == 0
    tier, flags = split_flags(got)
    assert tier.columns == d.columns and flags.count() == sum(f is not None for _, f in have)


def test_hampel_short_series_is_kept(spark):
    d = series(spark, [1.0] * 20 + [500.0] + [1.0] * 20).withColumnRenamed("Velocity", "outer_vel")
    got = hampel(d, cols=["outer_vel"])
    assert got.where("outer_flag IS NOT NULL").count() == 0


def test_outliers_with_holes_are_an_error_on_the_grid_and_equal_otherwise(spark):
    from sensorloom.operators.outliers import hampel

    rng = random.Random(8)
    data = [("T", 1, at(i), rng.gauss(10, 1) + (30 if i % 37 == 0 else 0), None, None) for i in range(400) if not 150 <= i < 290 and i % 53]
    d = spark.createDataFrame(data, schemas.L1)
    found = [rows(hampel(d, cols=["outer_vel"], half=5, block=b), "Timestamp") for b in (11, 64, 4096)]
    assert found[0] == found[1] == found[2]
    with pytest.raises(ValueError, match="steps"):
        hampel(d, cols=["outer_vel"], half=5, step=900)
    whole = [("T", 1, at(i), rng.gauss(10, 1) + (30 if i % 37 == 0 else 0), None, None) for i in range(300)]
    w = spark.createDataFrame(whole, schemas.L1)
    assert rows(hampel(w, cols=["outer_vel"], half=5, step=900, block=32), "Timestamp") == rows(hampel(w, cols=["outer_vel"], half=5), "Timestamp")
    twice = spark.createDataFrame([*whole[:100], *whole[101:], whole[5]], schemas.L1)
    with pytest.raises(Exception, match="repeated or odd"):
        hampel(twice, cols=["outer_vel"], half=5, step=900).collect()


def test_fills_keep_cables_without_a_sibling_and_windows_survive_holes(spark):
    from sensorloom.operators.models import fill_from_best

    def value(i):
        return 2.0 * i if i < 60 else 5 + (i % 9) * 0.5
    data = []
    for i in range(140):
        gone = 120 <= i < 124
        if i != 120 - 30 - 1:
            data.append(("T", 1, at(i), *((None,) * 3 if gone else (value(i) * 3 + 1 if i >= 60 else -value(i), None, None))))
        data.append(("T", 2, at(i), value(i), None, None))
        data.append(("T", 3, at(i), None if i == 50 else float(i), None, None))
    d = spark.createDataFrame(data, schemas.L1)
    siblings = spark.createDataFrame([("T", 1, 2), ("T", 2, 1)], "Tree string, Cable int, Sibling int")
    got = fill_from_best(d, siblings, history=30 * 900)
    assert got.count() == d.count()
    filled = rows(got.where("Cable = 1 AND source IS NOT NULL").select("Timestamp", "filled"), "Timestamp")
    assert [t for t, _ in filled] == [at(i) for i in range(120, 124)]
    assert all(abs(v - (value(i) * 3 + 1)) < 1e-6 for i, (_, v) in zip(range(120, 124), filled))
    assert rows(got.where("Cable = 3").groupBy("source").count()) == [(None, 140)]
    with pytest.raises(ValueError, match="sibling"):
        fill_from_best(d, siblings.union(siblings.limit(1)))


def test_quantiles_of_groups_of_every_size(spark):
    import numpy as np

    from sensorloom.operators.aggregates import quantiles

    rng = random.Random(12)
    groups = {n: [rng.choice([rng.random(), 0.5, 0.25]) for _ in range(n)] for n in (1, 2, 3, 7, 10, 33, 900)}
    d = spark.createDataFrame([(n, v) for n, vs in groups.items() for v in vs], "n int, v double")
    probs = (0.0, 0.05, 0.25, 0.33, 0.5, 0.75, 0.95, 1.0)
    for accuracy in (100, 10000):
        got = {(r.n, r.prob): r.value for r in quantiles(d, "v", probs, ["n"], accuracy).collect()}
        for n, vs in groups.items():
            for p in probs:
                assert abs(got[n, p] - np.quantile(vs, p)) < 1e-12, (accuracy, n, p)


def test_quantiles_narrow_a_long_group_until_few_values_are_ranked(spark):
    import numpy as np

    from sensorloom.operators.aggregates import quantiles

    # A third of the rows hold one value, some are infinite, and a small group stands beside the long one.
    d = spark.range(1_000_000).select(F.lit("long").alias("k"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e9).alias("v"))
    d = d.union(spark.createDataFrame([("long", float("inf")), ("long", float("-inf")), ("short", 1.0), ("short", 2.0), ("none", None)], "k string, v double"))
    probs = (0.0, 1e-6, 0.1, 0.333, 0.5, 0.7, 0.999, 1.0)
    values = {k: np.array([r.v for r in d.where(F.col("k") == k).select("v").collect()]) for k in ("long", "short")}
    for most in (500, 20_000):
        got = {(r.k, r.prob): r.value for r in quantiles(d, "v", probs, ["k"], most=most).collect()}
        assert len(got) == 16
        for (k, p), v in got.items():
            want = np.sort(values[k])
            at = (len(want) - 1) * p
            low, high = want[int(np.floor(at))], want[int(np.ceil(at))]
            assert v == low if low == high else abs(v - (low + (high - low) * (at - np.floor(at)))) < 1e-12, (most, k, p)
    assert rows(quantiles(d.where("k = 'none'"), "v", probs, ["k"])) == []
