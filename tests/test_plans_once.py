"""How often a plan reads its input and shuffles, and the carried forms against plain loops."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from sensorloom.operators import baseline as B
from sensorloom.operators import series as S
from sensorloom.operators.ordered import last_place, latest_event, next_place, openings, ordered


def plan(df) -> tuple[int, int]:
    """Scans and exchanges, without what is broadcast."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"FileScan", text)), len(re.findall(r"\bExchange ", text))


@pytest.fixture()
def tables(spark, tmp_path):
    rng = random.Random(3)
    tier = [("T", f"{c}a", at(i), None if rng.random() < 0.3 else rng.random(), 1.0, 1.0) for c in (1, 2) for i in range(200) if rng.random() < 0.9]
    periods = [("T", at(b), at(b + 9), n + 1, at(0)) for n, b in enumerate(range(7, 190, 20))]
    acts = [("T", 1, at(i), rng.choice(["AddOne", "H"])) for i in range(0, 200, 9)]
    made = {
        "tier": spark.createDataFrame(tier, "Tree string, Cable string, Timestamp timestamp, outer_vel double, middle_vel double, inner_vel double"),
        "periods": spark.createDataFrame(periods, "Tree string, periodBegin timestamp, periodEnd timestamp, Group long, dataStart timestamp"),
        "acts": spark.createDataFrame(acts, "Tree string, Cable int, Timestamp timestamp, Action string"),
    }
    for name, df in made.items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in made}


def test_the_tier_is_read_and_shuffled_few_times(tables):
    tier, periods, acts = tables["tier"], tables["periods"], tables["acts"]
    numbered = tier.withColumn("cable_no", F.col("Cable").substr(1, 1).cast("int"))
    for df in (B.asof_group(tier, periods), B.bump_group(numbered, periods, acts), B.baseline_values(tier, periods)):
        scans, exchanges = plan(df)
        assert scans <= 4 and exchanges <= 6
    for df in (S.run_lengths(tier, ["Tree", "Cable"], "outer_vel"), S.segment_ids(tier, ["Tree", "Cable"], "outer_vel"), S.interpolate_small(tier, ["Tree", "Cable"], "outer_vel")):
        scans, exchanges = plan(df)
        assert scans <= 2 and exchanges <= 4
    calm = tier.selectExpr("Tree", "Timestamp", "1.0 AS Wetness", "0.0 AS Solar", "0.0 AS VPD").dropDuplicates()
    scans, exchanges = plan(B.zero_periods(calm))
    assert scans <= 2 and exchanges <= 2


@pytest.mark.parametrize("span", [900, 4500, 10**8])
def test_places_and_openings(spark, span):
    rng = random.Random(span)
    flags = {k: [rng.random() < p for _ in range(60)] for k, p in (("a", 0.5), ("b", 0.05), ("c", 1.0), ("d", 0.0))}
    # Times with holes, so that some pieces have no rows.
    times = {k: sorted(rng.sample(range(200), 60)) for k in flags}
    df = spark.createDataFrame([(k, at(t), f) for k in flags for t, f in zip(times[k], flags[k])], "k string, t timestamp, f boolean")
    d = ordered(df, ["k"], "t", span, n=openings("f"), lo=last_place("f"), hi=next_place("f"))
    for k, fs in flags.items():
        got = [(r.n, r.lo, r.hi) for r in d.where(F.col("k") == k).orderBy("t").collect()]
        want = []
        for i in range(60):
            low = [j + 1 for j in range(i + 1) if fs[j]]
            high = [j + 1 for j in range(i, 60) if fs[j]]
            want.append((sum(fs[j] and not (j and fs[j - 1]) for j in range(i + 1)), low[-1] if low else None, high[0] if high else None))
        assert got == want


@pytest.mark.parametrize("span", [900, 4500, 10**8])
def test_latest_event(spark, span):
    rng = random.Random(7)
    times = sorted(rng.sample(range(300), 120))
    events = {t: (rng.choice([None, t]), rng.choice([None, f"s{t}"])) for t in rng.sample(range(300), 60)}
    df = spark.createDataFrame([("k", at(t), float(t), "mine") for t in times] + [("other", at(1), 1.0, "mine")], "k string, t timestamp, v double, _new string")
    ev = spark.createDataFrame([("k", at(t), x, y) for t, (x, y) in events.items()], "k string, t timestamp, x long, y string")
    got = latest_event(df, ev, ["k"], "t", ["x", "y"], span)
    assert got.columns == ["k", "t", "v", "_new", "x", "y"]
    want, x, y = [], None, None
    for t in times:
        # Only an event on a row counts.
        x, y = (events[t][0] if t in events and events[t][0] is not None else x), (events[t][1] if t in events and events[t][1] is not None else y)
        want.append(("k", at(t), float(t), "mine", x, y))
    assert rows(got, "k", "t") == [*want, ("other", at(1), 1.0, "mine", None, None)]
    assert rows(latest_event(df, ev.limit(0), ["k"], "t", ["x"], span).where("x is not null")) == []
