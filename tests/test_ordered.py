"""Piecewise ordered work equals a plain window over the whole series."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import T0, at, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.operators.ordered import following, last_known, lag_lead, next_known, ordered, position, previous, running, runs

SCHEMA = "k string, t timestamp_ntz, v double"


@pytest.fixture(scope="module")
def ragged(spark):
    rng = random.Random(7)
    data = []
    for k in ("a", "b", "c"):
        t = T0
        for _ in range(300 if k == "a" else 40):
            t += timedelta(seconds=rng.choice([900, 900, 900, 1800, 86400]))
            data.append((k, t, rng.random() * 10 if rng.random() > 0.6 else None))
    return spark.createDataFrame(data, SCHEMA).cache()


@pytest.mark.parametrize("span", [900, 86400, 10**9])
def test_specs_equal_plain_windows(ragged, span):
    got = ordered(
        ragged, ["k"], "t", span,
        last=last_known("v"), nxt=next_known("v"), total=running("v"), n=position(), prev=previous("v"), fol=following("v"),
    )
    w = Window.partitionBy("k").orderBy("t")
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = ragged.select(
        "k", "t", "v", F.last("v", True).over(upto).alias("last"), F.first("v", True).over(onward).alias("nxt"),
        F.sum(F.coalesce("v", F.lit(0.0))).over(upto).alias("total"), F.row_number().over(w).cast("long").alias("n"),
        F.lag("v").over(w).alias("prev"), F.lead("v").over(w).alias("fol"),
    )
    total = F.round("total", 9).alias("total")
    cols = ["k", "t", "v", "last", "nxt", total, "n", "prev", "fol"]
    assert rows(got.select(*cols), "k", "t") == rows(want.select(*cols), "k", "t")


@pytest.mark.parametrize("span", [1800, 86400, 10**9])
@pytest.mark.parametrize("step", [None, 900])
def test_runs_equal_a_loop(ragged, span, step):
    data = [tuple(r) for r in ragged.orderBy("k", "t").collect()]
    want, open_run = [], None
    for i, (k, t, v) in enumerate(data):
        flagged = v is None
        before = data[i - 1] if i and data[i - 1][0] == k else None
        goes_on = flagged and before is not None and before[2] is None and (step is None or (t - before[1]).total_seconds() == step)
        if goes_on:
            open_run[2], open_run[3] = t, open_run[3] + 1
        elif flagged:
            open_run = [k, t, t, 1]
            want.append(open_run)
    got = runs(ragged, ["k"], "t", F.col("v").isNull(), step, span)
    assert rows(got, "k", "run_start") == [tuple(w) for w in want]


def test_numeric_order_with_ties_broken(spark):
    df = spark.createDataFrame([("x", 1, "b"), ("x", 1, "a"), ("x", 9, "c"), ("x", 20, "d")], "k string, n long, s string")
    got = lag_lead(df, ["k"], ["n", "s"], "s", span=5)
    assert rows(got.select("s", "down1", "up1"), "s") == [("a", None, "b"), ("b", "a", "c"), ("c", "b", "d"), ("d", "c", None)]


def test_missing_value_at_a_border_is_not_skipped(spark):
    df = spark.createDataFrame([("x", at(0), 1.0), ("x", at(1), None), ("x", at(2), 3.0)], SCHEMA)
    got = ordered(df, ["k"], "t", 900, p=previous("v"), f=following("v"))
    assert rows(got.select("p", "f"), "t") == [(None, None), (1.0, 3.0), (None, None)]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rows(ordered(df, ["k"], "t", 900, a=last_known("v"))) == []
    assert rows(runs(df, ["k"], "t", F.lit(True), 900)) == []
