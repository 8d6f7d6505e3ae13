"""The forest: its rows reach all cores, are computed once, and what it finds is in them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import models as M

ROWS = 3000


@pytest.fixture
def series(spark):
    """A step in a and a slope in b, out of a shuffle that is small enough to be packed into one part; each row computed is counted."""
    seen = spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return v

    d = spark.range(ROWS).groupBy((F.col("id") * 7 % ROWS).alias("id")).agg(F.max(F.col("id") * 7 % ROWS).alias("n"))
    d = d.select("id", (F.col("n") % 7).cast("double").alias("a"), (F.col("n") % 101).cast("double").alias("b"))
    return d.withColumn("y", F.when(F.col("a") > 3, 50.0).otherwise(0.0) + F.col("b")), F.udf(counted, "double").asNondeterministic(), seen


def test_forest_rows_are_dealt_to_all_cores(spark, series, monkeypatch):
    d, _, _ = series
    parts, fit = [], M.Pipeline.fit
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, rows: parts.append(rows.rdd.glom().map(len).collect()) or fit(self, rows))
    out = M.forest_regress(d.where("id % 4 < 3"), d.where("id % 4 = 3"), "y", ("a", "b"), trees=5)
    cores = spark.sparkContext.defaultParallelism
    assert sum(parts[0]) == ROWS * 3 // 4 and len(parts[0]) == cores and max(parts[0]) <= 2 * ROWS // cores
    assert out.rdd.getNumPartitions() >= cores


def test_forest_tasks_hold_a_bounded_number_of_rows(spark, series, monkeypatch):
    d, _, _ = series
    parts, fit = [], M.Pipeline.fit
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, rows: parts.append(rows.rdd.glom().map(len).collect()) or fit(self, rows))
    monkeypatch.setattr(M, "TRAIN_ROWS", 100)
    M.forest_regress(d, d, "y", ("a", "b"), trees=2)
    assert sum(parts[0]) == ROWS and max(parts[0]) <= 101


def test_forest_computes_its_rows_once(series):
    d, counted, seen = series
    out = M.forest_regress(d.withColumn("y", counted("y")), d.where("id < 0"), "y", ("a", "b"), trees=5)
    assert out.count() == 0 and seen.value == ROWS


def test_forest_finds_a_known_signal(series):
    d, _, _ = series
    train = d.withColumn("y", F.when(F.col("id") % 10 > 0, F.col("y"))).where("id % 4 < 3")
    test = d.withColumn("a", F.when(F.col("id") % 8 != 3, F.col("a"))).where("id % 4 = 3")
    out = M.forest_regress(train, test, "y", ("a", "b"), trees=30)
    assert out.columns == [*test.columns, "pred"]
    assert out.count() == test.where("a IS NOT NULL").count()
    assert out.agg(F.corr("y", "pred")).first()[0] > 0.95
