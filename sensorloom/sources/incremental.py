"""Import log, incremental import, rollback and backfill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.config import STEP_SECONDS
from sensorloom.functions.columns import shift
from sensorloom.operators.joins import salted_join
from sensorloom.operators.reshape import union_distinct


def new_series(df: DataFrame, log: DataFrame, key: str = "Tree", time: str = "Timestamp") -> DataFrame:
    """Rows of series the log does not know; they are loaded whole."""
    return salted_join(df, log.select(key), [key], time, "left_anti")


def incremental_filter(df: DataFrame, log: DataFrame, key: str = "Tree", time: str = "Timestamp", last: str = "last_import") -> DataFrame:
    """Rows newer than their series' last import. Series without a log entry give nothing here."""
    return salted_join(df, log.select(key, last), [key], time, "inner").where(F.col(time) > F.col(last)).drop(last)


def import_batch(df: DataFrame, log: DataFrame, key: str = "Tree", time: str = "Timestamp", last: str = "last_import") -> DataFrame:
    """What an import adds: new series whole, known series from their last import on."""
    d = salted_join(df, log.select(key, F.col(last), F.lit(True).alias("_known")), [key], time)
    fresh = F.col("_known").isNull() | (F.col(time) > F.col(last))
    return d.where(fresh).drop(last, "_known")


def import_log_upsert(log: DataFrame, ends: DataFrame, key: str = "Tree", last: str = "last_import") -> DataFrame:
    """Log with the new ends of the imported series; others stay, new series are added."""
    new = ends.select(key, F.col(last).alias("_new"))
    return log.join(new, key, "full").select(key, F.coalesce("_new", last).alias(last))


def import_ends(df: DataFrame, key: str = "Tree", time: str = "Timestamp", last: str = "last_import") -> DataFrame:
    return df.groupBy(key).agg(F.max(time).alias(last))


def import_log_refresh(log: DataFrame, raw: DataFrame, key: str = "Tree", time: str = "Timestamp", last: str = "last_import") -> DataFrame:
    """Log rebuilt from the newest raw row of each series."""
    return import_log_upsert(log, import_ends(raw, key, time, last), key, last)


def import_report(df: DataFrame, log: DataFrame, key: str = "Tree", time: str = "Timestamp", last: str = "last_import") -> DataFrame:
    """Per series: rows to import, repeated times among them, days missing before the first, and a status."""
    batch = import_batch(df, log, key, time, last).groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(time) - F.count_distinct(time)).alias("duplicates"),
        F.min(time).alias("_first"),
    )
    seen = df.groupBy(key).agg(F.max(time).alias("import_ends"))
    d = seen.join(batch, key, "left").join(log, key, "left")
    days = F.round((F.unix_timestamp("_first") - F.unix_timestamp(last)) / 86400.0, 1)
    status = F.when(F.col("rows").isNull(), "no import needed").when(F.col(last).isNull(), "new series").otherwise("imported")
    return d.select(
        key, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"),
        days.alias("missing_days"), status.alias("status"),
    )


def skip_missing_input(df: DataFrame, available: DataFrame, key: str = "Tree", time: str = "Timestamp") -> DataFrame:
    """Rows of the series for which the other input exists."""
    return salted_join(df, available.select(key).distinct(), [key], time, "left_semi")


def rollback_tier(df: DataFrame, to: str, trees: Sequence[str], key: str = "Tree", time: str = "Timestamp") -> DataFrame:
    """Rows up to a time for the listed series; other series untouched."""
    limit = F.lit(to).cast(df.schema[time].dataType)
    return df.where(~F.col(key).isin(*trees) | (F.col(time) <= limit))


def rollback_log(log: DataFrame, to: str, trees: Sequence[str], key: str = "Tree", last: str = "last_import") -> DataFrame:
    limit = F.lit(to).cast(log.schema[last].dataType)
    return log.withColumn(last, F.when(F.col(key).isin(*trees), limit).otherwise(F.col(last)))


def backfill_merge(old: DataFrame, reread: DataFrame) -> DataFrame:
    """Old and re-read rows, exact duplicates removed."""
    return union_distinct(old, reread)


def backfill_window_replace(tier: DataFrame, redone: DataFrame, extents: DataFrame, key: str = "Tree", time: str = "Timestamp") -> DataFrame:
    """Replace each series' affected time range by rows processed anew.

    ``extents`` has (Tree, first, last) of the re-read data; series without one stay as they are.
    """
    d = salted_join(tier, extents.select(key, "first", "last"), [key], time)
    kept = d.where(F.col("first").isNull() | (F.col(time) < F.col("first")) | (F.col(time) > F.col("last"))).select(*tier.columns)
    return kept.unionByName(redone)


def restart_points(extents: DataFrame, key: str = "Tree", step: int = STEP_SECONDS) -> DataFrame:
    """Where processing resumes after a backfill: one step before the affected range."""
    return extents.select(key, shift("first", -step).alias("old_end"), F.col("last").alias("new_end"))

