"""Row filters and orderings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.columns import any_set, seconds, shift
from sensorloom.operators.joins import salted_join


def filter_date_range(df: DataFrame, start: str, end: str, time: str = "Timestamp", half_open: bool = False) -> DataFrame:
    """Rows with start <= t <= end, or start <= t < end."""
    kind = df.schema[time].dataType
    lo, hi = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return df.where((F.col(time) >= lo) & ((F.col(time) < hi) if half_open else (F.col(time) <= hi)))


def recent_window(df: DataFrame, days_ago_to_end: int = 1, days_to_view: int = 10, time: str = "Timestamp") -> DataFrame:
    """Rows of the ``days_to_view`` days that end ``days_ago_to_end`` days before the newest row."""
    newest = df.agg(F.max(time)).scalar()
    end = shift(newest, -days_ago_to_end * 86400)
    start = shift(newest, -(days_ago_to_end + days_to_view) * 86400)
    return df.where((F.col(time) >= start) & (F.col(time) < end))


def filter_cable_prefix(df: DataFrame, cable: str, col: str = "Cable") -> DataFrame:
    """Rows whose cable label starts with the given number."""
    return df.where(F.substring(F.col(col).cast("string"), 1, len(cable)) == cable)


def quality_voltage(df: DataFrame, col: str = "Big_Battery_Voltage", above: float | None = None) -> DataFrame:
    """Rows with a working battery: not zero, and above a limit if one is given."""
    return df.where(F.col(col) != 0) if above is None else df.where(F.col(col) > above)


def any_flag_filter(df: DataFrame, *flags: str) -> DataFrame:
    """Rows with at least one flag."""
    return df.where(any_set(*flags))


def sort_tier(df: DataFrame, *by: str) -> DataFrame:
    """Total order for output, missing last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (by or ("Tree", "Cable", "Timestamp"))])


def last_k(df: DataFrame, k: int, keys: Sequence[str], order: Sequence[str], before: str | None = None) -> DataFrame:
    """Last ``k`` rows of each series, optionally up to a time. Spark cuts each task's input to k rows per series first."""
    d = df if before is None else df.where(F.col(order[0]) <= F.lit(before).cast(df.schema[order[0]].dataType))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return d.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def head_tail(df: DataFrame, order: Sequence[str], n: int = 6) -> tuple[DataFrame, DataFrame]:
    """First and last ``n`` rows."""
    return df.orderBy(*order).limit(n), df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def nearest_point(df: DataFrame, at: str, value: float, time: str = "Timestamp", col: str = "Velocity", per_second: float = 1.0, per_unit: float = 1.0, ties: Sequence[str] = ()) -> DataFrame:
    """The row nearest to a (time, value) point, by scaled Euclidean distance."""
    target = F.lit(at).cast(df.schema[time].dataType)
    distance = F.sqrt(
        F.pow((seconds(time) - seconds(target)) * per_second, F.lit(2.0)) + F.pow((F.col(col) - F.lit(value)) * per_unit, F.lit(2.0))
    )
    return df.where(F.col(col).isNotNull()).orderBy(distance, *ties).limit(1)


def box_select(df: DataFrame, start: str, end: str, lo: float, hi: float, time: str = "Timestamp", col: str = "Velocity") -> DataFrame:
    """Rows in a time x value rectangle, borders included."""
    return filter_date_range(df, start, end, time).where(F.col(col).between(lo, hi))


def group_min_filter(df: DataFrame, keys: Sequence[str], col: str, spread_by: str) -> DataFrame:
    """Rows that hold the smallest ``col`` of their key."""
    least = df.groupBy(*keys).agg(F.min(col).alias("_least"))
    return salted_join(df, least, list(keys), spread_by, "inner").where(F.col(col) == F.col("_least")).drop("_least")


def duplicated_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows that repeat an earlier row's key, ``order`` (unique) saying what is earlier."""
    first = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    return df.join(first, list(keys)).where(F.col(order) > F.col("_first")).drop("_first")
