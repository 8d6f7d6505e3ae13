"""Regular grids, intervals on a grid, masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.config import SERIES, SPAN_SECONDS, STEP_SECONDS
from sensorloom.functions.columns import null_where, seconds, shift

# Slots made per generated row in the first of two steps; bounds the array a row can hold.
SLOTS_PER_PIECE = 2048


def expand_steps(
    df: DataFrame,
    start: str | Column,
    end: str | Column,
    step: int = STEP_SECONDS,
    name: str = "Timestamp",
    spread: bool = False,
) -> DataFrame:
    """One row per step from ``start`` to ``end``, both included, anchored at ``start``.

    Rows with an end before the start, or a missing end, give nothing. A long span
    is expanded in two steps so that no row carries an unbounded array; ``spread``
    sends the pieces to different tasks in between.
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    kept = df.columns
    d = df.withColumns({"_from": start, "_to": end})
    d = d.withColumn("_n", F.floor((seconds("_to") - seconds("_from")) / F.lit(step)).cast("long")).where("_n >= 0")
    d = d.withColumn("_lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n"), F.lit(SLOTS_PER_PIECE).cast("long"))))
    if spread:
        d = d.repartition(*[c for c in kept if c != name], "_lo")
    hi = F.least(F.col("_lo") + (SLOTS_PER_PIECE - 1), F.col("_n"))
    d = d.withColumn("_k", F.explode(F.sequence(F.col("_lo"), hi)))
    return d.select(*[c for c in kept if c != name], shift("_from", F.col("_k") * F.lit(step)).alias(name))


def make_grid(
    spans: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = SERIES,
    step: int = STEP_SECONDS,
    time: str = "Timestamp",
) -> DataFrame:
    """All slots of every series from ``start`` to ``end``; ``spans`` has one row per series."""
    return expand_steps(spans.select(*keys, start, end), start, end, step, time, spread=True).select(*keys, time)


def grid_left_join(grid: DataFrame, df: DataFrame, keys: Sequence[str] = (*SERIES, "Timestamp")) -> DataFrame:
    """Make missing rows explicit. Rows of ``df`` that are off the grid fall away."""
    return grid.join(df, list(keys), "left")


def expand_intervals(
    df: DataFrame,
    start: str = "Start",
    end: str = "End",
    keep: Sequence[str] = (),
    step: int = STEP_SECONDS,
    time: str = "Timestamp",
) -> DataFrame:
    """Interval rows to slot rows; slots that several intervals share come once."""
    return expand_steps(df.select(*keep, start, end), start, end, step, time).select(*keep, time).distinct()


def mask_intervals(
    df: DataFrame,
    intervals: DataFrame,
    on: Sequence[str] = ("Tree", "Cable", "Position"),
    start: str = "Start",
    end: str = "End",
    time: str = "Timestamp",
    value: str = "Velocity",
    step: int = STEP_SECONDS,
    flag: str | None = None,
    align: bool = False,
    span: int = SPAN_SECONDS,
) -> DataFrame:
    """Set values inside bad windows to missing.

    By default only rows at ``start + k * step`` are hit, so a window that starts
    off the grid hits nothing on it. With ``align`` every row in [start, end] is hit.
    """
    if align:
        return mask_between(df, intervals, on, start, end, time, [value], span, flag)
    hit = expand_intervals(intervals, start, end, on, step, time).withColumn("_bad", F.lit(1))
    bad_data = F.coalesce(F.col("_bad"), F.lit(0))
    d = df.join(hit, [*on, time], "left").withColumn(value, null_where(value, bad_data == 1))
    d = d.withColumn(flag, bad_data) if flag else d
    return d.select(*df.columns, *([flag] if flag else []))


def mask_wide(
    df: DataFrame,
    intervals: DataFrame,
    cols: Sequence[str],
    on: Sequence[str] = SERIES,
    start: str = "Start",
    end: str = "End",
    position: str = "Position",
    time: str = "Timestamp",
    step: int = STEP_SECONDS,
) -> DataFrame:
    """``mask_intervals`` for measures side by side: one join instead of a melt, a join and a cast."""
    hit = expand_intervals(intervals, start, end, [*on, position], step, time).groupBy(*on, time).agg(
        *[F.max(F.when(F.col(position) == c, True)).alias(f"_bad_{c}") for c in cols]
    )
    d = df.join(hit, [*on, time], "left")
    return d.select(*[null_where(c, F.col(f"_bad_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def mask_between(
    df: DataFrame,
    intervals: DataFrame,
    on: Sequence[str] = SERIES,
    start: str = "Start",
    end: str = "End",
    time: str = "Timestamp",
    cols: Sequence[str] = ("Velocity",),
    span: int = SPAN_SECONDS,
    flag: str | None = None,
) -> DataFrame:
    """Set values of all rows in [start, end] of their series to missing, on the grid or off it.

    Each interval is repeated once per piece of time it touches; readings meet the intervals of
    their (series, piece) in one join, so neither a long series nor a long interval fills one task.
    """
    bad = intervals.select(*on, F.col(start).alias("_s"), F.col(end).alias("_e")).where(F.col(end) >= F.col(start))
    bad = bad.withColumn("_p", F.explode(F.sequence(
        F.floor(seconds("_s") / F.lit(span)), F.floor(seconds("_e") / F.lit(span))
    ))).groupBy(*[F.col(c).alias(f"_k_{c}") for c in on], "_p").agg(F.collect_list(F.struct("_s", "_e")).alias("_bad"))
    d = df.withColumn("_piece", F.floor(seconds(time) / F.lit(span)))
    d = d.join(bad, [F.col(c) == F.col(f"_k_{c}") for c in on] + [F.col("_piece") == F.col("_p")], "left")
    inside = F.coalesce(F.exists("_bad", lambda b: F.col(time).between(b["_s"], b["_e"])), F.lit(False))
    out = [F.when(~inside, F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]
    return d.select(*out, *([inside.cast("int").alias(flag)] if flag else []))


def mask_dormancy(
    df: DataFrame,
    dormancy: DataFrame,
    on: Sequence[str] = SERIES,
    time: str = "Timestamp",
    cols: Sequence[str] = ("outer_vel",),
    start: str = "Dormant",
    end: str = "Returned",
    span: int = SPAN_SECONDS,
) -> DataFrame:
    """Set values within [Dormant, Returned] of their sensor to missing; drop exact duplicates."""
    return mask_between(df, dormancy, on, start, end, time, cols, span).distinct()
