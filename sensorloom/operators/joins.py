"""Joins. No broadcast hints: Spark broadcasts a side only when its size is known to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, on: Sequence[str], parts: int) -> Column:
    """Hashes of the keys that hold more rows than half a shuffle partition's share, as a scalar subquery: an array of at most ``2 * parts``.

    A mergeable frequency sketch of fixed size counts the keys in one narrow pass; every key above the bound is in it.
    """
    n, key = 2 * parts, F.xxhash64(*on)
    sketch = F.call_function("approx_top_k", key, F.lit(n), F.lit(max(10_000, 8 * n)))
    found = df.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n"))
    often = F.filter("top", lambda x: x["count"] * n > F.col("n"))
    return found.select(F.transform(often, lambda x: x["item"]).alias("hot")).scalar()


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: str | Sequence[str],
    how: str = "left",
    salts: int | None = None,
    like: DataFrame | None = None,
    like_on: Sequence[str] | None = None,
    hot: Column | None = None,
) -> DataFrame:
    """Join on keys of which one may hold much of ``left``.

    ``right`` is the smaller side. Left rows of a hot key are spread over ``salts`` partitions (the session's shuffle partitions) by a
    hash of ``spread_by``, and its right rows are repeated once per salt; all other keys keep one place and one copy,
    so the result is that of the plain join and copies grow with the hot keys only. Which keys are hot a sketch of ``left`` tells, or of
    ``like``, where a table with the same keys (or ``like_on``, some of them) is cheaper to read; ``hot`` is what ``hot_keys`` found before.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a salted join keeps left rows only: {how}")
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread_by = [spread_by] if isinstance(spread_by, str) else list(spread_by)
    keys = list(like_on or on)
    if hot is None:
        hot = hot_keys((left if like is None else like).select(*keys), keys, salts)
    is_hot = F.array_contains(hot, F.xxhash64(*keys))
    none, last = F.lit(0).cast("long"), F.lit(salts - 1).cast("long")
    spread = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(none))
    copies = right.withColumn("_salt", F.explode(F.sequence(none, F.when(is_hot, last).otherwise(none))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


def interval_lookup(df: DataFrame, expanded: DataFrame, on: Sequence[str] = ("Timestamp",)) -> DataFrame:
    """Rows inside an expanded window, tagged with the window's columns."""
    return df.join(expanded, list(on), "inner")


def join_actions(df: DataFrame, actions: DataFrame, on: Sequence[str] = ("Tree", "Cable", "Timestamp")) -> DataFrame:
    """Attach the maintenance event that falls exactly on a row."""
    return df.join(actions, list(on), "left")


def join_interval_start(df: DataFrame, periods: DataFrame, time: str = "Timestamp", begin: str = "periodBegin", on: Sequence[str] = ("Tree",)) -> DataFrame:
    """Attach a period's columns to the row at which it begins."""
    return df.join(periods.withColumnRenamed(begin, time), [*on, time], "left")


def join_on_time(df: DataFrame, other: DataFrame, on: Sequence[str] = ("Timestamp",)) -> DataFrame:
    """Attach covariates, predictions or gap numbers by their time keys."""
    return df.join(other, list(on), "left")


def semi_time(df: DataFrame, other: DataFrame, on: Sequence[str] = ("Timestamp",)) -> DataFrame:
    """Rows whose time keys occur in the other table."""
    return df.join(other.select(*on), list(on), "left_semi")


def guide_join(
    df: DataFrame,
    guide: DataFrame,
    time: str = "Timestamp",
    value_cols: Sequence[str] = ("Tree", "Cable", "Timestamp", "Position", "Velocity"),
) -> DataFrame:
    """Keep, per cable, the position the guide says to use, from the time it names on."""
    joined = salted_join(df, guide, ["Tree", "Cable"], time, "inner")
    fits = (F.col("Position") == F.col("Use")) & (F.col("Starting").isNull() | (F.col(time) >= F.col("Starting")))
    return joined.where(fits).select(*value_cols)


def neighbour_join(
    df: DataFrame,
    sibling: DataFrame,
    cols: Sequence[str],
    on: Sequence[str] = ("Tree", "Timestamp"),
    suffix: str = "_sib",
) -> DataFrame:
    """Put a sibling cable's measures beside a series' own."""
    other = sibling.select(*on, *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return df.join(other, list(on), "left")


def flag_overlay(flags: DataFrame, tier: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("Tree", "Cable", "Timestamp")) -> DataFrame:
    """Measures of the flagged rows, in long form."""
    return flags.select(*keys).join(tier.select(*keys, *cols), list(keys), "left").unpivot(
        list(keys), list(cols), "Position", "Velocity"
    )


def drop_listed(df: DataFrame, excluded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drop rows named in an exclusion table."""
    return df.join(excluded.select(*on), list(on), "left_anti")

