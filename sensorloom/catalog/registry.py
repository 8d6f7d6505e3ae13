"""Named queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.catalog.views import Tables
from sensorloom.functions.columns import as_col

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name; without SQL only its rows are checked."""
    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"registered twice: {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return {name: bind(fn) for name, fn in _QUERIES.items()}


def check_sql() -> dict[str, str]:
    return dict(_SQL)


# Means of two-place values often end in an exact 5 at the seventh place, where the
# last bit of a sum decides the rounding. A fixed nudge moves them off the tie.
NUDGE = 3e-8


def r6(c: str | Column) -> Column:
    """Six places, never negative zero: what two engines can be expected to share."""
    return F.round(as_col(c) + F.lit(NUDGE), 6) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


def R(expr: str) -> str:
    """``r6`` in SQL."""
    return f"(round({expr} + {NUDGE}, 6) + 0.0)"


def RV(prefix: str = "") -> str:
    """The three velocities, rounded, in SQL."""
    return ", ".join(f"{R(prefix + c)} AS {c}" for c in ("outer_vel", "middle_vel", "inner_vel"))
