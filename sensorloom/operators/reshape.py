"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.config import VELOCITIES
from sensorloom.functions.columns import cable_number, first_piece, midday_note_stamp, recode_position


def melt_positions(
    df: DataFrame,
    cols: Sequence[str] = VELOCITIES,
    ids: Sequence[str] | None = None,
    name: str = "Position",
    value: str = "Velocity",
) -> DataFrame:
    """Measure columns to rows; missing values stay."""
    ids = list(ids) if ids is not None else [c for c in df.columns if c not in cols]
    return df.unpivot(ids, list(cols), name, value)


def cast_positions(
    df: DataFrame,
    values: Sequence[str] = VELOCITIES,
    keys: Sequence[str] = ("Tree", "Cable", "Timestamp"),
    name: str = "Position",
    value: str = "Velocity",
) -> DataFrame:
    """Rows back to measure columns. Keys must be unique per measure (see ``duplicate_keys``)."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == v, F.col(value))).alias(v) for v in values])


def pivot_series(
    df: DataFrame,
    series: Sequence[str],
    keys: Sequence[str] = ("Timestamp",),
    name: str = "Tree",
    value: str = "Velocity",
    prefix: str = "",
) -> DataFrame:
    """One column per listed series."""
    return cast_positions(df, series, keys, name, value).withColumnsRenamed({s: f"{prefix}{s}" for s in series})


def melt_bad_windows(df: DataFrame, marks: Sequence[str] | None = None) -> DataFrame:
    """Marked 'CableN_Position' columns to (Tree, Cable, Position, Start, End) rows."""
    marks = list(marks or [c for c in df.columns if c.startswith("Cable") and "_" in c])
    long = df.unpivot(["Tree", "Start", "End"], marks, "mark", "affects").where(F.col("affects").isNotNull())
    return long.select(
        "Tree", cable_number(first_piece("mark", "_")).alias("Cable"),
        recode_position(F.split("mark", "_").getItem(1)).alias("Position"), "Start", "End",
    )


def melt_date_columns(df: DataFrame, dates: Sequence[str], part: str = "Part") -> DataFrame:
    """A sheet with one column per visit date to (Tree, Cable, Timestamp, Action) rows.

    Only parts 'Cable 1' .. 'Cable 8' count; empty notes and rows with a missing field are dropped.
    """
    cables = df.where(F.col(part).isin([f"Cable {i}" for i in range(1, 9)]))
    long = cables.unpivot(["Tree", part], list(dates), "Date", "Action")
    return long.select(
        "Tree", F.substring(part, 7, 2).alias("Cable"), midday_note_stamp("Date").alias("Timestamp"), "Action"
    ).dropna()


def cut_note(df: DataFrame, col: str = "Action", sep: str = ";") -> DataFrame:
    """Keep the code before the first separator of a note."""
    return df.withColumn(col, first_piece(col, sep))


def melt_corr_row(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """A row of correlations to (Sensor, corr) rows."""
    return df.unpivot(list(ids), list(cols), "Sensor", "corr")


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack by column name; columns a frame lacks are missing."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def sheet_union(sheets: dict[str, DataFrame], tag: str = "Tree") -> DataFrame:
    """Stack named sheets, tagging each row with its sheet."""
    return union_all(*[frame.withColumn(tag, F.lit(name)) for name, frame in sheets.items()])
