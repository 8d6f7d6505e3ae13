"""Column -> Column helpers. All stay inside Spark's own expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.config import MOVE_ACTIONS, MOVED, Probe


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- values ---------------------------------------------------------------

def null_outside(c: str | Column, lo, hi) -> Column:
    """Missing where the value is below ``lo`` or above ``hi``; the bounds stay."""
    c = as_col(c)
    return F.when(c.between(lo, hi), c)


def null_where(c: str | Column, condition: Column) -> Column:
    """Missing where ``condition`` holds; an unknown condition leaves the value."""
    return F.when(~F.coalesce(condition, F.lit(False)), as_col(c))


def nan_to_null(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def to_number(c: str | Column) -> Column:
    """Number or missing, never NaN and never an error."""
    return nan_to_null(as_col(c).try_cast("double"))


def heat_velocity(ratio: str | Column, probe: Probe = Probe()) -> Column:
    """Velocity in cm/hr of a temperature-rise ratio; missing for ratios that have no logarithm."""
    ratio = as_col(ratio)
    k = probe.diffusivity / probe.distance_cm * probe.seconds
    return F.when(ratio > 0, F.lit(k) * F.ln(ratio))


def all_missing(*cols: str | Column) -> Column:
    """1 where every column is missing, else 0."""
    return F.when(F.coalesce(*[as_col(c) for c in cols]).isNull(), 1).otherwise(0)


def any_set(*cols: str | Column) -> Column:
    """True where at least one column holds a value."""
    return F.coalesce(*[as_col(c) for c in cols]).isNotNull()


# --- text -----------------------------------------------------------------

def recode_action(action: str | Column) -> Column:
    """Moves and replacements become one code; every other code stays."""
    action = as_col(action)
    return F.when(action.isin(*MOVE_ACTIONS), MOVED).otherwise(action)


def recode_position(position: str | Column, none_label: str | None = None) -> Column:
    """Outer / Middle / Inner to the velocity column of that depth."""
    position = as_col(position)
    out = (
        F.when(position == "Outer", "outer_vel")
        .when(position == "Middle", "middle_vel")
        .when(position == "Inner", "inner_vel")
    )
    return out if none_label is None else out.when(position == "NA", none_label)


def classify_note(note: str | Column, move_token: str = "ove", replace_token: str = "eplace") -> Column:
    """Free text to MR / M / R by the words it holds; missing when it holds neither."""
    note = as_col(note)
    moved, replaced = note.contains(move_token), note.contains(replace_token)
    return F.when(moved & replaced, "MR").when(moved, "M").when(replaced, "R")


def first_piece(c: str | Column, sep: str) -> Column:
    """Text before the first separator (a regular expression), as a column split keeps it."""
    return F.split(as_col(c), sep, 2).getItem(0)


def split_at(c: str | Column, position: int) -> tuple[Column, Column]:
    """Cut a text after ``position`` characters."""
    c = as_col(c)
    return F.substring(c, 1, position), F.substring(c, position + 1, 1 << 30)


def unite(*cols: str | Column, sep: str = "") -> Column:
    """Join pieces; a missing piece makes the result missing."""
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            pieces.append(F.lit(sep))
        pieces.append(as_col(c).cast("string"))
    return F.concat(*pieces)


def path_key(path: str | Column, pattern: str = r"([A-Z]{2}\d)[^/]*$") -> Column:
    """Series id in the file name; missing if the name has none."""
    return F.nullif(F.regexp_extract(as_col(path), pattern, 1), F.lit(""))


def cable_number(c: str | Column) -> Column:
    """'Cable7' or '7b' -> 7."""
    return F.regexp_extract(as_col(c), r"(\d+)", 1).try_cast("int")


def wiring_start(span: str | Column) -> Column:
    """'7:12' -> 7."""
    return F.split(as_col(span), ":").getItem(0).try_cast("int")


def mapped(c: str | Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Look a value up in a small fixed mapping."""
    c = as_col(c)
    out = F.lit(default).cast("string")
    for key, value in reversed(table.items()):
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out


# --- time -----------------------------------------------------------------

def seconds(c: str | Column) -> Column:
    return F.unix_timestamp(as_col(c))


def shift(c: str | Column, secs: int | Column) -> Column:
    """A time moved by a number of seconds."""
    return as_col(c) + F.make_dt_interval(secs=as_col(secs) if isinstance(secs, Column) else F.lit(secs))


def floor_time(df: DataFrame, c: str, unit: str) -> Column:
    """Start of the hour, day, month or Sunday-based week, in the column's own time type."""
    kind = df.schema[c].dataType
    col = F.col(c)
    if unit == "week":
        back = F.date_trunc("week", shift(col, 86400)).cast(kind)
        return shift(back, -86400)
    return F.date_trunc(unit, col).cast(kind)


def minute_stamp(text: str | Column) -> Column:
    """Time of a text that starts with 'yyyy-MM-dd HH:mm'; the seconds are ignored."""
    head = F.regexp_extract(as_col(text), r"^\s*(\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2})", 1)
    return F.try_to_timestamp(F.replace(head, F.lit("T"), F.lit(" ")), F.lit("yyyy-M-d H:m")).cast("timestamp_ntz")


def stamp_text(c: str | Column) -> Column:
    """Time as text; the clock part is left off at midnight, as spreadsheet exports expect."""
    c = as_col(c)
    at_midnight = F.date_format(c, "HH:mm:ss") == "00:00:00"
    return F.when(at_midnight, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))


def iso_stamp(c: str | Column) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def midday_note_stamp(date_text: str | Column, clock: str = "10:00:00") -> Column:
    """A column heading that starts with a date, at a fixed time of day."""
    day = F.substring(as_col(date_text), 1, 10)
    return F.try_to_timestamp(F.concat(day, F.lit(" " + clock)), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


# --- many columns ---------------------------------------------------------

def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def apply_across(df: DataFrame, cols: Sequence[str], fn, name: str = "{col}") -> DataFrame:
    """The same Column function over many columns in one projection."""
    return df.withColumns({name.format(col=c): fn(F.col(c)) for c in cols})
