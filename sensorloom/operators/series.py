"""Installation letters, gaps and their filling from the series itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.config import LETTERS, SERIES, SPAN_SECONDS, STEP_SECONDS
from sensorloom.functions.columns import recode_action, seconds, shift
from sensorloom.operators.intervals import expand_steps
from sensorloom.operators.joins import salted_join
from sensorloom.operators.ordered import following, last_known, last_place, next_known, next_place, openings, ordered, position, previous, row_index, runs
from sensorloom.session import written

# Actions are numbered by their place in the file; this many places form a piece.
FILE_SPAN = 100_000
# The same for rows numbered within their series.
ROW_SPAN = 100_000


def letter_events(actions: DataFrame, keys: Sequence[str] = SERIES, file_pos: str = "file_pos", span: int = FILE_SPAN) -> DataFrame:
    """Number the actions of a sensor in file order and letter the first three b, c, d.

    Every action counts, also one without a time; later ones have no letter.
    ``letter_no`` is 1 for b; the letter itself follows from it.
    """
    d = actions.withColumn("Action", recode_action("Action")).where(F.col("Action").isNotNull())
    d = ordered(d, keys, file_pos, span, _n=position())
    number = F.when(F.col("_n") <= len(LETTERS), F.col("_n").cast("int"))
    return d.withColumn("letter_no", number).withColumn("letter", letter_of("letter_no")).drop("_n")


def letter_of(number: str):
    """0 -> a, 1 -> b, ... for the letters in use."""
    return F.get(F.array(*[F.lit(x) for x in ("a", *LETTERS)]), F.col(number).cast("int"))


def letter_series(df: DataFrame, events: DataFrame, keys: Sequence[str] = SERIES, time: str = "Timestamp") -> DataFrame:
    """Letter of the installation each row belongs to: 'a' at first, then that of the latest action.

    ``events`` comes from ``letter_events``. An action counts at the row with exactly
    its time; one on the series' first row is lost, as that row is always 'a'. With
    three letters a series has at most three changes, so they meet the rows as one
    row per series and no window over the series is needed.
    """
    keys, numbers = list(keys), range(1, len(LETTERS) + 1)
    at = events.where(F.col("letter_no").isNotNull()).groupBy(*keys, time).agg(F.max("letter_no").alias("letter_no"))
    seen = df.select(*keys, time).join(at, [*keys, time], "inner").distinct()
    starts = df.groupBy(*keys).agg(F.min(time).alias("_from"))
    changes = seen.join(starts, keys, "inner").where(F.col(time) > F.col("_from")).groupBy(*keys).agg(
        *[F.max(F.when(F.col("letter_no") == n, F.col(time))).alias(f"_at{n}") for n in numbers]
    )
    d = salted_join(df, changes, keys, time)
    passed = [F.when(F.col(f"_at{n}") <= F.col(time), F.col(f"_at{n}")) for n in numbers]
    d = d.withColumn("_latest", F.greatest(*passed))
    number = F.coalesce(*[F.when(F.col("_latest") == F.col(f"_at{n}"), n) for n in reversed(numbers)], F.lit(0))
    d = d.withColumn("letter_no", number).withColumn("letter", letter_of("letter_no"))
    return d.select(*df.columns, "letter_no", "letter")


def run_lengths(df: DataFrame, keys: Sequence[str], value: str, time: str = "Timestamp", span: int = SPAN_SECONDS) -> DataFrame:
    """Maximal runs of missing values: number, first and last missing time, length."""
    gaps = written(runs(df, keys, time, F.col(value).isNull(), span=span), "runs")
    gaps = gaps.withColumnsRenamed({"run_start": "first_missing", "run_end": "last_missing"})
    return row_index(gaps, keys, "first_missing", "gap", span)


def small_gaps(df: DataFrame, keys: Sequence[str], value: str, time: str = "Timestamp", longest: int = 5, step: int = STEP_SECONDS, span: int = SPAN_SECONDS) -> DataFrame:
    """Runs of at most ``longest`` missing rows, padded by one step on both sides and numbered."""
    gaps = written(runs(df, keys, time, F.col(value).isNull(), span=span).where(F.col("length") <= longest), "runs")
    gaps = row_index(gaps, keys, "run_start", "gap", span)
    return gaps.select(*keys, "gap", "length", shift("run_start", -step).alias("Start"), shift("run_end", step).alias("End"))


def expand_gaps(gaps: DataFrame, keys: Sequence[str], step: int = STEP_SECONDS, time: str = "Timestamp") -> DataFrame:
    """Padded gaps to one row per step with the gap's number."""
    return expand_steps(gaps.select(*keys, "gap", "Start", "End"), "Start", "End", step, time).select(*keys, "gap", time)


def gap_context(df: DataFrame, keys: Sequence[str], value: str, time: str = "Timestamp", rows: int = 12, span: int = SPAN_SECONDS) -> DataFrame:
    """Rows from ``rows`` before to ``rows`` after each missing run, tagged with the gap.

    Each gap asks for its row numbers and meets the series on them, so a row that
    serves several gaps is repeated only for those.
    """
    known = F.when(F.col(value).isNotNull(), F.col(time))
    d = ordered(df, keys, time, span, index=position(), _break=last_known(known))
    gaps = d.where(F.col(value).isNull()).groupBy(*keys, "_break").agg(
        F.min("index").alias("_lo"), F.max("index").alias("_hi"), F.count(F.lit(1)).alias("length")
    )
    gaps = row_index(gaps, keys, "_lo", "gap", ROW_SPAN)
    block = 2048
    wanted = gaps.withColumns({"_lo": F.col("_lo") - rows, "_hi": F.col("_hi") + rows})
    wanted = wanted.withColumn("_b", F.explode(F.sequence("_lo", "_hi", F.lit(block).cast("long"))))
    wanted = wanted.withColumn("index", F.explode(F.sequence(F.col("_b"), F.least(F.col("_b") + (block - 1), F.col("_hi")))))
    return wanted.select(*keys, "index", "gap", "length").join(d.drop("_break"), [*keys, "index"], "inner")


def segment_ids(df: DataFrame, keys: Sequence[str], value: str, time: str = "Timestamp", span: int = SPAN_SECONDS) -> DataFrame:
    """Missing rows with their row number and the number of their run."""
    missing = F.col(value).isNull()
    return ordered(df.select(*keys, time, value), keys, time, span, missingLoc=position(), sameSlot=openings(missing)).where(missing).drop(value)


def impute_single(df: DataFrame, keys: Sequence[str], value: str = "Velocity", time: str = "Timestamp", span: int = SPAN_SECONDS) -> DataFrame:
    """Fill an isolated missing value with the mean of its two neighbours.

    Adds ``imputedY`` and ``imputed`` (1 on isolated missing rows). The first and the
    last row have one neighbour only and stay missing.
    """
    d = ordered(df, keys, time, span, _down=previous(value), _up=following(value), _has_down=previous(F.lit(True)), _has_up=following(F.lit(True)))
    closed_below = F.col("_down").isNotNull() | F.col("_has_down").isNull()
    closed_above = F.col("_up").isNotNull() | F.col("_has_up").isNull()
    lone = F.col(value).isNull() & closed_below & closed_above
    return d.select(
        *df.columns,
        F.when(lone, (F.col("_down") + F.col("_up")) / 2).otherwise(F.col(value)).alias("imputedY"),
        F.when(lone, 1).otherwise(0).alias("imputed"),
    )


def interpolate_small(df: DataFrame, keys: Sequence[str], value: str = "Velocity", time: str = "Timestamp", longest: int = 5, span: int = SPAN_SECONDS) -> DataFrame:
    """Fill runs of at most ``longest`` missing rows linearly in time between the values around them."""
    known = F.when(F.col(value).isNotNull(), F.col(time))
    present = F.col(value).isNotNull()
    d = ordered(
        df, keys, time, span,
        _v0=last_known(value), _t0=last_known(known), _i0=last_place(present),
        _v1=next_known(value), _t1=next_known(known), _i1=next_place(present),
    )
    fraction = (seconds(time) - seconds("_t0")) / (seconds("_t1") - seconds("_t0"))
    fits = F.col(value).isNull() & (F.col("_i1") - F.col("_i0") - 1 <= longest)
    filled = F.when(fits, F.col("_v0") + (F.col("_v1") - F.col("_v0")) * fraction).otherwise(F.col(value))
    return d.select(*df.columns, filled.alias("filled"), F.when(fits, 1).otherwise(0).alias("interpolated"))
