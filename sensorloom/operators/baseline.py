"""Zero-flow periods and the baseline they give."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.config import MOVED, NO_BASELINE_FLAG, POSITIONS, SERIES, SPAN_SECONDS, STEP_SECONDS, VELOCITIES, ZeroRule
from sensorloom.functions.columns import any_set, seconds, shift
from sensorloom.operators.aggregates import window_means
from sensorloom.operators.intervals import expand_steps
from sensorloom.operators.joins import salted_join
from sensorloom.operators.ordered import last_known, latest_event, ordered, position, row_index, runs
from sensorloom.session import written

BASELINES = tuple(f"baseline_{p}" for p in ("inner", "middle", "outer"))
# Zero periods are numbered per tree; this many numbers form a piece.
GROUP_SPAN = 4096


def zero_periods(df: DataFrame, rule: ZeroRule = ZeroRule(), keys: Sequence[str] = ("Tree",), time: str = "Timestamp", span: int = SPAN_SECONDS) -> DataFrame:
    """Periods in which the weather fulfils the rule on every step, of at least ``min_rows`` rows."""
    vpd = F.when(F.col("Tree").isin(*rule.loose_trees), rule.vpd_below_loose).otherwise(rule.vpd_below)
    still = df.where((F.col("Wetness") < rule.wetness_below) & (F.col("Solar") == rule.solar) & (F.col("VPD") < vpd))
    found = runs(still.select(*keys, time), keys, time, F.lit(True), rule.step_seconds, span)
    return found.where(F.col("length") >= rule.min_rows).select(
        *keys, F.col("run_start").alias("periodBegin"), F.col("run_end").alias("periodEnd")
    )


def clip_night(df: DataFrame, begin: str = "periodBegin", end: str = "periodEnd", min_hours: float = 3.0) -> DataFrame:
    """Move daytime starts to 18:00 and daytime ends to 06:00; keep periods of at least ``min_hours``."""
    def at(c: str, hour: int):
        # Seconds of the day are cut, not the fraction below a second or minute: the borders are whole hours.
        into_day = F.hour(c) * 3600 + F.minute(c) * 60
        return shift(c, F.lit(hour * 3600) - into_day)

    b_hour, e_hour = F.hour(begin), F.hour(end)
    new_begin = F.when((b_hour >= 6) & (b_hour < 18), at(begin, 18)).otherwise(F.col(begin))
    late = ((e_hour > 6) & (e_hour < 18)) | ((e_hour == 6) & (F.minute(end) > 0))
    new_end = F.when(late, at(end, 6)).otherwise(F.col(end))
    d = df.withColumns({begin: new_begin, end: new_end})
    return d.where(seconds(end) - seconds(begin) >= min_hours * 3600)


def number_periods(periods: DataFrame, tier: DataFrame, key: str = "Tree", time: str = "Timestamp", begin: str = "periodBegin", span: int = SPAN_SECONDS) -> DataFrame:
    """Periods that begin at or after the start of their tree's data, numbered from 1.

    The start travels along as ``dataStart``, so later steps need not look for it again.
    """
    starts = tier.groupBy(key).agg(F.min(time).alias("dataStart"))
    d = periods.join(starts, key, "inner").where(F.col(begin) >= F.col("dataStart"))
    return row_index(d, [key], begin, "Group", span)


def expand_periods(periods: DataFrame, step: int = STEP_SECONDS, time: str = "Timestamp", keys: Sequence[str] = ("Tree",)) -> DataFrame:
    """One row per step of every period, with its number."""
    d = periods.select(*keys, "Group", "periodBegin", "periodEnd")
    return expand_steps(d, "periodBegin", "periodEnd", step, time).select(*keys, "Group", time)


def baseline_values(tier: DataFrame, periods: DataFrame, step: int = STEP_SECONDS, span: int = GROUP_SPAN) -> DataFrame:
    """Mean of each measure per cable and period, carried over periods without a value.

    Period 0 stands for the time before the first period and takes its means, with
    missing ones as zero.
    """
    inside = tier.join(expand_periods(periods, step), ["Tree", "Timestamp"], "inner")
    means = written(window_means(inside, VELOCITIES, (*SERIES, "Group")), "means")
    d = ordered(means, SERIES, "Group", span, _no=position(), **{f"baseline_{p}": last_known(f"{p}_vel") for p in ("inner", "middle", "outer")})
    # With period 0 in front, which has no missing mean, no later one is missing either.
    group = F.when(F.col("_no") == 1, F.array(F.lit(0).cast("long"), F.col("Group"))).otherwise(F.array("Group"))
    return d.withColumn("Group", F.explode(group)).fillna(0.0, list(BASELINES)).select(*SERIES, "Group", *BASELINES)


def asof_group(tier: DataFrame, periods: DataFrame, keys: Sequence[str] = SERIES, time: str = "Timestamp", span: int = SPAN_SECONDS) -> DataFrame:
    """Number of the latest period begun at or before each row, 0 before the first.

    A period that begins on the tree's first row does not count: those rows stay 0
    until the next period. Period starts run along in the rows' own stream; they are written to the scratch folder.
    """
    d = latest_event(tier, written(_starts(tier, periods, keys, time), "starts"), keys, time, ["Group"], span)
    return d.withColumn("Group", F.coalesce("Group", F.lit(0).cast("long")))


def bump_group(tier: DataFrame, periods: DataFrame, actions: DataFrame, keys: Sequence[str] = ("Tree", "cable_no"), time: str = "Timestamp", span: int = SPAN_SECONDS) -> DataFrame:
    """As ``asof_group``, but after a sensor was moved or replaced the next period counts until it begins.

    Other actions do not bump; an action on a row at which a period begins is lost;
    there is nothing to bump to after the tree's last period. Starts and actions run along in the rows' own
    stream; they are written to the scratch folder. ``actions`` has (Tree, Cable number, time, Action).
    """
    starts = _starts(tier, periods, keys, time).withColumn("_state", F.lit(False))
    # Two actions on one row: a move decides, whatever else is noted.
    acts = actions.where(F.col("Action").isNotNull()).groupBy("Tree", F.col("Cable").alias("cable_no"), time).agg(
        F.max(F.col("Action") == MOVED).alias("_state")
    )
    acts = acts.join(_tree_starts(tier, periods, time), "Tree", "inner").where(F.col(time) > F.col("_from")).drop("_from")
    # A period's start comes before an action at the same time.
    events = starts.unionByName(acts.withColumn("Group", F.lit(None).cast("long"))).groupBy(*keys, time).agg(
        F.max("Group").alias("Group"), F.min_by("_state", F.col("Group").isNull()).alias("_state")
    )
    events = events.join(last_groups(periods), "Tree", "left")
    d = latest_event(tier, written(events, "events"), keys, time, ["Group", "_state", "_last"], span)
    group = F.coalesce("Group", F.lit(0).cast("long"))
    bumped = F.when(F.col("_state") & (group < F.col("_last")), group + 1).otherwise(group)
    return d.withColumn("Group", bumped).select(*tier.columns, "Group")


def _tree_starts(tier: DataFrame, periods: DataFrame, time: str) -> DataFrame:
    """First time of each tree that has periods: as ``number_periods`` left it, else from the tier."""
    if "dataStart" in periods.columns:
        return periods.groupBy("Tree").agg(F.min("dataStart").alias("_from"))
    return tier.groupBy("Tree").agg(F.min(time).alias("_from"))


def _starts(tier: DataFrame, periods: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The starts of a tree's periods after its first row, for each of its series."""
    at = periods.join(_tree_starts(tier, periods, time), "Tree", "inner").where(F.col("periodBegin") > F.col("_from"))
    at = at.groupBy("Tree", F.col("periodBegin").alias(time)).agg(F.max("Group").alias("Group"))
    return tier.select(*keys).distinct().join(at, "Tree").select(*keys, time, "Group")


def last_groups(periods: DataFrame) -> DataFrame:
    """Largest period number per tree."""
    return periods.groupBy("Tree").agg(F.max("Group").alias("_last"))


def join_baseline(df: DataFrame, values: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """Attach the baseline of each row's cable and period. ``like`` is a table with the same series, to tell the long ones by."""
    return salted_join(df, values, [*SERIES, "Group"], "Timestamp", like=like, like_on=SERIES if like is not None else None)


def baseline_flags(df: DataFrame, keys: Sequence[str] = (*SERIES, "Timestamp")) -> DataFrame:
    """Rows whose period has no baseline for a measure."""
    flagged = df.select(*keys, *[F.when(F.col(c).isNull(), NO_BASELINE_FLAG).alias(c) for c in BASELINES])
    return flagged.where(any_set(*BASELINES))


def subtract_baseline(df: DataFrame) -> DataFrame:
    """Measure minus baseline; a missing baseline counts as zero."""
    return df.withColumns({
        f"{p}_vel": F.col(f"{p}_vel") - F.coalesce(F.col(f"baseline_{p}"), F.lit(0.0)) for p in POSITIONS
    }).drop("Group", *BASELINES)
