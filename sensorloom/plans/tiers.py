"""Raw, L1, L2, L3: each tier is one lazy plan over all trees."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.config import SERIES, SPAN_SECONDS, STEP_SECONDS, VELOCITIES, Limits, ZeroRule
from sensorloom.functions.columns import cable_number, classify_note, recode_action, recode_position, shift, unite
from sensorloom.operators.aggregates import station_mean
from sensorloom.operators.baseline import (
    baseline_flags, baseline_values, bump_group, clip_night, join_baseline, number_periods, subtract_baseline, zero_periods,
)
from sensorloom.operators.filters import filter_date_range, quality_voltage, recent_window
from sensorloom.operators.intervals import grid_left_join, make_grid, mask_wide
from sensorloom.operators.joins import drop_listed, salted_join
from sensorloom.operators.ordered import span_for
from sensorloom.operators.outliers import BLOCK_ROWS, hampel, split_flags
from sensorloom.operators.ports import before_after_probe, cable_velocities, ports_as_arrays, wired_cables
from sensorloom.operators.reshape import cut_note, melt_date_columns
from sensorloom.operators.series import letter_events, letter_series
from sensorloom.session import scratch_dir, written
from sensorloom.sources.incremental import (
    backfill_merge, backfill_window_replace, import_batch, import_ends, import_log_refresh, import_log_upsert, import_report, restart_points, skip_missing_input,
)
from sensorloom.sources.logger import format_logger, read_logger
from sensorloom.sources.tiers import keys_of, write_flags, write_tier


def raw_batch(spark: SparkSession, path: str | Sequence[str], log: DataFrame, tree: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Logger files to (rows to append with the path of their file, new import log, report). The text is parsed once, into a table in the scratch folder."""
    rows = written(format_logger(read_logger(spark, path), tree, ("path",)), "parsed")
    batch = import_batch(rows, log)
    return batch, import_log_upsert(log, import_ends(rows)), import_report(rows, log)


def import_raw(
    spark: SparkSession, path: str | Sequence[str], log: DataFrame, raw_path: str, tree: Column | None = None,
    batch: str | None = None, log_path: str | None = None, report_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write the new rows of logger files to the raw tier; returns the new log and the report, and writes them if paths are given.

    The raw tier has one folder per batch and tree, as the stream's has. A batch is one file of an import, named by ``batch`` or else by the
    log that the import starts from, and by the file. So an import that is run again from the same log replaces what it wrote, also if
    more files have come since, and imports of other files from that log stand beside each other. The log is written
    last: a job that dies before is imported again and neither lost nor doubled.
    """
    if batch is None:
        cells = F.sum(F.xxhash64("Tree", "last_import").cast("decimal(38,0)"))
        batch = f"log-{log.agg(F.coalesce(cells, F.lit(0))).first()[0]}"
    rows, new_log, report = raw_batch(spark, path, log, tree)
    name = F.concat(F.lit(f"{batch}-"), F.lower(F.hex(F.xxhash64("path"))))
    write_tier(rows.withColumn("batch", name).drop("path"), raw_path, ("batch", "Tree"))
    new_log, report = written(new_log, "log"), written(report, "report")
    if report_path:
        report.write.mode("overwrite").parquet(report_path)
    if log_path:
        new_log.write.mode("overwrite").parquet(log_path)
    return new_log, report


def l1_rows(
    ports: DataFrame,
    station_info: DataFrame,
    ends: DataFrame | None = None,
    limits: Limits | None = Limits(),
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Port arrays (Tree, Timestamp, base, after) to velocities on a gap-free grid.

    With ``ends`` (Tree, last_import) only newer records are processed and the grid
    goes on one step after them; these rows can be appended to the tier as they are.
    """
    spans = ports.groupBy("Tree").agg(F.min("Timestamp").alias("_start"), F.max("Timestamp").alias("_end"))
    if ends is not None:
        ports = import_batch(ports, ends)
        spans = spans.join(ends, "Tree", "left")
        spans = spans.withColumn("_start", F.coalesce(shift("last_import", step), "_start")).drop("last_import")
    grid = make_grid(spans.join(wired_cables(station_info), "Tree", "inner"), "_start", "_end", SERIES, step)
    return grid_left_join(grid, cable_velocities(ports, station_info, limits)).distinct()


def build_l1(ports: DataFrame, station_info: DataFrame, l1: DataFrame | None = None, limits: Limits | None = Limits(), step: int = STEP_SECONDS) -> DataFrame:
    """The whole L1 tier: an existing one and the rows after its end.

    The new grid begins after the old tier, so the two share no row and the old one
    is neither shuffled nor compared.
    """
    if l1 is None:
        return l1_rows(ports, station_info, None, limits, step)
    return l1.unionByName(l1_rows(ports, station_info, import_ends(l1), limits, step))


def build_l2(
    l1: DataFrame,
    bad_windows: DataFrame,
    actions: DataFrame,
    step: int = STEP_SECONDS,
    gridded: bool = False,
    span: int | None = None,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """L1 to masked, lettered and outlier-filtered rows, with the outlier flags beside them.

    ``bad_windows`` is long: (Tree, Cable, Position, Start, End). ``gridded`` says
    that each series has exactly one row per step, as an L1 tier has; it is checked, and saves numbering the rows.
    Otherwise the masked and lettered rows are written to the scratch folder and numbered.
    """
    d = letter_series(mask_wide(l1, bad_windows, VELOCITIES, step=step), letter_events(actions))
    d = d.withColumn("Cable", unite("Cable", "letter")).select("Tree", "Cable", "Timestamp", *VELOCITIES)
    if gridded:
        return hampel(d, step=step, block=block)
    # Numbering reads its input twice; the masks and letters are worked out once.
    return hampel(written(d, "lettered"), span=span or span_for(l1, SERIES, "Timestamp"), block=block)


def save_l2(cleaned: DataFrame, tier_path: str, flags_path: str) -> None:
    """Write tier and flags from one computation, by way of a written copy."""
    staging = scratch_dir(cleaned.sparkSession, "l2")
    cleaned.write.parquet(staging)
    tier, flags = split_flags(cleaned.sparkSession.read.schema(cleaned.schema).parquet(staging))
    write_tier(tier, tier_path)
    write_flags(flags, flags_path, keys_of(tier))


def backfill(
    tier: DataFrame, old: DataFrame, late: DataFrame, log: DataFrame, process: Callable[[DataFrame, DataFrame], DataFrame], step: int = STEP_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """Late records into a tier: (the tier with each series' affected range processed anew, the log after it).

    ``old`` are the records so far, ``late`` those that came after. ``process`` makes tier rows from both together and from the points
    (Tree, old_end, new_end) between which they are wanted. Series without late records stay as they are.
    """
    extents = late.groupBy("Tree").agg(F.min("Timestamp").alias("first"), F.max("Timestamp").alias("last"))
    records = backfill_merge(skip_missing_input(old, extents), late)
    points = restart_points(extents, step=step)
    redone = process(records, points)
    within = salted_join(redone, points, ["Tree"], "Timestamp", "inner").where((F.col("Timestamp") > F.col("old_end")) & (F.col("Timestamp") <= F.col("new_end")))
    return backfill_window_replace(tier, within.select(*tier.columns), extents), import_log_refresh(log, records)


def build_zeroes(microclimate: DataFrame, rule: ZeroRule = ZeroRule(), min_hours: float = 3.0, span: int = SPAN_SECONDS) -> DataFrame:
    """Weather by station to clipped zero-flow periods per tree."""
    return clip_night(zero_periods(station_mean(microclimate), rule, span=span), min_hours=min_hours)


def baselined(l2: DataFrame, zeroes: DataFrame, actions: DataFrame, excluded: DataFrame | None = None, step: int = STEP_SECONDS, span: int | None = None) -> DataFrame:
    """L2 rows with period number and baselines, for the trees that have zero periods.

    ``l2`` and ``zeroes`` are read several times and should be tables, not plans.
    """
    zeroes, span = zeroes.distinct(), span or span_for(l2, SERIES, "Timestamp")
    usable = zeroes if excluded is None else drop_listed(zeroes, excluded, ("Tree", "periodBegin"))
    # Trees without periods drop out of the numbering and of the means by themselves.
    periods = written(number_periods(usable, l2, span=span), "periods")
    values = written(baseline_values(l2, periods, step), "baselines")
    acts = actions.withColumn("Action", recode_action("Action")).where(F.col("Action").isNotNull())
    d = skip_missing_input(l2, zeroes).withColumn("cable_no", cable_number("Cable"))
    return join_baseline(bump_group(d, periods, acts, span=span).drop("cable_no"), values, like=l2)


def build_l3(l2: DataFrame, zeroes: DataFrame, actions: DataFrame, excluded: DataFrame | None = None, step: int = STEP_SECONDS, span: int | None = None) -> tuple[DataFrame, DataFrame]:
    """L2 to the baselined tier and the table of rows without a baseline."""
    d = baselined(l2, zeroes, actions, excluded, step, span)
    return subtract_baseline(d), baseline_flags(d)


def save_l3(joined: DataFrame, tier_path: str, flags_path: str) -> None:
    """Write the baselined tier and its flags from one computation of ``baselined``, by way of a written copy."""
    d = written(joined, "l3")
    tier = subtract_baseline(d)
    write_tier(tier, tier_path)
    write_flags(baseline_flags(d), flags_path, keys_of(d))


def maintenance_table(sheets: DataFrame, dates: Sequence[str], classify: bool = False) -> DataFrame:
    """Note sheets with one column per visit to the table of maintenance actions."""
    d = melt_date_columns(sheets, dates)
    return d.withColumn("Action", classify_note("Action")) if classify else cut_note(d)


def diagnostic_tables(records: DataFrame, station_info: DataFrame, days_ago_to_end: int = 1, days_to_view: int = 10) -> tuple[DataFrame, DataFrame]:
    """A station's recent records: temperatures before and after the pulse per probe, and unfiltered velocities."""
    recent = quality_voltage(recent_window(records, days_ago_to_end, days_to_view))
    ports = ports_as_arrays(recent)
    return before_after_probe(ports, station_info), cable_velocities(ports, station_info, limits=None)


def final_dataset(tier: DataFrame, guide: DataFrame, since: str | None = None) -> DataFrame:
    """The position to use per cable, for all trees, from a date on.

    The guide is joined to the wide rows and names the measure to take, so that no row is multiplied before the join.
    """
    use = guide.withColumn("Use", recode_position("Use", "None")).where(F.col("Use").isin(*VELOCITIES))
    d = tier if since is None else filter_date_range(tier, since, "9999-12-31")
    d = salted_join(d, use, ["Tree", "Cable"], "Timestamp", "inner").where(F.col("Starting").isNull() | (F.col("Timestamp") >= F.col("Starting")))
    value = F.coalesce(*[F.when(F.col("Use") == c, F.col(c)) for c in VELOCITIES])
    return d.select("Tree", "Cable", "Timestamp", F.col("Use").alias("Position"), value.alias("Velocity"))
