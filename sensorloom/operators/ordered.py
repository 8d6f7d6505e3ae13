"""Ordered work on series that may be too long for one task.

A plain window over a series puts the whole series in one task. Here a series is
cut into pieces of a fixed span of its order column. Each piece is one window
partition; what must cross a border (the last value, a running total, the edge
rows) travels in a summary with one row per piece, which is joined back on the
same keys the window was partitioned by. All specs of one call share the
shuffle and the summary.

Series keys and the first order column are expected to be present; rows where
they are missing are kept but see only their own piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.config import SPAN_SECONDS
from sensorloom.functions.columns import as_col
from sensorloom.session import written

PIECE = "_piece"
_FIRST = Window.unboundedPreceding


@dataclass(frozen=True)
class Spec:
    kind: str
    expr: Column


#: Kinds that look at their neighbours before they are carried.
_PLACED = ("openings", "last_place", "next_place")


def last_known(expr: str | Column) -> Spec:
    """The latest non-missing value at or before the row."""
    return Spec("last_known", as_col(expr))


def next_known(expr: str | Column) -> Spec:
    """The earliest non-missing value at or after the row."""
    return Spec("next_known", as_col(expr))


def running(expr: str | Column) -> Spec:
    """Total up to and including the row; missing counts as nothing."""
    return Spec("running", as_col(expr))


def position() -> Spec:
    """Row number from 1."""
    return Spec("running", F.lit(1).cast("long"))


def previous(expr: str | Column) -> Spec:
    """Value on the row before; missing on the first row."""
    return Spec("previous", as_col(expr))


def following(expr: str | Column) -> Spec:
    """Value on the row after; missing on the last row."""
    return Spec("following", as_col(expr))


def openings(flag: str | Column) -> Spec:
    """How many runs of rows with the flag have begun up to and including the row."""
    return Spec("openings", F.coalesce(as_col(flag), F.lit(False)))


def last_place(flag: str | Column) -> Spec:
    """Row number of the latest row with the flag at or before the row."""
    return Spec("last_place", F.coalesce(as_col(flag), F.lit(False)))


def next_place(flag: str | Column) -> Spec:
    """Row number of the earliest row with the flag at or after the row."""
    return Spec("next_place", F.coalesce(as_col(flag), F.lit(False)))


def piece_of(df: DataFrame, order: str, span: int) -> Column:
    """Number of the piece a row belongs to: seconds for times, units for numbers."""
    kind = df.schema[order].dataType
    c = F.unix_timestamp(order) if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else F.col(order)
    return F.floor(c / F.lit(span)).cast("long")


def span_for(df: DataFrame, keys: Sequence[str], order: str, rows: int = 2_000_000, longest: int = 10 * 365 * 86400) -> int:
    """A span in seconds at which no piece of a series holds many more than ``rows`` rows.

    One grouped count by series and day, of which a single number reaches the driver.
    """
    day = F.floor(F.unix_timestamp(order) / F.lit(86400))
    busiest = df.groupBy(*keys, day.alias("_day")).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return longest if not busiest else max(60, min(longest, 86400 * rows // busiest))


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    span: int = SPAN_SECONDS,
    **specs: Spec,
) -> DataFrame:
    """Add one column per spec, computed in ``order`` within ``keys``.

    ``order`` starts with the column that is cut into pieces of ``span``; further
    columns break ties. Without a full tie-breaker equal rows have no defined order.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    part = [*keys, PIECE]
    inputs = {f"_in_{name}": spec.expr for name, spec in specs.items()}
    src = df.withColumns({PIECE: piece_of(df, order[0], span), **inputs})

    by_order = Window.partitionBy(*part).orderBy(*order)
    upto, onward = by_order.rowsBetween(_FIRST, 0), by_order.rowsBetween(0, Window.unboundedFollowing)
    # One fixed-width order column keeps the summary a hash aggregate.
    where = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    beside: dict[str, Column] = {}
    local: dict[str, Column] = {}
    totals: list[Column] = []
    own: dict[str, Column] = {}
    across: dict[str, Column] = {}
    result: dict[str, Column] = {}
    pieces = Window.partitionBy(*keys).orderBy(PIECE)
    before = pieces.rowsBetween(_FIRST, -1)
    after = pieces.rowsBetween(1, Window.unboundedFollowing)

    if any(spec.kind in ("last_place", "next_place") for spec in specs.values()):
        beside["_at"] = F.row_number().over(by_order).cast("long")
        totals.append(F.count(F.lit(1)).alias("_rows"))
        own["_offset"] = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    for name, spec in specs.items():
        value, edge, carry, out = F.col(f"_in_{name}"), f"_edge_{name}", f"_carry_{name}", f"_out_{name}"
        present = F.when(value.isNotNull(), where)
        if spec.kind == "last_known":
            local[out] = F.last(value, ignorenulls=True).over(upto)
            totals.append(F.max_by(value, present).alias(edge))
            across[carry] = F.last(edge, ignorenulls=True).over(before)
            result[name] = F.coalesce(F.col(out), F.col(carry))
        elif spec.kind == "next_known":
            local[out] = F.first(value, ignorenulls=True).over(onward)
            totals.append(F.min_by(value, present).alias(edge))
            across[carry] = F.first(edge, ignorenulls=True).over(after)
            result[name] = F.coalesce(F.col(out), F.col(carry))
        elif spec.kind == "running":
            zero = F.coalesce(value, F.lit(0))
            local[out] = F.sum(zero).over(upto)
            totals.append(F.sum(zero).alias(edge))
            across[carry] = F.sum(edge).over(before)
            result[name] = F.col(out) + F.coalesce(F.col(carry), F.lit(0))
        elif spec.kind in ("previous", "following"):
            back = spec.kind == "previous"
            step = F.lag if back else F.lead
            local[out] = step(value).over(by_order)
            local[f"_in_piece_{name}"] = step(F.lit(True)).over(by_order)
            totals.append((F.max_by if back else F.min_by)(value, where).alias(edge))
            across[carry] = step(edge).over(pieces)
            result[name] = F.when(F.col(f"_in_piece_{name}"), F.col(out)).otherwise(F.col(carry))
        elif spec.kind == "openings":
            # A piece counts its first row as a beginning; where the piece before ends in the same run, that is taken back.
            begins, lasts = f"_begins_{name}", f"_lasts_{name}"
            beside[begins] = F.when(value & ~F.coalesce(F.lag(value).over(by_order), F.lit(False)), 1).otherwise(0).cast("long")
            local[out] = F.sum(begins).over(upto)
            totals += [F.sum(begins).alias(edge), F.min_by(value, where).alias(f"{edge}_first"), F.max_by(value, where).alias(f"{edge}_last")]
            own[lasts] = F.when(F.col(f"{edge}_first") & F.coalesce(F.lag(f"{edge}_last").over(pieces), F.lit(False)), 1).otherwise(0).cast("long")
            across[carry] = F.coalesce(F.sum(F.col(edge) - F.col(lasts)).over(before), F.lit(0)) - F.col(lasts)
            result[name] = F.col(out) + F.col(carry)
        elif spec.kind in ("last_place", "next_place"):
            back = spec.kind == "last_place"
            at, pick = F.when(value, F.col("_at")), F.last if back else F.first
            local[out] = pick(at, ignorenulls=True).over(upto if back else onward)
            totals.append((F.max if back else F.min)(at).alias(edge))
            across[carry] = pick(F.col(edge) + F.col("_offset"), ignorenulls=True).over(before if back else after)
            across["_offset"] = F.col("_offset")
            result[name] = F.coalesce(F.col(out) + F.col("_offset"), F.col(carry))
        else:
            raise ValueError(f"unknown kind: {spec.kind}")

    src = src.withColumns(beside) if beside else src
    summary = src.groupBy(*part).agg(*totals)
    summary = (summary.withColumns(own) if own else summary).select(*part, *[c.alias(n) for n, c in across.items()])
    # A hint on how pieces meet their summary is left out on purpose: Spark
    # broadcasts the summary only when its measured size allows it.
    joined = src.withColumns(local).join(summary, part, "left")
    kept = [c for c in df.columns if c not in result]
    return joined.select(*kept, *[c.alias(n) for n, c in result.items()])


def latest_event(df: DataFrame, events: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], span: int = SPAN_SECONDS) -> DataFrame:
    """Per row the latest known value of each column of ``events`` up to it.

    ``events`` has (keys, order, cols), one row per key and place, and is the much smaller side. An event counts if the series
    has a row at exactly its place. Events enter as rows of the ordered stream, just before the row they belong to, so
    one shuffle and one window carry them; no event is joined to rows.
    """
    keys, cols = list(keys), list(cols)
    part = [*keys, PIECE]
    rows = df.withColumns({PIECE: piece_of(df, order, span), "_row": F.lit(True), **{f"_new_{c}": F.lit(None).cast(events.schema[c].dataType) for c in cols}})
    added = events.select(*keys, order, F.lit(False).alias("_row"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    d = rows.unionByName(added.withColumn(PIECE, piece_of(added, order, span)), allowMissingColumns=True)
    by_order = Window.partitionBy(*part).orderBy(order, "_row")
    d = d.withColumn("_met", ~F.col("_row") & F.coalesce(F.lead("_row").over(by_order) & (F.lead(order).over(by_order) == F.col(order)), F.lit(False)))
    now = {c: F.when(F.col("_met"), F.col(f"_new_{c}")) for c in cols}
    latest = {f"_out_{c}": F.last(v, ignorenulls=True).over(by_order.rowsBetween(_FIRST, 0)) for c, v in now.items()}
    edges = [F.max_by(v, F.when(v.isNotNull(), F.col(order))).alias(f"_edge_{c}") for c, v in now.items()]
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(_FIRST, -1)
    summary = d.groupBy(*part).agg(*edges).select(*part, *[F.last(f"_edge_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols])
    joined = d.withColumns(latest).where("_row").join(summary, part, "left")
    return joined.select(*df.columns, *[F.coalesce(f"_out_{c}", f"_carry_{c}").alias(c) for c in cols])


def locf(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cols: Sequence[str], span: int = SPAN_SECONDS) -> DataFrame:
    """Carry the last known value of each column forward."""
    return ordered(df, keys, order, span, **{c: last_known(c) for c in cols})


def row_index(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], name: str = "index", span: int = SPAN_SECONDS) -> DataFrame:
    """Number the rows of each series from 1."""
    return ordered(df, keys, order, span, **{name: position()})


def lag_lead(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], col: str, span: int = SPAN_SECONDS) -> DataFrame:
    """Value of the row before (``down1``) and after (``up1``)."""
    return ordered(df, keys, order, span, down1=previous(col), up1=following(col))


def runs(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    flag: Column,
    step: int | None = None,
    span: int = SPAN_SECONDS,
) -> DataFrame:
    """Maximal runs of rows where ``flag`` holds: first and last order value and length.

    A run is broken by a row without the flag and, if ``step`` is given, by any
    distance to the previous row other than ``step`` (seconds or units). Rows without an order value belong to no run.

    Each piece becomes its stretches of like rows, in one shuffle and one window. They are written to the scratch folder:
    those inside a piece are finished, and only the two at a piece's ends can go on in the next one.
    """
    keys = list(keys)
    part = [*keys, PIECE]
    numeric = isinstance(df.schema[order].dataType, T.NumericType)
    distance = None if step is None else F.lit(step) if numeric else F.make_dt_interval(secs=F.lit(step))

    def goes_on(flagged: Column, last: Column) -> Column:
        """Whether a flagged row or stretch goes on from the one before, that of flag ``flagged`` that ends at ``last``."""
        near = F.lit(True) if step is None else F.col("run_start") - last == distance
        return F.col("_flag") & F.coalesce(flagged & near, F.lit(False))

    d = df.select(*keys, F.col(order).alias("run_start"), F.coalesce(flag, F.lit(False)).alias("_flag")).where("run_start is not null")
    d = d.withColumn(PIECE, piece_of(d, "run_start", span))
    inside = Window.partitionBy(*part).orderBy("run_start")
    was, last = F.lag("_flag").over(inside), F.lag("run_start").over(inside)
    same = F.coalesce(~F.col("_flag") & ~was, F.lit(False)) | goes_on(was, last)
    d = d.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_no", F.sum("_new").over(inside.rowsBetween(_FIRST, 0)))
    d = d.groupBy(*part, "_no").agg(F.max("run_start").alias("run_end"), F.min("run_start").alias("run_start"), F.count(F.lit(1)).alias("length"), F.max("_flag").alias("_flag"))
    ends = {"_opens": F.col("_no") == 1, "_closes": F.col("_no") == F.max("_no").over(Window.partitionBy(*part))}
    d = written(d.withColumns(ends).drop("_no", PIECE), "stretches")

    pieces = Window.partitionBy(*keys).orderBy("run_start")
    edge = d.where("_opens or _closes")
    more = F.col("_opens") & goes_on(F.lag("_flag").over(pieces), F.lag("run_end").over(pieces))
    edge = edge.withColumn("_new", F.when(more, 0).otherwise(1)).where("_flag").withColumn("_no", F.sum("_new").over(pieces.rowsBetween(_FIRST, 0)))
    edge = edge.groupBy(*keys, "_no").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), F.sum("length").alias("length"))
    cols = [*keys, "run_start", "run_end", "length"]
    return d.where("_flag and not (_opens or _closes)").select(*cols).union(edge.select(*cols))
