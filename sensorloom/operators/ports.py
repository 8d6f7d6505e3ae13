"""Wide logger records to velocities: ports, temperature rises, ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.config import AFTER_PREFIX, BASE_PREFIX, CABLES, PORTS, PORTS_PER_CABLE, POSITIONS, Limits, Probe
from sensorloom.functions.columns import heat_velocity, null_outside, to_number, wiring_start

HALF = PORTS_PER_CABLE // 2


def port_columns(df: DataFrame, prefix: str, ports: int = PORTS) -> list[str]:
    """Columns whose name starts with ``prefix`` in any case, in table order."""
    found = [c for c in df.columns if c.lower().startswith(prefix.lower())]
    if len(found) != ports:
        raise ValueError(f"expected {ports} columns starting with {prefix!r}, found {len(found)}")
    return found


def port_array(df: DataFrame, prefix: str, ports: int = PORTS) -> Column:
    return F.array(*[to_number(F.col(f"`{c}`")) for c in port_columns(df, prefix, ports)])


def select_ports(df: DataFrame, prefix: str, kind: str, time: str = "Timestamp", keep: Sequence[str] = (), ports: int = PORTS) -> DataFrame:
    """The columns of one kind as Port1..PortN, with time and a type tag."""
    renamed = [F.col(f"`{c}`").alias(f"Port{i}") for i, c in enumerate(port_columns(df, prefix, ports), 1)]
    return df.select(*keep, *renamed, time, F.lit(kind).alias("type"))


def ports_as_arrays(df: DataFrame, keep: Sequence[str] = ("Tree", "Timestamp"), ports: int = PORTS) -> DataFrame:
    """Both temperatures of every port as two arrays on the same row."""
    return df.select(*keep, port_array(df, BASE_PREFIX, ports).alias("base"), port_array(df, AFTER_PREFIX, ports).alias("after"))


def limit_ports(col: str | Column, lo: float, hi: float) -> Column:
    """Range check over an array of ports."""
    return F.transform(col, lambda v: null_outside(v, lo, hi))


def pulse_delta(df: DataFrame, limits: Limits | None = Limits(), name: str = "delta") -> DataFrame:
    """Temperature rise per port; with limits, out-of-range temperatures and rises are missing."""
    base, after = F.col("base"), F.col("after")
    if limits is not None:
        base, after = (limit_ports(c, limits.temp_min, limits.temp_max) for c in (base, after))
    rise = F.zip_with(after, base, lambda a, b: a - b)
    if limits is not None:
        rise = limit_ports(rise, limits.delta_min, limits.delta_max)
    return df.withColumn(name, rise)


def wired_cables(station_info: DataFrame, tree: str = "Tree", cables: int = CABLES) -> DataFrame:
    """Wired cables of each station with their first port; cables without wiring do not appear."""
    cols = [f"Cable{i}" for i in range(1, cables + 1)]
    return (
        station_info.unpivot([tree], cols, "Cable", "span")
        .where(F.col("span").isNotNull())
        .select(tree, F.regexp_extract("Cable", r"(\d+)", 1).try_cast("int").alias("Cable"), wiring_start("span").alias("start"))
    )


def wired_probes(station_info: DataFrame, tree: str = "Tree", cables: int = CABLES) -> DataFrame:
    """Upper and lower probe of every wired cable."""
    return wired_cables(station_info, tree, cables).select(
        tree, "Cable", F.explode(F.array(F.lit("U"), F.lit("L"))).alias("Placement"), "start"
    ).select(
        tree, "Cable", "Placement",
        F.concat(F.col("Cable").cast("string"), "Placement").alias("probe"),
        (F.col("start") + F.when(F.col("Placement") == "U", 0).otherwise(HALF)).alias("start"),
    )


def wiring_map(station_info: DataFrame, tree: str = "Tree", cables: int = CABLES) -> DataFrame:
    """One row per station with its wired cables as an array of at most ``cables`` (Cable, start)."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("Cable"), wiring_start(f"Cable{i}").alias("start")) for i in range(1, cables + 1)
    ])
    return station_info.select(tree, F.filter(pairs, lambda p: p["start"].isNotNull()).alias("wiring"))


def wiring_to_ports(df: DataFrame, arrays: Sequence[str] = ("delta",)) -> DataFrame:
    """One row per wired cable with the six consecutive ports of each array. Needs a ``wiring`` column."""
    d = df.withColumn("_c", F.explode("wiring"))
    kept = [c for c in df.columns if c not in (*arrays, "wiring")]
    return d.select(
        *kept, F.col("_c.Cable").alias("Cable"),
        *[F.slice(a, F.col("_c.start"), F.lit(PORTS_PER_CABLE)).alias(a) for a in arrays],
    )


def probe_ratio(df: DataFrame, delta: str = "delta") -> DataFrame:
    """Rise of ports 1..3 over that of ports 4..6 of a cable, per depth."""
    ratios = {p: F.try_divide(F.get(delta, F.lit(i)), F.get(delta, F.lit(i + HALF))) for i, p in enumerate(POSITIONS)}
    return df.withColumns(ratios).drop(delta)


def velocities(df: DataFrame, probe: Probe = Probe()) -> DataFrame:
    """Ratio columns to velocity columns; rows without a time are dropped."""
    d = df.withColumns({f"{p}_vel": heat_velocity(p, probe) for p in POSITIONS}).drop(*POSITIONS)
    return d.where(F.col("Timestamp").isNotNull())


def cable_velocities(
    ports: DataFrame,
    station_info: DataFrame,
    limits: Limits | None = Limits(),
    probe: Probe = Probe(),
) -> DataFrame:
    """Port arrays to one row per (Tree, Cable, Timestamp) with the three velocities.

    The wiring meets the records on the station; a table of one row per station is
    broadcast by Spark while it is small. Everything after it is a projection.
    """
    wired = ports.join(wiring_map(station_info), "Tree", "inner")
    d = pulse_delta(wired, limits).select("Tree", "Timestamp", "wiring", "delta")
    return velocities(probe_ratio(wiring_to_ports(d)), probe).select(
        "Tree", "Cable", "Timestamp", *[f"{p}_vel" for p in POSITIONS]
    )


def before_after_probe(ports: DataFrame, station_info: DataFrame) -> DataFrame:
    """Base and after-pulse temperature of each depth, per cable and probe (U / L)."""
    wired = ports.join(wiring_map(station_info), "Tree", "inner")
    d = wiring_to_ports(wired, ("base", "after"))
    pairs = [
        F.struct(
            F.lit(placement).alias("Placement"), F.lit(kind).alias("type"),
            *[F.get(array, F.lit(i + offset)).alias(p) for i, p in enumerate(("Outer", "Middle", "Inner"))],
        )
        for placement, offset in (("U", 0), ("L", HALF))
        for kind, array in (("Base.temp", "base"), ("After.pulse", "after"))
    ]
    return d.select("Tree", "Cable", "Timestamp", F.explode(F.array(*pairs)).alias("_p")).select(
        "Tree", "Cable", "_p.Placement", "Timestamp", "_p.type", "_p.Outer", "_p.Middle", "_p.Inner"
    )
