"""The queries behind a dashboard view of one tier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from sensorloom.operators.aggregates import resample, summary_table
from sensorloom.operators.filters import head_tail
from sensorloom.operators.reshape import melt_positions
from sensorloom.sources.tiers import export_slice, slice_tier

ORDER = ("Tree", "Cable", "Timestamp")


@dataclass(frozen=True)
class View:
    """Tables of one dashboard view; each is computed only when used."""

    data: DataFrame
    long: DataFrame
    summary: DataFrame
    head: DataFrame
    tail: DataFrame
    iso: DataFrame
    text: DataFrame


def dashboard_view(tier: DataFrame, tree: str, cable: str, start: str, end: str, resolution: str = "15min") -> View:
    data = resample(slice_tier(tier, start, end, tree, cable), resolution)
    head, tail = head_tail(data, ORDER)
    return View(data, melt_positions(data), summary_table(data), head, tail, export_slice(data), export_slice(data, "text"))
