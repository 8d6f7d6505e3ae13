"""Rolling median / MAD outlier filter."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.config import OUTLIER_FLAG, SPAN_SECONDS, VELOCITIES
from sensorloom.functions.columns import any_set
from sensorloom.operators.ordered import ordered, position

BLOCK_ROWS = 4096


def _with_halo(df: DataFrame, slot: str, half: int, block: int) -> DataFrame:
    """Give every row its block, and copy rows near a border into the next block too."""
    home = F.floor(F.col(slot) / F.lit(block)).cast("long")
    offset = F.pmod(F.col(slot), F.lit(block))
    targets = F.filter(
        F.array(home, F.when(offset < half, home - 1), F.when(offset >= block - half, home + 1)),
        lambda b: b.isNotNull(),
    )
    return df.withColumn("_home", home).withColumn("_block", F.explode(targets))


def _row_medians(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median of the present values in each row, and how many there are."""
    ranked = np.sort(windows, axis=1)
    n = windows.shape[1] - np.isnan(windows).sum(axis=1)
    row = np.arange(len(ranked))
    upper = np.minimum(n // 2, windows.shape[1] - 1)
    return (ranked[row, np.maximum(n - 1, 0) // 2] + ranked[row, upper]) / 2, n


def hampel(
    df: DataFrame,
    keys: Sequence[str] = ("Tree", "Cable"),
    time: str = "Timestamp",
    cols: Sequence[str] = VELOCITIES,
    half: int = 24,
    threshold: float = 3.0,
    scale: float = 1.4826,
    min_count: int = 1,
    step: int | None = None,
    span: int = SPAN_SECONDS,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Replace outliers by the median of the centred window of ``2 * half + 1`` rows.

    A value is an outlier if it is more than ``threshold`` scaled MADs from the
    median. Rows without a full window, and windows with fewer than ``min_count``
    values, keep their input. Adds ``<position>_flag`` where a value was changed.

    Spark cuts the rows into blocks of bounded size with copies of ``half`` rows
    across each border, so the result does not depend on the cut; only the window
    arithmetic of one block runs in Python (a MAD is not a window aggregate, and
    arrays per row cost more than twice the time). The row number decides the
    block. With ``step`` the time does, which saves a pass but holds only where a series has
    exactly one row per ``step`` seconds: this is checked by one aggregate at once and in every
    block, and a hole, an odd time or a repeated one is an error.
    """
    if block <= 2 * half:
        raise ValueError("block must be larger than the window")
    keys, cols, width = list(keys), list(cols), 2 * half + 1
    flags = [flag_name(c) for c in cols]
    if step is None:
        d = ordered(df, keys, time, span, _slot=position())
    else:
        at = F.unix_timestamp(time)
        holes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), ((F.max(at) - F.min(at)) / step + 1).alias("slots")).where("n <> slots").take(1)
        if holes:
            raise ValueError(f"series {[holes[0][k] for k in keys]} has {holes[0]['n']} rows on {holes[0]['slots']} steps of {step} s")
        d = df.withColumn("_slot", F.floor(at / F.lit(step)).cast("long"))
    d = _with_halo(d, "_slot", half, block)
    names = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(f, T.StringType()) for f in flags]])

    def clean(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_slot", ignore_index=True)
        if step is not None and (np.diff(pdf["_slot"].to_numpy()) != 1).any():
            raise ValueError(f"rows are not one per {step} s: repeated or odd times")
        out = pdf[names].copy()
        for c, flag in zip(cols, flags):
            values = pdf[c].to_numpy(dtype=float)
            marks = np.full(len(values), None, dtype=object)
            if len(values) >= width:
                windows = np.lib.stride_tricks.sliding_window_view(values, width)
                middle, n = _row_medians(windows)
                spread, _ = _row_medians(np.abs(windows - middle[:, None]))
                inner = slice(half, len(values) - half)
                odd = (n >= min_count) & (np.abs(values[inner] - middle) > threshold * scale * spread)
                replaced = values.copy()
                replaced[inner] = np.where(odd, middle, values[inner])
                marks[inner][odd] = OUTLIER_FLAG
                out[c] = replaced
            out[flag] = marks
        return out[pdf["_home"] == pdf["_block"]]

    cleaned = d.groupBy(*keys, "_block").applyInPandas(clean, schema)
    return cleaned.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})


def flag_name(col: str) -> str:
    return f"{col.removesuffix('_vel')}_flag"


def split_flags(df: DataFrame, cols: Sequence[str] = VELOCITIES, keys: Sequence[str] = ("Tree", "Cable", "Timestamp")) -> tuple[DataFrame, DataFrame]:
    """Separate the filtered tier from the table of changed rows."""
    flags = [flag_name(c) for c in cols]
    return df.drop(*flags), df.select(*keys, *flags).where(any_set(*flags))
