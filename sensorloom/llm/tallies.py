"""Counts of very many keys, summed over tasks: each task sends its keys in slices, and slices are added up in two rounds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slices_for(parts: int, least: int = 32) -> int:
    """Number of slices (a power of two) for so many tasks: it grows with their root, so that rows stay few and slices small."""
    return least << max(0, math.ceil(math.log(max(parts, 1) / least, 4)))


class Tally:
    """Counts by 64-bit key, ``width`` of them each."""

    def __init__(self, width: int = 1):
        self.width, self.keys, self.counts, self.more, self.held = width, np.empty(0, np.uint64), np.empty((0, width), np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.more.append((keys, np.ones((len(keys), self.width), np.int64) if counts is None else counts))
        self.held += len(keys)
        if self.held > max(1_000_000, len(self.keys)):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        if self.more:
            keys = np.concatenate([self.keys, *[k for k, _ in self.more]])
            counts = np.concatenate([self.counts, *[c for _, c in self.more]])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
            self.keys, self.counts = keys[at], np.add.reduceat(counts[order], at, axis=0) if len(at) else counts
            self.more, self.held = [], 0
        return self.keys, self.counts

    def sliced(self, number: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """(slice, keys, counts) by each key's slice."""
        order = np.argsort(number, kind="stable")
        cut = np.flatnonzero(np.diff(number[order])) + 1
        for at in np.split(order, cut) if len(order) else []:
            yield int(number[at[0]]), self.keys[at].tobytes(), self.counts[at].tobytes()


def added(rows: DataFrame, parts: int, by: list[str], width: int) -> DataFrame:
    """(by, slice, keys, counts) with counts summed, from rows (by, slice, part, keys, counts) of all tasks.

    The first round adds up some of a slice's rows, about the root of their number, the second the rest; so no task holds
    what all tasks have sent for a slice.
    """
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    schema = f"{schema}{', ' if by else ''}slice int, keys binary, counts binary"

    def add(d: pd.DataFrame) -> pd.DataFrame:
        t = Tally(width)
        for k, c in zip(d["keys"], d["counts"]):
            t.add(np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64).reshape(-1, width))
        keys, counts = t.settle()
        first = d.iloc[0]
        return pd.DataFrame({**{c: [first[c]] for c in by}, "slice": [first["slice"]], "keys": [keys.tobytes()], "counts": [counts.tobytes()]})

    fan = max(1, math.isqrt(max(parts - 1, 0)) + 1)
    d = rows.withColumn("_some", F.col("part") % fan)
    d = d.groupBy(*by, "slice", "_some").applyInPandas(add, schema)
    return d.groupBy(*by, "slice").applyInPandas(add, schema)
