"""Steps that the similarity joins share: buckets cut into bounded blocks, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.joins import salted_join
from sensorloom.session import written


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def crowded(rows: DataFrame, key: str, member: str = "node") -> DataFrame:
    """The rows whose key occurs at least twice, with its count ``n``.

    The counts are pre-aggregated and joined; a hot key's rows are spread by ``member``.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return salted_join(rows, counts, [key], member, "inner")


def with_lowest(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """``placed`` (node, root, class_id, ...) with ``component_id``, the lowest class of its root. A giant component's rows, told by ``roots``, are spread."""
    lowest = placed.groupBy("root").agg(F.min("class_id").alias("component_id"))
    return salted_join(placed, lowest, ["root"], "node", "inner", like=roots)


def maybe_among(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``key`` is surely not among the keys of ``wanted``, which has the same column.

    ``wanted`` becomes a bitmap of ``bits`` hashed places, two megabytes whatever its size, and is broadcast as such. It saves shuffling
    rows that a join on the key would drop; the join itself still decides. With many more keys than places it only saves less.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    w = wanted.select(place.alias("_p")).select(F.floor(F.col("_p") / 32768).alias("_bucket"), (F.col("_p") % 32768).alias("_at"))
    maps = w.groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_map"))
    d = rows.withColumn("_p", place).withColumn("_bucket", F.floor(F.col("_p") / 32768)).join(F.broadcast(maps), "_bucket", "left")
    at = F.col("_p") % 32768
    byte = F.conv(F.hex(F.substring("_map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return d.withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("_p", "_bucket", "_map")


def blocked(rows: DataFrame, bucket: str, member: str, most: int) -> DataFrame:
    """Adds ``part``, ``lo`` and ``hi``: a bucket of n rows becomes blocks of two parts each.

    Every two rows of a bucket meet in exactly one block, and a block holds about
    ``2 * most`` rows whatever the size of the bucket.
    """
    parts = F.ceil(F.col("n") / F.lit(most)).cast("int")
    d = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(member, bucket), F.col("parts")).cast("int"))
    d = d.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return d.withColumns({"lo": F.least("part", "_other"), "hi": F.greatest("part", "_other")}).drop("_other", "parts")


def per_block(
    rows: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str,
    screen: Callable[[pd.DataFrame, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``fn`` once per block, many small blocks in one Arrow batch.

    ``screen`` looks at all blocks of a batch at once and tells which of them can have a result.

    Blocks are bounded by ``blocked``, so a task holds one batch and one unfinished block.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held = pd.concat([*rest, batch], ignore_index=True) if rest else batch
            starts = _starts(held, keys)
            wanted = range(len(starts) - 1)
            if screen is not None and len(starts) > 1:
                wanted = np.flatnonzero(screen(held.iloc[: starts[-1]], starts))
            outs = [out for i in wanted if (out := fn(held.iloc[starts[i] : starts[i + 1]])) is not None]
            rest = [held.iloc[starts[-1]:]]
            if outs:
                yield pd.concat(outs, ignore_index=True)
        if rest and (out := fn(rest[0])) is not None:
            yield out
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _starts(d: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(d), bool)
    new[0] = True
    for k in keys:
        v = d[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def met_before(paths: list[np.ndarray], left: np.ndarray, right: np.ndarray, path: int) -> np.ndarray:
    """(left, right): whether two rows also share a bucket with a smaller number, where they are compared instead."""
    sides = []
    for rows in (left, right):
        held = [p[p < path] for p in (paths[i] for i in rows)]
        sides.append((np.repeat(np.arange(len(rows)), [len(p) for p in held]), np.concatenate([np.empty(0, np.int64), *held])))
    return incidence_product(sides, (len(left), len(right))) > 0


def incidence_product(sides: list[tuple[np.ndarray, np.ndarray]], shape: tuple[int, int]) -> np.ndarray:
    """How many values each row of one side shares with each row of the other; sides are (row, value) without repeats.

    Products of incidence columns, a slice of the shared values at a time.
    """
    both = np.intersect1d(sides[0][1], sides[1][1])
    out = np.zeros(shape, np.float32)
    if not len(both):
        return out
    held = []
    for row, value in sides:
        at = np.minimum(np.searchsorted(both, value), len(both) - 1)
        ok = both[at] == value
        order = np.argsort(at[ok], kind="stable")
        held.append((row[ok][order], at[ok][order]))
    width = 2048
    for start in range(0, len(both), width):
        n = min(width, len(both) - start)
        m = []
        for (row, at), rows in zip(held, shape):
            x, y = np.searchsorted(at, [start, start + n])
            one = np.zeros((rows, n), np.float32)
            one[row[x:y], at[x:y] - start] = 1
            m.append(one)
        out += m[0] @ m[1].T
    return out


def sides_of(d: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the two parts of a block, and whether they are the same part."""
    lo, hi, part = d["lo"].iloc[0], d["hi"].iloc[0], d["part"].to_numpy()
    return np.flatnonzero(part == lo), np.flatnonzero(part == hi), bool(lo == hi)


def linked(d: pd.DataFrame, near: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of a block for which ``near`` holds and that no smaller bucket has."""
    left, right, same = sides_of(d)
    paths, path = [np.asarray(p, np.int64) for p in d["paths"]], d["path"].iloc[0]
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(left), 256):
        l = left[at : at + 256]
        ok = near(l, right)
        if same:
            ok &= l[:, None] < right[None, :]
        if ok.any():
            ok &= ~met_before(paths, l, right, path)
            a, b = np.nonzero(ok)
            found_a.append(l[a])
            found_b.append(right[b])
    return np.concatenate(found_a), np.concatenate(found_b)


def block_links(d: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame | None:
    """Per row the copies it is linked with, and the first row of the block that it reaches. Rows are in order of ``node``."""
    if not len(a):
        return None
    copies, node, links = d["copies"].to_numpy(), d["node"].to_numpy(), np.zeros(len(d), np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    root, some = block_roots(len(d), a, b), np.flatnonzero(links > 0)
    return pd.DataFrame({"a": node[some], "b": node[root[some]], "links": links[some]})


def block_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n rows joined by the pairs (a, b) the smallest row that each reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is one node of its component.

    Every round moves each node to the smallest of itself and its neighbours and
    rewrites the edges; edges inside a merged node vanish. Nodes are hashes, so the
    order is random and the number of nodes with edges falls by a constant factor
    a round. Both tables of a round are written to the shared folder; nothing but
    the test for remaining edges reaches the driver.
    """
    e = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)
    moves: list[DataFrame] = []
    while not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root")), label)
        moves.append(to)
        e = e.join(to.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(to.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        e = written(e.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), label)
    if not moves:
        return e.select(F.col("a").alias("node"), F.col("a").alias("root"))
    out = moves[0]
    for to in moves[1:]:
        out = out.join(to.select(F.col("node").alias("root"), F.col("root").alias("_next")), "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return written(out, label)
