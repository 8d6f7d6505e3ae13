"""Near-duplicate vectors by lattice hashing.

In each of several tables a vector is projected at random to a few blocks of eight
numbers, and each block is decoded to its point of the lattice E8. The points of
all blocks name the vector's cell. Neighbouring cells, with one block moved to the
nearest point of the lattice's other half, are probed too. Vectors that share a cell
are compared by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.blocks import block_links, blocked, components, crowded, linked, per_block, with_lowest
from sensorloom.session import written


def nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest integer point with an even sum, for each row of eight numbers."""
    near = np.rint(y)
    off = y - near
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the nearest point of E8, and twice the nearest point of the half that it is not in."""
    whole, half = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    closer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    first = np.where(closer[:, None], whole, half)
    second = np.where(closer[:, None], half, whole)
    return (2 * first).astype(np.int64), (2 * second).astype(np.int64)


def unit(values) -> np.ndarray | None:
    """The vector at length one in double precision; None if it is null, empty, zero or not finite throughout."""
    if values is None or len(values) == 0:
        return None
    v = np.array([np.nan if x is None else x for x in values], dtype=np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def cells(units: np.ndarray, tables: int, blocks: int, scale: float, seed: int) -> np.ndarray:
    """The numbers of the cells of each vector: for each table its own, and one more per block."""
    dim = units.shape[1]
    rng = np.random.default_rng([seed, dim])
    # A column's length makes a block of a projected difference as long as the difference on average, times scale.
    project = rng.standard_normal((dim, tables * blocks * 8)) * (scale / np.sqrt(8))
    y = (units @ project).reshape(-1, 8)
    first, second = decode_e8(y)
    odd = np.random.default_rng([seed, 1]).integers(1, 2**62, (blocks, 8)) * 2 + 1
    n = len(units)
    a = (first.reshape(n, tables, blocks, 8) * odd).sum(axis=3)
    b = (second.reshape(n, tables, blocks, 8) * odd).sum(axis=3)
    mix = np.int64(0x9E3779B97F4A7C15 - 2**64)
    home = a.sum(axis=2)
    probed = home[:, :, None] - a + b
    keys = np.concatenate([home[:, :, None], probed], axis=2)
    keys = (keys ^ (np.arange(tables, dtype=np.int64)[None, :, None] * mix + dim)) * mix
    keys ^= (keys >> 29) & np.int64(2**35 - 1)
    return keys.reshape(n, -1)


def _hashed(tables: int, blocks: int, scale: float, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            vectors = [unit(v) for v in d["_vector"]]
            nodes: list = [None if v is None else xxhash.xxh3_128_hexdigest(v.tobytes()) for v in vectors]
            paths: list = [None] * len(d)
            for dim in {len(v) for v in vectors if v is not None}:
                at = [i for i, v in enumerate(vectors) if v is not None and len(v) == dim]
                with np.errstate(over="ignore"):
                    found = cells(np.stack([vectors[i] for i in at]), tables, blocks, scale, seed)
                for i, p in zip(at, found):
                    paths[i] = np.unique(p)
            yield pd.DataFrame({"_id": d["_id"], "node": nodes, "unit": [None if v is None else v.tobytes() for v in vectors], "cells": paths})
    return run


def _verified(threshold: float):
    def fn(d: pd.DataFrame) -> pd.DataFrame | None:
        d = d.sort_values("node", kind="stable")
        v = np.stack([np.frombuffer(x) for x in d["unit"]])
        return block_links(d, *linked(d, lambda l, r: v[l] @ v[r].T >= threshold))
    return fn


def _screened(threshold: float, small: int = 64):
    """Which blocks of a batch hold a close pair: all of their pairs by row products, offset by offset; large blocks are taken as they are."""
    def fn(d: pd.DataFrame, starts: np.ndarray) -> np.ndarray:
        size = np.diff(starts)
        keep = size > small
        units = d["unit"].to_numpy()
        if len({len(u) for u in units}) != 1:
            return np.ones(len(size), bool)
        v = np.frombuffer(b"".join(units)).reshape(len(units), -1)
        block = np.repeat(np.arange(len(size)), size)
        rows = np.flatnonzero(~keep[block])
        for k in range(1, small):
            rows = rows[rows + k < len(block)]
            rows = rows[block[rows] == block[rows + k]]
            if not len(rows):
                break
            near = np.einsum("ij,ij->i", v[rows], v[rows + k]) >= threshold - 1e-9
            keep[block[rows[near]]] = True
        return keep
    return fn


def vector_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, threshold: float = 0.9,
    tables: int = 24, blocks: int = 2, scale: float = 1.5, block: int = 1024, seed: int = 5,
) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``, ``class_id``.

    ``n_links`` counts the other rows with a cosine of at least ``threshold``, copies included;
    ``component_id`` is the smallest id reachable by links, ``class_id`` the smallest
    with the same direction to the last bit; ``kept`` marks ids that are their component's.
    A vector that is null, empty or zero or holds null, NaN or infinity links with nothing.
    Vectors of different lengths don't link. Repeated rows link with each other. An empty table gives an empty result.
    Reported links are exact; the number of tables sets how many are found (``tests/llm`` measures it).
    More blocks make cells smaller: each divides the chance meetings by some
    hundred, so add one for every hundredfold more rows, and tables to match.
    No bucket is capped. Writes intermediate tables to the shared folder.
    """
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    kind = rows.schema["_id"].dataType.simpleString()
    hashed = written(rows.mapInPandas(_hashed(tables, blocks, scale, seed), f"_id {kind}, node string, unit binary, cells array<long>"), "cells")
    nodes = written(hashed.where("node is not null").groupBy("node").agg(F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"), F.first("cells").alias("cells")), "vectors")
    shared = written(crowded(nodes.select("node", F.explode("cells").alias("path")), "path"), "shared")
    own = shared.groupBy("node").agg(F.collect_list("path").alias("paths"))
    rows_in = blocked(shared, "path", "node", block).join(nodes.select("node", "copies", "unit").join(own, "node"), "node")
    found = written(per_block(rows_in, ["path", "lo", "hi"], _verified(threshold), "a string, b string, links long", _screened(threshold)), "links")
    roots = components(found.select("a", "b"), "components")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    placed = nodes.select("node", "class_id", "copies").join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = with_lowest(placed, roots).select("node", "class_id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = hashed.select("_id", "node").join(placed, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"), F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
    )
