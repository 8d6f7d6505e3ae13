"""N-gram Jaccard join by chosen paths.

Texts are sets of word shingles. A run sends every set down paths of sampled
shared tokens: one coordinate of the set's minima names the first bucket; a
bucket that is still large is split again on further coordinates, chosen by a
hash of its path, 1 / threshold of them on average. Small buckets, and what is
left at the last depth, are compared by brute force in bounded blocks. Runs are
repeated until a pair at the threshold is met with the target recall.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.blocks import block_links, blocked, components, crowded, incidence_product, linked, maybe_among, per_block, text_or_empty, with_lowest
from sensorloom.session import written

MINIMA = 64
_WORD = re.compile(r"[^\x20\x09-\x0d]+")
_ODD = (np.random.default_rng(11).integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2)) + np.uint64(1)
_STEPS = (np.random.default_rng(12).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2)) + np.uint64(1)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct hashes of the text's runs of ``width`` words; a shorter text is one shingle, no words none."""
    words = _WORD.findall(text)
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    k = min(width, len(h))
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += h[i : i + n] * _STEPS[i % 64] + np.uint64(i)
    return np.unique(mixed(out))


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of 64 hash functions, as int32."""
    low = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        low = np.minimum(low, (s[at : at + 4096, None] * _ODD[None, :]).min(axis=0))
    return mixed(low).astype(np.uint32).view(np.int32)


def _equal_minima(threshold: float) -> list[float]:
    """The chance of each number of equal minima of a pair at the threshold."""
    return [math.comb(MINIMA, k) * threshold**k * (1 - threshold) ** (MINIMA - k) for k in range(MINIMA + 1)]


def floor_for(threshold: float, recall: float) -> int:
    """Equal minima from which a pair is compared exactly; a quarter of the misses that ``recall`` allows may fall below."""
    chance, below, k = _equal_minima(threshold), 0.0, 0
    while below + chance[k] <= (1 - recall) / 4:
        below += chance[k]
        k += 1
    return k


def runs_for(threshold: float, recall: float, depth: int) -> int:
    """Runs until a pair at the threshold is met with the wanted probability, when its bucket is split down to ``depth``.

    Runs share the minima, so the probability is a mean over how many of them are equal; pairs below the floor are never met.
    """
    def met(k: int, runs: int) -> float:
        x = k / MINIMA
        return 1 - (1 - x * (0.75 * x + 0.25 * (1 - (1 - x) ** 2)) ** (depth - 1)) ** runs

    chance, floor, runs = _equal_minima(threshold), floor_for(threshold, recall), 1
    while sum(chance[k] * met(k, runs) for k in range(floor, MINIMA + 1)) < recall:
        runs += 1
    return runs


def _sketched(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            sets = (shingles(t, width) for t in d["_text"])
            made = [(len(s), minima(s) if len(s) else None) for s in sets]
            yield pd.DataFrame({"_id": d["_id"], "_row": d["_row"], "_node": d["_node"], "size": [x[0] for x in made], "low": [x[1] for x in made]})
    return run


def _with_sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            yield pd.DataFrame({"node": d["node"], "hashes": [shingles(t, width).tobytes() for t in d["_text"]]})
    return run


def _next_paths(path: Column, low: str) -> Column:
    """The one or two buckets below a bucket, in which a set goes on."""
    def step(k: int) -> Column:
        at = F.pmod(F.xxhash64(path, F.lit(k)), F.lit(MINIMA)).cast("int")
        return F.xxhash64(path, F.lit(k), at, F.get(low, at))
    return F.when(F.pmod(F.xxhash64(path, F.lit(-1)), F.lit(4)) == 0, F.array(step(0), step(1))).otherwise(F.array(step(0)))


def bucket_rows(nodes: DataFrame, threshold: float, recall: float, small: int, depth: int) -> DataFrame:
    """(path, node, n): the final buckets with at least two sets."""
    runs = runs_for(threshold, recall, depth)
    first = [F.xxhash64(F.lit(r), F.get("low", F.lit(r * 7 % MINIMA))) for r in range(runs)]
    rows = nodes.select("node", "low", F.explode(F.array(*first)).alias("path"))
    done: list[DataFrame] = []
    for level in range(depth):
        rows = written(crowded(rows, "path"), "paths")
        if level == depth - 1:
            done.append(rows.select("path", "node", "n"))
            break
        done.append(rows.where(F.col("n") <= small).select("path", "node", "n"))
        rows = rows.where(F.col("n") > small).select("node", "low", F.explode(_next_paths(F.col("path"), "low")).alias("path"))
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def _likely(floor: int, threshold: float):
    """The rows of a block that by their minima may have a partner."""
    def fn(d: pd.DataFrame) -> pd.DataFrame | None:
        low, size = np.stack(d["low"].to_numpy()), d["size"].to_numpy().astype(np.float64)

        def near(l: np.ndarray, r: np.ndarray) -> np.ndarray:
            same = np.zeros((len(l), len(r)), np.uint8)
            for c in range(MINIMA):
                same += low[l, c][:, None] == low[r, c][None, :]
            ratio = size[l][:, None] / size[r][None, :]
            return (same >= floor) & (ratio >= threshold - 1e-9) & (ratio <= 1 / threshold + 1e-9)

        hit = np.unique(np.concatenate(linked(d, near)))
        return d.iloc[hit][["path", "lo", "hi", "part", "node", "paths", "copies"]] if len(hit) else None
    return fn


def _verified(threshold: float):
    """Links of a block by the sets themselves."""
    def fn(d: pd.DataFrame) -> pd.DataFrame | None:
        d = d.sort_values("node", kind="stable")
        sets = [np.frombuffer(x, np.uint64) for x in d["hashes"]]
        size = np.array([len(s) for s in sets], np.float64)

        def near(l: np.ndarray, r: np.ndarray) -> np.ndarray:
            sides = [(np.repeat(np.arange(len(x)), size[x].astype(int)), np.concatenate([sets[i] for i in x])) for x in (l, r)]
            common = incidence_product(sides, (len(l), len(r))).astype(np.float64)
            # A hair below: a ratio that is the threshold itself counts.
            return common >= threshold * (size[l][:, None] + size[r][None, :] - common) - 1e-9

        return block_links(d, *linked(d, near))
    return fn


def jaccard_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, threshold: float = 0.8, recall: float = 0.99,
    small: int = 256, depth: int = 3, block: int = 1024,
) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id``, ``component_id``, ``n_links``, ``kept``, and the key ``_row``.

    Words are runs without space, tab or line end, as they stand. ``class_id`` is the smallest id
    with the very same text, ``component_id`` the smallest reachable by links,
    ``n_links`` the number of other rows linked directly (copies included), ``kept``
    is true for the rows whose id is their component's. Repeated rows have equal values.
    Null texts count as empty. A text without words has no shingle: it links with nothing, is its
    own class and component, and is kept. A text shorter than ``width`` words is one shingle.
    Every link that is reported has been compared exactly; a link at the threshold is
    found with probability ``recall`` at least, a closer one with more. Nothing is
    capped: a large bucket is compared in blocks. An empty table gives an empty result.
    Writes intermediate tables to the shared folder.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    base = base.withColumn("_node", F.md5("_text")).withColumn("_row", row_key("_id", "_text"))
    rows = written(base.mapInPandas(_sketched(width), base.select("_id", "_row", "_node").schema.simpleString().removeprefix("struct<").removesuffix(">") + ",size int,low array<int>"), "sketches")
    nodes = written(rows.where("size > 0").groupBy(F.col("_node").alias("node")).agg(F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.first("low").alias("low"), F.first("size").alias("size")), "nodes")
    final = written(bucket_rows(nodes, threshold, recall, small, depth), "buckets")
    own = final.groupBy("node").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    lit_nodes = nodes.select("node", "low", "size", "copies").join(own, "node")
    pairs = blocked(final.distinct(), "path", "node", block).join(lit_nodes, "node")
    keys = ["path", "lo", "hi"]
    likely = written(per_block(pairs, keys, _likely(floor_for(threshold, recall), threshold), "path long, lo int, hi int, part int, node string, paths array<long>, copies long"), "likely")
    wanted = likely.select("node").distinct()
    texts = maybe_among(base.select(F.col("_node").alias("node"), "_text"), "node", wanted).where("_maybe").drop("_maybe")
    texts = texts.join(wanted.hint("merge"), "node", "left_semi").dropDuplicates(["node"])
    sets = texts.mapInPandas(_with_sets(width), "node string, hashes binary")
    found = written(per_block(likely.join(sets, "node"), keys, _verified(threshold), "a string, b string, links long"), "links")
    roots = components(found.select("a", "b"), "components")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    placed = nodes.select("node", "class_id", "copies").join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = with_lowest(placed, roots).select("node", "root", "class_id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("_id", "_row", F.col("_node").alias("node"), "size").join(placed, "node", "left")
    single = F.col("size") == 0
    return out.select(
        F.col("_id").alias(id_col), F.when(single, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(single, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (single | F.col("_id").eqNullSafe(F.col("component_id"))).alias("kept"), "_row", (~single).alias("_linked"), F.coalesce("root", "node").alias("_root"),
    )


def row_key(id_col: str | Column, text: str | Column) -> Column:
    """A key of id and text, never null."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), text_or_empty(text)))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies: the first id's. Texts without words all stay.

    Of repeated rows (same id, same text) one stays. Columns that are called like those in use here raise an error.
    """
    clash = {"_row", "_maybe", "_stays", "_p", "_bucket", "_map"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns in use: {sorted(clash)}")
    links = written(jaccard_links(docs, id_col, text_col, **options).select("_row", "_root", "kept", "_linked"), "kept")
    # One row key for each component, so that two texts under one id don't both stay.
    kept = links.where("kept AND _linked").groupBy("_root").agg(F.min("_row").alias("_row")).select("_row")
    # Rows that may go: those of other keys, and repeated rows. All others stay where they are.
    count = links.where("_linked").groupBy("_row").agg(F.count(F.lit(1)).alias("n")).join(kept.withColumn("_stays", F.lit(True)), "_row", "left")
    doubtful = written(count.where("n > 1 OR _stays IS NULL").select("_row", F.coalesce("_stays", F.lit(False)).alias("_stays")), "doubtful")
    keyed = maybe_among(docs.withColumn("_row", row_key(id_col, text_col)), "_row", doubtful.select("_row"))
    looked = keyed.where("_maybe").join(doubtful, "_row", "left")
    once = looked.where("_stays").dropDuplicates(["_row"])
    return keyed.where("NOT _maybe").select(*docs.columns).unionByName(looked.where("_stays IS NULL").select(*docs.columns)).unionByName(once.select(*docs.columns))
