"""Quality by importance resampling.

Two generative models, of the target texts and of all raw texts, give each document the
log ratio of its probabilities. Both are bags of hashed word n-grams. Gumbel noise
added to the ratios turns the top k into a sample without replacement.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.blocks import maybe_among, text_or_empty
from sensorloom.llm.poisson_mix import uniform
from sensorloom.session import written

BUCKETS = 1 << 15
_PARTS = re.compile(r"\w+|[^\w\s]+")
_KNOWN: dict[str, int] = {}


def buckets(text: str) -> np.ndarray:
    """The buckets of a text's words and signs, in small letters, and of its pairs of them."""
    words = _PARTS.findall(text.lower())
    if len(_KNOWN) > 500_000:
        _KNOWN.clear()
    for w in words:
        if w not in _KNOWN:
            _KNOWN[w] = xxhash.xxh32_intdigest(w)
    h = np.fromiter((_KNOWN[w] for w in words), np.uint64, len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B1) + h[1:] * np.uint64(0x85EBCA77)) >> np.uint64(13)
    return np.concatenate([h % np.uint64(BUCKETS // 2), pairs % np.uint64(BUCKETS // 2) + np.uint64(BUCKETS // 2)]).astype(np.int64)


# Counts travel in pieces of so many buckets; the pieces of this many tasks' shares are added first.
_PIECE, _SHARES = 1024, 32


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = {}
    for d in batches:
        for text, target in zip(d["text"], d["target"]):
            row = total.setdefault(bool(target), np.zeros(BUCKETS, np.int64))
            row += np.bincount(buckets(text), minlength=BUCKETS)
    share = TaskContext.get().partitionId() % _SHARES
    for target, row in total.items():
        pieces = row.reshape(-1, _PIECE)
        yield pd.DataFrame({"piece": np.arange(len(pieces), dtype=np.int32), "target": target, "share": share, "counts": [p.tobytes() for p in pieces]})


def _added(d: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_PIECE, np.int64)
    for c in d["counts"]:
        total += np.frombuffer(c, np.int64)
    return d.iloc[:1].assign(counts=[total.tobytes()])


def counts(texts: DataFrame) -> DataFrame:
    """(piece, target, share, counts) from (text, target): every task sends its counts in a fixed number of rows, which are added in two steps."""
    schema = "piece int, target boolean, share int, counts binary"
    d = texts.mapInPandas(_counted, schema)
    for keys in (("piece", "target", "share"), ("piece", "target")):
        d = d.groupBy(*keys).applyInPandas(_added, schema)
    return d


def log_ratios(found: DataFrame) -> np.ndarray:
    """Per bucket the log of target over raw probability. The number of buckets is fixed, and so is what reaches the driver.

    Raw counts are those of all texts, targets included; both models start from the raw shares with the weight of one
    token per hundred buckets, so that a bucket without tokens says nothing.
    """
    side = {True: np.zeros(BUCKETS), False: np.zeros(BUCKETS)}
    for r in found.collect():
        side[r["target"]][r["piece"] * _PIECE : (r["piece"] + 1) * _PIECE] = np.frombuffer(r["counts"], np.int64)
    raw = side[True] + side[False]
    out = np.zeros(BUCKETS)
    for part in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
        prior = (raw[part] + 1.0) / (raw[part] + 1.0).sum()
        weight = BUCKETS / 100
        target = (side[True][part] + weight * prior) / (side[True][part].sum() + weight)
        out[part] = np.log(target) - np.log(prior)
    return out


def _scored(weights: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            found = (buckets(t) for t in d["text"])
            both = [(float(weights[b].sum()), len(b)) for b in found]
            yield pd.DataFrame({"id": d["id"], "row": d["row"], "log_weight": [x[0] for x in both], "n_grams": [x[1] for x in both]})
    return run


def global_top(d: DataFrame, key: str, tie: str, k: int) -> DataFrame:
    """``d`` with ``selected``: whether a row is one of the k with the largest ``key``, then the smallest ``tie``.

    Rows are sorted over all partitions; one count per partition says in which the k-th row lies.
    """
    placed = written(d.orderBy(F.desc(key), F.asc(tie)).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")), "ranked")
    base, before = [], 0
    for r in sorted(placed.groupBy("_part").count().collect(), key=lambda r: r["_part"]):
        base.append((r["_part"], before))
        before += r["count"]
    starts = d.sparkSession.createDataFrame(base, "_part int, _base long")
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), "_part").withColumn("selected", F.col("_base") + inside < k).drop("_part", "_place", "_base")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, share: float | None = None, k: int | None = None, seed: int = 23,
) -> DataFrame:
    """Per row of ``docs``: id, ``log_weight``, ``n_grams``, ``key`` and ``selected``.

    ``target`` holds the ids of target documents. Exactly ``k`` rows are selected, or ``share`` of all rows, rounded.
    ``key`` is the log weight plus Gumbel noise hashed from seed, id and text.
    Null texts count as empty and have the log weight 0; repeated rows share their key, and ties go by a hash of id and text.
    Ids in ``target`` that are no document's, null or repeated change nothing. Without any target all weights are 0, and the sample is uniform.
    An empty table gives an empty result. Counts cover all texts; the models' size is fixed. Writes the keys to the shared folder.
    """
    row = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), text_or_empty(text_col)))
    d = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    wanted = target.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    # Texts that are surely no target are not shuffled.
    seen = maybe_among(d, "id", wanted)
    found = seen.where("_maybe").join(wanted.withColumn("target", F.lit(True)).hint("merge"), "id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    marked = seen.where("NOT _maybe").select("text", F.lit(False).alias("target")).unionByName(found)
    weights = log_ratios(counts(marked))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("row", T.StringType()), T.StructField("log_weight", T.DoubleType()), T.StructField("n_grams", T.LongType())])
    keyed = docs.select(F.col(id_col).alias("id"), row.alias("row"), text_or_empty(text_col).alias("text")).mapInPandas(_scored(weights), schema)
    keyed = keyed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform(seed, F.col("row")))))
    keyed = written(keyed, "keys")
    if k is None:
        k = round((1.0 if share is None else share) * keyed.count())
    out = global_top(keyed, "key", "row", k)
    return out.select(F.col("id").alias(id_col), "log_weight", "n_grams", "key", "selected")
