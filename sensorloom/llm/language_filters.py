"""Language identification by n-gram filters.

The n-grams that a fair share of a language's documents have are put into a Bloom filter whose cells hold one bit per
language: the cells of an n-gram, ANDed, are the languages that contain it. A text's n-grams are looked up, each
language's bits counted, and the counts freed of the hits that chance gives a filter as full as that language's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.tallies import Tally, added, slices_for
from sensorloom.session import written

ORDERS = (3, 4)
#: Cells per n-gram.
PROBES = 3
UNKNOWN = "und"
# Starts of n-grams looked at together: bounds a worker's memory for texts of any length.
_WINDOW = 1 << 18


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether words have it (letters and marks), and whether it is a letter."""
    from unicodedata import category

    kind = [category(chr(i))[0] for i in range(0x110000)]
    letter = np.array([k == "L" for k in kind])
    return letter | np.array([k == "M" for k in kind]), letter


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Small letters' code points with 0 for all else and around each text, where each text begins, and whether it has a letter."""
    word, letter = _letters()
    low = [t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "replace"), np.uint32)
    start = np.cumsum([0, *[len(t) + 1 for t in low]])
    some = np.add.reduceat(letter[points], start[:-1]) > 0 if len(texts) else np.zeros(0, bool)
    return np.where(word[points], points, 0).astype(np.uint64), start, some


def ngrams(codes: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the n-grams that start in [lo, hi): letters of one word, with a place outside of it at either end at most."""
    starts, hashes = [], []
    for n in ORDERS:
        end = min(hi, len(codes) - n + 1)
        if end <= lo:
            continue
        inner = np.ones(end - lo, bool)
        for j in range(1, n - 1):
            inner &= codes[lo + j : end + j] != 0
        at = np.flatnonzero(inner) + lo
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ codes[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        starts.append(at)
        hashes.append(h ^ (h >> np.uint64(32)))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def text_ngrams(text: str) -> np.ndarray:
    """A text's distinct n-grams, sorted."""
    codes, start, _ = coded([text])
    end = int(start[-1])
    found = [np.unique(ngrams(codes, lo, min(lo + _WINDOW, end))[1]) for lo in range(0, end, _WINDOW)]
    return found[0] if len(found) == 1 else np.unique(np.concatenate([np.empty(0, np.uint64), *found]))


def _cells(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The cells of n-grams in a block of ``size`` (a power of two) cells."""
    first, step = h & np.uint64(0xFFFFFFF), ((h >> np.uint64(20)) & np.uint64(0xFFFFFFF)) | np.uint64(1)
    for j in range(PROBES):
        yield ((first + np.uint64(j) * step) & np.uint64(size - 1)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """``cells[block, cell]`` holds a bit per language, eight to a byte; ``chance`` the share of absent n-grams that a language seems to contain.

    Languages stand in order of their documents, the most first.
    """

    languages: list[str]
    cells: np.ndarray
    chance: np.ndarray

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The bits of the languages that contain each n-gram."""
        blocks, size, width = self.cells.shape
        block = (h >> np.uint64(64 - int(blocks).bit_length() + 1)).astype(np.int64) * size if blocks > 1 else 0
        flat, out = self.cells.reshape(-1, width), None
        for cell in _cells(h, size):
            got = flat[block + cell]
            out = got if out is None else out & got
        return out

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the share of n-grams contained, freed of chance, and which texts have a letter."""
        codes, start, some = coded(texts)
        hits, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for lo in range(0, len(codes), _WINDOW):
            at, h = ngrams(codes, lo, min(lo + _WINDOW, len(codes)))
            # An n-gram may start in the place before its text.
            text = np.minimum(np.searchsorted(start, at, side="right") - 1, len(texts) - 1)
            n += np.bincount(text, minlength=len(texts))
            m = self.masks(h)
            for k in range(len(self.languages)):
                hits[:, k] += np.bincount(text[(m[:, k >> 3] >> np.uint8(k & 7)) & 1 != 0], minlength=len(texts))
        n = np.maximum(n, 1)[:, None]
        return np.maximum(hits / n - self.chance, 0) / np.maximum(1 - self.chance, 1e-9), some

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores; ``und`` and 0 where there is no letter or nothing was learned."""
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        share, some = self.shares([t if isinstance(t, str) else "" for t in texts])
        best = share.argmax(axis=1)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, some)], np.where(some, np.minimum(share[np.arange(len(best)), best], 1.0), 0.0)


def _counted(docs: DataFrame, slices: int) -> DataFrame:
    """(language, slice, part, keys, counts): in how many of a task's documents each n-gram is; key 0 counts the documents."""
    shift = np.uint64(64 - slices.bit_length() + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tallies: dict[str, Tally] = {}
        for d in batches:
            for language, text in zip(d["language"], d["text"]):
                t = tallies.setdefault(language, Tally())
                t.add(np.union1d(text_ngrams(text), np.zeros(1, np.uint64)))
        part = TaskContext.get().partitionId()
        for language, t in tallies.items():
            keys, _ = t.settle()
            rows = [(language, s, part, k, c) for s, k, c in t.sliced((keys >> shift).astype(np.int64))]
            yield pd.DataFrame(rows, columns=["language", "slice", "part", "keys", "counts"])
    return docs.mapInPandas(run, "language string, slice int, part int, keys binary, counts binary")


def train(docs: DataFrame, wanted: Column, text_col: str = "text", lang_col: str = "lang", *, share: float = 0.01) -> Filters:
    """Filters from all rows of ``docs`` that fulfil ``wanted`` and have a language; null texts are empty.

    An n-gram is in a language's filter if at least ``share`` of its documents, and two of them if there are two, have it. So a
    language has at most 1 / share times as many n-grams as a document on average, and the filters are of a size that
    does not grow with the table. Every row is counted; tasks send their counts in slices, each slice makes its block of
    cells, and only finished blocks and one row per language reach the driver.
    """
    rows = docs.where(wanted & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("language"), F.coalesce(text_col, F.lit("")).alias("text"))
    parts = rows.rdd.getNumPartitions()
    slices = slices_for(parts)
    counts = written(added(_counted(rows, slices), parts, ["language"], 1), "ngrams")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            out = []
            for language, k, c in zip(d["language"], d["keys"], d["counts"]):
                keys, n = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
                out.append(keys[(n >= max(share * total[language], min(2, total[language]))) & (keys != 0)].tobytes())
            yield pd.DataFrame({"language": d["language"], "slice": d["slice"], "keys": out})

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            yield pd.DataFrame({"language": d["language"], "n": [int(np.frombuffer(c, np.int64)[0]) for c in d["counts"]]})

    total = {r["language"]: r["n"] for r in counts.where("slice = 0").mapInPandas(documents, "language string, n long").collect()}
    if not total:
        return Filters([], np.zeros((1, 1, 1), np.uint8), np.zeros(0))
    languages = sorted(total, key=lambda l: (-total[l], l))
    number = {l: k for k, l in enumerate(languages)}
    grams = written(counts.mapInPandas(kept, "language string, slice int, keys binary"), "kept-ngrams")
    most = grams.agg(F.max(F.octet_length("keys"))).first()[0] // 8
    # Half of the cells are then set at most.
    size = 1 << max(6, int(np.ceil(np.log2(max(most, 1) * PROBES / np.log(2)))))
    width = (len(languages) + 7) // 8

    def block(d: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros((size, width), np.uint8)
        for language, k in zip(d["language"], d["keys"]):
            bit = number[language]
            for cell in _cells(np.frombuffer(k, np.uint64), size):
                cells[cell, bit >> 3] |= np.uint8(1 << (bit & 7))
        return pd.DataFrame({"slice": d["slice"].iloc[:1], "cells": [cells.tobytes()]})

    cells = np.zeros((slices, size, width), np.uint8)
    for r in grams.groupBy("slice").applyInPandas(block, "slice int, cells binary").collect():
        cells[r["slice"]] = np.frombuffer(r["cells"], np.uint8).reshape(size, width)
    full = [((cells[:, :, k >> 3] >> np.uint8(k & 7)) & 1).mean(axis=1) for k in range(len(languages))]
    return Filters(languages, cells, np.array([(f**PROBES).mean() for f in full]))


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``lang_pred``, ``score``) per row: the language that contains most of the text's n-grams, and the share that it contains.

    A null text or one without a letter is ``und`` with score 0, and so is every text if no language was learned. Ties, and texts
    none of whose n-grams is known, go to the language with the most documents, then to the first by name. Repeated rows are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            languages, scores = shared.value.predict(list(d["text"]))
            yield pd.DataFrame({"id": d["id"], "lang_pred": languages, "score": scores})

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema).withColumnRenamed("id", id_col)
