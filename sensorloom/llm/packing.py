"""Packing by concatenating and cutting.

Pass one tokenizes every document and numbers its tokens inside its partition; the
partitions' totals, summed up, give each partition's place in one endless run of tokens. Pass
two cuts that run every ``window`` tokens; a document across a cut leaves a record on either side.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.alignment import byte_letters
from sensorloom.session import written

WINDOW = 2048
END = 1
# Characters tokenized at once, which bounds a worker's memory.
_CHARS = 1_000_000
# Stands behind every word, as byte pairs are merged to ends of words; and between texts.
_WORD_END, _TEXT_END = 1, 2
_ODD, _LETTER, _NUMBER, _SPACE, _OTHER = range(5)


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its class and its small letter.

    Known are Latin letters, their signs and common punctuation, which are normal forms already and keep their length when
    lowered. All else is odd; texts with odd characters go to the tokenizer whole.
    """
    kind, low = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for i in [*range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        c = chr(i)
        if i == 0x130 or c == "'" or unicodedata.normalize("NFC", c) != c or len(c.lower()) != 1:
            continue
        kind[i] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(c)[0], _OTHER)
        low[i] = ord(c.lower())
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    kind[[ord("'"), _TEXT_END]] = _OTHER
    return kind, low


def word_ends(low: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a word ends with each character: letters, signs or a digit, or an apostrophe with one of seven endings."""
    after = np.append(kind[1:], _SPACE)
    end = (kind != after) | (kind == _NUMBER)
    at = np.flatnonzero(low[:-1] == ord("'"))
    at = at[(at == 0) | (kind[np.maximum(at - 1, 0)] != _OTHER)]
    pad = np.concatenate([low, np.zeros(2, np.uint32)])
    first, second = pad[at + 1], pad[at + 2]
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = ((second == ord("e")) & ((first == ord("r")) | (first == ord("v")))) | ((first == ord("l")) & (second == ord("l")))
    end[at[short | long]] = False
    end[at[short] + 1] = True
    end[at[long] + 2] = True
    return end


class WordTokenizer:
    """Token ids of texts, by a tokenizer that drops white space, lowers letters and merges bytes inside words up to their ends.

    Words of many texts are found at once, on their code points, and merged by an encoder that knows the vocabulary in the order
    of its merges. ``tests/llm`` compares this with encoding whole texts.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        letters, mark = byte_letters(), bytes([_WORD_END])
        ranks = {}
        for token, i in vocab.items():
            stem = token.removesuffix("</w>")
            if all(c in letters for c in stem):
                ranks[bytes(letters[c] for c in stem) + (mark if stem != token else b"")] = i
        self.text_end = ranks[bytes([_TEXT_END]) + mark]
        # The mark always merges with the byte before it.
        ranks[mark] = max(vocab.values()) + 1
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (and the last end)."""
        kind, low = _classes()
        given = texts.to_pylist()
        alone = {}

        def points(of: list[str]) -> np.ndarray:
            return np.frombuffer("".join(f"{t} \x02 " for t in of).encode("utf-32-le", "replace"), np.uint32)

        p = points(given)
        if len(p) and kind[p].min() == _ODD or any("<|" in t or "\x02" in t for t in given):
            for i, t in enumerate(given):
                if "<|" in t or "\x02" in t or (len(t) and kind[np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)].min() == _ODD):
                    alone[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
                    given[i] = ""
            p = points(given)
        k, small = kind[p], low[p]
        kept = k != _SPACE
        end = word_ends(small, k)[kept]
        at = np.arange(len(end)) + np.cumsum(end) - end
        words = np.full(len(end) + int(end.sum()), _WORD_END, np.uint32)
        words[at] = small[kept]
        ids = self.merges.encode_to_numpy(words.tobytes().decode("utf-32-le"), disallowed_special=())
        ends = np.flatnonzero(ids == self.text_end)
        sizes = np.diff(np.concatenate([[-1], ends])) - 1
        ids = np.delete(ids, ends)
        if alone:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, own in alone.items():
                parts[i], sizes[i] = own, len(own)
            ids = np.concatenate(parts)
        return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """One per worker process, which runs many tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of some million bytes, or a single longer row."""
    a, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > _CHARS:
            yield a, i
            a, held = i, 0
        held += n
    if a < len(sizes):
        yield a, len(sizes)


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``part``, ``first``, ``ids``): each row's token ids and the closing id, and how many ids of its partition come before."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, before = tokenizer_of(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for a, b in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                ids, at = tokenizer(texts.slice(a, b - a))
                size = np.diff(at)
                # The closing id after each text's ids.
                out = np.insert(ids.astype("<u4"), at[1:], END)
                bounds = np.concatenate([[0], np.cumsum(size + 1)])
                firsts = before + bounds[:-1]
                before += int(bounds[-1])
                raw = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(firsts, pa.int64()), raw], names=["id", "part", "first", "ids"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _cut(window: int):
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            rows: list[tuple] = []
            for key, at, raw in zip(d["id"], d["at"], d["ids"]):
                if len(rows) >= 1000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
                n, start = len(raw) // 4, 0
                while start < n:
                    offset = (at + start) % window
                    length = min(window - offset, n - start)
                    piece = raw[4 * start : 4 * (start + length)]
                    rows.append((key, start, length, zlib.crc32(piece), n, (at + start) // window, offset, piece))
                    start += length
            yield pd.DataFrame(rows, columns=names)
    return run


def pack(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and the piece's ``ids`` (little-endian 32-bit).

    A text is its token ids and the id 1. Null and empty texts are the id 1 alone. Sequence s holds the tokens s * window
    to (s + 1) * window of all rows laid end to end, so every sequence but the last is full and no token is lost.
    Rows with the same id are packed one by one. An empty table gives an empty result. ``path`` is the tokenizer's file on every worker.
    The tokens are written to the shared folder with their partition's number; only one total per
    partition is summed up, so nothing is sorted and no text is shuffled.
    """
    held = written(tokenized(docs, path, id_col, text_col), "tokens")
    totals = held.groupBy("part").agg(F.sum(F.octet_length("ids") / 4).cast("long").alias("n")).collect()
    # One number per partition: as many as tasks, never more with more rows in them.
    base, before = [], 0
    for r in sorted(totals, key=lambda r: r["part"]):
        base.append((r["part"], before))
        before += r["n"]
    starts = docs.sparkSession.createDataFrame(base, "part int, base long")
    placed = held.join(F.broadcast(starts), "part").select("id", (F.col("base") + F.col("first")).alias("at"), "ids")
    kind = docs.schema[id_col].dataType
    fields = [T.StructField("id", kind)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    return placed.mapInPandas(_cut(window), T.StructType([*fields, T.StructField("ids", T.BinaryType())])).withColumnRenamed("id", id_col)
