"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Where a token of either tokenizer ends at the same byte, the two are linked. Documents stand in blocks of at most 256; a block's
index lists for each linked pair of ids which documents have it, as compressed bitmaps, one per binary digit of how often a
document has it. Bitmaps ORed and counted give a pair's documents, digits weighed and counted its links;
summed over all blocks they score the pairs, and the bitmaps, walked once more, hand the scores to their documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.tallies import Tally, added
from sensorloom.session import written

# Documents of a block, and after how many links it ends: bounds of a worker's memory.
_DOCS, _LINKS = 256, 1 << 20
# A bitmap of that many documents or more is stored as bits, one of fewer as a list.
_DENSE = _DOCS // 8
_SLICES = 32


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """Ids of a byte-level vocabulary (a ``tokenizers`` file); special tokens' strings are plain text."""

    # Longer runs of white space are too much for the pattern of the fast encoder.
    _RUN = re.compile(r"\s{2000}")

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        # Ids are in the order in which merges apply.
        self.fast = tiktoken.Encoding("byte", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(self.bytes)}, special_tokens={})
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(" " + t) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if len(text) > 2000 and self._RUN.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.fast.encode_ordinary(text), np.int64)


class PieceTokenizer:
    """Ids of a sentence-piece model, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


class Pair:
    """Both tokenizers, the lengths of their tokens in bytes, and their ids as text."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        n, m = len(self.size_a), len(self.size_b)
        # What follows an id in the text of groups: another of its side, the other side, or the next group.
        self.words = [f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)]

    def ids(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none for a null or empty text and for one whose bytes either side changes."""
        none = np.empty(0, np.int64)
        given = [t if isinstance(t, str) else "" for t in texts]
        for text, a, b in zip(given, self.a(given), self.b(given)):
            want = b" " + text.encode("utf-8", "replace")
            whole = text and b"".join(map(self.a.bytes.__getitem__, a.tolist())) == want and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == want
            # A token without bytes ends where the one before it ends; no known vocabulary emits one, but then links need all pairs.
            if whole and not (self.size_a[a].all() and self.size_b[b].all()):
                raise ValueError("a token without bytes")
            yield (a, b) if whole else (none, none)

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, str]:
        """The linked pairs of ids, one per group, and the text of the groups."""
        if not len(a):
            return np.empty(0, np.int64), ""
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        # Where tokens stand in the text: after those of all groups before, the first side before the second.
        before_b = np.concatenate([[0], last_b + 1])
        n, m = len(self.size_a), len(self.size_b)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = a + n * (end_a == both[group_a])
        order[np.arange(len(b)) + last_a[group_b] + 1] = b + 2 * n + m * (end_b == both[group_b])
        return a[last_a] << 16 | b[last_b], "".join(map(self.words.__getitem__, order.tolist()))[:-1]


@lru_cache(1)
def pair_of(path_a: str, path_b: str) -> Pair:
    """One per worker process."""
    return Pair(path_a, path_b)


def packed_bitmaps(pairs: np.ndarray, docs: np.ndarray) -> dict[str, bytes]:
    """The index of a block from one (pair, document) per link.

    ``pairs``: the distinct pairs. A bitmap is of one ``pair`` (its place) and one ``plane`` (the documents whose multiplicity has that
    binary digit); with ``size`` below 32 its ``data`` are so many document numbers, else 256 bits.
    """
    found, n = np.unique(pairs << 8 | docs, return_counts=True)
    distinct, place = np.unique(found >> 8, return_inverse=True)
    planes = range(int(n.max()).bit_length() if len(n) else 0)
    has = [np.flatnonzero(n >> j & 1) for j in planes]
    key = np.concatenate([np.empty(0, np.int64), *[place[at] << 16 | j << 8 | (found[at] & 255) for j, at in zip(planes, has)]])
    key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] >> 8 != key[:-1] >> 8])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    size = np.minimum(count, _DENSE)
    begin = np.cumsum(size) - size
    of, doc = np.repeat(np.arange(len(new)), count), key & 255
    data = np.zeros(int(size.sum()), np.uint8)
    few = count[of] < _DENSE
    rank = np.arange(len(key)) - new[of]
    data[(begin[of] + rank)[few]] = doc[few]
    np.bitwise_or.at(data, (begin[of] + (doc >> 3))[~few], (1 << (doc & 7))[~few].astype(np.uint8))
    return {"pairs": distinct.astype(np.uint32).tobytes(), "place": (key[new] >> 16).astype(np.uint32).tobytes(), "plane": (key[new] >> 8 & 255).astype(np.uint8).tobytes(),
            "size": size.astype(np.uint8).tobytes(), "data": data.tobytes()}


def unpacked_bitmaps(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, and (place, plane, document) of all set bits."""
    pairs, place = (np.frombuffer(row[k], np.uint32).astype(np.int64) for k in ("pairs", "place"))
    plane, size, data = (np.frombuffer(row[k], np.uint8) for k in ("plane", "size", "data"))
    size = size.astype(np.int64)
    begin = np.cumsum(size) - size
    few, many = np.flatnonzero(size < _DENSE), np.flatnonzero(size == _DENSE)
    of = np.repeat(few, size[few])
    listed = data[np.arange(len(of)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + begin[of]] if len(of) else np.empty(0, np.uint8)
    which, doc = np.nonzero(np.unpackbits(data[begin[many][:, None] + np.arange(_DENSE)], axis=1, bitorder="little")) if len(many) else (np.empty(0, np.int64),) * 2
    at = np.concatenate([of, many[which]])
    return pairs, place[at], plane[at].astype(np.int64), np.concatenate([listed.astype(np.int64), doc])


def block_counts(row) -> tuple[np.ndarray, np.ndarray]:
    """(pair, [documents, links]) of a block: its planes ORed and counted, and counted by weight."""
    pairs, place, plane, doc = unpacked_bitmaps(row)
    union = np.zeros(len(pairs) * _DENSE, np.uint8)
    np.bitwise_or.at(union, place * _DENSE + (doc >> 3), (1 << (doc & 7)).astype(np.uint8))
    links = np.zeros(len(pairs), np.int64)
    np.add.at(links, place, np.int64(1) << plane)
    return pairs, np.stack([np.bitwise_count(union.reshape(-1, _DENSE)).sum(axis=1, dtype=np.int64), links], axis=1)


_BITMAPS = ("pairs", "place", "plane", "size", "data")
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def indexed(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", *, digest: bool = False) -> DataFrame:
    """One row per block of documents: their ids, numbers of tokens, groups and links, the text of their groups, and the bitmaps.

    With ``digest`` the text of a document's groups is its SHA-256 in place of itself (nothing stays nothing).
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, part, number = pair_of(path_a, path_b), TaskContext.get().partitionId(), 0
        rows, links = [], []

        def block() -> pd.DataFrame:
            nonlocal rows, links, number
            every = np.concatenate(links)
            doc = np.repeat(np.arange(len(links)), [len(x) for x in links])
            out = {k: [list(v)] for k, v in zip(("ids", *_NUMBERS, "groups"), zip(*rows))}
            out |= {"part": [part], "block": [number]} | {k: [v] for k, v in packed_bitmaps(every, doc).items()}
            rows, links, number = [], [], number + 1
            return pd.DataFrame(out)

        held = 0
        for d in batches:
            keys, texts = list(d["id"]), list(d["text"])
            # A few texts at a time, whatever a batch holds.
            for at in range(0, len(keys), 32):
                for key, (a, b) in zip(keys[at : at + 32], both.ids(texts[at : at + 32])):
                    pairs, groups = both.align(a, b)
                    if digest and groups:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    rows.append((None if key is pd.NA or key != key else key, len(a), len(b), len(pairs), len(pairs), groups))
                    links.append(pairs)
                    held += len(pairs)
                    if len(rows) == _DOCS or held > _LINKS:
                        yield block()
                        held = 0
        if rows:
            yield block()

    fields = [T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(kind))]
    fields += [T.StructField(k, T.ArrayType(T.LongType())) for k in _NUMBERS] + [T.StructField("groups", T.ArrayType(T.StringType()))]
    fields += [T.StructField(k, T.BinaryType()) for k in _BITMAPS]
    # As objects, so that null ids leave the others whole numbers.
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lists = source.select(F.array("id").alias("id"), "text")

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return run(d.assign(id=[x[0] for x in d["id"]]) for d in batches)

    return lists.mapInPandas(single, T.StructType(fields))


def pair_slices(index: DataFrame) -> DataFrame:
    """(slice, keys, counts): documents and links of all pairs, summed over the blocks. A slice has all pairs of its second ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = Tally(2)
        for d in batches:
            for row in d.to_dict("records"):
                pairs, counts = block_counts(row)
                t.add(pairs.astype(np.uint64), counts)
        keys, _ = t.settle()
        part = TaskContext.get().partitionId()
        rows = [(s, part, k, c) for s, k, c in t.sliced((keys % np.uint64(_SLICES)).astype(np.int64))]
        yield pd.DataFrame(rows, columns=["slice", "part", "keys", "counts"])

    d = index.select(*_BITMAPS)
    return added(d.mapInPandas(run, "slice int, part int, keys binary, counts binary"), d.rdd.getNumPartitions(), [], 2)


class Scores:
    """Pairs in order, their documents and links, and whether a pair's links are the most of its second id (ties too)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.docs, self.links = keys[order], counts[order, 0], counts[order, 1]
        most = np.zeros(1 << 16, np.int64)
        np.maximum.at(most, self.keys & 0xFFFF, self.links)
        self.best = self.links == most[self.keys & 0xFFFF]

    def of(self, row) -> tuple[np.ndarray, np.ndarray]:
        """Per document of a block its links that are best, and the sum of its links' counts."""
        pairs, place, plane, doc = unpacked_bitmaps(row)
        at = np.searchsorted(self.keys, pairs)
        best, total = np.zeros(_DOCS, np.int64), np.zeros(_DOCS, np.int64)
        np.add.at(best, doc, self.best[at][place].astype(np.int64) << plane)
        np.add.at(total, doc, self.links[at][place] << plane)
        return best, total


def scores_of(slices: DataFrame) -> Scores:
    """All pairs' scores in the driver.

    Of a pair the bytes of one token end with those of the other, so the vocabularies bound the pairs whatever the corpus: 324 297 for the given files.
    """
    got = slices.select("keys", "counts").collect()
    keys = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(r["keys"], np.uint64) for r in got]]).astype(np.int64)
    return Scores(keys, np.concatenate([np.empty((0, 2), np.int64), *[np.frombuffer(r["counts"], np.int64).reshape(-1, 2) for r in got]]))


def pair_counts(slices: DataFrame) -> DataFrame:
    """(a, b, docs, links), one row per pair of ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for k, c in zip(d["keys"], d["counts"]):
                keys, counts = np.frombuffer(k, np.uint64).astype(np.int64), np.frombuffer(c, np.int64).reshape(-1, 2)
                yield pd.DataFrame({"a": keys >> 16, "b": keys & 0xFFFF, "docs": counts[:, 0], "links": counts[:, 1]})
    return slices.mapInPandas(run, "a long, b long, docs long, links long")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", *, digest: bool = False) -> DataFrame:
    """Per row of ``docs``: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``.

    ``n_best`` are the links whose pair has the most links of all pairs with its second id, ties included; ``count_sum`` adds up the
    corpus-wide links of each link's pair. Null and empty texts, and texts whose bytes a tokenizer changes, have zeros and no groups.
    Repeated rows count as often as they stand; an empty table gives an empty result.
    ``path_a`` and ``path_b`` are the tokenizers' files on every worker. The index is written to the shared folder; texts are
    tokenized once and not shuffled; the only shuffle adds up the pairs' counts.
    """
    index = written(indexed(docs, path_a, path_b, id_col, text_col, digest=digest), "pair-bitmaps")
    shared = docs.sparkSession.sparkContext.broadcast(scores_of(pair_slices(index)))
    numbers = ("ids", *_NUMBERS, "groups")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            best, total = [], []
            for row in d.to_dict("records"):
                n = len(row["ids"])
                b, t = shared.value.of(row)
                best.append(b[:n].tolist())
                total.append(t[:n].tolist())
            yield pd.DataFrame({**{k: d[k] for k in numbers}, "n_best": best, "count_sum": total})

    schema = T.StructType([*[index.schema[k] for k in numbers], *[T.StructField(k, T.ArrayType(T.LongType())) for k in ("n_best", "count_sum")]])
    scored = index.select(*numbers, *_BITMAPS).mapInPandas(run, schema)
    d = scored.select(F.explode(F.arrays_zip(*scored.columns)).alias("d"))
    return d.select(F.col("d.ids").alias(id_col), *[F.col(f"d.{k}").alias(k) for k in (*_NUMBERS, "n_best", "count_sum", "groups")])
