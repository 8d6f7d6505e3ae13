"""Alignment against whole-text encoding and plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from sensorloom.llm import alignment, alignment_queries

PATHS = [public_tokenizers.path(t) for t in alignment_queries.TOKENIZERS]
SCHEMA = "doc_id long, text string, pairs string, n_a int, block int"
SF = "/root/testdata/sf0.001"


def plain(texts: list[str | None]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per text."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = alignment.byte_letters()
    out, every = [], []
    for text in texts:
        if not text:
            out.append((0, 0, [], []))
            continue
        a = first.encode(" " + text, add_special_tokens=False)
        bytes_a = [bytes(letters[c] for c in t) for t in a.tokens]
        b = second.encode(text)
        pieces = [second.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append((0, 0, [], []))
            continue

        def ends(tokens):
            at, found = 0, []
            for t in tokens:
                at += len(t)
                found.append(at)
            return found

        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(i) for i, e in zip(a.ids, ends_a) if low < e <= cut) + "|" + ",".join(str(i) for i, e in zip(b, ends_b) if low < e <= cut))
            low = cut
        at_b = {e: i for i, e in zip(b, ends_b)}
        links = [(i, at_b[e]) for i, e in zip(a.ids, ends_a) if e in at_b]
        every += links
        out.append((len(a.ids), len(b), groups, links))
    count = Counter(every)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(n, m, len(g), len(l), sum(count[p] == most[p[1]] for p in l), sum(count[p] for p in l), ";".join(g)) for n, m, g, l in out]


ODD = [
    None, "", " ", "  two  spaces ", "\n\n\tx\r\n", "<|endoftext|> <s> </s> <0x0A>", "▁", "a▁b", "naïve café – „Ja“ 字漢 हिन्दी 👩‍👩‍👧 \u0000 ​", "ﬁ Å Å", "'s 'll don't 1234567 1.5e10",
    "word " * 3000, "x" * 5000, " " * 3000 + "end", "\n" * 2500,
]


def rows_of(df) -> list[tuple]:
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=repr)


def test_against_plain_loops(spark):
    rng = random.Random(4)
    some = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    # Many short texts fill several blocks, with rare and common pairs and pairs that occur several times in a text.
    short = [" ".join(rng.choice(["the", "Thee", "ing", "élan", "x1", "zq"]) for _ in range(rng.randrange(1, 40))) for _ in range(700)]
    texts = [*ODD, *some, *short, *ODD[:4]]
    d = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    want = [(i, *r) for i, r in enumerate(plain(texts))]
    assert rows_of(alignment.align(d, *PATHS)) == sorted(want, key=repr)
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    assert rows_of(alignment.align(d, *PATHS, digest=True)) == sorted(hashed, key=repr)


def test_pair_counts(spark):
    texts = ["a b a b a b a", "a b", "b b b b", "c", None] * 30
    d = spark.createDataFrame([(i, t, "", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {(r.a, r.b): (r.docs, r.links) for r in alignment.pair_counts(alignment.pair_slices(alignment.indexed(d, *PATHS))).collect()}
    both = alignment.Pair(*PATHS)
    docs, links = Counter(), Counter()
    for t in texts:
        for a, b in both.ids([t]):
            pairs = [(int(p) >> 16, int(p) & 0xFFFF) for p in both.align(a, b)[0]]
            links.update(pairs)
            docs.update(set(pairs))
    assert got == {p: (docs[p], links[p]) for p in links}


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_give_back_what_they_hold(seed):
    rng = np.random.default_rng(seed)
    n = [0, 500, 60000][seed]
    pairs, docs = rng.zipf(1.3, n) % 3000 << 16 | 7, rng.integers(0, 256, n)
    row = alignment.packed_bitmaps(pairs, docs)
    distinct, place, plane, doc = alignment.unpacked_bitmaps(row)
    got = Counter()
    for p, j, d in zip(distinct[place].tolist(), plane.tolist(), doc.tolist()):
        got[p, d] += 1 << j
    want = Counter(zip(pairs.tolist(), docs.tolist()))
    assert got == want
    keys, counts = alignment.block_counts(row)
    assert {k: tuple(c) for k, c in zip(keys.tolist(), counts.tolist())} == {p: (sum(1 for q, _ in want if q == p), sum(v for (q, _), v in want.items() if q == p)) for p in set(pairs.tolist())} if n < 1000 else len(keys) == len(set(pairs.tolist()))


def test_null_and_repeated_ids_and_no_rows(spark):
    d = spark.createDataFrame([(None, "a b", "", 0, 0), (2**60 + 1, "a b", "", 0, 0), (2**60 + 1, "a b", "", 0, 0), (None, None, None, None, None)], SCHEMA)
    got = rows_of(alignment.align(d, *PATHS))
    assert sorted([r[0] for r in got], key=repr) == [2**60 + 1, 2**60 + 1, None, None]
    assert {r[1:] for r in got if r[0]} == {next(r[1:] for r in got if r[0] is None and r[1])}
    assert alignment.align(d.limit(0), *PATHS).collect() == []
