"""Language filters against plain sets, and on held-out rows."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import language_filters as lf
from sensorloom.llm import language_queries
from sensorloom.llm.tallies import Tally, added, slices_for

SCHEMA = "doc_id long, text string, lang string, language string, part int"


def plain_ngrams(text: str) -> list[str]:
    """All n-grams of a text, 0 for what belongs to no word; only the ends may be 0."""
    c = "\0" + "".join(x if unicodedata.category(x)[0] in "LM" else "\0" for x in text.lower()) + "\0"
    return [c[i : i + n] for n in lf.ORDERS for i in range(len(c) - n + 1) if "\0" not in c[i + 1 : i + n - 1]]


TEXTS = ["The cat and the hat.", "a", "", " \n", "Ünïcode wörds; x1y2z3 हिन्दी", "😀 one😀two", "no" * 3000]


def test_ngrams_are_those_of_the_plain_loop(monkeypatch):
    for window in (1 << 18, 7):
        monkeypatch.setattr(lf, "_WINDOW", window)
        for t in TEXTS:
            want = plain_ngrams(t)
            codes, start, some = lf.coded([t])
            assert len(lf.ngrams(codes, 0, len(codes))[1]) == len(want)
            assert len(lf.text_ngrams(t)) == len(set(want))
            assert bool(some[0]) == any(unicodedata.category(x)[0] == "L" for x in t)


def test_filters_hold_what_a_share_of_the_documents_has(spark):
    words = {"aa": ["blorp", "snarf", "glib"], "bb": ["zonk", "quux", "glib"], "cc": ["narf"]}
    rows = [(i, " ".join(words[l][: 1 + i % 3]) + f" rare{chr(97 + i % 26)}{l}", l, "x", 1) for i, l in enumerate(["aa"] * 60 + ["bb"] * 30 + ["cc"])]
    d = spark.createDataFrame([*rows, (91, None, "aa", "x", 1), (92, "unlabelled", None, "x", 1), (93, "left out", "aa", "x", 1)], SCHEMA).repartition(5)
    f = lf.train(d, F.col("doc_id") != 93, share=0.1)
    assert f.languages == ["aa", "bb", "cc"]
    docs = Counter(l for _, _, l, _, _ in rows) + Counter(["aa"])
    seen = {l: Counter(g for _, t, k, _, _ in rows if k == l for g in set(plain_ngrams(t))) for l in docs}
    want = {l: {g for g, n in seen[l].items() if n >= max(0.1 * docs[l], min(2, docs[l]))} for l in docs}
    every = sorted(set().union(*seen.values()))
    false = Counter()
    for g in every:
        codes = np.array([0 if c == "\0" else ord(c) for c in g], np.uint64)
        at, h = lf.ngrams(codes, 0, len(codes))
        bits = int(f.masks(h[at == 0][-1:])[0, 0])
        for k, l in enumerate(f.languages):
            has = bool(bits >> k & 1)
            assert has or g not in want[l]
            false[l] += has and g not in want[l]
    assert all(false[l] <= 0.2 * len(every) for l in docs)


def test_chance_is_taken_off():
    rng = np.random.default_rng(1)
    cells = (rng.random((4, 256, 1)) < 0.5).astype(np.uint8) * 3
    f = lf.Filters(["aa", "bb"], cells, np.array([0.125, 0.125]))
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = " ".join("".join(rng.choice(list(letters), 6)) for _ in range(3000))
    share, some = f.shares([text])
    assert some[0] and (share < 0.03).all()


def test_sums_of_tallies(spark):
    rng = np.random.default_rng(2)
    want, rows = Counter(), []
    for part in range(9):
        t = Tally(2)
        for _ in range(3):
            keys = rng.integers(0, 50, 40).astype(np.uint64)
            counts = rng.integers(1, 9, (40, 2))
            t.add(keys, counts)
            for k, (a, b) in zip(keys.tolist(), counts.tolist()):
                want[k, 0] += a
                want[k, 1] += b
        keys, _ = t.settle()
        rows += [("g", s, part, bytearray(k), bytearray(c)) for s, k, c in t.sliced((keys % np.uint64(4)).astype(np.int64))]
    got = Counter()
    for r in added(spark.createDataFrame(rows, "g string, slice int, part int, keys binary, counts binary"), 9, ["g"], 2).collect():
        for k, (a, b) in zip(np.frombuffer(r["keys"], np.uint64).tolist(), np.frombuffer(r["counts"], np.int64).reshape(-1, 2).tolist()):
            assert k % 4 == r["slice"] and (k, 0) not in got
            got[k, 0], got[k, 1] = a, b
    assert got == want
    assert slices_for(1) == slices_for(32) == 32 and slices_for(33) == 64 and slices_for(10**6) <= 32 * math.isqrt(10**6)


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_texts_and_tables(spark, labelled):
    rows = [(1, "le chat et la souris", "fr", "x", 1), (2, "the cat and the mouse", "en", "x", 1), (2, "the cat and the mouse", "en", "x", 1)]
    odd = [None, "", " \n", "123 !?", "é", "字", "the " * 50000, "le " * 50000]
    d = spark.createDataFrame([(i if labelled else i, t, l if labelled else None, x, p) for i, t, l, x, p in rows] + [(10 + i, t, None, "x", 1) for i, t in enumerate(odd)], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in lf.predict(d, lf.train(d, F.lit(True))).collect()}
    assert len(got) == 10
    if not labelled:
        assert set(got.values()) == {("und", 0.0)}
        return
    assert all(got[10 + i] == ("und", 0.0) for i in range(4))
    assert got[14][0] in ("en", "fr") and got[15] == ("en", 0.0)
    assert got[16][0] == "en" and got[17][0] == "fr" and got[1] == ("fr", 1.0)
    assert lf.predict(d.limit(0), lf.train(d.limit(0), F.lit(True))).collect() == []


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    d = language_queries.languages(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = d.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("right"), F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert held.n > 250 and held.right >= 0.99 and held.low >= 0 and held.high <= 1
