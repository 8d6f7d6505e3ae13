"""The word tokenizer against encoding whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest

from sensorloom.llm import packing, queries

PATH = public_tokenizers.path(queries.TOKENIZER)


def same(texts: list[str]) -> None:
    tokenizer = packing.tokenizer_of(PATH)
    ids, at = tokenizer(pa.array(texts, pa.string()))
    assert len(at) == len(texts) + 1 and at[-1] == len(ids)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == tokenizer.whole.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("pool", ["abSs' 't'\"l", "aABéßÄ019 \n\t.,!?'\"-$€²½–…sSdDmMtTrRlLvVeE", "aΣİ字\x01\x02\x85 ́<|ı"])
def test_random_texts(pool):
    rng = random.Random(5)
    same(["".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(3000)])


def test_all_words_of_the_vocabulary():
    whole = packing.tokenizer_of(PATH).whole
    words = [w.removesuffix("</w>") for w in whole.get_vocab()]
    same([" ".join(words[i : i + 100]) for i in range(0, len(words), 100)])


def test_odd_and_long_texts():
    same([])
    same(["", " ", "<|endoftext|>x", "<|ENDOFTEXT|>", "it's we'll I'VE ''s 's's 'ss \"'s 're'", "ª º µ ŉ ǅ Ǆ ſt 'ſ", "x" * 100_000, " " * 100_000, "Å Å ﬁ", "a b­c"])
