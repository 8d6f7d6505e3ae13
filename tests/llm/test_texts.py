"""The other operators: brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorloom.llm import adaptive_rules, chat_fold, chosen_path, importance, packing, page_templates, pii, poisson_mix, queries, string_kernel

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n", "x" * 20000, "a b c " * 5000, "ä😀 ﬁ <|im_end|> 1.2.3.4 a@b.co"]


def docs_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOCS)


# --- chat ----------------------------------------------------------------------------------------

def test_chat_events_fold_and_read_back(spark):
    log = [
        (1, 0, "m1", "message", "user", "Hi "), (1, 1, "m1", "delta", None, "there"), (1, 2, "m2", "message", "assistant", ""), (1, 4, "m2", "delta", None, "no"),
        (1, 5, "m2", "regenerate", None, None), (1, 7, "m2", "delta", None, "<|im_end|>"), (1, 6, "m2", "delta", None, "yes "), (1, 8, "m1", "edit", None, "Hello <\\|x"),
        (1, 9, "m3", "message", "user", "gone"), (1, 10, "m3", "delete", None, None), (2, 0, "m", "message", "odd\nrole", None), (None, 0, None, "message", None, "n"),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, message string, event string, role string, text string").withColumn("first", F.lit(1))
    d = chat_fold.format_log(df.drop("first")).withColumn("turns", chat_fold.turns_of(F.col("formatted"))).withColumn("learned", chat_fold.learned_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in d.collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "Hello <\\|x"), ("assistant", "yes <|im_end|>")]
    assert got[1].learned == "yes <|im_end|>" and got[1].formatted.count("<|im_end|>") == 2
    assert [tuple(t) for t in got[2].turns] == [("odd\nrole", "")] and [tuple(t) for t in got[None].turns] == [("", "n")]


def test_chat_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, message string"
    texts = [*ODD, "\\", "<\\\\|", "<|n|>", "<|", "|>", "<|im_start|>assistant\n"]
    rows = [(1, i, ["user", "assistant"][i % 2], t, "clash") for i, t in enumerate(texts)] + [(1, 3, "assistant", "x", "clash")] * 2
    d = chat_fold.format_log(chat_fold.log_of(spark.createDataFrame(rows, schema), piece=7), chat_fold.MESSAGE)
    got = d.select(chat_fold.turns_of(F.col("formatted")).alias("t"), chat_fold.learned_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()[0]
    want = sorted([(i, r, hashlib.md5((t or "").encode()).hexdigest(), t or "") for _, i, r, t, _ in rows])
    assert [tuple(t) for t in got.t] == [(r, t) for _, r, _, t in want]
    assert got.l == "".join(t for _, r, _, t in want if r == "assistant")
    assert chat_fold.format_log(chat_fold.log_of(spark.createDataFrame([], schema)), chat_fold.MESSAGE).count() == 0


def test_chat_texts_are_dealt_twice(spark):
    """By message and by conversation, and no more, whatever the log folds."""
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat_fold.format_log(chat_fold.log_of(df), chat_fold.MESSAGE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_chat_edits_of_one_message_and_marks_of_many_turns(spark):
    edits = [(1, i, "m", "edit", None, f"draft {i}") for i in range(1, 2000)] + [(1, 0, "m", "message", "assistant", "x"), (1, 5000, "m", "delta", None, " end")]
    many = [(2, i, f"t{i:05d}", "message", ["user", "assistant"][i % 2], f"text {i}") for i in range(3000)]
    log = spark.createDataFrame(edits + many, "conv_id long, seq long, message string, event string, role string, text string")
    got = {r.conv_id: r for r in chat_fold.format_log(log).collect()}
    assert got[1].formatted == "<|im_start|>assistant\ndraft 1999 end<|im_end|>\n" and got[2].n_turns == 3000
    for r in got.values():
        marked = [r.formatted[s.begin : s.begin + s.size] for s in r.loss_spans]
        assert marked == (["draft 1999 end"] if r.conv_id == 1 else [f"text {i}" for i in range(1, 3000, 2)])


# --- personal data -------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_pii(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_plain_expressions(spark):
    rng = random.Random(5)
    pieces = ["a@b.co", "a.b@c-d.e_f@g.hh", "@", ".", "1.2.3.4", "300.1.2.3", "1.2.3.4.5.6.7.8", "0001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-2030", "+49", " ", "é", "😀", "x", "7", "-", "_d@e.f", "\n", "4111111111111111", "00000.0.0.0"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    texts += [*ODD, "1" * 30000, "1 " * 9000, "a" * 30000, "a." * 9000 + "@", "+1" + "(" * 9000, "1." * 9000, "x@" + "a." * 9000 + "a"]
    df = docs_of(spark, texts)
    got = {r.doc_id: [(s["kind"], s["begin"], s["end"]) for s in r["_base"]] for r in pii.base_spans(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_pii(t or ""), t


def test_contexts_discover_and_texts_are_masked(spark):
    texts = [f"please contact desk {i}name@mail.example.org today" for i in range(8)] + ["please contact desk sam[at]mail7.example.org today", "the number 123456 is none", None, ""]
    df = docs_of(spark, texts).withColumn("value", F.lit("clash"))
    d = pii.find(df).collect()
    got = {r.doc_id: [(s["kind"], s["value"]) for s in r["_found"]] for r in d}
    assert got[0] == [(0, "0name@mail.example.org")] and got[9] == [] and got[10] == [] and len(d) == len(texts)
    wanted = docs_of(spark, [t.replace("[at]", "@@") if t else t for t in texts])
    found = {r.doc_id: [s["value"] for s in r["_found"]] for r in pii.find(wanted).collect()}
    assert found[8] == ["sam@@mail7.example.org"]
    masked = pii.redacted(wanted, length_col="n_chars")
    assert masked.columns == wanted.columns
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[0].text == "please contact desk [email] today" and rows[0].n_chars == len(rows[0].text) and rows[8].text == rows[0].text
    assert rows[9].text == texts[9] and rows[10].text is None
    assert pii.find(docs_of(spark, [])).count() == 0


def test_patterns_are_scored_as_by_hand(spark):
    rng = random.Random(6)
    pairs = {(f"p{rng.randrange(30)}", f"v{rng.randrange(60)}") for _ in range(400)}
    kinds = {f"v{i}": i % 2 for i in range(25)}
    edges = spark.createDataFrame([(p, v, kinds.get(v)) for p, v in sorted(pairs)] * 2, "pattern string, value string, kind int")
    for sure, seeds, rounds in ((0.2, 3, 1), (0.2, 3, 4), (0.3, 2, 3)):
        belief = {(v, k): 1.0 for v, k in kinds.items()}
        for _ in range(rounds):
            scores = {}
            for p in {p for p, _ in pairs}:
                values = [v for q, v in pairs if q == p]
                for k in (0, 1):
                    held = [belief[v, k] for v in values if (v, k) in belief]
                    if len(held) >= seeds and sum(held) / (len(values) + 2) >= sure:
                        scores[p, k] = (sum(held) / (len(values) + 2), len(held))
            new = {}
            for p, v in pairs:
                for k in (0, 1):
                    if v not in kinds and (p, k) in scores:
                        new[v, k] = max(new.get((v, k), 0), scores[p, k][0])
            belief = {(v, k): 1.0 for v, k in kinds.items()} | new
        got = {(r.pattern, r.kind): (round(r.score, 9), r.support) for r in pii.score_patterns(edges, rounds, sure, seeds).collect()}
        assert got == {k: (round(s, 9), n) for k, (s, n) in scores.items()} and got


def test_found_identifiers_are_seeds_of_the_next_round(spark):
    texts = [f"please contact desk {i}name@mail.example.org today" for i in range(20)]
    texts += [f"please contact desk AB-{i}234567 today" for i in range(8)]
    # What was found there stands behind other words too, which then find more.
    texts += [f"my iban is AB-{i}234567 thanks" for i in range(8)] + ["my iban is ZZ-7654321 thanks", "my iban was YY-7654321 thanks"]
    found = {r.doc_id: [s["value"] for s in r["_found"]] for r in pii.find(docs_of(spark, texts)).collect()}
    assert found[20] == ["AB-0234567"] and found[28] == ["AB-0234567"] and found[36] == ["ZZ-7654321"] and found[37] == []


def test_identifiers_of_any_shape_between_the_borders_of_a_sure_pattern(spark):
    texts = [f"please contact desk {i}name@mail.example.org today" for i in range(20)] + ["nothing to find in here", "Please  contact desk"]
    odd = ["please contact desk DE89 3704 0044 0532 0130 00 today", "Please contact\ndesk jane at example dot com.", "so please contact desk anna_schmidt today", "please contact desk anna"]
    found = {r.doc_id: [(s["begin"], s["end"], s["value"]) for s in r["_found"]] for r in pii.find(docs_of(spark, texts + odd)).collect()}
    want = ["DE89 3704 0044 0532 0130 00", "jane at example dot com", "anna_schmidt", "anna"]
    for i, (t, w) in enumerate(zip(odd, want)):
        assert found[22 + i] == [(t.index(w), t.index(w) + len(w), w)]
    assert found[20] == [] and found[21] == []
    masked = {r.doc_id: r.text for r in pii.redacted(docs_of(spark, texts + odd)).collect()}
    assert masked[22] == "please contact desk [email] today" and masked[23] == "Please contact\ndesk [email]."


def test_words_around_anything_find_nothing(spark):
    texts = [f"better than the {i}name@mail.example.org one" for i in range(5)] + [f"more than the cat{chr(97 + i)} one" for i in range(20)]
    found = pii.find(docs_of(spark, texts)).where("size(_found) > size(_base)").count()
    assert found == 0


def test_many_spans_take_time_in_proportion(spark):
    import time

    took = []
    for n in (4000, 32000):
        text = "".join(f"u{i}@m.example.org " for i in range(n))
        df = docs_of(spark, [text])
        began = time.perf_counter()
        r = pii.base_spans(df).select(F.size("_base").alias("n"), F.element_at("_base", -1).alias("last")).first()
        took.append(time.perf_counter() - began)
        assert r.n == n and r.last["end"] == len(text) - 1
    # Eight times as many; a fold that copies would take 64 times as long.
    assert took[1] < 24 * max(took[0], 0.3)


def test_own_column_names_are_refused(spark):
    df = docs_of(spark, ["a@b.co"])
    for call, name in ((pii.find, "_row"), (poisson_mix.poisson_mix, "_n"), (chosen_path.one_of_each, "_row")):
        with pytest.raises(ValueError, match=name):
            call(df.withColumn(name, F.lit(1)))


# --- mixing --------------------------------------------------------------------------------------

def test_poisson_counts_follow_the_weights(spark):
    rows = [(i, "t", "en", "a" if i % 10 else ("b" if i % 20 else None), 1) for i in range(4000)]
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, 0.0), ("absent", 9.0)], "source string, weight double")
    df = spark.createDataFrame(rows, DOCS)
    out = poisson_mix.poisson_mix(df, weights)
    assert out.columns == [*df.columns, "_copy"]
    n = Counter(r.source for r in out.collect())
    assert abs(n["a"] - 1000) < 150 and abs(n["b"] - 3000) < 250 and n[None] == 0
    again = sorted((r.doc_id, r._copy) for r in poisson_mix.poisson_mix(df.repartition(7), weights).collect())
    assert again == sorted((r.doc_id, r._copy) for r in out.collect())
    per = Counter(r.doc_id for r in out.where("source = 'b'").collect())
    assert abs(sum(v * v for v in per.values()) / 200 - 15 * 15 - 15) < 40
    assert poisson_mix.poisson_mix(docs_of(spark, [])).count() == 0


def test_no_row_is_dealt_by_its_source(spark, monkeypatch):
    df = spark.createDataFrame([(i, "t", "en", ["a", "b", None][i % 3] if i % 10 else "a", 1) for i in range(600)], DOCS)
    want = sorted((r.doc_id, r._copy) for r in poisson_mix.poisson_mix(df).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100)
    try:
        plan = poisson_mix.poisson_mix(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(_order" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(poisson_mix, "_FEW", 1)
        assert sorted((r.doc_id, r._copy) for r in poisson_mix.poisson_mix(df).collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")



# --- rules ---------------------------------------------------------------------------------------

def test_rules_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "b#", "c", "dd$d"]) for _ in range(rng.randint(0, 120))) + rng.choice(["", "\nx y\nx y\n \nx y"]) for _ in range(120)] + ODD
    got = {r.doc_id: r for r in adaptive_rules.judge(docs_of(spark, texts).withColumn("n_words", F.lit("clash"))).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        n = Counter(win)
        rep = {k + o for k, w in enumerate(win) if n[w] > 1 for o in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(rep) > 50 * len(words)) and not (r.base_failed and r.kept)


def test_odd_documents_fall_outside_the_fences(spark):
    rng = random.Random(9)
    plain = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(80)) for _ in range(60)]
    junk = [" ".join(w + "###" for w in plain[0].split()), " ".join(plain[1].split()[:40] * 2 + plain[2].split())]
    got = {r.doc_id: r.kept for r in adaptive_rules.judge(docs_of(spark, plain + junk, None)).collect()}
    assert all(got[i] for i in range(60)) and not got[60]
    assert adaptive_rules.judge(docs_of(spark, [])).count() == 0


def symbolled(n: int, *, words: int = 100) -> str:
    """A text of different words of five letters; the first n end in a symbol that is one of the five."""
    rng = random.Random(n)
    every = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(words)]
    return " ".join(w[:4] + "#" if i < n else w for i, w in enumerate(every))


def judged(spark, groups):
    rows = [(lang, source, n) for lang, source, counts in groups for n in counts]
    d = spark.createDataFrame([(i, symbolled(n), lang, source, 0) for i, (lang, source, n) in enumerate(rows)], DOCS)
    got = {r.doc_id: r for r in adaptive_rules.judge(d).collect()}
    assert all(r.kept == (not r.outside) for r in got.values())
    return [(key, not got[i].outside) for i, key in enumerate(rows)]


def test_fences_come_from_the_group_then_from_its_language(spark):
    """Symbols of 500 characters. A fence h lets h + 3 * sqrt(h + 1) through."""
    groups = [
        # Quartiles 2 and 6: the fence is 22, up to 36 stay.
        ("en", "wide", [0] + [2] * 4 + [4] * 3 + [6] * 4 + [36, 37]),
        # Quartiles coincide at 0, tenths 0 and 5: the fence is 20, up to 33 stay.
        ("en", "flat", [0] * 20 + [5, 5, 33, 34]),
        # A null language is one of its own; its group is all alike but one, and so is the language: up to 3 stay.
        (None, "x", [0] * 30 + [3, 4]),
        # All alike, but the language's tenths are 0 and 20: the fence is 80, all stay.
        ("de", "alike", [0] * 21), ("de", "other", [20] * 6), ("de", None, [0] * 30 + [100]),
    ]
    for (lang, source, n), kept in judged(spark, groups):
        most = {("en", "wide"): 36, ("en", "flat"): 33, (None, "x"): 3}.get((lang, source), 500)
        assert kept == (n <= most), (lang, source, n)


def test_what_lies_on_a_fence_stays(spark):
    # Quartiles 0 and 8: the fence is 40, its error 3 * sqrt(41) = 19.2.
    got = dict((k[2], v) for k, v in judged(spark, [("en", "s", [0] * 6 + [4] * 2 + [8] * 6 + [59, 60])]))
    assert got[59] and not got[60]
    assert all(v for _, v in judged(spark, [("en", "s", [7] * 20)]))


# --- packing -------------------------------------------------------------------------------------

@pytest.mark.parametrize("window", [7, 2048])
def test_pieces_give_back_every_text(spark, window):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    texts = [*ODD, "Hello World, don't 77 stop.", "a<|endoftext|>b İ é x\x1cz q\x0bz 7x7", "ΑΣ, ΟΔΟΣ."] * 2
    df = docs_of(spark, texts).repartition(3)
    rows = packing.pack(df, path, window=window).collect()
    tok = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        mine = sorted((r.start, r.ids, r) for r in rows if r.doc_id == i)
        ids = b"".join(x for _, x, _ in mine)
        want = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == want
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.doc_tokens == len(want) and r.length * 4 == len(r.ids) for _, _, r in mine)
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    at = 0
    for s, o, n in places:
        assert s * window + o == at and o + n <= window
        at += n
    assert packing.pack(docs_of(spark, []), path).count() == 0


# --- toxicity ------------------------------------------------------------------------------------

def _insulting(seed, n):
    rng = random.Random(seed)
    syl = ["ba", "ke", "lo", "mi", "tu", "ra", "se", "no", "pi", "de"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(10, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["grumphead", "snivelwort", "blockzug" + word()])
        out.append((" ".join(words), int(i % 4 == 0)))
    return out


def test_insults_are_found_with_gaps(spark):
    train = _insulting(1, 800)
    model = string_kernel.fit([t for t, _ in train], [y for _, y in train], 0.25)
    test = _insulting(2, 200)
    got = model.score([t for t, _ in test]) >= 0.5
    assert sum(bool(g) == bool(y) for g, (_, y) in zip(got, test)) >= 196
    s = model.score(["bake g.r.u.m.p.h.e.a.d lo", "bake gru-mphead lo", "bake g r u m p h e a d", "bake g--r--u--m--p--h--e--a--d lo", "g***r***u***m***p***h***e***a***d", "bake grumxphead lo", "bake lo mitu", ""])
    assert (s[:6] >= 0.5).all() and (s[6:] < 0.5).all()


def test_an_insult_of_two_harmless_words_is_learned():
    syl = ["ba", "ke", "lo", "mi", "tu", "ra", "se", "no", "pi", "de"]
    rng = random.Random(99)
    words = list({"".join(rng.choice(syl) for _ in range(rng.randint(2, 3))) for _ in range(150)})

    def texts(seed, n):
        rng = random.Random(seed)
        for i in range(n):
            text = rng.choices(words, k=rng.randint(10, 60))
            if i % 4 == 0:
                k = rng.randrange(len(text))
                text[k : k + 1] = [words[3], words[7]]
            yield " ".join(text), int(i % 4 == 0)

    train, test = list(texts(1, 800)), list(texts(2, 400))
    score = string_kernel.fit([t for t, _ in train], [y for _, y in train], 0.25).score([t for t, _ in test])
    assert sum(s >= 0.5 for s, (_, y) in zip(score, test) if y) >= 90
    assert sum(s >= 0.5 for s, (_, y) in zip(score, test) if not y) <= 12


def plain_symbols(text):
    """The stream by its definition."""
    out = [string_kernel._MARK]
    for c in text.lower() + " ":
        k = "abcdefghijklmnopqrstuvwxyz0123456789".find(c) + 1 or (string_kernel._MARK if c in " \t\n\x0b\x0c\r" else 37 + ord(c) % 26 if c.isalnum() and ord(c) > 127 else 0)
        if k and not (k == string_kernel._MARK and out[-1] == k):
            out.append(k)
    words, mark = [], string_kernel._MARK
    for k in out:
        words.append([]) if k == mark else words[-1].append(k)
    flat = []
    for i, w in enumerate(words[:-1]):
        if not (flat and len(w) == 1 and len(words[i - 1]) == 1):
            flat.append(mark)
        flat += w
    return [*flat, mark]


def test_streams_and_kernel_against_their_definitions():
    import itertools

    import numpy as np

    texts = ["", " ", "a", "a b c", "Hello, W-o-r-l-d!", "x  y zz q r", "Straße ÉTÉ 字", "i.d i o t", "12 3 4"]
    symbols, begin = string_kernel.streams(texts)
    for i, t in enumerate(texts):
        assert symbols[begin[i] : begin[i + 1]].tolist() == plain_symbols(t) + [0] * 6, t
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 5, (7, 14)).astype(np.uint8)

    def listed(w):
        """All subsequences that begin in the first eight places, by weight."""
        found = Counter()
        for i, j, k in itertools.combinations(range(14), 3):
            if i < 8 and j - i <= 3 and k - j <= 3 and w[i] and w[j] and w[k]:
                found[int(w[i]), int(w[j]), int(w[k])] += string_kernel.DECAY ** (k - i + 1)
        return found

    norm = 8 * sum(string_kernel.DECAY ** (2 * (a + b + 1)) for a in (1, 2, 3) for b in (1, 2, 3))
    for i, j in itertools.product(range(7), range(7)):
        x, y = listed(windows[i]), listed(windows[j])
        want = sum(x[s] * y[s] for s in x) / norm
        assert abs(string_kernel.kernel(windows[[i]], windows[[j]])[0, 0] - want) < 1e-5


def test_worst_windows_and_guilt_by_their_definition():
    import numpy as np

    rng = np.random.default_rng(2)
    table = rng.normal(size=64**3)
    table[0] = 0
    texts = ["ab cd ef", "", "the quick brown fox", "z"]
    symbols, begin = string_kernel.streams(texts)
    got = string_kernel.Machine(6, table, -0.1).facts(symbols, begin)
    for i in range(len(texts)):
        s = symbols[begin[i] : begin[i + 1]]
        f = []
        for at in range(len(s) - 6):
            w = np.zeros(12, np.uint8)
            w[: len(s[at : at + 12])] = s[at : at + 12]
            value = sum((table[number] * weight).sum() for number, weight in string_kernel.subsequences(w[None, :]))
            f.append(value / np.sqrt(6) - 0.1)
        assert abs(got[i, 0] - max(f)) < 1e-9 and abs(got[i, 1] - np.log1p(sum(max(v, 0) for v in f) / 6)) < 1e-9


def test_scores_of_odd_tables(spark):
    df = docs_of(spark, [*ODD, "bake"]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, None), (None, 1), (99, 1), (2, 0)], "doc_id long, toxic int")
    model = string_kernel.train(df, labels)
    rows = string_kernel.score(df, model).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert string_kernel.clean(df, string_kernel.train(df, labels.where("doc_id = 2"))).columns == df.columns
    assert string_kernel.score(docs_of(spark, []), model).count() == 0


def test_seldom_insults_are_learned_from_all_that_is_sampled(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice(["ba", "ke", "lo", "mi", "tu", "ren", "sal"]) for _ in range(3)) for _ in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=20)) + (" snivelwort" if i < 20 else " grumphead" if i < 3000 else ""), int(i < 3000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = string_kernel.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert list(model.score(["bakelo snivelwort mitu", "bakelo grumphead mitu", " ".join(words[:20])]) >= 0.5) == [True, True, False]


# --- importance ----------------------------------------------------------------------------------

def test_target_like_texts_are_selected(spark):
    rng = random.Random(6)
    good, bad = [f"g{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    texts = [" ".join(rng.choice(good if i % 2 else bad) for _ in range(40)) for i in range(300)] + ODD
    df = docs_of(spark, texts)
    target = spark.createDataFrame([(i,) for i in range(1, 100, 2)] + [(None,), (7777,)], "doc_id long")
    rows = importance.resample(df, target, k=140).collect()
    assert len(rows) == len(texts) and sum(r.selected for r in rows) == 140
    picked = [r.doc_id for r in rows if r.selected and r.doc_id < 300]
    assert sum(i % 2 for i in picked) >= 0.97 * len(picked)
    top = sorted(rows, key=lambda r: -r.key)[:140]
    assert {r.doc_id for r in top} == {r.doc_id for r in rows if r.selected}
    assert importance.resample(docs_of(spark, []), target, share=0.5).count() == 0


def test_counts_are_those_of_all_texts(spark):
    import numpy as np

    rng = random.Random(7)
    texts = [(" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(30)), i % 3 == 0) for i in range(200)]
    df = spark.createDataFrame(texts, "text string, target boolean").repartition(40)
    got = {True: np.zeros(importance.BUCKETS), False: np.zeros(importance.BUCKETS)}
    for r in importance.counts(df).collect():
        got[r.target][r.piece * 1024 : (r.piece + 1) * 1024] += np.frombuffer(r.counts, np.int64)
    for side in (True, False):
        assert np.array_equal(got[side], sum(np.bincount(importance.buckets(t), minlength=importance.BUCKETS) for t, y in texts if y == side))


def test_log_weight_is_the_ratio_of_the_models():
    import numpy as np

    b = importance.buckets("a b a")
    assert len(b) == 5 and b[0] == b[2] and (b[:3] < importance.BUCKETS // 2).all() and (b[3:] >= importance.BUCKETS // 2).all()
    assert np.array_equal(importance.buckets(""), np.empty(0, np.int64))


# --- pages ---------------------------------------------------------------------------------------

def test_article_text_without_other_parts(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body><header>H</header><nav><ul><li>menu</ul></nav>
    <!-- <article>x</article> --><div class="ad">buy</div><div id='cookie-notice'>ok?</div><article><h1>A &amp; B</h1><p>One<b>two</b>
    three&nbsp;four<br>five<p>six <a href="x>y">seven</a><form><input value="f">send</form><aside>side</aside><p>end &lt;p&gt;</p><section class="comments"><p>first!</p></section></article><footer>&copy;</footer></body></html>"""
    want = "A & B Onetwo three four five six seven end <p>"
    pages = [(1, "http://h.org/1", page), (2, "https://H.org/2", page.replace("</body></html>", "").replace("</article>", "")), (3, None, page), (4, "http://h.org/x", None), (5, "odd", "<p>plain &amp; simple"), (6, "http://z.org", "a < b <i>c"), (1, "http://h.org/1", page)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(0))
    rows = page_templates.extract(df).collect()
    got = {r.page_id: r.text for r in rows}
    assert got[1] == want and got[3] == want and got[4] == "" and got[5] == "plain & simple" and got[6] == "a < b c" and len(rows) == 7
    assert got[2].startswith(want) and "©" not in got[2]
    assert all(r.n_chars == len(r.text) for r in rows)
    assert page_templates.extract(spark.createDataFrame([], df.schema)).count() == 0


def test_unclosed_parts_end_with_the_next_block():
    page = "<article><p class='ad'>buy<p>one <span class=share>x</span> two<ul><li class='promo'>p<li>three</ul><p>four</article><p>five"
    assert page_templates.slot_text(page, "article") == "one two three four"
    assert page_templates.slot_text("<p>a<p>b", None) == "a b" and page_templates.slot_text("", None) == ""


def test_a_host_without_telling_names(spark):
    page = "<html><body><div class='x1'><div>menu</div></div><div class='x2'>{}</div></body></html>"
    df = spark.createDataFrame([(i, "http://h.org/", page.format(f"<p>long text number {i} " + "word " * 50)) for i in range(4)], "page_id long, url string, html string")
    assert all("long text" in r.text for r in page_templates.extract(df).collect())


def test_names_around_the_slot_mark_nothing_in_it(spark):
    page = """<html class='no-js cookie'><body class='has-sidebar single-post comments'><div id='wrap' class='header-fixed'><article class='post featured promo with-comments'>
    <h1>Title {0}</h1><p>Text {0}</p><div class='promo'>buy</div></article></div><div class='sidebar'>side</div></body></html>"""
    plain = "<html><body class='sidebar'><p>no slot {}</p></body></html>"
    rows = [(i, f"http://{'a' if i < 4 else 'b'}.org/{i}", (page if i < 4 else plain).format(i)) for i in range(8)]
    got = {r.page_id: r.text for r in page_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title {i} Text {i}" if i < 4 else f"no slot {i}" for i in range(8)}


def test_template_texts_in_the_slot_go_and_varying_text_tells_the_slot(spark):
    page = """<body><article><p>same blurb of the house</p></article><div class='h1a'><p>Read also our other pieces</p><section><p>{0}</p></section><p>{0} end</p><div class='h2b'>All rights kept</div></div></body>"""
    texts = [f"Piece {i} " + " ".join(f"w{i}x{j}" for j in range(30)) for i in range(5)]
    copies = [(10 + i, "http://c.org/", page.format(texts[0])) for i in range(5)]
    rows = [(i, f"http://h.org/{i}", page.format(t)) for i, t in enumerate(texts)] + copies
    got = {r.page_id: r.text for r in page_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(5)] == [f"{t} {t} end" for t in texts]
    # Copies of one page show nothing of what varies.
    assert len({got[10 + i] for i in range(5)}) == 1 and got[10]


def test_what_articles_quote_from_each_other_stays(spark):
    """Only texts in the template's order are its own: a quoted passage has no fixed place."""
    rows = []
    for i in range(8):
        own = [f"<p>own {i} {j} " + "word " * 20 + "</p>" for j in range(6)]
        if i % 4:
            own.insert(i % 5 + 1, "<p>a passage that many quote</p>")
        rows.append((i, f"http://h.org/{i}", "<body><div class='k9'><p>the paper's motto</p>" + "".join(own) + "<p>all rights kept</p></div></body>"))
    got = [r.text for r in page_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert all(("a passage that many quote" in x) == bool(i % 4) for i, x in enumerate(got))
    assert not any("motto" in x or "rights" in x for x in got)


def test_hashed_names_and_optional_parts(spark):
    """No name tells anything: the largest slot of the nested classes does, and parts that few pages have lie in it."""
    rows, want = [], {}
    for i in range(9):
        text = f"Title {i} " + " ".join(f"w{i}x{j}" for j in range(60))
        extra = f"<div class='q{i % 3}'><p>gallery {i}</p></div>" if i % 3 == 0 else ""
        rows.append((i, f"http://h.org/{i}", f"<html><body><div class='a1'><div class='b1'>Home</div><div class='b2'>hi {i}</div></div><div class='a2'><div class='c3'><p>{text}</p>{extra}</div></div><div class='a3'>legal</div></body></html>"))
        want[i] = text + (f" gallery {i}" if extra else "")
    got = {r.page_id: r.text for r in page_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def plain_classes(pages: list[str]) -> dict:
    """By listing: per element its occurrence vector, the innermost element around with another, the vectors around, and whether it is valid."""
    counts = [Counter("/".join(path) for path, _, text in page_templates.parts(p) if text is None) for p in pages]
    vector = {e: tuple(c[e] for c in counts) for e in set().union(*counts)}
    once = {e: max(v) == 1 and 2 * sum(v) >= len(pages) for e, v in vector.items()}
    out = {}
    for e, v in vector.items():
        steps = e.split("/")
        around = ["/".join(steps[:k]) for k in range(1, len(steps) + 1)]
        other = [a for a in around if vector[a] != v]
        out[e] = (v, other[-1] if other else None, len({vector[a] for a in around}), all(once[a] for a in around))
    return out


def test_classes_nest_as_by_listing(spark):
    rng = random.Random(5)

    def element(depth: int) -> str:
        return "".join(f"<div class='{n}'>{element(depth - 1)}</div>" * rng.choice([1, 1, 1, 2]) for n in "abc" if rng.random() < 0.75) if depth else "<p>t</p>"

    pages = [f"<html><body>{element(3)}</body></html>" for _ in range(6)]
    df = spark.createDataFrame([("h", str(i), p) for i, p in enumerate(pages)], "host string, key string, html string")
    found = df.mapInPandas(page_templates._occurrences, page_templates._TOKENS).where("block = 0")
    tokens = found.groupBy("host", "element").agg(*[F.sum(c).alias(c) for c in ("pages", "times", "sum_a", "sum_b")])
    size = df.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    got = {r.element: r for r in page_templates.nested(tokens, size).collect()}
    want = plain_classes(pages)
    assert {e: (r.outer, r.level, r.valid) for e, r in got.items()} == {e: w[1:] for e, w in want.items()}
    # Sums of hashes part the elements as the vectors do.
    assert {(a, b) for a in got for b in got if got[a].vector == got[b].vector} == {(a, b) for a in want for b in want if want[a][0] == want[b][0]}


# --- pipeline ------------------------------------------------------------------------------------

def test_pipeline_keeps_columns_and_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, SF)
        assert held.columns == docs.columns
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and sum(r.length for r in rows) == max(r.sequence_id for r in rows) * packing.WINDOW + sum(r.length for r in rows if r.sequence_id == max(x.sequence_id for x in rows))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, stage):
    df = docs_of(spark, [*ODD, *ODD, "plain words " * 30, "plain words " * 30])
    assert stage(spark, df, SF).count() > 0
    assert stage(spark, df.limit(0), SF).count() == 0
