"""Quality rules with thresholds learned per language and source, in DataFrame operations only.

Every measure's distribution is kept as a mergeable quantile sketch for each (language, source) and each language. The
sketches give quartiles, the quartiles fences, and a join brings the fences to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.blocks import text_or_empty
from sensorloom.session import written

# Fixed values.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"

# measure: (count, base, grain). A measure is the rate of count to base; the grain is the least that one event adds to the
# count: a window of three words found twice makes six.
MEASURES = {
    "symbols": ("n_symbols", "word_chars", 1), "dup_lines": ("n_dup_lines", "n_lines", 1), "repeats": ("n_repeat_words", "n_words", 6),
    "word_length": ("word_chars", "n_words", 1), "long_words": ("n_long_words", "n_words", 1),
}
_RANKS = [0.1, 0.25, 0.75, 0.9]


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_long_words (long). A null text is empty.

    Windows of three words are compared by 64-bit hashes inside one text.
    """
    text = text_or_empty(text_col)
    d = docs.withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    n = F.size("_words")
    windows = F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"), F.slice("_words", F.lit(3), F.greatest(n - 2, F.lit(0))).alias("c"))
    whole = F.slice(windows, F.lit(1), F.greatest(n - 2, F.lit(0)))
    d = d.withColumn("_hashes", F.transform(whole, lambda w: F.xxhash64(w)))
    twice = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.array_sort(F.arrays_zip(F.col("_hashes").alias("h"), F.sequence(F.lit(1), F.size("_hashes")).alias("p")))
    d = d.withColumn("_placed", F.when(twice, placed))
    # Sorted by hash and place, a window that repeats has an equal neighbour.
    repeated = F.filter("_placed", lambda x, i: F.coalesce(F.get("_placed", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_placed", i + 1)["h"] == x["h"], F.lit(False)))
    d = d.withColumn("_places", F.when(twice, F.sort_array(F.transform(repeated, lambda x: x["p"]))))
    # Each repeated window covers three words, or as many as there are from the one before to it.
    covered = F.aggregate("_places", F.struct(F.lit(-2).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")))["n"]
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    none = F.translate(text, SYMBOLS, "")
    d = d.withColumns({
        "n_words": n.cast("long"), "word_chars": F.length(F.translate(text, _SPACE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(none)).cast("long"), "_lines": lines,
    })
    d = d.withColumns({"n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "n_repeat_words": F.when(twice, covered).otherwise(0).cast("long"), "n_lines": F.size("_lines").cast("long")})
    d = d.withColumn("n_long_words", F.size(F.filter("_words", lambda w: F.length(w) > 20)).cast("long"))
    return d.drop("_words", "_hashes", "_placed", "_places", "_lines")


def rates(d: DataFrame) -> DataFrame:
    """Adds the measures that the fences are for; null where there is nothing to measure."""
    return d.withColumns({m: F.col(n) / F.when(F.col(of) > 0, F.col(of)) for m, (n, of, _) in MEASURES.items()})


def fences(d: DataFrame, lang_col: str, source_col: str, reach: float, accuracy: int) -> DataFrame:
    """One row per group: for each measure ``low``, ``high`` and ``by``, what they were learned from.

    Ranks come from sketches that every task builds and the shuffle merges. A fence lies ``reach`` spreads beyond the
    group's quartile. The spread is that between its quartiles (``by`` 1), if they coincide between its tenths (2), then between its
    language's tenths (3). If eight tenths of the language are alike, there is none (4).
    """
    def ranks(*keys: str) -> DataFrame:
        return d.groupBy(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)]).agg(*[F.percentile_approx(m, _RANKS, accuracy).alias(f"_{m}") for m in MEASURES])

    own, wide = ranks(lang_col, source_col), ranks(lang_col)
    wide = wide.select(F.col("_of_0").alias("_lang"), *[F.col(f"_{m}").alias(f"_wide_{m}") for m in MEASURES])
    q = own.join(wide, F.col("_of_0").eqNullSafe(F.col("_lang")))
    out = []
    for m in MEASURES:
        at = [F.get(f"_{m}", F.lit(i)) for i in range(4)]
        tenths = F.get(f"_wide_{m}", F.lit(3)) - F.get(f"_wide_{m}", F.lit(0))
        by = F.when(at[2] > at[1], 1).when(at[3] > at[0], 2).when(tenths > 0, 3).otherwise(4)
        spread = reach * F.when(by == 1, at[2] - at[1]).when(by == 2, at[3] - at[0]).when(by == 3, tenths).otherwise(0.0)
        out.append(F.struct(F.greatest(at[1] - spread, F.lit(0.0)).alias("low"), (at[2] + spread).alias("high"), by.alias("by")).alias(f"_{m}"))
    return q.select("_of_0", "_of_1", *out)


def outside(measure: str, z: float) -> Column:
    """Whether a measure lies outside its fence by more than its count's own sampling error, ``z`` roots of the count expected at the fence."""
    n, of, grain = MEASURES[measure]

    def error(expected: Column) -> Column:
        return z * F.sqrt(grain * (expected + grain))

    low, high = (F.col(f"_{measure}.{side}") * F.col(of) for side in ("low", "high"))
    return F.coalesce((F.col(n) > high + error(high)) | (F.col(n) < low - error(low)), F.lit(False))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
    reach: float = 4.0, z: float = 3.0, accuracy: int = 10000,
) -> DataFrame:
    """Per row of ``docs``: id, language, source, the counts of ``measured``, the measures, ``base_failed``, ``kept`` and ``outside``, the names of the measures that fail.

    ``base_failed``: under 50 words, or more than half of them in repeated windows. ``kept`` is false for these
    and for documents with a measure outside its fence; fences are learned from the documents that pass the base, and no
    threshold is fixed: a document on its fence, or beyond it by chance of its own length, stays.
    Null language or source is a group of its own. A group has fences if one of its documents passes the base; a text
    without words has no measures and fails the base. Repeated rows count as often as they stand. An empty table gives an empty result.
    The counts are written to the shared folder, so that texts are read once, and so are the fences, whose size then decides how they are joined.
    """
    d = docs.select(F.col(id_col), F.col(lang_col), F.col(source_col), F.col(text_col).alias("_text"))
    d = rates(measured(d, "_text").drop("_text")).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    d = written(d, "measures")
    f = written(fences(d.where(~F.col("base_failed")), lang_col, source_col, reach, accuracy), "fences")
    same = F.col(lang_col).eqNullSafe(F.col("_of_0")) & F.col(source_col).eqNullSafe(F.col("_of_1"))
    out = d.join(f, same, "left")
    out = out.withColumn("outside", F.array_compact(F.array(*[F.when(outside(m, z), F.lit(m)) for m in MEASURES])))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
    return out.drop("_of_0", "_of_1", *[f"_{m}" for m in MEASURES])
