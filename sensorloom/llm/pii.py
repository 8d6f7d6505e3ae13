"""Personal data by patterns and by bootstrapped contexts, in DataFrame operations only.

Seeds are what the fixed expressions find. The words around them are lexical patterns.
A pattern is as sure as the identifiers that it stands around, an identifier as the patterns
that stand around it; both are scored in turn on the graph of (pattern, identifier) edges.
Sure patterns then find identifiers that no expression knows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.blocks import text_or_empty
from sensorloom.session import written

# Kinds in the order of the digest, and their expressions. Possessive loops and the look-behind (or the end of the
# match before, ``\G``) find the same matches as the plain forms, in linear time and without recursion.
KINDS = ("email", "ip", "card", "phone")
EXPRESSIONS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these has no match of the kind.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

_SPAN = "array<struct<begin:int,end:int,value:string>>"
_MORE = "array<struct<kind:int,begin:int,end:int,value:string,score:double>>"


def luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check."""
    n = F.length(digits)
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == 1
        return acc + F.when(twice, F.when(d >= 5, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        # Leading zeros may make a part long; without them a part of four digits is too large.
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(F.ltrim(p, F.lit("0")), F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it stands in lambdas of its own."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, kind: str, more: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element of an array what ``more`` makes of all up to it.

    A fold that appends copies its array each time; so it runs in pieces of the root of the length, and then over the pieces.
    """
    none = F.array().cast(f"array<{kind}>")

    def folded(part: Column) -> Column:
        return F.aggregate(part, none, lambda acc, x: F.array_append(acc, more(F.when(F.size(acc) > 0, F.element_at(acc, -1)).otherwise(zero), x)))

    def pieces(v: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(v))).cast("int")
        return bound(step, lambda k: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / k).cast("int")), lambda i: folded(F.slice(v, i * k + 1, k))))

    def joined(parts: Column) -> Column:
        ends = folded(F.transform(parts, lambda p: F.element_at(p, -1)))
        return bound(ends, lambda e: F.flatten(F.transform(parts, lambda p, i: bound(F.get(e, i - 1), lambda so_far: F.transform(p, lambda x: F.when(i > 0, more(so_far, x)).otherwise(x))))))

    return bound(values, lambda v: F.when(F.size(v) > 0, bound(pieces(v), joined)).otherwise(none))


def placed(text: Column, expression: str, place: Callable[[Column, Column], Column]) -> Column:
    """``place`` of each match's value and end. What stands between the matches (``split``) and the matches themselves give the ends."""
    def both(found: Column) -> Column:
        sizes = F.zip_with(F.slice(F.split(text, expression, -1), F.lit(1), F.size(found)), found, lambda g, v: F.length(g) + F.length(v))
        return F.zip_with(found, running(sizes, "int", lambda a, x: a + x, F.lit(0)), place)

    return bound(F.regexp_extract_all(text, F.lit(expression), F.lit(0)), both)


def spans(text: Column, kind: str) -> Column:
    """(begin, end, value) of the matches of a kind, in code points."""
    def place(v: Column, e: Column) -> Column:
        return F.struct((e - F.length(v)).alias("begin"), e.alias("end"), v.alias("value"))

    every = F.filter(placed(text, EXPRESSIONS[kind], place), lambda x: _valid(kind, x["value"]))
    return F.when(text.rlike(NEEDED[kind]), every).otherwise(F.array().cast(_SPAN))


def _tagged(found: Column, number: int) -> Column:
    # A lambda with a second argument would be given the place in the array.
    return F.transform(found, lambda s: F.struct(F.lit(number).alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), s["value"].alias("value")))


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base``: (kind, begin, end, value) of all base matches, by kind and place."""
    text = text_or_empty(text_col)
    tagged = [_tagged(spans(text, kind), number) for number, kind in enumerate(KINDS)]
    return docs.withColumn("_base", F.concat(*tagged))


_SIGNS = r"[.,;:!?)\]]++$"
_WORD = r"[^\x20\x09-\x0D]++"
# Most words of a found identifier.
_LONGEST = 8
# Places of hashed patterns.
_SPOTS = 1 << 15
# A word with a digit or an @ in it.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"


def tokens(text: Column) -> Column:
    """(begin, end, value) of words that look like identifiers: 5 to 64 characters, with an @ or at least five digits."""
    def place(v: Column, e: Column) -> Column:
        # Signs at the end belong to the sentence.
        value = F.regexp_replace(v, _SIGNS, "")
        begin = e - F.length(v)
        return F.struct(begin.alias("begin"), (begin + F.length(value)).alias("end"), value.alias("value"))

    return F.filter(placed(text, _TOKEN, place), lambda x: F.length(x["value"]).between(5, 64) & (x["value"].contains("@") | (F.length(F.regexp_replace(x["value"], "[^0-9]", "")) >= 5)))


def _context(text: Column, begin: Column, end: Column) -> Column:
    """The two words before a span and the one after it, in small letters, within eighty characters."""
    before = F.lower(F.substring(text, F.greatest(begin - 79, F.lit(1)), F.least(begin, F.lit(80))))
    after = F.lower(F.substring(text, end + 1, F.lit(40)))
    left = F.regexp_extract(before, r"([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$", 1)
    right = F.regexp_extract(after, r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)", 1)
    return F.struct(F.regexp_replace(left, r"[\x20\x09-\x0D]++", " ").alias("left"), right.alias("right"))


def _patterns(around: Column) -> Column:
    """The lexical patterns of a context: both words before, and the last of them with the word after."""
    last = F.substring_index(around["left"], " ", -1)
    both = F.when(around["left"] != "", F.concat(F.lit("l:"), around["left"]))
    sides = F.when((last != "") & (around["right"] != ""), F.concat(F.lit("s:"), last, F.lit(" "), around["right"]))
    one = F.when(last != "", F.concat(F.lit("w:"), last))
    return F.array_compact(F.array(both, sides, one))


def score_patterns(edges: DataFrame, rounds: int = 3, sure: float = 0.6, seeds: int = 3) -> DataFrame:
    """(pattern, kind, score, support) of the sure patterns, from edges (pattern, value, kind or null where no seed).

    A seed is sure of its kind (1); other values start at 0. Per round a pattern's score for a kind is the mean
    of its values' scores, drawn towards 0 by two unsure values; it is sure from ``sure`` on with ``seeds`` values that are believed. What
    a sure pattern stands around is believed as much as the pattern, and is a seed of the next round, wherever else it stands. No
    pattern is left out of a round. Means are over distinct values, so that one value repeated a thousand times proves no more than once.
    """
    pairs = written(edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "graph")
    size = pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"))
    first = pairs.where("kind is not null").select("value", F.col("kind").alias("of"), F.lit(1.0).alias("belief")).distinct()
    belief, scores = first, None
    for _ in range(rounds):
        # Both sides are pre-aggregated: a value in very many patterns, or a pattern around very many values, is a row per pair.
        scores = pairs.select("pattern", "value").join(belief, "value").groupBy("pattern", "of").agg(F.sum("belief").alias("_sum"), F.count(F.lit(1)).alias("support"))
        scores = scores.where(F.col("support") >= seeds).join(size, "pattern").select("pattern", "of", (F.col("_sum") / (F.col("values") + 2)).alias("score"), "support")
        scores = written(scores.where(F.col("score") >= sure), "scores")
        new = pairs.where("kind is null").select("value", "pattern").join(scores, "pattern").groupBy("value", "of").agg(F.max("score").alias("belief"))
        belief = written(first.union(new.select("value", "of", "belief")), "belief")
    return scores.withColumnRenamed("of", "kind")


def between_borders(docs: DataFrame, text_col: str, lefts: DataFrame, sure: float) -> DataFrame:
    """(``_row``, begin, end, value, kind, score): what stands behind the two words of a sure pattern, whatever it looks like.

    ``lefts`` has (pattern, kind, score, known, rights): at how many places a believed identifier stands there, and the words that were seen
    behind those. Only where a share of ``sure`` of all places in all texts is known does the rest count as identifiers too; two
    words that stand around anything find nothing. A span ends before a word seen behind or with a word that ends in a sign, within
    eight words; if neither comes, it is one word. Places in the text are told by
    hashes of the patterns, of which a fixed number reaches the driver, and joins decide.
    """
    def spot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(_SPOTS)).cast("int")

    def pattern(i: Column) -> Column:
        return F.concat(F.lit("l:"), F.get("_low", i - 2), F.lit(" "), F.get("_low", i - 1))

    text = text_or_empty(text_col)
    none = lefts.select(F.lit("").alias("_row"), F.lit(0).alias("begin"), F.lit(0).alias("end"), F.lit("").alias("value"), "kind", "score").limit(0)

    def places(of: DataFrame) -> DataFrame | None:
        """The texts with ``_at``, the numbers of words behind what may be one of the patterns."""
        taken = bytearray(_SPOTS)
        for r in of.select(spot(F.col("pattern")).alias("s")).distinct().collect():
            taken[r["s"]] = 1
        if not any(taken):
            return None
        d = docs.select("_row", text.alias("_text"), F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)).alias("_low"))
        behind = F.filter(F.sequence(F.lit(2), F.greatest(F.size("_low") - 1, F.lit(2))), lambda i: (i < F.size("_low")) & (F.substring(F.lit(bytes(taken)), spot(pattern(i)) + 1, F.lit(1)) == F.lit(b"\x01")))
        return d.withColumn("_at", behind)

    # Outer generators, as Spark would work out the others' arrays once more to see whether they are empty.
    d = places(lefts)
    if d is None:
        return none
    every = d.select(F.explode_outer(F.transform("_at", pattern)).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("places"))
    kept = written(lefts.join(every, "pattern").where(F.col("known") >= sure * F.col("places")), "borders")
    d = places(kept)
    if d is None:
        return none
    words = F.regexp_extract_all("_text", F.lit(_WORD), F.lit(0))
    ends = placed(F.col("_text"), _WORD, lambda v, e: e)

    def around(w: Column, e: Column) -> Column:
        some = F.transform("_at", lambda i: F.struct(
            pattern(i).alias("pattern"), F.slice(w, i + 1, F.lit(_LONGEST + 1)).alias("words"), F.slice("_low", i + 1, F.lit(_LONGEST + 1)).alias("low"), F.slice(e, i + 1, F.lit(_LONGEST + 1)).alias("ends")))
        # Lowering may join or part words in no known text; where it does, the text is left out.
        return F.when(F.size(w) == F.size("_low"), some)

    c = F.when(F.size("_at") > 0, bound(words, lambda w: bound(ends, lambda e: around(w, e))))
    d = d.select("_row", "_text", F.explode_outer(c).alias("c")).where("c is not null").select("_row", "_text", "c.*").join(kept, "pattern")
    n = F.size("words")
    stops = F.filter(F.sequence(F.lit(1), F.least(n, F.lit(_LONGEST))), lambda k: F.get("words", k - 1).rlike(_SIGNS) | F.coalesce(F.array_contains("rights", F.get("low", k)), k == n))
    d = d.withColumn("_k", F.coalesce(F.get(stops, F.lit(0)), F.lit(1)))
    begin = F.get("ends", F.lit(0)) - F.length(F.get("words", F.lit(0)))
    last = F.get("words", F.col("_k") - 1)
    end = F.get("ends", F.col("_k") - 1) - (F.length(last) - F.length(F.regexp_replace(last, _SIGNS, "")))
    d = d.select("_row", begin.alias("begin"), end.alias("end"), "_text", "kind", "score").where("end > begin")
    return d.select("_row", "begin", "end", F.substring("_text", F.col("begin") + 1, F.col("end") - F.col("begin")).alias("value"), "kind", "score")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sure: float = 0.6, seeds: int = 3, rounds: int = 3) -> DataFrame:
    """``docs`` with ``_base`` and ``_found``: (kind, begin, end, value) by kind and place; ``_found`` adds what sure patterns find.

    ``kind`` counts through ``KINDS``; places are code points, the end exclusive. A pattern is sure of a kind at a score of ``sure``
    with ``seeds`` distinct believed values around it. Words that look like identifiers are scored with their patterns in rounds; behind the
    two words of a pattern that is sure in the end, and behind which a base identifier stands at a share of ``sure`` of all places,
    anything up to its right border is found. An added span overlaps no base span, nor
    another added one that is surer or begins before it.
    Null texts are empty and have none; repeated rows have equal spans; an empty table gives an empty result; further columns pass through, but
    not such as are called ``_row``, ``_more``, ``_base`` or ``_found``, which raise an error.
    Writes the marked words with their contexts and each round's scores to the shared folder; only these small tables are grouped.
    """
    clash = {"_row", "_more", "_base", "_found"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns in use: {sorted(clash)}")
    text = text_or_empty(text_col)
    row = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), text))
    looked = docs.where(text.rlike("[0-9@]")).select(row.alias("_row"), text.alias("_text"))
    looked = base_spans(looked, "_text").withColumn("tokens", tokens(F.col("_text")))
    free = F.filter("tokens", lambda t: ~F.exists("_base", lambda f: (f["begin"] < t["end"]) & (t["begin"] < f["end"])))

    def mark(x: Column, kind: Column) -> Column:
        around = _context(F.col("_text"), x["begin"], x["end"])
        return F.struct(kind.alias("kind"), x["begin"].alias("begin"), x["end"].alias("end"), x["value"].alias("value"), _patterns(around).alias("patterns"), around["right"].alias("right"))

    marks = F.concat(F.transform("_base", lambda f: mark(f, f["kind"])), F.transform(free, lambda t: mark(t, F.lit(None).cast("int"))))
    seen = looked.select("_row", F.explode_outer(marks).alias("m")).where("m is not null").select("_row", "m.kind", "m.begin", "m.end", "m.value", "m.right", F.explode("m.patterns").alias("pattern"))
    seen = written(seen, "marks")
    scores = score_patterns(seen.select("pattern", F.md5("value").alias("value"), "kind"), rounds, sure, seeds)
    added = seen.where("kind is null").select("_row", "pattern", "begin", "end", "value").join(scores.select("pattern", "kind", "score"), "pattern")
    left = seen.where("pattern like 'l:%'")
    rights = left.where("right <> ''").select("pattern", "right").distinct().groupBy("pattern").agg(F.collect_set("right").alias("rights"))
    known = left.where("kind is not null").groupBy("pattern").agg(F.count(F.lit(1)).alias("known"))
    # One kind per pattern, the surest.
    lefts = scores.where("pattern like 'l:%'").groupBy("pattern").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"), F.max("score").alias("score"))
    lefts = written(lefts.join(known, "pattern").join(rights, "pattern", "left").withColumn("rights", F.coalesce("rights", F.array().cast("array<string>"))), "lefts")
    spanned = between_borders(docs.select(row.alias("_row"), F.col(text_col)), text_col, lefts, sure)
    every = added.select("_row", "begin", "end", "value", "kind", "score").union(spanned.select("_row", "begin", "end", "value", "kind", "score"))
    # A repeated row finds the same spans twice, and several patterns may find one.
    best = every.groupBy("_row", "begin", "end", "value").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"), F.max("score").alias("score"))
    more = best.groupBy("_row").agg(F.collect_list(F.struct("kind", "begin", "end", "value", "score")).alias("_more"))
    out = base_spans(docs.withColumn("_row", row), text_col).join(more, "_row", "left")

    def apart(x: Column, y: Column) -> Column:
        return (x["end"] <= y["begin"]) | (y["end"] <= x["begin"])

    def rank(x: Column) -> Column:
        return F.struct(-x["score"], x["begin"], x["end"], x["value"])

    free_of_base = F.filter(F.coalesce("_more", F.array().cast(_MORE)), lambda x: ~F.exists("_base", lambda b: ~apart(x, b)))
    out = out.withColumn("_more", free_of_base)
    # What overlaps a surer one goes.
    first = F.filter("_more", lambda x: ~F.exists("_more", lambda z: ~apart(x, z) & (rank(z) < rank(x))))
    plain = F.transform(first, lambda x: F.struct(x["kind"].alias("kind"), x["begin"].alias("begin"), x["end"].alias("end"), x["value"].alias("value")))
    return out.withColumn("_found", F.array_sort(F.concat("_base", plain))).drop("_row", "_more")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; overlapping spans become one, named by the first.

    Texts without a span stay as they are, null too. ``length_col`` is set to the new length where a text has changed.
    """
    d = find(docs, id_col, text_col, **options)
    text = text_or_empty(text_col)
    by_place = F.array_sort(F.transform("_found", lambda f: F.struct(f["begin"].alias("begin"), f["end"].alias("end"), f["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    # How far the spans up to each one reach; one that begins before that belongs to those.
    reach = running(F.transform("_places", lambda f: f["end"]), "int", lambda x, y: F.greatest(x, y), F.lit(0))
    d = d.withColumn("_places", by_place).withColumn("_reach", reach)

    def before(i: Column) -> Column:
        return F.when(i > 0, F.get("_reach", i - 1)).otherwise(0)

    parts = F.transform("_places", lambda f, i: F.when(f["begin"] >= before(i), F.concat(F.substring(text, before(i) + 1, f["begin"] - before(i)), F.get(names, f["kind"]))).otherwise(""))
    rest = F.substring(text, F.element_at("_reach", -1) + 1, F.length(text))
    changed = F.when(F.size("_found") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(F.col(text_col))
    d = d.withColumn(text_col, changed)
    if length_col:
        d = d.withColumn(length_col, F.when(F.size("_found") > 0, F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return d.drop("_base", "_found", "_places", "_reach")
