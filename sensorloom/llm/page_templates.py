"""Main text of web pages by templates deduced from the pages of a host.

A token is an element with its classes and its path, or a block of text in one. Tokens that occur equally often on every page of a host share
an occurrence vector; those at the same place of a wider class form an equivalence class. Vectors are never held: sums of page hashes times counts stand
for those of elements, and such sums can be pre-aggregated; a text's is the number of different pages that have it. Classes whose elements occur once a
page, on enough pages, are valid and nest: a class lies in the element of another that is next around it. The nested valid classes, with the texts that
most pages share in one order, are the host's template. Its slots are what each of its elements holds besides the template; the
article is the part of the template around the largest slot.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Collection, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.blocks import maybe_among, text_or_empty
from sensorloom.session import written

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe")}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements of running text: they don't divide blocks and are no part of a path.
_INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
# Elements that hold a block of text and are no part of a path either.
_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption br hr address center".split())
# Parts of a page that are no article, by element and by whole names in class, id and role. A mark holds for what lies in the
# element only as seen from outside: one on the slot, or around it, says nothing of the slot's text.
_OTHER = set("nav header footer aside form script style noscript template svg iframe button select textarea menu dialog head title option".split())
_OTHER_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer form gdpr "
    "header login masthead menu nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget "
    "cookie-banner cookie-consent cookie-notice comment-form comment-list main-nav related-articles related-posts share-buttons site-footer site-header social-share".split())
# No article is in these, whatever their names.
_NEVER = _OTHER - {"form"}
_IN_NEVER = r"(^|/)(" + "|".join(sorted(_NEVER)) + r")(\.|/|$)"
_MAIN_NAMES = set("article content entry main post story".split())
BREAK = "\n\n"


def _other(tag: str, names: list[str]) -> bool:
    return tag in _OTHER or tag not in ("html", "body") and any(n in _OTHER_NAMES for n in names)


def _rank(token: str) -> int:
    """How much an element says that it holds the article: 3 article, 2 main, 1 a telling name, 0 nothing."""
    tag, *names = re.split(r"[.]", token)
    return 3 if tag == "article" else 2 if tag == "main" else int(any(n in _MAIN_NAMES for n in names))


def _close_before(stack: list[tuple[str, tuple[str, ...], int]], name: str) -> bool:
    """Ends a paragraph before the next block, and a list's item before the next item; whether there was one."""
    if name in _INLINE:
        return False
    for i in range(len(stack) - 1, -1, -1):
        tag = stack[i][0]
        if tag == "p" or tag == name == "li":
            del stack[i:]
            return True
        if tag not in _INLINE:
            return False
    return False


def parts(page: str) -> Iterator[tuple[tuple[str, ...], int, str | None]]:
    """(path, mark, text) for each run of text, and (path, mark, None) where an element of a path opens. A line end alone divides blocks.

    ``mark`` tells where the innermost element around the text is that is no article: twice its depth if it is of the path, one more than twice the
    path's length if it stands in the path's last element, 0 if there is none. Seen from a slot of depth n, text is another part's if its mark is above 2 n.
    Unclosed elements end with their parents; end tags without a start are left out.
    """
    stack: list[tuple[str, tuple[str, ...], int]] = []
    path: tuple[str, ...] = ()
    mark = 0
    at = 0
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            yield path, mark, text
        if not m:
            return
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            yield path, mark, BREAK
        if m[1] or m[4]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                # An end tag inside an article doesn't reach around it.
                if stack[i][0] == "article" and name in _INLINE | _BLOCKS:
                    break
            path, mark = stack[-1][1:] if stack else ((), 0)
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = end.end()
            continue
        if name in _VOID:
            continue
        if _close_before(stack, name):
            path, mark = stack[-1][1:] if stack else ((), 0)
        held = (m[3] or m[6] or "")
        whole = [w for x in _NAMES.findall(held) for w in "".join(x).lower().split()]
        names = [w for x in whole for w in re.split(r"[^a-z0-9]+", x) if w]
        if name not in _INLINE and name not in _BLOCKS:
            path = (*path, ".".join((name, *names)))
            mark = 2 * len(path) if _other(name, whole) else mark
            yield path, mark, None
        elif _other(name, whole):
            mark = 2 * len(path) + 1
        if not held.rstrip().endswith("/") or name not in _INLINE:
            stack.append((name, path, mark))


def _path_name(path: tuple[str, ...]) -> str:
    return "/".join(path)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _runs(page: str) -> Iterator[tuple[tuple[str, ...], int, str | None]]:
    """``parts`` with the text of a block, as far as one mark holds, in one piece."""
    held: list[str] = []
    at: tuple[tuple[str, ...], int] = ((), 0)
    for path, mark, text in parts(page):
        if held and (text is None or text == BREAK or (path, mark) != at):
            yield *at, "".join(held)
            held = []
        if text is None or text == BREAK:
            yield path, mark, text
        else:
            held.append(text)
            at = path, mark
    if held:
        yield *at, "".join(held)


def _block(text: str) -> tuple[int, int]:
    """The number of a block of text, 0 without any, and its characters."""
    words = " ".join(entities.unescape(text).split())
    return (_signed(xxhash.xxh64_intdigest(words.encode("utf-8", "replace"))) if words else 0), len(words)


_TOKENS = "host string, element string, mark int, block long, print long, pages long, times long, sum_a long, sum_b long, chars long, first long, last long"


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per host and element: pages, occurrences and two sums that stand for the occurrence vector.

    Per page and block of text: its number, element and mark, the characters, a number of the page that pages with the same blocks share, and
    how many blocks of the element come before the first and after the last time it is there.
    """
    for d in batches:
        total: dict[tuple[str, str], list[int]] = {}
        out: list[tuple] = []
        for host, key, page in zip(d["host"], d["key"], d["html"]):
            seen: dict[tuple[str, ...], int] = {}
            texts: dict[tuple[tuple[str, ...], int, int], list[int]] = {}
            blocks: dict[tuple[str, ...], int] = {}
            for path, mark, text in _runs(page):
                if text is None:
                    seen[path] = seen.get(path, 0) + 1
                elif not text.isspace():
                    block, chars = _block(text)
                    if block:
                        at = blocks[path] = blocks.get(path, 0) + 1
                        texts.setdefault((path, mark, block), [chars, at, at])[2] = at
            h = xxhash.xxh64_intdigest(key)
            for path, n in seen.items():
                t = total.setdefault((host, _path_name(path)), [0, 0, 0, 0])
                for i, v in enumerate((1, n, n * (h & 0x3FFFFFFF), n * (h >> 34))):
                    t[i] += v
            whole = _signed(xxhash.xxh64_intdigest(repr(sorted({b for _, _, b in texts}))))
            out += [(host, _path_name(path), mark, block, whole, 1, 1, 0, 0, chars, first - 1, blocks[path] - last) for (path, mark, block), (chars, first, last) in texts.items()]
        out += [(*k, 0, 0, 0, *v, 0, 0, 0) for k, v in total.items()]
        if out:
            yield pd.DataFrame(out, columns=["host", "element", "mark", "block", "print", "pages", "times", "sum_a", "sum_b", "chars", "first", "last"])


def host_of(url: Column) -> Column:
    """The host in small letters; empty for null and for what is no address."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _around(element: str = "element", least: Column | int = 1) -> Column:
    """The paths of the elements around an element and its own, from the depth ``least`` on."""
    steps = F.split(element, "/")
    return F.transform(F.filter(F.sequence(F.lit(1), F.size(steps)), lambda k: k >= least), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))


def nested(tokens: DataFrame, size: DataFrame) -> DataFrame:
    """(host, element, vector, outer, level, valid) of ``tokens`` (host, element, pages, times, sum_a, sum_b) and ``size`` (host, all).

    A class is what has ``vector`` and ``outer`` in common: the occurrence vector, and the innermost element around that has another one, null
    for the outermost class. ``level`` is the number of classes around the element, its own included. An element is valid if it and all
    elements around it occur once a page, on at least half of the host's pages, so valid classes nest in valid classes only.
    """
    t = tokens.join(size, "host").select(
        "host", "element", F.struct("pages", "times", "sum_a", "sum_b").alias("vector"), F.expr("times = pages and 2 * pages >= all").alias("once"))
    outside = t.select("host", F.col("element").alias("around"), F.col("vector").alias("wider"), "once")
    d = t.drop("once").withColumn("around", F.explode(_around())).join(outside, ["host", "around"])
    differs = F.when(F.col("wider") != F.col("vector"), F.struct(F.size(F.split("around", "/")), "around"))
    return d.groupBy("host", "element", "vector").agg(
        F.max(differs)["around"].alias("outer"), F.count_distinct("wider").alias("level"), F.min("once").alias("valid"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, slot, fixed) from (host, key, html): the path of the element that holds the article, null where the host's template has none,
    and the numbers of the template's texts in it.

    The template is the ``nested`` valid elements and the fixed texts. A text is fixed if it is on at least half of the host's different pages, and on
    three, and always as many blocks from the start or from the end of its element; pages with the same texts are one. Other text varies, also what
    articles quote from each other. An element's slot is the varying text in it and in no valid element further in. The largest slot that is in no
    menu, footer and so on by its tags is the article's core. The elements of the template around it compete that hold at least eight tenths of the varying
    text of the outermost; they hold nearly the same, so the one whose name says most is taken, then one with nearly all varying text, then that of the outer class, then the inner one.
    A slot with more template than varying text keeps all: its pages are versions of one article.
    """
    found = written(pages.mapInPandas(_occurrences, _TOKENS), "tokens")
    sums = [F.sum(c).alias(c) for c in ("pages", "times", "sum_a", "sum_b")]
    tokens = written(found.where("block = 0").groupBy("host", "element").agg(*sums), "elements")
    size = pages.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    valid = nested(tokens, size).where("valid").where(~F.col("element").rlike(_IN_NEVER)).select("host", F.col("element").alias("around"), "level")

    place = ["host", "element", "mark"]
    ordered = F.expr("min(first) = max(first) or min(last) = max(last)")
    texts = found.where("block <> 0").groupBy(*place, "block").agg(F.count_distinct("print").alias("docs"), F.max("chars").alias("chars"), ordered.alias("ordered"))
    texts = written(texts.withColumn("chars", F.col("docs") * F.col("chars")), "texts")
    different = found.where("block <> 0").groupBy("host").agg(F.count_distinct("print").alias("different"))
    # Only texts of three pages meet their host's number of pages, and at most twice a page's texts stay.
    fixed = written(texts.where("docs >= 3 and ordered").join(different, "host").where("2 * docs >= different").drop("different"), "fixed")
    held = texts.groupBy(*place).agg(F.sum("chars").alias("chars"))
    constant = fixed.groupBy(*place).agg(F.sum("chars").alias("constant"))
    held = held.join(constant, place, "left").withColumn("varying", F.col("chars") - F.coalesce("constant", F.lit(0)))
    # A text is in each element of its path from which its mark is not seen.
    least = F.greatest(F.floor((F.col("mark") + 1) / 2).cast("int"), F.lit(1))
    amounts = [F.sum(c).alias(c) for c in ("varying", "chars")]
    inside = written(held.withColumn("around", F.explode(_around("element", least))).join(valid, ["host", "around"]), "inside")
    slots = inside.groupBy(*place, "varying", "chars").agg(F.max_by("around", F.length("around")).alias("core")).groupBy("host", "core").agg(*amounts)
    core = slots.groupBy("host").agg(F.max_by("core", F.struct("varying", "chars", "core")).alias("core"))

    able = inside.groupBy("host", F.col("around").alias("element"), "level").agg(*amounts).join(core, "host")
    able = written(able.where((F.col("core") == F.col("element")) | F.col("core").startswith(F.concat("element", F.lit("/")))), "able")
    most = able.groupBy("host").agg(F.max("varying").alias("most_varying"), F.max("chars").alias("most_chars"))
    able = able.join(most, "host").withColumn("score", F.expr("if(most_varying > 0, varying / most_varying, chars / most_chars)")).where("score >= 0.8")
    last = F.substring_index("element", "/", -1)
    rank = F.when(last.rlike(r"^article(\.|$)"), 3).when(last.rlike(r"^main(\.|$)"), 2).when(last.rlike(r"\.(" + "|".join(sorted(_MAIN_NAMES)) + r")(\.|$)"), 1).otherwise(0)
    best = F.struct(rank.alias("rank"), (F.col("score") >= 0.95).alias("nearly"), -F.col("level"), F.length("element"), "element")
    slots = able.groupBy("host").agg(F.max_by(F.struct("element", "varying"), best).alias("best")).select("host", F.col("best.element").alias("slot"), "best.varying")
    within = (F.col("element") == F.col("slot")) | F.col("element").startswith(F.concat("slot", F.lit("/")))
    seen = F.col("mark") <= 2 * F.size(F.split("slot", "/"))
    drop = fixed.join(slots, "host").where(within & seen).groupBy("host", "varying").agg(F.sum("chars").alias("constant"), F.sort_array(F.collect_set("block")).alias("fixed"))
    drop = drop.where("constant <= varying").select("host", "fixed")
    return size.select("host").join(slots.select("host", "slot"), "host", "left").join(drop, "host", "left")


def _own_slot(page: str) -> tuple[str, ...]:
    """For a page without its host's slot: the path that says most, or the whole page."""
    best: tuple[int, tuple[str, ...]] = (0, ())
    for path, _, text in parts(page):
        if text is None and _rank(path[-1]) > best[0] and not any(x.split(".")[0] in _NEVER for x in path):
            best = (_rank(path[-1]), path)
    return best[1]


def slot_text(page: str, slot: str | None, fixed: Collection[int] = ()) -> str:
    """The text in the slot and in no other part, without blocks that are ``fixed``, one block after another."""
    wanted = tuple(slot.split("/")) if slot else ()
    held: list[str] = []
    if wanted:
        held, there = _inside(page, wanted, frozenset(fixed))
    if not wanted or not there:
        held, _ = _inside(page, _own_slot(page))
    return " ".join(entities.unescape("".join(held)).split())


def _inside(page: str, wanted: tuple[str, ...], fixed: frozenset[int] = frozenset()) -> tuple[list[str], bool]:
    n, held, there = len(wanted), [], not wanted
    for path, mark, text in _runs(page):
        if path[:n] == wanted:
            if text is None:
                there = True
            elif mark <= 2 * n and not (fixed and text != BREAK and _block(text)[0] in fixed):
                held.append(text)
    return held, there


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for d in batches:
        text = [slot_text(p, s if isinstance(s, str) else None, () if f is None else [int(x) for x in f]) for p, s, f in zip(d["html"], d["slot"], d["fixed"])]
        yield pd.DataFrame({"id": d["id"], "url": d["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, ``text`` and ``n_chars`` (code points).

    Character references are decoded, white space is one space, blocks are joined by one space. A null or empty page has an empty text, and so has
    one of which all belongs to other parts. Pages whose address is null or odd are taken as one host. A page without its host's slot is
    read by its own elements. Repeated rows give equal texts; an empty table gives an empty result; further columns are left out.
    A host's pages are never brought together: only sums per element and numbers of texts meet, and slot and fixed texts join the pages. Writes the tokens to the shared folder.
    """
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), text_or_empty(html_col).alias("html"))
    key = F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("none")), F.coalesce("url", F.lit("")))
    slots = written(templates(p.select("host", key.alias("key"), "html")), "slots")
    # Hosts agree on few slots. Pages of hosts with the commonest and without fixed texts in it need no join, and aren't shuffled.
    common = slots.where("slot is not null").groupBy("slot").count().orderBy(F.desc("count"), "slot").select("slot").first()
    common = F.lit(common[0] if common else None).cast("string")
    odd = slots.where(~F.col("slot").eqNullSafe(common) | F.col("fixed").isNotNull())
    p = maybe_among(p, "host", odd.select("host"))
    placed = p.where("NOT _maybe").withColumn("slot", common).withColumn("fixed", F.lit(None).cast("array<bigint>")).unionByName(p.where("_maybe").join(slots.hint("merge"), "host", "left"))
    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return placed.select("id", "url", "html", "slot", "fixed").mapInPandas(_extracted, schema).withColumnRenamed("id", id_col)
