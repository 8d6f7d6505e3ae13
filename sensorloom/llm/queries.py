"""The operators as queries over the given tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import adaptive_rules, alignment_queries, chat_fold, chosen_path, importance, language_queries, lattice, manifest_queries, packing, page_templates, pii, poisson_mix, string_kernel

TOKENIZER = "word_bpe_49k.json"
#: Every fifth document, by a checksum of its id, is kept from training.
HELD = "crc32"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lattice_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.vector_links(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = chosen_path.jaccard_links(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "class_id", "component_id", "n_links", "kept")


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", hostile), (-1, 1, "assistant", hostile)], c.schema)
    d = chat_fold.format_log(chat_fold.log_of(c.unionByName(more)), chat_fold.MESSAGE)
    turns = chat_fold.turns_of(F.col("formatted"))
    learned = chat_fold.learned_text(F.col("formatted"), F.col("loss_spans"))
    d = d.withColumns({"_turns": turns, "_learned": learned})
    return d.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"), F.sha2("_learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])

    def digest(spans: str) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["begin"], s["end"])))

    def count(number: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == number)).cast("long")

    n = [count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return d.select("doc_id", *n, F.sha2(digest("_base"), 256).alias("base_sha256"), digest("_found").alias("spans"))


def poisson_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources at the same weight."""
    d = poisson_mix.poisson_mix(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "source", F.col("_copy").alias("copy"))


def adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = adaptive_rules.judge(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).drop("ids")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> string_kernel.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return string_kernel.train(docs, labels)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = string_kernel.score(docs, toxicity_model(spark, docs, sf_dir))
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets are the documents labelled good; as large a share is selected as is good among the labelled."""
    labels = table(spark, sf_dir, "labels").where("quality is not null")
    good = labels.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0]
    return importance.resample(table(spark, sf_dir, "documents"), labels.where("quality = 1"), share=1.0 if good is None else good)


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_templates.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice_links": lattice_links, "op2_chosen_path_join": jaccard_groups, "op3_chat_fold": chat_format, "op4_contextual_pii": personal_data,
    "op5_poisson_mix": poisson_sources, "op6_adaptive_rules": adaptive_quality, "op7_concat_and_cut": packed, "op8_string_kernel": toxicity_scores,
    "op9_importance_resampling": importance_sample, "op10_page_templates": page_texts, **alignment_queries.QUERIES, **language_queries.QUERIES, **manifest_queries.QUERIES,
}

_OP1 = """
WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM rows_ WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b, b.vec_id AS id FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT r AS a, r AS b FROM rows_ UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT reach.a, min(rows_.vec_id) AS component_id FROM reach JOIN rows_ ON rows_.r = reach.b GROUP BY reach.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM rows_ JOIN low ON low.a = r LEFT JOIN n ON n.a = r
"""

_OP2 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (SELECT min(r) AS n, min(doc_id) AS class_id, count(*) AS copies, text, any_value(words) AS words FROM d WHERE len(words) > 0 GROUP BY text),
s AS (SELECT DISTINCT n, array_to_string(words[p : p + 4], ' ') AS gram FROM t, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS g(p)),
size AS (SELECT n, count(*) AS k FROM s GROUP BY n),
pairs_ AS (SELECT a.n AS a, b.n AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.n <> b.n GROUP BY 1, 2),
links AS (SELECT p.a, p.b, copies FROM pairs_ p JOIN size x ON x.n = p.a JOIN size y ON y.n = p.b JOIN t ON t.n = p.b WHERE shared >= 0.8 * (x.k + y.k - shared) - 1e-9),
reach AS (SELECT n AS a, n AS b FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT reach.a, min(class_id) AS component_id FROM reach JOIN t ON t.n = reach.b GROUP BY reach.a),
near AS (SELECT a, sum(copies) AS n FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(component_id, doc_id) AS component_id,
  CAST(coalesce(near.n, 0) + coalesce(t.copies, 1) - 1 AS BIGINT) AS n_links, doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN t ON t.text = d.text AND len(d.words) > 0 LEFT JOIN low ON low.a = t.n LEFT JOIN near ON near.a = t.n
"""

_OP3 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), t AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS size FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + size + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_OP5 = """
WITH n AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
r AS (SELECT source, (1.0 / (SELECT count(*) FROM n)) * (SELECT count(*) FROM documents) / docs AS rate FROM n),
p AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
      FROM r, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT))) AS g(k)),
d AS (SELECT doc_id, source, (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'none')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents)
SELECT d.doc_id, d.source, CAST(p.k AS INTEGER) AS copy FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND p.upto < d.u
"""

_OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS win FROM w, unnest(range(1, greatest(len(words) - 1, 1))) AS g(p)),
twice AS (SELECT r, p FROM win QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT p + o) AS n FROM twice, unnest([0, 1, 2]) AS g(o) GROUP BY r),
m AS (
  SELECT w.r, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(words, lambda x: length(x) > 20)) AS n_long_words
  FROM w LEFT JOIN rep ON rep.r = w.r
), q AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_symbols / nullif(word_chars, 0) AS symbols, n_dup_lines / nullif(n_lines, 0) AS dup_lines,
    n_repeat_words / nullif(n_words, 0) AS repeats, word_chars / nullif(n_words, 0) AS word_length, n_long_words / nullif(n_words, 0) AS long_words FROM m
), g AS (
  SELECT lang, source, {ranks} FROM q WHERE NOT base_failed GROUP BY lang, source
), wide AS (
  SELECT lang, {ranks} FROM q WHERE NOT base_failed GROUP BY lang
), s AS (
  SELECT g.*, {spreads} FROM g JOIN wide ON g.lang IS NOT DISTINCT FROM wide.lang
), f AS (
  SELECT lang, source, {ends} FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({outside}) AS kept
FROM q LEFT JOIN f ON q.lang IS NOT DISTINCT FROM f.lang AND q.source IS NOT DISTINCT FROM f.source
""".format(
    ranks=", ".join(f"quantile_disc({m}, [0.1, 0.25, 0.75, 0.9]) AS {m}_q" for m in adaptive_rules.MEASURES),
    spreads=", ".join(
        f"4.0 * CASE WHEN g.{m}_q[3] > g.{m}_q[2] THEN g.{m}_q[3] - g.{m}_q[2] WHEN g.{m}_q[4] > g.{m}_q[1] THEN g.{m}_q[4] - g.{m}_q[1] "
        f"WHEN wide.{m}_q[4] > wide.{m}_q[1] THEN wide.{m}_q[4] - wide.{m}_q[1] ELSE 0.0 END AS {m}_s" for m in adaptive_rules.MEASURES),
    ends=", ".join(f"greatest({m}_q[2] - {m}_s, 0.0) AS {m}_low, {m}_q[3] + {m}_s AS {m}_high" for m in adaptive_rules.MEASURES),
    outside=" OR ".join(
        f"coalesce({n} > {m}_high * {of} + 3.0 * sqrt({grain} * ({m}_high * {of} + {grain})) OR {n} < {m}_low * {of} - 3.0 * sqrt({grain} * ({m}_low * {of} + {grain})), false)"
        for m, (n, of, grain) in adaptive_rules.MEASURES.items()),
)

SQL: dict[str, str] = {
    "op1_lattice_links": _OP1, "op2_chosen_path_join": _OP2, "op3_chat_fold": _OP3, "op5_poisson_mix": _OP5, "op6_adaptive_rules": _OP6,
    **manifest_queries.SQL,
}
