"""Scalar functions by family."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.catalog.registry import R, query, r6
from sensorloom.catalog.views import Tables
from sensorloom.functions import columns as C


@query("fn_string", """SELECT doc_id, lang || '_' || source AS joined, length(text) AS n, text[1:3] AS head, text[-2:] AS tail, contains(text, 'the') AS has_the,
  replace(text, 'a', '') AS removed, split_part(text, ' ', 1) AS first_word, starts_with(lower(text), 't') AS starts FROM documents""")
def _(t: Tables):
    text = F.col("text")
    return t.table("documents").select(
        "doc_id", F.concat_ws("_", "lang", "source").alias("joined"), F.length(text).cast("long").alias("n"), F.substring(text, 1, 3).alias("head"),
        F.right(text, F.lit(2)).alias("tail"), text.contains("the").alias("has_the"), F.replace(text, F.lit("a"), F.lit("")).alias("removed"),
        C.first_piece("text", " ").alias("first_word"), F.startswith(F.lower(text), F.lit("t")).alias("starts"),
    )


@query("fn_datetime", """SELECT event_id, date_trunc('hour', ts) AS h, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d, CAST(date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY AS TIMESTAMP) AS w,
  CAST(hour(ts) AS INTEGER) AS hh, CAST(minute(ts) AS INTEGER) AS mi, CAST(ts AS DATE) AS day, ts + INTERVAL 15 MINUTE AS later, ts - INTERVAL 7 DAY AS earlier,
  CAST(floor(epoch(ts)) AS BIGINT) AS secs, strftime(ts, '%Y-%m-%d %H:%M:%S') AS txt, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, date_trunc('minute', ts) AS parsed FROM events""")
def _(t: Tables):
    d = t.events
    return d.select(
        "event_id", C.floor_time(d, "ts", "hour").alias("h"), C.floor_time(d, "ts", "day").alias("d"), C.floor_time(d, "ts", "week").alias("w"),
        F.hour("ts").alias("hh"), F.minute("ts").alias("mi"), F.to_date("ts").alias("day"), C.shift("ts", 900).alias("later"), C.shift("ts", -7 * 86400).alias("earlier"),
        C.seconds("ts").alias("secs"), C.stamp_text("ts").alias("txt"), C.iso_stamp("ts").alias("iso"),
        C.minute_stamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
    )


@query("stamp_text", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS txt, CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00' AS TIMESTAMP) AS at_ten FROM orders""")
def _(t: Tables):
    return t.table("orders").select("o_orderkey", C.stamp_text("o_orderdate").alias("txt"), C.midday_note_stamp(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("at_ten"))


@query("fn_math", f"""SELECT event_id, {R('ln(value)')} AS ln, round(value, 1) AS r1, abs(value - 50) AS dist, {R('pow(value, 2)')} AS sq, {R('value / 7')} AS per_week,
  least(value, 50) AS lo, greatest(value, 50) AS hi FROM events""")
def _(t: Tables):
    v = F.col("value")
    return t.events.select(
        "event_id", r6(F.ln(v)).alias("ln"), F.round(v, 1).alias("r1"), F.abs(v - 50).alias("dist"), r6(F.pow(v, F.lit(2.0))).alias("sq"),
        r6(v / 7).alias("per_week"), F.least(v, F.lit(50.0)).alias("lo"), F.greatest(v, F.lit(50.0)).alias("hi"),
    )


@query("fn_conditional", """SELECT event_id, CASE WHEN value < 20 THEN NULL ELSE value END AS kept, coalesce(CASE WHEN value < 20 THEN NULL ELSE value END, 0) AS filled,
  event_type IN ('click', 'view') AS listed, CASE WHEN value < 20 THEN 'low' WHEN value < 80 THEN 'mid' ELSE 'high' END AS band FROM events""")
def _(t: Tables):
    v = F.col("value")
    kept = F.when(v >= 20, v)
    return t.events.select(
        "event_id", kept.alias("kept"), F.coalesce(kept, F.lit(0.0)).alias("filled"), F.col("event_type").isin("click", "view").alias("listed"),
        F.when(v < 20, "low").when(v < 80, "mid").otherwise("high").alias("band"),
    )


@query("fn_cast", """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_no, TRY_CAST(p_name AS DOUBLE) AS junk, CAST(p_size AS VARCHAR) AS size_text,
  CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS number FROM part""")
def _(t: Tables):
    return t.table("part").select(
        "p_partkey", C.to_number(F.split("p_brand", "#").getItem(1)).alias("brand_no"), C.to_number("p_name").alias("junk"),
        F.col("p_size").cast("string").alias("size_text"), C.cable_number("p_brand").alias("number"),
    )


@query("fn_array", """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(list_sort(embedding)[1] AS DOUBLE) AS smallest, CAST(list_reverse(embedding)[1] AS DOUBLE) AS last,
  CAST(len(list_distinct(embedding)) AS INTEGER) AS different, CAST(len(range(0, label + 1)) AS INTEGER) AS steps FROM embeddings""")
def _(t: Tables):
    e = F.col("embedding")
    return t.table("embeddings").select(
        "vec_id", F.size(e).alias("n"), F.get(F.array_sort(e), F.lit(0)).cast("double").alias("smallest"), F.get(F.reverse(e), F.lit(0)).cast("double").alias("last"),
        F.size(F.array_distinct(e)).alias("different"), F.size(F.sequence(F.lit(0), F.col("label"))).alias("steps"),
    )


@query("path_key", """SELECT vec_id, 'ET' || label AS Tree FROM embeddings""")
def _(t: Tables):
    path = F.concat(F.lit("/data/import/AB9/ET"), F.col("label"), F.lit("_Data_Table.dat"))
    return t.table("embeddings").select("vec_id", C.path_key(path).alias("Tree"))
