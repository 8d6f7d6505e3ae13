"""Language identification as a query. Its filters are learned and hashed, which SQL can't express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import language_filters


def remainder() -> Column:
    """Of the checksum of a document's id by three; null for a null id, which is neither learned nor held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text", "lang")
    filters = language_filters.train(docs, remainder() != 1)
    d = language_filters.predict(docs, filters)
    return d.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op12_language_filters": languages}
