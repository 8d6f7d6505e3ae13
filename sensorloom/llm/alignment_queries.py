"""The alignment of two tokenizers as a query. SQL has no tokenizers."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import alignment

TOKENIZERS = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return alignment.align(docs, *[public_tokenizers.path(t) for t in TOKENIZERS], digest=True).withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op11_pair_bitmaps": pair_bitmaps}
