"""A corpus pipeline: toxic documents out, near copies out, personal data masked, sources mixed, tokens packed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import chosen_path, packing, pii, poisson_mix, queries, string_kernel
from sensorloom.session import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string kernel predicts to be toxic go; labels of held-out documents are never learned."""
    return string_kernel.clean(docs, queries.toxicity_model(spark, docs, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return chosen_path.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    return pii.redacted(docs, length_col="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources at the same weight; a document stands as often as its count says."""
    return poisson_mix.poisson_mix(docs).drop("_copy")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences; a document that stands several times is packed as often."""
    return packing.pack(docs, public_tokenizers.path(queries.TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("near_copies", near_copies), ("personal_data", personal_data), ("mixed", mixed), ("packed", packed),
]

#: The stages learn, hash to lattices of words and tokenize, which SQL can't.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
