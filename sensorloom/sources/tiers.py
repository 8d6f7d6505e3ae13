"""Tier tables: read, write, append, replace, export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.config import SPAN_SECONDS
from sensorloom.functions.columns import iso_stamp, stamp_text
from sensorloom.operators.filters import filter_cable_prefix, filter_date_range
from sensorloom.session import scratch_dir


def scan_tier(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a tier table or a folder of them. CSV needs a schema: types are never guessed."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV tables need a schema")
        reader = reader.option("header", "true").option("nullValue", "NA").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]['Z']")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan_dir_union(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", distinct: bool = True) -> DataFrame:
    """All files of a folder as one table, exact duplicates removed."""
    d = scan_tier(spark, path, schema, fmt)
    return d.distinct() if distinct else d


def typed_sheet_scan(spark: SparkSession, path: str, columns: dict[str, str | None], fmt: str = "csv") -> DataFrame:
    """Read a sheet export with declared types; columns declared ``None`` are skipped."""
    ddl = ", ".join(f"`{n}` {kind or 'STRING'}" for n, kind in columns.items())
    d = spark.read.format(fmt).option("header", "true").schema(ddl).load(path)
    return d.select(*[n for n, kind in columns.items() if kind])


def laid_out(df: DataFrame, by: Sequence[str] = ("Tree",), time: str = "Timestamp", order: Sequence[str] = ("Tree", "Cable", "Timestamp"), span: int = SPAN_SECONDS) -> DataFrame:
    """Rows placed by key and piece of time: a long series is written by many tasks, each to few folders."""
    placed = df.repartition(*[F.col(c) for c in by], F.floor(F.unix_timestamp(time) / F.lit(span)))
    return placed.sortWithinPartitions(*[c for c in order if c in df.columns])


def write_tier(df: DataFrame, path: str, by: Sequence[str] = ("Tree",), mode: str = "overwrite", time: str = "Timestamp") -> None:
    """Write a tier partitioned by key; overwriting replaces only the keys in ``df``. See ``empty_keys`` for keys without rows."""
    laid_out(df, by, time).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def empty_keys(spark: SparkSession, path: str, by: str, processed: Sequence[str], filled: Sequence[str]) -> None:
    """Remove the folders of processed keys that have no rows any more, which an overwrite leaves as they are."""
    jvm = spark._jvm
    for value in sorted(set(processed) - set(filled)):
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{by}={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def keys_of(df: DataFrame, by: str = "Tree") -> list[str]:
    """The keys that have rows: one text per tree, not per row."""
    return [r[0] for r in df.select(F.col(by).cast("string")).distinct().collect()]


def append_raw(df: DataFrame, path: str, by: Sequence[str] = ("Tree",)) -> None:
    """Add new rows without reading the table."""
    write_tier(df, path, by, "append")


def replace_keys(df: DataFrame, path: str, processed: Sequence[str] | None = None, by: str = "Tree") -> None:
    """Overwrite keys of the very table ``df`` was read from, by way of a written copy.

    ``processed`` are the keys whose rows ``df`` is meant to hold; those without any are emptied. A run that ends half way
    leaves each key old or new, and is repeated as it was: it reads the keys it has replaced as their own result.
    """
    staging = scratch_dir(df.sparkSession, "staging")
    laid_out(df, (by,)).write.partitionBy(by).parquet(staging)
    staged = df.sparkSession.read.schema(df.schema).parquet(staging)
    write_tier(staged, path, (by,))
    if processed is not None:
        empty_keys(df.sparkSession, path, by, processed, keys_of(staged, by))


def write_flags(df: DataFrame, path: str, processed: Sequence[str] | None = None) -> None:
    """Write flag rows; only the trees at hand are replaced, and ``processed`` trees without flags are emptied. ``df`` should be a table."""
    write_tier(df, path)
    if processed is not None:
        empty_keys(df.sparkSession, path, "Tree", processed, keys_of(df))


# --- export ---------------------------------------------------------------

def slice_tier(df: DataFrame, start: str, end: str, tree: str | None = None, cable: str | None = None, time: str = "Timestamp") -> DataFrame:
    """One cable, one tree or all trees in a date range; everything reaches the scan as a filter."""
    d = filter_date_range(df, start, end, time)
    if tree is not None:
        d = d.where(F.col("Tree") == tree)
    return d if cable is None else filter_cable_prefix(d, cable)


def export_slice(df: DataFrame, style: str = "iso", time: str = "Timestamp") -> DataFrame:
    """Times as ISO text or as plain text for spreadsheets."""
    styles = {"iso": iso_stamp, "text": stamp_text}
    if style not in styles:
        raise ValueError(f"style must be one of {sorted(styles)}")
    return df.withColumn(time, styles[style](time))


def export_name(amount: str, start: str, end: str, tree: str | None = None) -> str:
    """File name of an export: tree and amount, or AllTrees, then the two dates."""
    who = "AllTrees" if amount == "All_trees" else f"{tree}_{amount}"
    return f"{who}_{start[:10]}_{end[:10]}.csv"


def write_export(df: DataFrame, path: str, single_file: bool = False, order: Sequence[str] = ("Tree", "Cable", "Timestamp")) -> None:
    """Write CSV in time order, split over tasks; a single file only for slices known to be small."""
    by = [c for c in order if c in df.columns]
    out = df.orderBy(*by)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").option("header", "true").csv(path)
