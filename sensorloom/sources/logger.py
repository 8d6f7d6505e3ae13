"""Logger text files: one header line to skip, a name line, two lines of units, comma-separated records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.columns import minute_stamp, path_key
from sensorloom.session import written

TIME = "TIMESTAMP"
# Names the tiers use for the logger's housekeeping fields.
RENAMES = {
    "RECORD": "Record_Number",
    "Panel_Temperature_Avg": "Panel_Temperature",
    "Big_Battery_Voltage_Min": "Big_Battery_Voltage",
    "Small_Battery_Voltage_Min": "Small_Battery_Voltage",
}


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of the files with the path they come from and where their part of the file begins."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value"))


def name_lines(lines: DataFrame) -> DataFrame:
    """(path, names): the line of field names of each file, which stands in its first part."""
    unquoted = F.regexp_replace("value", '"', "")
    top = lines.where(F.col("block") == 0) if "block" in lines.columns else lines
    found = top.where(unquoted.startswith(TIME + ",")).select("path", F.split(unquoted, ",").alias("names"))
    return found.select("path", F.transform("names", lambda n: F.trim(n)).alias("names")).groupBy("path").agg(F.min("names").alias("names"))


def layouts(heads: DataFrame) -> list[list[str]]:
    """The different lists of field names: one row per layout, not per file, reaches the driver."""
    found = sorted(r["names"] for r in heads.select("names").distinct().collect())
    if not found:
        raise ValueError("expected logger files, found no line of field names")
    return found


def header_names(lines: DataFrame) -> list[str]:
    """Field names of files that share one layout."""
    found = layouts(name_lines(lines))
    if len(found) != 1:
        raise ValueError("expected one layout of logger fields, found several")
    return found[0]


def parse_lines(lines: DataFrame, names: Sequence[str], keep: Sequence[str] = ("path",), dedupe: bool = True) -> DataFrame:
    """Records of logger lines: header lines out, exact duplicates out, time parsed, all other fields numbers.

    Header lines are told by their first field, so files may be split at any line.
    'NAN', empty and unreadable fields are missing; a record whose time cannot be
    read keeps a missing time.
    """
    first = F.trim(F.regexp_replace(F.split("value", ",", 2).getItem(0), '"', ""))
    body = lines.where(~first.isin("TOA5", TIME, "TS", ""))
    if dedupe:
        body = body.dropDuplicates([*keep, "value"])
    record = F.from_csv("value", _ddl(names), {"nullValue": "NAN", "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    d = body.select(*keep, record.alias("_r")).select(*keep, "_r.*")
    return d.withColumn(TIME, minute_stamp(TIME)).withColumnRenamed(TIME, "Timestamp").select(
        *keep, "Timestamp", *[f"`{n}`" for n in names if n != TIME]
    )


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {'STRING' if n == TIME else 'DOUBLE'}" for n in names)


def read_logger(spark: SparkSession, path: str | Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Read logger files. Names are taken from the first part of each file unless given.

    Files of different layouts are united by name; fields that a file lacks are missing. The names are written to the scratch folder.
    """
    lines = read_lines(spark, path)
    if names:
        return parse_lines(lines, names)
    heads = written(name_lines(lines), "names")
    found = layouts(heads)
    if len(found) == 1:
        return parse_lines(lines, found[0])
    # Files and their names meet as tables; each layout parses the lines of its files.
    known = lines.join(heads, "path")
    parts = [parse_lines(known.where(F.col("names") == F.array(*[F.lit(n) for n in fields])), fields) for fields in found]
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def format_logger(df: DataFrame, tree: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Tree first, no NaN, housekeeping fields renamed. ``keep`` may name the path."""
    tree = path_key("path") if tree is None else tree
    fields = [c for c in df.columns if c not in ("path", "Timestamp")]
    nan = F.lit(float("nan"))
    return df.select(tree.alias("Tree"), "Timestamp", *[F.nullif(F.col(f"`{c}`"), nan).alias(RENAMES.get(c, c)) for c in fields], *keep)
