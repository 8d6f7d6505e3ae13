"""Mixing sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.joins import salted_join
from sensorloom.session import written

# Hexadecimal digits of an MD5 that make a uniform number: 52 bits, exact in a double.
_DIGITS = 13


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from a hash of the seed and the parts; the same in every run and on every machine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("none")) for p in parts]))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(16**_DIGITS)


def poisson_quantile(u: Column, mean: Column) -> Column:
    """The smallest count whose cumulative probability reaches ``u``.

    The probabilities are summed up to twelve deviations above the mean and twenty more,
    beyond which less than 2**-53 of the mass lies, less than ``u`` can tell apart from one.
    """
    top = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("upto"), F.lit(0).alias("n"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["upto"] + p).alias("upto"), (s["n"] + (s["upto"] < u).cast("int")).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), top), start, step)["n"]


def rates(docs: DataFrame, weights: DataFrame | None, source_col: str = "source", total: float | None = None) -> DataFrame:
    """(``source_col``, ``rate``): the mean number of times that a document of a source is repeated.

    ``weights`` has ``source_col`` and ``weight``; weights need not sum to one. Without
    it every source has the same weight. ``total`` is the wanted number of documents (as many as there are).
    Sources without a weight get the rate 0, and weights of absent sources are left out
    before they are brought to a sum of one. A null source is a source of its own.
    A rate may not exceed 600, where exp(-rate) nears the smallest double: ask for less of a source, or chain two mixes.
    """
    counts = docs.groupBy(source_col).agg(F.count(F.lit(1)).alias("docs"))
    if weights is None:
        counts = counts.withColumn("weight", F.lit(1.0))
    else:
        named = weights.select(F.col(source_col).alias("_named"), F.col("weight").cast("double").alias("weight"))
        counts = counts.join(named, F.col(source_col).eqNullSafe(F.col("_named")), "left").drop("_named")
    counts = counts.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    weight = counts.agg(F.sum("weight")).scalar()
    wanted = counts.agg(F.sum("docs")).scalar() if total is None else F.lit(float(total))
    rate = F.when(weight > 0, F.col("weight") / weight * wanted / F.col("docs")).otherwise(0.0)
    over = F.raise_error(F.concat(F.lit("rate above 600 for source "), F.coalesce(F.col(source_col).cast("string"), F.lit("null"))))
    return counts.select(source_col, F.when(rate > 600, over.cast("double")).otherwise(rate).alias("rate"))


def poisson_mix(
    docs: DataFrame, weights: DataFrame | None = None, *, id_col: str = "doc_id", source_col: str = "source", total: float | None = None, seed: int = 17,
) -> DataFrame:
    """The columns of ``docs`` and ``_copy`` (0, 1, ...): every row as often as its Poisson count says, in a random order.

    A row's count inverts the Poisson distribution with its source's rate (see ``rates``)
    at a hash of seed and id, so a run that is repeated gives the same rows. Rows with the same id get the same count;
    a null id is hashed as "none". Empty texts are documents like others. An empty table gives an empty result.
    The order is that of a hash of id and copy: rows are dealt over partitions by that hash and sorted by it inside.
    No row is dealt by its source: the rates are written, and up to a hundred thousand of them, which are counted first, go to
    all rows as they lie; beyond that the rows of a source with many are spread by their ids. Columns that are called like
    those in use here raise an error.
    """
    clash = {"_copy", "_n", "_rate", "_order", "_key", "_salt"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns in use: {sorted(clash)}")
    r = rates(docs, weights, source_col, total).select(_key(source_col), F.col("rate").alias("_rate"))
    r = written(r, "rates")
    d = docs.withColumn("_key", _key(source_col))
    d = d.join(F.broadcast(r), "_key", "left") if r.count() <= _FEW else salted_join(d, r, ["_key"], id_col)
    d = d.withColumn("_n", poisson_quantile(uniform(seed, F.col(id_col)), F.coalesce("_rate", F.lit(0.0)))).where("_n > 0")
    d = d.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n", "_rate", "_key")
    d = d.withColumn("_order", uniform(seed + 1, F.col(id_col), F.col("_copy")))
    return d.repartition("_order").sortWithinPartitions("_order").drop("_order")


# So many rates, of fixed width, are a few megabytes.
_FEW = 100_000


def _key(source_col: str) -> Column:
    """A source as a key of fixed width, never null."""
    return F.coalesce(F.md5(F.col(source_col).cast("string")), F.lit("none")).alias("_key")
