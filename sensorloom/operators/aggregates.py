"""Summaries. All combine per task before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.config import EXCLUDED_STATION, SERIES, VELOCITIES
from sensorloom.functions.columns import floor_time, null_outside
from sensorloom.operators.joins import hot_keys, salted_join
from sensorloom.session import written


def station_mean(
    df: DataFrame,
    cols: Sequence[str] = ("Solar", "VPD", "Wetness"),
    keys: Sequence[str] = ("Tree", "Timestamp"),
    excluded: str | None = EXCLUDED_STATION,
) -> DataFrame:
    """Mean over stations, leaving one station out."""
    d = df if excluded is None else df.where(F.col("Station") != excluded)
    return d.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def covariate_mean(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("Timestamp",)) -> DataFrame:
    """Mean of each covariate per time, after exact duplicates are removed."""
    return df.select(*keys, *cols).distinct().groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def window_means(df: DataFrame, cols: Sequence[str] = VELOCITIES, keys: Sequence[str] = (*SERIES, "Group")) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def resample(df: DataFrame, unit: str, cols: Sequence[str] = VELOCITIES, keys: Sequence[str] = SERIES, time: str = "Timestamp") -> DataFrame:
    """Mean per series and hour, day or Sunday-based week; '15min' passes through."""
    if unit == "15min":
        return df.select(*keys, time, *cols)
    return df.groupBy(*keys, floor_time(df, time, unit).alias(time)).agg(*[F.avg(c).alias(c) for c in cols])


def summary_table(df: DataFrame, cols: Sequence[str] = VELOCITIES, keys: Sequence[str] = SERIES) -> DataFrame:
    """min, mean, max, total and max - min of each measure, one row per series and measure.

    A measure without any value has a missing total too.
    """
    stats = [
        F.struct(
            F.lit(c).alias("measure"), F.min(c).alias("min"), F.avg(c).alias("mean"),
            F.max(c).alias("max"), F.sum(c).alias("total"),
        ) for c in cols
    ]
    d = df.groupBy(*keys).agg(F.array(*stats).alias("_s")).select(*keys, F.explode("_s").alias("_s"))
    return d.select(*keys, "_s.*").withColumn("Change", F.col("max") - F.col("min"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def extent(df: DataFrame, keys: Sequence[str] = ("Tree",), time: str = "Timestamp") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("first"), F.max(time).alias("last"))


def missing_counts(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows, and missing values per column."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in cols]
    )


def pairwise_corr(df: DataFrame, target: str, candidates: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of the target with each candidate over the rows where both are present.

    One row per key and candidate; missing where fewer than two pairs or no variation.
    """
    stats = [
        F.struct(F.lit(c).alias("Sensor"), correlation(target, c).alias("corr"), _pairs(target, c).alias("pairs"))
        for c in candidates
    ]
    d = df.groupBy(*keys).agg(F.array(*stats).alias("_s")).select(*keys, F.explode("_s").alias("_s"))
    return d.select(*keys, "_s.*")


def _both(a: str, b: str) -> tuple[Column, Column]:
    x, y = F.col(a), F.col(b)
    return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)


def correlation(a: str, b: str) -> Column:
    """Over the rows where both are present; missing without variation."""
    x, y = _both(a, b)
    varied = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varied, F.corr(x, y))


def _pairs(a: str, b: str) -> Column:
    return F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())


def best_neighbour(corrs: DataFrame, keys: Sequence[str] = (), absolute: bool = False) -> DataFrame:
    """Candidate with the highest correlation (or absolute correlation); names break ties."""
    score = F.abs("corr") if absolute else F.col("corr")
    d = corrs.where(F.col("corr").isNotNull())
    order = F.struct((-score).alias("s"), F.col("Sensor").alias("n"))
    return d.groupBy(*keys).agg(F.min_by("Sensor", order).alias("Sensor"), F.min_by("corr", order).alias("corr"))


def r_squared(df: DataFrame, observed: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.pow(correlation(observed, predicted), F.lit(2.0)).alias("r2"))


def quantiles(df: DataFrame, col: str, probs: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10000, most: int = 100_000) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key and probability.

    Spark's exact ``percentile`` holds all distinct values of a group in one task. Here each wanted rank has a bracket, which at first
    holds the whole group. A mergeable histogram of what is inside, of equal shares with a rank error of at most 1 / ``accuracy``, names
    the few shares that the rank lies in, and these are the next bracket, until none holds more than ``most`` rows between its
    borders; rows below are only counted. What is left, copies of a value as one row, is ranked, so no task ranks more
    than ``most`` values and the borders. Keys and values are written to the scratch folder; a round reads them twice and leaves one row in fifty or fewer.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    by = keys or ["_all"]
    d = (df if keys else df.withColumn("_all", F.lit(1))).where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("_v"))
    d = written(d, "values")
    salts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.lit(d.sparkSession.range(1).select(hot_keys(d.select(*by), by, salts)).first()[0]).cast("array<bigint>")
    shares = [k / _SHARES for k in range(_SHARES + 1)]
    slack = 1 + 2 * _SHARES // accuracy
    places = [F.get("_w", F.lit(i)) for i in range(len(probs))]
    within = [(F.col("_v") > w["lo"]) & (F.col("_v") < w["hi"]) for w in places]

    def wide(w: Column) -> Column:
        return w["n"] > most

    def counted(brackets: DataFrame) -> DataFrame:
        """Brackets with the rows below them, at their lower border and inside."""
        placed = salted_join(d, written(brackets, "cuts"), by, "_v", "inner", hot=hot)
        return written(placed.groupBy(*by).agg(F.array(*[
            F.struct(*[F.first(w[c]).alias(c) for c in ("p", "lo", "hi", "total")], F.count_if(F.col("_v") < w["lo"]).alias("below"),
                     F.count_if(F.col("_v") <= w["lo"]).alias("upto"), F.count_if(x).alias("n")) for w, x in zip(places, within)
        ]).alias("_w")), "brackets")

    # The first bracket is open, as missing numbers rank as the largest, and the same for all ranks: one histogram serves them.
    first = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", shares, accuracy).alias("_cuts"))
    whole = F.array(*[F.struct(
        F.lit(p).alias("p"), F.lit(float("-inf")).alias("lo"), F.lit(float("nan")).alias("hi"), F.col("_n").alias("total"), F.lit(0).cast("long").alias("upto"), F.col("_n").alias("n"),
    ) for p in probs])
    state = counted(first.select(*by, F.transform(whole, lambda w: _narrower(w, F.col("_cuts"), slack)).alias("_w")))
    while not state.where(F.exists("_w", wide)).isEmpty():
        placed = salted_join(d, state, by, "_v", "inner", hot=hot)
        cuts = placed.groupBy(*by).agg(F.first("_w").alias("_w"), F.array(*[F.percentile_approx(F.when(x & wide(w), F.col("_v")), shares, accuracy) for w, x in zip(places, within)]).alias("_cuts"))
        narrow = F.transform(F.arrays_zip(F.col("_w").alias("w"), F.col("_cuts").alias("cuts")), lambda z: F.when(wide(z["w"]), _narrower(z["w"], z["cuts"], slack)).otherwise(z["w"]))
        state = counted(cuts.select(*by, narrow.alias("_w")))
    placed = salted_join(d, state, by, "_v", "inner", hot=hot)
    inside = [F.col("_v").between(w["lo"], w["hi"]) for w in places]
    near = placed.select(*by, "_v", F.explode(F.array_compact(F.array(*[F.when(x, F.lit(i)) for i, x in enumerate(inside)]))).alias("_i"))
    near = near.groupBy(*by, "_i", "_v").agg(F.count(F.lit(1)).alias("_k"))
    upto = Window.partitionBy(*by, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    wanted = state.select(*by, F.posexplode("_w").alias("_i", "_b")).select(*by, "_i", F.col("_b.p").alias("_p"), F.col("_b.below").alias("_below"), F.col("_b.total").alias("_total"))
    near = near.withColumn("_to", F.sum("_k").over(upto)).join(wanted, [*by, "_i"], "inner")

    exact = (F.col("_total") - 1) * F.col("_p")
    end = F.col("_below") + F.col("_to")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < end) & (rank >= end - F.col("_k")), F.col("_v")))

    lower, upper = at(F.floor(exact)), at(F.ceil(exact))
    fraction = F.max(exact - F.floor(exact))
    out = near.groupBy(*by, "_i", F.col("_p").alias("prob")).agg(F.when(lower == upper, lower).otherwise(lower + (upper - lower) * fraction).alias("value"))
    return out.select(*keys, "prob", "value")


# Shares of a bracket's histogram.
_SHARES = 256


def _narrower(w: Column, cuts: Column, slack: int) -> Column:
    """The bracket cut down to the shares beside those with the wanted ranks; its borders are single values and not counted inside."""
    rank = (w["total"] - 1) * w["p"] - w["upto"]
    low = F.floor(rank / w["n"] * _SHARES).cast("int") - slack
    high = F.ceil((rank + 1) / w["n"] * _SHARES).cast("int") + slack
    # Beyond the outermost shares the bracket keeps its own borders.
    lo = F.when(low <= 0, w["lo"]).otherwise(F.get(cuts, F.least(low, F.lit(_SHARES))))
    hi = F.when(high >= _SHARES, w["hi"]).otherwise(F.get(cuts, F.greatest(high, F.lit(0))))
    return w.withField("lo", lo).withField("hi", hi)


def trim_percentile(df: DataFrame, lower: float, upper: float, cols: Sequence[str] = VELOCITIES, keys: Sequence[str] = ("Tree",), spread_by: str = "Timestamp") -> DataFrame:
    """Values outside their column's [lower, upper] percentiles become missing."""
    long = df.unpivot(list(keys), list(cols), "_col", "_v")
    q = quantiles(long, "_v", [lower, upper], [*keys, "_col"])
    bounds = q.groupBy(*keys).agg(*[
        F.max(F.when((F.col("_col") == c) & (F.col("prob") == F.lit(float(p))), F.col("value"))).alias(f"_{side}_{c}")
        for c in cols for side, p in (("lo", lower), ("hi", upper))
    ])
    d = salted_join(df, bounds, list(keys), spread_by)
    return d.select(*[null_outside(c, F.col(f"_lo_{c}"), F.col(f"_hi_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def battery_rate(df: DataFrame, since: str, keys: Sequence[str] = ("Tree",), col: str = "Big_Battery_Voltage", time: str = "Timestamp") -> DataFrame:
    """Length in days of the last battery block, and the voltage range per week of it."""
    d = df.where(F.col(time) >= F.lit(since).cast(df.schema[time].dataType))
    days = (F.unix_timestamp(F.max(time)) - F.unix_timestamp(F.min(time))) / F.lit(86400.0)
    return d.groupBy(*keys).agg(days.alias("days"), F.try_divide(F.max(col) - F.min(col), days / 7).alias("volts_per_week"))
