"""Regressions and the gap filling built on them.

Least squares is expressed in mergeable moments, so a model per series, gap or
tree is one grouped aggregate over all of them at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.config import SPAN_SECONDS, STEP_SECONDS, VELOCITIES
from sensorloom.functions.columns import all_missing, shift
from sensorloom.operators.aggregates import correlation
from sensorloom.operators.joins import neighbour_join, salted_join
from sensorloom.operators.ordered import last_known, ordered, running
from sensorloom.operators.series import gap_context
from sensorloom.session import scratch_dir, written

# Training rows of a forest in one task; every task has statistics of its own for the nodes being split, so there should be few.
TRAIN_ROWS = 50_000


def ols_pair(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope and intercept of y ~ x over complete rows."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def predict_pair(df: DataFrame, model: DataFrame, x: str, keys: Sequence[str], spread_by: str = "Timestamp", name: str = "yhat") -> DataFrame:
    """Prediction on every row that has x."""
    d = salted_join(df, model, list(keys), spread_by)
    return d.withColumn(name, F.col("intercept") + F.col("slope") * F.col(x)).drop("slope", "intercept")


def gap_fill_simple(df: DataFrame, y: str, x: str, keys: Sequence[str] = ("Tree",), spread_by: str = "Timestamp") -> DataFrame:
    """Fit y ~ x and predict all rows."""
    return predict_pair(df, ols_pair(df, y, x, keys), x, keys, spread_by)


def _hour_moments(df: DataFrame, y: str, x: str, keys: Sequence[str], time: str) -> DataFrame:
    d = df.where(F.col(y).isNotNull() & F.col(x).isNotNull()).withColumn("Hour", F.hour(time))
    n = F.count(F.lit(1))
    return d.groupBy(*keys, "Hour").agg(
        n.alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"),
        (F.var_pop(x) * n).alias("sxx"), (F.var_pop(y) * n).alias("syy"), (F.covar_pop(x, y) * n).alias("sxy"),
    )


def ols_hour_factor(df: DataFrame, y: str, x: str, keys: Sequence[str] = (), time: str = "Timestamp") -> DataFrame:
    """y ~ x + factor(hour of day): the common slope and the intercept of each hour."""
    m = _hour_moments(df, y, x, keys, time)
    if not keys:
        m = m.withColumn("_all", F.lit(1))
    by = list(keys) or ["_all"]
    slope = m.groupBy(*by).agg(F.try_divide(F.sum("sxy"), F.sum("sxx")).alias("slope"))
    d = m.join(slope, by, "inner")
    return d.select(*keys, "Hour", "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"))


def hour_factor_anova(df: DataFrame, y: str, x: str, keys: Sequence[str] = (), time: str = "Timestamp") -> DataFrame:
    """Sequential sums of squares of y ~ x + factor(hour): terms x, hour, residuals."""
    m = _hour_moments(df, y, x, keys, time)
    n = F.sum("n")
    # Within plus between sums give those around the overall mean.
    mean_x, mean_y = F.sum(F.col("n") * F.col("mx")) / n, F.sum(F.col("n") * F.col("my")) / n
    totals = m.groupBy(*keys).agg(
        n.alias("n"), F.count(F.lit(1)).alias("hours"),
        F.sum("sxx").alias("wxx"), F.sum("sxy").alias("wxy"), F.sum("syy").alias("wyy"),
        mean_x.alias("_gx"), mean_y.alias("_gy"),
        (F.sum(F.col("n") * F.col("mx") * F.col("mx")) - n * mean_x * mean_x).alias("bxx"),
        (F.sum(F.col("n") * F.col("mx") * F.col("my")) - n * mean_x * mean_y).alias("bxy"),
        (F.sum(F.col("n") * F.col("my") * F.col("my")) - n * mean_y * mean_y).alias("byy"),
    )
    t = totals.withColumns({"txx": F.col("wxx") + F.col("bxx"), "txy": F.col("wxy") + F.col("bxy"), "tyy": F.col("wyy") + F.col("byy")})
    t = t.withColumn("ss_x", F.try_divide(F.col("txy") * F.col("txy"), F.col("txx")))
    # Without variation of x within the hours, x is a combination of the hour terms and costs them one degree.
    extra = F.when(F.col("wxx") > 0, 1).otherwise(0)
    t = t.withColumn("ss_res", F.col("wyy") - F.coalesce(F.try_divide(F.col("wxy") * F.col("wxy"), F.col("wxx")), F.lit(0.0)))
    t = t.withColumns({
        "ss_hour": F.col("tyy") - F.col("ss_x") - F.col("ss_res"),
        "df_hour": F.col("hours") - 2 + extra, "df_res": F.col("n") - F.col("hours") - extra,
    })
    rows = F.array(
        F.struct(F.lit("x").alias("term"), F.lit(1).cast("long").alias("df"), F.col("ss_x").alias("sum_sq")),
        F.struct(F.lit("hour").alias("term"), F.col("df_hour").alias("df"), F.col("ss_hour").alias("sum_sq")),
        F.struct(F.lit("residuals").alias("term"), F.col("df_res").alias("df"), F.col("ss_res").alias("sum_sq")),
    )
    d = t.select(*keys, _mean_square("ss_res", "df_res").alias("_ms"), F.explode(rows).alias("_r")).select(*keys, "_ms", "_r.*")
    d = d.withColumn("mean_sq", _mean_square("sum_sq", "df"))
    f_value = F.when((F.col("term") != "residuals") & (F.col("_ms") > 0), F.col("mean_sq") / F.col("_ms"))
    return d.select(*keys, "term", "df", "sum_sq", "mean_sq", f_value.alias("f_value"))


def _mean_square(total: str, df: str) -> Column:
    """Missing without degrees of freedom."""
    return F.when(F.col(df) > 0, F.col(total) / F.col(df))


def ols_interaction(df: DataFrame, y: str, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """y ~ a + b + a:b over complete rows: the four coefficients.

    Three centred predictors leave a 3 x 3 system, solved per group by determinants.
    """
    d = df.where(F.col(y).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_ab", F.col(a) * F.col(b))
    p = (a, b, "_ab")
    pairs = {f"s{i}{j}": F.covar_pop(p[i], p[j]) for i in range(3) for j in range(i, 3)}
    cross = {f"c{i}": F.covar_pop(p[i], y) for i in range(3)}
    means = {f"m{i}": F.avg(p[i]) for i in range(3)} | {"my": F.avg(y)}
    m = d.groupBy(*keys).agg(*[c.alias(n) for n, c in (pairs | cross | means).items()])

    rows = [[F.col(f"s{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    right = [F.col(f"c{i}") for i in range(3)]
    whole = _det3(rows)
    m = m.withColumns({
        f"b{k}": F.try_divide(_det3([[right[i] if j == k else rows[i][j] for j in range(3)] for i in range(3)]), whole)
        for k in range(3)
    })
    intercept = F.col("my") - F.col("b0") * F.col("m0") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")
    return m.select(
        *keys, intercept.alias("intercept"), F.col("b0").alias(f"coef_{a}"), F.col("b1").alias(f"coef_{b}"), F.col("b2").alias("coef_interaction")
    )


def _det3(m: Sequence[Sequence[Column]]) -> Column:
    return (
        m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
        - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
        + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
    )


def predict_interaction(df: DataFrame, model: DataFrame, a: str, b: str, keys: Sequence[str], spread_by: str = "Timestamp", name: str = "pred") -> DataFrame:
    d = salted_join(df, model, list(keys), spread_by)
    value = (
        F.col("intercept") + F.col(f"coef_{a}") * F.col(a) + F.col(f"coef_{b}") * F.col(b)
        + F.col("coef_interaction") * F.col(a) * F.col(b)
    )
    return d.withColumn(name, value).drop("intercept", f"coef_{a}", f"coef_{b}", "coef_interaction")


def forest_regress(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], trees: int = 200, min_node: int = 5, depth: int = 30, bins: int = 128, seed: int = 222, name: str = "pred") -> DataFrame:
    """Random forest on complete rows; predictions for the test rows that have all predictors.

    Trees end at nodes of ``min_node`` rows, or at a depth of 30, the most that Spark allows: a leaf there may hold more rows, and
    predicts their mean. Splits are sought at ``bins`` quantiles of a predictor.

    A few bytes per row meet every tree at every level, so rows are dealt out by number, to all cores, and not packed by size. Each row
    keeps its node in every tree; where these are kept needs checkpoints, so a session without a folder for them gets one. Writes
    the training rows to the scratch folder.
    """
    spark = train.sparkSession
    cores, shuffled = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "forest"))
    stages = [
        VectorAssembler(inputCols=list(xs), outputCol="_x"),
        RandomForestRegressor(
            featuresCol="_x", labelCol=y, predictionCol=name, numTrees=trees, minInstancesPerNode=min_node, maxDepth=depth, maxBins=bins,
            seed=seed, cacheNodeIds=True,
        ),
    ]
    rows = written(train.dropna(subset=[y, *xs]).select(y, *xs), "training")
    model = Pipeline(stages=stages).fit(rows.repartition(max(cores, -(-rows.count() // TRAIN_ROWS))))
    return model.transform(test.dropna(subset=list(xs)).repartition(max(cores, shuffled))).drop("_x")


def train_test_split(df: DataFrame, keys: Sequence[str], seed: int = 222, parts: int = 4) -> tuple[DataFrame, DataFrame]:
    """Three of four parts to train on, by a hash of the row's key: the same rows on every run and layout."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % parts
    d = df.withColumn("_bucket", bucket)
    return d.where(F.col("_bucket") < parts - 1).drop("_bucket"), d.where(F.col("_bucket") == parts - 1).drop("_bucket")


def fill_from_best(
    tier: DataFrame,
    siblings: DataFrame,
    target: str = "outer_vel",
    cols: Sequence[str] = VELOCITIES,
    step: int = STEP_SECONDS,
    history: int = 7 * 86400,
    shortest: int = 1,
    min_pairs: int = 2,
    time: str = "Timestamp",
    span: int = SPAN_SECONDS,
) -> DataFrame:
    """Fill the gaps of every cable from the best correlated position of its sibling cable.

    For each gap (all measures missing, at least ``shortest`` rows) the ``history``
    before it is taken, the sibling's position with the highest correlation is
    chosen, and target ~ position is fitted there. Gives all tier rows with
    ``filled`` (observed values kept) and ``source``. ``siblings`` has (Tree, Cable,
    Sibling), at most one sibling per cable; a cable without one keeps its rows unfilled. Rows that miss only the target are no
    gap and stay as they are. A window begins after the latest row at or before ``history`` seconds and a step before its gap, so holes in the grid
    don't matter. Windows whose values vary by less than 1e-9 of their size count as constant. Writes the pairs and their sums to the scratch folder.

    The windows of close gaps overlap almost entirely, so they are not expanded:
    running sums of the centred pairs are kept along each series, and a window's
    moments are those at the gap less those one step before the window.
    """
    keys, xs, y = ["Tree", "Cable"], [f"{c}_sib" for c in cols], target
    twice = siblings.groupBy(*keys).count().where("count > 1").take(1)
    if twice:
        raise ValueError(f"cable {[twice[0][k] for k in keys]} has more than one sibling")
    other = tier.select("Tree", F.col("Cable").alias("Sibling"), time, *cols)
    d = neighbour_join(salted_join(tier, siblings, keys, time, "left"), other, cols, ("Tree", "Sibling", time))
    # Centred values keep the differences of long sums exact.
    centres = d.groupBy(*keys).agg(F.avg(y).alias("_c_y"), *[F.avg(x).alias(f"_c_{x}") for x in xs])
    d = written(salted_join(d, centres, keys, time), "pairs")

    sums = {}
    for x in xs:
        dy, dx = F.col(y) - F.col("_c_y"), F.col(x) - F.col(f"_c_{x}")
        both = dy.isNotNull() & dx.isNotNull()
        terms = {"n": F.lit(1.0), "x": dx, "y": dy, "xx": dx * dx, "yy": dy * dy, "xy": dx * dy}
        sums |= {f"_{m}_{x}": F.when(both, term) for m, term in terms.items()}
    gone = all_missing(*cols) == 1
    d = ordered(d, keys, time, span, _gap=last_known(F.when(~gone, F.col(time))), **{n: running(e) for n, e in sums.items()})
    d = d.withColumn("_gap", F.when(gone, F.coalesce("_gap", F.lit(0).cast("timestamp").cast(tier.schema[time].dataType))))
    d = written(d, "sums")

    # Inside a gap nothing is added, so any row of it holds the sums at its end.
    gaps = d.where(F.col("_gap").isNotNull()).groupBy(*keys, "_gap").agg(
        F.count(F.lit(1)).alias("_length"), F.min(time).alias("_first"), *[F.max(n).alias(n) for n in sums],
        F.max("_c_y").alias("_c_y"), *[F.max(f"_c_{x}").alias(f"_c_{x}") for x in xs],
    ).where(F.col("_length") >= shortest).withColumn(time, shift("_first", -history - step))
    # The sums before a window are the last known where a probe stands in the series.
    held = F.struct(*[F.col(n).alias(f"_before{n}") for n in sums])
    probes = gaps.select(*keys, time, F.lit(1).alias("_probe"), F.col("_gap"), F.lit(None).cast(d.select(held.alias("h")).schema["h"].dataType).alias("_held"))
    line = d.select(*keys, time, F.lit(0).alias("_probe"), F.lit(None).cast(tier.schema[time].dataType).alias("_gap"), held.alias("_held")).unionByName(probes)
    line = ordered(line, keys, [time, "_probe"], span, _held=last_known("_held")).where("_probe = 1")
    w = gaps.drop(time).join(line.select(*keys, "_gap", "_held"), [*keys, "_gap"]).select("*", "_held.*").drop("_held")
    moments = ("n", "x", "y", "xx", "yy", "xy")
    w = w.select(*keys, "_gap", "_c_y", F.inline(F.array(*[F.struct(
        F.lit(x).alias("source"), F.col(f"_c_{x}").alias("_c_x"),
        *[(F.col(f"_{m}_{x}") - F.coalesce(F.col(f"_before_{m}_{x}"), F.lit(0.0))).alias(m) for m in moments],
    ) for x in xs])))
    w = w.where(F.round("n") >= max(min_pairs, 2)).withColumns({
        "sxx": F.col("xx") - F.col("x") * F.col("x") / F.col("n"), "syy": F.col("yy") - F.col("y") * F.col("y") / F.col("n"),
        "sxy": F.col("xy") - F.col("x") * F.col("y") / F.col("n"),
    })
    # What is left of constant values after the subtraction is rounding, far below their size.
    w = w.where((F.col("sxx") > F.col("xx") * 1e-9) & (F.col("syy") > F.col("yy") * 1e-9))
    w = w.withColumns({"corr": F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy")), "_b": F.col("sxy") / F.col("sxx")})
    w = w.withColumn("_a", F.col("_c_y") + F.col("y") / F.col("n") - F.col("_b") * (F.col("_c_x") + F.col("x") / F.col("n")))
    best = F.min_by(F.struct("source", "_a", "_b"), F.struct(-F.col("corr"), F.col("source")))
    model = w.groupBy(*keys, "_gap").agg(best.alias("_m")).select(*keys, "_gap", "_m.*")
    d = d.join(model, [*keys, "_gap"], "left")
    x = F.coalesce(*[F.when(F.col("source") == c, F.col(c)) for c in xs])
    fits = F.col(y).isNull() & x.isNotNull()
    return d.select(
        *tier.columns, F.when(fits, F.col("_a") + F.col("_b") * x).otherwise(F.col(y)).alias("filled"),
        F.when(fits, F.col("source")).alias("source"),
    )


def fill_from_context(
    tier: DataFrame,
    target: str = "outer_vel",
    candidates: Sequence[str] = ("middle_vel", "inner_vel"),
    rows: int = 12,
    keys: Sequence[str] = ("Tree", "Cable"),
    time: str = "Timestamp",
    span: int = SPAN_SECONDS,
) -> DataFrame:
    """Fill each gap of the target from another position, fitted on ``rows`` rows on either side.

    A candidate counts only if the margins are complete and observed, it has a value
    on every row of the gap and misses at most one value overall; the highest
    absolute correlation wins. Gives the filled rows only.
    """
    by = [*keys, "gap"]
    d = written(gap_context(tier, keys, target, time, rows, span).select(*by, "length", time, target, *candidates), "gap-context")
    y = F.col(target)
    # Checks, correlation and fit of all candidates from one pass of moments.
    facts = [
        F.struct(
            F.lit(c).alias("Sensor"), F.count_if(y.isNull() & F.col(c).isNull()).alias("holes"), F.count_if(F.col(c).isNull()).alias("lost"),
            correlation(target, c).alias("corr"), F.regr_slope(target, c).alias("slope"), F.regr_intercept(target, c).alias("intercept"),
        ) for c in candidates
    ]
    fits = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(y.isNull()).alias("_missing"), F.max("length").alias("_length"), F.array(*facts).alias("_c"),
    ).where((F.col("_rows") == F.col("_length") + 2 * rows) & (F.col("_missing") == F.col("_length")))
    usable = F.filter("_c", lambda c: (c["holes"] == 0) & (c["lost"] <= 1) & (F.abs(c["corr"]) > 0))
    # The highest absolute correlation; names break ties.
    order = F.transform(usable, lambda c: F.struct((-F.abs(c["corr"])).alias("s"), c["Sensor"].alias("Sensor"), c["slope"].alias("slope"), c["intercept"].alias("intercept")))
    model = fits.select(*by, F.array_min(order).alias("_m")).where("_m is not null").select(*by, "_m.Sensor", "_m.slope", "_m.intercept")
    preds = d.where(y.isNull()).join(model, by)
    x = F.coalesce(*[F.when(F.col("Sensor") == c, F.col(c)) for c in candidates])
    return preds.select(*by, time, "Sensor", (F.col("intercept") + F.col("slope") * x).alias("filled"))
