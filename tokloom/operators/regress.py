"""Regression re-aimed from the tutorial's gradient-descent fit.

The tutorial iterates an optimiser towards the least-squares line; the exact
answer is a pair of aggregates per group (``regr_slope`` / ``regr_intercept``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokloom.session import stored


def linear_fit(df: DataFrame, y: str, x: str, group: list[str] | None = None) -> DataFrame:
    """``(group..., slope, intercept, n)`` per group."""
    g = list(group or [])
    return df.groupBy(*g).agg(F.regr_slope(y, x).alias("slope"),
                              F.regr_intercept(y, x).alias("intercept"),
                              F.count(F.lit(1)).alias("n"))


def predict(df: DataFrame, fit: DataFrame, x: str, group: list[str] | None = None,
            out: str = "prediction") -> DataFrame:
    """R2: every row with ``slope * x + intercept`` of its group's line (``linear_fit``), null without one.

    A fit has one row a group. Without groups its two numbers come to the driver and the rows stay where they are;
    with groups, which null keys may be among, the planner joins by the table's true size.
    """
    line = lambda a, b: (a * F.col(x) + b).alias(out)
    if not group:
        r = fit.select("slope", "intercept").first()
        number = lambda v: F.lit(v).cast("double")
        return df.select("*", line(number(r["slope"]), number(r["intercept"])))
    own = fit.select(*[F.col(g).alias(f"_fit_{g}") for g in group], F.col("slope").alias("_slope"),
                     F.col("intercept").alias("_intercept"))
    same = [F.col(g).eqNullSafe(F.col(f"_fit_{g}")) for g in group]
    joined = df.join(own, reduce(lambda a, b: a & b, same), "left")
    return joined.select(*df.columns, line(F.col("_slope"), F.col("_intercept")))


def mse(df: DataFrame, y: str, x: str, group: list[str] | None = None) -> DataFrame:
    """R2: mean squared error of the least-squares line, per group.

    Two passes: the line from centred sums, then the mean of squared residuals of its predictions; an identity of
    variances would cancel when the values are large and the errors small. With a constant ``x``
    there is no line and the result is null, as in R1.
    """
    g = list(group or [])
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    # about the means, which hold the large part of the values
    mean = rows.groupBy(*g).agg(F.avg(x).alias("_x"), F.avg(y).alias("_y"))
    mean, _ = stored(mean, "means")
    if g:
        own = mean.select(*[F.col(k).alias(f"_of_{k}") for k in g], "_x", "_y")
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in g]
        rows = rows.join(own, reduce(lambda a, b: a & b, same))
    else:
        r = mean.first()
        rows = rows.select("*", F.lit(r["_x"]).cast("double").alias("_x"), F.lit(r["_y"]).cast("double").alias("_y"))
    near = rows.select(*g, (F.col(x) - F.col("_x")).alias("_dx"), (F.col(y) - F.col("_y")).alias("_dy"))
    fit, _ = stored(linear_fit(near, "_dy", "_dx", g), "fit")
    return predict(near, fit, "_dx", g).groupBy(*g).agg(
        F.avg(F.pow(F.col("_dy") - F.col("prediction"), F.lit(2))).alias("mse"))


def synthetic_line(spark: SparkSession, n: int, seed: int = 42, slope: float = 2.0,
                   intercept: float = 1.0, noise: float = 0.1) -> DataFrame:
    """A10: ``y = slope * x + intercept + noise * N(0, 1)`` with ``x ~ N(0, 1)``.

    Generated in parallel by ``spark.range``; used by tests, not as a query.
    """
    return spark.range(n).select(F.randn(seed).alias("x"), F.randn(seed + 1).alias("e")) \
        .select("x", (F.col("x") * slope + intercept + F.col("e") * noise).alias("y"))
