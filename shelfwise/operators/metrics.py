"""Evaluation metrics as aggregates (one-row DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse(df: DataFrame, pred: str, target: str) -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(pred) - F.col(target), 2))).alias("rmse"))


def r_squared(df: DataFrame, pred: str, target: str) -> DataFrame:
    """1 - SSR / SST, with the mean as a scalar subquery; NULL when SST = 0."""
    mean = df.agg(F.avg(target)).scalar()
    return df.agg(
        (F.lit(1.0) - F.try_divide(F.sum(F.pow(F.col(target) - F.col(pred), 2)), F.sum(F.pow(F.col(target) - mean, 2)))).alias("r2")
    )


def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def impurity(df: DataFrame, label: str) -> DataFrame:
    """Entropy (bits) and Gini impurity of the class distribution of ``label``."""
    n = df.agg(F.count(F.lit(1))).scalar()
    shares = df.groupBy(label).agg((F.count(F.lit(1)) / n).alias("p"))
    return shares.agg(
        F.sum(-F.col("p") * F.log2("p")).alias("entropy"),
        (F.lit(1.0) - F.sum(F.col("p") * F.col("p"))).alias("gini"),
    )


def confusion_matrix(df: DataFrame, pred: str, label: str, classes=(0, 1)) -> DataFrame:
    """predicted x actual counts: (pred, actual_<c> ...), missing cells = 0."""
    wide = df.groupBy(pred).pivot(label, list(classes)).agg(F.count(F.lit(1)))
    wide = wide.toDF(pred, *[f"actual_{c}" for c in classes])
    return wide.fillna(0)


def within_between_ss(long: DataFrame, cluster: str, dim: str = "dim", value: str = "value") -> DataFrame:
    """Homogeneity / separation of clusters from a long (row, dim, value) table with a cluster label.

    within = sum_c sum_d (sum x^2 - (sum x)^2 / n_c), between = sum_c sum_d n_c (mean_cd - mean_d)^2.
    """
    per_cd = long.groupBy(cluster, dim).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("s2")
    )
    per_d = long.groupBy(dim).agg(F.avg(value).alias("m"))
    j = per_cd.join(per_d, dim)
    return j.agg(
        F.sum(F.col("s2") - F.col("s") * F.col("s") / F.col("n")).alias("within_ss"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("m"), 2)).alias("between_ss"),
    )
