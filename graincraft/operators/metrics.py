"""Evaluation metrics and group statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_pairs(df: DataFrame, true_col: str, pred_col: str, invalid: list[str]) -> DataFrame:
    """Rows whose labels are both present and not in ``invalid``."""
    ok = F.lit(True)
    for c in (true_col, pred_col):
        ok = ok & F.col(c).isNotNull() & ~F.col(c).isin(invalid or [""])
    return df.where(ok)


def confusion(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """``(true_label, pred_label, n, share)``: counts, and their share of the true label."""
    n = df.groupBy(F.col(true_col).alias("true_label"), F.col(pred_col).alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("true_label")))


def accuracy(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """``(accuracy, n)`` in one row; accuracy is null for no rows."""
    same = (F.col(true_col) == F.col(pred_col)).cast("double")
    return df.agg(F.avg(same).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def mean_variance(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """``(group, mean, variance)`` with the sample variance, null for a single value."""
    v = F.col(value_col).cast("double")
    return df.groupBy(group_col).agg(F.avg(v).alias("mean"), F.var_samp(v).alias("variance"))


def totals(df: DataFrame, seconds_col: str) -> DataFrame:
    """``(total_seconds, files)`` in one row."""
    return df.agg(F.sum(seconds_col).alias("total_seconds"), F.count(F.lit(1)).alias("files"))
