"""Regression metrics per split (rmse, mse, r2) in one grouped pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metric names as '{split}_{metric}'.
METRICS = ("rmse", "mse", "r2")


def regression_metrics(df: DataFrame, label_col: str, pred_col: str,
                       split_col: str | None = None) -> DataFrame:
    """(split, rmse, mse, r2, n). r2 = 1 - SS_res / SS_tot; a constant label
    gives 1.0 for a perfect fit and 0.0 otherwise."""
    err2 = (F.col(label_col) - F.col(pred_col)) ** 2
    keys = [split_col] if split_col else []
    agg = df.where(F.col(label_col).isNotNull() & F.col(pred_col).isNotNull()).groupBy(*keys).agg(
        F.avg(err2).alias("mse"), F.sum(err2).alias("__ssr"),
        (F.var_pop(F.col(label_col)) * F.count(F.lit(1))).alias("__sst"),
        F.count(F.lit(1)).alias("n"))
    r2 = (F.when(F.col("__sst") > 0, 1.0 - F.col("__ssr") / F.col("__sst"))
           .when(F.col("__ssr") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    out = agg.select(*keys, F.sqrt("mse").alias("rmse"), "mse", r2.alias("r2"), "n")
    return out.withColumnRenamed(split_col, "split") if split_col else out


def metrics_record(per_split: DataFrame) -> DataFrame:
    """Long (metric, value) rows named '{split}_{metric}'."""
    pairs = F.array(*[F.struct(F.concat(F.col("split"), F.lit(f"_{m}")).alias("metric"),
                               F.col(m).alias("value")) for m in METRICS])
    return per_split.select(F.inline(pairs))
