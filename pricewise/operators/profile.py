"""Data-quality profile: null ratios, schema, numeric stats, outliers,
category shares, train/validation drift (two-sample KS), and the report.

Wide tables are unpivoted once into (column, value) rows so that every
section is one grouped aggregate over all columns instead of one job per
column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.operators.split import random_split
from pricewise.operators.quantiles import exact_quantiles
from pricewise.operators.stats import APPROX_ACCURACY, join_small, quantile_method
from pricewise.session import stored

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
_FLOATS = ("float", "double")
# Fixed value: text columns with at most this many distinct values are categorical.
MAX_CATEGORY_VALUES = 50
# The statistics of a numeric profile, in report order.
PROFILE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES or t.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def _is_missing(name: str, dtype: str):
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if dtype in _FLOATS else c.isNull()


def to_long(df: DataFrame, cols: Sequence[str], value_type: str = "double",
            keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) rows, one per input row and listed column."""
    if not cols:
        raise ValueError("no columns to unpivot")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(value_type).alias("value"))
                      for c in cols])
    return df.select(*keep, F.inline(pairs))


def null_ratio(df: DataFrame) -> DataFrame:
    """(column, null_ratio) for every column, highest first; NaN counts as missing."""
    dtypes = dict(df.dtypes)
    one = df.select(*[F.avg(_is_missing(c, t).cast("double")).alias(c) for c, t in df.dtypes])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(c).alias("null_ratio")) for c in dtypes])))
    return long.orderBy(F.col("null_ratio").desc(), "column")


def schema_summary(df: DataFrame) -> DataFrame:
    """(column, type) for every column, from the rows themselves: one aggregate of
    ``typeof``, so a table that cannot be read fails here; an empty table has
    the declared types."""
    seen = df.agg(*[F.coalesce(F.max(F.typeof(F.col(f"`{c}`"))), F.lit(t)).alias(c) for c, t in df.dtypes])
    return seen.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("type"))
                                          for c in df.columns])))


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column (nulls/NaN ignored;
    a column without values has count 0 and null statistics)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = to_long(df, cols).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    if quantile_method(df.sparkSession, approx) == "distributed":
        quart = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
        moments = long.groupBy("column").agg(
            F.count("value").cast("double").alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
        # one row per profiled column on both sides
        return (moments.join(F.broadcast(quart), on="column", how="left")
                .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))
    qs = (F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)),
                              F.lit(APPROX_ACCURACY)) if approx
          else F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    return (long.groupBy("column").agg(
                F.count("value").cast("double").alias("count"), F.avg("value").alias("mean"),
                F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                qs.alias("__q"), F.max("value").alias("max"))
            .select("column", "count", "mean", "std", "min",
                    F.col("__q")[0].alias("q25"), F.col("__q")[1].alias("q50"),
                    F.col("__q")[2].alias("q75"), "max"))


def outlier_count(df: DataFrame, cols: Sequence[str] | None = None,
                  approx: bool = False, profile: DataFrame | None = None) -> DataFrame:
    """(column, outliers): values strictly outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR].

    ``profile`` (a ``numeric_profile`` result) supplies the quartiles so a
    report computes them once.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = to_long(df, cols)
    present = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    if profile is not None:
        quart = profile.select("column", F.array("q25", "q75").alias("__q"))
    elif quantile_method(df.sparkSession, approx) == "distributed":
        quart = (exact_quantiles(present, ["column"], "value", [0.25, 0.75], ["q1", "q3"])
                 .select("column", F.array("q1", "q3").alias("__q")))
    else:
        qf = (F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.75)), F.lit(APPROX_ACCURACY))
              if approx else F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))))
        quart = present.groupBy("column").agg(qf.alias("__q"))
    bounds = (quart
                  .select("column",
                          (F.col("__q")[0] - 1.5 * (F.col("__q")[1] - F.col("__q")[0])).alias("__lo"),
                          (F.col("__q")[1] + 1.5 * (F.col("__q")[1] - F.col("__q")[0])).alias("__hi")))
    # one row per profiled column: a proven bound for the broadcast
    flagged = long.join(F.broadcast(bounds), on="column", how="left")
    out = (F.col("value") < F.col("__lo")) | (F.col("value") > F.col("__hi"))
    counts = flagged.groupBy("column").agg(F.count_if(F.coalesce(out, F.lit(False))).alias("outliers"))
    return counts.select("column", F.col("outliers").cast("bigint"))


def category_distribution(df: DataFrame, cols: Sequence[str] | None = None,
                          max_unique: int = MAX_CATEGORY_VALUES) -> DataFrame:
    """(column, value, share) for text columns with at most ``max_unique``
    distinct non-null values; share = relative frequency among non-null rows.

    The gate is exact: distinct values are counted from the same grouped
    counts the shares come from, whatever their number.
    """
    cols = list(cols) if cols is not None else text_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, share double")
    counts = (to_long(df, cols, "string").where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    sizes = (counts.groupBy("column").agg(F.count(F.lit(1)).alias("__k"), F.sum("n").alias("__total"))
                   .where(F.col("__k") <= max_unique))
    # one row per column: a proven bound for the broadcast
    return (counts.join(F.broadcast(sizes), "column")
                  .select("column", "value", (F.col("n").cast("double") / F.col("__total")).alias("share")))


def _running_sums(counts: DataFrame, sum_cols: Sequence[str], parts: int) -> DataFrame:
    """Running sums of ``sum_cols`` in value order within each column.

    (column, value) rows are range-partitioned, summed inside each part and
    offset by the totals of earlier parts (a small columns x parts table).
    """
    ranged = stored(counts.repartitionByRange(parts, "column", "value")
                          .withColumn("__part", F.spark_partition_id()), "ranged")
    local_w = (Window.partitionBy("column", "__part").orderBy("value")
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = ranged.groupBy("column", "__part").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    prev = Window.partitionBy("column").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column", "__part", *[F.coalesce(F.sum(f"__t_{c}").over(prev), F.lit(0)).alias(f"__o_{c}")
                                                  for c in sum_cols])
    joined = join_small(ranged.withColumns({f"__l_{c}": F.sum(c).over(local_w) for c in sum_cols}),
                        offsets, on=["column", "__part"], how="inner")
    return joined.select("column", "value", *sum_cols,
                         *[(F.col(f"__l_{c}") + F.col(f"__o_{c}")).alias(f"cum_{c}") for c in sum_cols])


def ks_drift(df: DataFrame, id_col: str, cols: Sequence[str] | None = None,
             test_frac: float = 0.2, seed: int = 42, rows_per_part: int = 1_000_000) -> DataFrame:
    """(column, ks): two-sample Kolmogorov-Smirnov statistic between the train
    and test sides of an exact hash split, per numeric column (nulls dropped).

    D = max over distinct values of |F_train(v) - F_test(v)|, from per-value
    counts (stored once: the split runs once) and exact distributed running sums.
    """
    cols = list(cols) if cols is not None else [c for c in numeric_columns(df) if c != id_col]
    split = random_split(df.select(id_col, *cols), id_col, test_frac, seed, out_col="__side")
    long = to_long(split, cols, keep=["__side"]).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = stored(long.groupBy("column", "value").agg(
        F.count_if(F.col("__side") == "train").alias("a"),
        F.count_if(F.col("__side") == "test").alias("b")), "ks-counts")
    cum = _running_sums(counts, ["a", "b"], max(8, -(-counts.count() // rows_per_part)))
    # one row per profiled column: a proven bound for the broadcast
    sizes = counts.groupBy("column").agg(F.sum("a").alias("__na"), F.sum("b").alias("__nb"))
    cum = cum.join(F.broadcast(sizes), "column")
    diff = F.abs(F.try_divide(F.col("cum_a").cast("double"), F.col("__na"))
                 - F.try_divide(F.col("cum_b").cast("double"), F.col("__nb")))
    return cum.groupBy("column").agg(F.max(diff).alias("ks"))
