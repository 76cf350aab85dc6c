"""Group aggregates: medians per key, composite keys, recent medians, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.operators.filters import recent_rows
from pricewise.operators.quantiles import exact_median
from pricewise.operators.stats import median_expr, quantile_method


def keyed_median(df: DataFrame, keys: Sequence[str], value_col: str, out_col: str,
                 approx: bool = False) -> DataFrame:
    """Median of ``value_col`` per non-null key tuple, by the session's quantile
    method (see ``stats.quantile_method``)."""
    keys = list(keys)
    method = quantile_method(df.sparkSession, approx)
    if method == "distributed":
        return exact_median(df, keys, value_col, out_col)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(median_expr(value_col, method == "approx").alias(out_col))


def group_median(df: DataFrame, key: str, value_col: str = "price", out_col: str = "price",
                 approx: bool = False) -> DataFrame:
    """Exact median of ``value_col`` per non-null ``key`` (partial aggregation map-side)."""
    return keyed_median(df, [key], value_col, out_col, approx)


def group_median_composite(df: DataFrame, key: str, year_col: str, value_col: str = "price",
                           out_key: str = "district_year", out_col: str = "price",
                           approx: bool = False, keep_keys: bool = False) -> DataFrame:
    """Median per (key, year), keyed as ``'{key}_{year}'``; ``keep_keys`` leaves the two
    key columns beside the text, so joins need not parse it back."""
    text = F.concat_ws("_", F.col(key), F.col(year_col).cast("bigint").cast("string")).alias(out_key)
    return (keyed_median(df, [key, year_col], value_col, out_col, approx)
              .select(*([key, year_col] if keep_keys else []), text, out_col))


def recent_group_median(df: DataFrame, key: str, date_col: str, value_col: str = "price",
                        months: int = 6, out_col: str = "price", approx: bool = False,
                        year_col: str | None = None) -> DataFrame:
    """Median per key over rows dated within ``months`` of the table's latest date; ``year_col``
    as in ``recent_rows``."""
    return group_median(recent_rows(df, date_col, months, year_col), key, value_col, out_col, approx)


def global_fallback(group_medians: DataFrame, value_col: str = "price",
                    out_col: str = "global_median") -> DataFrame:
    """Median of the per-group medians (not of all rows): one row."""
    return keyed_median(group_medians, [], value_col, out_col)


def category_count(df: DataFrame, col: str, out_col: str = "count") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out_col))


def distinct_keys(df: DataFrame, cols: "str | Sequence[str]") -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond).select(*cols).distinct()


def distinct_count(df: DataFrame, col: str, out_col: str = "n_distinct") -> DataFrame:
    return df.agg(F.count_distinct(F.col(col)).alias(out_col))
