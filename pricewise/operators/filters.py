"""Row filters: keywords, rare categories, request validation, recency, runs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.numeric import is_finite_number
from pricewise.functions.text import canonical_postcode, keyword_predicate

# Request vocabularies accepted when scoring.
ALLOWED_PROPERTY_TYPES = ("D", "S", "T", "F")
ALLOWED_FLAGS = ("Y", "N")
FINISHED = "FINISHED"
# The five metrics a run needs before it is ranked.
REQUIRED_RUN_METRICS = ("validation_rmse", "validation_r2", "validation_mse", "train_rmse",
                        "test_rmse")


def keyword_filter(df: DataFrame, col: str, keywords: Iterable[str]) -> DataFrame:
    """Rows whose ``col`` contains all keywords (regex, case-insensitive)."""
    return df.where(keyword_predicate(col, list(keywords)))


def drop_rare_categories(df: DataFrame, col: str, min_count: int = 10) -> DataFrame:
    """Rows whose category occurs at least ``min_count`` times; null dropped.

    Counts are a partial (map-side combined) aggregate; the frequent keys are
    applied as a left-semi join, so no row of ``df`` is shuffled into a
    single per-category group.
    """
    from pricewise.operators.stats import join_small

    keep = (df.where(F.col(col).isNotNull()).groupBy(col).count()
              .where(F.col("count") >= min_count).select(col))
    return join_small(df, keep, on=col, how="left_semi")


def validate_requests(df: DataFrame, property_col: str = "property_type",
                      flag_cols: Sequence[str] = ("is_new_build", "is_leasehold"),
                      allowed_types: Sequence[str] = ALLOWED_PROPERTY_TYPES,
                      default_flag: str = "N") -> DataFrame:
    """Upper-case the request fields, default missing flags, and add
    ``is_valid`` plus ``reject_reason`` (first failing field)."""
    out = df.withColumn(property_col, F.upper(F.col(property_col)))
    out = out.withColumns({c: F.upper(F.coalesce(F.col(c), F.lit(default_flag))) for c in flag_cols})
    reason = F.when(~F.coalesce(F.col(property_col).isin(*allowed_types), F.lit(False)),
                    F.lit(f"{property_col} must be one of {','.join(allowed_types)}"))
    for c in flag_cols:
        reason = reason.when(~F.col(c).isin(*ALLOWED_FLAGS), F.lit(f"{c} must be Y or N"))
    return out.withColumn("reject_reason", reason).withColumn("is_valid", F.col("reject_reason").isNull())


def unresolved_keys(df: DataFrame, key_col: str, dim: DataFrame, dim_key: str,
                    dim_value: str) -> DataFrame:
    """Distinct canonical non-null keys with no usable (non-null) dimension value."""
    keys = (df.select(canonical_postcode(key_col).alias("key")).where(F.col("key").isNotNull())
              .distinct())
    known = (dim.where(F.col(dim_value).isNotNull())
                .select(canonical_postcode(dim_key).alias("key")).distinct())
    return keys.join(known, on="key", how="left_anti")


def recent_rows(df: DataFrame, date_col: str, months: int = 6, year_col: str | None = None) -> DataFrame:
    """Rows with ``date >= max(date) - months`` (calendar months, clamped to month end).

    ``max(date)`` is a scalar subquery; Spark also pushes it into the scan as
    a runtime filter. ``year_col`` names a column that holds the date's year, null for null
    dates. If the table is partitioned by it, the latest year is found without
    reading a data column, the latest date in that year alone, and the bound's year is a partition
    predicate: older years' rows are never read.
    """
    newest = df if year_col is None else df.where(F.col(year_col) == df.select(F.max(year_col)).scalar())
    bound = newest.select(F.max(date_col)).scalar() - F.make_ym_interval(F.lit(0), F.lit(months))
    recent = df.where(F.col(date_col) >= bound)
    return recent if year_col is None else recent.where(F.col(year_col) >= F.year(bound))


def has_finite_metrics(runs: DataFrame, metrics_col: str = "metrics",
                       required: Sequence[str] = REQUIRED_RUN_METRICS) -> DataFrame:
    """Runs whose required metrics (a map column) are all finite numbers."""
    pred = F.lit(True)
    for name in required:
        pred = pred & is_finite_number(F.col(metrics_col)[name])
    return runs.where(pred)


def finished_runs(runs: DataFrame, n: int = 30, status_col: str = "status",
                  start_col: str = "start_time") -> DataFrame:
    """At most ``n`` FINISHED runs, newest first (a top-k: TakeOrderedAndProject)."""
    if not 1 <= n <= 200:
        raise ValueError("n must be between 1 and 200")
    return (runs.where(F.col(status_col) == FINISHED)
                .orderBy(F.col(start_col).desc_nulls_last(), F.col("run_id")).limit(n))
