"""Registered queries: each binds an operator to the driver's tables and has
(where SQL can express it) a DuckDB twin used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.operators.serving import LookupTables, build_lookup_tables
from pricewise.plans import sqltext as Q
from pricewise.plans import tables as T
from pricewise.plans.layers import materialized
from pricewise.plans.pipelines import clean_sales, engineer_sales

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round4(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Round every double column to 4 decimals, or to ``digits[col]`` (the
    oracle does the same): large sums carry too few significant digits for 4."""
    from pricewise.functions.numeric import round_half_up
    digits = digits or {}
    return df.withColumns({c: round_half_up(c, digits.get(c, 4)) for c, t in df.dtypes if t == "double"})


# ------------------------------------------------------------------ builders

def clean_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(T.sales_raw(spark, sf_dir), dtype_map=T.RAW_DTYPES,
                       loading_cols=T.LOADED_COLUMNS, renames=T.RENAMES)


def engineer_from(spark: SparkSession, sf_dir: str, clean: DataFrame) -> DataFrame:
    return engineer_sales(clean, directory=T.postcode_directory(spark, sf_dir),
                          keywords=Q.FLAGSHIP_KEYWORDS)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver layer: clean sales, partitioned by sold_year, written once per session."""
    return materialized(spark, "silver", sf_dir, lambda: clean_from_raw(spark, sf_dir), ("sold_year",))


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold layer: engineered sales built from the silver layer, partitioned by sold_year, written once per session."""
    return materialized(spark, "gold", sf_dir, lambda: engineer_from(spark, sf_dir, cleaned(spark, sf_dir)), ("sold_year",))


def lookups(spark, sf_dir):
    """The three lookup tables, stored once per input version."""
    eng = engineered(spark, sf_dir)
    built = build_lookup_tables(eng)
    return LookupTables(*[materialized(spark, name, sf_dir, lambda df=df: df) for name, df in (
        ("lookup-district", built.borough_price_trend), ("lookup-year", built.district_yearly_medians),
        ("lookup-recent", built.avg_price_last_half))])


# ------------------------------------------------------------------ pipelines

def cast_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales after the coercing casts (before any row is dropped)."""
    from pricewise.operators.clean import cast_columns
    return cast_columns(T.sales_raw(spark, sf_dir), T.RAW_DTYPES)


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales (no keyword filter) with districts from the directory."""
    from pricewise.operators.enrich import resolve_dimension
    return resolve_dimension(cleaned(spark, sf_dir), "postcode",
                             T.postcode_directory(spark, sf_dir), "postcode", "district")


@register("clean_sales", Q.r4(Q.CLEAN_SQL, "price"))
def q_clean_sales(spark, sf_dir):
    """PL1 from the raw tables (not the stored silver layer)."""
    return round4(clean_from_raw(spark, sf_dir))


@register("engineer_sales", Q.r4(Q.ENGINEERED_SQL, "price", "borough_price_trend",
                                 "district_yearly_medians", "avg_price_last_half"))
def q_engineer_sales(spark, sf_dir):
    """PL2 end to end from the raw tables (not the stored gold layer)."""
    return round4(engineer_from(spark, sf_dir, clean_from_raw(spark, sf_dir)))


# Query modules register themselves on import.
from pricewise.plans import q_clean, q_features, q_profile, q_runs, q_model, q_io  # noqa: E402,F401
