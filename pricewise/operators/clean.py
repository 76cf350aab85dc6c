"""Cleaning and projection operators (casts, postcodes, nulls, clip, renames)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.dates import (DEFAULT_TS_FORMAT, INFER_TS_FORMAT, TS_LAYOUTS, cast_timestamp, sold_month,
                                       sold_year)
from pricewise.functions.numeric import cast_numeric, clip_upper
from pricewise.functions.text import canonical_postcode, incode, interaction, outcode
from pricewise.operators.stats import quantile_scalar

log = logging.getLogger(__name__)

POSTCODE_CLEAN = "postcode_clean"


def first_value(df: DataFrame, col: str) -> str | None:
    """The first non-null text of a column in file order (file, place in the file, row; rows of
    a frame made of several tables: partition, row), whatever order the tasks run in."""
    row = F.monotonically_increasing_id()
    text = F.col(col).cast("string").alias("v")
    try:
        rows = df.select(text, F.struct(F.input_file_name(), F.input_file_block_start(), row).alias("at"))
    except AnalysisException as e:
        if e.getCondition() != "MULTI_SOURCES_UNSUPPORTED_FOR_EXPRESSION":
            raise
        rows = df.select(text, row.alias("at"))
    return rows.where(F.col("v").isNotNull()).agg(F.min_by("v", "at")).first()[0]


def infer_ts_format(df: DataFrame, col: str) -> str:
    """The layout of a date column, decided by its first non-null value alone: the first of
    ``TS_LAYOUTS`` that reads it. Month before day where both are possible (12/05 is the fifth of
    December), day first where only that is (13/05). A column without values, or whose first one
    no layout reads, keeps the default layout. One aggregate; one value reaches the driver."""
    value = first_value(df, col)
    if value is None:
        return DEFAULT_TS_FORMAT
    reads = F.array(*[F.try_to_timestamp(F.lit(value), F.lit(f)).isNotNull() for f in TS_LAYOUTS])
    at = df.sparkSession.range(1).select(F.array_position(reads, True)).first()[0]
    return TS_LAYOUTS[at - 1] if at else DEFAULT_TS_FORMAT


def cast_columns(df: DataFrame, dtype_map: Mapping[str, str],
                 ts_format: str = DEFAULT_TS_FORMAT) -> DataFrame:
    """Coerce columns by tag: 'float' -> double (bad -> null), 'datetime' ->
    TIMESTAMP_NTZ (bad -> null); 'string' / 'int' tags leave the column as is. With
    ``ts_format='infer'`` each date column's layout is taken from its first value."""
    casts = {}
    for name, tag in dtype_map.items():
        if tag == "float":
            kind = dict(df.dtypes).get(name, "string")
            casts[name] = cast_numeric(name) if kind == "string" else F.col(name).cast("double")
        elif tag == "datetime":
            dtype = dict(df.dtypes).get(name)
            casts[name] = (F.col(name).cast("timestamp_ntz") if dtype in ("timestamp", "timestamp_ntz", "date")
                           else cast_timestamp(name, infer_ts_format(df, name) if ts_format == INFER_TS_FORMAT
                                               else ts_format))
    return df.withColumns(casts) if casts else df


def normalise_postcodes(df: DataFrame, raw_col: str, clean_col: str = POSTCODE_CLEAN,
                        out_col: str = "outcode", in_col: str = "incode") -> DataFrame:
    clean = canonical_postcode(raw_col)
    return (df.withColumn(clean_col, clean)
              .withColumns({out_col: outcode(clean_col), in_col: incode(clean_col)}))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows null (or NaN) in any of ``subset`` (all columns when None)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def add_sold_year(df: DataFrame, ts_col: str, out_col: str = "sold_year") -> DataFrame:
    return df.withColumn(out_col, sold_year(ts_col))


def add_sold_month(df: DataFrame, ts_col: str, out_col: str = "sold_month") -> DataFrame:
    return df.withColumn(out_col, sold_month(ts_col))


def clip_upper_quantile(df: DataFrame, col: str, q: float, out_col: str | None = None,
                        approx: bool = False) -> DataFrame:
    """Cap ``col`` at its own q-quantile (linear interpolation, nulls ignored).

    The cap is a scalar subquery: one distributed aggregate, then a literal in
    the projection, so no cross join and no single-task window.
    """
    cap = quantile_scalar(df, col, q, approx=approx)
    return df.withColumn(out_col or col, clip_upper(col, cap))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in mapping order; a missing source column is logged and skipped."""
    present = {}
    cols = list(df.columns)
    for src, dst in mapping.items():
        if src in cols:
            present[src] = dst
            cols[cols.index(src)] = dst
        else:
            log.info("rename skipped: column %r not found", src)
    return df.withColumnsRenamed(present) if present else df


def required_columns(df: DataFrame, cat_features: Sequence[str], numeric_features: Sequence[str],
                     label: str) -> DataFrame:
    """Project to categorical + numeric features + label, in that order."""
    wanted = [*cat_features, *numeric_features, label]
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise KeyError(f"df column has missing columns: {missing}")
    return df.select(*wanted)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def add_interaction(df: DataFrame, new_col: str, col1: str, col2: str, sep: str = "_",
                    null_token: str = "nan") -> DataFrame:
    return df.withColumn(new_col, interaction(col1, col2, sep, null_token))


def merge_categories(df: DataFrame, merge_map: Mapping[str, Sequence[str]],
                     subset: Sequence[str] | None = None) -> DataFrame:
    """Replace every value listed under a target with that target, in all string
    columns (or ``subset``). Every mapping applies, not just the last one."""
    lookup = {src: dst for dst, srcs in merge_map.items() for src in srcs}
    if not lookup:
        return df
    string_cols = [c for c, t in df.dtypes if t == "string"]
    cols = [c for c in (subset or string_cols) if c in string_cols]
    mapping = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv])
    return df.withColumns({c: F.when(F.col(c).isin(*lookup.keys()), mapping[F.col(c)])
                                .otherwise(F.col(c)) for c in cols})
