"""Composite pipelines: clean, engineer, side-table clean (chained transforms)."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.dates import DEFAULT_TS_FORMAT, ntz_micros
from pricewise.operators.clean import (add_interaction, add_sold_month, add_sold_year,
                                       cast_columns, clip_upper_quantile, drop_null_rows,
                                       normalise_postcodes, rename_columns)
from pricewise.operators.aggregates import group_median
from pricewise.operators.enrich import attach_group_stat_join, resolve_dimension
from pricewise.operators.filters import keyword_filter
from pricewise.operators.quantiles import medians_at
from pricewise.operators.stats import quantile_method
from pricewise.operators.windows import attach_group_median, rolling_median
from pricewise.session import stored

log = logging.getLogger(__name__)


def clean_sales(df: DataFrame, *, dtype_map: Mapping[str, str], postcode_col: str = "postcode",
                loading_cols: Sequence[str] | None = None, date_col: str = "date",
                price_col: str = "price", clip_price: bool = True, clip_quantile: float = 0.99,
                renames: Mapping[str, str] | None = None,
                ts_format: str = DEFAULT_TS_FORMAT, store: bool = True) -> DataFrame:
    """cast -> postcodes -> drop nulls -> year, month -> clip price -> rename.

    The clip quantile is taken over all cleaned rows, before any later filter.
    The exact quantile reads its input more than once and the clip once more, so
    the pre-clip rows are written to the shared folder rather than re-derived.
    ``dtype_map`` and ``loading_cols`` must have the same size.
    """
    if loading_cols is not None and len(dtype_map) != len(loading_cols):
        raise ValueError(f"{len(dtype_map)} typed columns, but {len(loading_cols)} loaded ones")
    out = cast_columns(df, dtype_map, ts_format)
    out = normalise_postcodes(out, raw_col=postcode_col)
    out = drop_null_rows(out, subset=list(loading_cols) if loading_cols else None)
    out = add_sold_year(out, date_col)
    out = add_sold_month(out, date_col)
    if clip_price:
        if store:
            out = stored(out, "unclipped")
        out = clip_upper_quantile(out, price_col, clip_quantile)
    return rename_columns(out, renames or {})


def sale_counts(df: DataFrame, cols: Sequence[str], date_col: str, price_col: str) -> DataFrame:
    """Rows counted by (``cols``, date in microseconds, price): what every median of the
    engineered table can be taken from. The one exchange of the sales rows."""
    price = F.col(price_col).cast("double")
    return (df.select(*cols, ntz_micros(date_col).alias("__t"), F.when(~F.isnan(price), price).alias("__v"))
            .groupBy(*cols, "__t", "__v").agg(F.count(F.lit(1)).alias("__n")))


def engineer_sales(df: DataFrame, *, directory: DataFrame | None, postcode_col: str = "postcode",
                   directory_key: str = "postcode", directory_value: str = "district",
                   city_col: str | None = "county", keywords: Sequence[str] = (),
                   district_col: str = "district", date_col: str = "date",
                   price_col: str = "price", year_col: str = "sold_year",
                   trend_key: str | None = None, window_days: int = 180,
                   slice_days: "int | str | None" = "auto", approx: bool = False,
                   store: bool = True) -> DataFrame:
    """keyword filter -> district -> three trend features -> three interactions.

    The sales rows are exchanged once, to count them by (district, year, date, price); the
    medians of all grains and the rolling median come from the counts and are joined back.

    ``trend_key`` chooses the group of ``borough_price_trend``: the district
    (default, what serving looks up) or the date column, which is what the
    source pipeline actually grouped by.
    """
    out = df
    trend_key = trend_key or district_col
    if city_col and keywords:
        out = keyword_filter(out, city_col, keywords)
    if directory is not None:
        out = resolve_dimension(out, postcode_col, directory, directory_key, directory_value,
                                out_col=district_col)
    if store:
        # the counts and the join base read this intermediate: compute it once
        out = stored(out, "resolved")
    if quantile_method(out.sparkSession, approx) == "distributed":
        cols = list(dict.fromkeys([district_col, year_col, trend_key]))
        counts = stored(sale_counts(out, cols, date_col, price_col), "sale-counts")
        grains = {"district": [district_col], "yearly": [district_col, year_col], "trend": [trend_key]}
        if trend_key == district_col:
            del grains["trend"]
        medians = medians_at(counts, grains, "__v", "__n")
        series = counts.where(F.col(district_col).isNotNull() & F.col("__t").isNotNull()).select(
            F.col(district_col).alias("k"), F.col("__t").alias("t"), F.col("__v").alias("v"), F.col("__n").alias("n"))
    else:
        medians = {"district": group_median(out, district_col, price_col, "price", approx)}
        series = None
    out = attach_group_median(out, trend_key, price_col, "borough_price_trend", approx,
                              stats=medians.get("trend", medians["district"] if trend_key == district_col else None))
    out = attach_group_stat_join(out, [district_col, year_col], price_col,
                                 "district_yearly_medians", approx, stats=medians.get("yearly"))
    out = rolling_median(out, district_col, date_col, price_col, "avg_price_last_half",
                         days=window_days, slice_days=slice_days, approx=approx,
                         fallback_stats=medians["district"], counts=series)
    out = add_interaction(out, "advanced_property_type", "is_new_build", "property_type")
    out = add_interaction(out, "property_type_and_tenure", "is_leasehold", "property_type")
    return add_interaction(out, "property_type_and_district", district_col, "property_type")


def clean_augment(df: DataFrame, *, dtype_map: Mapping[str, str], postcode_col: str | None,
                  required_cols: Sequence[str] | None = None,
                  ts_format: str = DEFAULT_TS_FORMAT) -> DataFrame:
    """Side table: cast -> postcodes (when it has one) -> drop nulls."""
    out = cast_columns(df, dtype_map, ts_format)
    if postcode_col:
        out = normalise_postcodes(out, raw_col=postcode_col)
    return drop_null_rows(out, subset=list(required_cols) if required_cols else None)
