"""Joins: dimension resolution, m:1 enrichment, group-stat attach, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.numeric import cast_numeric
from pricewise.functions.text import canonical_postcode
from pricewise.operators.stats import join_small

_KEY = "__pw_key"


def dimension_table(dim: DataFrame, dim_key: str, dim_value: str, out_col: str) -> DataFrame:
    """(canonical key -> value), one row per key, unusable (null) values removed.

    Grouping by the key makes the lookup m:1 even if the source repeats keys;
    the aggregate leaves the table hash-partitioned by key, so the following
    join reuses that partitioning instead of shuffling the dimension again.
    """
    return (dim.select(canonical_postcode(dim_key).alias(_KEY), F.col(dim_value).alias(out_col))
               .where(F.col(_KEY).isNotNull() & F.col(out_col).isNotNull())
               .groupBy(_KEY).agg(F.min(out_col).alias(out_col)))


def resolve_dimension(df: DataFrame, key_col: str, dim: DataFrame, dim_key: str,
                      dim_value: str, out_col: str = "district") -> DataFrame:
    """Attach ``out_col`` by canonical key. Rows whose non-null key has no
    usable dimension value are dropped; rows with a null key stay (null value).

    The dimension can be as large as the fact table (one row per postcode), so
    no broadcast is forced: Catalyst/AQE pick a broadcast only when the size
    statistics allow it, otherwise a sort-merge join with skew splitting.
    """
    lookup = dimension_table(dim, dim_key, dim_value, out_col)
    base = df.drop(out_col) if out_col in df.columns else df
    keyed = base.withColumn(_KEY, canonical_postcode(key_col))
    joined = keyed.join(lookup, on=_KEY, how="left")
    return joined.where(F.col(_KEY).isNull() | F.col(out_col).isNotNull()).drop(_KEY)


def augment_median(main: DataFrame, side: DataFrame, key: str, value_col: str,
                   how: str = "left", out_col: str | None = None, approx: bool = False,
                   max_broadcast_bytes: int | None = None) -> DataFrame:
    """m:1 enrichment: coerce ``value_col`` to double, take its median per key in
    the side table, then join. Pre-aggregating guarantees one match per row."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    for name, frame in (("main", main), ("side", side)):
        if key not in frame.columns:
            raise KeyError(f"join key {key!r} is no column of the {name} table")
    if value_col not in side.columns:
        raise KeyError(f"the side table has no column {value_col!r} to aggregate")
    from pricewise.operators.aggregates import keyed_median
    agg = keyed_median(side.withColumn(value_col, cast_numeric(value_col)), [key], value_col,
                       out_col or value_col, approx)
    if max_broadcast_bytes is None:  # one row per key can be as large as the side table
        return main.join(agg, on=key, how=how)
    return join_small(main, agg, on=key, how=how, max_bytes=max_broadcast_bytes)


def match_rate(df: DataFrame, col: str) -> DataFrame:
    """One row: share of rows whose ``col`` is not null."""
    return df.agg(F.avg(F.when(F.col(col).isNotNull(), 1.0).otherwise(0.0)).alias("match_rate"))


def check_match_rate(df: DataFrame, col: str, min_match_rate: float | None) -> float:
    """Raise when the share of matched rows is below ``min_match_rate`` (0/None skip). Pass a
    stored frame if it is used again: the check reads it once."""
    rate = match_rate(df, col).first()["match_rate"]
    rate = 0.0 if rate is None else float(rate)
    if min_match_rate and rate < min_match_rate:
        raise ValueError(f"only {rate:.2%} of the rows found a match, {min_match_rate:.2%} are required")
    return rate


def attach_group_stat_join(df: DataFrame, keys: Sequence[str], value_col: str, out_col: str,
                           approx: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """Left join of the per-(keys) median of ``value_col``. Null keys get null.

    The aggregate is combined map-side; its output (one row per key tuple) is
    broadcast only after its row count is checked. ``stats`` (keys, median)
    reuses medians already computed.
    """
    from pricewise.operators.aggregates import keyed_median
    if stats is None:
        stats = keyed_median(df, list(keys), value_col, out_col, approx)
    else:
        stats = stats.toDF(*keys, out_col)
    return join_small(df.drop(out_col) if out_col in df.columns else df, stats, on=keys, how="left")


def district_profile(district_lookup: DataFrame, yearly_lookup: DataFrame,
                     recent_lookup: DataFrame) -> DataFrame:
    """One small row per district: trend median, recent median and a
    year -> median map, from one union and one grouped pass.

    The yearly lookup's own (district, sold_year) columns are used where it has
    them, else its 'district_year' text is parsed. The map holds one entry per
    year of one district, so it stays small."""
    if "sold_year" in yearly_lookup.columns:
        place, year = F.col("district"), F.col("sold_year").cast("bigint")
    else:
        text = r"^(.*)_(-?[0-9]+)$"
        place, year = F.regexp_extract("district_year", text, 1), F.regexp_extract("district_year", text, 2).cast("bigint")

    def part(df: DataFrame, place, column: str, value) -> DataFrame:
        parts = {"__bpt": F.lit(None).cast("double"), "__recent": F.lit(None).cast("double"),
                 "__year": F.lit(None).cast("struct<__y:bigint,price:double>"), column: value}
        return df.select(place.alias("district"), *[c.alias(n) for n, c in parts.items()])

    price = F.col("price").cast("double")
    rows = (part(district_lookup, F.col("district"), "__bpt", price)
            .unionByName(part(recent_lookup, F.col("district"), "__recent", price))
            .unionByName(part(yearly_lookup, place, "__year", F.struct(year.alias("__y"), price.alias("price")))))
    return rows.groupBy("district").agg(
        F.max("__bpt").alias("__bpt"), F.max("__recent").alias("__recent"),
        F.map_from_entries(F.collect_list("__year")).alias("__years"))


def lookup_with_fallback(requests: DataFrame, district_col: str, year_col: str,
                         district_lookup: DataFrame, yearly_lookup: DataFrame,
                         recent_lookup: DataFrame, global_value) -> DataFrame:
    """Attach three trend values with fallbacks.

    - ``borough_price_trend``: district median, else ``global_value``
    - ``district_yearly_medians``: (district, year), else (district, year-1), else global
    - ``avg_price_last_half``: recent district median, else global

    The three lookups are folded into one per-district profile, so the
    request table (which can be as large as the data) takes one join,
    broadcast after a size check; ``global_value`` is a scalar Column.
    """
    prof = district_profile(district_lookup, yearly_lookup, recent_lookup) \
        .withColumnRenamed("district", "__pw_d")
    out = join_small(requests.withColumn("__pw_d", F.col(district_col)), prof, on="__pw_d", how="left")
    y = F.col(year_col).cast("bigint")
    g = global_value.cast("double")
    return (out.withColumns({
        "borough_price_trend": F.coalesce(F.col("__bpt"), g),
        "district_yearly_medians": F.coalesce(F.try_element_at("__years", y),
                                              F.try_element_at("__years", y - 1), g),
        "avg_price_last_half": F.coalesce(F.col("__recent"), g),
    }).drop("__pw_d", "__bpt", "__recent", "__years"))
