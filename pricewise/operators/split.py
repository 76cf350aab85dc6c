"""Repeatable exact splits by hash rank.

A row's position is its rank in ``(sha256(seed:id), id)`` order inside its
stratum. The rank is computed without a global sort or an unpartitioned
window: rows fall into hash buckets (equal-width on a uniform hash, so the
buckets are balanced even when one stratum holds most rows), are ranked
inside their (stratum, bucket), and get the exclusive prefix count of the
preceding buckets from a small (strata x buckets) table that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.numeric import price_band
from pricewise.operators.stats import join_small

HASH = "__pw_hash"
RANK = "__pw_rank"
SIZE = "__pw_n"
_BUCKET = "__pw_bucket"
DEFAULT_BUCKETS = 256
# auto sizing: about this many rows per (stratum, bucket) rank window
ROWS_PER_BUCKET = 1_000_000


def auto_buckets(df: DataFrame, floor: int = DEFAULT_BUCKETS) -> int:
    """Bucket count for ~ROWS_PER_BUCKET rows per rank window (one count pass)."""
    return max(floor, -(-df.count() // ROWS_PER_BUCKET))


def as_fraction(x: float) -> Fraction:
    """Exact rational of a share given in decimal (0.15 -> 3/20)."""
    return Fraction(str(x)).limit_denominator(10**6)


def ceil_share(count_sql: str, share: Fraction) -> Column:
    """ceil(count * share) in integer arithmetic (no float rounding at exact products)."""
    p, q = share.numerator, share.denominator
    return F.expr(f"(({count_sql}) * {p} + {q - 1}) div {q}")


def hash_key(id_col: str, seed: int) -> Column:
    """sha256 of 'seed:id' as lower-case hex (DuckDB's sha256 gives the same)."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def hash_rank(df: DataFrame, id_col: str, seed: int = 42, strata: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """Add ``__pw_rank`` (1-based rank within the stratum) and ``__pw_n`` (stratum size).

    ``buckets`` None sizes the hash buckets from the row count; any value gives
    the same ranks, it only sets how much one rank window sorts.
    """
    strata = list(strata)
    buckets = buckets or auto_buckets(df)
    h = hash_key(id_col, seed)
    # first 8 hex digits -> [0, 2^32): a bucket index monotone in the hash order
    prefix = F.conv(F.substring(F.col(HASH), 1, 8), 16, 10).cast("bigint")
    keyed = (df.withColumn(HASH, h)
               .withColumn(_BUCKET, F.floor(prefix * F.lit(buckets) / F.lit(2 ** 32)).cast("int")))
    counts = keyed.groupBy(*strata, _BUCKET).agg(F.count(F.lit(1)).alias("__pw_cnt"))
    by_stratum = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    offsets = counts.select(
        *strata, _BUCKET,
        F.coalesce(F.sum("__pw_cnt").over(by_stratum.orderBy(_BUCKET)
                                          .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__pw_off"),
        F.sum("__pw_cnt").over(by_stratum).alias(SIZE))
    # offsets has at most (#strata x buckets) rows: a proven bound for the broadcast
    ranked = join_small(keyed, offsets, on=[*strata, _BUCKET], how="inner")
    local = F.row_number().over(Window.partitionBy(*strata, _BUCKET).orderBy(HASH, id_col))
    return (ranked.withColumn(RANK, F.col("__pw_off") + local)
                  .drop("__pw_off", _BUCKET))


def random_split(df: DataFrame, id_col: str, test_frac: float = 0.2, seed: int = 42,
                 out_col: str = "split", buckets: int | None = None) -> DataFrame:
    """'train'/'test' with exactly ceil(test_frac * n) test rows (lowest hash ranks)."""
    ranked = hash_rank(df, id_col, seed, (), buckets)
    n_test = ceil_share(SIZE, as_fraction(test_frac))
    return (ranked.withColumn(out_col, F.when(F.col(RANK) <= n_test, "test").otherwise("train"))
                  .drop(HASH, RANK, SIZE))


def stratified_split(df: DataFrame, id_col: str, price_col: str = "price",
                     test_frac: float = 0.15, val_frac: float = 0.15, seed: int = 42,
                     out_col: str = "split", band_col: str | None = None,
                     buckets: int | None = None) -> DataFrame:
    """'test' / 'validation' / 'train' with exact shares inside each price band.

    Per band of n rows: test = ceil(test_frac * n); validation =
    ceil(val_frac / (1 - test_frac) * (n - test)); the rest is train. Rows
    without a band (price <= 0 or null) form their own stratum.
    """
    band = "__pw_band"
    source = F.col(band_col) if band_col else price_band(price_col)
    keyed = df.withColumn(band, F.coalesce(source.cast("int"), F.lit(0)))
    ranked = hash_rank(keyed, id_col, seed, [band], buckets)
    t = as_fraction(test_frac)
    v = as_fraction(val_frac) / (1 - t)
    ranked = ranked.withColumn("__pw_ntest", ceil_share(SIZE, t))
    ranked = ranked.withColumn("__pw_nval", ceil_share(f"{SIZE} - __pw_ntest", v))
    label = (F.when(F.col(RANK) <= F.col("__pw_ntest"), "test")
              .when(F.col(RANK) <= F.col("__pw_ntest") + F.col("__pw_nval"), "validation")
              .otherwise("train"))
    return (ranked.withColumn(out_col, label)
                  .drop(HASH, RANK, SIZE, band, "__pw_ntest", "__pw_nval"))
