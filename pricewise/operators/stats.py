"""Shared aggregate helpers: exact/approximate quantiles, scalar subqueries,
and the size-checked broadcast join used wherever one side is an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.session import stored

# Bytes up to which an aggregate side is broadcast after its size was checked.
DEFAULT_BROADCAST_BYTES = 64 << 20
# percentile_approx accuracy when approx=True (relative rank error 1/accuracy).
APPROX_ACCURACY = 10_000


def quantile_expr(col: "Column | str", q: float, approx: bool = False) -> Column:
    """Exact linear-interpolated quantile (``percentile``) or ``percentile_approx``.

    The exact aggregate keeps a value->count map per group and merges partial
    maps map-side, so its memory follows distinct values, not rows. NaN is no value.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("double")
    c = F.when(~F.isnan(c), c)
    if approx:
        return F.percentile_approx(c, F.lit(q), F.lit(APPROX_ACCURACY))
    return F.percentile(c, F.lit(q))


def median_expr(col: "Column | str", approx: bool = False) -> Column:
    return quantile_expr(col, 0.5, approx)


QUANTILE_METHOD_CONF = "pricewise.quantile.method"


def quantile_method(spark, approx: bool = False) -> str:
    """'distributed' (default: exact, no large group's values ever meet in one
    task), 'percentile' (Spark's exact aggregate alone: its final merge holds
    every distinct value of a group in one task, so only for groups known to be
    small) or 'approx'. All but the last give the same rows. Read from the
    session conf ``pricewise.quantile.method``."""
    if approx:
        return "approx"
    method = spark.conf.get(QUANTILE_METHOD_CONF, "distributed")
    if method not in ("percentile", "distributed", "approx"):
        raise ValueError(f"{QUANTILE_METHOD_CONF} must be percentile, distributed or approx")
    return method


def quantile_scalar(df: DataFrame, col: str, q: float, approx: bool = False) -> Column:
    """The q-quantile of a whole column as a scalar-subquery Column."""
    method = quantile_method(df.sparkSession, approx)
    if method == "distributed":
        from pricewise.operators.quantiles import exact_quantiles
        return exact_quantiles(df, [], col, [q], ["__pw_q"]).scalar()
    return df.select(quantile_expr(col, q, method == "approx")).scalar()


def row_bytes(df: DataFrame) -> Column:
    """Estimated size of a row in memory: fixed widths, text and collections by their length."""
    total = F.lit(16)
    for f in df.schema:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind.startswith(("array", "map")):
            total = total + F.coalesce(F.size(c), F.lit(0)) * 48
        elif kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 24
        else:
            total = total + 16
    return total.cast("long")


def join_small(big: DataFrame, small: DataFrame, on: "str | Sequence[str | Column]", how: str = "left",
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with an aggregate ``small`` side, broadcasting it only after
    checking its size.

    The small side is written once to the shared folder (a lost executor
    re-reads it; nothing stays in executor memory) and its rows' bytes are
    summed; at or under ``max_bytes`` it is broadcast so the big side is never
    shuffled on a possibly skewed key. Above the bound the plan stays a shuffle
    join and AQE's skew-join split handles hot keys.
    """
    side = stored(small, "side")
    size = side.agg(F.sum(row_bytes(side))).first()[0] or 0
    return big.join(F.broadcast(side) if size <= max_bytes else side, on=on, how=how)
