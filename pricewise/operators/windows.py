"""Window operators: trailing-window median, group medians on every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.dates import ntz_micros
from pricewise.operators.aggregates import group_median
from pricewise.operators.rolling import TARGET_GROUP_ROWS, US_PER_DAY, value_counts, window_medians
from pricewise.operators.stats import APPROX_ACCURACY, join_small
from pricewise.session import stored


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sliced(df: DataFrame, ts_col: str, days: int, slice_days: int) -> DataFrame:
    """Copy each row to its own time slice and to the following slices whose
    rows may look back at it (halo): ``__pw_slice`` and ``__pw_own``."""
    slice_us = slice_days * US_PER_DAY
    micros = ntz_micros(ts_col)
    own = F.floor(micros / F.lit(slice_us))
    last = F.floor((micros + F.lit(days * US_PER_DAY)) / F.lit(slice_us))
    return (df.withColumn("__pw_own_slice", own)
              .withColumn("__pw_slice", F.explode(F.sequence(own, F.greatest(own, last))))
              .withColumn("__pw_own", F.col("__pw_slice") == F.col("__pw_own_slice"))
              .drop("__pw_own_slice"))


def rolling_median(df: DataFrame, partition_col: str, ts_col: str, value_col: str,
                   out_col: str, days: int = 180, slice_days: "int | str | None" = "auto",
                   approx: bool = False, fallback: bool = True,
                   method: str = "pandas", fallback_stats: DataFrame | None = None,
                   counts: DataFrame | None = None, target_rows: int = TARGET_GROUP_ROWS) -> DataFrame:
    """Median of ``value_col`` over ``[ts - days, ts)`` within ``partition_col``.

    The left bound is included; the row itself and rows sharing its timestamp
    are excluded, so the value depends only on (key, ts). With ``fallback`` an
    empty window takes the key's overall median. Null keys get null.

    ``method='pandas'`` (default, exact): the rows are counted once by (key,
    instant, value); slices of ordinary keys and blocks of keys whose single
    window exceeds ``target_rows`` are solved apart (see ``rolling``), and one
    value per distinct (key, ts) is joined back. ``counts`` reuses a stored
    ``value_counts`` frame, ``slice_days`` is the slice width of ordinary keys
    ('auto': from the densest one's peak).
    ``method='window'`` keeps everything in the JVM with a RANGE-frame
    ``percentile`` (exact, but the frame is re-aggregated for every distinct
    timestamp: O(n x w)); ``approx=True`` uses ``percentile_approx`` there.
    ``fallback_stats`` (key, median) reuses an already computed key median.
    """
    if approx or method == "window":
        width = 4 * days if slice_days in ("auto", None) else int(slice_days)
        if width < 1:
            raise ValueError("slice_days must be positive")
        rolled = _rolling_window(df, partition_col, ts_col, value_col, out_col, days, width, approx)
    elif method == "pandas":
        if counts is None:
            counts = stored(value_counts(df, partition_col, ts_col, value_col), "value-counts")
        medians = window_medians(counts, days, slice_days, target_rows).toDF(partition_col, "__pw_ts", out_col)
        base = df.drop(out_col) if out_col in df.columns else df
        # one row per distinct (key, ts) on the right: the join never multiplies rows
        rolled = join_small(base.withColumn("__pw_ts", ntz_micros(ts_col)), medians,
                            on=[partition_col, "__pw_ts"], how="left").drop("__pw_ts")
    else:
        raise ValueError("method must be 'pandas' or 'window'")
    if not fallback:
        return rolled
    if fallback_stats is not None:
        overall = fallback_stats.toDF(partition_col, "__pw_overall")
    else:
        overall = group_median(df, partition_col, value_col, "__pw_overall", approx)
    return (join_small(rolled, overall, on=partition_col, how="left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.col("__pw_overall")))
            .drop("__pw_overall"))


def _rolling_window(df: DataFrame, partition_col: str, ts_col: str, value_col: str,
                    out_col: str, days: int, slice_days: int, approx: bool) -> DataFrame:
    agg = (f"percentile_approx({_q(value_col)}, 0.5, {APPROX_ACCURACY})" if approx
           else f"percentile(CAST({_q(value_col)} AS DOUBLE), 0.5)")
    window = (f"{agg} OVER (PARTITION BY {_q(partition_col)}, __pw_slice ORDER BY {_q(ts_col)} "
              f"RANGE BETWEEN INTERVAL '{days} 00:00:00' DAY TO SECOND PRECEDING "
              f"AND INTERVAL '0 00:00:00.000001' DAY TO SECOND PRECEDING)")
    return (_sliced(df, ts_col, days, slice_days).withColumn(out_col, F.expr(window))
            .where(F.col("__pw_own")).drop("__pw_slice", "__pw_own"))


def attach_group_median(df: DataFrame, key: str, value_col: str, out_col: str,
                        approx: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """Every row gets the median of ``value_col`` over its ``key`` group.

    Computed as a map-side-combined aggregate joined back (broadcast after a
    size check) rather than ``median() OVER (PARTITION BY key)``, which would
    buffer each whole group, including a hot one, inside a single task.
    """
    if stats is None:
        stats = group_median(df, key, value_col, out_col, approx)
    else:
        stats = stats.toDF(key, out_col)
    base = df.drop(out_col) if out_col in df.columns else df
    return join_small(base, stats, on=key, how="left")


