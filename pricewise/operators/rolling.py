"""Trailing-window medians over value counts, exact for keys of any size.

Input is one row per (key, instant, value) with its count ``n``. Ordinary keys
are cut into time slices, each with the window's length of earlier rows beside
it. A key whose single window holds more rows than a task should is cut finer:

1. its time is cut into blocks and its values into buckets of about ``size``
   rows; block borders are repeated one window later, so what leaves the
   window while a block's instants pass lies in few blocks;
2. between the leaving and the block's own rows lie whole blocks that stay in
   the window all the time. Counts per (block, bucket), summed up over time,
   say which buckets hold the median whatever the moving rows do;
3. a block's task gets its own rows, the leaving rows and, of the staying rows,
   the few buckets around the median with the number of values below them, and
   selects by rank over all three.

Selection is vectorised: ``range_select`` walks the bits of rank-compressed
values and answers all windows of a task at once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.dates import ntz_micros
from pricewise.operators.stats import join_small
from pricewise.session import stored

US_PER_DAY = 86_400_000_000
# Rows one task's group may hold.
TARGET_GROUP_ROWS = 2_000_000
_FAR = 1 << 61


def value_counts(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(k, t in microseconds, v, n): rows per key, instant and value; NaN is no value. Rows
    without key or instant take no part."""
    v = F.col(value).cast("double")
    return (df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
            .select(F.col(key).alias("k"), ntz_micros(ts).alias("t"), F.when(~F.isnan(v), v).alias("v"))
            .groupBy("k", "t", "v").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ selection

def range_select(codes: np.ndarray, weights: np.ndarray, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Code of the value at ``rank`` (from 0, counting weights) among the positions
    [lo, hi) of each query; ``lo`` and ``hi`` are (queries, ranges) and a query's ranges are
    taken together. Bit by bit from the highest: positions are split into zeros and ones, in
    order, and each query follows the side its rank falls into."""
    out = np.zeros(len(rank), np.int64)
    rank = rank.copy()
    for bit in reversed(range(int(codes.max()).bit_length() if len(codes) else 0)):
        one = (codes >> bit) & 1 == 1
        zeros = np.concatenate(([0], np.cumsum(~one)))
        weight = np.concatenate(([0], np.cumsum(np.where(one, 0, weights))))
        left = (weight[hi] - weight[lo]).sum(1)
        right = rank >= left
        rank -= np.where(right, left, 0)
        out |= right.astype(np.int64) << bit
        z_lo, z_hi = zeros[lo], zeros[hi]
        lo = np.where(right[:, None], zeros[-1] + lo - z_lo, z_lo)
        hi = np.where(right[:, None], zeros[-1] + hi - z_hi, z_hi)
        order = np.concatenate((np.flatnonzero(~one), np.flatnonzero(one)))
        codes, weights = codes[order], weights[order]
    return out


def range_medians(values: np.ndarray, weights: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                  below: int = 0, total: int = 0) -> np.ndarray:
    """Weighted medians over ranges of positions (NaN without weight). ``below`` values that
    are not here lie under all selected ones, ``total`` counts all constant values instead of
    those in the first range."""
    levels, codes = np.unique(values, return_inverse=True)
    w = np.concatenate(([0], np.cumsum(weights)))
    here = w[hi] - w[lo]
    n = here[:, 1:].sum(1) + total if total else here.sum(1)
    out = np.full(len(lo), np.nan)
    some = n > 0
    if not some.any():
        return out
    ends = []
    for rank in ((n - 1) // 2, n // 2):
        rank = (rank - below)[some]
        if (rank < 0).any() or (rank >= here.sum(1)[some]).any():
            raise ValueError("a median fell outside its buckets")
        ends.append(levels[range_select(codes.reshape(-1), weights, lo[some], hi[some], rank)])
    out[some] = np.where(ends[0] == ends[1], ends[0], (ends[0] + ends[1]) / 2)
    return out


# ------------------------------------------------------------------ ordinary keys

def _slices(counts: DataFrame, days: int, slice_days: int) -> DataFrame:
    """Each row in its own time slice (``own``) and in the following ones that look back at it."""
    us = slice_days * US_PER_DAY
    at = F.floor(F.col("t") / F.lit(us))
    last = F.floor((F.col("t") + F.lit(days * US_PER_DAY)) / F.lit(us))
    return (counts.withColumn("__at", at).withColumn("slice", F.explode(F.sequence(at, F.greatest(at, last))))
            .withColumn("own", F.col("slice") == F.col("__at")).drop("__at"))


def _roll(days: int):
    us = days * US_PER_DAY

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key, names = pd.factorize(pdf["k"], use_na_sentinel=False)
        t = pdf["t"].to_numpy(np.int64)
        order = np.lexsort((t, key))
        pdf, key, t = pdf.iloc[order], key[order], t[order]
        v, own = pdf["v"].to_numpy(np.float64), pdf["own"].to_numpy(bool)
        n = np.where(np.isnan(v), 0, pdf["n"].to_numpy(np.int64))
        instants = np.unique(t)
        place = key * (len(instants) + 1) + np.searchsorted(instants, t)
        ask = _first_own(place, own)
        since = key[ask] * (len(instants) + 1) + np.searchsorted(instants, t[ask] - us)
        lo, hi = np.searchsorted(place, since), np.searchsorted(place, place[ask])
        m = range_medians(np.nan_to_num(v, nan=0.0, posinf=np.inf, neginf=-np.inf), n, lo[:, None], hi[:, None])
        return pd.DataFrame({"k": _plain(np.asarray(names, dtype=object)[key[ask]]), "t": t[ask], "m": m})

    return run


def _plain(keys) -> pd.Series:
    """Keys as plain objects, whatever string type pandas would choose."""
    return pd.Series(list(keys), dtype=object)


def _first_own(place: np.ndarray, own: np.ndarray) -> np.ndarray:
    """One position per place that has an own row."""
    at = np.flatnonzero(own)
    return at[np.concatenate(([True], place[at][1:] != place[at][:-1]))] if len(at) else at


# ------------------------------------------------------------------ keys with crowded windows

def _borders(rows: DataFrame, column: str, size: int, parts: int) -> dict:
    """Per key at most ``parts`` + 1 borders of ``column`` with about ``size`` rows between
    two of them. They are few: rows / size numbers in all reach the driver."""
    many = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    cut = (rows.where(F.col(column).isNotNull() & (F.col("n") <= size)).select("k", column, many)
           .groupBy("k").agg(F.percentile_approx(column, F.array(*[F.lit(i / parts) for i in range(parts + 1)]),
                                                 F.lit(4 * parts + 100)).alias("b")))
    return {r["k"]: np.array(r["b"]) for r in cut.collect()}


def crowded_pieces(counts: DataFrame, days: int, target_rows: int) -> DataFrame:
    """What the tasks of crowded keys get: (k, i: time block, kind, t, v, n). kind 0: values that
    stay in the window all the time (around the median), 1: the block's own rows, 2: rows that
    leave while its instants pass, 3: t values stay in all, n of them below kind 0."""
    spark, us = counts.sparkSession, days * US_PER_DAY
    heaviest = counts.groupBy("k").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    # blocks x buckets of a key stay below its rows
    size = max(1, target_rows // 8, math.isqrt(heaviest))
    parts = max(1, math.ceil(heaviest / size))
    instants = counts.groupBy("k", "t").agg(F.sum("n").alias("n")).where(F.col("n") > size).collect()  # rows / size at most
    cuts, values = _borders(counts, "t", size, parts), _borders(counts, "v", size, parts)
    for r in instants:  # an instant of its own block: its rows never count for itself
        cuts[r["k"]] = np.append(cuts.get(r["k"], np.zeros(0, np.int64)), [r["t"], r["t"] + 1])
    cuts = {k: np.unique(np.concatenate((c, c + us)).astype(np.int64)) for k, c in cuts.items()}
    values = {k: np.unique(values.get(k, np.zeros(0))) for k in cuts}

    def assign(frames):
        for f in frames:
            f = f.reset_index(drop=True)
            f["b"], f["u"] = 0, 0
            for k, at in f.groupby("k").indices.items():
                f.iloc[at, f.columns.get_loc("b")] = np.searchsorted(cuts[k], f["t"].to_numpy()[at], side="right")
                f.iloc[at, f.columns.get_loc("u")] = np.searchsorted(values[k], f["v"].to_numpy()[at], side="right")
            f["k"] = _plain(f["k"])
            yield f

    kt = dict(counts.dtypes)["k"]
    placed = stored(counts.mapInPandas(assign, f"k {kt}, t long, v double, n long, b long, u long"), "placed")
    weight = {}
    for r in placed.where("v is not null").groupBy("k", "b").agg(F.sum("n").alias("n")).collect():  # a row per block
        weight.setdefault(r["k"], {})[r["b"]] = r["n"]
    plans = []
    for k, c in cuts.items():
        n = len(c) + 1
        i = np.arange(n)
        start, end = np.concatenate(([-_FAR], c)), np.concatenate((c, [_FAR]))
        leave, stay = np.searchsorted(c, start - us, side="right"), np.searchsorted(c, end - us - 1, side="right") + 1
        alone = (end - start == 1) & np.isin(start - us, c)
        stay = np.minimum(np.where(alone, leave, stay), i)
        own = end - start > 1
        w = np.concatenate(([0], np.cumsum([weight.get(k, {}).get(b, 0) for b in range(n)])))
        moving = w[stay] - w[np.minimum(leave, stay)] + np.where(own, w[i + 1] - w[i], 0)
        plans.append(pd.DataFrame({"k": k, "i": i, "leave": leave, "stay": stay, "own": own, "moving": moving,
                                   "buckets": len(values[k]) + 1}))
    blocks = stored(spark.createDataFrame(pd.concat(plans), f"k {kt}, i long, leave long, stay long, own boolean, "
                                          "moving long, buckets long"), "blocks")

    # staying values per (block, bucket): sums over time at the block less those where staying begins
    cells = placed.where("v is not null").select("k", "u", "b", "n").unionByName(
        blocks.select("k", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("u"), F.col("i").alias("b"),
                      F.lit(0).cast("long").alias("n")))
    cells = cells.groupBy("k", "u", "b").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("k", "u").orderBy("b")) - F.col("n")
    cells = stored(cells.select("k", "u", "b", before.alias("p")), "cells")
    grid = (blocks.join(cells.withColumnRenamed("b", "i"), ["k", "i"])
            .join(cells.select("k", "u", F.col("b").alias("stay"), F.col("p").alias("q")), ["k", "u", "stay"])
            .withColumn("m", F.col("p") - F.col("q")))
    per = Window.partitionBy("k", "i")
    grid = (grid.withColumn("below", F.sum("m").over(per.orderBy("u")) - F.col("m"))
            .withColumn("all", F.sum("m").over(per)).where("m > 0"))
    near = stored(grid.where((F.col("below") + F.col("m") > (F.col("all") - 1) / 2 - F.col("moving") - 2)
                             & (F.col("below") < (F.col("all") + F.col("moving")) / 2 + 2)), "near")
    # blocks of one bucket in chunks, so that a bucket near every median is no hot join key
    chunk = 64
    wanted = near.where("stay < i").select("k", "i", "u", "stay", F.explode(F.sequence(
        F.floor(F.col("stay") / chunk), F.floor((F.col("i") - 1) / chunk))).alias("c"))
    staying = (placed.where("v is not null").withColumn("c", F.floor(F.col("b") / chunk))
               .join(wanted, ["k", "u", "c"]).where("b >= stay and b < i")
               .groupBy("k", "i", "v").agg(F.sum("n").alias("n")))
    kind = lambda df, n, t: df.select("k", "i", F.lit(n).alias("kind"), t.cast("long").alias("t"), "v", "n")
    null = F.lit(None)
    mine = placed.withColumnRenamed("b", "i").join(blocks.select("k", "i", "own"), ["k", "i"])
    alone = mine.where("not own").select("k", "i", "t").distinct().select("k", "i", "t", null.cast("double").alias("v"), F.lit(0).cast("long").alias("n"))
    leaving = blocks.where("leave < stay").select("k", "i", F.explode(F.sequence("leave", F.col("stay") - 1)).alias("b"))
    facts = near.groupBy("k", "i").agg(F.max("all").alias("t"), F.min("below").alias("n")).withColumn("v", null.cast("double"))
    return (kind(staying, 0, null).unionByName(kind(mine.where("own"), 1, F.col("t"))).unionByName(kind(alone, 1, F.col("t")))
            .unionByName(kind(placed.where("v is not null").join(leaving, ["k", "b"]), 2, F.col("t")))
            .unionByName(kind(facts, 3, F.col("t"))))


def _merge(days: int):
    us = days * US_PER_DAY

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = pdf["kind"].to_numpy()
        facts = pdf[kind == 3]
        total, below = (int(facts["t"].iloc[0]), int(facts["n"].iloc[0])) if len(facts) else (0, 0)
        fixed = pdf[kind == 0]
        moving = pdf[(kind == 1) | (kind == 2)].sort_values("t", kind="stable")
        ask = np.unique(pdf["t"].to_numpy()[kind == 1]).astype(np.int64)
        t, v = moving["t"].to_numpy(np.int64), moving["v"].to_numpy(np.float64)
        n = np.where(np.isnan(v), 0, moving["n"].to_numpy(np.int64))
        c = len(fixed)
        lo = np.stack([np.zeros(len(ask), np.int64), c + np.searchsorted(t, ask - us)], 1)
        hi = np.stack([np.full(len(ask), c), c + np.searchsorted(t, ask)], 1)
        m = range_medians(np.concatenate((fixed["v"].to_numpy(np.float64), np.where(np.isnan(v), 0.0, v))),
                          np.concatenate((fixed["n"].to_numpy(np.int64), n)), lo, hi, below, total)
        return pd.DataFrame({"k": _plain([pdf["k"].iloc[0]] * len(ask)), "t": ask, "m": m})

    return run


# ------------------------------------------------------------------ both

def window_medians(counts: DataFrame, days: int, slice_days: "int | str | None" = "auto",
                   target_rows: int = TARGET_GROUP_ROWS) -> DataFrame:
    """(k, t, m): the median over [t - days, t) of every key and instant in ``counts`` (a stored
    table of k, t, v, n); null where the window holds no value."""
    kt = dict(counts.dtypes)["k"]
    schema = f"k {kt}, t long, m double"
    stretch = F.floor(F.col("t") / F.lit(days * US_PER_DAY))
    peaks = stored(counts.groupBy("k", stretch.alias("s")).agg(F.count(F.lit(1)).alias("n"))
                   .groupBy("k").agg(F.max("n").alias("peak"), F.sum("n").alias("n")), "peaks")
    # a window covers two stretches at most; keys beyond the target number rows / target_rows at most
    busy = F.col("peak") > target_rows
    peak, n, crowded = peaks.agg(F.max(F.when(~busy, F.col("peak"))), F.sum(F.when(~busy, F.col("n"))),
                                 F.count(F.when(busy, 1))).first()
    if slice_days == "auto":
        slice_days = max(1, min(target_rows * days // peak - days, 16 * days)) if peak else 4 * days
    slice_days = int(slice_days or 4 * days)
    if slice_days < 1:
        raise ValueError("slice_days must be positive")
    ordinary = counts
    if crowded:
        marked = join_small(counts, peaks.where(busy).select("k", F.lit(True).alias("__busy")), on="k", how="left")
        ordinary = marked.where("__busy is null").drop("__busy")
    groups = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                 math.ceil((n or 0) * (1 + days / slice_days) / target_rows))
    out = (_slices(ordinary, days, slice_days).withColumn("g", F.pmod(F.xxhash64("k"), F.lit(groups)))
           .groupBy("g", "slice").applyInPandas(_roll(days), schema))
    if crowded:
        pieces = crowded_pieces(stored(marked.where("__busy").drop("__busy"), "crowded"), days, target_rows)
        out = out.unionByName(pieces.groupBy("k", "i").applyInPandas(_merge(days), schema))
    return out.select("k", "t", F.when(~F.isnan("m"), F.col("m")).alias("m"))
