"""Rolling medians over value counts: selection by rank, crowded keys, bounded groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import rolling
from pricewise.session import stored

DAY = rolling.US_PER_DAY


def test_range_select_counts_weights():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n, levels = rng.integers(1, 60), rng.integers(1, 20)
        codes, weights = rng.integers(0, levels, n), rng.integers(0, 4, n)
        cuts = np.sort(rng.integers(0, n + 1, (30, 4)), axis=1)
        lo, hi = cuts[:, ::2], cuts[:, 1::2]
        rows = [np.sort(np.concatenate([np.repeat(codes[a:b], weights[a:b]) for a, b in zip(x, y)])) for x, y in zip(lo, hi)]
        some = np.array([len(r) > 0 for r in rows])
        rank = np.array([rng.integers(0, len(r)) for r in rows if len(r)])
        got = rolling.range_select(codes, weights, lo[some], hi[some], rank)
        assert got.tolist() == [r[k] for r, k in zip([r for r in rows if len(r)], rank)]


def brute(rows, days):
    """{(k, t): median} for rows (k, t, v)."""
    out = {}
    for k, t, _ in rows:
        w = [v for k2, t2, v in rows if k2 == k and t - days * DAY <= t2 < t and v is not None]
        out[k, t] = float(np.median(w)) if w else None
    return out


def crowd(seed):
    """One key with all rows inside one window, ties, crowded instants, a thin early stretch."""
    rng = random.Random(seed)
    at = [rng.randrange(0, 100 * DAY) for _ in range(500)] + [rng.randrange(0, 100) * DAY for _ in range(300)]
    at += [37 * DAY] * 200 + [217 * DAY] * 30 + [rng.randrange(100, 500) * DAY for _ in range(300)]
    value = lambda: rng.choice([rng.gauss(0, 1), float(rng.randrange(5)), float(rng.randrange(5)), None])
    rows = [("hot", t, value()) for t in at]
    rows += [("trend", t * DAY // 4, t * 0.1 + rng.random()) for t in range(900)]
    return rows + [("cold", rng.randrange(0, 400) * DAY, value()) for _ in range(20)]


@pytest.mark.parametrize("seed,target", [(1, 60), (2, 200)])
def test_crowded_keys_equal_brute_force(spark, seed, target):
    rows = crowd(seed)
    df = spark.createDataFrame(rows, "k string, t long, v double")
    counts = stored(df.groupBy("k", "t", "v").agg(F.count("*").alias("n")), "counts")
    got = {(r.k, r.t): r.m for r in rolling.window_medians(counts, 180, target_rows=target).collect()}
    want = brute(rows, 180)
    assert got.keys() == want.keys()
    for k in want:
        assert (got[k] is None and want[k] is None) or abs(got[k] - want[k]) < 1e-12, (k, got[k], want[k])


def test_one_window_of_one_key_is_split(spark):
    """All rows of one key within 180 days: no task gets more than a few blocks of them."""
    rows = 40_000
    counts = stored(spark.range(rows).select(F.lit("hot").alias("k"), (F.col("id") * 1_000_003 % (150 * DAY)).alias("t"),
                                             F.rand(5).alias("v"), F.lit(1).cast("long").alias("n")), "counts")
    pieces = rolling.crowded_pieces(counts, 180, 4_000)
    size = max(4_000 // 8, int(rows ** 0.5))
    largest, groups = pieces.groupBy("k", "i").count().agg(F.max("count"), F.count("*")).first()
    assert groups >= rows / size and largest < 12 * size < rows / 4
    got = {r.t: r.m for r in rolling.window_medians(counts, 180, target_rows=4_000).collect()}
    local = counts.toPandas().sort_values("t")
    t, v = local["t"].to_numpy(), local["v"].to_numpy()
    for i in range(0, rows, 997):
        w = v[np.searchsorted(t, t[i] - 180 * DAY):np.searchsorted(t, t[i])]
        assert (got[t[i]] is None) if not len(w) else abs(got[t[i]] - np.median(w)) < 1e-12
