"""Property checks against brute force on small random fixtures."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricewise.operators import clean as C
from pricewise.operators import enrich as EN
from pricewise.operators import windows as WN
from pricewise.operators.quantiles import exact_quantiles

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.sampled_from(["a", "b", "c"])
values = st.integers(min_value=-50, max_value=50).map(float)


specials = st.one_of(values, st.floats(allow_nan=True, allow_infinity=True), st.none(),
                     st.sampled_from([float("inf"), float("-inf"), -0.0, 0.0]),
                     st.integers(min_value=0, max_value=9).map(lambda i: 1e9 + i * 1e-6))


def _quantile(vals, q):
    """Linear interpolation between ranks; equal neighbours and whole ranks need none."""
    vals = sorted(vals)
    if not vals:
        return None
    pos = (len(vals) - 1) * q
    lo, hi, frac = vals[int(np.floor(pos))], vals[int(np.ceil(pos))], pos - np.floor(pos)
    return lo if lo == hi or frac == 0 else (1 - frac) * lo + frac * hi


@SETTINGS
@given(st.lists(st.tuples(keys, specials), min_size=1, max_size=60),
       st.lists(st.floats(min_value=0.0, max_value=1.0), min_size=1, max_size=3))
def test_exact_quantiles_equal_linear_interpolation(spark, data, qs):
    df = spark.createDataFrame([*data, (None, 1.0), ("void", None), ("void", None)], "k string, v double")
    names = [f"q{i}" for i in range(len(qs))]
    for light_rows in (50_000, 5, 0):
        got = {r.k: [r[n] for n in names] for r in
               exact_quantiles(df, ["k"], "v", qs, names, light_rows=light_rows).collect()}
        assert set(got) == {k for k, _ in data} | {"void"}
        assert got["void"] == [None] * len(qs)
        for k in {k for k, _ in data}:
            vals = [v for kk, v in data if kk == k and v is not None and not np.isnan(v)]
            for g, w in zip(got[k], [_quantile(vals, q) for q in qs]):
                assert (g is None and w is None) or np.isclose(g, w, rtol=1e-12, atol=1e-9, equal_nan=True), (k, g, w)


def test_selection_on_a_large_narrow_group(spark):
    from pyspark.sql import functions as F
    # a narrow range, heavy ties, infinities and one skewed key
    df = spark.range(120_000).select(
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("k"),
        F.when(F.col("id") % 5000 == 1, float("inf")).when(F.col("id") % 3 == 0, 1e9)
         .otherwise(1e9 + F.pmod(F.xxhash64("id"), F.lit(100_000)) * 1e-4).alias("v"))
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    names = [f"q{i}" for i in range(len(qs))]
    local = df.toPandas()
    for light_rows in (20_000, 0):
        for r in exact_quantiles(df, ["k"], "v", qs, names, light_rows=light_rows).collect():
            vals = local[local.k == r.k].v.tolist()
            assert np.allclose([r[n] for n in names], [_quantile(vals, q) for q in qs], rtol=1e-14, atol=0)
    whole = exact_quantiles(df, [], "v", qs, names, light_rows=0).first()
    assert np.allclose(list(whole), [_quantile(local.v.tolist(), q) for q in qs], rtol=1e-14, atol=0)


def _brute_rolling(rows, days):
    out = {}
    for i, k, t, v in rows:
        window = [v2 for _, k2, t2, v2 in rows if k2 == k and t - dt.timedelta(days=days) <= t2 < t]
        out[i] = float(np.median(window)) if window else None
    return out


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(min_value=0, max_value=400), values), min_size=1, max_size=50),
       st.sampled_from([3, 30, 365]))
def test_rolling_median_equals_brute_force(spark, data, slice_days):
    base = dt.datetime(2020, 1, 1)
    rows = [(i, k, base + dt.timedelta(days=d), v) for i, (k, d, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp_ntz, v double")
    got = {r.id: r.m for r in WN.rolling_median(df, "k", "t", "v", "m", days=30, slice_days=slice_days,
                                                fallback=False).collect()}
    want = _brute_rolling(rows, 30)
    for i in want:
        assert (got[i] is None and want[i] is None) or abs(got[i] - want[i]) < 1e-9, (i, got[i], want[i])


@SETTINGS
@given(st.lists(st.tuples(keys, values), min_size=1, max_size=40), st.floats(min_value=0.0, max_value=1.0))
def test_clip_never_raises_max_and_left_joins_keep_rows(spark, data, q):
    df = spark.createDataFrame(data, "k string, v double")
    clipped = C.clip_upper_quantile(df, "v", q).collect()
    assert max(r.v for r in clipped) <= max(v for _, v in data)
    assert len(clipped) == len(data)
    side = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("z", 2.0)], "k string, x double")
    assert EN.augment_median(df, side, "k", "x").count() == len(data)
    assert EN.attach_group_stat_join(df, ["k"], "v", "m").count() == len(data)
