"""Exact quantiles by narrowing brackets: rounds, weights, grains, what is shuffled, when jobs run."""

import json
import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import quantiles
from pricewise.operators.quantiles import exact_quantiles, medians_at
from pricewise.plans import pipelines
from tests.conftest import SF001, rows

QS = [0.0, 0.01, 0.3, 0.5, 0.77, 1.0]
NAMES = [f"q{i}" for i in range(len(QS))]


def want(values):
    return [float(np.quantile(values, q, method="linear")) for q in QS]


@pytest.fixture
def tight(monkeypatch):
    """Brackets of 20 rows and few bins: many rounds."""
    monkeypatch.setattr(quantiles, "BRACKET_ROWS", 20)
    monkeypatch.setattr(quantiles, "BINS", 64)


def test_many_rounds_on_uneven_values(spark, tight):
    rng = np.random.default_rng(4)
    groups = {"even": rng.random(3000), "tail": rng.standard_cauchy(3000) ** 5, "tiny": 1.0 + rng.random(2000) * 1e-12,
              "ties": rng.integers(0, 4, 3000).astype(float), "one": np.full(2500, 7.0),
              "signs": np.concatenate([-np.exp(rng.normal(0, 6, 1500)), np.exp(rng.normal(0, 6, 1500))])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: [r[n] for n in NAMES] for r in exact_quantiles(df, ["k"], "v", QS, NAMES, light_rows=100).collect()}
    for k, vs in groups.items():
        assert np.allclose(got[k], want(vs), rtol=1e-12, atol=0), k


def test_rounds_beside_infinities(spark, tight):
    inf = float("inf")
    values = [-inf] * 300 + [float(i) for i in range(1000)] + [inf] * 300
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (got,) = exact_quantiles(df, [], "v", [0.1, 0.18, 0.3, 0.5, 0.9], list("abcde"), light_rows=0).collect()
    assert tuple(got) == (-inf, -inf, values[int(1599 * .3)] + (1599 * .3) % 1, 499.5, inf)


@pytest.mark.parametrize("light_rows", [None, 3])
def test_weights_stand_for_rows(spark, light_rows):
    rng = np.random.default_rng(1)
    data = [("ab"[i % 2], float(rng.integers(0, 40)), int(rng.integers(1, 5))) for i in range(200)] + [("c", None, 3)]
    df = spark.createDataFrame(data, "k string, v double, n long")
    got = {r.k: [r[n] for n in NAMES] for r in exact_quantiles(df, ["k"], "v", QS, NAMES, light_rows, "n").collect()}
    for k in "ab":
        assert np.allclose(got[k], want(np.repeat([d[1] for d in data if d[0] == k], [d[2] for d in data if d[0] == k])))
    assert got["c"] == [None] * len(QS)


@pytest.mark.parametrize("small", [True, False])
def test_medians_at_several_grains(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(quantiles, "SMALL_BYTES", -1)
        monkeypatch.setattr(quantiles, "LIGHT_ROWS", 4)
    data = [("a", 1, 5.0, 2), ("a", 1, 9.0, 1), ("a", 2, 1.0, 4), (None, 2, 100.0, 9), ("b", None, 3.0, 1), ("b", 1, None, 2)]
    data += [("a", 3, float(i % 7), 1 + i % 3) for i in range(20)]
    df = spark.createDataFrame(data, "d string, y int, v double, n long")
    got = medians_at(df, {"d": ["d"], "dy": ["d", "y"], "y": ["y"]}, "v", "n")

    def brute(key):
        groups = {}
        for d in data:
            if None not in key(d):
                groups.setdefault(key(d), []).extend([d[2]] * d[3] if d[2] is not None else [])
        return sorted(((*k, float(np.median(v)) if v else None) for k, v in groups.items()), key=repr)

    assert rows(got["d"]) == brute(lambda d: (d[0],))
    assert rows(got["dy"]) == brute(lambda d: (d[0], d[1]))
    assert rows(got["y"]) == brute(lambda d: (d[1],))


def test_small_inputs_are_planned_without_a_job(spark):
    sc = spark.sparkContext
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    sc.setJobGroup("planning", "quantiles")
    try:
        exact_quantiles(df, ["o_custkey"], "o_totalprice", [0.5], ["m"])
        exact_quantiles(df, [], "o_totalprice", [0.5], ["m"])
        assert not sc.statusTracker().getJobIdsForGroup("planning")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_only_brackets_are_shuffled(tmp_path):
    """10 million different values: less than 5 % of the column's bytes cross the network."""
    code = textwrap.dedent(f"""
        from pricewise.session import get_session
        spark = get_session("local[4]", shuffle_partitions=4, extra={{"spark.eventLog.enabled": "true",
            "spark.eventLog.compress": "false", "spark.eventLog.dir": "{tmp_path}"}})
        from pyspark.sql import functions as F
        from pricewise.operators.quantiles import exact_quantiles
        df = spark.range(10_000_000).select((F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("v"))
        (got,) = exact_quantiles(df, [], "v", [0.5, 0.99], ["a", "b"]).collect()
        (under,) = df.agg(F.count_if(F.col("v") < got.a), F.count_if(F.col("v") < got.b)).collect()
        assert tuple(under) == (5_000_000, 9_900_000), under
        spark.stop()""")
    run = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                         capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    shuffled = 0
    for folder, _, files in os.walk(tmp_path):
        for name in files:
            if name.endswith(".crc"):
                continue
            with open(os.path.join(folder, name)) as f:
                for event in map(json.loads, f):
                    if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                        shuffled += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    assert 0 < shuffled < 0.05 * 8 * 10_000_000, shuffled


def test_engineered_sales_exchange_the_rows_once(spark):
    sales = spark.read.parquet(f"{SF001}/orders.parquet").select(
        F.concat(F.lit("d"), F.col("o_custkey") % 7).alias("district"), F.year("o_orderdate").cast("long").alias("sold_year"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"), F.col("o_totalprice").cast("double").alias("price"),
        F.lit("D").alias("property_type"), F.lit("N").alias("is_new_build"), F.lit("F").alias("is_leasehold"))

    def exchanges(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return sum("Exchange" in line and "BroadcastExchange" not in line for line in plan.split("== Initial Plan ==")[0].splitlines())

    counts = pipelines.sale_counts(sales, ["district", "sold_year"], "date", "price")
    assert exchanges(counts) == 1
    for trend in ("district", "date"):
        out = pipelines.engineer_sales(sales, directory=None, city_col=None, trend_key=trend)
        assert exchanges(out) == 0, out._jdf.queryExecution().executedPlan().toString()
