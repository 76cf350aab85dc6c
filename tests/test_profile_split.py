import pytest
from pyspark.sql import functions as F

from pricewise.operators import metrics as ME
from pricewise.operators import profile as PR
from pricewise.operators import split as SP
from pricewise.plans.q_profile import quality_report
from tests.conftest import SF001, rows


@pytest.fixture(scope="module")
def small(spark):
    data = [(i, float(v) if v is not None else None, s, t)
            for i, (v, s, t) in enumerate([(100, 10, "D"), (200, 10, "S"), (300, 10, "D"), (400, 10, None),
                                           (10000, 10, "T"), (None, 10, "D")])]
    return spark.createDataFrame(data, "id int, price double, sqft int, property_type string")


def test_null_ratio_and_schema(spark, small):
    got = dict(rows(PR.null_ratio(small)))
    assert got == {"id": 0.0, "price": 1 / 6, "sqft": 0.0, "property_type": 1 / 6}
    assert rows(PR.schema_summary(small)) == sorted(
        [("id", "int"), ("price", "double"), ("sqft", "int"), ("property_type", "string")])


def test_numeric_profile_and_constant_column(spark, small):
    prof = {r.column: r for r in PR.numeric_profile(small, ["price", "sqft"]).collect()}
    p = prof["price"]
    assert p["count"] == 5 and p["mean"] == 2200.0 and p["q50"] == 300.0
    assert p["q25"] == 200.0 and p["q75"] == 400.0 and p["min"] == 100.0 and p["max"] == 10000.0
    assert prof["sqft"]["std"] == 0.0
    out = dict(rows(PR.outlier_count(small, ["price", "sqft"])))
    assert out == {"price": 1, "sqft": 0}   # IQR 0: nothing is strictly outside


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    assert dict(rows(PR.null_ratio(df)))["x"] == 1.0
    prof = PR.numeric_profile(df, ["x"]).collect()
    assert len(prof) == 1 and prof[0]["count"] == 0
    assert all(prof[0][c] is None for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    assert dict(rows(PR.outlier_count(df, ["x"]))) == {"x": 0}


def test_category_distribution_gate(spark, small):
    got = rows(PR.category_distribution(small, ["property_type"]))
    assert got == [("property_type", "D", 0.6), ("property_type", "S", 0.2), ("property_type", "T", 0.2)]
    assert PR.category_distribution(small, ["property_type"], max_unique=2).count() == 0


def test_ks_drift_bounds(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    ks = dict(rows(PR.ks_drift(df, "o_orderkey", ["o_totalprice", "o_custkey"])))
    assert set(ks) == {"o_totalprice", "o_custkey"}
    assert all(0.0 <= v <= 1.0 for v in ks.values())
    # a column identical on both sides has no drift
    const = df.withColumn("c", F.lit(1.0))
    assert dict(rows(PR.ks_drift(const, "o_orderkey", ["c"])))["c"] == 0.0


def test_quality_report_sections(spark, small):
    rep = quality_report(small, "id", ["price", "sqft"], ["property_type"])
    sections = {r.section for r in rep.select("section").distinct().collect()}
    assert sections == {"missing", "schema_summary", "numeric_stats", "outliers",
                        "train_val_drift", "category_distribution"}


def test_random_split_exact_and_repeatable(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey")
    a = SP.random_split(df, "o_orderkey", 0.2, 42, buckets=7)
    b = SP.random_split(df, "o_orderkey", 0.2, 42, buckets=64)
    n = df.count()
    assert a.where("split = 'test'").count() == -(-n // 5)
    assert rows(a) == rows(b)   # bucket count only balances work


def test_stratified_split_shares_per_band(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", (F.col("o_totalprice") * 8).alias("price"))
    out = SP.stratified_split(df, "o_orderkey", "price", 0.15, 0.15, 42, buckets=16)
    counts = {}
    from pricewise.functions.numeric import price_band
    g = out.withColumn("band", price_band("price")).groupBy("band", "split").count().collect()
    for r in g:
        counts.setdefault(r.band, {})[r.split] = r["count"]
    for band, c in counts.items():
        n = sum(c.values())
        nt = -(-n * 3 // 20)
        nv = -(-(n - nt) * 3 // 17)
        assert c.get("test", 0) == nt and c.get("validation", 0) == nv, (band, c)
    assert out.count() == df.count()


def test_regression_metrics(spark):
    df = spark.createDataFrame([("train", 1.0, 1.0), ("train", 3.0, 3.0), ("val", 1.0, 2.0), ("val", 3.0, 2.0),
                                ("const", 5.0, 5.0), ("const2", 5.0, 4.0)], "s string, y double, p double")
    got = {r.split: r for r in ME.regression_metrics(df, "y", "p", "s").collect()}
    assert got["train"].rmse == 0.0 and got["train"].r2 == 1.0
    assert got["val"].mse == 1.0 and got["val"].r2 == 0.0
    assert got["const"].r2 == 1.0 and got["const2"].r2 == 0.0
    names = {r.metric for r in ME.metrics_record(ME.regression_metrics(df, "y", "p", "s")).collect()}
    assert "val_rmse" in names and "train_r2" in names


def test_profile_distributed_quantiles_agree(spark, small):
    base_p = rows(PR.numeric_profile(small, ["price", "sqft"]))
    base_o = rows(PR.outlier_count(small, ["price", "sqft"]))
    spark.conf.set("pricewise.quantile.method", "percentile")
    try:
        assert rows(PR.numeric_profile(small, ["price", "sqft"])) == base_p
        assert rows(PR.outlier_count(small, ["price", "sqft"])) == base_o
    finally:
        spark.conf.unset("pricewise.quantile.method")


def test_quality_report_document(spark, small):
    import json

    from pricewise.plans.q_profile import write_quality_report
    from pricewise.session import scratch_path
    rep = quality_report(small, "id", ["price", "sqft"], ["property_type"])
    path = write_quality_report(rep, scratch_path(spark, "test-report"))
    doc = json.loads(spark.read.text(path, wholetext=True).first().value)
    assert set(doc) == {"missing", "schema_summary", "numeric_stats", "outliers", "train_val_drift", "category_distribution"}
    assert doc["schema_summary"]["price"] == {"type": "double"} and doc["numeric_stats"]["price"]["count"] == 5
    assert doc["category_distribution"]["property_type"]["D"] == 0.6
