import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricewise import functions as PF
from pricewise.operators import clean as C


def test_canonical_postcode_one_distinct_value(spark):
    df = spark.createDataFrame([("sw1a 1aa",), (" SW1A1AA ",)], "p string")
    out = df.select(PF.canonical_postcode("p").alias("c")).distinct().collect()
    assert [r.c for r in out] == ["SW1A1AA"]


def test_numeric_cast(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3.5",), ("1d",), ("abc",), (None,)], "col1 string")
    got = [r.v for r in df.select(PF.cast_numeric("col1").alias("v")).collect()]
    assert got == [1.0, 2.0, 3.5, None, None, None]


def test_split_postcode(spark):
    df = spark.createDataFrame([("SW1 3NS",), ("N1 2LY",), ("ab",)], "postal_code string")
    out = C.normalise_postcodes(df, "postal_code").collect()
    assert [(r.postcode_clean, r.outcode, r.incode) for r in out] == [
        ("SW13NS", "SW1", "3NS"), ("N12LY", "N1", "2LY"), ("AB", "", "AB")]


def test_clip_upper_quantile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (1000.0,), (None,)], "numbers double")
    got = [r.numbers for r in C.clip_upper_quantile(df, "numbers", 0.99).collect()]
    assert got[:3] == [1.0, 2.0, 3.0] and got[4] is None
    assert got[3] == pytest.approx(970.09, abs=1e-9)


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "a int, b int")
    assert C.drop_null_rows(df).count() == 1
    nan = spark.createDataFrame([(float("nan"), 1), (1.0, 2)], "a double, b int")
    assert C.drop_null_rows(nan, ["a"]).count() == 1


def test_interaction_null_token(spark):
    df = spark.createDataFrame([("Y", "cat"), (None, "dog"), ("N", None)], "a string, b string")
    got = [r.x for r in df.select(PF.interaction("a", "b").alias("x")).collect()]
    assert got == ["Y_cat", "nan_dog", "N_nan"]


def test_sold_year_month(spark):
    ts = [dt.datetime(2023, 5, 1), dt.datetime(2025, 1, 31), dt.datetime(2022, 12, 31, 23, 59)]
    df = spark.createDataFrame([(t,) for t in ts], "d timestamp_ntz")
    out = df.select(PF.sold_year("d").alias("y"), PF.sold_month("d").alias("m"))
    assert dict(out.dtypes) == {"y": "bigint", "m": "bigint"}
    assert [(r.y, r.m) for r in out.collect()] == [(2023, 5), (2025, 1), (2022, 12)]


def test_cast_timestamp_format(spark):
    df = spark.createDataFrame([("2021-05-14 00:00",), ("14/05/2021",), (None,)], "s string")
    got = [r.t for r in df.select(PF.cast_timestamp("s").alias("t")).collect()]
    assert got == [dt.datetime(2021, 5, 14), None, None]


@pytest.mark.parametrize("price,band", [(-1.0, None), (0.0, None), (1.0, 1), (5e5, 1), (500000.01, 2),
                                        (1e6, 2), (2e6, 3), (3e6, 4), (3000000.5, 5), (None, None)])
def test_price_band_right_closed(spark, price, band):
    df = spark.createDataFrame([(price,)], "p double")
    assert df.select(PF.price_band("p").alias("b")).first().b == band


def test_interval_response(spark):
    import math
    df = spark.createDataFrame([(math.log1p(1000.0),), (None,)], "pred double")
    out = df.select(PF.round_price(PF.expm1_pred("pred")).alias("p"),
                    PF.interval_bounds(PF.expm1_pred("pred")).alias("ci")).collect()
    assert out[0].p == 1000.0 and out[0].ci == [900.0, 1100.0]
    assert out[1].p is None and out[1].ci is None


def test_round_half_up_matches_js_math_round(spark):
    vals = [1.005, 2.675, 0.125, 44.255, -1.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.r for r in df.select(PF.round_half_up("x", 2).alias("r")).collect()]
    import math
    assert got == [math.floor(v * 100 + 0.5) / 100 for v in vals]


def test_truthy(spark):
    df = spark.createDataFrame([(" Yes ",), ("1",), ("false",), (None,), ("y",)], "s string")
    assert [r.t for r in df.select(PF.truthy("s", True).alias("t")).collect()] == [True, True, False, True, True]
    assert df.select(PF.truthy("s", False).alias("t")).collect()[3].t is False


def test_month_start_and_epoch(spark):
    df = spark.createDataFrame([(1704067207179,)], "ms long")
    out = df.select(PF.epoch_millis_to_utc("ms").alias("t")).withColumn("m", PF.month_start("t")).first()
    assert out.t == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert out.m == dt.datetime(2024, 1, 1)


def test_finite_and_gap(spark):
    df = spark.createDataFrame([("1.5", 1.0, 1.05), ("inf", 1.0, 2.0), ("nan", 0.0, 1.0)],
                               "s string, train double, val double")
    out = df.select(PF.is_finite_number("s").alias("f"),
                    PF.gap_bucket(PF.generalisation_gap("val", "train")).alias("g")).collect()
    assert [r.f for r in out] == [True, False, False]
    assert [r.g for r in out] == ["excellent", "likely_overfit", "unavailable"]


def test_keyword_predicate_null_and_empty(spark):
    df = spark.createDataFrame([("WEST MIDLANDS",), ("Kent",), (None,)], "c string")
    assert df.where(PF.keyword_predicate("c", ["midlands"])).count() == 1
    assert df.where(PF.keyword_predicate("c", [])).count() == 3
    assert df.where(PF.keyword_predicate("c", ["mid", "^w"])).count() == 1
    assert df.where(F.lit(True) & PF.keyword_predicate("c", ["nowhere"])).count() == 0


def test_cast_timestamp_ignores_session_zone(spark):
    # 1995-10-15 00:00 does not exist in America/Sao_Paulo (DST started at midnight)
    df = spark.createDataFrame([("1995-10-15 00:00",)], "s string")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = df.select(PF.cast_timestamp("s").alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(1995, 10, 15, 0, 0)
