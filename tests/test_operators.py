import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from pricewise.operators import aggregates as AG
from pricewise.operators import clean as C
from pricewise.operators import enrich as EN
from pricewise.operators import filters as FL
from pricewise.operators import windows as WN
from pricewise.session import scratch_path
from tests.conftest import rows


def test_required_columns_order_and_error(spark):
    df = spark.createDataFrame([("a", 1, 100, 1990)], "district string, distance_from_centre int, price int, built_year int")
    out = C.required_columns(df, ["district"], ["distance_from_centre"], "price")
    assert out.columns == ["district", "distance_from_centre", "price"]
    with pytest.raises(KeyError):
        C.required_columns(df.drop("price"), ["district"], ["distance_from_centre"], "price")


def test_rename_skips_missing(spark):
    df = spark.createDataFrame([(1, "F")], "a int, duration string")
    out = C.rename_columns(df, {"missing": "x", "duration": "is_leasehold"})
    assert out.columns == ["a", "is_leasehold"]


def test_merge_categories_applies_every_mapping(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    out = C.merge_categories(df, {"AB": ["a", "b"], "C": ["c"]})
    assert [r.k for r in out.collect()] == ["AB", "AB", "C", "d"]


def test_keyword_filter_empty_result_keeps_schema(spark):
    df = spark.createDataFrame([("WEST MIDLANDS",), (None,)], "county string")
    out = FL.keyword_filter(df, "county", ["midlands"])
    assert out.count() == 1
    empty = FL.keyword_filter(df, "county", ["cornwall"])
    assert empty.count() == 0 and empty.columns == ["county"]


def test_drop_rare_categories(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)] * 4, "k string")
    assert rows(FL.drop_rare_categories(df, "k", 3)) == [("a",)] * 3


def test_validate_requests(spark):
    df = spark.createDataFrame([(1, "d", None, "y"), (2, "O", "N", "N"), (3, "F", "maybe", "N")],
                               "request_id int, property_type string, is_new_build string, is_leasehold string")
    out = {r.request_id: r for r in FL.validate_requests(df).collect()}
    assert out[1].is_valid and out[1].property_type == "D" and out[1].is_new_build == "N"
    assert not out[2].is_valid and "property_type" in out[2].reject_reason
    assert not out[3].is_valid and "is_new_build" in out[3].reject_reason


def test_resolve_dimension(spark):
    sales = spark.createDataFrame([(1, "sw1a 1aa"), (2, "ZZ9 9ZZ"), (3, None), (4, "e1 6an")],
                                  "id int, postcode string")
    dim = spark.createDataFrame([("SW1A1AA", "Westminster"), ("E1 6AN", None), ("E16AN", None)],
                                "postcode string, district string")
    out = rows(EN.resolve_dimension(sales, "postcode", dim, "postcode", "district"), "id", "district")
    # lower-case key resolves, unknown key dropped, null key kept, null district = unresolved
    assert out == [(1, "Westminster"), (3, None)]
    keys = rows(FL.unresolved_keys(sales, "postcode", dim, "postcode", "district"))
    assert keys == [("E16AN",), ("ZZ99ZZ",)]


def test_augment_median_and_match_rate(spark):
    main = spark.createDataFrame([(100, "A"), (200, "B"), (300, "C")], "price int, postcode_clean string")
    side = spark.createDataFrame([(50.0, "A"), (70.0, "A"), (80.0, "B"), (None, "D")],
                                 "floor_area double, postcode_clean string")
    out = EN.augment_median(main, side, "postcode_clean", "floor_area")
    assert rows(out, "price", "floor_area") == [(100, 60.0), (200, 80.0), (300, None)]
    assert EN.augment_median(main, side, "postcode_clean", "floor_area", how="inner").count() == 2
    assert EN.check_match_rate(out, "floor_area", 0.5) == pytest.approx(2 / 3)
    with pytest.raises(ValueError):
        EN.check_match_rate(out, "floor_area", 0.9)
    with pytest.raises(KeyError):
        EN.augment_median(main, side.drop("postcode_clean"), "postcode_clean", "floor_area")


def _sales(spark):
    d = dt.datetime
    data = [
        (1, "camden", d(2020, 1, 1), 700000.0),
        (2, "camden", d(2020, 2, 1), 800000.0),
        (3, "camden", d(2020, 2, 1), 900000.0),   # tied date with row 2
        (4, "camden", d(2020, 7, 30), 750000.0),  # 2020-01-31 .. window start: row 1 out
        (5, "hackney", d(2020, 1, 15), 500000.0),
        (6, "hackney", d(2020, 7, 13), 550000.0),  # exactly 180 days after row 5: included
        (7, None, d(2020, 3, 1), 100000.0),
    ]
    return spark.createDataFrame(data, "id int, district string, date timestamp_ntz, price double")


@pytest.mark.parametrize("method", ["pandas", "window"])
def test_rolling_median_edges(spark, method):
    out = WN.rolling_median(_sales(spark), "district", "date", "price", "m", fallback=False,
                            method=method, slice_days=30)
    got = dict(rows(out, "id", "m"))
    assert got[1] is None                   # first sale: empty window
    assert got[2] == 700000.0 and got[3] == 700000.0   # same-day peers excluded
    assert got[4] == 850000.0               # rows 2, 3 (row 1 is 211 days back)
    assert got[5] is None and got[6] == 500000.0       # left bound included
    assert got[7] is None                   # null district


def test_rolling_median_fallback(spark):
    out = WN.rolling_median(_sales(spark), "district", "date", "price", "m")
    got = dict(rows(out, "id", "m"))
    assert got[1] == 775000.0 and got[5] == 525000.0 and got[7] is None


def test_rolling_median_slices_do_not_change_values(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "ts", "value")
    a = rows(WN.rolling_median(e, "user_id", "ts", "value", "m", days=7, slice_days=1), "event_id", "m")
    b = rows(WN.rolling_median(e, "user_id", "ts", "value", "m", days=7, slice_days=1000), "event_id", "m")
    assert [x[0] for x in a] == [x[0] for x in b]
    assert all((p[1] is None and q[1] is None) or abs(p[1] - q[1]) < 1e-9 for p, q in zip(a, b))


def test_group_medians_and_fallback_chain(spark):
    sales = _sales(spark).withColumn("sold_year", F.year("date").cast("bigint"))
    bpt = dict(rows(AG.group_median(sales, "district"), "district", "price"))
    assert bpt == {"camden": 775000.0, "hackney": 525000.0}
    dym = rows(AG.group_median_composite(sales, "district", "sold_year"))
    assert ("camden_2020", 775000.0) in dym
    g = AG.global_fallback(AG.group_median(sales, "district")).first()[0]
    assert g == 650000.0
    yearly = spark.createDataFrame([("camden_2020", 1.0), ("hackney_2021", 2.0)], "district_year string, price double")
    req = spark.createDataFrame([("camden", 2021), ("hackney", 2021), ("nowhere", 2021)], "district string, y int")
    out = EN.lookup_with_fallback(req, "district", "y", AG.group_median(sales, "district"), yearly,
                                  AG.group_median(sales, "district"), F.lit(650000.0))
    got = {r.district: r for r in out.collect()}
    assert got["camden"].district_yearly_medians == 1.0       # previous year
    assert got["hackney"].district_yearly_medians == 2.0      # current year
    assert got["nowhere"].borough_price_trend == 650000.0     # global
    assert got["nowhere"].district_yearly_medians == 650000.0


def test_attach_group_median_and_join(spark):
    sales = _sales(spark).withColumn("sold_year", F.year("date").cast("bigint"))
    a = dict(rows(WN.attach_group_median(sales, "district", "price", "t"), "id", "t"))
    assert a[4] == 775000.0 and a[7] is None
    b = dict(rows(EN.attach_group_stat_join(sales, ["district", "sold_year"], "price", "t"), "id", "t"))
    assert b[6] == 525000.0 and b[7] is None


def test_recent_rows_month_clamp(spark):
    d = dt.datetime
    df = spark.createDataFrame([(d(2020, 8, 31),), (d(2020, 2, 29),), (d(2020, 2, 28),)], "date timestamp_ntz")
    # 2020-08-31 minus 6 months clamps to 2020-02-29
    assert FL.recent_rows(df, "date", 6).count() == 2


def test_distributed_quantiles_match_percentile(spark):
    from pricewise.operators.quantiles import exact_quantiles
    # one hot group holding most rows, ties, a single-row group and a null key
    data = [("hot", float(v % 97)) for v in range(3000)] + [("one", 5.0), ("tie", 2.0), ("tie", 2.0),
                                                            (None, 1.0), ("hot", None)]
    df = spark.createDataFrame(data, "k string, v double")
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: [r[f"q{i}"] for i in range(5)] for r in
           exact_quantiles(df, ["k"], "v", qs, [f"q{i}" for i in range(5)]).collect()}
    ref = {r.k: [r[f"q{i}"] for i in range(5)] for r in
           df.where("k IS NOT NULL").groupBy("k").agg(*[F.percentile("v", q).alias(f"q{i}") for i, q in enumerate(qs)]).collect()}
    assert got.keys() == ref.keys()
    for k in ref:
        assert got[k] == pytest.approx(ref[k], abs=1e-9)


def test_quantile_method_conf_switch(spark):
    void = spark.createDataFrame([("void", None), ("void", float("nan"))], "district string, price double")
    sales = _sales(spark).select("district", F.col("price").cast("double").alias("price")).unionByName(void)
    base = rows(AG.group_median(sales, "district"))
    assert ("void", None) in base
    spark.conf.set("pricewise.quantile.method", "percentile")
    try:
        assert rows(AG.group_median(sales, "district")) == base
        clipped = C.clip_upper_quantile(sales, "price", 0.5)
        assert max(r.price for r in clipped.collect() if r.price is not None) == 700000.0
    finally:
        spark.conf.unset("pricewise.quantile.method")


def test_recent_rows_read_the_latest_years_alone(spark):
    from pricewise.operators.aggregates import recent_group_median
    days = spark.range(4000).select(F.col("id"), (F.lit("2010-01-01").cast("date") + F.col("id").cast("int")).cast("timestamp_ntz").alias("date"),
                                    F.concat(F.lit("k"), F.col("id") % 3).alias("key"), (F.col("id") % 101).cast("double").alias("price"))
    extra = spark.createDataFrame([(-1, None, "k0", 1.0)], days.schema)
    df = days.where("date <= '2020-03-31'").unionByName(extra).withColumn("year", F.year("date"))
    path = scratch_path(spark, "years")
    df.repartition(1).write.partitionBy("year").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    want = rows(FL.recent_rows(df, "date", 6))
    assert len(want) == 184 and rows(FL.recent_rows(table, "date", 6, "year").select(df.columns)) == want
    assert rows(FL.recent_rows(df, "date", 6, "year")) == want
    assert rows(recent_group_median(table, "key", "date", year_col="year")) == rows(recent_group_median(df, "key", "date"))
    got = FL.recent_rows(table, "date", 6, "year")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= ", plan), plan
    read = {r.year for r in got.select("year").collect()}
    assert read == {2019, 2020}
    assert FL.recent_rows(table.limit(0), "date", 6, "year").count() == 0
    # an old year whose pages cannot be read any more (its footer is whole) does no harm
    for name in glob.glob(f"{path.removeprefix('file:')}/year=2012/*.parquet"):
        data = bytearray(open(name, "rb").read())
        data[4:len(data) // 4] = b"\xff" * (len(data) // 4 - 4)
        open(name, "wb").write(data)
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.unlink(crc)
    fresh = spark.read.schema(df.schema).parquet(path)
    with pytest.raises(Exception):
        fresh.select(F.max("date"), F.sum("price"), F.max("key"), F.sum("id")).collect()
    assert rows(FL.recent_rows(fresh, "date", 6, "year").select(df.columns)) == want
