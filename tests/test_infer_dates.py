"""Date layouts inferred from the first value."""

import datetime as dt

import pytest

from pricewise.operators import clean as C


@pytest.mark.parametrize("values,want", [
    ([None, "13/05/2021", "01/02/2021", "05/13/2021"], [None, dt.datetime(2021, 5, 13), dt.datetime(2021, 2, 1), None]),
    (["05/06/2021", "13/05/2021", "1/2/2021"], [dt.datetime(2021, 5, 6), None, dt.datetime(2021, 1, 2)]),
    ([None, None, "2021-05-14T10:30:00", "2021-05-14 00:00", ""], [None, None, dt.datetime(2021, 5, 14, 10, 30), None, None]),
    (["14.5.2021", "x"], [dt.datetime(2021, 5, 14), None]), (["20210514"], [dt.datetime(2021, 5, 14)]),
    (["May 4, 2021", "Dec 24, 2020"], [dt.datetime(2021, 5, 4), dt.datetime(2020, 12, 24)]),
    (["nonsense", "2021-05-14 00:00"], [None, dt.datetime(2021, 5, 14)]), ([None], [None])])
def test_layout_of_the_first_value(spark, values, want):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, date string").coalesce(1)
    out = C.cast_columns(df, {"date": "datetime"}, "infer")
    assert [r.date for r in out.orderBy("id").collect()] == want
    assert dict(out.dtypes)["date"] == "timestamp_ntz"


def test_first_value_in_file_order(spark, tmp_path):
    """Neither the order of tasks nor the split of a file decides."""
    spark.createDataFrame([(None,), ("13/05/2021",)] + [("01/02/2021",)] * 3000, "date string").coalesce(1).write.csv(
        f"{tmp_path}/a", nullValue="null")
    spark.createDataFrame([("2021-01-01",)] * 3000, "date string").coalesce(1).write.csv(f"{tmp_path}/b")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = spark.read.schema("date string").csv([f"{tmp_path}/b", f"{tmp_path}/a"], nullValue="null")
        assert df.rdd.getNumPartitions() > 3
        assert C.first_value(df, "date") == "13/05/2021" and C.infer_ts_format(df, "date") == "d/M/yyyy"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
