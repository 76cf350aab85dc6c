"""Joins of tables stored in the same buckets: same rows as the shuffled join, no exchange, hot keys in parts."""

import re

import pytest

from pricewise.operators import enrich as EN
from pricewise.operators import filters as FL
from pricewise.sources import buckets as BU
from pricewise.session import path_exists
from tests.conftest import rows

FACTS = "id int, postcode string, district string"
DIRECTORY = "postcode string, district string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def frames(spark):
    # one key and the null key hold a third of the rows each
    sales = [(i, "sw1a 1aa" if i % 3 == 0 else None if i % 3 == 1 else f"E{i % 40} 6an", "old") for i in range(3000)]
    places = [("SW1A1AA", "Westminster"), ("SW1A 1AA", "Westminster"), ("E3 6AN", None), (None, "Nowhere")]
    places += [(f"e{i} 6AN", f"d{i}") for i in range(4, 30)]
    return spark.createDataFrame(sales, FACTS), spark.createDataFrame(places, DIRECTORY)


@pytest.mark.parametrize("size", [100, 10_000])
def test_bucketed_join_equals_the_shuffled_one(spark, frames, size):
    sales, places = frames
    pair = BU.save_bucketed_pair(sales, "postcode", places, "postcode", "district", rows_per_bucket=size)
    assert pair.buckets == (30 if size == 100 else 1)
    got, keys = BU.resolve_bucketed(spark, pair), BU.unresolved_bucketed(spark, pair)
    want = EN.resolve_dimension(sales, "postcode", places, "postcode", "district")
    assert rows(got, "id", "postcode", "district") == rows(want, "id", "postcode", "district")
    assert rows(keys) == rows(FL.unresolved_keys(sales, "postcode", places, "postcode", "district")) != []
    # neither side moves: only the distinct keys without a value are exchanged
    assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)
    assert len(re.findall(r"\bExchange\b", plan(keys).split("Initial Plan")[0])) == 1
    largest = spark.table(pair.facts).groupBy(BU.KEY, BU.PART).count().agg({"count": "max"}).first()[0]
    assert largest <= (120 if size == 100 else 1000)
    pair.drop(spark)
    assert not path_exists(spark, pair.facts_path) and not path_exists(spark, pair.directory_path)


def test_bucketed_join_of_empty_tables(spark, frames):
    sales, places = frames
    for facts, directory in ((sales.limit(0), places), (sales, places.limit(0))):
        pair = BU.save_bucketed_pair(facts, "postcode", directory, "postcode", "district")
        want = EN.resolve_dimension(facts, "postcode", directory, "postcode", "district")
        assert rows(BU.resolve_bucketed(spark, pair), "id", "district") == rows(want, "id", "district")
        pair.drop(spark)
