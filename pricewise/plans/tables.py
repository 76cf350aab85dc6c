"""How the property-sales domain maps onto the driver's TPC-H-like tables.

Every derived table is written twice, once as a DataFrame and once as the
equivalent DuckDB SQL, so that each registered query has an oracle twin.

| role                    | derived from                                          |
| sale row / price / date | orders: o_orderkey, o_totalprice, o_orderdate          |
| raw postcode            | 'k' || c_custkey || ' ' || lower(3 letters of segment) |
| postcode directory      | customer x nation for customers with c_acctbal >= 0    |
| property_type           | first letter of c_mktsegment (A/B/F/H/M)               |
| old/new, duration       | o_orderstatus 'O' -> Y else N; priority 1/2 -> L else F |
| county                  | region name of the customer's nation                  |
| side table              | lineitem: l_quantity per order                         |
| fine-grained series     | events: ts, user_id, value                             |
| run records             | events grouped by user_id                              |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.functions.dates import ntz_micros

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# The tables that the layers are built from.
SOURCE_TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")

# The raw sales header names and the loaded subset.
RAW_SALES_COLUMNS = ("transaction_id", "price", "date", "postcode", "property_type", "old/new",
                     "duration", "county")
LOADED_COLUMNS = ("price", "date", "postcode", "property_type", "old/new", "duration", "county")
RAW_DTYPES = {"price": "float", "date": "datetime", "postcode": "string",
              "property_type": "string", "old/new": "string", "duration": "string",
              "county": "string"}
RENAMES = {"old/new": "is_new_build", "duration": "is_leasehold"}
# Property types of this mapping (first letters of the market segments).
PROPERTY_TYPES = ("A", "B", "F", "H", "M")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz_text(ts) -> "F.Column":
    """'yyyy-MM-dd HH:mm' of a TIMESTAMP_NTZ from field extractors, so the text
    never passes through the session time zone (``date_format`` would)."""
    def two(c):
        return F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), two(F.month(ts)), F.lit("-"),
                    two(F.dayofmonth(ts)), F.lit(" "), two(F.hour(ts)), F.lit(":"), two(F.minute(ts)))


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns as a CSV scan would give them, bad values included:
    price text 'unknown' for pending low-priority orders, date text
    'not recorded' for pending unspecified-priority orders."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    pending = F.col("o_orderstatus") == "P"
    price = F.when(pending & (F.col("o_orderpriority") == "5-LOW"), F.lit("unknown")) \
             .otherwise(F.format_string("%.2f", F.col("o_totalprice")))
    date = F.when(pending & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), F.lit("not recorded")) \
            .otherwise(ntz_text(F.col("o_orderdate")))
    joined = (o.join(c, o.o_custkey == c.c_custkey)
               .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
               .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        price.alias("price"),
        date.alias("date"),
        F.concat(F.lit("k"), F.col("c_custkey").cast("string"), F.lit(" "),
                 F.lower(F.substring("c_mktsegment", 1, 3))).alias("postcode"),
        F.substring("c_mktsegment", 1, 1).alias("property_type"),
        F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N").alias("old/new"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "L").otherwise("F").alias("duration"),
        F.col("r_name").alias("county"),
    )


def postcode_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(postcode, district): customers with a non-negative balance are listed,
    the rest are unknown postcodes. Keys are written with spacing/case noise
    so both sides go through the canonical form."""
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    return (c.where(F.col("c_acctbal") >= 0)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.concat(F.lit("K"), F.col("c_custkey").cast("string"), F.lit("  "),
                              F.upper(F.substring("c_mktsegment", 1, 3))).alias("postcode"),
                     F.col("n_name").alias("district")))


def quantity_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side table for m:1 enrichment: order key and quantity as text."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("transaction_id"),
                     F.col("l_quantity").cast("string").alias("quantity"))


def parcel_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side table with a postcode: a code in mixed case and spacing (none for some
    lines) and the quantity as text."""
    li = read(spark, sf_dir, "lineitem")
    code = F.concat(F.lit(" q"), (F.col("l_partkey") % 90).cast("string"), F.lit("  "),
                    (F.col("l_suppkey") % 9).cast("string"), F.lit("Ab "))
    return li.select(F.col("l_orderkey").cast("string").alias("transaction_id"),
                     F.when(F.col("l_linenumber") < 6, code).alias("postcode"),
                     F.col("l_quantity").cast("string").alias("quantity"))


# ---------------------------------------------------------------- SQL twins

SALES_RAW_SQL = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN 'unknown'
            ELSE printf('%.2f', o.o_totalprice) END AS price,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '4-NOT SPECIFIED' THEN 'not recorded'
            ELSE strftime(o.o_orderdate, '%Y-%m-%d %H:%M') END AS date,
       'k' || CAST(c.c_custkey AS VARCHAR) || ' ' || lower(substr(c.c_mktsegment, 1, 3)) AS postcode,
       substr(c.c_mktsegment, 1, 1) AS property_type,
       CASE WHEN o.o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS "old/new",
       CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'L' ELSE 'F' END AS duration,
       r.r_name AS county
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

DIRECTORY_SQL = """
SELECT 'K' || CAST(c.c_custkey AS VARCHAR) || '  ' || upper(substr(c.c_mktsegment, 1, 3)) AS postcode,
       n.n_name AS district
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_acctbal >= 0
"""

QUANTITY_SIDE_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id, CAST(l_quantity AS VARCHAR) AS quantity
FROM lineitem
"""


PARCEL_SIDE_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
       CASE WHEN l_linenumber < 6 THEN ' q' || CAST(l_partkey % 90 AS VARCHAR) || '  '
            || CAST(l_suppkey % 9 AS VARCHAR) || 'Ab ' END AS postcode,
       CAST(l_quantity AS VARCHAR) AS quantity
FROM lineitem
"""


def requests_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per customer; some fields are invalid or missing on purpose
    (by balance and nation), and customers outside the directory are unknown postcodes."""
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("request_id"),
        F.concat(F.lit("k"), F.col("c_custkey").cast("string"), F.lit(" "),
                 F.lower(F.substring("c_mktsegment", 1, 3))).alias("postcode"),
        F.lower(F.substring("c_mktsegment", 1, 1)).alias("property_type"),
        F.when(F.col("c_acctbal") > 5000, "y").when(F.col("c_acctbal") > 2500, "n")
         .alias("is_new_build"),
        F.when(F.col("c_nationkey") < 3, "x").when(F.col("c_nationkey") < 15, "y")
         .otherwise("N").alias("is_leasehold"))


def runs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-run records derived from events, one per user: status, epoch-ms
    times, a metrics map (some metrics missing), params and tags maps."""
    e = read(spark, sf_dir, "events")
    et, v = F.col("event_type"), F.col("value")
    agg = e.groupBy("user_id").agg(
        F.count_if(et == "error").alias("__err"), F.count_if(et == "purchase").alias("__buy"),
        F.count_if(et == "signup").alias("__sign"),
        ntz_micros(F.min("ts")).alias("__t0"),
        ntz_micros(F.max("ts")).alias("__t1"),
        F.avg(F.when(et == "view", v)).alias("train_rmse"),
        F.avg(F.when(et == "click", v)).alias("validation_rmse"),
        F.avg(F.when(et == "click", v * v)).alias("validation_mse"),
        (F.min(F.when(et == "click", v)) / F.max(F.when(et == "click", v))).alias("validation_r2"),
        F.avg(F.when(et == "purchase", v)).alias("test_rmse"))
    names = ("train_rmse", "validation_rmse", "validation_mse", "validation_r2", "test_rmse")
    metrics = F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                                F.array(*[F.col(n) for n in names]))
    return agg.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(F.col("__err") > F.col("__buy"), "FAILED").otherwise("FINISHED").alias("status"),
        F.floor(F.col("__t0") / 1000).cast("bigint").alias("start_time"),
        F.floor(F.col("__t1") / 1000).cast("bigint").alias("end_time"),
        metrics.alias("metrics"),
        F.create_map(F.lit("log_target"), F.when(F.col("__sign") > 0, "yes").otherwise("no"),
                     F.lit("model_class"), F.lit("GBTRegressor")).alias("params"),
        F.create_map(F.lit("source"), F.lit("events")).alias("tags"),
        F.concat(F.lit("runs/run-"), F.col("user_id").cast("string"), F.lit("/artifacts")).alias("artifact_uri"),
        F.lit("0").alias("experiment_id"), F.lit("active").alias("lifecycle_stage"),
        F.col("user_id").cast("string").alias("user_id"))
