"""Registered queries: sources, sinks and the dataset registry (IO*, RG*).

Sinks write under the shared checkpoint folder (``spark.checkpoint.dir``),
each run in a fresh sub-folder, and the query returns what was read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.functions.dates import ntz_micros
from pricewise.operators.aggregates import group_median
from pricewise.operators.serving import build_lookup_tables
from pricewise.plans import sqltext as Q
from pricewise.plans import tables as T
from pricewise.plans.catalog import cleaned, engineered, register, round4
from pricewise.plans.q_features import LOOKUPS_SQL
from pricewise.session import scratch_path
from pricewise.sources import files as IO
from pricewise.sources import registry as RG

SALES_TABLES = ("orders", "customer", "nation", "region")
ENG_DOUBLES = ("price", "borough_price_trend", "district_yearly_medians", "avg_price_last_half")


@register("scan_csv", f"""
SELECT price, date, postcode, property_type, "old/new", duration, county FROM ({T.SALES_RAW_SQL}) raw""")
def q_scan_csv(spark, sf_dir):
    path = IO.write_csv(T.sales_raw(spark, sf_dir), scratch_path(spark, "sales-csv"), header=True)
    return IO.scan_csv(spark, path, T.RAW_SALES_COLUMNS, T.LOADED_COLUMNS)


@register("write_partitioned", Q.r4(Q.CLEAN_SQL, "price"))
def q_write_partitioned(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    path = IO.write_partitioned(df, scratch_path(spark, "silver"), ["sold_year"])
    return round4(spark.read.schema(df.schema).parquet(path))


def _fingerprint(spark, sf_dir) -> str:
    """One checksum over every table that the engineered sales are built from."""
    return IO.content_checksum(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SALES_TABLES])


@register("save_dataset_version", Q.r4(Q.ENGINEERED_SQL, *ENG_DOUBLES))
def q_save_version(spark, sf_dir):
    base = scratch_path(spark, "gold")
    path = IO.save_dataset_version(engineered(spark, sf_dir), base, _fingerprint(spark, sf_dir))
    return round4(spark.read.parquet(path))


@register("load_dataset_version", Q.r4(Q.ENGINEERED_SQL, *ENG_DOUBLES))
def q_load_version(spark, sf_dir):
    base = scratch_path(spark, "gold")
    checksum = _fingerprint(spark, sf_dir)
    IO.save_dataset_version(engineered(spark, sf_dir), base, checksum)
    return round4(IO.load_dataset_version(spark, base, IO.table_name_from_checksum(checksum)))


@register("json_records_sink", Q.r4(LOOKUPS_SQL["bpt"], "price"))
def q_json_records(spark, sf_dir):
    path = IO.write_json_records(group_median(engineered(spark, sf_dir), "district"),
                                 scratch_path(spark, "records-json"))
    return round4(spark.read.schema("district string, price double").json(path))


@register("json_report_sink", Q.r4(" UNION ALL ".join([
    f"SELECT 'borough_price_trend' AS lookup, district AS key, price FROM ({LOOKUPS_SQL['bpt']}) a",
    f"SELECT 'district_yearly_medians', district_year, price FROM ({LOOKUPS_SQL['dym']}) b",
    f"SELECT 'avg_price_last_half', district, price FROM ({LOOKUPS_SQL['recent']}) c"]), "price"))
def q_json_report(spark, sf_dir):
    long = build_lookup_tables(engineered(spark, sf_dir)).long()
    path = IO.write_json_document(long, scratch_path(spark, "lookup-json"), ["lookup", "key"], "price")
    return round4(IO.read_json_document(spark, path, "lookup", "key", "price"))


@register("file_fingerprint", """
SELECT CAST(c_nationkey AS VARCHAR) AS nation, sha256(string_agg(line || chr(10), '' ORDER BY line)) AS sha256,
       CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes
FROM (SELECT c_nationkey, CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || c_mktsegment AS line FROM customer) l
GROUP BY c_nationkey""")
def q_fingerprint(spark, sf_dir):
    """Digests of text files written by the query (one per nation, sorted lines), so the
    expected bytes are known."""
    lines = T.read(spark, sf_dir, "customer").select(
        "c_nationkey", F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("line"))
    path = scratch_path(spark, "customer-lines")
    lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "line").write.partitionBy("c_nationkey").text(path)
    fp = IO.file_fingerprint(spark, f"{path}/*/*.txt")
    return fp.select(F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1).alias("nation"), "sha256", "bytes")


@register("ingest_dataset", Q.r4(Q.ENGINEERED_SQL, *ENG_DOUBLES))
def q_ingest(spark, sf_dir):
    """Fingerprint -> registry -> build and save, then once more: the second run must load."""
    base, registry = scratch_path(spark, "versions"), scratch_path(spark, "registry")
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SALES_TABLES]
    RG.ingest(spark, inputs, base, registry, lambda: engineered(spark, sf_dir))
    df, _checksum, built = RG.ingest(spark, inputs, base, registry, lambda: engineered(spark, sf_dir).limit(0))
    if built:
        raise RuntimeError("a registered version was built again")
    return round4(df)


# ------------------------------------------------------------------ registry

def insert_log(spark, sf_dir):
    """Registry insert log derived from events: one batch per (event type, day)
    is the dataset hash; every event re-inserts it under its own table name."""
    e = T.read(spark, sf_dir, "events")
    h = F.sha2(F.concat(F.col("event_type"), F.lit(":"), F.to_date("ts").cast("string")), 256)
    return e.select(h.alias("hash"),
                    F.concat(F.lit("gold_"), F.col("event_id").cast("string")).alias("table_name"),
                    F.col("ts").alias("inserted_at"), ntz_micros("ts").alias("__us"))


LOG_SQL = """
SELECT sha256(event_type || ':' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS hash,
       'gold_' || CAST(event_id AS VARCHAR) AS table_name, ts AS inserted_at, epoch_us(ts) AS us
FROM events"""
UPSERT_SQL = f"""
SELECT hash, arg_max(table_name, {{'t': inserted_at, 'n': table_name}}) AS table_name,
       min(inserted_at) AS inserted_at
FROM ({LOG_SQL}) l GROUP BY hash"""


@register("registry_upsert", UPSERT_SQL)
def q_upsert(spark, sf_dir):
    return RG.registry_upsert(insert_log(spark, sf_dir).drop("__us"))


@register("unseen_datasets", f"""
SELECT DISTINCT hash FROM ({LOG_SQL}) a
WHERE hash NOT IN (
  SELECT hash FROM ({LOG_SQL}) b
  WHERE us < (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events))""")
def q_unseen(spark, sf_dir):
    log = insert_log(spark, sf_dir)
    mid = log.select(F.floor((F.min("__us") + F.max("__us")) / 2)).scalar()
    registry = RG.registry_upsert(log.where(F.col("__us") < mid).drop("__us"))
    return RG.unseen_datasets(log.select("hash").distinct(), registry)


@register("latest_dataset", f"""
SELECT arg_max(table_name, {{'t': inserted_at, 'n': table_name}}) AS table_name, max(inserted_at) AS inserted_at
FROM ({UPSERT_SQL}) u""")
def q_latest_dataset(spark, sf_dir):
    return RG.latest_dataset(RG.registry_upsert(insert_log(spark, sf_dir).drop("__us")))
