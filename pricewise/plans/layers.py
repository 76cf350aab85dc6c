"""Silver and gold layers, written once per version of the input and read by later queries.

The source pipeline stores its cleaned data as partitioned Parquet (silver)
and its engineered data as a versioned table (gold); downstream steps read
those instead of recomputing them. Here each layer is written under the
shared checkpoint folder (``spark.checkpoint.dir``), which also cuts the
lineage: a lost executor re-reads the layer instead of replaying the raw
joins, casts and global quantiles. A layer belongs to the listing (path, size,
modification time) of all input files, so changed inputs get a new one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.plans.tables import SOURCE_TABLES
from pricewise.session import app_key, remove_path, scratch_path

_PATHS: dict = {}


def input_stamp(spark: SparkSession, sf_dir: str) -> str:
    """Version of the input folder: a hash over the listing of every source table's files
    (metadata only, one row reaches the driver)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES])
    row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{row[0]}-{row[1]}"


def materialized(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame],
                 partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``build()`` once for (session, name, input version); return a scan of it."""
    key = (app_key(spark), name, sf_dir, input_stamp(spark, sf_dir))
    if key not in _PATHS:
        df = build()
        path = scratch_path(spark, name)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        _PATHS[key] = (path, df.schema, list(df.columns))
    path, schema, cols = _PATHS[key]
    return spark.read.schema(schema).parquet(path).select(*cols)


def drop_layers(spark: SparkSession, name: str | None = None) -> list[str]:
    """Forget this session's layers (one name or all) and delete their folders."""
    gone = [k for k in _PATHS if k[0] == app_key(spark) and name in (None, k[1])]
    paths = [_PATHS.pop(k)[0] for k in gone]
    for path in paths:
        remove_path(spark, path)
    return paths
