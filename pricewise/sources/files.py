"""File scans and sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import path_exists

NOHEADER_SUFFIX = ".noheader.csv"


class SchemaMismatch(ValueError):
    """The file's columns do not fit the declared header."""


def header_schema(names: Sequence[str], types: dict[str, str] | None = None) -> str:
    """DDL schema for the supplied header; untyped columns are strings."""
    types = types or {}
    return ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)


_SURPLUS = "__pw_surplus"


def has_header(path: str) -> bool:
    """The source's rule: only a file whose suffixes are exactly '.noheader.csv' lacks a header line."""
    return "".join(PurePosixPath(path).suffixes) != NOHEADER_SUFFIX


def scan_csv(spark: SparkSession, path: str, names: Sequence[str], columns: Sequence[str],
             header: bool | None = None, types: dict[str, str] | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV scan with supplied column names, pruned to ``columns`` (file order kept).

    With ``header`` None ``has_header`` decides; a header line is discarded for the
    supplied names. Quotes inside quoted fields are doubled (RFC 4180). A line
    with fewer fields is filled with nulls, one with more fails the scan, as does
    a value that does not fit a declared type. ``multi_line`` also accepts line
    breaks inside quotes, at the price of files that cannot be split.
    """
    missing = [c for c in columns if c not in names]
    if missing:
        raise SchemaMismatch(f"the declared header lacks {missing}")
    if header is None:
        header = has_header(path)
    types = types or {}
    df = (spark.read.schema(header_schema([*names, _SURPLUS]))
               .option("header", header).option("mode", "PERMISSIVE").option("enforceSchema", True)
               .option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path))
    keep = [c for c in names if c in set(columns)]
    # the check rides on the first column, so pruning cannot drop it
    surplus = F.raise_error(F.concat(F.lit("a line has more fields than the declared header: "), F.col(_SURPLUS)))
    out = []
    for i, c in enumerate(keep):
        value = F.col(f"`{c}`")
        if i == 0:
            value = F.when(F.col(_SURPLUS).isNotNull(), surplus.cast("string")).otherwise(value)
        out.append(value.cast(types.get(c, "string")).alias(c))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("errorifexists").option("header", header).csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str]) -> str:
    """Partitioned Parquet; dynamic partition overwrite makes reruns idempotent
    (only the partitions present in ``df`` are replaced). Rows are gathered by partition
    value first (AQE splits large ones), so files follow the data, not tasks x values."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))
    return path


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read back; filters on partition columns prune directories."""
    return spark.read.parquet(path)


def table_name_from_checksum(checksum: str, prefix: str = "gold_", limit: int = 63) -> str:
    """Version table name: prefix + checksum, cut to ``limit`` characters."""
    return (prefix + checksum)[:limit]


def save_dataset_version(df: DataFrame, base: str, checksum: str, prefix: str = "gold_",
                         replace: bool = False) -> str:
    """Write the table under a name derived from the input checksum; an existing version is
    an error (versions are immutable) unless ``replace`` mends one left incomplete."""
    path = f"{base.rstrip('/')}/{table_name_from_checksum(checksum, prefix)}"
    df.write.mode("overwrite" if replace else "errorifexists").parquet(path)
    return path


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end (its success marker is there)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def load_dataset_version(spark: SparkSession, base: str, table_name: str) -> DataFrame:
    path = f"{base.rstrip('/')}/{table_name}"
    found = read_if_present(spark, path)
    if found is None:
        raise LookupError(f"no dataset version {table_name!r} under {base}")
    return found


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None if there is nothing."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def write_json_records(df: DataFrame, path: str) -> str:
    """JSON-lines records, one file per partition."""
    df.write.mode("errorifexists").json(path)
    return path


# Most entries one document may hold (it is one string in the end).
MAX_DOCUMENT_ENTRIES = 1_000_000


def json_text(c: Column) -> Column:
    """JSON text of one value (string or number); null is 'null'."""
    text = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def json_document(entries: DataFrame, key_cols: Sequence[str], value_col: str,
                  value_is_json: bool = False) -> DataFrame:
    """One row, one column ``value``: the nested JSON object {key1: {key2: ... value}}, keys sorted.
    ``value_is_json``: the value column holds JSON text already."""
    level = entries.select(*[F.col(k).cast("string").alias(k) for k in key_cols], (F.col(value_col) if value_is_json else json_text(F.col(value_col))).alias("__j"))
    keys = list(key_cols)
    while keys:
        last = keys.pop()
        pairs = F.array_sort(F.collect_list(F.concat(json_text(F.col(last)), F.lit(":"), "__j")))
        grouped = level.groupBy(*keys) if keys else level
        level = grouped.agg(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")).alias("__j"))
    return level.select(F.col("__j").alias("value"))


def write_json_document(entries: DataFrame, path: str, key_cols: Sequence[str], value_col: str,
                        max_entries: int = MAX_DOCUMENT_ENTRIES, value_is_json: bool = False) -> str:
    """Write one nested JSON document, e.g. {section: {key: value}}.

    For documents bounded by a dimension (lookup tables, report sections); more than
    ``max_entries`` entries are refused before anything is gathered.
    """
    n = entries.count()
    if n > max_entries:
        raise ValueError(f"{n} entries do not belong in one document (at most {max_entries})")
    json_document(entries, key_cols, value_col, value_is_json).write.mode("errorifexists").text(path)
    return path


def read_json_document(spark: SparkSession, path: str, section_col: str, key_col: str,
                       value_col: str, value_type: str = "double") -> DataFrame:
    """(section, key, value) rows of a two-level document."""
    doc = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", f"map<string,map<string,{value_type}>>")).alias(section_col, "__m"))
    return doc.select(section_col, F.explode("__m").alias(key_col, value_col))


# Files up to this size are hashed as one value, larger ones in chunks.
WHOLE_FILE_BYTES = 256 << 20
CHUNK_BYTES = 4 << 20


def _hash_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs
    for pdf in batches:
        digests = []
        for uri in pdf["path"]:
            system, path = fs.FileSystem.from_uri(uri)
            h = hashlib.sha256()
            with system.open_input_stream(path) as f:
                while chunk := f.read(CHUNK_BYTES):
                    h.update(chunk)
            digests.append(h.hexdigest())
        yield pdf.assign(sha256=digests)


def file_fingerprint(spark: SparkSession, paths: "str | Sequence[str]",
                     whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """(path, name, bytes, sha256, short_name) per file of any size, one task each.

    Files up to ``whole_file_bytes`` are read through Spark's ``binaryFile`` source; larger
    ones are streamed in chunks through the file system of their URI (local, HDFS
    or object stores that Arrow knows), so no file needs to fit a value.
    """
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    small = (files.where(F.col("length") <= whole_file_bytes)
                  .select("path", F.col("length").alias("bytes"), F.sha2(F.col("content"), 256).alias("sha256")))
    large = files.where(F.col("length") > whole_file_bytes).select("path", F.col("length").alias("bytes"))
    large = large.repartition("path").mapInPandas(_hash_chunks, "path string, bytes bigint, sha256 string")
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return small.unionByName(large).select(
        "path", name.alias("name"), "bytes", "sha256",
        F.concat(F.substring("sha256", 1, 16), F.lit("_"), name).alias("short_name"))


def content_checksum(spark: SparkSession, paths: "str | Sequence[str]") -> str:
    """One sha256 over all files' names and digests: the version of a set of inputs."""
    line = F.concat_ws(" ", "name", "sha256")
    rows = file_fingerprint(spark, paths).select(F.sha2(line, 256).alias("d"))
    return rows.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ","), 256)).first()[0]
