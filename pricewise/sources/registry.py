"""Dataset registry: which input versions were already processed.

Registry rows are (hash, table_name, inserted_at). Plain Parquet has no
MERGE, so an upsert is a replay of the insert log grouped by hash: the
latest table name wins, the first insertion time is kept.

The stored registry holds under several writers. A registration is one numbered
file put into ``commits`` only if no other writer has taken its number; the
loser reads again and finds the dataset registered or tries the next number.
Every ``COMPACT_EVERY`` registrations all rows are written as one Parquet
snapshot, and commits that the snapshot before it holds are removed, so a
reader lists and reads few files however long the registry is in use.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import hadoop_path, list_names, move_if_absent, path_exists, remove_path
from pricewise.sources.files import (content_checksum, is_complete, load_dataset_version,
                                     table_name_from_checksum)

LOG_SCHEMA = "hash string, table_name string, inserted_at timestamp_ntz"
COMPACT_EVERY = 64


def registry_upsert(log: DataFrame, hash_col: str = "hash", name_col: str = "table_name",
                    ts_col: str = "inserted_at", seq_col: str | None = None) -> DataFrame:
    """Collapse an insert log (or registry + new rows) to one row per hash.

    ``seq_col`` orders the inserts (defaults to ``ts_col``); ties are broken
    by table name so the result is deterministic. The aggregation is
    combined map-side, so a hash inserted very often never gathers its rows.
    """
    seq = F.struct(F.col(seq_col or ts_col), F.col(name_col))
    return log.groupBy(hash_col).agg(F.max_by(name_col, seq).alias(name_col),
                                     F.min(ts_col).alias(ts_col))


def unseen_datasets(fingerprints: DataFrame, registry: DataFrame, hash_col: str = "hash") -> DataFrame:
    """Fingerprints whose hash is not registered (those still need cleaning)."""
    return fingerprints.join(registry.select(hash_col), on=hash_col, how="left_anti")


def latest_dataset(registry: DataFrame, name_col: str = "table_name",
                   ts_col: str = "inserted_at") -> DataFrame:
    """One row: the most recently inserted registry entry."""
    return registry.agg(F.max_by(name_col, F.struct(F.col(ts_col), F.col(name_col))).alias(name_col),
                        F.max(ts_col).alias(ts_col))


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in list_names(spark, folder) if n[:1].isdigit())


def _state(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """(last number, one row per hash): the newest snapshot and the commits after it."""
    snapshots = [n for n in _numbers(spark, f"{path}/snapshots") if path_exists(spark, f"{path}/snapshots/{n:020d}/_SUCCESS")]
    base = snapshots[-1] if snapshots else 0
    commits = [n for n in _numbers(spark, f"{path}/commits") if n > base]
    log = spark.createDataFrame([], LOG_SCHEMA)
    if base:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/snapshots/{base:020d}")
    if commits:
        log = log.unionByName(spark.read.schema(LOG_SCHEMA).json([f"{path}/commits/{n:020d}.json" for n in commits]))
    return max([base, *commits]), registry_upsert(log)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The stored registry, one row per hash (empty if nothing was registered yet)."""
    return _state(spark, path.rstrip("/"))[1]


def register_dataset(spark: SparkSession, path: str, checksum: str, table_name: str) -> str:
    """Register a dataset unless its checksum is; returns the registered table name, which is
    another writer's where that one was first."""
    path = path.rstrip("/")
    while True:
        last, rows = _state(spark, path)
        hit = rows.where(F.col("hash") == checksum).first()
        if hit is not None:
            return hit["table_name"]
        now = spark.range(1).select(F.date_format(F.localtimestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()[0]
        draft = f"{path}/drafts/{uuid.uuid4().hex}"
        fs, target = hadoop_path(spark, draft)
        out = fs.create(target, False)
        out.write(bytearray(json.dumps({"hash": checksum, "table_name": table_name, "inserted_at": now}).encode()))
        out.close()
        number = last + 1
        if not move_if_absent(spark, draft, f"{path}/commits/{number:020d}.json"):
            continue
        if number % COMPACT_EVERY == 0:
            compact(spark, path)
        # a writer that slept through a compaction may have taken a number already gone
        if read_registry(spark, path).where(F.col("hash") == checksum).isEmpty():
            remove_path(spark, f"{path}/commits/{number:020d}.json")
            continue
        return table_name


def compact(spark: SparkSession, path: str) -> int:
    """Write all rows as a snapshot and remove the commits that the one before it holds.
    Returns the snapshot's number."""
    path = path.rstrip("/")
    last, rows = _state(spark, path)
    draft = f"{path}/drafts/{uuid.uuid4().hex}"
    rows.write.parquet(draft)
    if not path_exists(spark, f"{path}/snapshots/{last:020d}"):
        move_if_absent(spark, draft, f"{path}/snapshots/{last:020d}")
    if path_exists(spark, draft):
        remove_path(spark, draft)
    older = [n for n in _numbers(spark, f"{path}/snapshots") if n < last]
    for n in _numbers(spark, f"{path}/commits"):
        if older and n <= older[-1]:
            remove_path(spark, f"{path}/commits/{n:020d}.json")
    for n in older[:-1]:
        remove_path(spark, f"{path}/snapshots/{n:020d}")
    return last


def ingest(spark: SparkSession, inputs: "str | Sequence[str]", base: str, registry_path: str,
           build: Callable[[], DataFrame]) -> tuple[DataFrame, str, bool]:
    """(dataset, checksum, built): load the version of these inputs, building it only if needed.

    Fingerprint -> registry hit? load : build, save, register. Idempotent: a second run
    loads; a run that was cut off after saving finds the complete version and only
    registers it. Of two runs at the same time both build, one's table becomes the version.
    """
    checksum = content_checksum(spark, inputs)
    name = table_name_from_checksum(checksum)
    hit = read_registry(spark, registry_path).where(F.col("hash") == checksum).first()
    if hit is not None:
        return load_dataset_version(spark, base, hit["table_name"]), checksum, False
    built = not is_complete(spark, f"{base.rstrip('/')}/{name}")
    if built:
        save_version_once(spark, build(), base, name)
    name = register_dataset(spark, registry_path, checksum, name)
    return load_dataset_version(spark, base, name), checksum, built


def save_version_once(spark: SparkSession, df: DataFrame, base: str, name: str) -> None:
    """Write a version beside its place and move it there whole, unless another writer has."""
    base = base.rstrip("/")
    draft, target = f"{base}/_building-{uuid.uuid4().hex}", f"{base}/{name}"
    df.write.parquet(draft)
    if path_exists(spark, target) and not is_complete(spark, target):
        remove_path(spark, target)  # what a run cut off while writing in place left behind
    if not path_exists(spark, target):
        move_if_absent(spark, draft, target)
    if path_exists(spark, draft):
        remove_path(spark, draft)


def append_run(spark: SparkSession, path: str, run: DataFrame) -> bool:
    """Add one run record (one row with a run_id) to the stored runs table unless that run is
    there (False then). Each run is a partition of its own, moved into place whole, so of two
    writers of one run one wins and readers never see half a record."""
    (run_id,) = [r["run_id"] for r in run.select("run_id").collect()]  # a record is one row
    draft = f"{path.rstrip('/')}/_adding-{uuid.uuid4().hex}"
    run.drop("run_id").coalesce(1).write.parquet(draft)
    added = not path_exists(spark, _run_folder(path, run_id)) and move_if_absent(spark, draft, _run_folder(path, run_id))
    if path_exists(spark, draft):
        remove_path(spark, draft)
    return added


def _run_folder(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_id={quote(run_id, safe='')}"


def read_runs(spark: SparkSession, path: str, schema) -> DataFrame:
    """The stored runs table in ``schema`` (which names run_id as text); empty before the first run."""
    if not any(n.startswith("run_id=") for n in list_names(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])
