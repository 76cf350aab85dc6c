"""Session construction and the shared scratch/checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Fixed values for local runs and tests; on a cluster the deployment's own
# configuration wins because getOrCreate() reuses the active session.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "pricewise", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) one."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no local SparkContext
        return None


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (keys per-session caches)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    folder (HDFS/S3/...); we never replace it. Only a bare local session
    (tests) gets a private folder.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        # a bare local session (tests) gets a private folder
        configured = tempfile.mkdtemp(prefix="pricewise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pricewise/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a location in any storage Spark can reach."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, target = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def move_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder unless the target exists (False then). The storage decides: of two
    movers one wins. Local files are linked, since a local rename replaces silently."""
    fs, dst = hadoop_path(spark, target)
    _, src = hadoop_path(spark, source)
    fs.mkdirs(dst.getParent())
    if fs.getScheme() == "file" and fs.getFileStatus(src).isFile():
        try:
            os.link(src.toUri().getPath(), dst.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            fs.delete(src, False)
        return True
    context = spark.sparkContext._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(context.Options.Rename, 1)
    options[0] = getattr(context.Options.Rename, "NONE")
    try:
        context.FileContext.getFileContext(dst.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(src, dst, options)
    except Py4JJavaError:
        if fs.exists(dst):
            return False
        raise
    return True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and return a scan of it: several
    readers share one computation, nothing stays in executor memory, and a
    lost executor re-reads the rows instead of replaying their lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path", "stored", "app_key", "path_exists", "remove_path", "LOCAL_CONF"]
