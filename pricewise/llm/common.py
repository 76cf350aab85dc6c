"""Shared helpers: tables, stored intermediates, size-checked joins, byte views of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import scratch_path

# Tables under this many estimated bytes may be broadcast.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and return a scan of it.

    Cuts the lineage: a lost executor re-reads the table instead of replaying
    everything above it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_sized(big: DataFrame, side: DataFrame, on: list[str], how: str, row_bytes: int = 64,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a stored ``side``: broadcast while rows x ``row_bytes`` is under ``limit``,
    a shuffle join (AQE splits skewed partitions) beyond it. Same rows either way."""
    if side.count() * row_bytes <= limit:
        side = F.broadcast(side)
    return big.join(side, on, how)


# ------------------------------------------------------------------ Arrow text

def sub_batches(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20,
                max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into slices of at most ``max_rows`` rows whose ``column`` holds
    about ``max_bytes`` of text; a longer single text is a slice of its own, so
    nothing is cut short."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + max_rows, int(np.searchsorted(ends, base + max_bytes, side="right"))))
        yield batch.slice(start, stop - start)
        start = stop
    # workers are reused by later stages: hand free memory back
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its row offsets (rows + 1, from 0); null is empty."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    if len(a) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = a.buffers()
    off = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``bounds`` (rows may be empty)."""
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[bounds[1:]] - c[bounds[:-1]]


class Words:
    """Words of a block of rows: maximal runs of bytes outside ``separators``,
    A-Z lower-cased unless ``lower`` is off. Words never span rows, nor the bytes
    before which ``cuts`` is set.

    ``data`` holds the bytes of all words back to back, ``off`` the word
    offsets in it, ``first`` the index of each row's first word (rows + 1).
    """

    def __init__(self, data: np.ndarray, rows: np.ndarray, separators: bytes, lower: bool = True,
                 cuts: np.ndarray | None = None):
        in_word = np.ones(256, bool)
        in_word[np.frombuffer(separators, np.uint8)] = False
        inside = in_word[data]
        starts = inside.copy()
        if len(data):
            starts[1:] &= ~inside[:-1] if cuts is None else ~inside[:-1] | cuts[1:]
            at = rows[:-1][rows[:-1] < len(data)]
            starts[at] = inside[at]
        pos = np.flatnonzero(starts)
        self.data = LOWER[data[inside]] if lower else data[inside]
        kept = np.zeros(len(data) + 1, np.int64)
        np.cumsum(inside, out=kept[1:])
        self.off = np.append(kept[pos], len(self.data))
        self.first = np.searchsorted(pos, rows)
        self.n = len(pos)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word (multiply-add over its bytes, fixed odd factors)."""
        if not self.n:
            return np.zeros(0, np.uint64)
        at = (np.arange(len(self.data)) - np.repeat(self.off[:-1], np.diff(self.off))) & 255
        return np.add.reduceat((self.data.astype(np.uint64) + np.uint64(1)) * _FACTORS[at], self.off[:-1])

    def array(self) -> pa.Array:
        """The words as an Arrow binary array."""
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), self.n, [None, pa.py_buffer(self.off.astype(np.int64)), pa.py_buffer(self.data)])

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each; starts and ends of the words in it."""
        lens = np.diff(self.off)
        k = np.arange(self.n)
        out = np.full(len(self.data) + self.n, 32, np.uint8)
        out[np.arange(len(self.data)) + np.repeat(k, lens)] = self.data
        start = self.off[:-1] + k
        return out.tobytes(), start, start + lens


# ------------------------------------------------------------------ components

def component_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, label = smallest node).

    Alternates two star steps until nothing changes: every node hands the
    smallest of its neighbourhood to its larger neighbours, then to its smaller
    ones. Each half step is one map-side-combined minimum and one join, and
    edges never grow beyond their first count; each round is written to the
    shared folder, so no round replays the earlier ones. Raises if
    ``max_rounds`` (far above the logarithmic need) do not suffice.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "links")
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    seen = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .where("u <> v").distinct())
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        hand = big.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(hand.union(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)


def neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns renamed by place (_c0, _c1, ...), so that no working column can
    clash with one, and the new name of each old one."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def keep_columns(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[str], str]:
    """All columns under neutral names, the text as ``_text``, with those names and their
    schema: what a map over Arrow batches needs to pass every column through, each sent once."""
    names = ["_text" if c == text_col else f"_c{i}" for i, c in enumerate(docs.columns)]
    src = docs.toDF(*names)
    return src, names, ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)


def renamed_back(out: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    return out.select(*[F.col(n).alias(c) for c, n in zip(columns, names)])
