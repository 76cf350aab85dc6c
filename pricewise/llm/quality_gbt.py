"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from whole texts in Arrow batches. The trees are fitted
on a bounded sample of labelled documents (``MAX_TRAIN_ROWS``) on binned
features; every tree is a complete binary tree flattened into three arrays, so
scoring walks all rows and trees level by level in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import SPACES, Words, keep_columns, per_row, renamed_back, sub_batches, utf8

# Labelled documents used for fitting, the first in the order of a hash of the id.
MAX_TRAIN_ROWS = 30_000

NAMES = ["log_bytes", "log_words", "word_len", "upper", "digits", "punct", "symbols", "bangs", "bars", "spaces",
         "non_ascii", "log_lines", "line_len", "distinct_words", "top_word", "repeat_word", "symbol_end",
         "double_end", "letterless", "distinct_lines", "stops"]


def _mask(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


_UPPER, _LOWER = _mask(bytes(range(65, 91))), _mask(bytes(range(97, 123)))
_DIGIT, _SPACE = _mask(b"0123456789"), _mask(SPACES)
_PUNCT = _mask(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_SYMBOL, _STOP = _mask(b"#$%&*+/<=>@\\^_`{|}~"), _mask(b".,;:!?")
_LETTER = _UPPER | _LOWER | _mask(bytes(range(128, 256)))


def statistics(column: pa.Array) -> np.ndarray:
    """One row of NAMES per text, from its whole text; all zero for null, empty and blank texts."""
    data, rows = utf8(column)
    words = Words(data, rows, SPACES)
    lines = Words(data, rows, b"\n")
    n_bytes, n_words, n_lines = np.diff(rows), words.counts(), lines.counts()
    per_byte, per_word = 1 / np.maximum(n_bytes, 1), 1 / np.maximum(n_words, 1)
    share = lambda m: per_row(m[data], rows) * per_byte
    length = np.diff(words.off)
    h = words.hashes()
    row = words.row_of()
    same = np.zeros(words.n, bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    end = words.data[words.off[1:] - 1] if words.n else np.zeros(0, np.uint8)
    before = words.data[np.maximum(words.off[1:] - 2, 0)] if words.n else end
    letters = per_row(_LETTER[words.data], words.off)
    of_words = lambda v: per_row(v, words.first) * per_word
    distinct, top = _distinct(row, h, len(n_bytes))
    lines_distinct, _ = _distinct(lines.row_of(), lines.hashes(), len(n_bytes))
    x = np.stack([
        np.log1p(n_bytes), np.log1p(n_words), of_words(length), share(_UPPER), share(_DIGIT), share(_PUNCT),
        share(_SYMBOL), share(_mask(b"!")), share(_mask(b"|")), share(_SPACE), share(_mask(bytes(range(128, 256)))),
        np.log1p(n_lines), n_bytes / np.maximum(n_lines, 1), distinct * per_word, top * per_word, of_words(same),
        of_words(_PUNCT[end] & ~_STOP[end]), of_words(_PUNCT[end] & (end == before) & (length > 1)),
        of_words(letters == 0), lines_distinct / np.maximum(n_lines, 1), share(_STOP)], axis=1)
    return np.where((n_words > 0)[:, None], x, 0.0)


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of different hashes and the count of the most frequent one."""
    if not len(row):
        return np.zeros(n), np.zeros(n)
    key = np.sort(row.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20))
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    owner = (key[head] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, owner, np.diff(np.append(head, len(key))))
    return np.bincount(owner, minlength=n).astype(float), top


# ------------------------------------------------------------------ trees

@dataclass
class Trees:
    """Complete binary trees as arrays (tree, node): children of i are 2i+1 and 2i+2; a row
    goes right where its feature exceeds the threshold (inf: never)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        tree, at = np.arange(len(self.feature))[None, :], np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            go = np.take_along_axis(x, self.feature[tree, at], 1) > self.threshold[tree, at]
            at = 2 * at + 1 + go
        z = self.base + self.value[tree, at].sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
              l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Second-order boosting of the logistic loss on binned features. One class only, or
    no rows: a constant score (0.5 without rows)."""
    nodes = 2 ** (depth + 1) - 1
    n, m = x.shape
    p = (y.sum() + 1) / (n + 2)
    out = Trees(float(np.log(p / (1 - p))), np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf),
                np.zeros((trees, nodes)), depth)
    if n == 0 or y.min() == y.max():
        return out
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    z = np.full(n, out.base)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-z))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            gains = np.full((width, m), -np.inf)
            cuts = np.zeros((width, m), np.int64)
            for j in range(m):
                cell = (node - first) * bins + code[:, j]
                sums = [np.bincount(cell, w, width * bins).reshape(width, bins).cumsum(1) for w in (g, h, None)]
                gl, hl, nl = (s[:, :-1] for s in sums)
                ga, ha, na = (s[:, -1:] for s in sums)
                gain = gl ** 2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga ** 2 / (ha + l2)
                gain[(nl < min_rows) | (na - nl < min_rows) | (np.arange(bins - 1) >= len(edges[j]))] = -np.inf
                cuts[:, j] = gain.argmax(1)
                gains[:, j] = gain.max(1)
            best = gains.argmax(1)
            for k in np.flatnonzero(gains.max(1) > 1e-6):
                out.feature[t, first + k] = best[k]
                out.threshold[t, first + k] = edges[best[k]][cuts[k, best[k]]]
            go = x[np.arange(n), out.feature[t, node]] > out.threshold[t, node]
            node = 2 * node + 1 + go
        gs, hs = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
        out.value[t] = -rate * gs / (hs + l2)
        z += out.value[t, node]
    return out


# ------------------------------------------------------------------ Spark

def held_out(id_col: Column) -> Column:
    """Documents kept out of training: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS, **params) -> Trees:
    """Fit on at most ``max_rows`` labelled documents outside the held-out third.

    Only ids are sampled before the texts are read, so the corpus is scanned once
    and features of the sample alone reach the driver (``max_rows`` x 21 numbers).
    Labels other than 0 and 1, without an id, or contradicting each other for an
    id are left out; of several texts under one id the one with the smallest
    statistics counts.
    """
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where("_id is not null and _y in (0, 1)")
             .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z")
             .where(~held_out(F.col("_id"))).select("_id", "_y")
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    # at most max_rows ids and labels: a proven bound for the broadcast
    src = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
           .join(F.broadcast(known), "_id").select("_id", "_y", "_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "_text"):
                x = statistics(b.column("_text"))
                yield pa.record_batch([b.column("_id"), b.column("_y").cast(pa.int32()),
                                       pa.array(list(x), pa.list_(pa.float64()))], names=["_id", "_y", "x"])

    t = src.schema["_id"].dataType.simpleString()
    got = (src.mapInArrow(run, f"_id {t}, _y int, x array<double>").groupBy("_id", "_y").agg(F.min("x").alias("x"))
           .orderBy("_id").toArrow())
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(NAMES))
    return fit_trees(x, got["_y"].to_numpy().astype(float), **params)


def score(docs: DataFrame, model: Trees, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1), predicted (score >= 0.5).

    Null and empty texts are scored like a text of all-zero statistics; a row
    without an id is scored and not held out; repeated rows give repeated rows.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "_text"):
                s = model.score(statistics(b.column("_text")))
                yield pa.record_batch([b.column("_id"), pa.array(s)], names=["_id", "score"])

    t = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {t}, score double").select(
        F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Trees, *, text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """``docs`` whose score reaches ``at_least``; columns unchanged, one pass, no shuffle."""
    src, names, schema = keep_columns(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "_text"):
                ok = model.score(statistics(b.column("_text"))) >= at_least
                yield b.filter(pa.array(ok)).select(names)

    return renamed_back(src.mapInArrow(run, schema), names, docs.columns)
