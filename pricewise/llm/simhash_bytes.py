"""SimHash near-duplicates through an inverted index on byte positions.

A fingerprint has eight (position, byte) postings. Two fingerprints that differ
in at most ``k`` bits differ in at most ``k`` bytes, so they share at least
``8 - k`` positional bytes: the count filter's guaranteed minimum. Lists on
single postings hold 1/256 of the corpus each and their pairs grow with the
square of it, so the index intersects postings up front: a fingerprint is
posted once under every choice of ``8 - k`` of its positional bytes. A pair
meets in some list exactly if its tally of shared positional bytes reaches the
minimum. Members of a list differ only in the ``k`` remaining bytes, so a list
never exceeds ``256**k`` distinct fingerprints, whatever the corpus holds.

Candidates of a list are verified by their differing bits. Short lists do so
pair by pair; long ones probe every allowed bit flip against a table of the
list's members and hand on a spanning star of each linked set, so output stays
linear in the members and no link is lost from the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import SPACES, Words, component_labels, join_sized, neutral, stored, sub_batches, utf8

BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
PAIRWISE = 64  # longer lists are probed by bit flips instead of pair by pair


def fingerprints(column: pa.Array, shingle: int = 3) -> np.ndarray:
    """64-bit SimHash of every text: lower-cased ASCII, words between white space,
    shingles of ``shingle`` words with repeats (the whole sequence if fewer),
    XXH64 seed 42, a bit is set if it is set in over half the hashes; no words: 0."""
    data, rows = utf8(column)
    words = Words(data, rows, SPACES)
    text, start, end = words.joined()
    n = words.counts()
    per_row = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    base = np.concatenate(([0], np.cumsum(per_row)))
    row = np.repeat(np.arange(len(n)), per_row)
    first = words.first[:-1][row] + np.arange(base[-1]) - base[:-1][row]
    last = np.minimum(first + shingle, words.first[1:][row]) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[s:e], 42) for s, e in zip(start[first].tolist(), end[last].tolist())),
                    np.uint64, base[-1])
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(per_row)
    if len(full):
        # count byte values per row and position, then the bits of each value
        cell = row * 256
        on = [np.bincount(cell + column, minlength=256 * len(n)).reshape(-1, 256) @ BITS * 2 > per_row[:, None]
              for column in h.astype("<u8").view(np.uint8).reshape(-1, 8).T]
        out[full] = np.packbits(np.concatenate(on, axis=1)[full], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "text"):
                fp = pa.array(fingerprints(b.column("text"), shingle).view(np.int64))
                yield pa.record_batch([b.column("id"), b.column("th"), fp], names=["id", "th", "fp"])
    return run


def _links(members: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Verified links of one list; for a long list a spanning star of each linked set."""
    if len(members) <= PAIRWISE:
        i, j = np.triu_indices(len(members), 1)
        a, b = members[i], members[j]
        x = a ^ b
        shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        ok = (shared >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)
        return [(a[ok], b[ok])]
    differ = np.bitwise_or.reduce(members ^ members[0])
    bits = [np.uint64(1) << np.uint64(b) for b in range(64) if int(differ) >> b & 1]
    members = np.sort(members)
    label = np.arange(len(members))
    probes = []
    for k in range(1, max_bits + 1):
        for chosen in combinations(bits, k):
            want = members ^ np.bitwise_or.reduce(np.array(chosen, np.uint64))
            at = np.minimum(np.searchsorted(members, want), len(members) - 1)
            src = np.flatnonzero(members[at] == want)
            if len(src):
                probes.append((src, at[src]))
    while True:
        before = label.copy()
        for src, dst in probes:
            np.minimum.at(label, src, label[dst])
        label = label[label]
        if np.array_equal(before, label):
            break
    out = np.flatnonzero(label != np.arange(len(members)))
    return [(members[out], members[label[out]])]


def _verify(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("members")
            off = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().view(np.uint64)
            size = np.diff(off)
            two = np.flatnonzero(size == 2)
            # lists of two, the common case, in one step
            x, y = flat[off[two]], flat[off[two] + 1]
            d = x ^ y
            shared = (d.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            ok = (shared >= 8 - max_bits) & (np.bitwise_count(d) <= max_bits)
            found = [(x[ok], y[ok])]
            for i in np.flatnonzero(size > 2):
                found += _links(flat[off[i]:off[i + 1]], max_bits)
            a, c = (np.concatenate([f[k] for f in found]).view(np.int64) for k in (0, 1))
            yield pa.record_batch([pa.array(a), pa.array(c)], names=["a", "b"])
    return run


def positional_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` at ``max_bits`` or fewer
    differing bits, as spanning links of every posting list."""
    if not 0 < max_bits < 8:
        raise ValueError("max_bits must be 1 to 7: beyond it no positional byte need be shared")
    posts = []
    for slot, kept in enumerate(combinations(range(8), 8 - max_bits)):
        mask = int(np.array([sum(0xFF << 8 * p for p in kept)], np.uint64).view(np.int64)[0])
        posts.append(F.struct(F.lit(slot).alias("slot"), F.col("fp").bitwiseAND(F.lit(mask)).alias("shared")))
    lists = (fps.select("fp", F.explode(F.array(*posts)).alias("p")).groupBy("p.slot", "p.shared")
             .agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1).select("members"))
    return lists.mapInArrow(_verify(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, ``text_hash`` (xxhash64 of the text), fingerprint
    (16 hex digits) and component_id, the smallest id reachable over links.

    Null and empty texts have fingerprint zero and link like any other. A row
    without an id cannot be named: it takes no part in linking and its
    component_id is null. Repeated rows are returned as often as they occur.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"),
                      F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    prints = stored(src.mapInArrow(_fingerprint_batches(shingle), f"id {id_type}, th long, fp long"), "simhash")
    classes = prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("first_id"))
    classes = stored(classes, "simhash-classes")
    labels = stored(component_labels(positional_links(classes.select("fp"), max_bits))
                    .withColumnRenamed("node", "fp"), "simhash-labels")
    least = labels.join(classes, "fp").groupBy("label").agg(F.min("first_id").alias("least"))
    named = stored(classes.join(labels.join(least, "label").select("fp", "least"), "fp", "left")
                   .select("fp", F.coalesce("least", "first_id").alias("component_id")), "simhash-named")
    return (join_sized(prints, named, ["fp"], "left", row_bytes=48)
            .select(F.col("id").alias(id_col), F.col("th").alias("text_hash"),
                    F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of every component: the one of its smallest id (of rows
    that share this id the smallest text hash, of identical rows one). Rows
    without an id stay. Columns and their names are those of ``docs``."""
    found = stored(near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, max_bits=max_bits)
                   .where(F.col("component_id").isNotNull())
                   .select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_th"),
                           F.col("component_id").alias("_c")), "simhash-found")
    kept = stored(found.groupBy("_c").agg(F.min(F.struct("_id", "_th")).alias("k")).select("k._id", "k._th"),
                  "simhash-kept")
    gone = stored(found.select("_id", "_th").distinct().join(kept, ["_id", "_th"], "left_anti"), "simhash-gone")
    twice = stored(found.join(kept, ["_id", "_th"], "left_semi").groupBy("_id", "_th").count().where("count > 1")
                   .select("_id", "_th"), "simhash-twice")
    base, name = neutral(docs)
    keyed = base.withColumns({"_id": F.col(name[id_col]), "_th": F.xxhash64(name[text_col])})
    rest = join_sized(keyed, gone, ["_id", "_th"], "left_anti")
    once = join_sized(rest, twice, ["_id", "_th"], "left_anti")
    collapsed = join_sized(rest, twice, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"])
    return once.unionByName(collapsed).select(*[F.col(n).alias(c) for c, n in name.items()])
