"""Benchmark decontamination with suffix arrays over the training texts.

The training side is cut into shards (a few MB of whole documents each, as they
stand in a partition, so nothing is shuffled). A shard's words are numbered in
the vocabulary of the test items; a foreign word is 0, can match nothing and
ends every match. The suffixes that start with a vocabulary word are sorted by
prefix doubling, and every test suffix is looked up by binary search, which
gives its longest verbatim match in the shard and the places of all its
occurrences. A window of a test item occurs where the longest match of the suffix it
begins spans it. The test items travel to the shards in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import Words, keep_columns, renamed_back, sub_batches, utf8

# everything in ASCII but digits and letters separates words
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
BLOCK_BYTES = 8 << 20  # of test text sent to the tasks at a time
SHARD_BYTES = 4 << 20  # of training text under one suffix array


# ------------------------------------------------------------------ test side

class TestBlock:
    """Some test items, numbered in their own vocabulary (word ids from 1).

    ``text`` holds the different items back to back, with -1 before, between and after
    them. Every word of it begins a suffix: ``start`` is its place, ``item`` and ``pos``
    say whose it is, ``left`` how many words it has. Equal items are held once;
    ``names`` lists their ids. Items without words are not held.
    """

    __test__ = False

    def __init__(self, items: list[tuple[str | None, str | None]]):
        data, rows = utf8(pa.array([t for _, t in items], pa.string()))
        words = Words(data, rows, SEPARATORS)
        coded = words.array().dictionary_encode()
        self.vocab = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64) + 1
        same: dict[bytes, list[str | None]] = {}
        for k, (name, _) in enumerate(items):
            if words.first[k] < words.first[k + 1]:
                same.setdefault(ids[words.first[k]:words.first[k + 1]].tobytes(), []).append(name)
        self.names = list(same.values())
        held = [np.frombuffer(k, np.int64) for k in same]
        self.size = np.array([len(h) for h in held], np.int64)
        self.text = np.concatenate([[-1], *[x for h in held for x in (h, [-1])]]).astype(np.int64)
        self.item = np.repeat(np.arange(len(held)), self.size)
        self.start = np.flatnonzero(self.text > 0)
        self.pos = np.arange(len(self.start)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.left = self.size[self.item] - self.pos
        self.depth = int(self.size.max(initial=1))


def test_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcast the test items in blocks of about ``block_bytes`` (a longer item is a
    block of its own); the driver holds one block at a time."""
    sc = benchmark.sparkSession.sparkContext
    out, items, size = [], [], 0
    for r in benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        items.append((r[0], r[1]))
        size += len(r[1] or "")
        if size >= block_bytes:
            out.append(sc.broadcast(TestBlock(items)))
            items, size = [], 0
    if items or not out:
        out.append(sc.broadcast(TestBlock(items)))
    return out


# ------------------------------------------------------------------ shard side

class Shard:
    """Suffix array of some whole texts in a test block's vocabulary."""

    def __init__(self, words: Words, vocab: pa.Array, depth: int):
        at = pc.index_in(words.array(), value_set=vocab)
        ids = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.row = words.row_of()
        # one 0 after each row keeps matches inside their text
        self.place = np.arange(len(ids)) + self.row
        self.text = np.zeros(len(ids) + len(words.first) + depth, np.int64)
        self.text[self.place] = ids
        self.word = np.zeros(len(self.text), np.int64)
        self.word[self.place] = np.arange(len(ids))
        self.sa = suffix_array(self.text, depth)
        self.heads = np.searchsorted(self.text[self.sa], np.arange(len(vocab) + 2))

    def seek(self, test: np.ndarray, start: np.ndarray, n: np.ndarray, upper: bool) -> np.ndarray:
        """Index in the suffix array of the first suffix not below (``upper``: above every
        suffix that starts with) each query, the ``n`` words of ``test`` from ``start``."""
        first = test[start]
        lo, hi = self.heads[first].copy(), self.heads[first + 1].copy()
        while True:
            act = np.flatnonzero(lo < hi)
            if not len(act):
                return lo
            mid = (lo[act] + hi[act]) >> 1
            below = self._below(self.sa[mid], test, start[act], n[act], upper)
            lo[act[below]] = mid[below] + 1
            hi[act[~below]] = mid[~below]

    def _below(self, pos: np.ndarray, test: np.ndarray, start: np.ndarray, n: np.ndarray, upper: bool) -> np.ndarray:
        out = np.full(len(pos), upper)  # equal over the whole query
        act, k = np.arange(len(pos)), 0
        while True:
            act = act[n[act] > k]
            if not len(act):
                return out
            q, t = test[start[act] + k], self.text[pos[act] + k]
            out[act[t < q]] = True
            out[act[t > q]] = False
            act, k = act[t == q], k + 1

    def common(self, pos: np.ndarray, test: np.ndarray, start: np.ndarray, n: np.ndarray, known: int = 0) -> np.ndarray:
        """How many words the texts at ``pos`` share with the queries (``known``: shared for certain)."""
        out = n.copy()
        act, k = np.arange(len(pos)), known
        while True:
            act = act[n[act] > k]
            if not len(act):
                return out
            same = self.text[pos[act] + k] == test[start[act] + k]
            out[act[~same]] = k
            act, k = act[same], k + 1

    def longest(self, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
        """Longest verbatim match of every test suffix in this shard (words) and a place of it:
        it is a neighbour of the place where the binary search for the suffix ends."""
        best, where = np.zeros(len(block.start), np.int64), np.zeros(len(block.start), np.int64)
        if not len(self.sa):
            return best, where
        lo = self.seek(block.text, block.start, block.left, False)
        for side in (lo, lo - 1):
            at = self.sa[np.clip(side, 0, len(self.sa) - 1)]
            n = self.common(at, block.text, block.start, block.left)
            better = n > best
            best[better], where[better] = n[better], at[better]
        return best, where


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the non-zero words of ``text`` (at least ``depth`` zeros at its
    end), in the order of the word sequences that start there, compared over
    ``depth`` words or up to the first 0. Prefix doubling; only positions still
    tied are sorted again."""
    sa = np.flatnonzero(text)
    if not len(sa):
        return sa
    small = text.max() < 1 << 16
    sa = sa[np.argsort(text[sa].astype(np.uint16) if small else text[sa], kind="stable")]
    rank = np.zeros(len(text), np.int64)  # 1 + index of the first suffix of the same tie
    w = text[sa]
    head = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
    rank[sa] = np.repeat(head + 1, np.diff(np.append(head, len(sa))))
    k = 1
    slots = np.arange(len(sa))  # of the suffix array still to be settled
    while k < depth:
        r = rank[sa[slots]]
        nxt = rank[sa[slots] + k]
        # a tie lasts only among suffixes that did not end within k words
        size = np.bincount(r)[r]
        live = size > 1
        slots, r, nxt = slots[live], r[live], nxt[live]
        if not len(slots):
            break
        order = np.argsort(r * (len(text) + 1) + nxt, kind="stable")
        r, nxt = r[order], nxt[order]
        sa[slots] = sa[slots][order]
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (nxt[1:] != nxt[:-1])))
        head = np.flatnonzero(new)
        rank[sa[slots]] = np.repeat(slots[head] + 1, np.diff(np.append(head, len(slots))))
        slots = slots[nxt != 0]
        k *= 2
    return sa


PLACE_BITS = 40  # of a code (length, place) that is greatest for the longest and then the first match


def _match(words: Words, block: TestBlock, window: int) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """Which words lie in an occurrence of a test window; (row, item) pairs that occur; the
    code of every row's longest match (-1: none of window length).

    Every test suffix is looked up. Where its longest match spans its window, the window
    occurs, and one more search gives the interval of all its places.
    """
    hit = np.zeros(words.n + 1, np.int64)
    code = np.full(len(words.first) - 1, -1, np.int64)
    if not words.n or not len(block.start):
        return hit[:-1] > 0, [], code
    shard = Shard(words, block.vocab, block.depth)
    best, _ = shard.longest(block)
    need = np.minimum(window, block.size[block.item])
    found = np.flatnonzero(best >= need)
    if not len(found):
        return hit[:-1] > 0, [], code
    lo, hi = (shard.seek(block.text, block.start[found], need[found], upper) for upper in (False, True))
    # equal windows have one interval of places
    spans, of = np.unique(np.stack([lo, hi, need[found]], 1), axis=0, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    ends = np.searchsorted(of.ravel()[order], np.arange(len(spans) + 1))
    pairs = []
    for g, (a, b, n) in enumerate(spans.tolist()):
        place = shard.sa[a:b]
        word = shard.word[place]
        row = shard.row[word]
        hit[word] += 1
        hit[word + n] -= 1
        members = found[order[ends[g]:ends[g + 1]]]
        items, rows = np.unique(block.item[members]), np.unique(row)
        pairs.append(np.stack([np.repeat(rows, len(items)), np.tile(items, len(rows))], 1))
        for s in members.tolist():
            # a match that goes on to the left is measured from there
            new = np.flatnonzero(shard.text[place - 1] != block.text[block.start[s] - 1])
            if len(new):
                start, left = (np.full(len(new), x[s]) for x in (block.start, block.left))
                size = shard.common(place[new], block.text, start, left, n)
                at = word[new] - words.first[row[new]]
                np.maximum.at(code, row[new], (size << PLACE_BITS) + (1 << PLACE_BITS) - 1 - at)
    return np.cumsum(hit[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0).tolist(), code


def _annotate(blocks: list, window: int, keep: list[str], clean_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "_text", SHARD_BYTES):
                data, rows = utf8(b.column("_text"))
                words = Words(data, rows, SEPARATORS)
                hit = np.zeros(words.n, bool)
                code = np.full(b.num_rows, -1, np.int64)
                names: list[set] = [set() for _ in range(b.num_rows)]
                for block in blocks:
                    more, pairs, longest = _match(words, block.value, window)
                    hit |= more
                    code = np.maximum(code, longest)
                    for row, item in pairs:
                        names[row].update(block.value.names[item])
                total = np.concatenate(([0], np.cumsum(hit)))
                n_hit = total[words.first[1:]] - total[words.first[:-1]]
                if clean_only:
                    yield b.filter(pa.array(n_hit == 0)).select(keep)
                    continue
                listed = [sorted(n for n in s if n is not None) for s in names]
                place = (1 << PLACE_BITS) - 1 - (code & ((1 << PLACE_BITS) - 1))
                yield pa.record_batch(
                    [*[b.column(c) for c in keep], pa.array(words.counts().astype(np.int64)),
                     pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in listed], pa.int64()),
                     pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed], pa.string()),
                     pa.array(listed, pa.list_(pa.string())), pa.array(n_hit > 0),
                     pa.array(np.where(code < 0, 0, code >> PLACE_BITS)), pa.array(place, mask=code < 0)],
                    names=[*keep, "n_words", "n_hit", "n_items", "items_sha256", "items", "contaminated",
                           "longest_match", "longest_at"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, items, contaminated,
    longest_match, longest_at.

    Words are runs of ASCII digits, letters (lower-cased) and non-ASCII characters. A
    window is ``window`` consecutive words of an item, or the whole of a shorter
    item that has words. A document word is hit if it lies in any occurrence of
    a window. ``items`` are the ids of items with an occurring window, sorted as
    strings. ``longest_match`` is the number of words of the document's longest verbatim
    match with any item and ``longest_at`` the word (from 0) where the first such match
    begins; 0 and null where no window occurs. Null and empty texts have no words and are clean; an item without
    an id still hits words but is not listed; items without words do nothing;
    equal items are each listed; an empty benchmark leaves all clean. Whole texts
    are searched, a long one as a shard of its own.
    """
    blocks = test_blocks(benchmark, item_id, item_text, block_bytes)
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    t = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(_annotate(blocks, window, ["_id"], False),
                         f"_id {t}, n_words long, n_hit long, n_items long, items_sha256 string, "
                         "items array<string>, contaminated boolean, longest_match long, longest_at long")
    return out.withColumnRenamed("_id", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold any test window; columns unchanged. One pass, no shuffle."""
    blocks = test_blocks(benchmark, item_id, item_text, block_bytes)
    src, names, schema = keep_columns(docs, text_col)
    return renamed_back(src.mapInArrow(_annotate(blocks, window, names, True), schema), names, docs.columns)


def _longest(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk = block.value
        for whole in batches:
            for b in sub_batches(whole, "_text", SHARD_BYTES):
                data, rows = utf8(b.column("_text"))
                words = Words(data, rows, SEPARATORS)
                if not words.n or not len(blk.start):
                    continue
                shard = Shard(words, blk.vocab, blk.depth)
                best, where = shard.longest(blk)
                got = np.flatnonzero(best)
                word = shard.word[where[got]]
                row = shard.row[word]
                names = [blk.names[i] for i in blk.item[got]]
                again = pa.array(np.repeat(np.arange(len(got)), [len(x) for x in names]))  # equal items
                yield pa.record_batch(
                    [pa.array([n for x in names for n in x], pa.string()), pa.array(blk.pos[got]).take(again),
                     pa.array(best[got]).take(again), b.column("_id").take(pa.array(row)).take(again),
                     pa.array(word - words.first[:-1][row]).take(again)],
                    names=["item_id", "item_pos", "length", "_id", "doc_pos"])
    return run


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Longest verbatim match of every test suffix in the whole corpus, with a place of it:
    (item_id, item_pos, length, doc_id, doc_pos), in words; suffixes whose first
    word never occurs have no row. Of equal matches in one shard any place is
    given; of several shards that of the smallest document id. Each shard hands on
    one row per test suffix; the maximum over shards is combined on the map side."""
    parts = None
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    t = src.schema["_id"].dataType.simpleString()
    for block in test_blocks(benchmark, item_id, item_text, block_bytes):
        out = src.mapInArrow(_longest(block), f"item_id string, item_pos long, length long, _id {t}, doc_pos long")
        parts = out if parts is None else parts.unionByName(out)
    best = F.min(F.struct((-F.col("length")).alias("n"), "_id", "doc_pos")).alias("b")
    return parts.groupBy("item_id", "item_pos").agg(best).select(
        "item_id", "item_pos", (-F.col("b.n")).alias("length"), F.col("b._id").alias(id_col),
        F.col("b.doc_pos").alias("doc_pos"))
