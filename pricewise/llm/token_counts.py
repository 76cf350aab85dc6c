"""Token counts by rank-synchronous merging of ragged numpy arrays.

Texts are cut into pre-tokens; distinct pre-tokens of a batch are held as one
flat array of symbols with the row of each. In every round each pre-token finds its
lowest-ranked adjacent pair and merges it wherever it stands, all rows at once,
until no row has a mergeable pair; the surviving symbols are its tokens.
(A merged symbol only takes part in higher ranks, so merging all places of a
pair at once equals merging them one by one from the left.)
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import sub_batches

# Fixed value: the split pattern of byte-level BPE files whose ByteLevel pre-tokenizer uses its own pattern
# (white space by its Unicode property).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
CACHE_WORDS = 200_000  # of the per-worker memo of pre-token sizes
NO_RANK = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTable:
    """Open-addressed hash table from (left, right) symbol ids to (rank, merged id)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(2 * len(left)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NO_RANK, np.int64)
        self.merged = np.zeros(1 << bits, np.int64)
        key = left << 32 | right
        todo, at = np.arange(len(key)), self._home(key)
        while len(todo):
            # of several keys for one free slot the first is placed, the others move on
            free = self.key[at] == -1
            slot, first = np.unique(at[free], return_index=True)
            winners = todo[free][first]
            self.key[slot], self.rank[slot], self.merged[slot] = key[winners], winners, merged[winners]
            placed = self.key[at] == key[todo]
            todo, at = todo[~placed], (at[~placed] + 1) & self.mask

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = self._home(key)
        rank, merged = np.full(len(key), NO_RANK, np.int64), np.zeros(len(key), np.int64)
        act = np.arange(len(key))
        while len(act):
            seen = self.key[at]
            hit = seen == key[act]
            rank[act[hit]], merged[act[hit]] = self.rank[at[hit]], self.merged[at[hit]]
            on = ~hit & (seen != -1)
            act, at = act[on], (at[on] + 1) & self.mask
        return rank, merged


class Counter:
    """Counts the tokens a byte-level BPE ``tokenizers`` file gives for whole texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                 and not pre.get("add_prefix_space") and spec["normalizer"] is None
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are supported")
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.table = PairTable(np.array([vocab[a] for a, _ in pairs], np.int64),
                               np.array([vocab[b] for _, b in pairs], np.int64),
                               np.array([vocab[a + b] for a, b in pairs], np.int64))
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.memo: dict[str, int] = {}

    def sizes(self, tokens: list[bytes]) -> np.ndarray:
        """Number of tokens of every pre-token, by rank-synchronous merging."""
        out = np.zeros(len(tokens), np.int64)
        lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        sym = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        row = np.repeat(np.arange(len(tokens)), lens)
        rank, merged = self._ranks(sym, row)
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(row)))
            # rows without a mergeable pair are done
            done = low == NO_RANK
            out[row[first[done]]] = size[done]
            live = np.repeat(~done, size)
            sym, row, rank, merged, low = sym[live], row[live], rank[live], merged[live], np.repeat(low, size)[live]
            if not len(sym):
                break
            # every place of the lowest pair, in runs of overlapping places every other one
            hit = rank == low
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[nth % 2 == 0]
            sym[at] = merged[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            # only pairs beside a merged symbol change
            touched = np.zeros(len(sym), bool)
            touched[at] = True
            touched[np.maximum(at - 1, 0)] = True
            sym, row, rank, merged, touched = sym[keep], row[keep], rank[keep], merged[keep], touched[keep]
            i = np.flatnonzero(touched)
            rank[i], merged[i] = self._pairs(sym, row, i)
        return out

    def _pairs(self, sym: np.ndarray, row: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the pairs that start at ``i``."""
        rank, merged = np.full(len(i), NO_RANK, np.int64), np.zeros(len(i), np.int64)
        inner = np.flatnonzero((i + 1 < len(sym)) & (row[np.minimum(i + 1, len(sym) - 1)] == row[i]))
        rank[inner], merged[inner] = self.table.find(sym[i[inner]], sym[i[inner] + 1])
        return rank, merged

    def _ranks(self, sym: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._pairs(sym, row, np.arange(len(sym)))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Token counts of whole texts; added tokens inside them count one each."""
        pieces, of, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = text or ""
            if self.added is not None and self.added.search(text):
                extra[i] = sum(1 for _ in self.added.finditer(text))
                found = [w for part in self.added.split(text) for w in self.pattern.findall(part)]
            else:
                found = self.pattern.findall(text)
            pieces += found
            of.append(len(found))
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.memo]
        if len(self.memo) + len(new) > CACHE_WORDS:
            self.memo, new = {}, distinct
        self.memo.update(zip(new, self.sizes([w.encode() for w in new]).tolist()))
        size = np.fromiter((self.memo[w] for w in distinct), np.int64, len(distinct))
        each = size[coded.indices.to_numpy()]
        total = np.concatenate(([0], np.cumsum(each)))
        bound = np.concatenate(([0], np.cumsum(of, dtype=np.int64)))
        return total[bound[1:]] - total[bound[:-1]] + extra


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer_path: str, *, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Null and empty texts have 0 of both. Whole texts are counted, without begin, end or
    padding tokens; strings of added tokens inside texts are those tokens. Null
    ids and repeated rows pass through; other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for whole in batches:
            for b in sub_batches(whole, "_text", 2 << 20):
                texts = b.column("_text").to_pylist()
                n = count(texts)
                size = np.array([len((t or "").encode()) for t in texts], np.int64)
                yield pa.record_batch([b.column("_id"), pa.array(size), pa.array(n), pa.array(n > limit)],
                                      names=["_id", "n_bytes", "n_tokens", "over_limit"])

    t = src.schema["_id"].dataType.simpleString()
    return (src.mapInArrow(run, f"_id {t}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("_id", id_col))
