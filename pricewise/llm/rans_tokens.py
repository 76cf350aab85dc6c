"""Token-ID output in a static range asymmetric numeral system (rANS) format.

A corpus is tokenised once; token counts over all of it give one shared frequency
table (normalised to ``2**SCALE_BITS``). Documents are range-partitioned by id
and packed, in ascending order, into independent blocks of whole documents. A
block codes symbol ``t`` on lane ``t % lanes`` of interleaved rANS states (64-bit
states, 32-bit words), keeps a checkpoint of all lanes every ``CHECK_ROWS`` lane
rows, so decoding can start inside it, and a crc32 of its ids.

The output is a folder of two Parquet tables (``table``: symbol, freq; ``blocks``),
which any Spark storage can hold; payloads are stored as they are.

Payload: header (struct HEADER), checkpoint word positions (u64), checkpoint
lane states (u64), words (u32), all little-endian.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricewise.llm.common import LOWER, SPACES, Words, join_sized, stored, sub_batches, utf8
from pricewise.llm.token_counts import byte_symbols
from pricewise.session import scratch_path

MAGIC, VERSION = b"PWRA", 1
HEADER = "<4sHHIIIQQI"  # magic, version, scale bits, lanes, rows per checkpoint, checkpoints, ids, words, crc32
SCALE_BITS = 18
LANES = 1024
CHECK_ROWS = 128
BLOCK_TOKENS = 1 << 19
PART_TOKENS = 8 << 20
LOW = np.uint64(1) << np.uint64(32)
CACHE_PIECES = 1 << 19  # a worker's memo from pieces to ids; beyond it only the last slice's stay
SLICE_BYTES, SLICE_ROWS = 4 << 20, 1 << 14  # of text encoded at once


# ------------------------------------------------------------------ coder

def normalise(counts: np.ndarray, scale_bits: int = SCALE_BITS) -> np.ndarray:
    """Integer frequencies with sum ``2**scale_bits``, at least 1 for every symbol that occurs."""
    scale = 1 << scale_bits
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > scale:
        raise ValueError("more symbols than the frequency scale holds")
    exact = counts.astype(float) * (scale / total)
    freq = np.where(counts > 0, np.maximum(1, np.floor(exact)), 0).astype(np.int64)
    left = scale - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if left > 0:
        freq[order[0]] += left
    for s in order:
        if left >= 0:
            break
        take = min(-left, int(freq[s]) // 2)
        freq[s] -= take
        left += take
    return freq


class Coder:
    """Encoder and decoder of blocks under one frequency table."""

    def __init__(self, freq: np.ndarray, scale_bits: int = SCALE_BITS):
        self.bits = np.uint64(scale_bits)
        self.scale_bits = scale_bits
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, check_rows: int = CHECK_ROWS) -> bytes:
        n = len(ids)
        lanes = max(1, min(lanes, n // 64))
        rows = -(-n // lanes)
        if n and not self.freq[ids].all():
            raise ValueError("a symbol has no frequency")
        x = np.full(lanes, LOW, np.uint64)
        words, states, emitted, total = [], [], [], 0
        high = np.uint64(64) - self.bits
        for r in range(rows - 1, -1, -1):
            s = ids[r * lanes:(r + 1) * lanes]
            f, c = self.freq[s], self.start[s]
            y = x[:len(s)]
            full = (y >> high) >= f
            out = y[full]
            words.append(out.astype(np.uint32))  # the low 32 bits
            total += len(out)
            y = np.where(full, y >> np.uint64(32), y)
            q = y // f
            x[:len(s)] = (q << self.bits) + (y - q * f) + c
            if r % check_rows == 0:
                states.append(x.copy())
                emitted.append(total)
        head = struct.pack(HEADER, MAGIC, VERSION, self.scale_bits, lanes, check_rows, len(states), n, total,
                           crc(ids))
        position = np.array([total - e for e in reversed(emitted)], "<u8")
        return b"".join([head, position.tobytes(), *[s.astype("<u8").tobytes() for s in reversed(states)],
                         *[w.astype("<u4").tobytes() for w in reversed(words)]])

    def decode(self, payload: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``stop`` of a block, decoded from the nearest checkpoint; a whole
        block is held against its checksum."""
        magic, version, bits, lanes, check_rows, checks, n, n_words, want = struct.unpack_from(HEADER, payload)
        if magic != MAGIC or version != VERSION or bits != self.scale_bits:
            raise ValueError("not a block of this format")
        stop = n if stop is None else min(stop, n)
        if first >= stop:
            return np.empty(0, np.uint32)
        at = struct.calcsize(HEADER)
        position = np.frombuffer(payload, "<u8", checks, at)
        states = np.frombuffer(payload, "<u8", checks * lanes, at + 8 * checks).reshape(checks, lanes)
        words = np.frombuffer(payload, "<u4", n_words, at + 8 * checks * (1 + lanes)).astype(np.uint64)
        c = first // lanes // check_rows
        x, pos = states[c].copy(), int(position[c])
        row0, row1 = c * check_rows, -(-stop // lanes)
        out = np.empty((row1 - row0) * lanes, np.uint32)
        low = np.uint64((1 << bits) - 1)
        for r in range(row0, row1):
            m = min(lanes, n - r * lanes)
            y = x[:m]
            slot = y & low
            s = self.symbol[slot]
            out[(r - row0) * lanes:(r - row0) * lanes + m] = s
            y = self.freq[s] * (y >> self.bits) + slot - self.start[s]
            need = np.flatnonzero(y < LOW)
            y[need] = y[need] << np.uint64(32) | words[pos:pos + len(need)]
            pos += len(need)
            x[:m] = y
        got = out[first - row0 * lanes:stop - row0 * lanes]
        if first == 0 and stop == n and crc(got) != want:
            raise ValueError("a block does not match its checksum")
        return got


def crc(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


# ------------------------------------------------------------------ tokenizer

# Fixed value: the split pattern under which a text may be cut into pieces before it is encoded.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Letters up to this code point are stable under NFC, and lower case by the simple mapping.
LATIN_END = "\u0240"
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_MARK = np.array([33 <= c < 127 and not chr(c).isalnum() and chr(c) != "'" for c in range(256)])


class Encoder:
    """Encodes whole texts with a ``tokenizers`` file.

    Where the file lower-cases, drops white space and splits by SPLIT, a text's
    ids are those of its pieces in turn, cut at ASCII white space and between a
    Latin letter and an ASCII mark other than the apostrophe: no pre-token, no
    contraction and no composed character spans such a place. Distinct pieces
    are encoded by the library once (lower-case Latin letters alone by its
    model, since nothing normalises or splits them). Rows that may hold added
    tokens, and all rows of other files, go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        steps = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_piece = (steps == ["NFC", "Replace", "Lowercase"] and spec["model"]["type"] == "BPE"
                         and pre[0].get("pattern") == {"Regex": SPLIT} and pre[0].get("invert")
                         and spec["model"].get("dropout") is None and spec["post_processor"] is None
                         and all(t["content"].startswith("<|") and not (t["normalized"] or t["lstrip"] or t["rstrip"])
                                 for t in spec["added_tokens"]))
        # the memo: pieces met so far, and the ids of piece k at flat[at[k]:at[k + 1]]
        self.pieces = pa.array([], pa.large_binary())
        self.flat, self.at = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.byte_chars = dict(enumerate(byte_symbols()))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, column: pa.Array, end_id: int) -> list[np.ndarray]:
        """Ids of every text, each followed by ``end_id``."""
        column = pc.fill_null(column, "")
        end = np.uint32(end_id)
        if not self.by_piece:
            return [np.append(i, end) for i in self._whole(column.to_pylist())]
        marked = np.flatnonzero(pc.match_substring(column, "<|").to_numpy(zero_copy_only=False))
        rest = column
        if len(marked):
            keep = np.ones(len(column), bool)
            keep[marked] = False
            rest = pc.if_else(pa.array(keep), column, "")
        out = [np.append(i, end) for i in self._pieces(rest)]
        for row, ids in zip(marked, self._whole([column[int(i)].as_py() for i in marked])):
            out[row] = np.append(ids, end)
        return out

    def _pieces(self, column: pa.Array) -> list[np.ndarray]:
        data, rows = utf8(column)
        data = LOWER[data]
        letter, mark = _LETTER[data], _MARK[data]
        # two-byte letters U+00C0 to U+023F, without the signs U+00D7 and U+00F7 and without
        # U+0130, whose lower case ends in a combining mark
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC8))
        code = data[lead].astype(np.int64) << 8 | data[lead + 1]
        lead = lead[(code != 0xC397) & (code != 0xC3B7) & (code != 0xC4B0)]
        letter[lead] = letter[lead + 1] = True
        cut = np.zeros(len(data), bool)
        cut[1:] = letter[1:] & mark[:-1] | mark[1:] & letter[:-1]
        words = Words(data, rows, SPACES, lower=False, cuts=cut)
        coded = words.array().dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy()]
        n = np.diff(self.at)[place]
        ids = self.flat[_spread(self.at[place], n)]
        bound = np.concatenate(([0], np.cumsum(n)))[words.first]
        return [ids[a:b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Where the memo holds each of these distinct pieces; new ones are encoded and added."""
        place = pc.fill_null(pc.index_in(distinct, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(new) and len(self.pieces) + len(new) > CACHE_PIECES:
            met = place >= 0
            size = np.diff(self.at)[place[met]]
            self.flat = self.flat[_spread(self.at[place[met]], size)]
            self.pieces = self.pieces.take(pa.array(place[met]))
            self.at = np.concatenate(([0], np.cumsum(size)))
            place[met] = np.arange(len(size))
        if len(new):
            place[new] = len(self.pieces) + np.arange(len(new))
            added = distinct.take(pa.array(new))
            lists = self._encode(added.to_pylist())
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(lists), np.uint32, size.sum())))
            self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(size)))
            self.pieces = pa.concat_arrays([self.pieces, added])
        return place

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        out, others = [], []
        for k, w in enumerate(pieces):
            if w.isascii():
                alone = w.isalpha()
            else:
                s = w.decode()
                alone = s.isalpha() and s == s.lower() and max(s) < LATIN_END
            if alone:
                out.append([t.id for t in self.tok.model.tokenize(w.decode("latin-1").translate(self.byte_chars))])
            else:
                out.append([])
                others.append(k)
        coded = self.tok.encode_batch_fast([pieces[k].decode() for k in others], add_special_tokens=False)
        for k, e in zip(others, coded):
            out[k] = e.ids
        return out


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[k] .. start[k] + size[k] - 1 of all k in turn."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file, so the memo lasts over tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _tokenise(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for b in sub_batches(whole, "_text", SLICE_BYTES, SLICE_ROWS):
                lists = enc(b.column("_text"), end_id)
                ids = np.concatenate(lists)
                width = 4 if int(ids.max()) >= 1 << 16 else 2
                off = width * np.concatenate(([0], np.cumsum([len(i) for i in lists], dtype=np.int64)))
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(lists), [None, pa.py_buffer(off), pa.py_buffer(ids.astype(f"<u{width}"))])
                yield pa.record_batch([b.column("_id"), b.column("_th"), pa.array([width] * len(lists), pa.int32()),
                                       packed.cast(pa.binary())], names=["_id", "_th", "_w", "_ids"])
    return run


def _ids(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    for blob, w in zip(b.column("_ids"), b.column("_w").to_pylist()):
        yield np.frombuffer(blob.as_buffer(), f"<u{w}")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for b in batches:
        for part in sub_batches(b, "_ids", SLICE_BYTES, SLICE_ROWS):
            c = np.bincount(np.concatenate(list(_ids(part))), minlength=len(total))
            c[:len(total)] += total
            total = c
    s = np.flatnonzero(total)
    yield pa.record_batch([pa.array(s), pa.array(total[s])], names=["symbol", "count"])


# ------------------------------------------------------------------ write and read

def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", block_tokens: int = BLOCK_TOKENS, part_tokens: int = PART_TOKENS,
                 shuffle_seed: int | None = None) -> str:
    """Write every whole text's ids, each document closed by ``end_id``, in ascending order of
    (id, text hash) or, with a ``shuffle_seed``, in the order of a number drawn for every
    row, which keeps copies of a document apart; returns ``path``.

    Null texts are empty (the end id alone), null ids come first, repeated rows are
    written as often as they occur, an empty table gives empty tables. Only token counts
    (one row per id of the vocabulary) reach the driver.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"),
                      F.col(text_col).alias("_text"))
    id_type = src.schema["_id"].dataType
    t = id_type.simpleString()
    coded = src.mapInArrow(_tokenise(tokenizer_path, end_id), f"_id {t}, _th long, _w int, _ids binary")
    order = ["_id", "_th"]
    if shuffle_seed is not None:  # drawn once: the numbers are stored with the ids
        coded, order = coded.withColumn("_draw", F.rand(shuffle_seed)), ["_draw", *order]
    coded = stored(coded, "token-ids")
    counts = (coded.select("_ids", "_w").mapInArrow(_count, "symbol long, count long")
              .groupBy("symbol").agg(F.sum("count").alias("count")).toArrow())
    symbols = counts["symbol"].to_numpy()
    total = np.zeros(int(symbols.max()) + 1 if len(symbols) else 0, np.int64)
    total[symbols] = counts["count"].to_numpy()
    freq = normalise(total)
    used = np.flatnonzero(freq)
    spark.createDataFrame(pa.table({"symbol": used, "freq": freq[used]}),
                          "symbol long, freq long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)
    parts = max(1, -(-int(total.sum()) // part_tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(shared.value), TaskContext.get().partitionId()
        names, held, size, block, done = [], [], 0, 0, 0
        arrow_id = None

        def flush():
            ids = np.concatenate(held).astype(np.uint32)
            doc_ids = pa.concat_arrays(names)
            lens = pa.array([len(h) for h in held], pa.int64())
            one = pa.array([0, len(held)], pa.int32())
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([done], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays(one, doc_ids),
                 pa.ListArray.from_arrays(one, lens), pa.array([coder.encode(ids)], pa.binary())],
                names=["part", "block", "start_in_part", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for b in batches:
            arrow_id = b.column("_id")
            for k, ids in enumerate(_ids(b)):
                names.append(arrow_id.slice(k, 1))
                held.append(ids)
                size += len(ids)
                if size >= block_tokens:
                    yield flush()
                    names, held, done, size, block = [], [], done + size, 0, block + 1
        if held:
            yield flush()

    blocks = (coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select("_id", "_w", "_ids")
              .mapInArrow(run, "part int, block int, start_in_part long, n_tokens long, "
                               f"doc_ids array<{t}>, doc_tokens array<long>, payload binary"))
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """The shared frequency table (at most one row per id of the vocabulary)."""
    t = spark.read.parquet(f"{path}/table").toArrow()
    freq = np.zeros(int(t["symbol"].to_numpy().max()) + 1 if len(t) else 0, np.int64)
    freq[t["symbol"].to_numpy()] = t["freq"].to_numpy()
    return freq


def read_documents(spark: SparkSession, path: str, *, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Decode the files: per document id, start (ids of all documents before it), n_tokens,
    ids_crc32 and, if asked, the ids themselves. Blocks decode independently."""
    blocks = spark.read.parquet(f"{path}/blocks")
    shared = spark.sparkContext.broadcast(read_table(spark, path))
    t = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    # one row per file part: running totals over parts, never over documents
    parts = (blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")))
    placed = join_sized(blocks, stored(parts, "token-parts"), ["part"], "inner").select(
        (F.col("base") + F.col("start_in_part")).alias("start"), "doc_ids", "doc_tokens", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            for k in range(b.num_rows):
                ids = coder.decode(b.column("payload")[k].as_py())
                size = b.column("doc_tokens")[k].values.to_numpy()
                ends = np.cumsum(size)
                each = [ids[e - n:e] for e, n in zip(ends, size)]
                cols = [b.column("doc_ids")[k].values, pa.array(b.column("start")[k].as_py() + ends - size),
                        pa.array(size), pa.array([crc(e) for e in each], pa.int64())]
                names = ["_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([e.astype(np.int64) for e in each], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.record_batch(cols, names=names)

    schema = f"_id {t}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return placed.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def token_output(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, path: str | None = None,
                 **options) -> DataFrame:
    """Write the files (to ``path``, or a new folder under the shared one) and return the
    documents as read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    id_col = options.get("id_col", "doc_id")
    return read_documents(spark, write_tokens(docs, path, tokenizer_path, end_id=end_id, **options), id_col=id_col)


__all__ = ["Coder", "Encoder", "normalise", "write_tokens", "read_documents", "read_table", "token_output"]
