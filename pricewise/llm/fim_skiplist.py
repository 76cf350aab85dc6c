"""Fill-in-middle transformation: cut ranks found in indexable skip lists.

Every text is cut twice, between units (a word with the white space before it,
or trailing white space), and its three pieces are put in a new order for the
documents that a seeded hash of their id selects. The texts of a slice get one
skip list each: lane k holds every 4**k-th boundary, and every node knows how
many units and how many code points lie before the next node of its lane.
Descending from the top lane by accumulated unit widths ends exactly on a cut
rank, and the accumulated code-point widths are the length of what lies before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import SPACES, per_row, sub_batches, utf8

# Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FAN = 4

_SPACE = np.zeros(256, bool)
_SPACE[np.frombuffer(SPACES, np.uint8)] = True


def unit_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """First bytes of all units: the start of every non-empty text, and white space right
    after a word. ``rows`` are the offsets of the texts in ``data``."""
    space = _SPACE[data]
    first = np.zeros(len(data), bool)
    first[1:] = space[1:] & ~space[:-1]
    first[rows[:-1][np.diff(rows) > 0]] = True
    return np.flatnonzero(first)


class SkipLists:
    """One indexable skip list per text. ``widths`` are the code points of all units, text
    after text, ``counts`` the units of each text. A text of n units has nodes of rank 0
    (its head) to n; a lane's node stores the distance to its right neighbour."""

    def __init__(self, widths: np.ndarray, counts: np.ndarray):
        n_nodes = counts + 1
        first = np.concatenate(([0], np.cumsum(n_nodes)))
        rank = np.arange(first[-1]) - np.repeat(first[:-1], n_nodes)
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        chars = np.zeros(first[-1], np.int64)
        chars[~last] = widths
        # per lane: units and code points to the right neighbour, no neighbour, node below, heads
        self.lanes = [((~last).astype(np.int64), chars, last, np.arange(first[-1]), first[:-1])]
        while len(self.lanes[-1][0]) > 2 * len(counts):
            units, chars, last, _, _ = self.lanes[-1]
            down = np.flatnonzero(rank % FAN ** len(self.lanes) == 0)
            rank = rank[down]
            head = np.flatnonzero(rank == 0)
            last = np.zeros(len(down), bool)
            last[np.append(head[1:], len(down)) - 1] = True
            self.lanes.append((np.add.reduceat(units, down), np.add.reduceat(chars, down), last, down, head))

    def descend(self, rank: np.ndarray) -> np.ndarray:
        """Code points before unit ``rank`` (0 to n) of every text."""
        node = self.lanes[-1][4]
        gone, chars = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for units, width, last, down, _ in reversed(self.lanes):
            while True:
                go = ~last[node] & (gone + units[node] <= rank)
                if not go.any():
                    break
                gone += np.where(go, units[node], 0)
                chars += np.where(go, width[node], 0)
                node = node + go
            node = down[node]
        if not np.array_equal(gone, rank):
            raise ValueError("rank beyond the units of a text")
        return chars


def count_units(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of every unit, units of every text, first byte of every code point)."""
    starts = unit_starts(data, rows)
    head = (data & 0xC0) != 0x80
    return (per_row(head, np.append(starts, len(data))), np.diff(np.searchsorted(starts, rows)), np.flatnonzero(head))


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of ``seed:id`` (a null id: ``seed:``): the first four
    8-digit groups of its hex sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   rate: int = 50, spm: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n (units), form (plain, psm or spm), prefix_chars,
    middle_chars (code points, null if plain) and output.

    ``rate`` percent of the documents are transformed, ``spm`` percent of those into
    suffix-prefix-middle order, by the id's hash alone: repeated ids are treated alike
    wherever they lie. Null and empty texts, and texts that hold a marker, stay plain (null
    becomes empty). Only the id and the text are read, so other columns may have any name.
    One map pass, whole texts, no shuffle.
    """
    h = draws(F.col(f"`{id_col}`"), seed)
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                      *[h[i].alias(f"_h{i}") for i in range(4)])
    t = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "_text"):
                yield _transform(b, rate, spm)

    out = src.mapInArrow(run, f"_id {t}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("_id", id_col)


def _transform(b: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    data, rows = utf8(b.column("_text"))
    widths, n, points = count_units(data, rows)
    lists = SkipLists(widths, n)
    h = [b.column(f"_h{i}").to_numpy(zero_copy_only=False) for i in range(4)]
    cuts = np.sort([h[0] % (n + 1), h[1] % (n + 1)], axis=0)
    chars = [lists.descend(cut) for cut in cuts]
    # code points before a cut -> its byte
    points = np.append(points, len(data))
    first = np.searchsorted(points, rows[:-1])
    at = [points[first + c] for c in chars]
    raw = data.tobytes()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    form, output = [], []
    for i in range(b.num_rows):
        lo, hi, x, y = rows[i], rows[i + 1], at[0][i], at[1][i]
        if h[2][i] % 100 >= rate or lo == hi or any(raw.find(m, lo, hi) >= 0 for m in marks):
            form.append("plain")
            output.append(raw[lo:hi])
            continue
        prefix, middle, suffix = marks[0] + raw[lo:x], marks[2] + raw[x:y], marks[1] + raw[y:hi]
        form.append("spm" if h[3][i] % 100 < spm else "psm")
        output.append((suffix + prefix if form[-1] == "spm" else prefix + suffix) + middle)
    plain = np.array([f == "plain" for f in form], bool)
    return pa.record_batch(
        [b.column("_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(chars[0], mask=plain),
         pa.array(chars[1] - chars[0], mask=plain), pa.array(output, pa.binary()).cast(pa.string())],
        names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(form: Column, output: Column) -> Column:
    """The text an output was made from, by its form and markers alone."""
    p = F.split(output, "<[PSM]>", 4)
    return (F.when(form == "psm", F.concat(p[1], p[3], p[2]))
            .when(form == "spm", F.concat(p[2], p[3], p[1])).otherwise(output))


def digests(docs: DataFrame, **params) -> DataFrame:
    """``fill_in_middle`` with the sha256 of each output and of the text rebuilt from it."""
    out = fill_in_middle(docs, **params)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return (out.withColumn("output_sha256", sha(F.col("output")))
            .withColumn("restored_sha256", sha(restored(F.col("form"), F.col("output")))).drop("output"))


def fim_sql(seed: int = 42, rate: int = 50, spm: int = 80) -> str:
    """DuckDB form of ``digests`` over ``documents``."""
    space = r"[\x20\x09-\x0D]"
    group = lambda i: f"('0x' || substr(d, {8 * i + 1}, 8))::bigint"
    return rf"""
with cut as (
  select doc_id, coalesce(text, '') as t, sha256('{seed}:' || coalesce(doc_id::varchar, '')) as d,
         regexp_extract_all(coalesce(text, ''), '{space}*[^\x20\x09-\x0D]+|{space}+') as u
  from documents),
ranks as (
  select doc_id, t, u, len(u) as n, {group(0)} % (len(u) + 1) as a, {group(1)} % (len(u) + 1) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                   or {group(2)} % 100 >= {rate} then 'plain'
              when {group(3)} % 100 < {spm} then 'spm' else 'psm' end as form
  from cut),
pieces as (
  select doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') as p,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
         array_to_string(u[greatest(a, b) + 1:n], '') as s
  from ranks)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from pieces"""
