"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring with ``VNODES`` points; a document's hash falls
into the arc that ends at the next point clockwise. A shard takes the
documents of its own arcs (arc after arc in ring order, within an arc by a
second hash) until its capacity is reached; what is left over continues clockwise to the next point whose shard has room.
Capacities differ by at most one document and add up to the corpus, so the
balance is exact; a further shard only shifts the overflow and the arcs it cuts.

Documents never meet in one task: they are counted by fine ring cells (a few
tens of thousands of rows each, sized from the row count), only the counts per
arc are filled into shards, and a document's place follows from its rank
in its cell. DataFrame functions throughout; the fill is a loop over the
ring's points (``shards * VNODES`` counts).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricewise.llm.common import join_sized, stored

VNODES = 64
CELL_ROWS = 50_000


def ring_points(shards: int, vnodes: int, spark) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order; position is xxhash64 of (shard, node)."""
    rows = (spark.range(shards).select(F.col("id").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("v"))
            .select(F.xxhash64(F.lit("ring"), F.col("s").cast("string"), F.col("v").cast("string")).alias("p"), "s").collect())
    return sorted((r["p"], r["s"]) for r in rows)


def fill(own: list[int], owner: list[int], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """Bounded-load fill: (arc, first rank, end rank, shard) segments that cover all documents.

    ``own`` counts the documents of each arc, ``owner`` names the shard at its end.
    First each shard takes from its own arcs in ring order, then the overflow
    moves clockwise, first come first served; two turns always place all.
    """
    room, out, rest = list(capacity), [], []
    for arc, n in enumerate(own):
        take = min(n, room[owner[arc]])
        room[owner[arc]] -= take
        if take:
            out.append((arc, 0, take, owner[arc]))
        rest.append((take, n))
    moving: list[list[int]] = []  # [arc, first, end], oldest first
    for step in range(2 * len(own)):
        arc = step % len(own)
        s = owner[arc]
        while moving and room[s]:
            seg = moving[0]
            take = min(seg[2] - seg[1], room[s])
            out.append((seg[0], seg[1], seg[1] + take, s))
            seg[1] += take
            room[s] -= take
            if seg[1] == seg[2]:
                moving.pop(0)
        if step < len(own) and rest[arc][0] < rest[arc][1]:
            moving.append([arc, *rest[arc]])
    return out


def _arc_of(position: Column, points: list[tuple[int, int]]) -> Column:
    """Index of the first ring point at or after the position (past the last: the first point)."""
    ends = F.from_json(F.lit(json.dumps([p for p, _ in points])), "array<bigint>")
    # binary search over the sorted points
    steps = len(points).bit_length()
    lo = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("lo"), F.lit(len(points)).alias("hi")),
        lambda a, _: F.when(a["lo"] >= a["hi"], a).when(
            F.element_at(ends, F.shiftright(a["lo"] + a["hi"], 1) + 1) < position,
            F.struct((F.shiftright(a["lo"] + a["hi"], 1) + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(
            F.struct(a["lo"].alias("lo"), F.shiftright(a["lo"] + a["hi"], 1).alias("hi"))),
        lambda a: a["lo"])
    return F.when(lo == len(points), F.lit(0)).otherwise(lo)


def shard_documents(docs: DataFrame, *, shards: int = 24, vnodes: int = VNODES, id_col: str = "doc_id",
                    text_col: str = "text", cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, size (UTF-8 bytes of the text + 8), text_crc32, law, shard, slot.

    The law is ``rows``: shards hold counts at most one apart (the first ``n mod
    shards`` of them one more), slots run without gaps from 0 in every shard, in
    ring order from the arcs' segments. The ring position hashes the id and the text, so
    copies of one id spread; identical rows are interchangeable. Null texts have
    size 8 and the checksum of no bytes; null ids are hashed like any other value;
    with fewer rows than shards some shards are empty; an empty table gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    points = ring_points(shards, vnodes, spark)
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = stored(docs.select(F.col(id_col).alias("_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                              F.crc32(raw).alias("text_crc32"),
                              F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("_p")), "ring-rows")
    n = rows.count()
    cells = max(1, -(-n // (cell_rows * shards * vnodes))) if n else 1
    # a cell is a slice of an arc by a second hash of the position, ordered by that hash
    rows = rows.withColumn("_arc", _arc_of(F.col("_p"), points)).withColumn(
        "_q", F.xxhash64(F.lit("order"), "_p")).withColumn("_cell", F.pmod(F.shiftrightunsigned("_q", 1), F.lit(cells)).cast("int"))
    rows = rows.drop("_p")
    counted = stored(rows.groupBy("_arc", "_cell").agg(F.count("*").alias("_n")), "ring-cells")
    per_arc = {r["_arc"]: r["n"] for r in counted.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    owner = [s for _, s in points]
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    segments, used = [], [0] * shards
    for arc, first, end, shard in fill([per_arc.get(a, 0) for a in range(len(points))], owner, capacity):
        segments.append({"_arc": arc, "a": first, "b": end, "shard": shard, "base": used[shard] - first})
        used[shard] += end - first
    # at most two segments per ring point and shard: a proven bound
    table = spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(segments)), "array<struct<_arc:int,a:bigint,b:bigint,shard:int,base:bigint>>")).alias("g")).select("g.*")
    by_arc = table.groupBy("_arc").agg(F.array_sort(F.collect_list(F.struct("a", "b", "shard", "base"))).alias("_segs"))
    before = Window.partitionBy("_arc").orderBy("_cell")
    bases = stored(counted.withColumn("_base", F.sum("_n").over(before) - F.col("_n")).join(F.broadcast(by_arc), "_arc")
                   .select("_arc", "_cell", "_base", "_segs"), "ring-bases")
    in_cell = Window.partitionBy("_arc", "_cell").orderBy("_q", "_id", "text_crc32", "size")
    ranked = rows.withColumn("_k", F.row_number().over(in_cell) - 1)
    placed = join_sized(ranked, bases, ["_arc", "_cell"], "inner", row_bytes=256)
    rank = F.col("_base") + F.col("_k")
    seg = F.element_at(F.filter("_segs", lambda g: (g["a"] <= rank) & (rank < g["b"])), 1)
    return placed.withColumn("_s", seg).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), F.col("_s.shard").alias("shard"),
        (F.col("_s.base") + rank).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
