"""Merkle dataset manifest: persistent path-copying trees over aligned blocks.

Rows are leaves, ordered by id inside their source; every ``FAN`` consecutive
nodes have one parent. A tree is cut into aligned blocks of ``FAN ** HEIGHT``
leaves, so a block is a whole subtree and no task ever holds more than one
block. The block roots are the leaves of the next stage, and so on up to one
root per source; the sources' roots form one more tree. Inside a block a
``PathTree`` keeps the nodes; a tampered leaf makes a new version that copies
its ancestors alone and shares every other node. A version goes on above its
block by copying the block root's ancestors, found in the stages above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.llm.common import join_sized, stored

FAN = 3
# Levels of a block: at most FAN ** HEIGHT = 2,187 leaves in one task's tree.
HEIGHT = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def node_digest(children: Sequence[bytes]) -> bytes:
    """sha256 of the children's digests, written in hex one after the other."""
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


class PathTree:
    """The nodes of one block, level by level; levels are never changed. ``height`` fixes the
    number of levels above the leaves, None stops at a single node."""

    def __init__(self, leaves: Sequence[bytes], height: int | None = None):
        self.levels = [list(leaves)]
        while (len(self.levels[-1]) > 1) if height is None else (len(self.levels) <= height):
            below = self.levels[-1]
            self.levels.append([node_digest(below[i:i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, i: int) -> list[tuple[list[bytes], list[bytes]]]:
        """Per level the nodes left and right of leaf ``i``'s path in its run."""
        out = []
        for level in self.levels[:-1]:
            start = i - i % FAN
            out.append((level[start:i], level[i + 1:start + FAN]))
            i //= FAN
        return out

    def version(self, i: int, leaf: bytes) -> list[bytes]:
        """Copied nodes of the version whose leaf ``i`` is ``leaf``, from the leaf to the root.
        Every other node is shared with this tree."""
        copies = [leaf]
        for left, right in self.siblings(i):
            copies.append(node_digest([*left, copies[-1], *right]))
        return copies


# ------------------------------------------------------------------ leaves and places

def _part(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """sha256 (binary) of the columns: each ``-`` if null, else byte count, ``:``, value."""
    return F.unhex(F.sha2(F.concat(*[_part(c) for c in columns]).cast("binary"), 256))


def tampered(id_col: Column) -> Column:
    """Rows whose text loses its line ends: 2 divides the crc32 of the id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def places(df: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``_i``, its gapless place from 0 in its tree by ``order``, and ``_size``, the
    tree's rows. Range-partitioned by tree and order, so one tree may spread over all tasks;
    rows alike in every one of these columns fall into one of them."""
    rows = stored(df.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                  .withColumn("_m", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_m", 33)).withColumn("_at", F.col("_m").bitwiseAND((1 << 33) - 1))
    # one row per tree and range part
    n = rows.groupBy(tree, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    w = Window.partitionBy(tree)
    n = n.select(tree, "_part", "_from", F.sum("_n").over(w).alias("_size"),
                 (F.sum("_n").over(w.orderBy("_part")) - F.col("_n")).alias("_before"))
    n = stored(n, f"{name}-parts")
    return (join_sized(rows, n, [tree, "_part"], "inner")
            .withColumn("_i", F.col("_before") + F.col("_at") - F.col("_from"))
            .drop("_m", "_part", "_at", "_from", "_before"))


# ------------------------------------------------------------------ blocks

_PATH = "array<struct<left:array<binary>,right:array<binary>>>"


def blocks(items: DataFrame, tree: str, height: int, extra: Sequence[str] = ()) -> DataFrame:
    """One stage: items (tree, _i, _size, _digest) grouped into blocks of FAN ** height.

    Returns tree, _block, _i, _digest, _path (siblings per level inside the block), _root (of
    the block) and the ``extra`` columns. If ``extra`` holds ``_new`` (a tampered digest or
    null), ``_copies`` are the nodes its version copies. A block is rebuilt from one sorted
    run of rows; batches are cut at blocks, so a task holds one batch and one block.
    """
    width = FAN ** height
    versions = "_new" in extra
    src = (items.withColumn("_block", F.floor(F.col("_i") / width).cast("long"))
           .select(tree, "_block", "_i", "_size", "_digest", *extra)
           .repartition(tree, "_block").sortWithinPartitions(tree, "_block", "_i"))
    keep = [tree, "_block", "_i", "_digest", *[c for c in extra if c != "_new"]]
    types = [(f.name, f.dataType.simpleString()) for f in src.select(*keep).schema]
    schema = ", ".join(f"`{n}` {t}" for n, t in types) + f", _root binary, _path {_PATH}"
    schema += ", _copies array<binary>" if versions else ""

    def one(t: pa.Table) -> pa.Table:
        cols = t.select(["_digest", "_size", *(["_new"] if versions else [])]).to_pydict()
        whole = cols["_size"][0] <= width
        tree_ = PathTree(cols["_digest"], None if whole else height)
        out = t.select(keep)
        out = out.append_column("_root", pa.array([tree_.root] * len(out), pa.binary()))
        paths = [[{"left": a, "right": b} for a, b in tree_.siblings(i)] for i in range(len(out))]
        node = pa.struct([("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary()))])
        out = out.append_column("_path", pa.array(paths, pa.list_(node)))
        if versions:
            copies = [None if d is None else tree_.version(i, d) for i, d in enumerate(cols["_new"])]
            out = out.append_column("_copies", pa.array(copies, pa.list_(pa.binary())))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            for block, done in _runs(held, tree):
                if done:
                    yield from one(block).combine_chunks().to_batches()
                else:
                    held = block
        if held is not None and len(held):
            yield from one(held).combine_chunks().to_batches()

    return src.mapInArrow(run, schema)


def _runs(t: pa.Table, tree: str) -> Iterator[tuple[pa.Table, bool]]:
    """Consecutive rows of one block each; the last may go on in the next batch (False)."""
    keys = list(zip(t.column(tree).to_pylist(), t.column("_block").to_pylist()))
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield t.slice(start, i - start), i < len(keys)
            start = i


def climb(items: DataFrame, tree: str, height: int, name: str) -> DataFrame:
    """(tree, _i, _up, _top): for every item (tree, _i, _size, _digest) the siblings on its way
    to its tree's root and that root. Stage after stage, until every tree is one node."""
    stages = []
    items = stored(items, f"{name}-items")
    while True:
        # the widest tree decides how many stages there are: one number
        widest = items.agg(F.max("_size")).first()[0]
        stage = stored(blocks(items, tree, height), f"{name}-{len(stages)}")
        stages.append(stage)
        if widest is None or widest <= FAN ** height:
            break
        items = stored(stage.groupBy(tree, F.col("_block").alias("_i")).agg(F.first("_root").alias("_digest"))
                       .join(items.groupBy(tree).agg(F.max("_size").alias("_s")), tree)
                       .select(tree, "_i", F.ceil(F.col("_s") / FAN ** height).cast("long").alias("_size"), "_digest"),
                       f"{name}-items")
    up = stages.pop().select(tree, "_i", F.col("_path").alias("_up"), F.col("_root").alias("_top"))
    for stage in reversed(stages):
        above = up.select(tree, F.col("_i").alias("_block"), F.col("_up").alias("_more"), "_top")
        up = (stage.join(above, [tree, "_block"])
              .select(tree, "_i", F.concat("_path", "_more").alias("_up"), "_top"))
    return stored(up, f"{name}-paths")


# ------------------------------------------------------------------ manifest

def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def _text_of(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, _hex), "")


def manifest(docs: DataFrame, *, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", tree_col: str = "source",
             text_col: str = "text", height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot (of its source), root, proof (array: the
    siblings from leaf to root), copied (array: the nodes its tampered version copies, leaf
    first, root last; for an untampered row its own path) and tampered.

    A leaf is the digest of ``columns`` in their order, ``-`` for null. Inside a source leaves
    ascend by id (null first), rows of one id by leaf; repeated rows are leaves of their own.
    A null source is a source, and the first one. Tampering deletes the line ends of the text;
    a null text stays null. An empty table has no rows and no root. Other columns are not read.
    """
    col = lambda c: F.col(f"`{c}`")
    text = F.translate(col(text_col), "\n", "")
    src = docs.select(
        F.coalesce(F.concat(F.lit("1"), col(tree_col).cast("string")), F.lit("0")).alias("_tree"),
        col(id_col).alias("_id"), leaf_digest([col(c) for c in columns]).alias("_digest"),
        F.when(tampered(col(id_col)), leaf_digest([text if c == text_col else col(c) for c in columns])).alias("_other"))
    # every row has a version; an untampered one copies nodes equal to the old ones
    src = src.select("_tree", "_id", "_digest", F.coalesce("_other", "_digest").alias("_new"),
                     F.col("_other").isNotNull().alias("_tampered"))
    # the texts are read and hashed once; ranges are sampled from the digests
    src = stored(src, "digests")
    leaves = places(src, "_tree", ["_id", "_digest"], "leaves")
    low = stored(blocks(leaves, "_tree", height, extra=["_id", "_new", "_tampered"]).drop("_i"), "blocks")

    # block roots up to their source's root, the sources' roots up to the manifest's
    sizes = low.groupBy("_tree").agg((F.max("_block") + 1).alias("_size"))
    tops = (low.groupBy("_tree", F.col("_block").alias("_i")).agg(F.first("_root").alias("_digest"))
            .join(sizes, "_tree").select("_tree", "_i", "_size", "_digest"))
    inner = climb(tops, "_tree", height, "sources")
    subroots = inner.where("_i = 0").select(F.lit("").alias("_all"), "_tree", F.col("_top").alias("_digest"))
    ranked = stored(places(subroots, "_all", ["_tree"], "subroots"), "subroots-placed")
    outer = climb(ranked.select("_all", "_i", "_size", "_digest"), "_all", height, "root")
    outer = (ranked.select("_tree", "_i").join(outer, "_i")
             .select("_tree", F.col("_up").alias("_last"), F.col("_top").alias("_rootnode")))
    above = stored(inner.join(outer, "_tree").select(
        "_tree", F.col("_i").alias("_block"), F.col("_top").alias("_subroot"), "_rootnode",
        F.concat("_up", "_last").alias("_above")), "above")

    node = lambda s, h: F.unhex(F.sha2(F.concat(_text_of(s["left"]), _hex(h), _text_of(s["right"])).cast("binary"), 256))
    copied = F.aggregate("_above", F.col("_copies"),
                         lambda acc, s: F.concat(acc, F.array(node(s, F.element_at(acc, -1)))))
    path = F.flatten(F.transform(F.concat("_path", "_above"), lambda s: F.concat(s["left"], s["right"])))
    # 3 KB a block: the paths of a block's root at most
    out = join_sized(low, above, ["_tree", "_block"], "inner", row_bytes=3072)
    return out.select(F.col("_id").alias(id_col), _hex(F.col("_digest")).alias("leaf"),
                      _hex(F.col("_subroot")).alias("subroot"), _hex(F.col("_rootnode")).alias("root"),
                      F.transform(path, _hex).alias("proof"), F.transform(copied, _hex).alias("copied"),
                      F.col("_tampered").alias("tampered"))


def audit(docs: DataFrame, **params) -> DataFrame:
    """``manifest`` as digests: proof_sha256 of all siblings, folded_root (the root of the
    tampered version) and verified (it equals the root)."""
    m = manifest(docs, **params)
    return m.select(params.get("id_col", "doc_id"), "leaf", "subroot", "root",
                    F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256"),
                    F.element_at("copied", -1).alias("folded_root"),
                    (F.element_at("copied", -1) == F.col("root")).alias("verified"))


def audit_sql() -> str:
    """DuckDB form of ``audit`` over ``documents``: both trees level by level, siblings looked
    up per level, every version folded along them."""
    part = lambda c: f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in COLUMNS[:-1]) + f" || {part(text)})"
    crc = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::varchar, ''),
        lambda d: [ascii(d)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end), 4294967295)"""

    def levels(name: str, leaves: str) -> str:
        return f"""{name} as (
  select 0 as lvl, tree, i, n, h from {leaves}
  union all
  select lvl + 1, tree, i // {FAN}, any_value((n + {FAN - 1}) // {FAN}), sha256(string_agg(h, '' order by i))
  from {name} where n > 1 group by lvl, tree, i // {FAN})"""

    def siblings(name: str, levels: str, leaves: str) -> str:
        return f"""{name} as (
  select a.tree, a.i, b.lvl, coalesce(string_agg(b.h, '' order by b.i) filter (b.i < a.i // ({FAN}**b.lvl)::bigint), '') as l,
         coalesce(string_agg(b.h, '' order by b.i) filter (b.i > a.i // ({FAN}**b.lvl)::bigint), '') as r
  from {leaves} a join {levels} b on a.tree = b.tree and b.n > 1
       and b.i // {FAN} = (a.i // ({FAN}**b.lvl)::bigint) // {FAN}
  group by all)"""

    body = f"""with recursive
hashed as (
  select doc_id, coalesce('1' || source, '0') as tree, {leaf('text')} as h,
         case when {crc} % 2 = 0 then {leaf("replace(text, chr(10), '')")} end as other
  from documents),
leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as i, count(*) over (partition by tree) as n
  from hashed),
{levels('inner_nodes', 'leaves')},
subroots as (select tree, h from inner_nodes where n = 1),
sources as (
  select '' as tree, tree as source, h, row_number() over (order by tree) - 1 as i, count(*) over () as n from subroots),
{levels('outer_nodes', 'sources')},
{siblings('inner_path', 'inner_nodes', 'leaves')},
{siblings('outer_path', 'outer_nodes', 'sources')},
steps as (
  select tree, i, row_number() over (partition by tree, i order by part, lvl) as step, l, r from (
    select tree, i, 0 as part, lvl, l, r from inner_path
    union all
    select a.tree, a.i, 1, p.lvl, p.l, p.r from leaves a join sources s on a.tree = s.source join outer_path p on p.i = s.i)),
fold as (
  select tree, i, 0::bigint as step, coalesce(other, h) as h from leaves
  union all
  select f.tree, f.i, s.step, sha256(s.l || f.h || s.r) from fold f join steps s
  on s.tree = f.tree and s.i = f.i and s.step = f.step + 1),
ends as (select tree, i, arg_max(h, step) as folded_root from fold group by all),
proofs as (select tree, i, sha256(string_agg(l || r, '' order by step)) as proof_sha256 from steps group by all)
select doc_id, a.h as leaf, s.h as subroot, o.h as root, coalesce(p.proof_sha256, sha256('')) as proof_sha256,
       folded_root, folded_root = o.h as verified
from leaves a join subroots s using (tree) join ends e using (tree, i) left join proofs p using (tree, i)
     cross join (select h from outer_nodes where n = 1) o"""
    return body
