"""Exact quantiles that never gather a large group's values in one task.

Small groups go through ``percentile`` (a value -> count map per group, combined
map-side): one shuffle. Its map holds a group's distinct values, so groups above
``LIGHT_ROWS`` rows are selected by narrowing brackets instead:

1. one pass per round counts rows in ``BINS`` bins between a bracket's ends, map-side,
   so a task sends at most one row per group and bin, whatever the group's size;
   the bins that hold the wanted ranks become the next bracket. The first round
   cuts the whole range on a logarithmic scale, later ones evenly; both are
   monotone, infinities have bins of their own, and a bracket's ends are values
   that occur, so a round always narrows it or ends at a single value;
2. once every bracket holds at most ``BRACKET_ROWS`` rows, or one value, one more
   pass filters the rows to their brackets before grouping by value: only those
   are shuffled. The values at ranks floor((n-1)q) and ceil((n-1)q) are then
   interpolated as ``percentile`` does.

Rows may carry a count (``weight_col``), so tables of value counts give the
quantiles of the rows they stand for. Both ways give the same rows: one per
non-null key tuple, null where the group has no values (nulls and NaN are no values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.operators.stats import join_small
from pricewise.session import stored

# Rows up to which a group goes through ``percentile`` in one task.
LIGHT_ROWS = 50_000
# Rows a bracket may hold when its values are ranked.
BRACKET_ROWS = 1_000_000
# Bins a bracket is cut into per round; fewer where many groups are large.
BINS, FEW_BINS, MANY_GROUPS = 4_096, 256, 64
# Inputs of at most this many estimated bytes hold no large group worth a look.
SMALL_BYTES = 16 << 20
_V = "__pw_v"
_W = "__pw_w"
_G = "__pw_g"


def _values(value_col: str) -> Column:
    v = F.col(value_col).cast("double")
    return F.when(~F.isnan(v), v)


def _interpolate(lo: Column, hi: Column, frac: Column) -> Column:
    return F.when((lo == hi) | (frac == 0), lo).otherwise((1 - frac) * lo + frac * hi)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a frame (no job); None where the session has none."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # a remote session has no plan at hand
        return None


def _scale(v: Column, first: bool) -> Column:
    return F.signum(v) * F.log1p(F.abs(v)) if first else v


def _bin(v: Column, lo: Column, hi: Column, bins: int, first: bool) -> Column:
    """Bin of ``v`` in [lo, hi], monotone; infinities lie in bins -1 and ``bins``."""
    a, b, x = (_scale(c, first) / 2 for c in (lo, hi, v))
    inner = F.when(b > a, F.least(F.floor((x - a) / (b - a) * bins), F.lit(bins - 1))).otherwise(0)
    inf = float("inf")
    return F.when(v == -inf, -1).when(v == inf, bins).otherwise(inner).cast("int")


def _in_bin() -> list[Column]:
    finite = F.when(F.abs(_V) < float("inf"), F.col(_V))
    return [F.sum(_W).alias("__w"), F.count(F.lit(1)).alias("__r"), F.min(_V).alias("__lo"), F.max(_V).alias("__hi"),
            F.min(finite).alias("__flo"), F.max(finite).alias("__fhi")]


def _narrow(rows: DataFrame, brackets: DataFrame, grp: Sequence[str], bins: int) -> DataFrame:
    """One round. ``brackets``: grp, __i (quantile), __pos (its rank), __lo, __hi, __below (rows
    under the bracket), __rows, and __flo, __fhi, its least and largest finite value, which the
    bins are cut between; returns the same with narrower ends."""
    near = (join_small(rows, brackets.drop("__rows"), on=list(grp), how="inner")
            .where(F.col(_V).between(F.col("__lo"), F.col("__hi")))
            .withColumn("__bin", _bin(F.col(_V), F.col("__flo"), F.col("__fhi"), bins, False)))
    hist = (near.groupBy(*grp, "__i", "__bin")
            .agg(*_in_bin(), F.first("__pos").alias("__pos"), F.first("__below").alias("__base")))
    run = F.sum("__w").over(Window.partitionBy(*grp, "__i").orderBy("__bin"))
    return _hit(hist.withColumn("__from", F.col("__base") + run - F.col("__w")), grp)


def _hit(hist: DataFrame, grp: Sequence[str]) -> DataFrame:
    """Brackets: the bins (at most ``BINS`` + 2 a group and quantile) with the wanted ranks."""
    wanted = (F.col("__from") <= F.ceil("__pos")) & (F.col("__from") + F.col("__w") > F.floor("__pos"))
    return hist.where(wanted).groupBy(*grp, "__i").agg(
        F.first("__pos").alias("__pos"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
        F.min("__flo").alias("__flo"), F.max("__fhi").alias("__fhi"),
        F.min("__from").alias("__below"), F.sum("__r").alias("__rows"))


def _select(rows: DataFrame, large: DataFrame, grp: Sequence[str], qs: Sequence[float], out_cols: Sequence[str]) -> DataFrame:
    """Quantiles of the groups in ``large`` (grp, __n, __lo, __hi, __flo, __fhi)."""
    positions = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(q).alias("q")) for i, q in enumerate(qs)])
    rows = rows.where(F.col(_V).isNotNull())
    # the first round's bins are the same for all quantiles: counted once
    bins = BINS if large.count() <= MANY_GROUPS else FEW_BINS
    near = (join_small(rows, large, on=list(grp), how="inner")
            .withColumn("__bin", _bin(F.col(_V), F.col("__flo"), F.col("__fhi"), bins, True)))
    hist = near.groupBy(*grp, "__bin").agg(*_in_bin())
    run = F.sum("__w").over(Window.partitionBy(*grp).orderBy("__bin"))
    hist = (hist.withColumn("__from", run - F.col("__w"))
            .join(large.select(*grp, F.explode(positions).alias("__p"), "__n"), list(grp))
            .withColumn("__pos", (F.col("__n") - 1) * F.col("__p.q")).withColumn("__i", F.col("__p.i")))
    brackets = _hit(hist, grp)
    while True:
        brackets = stored(brackets, "brackets")
        wide = brackets.where((F.col("__rows") > BRACKET_ROWS) & (F.col("__lo") < F.col("__hi")))
        if wide.isEmpty():
            break
        brackets = _narrow(rows, wide, grp, bins).unionByName(
            brackets.join(wide.select(*grp, "__i"), [*grp, "__i"], "left_anti"))
    near = (join_small(rows, brackets, on=list(grp), how="inner").where(F.col(_V).between(F.col("__lo"), F.col("__hi")))
            .groupBy(*grp, "__i", _V).agg(F.sum(_W).alias("__w"), F.first("__pos").alias("__pos"),
                                          F.first("__below").alias("__below")))
    running = Window.partitionBy(*grp, "__i").orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("__last", F.col("__below") + F.sum("__w").over(running))
    first = F.col("__last") - F.col("__w")

    def value_at(rank: Column, i: int) -> Column:
        return F.max(F.when((F.col("__i") == i) & (first <= rank) & (rank < F.col("__last")), F.col(_V)))

    got = near.groupBy(*grp).agg(*[x for i in range(len(qs)) for x in (
        value_at(F.floor("__pos"), i).alias(f"__lo{i}"), value_at(F.ceil("__pos"), i).alias(f"__hi{i}"),
        F.max(F.when(F.col("__i") == i, F.col("__pos"))).alias(f"__p{i}"))])
    checked = [F.when(F.col(f"__lo{i}").isNull() | F.col(f"__hi{i}").isNull(),
                      F.raise_error("a quantile fell outside its bracket").cast("double"))
                .otherwise(_interpolate(F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__p{i}") - F.floor(f"__p{i}")))
               .alias(name) for i, name in enumerate(out_cols)]
    return got.select(*grp, *checked)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value_col: str, qs: Sequence[float],
                    out_cols: Sequence[str], light_rows: int | None = None, weight_col: str | None = None) -> DataFrame:
    """One row per non-null key tuple (one row in all without keys): the exact
    linear-interpolated quantiles (same definition as ``percentile`` and DuckDB's
    ``quantile_cont``), null for a group without values. ``weight_col`` (positive whole
    numbers) says how many rows each row stands for.

    Without ``light_rows`` an input whose estimated size is at most ``SMALL_BYTES`` is
    planned without running a job; otherwise one pass over keys and values finds the large groups.
    """
    keys, qs = list(keys), [float(q) for q in qs]
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    weight = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    rows = df.where(present).select(*(keys or [F.lit(0).alias(_G)]), _values(value_col).alias(_V), weight.alias(_W))
    grp = keys or [_G]
    arrays = F.percentile(_V, F.array(*map(F.lit, qs)), *([F.col(_W)] if weight_col else []))
    plain = [F.col("__a")[i].alias(n) for i, n in enumerate(out_cols)]

    def by_percentile(some: DataFrame) -> DataFrame:
        if not keys:
            return some.agg(arrays.alias("__a")).select(*plain)
        return some.groupBy(*grp).agg(arrays.alias("__a")).select(*grp, *plain)

    if light_rows is None:
        size = estimated_bytes(rows)
        if size is not None and size <= SMALL_BYTES:
            return by_percentile(rows)
        light_rows = LIGHT_ROWS
    # one map-side combined pass: at most rows / light_rows groups are large
    finite = F.when(F.abs(_V) < float("inf"), F.col(_V))
    large = stored(rows.groupBy(*grp).agg(F.sum(F.when(F.col(_V).isNotNull(), F.col(_W))).alias("__n"), F.count(_V).alias("__c"),
                                          F.min(_V).alias("__lo"), F.max(_V).alias("__hi"),
                                          F.coalesce(F.min(finite), F.lit(0.0)).alias("__flo"),
                                          F.coalesce(F.max(finite), F.lit(0.0)).alias("__fhi"))
                   .where(F.col("__c") > light_rows).drop("__c"), "large-groups")
    if large.isEmpty():
        return by_percentile(rows)
    if not keys:
        return _select(rows, large, grp, qs, out_cols).drop(_G)
    marked = join_small(rows, large.select(*grp, F.lit(True).alias("__large")), on=grp, how="left")
    light = by_percentile(marked.where("__large is null"))
    return light.unionByName(_select(rows, large, grp, qs, out_cols))


def exact_median(df: DataFrame, keys: Sequence[str], value_col: str, out_col: str, weight_col: str | None = None) -> DataFrame:
    return exact_quantiles(df, keys, value_col, [0.5], [out_col], weight_col=weight_col)


def medians_at(counts: DataFrame, grains: dict[str, Sequence[str]], value_col: str, weight_col: str) -> dict[str, DataFrame]:
    """Medians at several grains from one table of value counts: name -> (keys, median).

    Every row is expanded to one row per grain, as GROUPING SETS does, and all
    grains are grouped in one pass; the medians are written once and read per grain.
    """
    names = [c for g in grains.values() for c in g]
    cols = list(dict.fromkeys(names))
    kinds = dict(counts.dtypes)
    at = F.array(*[F.struct(F.lit(i).alias("g"), *[(F.col(c) if c in g else F.lit(None).cast(kinds[c])).alias(f"k{j}")
                                                   for j, c in enumerate(cols)])
                   for i, g in enumerate(grains.values())])
    rows = counts.select(F.explode(at).alias("__grain"), value_col, weight_col)
    for i, g in enumerate(grains.values()):
        known = F.lit(True)
        for c in g:
            known = known & F.col(f"__grain.k{cols.index(c)}").isNotNull()
        rows = rows.where((F.col("__grain.g") != i) | known)
    got = stored(exact_median(rows, ["__grain"], value_col, "median", weight_col), "medians")
    return {name: got.where(F.col("__grain.g") == i).select(*[F.col(f"__grain.k{cols.index(c)}").alias(c) for c in g], "median")
            for i, (name, g) in enumerate(grains.items())}
