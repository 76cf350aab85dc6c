"""Mixing sources to target weights by Poisson replication.

Every document gets a repetition count from a Poisson distribution whose mean
is its source's target repetition rate, by inverting the distribution at a
uniform number hashed from (seed, document). Documents are exploded by their
counts and shuffled globally: a random key sends each copy to a random
partition and orders it there. Counts depend on nothing but the seed, the
document and its source's rate, so a lost task repeats the same draws.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import join_sized, neutral, stored

# A mean above this is drawn as a sum of equal independent parts, since e^-mean underflows.
PART_MEAN = 256.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 of the parts."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, *, source_col: str = "source",
                 text_col: str = "text", total_bytes: float | None = None) -> DataFrame:
    """Per source: its size in UTF-8 bytes, target share and repetition rate.

    ``weights`` maps sources to relative weights (sources it does not name get
    none; None: all alike). The target size is ``total_bytes`` (None: the corpus as
    it is). A source whose texts are all empty has rate 0, a null source is a
    source of its own (weight key None).
    """
    size = docs.groupBy(F.col(source_col).alias("_s")).agg(
        F.sum(F.coalesce(F.octet_length(text_col), F.lit(0))).cast("double").alias("_size"))
    if weights is None:
        w = F.lit(1.0)
    else:
        w = F.lit(0.0)
        for name, weight in weights.items():
            w = F.when(F.col("_s").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(w)
    size = stored(size.withColumn("_w", F.when(F.col("_size") > 0, w).otherwise(0.0)), "mix-sizes")
    if total_bytes is None:
        goal = size.agg(F.sum("_size")).scalar()
    else:
        goal = F.lit(float(total_bytes))
    share = F.col("_w") / size.agg(F.sum("_w")).scalar()
    rate = F.when(F.col("_w") > 0, share * goal / F.col("_size")).otherwise(0.0)
    return size.select("_s", "_size", F.when(F.col("_w") > 0, share).otherwise(0.0).alias("_share"), rate.alias("_rate"))


def _with_steps(rates: DataFrame) -> DataFrame:
    """Adds the number of parts and the distribution function of one part, as an array up
    to where its tail is below 2^-52."""
    r = rates.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_rate") / PART_MEAN)).cast("int"))
    r = r.withColumn("_mean", F.col("_rate") / F.col("_parts"))
    last = F.ceil(F.col("_mean") + 10 * F.sqrt("_mean") + 30).cast("int")
    start = F.struct(F.exp(-F.col("_mean")).alias("p"), F.array(F.exp(-F.col("_mean"))).alias("c"))
    steps = F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda a, k: F.struct((a["p"] * F.col("_mean") / k).alias("p"),
                              F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * F.col("_mean") / k)).alias("c")),
        lambda a: a["c"])
    return r.withColumn("_cdf", steps)


def poisson_mix(docs: DataFrame, weights: Mapping[str, float] | None = None, *, seed: int = 1,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                total_bytes: float | None = None, extra: bool = False) -> DataFrame:
    """``docs`` replicated to the target weights and globally shuffled; columns unchanged.

    ``extra`` adds copy (from 1), rate (of the source) and shuffle_key. Draws
    are keyed by the id and the text's hash, so rows that share an id but not the
    text draw apart; identical rows draw alike, each being replicated. Null
    ids, texts and sources are values like any other. A count may be 0: on
    average a source holds its target share.
    """
    rates = stored(_with_steps(source_rates(docs, weights, source_col=source_col, text_col=text_col,
                                            total_bytes=total_bytes)), "mix-rates")
    base, name = neutral(docs)
    who = [F.lit(seed), F.coalesce(F.col(name[id_col]).cast("string"), F.lit("")),
           F.md5(F.coalesce(F.col(name[text_col]), F.lit("")))]
    # null-safe key: a null source joins its own rate
    side = rates.select(F.struct(F.col("_s")).alias("_key"), "_rate", "_parts", "_cdf")
    keyed = base.withColumns({"_who": F.concat_ws("|", *[w.cast("string") for w in who]),
                              "_key": F.struct(F.col(name[source_col]).alias("_s"))})
    joined = join_sized(keyed, side, ["_key"], "inner", row_bytes=1024)
    # one draw a part, each made once and looked up in the distribution
    draws = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda j: uniform(F.col("_who"), j))
    count = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("_cdf", lambda c: c <= u)))
    out = joined.withColumn("_n", count).where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    out = out.withColumn("_order", F.md5(F.concat_ws("|", F.col("_who"), F.lit("order"), F.col("_copy").cast("string"))))
    out = out.repartition("_order").sortWithinPartitions("_order")
    cols = [F.col(n).alias(c) for c, n in name.items()]
    if extra:
        cols += [F.col("_copy").alias("copy"), F.col("_rate").alias("rate"), F.col("_order").alias("shuffle_key")]
    return out.select(*cols)


def mix_sql(seed: int = 1) -> str:
    """DuckDB twin of ``poisson_mix`` with equal weights (rates up to PART_MEAN), for the digest columns."""
    return f"""
WITH RECURSIVE size AS (
  SELECT source, sum(coalesce(strlen(text), 0))::DOUBLE AS bytes FROM documents GROUP BY source),
rate AS (
  SELECT source, (1.0 / (SELECT count(*) FROM size WHERE bytes > 0)) * (SELECT sum(bytes) FROM size) / bytes AS rate
  FROM size WHERE bytes > 0),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rate
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf
  WHERE k < ceil(rate + 10 * sqrt(rate) + 30)),
who AS (
  SELECT doc_id, source, sha256(text) AS text_sha256, '{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) AS who FROM documents),
drawn AS (
  SELECT doc_id, source, text_sha256, who, ('0x' || substr(md5(who || '|0'), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM who),
counted AS (
  SELECT doc_id, drawn.source, who, any_value(text_sha256) AS text_sha256, any_value(rate) AS rate, count(*) FILTER (WHERE c <= u) AS n
  FROM drawn JOIN cdf ON drawn.source IS NOT DISTINCT FROM cdf.source GROUP BY doc_id, drawn.source, who)
SELECT doc_id, source, copy::INTEGER AS copy, round(rate, 6) AS rate, md5(who || '|order|' || copy) AS shuffle_key,
       text_sha256
FROM (SELECT *, unnest(generate_series(1, n)) AS copy FROM counted)"""
