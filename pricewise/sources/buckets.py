"""Facts and their directory stored in the same buckets, so that joins of the two shuffle nothing."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.functions.text import canonical_postcode
from pricewise.operators.enrich import dimension_table
from pricewise.operators.stats import join_small
from pricewise.session import remove_path, scratch_path, stored

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 100_000  # Spark's own limit of buckets per table

# columns added to both tables: the canonical key and the part of a hot key
KEY, PART = "__pw_key", "__pw_part"


@dataclass(frozen=True)
class BucketedPair:
    """Names and places of two tables bucketed alike by (key, part)."""

    facts: str
    directory: str
    facts_path: str
    directory_path: str
    buckets: int
    value: str

    def drop(self, spark: SparkSession) -> None:
        """Forget both tables and delete their files."""
        for name, path in ((self.facts, self.facts_path), (self.directory, self.directory_path)):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove_path(spark, path)


def _save(df: DataFrame, name: str, buckets: int) -> tuple[str, str]:
    table, path = f"pricewise_{name}_{uuid.uuid4().hex[:12]}", scratch_path(df.sparkSession, name)
    # placed like the buckets first: every bucket is one sorted file
    (df.repartition(buckets, KEY, PART).write.format("parquet").option("path", path)
     .bucketBy(buckets, KEY, PART).sortBy(KEY, PART).saveAsTable(table))
    return table, path


def save_bucketed_pair(facts: DataFrame, key_col: str, directory: DataFrame, directory_key: str, directory_value: str,
                       out_col: str = "district", rows_per_bucket: int = ROWS_PER_BUCKET) -> BucketedPair:
    """Store ``facts`` and the directory (canonical key -> ``out_col``, one row per key) in the
    same buckets of about ``rows_per_bucket`` fact rows.

    A key (or the null key) with more fact rows than that is cut into parts: its facts
    are dealt over them, its directory row is copied to each, so no bucket holds a
    hot key whole. The facts lose a column ``out_col`` they may have. One shuffle of
    each side, paid once for all later joins. Null and unusable directory rows are
    left out; empty tables give empty tables of one bucket.
    """
    base = facts.drop(out_col) if out_col in facts.columns else facts
    keyed = stored(base.withColumn(KEY, canonical_postcode(key_col)), "bucket-facts")
    counts = stored(keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")), "bucket-counts")
    parts = F.ceil(F.col("n") / rows_per_bucket).cast("int")
    hot = stored(counts.where(F.col("n") > rows_per_bucket).select(KEY, parts.alias("__pw_parts")), "bucket-hot")
    total, nulls = counts.agg(F.coalesce(F.sum("n"), F.lit(0)),
                              F.coalesce(F.max(F.when(F.col(KEY).isNull(), parts)), F.lit(1))).first()
    buckets = min(MAX_BUCKETS, max(1, -(-total // rows_per_bucket)))
    known = hot.where(F.col(KEY).isNotNull())
    cut = F.when(F.col(KEY).isNull(), F.lit(nulls)).otherwise(F.coalesce("__pw_parts", F.lit(1)))
    # row numbers of a stored table: a task that runs again deals its rows alike
    numbered = keyed.withColumn("__pw_row", F.monotonically_increasing_id())
    left = (join_small(numbered, known, on=KEY, how="left").withColumn(PART, F.pmod("__pw_row", cut).cast("int"))
            .drop("__pw_row", "__pw_parts"))
    right = (join_small(dimension_table(directory, directory_key, directory_value, out_col), known, on=KEY, how="left")
             .withColumn(PART, F.explode(F.sequence(F.lit(0), F.coalesce("__pw_parts", F.lit(1)) - 1))).drop("__pw_parts"))
    (a, a_path), (b, b_path) = _save(left, "facts", buckets), _save(right, "directory", buckets)
    return BucketedPair(a, b, a_path, b_path, buckets, out_col)


def _sides(spark: SparkSession, pair: BucketedPair) -> tuple[DataFrame, DataFrame]:
    # a merge of the sorted buckets: neither side is shuffled or broadcast
    return spark.table(pair.facts), spark.table(pair.directory).hint("merge")


def resolve_bucketed(spark: SparkSession, pair: BucketedPair) -> DataFrame:
    """``resolve_dimension`` over stored tables: rows whose non-null key has no usable value
    are dropped, rows with a null key stay with a null value. No exchange of either side."""
    facts, directory = _sides(spark, pair)
    return (facts.join(directory, [KEY, PART], "left")
            .where(F.col(KEY).isNull() | F.col(pair.value).isNotNull()).drop(KEY, PART))


def unresolved_bucketed(spark: SparkSession, pair: BucketedPair) -> DataFrame:
    """``unresolved_keys`` over stored tables: the facts meet the directory inside their buckets,
    only keys without a usable value are exchanged (parts of one key become one row)."""
    facts, directory = _sides(spark, pair)
    missing = facts.where(F.col(KEY).isNotNull()).select(KEY, PART).join(directory, [KEY, PART], "left_anti")
    return missing.select(F.col(KEY).alias("key")).distinct()
