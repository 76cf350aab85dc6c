"""Model-run records: finite-metric filter, ranking, gaps, series, latest run.

A runs table has ``run_id, status, start_time, end_time`` (epoch ms),
``metrics`` map<string,double> and ``params`` / ``tags`` map<string,string>.
Global quantities (the two lowest scores, all series' ends) are one scalar
subquery each: a distributed aggregate, never an unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.dates import epoch_millis_to_utc
from pricewise.functions.numeric import gap_bucket, generalisation_gap, round_half_up
from pricewise.operators.filters import FINISHED

# Leaderboard badges.
CHAMPION, CHALLENGER, ARCHIVE, UNKNOWN = "Champion", "Challenger", "Archive", "Unknown"


def metric(name: str, metrics_col: str = "metrics"):
    return F.col(metrics_col)[name]


def run_ranking(runs: DataFrame, score: str = "validation_rmse",
                metrics_col: str = "metrics") -> DataFrame:
    """Badge per run by its score rounded to 2 dp: equal to the lowest ->
    Champion; else equal to the second entry of the sorted list (duplicates
    kept, so a tie for first leaves no Challenger) -> Challenger; else Archive."""
    scored = runs.withColumn("rounded_score", round_half_up(metric(score, metrics_col), 2))
    # the two lowest scores with their counts: one grouped pass, at most two rows
    lowest = (scored.where(F.col("rounded_score").isNotNull()).groupBy("rounded_score").agg(F.count(F.lit(1)).alias("n"))
              .orderBy("rounded_score").limit(2)
              .agg(F.array_sort(F.collect_list(F.struct("rounded_score", "n"))).alias("top")))
    scored = scored.withColumn("__top", lowest.scalar())
    best = F.get("__top", F.lit(0))["rounded_score"]
    second = F.when(F.get("__top", F.lit(0))["n"] >= 2, best).otherwise(F.get("__top", F.lit(1))["rounded_score"])
    badge = (F.when(F.col("rounded_score").isNull(), UNKNOWN)
              .when(F.col("rounded_score") == best, CHAMPION)
              .when(second.isNotNull() & (F.col("rounded_score") == second), CHALLENGER)
              .otherwise(ARCHIVE))
    return scored.withColumn("badge", badge).drop("__top")


def generalisation(runs: DataFrame, metrics_col: str = "metrics") -> DataFrame:
    """(val - train) / train of the rmse and its bucket label."""
    gap = generalisation_gap(metric("validation_rmse", metrics_col), metric("train_rmse", metrics_col))
    return runs.withColumn("gap", gap).withColumn("gap_label", gap_bucket("gap"))


def metric_series(runs: DataFrame, metrics_col: str = "metrics",
                  names=("validation_rmse", "validation_r2")) -> DataFrame:
    """(run_id, end time, rounded metrics) plus each series' min and max."""
    out = runs.select("run_id", epoch_millis_to_utc("end_time").alias("end_at"),
                      *[round_half_up(metric(n, metrics_col), 2).alias(n) for n in names])
    ends = out.agg(F.struct(*[f(n).alias(f"{n}_{end}") for n in names for end, f in (("min", F.min), ("max", F.max))])
                   .alias("ends"))
    out = out.withColumn("__ends", ends.scalar())
    return out.select("*", "__ends.*").drop("__ends")


def latest_finished_run(runs: DataFrame) -> DataFrame:
    """One row: the newest FINISHED run id (ties broken by run id)."""
    return (runs.where(F.col("status") == FINISHED)
                .agg(F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id")))


# Fields of a run that are echoed where the runs table has them.
OPTIONAL_INFO = ("artifact_uri", "experiment_id", "lifecycle_stage", "user_id")


def run_payload(runs: DataFrame) -> DataFrame:
    """Nested record per run: data{metrics, params, tags}, info{...} with UTC times."""
    more = [(F.col(c) if c in runs.columns else F.lit(None).cast("string")).alias(c) for c in OPTIONAL_INFO]
    return runs.select(
        "run_id",
        F.struct(F.col("metrics"), F.col("params"), F.col("tags")).alias("data"),
        F.struct(F.col("run_id"), F.col("run_id").alias("run_uuid"), "status", "start_time",
                 "end_time", epoch_millis_to_utc("start_time").alias("start_at"),
                 epoch_millis_to_utc("end_time").alias("end_at"), *more).alias("info"))
