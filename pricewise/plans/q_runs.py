"""Registered queries: run records (FL7, FL8, WN4-WN6, SO3, SO4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.operators import filters as FL
from pricewise.operators import runs as RU
from pricewise.plans import sqltext as Q
from pricewise.plans import tables as T
from pricewise.plans.catalog import register, round4

RUNS = f"({Q.RUNS_SQL}) runs"
METRIC_NAMES = ("train_rmse", "validation_rmse", "validation_mse", "validation_r2", "test_rmse")
FINITE = " AND ".join(f"{m} IS NOT NULL AND isfinite({m})" for m in FL.REQUIRED_RUN_METRICS)
FINITE_RUNS = f"(SELECT * FROM {RUNS} WHERE {FINITE}) fr"


def _finite(spark, sf_dir):
    return FL.has_finite_metrics(T.runs_table(spark, sf_dir))


def _flat(df):
    return df.select("run_id", "status", "start_time", "end_time",
                     *[F.col("metrics")[m].alias(m) for m in METRIC_NAMES])


@register("has_finite_metrics", Q.r4(f"SELECT run_id, status, start_time, end_time, {', '.join(METRIC_NAMES)} FROM {FINITE_RUNS}",
                                     *METRIC_NAMES))
def q_finite(spark, sf_dir):
    return round4(_flat(_finite(spark, sf_dir)))


@register("finished_runs", f"""
SELECT run_id, start_time FROM {RUNS} WHERE status = 'FINISHED'
ORDER BY start_time DESC NULLS LAST, run_id LIMIT 30""")
def q_finished(spark, sf_dir):
    return FL.finished_runs(T.runs_table(spark, sf_dir), 30).select("run_id", "start_time")


RANK_SQL = f"""
WITH r AS (SELECT run_id, {Q.rhu('validation_rmse')} AS rounded_score FROM {FINITE_RUNS}),
b AS (SELECT min(rounded_score) AS best FROM r),
s AS (SELECT CASE WHEN (SELECT count_if(rounded_score = b.best) FROM r) >= 2 THEN b.best
                  ELSE (SELECT min(rounded_score) FROM r WHERE rounded_score > b.best) END AS second
      FROM b)
SELECT r.run_id, r.rounded_score,
       CASE WHEN r.rounded_score IS NULL THEN 'Unknown' WHEN r.rounded_score = b.best THEN 'Champion'
            WHEN s.second IS NOT NULL AND r.rounded_score = s.second THEN 'Challenger'
            ELSE 'Archive' END AS badge
FROM r, b, s"""


@register("run_ranking", Q.r4(RANK_SQL, "rounded_score"))
def q_ranking(spark, sf_dir):
    return round4(RU.run_ranking(_finite(spark, sf_dir)).select("run_id", "rounded_score", "badge"))


@register("generalisation_gap", Q.r4(f"""
SELECT run_id, gap, CASE WHEN gap IS NULL THEN 'unavailable' WHEN gap < 0.1 THEN 'excellent'
                         WHEN gap < 0.25 THEN 'acceptable' WHEN gap < 0.4 THEN 'potential_overfit'
                         ELSE 'likely_overfit' END AS gap_label
FROM (SELECT run_id, CASE WHEN validation_rmse IS NOT NULL AND train_rmse IS NOT NULL AND train_rmse <> 0
                          THEN (validation_rmse - train_rmse) / train_rmse END AS gap FROM {RUNS}) g""", "gap"))
def q_gap(spark, sf_dir):
    return round4(RU.generalisation(T.runs_table(spark, sf_dir)).select("run_id", "gap", "gap_label"))


@register("metric_series", Q.r4(f"""
WITH s AS (SELECT run_id, make_timestamp(end_time * 1000) AS end_at,
                  {Q.rhu('validation_rmse')} AS validation_rmse, {Q.rhu('validation_r2')} AS validation_r2
           FROM {FINITE_RUNS})
SELECT s.*, (SELECT min(validation_rmse) FROM s) AS validation_rmse_min,
       (SELECT max(validation_rmse) FROM s) AS validation_rmse_max,
       (SELECT min(validation_r2) FROM s) AS validation_r2_min,
       (SELECT max(validation_r2) FROM s) AS validation_r2_max
FROM s""", "validation_rmse", "validation_r2", "validation_rmse_min", "validation_rmse_max",
                                "validation_r2_min", "validation_r2_max"))
def q_series(spark, sf_dir):
    return round4(RU.metric_series(_finite(spark, sf_dir)))


@register("latest_finished_run", f"""
SELECT run_id FROM {RUNS} WHERE status = 'FINISHED' ORDER BY start_time DESC, run_id DESC LIMIT 1""")
def q_latest_run(spark, sf_dir):
    return RU.latest_finished_run(T.runs_table(spark, sf_dir))


@register("list_runs", Q.r4(f"""
SELECT run_id, run_id AS run_uuid, status, make_timestamp(start_time * 1000) AS start_at,
       make_timestamp(end_time * 1000) AS end_at, validation_rmse, log_target, 'events' AS source,
       'runs/' || run_id || '/artifacts' AS artifact_uri, '0' AS experiment_id, 'active' AS lifecycle_stage,
       substr(run_id, 5) AS user_id
FROM {RUNS} WHERE status = 'FINISHED'
ORDER BY start_time DESC NULLS LAST, run_id LIMIT 30""", "validation_rmse"))
def q_list_runs(spark, sf_dir):
    """Newest finished runs as nested payloads; the projection reads fields back
    out of the nested record so it can be compared."""
    p = RU.run_payload(FL.finished_runs(T.runs_table(spark, sf_dir), 30))
    return round4(p.select("run_id", F.col("info.run_uuid").alias("run_uuid"), F.col("info.status").alias("status"),
                           F.col("info.start_at").alias("start_at"), F.col("info.end_at").alias("end_at"),
                           F.col("data.metrics")["validation_rmse"].alias("validation_rmse"),
                           F.col("data.params")["log_target"].alias("log_target"),
                           F.col("data.tags")["source"].alias("source"),
                           *[F.col(f"info.{c}").alias(c) for c in RU.OPTIONAL_INFO]))
