"""Registered queries: lookup tables, serving features, model training and
scoring (ML1-ML6, SO2). Model-dependent outputs have no SQL twin."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from pricewise.functions.numeric import round_half_up
from pricewise.operators import model as MD
from pricewise.operators.filters import validate_requests
from pricewise.operators.enrich import resolve_dimension
from pricewise.operators.runs import latest_finished_run, run_ranking
from pricewise.operators.serving import (build_lookup_tables, route_requests, score_requests,
                                         serving_features)
from pricewise.operators.split import stratified_split
from pricewise.plans import sqltext as Q
from pricewise.plans import tables as T
from pricewise.plans.catalog import engineered, lookups, register, round4
from pricewise.plans.layers import input_stamp
from pricewise.plans.q_features import LOOKUPS_SQL, fallback_sql, stratified_sql
from pricewise.plans.sqltext import canon
from pricewise.session import scratch_path, stored
from pricewise.sources import files as IO
from pricewise.sources.registry import append_run, read_runs

CFG = MD.TrainConfig()
_MODELS: dict = {}


def split_engineered(spark, sf_dir):
    return stratified_split(engineered(spark, sf_dir), "transaction_id", "price", 0.15, 0.15, 42)


def fitted(spark, sf_dir):
    """Train once per session and input version (the model is small; the
    data it was fitted on stays distributed)."""
    from pricewise.session import app_key
    key = (app_key(spark), sf_dir, input_stamp(spark, sf_dir))
    if key not in _MODELS:
        parts = stored(split_engineered(spark, sf_dir), "split")
        train = parts.where(F.col("split") == "train")
        val = parts.where(F.col("split") == "validation")
        began = time.time()
        model = MD.train_price_model(train, val, CFG)
        metrics = stored(MD.evaluate_model(model, parts), "metrics")
        run = MD.run_record(metrics, CFG, checksum=IO.content_checksum(
            spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("orders", "customer", "nation", "region")]),
            start_time=int(began * 1000), end_time=int(time.time() * 1000))
        _MODELS[key] = (model, parts, metrics, stored(run, "run"))
    return _MODELS[key]


@register("build_lookup_tables", Q.r4(" UNION ALL ".join([
    f"SELECT 'borough_price_trend' AS lookup, district AS key, price FROM ({LOOKUPS_SQL['bpt']}) a",
    f"SELECT 'district_yearly_medians', district_year, price FROM ({LOOKUPS_SQL['dym']}) b",
    f"SELECT 'avg_price_last_half', district, price FROM ({LOOKUPS_SQL['recent']}) c"]), "price"))
def q_lookups(spark, sf_dir):
    return round4(build_lookup_tables(engineered(spark, sf_dir)).long())


ENG = f"({Q.ENGINEERED_SQL}) en"
VALID_REQUESTS_SQL = f"""
SELECT v.request_id, v.postcode, v.pt AS property_type, v.nb AS is_new_build, v.lh AS is_leasehold,
       dl.district, (SELECT max(date) FROM {ENG}) AS as_of
FROM (SELECT request_id, postcode, upper(property_type) AS pt, upper(coalesce(is_new_build, 'N')) AS nb,
             upper(coalesce(is_leasehold, 'N')) AS lh FROM ({Q.REQUESTS_SQL}) r) v
JOIN ({Q.DIR_LOOKUP_SQL}) dl ON {canon('v.postcode')} = dl.k
WHERE coalesce(v.pt IN ('A', 'B', 'F', 'H', 'M'), false) AND v.nb IN ('Y', 'N') AND v.lh IN ('Y', 'N')"""

SERVING_SQL = fallback_sql(f"""
SELECT request_id, property_type, is_new_build, is_leasehold, district,
       CAST(year(as_of) AS BIGINT) AS sold_year, CAST(month(as_of) AS BIGINT) AS sold_month,
       date_trunc('month', as_of) AS date
FROM ({VALID_REQUESTS_SQL}) vr""", "district", "sold_year")

SERVING_OUT_SQL = f"""
SELECT request_id, property_type, is_new_build,
       CASE is_leasehold WHEN 'Y' THEN 'L' WHEN 'N' THEN 'F' ELSE is_leasehold END AS is_leasehold, district, sold_month,
       is_new_build || '_' || property_type AS advanced_property_type,
       CASE is_leasehold WHEN 'Y' THEN 'L' WHEN 'N' THEN 'F' ELSE is_leasehold END || '_' || property_type
         AS property_type_and_tenure,
       district || '_' || property_type AS property_type_and_district,
       date, sold_year, borough_price_trend, district_yearly_medians, avg_price_last_half
FROM ({SERVING_SQL}) sv"""


def _valid_resolved_requests(spark, sf_dir):
    req = validate_requests(T.requests_table(spark, sf_dir), allowed_types=T.PROPERTY_TYPES)
    req = req.where("is_valid").drop("is_valid", "reject_reason")
    return resolve_dimension(req, "postcode", T.postcode_directory(spark, sf_dir), "postcode",
                             "district").where(F.col("district").isNotNull())


@register("serving_features", Q.r4(SERVING_OUT_SQL, "borough_price_trend", "district_yearly_medians",
                                   "avg_price_last_half"))
def q_serving(spark, sf_dir):
    eng = engineered(spark, sf_dir)
    lk = lookups(spark, sf_dir)
    as_of = eng.select(F.max("date")).scalar()
    return round4(serving_features(_valid_resolved_requests(spark, sf_dir), lk, as_of,
                                   keep=("request_id",)))


@register("train_price_model")
def q_train(spark, sf_dir):
    """The fitted ensemble: one row per tree (its index, stage of boosting, weight in the sum, nodes, depth)."""
    trees = [(k, weight * float(w), int(t.numNodes), int(t.depth))
             for k, (weight, gbt) in enumerate(MD.boosted_stages(fitted(spark, sf_dir)[0]))
             for t, w in zip(gbt.trees, gbt.treeWeights)]
    return spark.createDataFrame([(i, *t) for i, t in enumerate(trees)], "tree int, stage int, weight double, nodes int, depth int")


def _scored(spark, sf_dir):
    model, parts, *_ = fitted(spark, sf_dir)
    return MD.score_table(model, parts.where(F.col("split") == "test"))


@register("score_table")
def q_score(spark, sf_dir):
    return round4(_scored(spark, sf_dir).select("transaction_id", "price", "predicted_price"))


SPLIT_SQL = f"({stratified_sql(ENG)}) sp"


@register("score_table_rows", Q.r4(f"""
SELECT transaction_id, price, floor(avg(price) OVER () * 100 + 0.5) / 100 AS mean_price,
       floor(var_pop(price) OVER () / 10000 + 0.5) AS explained_and_residual
FROM {SPLIT_SQL} WHERE split = 'test'""", "price"))
def q_score_rows(spark, sf_dir):
    """What SQL can say of the scored table: its rows, and that the predictions' errors and their
    covariance with the price add up to the price's variance:
    var(y) = var(y - p) + 2 cov(y - p, p) + var(p), and mean(p) + mean(y - p) = mean(y)."""
    scored = stored(_scored(spark, sf_dir).select("transaction_id", "price", "predicted_price"), "scored")
    p, e = F.col("predicted_price"), F.col("price") - F.col("predicted_price")
    mean = scored.agg(F.floor((F.avg(p) + F.avg(e)) * 100 + 0.5) / 100).scalar()
    parts = scored.agg(F.floor((F.var_pop(e) + 2 * F.covar_pop(e, p) + F.var_pop(p)) / 10000 + 0.5)).scalar()
    return round4(scored.select("transaction_id", "price", mean.alias("mean_price"), parts.cast("double").alias("explained_and_residual")))


@register("evaluate_model")
def q_evaluate(spark, sf_dir):
    return round4(fitted(spark, sf_dir)[2])


@register("evaluate_model_rows", f"""
SELECT split, count(*) AS n, floor(stddev_pop(price) * 100 + 0.5) / 100 AS price_spread,
       floor(stddev_pop(price) * 100 + 0.5) / 100 AS spread_of_metrics
FROM {SPLIT_SQL} GROUP BY split""")
def q_evaluate_spread(spark, sf_dir):
    """What SQL can say of the metrics: rows per split and, since r2 = 1 - mse / variance, the spread
    of the prices, once from the split's rows and once from mse and r2 (rmse from its square)."""
    _model, parts, m, *_ = fitted(spark, sf_dir)
    cents = lambda c: F.floor(c * 100 + 0.5) / 100
    spread = parts.groupBy("split").agg(cents(F.stddev_pop("price")).alias("price_spread"))
    return m.join(spread, "split").select("split", "n", "price_spread",
                                          cents(F.col("rmse") / F.sqrt(1 - F.col("r2"))).alias("spread_of_metrics"))


@register("model_against_mean")
def q_evaluate_rows(spark, sf_dir):
    """Per split whether the model is better than the mean price (r2 above 0), beside identities of
    the metrics. What the model reaches is nothing SQL can know, so there is no twin."""
    m = fitted(spark, sf_dir)[2]
    return m.select("split", "n", (F.abs(F.col("rmse") * F.col("rmse") / F.col("mse") - 1) < 1e-9).alias("mse_is_rmse_squared"),
                    (F.col("r2") <= 1).alias("r2_at_most_one"), (F.col("r2") > 0).alias("better_than_mean"))


@register("feature_importance")
def q_importance(spark, sf_dir):
    return round4(MD.feature_importance(fitted(spark, sf_dir)[0], CFG))


@register("feature_importance_rows", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 100.0 AS total" for c in (*MD.CAT_FEATURES, *MD.NUM_FEATURES)))
def q_importance_rows(spark, sf_dir):
    """Every model input has an importance and they add up to 100."""
    imp = MD.feature_importance(fitted(spark, sf_dir)[0], CFG)
    total = imp.agg(F.round(F.sum("importance"), 6)).scalar()
    return imp.select("feature", total.alias("total"))


def _responses(spark, sf_dir):
    eng = engineered(spark, sf_dir)
    model, *_, run = fitted(spark, sf_dir)
    out, _rejected = score_requests(
        T.requests_table(spark, sf_dir), T.postcode_directory(spark, sf_dir),
        lookups(spark, sf_dir), model, eng.select(F.max("date")).scalar(), run,
        allowed_types=T.PROPERTY_TYPES)
    return out


@register("score_requests")
def q_score_requests(spark, sf_dir):
    """Responses for every valid request with a known postcode (rejections
    are the second output of the operator, see tests)."""
    return round4(_responses(spark, sf_dir))


@register("score_requests_rows", f"""
SELECT request_id, district, true AS interval_holds, true AS version_names_run,
       'district,borough_price_trend,district_yearly_medians,avg_price_last_half,advanced_property_type,'
       || 'property_type_and_tenure,property_type_and_district,sold_year,sold_month,date' AS enriched,
       'is_leasehold,is_new_build,postcode,property_type' AS user_provided
FROM ({VALID_REQUESTS_SQL}) vr""")
def q_score_requests_rows(spark, sf_dir):
    """What SQL can say of the responses: who is answered, the interval's identities and the contract's fields."""
    p, lo, hi = F.col("predicted_price"), F.col("confidence_interval")[0], F.col("confidence_interval")[1]
    margin = round_half_up(p * 0.1, 2)
    return _responses(spark, sf_dir).select(
        "request_id", "district",
        ((lo == round_half_up(p - margin, 2)) & (hi == round_half_up(p + margin, 2)) & (p > 0)).alias("interval_holds"),
        (F.col("model_version") == F.concat(F.lit("gbt_model:"), F.substring("run_id", 1, 8))).alias("version_names_run"),
        F.array_join("features_used.enriched", ",").alias("enriched"),
        F.array_join("features_used.user_provided", ",").alias("user_provided"))


@register("trained_run_listed", f"""
SELECT count(*) + 1 AS runs, true AS listed, true AS latest FROM ({Q.RUNS_SQL}) r""")
def q_run_listed(spark, sf_dir):
    """The trained model's record, appended to a stored runs table (a repeated append adds none),
    beside all other runs: it is ranked, and the newest finished run."""
    run = fitted(spark, sf_dir)[3]
    path = scratch_path(spark, "runs")
    for _ in range(2):
        append_run(spark, path, run)
    runs = T.runs_table(spark, sf_dir).unionByName(read_runs(spark, path, run.schema), allowMissingColumns=True)
    mine = run.select("run_id").scalar()
    ranked = run_ranking(runs)
    return ranked.agg(F.count(F.lit(1)).alias("runs"), F.max((F.col("run_id") == mine) & (F.col("badge") != "Unknown")).alias("listed"),
                      F.max((F.col("run_id") == latest_finished_run(runs).scalar()) & (F.col("run_id") == mine)).alias("latest"))


@register("rejected_requests", f"""
SELECT request_id, coalesce(reason, CASE WHEN dl.district IS NULL THEN 'unknown postcode' END) AS reject_reason
FROM (SELECT request_id, postcode,
             CASE WHEN NOT coalesce(pt IN ('A', 'B', 'F', 'H', 'M'), false)
                  THEN 'property_type must be one of A,B,F,H,M'
                  WHEN NOT nb IN ('Y', 'N') THEN 'is_new_build must be Y or N'
                  WHEN NOT lh IN ('Y', 'N') THEN 'is_leasehold must be Y or N' END AS reason
      FROM (SELECT request_id, postcode, upper(property_type) AS pt, upper(coalesce(is_new_build, 'N')) AS nb,
                   upper(coalesce(is_leasehold, 'N')) AS lh FROM ({Q.REQUESTS_SQL}) r) u) v
LEFT JOIN ({Q.DIR_LOOKUP_SQL}) dl ON {canon('v.postcode')} = dl.k
WHERE reason IS NOT NULL OR dl.district IS NULL""")
def q_rejected(spark, sf_dir):
    _accepted, rejected = route_requests(T.requests_table(spark, sf_dir),
                                         T.postcode_directory(spark, sf_dir),
                                         allowed_types=T.PROPERTY_TYPES)
    return rejected


@register("stream_serving_features", Q.r4(SERVING_OUT_SQL, "borough_price_trend",
                                          "district_yearly_medians", "avg_price_last_half"))
def q_stream_serving(spark, sf_dir):
    """The serving features as a Structured Streaming query: the request table
    lands as files, the stream joins static lookups (stateless), and a file sink
    with a checkpoint writes the features; the result is the sink read back."""
    from pricewise.session import scratch_path
    from pricewise.streaming.scoring import read_request_stream, stream_features
    src = scratch_path(spark, "requests-in")
    T.requests_table(spark, sf_dir).write.parquet(src)
    eng = engineered(spark, sf_dir)
    feats, _rejected = stream_features(read_request_stream(spark, src), T.postcode_directory(spark, sf_dir),
                                       lookups(spark, sf_dir), eng.select(F.max("date")).scalar(),
                                       allowed_types=T.PROPERTY_TYPES)
    out, ckpt = scratch_path(spark, "features-out"), scratch_path(spark, "features-ckpt")
    query = (feats.writeStream.format("parquet").option("checkpointLocation", ckpt)
                  .trigger(availableNow=True).start(out))
    query.awaitTermination()
    return round4(spark.read.schema(feats.schema).parquet(out))
