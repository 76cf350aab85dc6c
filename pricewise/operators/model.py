"""Boosted-tree price model on Spark ML: train in stages, score, evaluate, importances."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.operators.filters import FINISHED
from pricewise.operators.metrics import metrics_record, regression_metrics
from pricewise.operators.stats import join_small, quantile_scalar
from pricewise.session import remove_path, scratch_path, stored

# The 13 model inputs in their required order.
MODEL_COLUMNS = ("property_type", "is_new_build", "is_leasehold", "district", "sold_month",
                 "advanced_property_type", "property_type_and_tenure",
                 "property_type_and_district", "date", "sold_year", "borough_price_trend",
                 "district_yearly_medians", "avg_price_last_half")
CAT_FEATURES = ("property_type", "is_new_build", "is_leasehold", "district", "sold_month",
                "advanced_property_type", "property_type_and_tenure", "property_type_and_district")
NUM_FEATURES = ("date", "sold_year", "borough_price_trend", "district_yearly_medians",
                "avg_price_last_half")
LABEL = "__pw_label"
PRED = "prediction"
FIT = "__pw_fit"
STAGE = "__pw_stage_"
# Rows per cell (rows with equal model inputs) from which equal rows are counted as pairs of inputs
# and label, and pairs per cell from which trees are grown over cells.
ROWS_PER_CELL = 2
# Different labels one row of a cell may hold; a cell with more has several rows.
LABELS_PER_ROW = 20_000
# Rounds after which the fit to the cells is written.
STORE_ROUNDS = 10
# Cells, and labels in them, of one task: a round has some ten short jobs, so few cells on many tasks cost only their start.
CELLS_PER_TASK, CELL_LABELS_PER_TASK = 50_000, 500_000


@dataclass(frozen=True)
class TrainConfig:
    """Depth, rate and the most rounds are the source's. Rounds are trained in stages of
    ``stage_rounds``; a stage enters with the one of ``stage_weights`` that has the least
    error. Within a stage a round, and over stages a stage, that improves the error by less
    than ``early_stop`` (relative) ends it. ``min_bins`` is raised to the largest
    category's size."""

    cat_features: Sequence[str] = CAT_FEATURES
    num_features: Sequence[str] = NUM_FEATURES
    label: str = "price"
    log_target: bool = True
    clip_target_q: float = 0.99
    max_iter: int = 4000
    depth: int = 8
    step: float = 0.05
    early_stop: float = 0.001
    stage_rounds: int = 50
    stage_weights: Sequence[float] = (1.0, 0.5, 0.2, 0.1, 0.05)
    seed: int = 42
    min_bins: int = 128
    subsample: float = 1.0
    extra: dict = field(default_factory=dict)


def _num_expr(name: str) -> str:
    # timestamps enter the trees as (fractional) epoch days
    return (f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
            f"CAST(`{name}` AS TIMESTAMP_NTZ)) / 86400000000.0"
            if name == "date" else f"CAST(`{name}` AS DOUBLE)")


def _label(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """Label clipped at its own quantile (per split), then log1p when configured."""
    cap = quantile_scalar(df, cfg.label, cfg.clip_target_q)
    y = F.when(F.col(cfg.label) > cap, cap).otherwise(F.col(cfg.label)).cast("double")
    return df.withColumn(LABEL, F.log1p(y) if cfg.log_target else y)


def feature_pipeline(cfg: TrainConfig) -> Pipeline:
    idx = [f"__pw_idx_{c}" for c in cfg.cat_features]
    nums = [f"__pw_num_{c}" for c in cfg.num_features]
    select = ", ".join(["*"] + [f"{_num_expr(c)} AS `{n}`" for c, n in zip(cfg.num_features, nums)])
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT {select} FROM __THIS__"),
        StringIndexer(inputCols=list(cfg.cat_features), outputCols=idx, handleInvalid="keep"),
        VectorAssembler(inputCols=idx + nums, outputCol="__pw_features", handleInvalid="keep"),
    ])


def _pairs(rows: DataFrame, inputs: Sequence[str], cfg: TrainConfig, bins: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(cells, pairs), one of them or none: fewer rows that say what ``rows`` say. Pairs are rows of
    equal inputs and label, counted (__pw_n). Cells are pairs of equal inputs with their labels and
    counts listed (__pw_labels; __pw_n rows in all; many labels are listed in parts): worth it with
    ``ROWS_PER_CELL`` pairs a cell. None if few rows share inputs, or if there are too few for the bins."""
    if cfg.subsample < 1.0 or cfg.extra:
        return None, None
    keys = [*inputs, "__pw_is_val"]
    pairs = stored(rows.groupBy(*keys, LABEL).agg(F.count(F.lit(1)).alias("__pw_n")), "pairs")
    fitted = ~F.col("__pw_is_val")
    n, held, held_fit, cells, cells_fit, most = pairs.groupBy(*keys).agg(F.sum("__pw_n").alias("n"), F.count(F.lit(1)).alias("p")).agg(
        F.sum("n"), F.sum("p"), F.sum(F.when(fitted, F.col("p"))), F.count(F.lit(1)), F.count_if(fitted), F.max("p")).first()
    if not n or n < ROWS_PER_CELL * cells or (cells_fit if held >= ROWS_PER_CELL * cells else held_fit) < bins:
        return None, None
    if held >= ROWS_PER_CELL * cells:
        part = F.pmod(F.xxhash64(LABEL), F.lit(-(-most // LABELS_PER_ROW)))
        return (pairs.groupBy(*keys, part.alias("__pw_part"))
                .agg(F.collect_list(F.struct(F.col(LABEL).alias("y"), F.col("__pw_n").alias("n"))).alias("__pw_labels"), F.sum("__pw_n").alias("__pw_n"))
                .drop("__pw_part")), None
    return None, pairs


def _tasks(rows: DataFrame, held: Column) -> int:
    """Tasks for a pass over stored pairs or cells that hold so many labels."""
    size, labels = rows.agg(F.count(F.lit(1)), F.sum(held)).first()
    return max(1, -(-size // CELLS_PER_TASK), -(-labels // CELL_LABELS_PER_TASK))


def _over_labels(at: Column, value) -> Column:
    """Sum of ``value(y, at)`` over a cell's rows. ``at`` is the start value's second field: taken
    from there it is evaluated once a cell, not once a label."""
    start = F.struct(F.lit(0.0).alias("total"), at.cast("double").alias("at"))
    return F.aggregate("__pw_labels", start, lambda s, x: F.struct(
        (s["total"] + x["n"] * value(x["y"], s["at"])).alias("total"), s["at"].alias("at")), lambda s: s["total"])


def _ensemble(spark: SparkSession, trees: list, weights: list[float], out: str) -> GBTRegressionModel:
    gateway, ml = spark.sparkContext._gateway, spark.sparkContext._jvm.org.apache.spark.ml.regression
    these = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        these[i], shares[i] = tree._java_obj, weight
    model = GBTRegressionModel(ml.GBTRegressionModel(f"GBTRegressor_{uuid.uuid4().hex[:12]}", these, shares, trees[0].numFeatures))
    return model.setFeaturesCol("__pw_features").setPredictionCol(out)


def _boost_cells(state: DataFrame, kinds: dict, cfg: TrainConfig, rounds: int, seed: int, bins: int, out: str, tasks: int) -> GBTRegressionModel:
    """What ``GBTRegressor`` fits to the rows (absolute loss, the same rule to end), grown over
    cells: all rows of a cell have one prediction, so their pseudo-residuals (1 or -1) enter a
    tree as the cell's mean, weighted by its rows. Splits and leaves follow from sums and
    counts, which are the rows' own, so a round costs cells, not rows. One pass a round
    gives the error of the trees so far and the next tree's targets. Every ``STORE_ROUNDS``
    rounds the fit so far is written; only trees since then are evaluated again."""
    spark = state.sparkSession
    tree = DecisionTreeRegressor(featuresCol="__pw_features", labelCol="__pw_target", weightCol="__pw_n", maxDepth=cfg.depth,
                                 maxBins=bins, seed=seed, checkpointInterval=10)
    trees, weights, recent, best, least, path = [], [], 0, 1, None, None
    fitted = state
    while True:
        at = F.col(FIT) + F.col(out) if recent else F.col(FIT)
        step = (lambda y, p: F.when(y - p < 0, -1.0).otherwise(1.0)) if trees else (lambda y, p: y - p)
        aims = fitted.select(
            F.col("__pw_features").alias("__pw_features", metadata=kinds), "__pw_is_val", F.col("__pw_n").cast("double").alias("__pw_n"),
            F.when(F.col("__pw_is_val"), _over_labels(at, lambda y, p: F.abs(y - p)))
            .otherwise(_over_labels(at, step) / F.col("__pw_n")).alias("__pw_target")).persist()
        if trees:
            left = aims.where("__pw_is_val").agg(F.sum("__pw_target"), F.sum("__pw_n")).first()
            error = left[0] / left[1] if left[1] else 0.0
            ends = least is not None and least - error < cfg.early_stop * max(error, 0.01)
            if not ends:
                least, best = error, len(trees)
            if ends or len(trees) == rounds:
                aims.unpersist()
                break
        trees.append(tree.fit(aims.where("not __pw_is_val")))
        weights.append(cfg.step if weights else 1.0)
        aims.unpersist()
        recent += 1
        fitted = _ensemble(spark, trees[-recent:], weights[-recent:], out).transform(state)
        if recent == STORE_ROUNDS:
            before, path = path, scratch_path(spark, "rounds")
            fitted.withColumn(FIT, F.col(FIT) + F.col(out)).drop(out).write.parquet(path)
            state = fitted = spark.read.schema(state.schema).parquet(path).coalesce(tasks)
            recent = 0
            if before is not None:
                remove_path(spark, before)
    if path is not None:
        remove_path(spark, path)
    return _ensemble(spark, trees[:best], weights[:best], out)


def train_price_model(train: DataFrame, validation: DataFrame | None = None,
                      cfg: TrainConfig = TrainConfig()) -> PipelineModel:
    """Fit StringIndexer + VectorAssembler + boosted trees (absolute loss) in stages.

    The fit starts at the median label. Each stage is a GBTRegressor of at most
    ``stage_rounds`` rounds on what the stages before left over, read from a stored
    table of (features, label, fit), so no stage replays another's lineage and a lost
    executor re-reads one table. A stage's own first tree is not shrunk by Spark, so the
    stage enters with the weight that has the least mean absolute error on the validation
    rows; training ends with the first stage that gains less than ``early_stop``. The first
    stage always stays, with the best of the weights. Without a validation frame the
    training rows are the judges too. The result is a plain PipelineModel: the stages'
    regressors and one SQL sum.

    Where rows share their inputs (``ROWS_PER_CELL`` of them on average), the table holds one
    row per cell of equal inputs with all its labels, or, if most cells have one, a weighted row
    per pair of inputs and label. A round's cost then follows the cells or pairs, not the rows.

    Labels are clipped per split. The bin count follows the fitted indexers, so any
    number of categories trains. Only error sums and the median reach the driver.
    """
    cols = [*cfg.cat_features, *cfg.num_features, cfg.label]
    data = _label(train.select(*cols), cfg).withColumn("__pw_is_val", F.lit(False))
    judges = train if validation is None else validation
    data = stored(data.unionByName(_label(judges.select(*cols), cfg).withColumn("__pw_is_val", F.lit(True))), "train")
    spark = data.sparkSession
    prepared = feature_pipeline(cfg).fit(data)
    largest = max(len(labels) for labels in prepared.stages[1].labelsArray) + 1  # and the unknown one
    bins = max(cfg.min_bins, largest)
    middle = quantile_scalar(data.where(~F.col("__pw_is_val")), LABEL, 0.5)
    base = float(spark.range(1).select(middle.cast("double")).first()[0])
    features = prepared.transform(data)
    kinds = features.schema["__pw_features"].metadata  # which entries are categories
    assembler = prepared.stages[2]
    cells, pairs = _pairs(features, assembler.getInputCols(), cfg, bins)
    tasks, weighted = None, {}
    if cells is not None:
        labels, held = ["__pw_labels", "__pw_n"], F.size("__pw_labels")
    elif pairs is not None:
        labels, held, weighted = [LABEL, "__pw_n"], F.lit(1), {"weightCol": "__pw_n"}
    else:
        labels = [LABEL]
        state = features.select("__pw_features", *labels, "__pw_is_val")
    if len(labels) > 1:
        state = stored(assembler.transform(pairs if cells is None else cells).select("__pw_features", *labels, "__pw_is_val"), "cells")
        tasks = _tasks(state, held)
        state = state.coalesce(tasks)
    state = state.withColumn(FIT, F.lit(base))
    fits, weights, before = [], [], None
    for first in range(0, cfg.max_iter, cfg.stage_rounds):
        out = f"{STAGE}{len(fits)}"
        rounds = min(cfg.stage_rounds, cfg.max_iter - first)
        if cells is None:
            gbt = GBTRegressor(featuresCol="__pw_features", labelCol="__pw_left", predictionCol=out,
                               lossType="absolute", maxIter=rounds,
                               maxDepth=cfg.depth, stepSize=cfg.step, seed=cfg.seed + first,
                               maxBins=bins, subsamplingRate=cfg.subsample,
                               validationTol=cfg.early_stop, validationIndicatorCol="__pw_is_val",
                               checkpointInterval=10, **weighted, **cfg.extra)
            fit = gbt.fit(state.select(F.col("__pw_features").alias("__pw_features", metadata=kinds), "__pw_is_val", *labels[1:],
                                       (F.col(LABEL) - F.col(FIT)).alias("__pw_left")))
        else:
            fit = _boost_cells(state, kinds, cfg, rounds, cfg.seed + first, bins, out, tasks)
        path = scratch_path(spark, "boosting")
        fit.transform(state).write.parquet(path)
        scored = spark.read.parquet(path)
        choices = [0.0, *cfg.stage_weights]
        judged = scored.where("__pw_is_val")
        if cells is None:
            n = F.col("__pw_n") if weighted else F.lit(1)
            errors = judged.agg(*[F.sum(n * F.abs(F.col(LABEL) - F.col(FIT) - w * F.col(out))) / F.sum(n) for w in choices]).first()
        else:
            errors = judged.agg(*[F.sum(_over_labels(F.col(FIT) + w * F.col(out), lambda y, p: F.abs(y - p))) / F.sum("__pw_n")
                                  for w in choices]).first()
        best = min(range(1, len(choices)), key=lambda i: errors[i])
        gains = errors[0] - errors[best] >= cfg.early_stop * max(errors[0], 0.01)
        if gains or not fits:
            fits.append(fit)
            weights.append(choices[best])
        if before is not None:
            remove_path(spark, before)
        before = path
        if not gains:
            break
        state = scored.select("__pw_features", *labels, "__pw_is_val", (F.col(FIT) + choices[best] * F.col(out)).alias(FIT))
        if tasks:
            state = state.coalesce(tasks)
    if before is not None:
        remove_path(spark, before)
    total = " + ".join([f"{base!r}D", *[f"{w!r}D * {STAGE}{k}" for k, w in enumerate(weights)]])
    return PipelineModel([*prepared.stages, *fits, SQLTransformer(statement=f"SELECT *, {total} AS {PRED} FROM __THIS__")])


def boosted_stages(model: PipelineModel) -> list[tuple[float, GBTRegressionModel]]:
    """The weight and the regressor of every stage of boosting, in training order."""
    total = model.stages[-1].getStatement()
    weights = [float(w) for w, _ in re.findall(rf"([0-9.eE+-]+)D \* {STAGE}([0-9]+)", total)]
    return list(zip(weights, [s for s in model.stages if isinstance(s, GBTRegressionModel)], strict=True))


def model_inputs(model: PipelineModel) -> list[str]:
    """The columns of a scored table that the model reads."""
    _numbers, indexer, assembler = model.stages[:3]
    numeric = [c.removeprefix("__pw_num_") for c in assembler.getInputCols() if c.startswith("__pw_num_")]
    return list(dict.fromkeys([*indexer.getInputCols(), *numeric]))


def score_table(model: PipelineModel, df: DataFrame, log_target: bool = True,
                out_col: str = "predicted_price") -> DataFrame:
    """Predict every row; invert the log target. Input columns are kept.

    Rows of equal inputs have one prediction: each combination that occurs passes the trees
    once and is joined back (nulls and NaN are values like others), so trees x rows is never
    computed. A stream cannot be read twice and is predicted row by row.
    """
    price = F.expm1(F.col(PRED)) if log_target else F.col(PRED)
    if df.isStreaming:
        scored = model.transform(df).withColumn(out_col, price)
    else:
        inputs = model_inputs(model)
        cells = model.transform(df.select(*inputs).distinct()).select(
            *[F.col(c).alias(f"__pw_in_{c}") for c in inputs], price.alias("__pw_price"))
        same = [F.col(c).eqNullSafe(F.col(f"__pw_in_{c}")) for c in inputs]
        scored = join_small(df, cells, same).withColumn(out_col, F.col("__pw_price"))
    internal = [c for c in scored.columns if c.startswith("__pw_") or c == PRED]
    return scored.drop(*internal)


def evaluate_model(model: PipelineModel, split_df: DataFrame, split_col: str = "split",
                   label: str = "price", log_target: bool = True) -> DataFrame:
    """(split, rmse, mse, r2, n) against the unclipped price, price scale."""
    scored = score_table(model, split_df, log_target, "__pred")
    return regression_metrics(scored, label, "__pred", split_col)


def feature_importance(model: PipelineModel, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """(feature, importance) descending; importances scaled to sum to 100.

    A stage's importances count by its weight times its share of the trees' weights. The
    vector has one entry per input column, so its size is bounded by the feature list, not
    by the data.
    """
    names = [*cfg.cat_features, *cfg.num_features]
    parts = [w * sum(gbt.treeWeights) * gbt.featureImportances.toArray() for w, gbt in boosted_stages(model)]
    values = sum(parts)
    values = values / (values.sum() or 1.0)
    rows = [(n, float(v) * 100.0) for n, v in zip(names, values.tolist())]
    session = SparkSession.getActiveSession()
    return (session.createDataFrame(rows, "feature string, importance double")
                   .orderBy(F.col("importance").desc(), "feature"))


def run_record(metrics: DataFrame, cfg: TrainConfig, *, checksum: str, start_time: int, end_time: int,
               run_id: str | None = None, model_class: str = "GBTRegressor") -> DataFrame:
    """One run row in the runs table's shape (run_id, status, start_time, end_time, metrics,
    params, tags), so that ranking, listing and serving read trained models like any other run.

    ``metrics`` is ``evaluate_model``'s result; metrics are named '{split}_{metric}'. The
    parameters hold the settings, the columns used and the raw data's checksum.
    Without a ``run_id`` it is derived from settings and checksum.
    """
    params = {"log_target": str(cfg.log_target).lower(), "model_class": model_class, "label": cfg.label,
              "cat_features": ",".join(cfg.cat_features), "num_features": ",".join(cfg.num_features),
              "max_iter": cfg.max_iter, "depth": cfg.depth, "learning_rate": cfg.step, "early_stop": cfg.early_stop,
              "stage_rounds": cfg.stage_rounds, "seed": cfg.seed, "clip_target_q": cfg.clip_target_q, "checksum": checksum}
    if run_id is None:
        run_id = hashlib.sha256(repr(sorted(params.items())).encode()).hexdigest()[:32]
    pairs = [F.lit(x) for k, v in params.items() for x in (k, str(v))]
    return metrics_record(metrics).agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")).select(
        F.lit(run_id).alias("run_id"), F.lit(FINISHED).alias("status"), F.lit(start_time).cast("bigint").alias("start_time"),
        F.lit(end_time).cast("bigint").alias("end_time"), "metrics", F.create_map(*pairs).alias("params"),
        F.create_map(F.lit("source"), F.lit("training")).alias("tags"))
