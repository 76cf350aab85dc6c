import dataclasses
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pricewise.operators import model as MD
from pricewise.operators.serving import build_lookup_tables, route_requests, score_requests, serving_features
from pricewise.plans import tables as T
from pricewise.plans.catalog import engineered
from pricewise.session import scratch_path, stored
from pricewise.streaming.scoring import read_request_stream, start_scoring
from tests.conftest import SF001, rows

CFG = MD.TrainConfig(max_iter=5, depth=3)


@pytest.fixture(scope="module")
def fitted(spark):
    eng = engineered(spark, SF001)
    from pricewise.operators.split import stratified_split
    parts = stored(stratified_split(eng, "transaction_id", "price"), "test-split")
    model = MD.train_price_model(parts.where("split = 'train'"), parts.where("split = 'validation'"), CFG)
    return eng, parts, model


def test_train_score_evaluate(spark, fitted):
    eng, parts, model = fitted
    scored = MD.score_table(model, parts.where("split = 'test'"))
    assert scored.where(F.col("predicted_price").isNull()).count() == 0
    assert set(scored.columns) == set(parts.columns) | {"predicted_price"}
    ev = {r.split: r for r in MD.evaluate_model(model, parts).collect()}
    assert set(ev) == {"train", "validation", "test"} and all(r.rmse > 0 for r in ev.values())
    imp = MD.feature_importance(model, CFG).collect()
    assert len(imp) == 13 and abs(sum(r.importance for r in imp) - 100.0) < 1e-6


def test_known_signal_is_learned_and_recorded(spark):
    rows = [(i, "AB"[i % 2], "N" if i % 3 else "Y", 100_000.0 * (1 + i % 2) * (2 if i % 3 == 0 else 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, kind string, new string, price double")
    cfg = MD.TrainConfig(cat_features=("kind", "new"), num_features=(), max_iter=40, depth=3, step=0.1, clip_target_q=1.0)
    model = MD.train_price_model(df, cfg=cfg)
    for r in MD.score_table(model, df).collect():
        assert r.predicted_price == pytest.approx(r.price, rel=0.2)
    metrics = MD.evaluate_model(model, df.withColumn("split", F.lit("train")))
    assert metrics.first().r2 > 0.95
    imp = {r.feature: r.importance for r in MD.feature_importance(model, cfg).collect()}
    assert imp["kind"] > 10 and imp["new"] > 10
    run = MD.run_record(metrics, cfg, checksum="abc", start_time=1, end_time=2).first()
    assert run.params["checksum"] == "abc" and run.params["cat_features"] == "kind,new" and run.params["depth"] == "3"
    assert set(run.metrics) == {"train_rmse", "train_mse", "train_r2"} and run.status == "FINISHED"


def _signal(spark, n, noise):
    """Rows whose price is a step function of two columns times e^(noise * a fixed pseudo-random number)."""
    u = F.pmod(F.xxhash64(F.col("id")), F.lit(10_000)) / 10_000 - 0.5
    return (spark.range(n).withColumn("kind", F.concat(F.lit("k"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))))
            .withColumn("size", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)).cast("double"))
            .withColumn("price", 1e5 * F.exp(F.when(F.col("kind") == "k0", 1.0).otherwise(0.0) + F.col("size") / 50 + noise * u)))


def test_stages_reach_what_one_fit_reaches(spark):
    df = stored(_signal(spark, 1200, 0.05).withColumn("split", F.when(F.col("id") % 3 == 0, "validation").otherwise("train")), "signal")
    train, val = df.where("split = 'train'"), df.where("split = 'validation'")
    one = MD.TrainConfig(cat_features=("kind",), num_features=("size",), depth=4, step=0.1, clip_target_q=1.0, max_iter=24, stage_rounds=24)
    many = dataclasses.replace(one, stage_rounds=6)
    models = {n: MD.train_price_model(train, val, c) for n, c in (("one", one), ("many", many))}
    pred = [{r.id: r.predicted_price for r in MD.score_table(m, df).collect()} for m in models.values()]
    assert all(pred[1][i] == pytest.approx(p, rel=0.08) for i, p in pred[0].items())
    for m in models.values():
        assert all(r.r2 > 0.95 for r in MD.evaluate_model(m, df).collect())
    assert len(MD.boosted_stages(models["one"])) == 1


def test_stages_continue_while_they_gain_and_the_model_survives_saving(spark):
    df = stored(_signal(spark, 800, 0.0), "signal")
    cfg = MD.TrainConfig(cat_features=("kind",), num_features=("size",), depth=2, step=0.1, clip_target_q=1.0,
                         max_iter=12, stage_rounds=3)
    model = MD.train_price_model(df, cfg=cfg)
    stages = MD.boosted_stages(model)
    assert len(stages) > 1 and all(w in cfg.stage_weights for w, _ in stages)
    assert sum(len(g.trees) for _, g in stages) <= 12
    err = lambda m: MD.evaluate_model(m, df.withColumn("split", F.lit("all"))).first().rmse
    assert err(model) < 0.75 * err(MD.train_price_model(df, cfg=dataclasses.replace(cfg, max_iter=3)))
    assert {r.feature for r in MD.feature_importance(model, cfg).collect() if r.importance > 5} == {"kind", "size"}
    path = scratch_path(spark, "model")
    model.save(path)
    again = PipelineModel.load(path)
    assert [w for w, _ in MD.boosted_stages(again)] == [w for w, _ in stages]
    assert rows(MD.score_table(again, df)) == rows(MD.score_table(model, df))


def test_trees_are_grown_over_cells_and_equal_those_of_the_rows(spark, monkeypatch):
    df = stored(_signal(spark, 6000, 0.5).withColumn("split", F.when(F.col("id") % 3 == 0, "validation").otherwise("train")), "signal")
    train, val = df.where("split = 'train'"), df.where("split = 'validation'")
    cfg = MD.TrainConfig(cat_features=("kind",), num_features=("size",), depth=2, step=0.1, clip_target_q=1.0, max_iter=6, stage_rounds=3)
    seen, fit = [], MD.DecisionTreeRegressor.fit
    monkeypatch.setattr(MD.DecisionTreeRegressor, "fit", lambda self, d: seen.append(d.count()) or fit(self, d))
    monkeypatch.setattr(MD, "STORE_ROUNDS", 2)
    cells = MD.train_price_model(train, val, cfg)
    assert seen and max(seen) <= 200 < train.count() / 10   # 4 kinds x 50 sizes
    monkeypatch.setattr(MD, "LABELS_PER_ROW", 7)   # a cell of many labels has several rows
    parts = MD.train_price_model(train, val, cfg)
    assert max(seen) > 200
    seen.clear()
    monkeypatch.setattr(MD, "ROWS_PER_CELL", 10 ** 9)
    plain = MD.train_price_model(train, val, cfg)
    assert not seen
    shape = lambda m: [(w, list(g.treeWeights), [t.numNodes for t in g.trees]) for w, g in MD.boosted_stages(m)]
    want = {r.id: r.predicted_price for r in MD.score_table(plain, df).collect()}
    for m in (cells, parts):
        assert shape(m) == shape(plain)
        assert all(r.predicted_price == pytest.approx(want[r.id], rel=1e-9) for r in MD.score_table(m, df).collect())


def test_equal_rows_are_trained_as_weighted_pairs_and_give_the_trees_of_the_rows(spark, monkeypatch):
    once = _signal(spark, 900, 0.5).withColumn("size", F.col("id").cast("double"))   # one label a cell
    df = stored(once.withColumn("split", F.when(F.col("id") % 3 == 0, "validation").otherwise("train"))
                .withColumn("copy", F.explode(F.sequence(F.lit(0), F.pmod(F.col("id"), F.lit(5)) + 1))), "copies")
    train, val = df.where("split = 'train'"), df.where("split = 'validation'")
    cfg = MD.TrainConfig(cat_features=("kind",), num_features=("size",), depth=2, step=0.1, clip_target_q=1.0, max_iter=6, stage_rounds=3)
    seen, fit = [], MD.GBTRegressor.fit
    monkeypatch.setattr(MD.GBTRegressor, "fit", lambda self, d: seen.append((d.count(), d.rdd.getNumPartitions())) or fit(self, d))
    pairs = MD.train_price_model(train, val, cfg)
    assert seen and set(seen) == {(900, 1)} and df.count() > 3 * 900
    monkeypatch.setattr(MD, "ROWS_PER_CELL", 10 ** 9)
    plain = MD.train_price_model(train, val, cfg)
    assert seen[-1][0] == df.count()
    shape = lambda m: [(w, list(g.treeWeights), [t.numNodes for t in g.trees]) for w, g in MD.boosted_stages(m)]
    want = {r.id: r.predicted_price for r in MD.score_table(plain, df).collect()}
    assert shape(pairs) == shape(plain)
    assert all(r.predicted_price == pytest.approx(want[r.id], rel=1e-9) for r in MD.score_table(pairs, df).collect())


def test_equal_inputs_pass_the_trees_once_and_every_row_gets_its_price(spark, monkeypatch):
    clean = stored(_signal(spark, 3000, 0.5), "signal")
    df = stored(clean.withColumn("kind", F.when(F.col("id") % 7 > 0, F.col("kind")))
                .withColumn("size", F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).when(F.col("id") % 13 > 0, F.col("size"))), "odd")
    cfg = MD.TrainConfig(cat_features=("kind",), num_features=("size",), depth=3, step=0.1, clip_target_q=1.0, max_iter=3)
    model = MD.train_price_model(clean, cfg=cfg)
    want = {r.id: r for r in model.transform(df).withColumn("predicted_price", F.expm1("prediction")).select(*df.columns, "predicted_price").collect()}
    seen, transform = [], PipelineModel.transform
    monkeypatch.setattr(PipelineModel, "transform", lambda self, d: seen.append(d.count()) or transform(self, d))
    scored = MD.score_table(model, df)
    assert sum(seen) <= 5 * 52 < df.count() / 10   # 4 kinds and none x 50 sizes, NaN and none
    assert scored.columns == [*df.columns, "predicted_price"]
    got = scored.collect()
    assert len(got) == 3000 and {repr(r) for r in got} == {repr(r) for r in want.values()}
    assert not any(r.predicted_price is None for r in got)
    assert MD.score_table(model, df.limit(0)).count() == 0


def test_noise_is_not_learned(spark):
    u = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10_000)) / 10_000
    df = stored(_signal(spark, 900, 0.0).withColumn("price", 1e5 * (1 + 4 * u))
                .withColumn("split", F.element_at(F.array(F.lit("train"), F.lit("validation"), F.lit("test")), (F.col("id") % 3 + 1).cast("int"))), "noise")
    cfg = MD.TrainConfig(cat_features=("kind",), num_features=("size",))
    model = MD.train_price_model(df.where("split = 'train'"), df.where("split = 'validation'"), cfg)
    got = {r.split: r.r2 for r in MD.evaluate_model(model, df).collect()}
    assert got["validation"] > -0.2 and got["test"] > -0.2


def test_source_settings_and_many_categories(spark):
    cfg = MD.TrainConfig()
    assert (cfg.depth, cfg.step, cfg.max_iter) == (8, 0.05, 4000) and "sold_month" in cfg.cat_features
    assert sorted([*cfg.cat_features, *cfg.num_features]) == sorted(MD.MODEL_COLUMNS)
    df = spark.createDataFrame([(f"c{i % 165}", 100.0 + i % 165) for i in range(660)], "kind string, price double")
    small = MD.TrainConfig(cat_features=("kind",), num_features=(), max_iter=2, depth=2)
    assert MD.score_table(MD.train_price_model(df, cfg=small), df).where("predicted_price is null").count() == 0


def test_serving_categories_are_training_categories(spark, fitted):
    eng, _parts, _model = fitted
    req = T.requests_table(spark, SF001)
    accepted, _ = route_requests(req, T.postcode_directory(spark, SF001), allowed_types=T.PROPERTY_TYPES)
    served = serving_features(accepted, build_lookup_tables(eng), eng.select(F.max("date")).scalar())
    # districts outside the filtered training county are unknown by design
    for c in ("property_type", "is_new_build", "is_leasehold", "sold_month"):
        values = {r[0] for r in served.select(c).distinct().collect()}
        assert values <= {r[0] for r in eng.select(c).distinct().collect()}, c


def test_serving_features_order_and_fallback(spark, fitted):
    eng, _parts, _model = fitted
    lk = build_lookup_tables(eng)
    req = spark.createDataFrame([(1, "NATION_1", "A", "Y", "N"), (2, "ATLANTIS", "B", "N", "Y")],
                                "request_id int, district string, property_type string, is_new_build string, is_leasehold string")
    as_of = eng.select(F.max("date")).scalar()
    out = serving_features(req, lk, as_of, keep=("request_id",))
    assert out.columns == ["request_id", *MD.MODEL_COLUMNS]
    got = {r.request_id: r for r in out.collect()}
    g = lk.global_median()
    gval = eng.sparkSession.range(1).select(g.alias("g")).first().g
    assert got[2].borough_price_trend == gval and got[2].district_yearly_medians == gval
    assert got[2].property_type_and_tenure == "L_B"   # Y/N flag rendered as training's tenure code
    assert got[1].advanced_property_type == "Y_A"


def _run(spark, log_target="true"):
    params = "map('model_class', 'GBTRegressor')" if log_target is None else f"map('log_target', '{log_target}')"
    return spark.sql(f"SELECT 'abcdef0123456789' AS run_id, {params} AS params")


def test_score_requests_and_rejections(spark, fitted):
    eng, _parts, model = fitted
    req = T.requests_table(spark, SF001)
    args = (req, T.postcode_directory(spark, SF001), build_lookup_tables(eng), model, eng.select(F.max("date")).scalar())
    responses, rejected = score_requests(*args, _run(spark), allowed_types=T.PROPERTY_TYPES)
    n_ok, n_bad = responses.count(), rejected.count()
    assert n_ok + n_bad == req.count() and n_ok > 0 and n_bad > 0
    r = responses.orderBy("request_id").first()
    lo, hi = r.confidence_interval
    assert lo == pytest.approx(0.9 * r.predicted_price, abs=0.01) and hi == pytest.approx(1.1 * r.predicted_price, abs=0.01)
    assert r.run_id == "abcdef0123456789" and r.model_version == "gbt_model:abcdef01"
    assert r.features_used.user_provided == ["is_leasehold", "is_new_build", "postcode", "property_type"]
    assert len(r.features_used.enriched) == 10 and r.features_used.defaulted == []
    # the run says whether the target was logged; without a word it was
    plain = score_requests(*args, _run(spark, "false"), allowed_types=T.PROPERTY_TYPES)[0].orderBy("request_id").first()
    assert math.expm1(plain.predicted_price) == pytest.approx(r.predicted_price, rel=0.02)
    same = score_requests(*args, _run(spark, None), allowed_types=T.PROPERTY_TYPES)[0].orderBy("request_id").first()
    assert same.predicted_price == r.predicted_price
    reasons = {x.reject_reason for x in rejected.select("reject_reason").distinct().collect()}
    assert "unknown postcode" in reasons


def test_streaming_scoring_matches_batch(spark, fitted, tmp_path):
    eng, _parts, model = fitted
    src = scratch_path(spark, "req-in")
    T.requests_table(spark, SF001).repartition(3).write.parquet(src)
    stream = read_request_stream(spark, src, max_files_per_trigger=1)
    out, ckpt = scratch_path(spark, "req-out"), scratch_path(spark, "req-ckpt")
    static = (T.postcode_directory(spark, SF001), build_lookup_tables(eng), model, eng.select(F.max("date")).scalar(), _run(spark))
    q = start_scoring(stream, *static, out, ckpt, allowed_types=T.PROPERTY_TYPES)
    q.awaitTermination(300)
    for name, want in zip(("responses", "rejected"),
                          score_requests(T.requests_table(spark, SF001), *static, allowed_types=T.PROPERTY_TYPES)):
        assert rows(spark.read.parquet(f"{out}/{name}").drop("batch")) == rows(want)


def test_a_model_worse_than_the_mean_is_reported_so(spark, monkeypatch):
    from pricewise.plans import q_model
    metrics = spark.createDataFrame([("a", 9, 2.0, 4.0, 0.5), ("b", 9, 2.0, 4.0, -0.5)], "split string, n long, rmse double, mse double, r2 double")
    monkeypatch.setattr(q_model, "fitted", lambda *_: (None, None, metrics))
    got = {r.split: r.better_than_mean for r in q_model.q_evaluate_rows(spark, "").collect()}
    assert got == {"a": True, "b": False}
