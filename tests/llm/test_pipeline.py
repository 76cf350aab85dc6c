"""The corpus pipeline, stage by stage against brute force."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from pricewise.llm import quality_gbt, queries
from pricewise.llm.common import stored
from tests.conftest import SF001
from tests.llm.test_corpus_operators import brute_components, brute_contamination, brute_print, word_bpe  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF001), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stage_order_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"]
    columns = spark.read.parquet(f"{SF001}/documents.parquet").dtypes
    assert all(after.dtypes == columns for name, (_, after) in stages.items() if name != "tokens")


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    model = quality_gbt.train(before, spark.read.parquet(f"{SF001}/labels.parquet"))
    want = {r.doc_id for r in quality_gbt.score(before, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == want


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    rows = [(r.doc_id, brute_print(r.text)) for r in before.collect()]
    want = sorted({c for _, _, c in brute_components(rows)})
    assert sorted(r.doc_id for r in after.collect()) == want and len(want) < len(rows)


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    rows = before.collect()
    items = [(str(r[0]), r[1]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = [r.doc_id for r, b in zip(rows, brute_contamination([r.text for r in rows], items)) if not b[-1]]
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert rows and all(texts[r.doc_id] == r.text for r in rows)


def test_token_stage(stages, word_bpe):  # noqa: F811
    before, after = stages["tokens"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = [(i, len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))
            for (i, _), ids in zip(rows, word_bpe([t for _, t in rows]))]
    got = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in after.collect())
    assert sorted((i, n, c) for _, n, i, c in got) == sorted(want)
    assert [s for s, *_ in got] == [0, *np.cumsum([n for _, n, *_ in got]).tolist()[:-1]]
    # the files keep a global shuffle: neither sorted by id nor copies side by side
    order = [i for _, _, i, _ in got]
    beside = sum(a == b for a, b in zip(order, order[1:]))
    assert order != sorted(order) and beside < (len(order) - len(set(order))) / 2


def test_run_is_registered(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF001).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted(f"op{i}" for i in range(1, 14))
