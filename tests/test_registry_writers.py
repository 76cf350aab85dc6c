"""The stored registry under several writers."""

from concurrent.futures import ThreadPoolExecutor

from pricewise.session import list_names
from pricewise.sources import registry as R


def test_concurrent_ingests_of_one_checksum(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")
    built = []

    def run(i):
        def build():
            built.append(i)
            return spark.range(100)
        return R.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/gold", f"{tmp_path}/reg", build)

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(run, range(4)))
    assert built and {g[0].count() for g in got} == {100} and len({g[1] for g in got}) == 1
    assert R.read_registry(spark, f"{tmp_path}/reg").count() == 1
    assert len(list_names(spark, f"{tmp_path}/gold")) == 1
    again = run(9)
    assert not again[2] and 9 not in built


def test_writers_of_different_datasets_lose_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "COMPACT_EVERY", 4)
    path = f"{tmp_path}/reg"
    names = [f"h{i % 7}" for i in range(14)]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: R.register_dataset(spark, path, names[i], f"{names[i]}-{i}"), range(14)))
    rows = {r["hash"]: r.table_name for r in R.read_registry(spark, path).collect()}
    assert set(rows) == set(names) and all(rows[n] == g for n, g in zip(names, got))
    latest = R.latest_dataset(R.read_registry(spark, path)).first()
    assert latest.table_name in rows.values() and latest.inserted_at is not None


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "COMPACT_EVERY", 3)
    path = f"{tmp_path}/reg"
    assert R.read_registry(spark, path).count() == 0
    for i in range(10):
        R.register_dataset(spark, path, f"h{i}", f"t{i}")
    assert R.read_registry(spark, path).count() == 10
    assert len(list_names(spark, f"{path}/commits")) <= 6 and len(list_names(spark, f"{path}/snapshots")) <= 2
    assert R.register_dataset(spark, path, "h2", "other") == "t2"
    assert not list_names(spark, f"{path}/drafts")


def test_runs_table_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/runs"
    runs = spark.createDataFrame([("12e4", {"r2": 0.5}, {"depth": "8"}), ("a/b", {"r2": 0.1}, {"depth": "6"})],
                                 "run_id string, metrics map<string,double>, params map<string,string>")
    one, two = runs.where("run_id = '12e4'"), runs.where("run_id = 'a/b'")
    assert R.read_runs(spark, path, runs.schema).count() == 0
    with ThreadPoolExecutor(3) as pool:
        added = list(pool.map(lambda r: R.append_run(spark, path, r), [one, one, two]))
    assert sorted(added) == [False, True, True] and not R.append_run(spark, path, two)
    got = {r.run_id: (r.metrics["r2"], r.params["depth"]) for r in R.read_runs(spark, path, runs.schema).collect()}
    assert got == {"12e4": (0.5, "8"), "a/b": (0.1, "6")}
