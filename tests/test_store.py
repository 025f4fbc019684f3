"""Appended run records, and models by name, version and alias."""
import json

import pytest
from pyspark.sql import functions as F

from loomkit.operators import models as M
from loomkit.operators import runs as R
from loomkit.operators import scoring as I
from loomkit.operators.store import ModelStore, RunStore


def _run(spark, run_id, **metrics):
    pairs = lambda d, t: spark.createDataFrame(list(d.items()), f"key string, value {t}")
    return R.log_run(1, run_id, f"2024-01-{run_id:02d} 00:00:00", pairs({"model_alias": "challenger"}, "string"),
                     pairs({"rows": "5"}, "string"), pairs(metrics, "double"))


def test_runs_are_appended_once(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    assert store.runs().count() == 0 and store.metrics().count() == 0
    assert store.append(_run(spark, 1, acc=0.5, f1=0.25))
    assert store.append(_run(spark, 2, acc=0.75))
    assert not store.append(_run(spark, 2, acc=0.75))                       # the same record again
    with pytest.raises(ValueError, match="other content"):
        store.append(_run(spark, 2, acc=0.9))
    with pytest.raises(ValueError, match="one run record"):
        store.append(_run(spark, 3, acc=0.9).union(_run(spark, 4, acc=0.9)))
    assert store.runs().count() == 2
    newest = R.latest_run(store.runs()).first()
    assert newest["run_id"] == 2 and newest["metrics"] == {"acc": 0.75} and newest["params"] == {"rows": "5"}
    assert {tuple(r) for r in store.metrics().collect()} == {(1, 1, "acc", 0.5), (1, 1, "f1", 0.25), (1, 2, "acc", 0.75)}
    lines = [json.loads(x) for f in (tmp_path / "metrics").rglob("*.json") for x in f.read_text().splitlines()]
    assert {(x["metric"], x["value"]) for x in lines if x["run_id"] == 1} == {("acc", 0.5), ("f1", 0.25)}


def test_a_record_that_was_broken_off_is_written_again(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    store.append(_run(spark, 1, acc=0.5))
    mark = next((tmp_path / "runs").rglob("_SUCCESS"))
    mark.unlink()
    assert store.append(_run(spark, 1, acc=0.5)) and store.runs().count() == 1


def test_models_resolve_by_version_alias_and_latest(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    one = I.linear_expression_model({"x": 2.0}, 1.0)
    two = I.NumpyLogisticModel(["x"], [1.0], 0.0)
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, y double")
    three = M.train_random_forest(df, ["x"], "y", n_estimators=3, max_depth=2)
    assert [store.register("m", m) for m in (one, two, three)] == [1, 2, 3]
    assert store.register("other", one, run_id=9) == 1
    store.set_alias("m", "champion", 2)
    store.set_alias("m", "Champion", 1)                                      # moved
    assert store.resolve("m")[:2] == (1, "expression") and store.resolve("m", "latest")[:2] == (3, "spark")
    assert store.resolve("m", "2")[:2] == (2, "python")
    assert isinstance(store.load("m", "2"), I.NumpyLogisticModel)
    with pytest.raises(ValueError, match="no model"):
        store.resolve("m", "staging")
    with pytest.raises(ValueError, match="no model"):
        store.resolve("none", "latest")
    with pytest.raises(ValueError, match="no version"):
        store.set_alias("m", "staging", 7)
    with pytest.raises(TypeError):
        store.register("m", object())
    src = str(tmp_path / "in.parquet")
    df.write.parquet(src)
    for spec, want in (("champion", [2.0 * i + 1 for i in range(20)]), ("2", [float(i >= 0) for i in range(20)])):
        out = I.score_file(spark, "m", src, str(tmp_path / f"out-{spec}.parquet"), store=store, version=spec)
        assert [r.prediction for r in out.orderBy("x").collect()] == want
    forest = I.score_file(spark, "m", src, str(tmp_path / "out.parquet"), store=store, version="latest")
    assert forest.columns == ["x", "y", "prediction", "prob_class_0", "prob_class_1"] and forest.count() == 20
    with pytest.raises(ValueError, match="store"):
        I.score_file(spark, "m", src, str(tmp_path / "none.parquet"))


def test_python_scoring_leaves_the_session_alone(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = spark.range(2500).select(F.col("id").cast("double").alias("x")).coalesce(1)

    class Sizes:
        def predict(self, x):
            return [len(x)] * len(x)

    out = I.predict_batch_udf(sizes, Sizes(), ["x"], num_classes=0, batch_size=1000)
    assert {r.prediction for r in out.collect()} == {1000.0, 500.0}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_class_count_comes_from_the_model(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(30)], "x double, y double")
    model = M.train_random_forest(df, ["x"], "y", n_estimators=2, max_depth=2)
    failing = df.withColumn("x", F.raise_error(F.lit("the input was read")).cast("double"))
    assert I.predict_batch(model, failing).columns == ["prediction", "prob_class_0", "prob_class_1", "prob_class_2"]
