"""Sources, sinks, scoring and the stream."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from loomkit.operators import scoring as I
from loomkit.sources import files as FS
from loomkit.sources import jdbc as J
from tests.conftest import SF001


def test_format_detection():
    assert FS.detect_format("/a/b.PQ") == "parquet" and FS.detect_format("x.csv") == "csv"
    with pytest.raises(ValueError, match="Supported"):
        FS.detect_format("x.xlsx")


def test_write_formats(spark):
    d = tempfile.mkdtemp(prefix="lk-test-")
    with pytest.raises(ValueError):
        FS.write_table(spark.range(3), os.path.join(d, "a"), "avro")


def test_jdbc_needs_table_or_query(spark):
    with pytest.raises(ValueError, match="either"):
        J.read_jdbc(spark, "jdbc:derby:memory:x;create=true")


def test_snapshot_keyed_by_query(spark):
    base = tempfile.mkdtemp(prefix="lk-snap-")
    a = J.snapshot_cache(spark, base, "src", lambda: spark.range(3), query="q1")
    b = J.snapshot_cache(spark, base, "src", lambda: spark.range(5), query="q2")
    c = J.snapshot_cache(spark, base, "src", lambda: spark.range(9), query="q1")
    assert (a.count(), b.count(), c.count()) == (3, 5, 3)


def test_query_hash_matches_hashlib(spark):
    import hashlib
    q = "SELECT * FROM users WHERE active=true"
    got = spark.range(1).select(J.query_hash(F.lit(q)).alias("h")).first()["h"]
    assert got == hashlib.sha256(q.encode()).hexdigest()[:16] == J.query_hash_text(q)


def test_udf_model_equals_expression_model(spark):
    df = spark.read.parquet(f"{SF001}/customer.parquet").withColumn("x", F.col("c_acctbal") / 1000)
    expr = I.logistic_expression_model({"x": 0.8}, -1.0)
    a = {r["c_custkey"]: r for r in I.predict_with_inputs(expr, df).collect()}
    m = I.NumpyLogisticModel(["x"], [0.8], -1.0)
    b = I.predict_batch_udf(df, m, ["x"], keep=["c_custkey"], batch_size=7).collect()
    assert len(b) == len(a)
    for r in b:
        assert r["prediction"] == a[r["c_custkey"]]["prediction"]
        assert abs(r["prob_class_1"] - a[r["c_custkey"]]["prob_class_1"]) < 1e-12


def test_stream_equals_batch_and_restarts(spark):
    from loomkit.streaming.scoring import run_score_stream
    src = tempfile.mkdtemp(prefix="lk-src-")
    out = tempfile.mkdtemp(prefix="lk-out-")
    part = spark.read.parquet(f"{SF001}/part.parquet")
    part.where("p_partkey < 100").write.mode("append").parquet(src)
    model = I.linear_expression_model({"p_partkey": 0.05}, 900.0)
    r1 = run_score_stream(spark, src, part.schema, model, "m1", f"{out}/o", f"{out}/ck", keep=["p_partkey"])
    assert r1.count() == 100
    part.where("p_partkey >= 100").write.mode("append").parquet(src)
    r2 = run_score_stream(spark, src, part.schema, model, "m1", f"{out}/o", f"{out}/ck", keep=["p_partkey"])
    batch = I.predict_with_inputs(model, part).select("p_partkey", "prediction")
    assert r2.count() == part.count()      # restart resumed: nothing scored twice
    assert r2.select("p_partkey", "prediction").exceptAll(batch).count() == 0


def test_spark_ml_model_columns(spark):
    from loomkit.operators import models as M
    df = spark.read.parquet(f"{SF001}/customer.parquet").withColumn(
        "y", (F.col("c_acctbal") > 4000).cast("int"))
    m = M.train_random_forest(df, ["c_acctbal", "c_mktsegment"], "y", n_estimators=5, max_depth=3)
    out = I.predict_batch(m, df, num_classes=2)
    assert out.columns == ["prediction", "prob_class_0", "prob_class_1"]
    assert out.count() == df.count()


def test_stream_with_array_requests(spark):
    """Requests as array<double> rows (the online call's shape) on a stream."""
    from loomkit.streaming.scoring import request_features, score_stream
    src = tempfile.mkdtemp(prefix="lk-req-")
    spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(20)], "req_id long, features array<double>") \
        .write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    stream = request_features(spark.readStream.schema(schema).parquet(src), "features", ["a", "b"])
    model = I.linear_expression_model({"a": 1.0, "b": 0.5}, 1.0)
    q = (score_stream(stream, model, "m-req", keep=["req_id"]).writeStream.format("memory")
         .queryName("lk_requests").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["req_id"]: (r["prediction"], r["model_id"]) for r in spark.sql("select * from lk_requests").collect()}
    assert got == {i: (1.0 + i + i, "m-req") for i in range(20)}


def test_pipeline_with_arrays_saves_and_loads(spark):
    from pyspark.ml import PipelineModel

    from loomkit.operators import models as M
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    m = M.train_kmeans(e, ["embedding"], k=3, max_iter=5, n_init=1)
    path = tempfile.mkdtemp(prefix="lk-model-") + "/km"
    m.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = m.transform(e).select("vec_id", "cluster").collect()
    b = back.transform(e).select("vec_id", "cluster").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_bernoulli_split_on_a_stream_equals_batch(spark):
    from loomkit.operators.splits import split_bernoulli
    src = tempfile.mkdtemp(prefix="lk-bern-")
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "value")
    ev.write.mode("append").parquet(src)
    stream = split_bernoulli(spark.readStream.schema(ev.schema).parquet(src), keys=["event_id"],
                             test_size=0.2, validation_size=0.1)
    q = stream.writeStream.format("memory").queryName("lk_bern").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["event_id"]: r["split"] for r in spark.sql("select * from lk_bern").collect()}
    want = {r["event_id"]: r["split"] for r in split_bernoulli(ev, keys=["event_id"], test_size=0.2,
                                                                 validation_size=0.1).collect()}
    assert got == want and len(got) == ev.count()


def test_score_file_keeps_csv(spark):
    d = tempfile.mkdtemp(prefix="lk-csv-")
    part = spark.read.parquet(f"{SF001}/part.parquet").select("p_partkey", "p_size")
    FS.write_table(part, f"{d}/in.csv", "csv")
    model = I.linear_expression_model({"p_size": 2.0}, 1.0)
    out = I.score_file(spark, model, f"{d}/in.csv", f"{d}/out.csv")
    assert set(out.columns) == {"p_partkey", "p_size", "prediction"}
    rows = out.collect()
    assert len(rows) == part.count() and all(abs(r["prediction"] - (1.0 + 2.0 * r["p_size"])) < 1e-9 for r in rows)
    assert FS.detect_format(f"{d}/out.csv") == "csv"
