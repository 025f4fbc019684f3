"""Split properties: exact sizes, disjoint, complete, partition-independent,
quotas within one of proportional, and the error cases."""
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomkit.operators import splits as S


def _df(spark, labels):
    return spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id long, y string")


def _assign(df):
    return {r["id"]: r["split"] for r in df.collect()}


def test_partition_count_does_not_matter(spark):
    labels = ["a"] * 37 + ["b"] * 55 + ["c"] * 8
    base = _df(spark, labels)
    want = _assign(S.split_stratified(base, "y", keys=["id"], test_size=0.3, seed=7))
    for n in (1, 3, 17):
        got = _assign(S.split_stratified(base.repartition(n), "y", keys=["id"], test_size=0.3, seed=7))
        assert got == want


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(counts=st.lists(st.integers(min_value=2, max_value=40), min_size=1, max_size=5),
       test_size=st.sampled_from([0.1, 0.2, 0.25, 0.3, 0.5]))
def test_stratified_quotas(spark, counts, test_size):
    labels = [f"k{i}" for i, c in enumerate(counts) for _ in range(c)]
    n = len(labels)
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    df = _df(spark, labels)
    if n_train < len(counts) or n_test < len(counts):
        with pytest.raises(ValueError):
            S.split_stratified(df, "y", keys=["id"], test_size=test_size)
        return
    out = S.split_stratified(df, "y", keys=["id"], test_size=test_size).collect()
    assert len(out) == n and len({r["id"] for r in out}) == n            # complete, disjoint
    assert sum(r["split"] == "train" for r in out) == n_train            # exact size
    for i, c in enumerate(counts):                                       # within one of proportional
        tr = sum(r["split"] == "train" and r["y"] == f"k{i}" for r in out)
        assert abs(tr - c * n_train / n) < 1


def test_train_rows_are_first_in_hash_order(spark):
    import hashlib
    labels = ["a"] * 20 + ["b"] * 30
    out = _assign(S.split_stratified(_df(spark, labels), "y", keys=["id"], test_size=0.2, seed=42))
    for cls in ("a", "b"):
        ids = [i for i, y in enumerate(labels) if y == cls]
        ids.sort(key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
        parts = [out[i] for i in ids]
        k = parts.count("train")
        assert parts == ["train"] * k + ["test"] * (len(ids) - k)


def test_single_member_class_is_an_error(spark):
    with pytest.raises(ValueError, match="single row"):
        S.split_stratified(_df(spark, ["a"] * 5 + ["b"]), "y", keys=["id"])


def test_three_way_sizes(spark):
    df = spark.range(1000).withColumnRenamed("id", "id")
    out = S.split_three_way(df, keys=["id"], test_size=0.3, validation_size=0.1)
    c = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert c["test"] == 300
    # validation share of train: 0.1 / 0.7 of 700 -> ceil(100.00000000000001) = 101
    assert c["validation"] == math.ceil(0.1 / (1 - 0.3) * 700) == 101
    assert c["train"] == 599


@pytest.mark.parametrize("n", [5, 10, 100])
def test_tiny_tables(spark, n):
    df = spark.range(n)
    out = S.split_three_way(df, keys=["id"], test_size=0.3, validation_size=0.1)
    c = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    n_test = math.ceil(0.3 * n)
    assert c["test"] == n_test
    assert sum(c.values()) == n


def test_identical_rows_split_stably(spark):
    rows = [(1, "x")] * 6 + [(2, "y")] * 4
    df = spark.createDataFrame(rows, "a long, b string")
    a = sorted(tuple(r) for r in S.split_random(df, test_size=0.3).collect())
    b = sorted(tuple(r) for r in S.split_random(df.repartition(5), test_size=0.3).collect())
    assert a == b and len(a) == 10


def test_kfold_balanced(spark):
    labels = ["a"] * 30 + ["b"] * 12
    out = S.stratified_kfold(_df(spark, labels), "y", keys=["id"], k=3).collect()
    for cls, c in (("a", 30), ("b", 12)):
        per = [sum(1 for r in out if r["y"] == cls and r["fold"] == f) for f in range(3)]
        assert per == [c // 3] * 3


def test_task_type_threshold(spark):
    df = spark.createDataFrame([(i % 19, i % 20, float(i % 19), float("nan") if i % 2 else float(i % 20))
                                for i in range(200)], "a long, b long, c double, d double")
    t = {r["column_name"]: r["task_type"] for r in S.task_types(df).collect()}
    assert t == {"a": "classification", "b": "regression", "c": "classification", "d": "classification"}


def test_bernoulli_is_stateless(spark):
    df = spark.range(2000)
    a = _assign(S.split_bernoulli(df.withColumnRenamed("id", "id"), keys=["id"], test_size=0.25))
    assert abs(sum(v == "test" for v in a.values()) / 2000 - 0.25) < 0.05


def test_rank_in_groups_equals_row_number(spark):
    from pyspark.sql import Window
    # one hot group with most rows, several time buckets with ties
    rows = [("hot", i // 7, i) for i in range(300)] + [("cold", i % 3, i) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, t long, id long")
    got = S.rank_in_groups(df, ["g"], [F.col("t"), F.col("id")], F.floor(F.col("t") / 5), "r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(counts=st.lists(st.integers(min_value=3, max_value=30), min_size=1, max_size=4),
       parts=st.integers(min_value=1, max_value=9), k=st.integers(min_value=2, max_value=5))
def test_kfold_partition_independent(spark, counts, parts, k):
    labels = [f"k{i}" for i, c in enumerate(counts) for _ in range(c)]
    df = _df(spark, labels)
    a = {r["id"]: r["fold"] for r in S.stratified_kfold(df, "y", keys=["id"], k=k).collect()}
    b = {r["id"]: r["fold"] for r in S.stratified_kfold(df.repartition(parts), "y", keys=["id"], k=k).collect()}
    assert a == b
    for i, c in enumerate(counts):     # every fold within one of c / k
        per = [sum(1 for j, y in enumerate(labels) if y == f"k{i}" and a[j] == f) for f in range(k)]
        assert max(per) - min(per) <= 1


def test_null_labels_are_their_own_stratum(spark):
    labels = ["a"] * 20 + [None] * 10 + ["b"] * 10
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id long, y string")
    out = S.split_stratified(df, "y", keys=["id"], test_size=0.2).collect()
    assert len(out) == 40
    tr = {k: sum(1 for r in out if r["y"] == k and r["split"] == "train") for k in ("a", "b", None)}
    assert tr == {"a": 16, "b": 8, None: 8}
    folds = S.stratified_kfold(df, "y", keys=["id"], k=2).collect()
    assert sum(1 for r in folds if r["y"] is None and r["fold"] == 0) == 5


@pytest.mark.parametrize("label", [None, "y"])
def test_three_way_split_reads_its_input_twice(spark, tmp_path, label):
    """One scan for the narrow table, one for the result; nothing else touches the input."""
    path = str(tmp_path / "in")
    spark.createDataFrame([(i, "ab"[i % 2], "x" * 50) for i in range(500)], "id long, y string, wide string").write.parquet(path)
    reads = []
    plain = S._narrow
    try:
        S._narrow = lambda df, *a: reads.append(df) or plain(df, *a)
        out = S.split_three_way(spark.read.parquet(path), keys=["id"], label=label, test_size=0.2, validation_size=0.1)
    finally:
        S._narrow = plain
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(reads) == 1 and plan.count("wide#") >= 1
    assert sum(path.split("/")[-2] in x for x in out._jdf.queryExecution().executedPlan().toString().split("Location: ")) == 1
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 350, "test": 100, "validation": 50}


def test_repeated_rows_keep_exact_sizes(spark):
    """Rows without a key of their own: the cuts fall among equal rows."""
    df = spark.createDataFrame([("a",)] * 70 + [("b",)] * 30, "y string")
    for label in (None, "y"):
        out = S.split_three_way(df, label=label, test_size=0.2, validation_size=0.1, stratify=bool(label))
        assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 70, "test": 20, "validation": 10}
    by = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert by == {("a", "train"): 49, ("a", "test"): 14, ("a", "validation"): 7, ("b", "train"): 21, ("b", "test"): 6, ("b", "validation"): 3}


def test_a_class_without_training_rows_stays(spark):
    df = _df(spark, ["a"] * 2 + ["b"] * 48)
    out = S.split_three_way(df, label="y", keys=["id"], test_size=0.8, validation_size=0.1, stratify=True)
    assert out.count() == 50 and out.where("split = 'test'").count() == 40


def test_bernoulli_split_of_a_stream_after_a_restart(spark, tmp_path):
    """Files arrive, the stream is stopped and started again on its checkpoint; the parts equal the batch split's."""
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    schema = "id long, y string"

    def go():
        s = S.split_bernoulli(spark.readStream.schema(schema).parquet(src), keys=["id"], test_size=0.3, validation_size=0.1)
        q = s.writeStream.format("parquet").partitionBy("split").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    _df(spark, ["a"] * 300).write.mode("append").parquet(src)
    go()
    _df(spark, ["a"] * 700).where("id >= 300").write.mode("append").parquet(src)
    go()
    go()                                                                     # nothing new: nothing twice
    got = {r["id"]: r["split"] for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == 700
    assert got == _assign(S.split_bernoulli(_df(spark, ["a"] * 700), keys=["id"], test_size=0.3, validation_size=0.1))
