"""Invariants of fits and searches (their numbers depend on the learner)."""
import pytest
from pyspark.sql import functions as F

from loomkit.operators import models as M
from loomkit.operators import tuning as H
from loomkit.plans.tables import quality_view, table
from tests.conftest import SF001

FEATS = ["letter_share", "n_chars", "lang"]


@pytest.fixture(scope="module")
def train(spark):
    return quality_view(spark, SF001).withColumn("quality", F.col("quality").cast("double")).persist()


def _make(df):
    def make(p):
        return M.random_forest_pipeline(df, FEATS, "quality", n_estimators=int(p["n_estimators"]),
                                        max_depth=int(p["max_depth"]))
    return make


def test_grid_search_ranks_every_trial(spark, train):
    space = {"n_estimators": [3, 5], "max_depth": [2, 3], "min_samples_split": [2, 5]}
    s = H.grid_search(train, space, _make(train), "quality", k=3, keys=["doc_id"]).collect()
    assert len(s) == 8 and sorted(r["rank"] for r in s) == list(range(1, 9))
    assert all(0.0 <= r["mean_test_score"] <= 1.0 and r["n_folds"] == 3 for r in s)
    # min_samples_split has no Spark counterpart: trials differing only there score the same
    by = {}
    for r in s:
        by.setdefault((r["n_estimators"], r["max_depth"]), set()).add(round(r["mean_test_score"], 12))
    assert all(len(v) == 1 for v in by.values())
    best = H.best_params(spark.createDataFrame(s))
    assert set(best) == set(space)


def test_random_and_adaptive_trial_counts(spark, train):
    rng = {"n_estimators": (2, 6), "max_depth": (2, 4)}
    r = H.random_search(train, rng, _make(train), "quality", n_trials=4, k=2, keys=["doc_id"]).collect()
    assert sorted(x["trial_id"] for x in r) == [0, 1, 2, 3]
    a = H.adaptive_search(train, rng, _make(train), "quality", n_trials=5, n_startup=3, batch=2, k=2,
                          keys=["doc_id"]).collect()
    assert sorted(x["trial_id"] for x in a) == [0, 1, 2, 3, 4]
    assert all(2 <= int(x["n_estimators"]) < 6 for x in a)


def test_kmeans_keeps_lowest_cost(spark):
    e = table(spark, SF001, "embeddings")
    m = M.train_kmeans(e, ["embedding"], k=3, max_iter=20, n_init=3)
    clusters = {r["cluster"] for r in m.transform(e).select("cluster").collect()}
    assert clusters <= {0, 1, 2}
    costs = []
    for i in range(3):
        costs.append(M.train_kmeans(e, ["embedding"], k=3, max_iter=20, seed=42 + i, n_init=1)
                     .stages[-1].summary.trainingCost)
    assert abs(m.stages[-1].summary.trainingCost - min(costs)) < 1e-9


def test_final_evaluation_scores_held_out_parts(spark, train):
    from loomkit.operators.splits import split_three_way
    s = split_three_way(train, keys=["doc_id"], label="quality", test_size=0.2, validation_size=0.1)
    out = H.final_evaluation(s, {"n_estimators": 3, "max_depth": 2}, _make(train), "quality").collect()
    assert {r["split"] for r in out} == {"test", "validation"}


def test_rows_in_are_rows_out_and_ragged_arrays_are_refused(spark):
    good = spark.createDataFrame([(i, [float(i % 3), float(i)]) for i in range(10)], "id long, f array<double>")
    assert M.train_kmeans(good, ["f"], k=2, max_iter=5, n_init=1).transform(good).count() == 10
    for odd in ([1.0], None):
        bad = good.unionByName(spark.createDataFrame([(99, odd)], good.schema))
        with pytest.raises(ValueError, match="different lengths"):
            M.train_kmeans(bad, ["f"], k=2)
    model = M.train_kmeans(good, ["f"], k=2, max_iter=5, n_init=1)
    with pytest.raises(Exception):  # at scoring too a row is never dropped
        model.transform(good.unionByName(spark.createDataFrame([(99, [1.0])], good.schema))).select("cluster").collect()


def test_mlp_takes_array_features(spark):
    df = spark.createDataFrame([(i, [float(i % 2), float(i), 1.0], float(i % 2)) for i in range(40)], "id long, f array<double>, y double")
    m = M.train_mlp(df, ["f"], "y", hidden=(4,), max_iter=20)
    assert m.transform(df).count() == 40


def test_forest_defaults():
    assert M.forest_params()["featureSubsetStrategy"] == "sqrt"
    assert M.forest_params(max_features=None)["featureSubsetStrategy"] == "all"


@pytest.mark.parametrize("metric,cols", [("f1", {"split", "precision", "recall", "support", "f1"}), ("accuracy", {"split", "accuracy", "n_rows"})])
def test_final_evaluation_returns_the_metric_asked_for(spark, train, metric, cols):
    from loomkit.operators.splits import split_three_way
    s = split_three_way(train, keys=["doc_id"], label="quality", test_size=0.2, validation_size=0.1)
    out = H.final_evaluation(s, {"n_estimators": 3, "max_depth": 2}, _make(train), "quality", metric=metric)
    assert set(out.columns) == cols


def test_directions_follow_the_metric_table():
    assert H.higher_better("accuracy") and H.higher_better("r2")
    assert not H.higher_better("rmse") and not H.higher_better("mae")


def test_adaptive_search_takes_choices(spark, train):
    space = {"n_estimators": (2, 6), "max_depth": [2, 3]}
    a = H.adaptive_search(train, space, _make(train), "quality", n_trials=6, n_startup=2, batch=2, n_candidates=5, k=2, keys=["doc_id"]).collect()
    assert sorted(x["trial_id"] for x in a) == list(range(6)) and {x["max_depth"] for x in a} <= {"2", "3"}


@pytest.mark.parametrize("name", ["grid_search", "final_evaluation"])
def test_registered_searches_run_the_default_grid(spark, monkeypatch, name):
    from loomkit.plans.catalog import QUERIES
    seen = []

    def scored(df, trials, *a, **kw):                                        # stands in for the 675 fits
        rows = trials.collect()
        seen.extend(rows)
        return spark.createDataFrame([(r.trial_id, f, float(r.trial_id == 0), 1.0) for r in rows for f in range(3)],
                                     "trial_id long, fold long, test_score double, train_score double")

    monkeypatch.setattr(H, "cross_validate", scored)
    QUERIES[name](spark, SF001).collect()
    want = {tuple(r)[1:] for r in H.param_grid(spark, H.DEFAULT_RF_SPACE).collect()}
    assert len(seen) == 675 and {tuple(r)[1:] for r in seen} == want
    params = [{n: H._parse(v) for n, v in r.asDict().items() if n != "trial_id"} for r in seen]
    assert len({H.fit_key(p) for p in params}) == 225


def test_forest_inputs_are_spread_by_their_work(spark, monkeypatch):
    """A few bytes a row, but met once a tree on every level: one partition was one core for the whole fit."""
    df = spark.range(90).select("id", (F.col("id") % 7).cast("double").alias("x")).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(M, "PAIRS_PER_PARTITION", 100)
    places = []
    for _ in range(2):
        with M.cached(df, 10) as d:
            places.append(d.rdd.glom().collect())
            assert d.rdd.getNumPartitions() == min(9, cores)
    assert places[0] == places[1] and sorted(r.id for p in places[0] for r in p) == list(range(90))
    monkeypatch.setattr(M, "MOST_PAIRS", 900 // (cores + 3))                 # bounded per partition beyond the cores
    with M.cached(df, 10) as d:
        assert d.rdd.getNumPartitions() >= cores + 3
    with M.cached(df) as d:
        assert d.rdd.getNumPartitions() == 1


def test_forests_keep_the_nodes_of_rows_and_cache_what_they_read(spark, monkeypatch):
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([(i, "long text", float(i % 5), float(i * 7 % 11)) for i in range(60)], "id long, s string, x double, y double")
    assert M.forest_params()["cacheNodeIds"]
    rf = M.RandomForestRegressor(featuresCol="features", labelCol="y", **M.forest_params(5, 6, max_features=None))
    stages = M.assemble_features(df, ["x"], "y")
    trees = [Pipeline(stages=[*stages, rf.copy({rf.cacheNodeIds: on})]).fit(df).stages[-1].toDebugString for on in (True, False)]
    assert trees[0].split("\n")[1:] == trees[1].split("\n")[1:]
    seen, real = [], M.cached

    def looked_at(d, trees=0):
        seen.append((d.columns, trees))
        return real(d, trees)

    monkeypatch.setattr(M, "cached", looked_at)
    M.train_random_forest_regressor(df, ["x"], "y", n_estimators=3)
    assert seen == [(["x", "y"], 3)]
