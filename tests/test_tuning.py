"""Trials tables: the full grid and the seeded random draws."""
import hashlib
import itertools

from loomkit.operators import tuning as H


def test_default_grid_is_complete(spark):
    g = H.param_grid(spark, H.DEFAULT_RF_SPACE)
    rows = g.collect()
    assert len(rows) == 675
    combos = {tuple(r[n] for n in H.DEFAULT_RF_SPACE) for r in rows}
    want = {tuple(None if v is None else str(v) for v in c) for c in itertools.product(*H.DEFAULT_RF_SPACE.values())}
    assert combos == want
    # min_samples_split has no Spark counterpart: 675 trials, 225 distinct fits
    fits = {H.fit_key({n: H._parse(r[n]) for n in H.DEFAULT_RF_SPACE}) for r in rows}
    assert len(fits) == 225


def test_random_draws_match_hash_rule(spark):
    t = H.random_trials(spark, H.DEFAULT_RF_RANGES, 20, 42).collect()
    assert len(t) == 20
    for r in t:
        for n, (lo, hi) in H.DEFAULT_RF_RANGES.items():
            h = hashlib.md5(f"42|{r['trial_id']}|{n}".encode()).hexdigest()
            assert int(r[n]) == lo + int(h[:8], 16) % (hi - lo)
            assert lo <= int(r[n]) < hi


def test_best_trial_ties_to_lowest_id(spark):
    s = spark.createDataFrame([(3, 0, 0.5), (3, 1, 0.7), (1, 0, 0.6), (1, 1, 0.6), (2, 0, 0.1)],
                              "trial_id long, fold long, test_score double")
    b = H.best_trial(s).first()
    assert b["trial_id"] == 1 and abs(b["mean_score"] - 0.6) < 1e-12
    assert H.best_trial(s, higher_is_better=False).first()["trial_id"] == 2


def _fits(df, seen=None):
    from loomkit.operators import models as M

    def make(p):
        if seen is not None:
            seen.append(dict(p))
        return M.random_forest_pipeline(df, ["x", "z"], "y", n_estimators=int(p["n_estimators"]), max_depth=int(p["max_depth"]))
    return make


def _points(spark):
    return spark.createDataFrame([(i, float(i % 7), float((i * 37) % 11), float((i % 7 + (i * 37) % 11) % 3 == 0)) for i in range(90)],
                                 "id long, x double, z double, y double")


def test_smaller_forests_are_prefixes_summed_tree_by_tree(spark):
    import numpy as np
    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F
    df = _points(spark)
    model = _fits(df)({"n_estimators": 7, "max_depth": 4}).fit(df)
    forest, ready = model.stages[-1], PipelineModel(model.stages[:-1]).transform(df).orderBy("id")
    votes = []
    for tree in forest.trees:
        raw = np.array([r.raw for r in tree.setRawPredictionCol("raw").setPredictionCol("p").setProbabilityCol("").setFeaturesCol("features")
                        .transform(ready).orderBy("id").select("raw").collect()])
        votes.append(raw / raw.sum(axis=1, keepdims=True))
    for n in (1, 3, 7):
        got = [r.p for r in H.first_trees(forest._java_obj, n, "p").transform(ready).orderBy("id").select("p").collect()]
        assert got == np.sum(votes[:n], axis=0).argmax(axis=1).astype(float).tolist()
    whole = [r.prediction for r in forest.transform(ready).orderBy("id").select(F.col("prediction")).collect()]
    assert whole == got


def test_grid_fits_the_largest_forest_only(spark):
    df, seen = _points(spark), []
    space = {"n_estimators": [2, 5, 4], "max_depth": [2, 3], "min_samples_split": [2, 5]}
    out = H.grid_search(df, space, _fits(df, seen), "y", k=3, keys=["id"]).collect()
    assert len(out) == 12 and sorted(r["rank"] for r in out) == list(range(1, 13))
    assert len(seen) == 6 and {p["n_estimators"] for p in seen} == {5}       # 2 depths x 3 folds


def test_a_broken_search_goes_on_and_a_second_query_fits_nothing(spark, tmp_path):
    df = _points(spark)
    store = H.TrialStore(spark, str(tmp_path))
    space = {"n_estimators": [2, 4], "max_depth": [2, 3, 4]}
    calls = []

    def breaking(p):
        if len(calls) == 5:
            raise RuntimeError("stopped")
        calls.append(p)
        return _fits(df)(p)

    with __import__("pytest").raises(RuntimeError, match="stopped"):
        H.grid_search(df, space, breaking, "y", k=3, keys=["id"], store=store, parallelism=1)
    seen = []
    whole = H.grid_search(df, space, _fits(df, seen), "y", k=3, keys=["id"], store=store).collect()
    assert len(seen) == 9 - 5
    again = []
    assert sorted(map(tuple, H.grid_search(df, space, _fits(df, again), "y", k=3, keys=["id"], store=store).collect())) == sorted(map(tuple, whole))
    assert not again
    fresh = H.grid_search(df, space, _fits(df), "y", k=3, keys=["id"]).collect()
    assert sorted(map(tuple, fresh)) == sorted(map(tuple, whole))
    other = []
    H.grid_search(df.where("id < 80"), {"n_estimators": [2], "max_depth": [2]}, _fits(df, other), "y", k=2, keys=["id"], store=store).collect()
    assert len(other) == 2                                                   # other rows: another search


def test_settings_that_try_equally_many_features_share_their_fits(spark, tmp_path):
    """Of 3 features, sqrt and log2 both try 2: one fit for both, and the scores of fitting each."""
    from loomkit.operators import models as M
    df = _points(spark).withColumn("w", __import__("pyspark").sql.functions.col("id") % 5)

    def make(p):
        return M.random_forest_pipeline(df, ["x", "z", "w"], "y", n_estimators=int(p["n_estimators"]), max_depth=3, max_features=p["max_features"])

    space = {"n_estimators": [2, 4], "max_features": ["sqrt", "log2", None]}
    out = H.grid_search(df, space, make, "y", k=3, keys=["id"], store=H.TrialStore(spark, str(tmp_path))).collect()
    assert len(list(tmp_path.glob("search=*/unit=*"))) == 2 * 3
    score = {(r.n_estimators, r.max_features): (round(r.mean_test_score, 9), round(r.mean_train_score, 9)) for r in out}
    for choice in ("sqrt", "log2", None):
        alone = H.grid_search(df, {**space, "max_features": [choice]}, make, "y", k=3, keys=["id"]).collect()
        assert {r.n_estimators: (round(r.mean_test_score, 9), round(r.mean_train_score, 9)) for r in alone} == {n: score[n, choice] for n in ("2", "4")}


def test_smaller_depths_are_cut_from_the_deepest_forest(spark, monkeypatch):
    """One fit a fold for all depths, and the scores of fitting each depth."""
    from pyspark.ml.classification import RandomForestClassifier
    from loomkit.operators import models as M
    df = spark.createDataFrame([(i, float(i * 7919 % 101), float(i * 104729 % 97), float(i * 31 % 13), float((i * 7919 % 101 > 40) + (i * 2654435761 % 5 == 0)))
                                for i in range(240)], "id long, x double, z double, w double, y double")  # noisy, of three classes
    fits, real = [], RandomForestClassifier._fit_java
    monkeypatch.setattr(RandomForestClassifier, "_fit_java", lambda self, d: (fits.append(self.getMaxDepth()), real(self, d))[1])

    def make(p):
        return M.random_forest_pipeline(df, ["x", "z", "w"], "y", n_estimators=int(p["n_estimators"]), max_depth=p["max_depth"],
                                        min_samples_leaf=int(p["min_samples_leaf"]))

    space = {"n_estimators": [3, 8], "max_depth": [0, 1, 2, 4, None], "min_samples_leaf": [1, 3]}
    got = H.grid_search(df, space, make, "y", k=3, keys=["id"]).collect()
    assert fits == [30] * 6                                                  # before: 5 depths x 2 x 3 folds
    scores = lambda rows: {(r.n_estimators, r.max_depth, r.min_samples_leaf):
                           tuple(round(x, 9) for x in (r.mean_test_score, r.std_test_score, r.mean_train_score)) for r in rows}
    score = scores(got)
    assert len(set(score.values())) > 10
    for d in space["max_depth"]:
        alone = H.grid_search(df, {**space, "max_depth": [d]}, make, "y", k=3, keys=["id"]).collect()
        assert scores(alone) == {k: v for k, v in score.items() if k[1] == (None if d is None else str(d))}
    monkeypatch.setattr(H, "MOST_NODES", 0)                                  # too large to be cut: each depth is fitted
    fits.clear()
    whole = H.grid_search(df, {**space, "max_depth": [1, 4]}, make, "y", k=3, keys=["id"]).collect()
    assert sorted(fits) == [1] * 6 + [4] * 6
    assert scores(whole) == {k: v for k, v in score.items() if k[1] in ("1", "4")}


def test_pipelines_that_differ_in_more_than_depth_are_fitted_each(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from loomkit.operators import models as M
    df, fits, real = _points(spark), [], RandomForestClassifier._fit_java
    monkeypatch.setattr(RandomForestClassifier, "_fit_java", lambda self, d: (fits.append(self.getMaxDepth()), real(self, d))[1])

    def make(p):
        return M.random_forest_pipeline(df, ["x", "z"], "y", n_estimators=3, max_depth=p["max_depth"], seed=p["max_depth"])

    H.grid_search(df, {"n_estimators": [3], "max_depth": [2, 4]}, make, "y", k=2, keys=["id"]).collect()
    assert sorted(fits) == [2, 2, 4, 4]


def test_searches_spread_their_folds_by_the_largest_forest(spark, monkeypatch):
    from loomkit.operators import models as M
    df, asked, real = _points(spark), [], M.cached

    def looked_at(d, trees=0):
        asked.append(trees)
        return real(d, trees)

    monkeypatch.setattr(M, "cached", looked_at)
    ranges = {"n_estimators": (2, 6), "max_depth": (2, 4)}
    most = max(int(r.n_estimators) for r in H.random_trials(spark, ranges, 4, 42).collect())
    H.random_search(df, ranges, _fits(df), "y", n_trials=4, k=2, keys=["id"])
    assert asked == [0, most]
    asked.clear()
    H.adaptive_search(df, ranges, _fits(df), "y", n_trials=3, n_startup=2, batch=1, n_candidates=4, k=2, keys=["id"])
    assert asked[0] == 0 and 2 <= asked[1] < 6
    assert [M.concurrency(spark, 99, None, n) for n in (1, 10 ** 6)] == [min(99, spark.sparkContext.defaultParallelism), 1]


def test_forests_take_two_fits_at_least():
    """A fit that spans the cluster leaves it idle while its trees grow on the driver: searches run another beside it."""
    from types import SimpleNamespace

    from loomkit.operators.models import concurrency
    spark = SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=12))
    assert concurrency(spark, 60, None, 12) == 1 and concurrency(spark, 60, None, 12, least=2) == 2
    assert concurrency(spark, 60, None, 1, least=2) == 12 and concurrency(spark, 60, 1, 12, least=2) == 1 == concurrency(spark, 1, None, 1, least=2)


def test_small_forest_input_is_kept_on_every_executor(spark, monkeypatch):
    """Otherwise all fits side by side wait for the cores of the executor that holds the one partition."""
    from loomkit.operators import models as M
    df = spark.range(0, 100, 1, 4)
    kept, persist = [], type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, level: (kept.append(level.replication), persist(self, level))[1])
    monkeypatch.setattr(M, "executors", lambda s: 3)
    for trees, copies in ((50, [1, 3]), (0, [1])):
        kept.clear()
        with M.cached(df, trees) as d:
            assert d.rdd.getNumPartitions() == 1 and d.count() == 100
        assert kept == copies
