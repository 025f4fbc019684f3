"""Forests grown over counted bins: the trees are Spark's where no draw decides, and the scores agree where draws do."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from loomkit.operators import binned
from loomkit.operators import models as M
from loomkit.operators import tuning as H


@pytest.fixture(scope="module")
def rows(spark):
    """Noisy rows of few combinations: 9 x 7 numbers (zero and below among them) and 3 words."""
    r = np.random.default_rng(3)
    x, z, w = r.integers(-3, 6, 3000), r.integers(0, 7, 3000) / 4, r.integers(0, 3, 3000)
    y = (x * z + np.array([1.5, -1, 0])[w] + r.normal(0, 2, 3000) > 1).astype(float)
    data = [(i, float(x[i]), float(z[i]), "abc"[w[i]], float(y[i])) for i in range(3000)]
    return spark.createDataFrame(data, "id long, x double, z double, w string, y double").coalesce(1).cache()


def _make(df, bootstrap=True, features=("x", "z", "w")):
    def make(p):
        settings = {k: v for k, v in p.items() if k in ("n_estimators", "max_depth", "min_samples_leaf", "max_features")}
        pipeline = M.random_forest_pipeline(df, list(features), "y", **settings)
        pipeline.getStages()[-1].setBootstrap(bootstrap)
        return pipeline
    return make


@pytest.fixture
def fitted(monkeypatch):
    """Depths of the forests that Spark fits to rows."""
    fits, real = [], RandomForestClassifier._fit_java
    monkeypatch.setattr(RandomForestClassifier, "_fit_java", lambda self, d: (fits.append(self.getMaxDepth()), real(self, d))[1])
    return fits


def _scores(out):
    names = ("n_estimators", "max_depth", "min_samples_leaf", "max_features")
    return {tuple(r[n] for n in names): (round(r.mean_test_score, 9), round(r.std_test_score, 9), round(r.mean_train_score, 9)) for r in out.collect()}


SPACE = {"n_estimators": [2, 3], "max_depth": [0, 1, 3, 6, None], "min_samples_leaf": [1, 4, 40], "max_features": [None]}


@pytest.mark.parametrize("metric", ["accuracy", "f1", "precision", "recall"])
def test_without_draws_the_scores_are_those_of_sparks_forests(spark, rows, fitted, monkeypatch, metric):
    space = SPACE if metric == "accuracy" else {**SPACE, "min_samples_leaf": [4], "max_depth": [1, None]}
    got = _scores(H.grid_search(rows, space, _make(rows, False), "y", k=3, metric=metric, keys=["id"]))
    assert not fitted                                                        # before: 3 folds x each leaf size, to the rows
    monkeypatch.setattr(binned, "MOST_CELLS", 0)
    want = _scores(H.grid_search(rows, space, _make(rows, False), "y", k=3, metric=metric, keys=["id"]))
    assert fitted and got == want and len(set(got.values())) > 1


def test_numbers_are_cut_as_spark_cuts_them(spark, fitted, monkeypatch):
    """More rows than Spark looks at for its bins, zeros among them; two thirds are trained on."""
    r = np.random.default_rng(5)
    x = np.where(r.random(21000) < 0.1, 0.0, r.normal(size=21000))
    y = (np.sin(3 * x) + r.normal(0, 0.5, 21000) > 0).astype(float)
    df = spark.createDataFrame([(i, float(x[i]), float(y[i])) for i in range(21000)], "id long, x double, y double").coalesce(2).cache()
    space = {"n_estimators": [1], "max_depth": [2, 5, None], "min_samples_leaf": [1, 9], "max_features": [None]}
    got = _scores(H.grid_search(df, space, _make(df, False, ["x"]), "y", k=3, keys=["id"]))
    assert not fitted
    monkeypatch.setattr(binned, "MOST_CELLS", 0)
    assert got == _scores(H.grid_search(df, space, _make(df, False, ["x"]), "y", k=3, keys=["id"]))


def test_with_draws_the_scores_are_near_sparks(spark, rows, fitted, monkeypatch):
    space = {"n_estimators": [40, 80], "max_depth": [2, 4, None], "min_samples_leaf": [1, 4], "max_features": ["sqrt", None]}
    got = _scores(H.grid_search(rows, space, _make(rows), "y", k=3, keys=["id"]))
    again = _scores(H.grid_search(rows.repartition(5), space, _make(rows), "y", k=3, keys=["id"]))
    assert not fitted and got == again                                       # no draw depends on partitions
    monkeypatch.setattr(binned, "MOST_CELLS", 0)
    want = _scores(H.grid_search(rows, space, _make(rows), "y", k=3, keys=["id"]))
    apart = np.array([np.subtract(got[k], want[k]) for k in want])
    assert abs(apart[:, [0, 2]]).max() < 0.02 and abs(apart[:, [0, 2]].mean(axis=0)).max() < 0.004


def test_every_search_counts_its_folds_once(spark, rows, fitted, monkeypatch):
    counted, real = [], H.counted_folds._counted
    monkeypatch.setattr(H.counted_folds, "_counted", lambda self, d, f, last: (counted.append(f), real(self, d, f, last))[1])
    ranges = {"n_estimators": (2, 6), "max_depth": (2, 8), "min_samples_leaf": (1, 5), "max_features": ["sqrt", None]}
    out = H.adaptive_search(rows, ranges, _make(rows), "y", n_trials=6, n_startup=2, batch=2, n_candidates=4, k=3, keys=["id"]).collect()
    assert len(out) == 6 and not fitted and sorted(counted) == [0, 1, 2]
    counted.clear()
    assert len(H.random_search(rows, ranges, _make(rows), "y", n_trials=4, k=3, keys=["id"]).collect()) == 4
    assert not fitted and sorted(counted) == [0, 1, 2]


def test_smaller_sizes_are_part_of_the_largest():
    r = np.random.default_rng(7)
    codes = np.array([(i, j, k) for i in range(6) for j in range(5) for k in range(4)])
    cells = binned.Cells(codes, [6, 5, 4], [False, False, True], r.integers(0, 9, (120, 2)), r.integers(0, 4, (120, 2)))
    sizes = [(d, n) for d in (0, 2, 30) for n in (1, 4, 9)]
    whole = binned.confusions(cells, sizes, 2, 2, 42)
    for s in sizes:
        assert (binned.confusions(cells, [s], 2, 2, 42)[s] == whole[s]).all()
        assert (whole[s].sum(axis=2) == [cells.test.sum(axis=0), cells.train.sum(axis=0)]).all()


def test_equal_rows_are_bagged_like_rows():
    """Shares of a cell's rows in the bags: mean and variance of as many Poisson(1) copies."""
    cells = binned.Cells(np.zeros((1, 1), int), [1], [False], np.array([[30, 70]]), np.array([[0, 0]]))
    bags = []
    real = binned.grow
    try:
        binned.grow = lambda c, bag, *a: (bags.append(bag[0]), real(c, bag, *a))[1]
        binned.confusions(cells, [(3, 4000)], 1, 1, 1)
    finally:
        binned.grow = real
    bags = np.array(bags)
    assert np.allclose(bags.mean(axis=0), [30, 70], rtol=0.02) and np.allclose(bags.var(axis=0), [30, 70], rtol=0.1)


@pytest.mark.parametrize("odd", ["cast(null as double) y", "2.0D y", "cast('NaN' as double) x", "cast(null as double) x"])
def test_what_spark_refuses_or_takes_otherwise_goes_to_spark(spark, rows, fitted, odd):
    """Missing labels and numbers are errors as before; a third class is fitted to the rows."""
    what, name = odd.rsplit(" ", 1)
    df = rows.withColumn(name, F.when(F.col("id") == 77, F.expr(what)).otherwise(F.col(name)))
    search = lambda: H.grid_search(df, {"n_estimators": [2], "max_depth": [2]}, _make(df), "y", k=3, keys=["id"]).collect()
    if odd.startswith("2"):
        assert len(search()) == 1 and fitted == [2, 2, 2]
    else:
        with pytest.raises(Exception):
            search()


def test_the_final_evaluation_fits_its_best_setting_alone(spark, rows, fitted):
    """The grid under it grows over counts; only the setting it finds is fitted to the rows."""
    make = _make(rows)
    grid = H.grid_search(rows, {**SPACE, "n_estimators": [3, 5]}, make, "y", k=3, keys=["id"])
    split = rows.withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "train", "test", "validation"))), (F.col("id") % 4).cast("int") + 1))
    out = {r.split: r.n_rows for r in H.final_evaluation(split, H.best_params(grid), make, "y").collect()}
    assert out == {"test": 750, "validation": 750} and len(fitted) == 1       # before: 9 fits of the grid, too
