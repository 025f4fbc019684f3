"""Metrics against plain numpy brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomkit.operators import metrics as E


def _auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_with_ties(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300).tolist()
    s = np.round(rng.random(300), 1).tolist()
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    got = E.roc_auc(df, "label", "score").first()["roc_auc"]
    assert abs(got - _auc(y, s)) < 1e-12


def test_mcc_and_prf(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 200)
    p = np.where(rng.random(200) < 0.6, y, rng.integers(0, 3, 200))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, prediction double")
    k = 3
    cm = np.zeros((k, k))
    for a, b in zip(y, p):
        cm[a, b] += 1
    t, pr, c, s = cm.sum(1), cm.sum(0), np.trace(cm), cm.sum()
    want = (c * s - t @ pr) / math.sqrt((s * s - pr @ pr) * (s * s - t @ t))
    assert abs(E.mcc(df).first()["mcc"] - want) < 1e-12
    rows = {r["class"]: r for r in E.precision_recall_f1(df).collect()}
    for i in range(k):
        r = rows[str(float(i))]
        assert abs(r["precision"] - cm[i, i] / pr[i]) < 1e-12
        assert abs(r["recall"] - cm[i, i] / t[i]) < 1e-12


def _clusters(spark, n=120, d=5, k=4, seed=3):
    rng = np.random.default_rng(seed)
    lab = rng.integers(0, k, n)
    x = rng.normal(size=(n, d)) + lab[:, None] * 2.0
    df = spark.createDataFrame([(i, x[i].tolist(), int(lab[i])) for i in range(n)],
                               "id long, features array<double>, cluster int")
    return df, x, lab


def test_clustering_metrics(spark):
    df, x, lab = _clusters(spark)
    ks = sorted(set(lab))
    cen = {c: x[lab == c].mean(0) for c in ks}
    inertia = sum(((x[i] - cen[lab[i]]) ** 2).sum() for i in range(len(x)))
    assert abs(E.inertia(df).first()["inertia"] - inertia) < 1e-8
    s = {c: np.mean([np.linalg.norm(x[i] - cen[c]) for i in range(len(x)) if lab[i] == c]) for c in ks}
    db = np.mean([max((s[a] + s[b]) / np.linalg.norm(cen[a] - cen[b]) for b in ks if b != a) for a in ks])
    assert abs(E.davies_bouldin(df).first()["davies_bouldin"] - db) < 1e-10
    g = x.mean(0)
    B = sum((lab == c).sum() * ((cen[c] - g) ** 2).sum() for c in ks)
    ch = (B / (len(ks) - 1)) / (inertia / (len(x) - len(ks)))
    assert abs(E.calinski_harabasz(df).first()["calinski_harabasz"] - ch) < 1e-8
    # squared-distance silhouette by brute force
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    vals = []
    for i in range(len(x)):
        own = [j for j in range(len(x)) if lab[j] == lab[i] and j != i]
        if not own:
            vals.append(0.0)
            continue
        a = d2[i, own].mean()
        b = min(d2[i, lab == c].mean() for c in ks if c != lab[i])
        vals.append((b - a) / max(a, b))
    got = E.silhouette_squared(df).first()["silhouette_squared"]
    assert abs(got - np.mean(vals)) < 1e-9


def test_regression_metrics(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=100)
    p = y + rng.normal(scale=0.3, size=100)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    r = E.regression_metrics(df).first()
    mse = ((y - p) ** 2).mean()
    assert abs(r["mse"] - mse) < 1e-12
    assert abs(r["r2"] - (1 - mse / y.var())) < 1e-12
    assert abs(r["explained_variance"] - (1 - (y - p).var() / y.var())) < 1e-12
    assert abs(r["mae"] - np.abs(y - p).mean()) < 1e-12


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (0, 1.0, 0.0), (1, 1.0, 0.0)], "label int, p0 double, p1 double")
    got = E.log_loss(df, "label", ["p0", "p1"]).first()["log_loss"]
    assert abs(got - (-math.log(1e-15)) / 3) < 1e-9


def test_pca_inverse_round_trip(spark):
    from loomkit.operators import models as M
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4)) @ rng.normal(size=(4, 4)) + 3.0
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(60)], "id long, f array<double>")
    full = M.train_pca(df, ["f"], k=4)
    pc, mean = M.pca_parts(full)
    rec = M.reconstruct(M.project(df, "f", pc, mean), "scores", pc, mean)
    err = E.reconstruction_error(rec, features="f", recon="reconstruction").first()["reconstruction_error"]
    assert err < 1e-18                                   # all components: exact inverse
    two = M.train_pca(df, ["f"], k=2)
    assert 0 < M.explained_variance_ratio(two) <= 1
    pc2, mean2 = M.pca_parts(two)
    rec2 = M.reconstruct(M.project(df, "f", pc2, mean2), "scores", pc2, mean2)
    err2 = E.reconstruction_error(rec2, features="f", recon="reconstruction").first()["reconstruction_error"]
    ev = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert abs(err2 - ev[2:].sum() / 4) < 1e-9           # dropped variance per cell


def test_auc_one_class_group_is_null_and_outlier_is_exact(spark):
    rows = [("a", 1, 0.1), ("a", 0, 0.2), ("a", 1, 1e12), ("b", 1, 0.3), ("b", 1, 0.4)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r["roc_auc"] for r in E.roc_auc(df, group=["g"]).collect()}
    assert got == {"a": 0.5, "b": None}


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_auc_refuses_rows_without_a_score(spark, bad):
    df = spark.createDataFrame([(1, 0.5), (0, bad)], "label int, score double")
    with pytest.raises(Exception, match="no score"):
        E.roc_auc(df).collect()


@pytest.mark.parametrize("row", [(1, 0.5, None), (7, 0.5, 0.5)])
def test_log_loss_refuses_missing_probabilities(spark, row):
    df = spark.createDataFrame([(0, 0.5, 0.5), row], "label int, p0 double, p1 double")
    with pytest.raises(Exception, match="no probability"):
        E.log_loss(df, "label", ["p0", "p1"]).collect()


def test_anomaly_metrics_when_nothing_is_flagged(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, y int")
    r = E.anomaly_metrics(df, threshold=1.0, label="y").first()
    assert r["contamination"] == 0 and r["precision"] is None and r["recall"] is None


CLUSTER_METRICS = [E.inertia, E.calinski_harabasz, E.davies_bouldin, E.silhouette_squared]


@pytest.mark.parametrize("metric", CLUSTER_METRICS)
@pytest.mark.parametrize("odd", [([1.0, 2.0, 3.0], 1), (None, 1), ([1.0, None], 0), ([1.0, 2.0, 3.0], 0)])
def test_ragged_or_null_vectors_are_errors(spark, metric, odd):
    df = spark.createDataFrame([([0.0, 1.0], 0), ([0.0, 2.0], 0), ([5.0, 5.0], 2), odd], "features array<double>, cluster int")
    with pytest.raises(Exception):
        metric(df).collect()


def test_identical_points_and_coinciding_centroids(spark):
    df = spark.createDataFrame([([1.0, 1.0], 0), ([1.0, 1.0], 0), ([1.0, 1.0], 1), ([1.0, 1.0], 1)], "features array<double>, cluster int")
    assert E.silhouette_squared(df).first()[0] == 0.0
    assert E.davies_bouldin(df).first()[0] == 0.0
    assert E.calinski_harabasz(df).first()[0] == 1.0
    assert E.inertia(df).first()[0] == 0.0


@pytest.mark.parametrize("metric", CLUSTER_METRICS)
def test_cluster_metrics_by_group_equal_those_of_the_parts(spark, metric):
    df, _, _ = _clusters(spark)
    df = df.withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    got = {r["split"]: r[1] for r in metric(df, group=["split"]).collect()}
    for s in ("train", "test"):
        assert abs(metric(df.where(F.col("split") == s)).first()[0] - got[s]) < 1e-9


def test_null_groups_and_classes_are_kept(spark):
    rows = [(None, "a", "a"), (None, "a", "b"), (None, None, "a"), ("x", "b", "b"), ("x", "a", "a"), ("x", None, None)]
    df = spark.createDataFrame(rows, "g string, label string, prediction string")
    prf = E.precision_recall_f1(df, group=["g"]).collect()
    assert len([r for r in prf if r["class"] is None]) == 2                  # one row a group for the missing class
    weighted = {r["g"]: r["support"] for r in prf if r["class"] == "weighted"}
    assert weighted == {None: 3, "x": 3}
    assert {r["g"] for r in E.mcc(df, group=["g"]).collect()} == {None, "x"}
