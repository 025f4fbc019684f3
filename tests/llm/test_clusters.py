"""Ns-bounds clustering against plain rounds."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomkit.llm import nsbounds
from loomkit.llm.common import read
from loomkit.llm.queries import QUERIES
from tests.llm import helpers as H


def lloyd(rows, k=16, n_rounds=3, dims=64, scale=64):
    """[(id, cluster, distance, cluster_inertia, inertia, sha)]; rows are (id, vector)."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for r in range(n_rounds + 1):
        own = [min((dist(v, c), j) for j, c in enumerate(cents)) for _, v in kept]
        if r < n_rounds:
            for j in range(len(cents)):
                mine = [v for (_, v), (_, o) in zip(kept, own, strict=True) if o == j]
                if mine:
                    cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    per = {}
    for d, j in own:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((i is None, i, j, d, per[j], sum(per.values()), sha[j]) for (i, _), (d, j) in zip(kept, own, strict=True))


def got(df):
    return sorted((r.vec_id is None, r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_query_equals_plain_rounds(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, H.SF, "embeddings").select("vec_id", "embedding").collect()]
    assert got(QUERIES["op12_ns_bounds_clusters"](spark, H.SF)) == lloyd(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_ties_and_more_rounds(spark, seed):
    rng = np.random.default_rng(seed)
    mids = rng.integers(-3, 4, (7, 4)) / 2
    rows = [(i, (mids[i % 7] + rng.integers(-2, 3, 4) / 8).tolist()) for i in range(400)]  # few values: many equal distances
    rows += [(1000 + i, mids[0].tolist()) for i in range(100)]
    df = vectors(spark, rows)
    out = nsbounds.cluster(df, k=9, n_rounds=6, dims=4, scale=8)
    assert got(out) == lloyd(rows, k=9, n_rounds=6, dims=4, scale=8)


def test_bounds_spare_most_evaluations(spark):
    rng = np.random.default_rng(4)
    mids = rng.normal(size=(6, 16)) * 5
    rows = [(i, (mids[i % 6] + rng.normal(size=16) * 0.1).tolist()) for i in range(600)]
    points = nsbounds.quantised(vectors(spark, rows), "vec_id", "embedding", 16, 64)
    first = nsbounds.starts(points, 6, "1")
    evaluated = []
    for state, history in nsbounds.rounds(points, first, 4):
        evaluated.append(state.select(F.explode("seen").alias("t")).where(F.col("t") == len(history) - 1).count())
    assert evaluated[0] == 600 * 6 and evaluated[3] < 600 * 2  # later rounds look at a fraction of all distances


def test_displacement_is_total_not_summed():
    """A centroid that comes back leaves the bound as tight as it was."""
    history = np.array([[[0, 0], [100, 0]], [[0, 0], [60, 0]], [[0, 0], [100, 0]]])
    v = np.array([[30, 0]])
    dist, seen = nsbounds.squared(v, history[0]), np.zeros((1, 2), np.int64)
    own = nsbounds.reassign(v, np.array([0]), dist, seen, history)
    assert own.tolist() == [0] and seen.tolist() == [[0, 0]]  # 70 - 0 > 30; with drifts summed up it would be 70 - 80


def test_odd_vectors(spark):
    ok = [0.5] * 64
    rows = [(1, ok), (1, ok), (None, [-0.25] * 64), (2, None), (3, []), (4, [1.0] * 63), (5, [None] + ok[1:]), (6, [float("nan")] + ok[1:]),
            (7, [float("inf")] + ok[1:]), (8, [0.0] * 64)]
    df = vectors(spark, rows).withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).withColumn("own", F.lit(2))
    assert got(nsbounds.cluster(df)) == lloyd(rows) and nsbounds.cluster(df).columns[0] == "vec_id"
    assert got(nsbounds.cluster(df.limit(0))) == [] and got(nsbounds.cluster(df.where("vec_id = 3"))) == []
    with pytest.raises(Exception, match="out of range"):
        nsbounds.cluster(vectors(spark, [(1, [1e9] * 64)])).collect()
