"""Spark ML training (M1-M7) and the PCA helpers behind E13 / E14.

Every model is a ``PipelineModel``: feature assembly (M1), label indexing
for string targets, then the estimator.  Fitting is distributed by Spark
ML; only the fitted parameters live on the driver.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType

from .features import assemble_features

# Spark's deepest tree: stands in for "no depth limit".
MAX_TREE_DEPTH = 30


def _label_stages(df: DataFrame, label: str):
    if isinstance(df.schema[label].dataType, StringType):
        return [StringIndexer(inputCol=label, outputCol="label__idx", handleInvalid="error")], "label__idx"
    return [], label


# Learners pay per partition on every pass: cached training data is merged
# into partitions of about this many bytes (measured in the cache).
BYTES_PER_PARTITION = 32 << 20
# A forest meets each row once a tree on every level: a few bytes of input are much work.  Its input is cut into
# partitions of this many (row, tree) pairs, one per core at most, beyond which a partition may hold up to MOST_PAIRS.
PAIRS_PER_PARTITION, MOST_PAIRS = 5_000_000, 100_000_000


class cached:
    """Persist a training input for the duration of a fit: tree and
    iterative learners make many passes, and the input's lineage (splits,
    joins, text features) should run once.  Lost blocks are recomputed.
    Many tiny partitions (a small table after a wide shuffle) are merged
    with a narrow ``coalesce`` by their size in bytes.  For a forest of
    ``trees`` trees the rows are spread over the cores by their work, each
    row's place given by its values.  If it is small, every executor gets a
    copy of what is kept: tasks prefer the executors that hold their input,
    and fits side by side would all wait for the cores of one."""

    def __init__(self, df: DataFrame, trees: int = 0):
        self.df, self.trees = df, int(trees)

    def __enter__(self) -> DataFrame:
        from pyspark import StorageLevel
        d = self.df.persist(StorageLevel.MEMORY_AND_DISK)
        pairs = d.count() * self.trees
        size = int(str(d.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        cores = d.sparkSession.sparkContext.defaultParallelism
        target = max(1, -(-size // BYTES_PER_PARTITION), min(-(-pairs // PAIRS_PER_PARTITION), cores), -(-pairs // MOST_PAIRS))
        have = d.rdd.getNumPartitions()
        copies = executors(d.sparkSession) if self.trees and size <= BYTES_PER_PARTITION else 1
        if have < target and self.trees:
            values = [F.col(f"`{f.name}`") for f in d.schema.fields if isinstance(f.dataType, AtomicType)]
            spread = d.repartition(target, *values)
            spread = spread.sortWithinPartitions(*values) if values else spread
        elif copies > 1:  # even if no partition is merged: kept again, with its copies
            spread = d.coalesce(target)
        else:
            return d.coalesce(target) if have > target else d
        spread = spread.persist(StorageLevel(True, True, False, False, copies))
        spread.count()
        self.df.unpersist()
        self.df = spread
        return spread

    def __exit__(self, *exc):
        self.df.unpersist()


def _fit(pipeline: Pipeline, df: DataFrame, trees: int = 0):
    with cached(df, trees) as d:
        return pipeline.fit(d)


def _used(df: DataFrame, features, label: str) -> DataFrame:
    """The columns a fit reads: no others are cached."""
    return df.select(*dict.fromkeys([*features, label])) if features else df


def _labeled(df: DataFrame, label: str) -> DataFrame:
    if isinstance(df.schema[label].dataType, StringType):
        return df
    return df.withColumn(label, F.col(label).cast("double"))


def forest_params(n_estimators=100, max_depth=10, min_samples_leaf=1, max_features="sqrt", seed=42) -> dict:
    """Map forest settings onto Spark names (None depth -> 30; features per
    split: the classifier's usual square root, all if None is given).  The
    node of each row is kept from level to level: the trees so far are not
    sent to the tasks and walked again on every level."""
    return {"numTrees": int(n_estimators),
            "maxDepth": MAX_TREE_DEPTH if max_depth is None else min(int(max_depth), MAX_TREE_DEPTH),
            "minInstancesPerNode": int(min_samples_leaf),
            "featureSubsetStrategy": "all" if max_features is None else str(max_features),
            "cacheNodeIds": True,
            "seed": int(seed)}


def random_forest_pipeline(df: DataFrame, features, label: str, **kw) -> Pipeline:
    ls, lcol = _label_stages(df, label)
    rf = RandomForestClassifier(featuresCol="features", labelCol=lcol, **forest_params(**kw))
    return Pipeline(stages=assemble_features(df, features, label) + ls + [rf])


def train_random_forest(df: DataFrame, features, label: str, n_estimators=100, max_depth=10,
                        min_samples_leaf=1, max_features="sqrt", seed=42):
    """M2: random forest classifier (100 trees, depth 10, square root of the features per split, seeded)."""
    df = _labeled(df, label)
    return _fit(random_forest_pipeline(df, features, label, n_estimators=n_estimators, max_depth=max_depth,
                                       min_samples_leaf=min_samples_leaf, max_features=max_features,
                                       seed=seed), _used(df, features, label), n_estimators)


def train_random_forest_regressor(df: DataFrame, features, label: str, n_estimators=100, max_depth=10,
                                  min_samples_leaf=1, max_features=None, seed=42):
    """M3: random forest regressor, the regression side of the task type."""
    df = _labeled(df, label)
    p = forest_params(n_estimators, max_depth, min_samples_leaf, max_features, seed)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, **p)
    return _fit(Pipeline(stages=assemble_features(df, features, label) + [rf]), _used(df, features, label), n_estimators)


def train_gbt(df: DataFrame, features, label: str, max_iter=20, max_depth=5, step_size=0.1, seed=42):
    """M6: gradient-boosted trees (binary) in place of boosted-tree libraries."""
    df = _labeled(df, label)
    ls, lcol = _label_stages(df, label)
    gbt = GBTClassifier(featuresCol="features", labelCol=lcol, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step_size, seed=seed)
    return _fit(Pipeline(stages=assemble_features(df, features, label) + ls + [gbt]), df)


def train_mlp(df: DataFrame, features, label: str, hidden=(4,), num_classes: int | None = None,
              max_iter=100, seed=42):
    """M7: small neural net (multilayer perceptron) on standardized inputs."""
    df = _labeled(df, label)
    ls, lcol = _label_stages(df, label)
    stages = assemble_features(df, features, label, output="raw_features")
    stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    k = num_classes or df.select(F.count_distinct(label)).first()[0]
    with cached(df) as d:
        prep = Pipeline(stages=stages + ls).fit(d)
        ready = prep.transform(d)
        n_in = len(ready.select("features").first()[0])  # vectors all have this width, or assembling fails
        mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol=lcol,
                                             layers=[n_in, *hidden, int(k)], maxIter=max_iter, seed=seed)
        return PipelineModel(stages=[*prep.stages, mlp.fit(ready)])


def executors(spark) -> int:
    """Executors that hold cached data (1 in local mode), 10 at most (Spark keeps fewer than 40 copies)."""
    sc = spark.sparkContext
    others = sc._jsc.sc().getExecutorMemoryStatus().size() - 1  # the driver is listed, too
    return max(1, min(others, 10))


def concurrency(spark, jobs: int, parallelism: int | None, partitions: int = 1, least: int = 1) -> int:
    """Concurrent fits: as given, else as many as keep the cluster's cores
    busy, i.e. cores / partitions-per-fit rounded up (a fit over a large
    input that already spans the cluster runs alone, unless ``least`` are
    asked for); never more than the number of jobs."""
    p = parallelism or max(least, -(-spark.sparkContext.defaultParallelism // max(1, int(partitions))))
    return max(1, min(int(jobs), int(p)))


def train_kmeans(df: DataFrame, features, k=3, max_iter=300, seed=42, n_init=10, parallelism: int | None = None):
    """M4: k-means; ``n_init`` seeded restarts, the lowest training cost wins.
    The assembled input is cached once and the restarts run as concurrent
    Spark jobs (``parallelism`` at a time)."""
    from concurrent.futures import ThreadPoolExecutor

    prep = Pipeline(stages=assemble_features(df, features)).fit(df)

    with cached(prep.transform(df).select("features")) as data:
        def fit(i):
            m = KMeans(k=k, maxIter=max_iter, seed=seed + i, featuresCol="features",
                       predictionCol="cluster").fit(data)
            return m.summary.trainingCost, i, m

        n = max(1, int(n_init))
        workers = concurrency(df.sparkSession, n, parallelism, data.rdd.getNumPartitions())
        with ThreadPoolExecutor(max_workers=workers) as pool:
            runs = list(pool.map(fit, range(n)))
    best = min(runs, key=lambda r: (r[0], r[1]))  # lowest cost, ties to the first seed
    return PipelineModel(stages=prep.stages + [best[2]])


def train_pca(df: DataFrame, features, k=2):
    """M5: PCA on mean-centred features (Spark's PCA does not centre)."""
    stages = assemble_features(df, features, output="raw_features")
    stages.append(StandardScaler(inputCol="raw_features", outputCol="centered", withMean=True, withStd=False))
    stages.append(PCA(k=k, inputCol="centered", outputCol="pca"))
    return _fit(Pipeline(stages=stages), df)


def pca_parts(model):
    """(components d x k as lists, mean as list) of a ``train_pca`` model."""
    scaler, pca = model.stages[-2], model.stages[-1]
    pc = pca.pc.toArray()
    return pc.tolist(), scaler.mean.toArray().tolist()


def explained_variance_ratio(model) -> float:
    """Share of variance kept by the components (sum of shares)."""
    return float(sum(model.stages[-1].explainedVariance.toArray()))


def _doubles(values):
    return F.array(*[F.lit(float(v)) for v in values])  # folds into one literal


def project(df: DataFrame, features: str, components, mean, out: str = "scores") -> DataFrame:
    """Scores ``(x - mean) . pc_j`` for an array column (pure column math)."""
    centred = F.zip_with(F.col(features), _doubles(mean), lambda x, m: x.cast("double") - m)
    dot = lambda j: F.aggregate(F.zip_with(centred, _doubles(c[j] for c in components), lambda x, p: x * p),
                                F.lit(0.0), lambda t, v: t + v)
    return df.withColumn(out, F.array(*[dot(j) for j in range(len(components[0]))]))


def reconstruct(df: DataFrame, scores: str, components, mean, out: str = "reconstruction") -> DataFrame:
    """Inverse transform: ``mean + pc . score`` for every coordinate."""
    rec = _doubles(mean)

    def add(rec, j):
        return F.zip_with(rec, _doubles(c[j] for c in components), lambda r, p: r + p * F.col(scores)[j])

    for j in range(len(components[0])):
        rec = add(rec, j)
    return df.withColumn(out, rec)


def column_means(df: DataFrame, features: str, dim: int) -> list:
    """Per-coordinate means of an array column (one aggregate, d values)."""
    r = df.agg(*[F.avg(F.col(features)[i].cast("double")).alias(f"m{i}") for i in range(dim)]).first()
    return [float(r[f"m{i}"]) for i in range(dim)]
