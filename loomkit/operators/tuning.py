"""Hyper-parameter search (H1-H6) with k-fold cross-validation.

Trials are a small Spark table; every fit is a distributed Spark ML job.
Folds come from the exact stratified k-fold (T6), the assembled training
data is cached once, and (trial, fold) fits run ``parallelism`` at a time
as concurrent Spark jobs.  Only the per-fit scores (one number each) reach
the driver; they are turned straight back into a table and aggregated in
Spark (H5).

Forests nest: for settings that differ in the number of trees only, the
largest forest is fitted once per fold and its first n trees are scored as
the forest of n trees (``NESTED``).  Classification forests that differ in
their depth only are cut from the deepest of them (``cut_forest``).  Folds of
more rows than their features have combinations of bins are counted per
combination, and their forests grow over the counts (``binned``), a task a
forest.  With a ``TrialStore`` the scores of every finished fit are written
down, so a search that was broken off goes on where it stood, and another
query reads the scores without fitting again.
"""

from __future__ import annotations

import gc
import hashlib
import json
import math
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from threading import Lock, Semaphore

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StructField, StructType

from ..functions.hashing import seeded_md5
from ..session import scratch_path, ship_package
from . import binned
from .models import MAX_TREE_DEPTH
from .splits import stratified_kfold

# The default forest search space (grid) and random ranges
# (integer draws, upper end excluded).
DEFAULT_RF_SPACE = {
    "n_estimators": [50, 100, 150, 200, 300],
    "max_depth": [3, 5, 7, 10, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2", None],
}
DEFAULT_RF_RANGES = {
    "n_estimators": (50, 300),
    "max_depth": (3, 15),
    "min_samples_split": (2, 10),
    "min_samples_leaf": (1, 5),
}
# Settings with no Spark counterpart: kept in the trials table, ignored by fits.
NO_SPARK_COUNTERPART = ("min_samples_split",)
# The setting whose smaller values are prefixes of the largest fit.
NESTED = "n_estimators"
# The setting whose smaller values are the upper levels of the deepest fit.
DEPTH = "max_depth"
# A forest of more nodes is not cut to smaller depths (its nodes go to the driver for that): each depth is fitted.
MOST_NODES = 1_000_000
# The setting of which several values may ask for the same number of features per split.
SUBSET = "max_features"


def _lit(v):
    return F.lit(None).cast("string") if v is None else F.lit(str(v))


def param_grid(spark: SparkSession, space: dict) -> DataFrame:
    """H1: every combination as a row (trial_id, one string column per
    setting).  Built from ``range`` by mixed-radix decoding: no joins."""
    names = list(space)
    sizes = [len(space[n]) for n in names]
    total = math.prod(sizes)
    t = F.col("id")
    cols, stride = [], 1
    for n, sz in reversed(list(zip(names, sizes))):
        idx = (F.floor(t / F.lit(stride)) % F.lit(sz)).cast("int")
        cols.append(F.element_at(F.array(*[_lit(v) for v in space[n]]), idx + 1).alias(n))
        stride *= sz
    return spark.range(total).select(F.col("id").alias("trial_id"), *reversed(cols))


def random_trials(spark: SparkSession, ranges: dict, n_trials: int = 20, seed: int = 42) -> DataFrame:
    """H3 draws: setting ``p`` of trial ``t`` is
    ``low + (first 32 bits of md5('<seed>|<t>|<p>')) mod (high - low)`` for a
    ``(low, high)`` range, or the choice at those bits modulo their number for a list."""
    t = spark.range(n_trials).select(F.col("id").alias("trial_id"))
    cols = []
    for n, r in ranges.items():
        h = seeded_md5(seed, F.col("trial_id"), F.lit(n))
        u = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
        if isinstance(r, list):
            cols.append(F.element_at(F.array(*[_lit(v) for v in r]), (u % len(r)).cast("int") + 1).alias(n))
        else:
            cols.append((F.lit(int(r[0])) + u % F.lit(int(r[1]) - int(r[0]))).cast("string").alias(n))
    return t.select("trial_id", *cols)


def _parse(v):
    if v is None:
        return None
    try:
        return int(v)
    except ValueError:
        try:
            return float(v)
        except ValueError:
            return v


def fit_key(params: dict) -> tuple:
    """Settings that change the fit (drops those Spark has no use for)."""
    return tuple(sorted((k, v) for k, v in params.items() if k not in NO_SPARK_COUNTERPART))


def _subset_size(strategy: str, width: int):
    """How many of ``width`` features a named strategy tries per split (a name it does not know stands for itself)."""
    return {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log(width) / math.log(2))),
            "onethird": math.ceil(width / 3.0)}.get(strategy, strategy)


def _alike_subsets(df: DataFrame, params: list[dict], make_pipeline) -> dict:
    """``{value: the value fitted in its place}`` for the ``max_features`` that mean the same fit on these features
    (of 3 features, ``sqrt`` and ``log2`` both try 2)."""
    first = {}
    for p in params:
        first.setdefault(p.get(SUBSET), p)
    if len(first) < 2:
        return {v: v for v in first}
    stages = {v: make_pipeline(p).getStages() for v, p in first.items()}
    if not all(isinstance(s[-1], (RandomForestClassifier, RandomForestRegressor)) for s in stages.values()):
        return {v: v for v in first}
    *before, last = next(iter(stages.values()))
    row = Pipeline(stages=before).fit(df).transform(df).select(last.getFeaturesCol()).first()
    if row is None:
        return {v: v for v in first}
    fitted: dict = {}
    return {v: fitted.setdefault(_subset_size(s[-1].getFeatureSubsetStrategy(), row[0].size), v) for v, s in stages.items()}


def higher_better(metric: str) -> bool:
    """Whether more of ``metric`` is better, by the same table as R4."""
    from .runs import METRIC_DIRECTIONS
    name = metric.lower()
    table = list(METRIC_DIRECTIONS)
    return next((v for k, v in table if k == name), next((v for k, v in table if k in name), True))


# Metrics a cross-validation can optimize (computed by loomkit's aggregates).
CV_METRICS = {"accuracy", "f1", "precision", "recall", "rmse", "mse", "mae", "r2"}


def fold_scores(scored: DataFrame, label: str, metric: str) -> dict:
    """``{part: score}`` for the parts in ``_part`` (one aggregate job)."""
    from .metrics import accuracy, precision_recall_f1, regression_metrics
    if metric == "accuracy":
        rows = accuracy(scored, label, "prediction", ["_part"]).collect()
    elif metric in ("f1", "precision", "recall"):
        rows = precision_recall_f1(scored, label, "prediction", ["_part"]).where(F.col("class") == "weighted").collect()
    else:
        rows = regression_metrics(scored, label, "prediction", ["_part"]).collect()
    return {r["_part"]: float(r[metric]) for r in rows}


class first_trees:
    """The model of the first ``n`` trees of a fitted forest (the JVM's model), writing its prediction to ``column``.

    Models are held without their Python wrappers, which call the JVM for every tree."""

    def __init__(self, forest, n: int, column: str):
        from pyspark import SparkContext
        ml = SparkContext._active_spark_context._jvm.org.apache.spark.ml
        trees, uid = forest.trees()[0:int(n)], f"{forest.uid()}_{n}"
        if "Classification" in forest.getClass().getSimpleName():
            cut = ml.classification.RandomForestClassificationModel(uid, trees, forest.numFeatures(), forest.numClasses())
            cut.setProbabilityCol("")
            cut.setRawPredictionCol("")
        else:
            cut = ml.regression.RandomForestRegressionModel(uid, trees, forest.numFeatures())
        cut.setFeaturesCol(forest.getFeaturesCol())
        cut.setPredictionCol(column)
        self.model = cut

    def transform(self, df: DataFrame) -> DataFrame:
        return DataFrame(self.model.transform(df._jdf), df.sparkSession)


class cut_forest:
    """Predictions of a fitted classification forest (the JVM's model) cut to ``(depth, trees)`` sizes.

    A tree grows from the root, and no level depends on how many are allowed below it: the first d levels of a deep
    tree, its leaves merged where they predict alike, are the tree fitted with depth d.  (Spark draws the features of
    the nodes level by level, too, as long as a level fits ``maxMemoryInMB``; beyond that the draws are others.)
    The forest tells which leaf of each tree a row reaches, and each leaf's ancestor on level d has the counts of its
    classes; they are added tree by tree, as the forest does.  Only the nodes' counts and children go to the driver,
    those of one forest at a time."""

    ONE = Lock()

    def __init__(self, spark: SparkSession, forest, sizes: list[tuple[int, int]]):
        self.spark, self.forest = spark, forest
        path = scratch_path(spark, f"forests/{uuid.uuid4().hex}")
        forest.save(path)
        with self.ONE:
            self.model = spark.sparkContext.broadcast(self._votes(spark.read.parquet(f"{path}/data"), list(sizes)))
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    @classmethod
    def _votes(cls, saved: DataFrame, sizes: list[tuple[int, int]]) -> tuple:
        """Class shares of every node, leaves before each tree, by depth the node that a leaf votes for, and the sizes."""
        nodes = saved.select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
                             "nodeData.leftChild", "nodeData.rightChild").toArrow()
        nodes = nodes.sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()
        column = lambda name: nodes[name].to_numpy()
        tree = column("treeID")
        roots = np.flatnonzero(np.diff(tree, prepend=-1))
        root = roots[tree]  # ids count from 0 in each tree
        left, right = (np.where(column(c) < 0, -1, root + column(c)) for c in ("leftChild", "rightChild"))
        counts = nodes["impurityStats"].combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
        total = counts.sum(axis=1, keepdims=True)
        levels = [roots]
        while len(inner := levels[-1][left[levels[-1]] >= 0]):
            levels.append(np.concatenate([left[inner], right[inner]]))
        leaf = left < 0
        first = np.cumsum(leaf)[roots] - leaf[roots]
        ends = {d: binned.voting(levels, left, right, column("prediction"), d)[leaf].astype(np.int32) for d in {d for d, _ in sizes}}
        return np.divide(counts, total, out=np.zeros_like(counts), where=total != 0), first, ends, sizes

    def transform(self, df: DataFrame, keep: list[str], column: str) -> DataFrame:
        """The columns ``keep`` of ``df``, and an array of the predictions of each size."""
        from pyspark.ml.functions import vector_to_array
        from pyspark.sql.types import ArrayType
        model = self.model
        self.forest.setLeafCol("_leaves")
        for c in ("Prediction", "RawPrediction", "Probability"):
            getattr(self.forest, f"set{c}Col")("")
        reached = DataFrame(self.forest.transform(df._jdf), df.sparkSession).select(*keep, vector_to_array("_leaves").alias(column))

        def vote(batches):
            import numpy as np
            import pyarrow as pa
            share, first, ends, sizes = model.value
            for b in batches:
                leaves = b.column(len(keep)).flatten().to_numpy().reshape(b.num_rows, len(first)).astype(np.int64) + first
                out = np.empty((b.num_rows, len(sizes)))
                for i in range(0, b.num_rows, 1000):
                    for d, at in ends.items():
                        votes = np.cumsum(share[at[leaves[i:i + 1000]]], axis=1)  # in the order of the trees
                        for j, (depth, n) in enumerate(sizes):
                            if depth == d:
                                out[i:i + 1000, j] = votes[:, n - 1].argmax(axis=1)
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, max(1, len(sizes)), dtype=np.int32), out.ravel())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], lists], names=[*keep, column])

        fields = [reached.schema[c] for c in keep]
        return reached.mapInArrow(vote, StructType([*fields, StructField(column, ArrayType(DoubleType()))]))


class counted_folds:
    """The counted cells of each fold of a search (see ``binned``), made once and sent to the executors.

    ``of`` gives None where a forest must be fitted to the rows: other learners and settings, more than two classes, fewer
    rows than combinations of bins, and values or labels that Spark's own fit refuses."""

    def __init__(self, metric: str, label: str):
        self.metric, self.label, self.lock, self.locks, self.made = metric, label, Lock(), {}, {}

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        for cells in self.made.values():
            if cells:
                cells.destroy()

    def of(self, folds: DataFrame, f: int, before: list, last):
        if not self._grows(last):
            return None
        name = str((f, _but_depth(before), last.getFeaturesCol(), last.getMaxBins(), last.getSeed()))
        with self.lock:
            mine = self.locks.setdefault(name, Lock())
        with mine:
            if name not in self.made:
                ready = Pipeline(stages=before).fit(folds.where(F.col("fold") != f)).transform(folds)
                cells = self._counted(ready, f, last)
                self.made[name] = cells and folds.sparkSession.sparkContext.broadcast(cells)
            return self.made[name]

    def _grows(self, last) -> bool:
        """Whether ``binned`` grows the forest that the learner asks for."""
        if self.metric not in ("accuracy", "f1", "precision", "recall") or not isinstance(last, RandomForestClassifier):
            return False
        p = {x.name: v for x, v in last.extractParamMap().items()}
        return (p["labelCol"] == self.label and p["impurity"] == "gini" and p["subsamplingRate"] == 1.0
                and p["minInfoGain"] == p["minWeightFractionPerNode"] == 0.0 and not p.get("weightCol")
                and "thresholds" not in p and p["featureSubsetStrategy"] in ("auto", "all", "sqrt", "log2", "onethird"))

    def _counted(self, ready: DataFrame, f: int, last) -> binned.Cells | None:
        from pyspark.ml.functions import vector_to_array
        spark, bins = ready.sparkSession, last.getMaxBins()
        about = ready.schema[last.getFeaturesCol()].metadata.get("ml_attr", {})
        width, kinds = about.get("num_attrs", 0), about.get("attrs", {})
        arity = {a["idx"]: 2 for a in kinds.get("binary", [])}
        arity.update({a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in kinds.get("nominal", [])})
        if not width or not all(0 < n <= bins for n in arity.values()) or "ml_attr" in ready.schema[self.label].metadata:
            return None
        rows = ready.select(vector_to_array(last.getFeaturesCol()).alias("x"), F.col(self.label).cast("double").alias("y"), (F.col("fold") == f).alias("held"))
        train = rows.where("not held")
        n = train.count()
        # Spark's bins: of the rows that its own fit looks at for them
        share = min(1.0, max(bins * bins, 10_000) / max(1, n))
        some = train.select("x")
        if share < 1:
            draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(last.getSeed()).nextInt()
            drawn = some._jdf.rdd().sample(False, share, draw).toJavaRDD()
            some = DataFrame(spark._jsparkSession.createDataFrame(drawn, some._jdf.schema()), spark)
        values = [r.x for r in some.collect()]
        if not values or any(x is None or len(x) != width for x in values):
            return None
        values = np.array(values)
        if not np.isfinite(values).all():
            return None
        cuts = [None if j in arity else binned.thresholds(values[:, j], share * n, bins) for j in range(width)]
        radix = [arity[j] if j in arity else len(cuts[j]) + 1 for j in range(width)]
        if math.prod(radix) > min(n, binned.MOST_CELLS):
            return None
        with self.lock:
            ship_package(spark)

        def count(batches):
            import numpy as np
            import pyarrow as pa

            from loomkit.operators import binned
            held = np.zeros(math.prod(radix) * 4 + 1, np.int64)  # the last: rows that no forest takes
            for b in batches:
                x, y, out = b.column(0), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
                if x.null_count or len(x.flatten()) != len(x) * width:
                    held[-1] += 1
                    continue
                cell = binned.encode(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), cuts, arity)
                good = (cell >= 0) & ((y == 0) | (y == 1))
                held[-1] += (~good).sum()
                at = (cell[good] * 2 + y[good].astype(np.int64)) * 2 + out[good].astype(np.int64)
                held += np.bincount(at, minlength=len(held))
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["at", "n"])

        got = rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        at, number = got["at"].to_numpy(), got["n"].to_numpy()
        total = np.zeros(math.prod(radix) * 4 + 1, np.int64)
        total[at] = number
        by = total[:-1].reshape(-1, 2, 2)  # cell, class, held out
        if total[-1] or not by[:, 1].any():
            return None  # Spark's fit says what is wrong, or finds one class
        cell = np.flatnonzero(by.any(axis=(1, 2)))
        return binned.Cells(binned.decode(cell, radix), radix, [j in arity for j in range(width)],
                            np.ascontiguousarray(by[cell, :, 0]), np.ascontiguousarray(by[cell, :, 1]))

    def scores(self, spark: SparkSession, cells, last, sizes: list[tuple[int, int]]) -> list[tuple[float, float]]:
        """(test, train) score of each ``(depth, trees)`` size, from one forest grown in a task of its own."""
        least, seed, bootstrap, sizes = last.getMinInstancesPerNode(), last.getSeed(), last.getBootstrap(), list(sizes)
        strategy, width = last.getFeatureSubsetStrategy(), len(cells.value.bins)
        each = _subset_size("all" if strategy == "auto" and last.getNumTrees() == 1 else "sqrt" if strategy == "auto" else strategy, width)

        def grow(batches):
            import pyarrow as pa

            from loomkit.operators import binned
            for _ in batches:
                got = binned.confusions(cells.value, sizes, least, each, seed, bootstrap)
                yield pa.RecordBatch.from_arrays([pa.array([[int(n) for s in sizes for n in got[s].ravel()]])], names=["n"])

        rows = spark.range(0, 1, 1, 1).mapInArrow(grow, "n array<long>").first().n
        counts = np.array(rows).reshape(len(sizes), 2, 2, 2)
        return [(binned.score(test, self.metric), binned.score(train, self.metric)) for test, train in counts]


def _levels(depth) -> int | None:
    """Spark's depth for a value of the setting ``DEPTH`` (None: not a depth)."""
    return MAX_TREE_DEPTH if depth is None else min(depth, MAX_TREE_DEPTH) if isinstance(depth, int) and depth >= 0 else None


def _but_depth(stages) -> list:
    """What sets the stages of a pipeline apart from others, without the depth."""
    return [(type(s), {p.name: str(v) for p, v in s.extractParamMap().items() if p.name != "maxDepth"}) for s in stages]


class TrialStore:
    """Scores of finished fits, one folder a fit under ``path``: a fit that is repeated replaces its own rows."""

    SCHEMA = "fold long, trees long, test_score double, train_score double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def search_id(df: DataFrame, *facts) -> str:
        """Names the data (row count and a sum of row hashes), the folds and the metric; not the settings tried."""
        usable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType)]
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*usable).cast("decimal(38,0)"))).first()
        return hashlib.sha256(json.dumps([df.schema.simpleString(), str(r[0]), str(r[1]), *map(str, facts)]).encode()).hexdigest()[:16]

    def _folder(self, search: str) -> str:
        return os.path.join(self.path, f"search={search}")

    def scores(self, search: str) -> DataFrame:
        """(unit, fold, trees, test_score, train_score) of a search's finished fits."""
        folder = self._folder(search)
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = []
        if fs.exists(p):  # a folder without its mark is a write that was broken off
            units = [x.getPath().getName() for x in fs.listStatus(p)]
            done = [os.path.join(folder, u) for u in units if fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(folder, u, "_SUCCESS")))]
        if not done:
            return self.spark.createDataFrame([], "unit string, " + self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA + ", unit string").option("basePath", folder).parquet(*done).select(
            "unit", "fold", "trees", "test_score", "train_score")

    def add(self, search: str, unit: str, rows: list[tuple]) -> None:
        df = self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1)
        df.write.mode("overwrite").parquet(os.path.join(self._folder(search), f"unit={unit}"))


def _settings(row: dict) -> dict:
    return {n: _parse(v) for n, v in row.items() if n != "trial_id"}


def most_trees(rows: list[dict]) -> int:
    """The largest number of trees among trials (0: not forests)."""
    return max((n for r in rows if isinstance(n := _settings(r).get(NESTED), int)), default=0)


def cross_validate(df: DataFrame, trials: DataFrame, make_pipeline, label: str, k: int = 3,
                   metric: str = "accuracy", keys=None, seed: int = 42, parallelism: int | None = None,
                   stratify: bool = True, folds: DataFrame | None = None, store: TrialStore | None = None,
                   counted: counted_folds | None = None) -> DataFrame:
    """H2 core: per (trial, fold) test and train scores, as a Spark table.

    ``make_pipeline(params: dict) -> Pipeline``.  Trials with equal
    fit-relevant settings share their fits (those that try equally many
    features per split too), and trials that differ only in
    their number of trees share the largest of them, of which the smaller are
    prefixes; those that differ only in depth are cut from the deepest.  ``folds``: ``df`` with its fold column, if the caller has cached
    it already, and ``counted`` their counts.  ``store``: where scores are kept and looked up.
    """
    spark = df.sparkSession
    from contextlib import ExitStack

    from .models import cached, concurrency
    rows = [r.asDict() for r in trials.orderBy("trial_id").collect()]  # one row per trial (bounded)
    if metric not in CV_METRICS:
        raise ValueError(f"metric must be one of {sorted(CV_METRICS)}")
    params = [dict(fit_key(_settings(r))) for r in rows]
    alike = _alike_subsets(df, params, make_pipeline)
    fits = []  # of every trial: the setting fitted and the number of trees
    sizes: dict[tuple, set] = {}
    for p in params:
        n = p.pop(NESTED, None)
        if SUBSET in p:
            p[SUBSET] = alike[p[SUBSET]]
        fits.append((tuple(sorted(p.items())), n))
        sizes.setdefault(fits[-1][0], set()).add(n)
    # one unit of work: all sizes of one setting on one fold
    unit = lambda key, f: hashlib.sha256(json.dumps([key, sorted(map(str, sizes[key])), f]).encode()).hexdigest()[:24]
    jobs = {unit(key, f): (key, f) for key in sizes for f in range(k)}
    done: dict[tuple, tuple] = {}  # (setting, fold, trees) -> scores
    search = store and store.search_id(df, label, k, metric, keys, seed, stratify)
    if store:
        for r in store.scores(search).where(F.col("unit").isin(list(jobs))).collect():  # a number per finished fit
            done[jobs[r.unit][0], r.fold, r.trees] = (r.test_score, r.train_score)
    todo = [(u, key, f) for u, (key, f) in jobs.items() if any((key, f, n) not in done for n in sizes[key])]
    # settings that differ only in their depth come from the deepest of them; the longest fits begin first
    alone: dict[tuple, list] = {}
    for u, key, f in todo:
        p = dict(key)
        n = max((n for n in sizes[key] if n is not None), default=None)
        nests = DEPTH in p and _levels(p[DEPTH]) is not None and None not in sizes[key]
        alone.setdefault((tuple((k, v) for k, v in key if k != DEPTH), n, f) if nests else (u,), []).append((u, key, f))
    depth = lambda key: _levels(dict(key).get(DEPTH)) or 0
    work = lambda job: depth(job[1]) * max((n for n in sizes[job[1]] if isinstance(n, int)), default=1)
    groups = sorted((sorted(g, key=lambda job: -depth(job[1])) for g in alone.values()), key=lambda g: -work(g[0]))
    counts_of = lambda key: sorted(sizes[key], key=lambda n: -1 if n is None else n)

    def fit(stages, key, f, others):
        """Scores of a setting's sizes, and of other settings that can be cut from its forest, by (setting, trees)."""
        counts = counts_of(key)
        *before, last = stages
        cells = counted.of(folds, f, before, last)
        if cells:
            names = [(o, n) for o in [key, *(others if last.getMaxDepth() == depth(key) else [])] for n in counts_of(o)]
            sizes_of = [(last.getMaxDepth() if o == key else depth(o), n or last.getNumTrees()) for o, n in names]
            return dict(zip(names, counted.scores(spark, cells, last, sizes_of)))
        with rows_fitted:
            return fit_rows(stages, key, f, others)

    def fit_rows(stages, key, f, others):
        counts = counts_of(key)
        train = folds.where(F.col("fold") != f)
        part = F.when(F.col("fold") == f, F.lit("test")).otherwise(F.lit("train"))
        *before, last = stages
        names, cut = [(key, n) for n in counts], None
        if isinstance(last, (RandomForestClassifier, RandomForestRegressor)):
            ready = Pipeline(stages=before).fit(train)
            forest, scored = last._fit_java(ready.transform(train)), ready.transform(folds)
            nest = isinstance(last, RandomForestClassifier) and last.getMaxDepth() == depth(key) and forest.totalNumNodes() <= MOST_NODES
            if others and nest:
                names += [(o, n) for o in others for n in counts_of(o)]
                cut = cut_forest(spark, forest, [(depth(o), n) for o, n in names])
                scored = cut.transform(scored.select(part.alias("_p"), F.col(label), last.getFeaturesCol()), ["_p", label], "_each")
            else:
                columns = [f"_of_{i}" for i in range(len(counts))]
                for n, c in zip(counts, columns):
                    scored = first_trees(forest, forest.getNumTrees() if n is None else n, c).transform(scored)
        elif len(counts) == 1:
            scored, columns = Pipeline(stages=stages).fit(train).transform(folds), ["prediction"]
        else:
            raise ValueError(f"only forests nest: {NESTED} varies, but the last stage is {type(last).__name__}")
        if not cut:
            scored = scored.select(part.alias("_p"), F.col(label), F.array(*[F.col(c).cast("double") for c in columns]).alias("_each"))
        scored = scored.select("_p", F.col(label), F.posexplode("_each").alias("_i", "prediction")).select(
            F.concat_ws(":", "_p", F.col("_i").cast("string")).alias("_part"), label, "prediction")
        # test and train scores of every size from one pass over the scored folds
        got = fold_scores(scored, label, metric)
        if cut:
            cut.model.destroy()
        return {name: (got[f"test:{i}"], got[f"train:{i}"]) for i, name in enumerate(names)}

    def run(group):
        out, known, deepest = [], {}, None
        for u, key, f in group:
            n = counts_of(key)[-1]
            stages = make_pipeline({**dict(key), **({} if n is None else {NESTED: n})}).getStages()
            if not ((key, n) in known and stages[-1].getMaxDepth() == depth(key) and _but_depth(stages) == deepest):
                others = [o for _, o, _ in group if o != key] if not known else []
                known = {**known, **fit(stages, key, f, others)}
                deepest = deepest or _but_depth(stages)
            rows = [(f, n, *known[key, n]) for n in counts_of(key)]
            if store:
                store.add(search, u, rows)
            out.append((key, rows))
        gc.collect(0)  # lets go of the JVM's models
        return out

    with ExitStack() as stack:
        if todo:
            # the input and its fold assignment are each computed once and cached
            if folds is None:
                d = stack.enter_context(cached(df))
                folds = stack.enter_context(cached(stratified_kfold(d, label if stratify else None, keys, k, seed), most_trees(rows)))
            counted = counted or stack.enter_context(counted_folds(metric, label))
            # two at least: while the driver grows the trees of one forest, the cluster works on another
            rows_fitted = Semaphore(concurrency(spark, len(groups), parallelism, folds.rdd.getNumPartitions(), least=2))
            # a forest grown over counts takes one core
            with ThreadPoolExecutor(max_workers=concurrency(spark, len(groups), parallelism)) as pool:
                for group in pool.map(run, groups):
                    done.update({(key, f, n): (te, tr) for key, out in group for f, n, te, tr in out})
    out = [(int(r["trial_id"]), f, *done[key, f, n]) for r, (key, n) in zip(rows, fits) for f in range(k)]
    schema = StructType([StructField("trial_id", LongType()), StructField("fold", LongType()),
                         StructField("test_score", DoubleType()), StructField("train_score", DoubleType())])
    return spark.createDataFrame(out, schema)


def summarize_trials(scores: DataFrame, trials: DataFrame | None = None, higher_is_better: bool = True) -> DataFrame:
    """Per trial: mean / std (population) of test and train scores and a rank."""
    s = scores.groupBy("trial_id").agg(
        F.avg("test_score").alias("mean_test_score"), F.stddev_pop("test_score").alias("std_test_score"),
        F.avg("train_score").alias("mean_train_score"), F.count(F.lit(1)).alias("n_folds"))
    o = F.col("mean_test_score").desc() if higher_is_better else F.col("mean_test_score").asc()
    # one row per trial: the ranking window covers the (small) trials table
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(o, F.col("trial_id"))))
    return trials.join(s, "trial_id") if trials is not None else s


def best_trial(scores: DataFrame, score: str = "test_score", higher_is_better: bool = True) -> DataFrame:
    """H5: the trial with the best mean score over folds (ties to the
    lowest trial id); ``loss = -mean`` for minimizers."""
    s = scores.groupBy("trial_id").agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"),
                                       F.count(F.lit(1)).alias("n_folds"))
    key = F.col("mean_score") if higher_is_better else -F.col("mean_score")
    top = s.agg(F.max_by(F.struct("trial_id", "mean_score", "std_score", "n_folds"),
                         F.struct(key, -F.col("trial_id"))).alias("b")).select("b.*")
    return top.withColumn("loss", -F.col("mean_score") if higher_is_better else F.col("mean_score"))


def _search(df, trials, make_pipeline, label, k, metric, keys, seed, parallelism, higher, store=None):
    scores = cross_validate(df, trials, make_pipeline, label, k, metric, keys, seed, parallelism, store=store)
    return summarize_trials(scores, trials, higher_better(metric) if higher is None else higher)


def grid_search(df, space, make_pipeline, label, k=3, metric="accuracy", keys=None, seed=42,
                parallelism=None, higher_is_better=None, store: TrialStore | None = None) -> DataFrame:
    """H2: CV score of every combination (mean, std, train score) ranked.

    Smaller forests are prefixes of the largest one with the same other settings.
    With a ``store``, what it holds of this search is not fitted again."""
    trials = param_grid(df.sparkSession, space)
    return _search(df, trials, make_pipeline, label, k, metric, keys, seed, parallelism, higher_is_better, store)


def random_search(df, ranges, make_pipeline, label, n_trials=20, k=3, metric="accuracy", keys=None,
                  seed=42, parallelism=None, higher_is_better=None) -> DataFrame:
    """H3: ``n_trials`` seeded draws, then cross-validated like H2."""
    trials = random_trials(df.sparkSession, ranges, n_trials, seed)
    return _search(df, trials, make_pipeline, label, k, metric, keys, seed, parallelism, higher_is_better)


def _densities(values: list, at: list, kind) -> np.ndarray:
    """Parzen density of ``values`` at ``at``: Gaussian kernels for a range, smoothed shares for choices."""
    if isinstance(kind, list):
        names = [str(v) for v in kind]
        share = np.array([1.0 + sum(str(v) == n for v in values) for n in names])
        return (share / share.sum())[[names.index(str(v)) for v in at]]
    width = max(1.0, (kind[1] - kind[0]) / 5.0)
    d = (np.array(at, float)[:, None] - np.array(values, float)[None, :]) / width
    return np.exp(-0.5 * d * d).mean(axis=1) + 1e-12


def adaptive_search(df, ranges, make_pipeline, label, n_trials=20, n_startup=8, batch=4, gamma=0.25,
                    n_candidates=64, k=3, metric="accuracy", keys=None, seed=42, parallelism=None,
                    higher_is_better=None) -> DataFrame:
    """H4: sequential model-based search in rounds (tree-structured Parzen
    style).  ``ranges`` holds ``(low, high)`` integer ranges and lists of choices.
    Start with ``n_startup`` seeded draws; each round splits past trials into
    good (best ``gamma`` share) and bad, draws ``n_candidates`` fresh candidates,
    scores them by the ratio of Parzen densities l(x)/g(x) per setting, and
    cross-validates the best ``batch`` in parallel.  The folds are computed once.
    Only the proposal runs on the driver (over the trials table)."""
    from .models import cached

    spark = df.sparkSession
    names = list(ranges)
    higher = higher_better(metric) if higher_is_better is None else higher_is_better
    rounds = max(0, -(-(n_trials - n_startup) // batch))
    pool = random_trials(spark, ranges, n_startup + rounds * n_candidates, seed)  # bounded by the search's own settings
    drawn = [r.asDict() for r in pool.orderBy("trial_id").collect()]
    trees, drawn = most_trees(drawn), [[r[n] for n in names] for r in drawn]
    history: list[tuple[list, float]] = []
    tables: list[tuple[DataFrame, DataFrame]] = []
    with cached(df) as d, cached(stratified_kfold(d, label, keys, k, seed), trees) as folds, counted_folds(metric, label) as counted:
        while len(history) < n_trials:
            if not history:
                pick = drawn[:min(n_startup, n_trials)]
            else:
                past = sorted(history, key=lambda h: -h[1] if higher else h[1])
                n_good = max(1, int(math.ceil(gamma * len(past))))
                good = [h[0] for h in past[:n_good]]
                bad = [h[0] for h in past[n_good:]] or good
                start = n_startup + (len(tables) - 1) * n_candidates
                fresh = drawn[start:start + n_candidates]
                ratio = sum(np.log(_densities([g[c] for g in good], [f[c] for f in fresh], ranges[n]))
                            - np.log(_densities([b[c] for b in bad], [f[c] for f in fresh], ranges[n])) for c, n in enumerate(names))
                order = np.argsort(-ratio, kind="stable")
                pick = [fresh[i] for i in order[:min(batch, n_trials - len(history))]]
            first = len(history)
            schema = "trial_id long, " + ", ".join(f"`{n}` string" for n in names)
            t = spark.createDataFrame([(first + i, *p) for i, p in enumerate(pick)], schema)
            sc = cross_validate(df, t, make_pipeline, label, k, metric, keys, seed, parallelism, folds=folds, counted=counted)
            means = {r["trial_id"]: r["m"] for r in sc.groupBy("trial_id").agg(F.avg("test_score").alias("m")).collect()}
            history += [(p, means[first + i]) for i, p in enumerate(pick)]
            tables.append((t, sc))
    trials, scores = tables[0]
    for t, sc in tables[1:]:
        trials, scores = trials.unionByName(t), scores.unionByName(sc)
    return summarize_trials(scores, trials, higher)


def best_params(summary: DataFrame) -> dict:
    """The rank-1 trial's settings (one row to the driver)."""
    r = summary.where(F.col("rank") == 1).first().asDict()
    skip = {"trial_id", "mean_test_score", "std_test_score", "mean_train_score", "n_folds", "rank"}
    return {k: _parse(v) for k, v in r.items() if k not in skip}


def final_evaluation(split_df: DataFrame, params: dict, make_pipeline, label: str,
                     metric: str = "accuracy", split_col: str = "split") -> DataFrame:
    """H6: refit on train with the best settings, score test and validation."""
    from .metrics import accuracy, precision_recall_f1, regression_metrics
    from .models import cached
    if metric not in CV_METRICS:
        raise ValueError(f"metric must be one of {sorted(CV_METRICS)}")
    with cached(split_df.where(F.col(split_col) == "train"), most_trees([params])) as train:
        model = make_pipeline(params).fit(train)
    scored = model.transform(split_df.where(F.col(split_col) != "train"))
    if metric == "accuracy":
        return accuracy(scored, label, "prediction", [split_col])
    if metric in ("f1", "precision", "recall"):
        return precision_recall_f1(scored, label, "prediction", [split_col]).where(F.col("class") == "weighted").drop("class")
    return regression_metrics(scored, label, "prediction", [split_col])
