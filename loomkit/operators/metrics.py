"""Evaluation metrics as aggregates.

Inputs are prediction tables: a label column, a prediction column and
optionally a probability / score column, plus any grouping columns (e.g.
``split``).  Every metric is one or two aggregates grouped by those
columns; nothing is collected.

Clustering metrics take a ``features`` array column, a ``cluster`` column
and grouping columns.  One aggregate gives every cluster's size, mean,
variances and vector lengths; vectors that are NULL or of different lengths
are an error, never left out.  Inertia and Calinski-Harabasz need nothing
else; Davies-Bouldin and the silhouette read the rows once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_LOSS_EPS = 1e-15  # fixed value: the clip of the usual library


def _g(group):
    return list(group or [])


# ---------------------------------------------------------------- E1-E4
def accuracy(df: DataFrame, label="label", prediction="prediction", group=None) -> DataFrame:
    """Share of rows predicted right."""
    ok = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.groupBy(*_g(group)).agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def _class_key(df: DataFrame, c: str) -> Column:
    """Numeric classes compare as doubles (so 1 and 1.0 are one class)."""
    from pyspark.sql.types import NumericType
    return F.col(c).cast("double") if isinstance(df.schema[c].dataType, NumericType) else F.col(c)


def confusion(df: DataFrame, label="label", prediction="prediction", group=None) -> DataFrame:
    """Label x prediction counts."""
    return df.groupBy(*_g(group), _class_key(df, label).alias("label"),
                      _class_key(df, prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n_rows"))


def precision_recall_f1(df: DataFrame, label="label", prediction="prediction", group=None) -> DataFrame:
    """Per class precision / recall / f1 / support, plus a
    support-weighted row (``class = 'weighted'``).  Undefined ratios are 0."""
    g = _g(group)
    c = confusion(df, label, prediction, g).withColumn("label", F.col("label").cast("string")) \
        .withColumn("prediction", F.col("prediction").cast("string"))
    t = c.groupBy(*g, F.col("label").alias("class")).agg(
        F.sum("n_rows").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0)).alias("tp"))
    p = c.groupBy(*g, F.col("prediction").alias("class")).agg(F.sum("n_rows").alias("predicted"))
    j = t.unionByName(p, allowMissingColumns=True).groupBy(*g, "class").agg(  # a NULL group or class is one like any other
        *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("support", "tp", "predicted")])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    j = j.select(*g, "class", prec.alias("precision"), rec.alias("recall"),
                 F.col("support").cast("bigint").alias("support"))
    j = j.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                  2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(F.lit(0.0)))
    w = j.groupBy(*g).agg(
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        F.sum("support").cast("bigint").alias("support"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
    w = w.select(*g, F.lit("weighted").alias("class"), "precision", "recall", "support", "f1")
    return j.unionByName(w)


def mcc(df: DataFrame, label="label", prediction="prediction", group=None) -> DataFrame:
    """Multi-class Matthews correlation from the confusion counts."""
    g = _g(group)
    c = confusion(df, label, prediction, g).withColumn("label", F.col("label").cast("string")) \
        .withColumn("prediction", F.col("prediction").cast("string"))
    t = c.groupBy(*g, F.col("label").alias("k")).agg(F.sum("n_rows").alias("t"))
    p = c.groupBy(*g, F.col("prediction").alias("k")).agg(F.sum("n_rows").alias("p"))
    each = t.unionByName(p, allowMissingColumns=True).groupBy(*g, "k").agg(
        *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("t", "p")])
    tp = each.groupBy(*g).agg(
        F.sum(F.col("t").cast("double") * F.col("p")).alias("tp_sum"),
        F.sum(F.col("t").cast("double") * F.col("t")).alias("t2"),
        F.sum(F.col("p").cast("double") * F.col("p")).alias("p2"))
    tot = c.groupBy(*g).agg(F.sum("n_rows").cast("double").alias("s"),
                            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0))
                            .cast("double").alias("cor"))
    j = _on(tot, tp, g) if g else tot.select(
        "*", *[tp.select(c).scalar().alias(c) for c in ("tp_sum", "t2", "p2")])
    den = F.sqrt((F.col("s") * F.col("s") - F.col("p2")) * (F.col("s") * F.col("s") - F.col("t2")))
    return j.select(*g, F.when(den > 0, (F.col("cor") * F.col("s") - F.col("tp_sum")) / den)
                    .otherwise(F.lit(0.0)).alias("mcc"))


# ---------------------------------------------------------------- E5, E6
def log_loss(df: DataFrame, label="label", prob_cols=None, group=None, eps=LOG_LOSS_EPS) -> DataFrame:
    """E5: mean of -ln(p of the true class), p clipped to [eps, 1-eps].
    ``prob_cols[i]`` is the probability of class ``i``.  A row without a
    probability for its class (NULL, or a class outside ``prob_cols``) is an error."""
    chain = None
    for i, pc in enumerate(prob_cols):
        cond = F.col(label).cast("int") == F.lit(i)
        chain = F.when(cond, F.col(pc)) if chain is None else chain.when(cond, F.col(pc))
    known = F.coalesce(chain.cast("double"), F.raise_error(F.lit("no probability for a row's class")).cast("double"))
    p = F.least(F.greatest(known, F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*_g(group)).agg(F.avg(-F.log(p)).alias("log_loss"))


def roc_auc(df: DataFrame, label="label", score="score", group=None) -> DataFrame:
    """Exact ROC AUC, ties averaged (Mann-Whitney), positives = label 1.

    Per distinct score: positives and negatives (partial aggregation).  The
    distinct scores are range-partitioned (Spark samples the quantiles, so an
    outlier moves no bounds) and written once; the partition number is the
    bucket.  A running sum over the buckets' totals gives each bucket's
    offset, and the running sum inside a bucket is over its scores only.

    NULL or NaN scores are an error; a group with one class has no AUC (NULL).
    """
    from ..session import materialize

    g = _g(group)
    s = F.col(score).cast("double")
    s = F.when(F.isnotnull(s) & ~F.isnan(s), s).otherwise(F.raise_error(F.lit("a row has no score")).cast("double"))
    y = F.col(label).cast("int")
    d = df.groupBy(*g, s.alias("_s")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("double").alias("_p"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("double").alias("_n"))
    d = materialize(d.repartitionByRange(*g, "_s").withColumn("_b", F.spark_partition_id()), "auc-scores")
    bt = d.groupBy(*g, "_b").agg(F.sum("_n").alias("_bn"))
    run = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bt = bt.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_b").alias("_bb"),
                   (F.sum("_bn").over(run) - F.col("_bn")).alias("_off"))
    cond = d["_b"] == bt["_bb"]
    for i, c in enumerate(g):
        cond = cond & d[c].eqNullSafe(bt[f"_g{i}"])
    d = d.join(bt, cond)
    inb = Window.partitionBy(*g, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_below", F.col("_off") + F.sum("_n").over(inb) - F.col("_n"))
    return d.groupBy(*g).agg(F.try_divide(
        F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2)), F.sum("_p") * F.sum("_n")).alias("roc_auc"))


# ---------------------------------------------------------------- E7
def regression_metrics(df: DataFrame, label="label", prediction="prediction", group=None) -> DataFrame:
    """r2, rmse, mse, mae, explained_variance in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    r = y - p
    a = df.groupBy(*_g(group)).agg(
        F.avg(r * r).alias("mse"), F.avg(F.abs(r)).alias("mae"), F.var_pop(y).alias("_vy"),
        F.var_pop(r).alias("_vr"), F.count(F.lit(1)).alias("n_rows"))
    return a.select(
        *_g(group),
        F.when(F.col("_vy") > 0, 1 - F.col("mse") / F.col("_vy")).otherwise(F.lit(0.0)).alias("r2"),
        F.sqrt("mse").alias("rmse"), "mse", "mae",
        F.when(F.col("_vy") > 0, 1 - F.col("_vr") / F.col("_vy")).otherwise(F.lit(0.0)).alias("explained_variance"),
        "n_rows")


# ---------------------------------------------------------------- clustering
_RAGGED = "feature vectors are missing or of different lengths"


def _vector(features: str) -> Column:
    """The feature array as an ML vector; NULL arrays and NULL components are errors."""
    from pyspark.ml.functions import array_to_vector
    v = F.col(features).cast("array<double>")
    whole = F.isnotnull(v) & F.forall(v, lambda x: F.isnotnull(x))
    return array_to_vector(F.when(whole, v).otherwise(F.raise_error(F.lit(_RAGGED)).cast("array<double>")))


def cluster_stats(df: DataFrame, features="features", cluster="cluster", group=None) -> DataFrame:
    """Per (group, cluster): n, centroid, within (sum of squared distances to
    the centroid) and width, in one aggregate.  Vectors of different lengths
    inside a cluster make the summarizer fail; across clusters ``width`` shows it."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    s = Summarizer.metrics("mean", "variance").summary(_vector(features))
    a = df.groupBy(*_g(group), cluster).agg(F.count(F.lit(1)).alias("n"), s.alias("_s"), F.min(F.size(features)).alias("width"))
    spread = F.aggregate(vector_to_array("_s.variance"), F.lit(0.0), lambda t, v: t + v)
    return a.select(*_g(group), cluster, "n", vector_to_array("_s.mean").alias("centroid"),
                    (spread * (F.col("n") - 1)).alias("within"), "width")


def _even(value: Column) -> Column:
    """``value`` of an aggregate over clusters, provided that all have the same width."""
    return F.when(F.min("width") == F.max("width"), value).otherwise(F.raise_error(F.lit(_RAGGED)).cast("double"))


def _sqdist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def _on(left: DataFrame, right: DataFrame, names: list[str], how="inner") -> DataFrame:
    """Join on equal (or both NULL) ``names``, keeping the left side's columns of that name."""
    r = right.select(*[F.col(c).alias(f"_j{i}") if c in names else F.col(c) for i, c in enumerate(right.columns)])
    cond = None
    for i, c in enumerate(right.columns):
        if c in names:
            x = left[c].eqNullSafe(r[f"_j{i}"])
            cond = x if cond is None else cond & x
    out = left.join(r, cond, how) if names else left.join(r, how=how)
    return out.drop(*[f"_j{i}" for i in range(len(right.columns))])


def inertia(df: DataFrame, features="features", cluster="cluster", group=None) -> DataFrame:
    """Sum of squared distances to the own centroid (one pass)."""
    return cluster_stats(df, features, cluster, group).groupBy(*_g(group)).agg(_even(F.sum("within")).alias("inertia"))


def calinski_harabasz(df: DataFrame, features="features", cluster="cluster", group=None) -> DataFrame:
    """(between / (k-1)) / (within / (n-k)); higher is better (one pass).
    1 when there is one cluster or no spread within the clusters."""
    g = _g(group)
    st = cluster_stats(df, features, cluster, g)
    cells = st.select(*g, "n", "within", "width", F.posexplode("centroid").alias("i", "m"))
    w = Window.partitionBy(*g, "i")
    mean = F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w)
    cells = cells.withColumn("_b", F.col("n") * (F.col("m") - mean) * (F.col("m") - mean))
    first = F.col("i") == 0  # a cluster's own figures count once
    a = cells.groupBy(*g).agg(_even(F.sum("_b")).alias("_b"), F.sum(F.when(first, F.col("within"))).alias("_w"),
                              F.count(F.when(first, 1)).alias("_k"), F.sum(F.when(first, F.col("n"))).alias("_n"))
    value = F.try_divide(F.col("_b") / (F.col("_k") - 1), F.try_divide(F.col("_w"), F.col("_n") - F.col("_k")))
    return a.select(*g, F.when((F.col("_w") > 0) & (F.col("_k") > 1), value).otherwise(F.lit(1.0)).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, features="features", cluster="cluster", group=None) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d(c_i, c_j); s_i =
    mean distance to the own centroid.  Clusters whose centroids coincide
    have ratio 0, as in the usual library; a group with one cluster is an error."""
    from ..session import materialize

    g = _g(group)
    st = cluster_stats(df, features, cluster, g)
    j = _on(df.select(*g, cluster, features), st.select(*g, cluster, "centroid", "width"), [*g, cluster])
    s = j.groupBy(*g, cluster).agg(F.avg(F.sqrt(_sqdist(F.col(features), F.col("centroid")))).alias("s"),
                                   F.first("centroid").alias("centroid"), F.first("width").alias("width"))
    s = materialize(s, "db-clusters")  # read for both sides of the centroid comparison
    every = s.groupBy(*g).agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "s", "centroid")).alias("_all"))
    me = _on(s, every, g)
    ratio = lambda o: F.coalesce(F.try_divide(F.col("s") + o["s"], F.sqrt(_sqdist(F.col("centroid"), o["centroid"]))), F.lit(0.0))
    worst = F.array_max(F.transform(F.filter("_all", lambda o: ~o["c"].eqNullSafe(F.col(cluster))), ratio))
    worst = F.coalesce(worst, F.raise_error(F.lit("Davies-Bouldin compares clusters: a group has only one")).cast("double"))
    return me.groupBy(*g).agg(_even(F.avg(worst)).alias("davies_bouldin"))


def silhouette_squared(df: DataFrame, features="features", cluster="cluster", group=None) -> DataFrame:
    """Silhouette with squared Euclidean distance, in closed form from
    per-cluster statistics (linear cost; the exact Euclidean form needs every
    pair of rows and is not built).

    Mean squared distance from x to the members of cluster C:
    |x - c|^2 + W/n with c the centroid and W the sum of squared distances to
    it (own cluster: n/(n-1) times that, over the other members).
    Singletons, one-cluster groups and rows at distance 0 from both score 0.
    """
    g = _g(group)
    st = cluster_stats(df, features, cluster, g)
    every = st.groupBy(*g).agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "n", "centroid", "within")).alias("_all"),
                               _even(F.lit(0.0)).alias("_ok"))
    x = _on(df.select(*g, F.col(cluster).alias("_own"), F.col(features).alias("_f")), every, g)

    def mean_d(o):
        d = _sqdist(F.col("_f"), o["centroid"]) + o["within"] / o["n"]
        return F.when(o["c"].eqNullSafe(F.col("_own")), F.when(o["n"] > 1, d * o["n"] / (o["n"] - 1))).otherwise(d)

    per = x.select(
        *g, "_ok",
        F.aggregate(F.filter("_all", lambda o: o["c"].eqNullSafe(F.col("_own"))), F.lit(None).cast("double"),
                    lambda acc, o: mean_d(o)).alias("_a"),
        F.array_min(F.transform(F.filter("_all", lambda o: ~o["c"].eqNullSafe(F.col("_own"))), mean_d)).alias("_b"))
    val = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0)))
    return per.groupBy(*g).agg((F.avg(val) + F.max("_ok")).alias("silhouette_squared"))


# ---------------------------------------------------------------- E13-E15
def reconstruction_error(df: DataFrame, reconstructed: DataFrame | None = None, key: str | None = None,
                         features="features", recon="reconstruction", group=None) -> DataFrame:
    """Mean squared cell error between a row and its reconstruction.
    With ``reconstructed=None`` both arrays are columns of ``df`` (no join);
    otherwise the two tables are joined on ``key``."""
    g = _g(group)
    if reconstructed is not None:
        r = reconstructed.select(key, F.col(recon).alias("_rec"))
        j = df.join(r, key)
    else:
        j = df.withColumn("_rec", F.col(recon))
    return j.groupBy(*g).agg((F.sum(_sqdist(F.col(features), F.col("_rec"))) / F.sum(F.size(features)))
                             .alias("reconstruction_error"))


def anomaly_metrics(df: DataFrame, score="score", threshold: float = 0.0, label: str | None = None,
                    group=None) -> DataFrame:
    """Mean score, contamination rate (share flagged: score > threshold),
    and precision / recall of the flag against a 0/1 label when given."""
    flag = F.col(score) > F.lit(threshold)
    aggs = [F.avg(score).alias("mean_score"), F.avg(flag.cast("double")).alias("contamination"),
            F.count(F.lit(1)).alias("n_rows")]
    if label:
        y = F.col(label).cast("int") == 1
        tp = F.sum((flag & y).cast("double"))
        aggs += [F.try_divide(tp, F.sum(flag.cast("double"))).alias("precision"),  # NULL: nothing flagged
                 F.try_divide(tp, F.sum(y.cast("double"))).alias("recall")]
    return df.groupBy(*_g(group)).agg(*aggs)
