"""Queries M1-M7, E13-E14 and H1-H6 (fits are checked by rows; the
deterministic parts by value)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ...operators import metrics as E
from ...operators import models as M
from ...operators import splits as S
from ...operators import tuning as H
from ...operators.features import assemble_features
from ...operators.scoring import predict_batch
from ..tables import quality_view, table

QF = ["letter_share", "n_chars", "lang"]


def _quality_split(spark, sf):
    """Split feature table, written once (text features are computed once)."""
    from ...session import materialize
    q = quality_view(spark, sf)
    return materialize(S.split_three_way(q, keys=["doc_id"], label="quality", test_size=0.2,
                                         validation_size=0.1), "quality_split")


def _train_test(spark, sf):
    s = _quality_split(spark, sf)
    return s.where("split = 'train'"), s.where("split != 'train'")


def q_assemble_features(spark, sf):
    q = quality_view(spark, sf)
    from pyspark.ml.functions import vector_to_array
    model = Pipeline(stages=assemble_features(q, QF, "quality")).fit(q)
    return model.transform(q).select("doc_id", vector_to_array("features").alias("features"))


def _scored(model, test):
    return predict_batch(model, test, keep_inputs=True).select("doc_id", "split", "quality", "prediction")


def q_train_random_forest(spark, sf):
    tr, te = _train_test(spark, sf)
    return _scored(M.train_random_forest(tr, QF, "quality"), te)


def q_train_random_forest_regressor(spark, sf):
    p = S.split_random(table(spark, sf, "part"), keys=["p_partkey"])
    m = M.train_random_forest_regressor(p.where("split = 'train'"), ["p_partkey", "p_size"], "p_retailprice")
    return E.regression_metrics(m.transform(p.where("split = 'test'")), "p_retailprice", "prediction")


def q_train_gbt(spark, sf):
    tr, te = _train_test(spark, sf)
    return _scored(M.train_gbt(tr, QF, "quality"), te)


def q_train_mlp(spark, sf):
    tr, te = _train_test(spark, sf)
    return _scored(M.train_mlp(tr, ["letter_share", "n_chars"], "quality", hidden=(4,), num_classes=2), te)


def q_train_kmeans(spark, sf):
    e = table(spark, sf, "embeddings")
    m = M.train_kmeans(e, ["embedding"], k=3, max_iter=300, seed=42, n_init=10)
    return m.transform(e).select("vec_id", "cluster")


def q_train_pca(spark, sf):
    e = table(spark, sf, "embeddings")
    m = M.train_pca(e, ["embedding"], k=2)
    from pyspark.ml.functions import vector_to_array
    return m.transform(e).select("vec_id", vector_to_array("pca").alias("scores"))


def q_explained_variance_ratio(spark, sf):
    e = table(spark, sf, "embeddings")
    m = M.train_pca(e, ["embedding"], k=2)
    ratio = M.explained_variance_ratio(m)
    return e.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(ratio).alias("explained_variance_ratio"), F.lit(2).alias("n_components"), "n_rows")


def _clustered(spark, sf):
    """Embeddings split, k-means fitted on the train part, every row with its fitted cluster."""
    from ...session import materialize
    e = S.split_bernoulli(table(spark, sf, "embeddings"), keys=["vec_id"], test_size=0.2, validation_size=0.1)
    m = M.train_kmeans(e.where("split = 'train'"), ["embedding"], k=3, max_iter=300, seed=42, n_init=10)
    return materialize(m.transform(e).select("vec_id", "split", "embedding", "cluster"), "clustered")


def q_cluster_scores_by_split(spark, sf):
    """E8, E9, E11 and E12 of the fitted clusters on train, test and validation."""
    c = _clustered(spark, sf)
    out = None
    for metric in (E.silhouette_squared, E.davies_bouldin, E.calinski_harabasz, E.inertia):
        m = metric(c, "embedding", "cluster", ["split"])
        out = m if out is None else out.join(m, "split")
    return out


def q_pca_error_by_split(spark, sf):
    """E13 and E14 of the fitted PCA, on train and test."""
    e = S.split_bernoulli(table(spark, sf, "embeddings"), keys=["vec_id"], test_size=0.2)
    model = M.train_pca(e.where("split = 'train'"), ["embedding"], k=2)
    pc, mean = M.pca_parts(model)
    rec = M.reconstruct(M.project(e, "embedding", pc, mean), "scores", pc, mean)
    err = E.reconstruction_error(rec, features="embedding", recon="reconstruction", group=["split"])
    return err.withColumn("explained_variance_ratio", F.lit(M.explained_variance_ratio(model)))


def q_reconstruction_error(spark, sf):
    """E14 with a fixed projection (the first two coordinate axes), fitted
    mean from the train part; error per split."""
    e = S.split_bernoulli(table(spark, sf, "embeddings"), keys=["vec_id"], test_size=0.2)
    dim = 64
    mean = M.column_means(e.where("split = 'train'"), "embedding", dim)
    comps = [[1.0 if (i == j) else 0.0 for j in range(2)] for i in range(dim)]
    rec = M.reconstruct(M.project(e, "embedding", comps, mean), "scores", comps, mean)
    return E.reconstruction_error(rec, features="embedding", recon="reconstruction", group=["split"])


def rf_pipeline_for(df):
    def make(p):
        return M.random_forest_pipeline(df, QF, "quality", **{k: v for k, v in p.items()
                                                             if k in ("n_estimators", "max_depth",
                                                                      "min_samples_leaf", "max_features")})
    return make


def _train(spark, sf):
    tr, _ = _train_test(spark, sf)
    return tr.drop("split").withColumn("quality", F.col("quality").cast("double"))


def _grid(spark, tr):
    """The whole default grid; its scores are kept, so that the queries that use them fit it once."""
    from ...session import scratch_path
    store = H.TrialStore(spark, scratch_path(spark, "trials"))
    return H.grid_search(tr, H.DEFAULT_RF_SPACE, rf_pipeline_for(tr), "quality", k=3, keys=["doc_id"], store=store)


def q_grid_search(spark, sf):
    return _grid(spark, _train(spark, sf))


def q_random_search(spark, sf):
    tr = _train(spark, sf)
    return H.random_search(tr, H.DEFAULT_RF_RANGES, rf_pipeline_for(tr), "quality", k=3, keys=["doc_id"])


def q_adaptive_search(spark, sf):
    tr = _train(spark, sf)
    space = {**H.DEFAULT_RF_RANGES, "max_features": H.DEFAULT_RF_SPACE["max_features"]}
    return H.adaptive_search(tr, space, rf_pipeline_for(tr), "quality", k=3, keys=["doc_id"])


def q_final_evaluation(spark, sf):
    s = _quality_split(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    tr = s.where("split = 'train'").drop("split")
    return H.final_evaluation(s, H.best_params(_grid(spark, tr)), rf_pipeline_for(tr), "quality")


def q_best_trial(spark, sf):
    """H5 over a (trial, fold, score) table derived from events."""
    ev = table(spark, sf, "events").select(F.col("user_id").alias("trial_id"),
                                           (F.col("event_id") % 3).alias("fold"),
                                           F.col("value").alias("test_score"))
    return H.best_trial(ev)


QUERIES = {
    "assemble_features": q_assemble_features,
    "train_random_forest": q_train_random_forest,
    "train_random_forest_regressor": q_train_random_forest_regressor,
    "train_kmeans": q_train_kmeans,
    "train_pca": q_train_pca,
    "train_gbt": q_train_gbt,
    "train_mlp": q_train_mlp,
    "metric_explained_variance_ratio": q_explained_variance_ratio,
    "metric_reconstruction_error": q_reconstruction_error,
    "cluster_scores_by_split": q_cluster_scores_by_split,
    "pca_error_by_split": q_pca_error_by_split,
    "grid_search": q_grid_search,
    "random_search": q_random_search,
    "adaptive_search": q_adaptive_search,
    "final_evaluation": q_final_evaluation,
    "best_trial": q_best_trial,
}

from .evaluate import QV as _QV  # noqa: E402

_U = "cast(('0x' || substr(md5('42|' || vec_id), 1, 8)) as bigint) / 4294967296.0e0"
SQL = {
    "assemble_features": f"""with {_QV},
li as (select lang, cast(row_number() over (order by count(*) desc, lang) - 1 as double) idx from qv group by lang)
select doc_id, [letter_share, cast(n_chars as double), idx] features from qv join li using (lang)""",
    "metric_reconstruction_error": f"""with e as (select vec_id, embedding,
   case when {_U} < 0.2e0 then 'test' when {_U} < 0.2e0 + 0.0e0 then 'validation' else 'train' end split from embeddings),
x as (select vec_id, split, unnest(embedding) v, generate_subscripts(embedding, 1) i from e),
m as (select i, avg(v) m from x where split = 'train' group by i)
select split, sum(case when i <= 2 then 0.0 else (v - m) * (v - m) end) / count(*) reconstruction_error
from x join m using (i) group by split""",
    "best_trial": """with s as (select user_id trial_id, avg(value) mean_score, stddev_pop(value) std_score, count(*) n_folds
  from events group by user_id)
select trial_id, mean_score, std_score, n_folds, -mean_score loss from s
order by mean_score desc, trial_id limit 1""",
}


def _largest_eigenvalues_sql(steps: int = 26) -> str:
    """Two largest eigenvalues of the covariance of ``embeddings``: a matrix squared again and again tends to the
    projection on its first eigenvector; the second is the first of what is left without it."""
    ctes = ["""x as materialized (select vec_id, unnest(embedding)::double v, generate_subscripts(embedding, 1) i from embeddings)""",
            """m as materialized (select i, avg(v) m, count(*) n from x group by i)""",
            """c0 as materialized (select a.i, b.i j, (sum(a.v * b.v) - any_value(p.n * p.m * q.m)) / (any_value(p.n) - 1) v
  from x a join x b using (vec_id) join m p on p.i = a.i join m q on q.i = b.i group by a.i, b.i)"""]
    for e in (0, 1):
        ctes.append(f"p{e}_0 as materialized (select i, j, v / (select sum(v) from c{e} where i = j) v from c{e})")
        for k in range(steps):
            ctes.append(f"s{e}_{k} as materialized (select a.i, b.j, sum(a.v * b.v) v from p{e}_{k} a join p{e}_{k} b on a.j = b.i group by a.i, b.j)")
            ctes.append(f"p{e}_{k + 1} as materialized (select i, j, v / (select sum(v) from s{e}_{k} where i = j) v from s{e}_{k})")
        ctes.append(f"l{e} as materialized (select sum(c.v * p.v) l from c{e} c join p{e}_{steps} p using (i, j))")
        ctes.append(f"c{e + 1} as materialized (select i, j, c.v - (select l from l{e}) * p.v v from c{e} c join p{e}_{steps} p using (i, j))")
    return ("with " + ",\n".join(ctes) + """
select ((select l from l0) + (select l from l1)) / (select sum(v) from c0 where i = j) explained_variance_ratio, 2 n_components,
  (select count(*) from embeddings) n_rows""")


SQL["metric_explained_variance_ratio"] = _largest_eigenvalues_sql()
