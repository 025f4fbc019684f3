"""Queries I1-I4, S1, S11, S12, P1, P2 and metrics E1-E15."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ...operators import metrics as E
from ...operators import runs as R
from ...operators import scoring as I
from ...operators import splits as S
from ...operators.store import ModelStore, RunStore
from ...session import scratch_path
from ...sources import files as FS
from ..tables import quality_view, table

# Fixed model used by the scoring and metric queries (a saved artifact).
QUALITY_MODEL = I.logistic_expression_model({"letter_share": 12.0}, -8.0)
PRICE_MODEL = I.linear_expression_model({"p_partkey": 0.05}, 900.0)
FLAT_MODEL = I.linear_expression_model({"p_size": 1.0}, 1400.0, "flat")


def _fresh(spark, name):
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


def quality_scored(spark, sf):
    """Quality rows, a stateless split, and the model's outputs beside them."""
    q = S.split_bernoulli(quality_view(spark, sf), keys=["doc_id"], test_size=0.2, validation_size=0.1)
    return I.predict_with_inputs(QUALITY_MODEL, q)


def q_predict_batch(spark, sf):
    return I.predict_batch(QUALITY_MODEL, quality_view(spark, sf), features=["letter_share"])


def q_predict_with_inputs(spark, sf):
    return I.predict_with_inputs(QUALITY_MODEL, quality_view(spark, sf))


def q_predict_batch_udf(spark, sf):
    m = I.NumpyLogisticModel(["letter_share"], [12.0], -8.0)
    return I.predict_batch_udf(quality_view(spark, sf), m, ["letter_share"], keep=["doc_id"])


def q_score_file(spark, sf):
    src = f"{sf}/part.parquet"
    out = _fresh(spark, "score_file") + "/scored.parquet"
    return I.score_file(spark, PRICE_MODEL, src, out, features=["p_partkey", "p_retailprice"])


def q_score_file_by_name(spark, sf):
    """I4 with a model that the store resolves by name and alias (R10), after two versions were registered."""
    store = ModelStore(spark, _fresh(spark, "model_store"))
    first = store.register("price", PRICE_MODEL, run_id=1)
    second = store.register("price", FLAT_MODEL, run_id=2)
    store.set_alias("price", "champion", second)
    store.set_alias("price", "champion", first)
    store.set_alias("price", "archived", second)
    src, cols = f"{sf}/part.parquet", ["p_partkey", "p_size", "p_retailprice"]
    out = None
    for spec in ("champion", "latest"):
        path = _fresh(spark, "score_file_by_name") + "/scored.parquet"
        part = I.score_file(spark, "price", src, path, features=cols, store=store, version=spec)
        part = part.withColumn("model_version", F.lit(store.resolve("price", spec)[0]).cast("bigint"))
        out = part if out is None else out.unionByName(part)
    return out


def q_append_runs(spark, sf):
    """Two runs of one experiment logged and appended (the second twice), then read back: the newest by R2, its metrics from the JSON, too."""
    store = RunStore(spark, _fresh(spark, "run_store"))
    part = table(spark, sf, "part")
    facts = part.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit("rows").alias("key"), "value")
    for run_id, model in ((1, PRICE_MODEL), (2, FLAT_MODEL)):
        scores = E.regression_metrics(I.predict_with_inputs(model, part), "p_retailprice", "prediction")
        metrics = scores.select(F.stack(F.lit(3), F.lit("r2"), "r2", F.lit("rmse"), "rmse", F.lit("mae"), "mae").alias("key", "value"))
        tags = facts.select(F.lit("model_alias").alias("key"), F.lit("challenger").alias("value"))
        run = R.log_run(7, run_id, f"2024-01-0{run_id} 12:00:00", tags, facts, metrics)
        store.append(run)
    store.append(run)
    newest = R.latest_run(store.runs())
    flat = newest.select("experiment_id", "run_id", F.col("tags")["model_alias"].alias("alias"), F.col("params")["rows"].alias("n_rows"),
                         F.explode("metrics").alias("metric", "value"))
    written = store.metrics().withColumnRenamed("value", "json_value")
    per = store.runs().groupBy("experiment_id").agg(F.count(F.lit(1)).alias("runs_held"))
    return flat.join(written, ["experiment_id", "run_id", "metric"]).join(per, "experiment_id")


def q_scan_parquet(spark, sf):
    df = FS.read_table(spark, f"{sf}/lineitem.parquet")
    return df.where(F.col("l_discount") > 0.05).select("l_orderkey", "l_extendedprice", "l_discount")


def _orders_copy(spark, sf, fmt):
    o = table(spark, sf, "orders")
    path = _fresh(spark, f"sink_{fmt}")
    FS.write_table(o, path, fmt)
    return o.schema, path


def q_scan_csv(spark, sf):
    schema, path = _orders_copy(spark, sf, "csv")
    df = FS.read_table(spark, path, "csv")  # header + inferred schema (ints infer as int)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return df.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in cols])


def _sink(fmt):
    def q(spark, sf):
        schema, path = _orders_copy(spark, sf, fmt)
        return FS.read_table(spark, path, fmt, schema=None if fmt == "parquet" else StructType(schema.fields))
    return q


def q_sample_rows(spark, sf):
    o = S.split_stratified(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
                           "o_orderstatus", keys=["o_orderkey"])
    return FS.sample_rows(o.where("split = 'train'").drop("split"), 5, keys=["o_orderkey"])


def q_features_target(spark, sf):
    from ...operators.features import features_target
    return features_target(table(spark, sf, "customer"), "c_mktsegment")


def q_select_features(spark, sf):
    from ...operators.features import select_features
    return select_features(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


def q_accuracy(spark, sf):
    return E.accuracy(quality_scored(spark, sf), "quality", "prediction", ["split"])


def q_prf(spark, sf):
    return E.precision_recall_f1(quality_scored(spark, sf), "quality", "prediction", ["split"])


def q_confusion(spark, sf):
    return E.confusion(quality_scored(spark, sf), "quality", "prediction", ["split"])


def q_mcc(spark, sf):
    return E.mcc(quality_scored(spark, sf), "quality", "prediction", ["split"])


def q_log_loss(spark, sf):
    return E.log_loss(quality_scored(spark, sf), "quality", ["prob_class_0", "prob_class_1"], ["split"])


def q_roc_auc(spark, sf):
    return E.roc_auc(quality_scored(spark, sf), "quality", "prob_class_1", ["split"])


def q_roc_auc_ties(spark, sf):
    q = quality_view(spark, sf).withColumn("score", F.round(F.col("n_chars") / 20000.0, 4))
    return E.roc_auc(q, "quality", "score")


def q_regression(spark, sf):
    p = S.split_bernoulli(table(spark, sf, "part"), keys=["p_partkey"], test_size=0.2)
    return E.regression_metrics(I.predict_with_inputs(PRICE_MODEL, p), "p_retailprice", "prediction", ["split"])


def q_anomaly(spark, sf):
    e = table(spark, sf, "events").withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    return E.anomaly_metrics(e, "value", 100.0, "is_error")


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


def q_inertia(spark, sf):
    return E.inertia(_emb(spark, sf), "embedding", "label")


def q_calinski(spark, sf):
    return E.calinski_harabasz(_emb(spark, sf), "embedding", "label")


def q_davies(spark, sf):
    return E.davies_bouldin(_emb(spark, sf), "embedding", "label")


def q_silhouette_sq(spark, sf):
    return E.silhouette_squared(_emb(spark, sf), "embedding", "label")


QUERIES = {
    "predict_batch": q_predict_batch,
    "predict_with_inputs": q_predict_with_inputs,
    "predict_batch_udf": q_predict_batch_udf,
    "score_file": q_score_file,
    "score_file_by_name": q_score_file_by_name,
    "append_runs": q_append_runs,
    "scan_parquet": q_scan_parquet,
    "scan_csv": q_scan_csv,
    "sink_parquet": _sink("parquet"),
    "sink_csv": _sink("csv"),
    "sink_json": _sink("json"),
    "sample_rows": q_sample_rows,
    "features_target": q_features_target,
    "select_features": q_select_features,
    "metric_accuracy": q_accuracy,
    "metric_precision_recall_f1": q_prf,
    "metric_confusion": q_confusion,
    "metric_mcc": q_mcc,
    "metric_log_loss": q_log_loss,
    "metric_roc_auc": q_roc_auc,
    "metric_roc_auc_ties": q_roc_auc_ties,
    "metric_regression": q_regression,
    "metric_anomaly": q_anomaly,
    "metric_inertia": q_inertia,
    "metric_calinski_harabasz": q_calinski,
    "metric_davies_bouldin": q_davies,
    "metric_silhouette_sq": q_silhouette_sq,
}

# ---------------------------------------------------------------- oracle SQL
QV = """qv as (select d.doc_id, d.lang, d.n_chars,
   coalesce(length(regexp_replace(d.text, '[^a-zA-Z]', '', 'g')) / nullif(length(d.text), 0), 0) as letter_share,
   cast(l.quality as integer) as quality
 from documents d join labels l using (doc_id))"""
P1 = "(1.0 / (1.0 + exp(-(-8.0 + 12.0 * letter_share))))"
BERN = ("case when u < 0.2e0 then 'test' when u < 0.2e0 + 0.1e0 then 'validation' else 'train' end")
U = "cast(('0x' || substr(md5('42|' || {k}), 1, 8)) as bigint) / 4294967296.0e0"
SCORED = f"""{QV},
sc as (select *, {BERN} as split, cast(case when {P1} >= 0.5 then 1 else 0 end as double) prediction,
  1.0 - {P1} prob_class_0, {P1} prob_class_1 from (select *, {U.format(k='doc_id')} u from qv))"""
EMB = """x as (select vec_id, label, unnest(embedding) v, generate_subscripts(embedding, 1) i from embeddings),
c as (select label, i, avg(v) m, count(*) n from x group by label, i)"""

SQL = {
    "predict_batch": f"""with {QV} select cast(case when {P1} >= 0.5 then 1 else 0 end as double) prediction,
  1.0 - {P1} prob_class_0, {P1} prob_class_1 from qv""",
    "predict_with_inputs": f"""with {QV} select *, cast(case when {P1} >= 0.5 then 1 else 0 end as double) prediction,
  1.0 - {P1} prob_class_0, {P1} prob_class_1 from qv""",
    "predict_batch_udf": f"""with {QV} select doc_id, cast(case when {P1} >= 0.5 then 1 else 0 end as double) prediction,
  1.0 - {P1} prob_class_0, {P1} prob_class_1 from qv""",
    "score_file": "select p_partkey, p_retailprice, cast(900.0 + 0.05 * p_partkey as double) prediction from part",
    "score_file_by_name": """select p_partkey, p_size, p_retailprice, cast(900.0 + 0.05 * p_partkey as double) prediction, cast(1 as bigint) model_version from part
union all select p_partkey, p_size, p_retailprice, cast(1400.0 + 1.0 * p_size as double), 2 from part""",
    "append_runs": """with p as (select cast(p_retailprice as double) y, 1400.0e0 + 1.0e0 * p_size yhat from part),
m as (select 1 - avg((y-yhat)*(y-yhat)) / var_pop(y) r2, sqrt(avg((y-yhat)*(y-yhat))) rmse, avg(abs(y-yhat)) mae, count(*) n from p),
u as (select 'r2' metric, r2 as value, n from m union all select 'rmse', rmse, n from m union all select 'mae', mae, n from m)
select cast(7 as bigint) experiment_id, cast(2 as bigint) run_id, metric, 'challenger' as alias, cast(n as varchar) n_rows, value, value json_value,
  cast(2 as bigint) runs_held from u""",
    "scan_parquet": "select l_orderkey, l_extendedprice, l_discount from lineitem where l_discount > 0.05",
    "scan_csv": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
    "sink_parquet": "select * from orders",
    "sink_csv": "select * from orders",
    "sink_json": "select * from orders",
    "sample_rows": """select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F','O','P')
  and o_orderkey in (select o_orderkey from ({split}) where split = 'train')
  order by md5('42|' || o_orderkey), o_orderkey limit 5""",
    "features_target": "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment as label from customer",
    "select_features": "select l_quantity, l_extendedprice, l_discount from lineitem",
    "metric_accuracy": f"""with {SCORED} select split, avg(case when quality = prediction then 1.0 else 0.0 end) accuracy,
  count(*) n_rows from sc group by split""",
    "metric_confusion": f"""with {SCORED} select split, cast(quality as double) label, prediction, count(*) n_rows from sc group by all""",
    "metric_precision_recall_f1": f"""with {SCORED},
cls as (select split, k from (select split, cast(cast(quality as double) as varchar) k from sc union select split,
        cast(prediction as varchar) from sc)),
st as (select cls.split, cls.k,
   (select count(*) from sc where sc.split = cls.split and cast(cast(quality as double) as varchar) = cls.k) support,
   (select count(*) from sc where sc.split = cls.split and cast(prediction as varchar) = cls.k) predicted,
   (select count(*) from sc where sc.split = cls.split and cast(cast(quality as double) as varchar) = cls.k
        and cast(prediction as varchar) = cls.k) tp from cls),
m as (select split, k, case when predicted > 0 then tp / predicted else 0.0 end p,
        case when support > 0 then tp / support else 0.0 end r, support from st),
f as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end f1 from m)
select split, k as class, p as precision, r as recall, support, f1 from f
union all select split, 'weighted', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(support)::bigint, sum(f1 * support) / sum(support) from f group by split""",
    "metric_mcc": f"""with {SCORED},
t as (select split, cast(cast(quality as double) as varchar) k, count(*) t from sc group by all),
p as (select split, cast(prediction as varchar) k, count(*) p from sc group by all),
tp as (select coalesce(t.split, p.split) split, coalesce(t, 0) t, coalesce(p, 0) p
       from t full join p on t.split = p.split and t.k = p.k),
a as (select split, sum(t * p) tp, sum(t * t) t2, sum(p * p) p2 from tp group by split),
s as (select split, count(*) s, sum(case when quality = prediction then 1 else 0 end) cor from sc group by split)
select split, case when (s*s - p2) * (s*s - t2) > 0 then (cor * s - tp) / sqrt((s*s - p2) * (s*s - t2)) else 0.0 end mcc
from a join s using (split)""",
    "metric_log_loss": f"""with {SCORED} select split,
  avg(-ln(least(greatest(case when quality = 0 then prob_class_0 else prob_class_1 end, 1e-15), 1 - 1e-15))) log_loss
  from sc group by split""",
    "metric_roc_auc": f"""with {SCORED},
g as (select split, prob_class_1 sc, sum(case when quality=1 then 1 else 0 end) p, sum(case when quality=0 then 1 else 0 end) n
      from sc group by split, prob_class_1),
r as (select split, sc, p, n, sum(n) over (partition by split order by sc) - n below from g)
select split, sum(p*(below + n/2e0)) / (sum(p)*sum(n)) roc_auc from r group by split""",
    "metric_roc_auc_ties": f"""with {QV}, p as (select round(n_chars/20000e0, 4) sc, quality y from qv),
g as (select sc, sum(case when y=1 then 1 else 0 end) p, sum(case when y=0 then 1 else 0 end) n from p group by sc),
r as (select sc, p, n, sum(n) over (order by sc) - n below from g)
select sum(p*(below + n/2e0)) / (sum(p)*sum(n)) roc_auc from r""",
    "metric_regression": f"""with p as (select p_retailprice y, 900.0 + 0.05 * p_partkey yhat,
   case when {U.format(k='p_partkey')} < 0.2e0 then 'test' when {U.format(k='p_partkey')} < 0.2e0 + 0.0e0 then 'validation' else 'train' end split from part)
select split, case when var_pop(y) > 0 then 1 - avg((y-yhat)*(y-yhat)) / var_pop(y) else 0.0 end r2,
  sqrt(avg((y-yhat)*(y-yhat))) rmse, avg((y-yhat)*(y-yhat)) mse, avg(abs(y-yhat)) mae,
  case when var_pop(y) > 0 then 1 - var_pop(y-yhat) / var_pop(y) else 0.0 end explained_variance,
  count(*) n_rows from p group by split""",
    "metric_anomaly": """select avg(value) mean_score, avg(case when value > 100 then 1.0 else 0.0 end) contamination,
  count(*) n_rows,
  sum(case when value > 100 and event_type = 'error' then 1.0 else 0.0 end) / sum(case when value > 100 then 1.0 else 0.0 end) "precision",
  sum(case when value > 100 and event_type = 'error' then 1.0 else 0.0 end) / sum(case when event_type = 'error' then 1.0 else 0.0 end) recall
  from events""",
    "metric_inertia": f"with {EMB} select sum((v - m) * (v - m)) inertia from x join c using (label, i)",
    "metric_calinski_harabasz": f"""with {EMB},
g as (select i, avg(v) gm from x group by i),
w as (select sum((v - m) * (v - m)) w from x join c using (label, i)),
b as (select sum(n * (m - gm) * (m - gm)) b, count(distinct label) k from c join g using (i)),
nn as (select count(*) n from embeddings)
select case when w > 0 and k > 1 then (b / (k - 1)) / (w / (n - k)) else 1.0 end calinski_harabasz from w, b, nn""",
    "metric_davies_bouldin": f"""with {EMB},
s as (select label, avg(d) s from (select vec_id, label, sqrt(sum((v - m) * (v - m))) d
        from x join c using (label, i) group by vec_id, label) group by label),
cd as (select a.label la, b.label lb, sqrt(sum((a.m - b.m) * (a.m - b.m))) d
        from c a join c b on a.i = b.i and a.label <> b.label group by a.label, b.label),
r as (select la, max((sa.s + sb.s) / d) r from cd join s sa on sa.label = la join s sb on sb.label = lb group by la)
select avg(r) davies_bouldin from r""",
    "metric_silhouette_sq": """with e as (select vec_id, label, cast(embedding as double[]) f from embeddings),
pd as (select a.vec_id, a.label la, b.label lb, avg(power(list_distance(a.f, b.f), 2)) md, count(*) cnt
       from e a join e b on a.vec_id <> b.vec_id group by a.vec_id, a.label, b.label),
s as (select vec_id, max(case when la = lb then md end) a, min(case when la <> lb then md end) b from pd group by vec_id)
select avg(case when a is null or b is null then 0.0 else (b - a) / greatest(a, b) end) silhouette_squared
from (select e.vec_id, a, b from e left join s using (vec_id))""",
}

from .splits import SQL as _SPLIT_SQL  # noqa: E402

SQL["sample_rows"] = SQL["sample_rows"].format(split=_SPLIT_SQL["split_stratified"])
