"""Facts recorded for the sf0.01 tables (FIXTURES.md), reproduced."""
from pyspark.sql import functions as F

from loomkit.operators import metrics as E
from loomkit.plans.catalog.runs import q_compare_models
from loomkit.plans.catalog.splits import q_split_stratified
from loomkit.plans.tables import quality_view, table
from tests.conftest import SF01


def test_stratified_quotas(spark):
    r = q_split_stratified(spark, SF01).groupBy("o_orderstatus", "split").count().collect()
    got = {(x["o_orderstatus"], x["split"]): x["count"] for x in r}
    assert got == {("F", "train"): 3947, ("F", "test"): 986, ("O", "train"): 3983, ("O", "test"): 996,
                   ("P", "train"): 4070, ("P", "test"): 1018}


def test_comparison_outcomes(spark):
    c = q_compare_models(spark, SF01)
    kind = (F.when(F.col("reason").startswith("First"), "first")
             .when(F.col("reason").startswith("Challenger missing"), "missing")
             .when(F.col("reason").startswith("No challenger"), "same")
             .when(F.col("promote_challenger"), "promote")
             .when(F.col("reason").startswith("Improvement"), "below").otherwise("worse"))
    got = {r[0]: r[1] for r in c.groupBy(kind).count().collect()}
    assert got == {"first": 11, "missing": 12, "promote": 47, "same": 30, "worse": 50}


def test_auc_inertia_and_letter_share(spark):
    q = quality_view(spark, SF01)
    auc = E.roc_auc(q.withColumn("s", F.round(F.col("n_chars") / 20000.0, 4)), "quality", "s").first()["roc_auc"]
    assert round(auc, 6) == 0.512135
    inertia = E.inertia(table(spark, SF01, "embeddings"), "embedding", "label").first()["inertia"]
    assert abs(inertia - 489.3170921853) < 1e-6
    share = {r["quality"]: (r["m"], r["n"]) for r in
             q.groupBy("quality").agg(F.avg("letter_share").alias("m"), F.count(F.lit(1)).alias("n")).collect()}
    assert round(share[0][0], 6) == 0.629742 and share[0][1] == 58
    assert round(share[1][0], 6) == 0.786233 and share[1][1] == 341
