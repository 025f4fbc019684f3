"""The flagship: validate -> stratified three-way split -> fit on document
quality -> score -> metrics by split, with the suite's verdict beside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import expectations as X
from ..operators import metrics as E
from ..operators import models as M
from ..operators import splits as S
from ..operators.scoring import predict_with_inputs
from ..session import materialize
from .tables import quality_view

FEATURES = ["letter_share", "n_chars", "lang"]


def quality_suite():
    return [X.Expectation.of(X.ROW_COUNT, min_value=1),
            X.Expectation.of(X.NOT_NULL, "quality"),
            X.Expectation.of(X.IN_SET, "quality", value_set=[0, 1]),
            X.Expectation.of(X.BETWEEN, "letter_share", min_value=0, max_value=1),
            X.Expectation.of(X.UNIQUE, "doc_id")]


def flagship(spark, sf_dir, n_estimators: int = 100, max_depth: int = 10):
    q = quality_view(spark, sf_dir)
    verdict = X.suite_statistics(X.validate(q, quality_suite())).select(
        F.lit(1).alias("_k"), F.col("success").alias("suite_success"), "success_percent")
    # the split feature table (numbers only, far smaller than the texts) is
    # written once, so fit, scoring and metrics never recompute text features
    s = materialize(S.split_three_way(q, keys=["doc_id"], label="quality", test_size=0.2,
                                      validation_size=0.1, seed=42), "flagship_split")
    model = M.train_random_forest(s.where("split = 'train'"), FEATURES, "quality",
                                  n_estimators=n_estimators, max_depth=max_depth)
    scored = predict_with_inputs(model, s, num_classes=2).withColumn("quality", F.col("quality").cast("double"))
    acc = E.accuracy(scored, "quality", "prediction", ["split"])
    auc = E.roc_auc(scored, "quality", "prob_class_1", ["split"])
    return (acc.join(auc, "split").withColumn("_k", F.lit(1)).join(F.broadcast(verdict), "_k")
               .select("split", "n_rows", "accuracy", "roc_auc", "suite_success", "success_percent"))
