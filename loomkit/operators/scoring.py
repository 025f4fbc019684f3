"""Batch scoring (I1-I4) and the expression model.

* ``ExpressionModel``: a saved model whose outputs are SQL expressions over
  feature columns (e.g. fixed logistic coefficients).  Scoring is a narrow
  ``select`` that stays inside whole-stage codegen, and the same
  expressions run in any SQL engine, so results are checkable by value.
* Spark ML ``Model`` / ``PipelineModel``: ``transform`` plus
  ``vector_to_array(probability)[i]`` -> ``prob_class_i``; no shuffle.
* Python models (I2): ``mapInPandas`` with the model loaded once per
  Python worker (module-level cache keyed by path) and called on slices of
  ``batch_size`` rows of each Arrow batch; no session setting is touched.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.storage import read_text, write_text

BATCH_SIZE = 1000  # rows per Arrow batch handed to a Python model


@dataclass
class ExpressionModel:
    """Outputs as SQL expressions, e.g. ``{"prediction": "...", "prob_class_0": "..."}``."""
    features: list
    outputs: dict
    name: str = "expression-model"
    meta: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, keep_inputs: bool = False) -> DataFrame:
        outs = [F.expr(e).alias(n) for n, e in self.outputs.items()]
        return df.select("*", *outs) if keep_inputs else df.select(*outs)

    def save(self, path: str) -> None:
        write_text(path, json.dumps({"features": self.features, "outputs": self.outputs, "name": self.name,
                                     "meta": self.meta}, indent=1))

    @staticmethod
    def load(path: str) -> "ExpressionModel":
        d = json.loads(read_text(path))
        return ExpressionModel(d["features"], d["outputs"], d.get("name", "expression-model"), d.get("meta", {}))


def logistic_expression_model(coef: dict, intercept: float, threshold: float = 0.5,
                              name: str = "logistic") -> ExpressionModel:
    """Binary logistic model as SQL text: prob_class_1 = 1/(1+exp(-z))."""
    z = " + ".join([repr(float(intercept))] + [f"{float(w)!r} * {c}" for c, w in coef.items()])
    p1 = f"(1.0 / (1.0 + exp(-({z}))))"
    return ExpressionModel(list(coef), {
        "prediction": f"cast(case when {p1} >= {float(threshold)!r} then 1 else 0 end as double)",
        "prob_class_0": f"(1.0 - {p1})",
        "prob_class_1": p1,
    }, name, {"coef": coef, "intercept": intercept, "threshold": threshold})


def linear_expression_model(coef: dict, intercept: float, name: str = "linear") -> ExpressionModel:
    z = " + ".join([repr(float(intercept))] + [f"{float(w)!r} * {c}" for c, w in coef.items()])
    return ExpressionModel(list(coef), {"prediction": f"cast({z} as double)"}, name,
                           {"coef": coef, "intercept": intercept})


def _class_count(model) -> int:
    """Number of classes that a fitted model gives probabilities for, read from the model."""
    while hasattr(model, "stages") or hasattr(model, "bestModel"):
        model = model.bestModel if hasattr(model, "bestModel") else model.stages[-1]
    for name in ("numClasses", "weights"):  # classifiers; mixtures
        if hasattr(model, name):
            value = getattr(model, name)
            return int(value) if name == "numClasses" else len(value)
    raise ValueError(f"give num_classes: {type(model).__name__} does not tell it")


def _spark_ml_outputs(model, df: DataFrame, keep_inputs: bool, num_classes: int | None):
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    cols = [F.col("prediction").cast("double").alias("prediction")]
    if "probability" in out.columns:
        k = _class_count(model) if num_classes is None else num_classes
        arr = vector_to_array(F.col("probability"))
        cols += [arr[i].alias(f"prob_class_{i}") for i in range(k)]
    keep = [F.col(c) for c in df.columns] if keep_inputs else []
    return out.select(*keep, *cols)


def predict_batch(model, df: DataFrame, features=None, keep_inputs: bool = False,
                  num_classes: int | None = None) -> DataFrame:
    """I1 (and I3 with ``keep_inputs``): predictions [+ prob_class_i]."""
    if features:
        df = df.select(*features) if not keep_inputs else df
    if isinstance(model, ExpressionModel):
        return model.transform(df, keep_inputs)
    return _spark_ml_outputs(model, df, keep_inputs, num_classes)


def predict_with_inputs(model, df: DataFrame, num_classes: int | None = None) -> DataFrame:
    """Predictions beside the original columns (same row, no join)."""
    return predict_batch(model, df, keep_inputs=True, num_classes=num_classes)


# ---------------------------------------------------------------- I2 (Python)
class NumpyLogisticModel:
    """A small Python model: binary logistic regression on named features."""

    def __init__(self, features, coef, intercept, threshold=0.5):
        self.features = list(features)
        self.coef = np.asarray(coef, dtype="float64")
        self.intercept = float(intercept)
        self.threshold = float(threshold)

    def predict_proba(self, pdf: pd.DataFrame) -> np.ndarray:
        x = pdf[self.features].to_numpy(dtype="float64")
        p1 = 1.0 / (1.0 + np.exp(-(x @ self.coef + self.intercept)))
        return np.column_stack([1.0 - p1, p1])

    def predict(self, pdf: pd.DataFrame) -> np.ndarray:
        return (self.predict_proba(pdf)[:, 1] >= self.threshold).astype("float64")

    def save(self, path: str) -> None:
        write_text(path, json.dumps({"kind": "numpy_logistic", "features": self.features, "coef": self.coef.tolist(),
                                     "intercept": self.intercept, "threshold": self.threshold}))

    @staticmethod
    def load(path: str) -> "NumpyLogisticModel":
        d = json.loads(read_text(path))
        return NumpyLogisticModel(d["features"], d["coef"], d["intercept"], d.get("threshold", 0.5))


_MODEL_CACHE: dict = {}


def _cached_model(path: str, loader):
    """Load once per Python worker process (workers are reused)."""
    m = _MODEL_CACHE.get(path)
    if m is None:
        m = loader(path)
        _MODEL_CACHE[path] = m
    return m


def predict_batch_udf(df: DataFrame, model, features, num_classes: int = 2,
                      loader=NumpyLogisticModel.load, keep: list | None = None,
                      batch_size: int = BATCH_SIZE) -> DataFrame:
    """A Python model over Arrow batches (``mapInPandas``).

    ``model`` is a path on storage every executor reads (loaded once per
    Python worker and cached) or a small picklable model object shipped
    with the task.  ``keep`` columns (e.g. a key) are carried through.
    """
    from ..session import ship_package
    keep = list(keep or [])
    ship_package(df.sparkSession)
    fields = [df.schema[c] for c in keep] + [StructField("prediction", DoubleType())] + [
        StructField(f"prob_class_{i}", DoubleType()) for i in range(num_classes)]
    schema = StructType(fields)
    feats = list(features)
    path = model if isinstance(model, str) else None
    obj = None if path else model

    def score(batches):
        m = _cached_model(path, loader) if path else obj
        for pdf in (b.iloc[lo:lo + batch_size] for b in batches for lo in range(0, len(b), batch_size)):
            out = pd.DataFrame({c: pdf[c] for c in keep}, index=pdf.index)
            x = pdf[feats]
            out["prediction"] = np.asarray(m.predict(x), dtype="float64")
            if num_classes and hasattr(m, "predict_proba"):
                p = m.predict_proba(x)
                for i in range(num_classes):
                    out[f"prob_class_{i}"] = p[:, i]
            yield out

    return df.select(*dict.fromkeys(keep + feats)).mapInPandas(score, schema)


# ---------------------------------------------------------------- S1/S11 + I4
def score_file(spark, model, in_path: str, out_path: str, features=None, keep_inputs: bool = True,
               fmt: str | None = None, mode: str = "overwrite", store=None, version: str = "champion") -> DataFrame:
    """I4: read csv/parquet by suffix, keep the features, score, write in the
    same format; returns the written result read back.

    ``model`` is a model, or a name in ``store`` (a ``ModelStore``) with a
    version number, an alias or ``latest``."""
    from ..sources.files import detect_format, read_table, write_table
    if isinstance(model, str):
        if store is None:
            raise ValueError("a model name needs the store that has it")
        model = store.load(model, version)
    fmt = fmt or detect_format(in_path)
    df = read_table(spark, in_path, fmt)
    if features:
        df = df.select(*features)
    if isinstance(model, NumpyLogisticModel):
        scored = predict_batch_udf(df, model, model.features, keep=df.columns if keep_inputs else None)
    else:
        scored = predict_batch(model, df, keep_inputs=keep_inputs)
    write_table(scored, out_path, fmt, mode)
    return read_table(spark, out_path, fmt)
