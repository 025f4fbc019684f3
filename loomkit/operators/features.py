"""Feature / target separation (P1), feature selection (P2) and feature
assembly for Spark ML (M1)."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, BooleanType, ArrayType


def features_target(df: DataFrame, target: str | None, label_col: str = "label") -> DataFrame:
    """Feature columns plus the target renamed ``label`` (X and y stay in
    one row); a missing target is an error listing the columns."""
    if target is None:
        return df
    if target not in df.columns:
        raise ValueError(f"no column {target!r} to predict among {df.columns}")
    feats = [c for c in df.columns if c != target]
    return df.select(*feats, F.col(target).alias(label_col))


def select_features(df: DataFrame, features) -> DataFrame:
    """Keep only the named feature columns (pruned into the scan)."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"Feature columns not found: {missing}. Available: {df.columns}")
    return df.select(*features)


class ArrayToVector(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: array<float|double> columns -> ML vectors named
    ``<column>__vec`` (``array_to_vector``, a column function; no UDF).
    Saved and loaded with the pipeline like any Spark ML stage."""

    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, dataset):
        from pyspark.ml.functions import array_to_vector
        for c in self.getInputCols():
            dataset = dataset.withColumn(f"{c}__vec", array_to_vector(F.col(c).cast("array<double>")))
        return dataset


def assemble_features(df: DataFrame, features=None, label: str | None = None,
                      output: str = "features"):
    """M1: numeric / boolean columns, string columns (indexed; unseen values
    get an extra index) and array<float|double> columns -> one vector.

    Returns the unfitted stages (a list for a ``Pipeline``): string indexers,
    an array-to-vector stage (a column function, no UDF) and the assembler.
    """
    from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler

    features = list(features or [c for c in df.columns if c != label])
    stages, cols, arrays, bools = [], [], [], []
    for c in features:
        dt = df.schema[c].dataType
        if isinstance(dt, StringType):
            stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"))
            cols.append(f"{c}__idx")
        elif isinstance(dt, ArrayType):
            arrays.append(c)
            cols.append(f"{c}__vec")
        elif isinstance(dt, BooleanType):
            bools.append(c)
            cols.append(f"{c}__num")
        elif isinstance(dt, NumericType):
            cols.append(c)
        else:
            raise ValueError(f"Cannot use column {c} of type {dt.simpleString()} as a feature")
    if bools:
        casts = ", ".join(f"cast(`{c}` as double) as `{c}__num`" for c in bools)
        stages.append(SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"))
    if arrays:
        from pyspark.ml.feature import VectorSizeHint
        stages.append(ArrayToVector(arrays))
        # the assembler needs each vector's length up front; a row of another length is an error, at fit and at scoring
        least = [F.min(F.coalesce(F.size(a), F.lit(-1))).alias(f"lo{i}") for i, a in enumerate(arrays)]
        most = [F.max(F.coalesce(F.size(a), F.lit(-1))).alias(f"hi{i}") for i, a in enumerate(arrays)]
        width = df.agg(*least, *most).first()
        for i, a in enumerate(arrays):
            lo, hi = width[f"lo{i}"], width[f"hi{i}"]
            if lo is None or lo < 0 or lo != hi:
                raise ValueError(f"column {a} holds NULL arrays or arrays of different lengths ({lo} to {hi}; -1: NULL)")
            stages.append(VectorSizeHint(inputCol=f"{a}__vec", size=int(lo), handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep"))
    return stages
