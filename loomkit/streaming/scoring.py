"""Scoring as a Structured Streaming query.

The online ``/predict`` call re-aimed as a stream: rows with an
``array<double>`` or named feature columns arrive from a file / Kafka
source, the model adds ``prediction`` (+ probabilities) and the model id,
and the sink is written exactly once per micro-batch with a checkpoint, so
a restarted query resumes where it stopped.  No event-time logic is
involved, so there is no watermark and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import predict_batch


def request_features(df: DataFrame, array_col: str, names) -> DataFrame:
    """Spread an ``array<double>`` request column into named features."""
    return df.select("*", *[F.col(array_col)[i].cast("double").alias(n) for i, n in enumerate(names)])


def score_stream(stream: DataFrame, model, model_id: str, keep=None) -> DataFrame:
    """The streaming plan: narrow projection, no shuffle, no state."""
    keep = list(keep or [])
    out = predict_batch(model, stream, keep_inputs=True)
    preds = [c for c in out.columns if c == "prediction" or c.startswith("prob_class_")]
    return out.select(*keep, *preds, F.lit(model_id).alias("model_id"))


def run_score_stream(spark: SparkSession, source_dir: str, schema, model, model_id: str,
                     out_path: str, checkpoint: str, keep=None, glob: str | None = None,
                     max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Score every file available now (``availableNow`` trigger), write
    parquet with a checkpoint, wait, and return the written output."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    scored = score_stream(r.load(source_dir), model, model_id, keep)
    q = (scored.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
