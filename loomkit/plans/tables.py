"""Loading the driver's tables and the derived views built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def runs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records derived from ``events``: one experiment per user, one
    run per event, flat columns (alias, test_accuracy, test_rmse)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("experiment_id"),
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_type") == "purchase", F.lit("champion"))
         .when(F.col("event_type") == "error", F.lit("archived")).alias("alias"),
        F.when(F.col("event_id") % 10 == 3, F.lit(None).cast("double"))
         .otherwise(F.col("value") / 1000).alias("test_accuracy"),
        F.col("value").alias("test_rmse"),
    )


def runs_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs in record form: tags and metrics as maps."""
    r = runs_view(spark, sf_dir)
    tags = F.when(F.col("alias").isNull(), F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit("model_alias"), F.col("alias")))
    metrics = F.map_filter(
        F.create_map(F.lit("test_accuracy"), F.col("test_accuracy"),
                     F.lit("test_rmse"), F.col("test_rmse")),
        lambda k, v: v.isNotNull())
    return r.select("experiment_id", "run_id", "start_time",
                    tags.alias("tags"), metrics.alias("metrics"),
                    F.create_map().cast("map<string,string>").alias("params"))


def quality_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a learnable binary target (``labels.quality``).

    The text feature is computed before the join, so a shuffle join carries
    numbers, never whole texts."""
    letters = F.length(F.regexp_replace("text", "[^a-zA-Z]", ""))
    share = F.coalesce(F.try_divide(letters, F.length("text")), F.lit(0.0))  # empty or missing text has no letters
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", share.alias("letter_share"))
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"))
    return d.join(lab, "doc_id").select("doc_id", "lang", "n_chars", "letter_share", "quality")


def registry_from_runs(runs):
    """A model registry derived from run records: every run that was ever a
    champion or archived is a version (numbered by start time per model);
    aliases point at the newest champion and newest archived run.

    Version numbers are an exact per-model rank computed bucket by bucket
    (minute of the start time), so a model with a third of all runs is
    never sorted in one task; the aliases are ``max_by`` aggregates."""
    from ..operators.splits import rank_in_groups
    alias = F.col("tags")["model_alias"]
    reg = runs.where(alias.isin("champion", "archived")).select(
        F.concat(F.lit("model-"), F.col("experiment_id").cast("string")).alias("model_name"),
        "experiment_id", "run_id", "start_time", alias.alias("alias"))
    minute = F.floor(F.unix_micros(F.col("start_time").cast("timestamp")) / 60_000_000)
    versions = rank_in_groups(reg, ["model_name"], [F.col("start_time"), F.col("run_id")], minute, "version") \
        .withColumn("version", F.col("version").cast("bigint"))
    from ..session import materialize
    versions = materialize(versions, "registry-versions")  # read by several later steps
    aliases = versions.groupBy("model_name", "alias").agg(
        F.max_by("version", F.struct("start_time", "run_id")).alias("version"))
    return versions.select("model_name", "version", "run_id"), aliases


def model_name_of(experiment):
    return F.concat(F.lit("model-"), experiment.cast("string"))
