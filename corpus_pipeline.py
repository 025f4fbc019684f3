"""Corpus preparation: language ID, exact and near deduplication, secret scan, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and reread as the next one's ``docs``; all but the last return the columns
of ``documents``.

1. ``language_id``: trains the byte CNN on the stage's own labelled rows (a bounded
   sample) and on noise, and drops documents without a letter and those that the
   network is sure are no language (encoded data, shuffled bytes); if no row can be
   trained on, only documents with null or letterless text go.
2. ``exact_dedup``: keeps the longest original of each group of texts equal but for white space.
3. ``near_dedup``: keeps the document with the smallest id of each near-duplicate component.
4. ``secret_scan``: replaces every reported span by ``[SECRET]`` and corrects ``n_chars``.
5. ``packing``: cuts the concatenated token ids into sequences of 1024; one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomkit.llm import credentials, langid, neardup, packing, radix
from loomkit.llm.common import read, written
from loomkit.llm.queries import byte_bpe_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.train(docs, noise=True))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return radix.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, byte_bpe_path(), with_ids=False)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("secret_scan", secret_scan), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: A trained network and similarity joins have no SQL form; tests/llm checks run() against a brute-force version.
ORACLE_SQL = None
