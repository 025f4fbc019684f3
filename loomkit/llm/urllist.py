"""Temporal URL list join, in DataFrame functions only.

List entries are dated changes ``(pattern, action, listed_at)``: ``block`` and
``allow`` switch a pattern on, ``remove`` takes it off.  Per pattern, each entry is
valid from its date until the next one, which makes validity intervals.  Every
capture is evaluated against the entries active when it was fetched: an as-of
join on pattern and month, with the exact interval as join condition.

A pattern is a host (``a.example.com``), a parent domain (``example.com``, also
matching every host below it) or a host with a path prefix of whole segments
(``example.com/es/``, ``example.com/es/Shop/``).  Hosts are compared without case,
paths with it.  Among the active entries the longest pattern decides; ``allow`` beats a shorter ``block``.

Months spread a hot host over its fetch dates, and the join's remaining skew is
on the capture side, which adaptive execution splits.  Repeated captures are
counted before the join and given back after it.

Defined results: null or hostless URLs and null fetch times match nothing and
are not blocked; of entries with the same pattern and time ``remove`` holds over
``block`` and ``block`` over ``allow``; entries with a null field are left out; repeated captures each get a row; empty tables give empty results or no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.when(host != "", host)


def path_prefixes(url: Column, deepest: Column) -> Column:
    """``/a/``, ``/a/b/``, ... of a path, at most ``deepest`` of them."""
    parts = F.split(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*/)", 1), "/")
    n = F.least(F.size(parts) - 2, deepest)
    made = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.array_join(F.slice(parts, 1, i + 1), "/"), F.lit("/")))
    return F.when(n >= 1, made).otherwise(F.array().cast("array<string>"))


def patterns_of(url: Column, deepest: Column) -> Column:
    """Every pattern that can match: the host and its parent domains, each also with the path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    with_path = F.flatten(F.transform(path_prefixes(url, deepest), lambda x: F.transform(parents, lambda p: F.concat(p, x))))
    return F.when(F.isnotnull(host), F.array_distinct(F.concat(parents, with_path)))


def _month(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t) - 1


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to): active stretches; ``valid_to`` is null while the entry stands."""
    pattern = F.concat(F.lower(F.substring_index("pattern", "/", 1)), F.regexp_extract("pattern", "(?s)^[^/]*(/.*)?$", 1))
    e = entries.select(pattern.alias("pattern"), "action", F.col("listed_at").cast("timestamp").alias("valid_from"))
    rank = F.when(F.col("action") == "allow", 0).when(F.col("action") == "block", 1).otherwise(2)
    e = e.dropna().groupBy("pattern", "valid_from").agg(F.max_by("action", rank).alias("action"))
    w = Window.partitionBy("pattern").orderBy("valid_from")
    return e.withColumn("valid_to", F.lead("valid_from").over(w)).where(F.col("action") != "remove")


def temporal_list_join(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """Per capture: id, url, time, n_active, matched pattern, its action and start, and ``blocked``."""
    c = captures.select(col(id_col).alias("id"), col(url_col).cast("string").alias("url"), col(time_col).cast("timestamp").alias("at"))
    c = c.groupBy("id", "url", "at").agg(F.count(F.lit(1)).alias("copies"))
    # no prefix deeper than the deepest entry can match
    deepest = F.coalesce(entries.agg(F.max(F.size(F.split("pattern", "/")) - 2).alias("n")).scalar(), F.lit(0))
    dated = c.where(F.isnotnull("at")).select("id", "url", "at", deepest.alias("deepest"))
    spread = dated.select("id", "url", "at", F.explode(patterns_of(F.col("url"), F.col("deepest"))).alias("pattern"), _month(F.col("at")).alias("month"))
    last = c.agg(F.max("at").alias("t")).scalar()  # open intervals reach to the last capture's month
    until = F.coalesce(F.least("valid_to", last), last)
    iv = intervals(entries).where(F.col("valid_from") <= last).select(
        "pattern", "action", "valid_from", "valid_to",
        F.explode(F.sequence(_month(F.col("valid_from")), F.greatest(_month(until), _month(F.col("valid_from"))))).alias("month"))
    hit = spread.join(iv, ["pattern", "month"]).where(
        (F.col("valid_from") <= F.col("at")) & (F.isnull("valid_to") | (F.col("at") < F.col("valid_to"))))
    best = F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "valid_from")).alias("b")
    won = hit.groupBy("id", "url", "at").agg(F.count(F.lit(1)).alias("n_active"), best)
    j = c.alias("c").join(won.alias("w"), F.expr("c.id <=> w.id and c.url <=> w.url and c.at <=> w.at"), "left")
    out = j.select(F.col("c.id").alias(id_col), F.col("c.url").alias("url"), F.col("c.at").alias("fetched_at"),
                   F.coalesce("w.n_active", F.lit(0)).cast("long").alias("n_active"), F.col("w.b.pattern").alias("pattern"),
                   F.col("w.b.action").alias("action"), F.col("w.b.valid_from").alias("active_since"),
                   F.coalesce(F.col("w.b.action") == "block", F.lit(False)).alias("blocked"), F.col("c.copies").alias("copies"))
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")
