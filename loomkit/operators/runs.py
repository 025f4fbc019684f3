"""Run records, champion / challenger comparison and promotion.

Set-based over **all** experiments at once.  A runs table has columns
``experiment_id, run_id, start_time, tags map<string,string>,
metrics map<string,double>, params map<string,string>``.  Registry tables:
``versions(model_name, version bigint, run_id)`` and
``aliases(model_name, alias, version bigint)``.

"Newest" means latest ``start_time``, ties to the larger ``run_id``.  Top-1
per experiment is a ``max_by`` aggregate (partial aggregation before the
shuffle), so an experiment holding a third of all runs never lands whole
in one task.  Time stamps come from a ``now`` argument so runs repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXP, RUN, START = "experiment_id", "run_id", "start_time"
ALIAS_TAG = "model_alias"

# Metric name -> higher is better, in lookup order.  Exact
# (lower-cased) name first, then the first entry that is a substring.
METRIC_DIRECTIONS = [
    ("accuracy", True), ("test_accuracy", True), ("val_accuracy", True), ("precision", True),
    ("recall", True), ("f1_score", True), ("f1", True), ("roc_auc", True), ("auc", True),
    ("r2_score", True), ("r2", True), ("explained_variance", True),
    ("loss", False), ("val_loss", False), ("test_loss", False), ("rmse", False), ("mse", False),
    ("mae", False), ("error", False),
]

# Reason texts of the comparison ({pct} and {thr} are percents
# with two decimals, e.g. "2.67%"; {metric} is the metric name).
REASON_IMPROVED = "Challenger improved by {pct} (threshold: {thr})"
REASON_BELOW = "Improvement {pct} below threshold {thr}"
REASON_WORSE = "Challenger performed worse on {metric}"
REASON_MISSING = "Challenger missing primary metric: "
REASON_FIRST = "First model - promoting as champion"
REASON_SAME = "No challenger: the newest run is the champion"
REASON_NO_RUNS = "No runs found in experiment"
ARCHIVED_REASON = "Replaced by better model"
ROLLBACK_REASON = "Rollback - replaced by previous model"


# ------------------------------------------------------------------ helpers
def set_tags(tags: Column, values: dict) -> Column:
    """Tags with ``values`` set (replacing existing keys)."""
    keys = list(values)
    kept = F.map_filter(tags, lambda k, v: ~k.isin(keys))
    vals = [values[k] if isinstance(values[k], Column) else F.lit(values[k]) for k in keys]
    new = F.create_map(*[x for k, v in zip(keys, vals) for x in (F.lit(k), v)])
    return F.map_concat(kept, new)


def drop_tags(tags: Column, keys) -> Column:
    return F.map_filter(tags, lambda k, v: ~k.isin(list(keys)))


def tags_text(tags: Column) -> Column:
    """Sorted ``key=value`` strings: an engine-neutral view of a map."""
    return F.array_sort(F.transform(F.map_entries(tags), lambda e: F.concat(e["key"], F.lit("="), e["value"])))


def _newest(runs: DataFrame, order=None) -> DataFrame:
    """Top-1 per experiment by (order..., start_time, run_id), newest wins.
    A rank filter: each task keeps one row per experiment before the shuffle,
    and only the columns used later are carried."""
    order = order or [F.col(START), F.col(RUN)]
    w = Window.partitionBy(EXP).orderBy(*[o.desc_nulls_last() for o in order])
    return runs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 1).drop("_rn")


# ------------------------------------------------------------------ R1-R3
def search_runs(runs: DataFrame, experiment_ids=None, tag_equals: dict | None = None,
                order_by=None, max_results: int | None = None) -> DataFrame:
    """Filter by experiment and tag equality, keep the first
    ``max_results`` per experiment (all if None), ordered by experiment and ``order_by``.  ``order_by`` is a list of
    ``(column, ascending)`` where column is a name or an expression such as
    ``F.col("tags")["archived_at"]``; missing values sort last."""
    r = runs
    if experiment_ids is not None:
        r = r.where(F.col(EXP).isin(list(experiment_ids)))
    for k, v in (tag_equals or {}).items():
        r = r.where(F.col("tags")[k] == F.lit(v))
    order_by = order_by or [(START, False), (RUN, False)]
    cols = [(F.col(c) if isinstance(c, str) else c, asc) for c, asc in order_by]
    ords = [c.asc_nulls_last() if asc else c.desc_nulls_last() for c, asc in cols]
    if max_results is None:
        return r.orderBy(EXP, *ords)
    w = Window.partitionBy(EXP).orderBy(*ords)
    # rank filter -> planned as a per-partition group limit before the shuffle
    top = r.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_results)
    return top.orderBy(EXP, "_rn").drop("_rn")


def latest_run(runs: DataFrame) -> DataFrame:
    """R2: newest run per experiment."""
    return _newest(runs)


def run_by_alias(runs: DataFrame, alias: str) -> DataFrame:
    """Newest run per experiment whose ``model_alias`` tag is ``alias``."""
    return _newest(runs.where(F.col("tags")[ALIAS_TAG] == F.lit(alias)))


# ------------------------------------------------------------------ R4
def metric_direction(name: Column, overrides: dict | None = None) -> Column:
    """True when higher is better.  Overrides (exact names) first, then
    exact table names, then the first table entry contained in the name,
    else True."""
    low = F.lower(name)
    expr = None
    chain = []
    for k, v in (overrides or {}).items():
        chain.append((low == F.lit(k.lower()), v))
    chain += [(low == F.lit(k), v) for k, v in METRIC_DIRECTIONS]
    chain += [(F.instr(low, k) > 0, v) for k, v in METRIC_DIRECTIONS]
    for cond, v in chain:
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(True))


# ------------------------------------------------------------------ R5
def _pct_text(x: Column) -> Column:
    return F.format_string("%.2f%%", x * 100)


def _fill(template: str, **cols) -> Column:
    """A text template with ``{name}`` slots filled by string columns."""
    import re
    parts = re.split(r"\{(\w+)\}", template)
    out = [F.lit(p) if i % 2 == 0 else cols[p] for i, p in enumerate(parts) if p != "" or i % 2]
    return F.concat(*out)


def compare_models(runs: DataFrame, metric: str = "test_accuracy", threshold: float = 0.01,
                   experiments: DataFrame | None = None, direction_overrides: dict | None = None) -> DataFrame:
    """Newest run (challenger) vs newest champion, per experiment.

    Columns: experiment_id, champion_run_id, challenger_run_id,
    promote_challenger, champion_score, challenger_score, improvement,
    pct_improvement, metric, higher_is_better, reason.
    """
    chall = latest_run(runs).select(EXP, F.col(RUN).alias("challenger_run_id"),
                                    F.col("metrics").alias("_cm"))
    champ = run_by_alias(runs, "champion").select(EXP, F.col(RUN).alias("champion_run_id"),
                                                  F.col("metrics").alias("_pm"))
    j = chall.join(champ, EXP, "left")
    if experiments is not None:
        j = experiments.select(EXP).join(j, EXP, "left")
    cs = F.col("_cm")[metric]
    ps = F.col("_pm")[metric]
    hib = metric_direction(F.lit(metric), direction_overrides)
    imp = F.when(hib, cs - ps).otherwise(ps - cs)
    better = F.when(hib, cs > ps).otherwise(cs < ps)
    pct = F.when(F.abs(ps) > 1e-10, imp / F.abs(ps)).otherwise(F.lit(0.0))
    no_runs = F.col("challenger_run_id").isNull()
    same = F.col("challenger_run_id") == F.col("champion_run_id")
    missing = cs.isNull()
    first = F.col("champion_run_id").isNull() | ps.isNull()
    compared = ~no_runs & ~F.coalesce(same, F.lit(False)) & ~missing & ~first
    promote = (F.when(no_runs | F.coalesce(same, F.lit(False)) | missing, F.lit(False))
                .when(first, F.lit(True))
                .otherwise(better & (pct >= F.lit(threshold))))
    thr = F.lit(threshold)
    reason = (F.when(no_runs, F.lit(REASON_NO_RUNS))
               .when(F.coalesce(same, F.lit(False)), F.lit(REASON_SAME))
               .when(missing, F.lit(REASON_MISSING + metric))
               .when(first, F.lit(REASON_FIRST))
               .when(promote, _fill(REASON_IMPROVED, pct=_pct_text(pct), thr=_pct_text(thr)))
               .when(better, _fill(REASON_BELOW, pct=_pct_text(pct), thr=_pct_text(thr)))
               .otherwise(F.lit(REASON_WORSE.format(metric=metric))))
    dnull = F.lit(None).cast("double")
    return j.select(
        EXP, "champion_run_id", "challenger_run_id", promote.alias("promote_challenger"),
        F.when(compared, ps).otherwise(dnull).alias("champion_score"),
        F.when(~missing & ~no_runs & ~F.coalesce(same, F.lit(False)), cs).otherwise(dnull).alias("challenger_score"),
        F.when(compared, imp).otherwise(dnull).alias("improvement"),
        F.when(compared, pct).otherwise(dnull).alias("pct_improvement"),
        F.lit(metric).alias("metric"),
        F.when(compared, hib).otherwise(F.lit(None).cast("boolean")).alias("higher_is_better"),
        reason.alias("reason"))


# ------------------------------------------------------------------ R6
def tag_challenger(runs: DataFrame) -> DataFrame:
    """The newest run of each experiment gets ``model_alias=challenger``
    and ``ci_pipeline=true``; other runs unchanged."""
    newest = latest_run(runs).select(F.col(RUN).alias("_hit"), F.col(EXP).alias("_he"))
    j = runs.join(newest, (runs[RUN] == newest["_hit"]) & (runs[EXP] == newest["_he"]), "left")
    tags = F.when(F.col("_hit").isNotNull(),
                  set_tags(F.col("tags"), {ALIAS_TAG: "challenger", "ci_pipeline": "true"})).otherwise(F.col("tags"))
    return j.withColumn("tags", tags).select(*runs.columns)


# ------------------------------------------------------------------ R7 / R8
def model_name_for(experiment: Column) -> Column:
    """Registered model name: the experiment name with ``-exp`` -> ``-model``."""
    return F.replace(experiment.cast("string"), F.lit("-exp"), F.lit("-model"))


def _retag(runs: DataFrame, pairs: DataFrame, changes: dict) -> DataFrame:
    """``runs`` with the tags of those runs replaced that ``pairs`` (one row per
    experiment) names: ``changes`` maps a column of run ids to the new tags."""
    p = pairs.select(F.col(EXP).alias("_pe"), *changes)
    j = runs.join(p, runs[EXP] == F.col("_pe"), "left")
    new = None
    for c, tags in changes.items():
        hit = F.col(RUN) == F.col(c)
        new = F.when(hit, tags) if new is None else new.when(hit, tags)
    return j.withColumn("tags", new.otherwise(F.col("tags"))).select(*runs.columns)


def _alias_rows(pairs: DataFrame, versions: DataFrame, run_col: str, newest_col: str, alias: str) -> DataFrame:
    """(model_name, alias, version) of the newest of each model's runs in ``run_col``; a run's first version counts."""
    v = versions.groupBy("model_name", F.col(RUN).alias(run_col)).agg(F.min("version").alias("version"))
    j = pairs.where(F.col(run_col).isNotNull()).join(v, ["model_name", run_col])
    return j.groupBy("model_name").agg(F.max_by("version", F.struct(newest_col, run_col)).alias("version")).select(
        "model_name", F.lit(alias).alias("alias"), F.col("version").cast("bigint").alias("version"))


def _upsert_aliases(aliases: DataFrame, new: DataFrame) -> DataFrame:
    """Alias upsert: anti-join the replaced (model_name, alias) + union."""
    keep = aliases.join(new.select("model_name", "alias"), ["model_name", "alias"], "left_anti")
    return keep.unionByName(new.select("model_name", "alias", "version"))


def _newest_of(alias: str, *order) -> Column:
    """(order..., start_time, run_id) of the newest run of that alias, as an aggregate."""
    rec = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(START).alias("at"), F.col(RUN).alias("run"))
    return F.max(F.when(F.col("tags")[ALIAS_TAG] == alias, rec))


def promote_model(runs: DataFrame, versions: DataFrame, aliases: DataFrame, now: str,
                  model_name=model_name_for, decisions: DataFrame | None = None):
    """Challenger -> champion, old champion -> archived, for every
    experiment that has a challenger.  Returns (runs, versions, aliases).

    ``decisions`` (experiment_id, promote_challenger, as ``compare_models``
    gives them): only experiments whose comparison says so are promoted.

    The challenger's run is registered as a new version (max + 1) unless
    already registered.  Of all experiments of one model, the newest promoted
    run gets alias ``champion`` and the newest replaced one ``archived``.
    The runs are read twice: for the newest run per alias, and to retag.
    """
    from ..session import materialize

    facts = runs.groupBy(EXP).agg(_newest_of("challenger").alias("ch"), _newest_of("champion").alias("cp"))
    pairs = facts.where(F.col("ch").isNotNull()).select(
        EXP, F.col("ch.run").alias("_chal"), F.col("ch.at").alias("_chal_at"), F.col("cp.run").alias("_champ"), F.col("cp.at").alias("_champ_at"))
    if decisions is not None:
        pairs = pairs.join(decisions.where("promote_challenger").select(EXP).distinct(), EXP, "left_semi")
    pairs = materialize(pairs.withColumn("model_name", model_name(F.col(EXP))), "promote-pairs")  # one row an experiment

    new_runs = _retag(runs, pairs, {
        "_chal": set_tags(F.col("tags"), {ALIAS_TAG: "champion", "promoted_at": now, "promoted_from": "challenger"}),
        "_champ": set_tags(F.col("tags"), {ALIAS_TAG: "archived", "archived_at": now, "archived_reason": ARCHIVED_REASON})})

    # registry: register the challenger run unless it already has a version
    top = versions.groupBy("model_name").agg(F.max("version").alias("_max"))
    p = pairs.join(versions.select("model_name", F.col(RUN).alias("_chal")), ["model_name", "_chal"], "left_anti").join(top, "model_name", "left")
    # several experiments may map to one model name: number new versions in order
    w = Window.partitionBy("model_name").orderBy(EXP)
    fresh = p.withColumn("_v", F.coalesce("_max", F.lit(0)) + F.row_number().over(w))
    add = materialize(fresh.select("model_name", F.col("_v").cast("bigint").alias("version"), F.col("_chal").alias(RUN)), "promote-versions")
    new_versions = versions.unionByName(add)
    new = _alias_rows(pairs, new_versions, "_chal", "_chal_at", "champion").unionByName(
        _alias_rows(pairs, versions, "_champ", "_champ_at", "archived"))
    return new_runs, new_versions, _upsert_aliases(aliases, new)


def rollback_model(runs: DataFrame, versions: DataFrame, aliases: DataFrame, now: str,
                   model_name=model_name_for):
    """Current champion -> archived; the most recently archived run
    (by ``archived_at``, then newest) -> champion with ``restored_at`` and
    without ``archived_at``.  Experiments lacking either are unchanged.
    Registry aliases move too, to the newest run of the model's experiments.
    Returns (runs, aliases).  The runs are read twice."""
    from ..session import materialize

    # archived_at DESC with missing stamps last, then start_time / run_id DESC
    stamp = F.col("tags")["archived_at"]
    facts = runs.groupBy(EXP).agg(_newest_of("champion").alias("cu"), _newest_of("archived", stamp.isNotNull(), stamp).alias("pr"))
    pairs = facts.where(F.col("cu").isNotNull() & F.col("pr").isNotNull()).select(
        EXP, F.col("cu.run").alias("_cur"), F.col("cu.at").alias("_cur_at"), F.col("pr.run").alias("_prev"), F.col("pr.at").alias("_prev_at"))
    pairs = materialize(pairs.withColumn("model_name", model_name(F.col(EXP))), "rollback-pairs")
    new_runs = _retag(runs, pairs, {
        "_cur": set_tags(F.col("tags"), {ALIAS_TAG: "archived", "archived_at": now, "archived_reason": ROLLBACK_REASON}),
        "_prev": set_tags(drop_tags(F.col("tags"), ["archived_at"]), {ALIAS_TAG: "champion", "restored_at": now})})
    new = _alias_rows(pairs, versions, "_prev", "_prev_at", "champion").unionByName(
        _alias_rows(pairs, versions, "_cur", "_cur_at", "archived"))
    return new_runs, _upsert_aliases(aliases, new)


# ------------------------------------------------------------------ R9
def comparison_report(comparison: DataFrame, runs: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Per experiment and challenger metric (sorted by name): scores,
    absolute and relative change, trend, result band, primary flag."""
    m = runs.select(F.col(RUN).alias("challenger_run_id"), F.col(EXP).alias("_e"), "metrics")
    j = comparison.join(m, (comparison["challenger_run_id"] == m["challenger_run_id"])
                        & (comparison[EXP] == m["_e"]), "left").drop(m["challenger_run_id"])
    pct = F.col("pct_improvement")
    hib = F.coalesce(F.col("higher_is_better"), F.lit(True))
    trend = (F.when(pct.isNull(), F.lit(None).cast("string"))
              .when(pct == 0, F.lit("flat"))
              .when(hib, F.when(pct > 0, F.lit("up")).otherwise(F.lit("down")))
              .otherwise(F.when(pct > 0, F.lit("down")).otherwise(F.lit("up"))))
    full = pct.isNotNull() & F.col("champion_score").isNotNull() & F.col("challenger_score").isNotNull()
    better = F.col("improvement") > 0
    result = (F.when(~full, F.lit(None).cast("string"))
               .when(F.col("promote_challenger"), F.lit("exceeds threshold"))
               .when(better, F.lit("below threshold"))
               .otherwise(F.lit("degraded")))
    base = j.select(
        EXP, "champion_run_id", "challenger_run_id", "promote_challenger", "metric",
        "champion_score", "challenger_score",
        F.when(full, F.col("challenger_score") - F.col("champion_score")).alias("abs_change"),
        pct.alias("pct_change"), trend.alias("trend"), result.alias("result"),
        F.lit(float(threshold)).alias("threshold"),
        F.array_sort(F.map_entries(F.coalesce("metrics", F.create_map().cast("map<string,double>")))).alias("_ms"))
    out = base.select("*", F.posexplode_outer("_ms").alias("_pos", "_m")).drop("_ms")
    return out.select(
        *[c for c in out.columns if not c.startswith("_")],
        (F.col("_pos") + 1).cast("int").alias("metric_rank"),
        F.col("_m")["key"].alias("metric_name"), F.col("_m")["value"].alias("metric_value"),
        (F.col("_m")["key"] == F.col("metric")).alias("is_primary"))


# ------------------------------------------------------------------ R10
def resolve_model(requests: DataFrame, versions: DataFrame, aliases: DataFrame,
                  runs: DataFrame | None = None) -> DataFrame:
    """(model_name, version_spec[, experiment_id]) -> location.

    champion / staging / production / archived -> the aliased version;
    latest -> highest version; digits -> that version if registered; else
    the newest champion run, else the newest run of the experiment, else a
    local ``models/<name>`` path.
    """
    spec = F.lower(F.trim(F.col("version_spec")))
    r = requests.withColumn("_spec", spec)
    al = aliases.select("model_name", F.col("alias").alias("_spec"), F.col("version").alias("_av"))
    r = r.join(al, ["model_name", "_spec"], "left")
    latest = versions.groupBy("model_name").agg(F.max("version").alias("_lv"))
    r = r.join(latest, "model_name", "left")
    vv = versions.select("model_name", F.col("version").cast("string").alias("_spec"),
                         F.col("version").alias("_nv"), F.col(RUN).alias("_nrun"))
    r = r.join(vv, ["model_name", "_spec"], "left")
    is_alias = F.col("_spec").isin("champion", "staging", "production", "archived")
    version = (F.when(is_alias, F.col("_av"))
                .when(F.col("_spec") == "latest", F.col("_lv"))
                .when(F.col("_spec").rlike("^[0-9]+$"), F.col("_nv")))
    r = r.withColumn("resolved_version", version.cast("bigint"))
    if runs is not None and EXP in requests.columns:
        champ = run_by_alias(runs, "champion").select(EXP, F.col(RUN).alias("_crun"))
        newest = latest_run(runs).select(EXP, F.col(RUN).alias("_lrun"))
        r = r.join(champ, EXP, "left").join(newest, EXP, "left")
        fallback = F.coalesce(F.col("_crun"), F.col("_lrun"))
    else:
        fallback = F.lit(None).cast("bigint")
    uri = (F.when(F.col("resolved_version").isNotNull(),
                  F.concat(F.lit("models:/"), F.col("model_name"), F.lit("/"),
                           F.col("resolved_version").cast("string")))
            .when(fallback.isNotNull(), F.concat(F.lit("runs:/"), fallback.cast("string"), F.lit("/model")))
            .otherwise(F.concat(F.lit("models/"), F.col("model_name"))))
    source = (F.when(F.col("resolved_version").isNotNull(), F.lit("registry"))
               .when(fallback.isNotNull(), F.lit("run")).otherwise(F.lit("local")))
    keep = [c for c in requests.columns]
    return r.select(*keep, "resolved_version", source.alias("source"), uri.alias("model_uri"))


# ------------------------------------------------------------------ R11 / R12
def dataset_lineage(split_df: DataFrame, dataset: str, source: str, target: str | None = None,
                    split_col: str = "split") -> DataFrame:
    """One row per split part: name, source, context, target, rows, schema."""
    ctx = (F.when(F.col(split_col) == "train", F.lit("training"))
            .when(F.col(split_col) == "test", F.lit("testing"))
            .when(F.col(split_col) == "validation", F.lit("validation")))
    schema = split_df.drop(split_col).schema.simpleString()
    return (split_df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.concat(F.lit(dataset + "-"), F.col(split_col)).alias("name"),
                    F.lit(source).alias("source"), ctx.alias("context"),
                    F.lit(target).cast("string").alias("target"), "rows",
                    F.lit(schema).alias("schema")))


def log_run(experiment_id, run_id, start_time: str, tags: DataFrame | None = None,
            params: DataFrame | None = None, metrics: DataFrame | None = None, spark=None) -> DataFrame:
    """One run record from (key, value) tables of tags, params and
    metrics (each a small DataFrame with columns key, value), built with
    ``map_from_entries`` so the values never leave Spark."""
    def as_map(df, vtype, t):
        if df is None:
            return F.create_map().cast(t)
        return df.agg(F.map_from_entries(F.collect_list(F.struct(
            F.col("key").cast("string"), F.col("value").cast(vtype))))).scalar()
    parts = [(tags, "tags", "string", "map<string,string>"), (params, "params", "string", "map<string,string>"),
             (metrics, "metrics", "double", "map<string,double>")]
    base = next(df for df, *_ in parts if df is not None)
    # each map is a scalar subquery over its (small) key / value table
    return base.agg(F.count(F.lit(1))).select(
        F.lit(experiment_id).alias(EXP), F.lit(run_id).alias(RUN),
        F.to_timestamp_ntz(F.lit(start_time)).alias(START),
        *[as_map(df, vt, t).alias(n) for df, n, vt, t in parts])
