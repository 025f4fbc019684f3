"""Queries R1-R11 over run records derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import runs as R
from ...operators import splits as S
from ..tables import model_name_of, registry_from_runs, runs_records, table

NOW = "2025-01-01T00:00:00"
SPECS = ["champion", "latest", "1", "archived", "7", "newest"]


def _ids(df):
    return df.select("experiment_id", "run_id", "start_time")


def q_search_runs(spark, sf):
    r = R.search_runs(runs_records(spark, sf), tag_equals={"model_alias": "archived"}, max_results=3)
    return _ids(r)


def q_latest_run(spark, sf):
    return _ids(R.latest_run(runs_records(spark, sf)))


def q_run_by_alias(spark, sf):
    return _ids(R.run_by_alias(runs_records(spark, sf), "champion"))


def q_metric_direction(spark, sf):
    names = runs_records(spark, sf).select(F.explode(F.map_keys("metrics")).alias("metric_name")).distinct()
    return names.select("metric_name", R.metric_direction(F.col("metric_name")).alias("higher_is_better"))


def q_compare_models(spark, sf):
    return R.compare_models(runs_records(spark, sf), "test_accuracy", 0.01)


def q_compare_models_rmse(spark, sf):
    return R.compare_models(runs_records(spark, sf), "test_rmse", 0.01)


def _tag_view(runs):
    return runs.select("experiment_id", "run_id", R.tags_text(F.col("tags")).alias("tags"))


def q_tag_challenger(spark, sf):
    return _tag_view(R.tag_challenger(runs_records(spark, sf)))


def _promoted(spark, sf):
    runs = runs_records(spark, sf)
    versions, aliases = registry_from_runs(runs)
    return R.promote_model(R.tag_challenger(runs), versions, aliases, NOW, model_name=model_name_of)


def q_promote_model(spark, sf):
    return _tag_view(_promoted(spark, sf)[0])


def q_promote_model_registry(spark, sf):
    return _promoted(spark, sf)[2]


def _gated(spark, sf):
    """Only experiments whose comparison says so are promoted; two experiments share a model name."""
    runs = runs_records(spark, sf)
    versions, aliases = registry_from_runs(runs)
    decisions = R.compare_models(runs, "test_accuracy", 0.01).select("experiment_id", "promote_challenger")
    shared = lambda e: F.concat(F.lit("shared-"), F.floor(e / 2).cast("string"))
    return R.promote_model(R.tag_challenger(runs), versions, aliases, NOW, model_name=shared, decisions=decisions)


def q_promote_gated(spark, sf):
    return _tag_view(_gated(spark, sf)[0])


def q_promote_gated_registry(spark, sf):
    return _gated(spark, sf)[2]


def _rolled(spark, sf):
    runs = runs_records(spark, sf)
    versions, aliases = registry_from_runs(runs)
    return R.rollback_model(runs, versions, aliases, NOW, model_name=model_name_of)


def q_rollback_model(spark, sf):
    return _tag_view(_rolled(spark, sf)[0])


def q_rollback_model_registry(spark, sf):
    return _rolled(spark, sf)[1]


def q_comparison_report(spark, sf):
    runs = runs_records(spark, sf)
    return R.comparison_report(R.compare_models(runs, "test_accuracy", 0.01), runs, 0.01)


def q_resolve_model(spark, sf):
    runs = runs_records(spark, sf)
    versions, aliases = registry_from_runs(runs)
    req = (runs.select("experiment_id").distinct()
               .select("experiment_id", model_name_of(F.col("experiment_id")).alias("model_name"),
                       F.explode(F.array(*[F.lit(s) for s in SPECS])).alias("version_spec")))
    return R.resolve_model(req, versions, aliases, runs)


def q_dataset_lineage(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    s = S.split_three_way(o, keys=["o_orderkey"], label="o_orderstatus", test_size=0.2,
                          validation_size=0.1, seed=42)
    return R.dataset_lineage(s, "orders", "orders.parquet", "o_orderstatus")


QUERIES = {
    "search_runs": q_search_runs,
    "latest_run": q_latest_run,
    "run_by_alias": q_run_by_alias,
    "metric_direction": q_metric_direction,
    "compare_models": q_compare_models,
    "compare_models_rmse": q_compare_models_rmse,
    "tag_challenger": q_tag_challenger,
    "promote_model": q_promote_model,
    "promote_model_registry": q_promote_model_registry,
    "promote_gated": q_promote_gated,
    "promote_gated_registry": q_promote_gated_registry,
    "rollback_model": q_rollback_model,
    "rollback_model_registry": q_rollback_model_registry,
    "comparison_report": q_comparison_report,
    "resolve_model": q_resolve_model,
    "dataset_lineage": q_dataset_lineage,
}

# ---------------------------------------------------------------- oracle SQL
RUNS = """runs as (select user_id experiment_id, event_id run_id, ts start_time,
       case event_type when 'purchase' then 'champion' when 'error' then 'archived' end alias,
       case when event_id % 10 = 3 then null else value / 1000 end test_accuracy,
       value test_rmse from events)"""
NEWEST = "row_number() over (partition by experiment_id order by start_time desc, run_id desc)"
LATEST = f"l as (select * from (select *, {NEWEST} rn from runs) where rn = 1)"
CHAMP = f"c as (select * from (select *, {NEWEST} rn from runs where alias = 'champion') where rn = 1)"
REG = """v as (select 'model-' || experiment_id model_name, experiment_id, run_id, start_time, alias,
        row_number() over (partition by experiment_id order by start_time, run_id) version
      from runs where alias in ('champion', 'archived')),
a as (select model_name, alias, version from (select *, row_number() over (partition by model_name, alias
        order by start_time desc, run_id desc) rn from v) where rn = 1)"""


def _compare_sql(metric, higher):
    imp = "cs - ps" if higher else "ps - cs"
    better = "cs > ps" if higher else "cs < ps"
    return f"""with {RUNS}, {LATEST}, {CHAMP},
j as (select l.experiment_id, c.run_id champion_run_id, l.run_id challenger_run_id,
        l.{metric} cs, c.{metric} ps from l left join c using (experiment_id)),
k as (select *, coalesce(champion_run_id = challenger_run_id, false) same, cs is null missing,
        champion_run_id is null or ps is null first, {imp} imp, {better} better,
        case when abs(ps) > 1e-10 then ({imp}) / abs(ps) else 0.0 end pct from j),
f as (select *, not same and not missing and not first compared from k)
select experiment_id, champion_run_id, challenger_run_id,
  case when same or missing then false when first then true else better and pct >= 0.01 end promote_challenger,
  case when compared then ps end champion_score,
  case when not missing and not same then cs end challenger_score,
  case when compared then imp end improvement,
  case when compared then pct end pct_improvement,
  '{metric}' metric,
  case when compared then {str(higher).lower()} end higher_is_better,
  case when same then 'No challenger: the newest run is the champion'
       when missing then 'Challenger missing primary metric: {metric}'
       when first then 'First model - promoting as champion'
       when better and pct >= 0.01 then 'Challenger improved by ' || printf('%.2f', pct * 100) || '% (threshold: 1.00%)'
       when better then 'Improvement ' || printf('%.2f', pct * 100) || '% below threshold 1.00%'
       else 'Challenger performed worse on {metric}' end reason
from f"""


SQL = {
    "search_runs": f"""with {RUNS}
select experiment_id, run_id, start_time from (select *, {NEWEST} rn from runs where alias = 'archived') where rn <= 3""",
    "latest_run": f"with {RUNS}, {LATEST} select experiment_id, run_id, start_time from l",
    "run_by_alias": f"with {RUNS}, {CHAMP} select experiment_id, run_id, start_time from c",
    "metric_direction": f"""with {RUNS}
select 'test_accuracy' metric_name, true higher_is_better from runs where test_accuracy is not null group by 1
union all select 'test_rmse', false from runs where test_rmse is not null group by 1""",
    "compare_models": _compare_sql("test_accuracy", True),
    "compare_models_rmse": _compare_sql("test_rmse", False),
    "tag_challenger": f"""with {RUNS}, {LATEST}
select r.experiment_id, r.run_id,
  case when l.run_id is not null then ['ci_pipeline=true', 'model_alias=challenger']
       when r.alias is not null then ['model_alias=' || r.alias] else [] end tags
from runs r left join l on r.run_id = l.run_id and r.experiment_id = l.experiment_id""",
    "promote_model": f"""with {RUNS}, {LATEST},
t as (select r.experiment_id, r.run_id, r.start_time,
        case when l.run_id is not null then 'challenger' else r.alias end alias
      from runs r left join l on r.run_id = l.run_id and r.experiment_id = l.experiment_id),
ch as (select * from (select *, {NEWEST} rn from t where alias = 'challenger') where rn = 1),
cp as (select * from (select *, {NEWEST} rn from t where alias = 'champion') where rn = 1)
select t.experiment_id, t.run_id,
  case when ch.run_id is not null then ['ci_pipeline=true', 'model_alias=champion', 'promoted_at={NOW}', 'promoted_from=challenger']
       when cp.run_id is not null and exists (select 1 from ch where ch.experiment_id = t.experiment_id)
         then ['archived_at={NOW}', 'archived_reason=Replaced by better model', 'model_alias=archived']
       when t.run_id = l.run_id then ['ci_pipeline=true', 'model_alias=challenger']
       when t.alias is not null then ['model_alias=' || t.alias] else [] end tags
from t left join ch on t.run_id = ch.run_id and t.experiment_id = ch.experiment_id
       left join cp on t.run_id = cp.run_id and t.experiment_id = cp.experiment_id
       left join l on t.run_id = l.run_id and t.experiment_id = l.experiment_id""",
    "promote_model_registry": f"""with {RUNS}, {LATEST},
t as (select r.experiment_id, r.run_id, r.start_time,
        case when l.run_id is not null then 'challenger' else r.alias end alias
      from runs r left join l on r.run_id = l.run_id and r.experiment_id = l.experiment_id),
ch as (select * from (select *, {NEWEST} rn from t where alias = 'challenger') where rn = 1),
cp as (select * from (select *, {NEWEST} rn from t where alias = 'champion') where rn = 1),
{REG},
mx as (select model_name, max(version) mv from v group by 1),
nv as (select 'model-' || ch.experiment_id model_name, coalesce(v.version, coalesce(mx.mv, 0) + 1) version
       from ch left join v on v.run_id = ch.run_id and v.experiment_id = ch.experiment_id
               left join mx on mx.model_name = 'model-' || ch.experiment_id),
ov as (select 'model-' || cp.experiment_id model_name, min(v.version) version
       from cp join ch using (experiment_id) join v on v.run_id = cp.run_id and v.experiment_id = cp.experiment_id group by 1),
upd as (select model_name, 'champion' alias, version from nv union all select model_name, 'archived', version from ov)
select model_name, alias, cast(version as bigint) version from a
  where not exists (select 1 from upd where upd.model_name = a.model_name and upd.alias = a.alias)
union all select model_name, alias, cast(version as bigint) from upd""",
    "rollback_model": f"""with {RUNS}, {CHAMP},
p as (select * from (select *, {NEWEST} rn from runs where alias = 'archived') where rn = 1),
pr as (select c.experiment_id, c.run_id cur, p.run_id prev from c join p using (experiment_id))
select r.experiment_id, r.run_id,
  case when r.run_id = pr.cur then ['archived_at={NOW}', 'archived_reason=Rollback - replaced by previous model', 'model_alias=archived']
       when r.run_id = pr.prev then ['model_alias=champion', 'restored_at={NOW}']
       when r.alias is not null then ['model_alias=' || r.alias] else [] end tags
from runs r left join pr on r.experiment_id = pr.experiment_id and (r.run_id = pr.cur or r.run_id = pr.prev)""",
    "rollback_model_registry": f"""with {RUNS}, {CHAMP},
p as (select * from (select *, {NEWEST} rn from runs where alias = 'archived') where rn = 1),
pr as (select c.experiment_id, c.run_id cur, p.run_id prev from c join p using (experiment_id)),
{REG},
upd as (select v.model_name, 'champion' alias, min(v.version) version from pr join v on v.run_id = pr.prev and v.experiment_id = pr.experiment_id group by 1
        union all
        select v.model_name, 'archived', min(v.version) from pr join v on v.run_id = pr.cur and v.experiment_id = pr.experiment_id group by 1)
select model_name, alias, cast(version as bigint) version from a
  where not exists (select 1 from upd where upd.model_name = a.model_name and upd.alias = a.alias)
union all select model_name, alias, cast(version as bigint) from upd""",
    "comparison_report": f"""with cmp as ({_compare_sql("test_accuracy", True)}),
{RUNS},
m as (select run_id, experiment_id, 'test_accuracy' metric_name, test_accuracy metric_value from runs where test_accuracy is not null
      union all select run_id, experiment_id, 'test_rmse', test_rmse from runs),
mr as (select *, cast(row_number() over (partition by experiment_id, run_id order by metric_name) as integer) metric_rank from m)
select cmp.experiment_id, champion_run_id, challenger_run_id, promote_challenger, metric, champion_score, challenger_score,
  case when pct_improvement is not null and champion_score is not null and challenger_score is not null
       then challenger_score - champion_score end abs_change,
  pct_improvement pct_change,
  case when pct_improvement is null then null when pct_improvement = 0 then 'flat'
       when pct_improvement > 0 then 'up' else 'down' end trend,
  case when not (pct_improvement is not null and champion_score is not null and challenger_score is not null) then null
       when promote_challenger then 'exceeds threshold' when improvement > 0 then 'below threshold'
       else 'degraded' end result,
  0.01e0 threshold, metric_rank, metric_name, metric_value, metric_name = metric is_primary
from cmp left join mr on mr.run_id = cmp.challenger_run_id and mr.experiment_id = cmp.experiment_id""",
    "resolve_model": f"""with {RUNS}, {LATEST}, {CHAMP}, {REG},
req as (select experiment_id, 'model-' || experiment_id model_name, unnest({SPECS!r}) version_spec
        from (select distinct experiment_id from runs)),
mx as (select model_name, max(version) mv from v group by 1),
res as (select req.*, case when version_spec in ('champion', 'staging', 'production', 'archived') then a.version
          when version_spec = 'latest' then mx.mv
          when regexp_matches(version_spec, '^[0-9]+$') then (select v2.version from v v2 where v2.model_name = req.model_name
               and cast(v2.version as varchar) = version_spec) end rv,
          coalesce(c.run_id, l.run_id) fb
        from req left join a on a.model_name = req.model_name and a.alias = req.version_spec
                 left join mx on mx.model_name = req.model_name
                 left join c on c.experiment_id = req.experiment_id
                 left join l on l.experiment_id = req.experiment_id)
select experiment_id, model_name, version_spec, cast(rv as bigint) resolved_version,
  case when rv is not null then 'registry' when fb is not null then 'run' else 'local' end source,
  case when rv is not null then 'models:/' || model_name || '/' || rv
       when fb is not null then 'runs:/' || fb || '/model' else 'models/' || model_name end model_uri
from res""",
}

_GATE = f"""dec as (select experiment_id from ({_compare_sql("test_accuracy", True)}) where promote_challenger),
{RUNS}, {LATEST},
t as (select r.experiment_id, r.run_id, r.start_time,
        case when l.run_id is not null then 'challenger' else r.alias end alias
      from runs r left join l on r.run_id = l.run_id and r.experiment_id = l.experiment_id),
ch as (select * from (select *, {NEWEST} rn from t where alias = 'challenger') where rn = 1 and experiment_id in (select experiment_id from dec)),
cp as (select * from (select *, {NEWEST} rn from t where alias = 'champion') where rn = 1 and experiment_id in (select experiment_id from ch))"""
SQL["promote_gated"] = f"""with {_GATE}
select t.experiment_id, t.run_id,
  case when ch.run_id is not null then ['ci_pipeline=true', 'model_alias=champion', 'promoted_at={NOW}', 'promoted_from=challenger']
       when cp.run_id is not null then ['archived_at={NOW}', 'archived_reason=Replaced by better model', 'model_alias=archived']
       when t.run_id = l.run_id then ['ci_pipeline=true', 'model_alias=challenger']
       when t.alias is not null then ['model_alias=' || t.alias] else [] end tags
from t left join ch on t.run_id = ch.run_id and t.experiment_id = ch.experiment_id
       left join cp on t.run_id = cp.run_id and t.experiment_id = cp.experiment_id
       left join l on t.run_id = l.run_id and t.experiment_id = l.experiment_id"""
# every promoted run is new under its shared name: versions number a model's experiments in order; the newest run is champion
SQL["promote_gated_registry"] = f"""with {_GATE}, {REG},
n as (select 'shared-' || (experiment_id // 2) model_name, run_id, start_time,
        row_number() over (partition by experiment_id // 2 order by experiment_id) version from ch)
select model_name, alias, cast(version as bigint) version from a
union all select model_name, 'champion', cast(arg_max(version, struct_pack(start_time, run_id)) as bigint) from n group by 1"""

from .splits import SQL as _SPLIT_SQL  # noqa: E402

SQL["dataset_lineage"] = f"""with s as ({_SPLIT_SQL["split_three_way"]})
select 'orders-' || split as name, 'orders.parquet' as source,
  case split when 'train' then 'training' when 'test' then 'testing' else 'validation' end as context,
  'o_orderstatus' as target, count(*) as rows, 'struct<o_orderkey:bigint,o_orderstatus:string>' as schema
from s group by split"""
