"""Tag -> promote -> rollback against a dict model: at most one champion."""
from pyspark.sql import functions as F

from loomkit.operators import runs as R

NOW = "2025-01-01T00:00:00"


def _runs(spark, rows):
    return spark.createDataFrame(
        [(e, r, f"2024-01-01 00:00:{t:02d}", tags, {"test_accuracy": m} if m is not None else {}, {})
         for e, r, t, tags, m in rows],
        "experiment_id string, run_id long, start_time string, tags map<string,string>, "
        "metrics map<string,double>, params map<string,string>").withColumn(
        "start_time", F.to_timestamp_ntz("start_time"))


def _alias(df):
    return {r["run_id"]: r["tags"].get("model_alias") for r in df.collect()}


def test_compare_cases(spark):
    rows = [("e1", 1, 1, {"model_alias": "champion"}, 0.5), ("e1", 2, 2, {}, 0.6),      # promote
            ("e2", 3, 1, {"model_alias": "champion"}, 0.5), ("e2", 4, 2, {}, 0.503),    # below threshold
            ("e3", 5, 1, {"model_alias": "champion"}, 0.5), ("e3", 6, 2, {}, 0.4),      # worse
            ("e4", 7, 1, {}, 0.5),                                                       # first model
            ("e5", 8, 1, {"model_alias": "champion"}, 0.5), ("e5", 9, 2, {}, None),     # missing metric
            ("e6", 10, 3, {"model_alias": "champion"}, 0.5),                             # same run
            ("e7", 11, 1, {"model_alias": "champion"}, 0.0), ("e7", 12, 2, {}, 0.9)]    # zero champion
    c = {r["experiment_id"]: r for r in R.compare_models(_runs(spark, rows)).collect()}
    assert c["e1"]["promote_challenger"] and c["e1"]["reason"].startswith("Challenger improved by 20.00%")
    assert not c["e2"]["promote_challenger"] and c["e2"]["reason"] == "Improvement 0.60% below threshold 1.00%"
    assert c["e3"]["reason"] == "Challenger performed worse on test_accuracy"
    assert c["e4"]["promote_challenger"] and c["e4"]["reason"] == R.REASON_FIRST
    assert not c["e5"]["promote_challenger"] and c["e5"]["reason"].startswith(R.REASON_MISSING)
    assert not c["e6"]["promote_challenger"] and c["e6"]["reason"] == R.REASON_SAME
    assert not c["e7"]["promote_challenger"] and c["e7"]["pct_improvement"] == 0.0


def test_direction_table_order(spark):
    df = spark.createDataFrame([(n,) for n in ["test_rmse", "precision_loss", "test_davies_bouldin_index",
                                               "inertia", "val_loss", "R2"]], "m string")
    got = {r["m"]: r["d"] for r in df.select("m", R.metric_direction(F.col("m")).alias("d")).collect()}
    assert got == {"test_rmse": False, "precision_loss": True, "test_davies_bouldin_index": True,
                   "inertia": True, "val_loss": False, "R2": True}
    got = df.select(R.metric_direction(F.col("m"), {"inertia": False}).alias("d")).collect()
    assert got[3]["d"] is False


def test_tag_promote_rollback_state_machine(spark):
    rows = [("e1", 1, 1, {"model_alias": "archived", "archived_at": "2024-06-01"}, 0.4),
            ("e1", 2, 2, {"model_alias": "champion"}, 0.5), ("e1", 3, 3, {}, 0.7),
            ("e2", 4, 1, {}, 0.1)]
    runs = _runs(spark, rows)
    versions = spark.createDataFrame([("e1-model", 1, 1), ("e1-model", 2, 2)], "model_name string, version long, run_id long")
    aliases = spark.createDataFrame([("e1-model", "champion", 2), ("e1-model", "archived", 1)],
                                    "model_name string, alias string, version long")
    runs = runs.withColumn("experiment_id", F.concat("experiment_id", F.lit("-exp")))
    tagged = R.tag_challenger(runs)
    assert _alias(tagged) == {1: "archived", 2: "champion", 3: "challenger", 4: "challenger"}
    r2, v2, a2 = R.promote_model(tagged, versions, aliases, NOW)
    assert _alias(r2) == {1: "archived", 2: "archived", 3: "champion", 4: "champion"}
    al = {(r["model_name"], r["alias"]): r["version"] for r in a2.collect()}
    assert al[("e1-model", "champion")] == 3 and al[("e1-model", "archived")] == 2
    assert al[("e2-model", "champion")] == 1
    r3, a3 = R.rollback_model(r2, v2, a2, NOW)
    got = {r["run_id"]: r["tags"] for r in r3.collect()}
    assert got[3]["model_alias"] == "archived"
    # the most recently archived run (run 2, archived_at = NOW) comes back
    assert got[2]["model_alias"] == "champion" and "archived_at" not in got[2] and got[2]["restored_at"] == NOW
    for df in (tagged, r2, r3):
        champs = df.where(F.col("tags")["model_alias"] == "champion").groupBy("experiment_id").count()
        assert champs.where("count > 1").count() == 0


def test_threshold_edges_and_no_runs(spark):
    # pct exactly 0.01 promotes (>=); pct just under does not; lower-is-better metric
    rows = [("a", 1, 1, {"model_alias": "champion"}, 0.5), ("a", 2, 2, {}, 0.505),
            ("b", 3, 1, {"model_alias": "champion"}, 0.5), ("b", 4, 2, {}, 0.50499)]
    runs = _runs(spark, rows)
    c = {r["experiment_id"]: r for r in R.compare_models(runs, threshold=0.01).collect()}
    assert abs(c["a"]["pct_improvement"] - 0.01) < 1e-12
    assert c["a"]["promote_challenger"] == (c["a"]["pct_improvement"] >= 0.01)
    assert not c["b"]["promote_challenger"] and c["b"]["reason"].startswith("Improvement 1.00% below")
    low = runs.withColumn("metrics", F.create_map(F.lit("test_rmse"), F.col("metrics")["test_accuracy"]))
    c = {r["experiment_id"]: r for r in R.compare_models(low, "test_rmse").collect()}
    assert c["a"]["higher_is_better"] is False and not c["a"]["promote_challenger"]
    assert c["a"]["reason"] == "Challenger performed worse on test_rmse"
    exps = spark.createDataFrame([("a",), ("zz",)], "experiment_id string")
    c = {r["experiment_id"]: r for r in R.compare_models(runs, experiments=exps).collect()}
    assert c["zz"]["reason"] == R.REASON_NO_RUNS and not c["zz"]["promote_challenger"]
    assert set(c) == {"a", "zz"}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _model_step(state, op):
    """Dict model: state[exp] = list of [run_id, start, tags]; newest = max (start, run_id)."""
    for exp, runs in state.items():
        def newest(pred, key=lambda r: (r[1], r[0])):
            c = [r for r in runs if pred(r)]
            return max(c, key=key) if c else None
        if op == "tag":
            r = newest(lambda r: True)
            r[2].update({"model_alias": "challenger", "ci_pipeline": "true"})
        elif op == "promote":
            ch = newest(lambda r: r[2].get("model_alias") == "challenger")
            if ch is None:
                continue
            cp = newest(lambda r: r[2].get("model_alias") == "champion")
            if cp is not None:
                cp[2].update({"model_alias": "archived", "archived_at": NOW,
                              "archived_reason": "Replaced by better model"})
            ch[2].update({"model_alias": "champion", "promoted_at": NOW, "promoted_from": "challenger"})
        elif op == "rollback":
            cur = newest(lambda r: r[2].get("model_alias") == "champion")
            prev = newest(lambda r: r[2].get("model_alias") == "archived",
                          key=lambda r: ("archived_at" in r[2], r[2].get("archived_at", ""), r[1], r[0]))
            if cur is None or prev is None:
                continue
            cur[2].update({"model_alias": "archived", "archived_at": NOW,
                           "archived_reason": "Rollback - replaced by previous model"})
            prev[2].pop("archived_at", None)
            prev[2].update({"model_alias": "champion", "restored_at": NOW})


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(ops=st.lists(st.sampled_from(["tag", "promote", "rollback"]), min_size=1, max_size=4))
def test_operation_sequences_match_dict_model(spark, ops):
    rows = [("x-exp", 1, 1, {"model_alias": "archived"}, 0.1), ("x-exp", 2, 2, {"model_alias": "champion"}, 0.2),
            ("x-exp", 3, 3, {}, 0.3), ("y-exp", 4, 1, {}, 0.1), ("y-exp", 5, 2, {}, 0.2)]
    state = {}
    for e, r, t, tags, _ in rows:
        state.setdefault(e, []).append([r, t, dict(tags)])
    runs = _runs(spark, rows)
    versions = spark.createDataFrame([("x-model", 1, 1), ("x-model", 2, 2)], "model_name string, version long, run_id long")
    aliases = spark.createDataFrame([("x-model", "archived", 1), ("x-model", "champion", 2)],
                                    "model_name string, alias string, version long")
    for op in ops:
        if op == "tag":
            runs = R.tag_challenger(runs)
        elif op == "promote":
            runs, versions, aliases = R.promote_model(runs, versions, aliases, NOW)
        else:
            runs, aliases = R.rollback_model(runs, versions, aliases, NOW)
        runs = spark.createDataFrame(runs.collect(), runs.schema)  # small fixture: keep plans short
        _model_step(state, op)
        got = {r["run_id"]: dict(r["tags"]) for r in runs.collect()}
        want = {r[0]: r[2] for rs in state.values() for r in rs}
        assert got == want, (ops, op)
        for rs in state.values():
            assert sum(1 for r in rs if r[2].get("model_alias") == "champion") <= 1


def test_search_runs_by_tag_order(spark):
    rows = [("e", 1, 1, {"model_alias": "archived", "archived_at": "2024-03"}, 0.1),
            ("e", 2, 2, {"model_alias": "archived", "archived_at": "2024-05"}, 0.2),
            ("e", 3, 3, {"model_alias": "archived"}, 0.3)]
    got = R.search_runs(_runs(spark, rows), tag_equals={"model_alias": "archived"},
                        order_by=[(F.col("tags")["archived_at"], False)], max_results=2).collect()
    assert [r["run_id"] for r in sorted(got, key=lambda r: r["tags"].get("archived_at", ""), reverse=True)] == [2, 1]


def test_resolve_model_fallbacks(spark):
    runs = _runs(spark, [("a-exp", 1, 1, {"model_alias": "champion"}, 0.1), ("a-exp", 2, 2, {}, 0.2),
                         ("b-exp", 3, 1, {}, 0.1)])
    versions = spark.createDataFrame([("a-model", 1, 1), ("a-model", 4, 1)], "model_name string, version long, run_id long")
    aliases = spark.createDataFrame([("a-model", "champion", 1)], "model_name string, alias string, version long")
    req = spark.createDataFrame(
        [("a-exp", "a-model", s) for s in ("Champion", "latest", "4", "9", "staging")] + [("b-exp", "b-model", "latest"),
                                                                                          ("c-exp", "c-model", "1")],
        "experiment_id string, model_name string, version_spec string")
    got = {(r["model_name"], r["version_spec"]): r["model_uri"] for r in R.resolve_model(req, versions, aliases, runs).collect()}
    assert got[("a-model", "Champion")] == "models:/a-model/1"      # alias (case-insensitive)
    assert got[("a-model", "latest")] == "models:/a-model/4"        # highest version
    assert got[("a-model", "4")] == "models:/a-model/4"             # that version
    assert got[("a-model", "9")] == "runs:/1/model"                 # unknown version: newest champion run
    assert got[("a-model", "staging")] == "runs:/1/model"           # alias not set: newest champion run
    assert got[("b-model", "latest")] == "runs:/3/model"            # no registry, no champion: newest run
    assert got[("c-model", "1")] == "models/c-model"                # nothing known: local path


def test_gate_and_shared_model_name(spark):
    rows = [("a", 1, 1, {"model_alias": "champion"}, 0.5), ("a", 2, 2, {"model_alias": "challenger"}, 0.9),
            ("b", 3, 3, {"model_alias": "champion"}, 0.5), ("b", 4, 9, {"model_alias": "challenger"}, 0.8),
            ("c", 5, 1, {"model_alias": "champion"}, 0.5), ("c", 6, 2, {"model_alias": "challenger"}, 0.1)]
    runs = _runs(spark, rows)
    versions = spark.createDataFrame([("m", 1, 1), ("m", 2, 3), ("m", 3, 5)], "model_name string, version long, run_id long")
    aliases = spark.createDataFrame([("m", "champion", 1), ("other", "champion", 7)], "model_name string, alias string, version long")
    one = lambda e: F.lit("m")
    r2, v2, a2 = R.promote_model(runs, versions, aliases, NOW, model_name=one, decisions=R.compare_models(runs))
    assert _alias(r2) == {1: "archived", 2: "champion", 3: "archived", 4: "champion", 5: "champion", 6: "challenger"}
    assert sorted(map(tuple, v2.collect())) == [("m", 1, 1), ("m", 2, 3), ("m", 3, 5), ("m", 4, 2), ("m", 5, 4)]
    # one row per alias: the newest promoted run (4) and the newest replaced one (3)
    assert sorted(map(tuple, a2.collect())) == [("m", "archived", 2), ("m", "champion", 5), ("other", "champion", 7)]
    _, a3 = R.rollback_model(r2, v2, a2, "2025-02-01T00:00:00", model_name=one)
    assert sorted(map(tuple, a3.collect())) == [("m", "archived", 5), ("m", "champion", 2), ("other", "champion", 7)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_search_runs_is_ordered_without_a_limit(spark):
    rows = [("e", 1, 2, {}, 0.1), ("e", 2, 3, {}, 0.3), ("e", 3, 1, {}, 0.2), ("d", 4, 1, {}, 0.2)]
    runs = _runs(spark, rows)
    assert [r["run_id"] for r in R.search_runs(runs).collect()] == [4, 2, 1, 3]
    by = [(F.col("metrics")["test_accuracy"], True)]
    assert [r["run_id"] for r in R.search_runs(runs, order_by=by).collect()] == [4, 1, 3, 2]
    assert [r["run_id"] for r in R.search_runs(runs, order_by=by, max_results=2).collect()] == [4, 1, 3]
