"""Expectations against brute-force loops, with NULL and NaN."""
import math

from loomkit.operators import expectations as X


def _nulls(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), "b"), (None, None, None), (2, 5.0, "a"), (4, 2.5, "zz")]
    return spark.createDataFrame(rows, "k long, v double, s string"), rows


def test_value_checks(spark):
    df, rows = _nulls(spark)
    suite = [X.Expectation.of(X.BETWEEN, "v", min_value=0, max_value=3),
             X.Expectation.of(X.NOT_NULL, "v"), X.Expectation.of(X.UNIQUE, "k"),
             X.Expectation.of(X.IN_SET, "s", value_set=["a", "b"]),
             X.Expectation.of(X.REGEX, "s", regex="^[ab]$"),
             X.Expectation.of(X.DISTINCT_BETWEEN, "v", min_value=3, max_value=3),
             X.Expectation.of(X.MEAN_BETWEEN, "v", min_value=2, max_value=3)]
    r = {x["expectation"]: x for x in X.validate(df, suite).collect()}
    vs = [v for _, v, _ in rows if v is not None and not math.isnan(v)]
    assert r[X.BETWEEN]["unexpected_count"] == sum(1 for v in vs if not 0 <= v <= 3) == 1
    assert r[X.BETWEEN]["unexpected_percent"] == 100.0 / 3
    assert r[X.NOT_NULL]["unexpected_count"] == 2          # NULL and NaN are both missing
    assert r[X.NOT_NULL]["unexpected_percent"] == 40.0
    assert r[X.UNIQUE]["unexpected_count"] == 2            # both members of the duplicate group
    assert r[X.IN_SET]["unexpected_count"] == 1 and not r[X.IN_SET]["success"]
    assert r[X.REGEX]["unexpected_count"] == 1
    assert r[X.DISTINCT_BETWEEN]["observed_value"] == 3 and r[X.DISTINCT_BETWEEN]["success"]
    assert abs(r[X.MEAN_BETWEEN]["observed_value"] - sum(vs) / 3) < 1e-12


def test_suite_drops_exact_repeats_and_counts(spark):
    df, _ = _nulls(spark)
    suite = X.default_suite(["k", "v", "s"], {"k": "int64", "v": "float64"})
    res = X.validate(df, [*suite, *suite, X.Expectation.of(X.COLUMNS_MATCH, column_set=["k"], exact_match=False)])
    assert res.count() == 6   # repeated checks are dropped; the inexact set check stays
    tot = X.suite_statistics(res).first()
    assert tot["evaluated_expectations"] == 6 and tot["success"]


def test_missing_column_fails(spark):
    df, _ = _nulls(spark)
    r = X.validate(df, [X.Expectation.of(X.EXISTS, "nope"), X.Expectation.of(X.NOT_NULL, "nope")]).collect()
    assert [x["success"] for x in r] == [False, False]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(vals=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=30),
       lo=st.integers(-5, 0), hi=st.integers(0, 5))
def test_row_checks_equal_brute_force(spark, vals, lo, hi):
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    suite = [X.Expectation.of(X.BETWEEN, "v", min_value=lo, max_value=hi), X.Expectation.of(X.UNIQUE, "v"),
             X.Expectation.of(X.NOT_NULL, "v"), X.Expectation.of(X.IN_SET, "v", value_set=[0, 1, 2])]
    r = {x["expectation"]: x for x in X.validate(df, suite).collect()}
    nn = [v for v in vals if v is not None]
    assert r[X.BETWEEN]["unexpected_count"] == sum(1 for v in nn if not lo <= v <= hi)
    assert r[X.UNIQUE]["unexpected_count"] == sum(1 for v in nn if nn.count(v) > 1)
    assert r[X.NOT_NULL]["unexpected_count"] == len(vals) - len(nn)
    assert r[X.IN_SET]["unexpected_count"] == sum(1 for v in nn if v not in (0, 1, 2))
    assert r[X.BETWEEN]["success"] == all(lo <= v <= hi for v in nn)



def test_several_unique_checks_in_one_pass(spark):
    rows = [(1, "a", 0.5), (1, "b", float("nan")), (2, "b", 0.5), (3, None, float("nan")), (4, "c", 1.5)]
    df = spark.createDataFrame(rows, "k long, s string, d double")
    suite = [X.Expectation.of(X.UNIQUE, c) for c in ("k", "s", "d")]
    got = {r["column"]: r["unexpected_count"] for r in X.validate(df, suite).collect()}
    assert got == {"k": 2, "s": 2, "d": 2}     # NaN is missing, so only the two 0.5 values collide


def test_written_and_validated_in_one_pass(spark, tmp_path):
    """The input is computed once; results equal ``validate``; the session can aggregate ML predictions afterwards."""
    from pyspark.sql import functions as F

    from loomkit.operators import expectations as X
    from loomkit.operators import models as M
    from loomkit.plans.catalog.profile import orders_suite
    from loomkit.plans.tables import table
    from tests.conftest import SF001
    orders = table(spark, SF001, "orders")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    from loomkit.session import ship_package
    ship_package(spark)
    once = orders.mapInArrow(counted, orders.schema)
    got = X.write_validated(once, orders_suite(), str(tmp_path / "out"))
    shown = lambda df: sorted(repr(r) for r in df.withColumn("observed_value", F.round("observed_value", 6)).collect())
    rows = shown(got)                                                        # (a mean's last digit follows the order of the sum)
    assert reads.value == orders.count()
    assert rows == shown(X.validate(orders, orders_suite()))
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(orders).count() == 0
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, y double")
    scored = M.train_random_forest(df, ["x"], "y", n_estimators=2, max_depth=2).transform(df)
    assert scored.groupBy("prediction").agg(F.count("*").alias("n")).agg(F.sum("n")).first()[0] == 20


def test_default_suite_has_each_check_once():
    from loomkit.operators import expectations as X
    s = X.default_suite(["a", "b"], {"a": "int64"})
    assert len(s) == len({(e.expectation, e.column) for e in s}) == 4


def test_orders_suite_is_whole():
    """The starter suite checks the column set twice: exactly, and as it is by default."""
    from loomkit.operators import expectations as X
    from loomkit.plans.catalog.profile import SQL, orders_suite
    whole = X.dedupe(orders_suite())
    assert len(whole) == 14
    assert [e.kw.get("exact_match") for e in whole if e.expectation == X.COLUMNS_MATCH] == [True, None]
    assert SQL["validate_suite"].count("as expectation_id") == 14


def test_totals_count_the_whole_orders_suite(spark):
    from loomkit.plans.catalog.profile import SQL, q_validate_suite_totals
    from tests.conftest import SF001
    assert SQL["validate_suite_totals"].count("as expectation_id") == 14
    assert q_validate_suite_totals(spark, SF001).first()["evaluated_expectations"] == 14
