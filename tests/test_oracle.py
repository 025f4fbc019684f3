"""Every query with an oracle equals DuckDB by value at sf0.01."""
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF01
from tests.oracle_harness import compare

NAMES = sorted(oracle_sql())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["split", "n_rows", "accuracy", "roc_auc", "suite_success", "success_percent"]
    assert {r["split"] for r in rows} == {"train", "test", "validation"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    r = compare(spark, duck, name, queries()[name], oracle_sql()[name], SF01)
    assert r["ok"], r
