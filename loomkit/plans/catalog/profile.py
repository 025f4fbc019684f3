"""Queries D1-D4 and V1-V13 over the driver tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from ...operators import expectations as X
from ...operators import profile as P
from ..tables import table

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def q_dataset_info(spark, sf):
    return P.dataset_info(table(spark, sf, "orders"), target="o_orderstatus",
                          file_format="parquet", path="orders.parquet")


def q_class_distribution(spark, sf):
    return P.class_distribution(table(spark, sf, "part"), "p_brand")


def q_table_bytes(spark, sf):
    return P.table_bytes(table(spark, sf, "documents"))


def q_dataset_summary(spark, sf):
    info = q_dataset_info(spark, sf)
    return P.dataset_summary(info, file_name="orders.parquet")


ORDERS_TYPES = {"o_orderkey": "int64", "o_totalprice": "float64"}


def _value_checks():
    """One of each value check, and a failing case each."""
    return [
        X.Expectation.of(X.EXISTS, "o_orderdate"),
        X.Expectation.of(X.BETWEEN, "o_totalprice", min_value=1000, max_value=400000),
        X.Expectation.of(X.REGEX, "o_orderpriority", regex="^[1-3]-"),
        X.Expectation.of(X.IN_SET, "o_orderstatus", value_set=["F", "O"]),
        X.Expectation.of(X.NOT_NULL, "o_custkey"),
        X.Expectation.of(X.MEAN_BETWEEN, "o_totalprice", min_value=200000, max_value=300000),
        X.Expectation.of(X.UNIQUE, "o_custkey"),
        X.Expectation.of(X.DISTINCT_BETWEEN, "o_orderstatus", min_value=1, max_value=3),
    ]


# The suite used by validate_suite: the starter checks as a starter suite adds them (the exact column set and
# the types, then the column set as it is by default and the types again), then the value checks.
def orders_suite():
    types = [X.Expectation.of(X.OF_TYPE, c, type_=t) for c, t in ORDERS_TYPES.items()]
    return [X.Expectation.of(X.ROW_COUNT, min_value=1), X.Expectation.of(X.COLUMN_COUNT, min_value=1, max_value=None),
            X.Expectation.of(X.COLUMNS_MATCH, column_set=ORDERS_COLS, exact_match=True), *types,
            X.Expectation.of(X.COLUMNS_MATCH, column_set=ORDERS_COLS), *types, *_value_checks()]


def written_suite():
    """The suite used by write_validated: each starter check once, then the value checks."""
    return X.default_suite(ORDERS_COLS, ORDERS_TYPES) + _value_checks()


SINGLE = {
    "expect_row_count_between": X.Expectation.of(X.ROW_COUNT, min_value=1),
    "expect_column_count_between": X.Expectation.of(X.COLUMN_COUNT, min_value=1, max_value=None),
    "expect_columns_match_set": X.Expectation.of(X.COLUMNS_MATCH, column_set=ORDERS_COLS, exact_match=True),
    "expect_column_type": X.Expectation.of(X.OF_TYPE, "o_totalprice", type_="float64"),
    "expect_column_exists": X.Expectation.of(X.EXISTS, "o_orderdate"),
    "expect_between": X.Expectation.of(X.BETWEEN, "o_totalprice", min_value=1000, max_value=400000),
    "expect_regex": X.Expectation.of(X.REGEX, "o_orderpriority", regex="^[1-3]-"),
    "expect_in_set": X.Expectation.of(X.IN_SET, "o_orderstatus", value_set=["F", "O"]),
    "expect_not_null": X.Expectation.of(X.NOT_NULL, "o_custkey"),
    "expect_mean_between": X.Expectation.of(X.MEAN_BETWEEN, "o_totalprice", min_value=200000, max_value=300000),
    "expect_unique": X.Expectation.of(X.UNIQUE, "o_custkey"),
    "expect_distinct_count_between": X.Expectation.of(X.DISTINCT_BETWEEN, "o_orderstatus", min_value=1, max_value=3),
}


def _single(e):
    return lambda spark, sf: X.validate(table(spark, sf, "orders"), [e])


def q_validate_suite(spark, sf):
    return X.validate(table(spark, sf, "orders"), orders_suite())


def q_write_validated(spark, sf):
    """V13 while ``orders`` is written: the same results from one pass over it, and the rows that were written."""
    import uuid

    from ...session import scratch_path
    path = scratch_path(spark, f"validated/{uuid.uuid4().hex}")
    out = X.write_validated(table(spark, sf, "orders"), written_suite(), path)
    return out.withColumn("rows_written", spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).scalar())


def q_validate_suite_totals(spark, sf):
    return X.suite_statistics(q_validate_suite(spark, sf))


QUERIES = {
    "dataset_info": q_dataset_info,
    "class_distribution": q_class_distribution,
    "table_bytes": q_table_bytes,
    "dataset_summary": q_dataset_summary,
    "validate_suite": q_validate_suite,
    "validate_suite_totals": q_validate_suite_totals,
    "write_validated": q_write_validated,
}
QUERIES.update({k: _single(e) for k, e in SINGLE.items()})

# ---------------------------------------------------------------- oracle SQL
_PD = ("case t when 'BIGINT' then 'int64' when 'INTEGER' then 'int32' when 'DOUBLE' then 'float64' "
       "when 'FLOAT' then 'float32' when 'BOOLEAN' then 'bool' when 'TIMESTAMP' then 'datetime64[ns]' "
       "else 'object' end")
_COLS = "(select * from information_schema.columns where table_name = 'orders')"


def _row(i, e, success, obs="null", text="null", elem="null", miss="null", unexp="null", pct="null", src=""):
    col = "null" if e.column is None else f"'{e.column}'"
    kw = e.kwargs_json().replace("'", "''")
    return (f"select cast({i} as integer) as expectation_id, '{e.expectation}' as expectation, "
            f"cast({col} as varchar) as \"column\", '{kw}' as kwargs, cast({success} as boolean) as success, "
            f"cast({obs} as double) as observed_value, cast({text} as varchar) as observed_text, "
            f"cast({elem} as bigint) as element_count, cast({miss} as bigint) as missing_count, "
            f"cast({unexp} as bigint) as unexpected_count, cast({pct} as double) as unexpected_percent {src}")


def _between(v, lo, hi):
    parts = []
    if lo is not None:
        parts.append(f"{v} >= {lo}")
    if hi is not None:
        parts.append(f"{v} <= {hi}")
    return " and ".join(parts) or "true"


def expectation_sql(i, e):
    kw, c = e.kw, e.column
    if e.expectation == X.ROW_COUNT:
        return _row(i, e, _between("count(*)", kw.get("min_value"), kw.get("max_value")),
                    obs="count(*)", src="from orders")
    if e.expectation == X.COLUMN_COUNT:
        return _row(i, e, _between("count(*)", kw.get("min_value"), kw.get("max_value")),
                    obs="count(*)", src=f"from {_COLS}")
    if e.expectation == X.COLUMNS_MATCH:
        want = ", ".join(f"'{x}'" for x in kw["column_set"])
        missing = f"(select count(*) from unnest([{want}]) u(x) where x not in (select column_name from {_COLS}))"
        extra = f"(select count(*) from {_COLS} where column_name not in ({want}))"
        ok = f"{missing} = 0" + (f" and {extra} = 0" if kw.get("exact_match", True) in (True, None) else "")
        text = f"(select '[' || string_agg('\"' || column_name || '\"', ', ' order by ordinal_position) || ']' from {_COLS})"
        return _row(i, e, ok, text=text)
    if e.expectation == X.EXISTS:
        return _row(i, e, f"exists (select 1 from {_COLS} where column_name = '{c}')")
    if e.expectation == X.OF_TYPE:
        pd = f"(select {_PD} from (select data_type t from {_COLS} where column_name = '{c}'))"
        return _row(i, e, f"{pd} = '{kw['type_']}'", text=pd)
    miss = f"count(*) filter (where {c} is null)"
    if e.expectation == X.MEAN_BETWEEN:
        return _row(i, e, f"coalesce({_between(f'avg({c})', kw.get('min_value'), kw.get('max_value'))}, false)",
                    obs=f"avg({c})", elem="count(*)", miss=miss, src="from orders")
    if e.expectation == X.DISTINCT_BETWEEN:
        return _row(i, e, _between(f"count(distinct {c})", kw.get("min_value"), kw.get("max_value")),
                    obs=f"count(distinct {c})", elem="count(*)", miss=miss, src="from orders")
    if e.expectation == X.NOT_NULL:
        return _row(i, e, f"{miss} = 0", elem="count(*)", miss=miss, unexp=miss,
                    pct=f"{miss} * 100.0 / count(*)", src="from orders")
    if e.expectation == X.UNIQUE:
        u = (f"(select coalesce(sum(n), 0) from (select {c}, count(*) n from orders where {c} is not null "
             f"group by {c} having count(*) > 1))")
        return _row(i, e, f"{u} = 0", elem="count(*)", miss=miss, unexp=u,
                    pct=f"{u} * 100.0 / count({c})", src="from orders")
    if e.expectation == X.BETWEEN:
        bad = f"not ({_between(c, kw.get('min_value'), kw.get('max_value'))})"
    elif e.expectation == X.REGEX:
        bad = f"not regexp_matches({c}, '{kw['regex']}')"
    elif e.expectation == X.IN_SET:
        bad = f"{c} not in ({', '.join(repr(v) for v in kw['value_set'])})"
    else:
        raise ValueError(e.expectation)
    u = f"count(*) filter (where {c} is not null and {bad})"
    return _row(i, e, f"{u} = 0", elem="count(*)", miss=miss, unexp=u,
                pct=f"{u} * 100.0 / count({c})", src="from orders")


def _suite_sql(suite):
    return "\nunion all\n".join(expectation_sql(i + 1, e) for i, e in enumerate(X.dedupe(suite)))


SQL = {
    "dataset_info": """
select 'tabular' as loader_type, 'parquet' as file_format, 'orders.parquet' as path,
  count(*) as rows, cast(6 as bigint) as columns,
  (sum(8 + 8 + octet_length(encode(o_orderstatus)) + 8 + 8 + octet_length(encode(o_orderpriority)))) / (1024.0*1024.0) as memory_mb,
  'supervised' as task_type, 0.2e0 as test_size, 0.0e0 as validation_size, cast(42 as bigint) as random_state,
  'o_orderstatus' as target, 'classification' as target_type, count(distinct o_orderstatus) as num_classes
from orders""",
    "class_distribution": """
select p_brand as label, count(*) as n_rows, count(*) * 100.0 / sum(count(*)) over () as pct,
  cast(row_number() over (order by count(*) desc, p_brand) as integer) as rank
from part group by p_brand""",
    "table_bytes": """
select 'doc_id' as column_name, cast(8 * count(doc_id) as bigint) as n_bytes from documents
union all select 'text', cast(coalesce(sum(octet_length(encode(text))), 0) as bigint) from documents
union all select 'lang', cast(coalesce(sum(octet_length(encode(lang))), 0) as bigint) from documents
union all select 'source', cast(coalesce(sum(octet_length(encode(source))), 0) as bigint) from documents
union all select 'n_chars', cast(8 * count(n_chars) as bigint) from documents""",
    "dataset_summary": """
with i as (select count(*) n, sum(8 + 8 + octet_length(encode(o_orderstatus)) + 8 + 8
             + octet_length(encode(o_orderpriority))) / (1024.0*1024.0) mb,
             count(distinct o_orderstatus) k from orders),
l as (select unnest([repeat('=', 60), 'TABULAR DATASET SUMMARY', repeat('=', 60), 'File: orders.parquet',
      'Format: PARQUET', printf('Size: %.2f MB', mb), 'Rows: ' || format('{:,}', n), 'Columns: 6', '',
      'Task: SUPERVISED', 'Target: o_orderstatus', 'Type: classification', 'Classes: ' || k, repeat('=', 60)]) line,
      unnest(range(1, 15)) line_no from i)
select cast(line_no as bigint) as line_no, line from l""",
    "validate_suite": _suite_sql(orders_suite()),
    "write_validated": f"select *, (select count(*) from orders) as rows_written from ({_suite_sql(written_suite())})",
    "validate_suite_totals": f"""
with r as ({_suite_sql(orders_suite())})
select count(*) as evaluated_expectations, cast(sum(case when success then 1 else 0 end) as bigint) as successful_expectations,
  cast(sum(case when success then 0 else 1 end) as bigint) as unsuccessful_expectations,
  sum(case when success then 1 else 0 end) * 100.0 / count(*) as success_percent, bool_and(success) as success from r""",
}
SQL.update({k: expectation_sql(1, e) for k, e in SINGLE.items()})
