"""Queries T1-T6: splits and folds over the driver tables."""

from __future__ import annotations

from ...operators import splits as S
from ..tables import table


def q_split_random(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return S.split_random(o, keys=["o_orderkey"], test_size=0.2, seed=42)


def q_split_stratified(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.split_stratified(o, "o_orderstatus", keys=["o_orderkey"], test_size=0.2, seed=42)


def q_split_three_way(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.split_three_way(o, keys=["o_orderkey"], label="o_orderstatus",
                             test_size=0.2, validation_size=0.1, seed=42)


def q_split_three_way_regression(spark, sf):
    """A continuous target (regression): no strata in either stage."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return S.split_three_way(p, keys=["p_partkey"], label="p_retailprice",
                             test_size=0.2, validation_size=0.1, seed=42)


def q_split_bernoulli(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    return S.split_bernoulli(e, keys=["event_id"], test_size=0.2, validation_size=0.1, seed=42)


def q_stratified_kfold(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.stratified_kfold(o, "o_orderstatus", keys=["o_orderkey"], k=3, seed=42)


def q_task_type(spark, sf):
    return S.task_types(table(spark, sf, "lineitem"))


QUERIES = {
    "split_random": q_split_random,
    "split_stratified": q_split_stratified,
    "split_three_way": q_split_three_way,
    "split_three_way_regression": q_split_three_way_regression,
    "split_bernoulli": q_split_bernoulli,
    "stratified_kfold": q_stratified_kfold,
    "task_type": q_task_type,
}

def _quota(ts: str, src: str, y: str, sfx: str = "") -> str:
    """CTEs n, cl, q, z, w (+ suffix) giving the train quota ``tr`` per class
    ``y`` of ``src`` for a test share ``ts`` (largest remainder, ties by y)."""
    return f"""
n{sfx}  as (select count(*) n, cast(ceil({ts}*count(*)) as bigint) nt from {src}),
cl{sfx} as (select {y} y, count(*) c from {src} group by {y}),
q{sfx}  as (select y, (c*(n-nt) - (c*(n-nt)) % n) / n f, (c*(n-nt)) % n r, n, nt from cl{sfx}, n{sfx}),
z{sfx}  as (select y, f, n - nt - sum(f) over () k, row_number() over (order by r desc, y) rk from q{sfx}),
w{sfx}  as (select y, cast(f + case when rk <= k then 1 else 0 end as bigint) tr from z{sfx})"""


_LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                   ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                   ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                   ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


def _task_type_sql():
    parts = []
    for c, t in _LINEITEM_TYPES:
        if t == "string":
            parts.append(f"select '{c}' as column_name, '{t}' as data_type, 'classification' as task_type")
            continue
        else:
            v = f"case when isnan({c}) then null else {c} end" if t == "double" else c
            expr = f"case when count(distinct {v}) < 20 then 'classification' else 'regression' end"
        parts.append(f"select '{c}' as column_name, '{t}' as data_type, {expr} as task_type from lineitem")
    return "\nunion all\n".join(parts)


SQL = {
    "split_random": """
with n as (select count(*) - cast(ceil(0.2e0*count(*)) as bigint) ntr from orders),
o as (select o_orderkey, row_number() over (order by md5('42|' || o_orderkey), o_orderkey) rn from orders)
select o_orderkey, case when rn <= ntr then 'train' else 'test' end as split from o, n""",
    "split_stratified": "with" + _quota("0.2e0", "orders", "o_orderstatus") + """,
o as (select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus
      order by md5('42|' || o_orderkey), o_orderkey) rn from orders)
select o_orderkey, o_orderstatus, case when rn <= tr then 'train' else 'test' end as split
from o join w on o.o_orderstatus = w.y""",
    "split_three_way": "with" + _quota("0.2e0", "orders", "o_orderstatus") + """,
o as (select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus
      order by md5('42|' || o_orderkey), o_orderkey) rn from orders),
s1 as (select o_orderkey, o_orderstatus, case when rn <= tr then 'train' else 'test' end as split
       from o join w on o.o_orderstatus = w.y),
tr1 as (select o_orderkey, o_orderstatus from s1 where split = 'train'),""" + _quota(
        "(0.1e0/(1-0.2e0))", "tr1", "o_orderstatus", "2") + """,
o2 as (select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus
      order by md5('42|validation|' || o_orderkey), o_orderkey) rn from tr1)
select o_orderkey, o_orderstatus, split from s1 where split = 'test'
union all
select o_orderkey, o_orderstatus, case when rn <= tr then 'train' else 'validation' end
from o2 join w2 on o2.o_orderstatus = w2.y""",
    "split_three_way_regression": """
with n as (select count(*) - cast(ceil(0.2e0*count(*)) as bigint) ntr from part),
o as (select p_partkey, p_retailprice, row_number() over (order by md5('42|' || p_partkey), p_partkey) rn from part),
s1 as (select p_partkey, p_retailprice, case when rn <= ntr then 'train' else 'test' end split from o, n),
t1 as (select p_partkey, p_retailprice from s1 where split = 'train'),
n2 as (select count(*) - cast(ceil((0.1e0/(1-0.2e0))*count(*)) as bigint) ntr2 from t1),
o2 as (select p_partkey, p_retailprice, row_number() over (order by md5('42|validation|' || p_partkey), p_partkey) rn2 from t1)
select p_partkey, p_retailprice, split from s1 where split = 'test'
union all
select p_partkey, p_retailprice, case when rn2 <= ntr2 then 'train' else 'validation' end from o2, n2""",
    "split_bernoulli": """
select event_id, case when u < 0.2e0 then 'test' when u < 0.2e0 + 0.1e0 then 'validation' else 'train' end as split
from (select event_id, cast(('0x' || substr(md5('42|' || event_id), 1, 8)) as bigint) / 4294967296.0e0 u from events)""",
    "stratified_kfold": """
select o_orderkey, o_orderstatus, cast((row_number() over (partition by o_orderstatus
       order by md5('42|' || o_orderkey), o_orderkey) - 1) % 3 as integer) as fold from orders""",
    "task_type": _task_type_sql(),
}
