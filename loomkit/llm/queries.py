"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, credentials, disclosure, hnsw, langid, neardup, nsbounds, packing, radix, subword, suffixes, urllist, warc
from .common import read


def byte_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(read(spark, sf_dir, "documents"))


def op2_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op3_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(read(spark, sf_dir, "embeddings"))


def op4_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), byte_bpe_path(), with_ids=False)


def op5_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.exact_groups(read(spark, sf_dir, "documents"))


def _number(text: Column) -> Column:
    """A number below 2**32 fixed by a text, the same in Spark and in SQL."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def captures_and_list(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Captures of ``pages`` with a fetch time in 2024, and a dated list over the hosts seen in them.

    The tables have neither times nor lists, so both follow from the md5 of page id and host."""
    pages = read(spark, sf_dir, "pages")
    start = F.lit(1704067200)  # 2024-01-01 UTC
    captures = pages.select("page_id", "url", F.timestamp_seconds(
        start + _number(F.col("page_id").cast("string")) % (366 * 86400)).alias("fetched_at"))
    hosts = pages.select(urllist.host_of(F.col("url")).alias("host")).where(F.isnotnull("host")).distinct()
    n = _number(F.col("host"))
    h = hosts.select("host", (n % 6).alias("k"), (start + n % (200 * 86400)).alias("t"), F.regexp_replace("host", r"^[^.]+\.", "").alias("parent"))
    row = lambda p, action, t: F.struct(p.alias("pattern"), F.lit(action).alias("action"), F.timestamp_seconds(t).alias("listed_at"))
    host, t, day = F.col("host"), F.col("t"), 86400
    entries = F.when(F.col("k") == 0, F.array(row(host, "block", t), row(host, "remove", t + 60 * day), row(host, "block", t + 120 * day))
                     ).when(F.col("k") == 1, F.array(row(F.col("parent"), "block", t))
                            ).when(F.col("k") == 2, F.array(row(host, "block", t), row(F.concat(host, F.lit("/en/")), "allow", t + 10 * day))
                                   ).when(F.col("k") == 3, F.array(row(F.concat(host, F.lit("/fr/")), "block", t)))
    return captures, h.select(F.explode(entries).alias("e")).select("e.*")


def op6_temporal_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_list(spark, sf_dir)
    return urllist.temporal_list_join(captures, entries, "page_id", "url", "fetched_at")


def op7_sparse_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


def op8_hamming_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(read(spark, sf_dir, "documents"))


def op9_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.sample_segmentations(read(spark, sf_dir, "conversations"), piece_bpe_path(), ["conv_id", "turn"])


def op10_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op11_disclosure_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.scan(read(spark, sf_dir, "documents"))


def op12_ns_bounds_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nsbounds.cluster(read(spark, sf_dir, "embeddings"))


def op13_retraction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spark, os.path.join(sf_dir, "documents.parquet"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_byte_cnn_language, op3_hnsw_search, op4_concat_and_cut, op5_radix_dedup, op6_temporal_url_list,
    op7_sparse_suffix_array, op8_hamming_near_dup, op9_sampled_segmentations, op10_warc_reassembly,
    op11_disclosure_spans, op12_ns_bounds_clusters, op13_retraction_audit)}

def _lloyd_sql(rounds: int = 3) -> str:
    """Plain rounds: every distance of every round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} as (select rn, v, min(row(d, c)) as b from (select rn, v, c, list_sum(list_transform(list_zip(v, cv), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
                       from e cross join c{r}) group by rn, v)""")
        if r < rounds:
            steps.append(f"""s{r} as (select b[2] as c, i, sum(v[i])::bigint as s, count(*) as n from a{r} cross join range(1, 65) as t(i) group by all),
                  m{r} as (select c, list((s - ((s % n) + n) % n) // n order by i) as v from s{r} group by c),
                  c{r + 1} as (select c{r}.c, coalesce(m{r}.v, c{r}.cv) as cv from c{r} left join m{r} on c{r}.c = m{r}.c)""")
    body = ",\n".join(steps)
    return f"""
        with e as (select row_number() over () as rn, * from (
                     select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
                     where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)),
        c0 as (select row_number() over (order by h, v) - 1 as c, v as cv from
                 (select v, sha256('1:' || coalesce(vec_id::varchar, 'null')) as h from e order by h, v limit 16)),
        {body}
        select vec_id, b[2]::int as cluster, b[1]::bigint as distance, sum(b[1]) over (partition by b[2])::bigint as cluster_inertia,
               sum(b[1]) over ()::bigint as inertia, sha256(array_to_string(cv, ',')) as centroid_sha256
        from a{rounds} join e using (rn) join c{rounds} on c = b[2]"""


#: The base patterns as the contract gives them.
PII_PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def _disclosure_sql() -> str:
    c, space = disclosure.CONTEXT + 1, r"[\x20\x09-\x0D]"
    kinds = "\nunion all ".join(f"select t, n, {i} as kind, string_split_regex(t, '{p}') as g, regexp_extract_all(t, '{p}') as m from d"
                                for i, p in enumerate(PII_PATTERNS))
    names = ", ".join(f"'{k}'" for k in disclosure.KINDS)
    return rf"""
        with d as (select coalesce(text, '') as t, count(*) as n from documents group by 1),
        k as ({kinds}),
        x as (select t, n, kind, i, len(m) as last, g[i] as gap, m[i] as value, g[i + 1] as next from
                (select *, unnest(range(1, len(m) + 1)) as i from k where len(m) > 0)),
        y as (select *, sum(length(gap) + length(value)) over (partition by t, kind order by i) as stop,
                     regexp_replace(value, '[^0-9]', '', 'g') as digits from x),
        f as (select t, n, kind, (stop - length(value))::bigint as start, stop::bigint as stop,
                     kind || ':' || case kind when 0 then lower(value) when 1 then value else digits end as entity,
                     right(case when i = 1 then ' ' || gap else gap end, {c}) as b, left(case when i = last then next || ' ' else next end, {c}) as a
              from y where case kind when 0 then true
                when 1 then len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 or
                            (case when length(ltrim(p, '0')) between 1 and 3 then ltrim(p, '0')::int else 0 end) > 255)) = 0
                when 2 then length(digits) between 13 and 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda j:
                            case when j % 2 = 1 then reverse(digits)[j]::int when reverse(digits)[j]::int > 4 then reverse(digits)[j]::int * 2 - 9
                                 else reverse(digits)[j]::int * 2 end)) % 10 = 0
                else length(digits) between 9 and 15 end),
        s as (select t, n, entity, string_split_regex(b, '{space}') as p, start - length(b) as p0 from f
              union all select t, n, entity, string_split_regex(a, '{space}'), stop from f),
        w as (select t, n, entity, p[j] as w, p0 + list_sum(list_transform(p[1:j - 1], lambda z: length(z) + 1))::bigint as p1
              from (select *, unnest(range(2, len(p))) as j from s where len(p) > 2)),
        v as (select t, n, entity, p1 + length(w) - length(regexp_replace(w, '^\P{{L}}+', '')) as start,
                     regexp_replace(regexp_replace(w, '^\P{{L}}+', ''), '\P{{L}}+$', '') as w from w),
        term as (select t, n, entity, lower(w) as term, start, start + length(w) as stop from v where regexp_full_match(w, '\p{{L}}{{3,}}')),
        both_ as (select entity, term, sum(n) as n from (select distinct t, n, entity, term from term) group by all having sum(n) >= {disclosure.SUPPORT}),
        ent as (select entity, sum(n) as n from (select distinct t, n, entity from f) group by all),
        having_ as (select term, sum(n) as n from (select distinct t, n, lower(unnest(string_split_regex(t, '\P{{L}}+'))) as term from d)
                    where term in (select term from both_) group by all),
        total as (select count(*) as n from documents),
        told as (select b.entity, b.term, log2(least(b.n / h.n, 1) / (e.n / total.n)) / -log2(e.n / total.n) as d
                 from both_ b join ent e using (entity) join having_ h using (term), total where e.n < total.n),
        spans as (select t, kind, start, stop from f
                  union all select t, case when max(d) >= {disclosure.REMOVE} then 5 else 4 end, start, stop
                  from term join told using (entity, term) where d >= {disclosure.GENERALISE} group by t, start, stop),
        named as (select *, [{names}][kind + 1] || ':' || start || ':' || stop as span from spans),
        r as (select t, count(*) filter (kind = 0) as n_email, count(*) filter (kind = 1) as n_ip, count(*) filter (kind = 2) as n_card,
                     count(*) filter (kind = 3) as n_phone, string_agg(span, ',' order by kind, start) filter (kind < 4) as base,
                     string_agg(span, ',' order by kind, start) as spans from named group by t)
        select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
               sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from documents left join r on coalesce(text, '') = t"""


SQL = {
    "op11_disclosure_spans": _disclosure_sql(),
    "op12_ns_bounds_clusters": _lloyd_sql(),
    "op13_retraction_audit": r"""
        with w as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        l as (select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic
              from labels where doc_id is not null group by doc_id),
        m as (select part, (len(ws) < 200)::int + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::int
                     + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
                     + 16 * coalesce(w.doc_id > min(w.doc_id) over (partition by t), false)::int as mask, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
              from w left join l on w.doc_id = l.doc_id),
        c as (select part, mask, count(*) as n, sum(good) as g, sum(toxic) as t from m group by part, mask),
        f(l, b) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        o as (select f1.l || f2.l || f3.l || f4.l || f5.l as filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] as bits
              from f f1, f f2, f f3, f f4, f f5 where f1.b + f2.b + f3.b + f4.b + f5.b = 31 and (f1.b | f2.b | f3.b | f4.b | f5.b) = 31),
        s as (select filter_order, i::int as step, bits[i]::int as bit, coalesce(list_sum(bits[1:i - 1]), 0)::int as before from o, range(1, 6) as r(i))
        select part, filter_order, step, sum(case when mask & (before | bit) = 0 then n else 0 end)::bigint as kept,
               sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end)::bigint as removed,
               sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end)::bigint as redundant,
               sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
               sum(case when mask & before = 0 and mask & bit <> 0 then g else 0 end)::bigint as good_lost,
               sum(case when mask & before = 0 and mask & bit <> 0 then t else 0 end)::bigint as toxic_lost,
               sum(case when mask & bit <> 0 then n * (120 // greatest(bit_count(mask), 1)) else 0 end)::bigint as shapley
        from s, c group by part, filter_order, step""",
    "op5_radix_dedup": r"""
        with n as (select doc_id, length(coalesce(text, '')) as n_cp,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
        g as (select *, count(*) over (partition by norm) as group_size,
                     first_value(doc_id) over (partition by norm order by n_cp desc, doc_id) as keep_id from n)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from g""",
    "op6_temporal_url_list": r"""
        with p as (select page_id, url, ('0x' || substr(md5(page_id::varchar), 1, 8))::bigint as n,
                          nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') as host,
                          regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+/)', 1) as seg from pages),
        c as (select *, make_timestamp((1704067200 + n % (366 * 86400)) * 1000000) as fetched from p),
        h as (select host, ('0x' || substr(md5(host), 1, 8))::bigint as n, regexp_replace(host, '^[^.]+\.', '') as parent
              from (select distinct host from c where host is not null)),
        d as (select host, parent, n % 6 as k, 1704067200 + n % (200 * 86400) as t from h),
        e as (select host as pattern, 'block' as action, t from d where k in (0, 2)
              union all select host, 'remove', t + 60 * 86400 from d where k = 0
              union all select host, 'block', t + 120 * 86400 from d where k = 0
              union all select parent, 'block', t from d where k = 1
              union all select host || '/en/', 'allow', t + 10 * 86400 from d where k = 2
              union all select host || '/fr/', 'block', t from d where k = 3),
        o as (select pattern, make_timestamp(t * 1000000) as valid_from,
                     arg_max(action, case action when 'allow' then 0 when 'block' then 1 else 2 end) as action from e group by all),
        i as (select *, lead(valid_from) over (partition by pattern order by valid_from) as valid_to from o),
        q as (select distinct page_id, url, fetched, unnest(list_concat(
                     list_transform(range(1, greatest(len(string_split(host, '.')), 2)), lambda x: array_to_string(array_slice(string_split(host, '.'), x, len(string_split(host, '.'))), '.')),
                     case when seg <> '' then list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
                          lambda x: array_to_string(array_slice(string_split(host, '.'), x, len(string_split(host, '.'))), '.') || seg) else [] end)) as pattern
              from c where host is not null),
        m as (select q.page_id, q.url, q.fetched, i.* from q join i using (pattern)
              where action <> 'remove' and valid_from <= fetched and (valid_to is null or fetched < valid_to)),
        w as (select page_id, url, fetched, count(*) as n_active,
                     max({'n': length(pattern), 'pattern': pattern, 'action': action, 'valid_from': valid_from}) as b from m group by all)
        select c.page_id, c.url, c.fetched as fetched_at, coalesce(w.n_active, 0) as n_active, w.b.pattern as pattern, w.b.action as action,
               w.b.valid_from as active_since, coalesce(w.b.action = 'block', false) as blocked
        from c left join w on c.page_id is not distinct from w.page_id and c.url is not distinct from w.url and c.fetched is not distinct from w.fetched""",
}
