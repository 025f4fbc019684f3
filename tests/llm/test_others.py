"""Search, URL lists, segmentations, archives and the pipeline."""
import base64
import gzip
import hashlib
import io
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomkit.llm import credentials, hnsw, langid, subword, urllist, warc
from loomkit.llm.common import read
from loomkit.llm.queries import QUERIES, SQL, byte_bpe_path, piece_bpe_path
from tests.llm import helpers as H
from tests.oracle_harness import compare, duck


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    r = compare(spark, duck(H.SF), name, QUERIES[name], SQL[name], H.SF)
    assert r["ok"], r


# ------------------------------------------------------------------ nearest neighbours
def nearest(rows, k=20):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    out = {}
    for q in ids[ids % 20 == 0]:
        s = v @ v[ids == q][0]
        o = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in o]
    return out


@pytest.mark.parametrize("shard_rows", [16384, 128])
def test_search_recall_and_scores(spark, shard_rows):
    sf = "/root/testdata/sf0.1"
    e = read(spark, sf, "embeddings")
    want = nearest([(r.vec_id, r.embedding) for r in e.collect()])
    got = {}
    for r in hnsw.nearest(e, shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) > 0.95
    for q, found in got.items():
        true = dict(want[q])
        assert len(found) == 20 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - true[i]) < 1e-12 for i, s in found if i in true)


def _shard(kind, n, rng, dims=64):
    x = rng.normal(size=(n, dims))
    if kind == "norms":
        return x * rng.lognormal(0, 0.5, (n, 1))
    copies = {"one half a group": n // 2, "two groups": 2048}.get(kind, n if isinstance(kind, int) else 0)
    size = {"one half a group": n // 2, "two groups": 1024}.get(kind, kind)
    if copies:
        x[:copies] = rng.normal(size=(n, dims))[np.arange(copies) // size] + x[:copies] * 0.01
    return (x / np.linalg.norm(x, axis=1, keepdims=True))[rng.permutation(n)]


@pytest.mark.parametrize("kind", ["noise", 60, 256, 1024, "two groups", "one half a group", "norms"])
def test_recall_in_a_full_shard_of_near_copies(kind):
    """Groups of near copies larger than a node's links, alone and beside noise, and norms that differ."""
    x = _shard(kind, hnsw.SHARD_ROWS, np.random.default_rng(3))
    asked = np.arange(0, len(x), 20)
    found, recall = hnsw.search_graph(x, hnsw.build_graph(x), x[asked]), []
    for i, at in zip(asked, found, strict=True):
        s = x @ x[i]
        s[i] = -np.inf
        at = at[(at >= 0) & (at != i)]
        assert len(set(at.tolist())) == len(at)
        recall.append((s[at[:20]] >= np.sort(s)[-20] - 1e-12).mean())
    assert np.mean(recall) > 0.98 and min(recall) >= 0.8


def test_search_of_clashing_and_null_tables(spark):
    rows = [(i, [float(i), 1.0], 1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id long, `rank` long")
    assert hnsw.nearest(df).columns == ["query_id", "rank", "vec_id", "score"] and hnsw.nearest(df).count() == 40
    nulls = spark.createDataFrame([(None, None)] * 3, "vec_id long, embedding array<double>")
    assert hnsw.nearest(nulls).count() == 0


def test_search_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 90)]
    rows += [(i, [3.0] * 8) for i in range(100, 160)]                        # one vector many times
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] + [1.0] * 7), (280, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = nearest([(i, v) for i, v in rows[:149]])
    assert set(got) == set(want) == {20, 40, 60, 80, 100, 120, 140}
    assert all(got[q] == [i for i, _ in want[q]] for q in (100, 120, 140))   # ties go to the smaller id
    assert np.mean([len(set(got[q]) & {i for i, _ in want[q]}) / 20 for q in got]) > 0.95
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in hnsw.nearest(few).collect()] == [(0, 1, 1, 0.5)]
    assert hnsw.nearest(df.limit(0)).count() == 0


# ------------------------------------------------------------------ URL lists
def test_temporal_list(spark):
    e = spark.createDataFrame([("bad.example.com", "block", "2024-01-10"), ("bad.example.com", "remove", "2024-03-01"), ("bad.example.com", "block", "2024-05-01"),
                               ("example.org", "block", "2024-02-01"), ("ok.example.org", "allow", "2024-02-15"), ("example.net/x/", "block", "2023-01-01"),
                               ("bad.example.com", "block", None), (None, "block", "2024-01-01"), ("tie.com", "block", "2024-01-01"), ("tie.com", "allow", "2024-01-01")],
                              "pattern string, action string, listed_at string").withColumn("listed_at", F.to_timestamp("listed_at"))
    c = spark.createDataFrame([(1, "http://bad.example.com/a", "2024-01-09"), (2, "http://BAD.example.com/a", "2024-01-10"), (3, "http://bad.example.com", "2024-02-29"),
                               (4, "http://bad.example.com", "2024-03-01"), (5, "http://bad.example.com:80/", "2024-07-01"), (6, "https://a.b.example.org/q", "2024-02-10"),
                               (7, "https://ok.example.org/q", "2024-02-10"), (8, "https://ok.example.org/q", "2024-02-20"), (9, "http://u:p@example.net/x/y", "2024-01-01"),
                               (10, "http://example.net/y/x", "2024-01-01"), (11, None, "2024-01-01"), (12, "nonsense", "2024-01-01"), (13, "http://bad.example.com", None),
                               (14, "http://tie.com", "2024-01-02"), (2, "http://BAD.example.com/a", "2024-01-10"), (None, "http://tie.com", "2024-01-02")],
                              "id long, link string, at string").withColumn("at", F.to_timestamp("at")).withColumn("copies", F.lit(1))
    rows = urllist.temporal_list_join(c, e, "id", "link", "at").collect()
    assert len(rows) == 16
    assert sorted(r.id or 0 for r in rows if r.blocked) == [0, 2, 2, 3, 5, 6, 7, 9, 14]
    assert {r.id: (r.n_active, r.pattern, r.action) for r in rows if r.id in (8, 14)} == {8: (2, "ok.example.org", "allow"), 14: (1, "tie.com", "block")}
    assert urllist.temporal_list_join(c.limit(0), e, "id", "link", "at").count() == 0
    assert urllist.temporal_list_join(c, e.limit(0), "id", "link", "at").where("blocked").count() == 0


def test_list_paths_keep_case_and_depth(spark):
    e = spark.createDataFrame([("Example.com/Shop/", "block"), ("example.com/Shop/a/B/", "allow"), ("deep.org/x/y/", "block")],
                              "pattern string, action string").withColumn("listed_at", F.to_timestamp(F.lit("2024-01-01")))
    urls = ["http://example.com/Shop/x", "http://www.EXAMPLE.com/Shop/", "http://example.com/shop/x", "http://example.com/Shop", "http://example.com/Shop/a/B/c",
            "http://example.com/Shop/a/b/c", "http://deep.org/x/y/z/w?q=/", "http://deep.org/x/yy/", "http://deep.org/x?/y/", "http://deep.org//x/y/"]
    c = spark.createDataFrame(list(enumerate(urls)), "id long, url string").withColumn("at", F.to_timestamp(F.lit("2024-02-01")))
    rows = {r.id: r for r in urllist.temporal_list_join(c, e, "id", "url", "at").collect()}
    assert len(rows) == len(urls) and [i for i in sorted(rows) if rows[i].blocked] == [0, 1, 5, 6]
    assert (rows[4].n_active, rows[4].pattern, rows[4].action) == (2, "example.com/Shop/a/B/", "allow")


def test_url_query_stays_native(spark):
    plan = QUERIES["op6_temporal_url_list"](spark, H.SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# ------------------------------------------------------------------ segmentations
def paths(steps):
    out = [((), 0.0)]
    for places in steps:
        live, done = [(p, lp, 0) for p, lp in out], []
        while live:
            p, lp, at = live.pop()
            if at == len(places):
                done.append((p, lp))
                continue
            ids, nxt, chance = places[at]
            for x, n, c in zip(ids, nxt, chance, strict=True):
                live.append((p + (x if isinstance(x, tuple) else (x,)), lp + math.log(c), n))
        out = done
    return dict(out)


def test_sampling_without_replacement_has_the_right_law():
    lat = subword.lattices(piece_bpe_path())
    every = paths(lat.steps_of("the cat"))
    assert abs(sum(map(math.exp, every.values())) - 1) < 1e-9
    n, first, total = 6000, {}, 0.0
    for seed in range(n):
        got = subword.sample(lat, "the cat", 3, np.random.default_rng(seed))
        ids = [tuple(x[0]) for x in got]
        assert len(set(ids)) == 3 and [x[2] for x in got] == sorted((x[2] for x in got), reverse=True)
        assert all(abs(every[i] - x[1]) < 1e-9 for i, x in zip(ids, got, strict=True))
        first[ids[0]] = first.get(ids[0], 0) + 1
        total += sum(math.exp(x[1]) / x[3] for x in got)                     # an unbiased estimate of 1
    for p, lp in every.items():
        assert abs(first.get(p, 0) / n - math.exp(lp)) < 4 * math.sqrt(math.exp(lp) / n) + 2e-3
    assert abs(total / n - 1) < 0.05


def test_sampling_query(spark):
    rows = QUERIES["op9_sampled_segmentations"](spark, H.SF).join(read(spark, H.SF, "conversations"), ["conv_id", "turn"]).collect()
    sp = subword.lattices(piece_bpe_path()).sp
    assert all(sp.decode(list(r.ids)) == r.text and 0 < r.inclusion <= 1 and r.log_prob <= 1e-9 for r in rows)
    assert max(r.sample_no for r in rows) == 4
    again = QUERIES["op9_sampled_segmentations"](spark, H.SF).select("conv_id", "turn", "sample_no", "ids")
    assert {tuple(map(str, r)) for r in again.collect()} == {(str(r.conv_id), str(r.turn), str(r.sample_no), str(r.ids)) for r in rows}


def test_sampling_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "", 0), (2, None, 0), (3, "x" * 3000, 0), (4, "é\n\t 漢字  ", 0), (4, "é\n\t 漢字  ", 0), (None, "a", 0)], "id long, text string, key int")
    rows = subword.sample_segmentations(docs, piece_bpe_path(), ["id"]).collect()
    sp = subword.lattices(piece_bpe_path()).sp
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r)
    assert 2 not in by and [list(r.ids) for r in by[1]] == [[]] and len(by[3]) == 4 and len(by[4]) == 8
    assert all(sp.decode(list(r.ids)) == "é\n\t 漢字  " for r in by[4])
    assert sorted(r.sample_no for r in by[None])[0] == 1
    back = subword.decode_ids(subword.sample_segmentations(docs, piece_bpe_path(), ["id"]), piece_bpe_path()).where("id = 4").select("text").distinct()
    assert [r.text for r in back.collect()] == ["é\n\t 漢字  "]
    assert subword.sample_segmentations(docs.limit(0), piece_bpe_path(), ["id"]).count() == 0


# ------------------------------------------------------------------ archives
def records(rows):
    groups, out = {}, []
    for i, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    for b, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out += [(i, len(b), d, "response" if i == top else "revisit", None if i == top else top) for i in ids]
    return sorted(out, key=str)


def test_archive_query(spark):
    got = [tuple(r)[:5] for r in QUERIES["op10_warc_reassembly"](spark, H.SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == records([(r.page_id, r.html) for r in read(spark, H.SF, "pages").collect()])


def test_archive_of_odd_rows(spark):
    rows = [(1, "http://a/ü?q=\r\nx", "é" * 5000), (2, None, None), (3, "u", ""), (4, "u", "same"), (5, "u", "same"), (6, "u", "same"), (None, "u", "no id"),
            (7, "u", "7\r\n0\r\n\r\nWARC/1.1\r\n"), (8, "u", "x" * 3_000_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    got = [tuple(r) for r in warc.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == records([(i, h) for i, _, h in rows])
    small = {r.page_id: r.record_type for r in warc.round_trip(df, least=10).collect()}
    assert small[4] == small[5] == small[6] == "response"
    assert warc.round_trip(df.limit(0)).count() == 0


def test_broken_segments_and_framing_are_reported():
    seg = lambda n, block, total=None, whole=False: ("o", n, total, "response" if n == 1 else "continuation", 1, "u", "d", None, block, whole)
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    body = head + warc.chunked(b"hello world", 4)
    a, b, c = body[:20], body[20:60], body[60:]
    fine = warc._finished([seg(1, a), seg(2, b), seg(3, c, len(body))])
    assert fine[6] == b"hello world" and fine[9] is None
    for bad in ([seg(1, a), seg(3, c, len(body))], [seg(1, a), seg(2, b), seg(2, b), seg(3, c, len(body))], [seg(1, a), seg(2, b)],
                [seg(1, a), seg(2, b), seg(3, c, len(body) + 1)], [seg(1, head + b"5\r\nab", whole=True)], [seg(1, b"no header", whole=True)]):
        assert warc._finished(bad)[6] is None and warc._finished(bad)[9]
    assert warc.dechunked(b"5;ext=1\r\nhello\r\n0\r\nTrailer: x\r\n\r\n") == b"hello"


def test_foreign_archive_is_read(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"
    raw = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 0\r\n\r\n\r\n\r\n" + (
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:y>\r\nWARC-Target-URI: http://a/\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(body), body))
    buf = io.BytesIO()
    with gzip.GzipFile(fileobj=buf, mode="wb") as z:
        z.write(raw)
    (tmp_path / "a.warc.gz").write_bytes(buf.getvalue())
    manifest = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), 2, 1)], warc.MANIFEST)
    assert [(r.record_id, r.payload) for r in warc.reassemble(warc.read_segments(manifest)).collect()] == [("<urn:y>", b"hi")]


# ------------------------------------------------------------------ pipeline
def test_pipeline_equals_its_stages_by_brute_force(spark):
    from tokenizers import Tokenizer
    docs = read(spark, H.SF, "documents")
    model = langid.train(docs, noise=True)
    size = {i: len((t or "").encode()) for i, t in H.texts(spark)}
    told = {r.doc_id for r in langid.predict(docs, model).collect()
            if r.lang_pred != "und" or r.score > 0 and (r.score < model.limit or size[r.doc_id] < langid.WINDOW)}
    rows = [(i, t) for i, t in H.texts(spark) if i in told]
    exact = H.exact_groups(rows)
    rows = [(i, t) for i, t in rows if exact[i][2]]
    near = H.near_groups(rows)
    rows = [(i, credentials.redact_text(t, "[SECRET]")) for i, t in rows if near[i][2]]
    tok = Tokenizer.from_file(byte_bpe_path())
    want = {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    got = {}
    for r in corpus_pipeline.run(spark, H.SF).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert {i: v[0][2] for i, v in got.items()} == want
    assert all(sum(x[1] for x in v) == v[0][2] for v in got.values())


def test_pipeline_stages_keep_columns_and_take_odd_rows(spark):
    docs = H.odd_documents(spark).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, H.SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), H.SF).count() == 0
        docs = out
    assert corpus_pipeline.pack_sequences(spark, docs, H.SF).count() > 0
