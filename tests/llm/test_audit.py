"""Filter audit: the stream's counters and the report against brute force."""
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from loomkit.llm import audit
from loomkit.llm.common import read
from loomkit.llm.queries import QUERIES
from tests.llm import helpers as H


def failures(rows):
    """Per row (id, text, part): the filters it fails."""
    least = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            least[t or ""].append(i)
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and i > min(least[t])), strict=True) if bad))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    bad, out = failures(rows), {}
    part = [p or "" for *_, p in rows]
    for order in map("".join, permutations("ABCDE")):
        for s, f in enumerate(order):
            c = defaultdict(Counter)
            for (i, *_), p, b in zip(rows, part, bad, strict=True):
                early = any(x in b for x in order[:s])
                c[p]["kept"] += not early and f not in b
                here = not early and f in b
                c[p]["removed"] += here
                c[p]["redundant"] += early and f in b
                c[p]["unique"] += b == f
                c[p]["good"] += here and i in good
                c[p]["toxic"] += here and i in toxic
            for p, x in c.items():
                out[p, order, s + 1] = [x["kept"], x["removed"], x["redundant"], x["unique"], x["good"], x["toxic"]]
    total = Counter()
    for (p, order, s), v in out.items():
        total[p, order[s - 1]] += v[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


ROWS = [(9, "x y", "en"), (3, "x y", "fr"), (7, "x y", "en"), (1, "x y", None), (1, "x y", "en"), (2, None, "en"), (5, "", "en"), (None, "x y", "en"),
        (None, None, "en"), (4, "AB " + " ".join(f"w{i}" for i in range(300)), "en"), (6, "w # " * 300, "fr"), (8, "w # " * 300, "fr"), (6, "w # " * 300, "fr"),
        (10, " ".join(f"w{i}" for i in range(300)), "de"), (11, "\t\n ", "en"), (12, "x y ", "en")]
LABELS = [(9, 1, 0), (9, 0, None), (3, 0, 1), (1, 1, 1), (6, 1, None), (None, 1, 1), (8, None, 1), (10, 1, 0)]


def files(spark, path, rows):
    """One Parquet file a row, in this order."""
    for r in rows:
        spark.createDataFrame([(*r, "clash", 1)], "doc_id long, text string, lang string, `key` string, mask int").coalesce(1).write.mode("append").parquet(str(path))


def label_table(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in read(spark, H.SF, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in read(spark, H.SF, "labels").collect()]
    assert got(QUERIES["op13_retraction_audit"](spark, H.SF)) == brute(rows, labels)


@pytest.mark.parametrize("batches", [8])
def test_smaller_ids_retract_earlier_masks_and_a_stream_goes_on(spark, tmp_path, batches):
    files(spark, tmp_path / "docs", ROWS[:10])
    kept = audit.run_stream(spark, str(tmp_path / "docs"), label_table(spark), str(tmp_path / "run"), micro_batches=batches)
    assert got(audit.report(kept.counters())) == brute(ROWS[:10], LABELS)
    files(spark, tmp_path / "docs", ROWS[10:])
    kept = audit.run_stream(spark, str(tmp_path / "docs"), label_table(spark), str(tmp_path / "run"), micro_batches=batches)
    assert got(audit.report(kept.counters())) == brute(ROWS, LABELS)
    assert spark.read.parquet(str(tmp_path / "run" / "counters")).where("n < 0").count() > 0  # something was retracted


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    kept = audit.Retraction(spark, str(tmp_path), label_table(spark))
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    for n, part in enumerate((df.where("doc_id > 4"), df.where("not doc_id > 4 or doc_id is null"))):
        for _ in range(2):
            kept.step(audit.reduced(part, "doc_id", "text", "lang"), n)
    assert got(audit.report(kept.counters())) == brute(ROWS, LABELS)


def test_odd_and_empty_tables(spark, tmp_path):
    H.odd_documents(spark).write.parquet(str(tmp_path / "odd"))
    rows = [(r.doc_id, r.text, r.lang) for r in H.odd_documents(spark).collect()]
    assert got(audit.audit(spark, str(tmp_path / "odd"), label_table(spark))) == brute(rows, LABELS)
    H.empty_documents(spark).write.parquet(str(tmp_path / "none"))
    assert got(audit.audit(spark, str(tmp_path / "none"), label_table(spark))) == {}
    assert {r.n for r in audit.run_stream(spark, str(tmp_path / "odd"), label_table(spark).limit(0), str(tmp_path / "run")).counters().collect()} >= {1}
