"""Personal data and disclosive terms against brute force over whole texts."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

from loomkit.llm import disclosure
from loomkit.llm.queries import PII_PATTERNS, QUERIES
from tests.llm import helpers as H

SPACE = " \t\n\x0b\x0c\r"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    """[(kind, start, end, entity)] by the patterns as the contract gives them."""
    out = []
    for k, p in enumerate(PII_PATTERNS):
        for m in re.finditer(p, text or ""):
            v, digits = m[0], re.sub("[^0-9]", "", m[0])
            ok = [True, all(int(x) <= 255 for x in v.split(".")) if k == 1 else False, 13 <= len(digits) <= 19 and luhn(digits),
                  9 <= len(digits) <= 15][k]
            if ok:
                out.append((k, m.start(), m.end(), f"{k}:" + [v.lower(), v, digits, digits][k]))
    return out


def words_near(text, k, start, end):
    """Words in white space within CONTEXT + 1 code points of a mention, up to its kind's neighbours; the text's ends count as a space."""
    spans = [m.span() for m in re.finditer(PII_PATTERNS[k], text)]
    i = spans.index((start, end))
    lo, hi = (spans[i - 1][1] if i else -1), (spans[i + 1][0] if i + 1 < len(spans) else len(text) + 1)
    padded = " " + text + " "  # code point p of the text is p + 1 here
    out = []
    for a, b in ((max(lo, start - disclosure.CONTEXT - 1), start), (end, min(hi, end + disclosure.CONTEXT + 1))):
        piece = padded[a + 1:b + 1]
        for m in re.finditer(r"(?<=[ \t-\r])[^ \t-\r]+(?=[ \t-\r])", piece):
            raw = m[0]
            letters = [j for j, c in enumerate(raw) if c.isalpha()]
            w = raw[letters[0]:letters[-1] + 1] if letters else ""
            if len(w) >= 3 and w.isalpha():
                out.append((w.lower(), a + m.start() + letters[0], a + m.start() + letters[0] + len(w)))
    return out


def brute(rows):
    """{id: (counts, base sha, spans)}."""
    n = len(rows)
    entity, near, both = Counter(), defaultdict(list), Counter()
    for i, t in rows:
        t = t or ""
        found = base(t)
        entity.update({e for *_, e in found})
        pairs = set()
        for k, s, e, c in found:
            for w, a, b in words_near(t, k, s, e):
                near[i].append((c, w, a, b))
                pairs.add((c, w))
        both.update(pairs)
    with_term = Counter()
    for _, t in rows:
        with_term.update({w.lower() for w in re.split(r"[^\W\d_]+|(.)", "") if w} | {w.lower() for w in re.findall(r"[^\W\d_]+", t or "")})

    def told(c, w):
        if both[c, w] < disclosure.SUPPORT or entity[c] == n:
            return 0.0
        p = entity[c] / n
        return math.log2(min(1.0, both[c, w] / with_term[w]) / p) / -math.log2(p)

    out = {}
    for i, t in rows:
        b = [(k, s, e) for k, s, e, _ in base(t or "")]
        best = {}
        for c, w, s, e in near[i]:
            best[s, e] = max(best.get((s, e), 0.0), told(c, w))
        more = [(5 if d >= disclosure.REMOVE else 4, s, e) for (s, e), d in best.items() if d >= disclosure.GENERALISE]
        text = lambda x: ",".join(f"{disclosure.KINDS[k]}:{s}:{e}" for k, s, e in sorted(x))
        out[i] = (*[sum(k == j for k, _, _ in b) for j in range(4)], hashlib.sha256(text(b).encode()).hexdigest(), text([*b, *more]))
    return out


def got(df):
    return {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in df.collect()}


def test_query_equals_brute_force(spark):
    assert got(QUERIES["op11_disclosure_spans"](spark, H.SF)) == brute(H.texts(spark))


def test_base_patterns_on_awkward_strings(spark):
    rng = np.random.default_rng(11)
    bits = ["a@b.c", "@", ".", "-", " ", "_d@e.f", "1.2.3.4", "300.1.2.3", "007.0255.1.9", "4111 1111-1111 1111", "4111111111111111", "5", "12 ", "+", "+1 (743) 555-3824",
            "+12", ")", "(", "ü", "x", "\n", "123456789", "%", "é@é.é", "a@b", "..", " ", "𝒳", "q.w@x.y.z", "0"]
    rows = [(i, "".join(rng.choice(bits, rng.integers(1, 14)))) for i in range(1500)]
    assert got(disclosure.scan(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_terms_that_give_an_entity_away(spark):
    rng = np.random.default_rng(7)
    filler = lambda k: " ".join(rng.choice(["the", "of", "and", "market", "house", "river"], k))
    rows = [(i, filler(30)) for i in range(80)]
    rows += [(100 + i, f"{filler(8)} Zelda Quux, of {filler(1)} jane.doe@corp.example wrote {filler(6)}") for i in range(4)]
    rows += [(200 + i, f"{filler(8)} the baker (Quux) slept {filler(5)}") for i in range(3)]   # seen without the address, too
    rows += [(300, "+1 (743) 555-3824 lonely words here")]                                   # an entity seen once discloses nothing
    rows += [(301, "Zelda alone"), (302, None), (303, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(disclosure.scan(df)) == want
    assert "remove" in want[100][5] and "generalise" in want[100][5] and "generalise" not in want[200][5] and want[301][5] == ""
    out = {r.doc_id: r for r in disclosure.sanitise(df.selectExpr("*", "length(text) as n_chars", "1 as `key`", "2 as `s`")).collect()}
    assert "[EMAIL]" in out[100].text and "Zelda" not in out[100].text.replace("[NAME]", "") and out[100].n_chars == len(out[100].text)
    assert out[0].text == rows[0][1] and out[302].text is None and out[302].n_chars is None and out[300].text == "[PHONE] lonely words here"


def test_long_texts_do_not_backtrack(spark):
    n = 200_000
    rows = [(0, "a" * n), (1, "1" * n), (2, "1." * n), (3, "a@b" + ".c" * n), (4, "1 " * n), (5, "+1" + " " * n), (6, "+1" * n), (7, "a@" * n), (8, "a@b.c " * 20_000),
            (9, "word " * n + "4111 1111 1111 1111")]
    r = got(disclosure.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert r[3][0] == 1 and r[8][0] == 20_000 and r[9][2] == 1 and all(sum(r[i][:4]) == 0 for i in (0, 1, 4, 5, 6, 7))
    assert r[2][1] == n // 4


def test_odd_rows(spark):
    rows = disclosure.scan(H.odd_documents(spark)).collect()
    assert len(rows) == 12 and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert disclosure.scan(H.empty_documents(spark)).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert disclosure.scan(nulls).count() == 2
    out = disclosure.sanitise(H.odd_documents(spark), length=None)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, H.odd_documents(spark).collect()))
    twice = spark.createDataFrame([(1, "a@b.c x"), (1, "a@b.c x"), (None, "a@b.c x")], "doc_id long, text string")
    assert [r.spans for r in disclosure.scan(twice).collect()] == ["email:0:5"] * 3
    marked = disclosure.sanitise(spark.createDataFrame([(1, "+4111 1111-1111 1111 a@b.c.")], "doc_id long, text string"), length=None)
    assert [r.text for r in marked.collect()] == ["[CARD] [EMAIL]."] or [r.text for r in marked.collect()][0].startswith("+[CARD]")


def test_plan_has_no_python(spark):
    plan = disclosure.scan(H.odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
