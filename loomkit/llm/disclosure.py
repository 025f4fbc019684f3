"""Personal data and the terms that disclose it, by corpus co-occurrence, in DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.  Each
valid one protects an entity: its kind and normalised value.  Terms are whole
words near a mention (``CONTEXT`` code points on both sides).  With documents as the
unit, ``p(c)`` is the share that mentions entity c, and ``p(c|t)`` the share of the documents with
term t in which t stands near a mention of c.  How strongly t reveals c is their
pointwise mutual information over c's information content:

    disclosure(c, t) = log2(p(c|t) / p(c)) / -log2(p(c))

It is 1 if t gives c away wherever it occurs, and 0 if t tells nothing.  A pair needs ``SUPPORT``
documents.  Near a mention, a term of ``REMOVE`` or more is removed, one of ``GENERALISE`` or more is replaced by
its class (``[NAME]`` if capitalised, else ``[WORD]``).  All counts cover all documents.

Positions come from the pieces between matches: their lengths are summed up by a
window inside one text.  Texts with findings are handled once per distinct text (by SHA-256), with
their number of rows, so a large group of copies is one row.  Only terms that meet the support
are counted in the corpus; the planner broadcasts their list if the written table is
small enough, and shuffles otherwise.  The patterns are written so that no text makes them backtrack.

Defined results: null and empty texts have no span; rows with equal ids each get
their own result; a part of an IP address may have leading zeros; an entity in every document
discloses nothing; an empty table gives an empty result; other columns are untouched.
Rebuilding a text costs its length times its spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, drop_written, text_or_empty, whole_row, written

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "generalise", "remove"]
CONTEXT = 64
SUPPORT = 2
GENERALISE, REMOVE = 0.7, 0.9

_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns as maximal runs: a match starts where no earlier one can, and never gives characters back.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPACE = r"[\x20\x09-\x0D]"  # one character
_MARK = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": ""}


def _candidates(kind: int) -> str:
    """Matches of one kind in column ``t``: kind, pos, gap (code points since the match before), value, and up to CONTEXT + 1
    code points on both sides, as far as its own kind's neighbours (a space stands for the text's ends)."""
    p = f"r'{PATTERNS[BASE[kind]]}'"
    return f"""transform(array(struct(split(t, {p}, -1) as g, regexp_extract_all(t, {p}, 0) as m)), x -> transform(x.m, (v, i) -> struct(
        {kind} as kind, i as pos, char_length(x.g[i]) as gap, v as value,
        right(if(i = 0, concat(' ', x.g[i]), x.g[i]), {CONTEXT + 1}) as before,
        left(if(i = size(x.m) - 1, concat(x.g[i + 1], ' '), x.g[i + 1]), {CONTEXT + 1}) as after)))[0]"""


def _valid() -> Column:
    digits = "regexp_replace(value, '[^0-9]', '')"
    luhn = (f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(i % 2 = 0, int(c), int(c) * 2 - if(int(c) > 4, 9, 0))), "
            "0, (a, x) -> a + x) % 10 = 0")
    return F.expr(f"case kind when 0 then true when 1 then value rlike r'^(?:{_BYTE}\\.){{3}}{_BYTE}$' when 2 then {luhn} "
                  f"else char_length({digits}) between 9 and 15 end")


def _entity() -> Column:
    return F.expr("concat(kind, ':', case kind when 0 then lower(value) when 1 then value else regexp_replace(value, '[^0-9]', '') end)")


def scanned(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, key, found) of every row; key (digest of the text) and found (its candidates) are null without any; written."""
    t = docs.select(col(id_col).alias("id"), text_or_empty(text).alias("t"))
    some = F.col("t").rlike("[0-9@]")  # every kind has a digit or an @
    found = t.select("id", "t", F.when(some, F.expr(f"concat({', '.join(map(_candidates, range(len(BASE))))})")).alias("found"))
    has = F.size("found") > 0
    return written(found.select("id", F.when(has, F.unhex(F.sha2("t", 256))).alias("key"), F.when(has, F.col("found")).alias("found")), "pii-rows")


def mentions(rows: DataFrame) -> DataFrame:
    """(key, n, kind, start, stop, entity, before, after): the valid base spans of each distinct text; n is its number of rows."""
    texts = rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("found").alias("found"))
    each = texts.select("key", "n", F.explode("found").alias("f")).select("key", "n", "f.*")
    upto = Window.partitionBy("key", "kind").orderBy("pos")  # the matches of one text
    placed = each.withColumn("stop", F.sum(F.col("gap") + F.char_length("value")).over(upto))
    return placed.where(_valid()).select("key", "n", "kind", (F.col("stop") - F.char_length("value")).alias("start"), "stop",
                                         _entity().alias("entity"), "before", "after")


def near_terms(found: DataFrame) -> DataFrame:
    """(key, n, entity, term, start, stop, named): words near a mention, with white space on both sides of them in its context."""
    sides = found.select("key", "n", "entity", F.explode(F.expr(
        "array(struct(before as s, start - char_length(before) as at), struct(after as s, stop as at))")).alias("x"))
    cut = sides.select("key", "n", "entity", "x.at", F.split("x.s", _SPACE, -1).alias("p")).where("size(p) > 2")
    inner = F.expr("transform(slice(p, 2, size(p) - 2), (w, j) -> struct(w, "
                   "at + aggregate(slice(p, 1, j + 1), 0, (a, y) -> a + char_length(y) + 1) as at))")  # at most CONTEXT + 2 pieces
    word = cut.select("key", "n", "entity", F.explode(inner).alias("x")).select(
        "key", "n", "entity", F.regexp_replace("x.w", r"^\P{L}+", "").alias("w"), F.expr("x.at + char_length(x.w)").alias("end"))
    term = word.select("key", "n", "entity", (F.col("end") - F.char_length("w")).alias("start"), F.regexp_replace("w", r"\P{L}+$", "").alias("w"))
    return term.where(F.col("w").rlike(r"^\p{L}{3,}$")).select(
        "key", "n", "entity", F.lower("w").alias("term"), "start", (F.col("start") + F.char_length("w")).alias("stop"),
        F.col("w").rlike(r"^\p{Lu}").alias("named"))


def disclosures(docs: DataFrame, text: str, found: DataFrame, terms: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the pairs to act on; written."""
    spark, total = docs.sparkSession, docs.count()
    both = terms.select("key", "n", "entity", "term").distinct().groupBy("entity", "term").agg(F.sum("n").alias("both"))
    both = written(both.where(F.col("both") >= SUPPORT), "pii-pairs")
    wanted = written(both.select("term").distinct(), "pii-wanted")
    words = F.array_distinct(F.transform(F.array_distinct(F.split(text_or_empty(text), r"\P{L}+")), F.lower))
    having = docs.select(F.explode(words).alias("term")).join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    naming = found.select("key", "n", "entity").distinct().groupBy("entity").agg(F.sum("n").alias("with_entity"))
    pair = both.join(naming, "entity").join(having, "term").where(F.col("with_entity") < total)
    share = F.col("with_entity") / F.lit(total)
    told = F.log2(F.least(F.col("both") / F.col("with_term"), F.lit(1.0)) / share) / -F.log2(share)
    out = written(pair.select("entity", "term", told.alias("disclosure")).where(F.col("disclosure") >= GENERALISE), "pii-disclosures")
    drop_written(spark, both, wanted)
    return out


def spans_by_text(docs: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """(key, kind, start, stop, named): base spans and term spans of each distinct text; written."""
    found = written(mentions(rows), "pii-mentions")
    terms = written(near_terms(found), "pii-terms")
    told = disclosures(docs, text, found, terms)
    more = terms.join(told, ["entity", "term"]).groupBy("key", "start", "stop").agg(F.max("disclosure").alias("d"), F.max("named").alias("named"))
    kind = F.when(F.col("d") >= REMOVE, KINDS.index("remove")).otherwise(KINDS.index("generalise"))
    spans = found.select("key", "kind", "start", "stop", F.lit(False).alias("named")).unionByName(more.select("key", kind.alias("kind"), "start", "stop", "named"))
    spans = written(spans, "pii-spans")
    drop_written(docs.sparkSession, found, terms, told)
    return spans


def _names(of: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({of}, x -> concat_ws(':', array({names})[x.kind], x.start, x.stop)), ',')"


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    rows = scanned(docs, id_col, text)
    spans = spans_by_text(docs, rows, text)
    per = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("s"))  # one text's spans
    hit = rows.where("key is not null").select("id", "key").join(per, "key", "left").select("id", "s")
    out = hit.unionByName(rows.where("key is null").select("id", F.lit(None).cast(per.schema["s"].dataType).alias("s")))
    out = out.select("id", F.coalesce("s", F.array().cast(per.schema["s"].dataType)).alias("s"))
    counts = [F.expr(f"cast(size(filter(s, x -> x.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(BASE)]
    base = F.sha2(F.expr(_names(f"filter(s, x -> x.kind < {len(BASE)})")), 256).alias("base_sha256")
    return out.select(F.col("id").alias(id_col), *counts, base, F.expr(_names("s")).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its mark and ``length`` (code points) brought up to date.

    Overlapping spans become one mark, that of the first.  Rows without a span stay exactly as they were."""
    spans = spans_by_text(docs, scanned(docs, id_col, text), text)
    order = Window.partitionBy("key").orderBy("start", "stop", "kind")  # one text's spans
    apart = spans.withColumn("before", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = apart.withColumn("run", F.sum(F.when(F.col("start") < F.col("before"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    one = runs.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                                         F.min(F.struct("start", "stop", "kind", "named")).alias("first"))
    mark = F.when(F.col("first.kind") == KINDS.index("generalise"), F.when(F.col("first.named"), "[NAME]").otherwise("[WORD]"))
    for i, k in enumerate(KINDS):
        if k in _MARK:
            mark = F.when(F.col("first.kind") == i, _MARK[k]).otherwise(mark)
    per = one.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop", mark.alias("mark")))).alias("s"))
    rows = docs.select(whole_row(docs).alias("row"), col(text).cast("string").alias("t"))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.coalesce("t", F.lit("")), 256)))
    new = ("concat(array_join(transform(s, (x, i) -> concat(substring(t, if(i = 0, 0, s[greatest(i, 1) - 1].stop) + 1, "
           "x.start - if(i = 0, 0, s[greatest(i, 1) - 1].stop)), x.mark)), ''), substring(t, s[size(s) - 1].stop + 1))")
    out = rows.join(per, "key", "left").select("row", F.expr(f"if(s is null, null, {new})").alias("new"))

    def value(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text:
            return F.coalesce("new", old).alias(c)
        if c == length:
            return F.when(F.isnotnull("new"), F.char_length("new").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)

    return out.select(*[value(c) for c in docs.columns])
