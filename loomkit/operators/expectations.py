"""Expectation suites (V1-V13) compiled to one aggregate pass.

An expectation is ``(expectation, column, kwargs)``.  Table-level and
schema checks come from the schema and the row count; every row-wise
check becomes a few conditional sums in **one** ``agg``; uniqueness needs
a ``groupBy`` per column (partial aggregation first, so a hot value never
lands whole in one task).  The per-expectation results are produced by
Spark as rows; nothing but single-row aggregates is computed.

Counting conventions: NULL (and NaN on float columns) is missing; missing
values are skipped by value checks; ``unexpected_percent`` is over
non-missing rows, except for the not-null check where it is over all rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, TimestampNTZType,
                               TimestampType)

from ..functions.missing import as_missing

# Expectation names of the suite vocabulary.
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_COUNT = "expect_table_column_count_to_be_between"
COLUMNS_MATCH = "expect_table_columns_to_match_set"
OF_TYPE = "expect_column_values_to_be_of_type"
EXISTS = "expect_column_to_exist"
BETWEEN = "expect_column_values_to_be_between"
REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
NOT_NULL = "expect_column_values_to_not_be_null"
MEAN_BETWEEN = "expect_column_mean_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
DISTINCT_BETWEEN = "expect_column_unique_value_count_to_be_between"


def pandas_dtype(dt: DataType) -> str:
    """The pandas dtype name a Spark type reads back as."""
    if isinstance(dt, LongType):
        return "int64"
    if isinstance(dt, IntegerType):
        return "int32"
    if isinstance(dt, ShortType):
        return "int16"
    if isinstance(dt, ByteType):
        return "int8"
    if isinstance(dt, DoubleType):
        return "float64"
    if isinstance(dt, FloatType):
        return "float32"
    if isinstance(dt, BooleanType):
        return "bool"
    if isinstance(dt, (TimestampType, TimestampNTZType, DateType)):
        return "datetime64[ns]"
    return "object"


@dataclass(frozen=True)
class Expectation:
    expectation: str
    column: str | None = None
    kwargs: tuple = field(default_factory=tuple)  # sorted (name, value) pairs

    @staticmethod
    def of(expectation: str, column: str | None = None, **kw) -> "Expectation":
        return Expectation(expectation, column, tuple(sorted(
            (k, tuple(v) if isinstance(v, list) else v) for k, v in kw.items())))

    @property
    def kw(self) -> dict:
        return {k: list(v) if isinstance(v, tuple) else v for k, v in self.kwargs}

    def kwargs_json(self) -> str:
        return json.dumps(self.kw, sort_keys=True)


def dedupe(suite) -> list:
    """Drop exact repeats (a suite may add the same schema check twice)."""
    seen, out = set(), []
    for e in suite:
        if e not in seen:
            seen.add(e)
            out.append(e)
    return out


def default_suite(columns=None, column_types=None) -> list:
    """The starter suite: non-empty table, at least one column, and when
    given, the exact column set and per-column dtypes; each check once."""
    checks = [Expectation.of(ROW_COUNT, min_value=1), Expectation.of(COLUMN_COUNT, min_value=1, max_value=None)]
    checks += [Expectation.of(OF_TYPE, c, type_=t) for c, t in sorted((column_types or {}).items())]
    return checks + ([Expectation.of(COLUMNS_MATCH, column_set=list(columns), exact_match=True)] if columns else [])


def _in_range(v: Column, lo, hi, strict_lo=False, strict_hi=False) -> Column:
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((v > F.lit(lo)) if strict_lo else (v >= F.lit(lo)))
    if hi is not None:
        ok = ok & ((v < F.lit(hi)) if strict_hi else (v <= F.lit(hi)))
    return ok


def _count(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _row_exprs(i: int, e: Expectation, fields: dict) -> list:
    """Aggregate expressions of one row-wise expectation: missing count
    ``m<i>`` and unexpected count ``u<i>`` or observation ``o<i>``."""
    kw = e.kw
    v = as_missing(F.col(e.column), fields[e.column])
    out = [_count(v.isNull()).alias(f"m{i}")]
    if e.expectation == BETWEEN:
        ok = _in_range(v, kw.get("min_value"), kw.get("max_value"),
                       kw.get("strict_min", False), kw.get("strict_max", False))
        out.append(_count(v.isNotNull() & ~ok).alias(f"u{i}"))
    elif e.expectation == REGEX:
        out.append(_count(v.isNotNull() & ~v.cast("string").rlike(kw["regex"])).alias(f"u{i}"))
    elif e.expectation == IN_SET:
        out.append(_count(v.isNotNull() & ~v.isin(list(kw["value_set"]))).alias(f"u{i}"))
    elif e.expectation == NOT_NULL:
        out.append(_count(v.isNull()).alias(f"u{i}"))
    elif e.expectation == MEAN_BETWEEN:
        out.append(F.avg(v).cast("double").alias(f"o{i}"))
    elif e.expectation == DISTINCT_BETWEEN:
        out.append(F.count_distinct(v).cast("double").alias(f"o{i}"))
    else:
        raise ValueError(f"Unknown expectation {e.expectation}")
    return out


def _duplicate_counts(df: DataFrame, suite, uniq, fields) -> Column:
    """Rows whose value occurs more than once, for every uniqueness check at
    once: one scan and one shuffle with grouping sets (one per column; map-side
    partial counts, so a hot value is pre-reduced), returned as one struct
    (a scalar subquery, no join)."""
    cols = [f"_u{i}" for i in uniq]
    vals = df.select(*[as_missing(F.col(suite[i].column), fields[suite[i].column]).alias(f"_u{i}") for i in uniq])
    counts = vals.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(c).alias(f"_g{c}") for c in cols])
    sums = counts.agg(F.struct(*[
        F.coalesce(F.sum(F.when((F.col(f"_g{c}") == 0) & F.col(c).isNotNull() & (F.col("_n") > 1), F.col("_n"))),
                   F.lit(0)).cast("bigint").alias(f"u{i}") for c, i in zip(cols, uniq)]))
    return sums.scalar().alias("_dups")


def validate(df: DataFrame, suite) -> DataFrame:
    """One result row per expectation (exact repeats dropped).

    Columns: expectation_id, expectation, column, kwargs, success,
    observed_value (numeric observations), observed_text (others),
    element_count, missing_count, unexpected_count, unexpected_percent.
    """
    suite = dedupe(suite)
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs, uniq = _aggregates(suite, fields)
    stats = df.agg(*aggs)
    return _results(_with_duplicates(stats, df, suite, uniq, fields), suite, df)


def _aggregates(suite, fields) -> tuple[list, list]:
    """The aggregates of every row-wise check, and the numbers of the uniqueness checks."""
    aggs, uniq = [F.count(F.lit(1)).alias("_rows")], []
    for i, e in enumerate(suite):
        c = e.column
        if e.expectation in (ROW_COUNT, COLUMN_COUNT, COLUMNS_MATCH, OF_TYPE, EXISTS) or c not in fields:
            continue  # from the schema; a missing column is reported as a failed expectation
        if e.expectation == UNIQUE:
            aggs.append(_count(as_missing(F.col(c), fields[c]).isNull()).alias(f"m{i}"))
            uniq.append(i)
        else:
            aggs += _row_exprs(i, e, fields)
    return aggs, uniq


def _with_duplicates(stats: DataFrame, df: DataFrame, suite, uniq, fields) -> DataFrame:
    if not uniq:
        return stats
    stats = stats.select("*", _duplicate_counts(df, suite, uniq, fields))
    return stats.select("*", *[F.col("_dups")[f"u{i}"].alias(f"u{i}") for i in uniq]).drop("_dups")


def _results(stats: DataFrame, suite, df: DataFrame) -> DataFrame:
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows = [_result(i, e, fields, df.columns) for i, e in enumerate(suite)]
    return stats.select(F.inline(F.array(*rows)))


#: Settings that a side session takes over, as they decide what an expression gives.
_CARRIED = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")


def write_validated(df: DataFrame, suite, path: str, fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """V13 while writing: ``df`` is written to ``path`` and validated in the same pass over it.

    Row counts, missing values, value checks and means are observed by the job
    that writes.  Checks that need all values of a column at once (uniqueness,
    number of distinct values) read that column of what was written.  The
    writing runs in a session of its own that shares the tables: in Spark 4.1 an
    ``Observation`` leaves a listener in its session, after which aggregations
    over ML predictions there fail to serialise."""
    from pyspark.sql import Observation

    from ..sources.files import read_table, write_table
    spark = df.sparkSession
    suite = dedupe(suite)
    fields = {f.name: f.dataType for f in df.schema.fields}
    distinct = [i for i, e in enumerate(suite) if e.expectation == DISTINCT_BETWEEN and e.column in fields]
    aggs, uniq = _aggregates([e if i not in distinct else Expectation.of(NOT_NULL, e.column) for i, e in enumerate(suite)], fields)
    side = spark.newSession()
    for name in _CARRIED:
        side.conf.set(name, spark.conf.get(name))
    view = f"loomkit_write_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        seen = Observation(view)
        write_table(side.table(f"{side.conf.get('spark.sql.globalTempDatabase')}.{view}").observe(seen, *aggs), path, fmt, mode)
        counts = seen.get
    finally:
        spark.catalog.dropGlobalTempView(view)
    schema = df.limit(0).agg(*aggs).schema
    stats = spark.createDataFrame([tuple(counts[f.name] for f in schema)], schema)
    back = read_table(spark, path, fmt, schema=df.schema if fmt != "parquet" else None)
    if distinct:
        exact = back.agg(F.struct(*[F.count_distinct(as_missing(F.col(suite[i].column), fields[suite[i].column])).cast("double").alias(f"o{i}")
                                    for i in distinct])).scalar().alias("_distinct")
        stats = stats.drop(*[f"u{i}" for i in distinct]).select("*", exact)
        stats = stats.select("*", *[F.col("_distinct")[f"o{i}"].alias(f"o{i}") for i in distinct]).drop("_distinct")
    return _results(_with_duplicates(stats, back, suite, uniq, fields), suite, df)


def _result(i: int, e: Expectation, fields: dict, columns: list) -> Column:
    kw, c = e.kw, e.column
    n = F.col("_rows")
    null_d, null_s, null_l = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    obs, text, elem, miss, unexp, pct = null_d, null_s, null_l, null_l, null_l, null_d
    if e.expectation == ROW_COUNT:
        obs = n.cast("double")
        ok = _in_range(n, kw.get("min_value"), kw.get("max_value"))
    elif e.expectation == COLUMN_COUNT:
        obs = F.lit(float(len(columns)))
        ok = F.lit(bool((kw.get("min_value") is None or len(columns) >= kw["min_value"])
                        and (kw.get("max_value") is None or len(columns) <= kw["max_value"])))
    elif e.expectation == COLUMNS_MATCH:
        want = set(kw["column_set"])
        exact = kw.get("exact_match", True)
        good = (set(columns) == want) if exact in (True, None) else want <= set(columns)
        text, ok = F.lit(json.dumps(list(columns))), F.lit(bool(good))
    elif e.expectation == EXISTS:
        ok = F.lit(c in fields)
    elif c not in fields:
        text, ok = F.lit(f"column {c} not found"), F.lit(False)
    elif e.expectation == OF_TYPE:
        name = pandas_dtype(fields[c])
        text = F.lit(name)
        ok = F.lit(kw["type_"] in (name, fields[c].simpleString()))
    else:
        elem, miss = n, F.col(f"m{i}")
        nonnull = n - miss
        if e.expectation in (MEAN_BETWEEN, DISTINCT_BETWEEN):
            obs = F.col(f"o{i}")
            ok = F.coalesce(_in_range(obs, kw.get("min_value"), kw.get("max_value"),
                                      kw.get("strict_min", False), kw.get("strict_max", False)), F.lit(False))
        else:
            unexp = F.col(f"u{i}")
            denom = n if e.expectation == NOT_NULL else nonnull
            pct = F.when(denom > 0, unexp * 100.0 / denom).otherwise(F.lit(0.0))
            mostly = kw.get("mostly")
            if mostly is None:
                ok = unexp == 0
            else:
                ok = F.when(denom > 0, (F.lit(1.0) - unexp / denom) >= F.lit(float(mostly))).otherwise(F.lit(True))
    return F.struct(
        F.lit(i + 1).cast("int").alias("expectation_id"), F.lit(e.expectation).alias("expectation"),
        F.lit(c).cast("string").alias("column"), F.lit(e.kwargs_json()).alias("kwargs"),
        ok.cast("boolean").alias("success"), obs.cast("double").alias("observed_value"),
        text.alias("observed_text"), elem.cast("bigint").alias("element_count"),
        miss.cast("bigint").alias("missing_count"), unexp.cast("bigint").alias("unexpected_count"),
        pct.cast("double").alias("unexpected_percent"))


def suite_statistics(results: DataFrame) -> DataFrame:
    """Totals: evaluated, successful, unsuccessful, success_percent, success."""
    ok = F.sum(F.col("success").cast("int")).cast("bigint")
    n = F.count(F.lit(1)).cast("bigint")
    return results.agg(
        n.alias("evaluated_expectations"), ok.alias("successful_expectations"),
        (n - ok).alias("unsuccessful_expectations"),
        F.when(n > 0, ok * 100.0 / n).otherwise(F.lit(100.0)).alias("success_percent"),
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"))


def expect_one(df: DataFrame, expectation: str, column: str | None = None, **kw) -> DataFrame:
    """Run a single expectation (V1-V12) as a one-row result."""
    return validate(df, [Expectation.of(expectation, column, **kw)])

