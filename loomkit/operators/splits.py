"""Exact, seeded, partition-independent train / test / validation splits.

Semantics (same contract as the common in-memory splitter):

* ``n_test = ceil(test_size * n)``, ``n_train = n - n_test``.
* Stratified: train gets ``floor(c * n_train / n)`` rows of a class with
  ``c`` rows; the leftover rows go one each to the classes with the
  largest remainders ``(c * n_train) % n`` (ties by label); test gets the
  rest.  A class with fewer than 2 rows, or fewer train / test rows than
  classes, is an error.
* Inside a class rows are ordered by ``md5('<seed>|<key>')`` then key; the
  first quota rows are train.

The cut never ranks a whole class in one task, and a split reads its input
twice, whatever the number of parts.  The first read writes a narrow table of
(class, hashes, key) into the session's checkpoint folder.  There, rows are
counted per ``(class, hash-prefix bucket)`` with the first 4 hex digits of the
hash: at most 65,536 buckets per class, so map-side partial aggregation shrinks
every task's output to that size.  A running sum over the buckets finds, for
each class, the one bucket holding the quota boundary; only its rows (about
1/65,536 of a class) are ranked, which gives the last (hash, key) of the first
part.  A three-way split finds its second cut in the same narrow table.  The second
read compares every row with the cuts of its class (a per-class table, broadcast by the
planner if small).  Rows that equal a cut are ranked among themselves only if some
of them belong on each side.  The result equals a full sort by (hash, key) and
does not depend on partitioning.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.hashing import hash_prefix, hash_unit, seeded_md5
from ..functions.missing import as_missing

# ``task_type`` threshold: fewer distinct non-missing values -> classification.
CLASSIFICATION_MAX_DISTINCT = 20

_Y, _H, _B, _K = "_lk_y", "_lk_h", "_lk_b", "_lk_k"


def split_sizes(n: int, test_size) -> tuple[int, int]:
    """(n_train, n_test) with a float share rounded up for test."""
    if isinstance(test_size, float) and 0.0 < test_size < 1.0:
        n_test = int(math.ceil(test_size * n))
    elif isinstance(test_size, int) and not isinstance(test_size, bool) and 0 < test_size < n:
        n_test = test_size
    else:
        raise ValueError(f"test_size={test_size!r} should be a float in (0, 1) or an int in (0, {n})")
    n_train = n - n_test
    if n_train <= 0:
        raise ValueError(f"With n_samples={n} and test_size={test_size}, the train set is empty")
    return n_train, n_test


# Hash-prefix length of a bucket: 16**4 = 65,536 buckets per class.
BUCKET_HEX = 4


def _prepare(df: DataFrame, keys, label, seed, salt) -> DataFrame:
    keys = list(keys) if keys else list(df.columns)
    y = F.col(label) if label else F.lit(0)
    if label:
        y = as_missing(y, df.schema[label].dataType)
    d = (df.withColumn(_Y, y)
           .withColumn(_H, seeded_md5(seed, *keys, salt=salt)))
    return d.withColumn(_B, hash_prefix(F.col(_H), BUCKET_HEX)), keys


def _bucket_counts(d: DataFrame) -> DataFrame:
    """Rows per (class, bucket), computed once and checkpointed into the
    session's shared checkpoint folder (lineage cut; small: <= 65,536 rows
    per class)."""
    from ..session import checkpoint_dir, narrowed
    checkpoint_dir(d.sparkSession)
    return narrowed(d.groupBy(_Y, _B).agg(F.count(F.lit(1)).alias("_n"))).checkpoint(eager=True)


def _class_stats(bc: DataFrame):
    cls = bc.groupBy(_Y).agg(F.sum("_n").alias("_c"))
    s = cls.agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("k"),
                F.min("_c").alias("minc"), F.max("_c").alias("maxc")).first()
    return cls, int(s["n"] or 0), int(s["k"] or 0), int(s["minc"] or 0), int(s["maxc"] or 0)


def _train_quotas(cls: DataFrame, n: int, n_train: int, stratified: bool) -> DataFrame:
    """Per class: ``_tr`` rows go to the first part (largest remainder)."""
    if not stratified:
        return cls.select(F.col(_Y).alias("_yk"), F.lit(n_train).cast("bigint").alias("_tr"))
    prod = F.col("_c").cast("decimal(38,0)") * F.lit(n_train)
    rem = prod % F.lit(n)
    q = cls.select(F.col(_Y).alias("_yk"),
                   ((prod - rem) / F.lit(n)).cast("bigint").alias("_f"),
                   rem.alias("_r"))
    # Window over the per-class table (one row per class, not per data row).
    left = F.lit(n_train) - F.sum("_f").over(Window.partitionBy())
    rk = F.row_number().over(Window.orderBy(F.col("_r").desc(), F.col("_yk").asc_nulls_last()))
    return q.select("_yk", (F.col("_f") + F.when(rk <= left, 1).otherwise(0)).cast("bigint").alias("_tr"))


def _check_strata(n, k, minc, n_train, n_test):
    if minc < 2:
        raise ValueError("a class has a single row: it cannot be in both parts")
    if n_train < k:
        raise ValueError(f"{n_train} training rows cannot cover {k} classes")
    if n_test < k:
        raise ValueError(f"{n_test} test rows cannot cover {k} classes")


def _narrow(df: DataFrame, keys, label, seed, salts) -> DataFrame:
    """(class, key, one hash a salt) of every row, written; the only read of ``df`` that finding cuts takes."""
    from ..session import materialize
    y = as_missing(F.col(label), df.schema[label].dataType) if label else F.lit(0)
    return materialize(df.select(y.alias(_Y), F.struct(*[F.col(c) for c in keys]).alias(_K),
                                 *[seeded_md5(seed, *keys, salt=x).alias(f"{_H}{i}") for i, x in enumerate(salts)]), "split-keys")


def _place(i: int) -> Column:
    """A narrow row's place in the order of its ``i``-th hash."""
    return F.struct(F.col(f"{_H}{i}").alias("h"), F.col(_K).alias("k"))


def _cuts(narrow: DataFrame, i: int, stratified: bool, test_size) -> DataFrame:
    """Per class: ``cut`` (the last place of the first part; NULL if that is empty), how many rows
    have that place (``_ties``) and how many of them go first (``_first``).  Written: one row a class."""
    from ..session import materialize
    rows = narrow if stratified else narrow.withColumn(_Y, F.lit(0))
    rows = rows.select(_Y, hash_prefix(F.col(f"{_H}{i}"), BUCKET_HEX).alias(_B), _place(i).alias("_o"))
    bc = _bucket_counts(rows)
    cls, n, k, minc, _ = _class_stats(bc)
    if n == 0:
        raise ValueError("Cannot split an empty table")
    n_first, n_second = split_sizes(n, test_size)
    if stratified:
        _check_strata(n, k, minc, n_first, n_second)
    quotas = _train_quotas(cls, n, n_first, stratified)
    run = Window.partitionBy(_Y).orderBy(_B).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bc = bc.withColumn("_cum", F.sum("_n").over(run))
    edge = (bc.join(quotas, bc[_Y].eqNullSafe(quotas["_yk"]))
              .where((F.col("_cum") - F.col("_n") < F.col("_tr")) & (F.col("_tr") <= F.col("_cum")))
              .select("_yk", F.col(_B).alias("_bb"), (F.col("_tr") - (F.col("_cum") - F.col("_n"))).alias("_need")))
    near = rows.join(edge, rows[_Y].eqNullSafe(edge["_yk"]) & (rows[_B] == edge["_bb"]))  # one bucket a class
    order = Window.partitionBy("_yk").orderBy("_o")
    near = near.select("_yk", "_o", "_need", F.row_number().over(order).alias("_rn"), F.rank().over(order).alias("_r"),
                       F.count(F.lit(1)).over(Window.partitionBy("_yk", "_o")).alias("_ties"))
    last = near.where(F.col("_rn") == F.col("_need")).select(
        F.col("_yk").alias("_ye"), F.col("_o").alias("cut"), "_ties", (F.col("_rn") - F.col("_r") + 1).alias("_first"))
    return materialize(quotas.join(last, quotas["_yk"].eqNullSafe(last["_ye"]), "left").select("_yk", "cut", "_ties", "_first"), "split-cuts")


def _assigned(d: DataFrame, place: Column, klass: Column, cuts: DataFrame, col: str, first: str, second: str, stratified: bool,
              among: Column | None = None) -> DataFrame:
    """``d`` with ``col``: its side of the cut of its class.  Rows outside ``among`` take no place (their side means nothing)."""
    if stratified:
        rows = d.withColumn("_yd", klass)
        rows = rows.join(cuts, rows["_yd"].eqNullSafe(cuts["_yk"]), "left").drop("_yd", "_yk")
    else:  # one stratum: its cut is three scalars, no join needed
        rows = d.select("*", *[cuts.select(c).scalar().alias(c) for c in ("cut", "_ties", "_first")])
    rows = rows.withColumn("_o", place)
    before = F.col("cut").isNotNull() & ((F.col("_o") < F.col("cut")) | ((F.col("_o") == F.col("cut")) & (F.col("_first") == F.col("_ties"))))
    side = F.when(before, F.lit(first)).otherwise(F.lit(second))
    keep = [*[F.col(c) for c in d.columns], F.col(col)]
    if not cuts.where("_first < _ties").take(1):  # one row a class
        return rows.withColumn(col, side).select(*keep)
    straddles = F.coalesce((F.col("_o") == F.col("cut")) & (F.col("_first") < F.col("_ties")), F.lit(False))
    straddles = straddles if among is None else straddles & among
    rn = F.row_number().over(Window.partitionBy("_o").orderBy(F.lit(0)))  # equal rows
    tied = rows.where(straddles).withColumn(col, F.when(rn <= F.col("_first"), F.lit(first)).otherwise(F.lit(second)))
    return rows.where(~straddles).withColumn(col, side).select(*keep).unionByName(tied.select(*keep))


def _split(df: DataFrame, keys, label, seed, steps, split_col, decide=None) -> DataFrame:
    """Cut off one part after another: ``steps`` are (salt, share or size of the second part, rest, second part).

    ``decide``: whether the label gives strata, asked of the narrow table at each step (None: it does if given)."""
    keys = list(keys) if keys else list(df.columns)
    narrow = _narrow(df, keys, label, seed, [x for x, *_ in steps])
    y = as_missing(F.col(label), df.schema[label].dataType) if label else F.lit(0)
    out = df.select("*", y.alias("_lk_class"), *[F.struct(seeded_md5(seed, *keys, salt=x).alias("h"), F.struct(*[F.col(c) for c in keys]).alias("k"))
                                               .alias(f"_lk_o{i}") for i, (x, *_) in enumerate(steps)])
    left, parts = narrow, []
    for i, (_, share, first, second) in enumerate(steps):
        strata = bool(label) and (decide is None or decide(left, i))
        cuts = _cuts(left, i, strata, share)
        part = f"_lk_part{i}"
        parts.append((part, first, second))
        still = reduce(lambda a, b: a & b, [F.col(p) == f for p, f, _ in parts[:-1]]) if i else None
        out = _assigned(out, F.col(f"_lk_o{i}"), F.col("_lk_class"), cuts, part, first, second, strata, still)
        if i + 1 < len(steps):
            left = _assigned(left, _place(i), F.col(_Y), cuts, part, first, second, strata).where(F.col(part) == first).drop(part)
    name = F.lit(None)
    for part, first, second in reversed(parts):
        name = F.when(F.col(part) == second, F.lit(second)).otherwise(name if part != parts[-1][0] else F.lit(first))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], name.alias(split_col))


def exact_split(df: DataFrame, keys=None, label: str | None = None, test_size=0.2,
                seed: int = 42, salt: str | None = None, split_col: str = "split",
                first: str = "train", second: str = "test") -> DataFrame:
    """Assign every row to ``first`` or ``second`` with exact quotas.

    ``label`` given means stratified.  ``keys`` must identify a row
    (default: all columns, so identical rows tie and are interchangeable).
    """
    return _split(df, keys, label, seed, [(salt, test_size, first, second)], split_col)


def task_type_of(df: DataFrame, column: str) -> str:
    """'classification' or 'regression' for one target column."""
    return task_types(df, [column]).where(F.col("column_name") == column).first()["task_type"]


def task_types(df: DataFrame, columns=None) -> DataFrame:
    """Per column: classification when string-typed or fewer than 20
    distinct non-missing values, else regression.

    One approximate pass over all columns; exact distinct counts only for
    columns whose estimate is near the threshold.
    """
    columns = list(columns or df.columns)
    fields = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in columns if not isinstance(fields[c], StringType)]
    near = []
    if num:
        est = df.agg(*[F.approx_count_distinct(as_missing(F.col(c), fields[c])).alias(c)
                       for c in num]).first()
        near = [c for c in num if est[c] < 2 * CLASSIFICATION_MAX_DISTINCT]
    exprs = []
    for c in columns:
        if isinstance(fields[c], StringType):
            t = F.lit("classification")
        elif c in near:
            t = F.when(F.count_distinct(as_missing(F.col(c), fields[c])) < CLASSIFICATION_MAX_DISTINCT,
                       F.lit("classification")).otherwise(F.lit("regression"))
        else:
            t = F.lit("regression")
        exprs.append(F.struct(F.lit(c).alias("column_name"),
                              F.lit(fields[c].simpleString()).alias("data_type"),
                              t.alias("task_type")))
    if near:
        row = df.agg(F.array(*exprs).alias("_t"))
    else:  # every answer is known from the schema and the estimate
        row = df.sparkSession.range(1).select(F.array(*exprs).alias("_t"))
    return row.select(F.inline("_t"))


def is_classification(df: DataFrame, label: str) -> bool:
    return task_type_of(df, label) == "classification"


def split_random(df: DataFrame, keys=None, test_size=0.2, seed=42, split_col="split") -> DataFrame:
    """Exact-size seeded split, no strata."""
    return exact_split(df, keys, None, test_size, seed, split_col=split_col)


def split_stratified(df: DataFrame, label: str, keys=None, test_size=0.2, seed=42,
                     split_col="split") -> DataFrame:
    """Exact per-class quotas."""
    return exact_split(df, keys, label, test_size, seed, split_col=split_col)


def split_three_way(df: DataFrame, keys=None, label: str | None = None, test_size=0.2,
                    validation_size=0.0, seed=42, stratify: bool | None = None,
                    split_col="split") -> DataFrame:
    """Test first, then validation carved out of train with
    ``validation_size / (1 - test_size)``; stratified again on train labels
    when the target is a classification target (``stratify=None``)."""
    steps = [(None, test_size, "train", "test")]
    if validation_size and validation_size > 0:
        steps.append(("validation", validation_size / (1 - test_size), "train", "validation"))
    known: list[bool] = []

    def decide(rows: DataFrame, i: int) -> bool:
        if stratify is not None:
            return stratify
        # asked again of the train rows only when that could change the answer: a
        # subset of a classification target (string, or < 20 values) stays one
        if not known or not known[0]:
            known[:] = [is_classification(rows.select(F.col(_Y).alias(label)), label)]
        return known[0]

    return _split(df, keys, label, seed, steps, split_col, decide)


def split_bernoulli(df: DataFrame, keys=None, test_size=0.2, validation_size=0.0,
                    seed=42, split_col="split") -> DataFrame:
    """T4: stateless per-row split by hash threshold (approximate sizes;
    valid on a stream because each row decides alone)."""
    keys = list(keys) if keys else list(df.columns)
    u = hash_unit(seeded_md5(seed, *keys))
    return df.withColumn(split_col,
                         F.when(u < F.lit(float(test_size)), F.lit("test"))
                          .when(u < F.lit(float(test_size + validation_size)), F.lit("validation"))
                          .otherwise(F.lit("train")))


def rank_within(df: DataFrame, keys, label: str | None, seed=42, rank_col="_rank") -> DataFrame:
    """Exact 1-based rank of each row inside its class by (hash, key).

    Distributed: per-(class, bucket) counts give each bucket's offset, and
    rows are ranked inside their bucket only, so no task holds a class.
    """
    d, keys = _prepare(df, keys, label, seed, None)
    bc = _bucket_counts(d)
    _, n, k, _, maxc = _class_stats(bc)
    run = Window.partitionBy(_Y).orderBy(_B).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    off = bc.select(F.col(_Y).alias("_yk"), F.col(_B).alias("_bk"),
                    (F.sum("_n").over(run) - F.col("_n")).alias("_off"))
    rows = d.join(off,
                  d[_Y].eqNullSafe(off["_yk"]) & (d[_B] == off["_bk"]))
    order = [F.col(_H)] + [F.col(c).asc_nulls_first() for c in keys]
    rn = F.row_number().over(Window.partitionBy(_Y, _B).orderBy(*order))
    return rows.withColumn(rank_col, F.col("_off") + rn).select(*df.columns, rank_col)


def stratified_kfold(df: DataFrame, label: str | None, keys=None, k: int = 3, seed=42,
                     fold_col="fold") -> DataFrame:
    """fold = (rank inside class - 1) mod k, so every fold keeps class shares."""
    if k < 2:
        raise ValueError("k must be at least 2")
    r = rank_within(df, keys, label, seed, "_rank")
    return r.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def rank_in_groups(df: DataFrame, group_cols, order_cols, bucket: Column, rank_col: str = "_rank") -> DataFrame:
    """Exact 1-based ``row_number`` inside each group by ``order_cols``
    without sorting a whole group in one task.

    ``bucket`` must be an order-preserving coarsening of the first order
    column (e.g. the minute of a time stamp).  Per (group, bucket) counts
    are cumulated on that small table to give each bucket's offset; rows
    are then ranked inside their (group, bucket) only.
    """
    g = list(group_cols)
    d = df.withColumn("_rb", bucket)
    bc = d.groupBy(*g, "_rb").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*g).orderBy("_rb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    off = bc.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_rb").alias("_rbk"),
                    (F.sum("_n").over(run) - F.col("_n")).alias("_off"))
    cond = d["_rb"].eqNullSafe(off["_rbk"])
    for i, c in enumerate(g):
        cond = cond & d[c].eqNullSafe(off[f"_g{i}"])
    rows = d.join(off, cond)
    rn = F.row_number().over(Window.partitionBy(*g, "_rb").orderBy(*order_cols))
    return rows.withColumn(rank_col, F.col("_off") + rn).select(*df.columns, rank_col)
