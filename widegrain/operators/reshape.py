"""Reshaping and grain changes: long->wide pivot, role-aware roll-up, N-way
outer merges, lookups, anti joins and transposes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import BROADCAST_ROW_LIMIT, pinned_count


# --------------------------------------------------------------------------- #
# A1 / A2 pivot
# --------------------------------------------------------------------------- #

def require_values(df: DataFrame, column: str, values: Sequence) -> None:
    """Pivot completeness (A2): raise if a requested value never occurs.

    One small aggregate (a semi-filter on the requested values, then distinct)
    — a pivot on an absent value would silently give an all-null column.
    """
    seen = {r[0] for r in df.where(F.col(column).isin(list(values)))
            .select(column).distinct().collect()}
    missing = [v for v in values if v not in seen]
    if missing:
        raise ValueError(f"requested {column} values absent from the input: {missing}")


def pivot_mean(df: DataFrame, index: Sequence[str] | str, column: str, value: str,
               values: Sequence, names: Mapping | None = None, check: bool = True) -> DataFrame:
    """Long -> wide with the mean of ``value`` per (index, column value) (A1).

    Rows with a null index are dropped, nulls are skipped. The value list is
    fixed, so the output schema is known without a data pass, and the plan is
    a single hash aggregate with partial (map-side) combine: a hot index key
    never ships its raw rows.
    """
    idx = [index] if isinstance(index, str) else list(index)
    if check:
        require_values(df, column, values)
    names = names or {}
    d = df.na.drop(subset=idx)
    aggs = [F.avg(F.when(F.col(column) == F.lit(v), F.col(value))).alias(names.get(v, str(v)))
            for v in values]
    return d.groupBy(*idx).agg(*aggs)


# --------------------------------------------------------------------------- #
# A3-A7 grain change
# --------------------------------------------------------------------------- #

def group_sum_zero(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Group sums where an all-null group sums to 0, like pandas (A4); rows
    with a null key belong to no group, as in the other roll-ups."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])


def group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Unweighted mean of each column per group."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def first_label(label: str, order: str):
    """Label of the row with the smallest ``order`` among non-null labels (A6);
    ties broken by the label itself, so the result is deterministic."""
    s = F.min(F.when(F.col(label).isNotNull(), F.struct(F.col(order).alias("o"), F.col(label).alias("l"))))
    return s["l"]


def weighted_rollup(df: DataFrame, key: Sequence[str] | str, weight: str,
                    flags: Sequence[str] = (), rates: Sequence[str] = (),
                    counts: Sequence[str] = (), labels: Mapping[str, str] | Sequence[str] = (),
                    label_order: str | None = None, denominator: str = "all",
                    n_rows_col: str | None = "n_rows", weight_sum_col: str | None = None,
                    means: Mapping[str, str] | Sequence[str] = ()) -> DataFrame:
    """Role-based grain change (A5) in one ``groupBy().agg``:

    * flags and rates -> weighted mean ``sum(v*w) / sum(w)``; the denominator is
      the total weight of **all** rows of the group (``denominator='all'``, the
      reference rule) or of rows where ``v`` is not null (``'nonnull'``); a
      zero total weight gives null;
    * counts -> sum, an all-null group sums to 0;
    * labels -> first non-null label by ``label_order``;
    * means -> unweighted mean (A7), in the same aggregate.
    """
    k = [key] if isinstance(key, str) else list(key)
    w = F.col(weight).cast("double")
    aggs = []
    if n_rows_col:
        aggs.append(F.count(F.lit(1)).alias(n_rows_col))
    for c in list(flags) + list(rates):
        num = F.coalesce(F.sum(F.col(c).cast("double") * w), F.lit(0.0))
        den = F.sum(w) if denominator == "all" else F.sum(F.when(F.col(c).isNotNull(), w))
        aggs.append(F.try_divide(num, den).alias(c))
    for c in counts:
        aggs.append(F.coalesce(F.sum(c), F.lit(0)).alias(c))
    if weight_sum_col:
        aggs.append(F.coalesce(F.sum(weight), F.lit(0)).alias(weight_sum_col))
    lab = labels.items() if isinstance(labels, Mapping) else [(c, c) for c in labels]
    for src, out in lab:
        aggs.append(first_label(src, label_order or k[0]).alias(out))
    mns = means.items() if isinstance(means, Mapping) else [(c, c) for c in means]
    for src, out in mns:
        aggs.append(F.avg(src).alias(out))
    return df.na.drop(subset=k).groupBy(*k).agg(*aggs)


# --------------------------------------------------------------------------- #
# J1-J7 joins
# --------------------------------------------------------------------------- #

#: rows that a key may give in a full outer join, where a task holds all of them at once
FULL_JOIN_PRODUCT = 1_000_000


def full_join_split(a: DataFrame, b: DataFrame, key: str, hot_rows: int = 1_000_000, salts: int = 16) -> DataFrame:
    """Full outer join on ``key`` whose hot keys are taken out of it (J1): a
    full outer join cannot be split by adaptive execution, so a key with more
    than ``hot_rows`` rows on a side is joined apart, and so is one that gives
    more than ``FULL_JOIN_PRODUCT`` rows. Where both sides have it,
    every row matches, and an inner join on (key, salt) gives the product: the
    side with more rows of the key is dealt over ``salts`` parts by a hash of
    the row, the other one is copied to each. Where one side alone has it, its
    rows pass with nulls. Rows without key pass on both sides."""
    ca = a.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__a"))
    cb = b.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__b"))
    na, nb = F.coalesce("__a", F.lit(0)), F.coalesce("__b", F.lit(0))
    hot, n = pinned_count(ca.join(cb, key, "full").where((na > hot_rows) | (nb > hot_rows) | (na.cast("double") * nb > FULL_JOIN_PRODUCT)))
    if n == 0:
        return a.join(b, key, "full")
    if n <= BROADCAST_ROW_LIMIT:
        hot = F.broadcast(hot)
    ha, hb = a.join(hot, key), b.join(hot, key)
    cold = a.join(hot, key, "left_anti").join(b.join(hot, key, "left_anti"), key, "full")
    larger_left = F.col("__a") >= F.col("__b")
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    every = F.sequence(F.lit(0), F.lit(salts - 1))

    def salted(side, own, dealt):
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in own.columns]), F.lit(salts)).cast("int")
        return side.where(both).withColumn("__salt", F.explode(F.when(dealt, F.array(part)).otherwise(every))).drop("__a", "__b")

    product = salted(ha, a, larger_left).join(salted(hb, b, ~larger_left), [key, "__salt"]).drop("__salt")
    lone = ha.where(F.col("__b").isNull()).drop("__a", "__b").unionByName(hb.where(F.col("__a").isNull()).drop("__a", "__b"), allowMissingColumns=True)
    return cold.unionByName(product).unionByName(lone, allowMissingColumns=True).select(*cold.columns)


def outer_merge(frames: Sequence[DataFrame], key: str, reconcile: bool = True,
                sort: bool = False, method: str = "split", hot_rows: int = 1_000_000) -> DataFrame:
    """N-way full outer equi-join on one key, folded left to right.

    Rows with a null key are dropped before the merge (the reference drops them
    after it; null keys never match in Spark). Columns with the same name in
    several inputs are reconciled into one column keeping the first non-null
    value in input order (P22). Sorting is left to the sink (``sort=True``).

    ``method="split"`` (default) and ``"join"`` fold full outer joins (pandas
    merge semantics, including the product of duplicate keys); ``split`` takes
    keys of more than ``hot_rows`` rows out of the join (``full_join_split``).
    Spark re-shuffles the growing result before
    each next join because a full outer join's coalesced key has no known
    partitioning. ``method="union"`` is for inputs whose key is unique per
    input: one ``unionByName`` and one ``groupBy(key)`` — a single shuffle of
    all inputs with map-side combine, whatever the number of sources. The
    uniqueness is verified inside the same aggregate and a repeated key raises.
    """
    cleaned = [f.where(F.col(key).isNotNull()) for f in frames]
    seen: dict[str, int] = {}
    renamed = []
    for i, f in enumerate(cleaned):
        ren = {}
        for c in f.columns:
            if c == key:
                continue
            if c in seen:
                ren[c] = f"{c}__dup{i}"
            else:
                seen[c] = i
        renamed.append(f.withColumnsRenamed(ren) if ren else f)
    if method == "union":
        tagged = [f.withColumn("__src", F.lit(i)) for i, f in enumerate(renamed)]
        u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
        value_cols = [c for c in u.columns if c not in (key, "__src")]
        per_src = [F.count_if(F.col("__src") == i).alias(f"__n{i}") for i in range(len(frames))]
        agg = u.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in value_cols], *per_src)
        too_many = F.greatest(*[F.col(f"__n{i}") for i in range(len(frames))]) > 1 if len(frames) > 1 \
            else F.col("__n0") > 1
        merged = agg.select(F.when(too_many, F.raise_error(F.lit(f"key {key} repeats within an input; "
                                                                  "use method='join'")).cast(u.schema[key].dataType))
                            .otherwise(F.col(key)).alias(key), *value_cols)
    elif method == "split":
        merged = reduce(lambda a, b: full_join_split(a, b, key, hot_rows), renamed)
    elif method == "join":
        merged = reduce(lambda a, b: a.join(b, key, "full"), renamed)
    else:
        raise ValueError(f"unknown method {method!r}")
    if reconcile:
        out = [F.col(key)]
        for c in seen:
            dups = [f"{c}__dup{i}" for i in range(len(frames)) if f"{c}__dup{i}" in merged.columns]
            out.append(F.coalesce(F.col(c), *[F.col(d) for d in dups]).alias(c) if dups else F.col(c))
        merged = merged.select(*out)
    return merged.orderBy(key) if sort else merged


def left_lookup(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left equi-join that names the key once (J2, J3 when chained)."""
    return left.join(right, key, "left")


def left_chain(spine: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Chain of left joins from a spine table."""
    return reduce(lambda a, b: a.join(b, key, "left"), others, spine)


def unmatched(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (J7), as a left anti join."""
    return left.join(right, key, "left_anti")


def all_null_in(cols: Sequence[str]):
    """Predicate: every listed column is null (J7 after a merge)."""
    return F.forall(F.array(*[F.col(c).isNull() for c in cols]), lambda x: x)


# --------------------------------------------------------------------------- #
# P14 / J5 transpose and side-by-side
# --------------------------------------------------------------------------- #

def transpose(df: DataFrame, ids: Sequence[str], fields: Sequence[str] | None = None,
              name_col: str = "field", value_col: str = "value", as_string: bool = False) -> DataFrame:
    """Record -> long (field, value) rows (P14) via ``unpivot``. Mixed types are
    cast to double (numeric fields) or string (``as_string``)."""
    fields = list(fields) if fields is not None else [c for c in df.columns if c not in ids]
    t = "string" if as_string else "double"
    d = df.select(*ids, *[F.col(c).cast(t).alias(c) for c in fields])
    return d.unpivot(list(ids), fields, name_col, value_col)


def side_by_side(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str],
                 left_name: str = "value_a", right_name: str = "value_b") -> DataFrame:
    """Compare the same fields of one entity in two tables (J5): a key join,
    then both sides unpivoted into (key, field, value_a, value_b)."""
    la = transpose(a.select(key, *fields), [key], fields, "field", left_name)
    lb = transpose(b.select(key, *fields), [key], fields, "field", right_name)
    return la.join(lb, [key, "field"], "full")
