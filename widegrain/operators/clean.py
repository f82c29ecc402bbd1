"""Missing-data and reliability operators.

Each data-dependent operator is two-phase: a one-row profile job (null share
per column, medians) is read on the driver, then a single projection applies
the plan — no ``withColumn`` loops, no per-column jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.scalars import coerce_numeric, recode
from .ranking import broadcast_if_small, group_quantiles


@dataclass(frozen=True)
class MissingPolicy:
    """Tier thresholds (percent) that drive the cleaners (I8).

    Defaults are the reference's code: drop at >= 60 %, group-median fill for
    genuine numeric gaps below 20 %, structural (prefix) columns filled with 0
    below the drop threshold, 20-60 % genuine gaps left as they are.
    """
    drop_at: float = 60.0
    median_below: float = 20.0
    structural_prefixes: tuple[str, ...] = ("la",)
    structural_fill: float = 0.0
    indicator_suffix: str = "_is_missing"
    indicate_between: bool = False  # the written policy: an indicator for genuine gaps from median_below to drop_at

    def is_structural(self, name: str) -> bool:
        return any(name.lower().startswith(p.lower()) for p in self.structural_prefixes)


def null_shares(df: DataFrame, cols: Sequence[str] | None = None, sentinel=None) -> dict[str, float]:
    """Null percent per column from one aggregate (a profile read on the driver).
    With ``sentinel`` the sentinel value is **not** counted as missing (I3)."""
    cols = list(cols) if cols is not None else list(df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    n = row["__n"] or 0
    return {c: (100.0 * row[f"c{i}"] / n if n else 0.0) for i, c in enumerate(cols)}


def group_median_fill(df: DataFrame, cols: Sequence[str], by: Sequence[str] | str) -> DataFrame:
    """Fill nulls with the exact median of the same group.

    Medians come from the skew-safe exact quantile operator (one per column on
    the unpivoted (group, column, value) pairs), joined back by group. A group
    whose values are all null stays null. Rows with a null group key use the
    median of the null-key group (quirk Q10: their present values are kept).
    """
    by = [by] if isinstance(by, str) else list(by)
    cols = list(cols)
    if not cols:
        return df
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        by, cols, "__col", "__v")
    med = group_quantiles(long, "__v", [0.5], [*by, "__col"], ["__med"])
    wide = med.groupBy(*by).agg(*[F.max(F.when(F.col("__col") == c, F.col("__med"))).alias(f"__m{i}")
                                  for i, c in enumerate(cols)])
    wide = broadcast_if_small(wide)
    j = _join_side_left(df, wide, by)
    idx = {c: i for i, c in enumerate(cols)}
    types = {c: filled_type(t) for c, t in df.dtypes}
    return j.select(*[F.coalesce(F.col(c).cast(types[c]), F.col(f"__m{idx[c]}").cast(types[c])).alias(c) if c in idx
                      else F.col(c) for c in df.columns])


def filled_type(data_type: str) -> str:
    """Type of a column after a median fill: whole-number columns become
    double, since a median may lie between two of their values."""
    return "double" if data_type in ("tinyint", "smallint", "int", "bigint") else data_type


def _join_side_left(big: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    ren = {k: f"__sk{i}" for i, k in enumerate(keys)}
    s2 = side.withColumnsRenamed(ren)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(ren[k]))
        cond = c if cond is None else cond & c
    return big.join(s2, cond, "left").drop(*ren.values())


def global_medians(df: DataFrame, cols: Sequence[str], exclude_value=None) -> dict[str, float | None]:
    """Exact median of each column (optionally ignoring a sentinel value), as
    a small profile dict read on the driver."""
    cols = list(cols)
    if not cols:
        return {}
    sel = []
    for c in cols:
        x = F.col(c).cast("double")
        if exclude_value is not None:
            x = F.when(x != F.lit(float(exclude_value)), x)
        sel.append(x.alias(c))
    long = df.select(*sel).unpivot([], cols, "__col", "__v")
    rows = group_quantiles(long, "__v", [0.5], ["__col"], ["__med"]).collect()
    got = {r["__col"]: r["__med"] for r in rows}
    return {c: got.get(c) for c in cols}


# --------------------------------------------------------------------------- #
# I1 tiered cleaner
# --------------------------------------------------------------------------- #

def tiered_clean(df: DataFrame, group: str | Sequence[str], policy: MissingPolicy = MissingPolicy(),
                 protect: Sequence[str] = ()) -> DataFrame:
    """Tiered cleaner (I1):

    * null share >= ``drop_at`` -> drop the column;
    * structural (name prefix) with 0 < p < ``drop_at`` -> fill ``structural_fill``;
    * other numeric with 0 < p < ``median_below`` -> group median (W1);
    * everything else (20-60 % genuine, non-numeric) untouched; with the
      policy's ``indicate_between``, the genuine numeric ones get an indicator
      column at the end.
    """
    shares = null_shares(df)
    prot = set(protect) | ({group} if isinstance(group, str) else set(group))
    drop = [c for c, p in shares.items() if p >= policy.drop_at and c not in prot]
    keep = [c for c in df.columns if c not in drop]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    structural = [c for c in keep if c not in prot and policy.is_structural(c) and 0 < shares[c] < policy.drop_at]
    genuine = [c for c in keep if c not in prot and c not in structural and c in numeric
               and 0 < shares[c] < policy.median_below]
    between = [c for c in keep if policy.indicate_between and c not in prot and c not in structural and c in numeric
               and policy.median_below <= shares[c] < policy.drop_at]
    d = df.select(*[F.coalesce(F.col(c), F.lit(policy.structural_fill).cast(dict(df.dtypes)[c])).alias(c)
                    if c in structural else F.col(c) for c in keep],
                  *[F.col(c).isNull().cast("int").alias(f"{c}{policy.indicator_suffix}") for c in between])
    return group_median_fill(d, genuine, group)


# --------------------------------------------------------------------------- #
# I2-I6 reliability flags, indicators, sentinel-aware median impute
# --------------------------------------------------------------------------- #

def reliability_expand(df: DataFrame, flag_suffix: str = "_flag", raw_suffix: str = "_rawvalue",
                       suppressed_code=2, unreliable_code=1, sentinel: float = -1.0) -> DataFrame:
    """Reliability expansion (I2): for every ``*_flag`` column add
    ``<flag>_suppressed`` (flag == 2) and ``<flag>_unreliable`` (flag == 1) as
    0/1 ints (null flag -> 0); where the matching ``*_rawvalue`` column exists,
    it becomes the sentinel where suppressed and is coerced to numeric."""
    flags = [c for c in df.columns if c.lower().endswith(flag_suffix)]
    raw_of = {}
    for f in flags:
        r = f[: -len(flag_suffix)] + raw_suffix
        if r in df.columns:
            raw_of[r] = f
    base = []
    for c in df.columns:
        if c in raw_of:
            f = raw_of[c]
            base.append(F.when(F.col(f) == suppressed_code, F.lit(sentinel))
                        .otherwise(coerce_numeric(c)).alias(c))
        else:
            base.append(F.col(c))
    extra = []
    for f in flags:
        extra.append(F.coalesce((F.col(f) == suppressed_code).cast("int"), F.lit(0)).alias(f"{f}_suppressed"))
        extra.append(F.coalesce((F.col(f) == unreliable_code).cast("int"), F.lit(0)).alias(f"{f}_unreliable"))
    return df.select(*base, *extra)


def column_roles(name: str, metadata_terms: Sequence[str], indicator_terms: Sequence[str]) -> set[str]:
    """The roles of a column of an expanded flagged table, by its name:
    ``metadata``, ``indicator``, both, or otherwise ``feature``."""
    roles = set()
    if any(term in name for term in metadata_terms):
        roles.add("metadata")
    if any(term in name for term in indicator_terms):
        roles.add("indicator")
    return roles or {"feature"}


def split_metadata(df: DataFrame, key: str,
                   metadata_terms: Sequence[str] = ("cilow", "cihigh", "numerator", "denominator"),
                   indicator_terms: Sequence[str] = ("_suppressed", "_unreliable")) -> tuple[DataFrame, DataFrame]:
    """Vertical split (I5) into (metadata, features): metadata columns contain
    one of ``metadata_terms``; features are the rest, flag indicators last."""
    roles = {c: column_roles(c, metadata_terms, indicator_terms) for c in df.columns if c != key}

    def having(role):
        return [c for c, own in roles.items() if role in own]

    return df.select(key, *having("metadata")), df.select(key, *having("feature"), *having("indicator"))


def indicator_impute(df: DataFrame, cols: Sequence[str] | None = None, policy: MissingPolicy = MissingPolicy(),
                     sentinel: float = -1.0, sentinel_in_median: bool = False,
                     protect: Sequence[str] = ()) -> DataFrame:
    """Indicator + median impute (I3; I4 with ``sentinel_in_median=True``).

    The null share is computed without counting the sentinel. Columns with
    p >= ``drop_at`` are dropped; columns with 0 < p < ``drop_at`` get
    ``<c>_is_missing`` (null or sentinel) appended at the end and their nulls
    and sentinels replaced by the median of the other values (or, with
    ``sentinel_in_median``, of all non-null values including sentinels).
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in set(protect)]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    shares = null_shares(df, cols)
    drop = [c for c in cols if shares[c] >= policy.drop_at]
    fix = [c for c in cols if 0 < shares[c] < policy.drop_at and c in numeric]
    meds = global_medians(df, fix, exclude_value=None if sentinel_in_median else sentinel)
    types = {c: filled_type(t) for c, t in df.dtypes}
    out, ind = [], []
    for c in df.columns:
        if c in drop:
            continue
        if c in fix:
            x = F.col(c)
            miss = x.isNull() | (x == F.lit(sentinel))
            ind.append(miss.cast("int").alias(f"{c}{policy.indicator_suffix}"))
            fill = F.lit(meds[c]).cast(types[c]) if meds[c] is not None else F.lit(None).cast(types[c])
            out.append(F.when(miss, fill).otherwise(x.cast(types[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out, *ind)


def indicator_impute_one(df: DataFrame, col: str, sentinel: float = -1.0, suffix: str = "_is_missing",
                         sentinel_in_median: bool = True, indicator: str | None = None) -> DataFrame:
    """The named-column variant (I4): indicator and fill for one column, the
    median taken over all non-null values **including** sentinels (quirk Q3).
    The indicator is named ``indicator``, or the column's name with ``suffix``."""
    med = global_medians(df, [col], exclude_value=None if sentinel_in_median else sentinel)[col]
    x = F.col(col)
    miss = x.isNull() | (x == F.lit(sentinel))
    t = filled_type(dict(df.dtypes)[col])
    cols = [F.when(miss, F.lit(med).cast(t)).otherwise(x.cast(t)).alias(col) if c == col else F.col(c) for c in df.columns]
    return df.select(*cols, miss.cast("int").alias(indicator or f"{col}{suffix}"))


def recode_columns(df: DataFrame, cols: Sequence[str], mapping: Mapping) -> DataFrame:
    """Value recode on the named columns that exist (P17), e.g. {1: 0, 2: 1}."""
    present = set(cols) & set(df.columns)
    return df.select(*[recode(c, mapping).alias(c) if c in present else F.col(c) for c in df.columns])


def clean_flagged(df: DataFrame, key: str, named_col: str | None = None,
                  recode_cols: Sequence[str] = (), policy: MissingPolicy = MissingPolicy(),
                  sentinel: float = -1.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaning chain I2 -> I5 -> I4 -> I3 -> P17 (I6). Returns
    (final, metadata, features); the features carry the named column's fill and
    indicator, but not yet the general imputation."""
    rel = reliability_expand(df, sentinel=sentinel)
    meta, feats = split_metadata(rel, key)
    f = feats
    if named_col is not None and named_col in f.columns:
        f = indicator_impute_one(f, named_col, sentinel=sentinel)
    final = indicator_impute(f, policy=policy, sentinel=sentinel, protect=[key])
    final = recode_columns(final, recode_cols, {1: 0, 2: 1})
    return final, meta, f


def suppression_audit(df: DataFrame, sentinel: float = -1.0, flag_suffix: str = "_flag",
                      raw_suffix: str = "_rawvalue") -> DataFrame:
    """Suppression audit (A24): for each numeric column holding the sentinel,
    its count and share, and the share of those rows its flag marks as
    suppressed (flag == 2). The flag is looked up by the name the expansion
    really uses (quirk Q6)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(numeric):
        aggs.append(F.count_if(F.col(c) == F.lit(sentinel)).alias(f"s{i}"))
        flag = c[: -len(raw_suffix)] + flag_suffix if c.endswith(raw_suffix) else None
        if flag and flag in df.columns:
            aggs.append(F.avg(F.when(F.col(c) == F.lit(sentinel),
                                     F.coalesce((F.col(flag) == 2).cast("double"), F.lit(0.0)))).alias(f"e{i}"))
        else:
            aggs.append(F.lit(None).cast("double").alias(f"e{i}"))
    r = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("n_sentinel"),
                                        (F.col(f"s{i}") * 100.0 / F.col("__n")).alias("sentinel_pct"),
                                        F.col(f"e{i}").alias("explained_share"))
                               for i, c in enumerate(numeric)]))
    return r.select(rows.alias("s")).select("s.*").where(F.col("n_sentinel") > 0)
