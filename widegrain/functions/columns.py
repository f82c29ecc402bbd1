"""Column roles and families, decided on the driver from the schema (names and
types) or from a one-row content profile — never from collected data rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def columns_matching(columns: Iterable[str], *, prefix: str | Sequence[str] = (),
                     suffix: str | Sequence[str] = (), contains: str | Sequence[str] = (),
                     case_insensitive: bool = True) -> list[str]:
    """Names matching any given prefix / suffix / substring (P10)."""
    def norm(x):
        return x.lower() if case_insensitive else x

    def as_list(x):
        return [x] if isinstance(x, str) else list(x)

    pre, suf, sub = ([norm(p) for p in as_list(x)] for x in (prefix, suffix, contains))
    out = []
    for c in columns:
        n = norm(c)
        if (any(n.startswith(p) for p in pre) or any(n.endswith(s) for s in suf)
                or any(s in n for s in sub)):
            out.append(c)
    return out


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """``select_dtypes('number')``."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def binary_columns(df: DataFrame, candidates: Sequence[str] | None = None) -> list[str]:
    """Columns whose non-null values all lie in {0, 1}.

    One aggregate job returns one boolean per column; an all-null column counts
    as binary (vacuous truth), as in the reference rule.
    """
    cands = list(candidates) if candidates is not None else numeric_columns(df)
    if not cands:
        return []
    exprs = [
        F.coalesce(F.bool_and(F.when(F.col(c).isNotNull(), F.col(c).isin(0, 1))),
                   F.lit(True)).alias(f"b{i}")
        for i, c in enumerate(cands)
    ]
    row = df.agg(*exprs).first()
    return [c for i, c in enumerate(cands) if row[f"b{i}"]]


def source_catalog(spark: SparkSession, sources: Mapping[str, Sequence[str]],
                   key: str | None = None) -> DataFrame:
    """Column -> source catalog (P15) as a DataFrame (source, column, position)."""
    rows = [(src, c, i) for src, cols in sources.items()
            for i, c in enumerate(cols) if c != key]
    return spark.createDataFrame(rows, "source string, column string, position int")


def source_counts(catalog: DataFrame) -> DataFrame:
    """Columns per source (P15): (source, n)."""
    return catalog.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def family_prune(columns: Sequence[str], prefixes: Sequence[str] = ("la", "tract"),
                 keep_any: Sequence[str] = ("share", "Tract"),
                 drop_any: Sequence[str] = ("number",),
                 scope: Iterable[str] | None = None) -> tuple[list[str], list[str]]:
    """Family pruning (P18): of the columns whose lower-cased name starts with
    one of ``prefixes``, keep those containing any of ``keep_any`` (case as
    written) and, lower-cased, none of ``drop_any``. Returns (kept, dropped).

    ``scope`` restricts the family to one source's columns (default: all
    columns, which reproduces the reference's behaviour, quirk Q1).
    """
    inside = None if scope is None else set(scope)

    def verdict(name: str) -> bool | None:  # None: not of the family
        low = name.lower()
        if (inside is not None and name not in inside) or not low.startswith(tuple(prefixes)):
            return None
        if any(term.lower() in low for term in drop_any):
            return False
        return any(term in name for term in keep_any)

    judged = [(name, verdict(name)) for name in columns]
    return [n for n, v in judged if v], [n for n, v in judged if v is False]


def assert_no_target(columns: Iterable[str], target: str) -> None:
    """Target-leak guard."""
    if target in set(columns):
        raise AssertionError(f"target {target!r} is among the feature columns")


def align_features(df: DataFrame, features: Sequence[str], fill_absent: bool = False,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` to a model's expected feature list.

    Absent features raise unless ``fill_absent`` — then they become 0.0 (the
    reference's silent behaviour, available only on request, quirk Q8).
    """
    have = set(df.columns)
    missing = [c for c in features if c not in have]
    if missing and not fill_absent:
        raise ValueError(f"features absent from the input: {missing}")
    cols = [F.col(c) for c in keep]
    cols += [F.col(c) if c in have else F.lit(0.0).alias(c) for c in features]
    return df.select(*cols)


def choice_filter(df: DataFrame, choices: Mapping[str, object], all_token: str = "All") -> DataFrame:
    """Equality filters from user choices (P4); a choice equal to ``all_token``
    (or None) applies no filter. Filter on keys, not on non-unique names."""
    for c, v in choices.items():
        if v is not None and v != all_token:
            df = df.where(F.col(c) == F.lit(v))
    return df
