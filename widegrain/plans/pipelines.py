"""User-level compositions (C1-C10): each chains library operators into the
steps a user of the reference runs, generic in table and column names.

All return DataFrames (or dicts of them); nothing here collects data rows —
only one-row profiles and p x p matrices reach the driver inside operators.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import align_features, assert_no_target, binary_columns, choice_filter, family_prune, numeric_columns
from ..functions.keys import key_prefix, pad_key
from ..functions.scalars import coerce_numeric, mean_of_two, row_argmax
from ..operators import clean as C
from ..operators import explain as X
from ..operators import profile as P
from ..operators import ranking as R
from ..operators import reshape as RS
from ..operators import stats as S
from ..session import cut_lineage
from ..sources import io as IO


# C1 ------------------------------------------------------------------------ #
def prepare_long_measures(df: DataFrame, key: str, measure: str, value: str, measures: Sequence[str],
                          labels: Sequence[str] = (), key_width: int = 5, drop_cols: Sequence[str] = (),
                          source_filter: tuple[str, object] | None = None,
                          rename: Mapping[str, str] | None = None) -> DataFrame:
    """Long measures -> one wide row per key (C1): source filter (S10), drop
    columns (P1), drop null values (P2), keep requested measures (P3), mean
    pivot with a completeness check (A1, A2), pad the key (P7), numeric cast
    (P9), rename (P5). ``labels`` are part of the row's key, as in a pivot whose
    index holds them: a key with two names gives two rows, and rows with a null
    in key or labels belong to none."""
    d = df
    if source_filter is not None:
        d = d.where(F.col(source_filter[0]) == F.lit(source_filter[1]))
    d = d.drop(*drop_cols).na.drop(subset=[value]).where(F.col(measure).isin(list(measures)))
    d = d.withColumn(value, coerce_numeric(value))
    index = [key, *labels]
    wide = RS.pivot_mean(d.na.drop(subset=index), index, measure, value, list(measures))
    wide = wide.withColumn(key, pad_key(key, key_width))
    return wide.withColumnsRenamed(dict(rename)) if rename else wide


# C2 ------------------------------------------------------------------------ #
def prepare_fine_grain(df: DataFrame, fine_key: str, weight: str, group: str, coarse_len: int = 5,
                       coarse_key: str = "fipscode", label_cols: Sequence[str] = (),
                       rate_suffix: str = "share", extra_rates: Sequence[str] = (),
                       policy: C.MissingPolicy = C.MissingPolicy()) -> DataFrame:
    """Fine grain (e.g. tract) -> coarse grain (county) (C2): tiered cleaning
    (I1), coarse key = key prefix (P8), role detection — 0/1 flags by content
    (P11), rates by suffix, counts = remaining numeric — and one role-aware
    roll-up (A5), key padded (P7)."""
    clean = C.tiered_clean(df, group, policy, protect=[fine_key, weight, *label_cols])
    d = clean.withColumn(coarse_key, key_prefix(fine_key, coarse_len))
    ids = {fine_key, coarse_key, group, *label_cols}
    num = [c for c in numeric_columns(d) if c not in ids]
    flags = binary_columns(d, [c for c in num if c != weight])
    rates = [c for c in num if (c.endswith(rate_suffix) or c in set(extra_rates)) and c not in flags]
    counts = [c for c in num if c not in set(flags) | set(rates)]
    out = RS.weighted_rollup(d, coarse_key, weight, flags=flags, rates=rates, counts=counts,
                             labels=[group, *label_cols], label_order=fine_key, n_rows_col=None)
    return out.withColumn(coarse_key, pad_key(coarse_key, coarse_len))


# C3 ------------------------------------------------------------------------ #
def prepare_flagged(df: DataFrame, key: str, named_col: str | None = None, recode_cols: Sequence[str] = (),
                    key_width: int = 5) -> dict[str, DataFrame]:
    """Flagged benchmark table (C3): pad key, the I2 -> I5 -> I4 -> I3 -> P17
    chain (I6), key first (P6). Sorting by key (W4) is left to the sink."""
    d = df.withColumn(key, pad_key(key, key_width))
    final, meta, feats = C.clean_flagged(d, key, named_col=named_col, recode_cols=recode_cols)
    first = lambda t: t.select(key, *[c for c in t.columns if c != key])
    return {"final": first(final), "metadata": first(meta), "features": first(feats)}


# C4 ------------------------------------------------------------------------ #
def prepare_keyed(df: DataFrame, key: str, required: Sequence[str] = (), rename: Mapping[str, str] | None = None,
                  key_width: int = 5) -> DataFrame:
    """Small keyed table (C4): pad key (P7), drop rows missing a required
    value (P2), rename (P5)."""
    d = df.withColumn(key, pad_key(key, key_width))
    if required:
        d = d.na.drop(subset=list(required))
    return d.withColumnsRenamed(dict(rename)) if rename else d


# C5 ------------------------------------------------------------------------ #
def merge_master(frames: Sequence[DataFrame], key: str, key_width: int = 5,
                 method: str = "split") -> tuple[DataFrame, DataFrame]:
    """Master merge (C5): pad every key (P7), N-way full outer join with
    reconciled duplicate names (J1, P22), duplicate-key report (A17).
    Returns (master, duplicate keys); a warning is raised when any exist.
    ``method="union"`` merges in one shuffle when each source has one row per
    key (a repeated key then raises instead of warning)."""
    padded = [f.withColumn(key, pad_key(key, key_width)) for f in frames]
    master = cut_lineage(RS.outer_merge(padded, key, method=method))   # merged once, for the report and the caller
    dups = master.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if dups.limit(1).count():
        warnings.warn("duplicate keys after the merge", stacklevel=2)
    return master, dups


# C7 ------------------------------------------------------------------------ #
def engineer(df: DataFrame, target: str, mean_pairs: Mapping[str, tuple[str, str]] = (),
             drop_after_mean: bool = True, family_prefixes: Sequence[str] = ("la", "tract"),
             keep_any: Sequence[str] = ("share", "Tract"), drop_any: Sequence[str] = ("number",),
             family_scope: Sequence[str] | None = None) -> DataFrame:
    """Feature engineering (C7): rows with a target (P2), consensus means of
    column pairs (P13), family pruning (P18)."""
    d = df.na.drop(subset=[target])
    used = []
    for new, (a, b) in dict(mean_pairs).items():
        d = d.withColumn(new, mean_of_two(a, b))
        used += [a, b]
    if drop_after_mean and used:
        d = d.drop(*used)
    _, dropped = family_prune(d.columns, family_prefixes, keep_any, drop_any, scope=family_scope)
    return d.drop(*dropped)


def split(df: DataFrame, key: str, target: str, test_fraction: float = 0.2, seed: int = 42) -> dict[str, DataFrame]:
    """Exact-size seeded split (W12) into x/y train/test with the leak guard
    (P19); the key stays a string column in every part (Q7)."""
    s = R.exact_split(df, [key], test_fraction, seed)
    feats = [c for c in df.columns if c not in (target,)]
    assert_no_target([c for c in feats if c != key], target)
    out = {}
    for part in ("train", "test"):
        p = s.where(F.col("split") == part)
        out[f"x_{part}"] = p.select(*feats)
        out[f"y_{part}"] = p.select(key, target)
    return out


# C8 ------------------------------------------------------------------------ #
def profile_report(df: DataFrame, target: str, key: str, k_top: int = 20, heat_k: int = 10,
                   heat_by: str = "position", sources: Mapping[str, Sequence[str]] | None = None,
                   train: DataFrame | None = None, test: DataFrame | None = None) -> dict[str, DataFrame]:
    """Data behind the profile report (C8); ``sources`` (columns per source),
    ``train`` and ``test`` go into its header (A29)."""
    num = [c for c in numeric_columns(df) if c != key]
    prof = P.null_profile(df)
    corr = S.corr_with_target(df, target, num)
    ordered = [r["column_name"] for r in corr.orderBy("position").select("column_name").collect()]
    strengths = {r["column_name"]: r["r"] for r in corr.collect()} if heat_by == "strength" else None
    heat = S.heatmap_columns(ordered, heat_k, target, heat_by, strengths)
    return {
        "header": P.report_header(df, target, sources, train, test),
        "null_profile": prof,
        "missing_bins": P.tier_counts(prof, "right"),
        "overall_missing": P.overall_missing_pct(df),
        "duplicates": P.duplicate_summary(df, [key]),
        "target_describe": P.describe(df, [target]),
        "target_histogram": P.histogram(df, target, 40),
        "target_kde": P.kde(df, target, 50),
        "correlations": corr,
        "top_correlations": S.top_correlations(corr, k_top),
        "leakage": S.leakage_screen(corr),
        "heatmap": S.corr_matrix(df, heat),
    }


# C9 ------------------------------------------------------------------------ #
def model_report(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str,
                 candidates: Mapping[str, object], k: int = 5, seed: int = 42, n_repeats: int = 15,
                 n_background: int = 100, parallelism: int = 2, grids: Mapping[str, list] | None = None,
                 baseline=None, save_to: str | None = None) -> dict[str, DataFrame]:
    """Data behind the modelling report (C9): CV of the candidates on
    identical folds (M18), tuning of the best over ``grids[name]`` (M19, as for
    ``grid_search``; none: it is refitted as it is) on all training rows,
    train/test scores (M28) beside those of the linear ``baseline`` pipeline
    (the candidate ``linear`` or the shared pipeline) and of the mean (M31), residual summary (A28), largest errors (W7), permutation
    importance (M21), Shapley mean |φ| (M22) and their rank agreement (M23).
    With ``save_to`` the chosen model is saved there, read back and checked
    against itself on the test rows (S16, ``reload``)."""
    from ..models import pipeline as MP
    folded = R.kfold_assign(train, [key], k, seed)
    per_fold, summary = MP.cross_validate(folded, candidates, label, "fold", parallelism=parallelism)
    best_row = summary.orderBy(F.col("r2_mean").desc(), "model").first()
    best = best_row["model"]
    linear = (baseline or candidates.get("linear") or MP.make_pipeline(features, label, "linear")).fit(train)
    cv_row = summary.where(F.col("model") == best).select(
        F.lit(None).cast("long").alias("n"), F.col("r2_mean").alias("r2"), F.col("rmse_mean").alias("rmse"),
        F.col("mae_mean").alias("mae"), F.lit("cv").alias("split"))
    tuned = {}
    if grids and grids.get(best):
        search, tuned["tuning"] = MP.grid_search(folded, candidates[best], grids[best], label, "fold", parallelism)
        model = search.bestModel
        cv_row = cv_row.withColumns({"r2": F.lit(float(max(search.avgMetrics))), "rmse": F.lit(None).cast("double"),
                                     "mae": F.lit(None).cast("double")})
    else:
        model = candidates[best].fit(train)
    if save_to is not None:
        tuned["reload"] = IO.verify_reload(model, save_to, test, label)
    pred_tr, pred_te = model.transform(train), model.transform(test)
    scores = MP.score_table({"train": pred_tr, "test": pred_te, "baseline_test": linear.transform(test),
                             "mean_baseline_test": MP.mean_baseline(train, test, label)}, label)
    scores = scores.unionByName(cv_row)
    resid = MP.residual_summary(pred_te, label)
    errors = R.top_k(pred_te.select(key, label, "prediction",
                                    F.abs(F.col(label) - F.col("prediction")).alias("abs_error")),
                     "abs_error", 10, tiebreak=[key])
    imp, _ = X.permutation_importance(model, test, features, label, key, n_repeats, seed)
    bg = R.seeded_sample(train, [key], n_background, seed)
    phi = X.shapley_values(model, test, features, key, bg, seed=seed)
    shap = X.mean_abs_attribution(phi)
    both = imp.join(shap, "feature")
    top = R.top_k(both, "importance_mean", 20, tiebreak=["feature"])
    agreement = (S.spearman(both, "importance_mean", "mean_abs_phi").withColumn("scope", F.lit("all"))
                 .unionByName(S.spearman(top, "importance_mean", "mean_abs_phi").withColumn("scope", F.lit("top20"))))
    return {"cv_per_fold": per_fold, "cv_summary": summary, "scores": scores, "residuals": resid,
            "largest_errors": errors, "permutation_importance": imp, "shapley": shap,
            "importance_agreement": agreement, **tuned}


# C10 ----------------------------------------------------------------------- #
def score_entities(model, df: DataFrame, features: Sequence[str], key: str, fill_absent: bool = False) -> DataFrame:
    """Every entity scored by a fitted model (M20): its columns aligned to the
    model's features (P16), then (key, prediction). A feature that is absent
    raises unless ``fill_absent``, and so does a row that cannot be scored: no
    prediction is replaced by an observed value."""
    return model.transform(align_features(df, features, fill_absent, keep=[key])).select(key, "prediction")


def entity_profile(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], driver_cols: Sequence[str],
                   entity: str | None = None, model=None, features: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Entity explorer (C10): optional filter on one key value (P4, by key —
    names are not unique), side-by-side comparison of two tables (J5, P14),
    the row-wise top driver among named columns (W9) and, with a ``model``, the
    entity's score (M20)."""
    a, b = choice_filter(a, {key: entity}), choice_filter(b, {key: entity})
    v, name = row_argmax(list(driver_cols))
    out = {"side_by_side": RS.side_by_side(a, b, key, fields),
           "top_driver": a.select(key, v.alias("top_value"), name.alias("top_driver"))}
    if model is not None:
        out["score"] = score_entities(model, a, features, key)
    return out
