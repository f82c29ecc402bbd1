"""Bench: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print ONE JSON line.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected); profile jobs a query runs while planning are included in
its time. Every timed query first runs once on the smallest scale as a
warm-up (JIT, Python workers), not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "pivot_quantity_by_returnflag",
    "rollup_lineitem_to_supplier",
    "outer_merge_customer_sources",
    "null_profile_lineitem",
    "describe_lineitem",
    "group_median_fill_part",
    "reliability_clean_lineitem",
    "split_orders",
    "target_correlations",
    "correlation_matrix_lineitem",
    "spearman_quantity_price",
    "row_argmax_lineitem",
    "regression_scores",
    "permutation_importance_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from widegrain.plans import registry
    from widegrain.session import local_session

    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="widegrain-bench")
    registry.load_all()
    only = [q for q in sys.argv[1:] if q in registry.QUERIES] or HEADLINE

    # warm-up (JIT, Python workers): every timed query once on the smallest scale, not counted
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in only:
        registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in only:
        t0 = time.perf_counter()
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    # model-selection timing comparable to the published per-fold fit times
    extra = {}
    if not sys.argv[1:]:
        from widegrain.models import foldfits as FF
        from widegrain.models import pipeline as MP
        from widegrain.models import svrfits as SF
        from widegrain.models import treefits as TF
        from widegrain.operators.ranking import kfold_assign
        from widegrain.plans.tables import ORDER_FEATURE_COLS, order_features
        shared = {"alpha": 0.0055, "n_components": 3}
        t0 = time.perf_counter()
        moments = FF.fold_moments(kfold_assign(order_features(spark, sf_dir), ["l_orderkey"], 5, 42), ORDER_FEATURE_COLS, "revenue", "fold")
        _, summary = FF.linear_scores(moments, {k: {"kind": k, **shared} for k in ["linear", "ridge", "elasticnet"]})
        rows = {r["model"]: r for r in summary.collect()}
        times["cv_5fold_3_linear_models"] = round(time.perf_counter() - t0, 3)
        for k, r in rows.items():
            extra[f"cv_r2_{k}"] = round(r["r2_mean"], 4)
        # all six candidates on the smallest table, whose row count is near that of the published fit times
        small = FF.fold_moments(kfold_assign(order_features(spark, warm_dir), ["l_orderkey"], 5, 42), ORDER_FEATURE_COLS, "revenue", "fold")
        runs = {
            "linear_ridge_elasticnet": lambda: FF.cross_validate_linear(small, {k: {"kind": k, **shared} for k in ["linear", "ridge", "elasticnet"]}),
            "svr_rbf": lambda: SF.cross_validate_svr(small, {"svr_rbf": {}}, **shared),
            "forest": lambda: TF.cross_validate_trees(small, {"forest": ("forest", MP.FOREST)}, **shared),
            "gbt": lambda: TF.cross_validate_trees(small, {"gbt": ("gbt", MP.DEFAULTS["gbt"])}, **shared),
        }
        for name, run in runs.items():
            t0 = time.perf_counter()
            run()
            extra[f"small_cv_sec_per_fold_{name}"] = round((time.perf_counter() - t0) / 5, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "extra": extra, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
