"""Physical-plan properties the library relies on at scale: one shuffle per
aggregate, pruned scans with pushed filters, no cartesian products, broadcast
only where bounded."""

import re

from widegrain.plans import registry

registry.load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan, pat):
    return len(re.findall(pat, plan))


def test_pivot_is_one_partial_aggregate_and_one_shuffle(spark, sf_dir):
    p = _plan(registry.QUERIES["pivot_quantity_by_returnflag"](spark, sf_dir))
    assert _count(p, r"Exchange hashpartitioning") == 1
    assert "partial_avg" in p
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_returnflag:string>", p)


def test_rollup_reads_lineitem_once(spark, sf_dir):
    p = _plan(registry.QUERIES["rollup_lineitem_to_supplier"](spark, sf_dir))
    assert _count(p, r"FileScan parquet") == 1
    assert _count(p, r"Exchange hashpartitioning") == 1


def test_union_merge_shuffles_the_sources_once_more_at_most(spark, sf_dir):
    p = _plan(registry.QUERIES["outer_merge_customer_sources"](spark, sf_dir))
    # two per-source aggregates + one merge aggregate; no join operators
    assert _count(p, r"Exchange hashpartitioning") == 3
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p


def test_source_filter_is_pushed_to_the_scan(spark, sf_dir):
    p = _plan(registry.QUERIES["source_filter_purchases"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[IsNotNull\(event_type\), EqualTo\(event_type,purchase\)\]", p)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p


def test_no_cartesian_products_anywhere(spark, sf_dir):
    for name in ["kde_retailprice", "histogram_retailprice", "box_totalprice_by_status", "split_orders",
                 "describe_lineitem", "shapley_linear_orders", "permutation_importance_orders"]:
        p = _plan(registry.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
