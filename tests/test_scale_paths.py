"""The at-scale settings (many value ranges, many hash buckets, shuffle joins
instead of broadcasts) give the same results as the small ones on driver
tables."""

import pytest

from widegrain.operators import ranking as R
from widegrain.plans import registry

registry.load_all()

SCALE_SENSITIVE = ["describe_lineitem", "group_median_fill_part", "tiered_clean_part", "box_totalprice_by_status",
                   "reliability_clean_lineitem", "spearman_quantity_price", "split_orders", "folds_orders",
                   "permutation_importance_orders"]


def _rows(df):
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("name", SCALE_SENSITIVE)
def test_bucketed_paths_equal_small_paths(spark, sf_dir, monkeypatch, name):
    small = _rows(registry.QUERIES[name](spark, sf_dir))
    plain = R._value_ranges
    monkeypatch.setattr(R, "_value_ranges", lambda df, value, P, n: plain(df, value, P, 61))   # many value ranges
    monkeypatch.setattr(R, "BROADCAST_ROW_LIMIT", 0)        # every side table joins by shuffle
    monkeypatch.setattr(R, "_digits_for", lambda n, rows_per_bucket=0: 3)   # 4,096 hash buckets
    big = _rows(registry.QUERIES[name](spark, sf_dir))
    assert small == big
