"""widegrain — PySpark library for preparing, profiling, cleaning, modelling and
explaining wide keyed tables that arrive from several sources at different
grains.

Every operator is a DataFrame -> DataFrame function, generic in table and column
names. Data-dependent schemas (column drops, role sets) follow a two-phase
*profile -> plan -> project* shape: a tiny profile job (one row per column) is
collected, then a single projection is built from it.

Where to start:

* ``widegrain.plans.pipelines`` — the user-level steps: ``prepare_long_measures``,
  ``prepare_fine_grain``, ``prepare_flagged``, ``prepare_keyed``, ``merge_master``,
  ``engineer``/``split``, ``profile_report``, ``model_report``, ``entity_profile``;
* ``widegrain.operators`` — reshape, profile, clean, ranking (exact skew-safe ranks
  and quantiles), stats (correlations), explain (permutation, Shapley);
* ``widegrain.models`` — Spark ML stages and pipelines with sklearn conventions;
* ``widegrain.sources.io`` — scans, sinks, catalog, fingerprints, model reload.
"""

__version__ = "0.1.0"
