"""Driver-table queries for sources, sinks, fingerprints and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import pad_key
from ..models import pipeline as MP
from ..sources import io as IO
from .registry import register
from .tables import ORDER_FEATURE_COLS, load, order_features, pad_sql

_DRIVER_TABLES = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
                  "lineitem": 11, "events": 6, "documents": 5, "labels": 3, "embeddings": 3,
                  "pages": 3, "benchmark": 2, "conversations": 4}


@register("table_dimensions", "S15", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, {n} AS n_columns FROM {t}" for t, n in _DRIVER_TABLES.items()))
def table_dimensions(spark, sf):
    return IO.dimensions({t: load(spark, sf, t) for t in _DRIVER_TABLES})


_TYPE_FAMILY_SQL = """CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'integer' WHEN data_type = 'VARCHAR' THEN 'string'
 WHEN data_type IN ('DOUBLE', 'FLOAT') THEN 'double' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp'
 WHEN data_type LIKE '%[]' THEN 'array' ELSE lower(data_type) END"""


@register("schema_audit_driver_tables", "S14", sql=f"""
SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name, {_TYPE_FAMILY_SQL} AS dtype_family
FROM information_schema.columns
WHERE table_name IN ({', '.join(f"'{t}'" for t in _DRIVER_TABLES)})
""")
def schema_audit_driver_tables(spark, sf):
    a = IO.schema_audit({t: load(spark, sf, t) for t in _DRIVER_TABLES})
    fam = (F.when(F.col("dtype").isin("bigint", "int"), "integer").when(F.col("dtype") == "string", "string")
           .when(F.col("dtype").isin("double", "float"), "double")
           .when(F.col("dtype").startswith("timestamp"), "timestamp")
           .when(F.col("dtype").startswith("array"), "array").otherwise(F.col("dtype")))
    return a.select("table_name", "position", "column_name", fam.alias("dtype_family"))


#: every column of orders, as a text that both engines spell alike
_FP_TEXTS = ["CAST(o_orderkey AS STRING)", "CAST(o_custkey AS STRING)", "o_orderstatus",
             "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING)", "CAST(CAST(o_orderdate AS DATE) AS STRING)",
             "o_orderpriority"]


@register("fingerprint_orders", "S13", sql=f"""
WITH t AS (SELECT {', '.join(f"{e} AS c{i}" for i, e in enumerate(_FP_TEXTS))} FROM orders),
h AS (SELECT CAST(('0x' || substr(md5(concat_ws('|', {', '.join(
    f"coalesce(length(c{i}) || ':' || c{i}, '-')" for i in range(len(_FP_TEXTS)))})), 1, 12)) AS BIGINT) AS h FROM t)
SELECT count(*) AS n_rows, bit_xor(h) AS digest_xor, CAST(sum(h) AS VARCHAR) AS digest_sum FROM h
""")
def fingerprint_orders(spark, sf):
    rows = load(spark, sf, "orders").select(*[F.expr(e).alias(f"c{i}") for i, e in enumerate(_FP_TEXTS)])
    return IO.table_fingerprint(rows, method="md5")


@register("source_filter_purchases", "S10,S11,P3", sql="""
SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'
""")
def source_filter_purchases(spark, sf):
    ev = load(spark, sf, "events")
    return IO.source_filter(ev, "event_type", "purchase").select("event_id", "user_id", "value")


@register("csv_two_header_roundtrip", "S1,S2,S6,P7,P9", sql=f"""
SELECT {pad_sql('c_custkey')} AS cust_key, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer
""")
def csv_two_header_roundtrip(spark, sf):
    c = load(spark, sf, "customer").select(pad_key("c_custkey").alias("cust_key"), "c_name", "c_nationkey",
                                            "c_acctbal", "c_mktsegment")
    path = IO.scratch_path(spark, "two-header")
    IO.write_two_header_csv(c, path)
    return IO.read_two_header_csv(spark, path, key_cols=["cust_key"])


@register("model_reload_check", "S16")
def model_reload_check(spark, sf):
    d = order_features(spark, sf)
    pipe = MP.make_pipeline(ORDER_FEATURE_COLS, "revenue", "ridge", n_components=3)
    model = pipe.fit(d)
    return IO.verify_reload(model, IO.scratch_path(spark, "model"), d, "revenue")


@register("published_exploration_view", "S9,S7,S4,C6", sql="""
SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
""")
def published_exploration_view(spark, sf):
    prefix = "wg_"
    IO.publish(spark, {f"{prefix}documents": load(spark, sf, "documents").select("doc_id", "lang", "n_chars"),
                       f"{prefix}labels": load(spark, sf, "labels")})
    IO.require_tables(spark, [f"{prefix}documents", f"{prefix}labels"])
    IO.create_views(spark, f"{prefix}documents", f"{prefix}labels", "doc_id", prefix=prefix)
    return IO.read_table(spark, f"{prefix}exploration_view")


@register("sorted_parquet_roundtrip", "S6,S17,W4", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def sorted_parquet_roundtrip(spark, sf):
    path = IO.scratch_path(spark, "orders-sorted")
    IO.write_files(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
                   path, "parquet", sort_by=["o_orderkey"])
    return spark.read.parquet(path)
