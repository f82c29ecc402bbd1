"""Loading the driver's parquet tables and shared derived views.

Every derived view here is a pure projection of a driver table, so its work
grows with the table. Rules that inject nulls, flags or sentinels are written
once as SQL text and used both by Spark and by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(c, digits: int = 6):
    """Round a floating result (both sides of every oracle comparison round)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits)


def pad_sql(expr: str, width: int = 5) -> str:
    """SQL twin of ``functions.keys.pad_key``."""
    s = f"CAST({expr} AS STRING)"
    return f"(CASE WHEN length({s}) < {width} THEN lpad({s}, {width}, '0') ELSE {s} END)"


# Null / flag / sentinel injection rules (shared SQL text) ------------------- #

#: lineitem with columns carrying roughly 0/3/10/30/50/70 % injected nulls
LINEITEM_GAPS_SQL = {
    "l_quantity": "l_quantity",
    "tax_3": "CASE WHEN l_orderkey % 100 < 3 THEN NULL ELSE l_tax END",
    "disc_10": "CASE WHEN l_orderkey % 10 = 1 THEN NULL ELSE l_discount + 0.0 END",
    "price_30": "CASE WHEN l_orderkey % 10 < 3 THEN NULL ELSE l_extendedprice END",
    "line_50": "CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE l_linenumber END",
    "la_share_70": "CASE WHEN l_orderkey % 10 < 7 THEN NULL ELSE l_discount * 10 END",
}
LINEITEM_GAPS_TYPES = {
    "l_quantity": "double", "tax_3": "double", "disc_10": "double",
    "price_30": "double", "line_50": "int", "la_share_70": "double",
}


def lineitem_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey"), F.col("l_linenumber").alias("l_line"),
                     F.col("l_returnflag"),
                     *[F.expr(e).alias(c) for c, e in LINEITEM_GAPS_SQL.items()])


def lineitem_gaps_sql() -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in LINEITEM_GAPS_SQL.items())
    return f"(SELECT l_orderkey, l_linenumber AS l_line, l_returnflag, {cols} FROM lineitem)"


#: part with gaps for the tiered cleaner and the group-median fill
PART_GAPS_SQL = {
    "price_gap": "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END",
    "la_size_share": "CASE WHEN p_partkey % 10 < 3 THEN NULL ELSE CAST(p_size AS DOUBLE) / 50 END",
    "lafar_share": "CASE WHEN p_partkey % 10 < 7 THEN NULL ELSE CAST(p_size AS DOUBLE) END",
    "size_gap": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END",
    "size_gap7": "CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END",
}


def part_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", "p_type", "p_name", *[F.expr(e).alias(c) for c, e in PART_GAPS_SQL.items()])


def part_gaps_sql() -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in PART_GAPS_SQL.items())
    return f"(SELECT p_partkey, p_type, p_name, {cols} FROM part)"


#: lineitem shaped like a flagged benchmark table: raw values, tri-state
#: quality flags (null / 1 / 2), confidence bounds and a numerator
FLAGGED_SQL = {
    "v1_rawvalue": "l_quantity",
    "v1_flag": "CASE WHEN l_orderkey % 5 < 2 THEN 2 WHEN l_orderkey % 5 = 2 THEN 1 ELSE NULL END",
    "v1_cilow": "l_quantity * 0.9",
    "v1_numerator": "l_extendedprice",
    "v2_rawvalue": "CASE WHEN l_orderkey % 10 = 3 THEN NULL ELSE l_discount + 0.0 END",
    "v2_flag": "CASE WHEN l_orderkey % 9 = 0 THEN 2 ELSE NULL END",
    "v3_rawvalue": "CASE WHEN l_orderkey % 10 < 7 THEN NULL ELSE l_tax + 0.0 END",
}


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", *[F.expr(e).alias(c) for c, e in FLAGGED_SQL.items()])


def flagged_sql() -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in FLAGGED_SQL.items())
    return f"(SELECT l_orderkey, {cols} FROM lineitem)"


#: per-order modelling table: lineitem joined to part, rolled up per order
ORDER_FEATURES_SQL = """(SELECT l_orderkey, sum(l_extendedprice) / 1000 AS revenue, sum(l_quantity) / 100 AS sum_qty,
  CAST(count(*) AS DOUBLE) AS n_lines, avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax,
  avg(p_retailprice) / 1000 AS avg_retail
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""

ORDER_FEATURE_COLS = ["sum_qty", "n_lines", "avg_disc", "avg_tax", "avg_retail"]


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return j.groupBy("l_orderkey").agg(
        (F.sum("l_extendedprice") / 1000).alias("revenue"), (F.sum("l_quantity") / 100).alias("sum_qty"),
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.avg("l_discount").alias("avg_disc"),
        F.avg("l_tax").alias("avg_tax"), (F.avg("p_retailprice") / 1000).alias("avg_retail"))
