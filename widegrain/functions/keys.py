"""Key scalars: zero padding that never truncates, prefixes, key validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_key(c, width: int = 5) -> Column:
    """Left-pad a key with zeros to ``width`` characters, never truncating.

    Spark's ``lpad`` cuts longer input; ``zfill`` semantics keep it, so the pad
    is applied only when the text is shorter than ``width``. Null stays null.
    """
    s = _col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def key_prefix(c, n: int = 5) -> Column:
    """First ``n`` characters of a key (e.g. tract -> county)."""
    return F.substring(_col(c).cast("string"), 1, n)


def key_check(df: DataFrame, key: str, width: int = 5) -> DataFrame:
    """One-row validation of a key column: type, null count and length range.

    ``ok`` is true when the column is a string and every non-null value has
    exactly ``width`` characters.
    """
    is_string = dict(df.dtypes)[key] == "string"
    length = F.length(F.col(key).cast("string"))
    return df.agg(
        F.lit(key).alias("key"),
        F.lit(is_string).alias("is_string"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(key).isNull()).alias("n_null"),
        F.min(length).alias("min_len"),
        F.max(length).alias("max_len"),
        F.count_if(length != width).alias("n_bad_len"),
    ).withColumn("ok", F.col("is_string") & (F.col("n_bad_len") == 0))
