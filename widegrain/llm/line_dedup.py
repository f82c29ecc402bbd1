"""Line dedup across documents (operator 2), DataFrame functions only.

Lines are exploded with their position, normalised and hashed; documents are
counted per hash; lines of a hash found in ``min_docs`` documents or more are
dropped everywhere but in the smallest id that holds it, and the texts are put
together again by position. Only hashes, ids and positions are shuffled by
line; texts move once, to meet the positions to drop. A very common line is
pre-aggregated on the map side; where the lines meet their counts, lines of a
hash that holds more than its share of the rows take the smallest id from a
broadcast table and are spread over all tasks by a salt. By its definition that
table has at most ``HOT_PER_TASK`` times the shuffle partitions rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pinning import pinned

#: fixed value: the blanks [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"
#: a hash is hot from a share of 1 / (HOT_PER_TASK * shuffle partitions) of the common lines on
HOT_PER_TASK = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text):
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line):
    """The normalised line: blanks stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                min_chars: int = 10) -> DataFrame:
    """The rows of ``docs`` with ``text_col`` replaced by the lines that stay,
    and two more columns: ``n_lines`` (before dropping) and ``n_dropped``.

    * null or empty text: one empty line, which is too short to be dropped;
      the resulting text is the empty string;
    * a text whose lines are all dropped becomes the empty string;
    * null id: the row is left as it is and does not count as a document;
    * rows that repeat an id count as one document and treat lines alike;
    * within the smallest id all lines of the key stay, repeated ones as well;
    * columns named ``n_lines`` or ``n_dropped`` are replaced, all others pass
      through; an empty table gives an empty result.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    text = F.col(text_col)
    # rows that repeat an id with other texts keep their own positions
    lines = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("__id"), F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))).alias("__row"),
                     F.posexplode(_lines(text)).alias("__pos", "__line"))
             .select("__id", "__row", "__pos", line_key(F.col("__line")).alias("__key"))
             .where(F.length("__key") >= min_chars)
             # 128 bits: two hashes chained from different starts
             .select("__id", "__row", "__pos", F.xxhash64("__key").alias("__h1"),
                     F.xxhash64(F.lit("second"), "__key").alias("__h2")))
    n_rows = F.count(F.lit(1)).alias("__n_rows")
    if min_docs == 2:  # at least two distinct ids: the smallest and the largest differ
        common = (lines.groupBy("__h1", "__h2").agg(F.min("__id").alias("__first"), F.max("__id").alias("__last"), n_rows)
                  .where(F.col("__first") != F.col("__last")))
    else:
        common = (lines.groupBy("__h1", "__h2").agg(F.min("__id").alias("__first"), F.count_distinct("__id").alias("__n"), n_rows)
                  .where(F.col("__n") >= min_docs))
    common = pinned(common.select("__h1", "__h2", "__first", "__n_rows"), "common-lines")
    all_rows = common.agg(F.sum("__n_rows")).first()[0] or 0
    most_hot = HOT_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col("__n_rows") * most_hot > all_rows  # so at most most_hot hashes are: a proven bound
    hot = common.where(is_hot).select("__h1", "__h2", F.col("__first").alias("__hot_first"))
    cold = common.where(~is_hot).select("__h1", "__h2", F.lit(0).alias("__salt"), "__first")
    # hot lines have their smallest id already; a salt of their own keeps them off one task
    salt = F.when(F.col("__hot_first").isNull(), 0).otherwise(F.pmod(F.xxhash64("__id", "__pos"), F.lit(1 << 20)).cast("int") + 1)
    first = F.coalesce("__hot_first", "__first")
    drops = (lines.join(F.broadcast(hot), ["__h1", "__h2"], "left").withColumn("__salt", salt)
             .join(cold, ["__h1", "__h2", "__salt"], "left")
             .where(first.isNotNull() & (F.col("__id") != first))
             .groupBy("__id", "__row").agg(F.collect_set("__pos").alias("__drops")))
    keyed = docs.withColumn("__id", F.col(id_col)).withColumn(
        "__row", F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    joined = keyed.join(drops, ["__id", "__row"], "left")
    parts = _lines(text)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__drops"))
    kept = F.when(F.col("__drops").isNull(), F.coalesce(text.cast("string"), F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n"))
    return (joined.withColumns({
        "n_lines": F.size(parts).cast("long"),
        "n_dropped": F.coalesce(F.size("__drops"), F.lit(0)).cast("long"),
        text_col: kept}).select(*[c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")],
                                "n_lines", "n_dropped"))
