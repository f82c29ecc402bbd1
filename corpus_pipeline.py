"""The corpus pipeline: five stages over ``documents``, each an operator of
``widegrain.llm``. Every stage takes ``(spark, docs, sf_dir)`` and returns a
DataFrame; all but the last return the columns of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widegrain.llm import byte_bpe, language_id, line_dedup, mixing, near_duplicates
from widegrain.llm.pinning import Scratch

#: documents without letters are rejected, and those whose best language has
#: less than this share of the scores (a text in an unlearned language)
MIN_LANGUAGE_SCORE = 0.3


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification rejects; the columns
    of those that stay are as they were."""
    told = language_id.identify(_beside(docs, "doc_id", "text", "lang"))
    kept = told.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*_own(docs, "doc_id", "text", "lang"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; ``n_chars`` follows the
    text. A document that loses lines and is left without a word goes: all it
    had stands in earlier documents."""
    out = line_dedup.dedup_lines(_beside(docs, "doc_id", "text"))
    out = out.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        own = F.col("own_n_chars")
        out = out.withColumn("own_n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(own))
    return out.select(*_own(docs, "doc_id", "text"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (shingles of five
    words, a similarity of 0.8 or more), the smallest id."""
    kept = near_duplicates.near_duplicates(docs.select("doc_id", "text"), width=5, share=80).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"])).select(*[docs[c] for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of smaller sources until the mixture has its weights;
    no document goes. The rows are not laid out in the order of the mixture's
    blocks: that order is ``mixing.mixing_plan``'s ``mix_block, mix_rank``."""
    plan = mixing.mixing_plan(docs.select("doc_id", "text", "source")).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_hash").alias("__content"))
    same = (docs["doc_id"].eqNullSafe(plan["__id"]) & docs["source"].eqNullSafe(plan["__source"]) & (_content("text") == plan["__content"]))
    return docs.join(plan, same).select(*[docs[c] for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mixture."""
    import public_tokenizers
    return byte_bpe.byte_bpe(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                             public_tokenizers.PATTERN)


def _content(text: str):
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _beside(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with the columns that an operator does not use out of its way."""
    return docs.select(*used, *[F.col(c).alias(f"own_{c}") for c in docs.columns if c not in used])


def _own(docs: DataFrame, *used: str) -> list:
    """The columns of ``docs`` again."""
    return [F.col(c) if c in used else F.col(f"own_{c}").alias(c) for c in docs.columns]


STAGES = [("language_id", languages), ("line_dedup", lines), ("near_duplicates", near_copies),
          ("source_mixing", mixture), ("byte_bpe", tokens)]

#: language identification and byte-pair encoding are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again; what
    a stage wrote on its way goes when its result stands."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with Scratch(spark) as scratch:
            docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
