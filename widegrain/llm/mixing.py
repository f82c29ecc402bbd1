"""Mixing sources to target weights (operator 4), DataFrame functions only.

Temperature mixing: a source with the share ``p`` of all tokens gets a weight
in proportion to ``p ** a``. The exponent is bisected between 0 (all sources
alike) and 1 (as they are): either the largest one whose weights reach a
target entropy, or the smallest one that repeats no source more often than a
limit. The weights are realised as budgeted block permutations: every source
is laid out as a sequence of epochs, each a permutation of its documents by a
seeded hash; block b takes from each source the next ``weight * block_tokens``
tokens, and the documents inside a block are permuted again.

The budget is the smallest one that takes every source whole at least once, so
no document is dropped: sources that are to weigh more are repeated.

Running token sums are taken within ranges of the permutation hash and shifted
by the sums of the ranges before, so a source of any size is spread over many
tasks; source sums are aggregated before they are shuffled, and the bisection
runs on the source table, a few levels per job, without collecting it. Texts
are read to count tokens and again to be joined with their places.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pinning import pinned

PARTS = 1_000_000_000  # weights are rounded to billionths, so that all later arithmetic is on integers
LEVELS = 4  # halvings of the bisection per job
BITS = 40  # halvings altogether
RANGE_ROWS = 20_000  # documents of a source aimed at per range of the permutation hash
ADDED = ("n_tokens", "mix_epoch", "mix_block", "mix_rank")


def token_count(text):
    """Words ([^\\x20\\x09-\\x0D]+); a text without words (or null) counts 1,
    so that every document takes its place in a block."""
    words = F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.greatest(words, F.lit(1)).cast("long")


def bisect_exponent(shares: DataFrame, target_entropy: float | None = None, max_epochs: float | None = None) -> float:
    """The exponent in [0, 1] for ``shares(p)``. ``target_entropy`` is a share
    of the largest possible entropy (the logarithm of the number of sources)
    and gives the largest exponent that still reaches it; ``max_epochs`` gives
    the smallest one whose most repeated source is seen at most so often; with
    both, the larger of the two counts, so the limit always holds."""
    def solve(holds, largest: bool) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(0, BITS, LEVELS):
            inner = [lo + (hi - lo) * k / 2 ** LEVELS for k in range(1, 2 ** LEVELS)]
            row = shares.agg(F.count(F.lit(1)).alias("n"), *[x for i, a in enumerate(inner) for x in (
                F.sum(F.pow("p", F.lit(a))).alias(f"z{i}"), F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"l{i}"),
                (F.max(F.pow("p", F.lit(a - 1))) / F.min(F.pow("p", F.lit(a - 1)))).alias(f"r{i}"))]).first()
            if not row["n"]:
                return 1.0
            true = [holds(a, row[f"z{i}"], row[f"l{i}"], row[f"r{i}"], row["n"]) for i, a in enumerate(inner)]
            k = sum(true) if largest else len(true) - sum(true)
            lo, hi = [lo, *inner][k], [*inner, hi][k]
        return lo if largest else hi

    answers = []
    if target_entropy is not None:
        answers.append(solve(lambda a, z, l, r, n: math.log(z) - a * l / z >= target_entropy * math.log(n), True))
    if max_epochs is not None:
        answers.append(solve(lambda a, z, l, r, n: r <= max_epochs, False))
    return max(answers, default=1.0)


def mixing_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                target_entropy: float | None = None, max_epochs: float | None = 2.0, block_tokens: int = 1_000_000,
                seed: int = 17) -> DataFrame:
    """One row per document and epoch that takes it: ``(id_col, source_col,
    text_hash, copies, n_tokens, mix_epoch, mix_block, mix_rank)``, with
    epochs and blocks from 0 and ranks from 1 within the block.

    * a null source is a source of its own; null ids and texts take part;
    * rows equal in id, source and text are one entry with their number in
      ``copies`` and the tokens of all; other rows that repeat an id stand
      for themselves, ties in the permutation go by the text's hash;
    * one source: weight 1, every row once; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    units = pinned(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               F.xxhash64(text).alias("text_hash"), token_count(F.col(text_col)).alias("n"))
                   .groupBy("id", "source", "text_hash", "n").agg(F.count(F.lit(1)).alias("copies"))
                   .withColumn("n", F.col("n") * F.col("copies")), "mix-units")
    sources = units.groupBy("source").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("entries"))
    whole = sources.agg(F.sum("tokens").alias("all_tokens"))
    sources = pinned(sources.join(F.broadcast(whole)).withColumn("p", F.col("tokens").cast("double") / F.col("all_tokens")),
                     "mix-sources")  # the broadcast is one row
    a = bisect_exponent(sources, target_entropy, max_epochs)
    z = sources.agg(F.sum(F.pow("p", F.lit(a))).alias("z"), F.max("entries").alias("most")).first()
    if z["most"] is None:
        a, z = 1.0, {"z": 1.0, "most": 0}
    big = "decimal(38,0)"
    weight = F.greatest(F.round(F.pow("p", F.lit(a)) / F.lit(z["z"]) * PARTS).cast("long"), F.lit(1))
    sources = sources.withColumn("w", weight)
    budget = sources.agg(F.max(F.expr(f"CAST(tokens AS {big}) * {PARTS} div w")).alias("budget")).first()["budget"]
    budget = int(budget or 0) + 1
    sources = sources.select(F.col("source").alias("s"), "w", "tokens",
                             F.expr(f"CAST(w AS {big}) * CAST({budget} AS {big}) div {PARTS}").cast("long").alias("target"))

    digits = max(0, math.ceil(math.log(max(1, z["most"]) / RANGE_ROWS, 16)))
    name = F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    laid = (units.join(sources, units["source"].eqNullSafe(sources["s"])).drop("s")
            .withColumn("epoch", F.explode(F.expr("sequence(0L, greatest(0L, (target - 1) div tokens))")))
            .withColumn("h", F.md5(name)).withColumn("range", F.substring("h", 1, digits)))
    sums = laid.groupBy("source", "epoch", "range").agg(F.sum("n").alias("range_tokens"))
    before = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("range").alias("g"),
                         F.coalesce(F.sum("range_tokens").over(before), F.lit(0)).alias("range_start"))
    inside = (Window.partitionBy("source", "epoch", "range").orderBy("h", "id", "text_hash", "n")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (laid.join(starts, laid["source"].eqNullSafe(starts["s"]) & (laid["epoch"] == starts["e"])
                        & (laid["range"] == starts["g"]))
              .withColumn("start", F.col("epoch") * F.col("tokens") + F.col("range_start")
                          + F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .where("start < target")
              .withColumn("block", F.expr(f"CAST(start AS {big}) * {PARTS} div (CAST(w AS {big}) * {block_tokens})")
                          .cast("long")))
    order = F.md5(F.concat_ws(":", F.lit("block"), F.lit(str(seed)), F.col("epoch").cast("string"),
                              F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rank = F.row_number().over(Window.partitionBy("block").orderBy(order, "epoch", "id", "text_hash", "source"))
    return placed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "text_hash", "copies",
                         F.col("n").alias("n_tokens"), F.col("epoch").cast("long").alias("mix_epoch"),
                         F.col("block").alias("mix_block"), rank.cast("long").alias("mix_rank"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                **settings) -> DataFrame:
    """The rows of ``docs`` with their places in the mixture (``n_tokens,
    mix_epoch, mix_block, mix_rank``), once per epoch that takes them; equal
    rows share a place. ``settings`` and defined cases: see ``mixing_plan``.
    Columns of ``docs`` with these names are replaced; the order of the
    mixture is ``ORDER BY mix_block, mix_rank``."""
    plan = mixing_plan(docs, id_col, text_col, source_col, **settings).select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("text_hash").alias("__hash"), *ADDED)
    passed = [c for c in docs.columns if c.lower() not in ADDED]
    rows = docs.select(*passed).withColumn("__own", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return rows.join(plan, rows[id_col].eqNullSafe(plan["__id"]) & rows[source_col].eqNullSafe(plan["__source"])
                     & (rows["__own"] == plan["__hash"])).select(*passed, *ADDED)
