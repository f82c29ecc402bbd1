"""Quality by co-training (operator 5).

Two classifiers look at different sides of a document: one at its text (the
counts of ``text_stats`` as ratios), one at its page metadata (source, language,
stated length). Each learns from the labelled rows; then, for some rounds,
each is calibrated on labelled rows kept aside, and the unlabelled rows it is
confident about become pseudo-labels for the other one's next fit. In the end
the two calibrated probabilities are combined as independent evidence and
every document is scored. A view that knows nothing is calibrated to the base
rate: it hands over no pseudo-labels and does not move the result.

The fits are Spark ML logistic regressions over all labelled and pseudo-
labelled rows; nothing is collected but coefficients.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pinning import pinned
from .quality_rules import RATIOS
from .text_stats import text_counts

SOURCES, LANGS = 16, 8  # hash buckets of the metadata view


def _text_view():
    ratios = [F.expr(e) for e in RATIOS.values()]
    # each ratio as it is and squashed, so that small shares tell as well
    return array_to_vector(F.array(*[F.log1p(r) for r in ratios], *[r / (r + 0.05) for r in ratios]))


def _meta_view(source: str | None, lang: str | None, length: str | None):
    def one_hot(col, size):
        if col is None:
            return [F.lit(0.0)] * size
        at = F.pmod(F.xxhash64(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(size))
        return [(at == k).cast("double") for k in range(size)]

    chars = F.greatest(F.coalesce(F.col(length).cast("double"), F.lit(0.0)), F.lit(0.0)) if length else F.lit(0.0)
    return array_to_vector(F.array(F.log1p(chars), F.pow(F.log1p(chars), F.lit(2.0)) / 10, *one_hot(source, SOURCES),
                                   *one_hot(lang, LANGS)))


def _logit(p):
    return F.log(p / (1 - p))


def co_train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             quality_col: str = "quality", source_col: str | None = "source", lang_col: str | None = "lang",
             length_col: str | None = "n_chars", rounds: int = 2, confident: float = 0.97, keep: float = 0.5) -> DataFrame:
    """One row per document: ``id_col, text_score, meta_score, score`` (the
    calibrated probability of good quality by each view and together) and
    ``kept`` (``score >= keep``).

    * null text counts as the empty one, null metadata as an empty value;
    * an id with several labels takes the lowest; null labels do not count;
    * a fifth of the labelled ids, by a hash, is set aside for calibration; a
      class that has none of it, or nothing else, moves its id of the smallest
      hash to the other side;
    * labels of one class only, or none, or a class with a single labelled id:
      every score is the share of good labels (0.5 without labels) and every
      row is kept;
    * null and repeated ids: every row is scored by its own content; other
      columns play no part; an empty table gives no rows.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
             .groupBy(F.col(id_col).alias("__labelled")).agg((F.min(quality_col) > 0).cast("double").alias("label")))
    meta = [c for c in (source_col, lang_col, length_col) if c]
    counted = text_counts(docs.select(F.col(id_col).alias("__id"), *[F.col(c).alias(f"__m{i}") for i, c in enumerate(meta)],
                                      F.col(text_col).alias("text")))
    names = {c: f"__m{i}" for i, c in enumerate(meta)}
    views = {"text": _text_view(), "meta": _meta_view(names.get(source_col), names.get(lang_col), names.get(length_col))}
    fold = F.pmod(F.crc32(F.coalesce(F.col("__id").cast("string"), F.lit(""))), F.lit(5))
    rows = pinned(counted.join(known, F.col("__id") == F.col("__labelled"), "left")
                  .select("__id", "label", (fold == 0).alias("aside"), *[v.alias(f"x_{k}") for k, v in views.items()]), "views")
    seen = rows.where("label IS NOT NULL").groupBy("label", "aside").count().collect()  # four rows at most
    n = sum(r["count"] for r in seen)
    prior = sum(r["count"] * r["label"] for r in seen) / n if n else 0.5
    for label in {r["label"] for r in seen if sum(x["label"] == r["label"] for x in seen) == 1}:
        own = F.coalesce(F.col("label") == label, F.lit(False))
        hashed = F.xxhash64("__id")
        least = rows.where(own).agg(F.min(hashed).alias("first"), F.max(hashed).alias("last")).first()
        if least["first"] != least["last"]:
            rows = rows.withColumn("aside", F.col("aside") != (own & (hashed == least["first"])))
            seen.append({"label": label, "moved": True})
    if len(seen) < 4:
        return rows.select(F.col("__id").alias(id_col), *[F.lit(prior).alias(c) for c in ("text_score", "meta_score", "score")],
                           F.lit(True).alias("kept"))

    def fitted(view, extra):
        """The view's model, calibrated: a function from rows to probabilities."""
        own = rows.where("label IS NOT NULL AND NOT aside").select("label", F.lit(1.0).alias("w"), f"x_{view}")
        if extra is not None:
            own = own.unionByName(extra.select("label", F.lit(0.5).alias("w"), f"x_{view}"))
        model = LogisticRegression(featuresCol=f"x_{view}", weightCol="w", maxIter=25, regParam=1e-3).fit(own)

        def margin(df):
            return model.transform(df).withColumn("m", vector_to_array("rawPrediction")[1])

        kept_aside = margin(rows.where("label IS NOT NULL AND aside")).select("label", array_to_vector(F.array("m")).alias("m1"))
        scale = LogisticRegression(featuresCol="m1", maxIter=25, regParam=1e-3).fit(kept_aside)
        a, b = float(scale.coefficients[0]), float(scale.intercept)
        return lambda df: (margin(df).withColumn(f"p_{view}", 1 / (1 + F.exp(-(F.lit(a) * F.col("m") + F.lit(b)))))
                           .drop("m", "rawPrediction", "probability", "prediction"))

    extra = {"text": None, "meta": None}
    for last in [False] * rounds + [True]:
        models = {view: fitted(view, extra[view]) for view in views}
        scored = models["meta"](models["text"](rows))
        if last:
            break
        scored = pinned(scored, "round")
        for view, other in (("text", "meta"), ("meta", "text")):
            sure = scored.where(f"label IS NULL AND (p_{other} >= {confident} OR p_{other} <= {1 - confident})")
            extra[view] = sure.withColumn("label", (F.col(f"p_{other}") >= confident).cast("double"))

    def inside(p):
        return F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))

    evidence = _logit(inside(F.col("p_text"))) + _logit(inside(F.col("p_meta"))) - math.log(prior / (1 - prior))
    return (scored.select(F.col("__id").alias(id_col), F.col("p_text").alias("text_score"), F.col("p_meta").alias("meta_score"),
                          (1 / (1 + F.exp(-evidence))).alias("score"))
            .withColumn("kept", F.col("score") >= keep))
