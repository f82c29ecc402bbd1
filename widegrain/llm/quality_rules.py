"""Quality rules: learned decision lists (operator 9).

Sequential covering over labelled text statistics: each rule is a conjunction
of threshold tests grown by information gain on two thirds of the labelled
rows, pruned from its end on the other third, and kept if it is precise there;
the low-quality rows it covers leave, and the next rule is grown. The list
becomes one ordered Spark expression (``CASE WHEN``) over the statistics of
every document. The rules are fitted on a bounded sample of labelled rows
(``max_labelled``); the statistics cover every whole text.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pinning import pinned
from .text_stats import text_counts

#: ratios that the rules test, as SQL over the counts
RATIOS = {
    "symbols_per_char": "n_symbols / greatest(word_chars, 1)",
    "upper_per_char": "n_upper / greatest(word_chars, 1)",
    "digits_per_char": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "stops_per_word": "n_stops / greatest(n_words, 1)",
    "repeats_per_word": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "words": "CAST(n_words AS DOUBLE)",
}
Rule = list[tuple[str, str, float]]  # (ratio, "<=" or ">", threshold), all of which hold


def _covers(rule: Rule, data: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for name, way, cut in rule:
        rows = rows[data[name][rows] <= cut] if way == "<=" else rows[data[name][rows] > cut]
    return rows


def _grow(data: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, max_tests: int) -> Rule:
    rule: Rule = []
    while len(rule) < max_tests:
        p, n = bad[rows].sum(), (~bad[rows]).sum()
        if not n:
            break
        base = math.log2(p / (p + n))
        best = (1e-9, None)
        for name, values in data.items():
            own = values[rows]
            cuts = np.unique(np.quantile(own, np.linspace(0.01, 0.99, 50)))
            order = np.argsort(own, kind="stable")
            good_hits = np.concatenate(([0], np.cumsum(bad[rows][order])))
            at = np.searchsorted(own[order], cuts, side="right")
            for way, pp, size in (("<=", good_hits[at], at), (">", p - good_hits[at], len(rows) - at)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / np.maximum(size, 1)) - base), 0)
                k = int(gain.argmax())
                if gain[k] > best[0] and size[k] < len(rows):
                    best = (gain[k], (name, way, float(cuts[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = _covers(rule[-1:], data, rows)
    return rule


def learn_rules(data: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 4,
                min_precision: float = 0.9, min_cover: int = 3) -> list[Rule]:
    """The ordered rules for the rows marked ``bad`` (a plain NumPy fit over
    the bounded sample). No bad row, or no good one: no rules."""
    rules: list[Rule] = []
    if not bad.any() or bad.all():
        return rules
    place = np.arange(len(bad)) % 3 == 2  # the sample comes in hash order
    grow, prune = np.flatnonzero(~place), np.flatnonzero(place)
    while len(rules) < max_rules and bad[grow].any():
        rule = _grow(data, bad, grow, max_tests)
        if not rule:
            break

        def worth(r):
            rows = _covers(r, data, prune)
            p = bad[rows].sum()
            return (2 * p - len(rows)) / max(1, len(rows)), p

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = _covers(rule, data, prune)
        if bad[hit].sum() < min_cover or bad[hit].sum() < min_precision * len(hit):
            break
        rules.append(rule)
        grow = np.setdiff1d(grow, _covers(rule, data, grow))
        prune = np.setdiff1d(prune, hit)
    return rules


def decision_list(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that fires, else 0."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = None
        for name, way, cut in rule:
            ratio = F.expr(RATIOS[name])
            one = ratio <= F.lit(cut) if way == "<=" else ratio > F.lit(cut)
            test = one if test is None else test & one
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  quality_col: str = "quality", max_labelled: int = 20_000) -> DataFrame:
    """One row per document: ``id_col``, the counts, ``base_failed``, the number
    of the ``rule`` that fired (0: none) and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in
    repeated three-word windows. ``kept`` is false there, else true unless a
    rule fires. Rules learn from rows that pass the base only.

    * null text counts as the empty one, which fails the base;
    * an id with several labels takes the lowest; null labels are left out;
    * no usable labels: no rules; null and repeated ids: every row is judged
      by its own text; an empty table gives no rows.
    """
    base = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    stats = pinned(text_counts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))), "text-counts")
    known = (labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(quality_col).alias("quality")))
    usable = pinned(stats.join(known, "id").where(f"NOT {base}")
                    .select("quality", F.md5(F.col("id").cast("string")).alias("h"), *[F.expr(e).alias(c) for c, e in RATIOS.items()]),
                    "labelled")
    # the smallest hashes lie below this place, with a margin; so no task hands on more than its share of them
    below = int(min(1.0, (1.5 * max_labelled + 1000) / max(1, usable.count())) * 16 ** 8)
    sample = (usable.where(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") < below)
              .orderBy("h", *RATIOS).limit(max_labelled).collect())  # at most max_labelled rows
    data = {c: np.array([r[c] for r in sample], float) for c in RATIOS}
    rules = learn_rules(data, np.array([r["quality"] == 0 for r in sample], bool)) if sample else []
    return (stats.withColumn("base_failed", F.expr(base)).withColumn("rule", decision_list(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)).withColumnRenamed("id", id_col))
