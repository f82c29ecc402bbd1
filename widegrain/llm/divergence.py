"""Divergence of sources within a language, by columnar counts (operator 11).

Tasks count terms in Arrow: a batch of texts is lower-cased, split by a
regular expression, dictionary-encoded and grouped by a hash aggregation, and
what a task has counted is folded together whenever it grows beyond a bound.
Partial counts travel as columnar shards, one Arrow table per language and
range of term hashes, so that Spark moves few rows; the shards of one key are
merged, which tells the documents of each term, and only the terms that a
language keeps go on. These are cut into shards of terms that hold every
group's counts, and give the shard's part of the divergence of every two
sources and its best terms per group. A hot source, language or term is one
row per task in whatever is shuffled.

All arithmetic is on integers: the share of a term in N occurrences of V terms
is ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pinning import pinned

# What parts terms (every ASCII character but letters), the
# smoothing count and the unit of shares.
NOT_TERM = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SMOOTH = 5
UNIT = 1_000_000_000

SLICE_BYTES = 8_000_000  # of texts split at once
HELD_ROWS = 1_000_000  # counts that a task holds before it hands them on
SHARD_DOCS = 4_000  # documents per shard of a language aimed at while merging
SHARDS = 4_096  # at most
SHARD_CELLS = 4_000_000  # counts (groups x terms) of a shard aimed at while comparing
_GROUPS = -1  # the shard that tells which sources a language has
_COLUMNS = ["source", "term", "n", "docs"]
_SHARD = "lang string, shard int, counts binary"
_KEPT = "lang string, source string, term string, n long"
_PARTS = "lang string, part string, source string, item string, value long"


def _slices(batch: pa.RecordBatch):
    """Runs of rows with about ``SLICE_BYTES`` of text; a longer text stands alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if batch.num_rows > start:
        yield batch.slice(start)


def _folded(parts: list[pa.Table], keys: list[str]) -> pa.Table:
    """Counts of equal keys added up by a hash aggregation."""
    return (pa.concat_tables(parts).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")])
            .rename_columns([*keys, "n", "docs"]))


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term) of some rows; the
    empty term stands for the group itself."""
    lang, source, text = (pc.fill_null(batch.column(c), "") for c in ("lang", "source", "text"))
    words = pc.split_pattern_regex(pc.ascii_lower(text), NOT_TERM)
    row, term = pc.list_parent_indices(words).cast(pa.int64()), pc.list_flatten(words)
    there = pc.not_equal(term, "")
    coded = pc.dictionary_encode(pc.filter(term, there))
    seen = (pa.table({"row": pc.filter(row, there), "code": coded.indices}).group_by(["row", "code"])
            .aggregate([([], "count_all")]).combine_chunks())  # one row per document and term
    groups = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"]).aggregate([([], "count_all")])
    whole = pa.table({"lang": pc.take(lang, seen["row"]), "source": pc.take(source, seen["row"]), "code": seen["code"], "n": seen["count_all"]})
    counts = whole.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("n", "count")]).combine_chunks()
    terms = pa.table({"lang": counts["lang"], "source": counts["source"], "term": pc.take(coded.dictionary, counts["code"]),
                      "n": counts["n_sum"], "docs": counts["n_count"]})
    own = pa.table({"lang": groups["lang"], "source": groups["source"], "term": pa.array([""] * groups.num_rows, term.type),
                    "n": pa.array([0] * groups.num_rows, pa.int64()), "docs": groups["count_all"]})
    return pa.concat_tables([terms, own])


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _partial_counts(shards: int):
    """Partial counts of a task's rows as columnar shards."""
    def handed(table: pa.Table):
        lang, first = pc.dictionary_encode(table["lang"].combine_chunks()), table["term"].combine_chunks()
        hashed = pd.util.hash_array(first.to_numpy(zero_copy_only=False).astype(object), categorize=False) % np.uint64(shards)
        shard = np.where(pc.equal(first, "").to_numpy(zero_copy_only=False), _GROUPS, hashed.astype(np.int64))
        key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * (shards + 1) + shard + 1
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        table = table.select(_COLUMNS).take(pa.array(order)).combine_chunks()
        for start, end in zip(starts, np.r_[starts[1:], len(order)], strict=True):
            k = int(key[order[start]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang.dictionary[k // (shards + 1)].as_py()], pa.string()), pa.array([k % (shards + 1) - 1], pa.int32()),
                 pa.array([_packed(table.slice(start, end - start))], pa.binary())], names=["lang", "shard", "counts"])

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            for part in _slices(batch):
                held.append(_counted(part))
                if sum(t.num_rows for t in held) > HELD_ROWS:
                    held = [_folded(held, ["lang", "source", "term"])]
                    if held[0].num_rows > HELD_ROWS // 2:
                        yield from handed(held.pop())
        if held:
            yield from handed(_folded(held, ["lang", "source", "term"]))
    return run


def _merged(min_docs: int):
    """The counts of a shard's kept terms; of the shard of groups every source."""
    def run(key, table):
        lang, shard = (k.as_py() for k in key)
        held: list[pa.Table] = []
        for packed in table["counts"]:
            held.append(pa.ipc.open_stream(packed.as_buffer()).read_all())
            if sum(t.num_rows for t in held) > HELD_ROWS:
                held = [_folded(held, ["source", "term"])]
        counts = _folded(held, ["source", "term"])
        if shard != _GROUPS:
            docs = counts.group_by("term").aggregate([("docs", "sum")])
            kept = docs.filter(pc.greater_equal(docs["docs_sum"], min_docs)).select(["term"])
            counts = counts.join(kept, "term", join_type="inner")
        return pa.table({"lang": pa.array([lang] * counts.num_rows, pa.string()), "source": counts["source"].cast(pa.string()),
                         "term": counts["term"].cast(pa.string()), "n": counts["n"].cast(pa.int64())})
    return run


def kept_counts(docs: DataFrame, min_docs: int, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, term, n)``: occurrences in every group of the terms
    that ``min_docs`` documents of the language hold, where there are any, and
    a row of the empty term for every group."""
    texts = docs.select(*[F.col(c).cast("string").alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    shards = min(SHARDS, max(1, -(-docs.count() // SHARD_DOCS)))
    return (texts.mapInArrow(_partial_counts(shards), _SHARD).groupBy("lang", "shard")
            .applyInArrow(_merged(min_docs), _KEPT))


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``1 + floor(UNIT (counts + SMOOTH) / whole)``, exact: a division digit
    by digit where the product would not fit, in Python's integers beyond."""
    a, d = counts + SMOOTH, np.broadcast_to(whole, counts.shape)
    most = int(d.max(initial=1))
    if most >= 2 ** 53:
        return np.array([1 + UNIT * int(x) // int(y) for x, y in zip(a.ravel(), d.ravel(), strict=True)], np.int64).reshape(a.shape)
    out = np.zeros(a.shape, np.int64)
    rest = a
    for _ in range(3):  # three digits at a time: the rest is below 2 ** 53
        out = out * 1000 + rest * 1000 // d
        rest = rest * 1000 % d
    return out + 1


def _measured(top: int):
    def run(key, counts: pa.Table, groups: pa.Table) -> pa.Table:
        """One shard of a language: every group's counts of the shard's terms.
        The language itself is the group whose source is null."""
        names = groups["source"].to_pylist()
        order = sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i] or ""))
        names = [names[i] for i in order]
        whole = groups["whole"].to_numpy()[order]
        terms = pc.dictionary_encode(counts["term"].combine_chunks())
        at = {name: i for i, name in enumerate(names)}
        c = np.zeros((len(names), len(terms.dictionary)), np.int64)
        if len(counts):
            row = np.array([at[s] for s in counts["source"].to_pylist()])
            c[row, terms.indices.to_numpy()] = counts["n"].to_numpy()
        c[0] = c[1:].sum(axis=0)
        p = shares(c, whole[:, None])
        lang, out = key[0].as_py(), {x: [] for x in ("part", "source", "item", "value")}

        def put(part, source, items, values):
            out["part"] += [part] * len(items)
            out["source"] += [source] * len(items)
            out["item"] += items
            out["value"] += values

        word = np.array(terms.dictionary.to_pylist(), dtype=object)
        rank = np.argsort(np.argsort(np.array([w.encode() for w in word], dtype=object))) if len(word) else np.zeros(0, int)
        for i in range(1, len(names)):
            if i + 1 < len(names):
                put("pair", names[i], names[i + 1:], [int(np.abs(p[i] - p[j]).sum()) for j in range(i + 1, len(names))])
            f = p[i] - p[0]
            best = np.flatnonzero((c[i] > 0) & (f > 0))
            best = best[np.lexsort((rank[best], -f[best]))[:top]]
            put("term", names[i], word[best].tolist(), f[best].tolist())
        return pa.table({"lang": pa.array([lang] * len(out["part"]), pa.string()), "part": pa.array(out["part"], pa.string()),
                         "source": pa.array(out["source"], pa.string()), "item": pa.array(out["item"], pa.string()),
                         "value": pa.array(out["value"], pa.int64())})
    return run


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, **columns) -> DataFrame:
    """``(lang, source, part, item, value, rank)``. Part ``pair``: every other
    source of the language, by the sum of differences of the shares of all
    kept terms. Part ``term``: the ``top`` terms whose share is above that of
    the language, by the difference. A language keeps the terms found in
    ``min_docs`` of its documents.

    * null texts, languages and sources are empty ones; an empty source or
      language is one like any other;
    * repeated rows are documents of their own;
    * groups without terms take part with the smoothing alone; a language
      without kept terms gives pairs of value 0 and no terms;
    * a language of one source has no pairs; an empty table gives no rows;
    * ties go to the item first in UTF-8 order; other columns take no part.
    """
    counts = pinned(kept_counts(docs, min_docs, **columns), "kept-counts")
    of_kept = counts.where(F.col("term") != "")
    kept = of_kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    vocabulary = pinned(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("all_n")), "vocabulary")
    totals = of_kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = pinned(counts.where(F.col("term") == "").select("lang", "source").join(totals, ["lang", "source"], "left")
                    .join(vocabulary, "lang", "left"), "groups")
    size = F.coalesce("v", F.lit(0)) * SMOOTH
    told = groups.select("lang", "source", (F.coalesce("total", F.lit(0)) + size).alias("whole"))
    lang_row = groups.groupBy("lang").agg(F.max(F.coalesce("all_n", F.lit(0)) + size).alias("whole"), F.count(F.lit(1)).alias("sources"))
    langs = pinned(lang_row, "langs")
    # shards by the cells of the largest language, so that a shard's table is bounded
    cells = langs.join(vocabulary, "lang").agg(F.max((F.col("sources") + 1) * F.col("v"))).first()[0] or 0
    shards = max(1, -(-int(cells) // SHARD_CELLS), min(8, int(cells) // 20_000))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    table = told.unionByName(langs.select("lang", F.lit(None).cast("string").alias("source"), "whole")).withColumn("shard", every)
    dealt = of_kept.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    parts = pinned(dealt.groupBy("lang", "shard").cogroup(table.groupBy("lang", "shard")).applyInArrow(_measured(top), _PARTS), "parts")

    half = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")).withColumn("part", F.lit("pair"))
    terms = parts.where("part = 'term'")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", place).unionByName(terms.withColumn("rank", place).where(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
