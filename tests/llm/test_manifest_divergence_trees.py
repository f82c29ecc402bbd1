"""Divergence audit, Merkle manifest and vantage-point trees against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from widegrain.llm import divergence, merkle, vantage_trees

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, idx long, own string, above int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(out)


def _manifest(rows, fanout):
    """Root, and per row (id, leaf, subroot, proof)."""
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0] is not None, r[0] or 0, _leaf(r), r))

    def tree(level):
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for leaf, k in enumerate(at):
                first = k // fanout * fanout
                paths[leaf] += [h for i, h in enumerate(level[first:first + fanout], first) if i != k]
                at[leaf] = k // fanout
            level = [_h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        return level[0], paths

    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for lang in langs:
        nodes = sorted(by[lang], key=lambda x: x[:3])
        own[lang] = (nodes, *tree([x[2] for x in nodes]))
    root, upper = tree([own[lang][1] for lang in langs])
    out = []
    for i, lang in enumerate(langs):
        nodes, subroot, paths = own[lang]
        out += [(n[3][0], n[2], subroot, _h(*(path + upper[i]))) for n, path in zip(nodes, paths, strict=True)]
    return root, out


def _manifest_rows():
    rnd = random.Random(4)
    rows = [(i, f"Text {i} \x00 é" * (1 + i % 3), rnd.choice(["en", "en", "en", "de", None, ""]), f"s{i % 4}", i) for i in range(150)]
    rows += [(500, "one alone", "zz", "s", 3), (501, None, "en", None, None), (502, "", "en", "", 0), (None, "Null id", "en", "s", 1),
             (7, "Another 7", rows[7][2], "s", 1), rows[9], rows[9], (503, "Long " * 60_000, "de", "s", 1)]
    return rows


@pytest.mark.parametrize("fanout", [2, 8])
def test_merkle_manifest_equals_brute_force(spark, fanout):
    rows = _manifest_rows()
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.manifest(df, fanout=fanout, tampered=tampered).collect()
    root, want = _manifest(rows, fanout)
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["proof_sha256"]) for r in got) == Counter(want)
    assert {r["root"] for r in got} == {root}
    forged = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
              and r[1] is not None and re.search("[A-Z]", r[1])}
    assert forged and all(r["verified"] == (r["doc_id"] not in forged) for r in got)
    for r in got:  # the proof leads from the leaf to the root
        h = r["leaf"]
        for left, right in r["above"]:
            h = _h(left, h, right)
        assert h == root and (r["folded_root"] == root) == r["verified"]


def test_merkle_manifest_of_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "A", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    r = merkle.manifest(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == _leaf((1, "A", None, None, None)) and r["proof_sha256"] == _h("") and r["verified"]
    assert merkle.manifest(one.limit(0)).count() == 0


def test_merkle_numbers_of_a_hot_group_over_many_ranges(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "a").otherwise("b").alias("g"), (F.col("id") % 50).alias("key"))
    got = merkle.numbered(rows, "g", ["key"]).collect()
    for g, n in (("a", 4000), ("b", 1000)):
        own = sorted((r["idx"], r["key"]) for r in got if r["g"] == g)
        assert [i for i, _ in own] == list(range(n)) and [k for _, k in own] == sorted(k for _, k in own)
        assert {r["n"] for r in got if r["g"] == g} == {n}


def _audit(rows, min_docs, top):
    groups, by_lang, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        words = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        groups[lang or "", source or ""].update(words)
        by_lang[lang or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def p(counts, kept=kept):
            whole = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // whole for t in kept}
        mine, q = p(own), p(by_lang[lang])
        pairs = [(-sum(abs(mine[t] - v) for t, v in p(c).items()), s.encode(), s) for (la, s), c in groups.items() if la == lang and s != source]
        terms = [(-(mine[t] - q[t]), t.encode(), t) for t in kept if own[t] and mine[t] > q[t]]
        out += [(lang, source, "pair", s, -f, i) for i, (f, _, s) in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", t, -f, i) for i, (f, _, t) in enumerate(sorted(terms)[:top], 1)]
    return out


def _audit_rows():
    rnd = random.Random(6)
    words = ["the", "The", "of", "été", "über", "ÉTÉ", "日本", "don't", "x1y", "a\x00b", "z_z", "𝒳"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 60))), rnd.choice(["en", "en", "de", None]), rnd.choice(["a", "a", "b", None]), 1)
            for i in range(300)]
    rows += [(400, "1 2 3", "en", "empty", 1), (401, None, "en", "null", 1), (402, "word", "fr", "x", 1), (403, "word", "fr", "y", 1),
             (404, "lone", "it", "x", 1), (405, "The of " * 50_000, "en", "long", 1), rows[5], rows[5]]
    return rows


@pytest.mark.parametrize("settings", [{}, {"SLICE_BYTES": 500, "HELD_ROWS": 40, "SHARD_CELLS": 30}])
def test_divergence_equals_brute_force(spark, monkeypatch, settings):
    rows = _audit_rows()
    if settings:  # many slices, hand-overs and shards; workers fork with the settings of the closure's module only
        monkeypatch.setattr(divergence, "SHARD_CELLS", settings["SHARD_CELLS"])
        batches = [b for b in _arrow(rows)]
        monkeypatch.setattr(divergence, "SLICE_BYTES", settings["SLICE_BYTES"])
        monkeypatch.setattr(divergence, "HELD_ROWS", settings["HELD_ROWS"])
        parts = list(divergence._partial_counts(5)(iter(batches)))
        assert len({(b["lang"][0].as_py(), b["shard"][0].as_py()) for b in parts}) < len(parts)
        total = Counter()
        for b in parts:
            for r in pa.ipc.open_stream(b["counts"][0].as_buffer()).read_all().to_pylist():
                total[b["lang"][0].as_py(), r["source"], r["term"]] += r["n"]
        assert total["en", "long", "the"] == total["en", "long", "of"] == 50_000
        monkeypatch.setattr(divergence, "SHARD_DOCS", 40)
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS)
    got = divergence.audit(df, min_docs=30, top=5).collect()
    assert sorted(tuple(r) for r in got) == sorted(_audit(rows, 30, 5))


def _arrow(rows):
    t = pa.table({"lang": [r[2] for r in rows], "source": [r[3] for r in rows], "text": [r[1] for r in rows]})
    return t.to_batches(max_chunksize=50)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], DOCS)
    assert divergence.audit(df).count() == 0


def test_shares_are_exact_at_every_size():
    for n, whole in ((0, 5), (10, 37), (123456789012, 999999999999), (9 * 10 ** 15, 2 * 10 ** 16), (2 ** 53 - 10, 2 ** 53 - 1)):
        got = divergence.shares(np.array([[n]]), np.array([[whole]]))
        assert got[0, 0] == 1 + 10 ** 9 * (n + 5) // whole


def _nearest(rows, k, asked):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            whole[i] = min(whole.get(i, v), v)
    dim = max((len(v) for v in whole.values()), default=0)
    m = {i: list(v) + [0.0] * (dim - len(v)) for i, v in whole.items()}
    out = []
    for q in filter(asked, m):
        def score(i, q=q):
            s = 0.0
            for a, b in zip(m[q], m[i], strict=True):
                s += a * b
            return s
        best = sorted((-score(i), i) for i in m if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_factor_one_is_exact(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + rnd.normal(size=8)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[40][1]) for i in range(300)]  # a group of copies
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] * 4), (2060, [float("nan")] * 8), (2080, [float("inf")] * 8), (None, [1.0] * 8),
             (2100, [1.0]), (2120, []), (20, rows[21][1]), rows[60], (2140, [float(x) for x in range(8)])]
    df = spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], "vec_id long, embedding array<double>, v string, score double")
    monkeypatch.setattr(vantage_trees, "SHARD_BYTES", 64 * 8 * 100)  # shards of 100 points: a router of several levels
    got = vantage_trees.nearest(df, F.col("id") % 20 == 0, k=20, factor=1.0).collect()
    want = _nearest(rows, 20, lambda i: i % 20 == 0)
    assert [tuple(r)[:3] for r in sorted(got)] == [w[:3] for w in want]
    assert all(a["score"] == b[3] for a, b in zip(sorted(got), want, strict=True))
    relaxed = vantage_trees.nearest(df, F.col("id") % 20 == 0, k=20, recall=0.95).collect()  # a tuned factor
    found = {(r["query_id"], r["vec_id"]) for r in relaxed}
    assert len(relaxed) == len(want) and len(found & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)


def test_trees_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert vantage_trees.nearest(spark.createDataFrame([], schema), F.col("id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(20, [1.0, 2.0]), (3, [0.5, 0.5])], schema)
    assert [tuple(r) for r in vantage_trees.nearest(two, F.col("id") % 20 == 0).collect()] == [(20, 1, 3, 1.5)]
    alike = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(60)], schema)
    got = sorted(tuple(r) for r in vantage_trees.nearest(alike, F.col("id") % 20 == 0, k=3).collect())
    assert got == [(q, r, v, 2.0) for q, vs in ((0, (1, 2, 3)), (20, (0, 1, 2)), (40, (0, 1, 2))) for r, v in enumerate(vs, 1)]
    with pytest.raises(ValueError):
        vantage_trees.nearest(two, F.col("id") % 20 == 0, factor=0.5)


def test_recall_of_the_query(spark):
    from widegrain.llm import queries
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op13_nearest_neighbours"](spark, sf).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {w[0::2][:2] for w in _nearest(rows, 20, lambda i: i % 20 == 0)}
    assert len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.9 * len(want)
