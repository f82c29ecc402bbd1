"""Operators on texts against brute force, and their defined edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from widegrain.llm import byte_bpe, language_id, line_dedup, mixing, near_duplicates
from widegrain.llm.pinning import Scratch, pinned

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, score string, component_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", 1) for i, t, s in rows], SCHEMA)


def noisy_texts(seed=3, n=60):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [[rnd.choice(words) for _ in range(rnd.choice((3, 30, 90)))] for _ in range(8)]
    rows = []
    for i in range(n):
        own = list(rnd.choice(base)) if rnd.random() < 0.8 else [rnd.choice(words) for _ in range(40)]
        for _ in range(rnd.choice((0, 1, 2, 4, 8))):
            own[rnd.randrange(len(own))] = rnd.choice(words).upper()
        rows.append((i * 7 % 101, " ".join(own).replace(" w1", "\n  w1"), "s"))
    return rows + [(200, None, "s"), (201, "", "s"), (202, " \t\n", "s"), (203, "one", "s"), (204, "ONE", "s"),
                   (None, "one", "s"), (205, "two words", "s"), (205, "other text altogether here", "s"), (203, "one", "s")]


def brute_components(rows):
    sets = []
    for _, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set())
    comp = {i: i for i, _, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for (i, _, _), a in zip(rows, sets, strict=True):
            for (j, _, _), b in zip(rows, sets, strict=True):
                if None not in (i, j) and a and 100 * len(a & b) >= 80 * len(a | b) and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    return sorted(((i, len(s), comp.get(i), i is None or comp[i] == i) for (i, _, _), s in zip(rows, sets, strict=True)), key=str)


def test_near_duplicates_equal_brute_force(spark):
    rows = noisy_texts()
    got = near_duplicates.near_duplicates(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


def changed(words, at):
    return " ".join("x" if k in at else w for k, w in enumerate(words))


def test_near_duplicates_of_repeated_rows(spark):
    rows = []
    for k in range(20):
        words = [f"a{k}w{i}" for i in range(101)]
        text, near = " ".join(words), changed(words, {0, 40, 100})
        if k % 4 == 0:  # a repeated row and a near copy (96 of 104 shingles)
            rows += [(10 * k, text, "s"), (10 * k, text, "s"), (10 * k + 1, near, "s")]
        elif k % 4 == 1:  # the smaller id is the one that stands once
            rows += [(10 * k, near, "s"), (10 * k + 1, text, "s"), (10 * k + 1, text, "s"), (10 * k + 1, text, "s")]
        elif k % 4 == 2:  # an id with two texts, each with a near copy
            other = [f"b{k}w{i}" for i in range(101)]
            rows += [(10 * k, text, "s"), (10 * k, " ".join(other), "s"), (10 * k + 1, near, "s"),
                     (10 * k + 2, changed(other, {0, 60, 100}), "s")]
        else:  # texts with equal sets under one id, and the same text under another
            rows += [(10 * k, text, "s"), (10 * k, text.upper(), "s"), (10 * k + 2, text, "s"), (10 * k + 1, near, "s")]
    got = near_duplicates.near_duplicates(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)
    assert {r["component_id"] for r in got} == {10 * k for k in range(20)}


@pytest.mark.parametrize("share,both,alone", [(80, 40, 5), (50, 20, 10), (90, 90, 5), (30, 12, 14)])
def test_links_of_just_the_share_are_found(spark, share, both, alone):
    """200 pairs at exactly the share, 200 a shingle below it, sets of words."""
    rows = []
    for k in range(200):
        for base, common in ((4 * k, both), (4 * k + 2, both - 1)):
            shared = [f"d{base}c{i}" for i in range(common)]
            for d in (0, 1):
                own = [f"d{base}o{d}n{i}" for i in range(alone + both - common)]
                rows.append((base + d, " ".join(shared + own), "s"))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(frame(spark, rows), width=1, share=share).collect()}
    assert sum(got[4 * k + 1] == 4 * k for k in range(200)) >= 198
    assert all(got[4 * k + 3] == 4 * k + 3 for k in range(200))


def test_table_shape():
    assert near_duplicates.table_shape(80, 0.999) == (3, 11)
    for share in range(5, 100):
        rows, m = near_duplicates.table_shape(share, 0.999)
        assert (1 - (1 - (share / 100) ** rows) ** m) ** 2 >= 0.999
    for wrong in ((0, 0.9), (101, 0.9), (80, 1.0), (80, 0.0)):
        with pytest.raises(ValueError):
            near_duplicates.table_shape(*wrong)


def test_equal_sets_alone_at_a_share_of_100(spark):
    rows = [(1, "a b c", "s"), (2, "A B C", "s"), (3, "a b d", "s")]
    got = near_duplicates.near_duplicates(frame(spark, rows), share=100).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3}


def test_scratch_deletes_what_is_not_kept(spark):
    frames = {}
    with Scratch(spark) as outer:
        with Scratch(spark) as inner:
            frames["passing"] = pinned(spark.range(5), "passing")
            frames["kept"] = inner.keep(frames["passing"].where("id > 1"), "kept")
        assert not there(spark, inner.paths[0]) and there(spark, outer.paths[0])
        frames["last"] = outer.keep(frames["kept"], "last")
    assert not there(spark, outer.paths[0])
    assert sorted(r["id"] for r in frames["last"].collect()) == [2, 3, 4]
    with pytest.raises(ValueError):
        with Scratch(spark) as failing:
            pinned(spark.range(5), "failing")
            raise ValueError
    assert not there(spark, failing.paths[0])


def there(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def test_mixing_counts_equal_rows(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, None, None), (2, None, None), (2, None, None), (3, "x", "s")]
    plan = mixing.mixing_plan(frame(spark, rows), max_epochs=1.0).collect()
    assert {(r["doc_id"], r["source"], r["copies"], r["n_tokens"]) for r in plan} == {(1, "s", 2, 4), (2, None, 3, 3), (3, "s", 1, 1)}


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(1, "a", "s")]])
def test_near_duplicates_small(spark, rows):
    assert near_duplicates.near_duplicates(frame(spark, rows)).count() == len(rows)


def brute_lines(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 2 or i == min(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_equals_brute_force(spark):
    rows = [(3, "A shared line here\n  a SHARED line here\t\nown", "s"), (1, "a shared line here\n\nshort\n", None),
            (2, "short\nA shared line here", "s"), (2, "another\nA shared line here\nA shared line here", "s"),
            (None, "a shared line here", "s"), (5, None, "s"), (6, "", "s"), (7, "x" * 50_000 + "\n" + "é shared line é", "s"),
            (8, "É SHARED line é\né shared line é", "s"), (3, "A shared line here\n  a SHARED line here\t\nown", "s")]
    got = line_dedup.dedup_lines(frame(spark, rows))
    assert got.columns.count("n_lines") == 1 and "component_id" in got.columns
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=str) == brute_lines(rows)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    three = line_dedup.dedup_lines(frame(spark, [(1, "a shared line here", "s"), (2, "a shared line here", "s")]), min_docs=3)
    assert {r["n_dropped"] for r in three.collect()} == {0}


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_with_a_line_in_every_document(spark, min_docs):
    rnd = random.Random(4)
    hot = ["A line that every document holds", "another such line of all of them"]
    rows = [(i, "\n".join([rnd.choice(hot), f"a line of its own {i}", f"shared by a few {i % 400:05d}", hot[0]]), "s") for i in range(1200)]
    rows += [(i, hot[0] + "\nother text of this id", "s") for i in range(0, 1200, 7)] + [(None, hot[0], "s")]
    holders = {}
    for i, text, _ in rows:
        if i is not None:
            for x in text.split("\n"):
                holders.setdefault(x.lower(), set()).add(i)
    want = Counter()
    for i, text, _ in rows:
        stay = [x for x in text.split("\n") if i is None or len(holders[x.lower()]) < min_docs or i == min(holders[x.lower()])]
        want[i, "\n".join(stay)] += 1
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(frame(spark, rows), min_docs=min_docs).collect())
    assert got == want


def test_mixing_repeats_small_sources_and_drops_nothing(spark):
    rows = [(i, "a b c d e", "big") for i in range(400)] + [(1000 + i, "a b c d e", "mid") for i in range(100)]
    rows += [(2000 + i, None, None) for i in range(50)] + [(2000, None, None)]
    out = mixing.mix_sources(frame(spark, rows), max_epochs=2.0, block_tokens=300)
    got = out.collect()
    times = Counter(r["doc_id"] for r in got)
    assert set(times) == {r[0] for r in rows} and max(times.values()) <= 4  # 2000 stands twice
    per = Counter(r["source"] for r in got)
    assert per["big"] == 400 and 100 < per["mid"] <= 200 and 51 < per[None] <= 102
    blocks = Counter(r["mix_block"] for r in got)
    assert set(blocks) == set(range(max(blocks) + 1))
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    again = mixing.mix_sources(frame(spark, rows), max_epochs=2.0, block_tokens=300).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixing_entropy(spark):
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "p double")
    import math
    a = mixing.bisect_exponent(shares, target_entropy=0.9)
    w = [p ** a for p in (0.7, 0.2, 0.1)]
    h = -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
    assert 0 < a < 1 and abs(h - 0.9 * math.log(3)) < 1e-9
    assert mixing.bisect_exponent(shares, max_epochs=1.0) == pytest.approx(1, abs=1e-9)


def codec(**settings):
    import public_tokenizers as P
    return byte_bpe.TreeCodec(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN, **settings)


def test_bpe_tree_equals_whole_encoding():
    tree = codec(leaf_chars=5)
    rnd = random.Random(5)
    parts = ["a", "'", "'s", "'re", " ", "  ", "\n", "\t", "é", "1", "23", ".", "!", "the", " and", "\x1c", "\xa0", "語", "🙂",
             "\r", "\x0b", "\x0c", "\x85", "\u3000", "\u2028", "\u180e", "\u200b", "\u0301", "²", "Ⅷ", "٣", "ʼ", "’", "'ll", "'LL",
             "\U0001e900", "\U00011f50", "。", "_", "-", "\x00", "\u16ee", "\u19da"]
    for _ in range(8000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        ids = tree.encode(text)
        assert ids == tree.leaf(text) and tree.decode(ids) == text.encode()


@pytest.mark.parametrize("text,times", [("word\t" * 40_000, 1.1), ("abc123,de'f." * 16_000, 1.1), ("語" * 30_000 + "。", 3),
                                        ("a" * 100_000, 1.01), ("x" * 70_000 + " and so on" * 9_000, 3), ("\t" * 50_000, 1.01)])
def test_bpe_encodes_little_twice(text, times):
    tree = codec()
    seen = []
    whole = tree.leaf

    def counting(part):
        seen.append(len(part))
        return whole(part)

    tree.leaf = counting
    assert tree.encode(text) == whole(text)
    assert sum(seen) <= times * len(text)


def test_bpe_query_columns(spark):
    import public_tokenizers as P
    rows = [(1, "Hello world's end", "s"), (2, None, "s"), (None, "", "s"), (1, "a" * 30_000, "s"), (3, "<|endoftext|>", "s")]
    got = byte_bpe.byte_bpe(frame(spark, rows), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()
    whole = codec().leaf
    want = sorted(((i, whole(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows), key=str)
    assert sorted(((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in got), key=str) == want
    for r in got:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
    assert byte_bpe.byte_bpe(frame(spark, []), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language_id.identify(docs).where("held_out").selectExpr("avg(CAST(lang = lang_pred AS INT))", "min(score)", "max(score)").first()
    assert got[0] >= 0.97 and 0 <= got[1] <= got[2] <= 1


def test_language_edges(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "12 ² !", "s"), (None, "hello there", "s"), (8, "the end of the day", "s"), (8, "é", "s")]
    assert zlib.crc32(b"8") % 4 != 2  # learned from
    got = language_id.identify(frame(spark, rows)).collect()
    assert len(got) == 6
    assert {(r["doc_id"], r["lang_pred"]) for r in got} == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (8, "en")}
    assert language_id.identify(frame(spark, [])).count() == 0
    blank = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert language_id.identify(blank).first()["lang_pred"] == "und"


@pytest.mark.parametrize("short", [(), ("xx",)])
def test_language_of_long_texts(spark, short):
    rnd = random.Random(8)
    letters = {"xx": "abcdefghij", "yy": "mnopqrstuv"}
    rows = []
    for i in range(60):
        lang = ("xx", "yy")[i % 2]
        n = 20 if lang in short else 1200
        rows.append((i, " ".join("".join(rnd.choices(letters[lang], k=5)) for _ in range(n)), lang))
    assert all(len(t) > 4000 for _, t, lang in rows if lang not in short)
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == 60 and all(r["lang_pred"] == r["lang"] and r["score"] > 0.5 for r in got)


def test_every_language_has_a_landmark(spark):
    # more languages than landmarks, a letter pair each
    names = [f"l{k:03d}" for k in range(120)]
    rows = [(i, " ".join([chr(0x4e00 + 7 * (i % 120)) + chr(0x4e01 + 7 * (i % 120))] * 30), names[i % 120]) for i in range(480)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify(docs, landmarks=96).collect()
    learned = {names[i % 120] for i in range(480) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(got) == 480
    assert all(r["lang_pred"] == r["lang"] for r in got if r["lang"] in learned)


def test_language_vocabulary_is_bounded(spark):
    rows = [(i, " ".join(f"{'ab' if i % 2 else 'yz'}{j * 37 % 1009}" for j in range(300)), "xy"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, max_grams=200)
    assert model.weights.shape[0] == 200
    assert all(r["lang_pred"] == r["lang"] for r in language_id.predict(docs, model).collect())
