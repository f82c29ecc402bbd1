"""Search, WARC, quality and personal data against brute force, with edges."""

import base64
import hashlib
import math
import random
import re

import pytest

from widegrain.llm import co_training, personal_data, quality_rules, text_stats, topk_search, warc


def test_top_k_equals_brute_force(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(2)
    rows = [(i, [rnd.choice((-1.0, 0.25, 0.5, 1.5)) for _ in range(6)], 0) for i in range(300)]
    rows += [(301, None, 0), (302, [1.0, None, 2.0], 0), (303, [float("nan")] * 6, 0), (304, [float("inf")] * 6, 0), (None, [1.0] * 6, 0),
             (305, [1.0], 0), (306, [], 0), (7, rows[7][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in topk_search.top_k(df, F.col("id") % 100 == 0, k=10).collect())
    whole = {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in whole if i % 100 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert topk_search.top_k(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_top_k_many_blocks(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(topk_search, "ROWS", 8)
    monkeypatch.setattr(topk_search, "GROUP", 2)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    rows = [(i, [float(i % 13), float(-(i % 7)), 1.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk_search.top_k(df, F.col("id") % 40 == 0, k=5, scale=1).collect())
    want = []
    for q in range(0, 400, 40):
        best = sorted((-sum(a * b for a, b in zip(rows[q][1], v, strict=True)), i) for i, v in rows if i != q)[:5]
        want += [(q, r, i, -int(s)) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)


def test_warc_derivatives(spark, tmp_path):
    page = ('<html lang="en"><head><title>A &amp; B</title><script>x="<p>no</p>"</script></head><body><!-- no -->'
            '<p>One <b>two</b><br>three</p><a href="/x?a=1&amp;b=2">go</a><a href="/x?a=1&amp;b=2">go</a></body></html>')
    pages = spark.createDataFrame([(1, "http://e.org/d/", page, "k"), (2, None, None, "k"), (None, "http://e.org", "plain", "k"),
                                   (1, "http://e.org/d/", page, "k")], "page_id long, url string, html string, kind string")
    source = warc.responses(pages)
    got = warc.derive(source).collect()
    assert len(got) == 8
    first = {r["kind"]: r for r in got if r["page_id"] == 1}
    assert first["conversion"]["block"] == "A & B\nOne two\nthree\ngogo"
    fields = [x.split(": ", 1) for x in first["metadata"]["block"].split("\r\n") if x]
    assert ["title", "A & B"] in fields and ["language", "en"] in fields
    assert [v for k, v in fields if k == "outlink"] == ["http://e.org/x?a=1&b=2"]
    assert ["source-header", "Content-Type: text/html; charset=utf-8"] in fields
    sha = "sha1:" + base64.b32encode(hashlib.sha1(page.encode()).digest()).decode()
    assert ["source-payload-digest", sha] in fields and first["conversion"]["source_payload_digest"] == sha
    assert first["metadata"]["refers_to"] == first["conversion"]["refers_to"] != first["conversion"]["record_id"]
    for r in got:
        assert r["content_length"] == len(r["block"].encode())
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(r["block"].encode()).digest()).decode()
    warc.write(warc.derive(source), str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    n = 0
    while data:  # every record is found by its length, as a WARC reader does
        head, rest = data.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[size:size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4:], n + 1
    assert n == 8
    assert warc.derive(source.limit(0)).count() == 0


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_text_counts_equal_brute_force():
    rnd = random.Random(9)
    for _ in range(400):
        text = "".join(rnd.choice(["a ", "b ", "é ", "\n", "\x0b", "#", "a b a ", "\x1c"]) for _ in range(rnd.randint(0, 30)))
        assert text_stats.counts(text)[:5] == brute_counts(text), text


def test_decision_list_learns_and_keeps_clean_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    share = quality_rules.judge_quality(docs, labels).join(labels, "doc_id").where("NOT base_failed").selectExpr(
        "avg(CAST(kept = (quality = 1) AS INT))").first()[0]
    assert share >= 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "z"), (None, "a b", "z"), (2, "w " * 60, "z"), (2, " ".join(f"w{i}" for i in range(60)), "z")],
                                 "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([(2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.judge_quality(docs, labels).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["base_failed"], r["kept"]) for r in got) == [
        ("1", 0, True, False), ("2", 60, False, True), ("2", 60, True, False), ("None", 2, True, False)]
    assert quality_rules.judge_quality(docs.limit(0), labels).count() == 0
    assert quality_rules.learn_rules({"x": quality_rules.np.arange(4.0)}, quality_rules.np.ones(4, bool)) == []


def test_quality_sample_is_the_smallest_hashes(spark, sf_dir, monkeypatch):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    drawn = []
    monkeypatch.setattr(quality_rules, "learn_rules", lambda data, bad: drawn.append((data["words"].tolist(), bad.tolist())) or [])
    for most in (10 ** 6, 5):
        quality_rules.judge_quality(docs, labels, max_labelled=most)
    assert len(drawn[0][1]) > 5
    assert drawn[1] == (drawn[0][0][:5], drawn[0][1][:5])


def test_co_training_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 3 <> 1")
    got = co_training.co_train(docs, train, rounds=1).cache().join(labels.where("doc_id % 3 = 1"), "doc_id")
    assert got.selectExpr("avg(CAST(kept = (quality = 1) AS INT))").first()[0] >= 0.9
    assert got.selectExpr("min(score) >= 0 AND max(score) <= 1").first()[0]


def test_co_training_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 2.0), (None, "a", "s", "en", 3, 2.0)],
                                 "doc_id long, text string, source string, lang string, n_chars long, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = co_training.co_train(docs, none).collect()
    assert [(r["score"], r["kept"]) for r in got] == [(0.5, True)] * 2
    assert co_training.co_train(docs.limit(0), none).count() == 0


def brute_spans(text):
    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (2 if k % 2 else 1)
            total += v - 9 if v > 9 else v
        return total % 10 == 0
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15))
    return [(kind, m.start(), m.end()) for kind, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans_equal_brute_force(spark):
    rnd = random.Random(4)
    parts = ["a.b@c.de", "@", "x@y", ".", "1.2.3.4", "256", "255", "+1 (234) 555-6789", "+", "4111111111111111", "4111 1111 1111 1111",
             "-", " ", "0", "12", "é", "\n", "🙂", "a@b.c+d@e.f", "(", ")", "+1", "+12"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(600)]
    texts += ["9" * 50_000, "a" * 50_000, "1 " * 5_000, "+1" * 2_000, "1." * 2_000]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)] + [(-1, None, "q"), (None, "a@b.cd", "q"), (0, texts[0], "q")],
                                 "doc_id long, text string, spans string")
    got = personal_data.find_personal_data(docs).collect()
    assert len(got) == len(texts) + 3
    for r in got:
        text = "a@b.cd" if r["doc_id"] is None else "" if r["doc_id"] < 0 else texts[r["doc_id"]]
        base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
        assert base == brute_spans(text), text[:200]
        assert set(base) <= {(s["kind"], s["start"], s["end"]) for s in r["spans"]}
    assert personal_data.find_personal_data(docs.limit(0)).count() == 0


def test_added_spans_of_hidden_formats(spark):
    rnd = random.Random(4)

    def word():
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(4, 9)))

    def phone():
        return f"{rnd.randrange(1, 99)} ({rnd.randrange(100, 999)}) {rnd.randrange(100, 999)}-{rnd.randrange(1000, 9999)}"

    texts = []
    for _ in range(300):
        texts.append(f"{word()} {word()} write to {word()}.{word()}@{word()}.com or phone +{phone()} {word()}")
        texts.append(f"{word()} sold {rnd.randrange(2, 99)} @ {rnd.randrange(2, 99)}.{rnd.randrange(10, 99)} each, order id "
                     f"{rnd.randrange(10**8, 10**9)} {word()}")
    planted = ["jane.miller [at] sunmail.com", "paul.baker(at)woodland.com", "mary.stone @ riverbank.com"]
    phones = [phone() for _ in range(3)]
    at = len(texts)
    texts += [f"{word()} please write to {e} or phone {p} today" for e, p in zip(planted, phones, strict=True)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data.find_personal_data(docs).collect():
        text, base = texts[r["doc_id"]], {(s["kind"], s["start"], s["end"]) for s in r["base"]}
        added = {(s["kind"], text[s["start"]:s["end"]]) for s in r["spans"] if (s["kind"], s["start"], s["end"]) not in base}
        k = r["doc_id"] - at
        assert {("email", planted[k]), ("phone", phones[k])} <= added if k >= 0 else not added, (text, added)


def _hidden_table(share, n=400):
    """``n`` strict addresses, decoy texts, and hidden addresses and phones in
    ``share`` percent of all that the kind has."""
    rnd = random.Random(9)

    def word():
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(4, 9)))

    def phone():
        return f"{rnd.randrange(1, 99)} ({rnd.randrange(100, 999)}) {rnd.randrange(100, 999)}-{rnd.randrange(1000, 9999)}"

    texts, hidden = [], {}
    for _ in range(n):
        texts.append(f"{word()} {word()} write to {word()}.{word()}@{word()}.com or phone +{phone()} {word()}")
        texts.append(f"{word()} sold {rnd.randrange(2, 99)} @ {rnd.randrange(2, 99)}.{rnd.randrange(10, 99)} each, order id "
                     f"{rnd.randrange(10**8, 10**9)} {word()}, version 1.{rnd.randrange(9)}.{rnd.randrange(20)}")
    for _ in range(max(2, round(n * share / (100 - share)))):
        e = f"{word()}.{word()}{rnd.choice([' [at] ', '(at)', ' @ ', ' (at) '])}{word()}.org"
        p = phone()
        hidden[len(texts)] = {("email", e), ("phone", p)}
        texts.append(f"{word()} please write to {e} or phone {p} today")
    return texts, hidden


@pytest.mark.parametrize("share", [0.5, 10, 50])
def test_hidden_spans_are_found_however_many_there_are(spark, share):
    texts, hidden = _hidden_table(share)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, wrong = 0, []
    for r in personal_data.find_personal_data(docs).collect():
        text, base = texts[r["doc_id"]], {(s["kind"], s["start"], s["end"]) for s in r["base"]}
        added = {(s["kind"], text[s["start"]:s["end"]]) for s in r["spans"] if (s["kind"], s["start"], s["end"]) not in base}
        want = hidden.get(r["doc_id"], set())
        found += len(added & want)
        wrong += sorted(added - want)
    total = sum(map(len, hidden.values()))
    assert found >= 0.95 * total and len(wrong) <= 0.02 * total, (found, total, wrong[:5])


def test_hostile_pages_are_scanned_once():
    import time
    for piece in ("<a ", "<title>", "<html ", "<meta ", "<script ", "<!--", "<p", "</", "<", "<a href='", "<script>", "&amp", "<a href=", "<title></title"):
        page = piece * (1_000_000 // len(piece))
        t0 = time.perf_counter()
        warc.visible_text(page)
        warc.page_fields(page, "http://e.org")
        assert time.perf_counter() - t0 < 6, piece


def _page_by_hand(page):
    """Fields and text of a page by a plain walk over its characters."""
    import html
    text, tags, i = "", [], 0
    while i < len(page):
        if page[i] != "<" or i + 1 == len(page) or not (page[i + 1].isascii() and page[i + 1].isalpha() or page[i + 1] in "/!?"):
            text, i = text + page[i], i + 1
        elif page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            text, i = text + " ", len(page) if end < 0 else end + 3
        else:
            end = page.find(">", i)
            tag, after = page[i:] if end < 0 else page[i:end + 1], len(page) if end < 0 else end + 1
            name = re.match(r"</?([A-Za-z]\w*)", tag)
            name = name[1].lower() if name else ""
            if name in ("script", "style") and tag[1] != "/" and end >= 0:
                closed = re.search(rf"</{name}\s*>", page[after:], re.I)
                text, i = text + " ", len(page) if closed is None else after + closed.end()
                continue
            tags.append((tag, name))
            text, i = text + ("\n" if name in ("p", "br", "title", "div", "li") else ""), after
    lines = [re.sub("[ \t\r\f\v]+", " ", x).strip() for x in html.unescape(text).split("\n")]
    links = [m[1] for t, n in tags if n == "a" and t[1] != "/" for m in [re.search(r'\bhref\s*=\s*"([^"]*)"', t, re.I)] if m]
    return "\n".join(x for x in lines if x), list(dict.fromkeys(x for x in links if x))


def test_pages_equal_a_plain_walk():
    rnd = random.Random(3)
    pieces = ["<p>", "</p>", "<br>", "text ", "a &amp; b", "<a href=\"http://e.org/1\">", "<A HREF=\"http://e.org/2\" x>", "</a>", "<!-- c -->", "<!--", "-->",
              "<script>", "</script>", "<style x>", "</STYLE >", "<", ">", "<3", "<div", " class=\"y\">", "<title>", "</title>", "\n", "é", "<?x?>", "<!DOCTYPE html>"]
    for _ in range(3000):
        page = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(0, 16)))
        text, links = _page_by_hand(page)
        assert warc.visible_text(page) == text, page
        assert [v for k, v in warc.page_fields(page, "") if k == "outlink"] == links, page


def test_co_training_with_few_labels_of_a_class(spark):
    rnd = random.Random(8)
    good, bad = "the harvest of the valley was counted by the old miller".split(), "zz xq 00 ## kk jj".split()
    docs = [(i, " ".join(rnd.choices(good if i % 2 else bad, k=40)), "web", "en", 200) for i in range(300)]
    labels = [(i, 0) for i in (2, 4, 6)] + [(i, 1) for i in range(1, 200, 2)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in co_training.co_train(d, lab).collect()}
    assert sum(got[i] for i in got if i % 2) >= 140 and sum(got[i] for i in got if i % 2 == 0) <= 10
    one = co_training.co_train(d, lab.where("quality = 1 OR doc_id = 2")).collect()
    assert len({r["score"] for r in one}) == 1 and all(r["kept"] for r in one)


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é write to a.b@c.de or +1 (234) 555-6789.", 5), (2, "nothing", 6), (3, None, 7)],
                                 "doc_id long, text string, spans int")
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in personal_data.redact(docs).collect()}
    assert got == {1: ("é write to <email> or <phone>.", 5), 2: ("nothing", 6), 3: (None, 7)}


def test_personal_data_learns_from_every_variant_and_decoy(spark, monkeypatch):
    """``max_train`` weighs the known rows and takes none out."""
    from pyspark.sql import functions as F
    seen = []

    class Told(personal_data.GBTClassifier):
        def fit(self, dataset, params=None):
            seen.append(dataset.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect())
            return super().fit(dataset, params)

    monkeypatch.setattr(personal_data, "GBTClassifier", Told)
    docs = spark.createDataFrame([(i, f"write to user{i}@host{i}.com now, or call +49 {3000000 + i} or see 2 @ {i} please") for i in range(400)], "doc_id long, text string")
    personal_data.find_personal_data(docs, max_train=160).count()
    told = {(r["kind"], r["label"]): (r["n"], r["w"]) for r in seen[0]}
    for key in (("email", 1.0), ("email", 0.0), ("phone", 1.0)):
        n, w = told[key]
        assert 250 < n < 350  # those of three quarters of the digests
        assert w == pytest.approx(20 * n / 400)  # the quota's share
