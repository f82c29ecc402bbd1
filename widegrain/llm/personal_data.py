"""Personal data: candidate gradient boosting (operator 10), DataFrame, SQL and
Spark ML functions only.

Strict patterns give the base spans of four kinds (email, ip, card, phone).
High-recall generators propose further, overlapping spans of the same kinds
(obfuscated addresses, longer or shorter digit runs, numbers without a plus).
Boosted trees judge every proposal by its format and context. They learn from
base spans with their strict marks hidden, rewritten into what the generators look for (obfuscated
addresses, phones without their plus, dotted cards; an ip has no other form),
against known decoys: proposals that touch no base span and that their kind's
own rules tell to be something else (numbers around an at sign, a failed check
digit, too many parts, an identifier's name before the digits). Proposals that
may be hidden spans are never counted as negatives, so the method finds them
however many there are. What makes a base span valid (plus, at sign, check
digit, part sizes) is no feature. A threshold per kind, at least one half,
calibrated on held-out variants and decoys to a wanted precision, selects the
spans that are added.

The trees and thresholds are learned from every variant and decoy. Where a kind
has more of a label than its quota (``max_train``, shared equally by kinds and
labels), these rows weigh less, so that together they weigh as much as the
quota. Patterns, scores and selection cover every whole text. The patterns start a run only
where one begins and never give characters back, so a text of any length is
matched in linear time. Texts are read once and never shuffled: only matches
move, and running sums over a text's matches give the positions.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pinning import pinned

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = "[A-Za-z0-9-]"
#: (kind, base span or proposal, what a text must contain to be matched, pattern)
PATTERNS = (
    ("email", True, "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++"),
    ("ip", True, ".", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", True, "", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", True, "+", r"\+[0-9][\x20().0-9-]+(?<=[0-9])(?<!\+[0-9])"),
    ("email", False, "@", rf"(?<!{_LOCAL}){_LOCAL}++\x20?@\x20?[A-Za-z0-9.-]++"),
    ("email", False, "at", rf"(?<!{_LOCAL}){_LOCAL}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9.-]++"),
    ("ip", False, ".", r"(?<![0-9.])[0-9]{1,5}+(?:\.[0-9]{1,5}+){2,7}+"),
    ("card", False, "", r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,22}+"),
    ("phone", False, "", r"(?<![0-9+])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){5,16}+"),
)
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
FEATURES = 21


def _hits(text, number: int, kind: str, contained: str, pattern: str):
    """Every match of one pattern with the text around it, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"),
                                    F.slice(gaps, 2, F.size(found)).alias("a")),
                       lambda x, i: F.struct(F.lit(number).alias("number"), i.alias("pos"), x["m"].alias("match"),
                                             F.length(x["g"]).alias("gap"), F.right(x["g"], F.lit(24)).alias("before"),
                                             F.left(x["a"], F.lit(8)).alias("after")))
    none = F.expr("CAST(array() AS array<struct<number:int,pos:int,match:string,gap:int,before:string,after:string>>)")
    needed = text.rlike("[0-9]") if kind != "email" else F.lit(True)
    if contained:
        needed = needed & text.contains(contained)
    return F.when(needed, rows).otherwise(none)


def _luhn(digits):
    """Whether the digit string passes the Luhn check."""
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + _luhn_digit(digits, i))
    return total % 10 == 0


def _luhn_digit(digits, i):
    d = F.substring(digits, i, F.lit(1)).cast("int")
    twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)


def _valid():
    """Whether a base match is a span: the rules beside the patterns."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    return (F.when(F.col("kind") == "ip", F.col("match").rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
            .when(F.col("kind") == "card", F.when(n.between(16, 19), _luhn(digits)).otherwise(F.lit(False)))
            .when(F.col("kind") == "phone", n.between(8, 15)).otherwise(F.lit(True)))


def _variant():
    """A base match as the generators of its kind look for it, without the
    marks of the strict format; the form goes by a hash."""
    m = F.col("match")
    form = F.pmod(F.xxhash64("match", "before"), F.lit(4))
    at = F.get(F.array(*[F.lit(x) for x in (" [at] ", "(at)", " @ ", " (at) ")]), form.cast("int"))
    plain = F.regexp_replace(m, r"^\+", "")
    phone = (F.when(form == 0, F.concat(F.lit("00"), plain))
             .when(form == 1, F.regexp_replace(F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]+", ""), r"^\+", "")).otherwise(plain))
    dotted = F.regexp_replace(F.regexp_replace(m, "[^0-9]", ""), "([0-9]{4})(?=[0-9])", "$1.")
    return (F.when(F.col("kind") == "email", F.concat_ws("", F.substring_index(m, "@", 1), at, F.substring_index(m, "@", -1)))
            .when(F.col("kind") == "phone", phone)
            .when((F.col("kind") == "card") & (form < 2), dotted).otherwise(m))


def _proposable():
    """Whether a generator of the kind would propose the whole match."""
    out = F.lit(False)
    for kind, strict, _, pattern in PATTERNS:
        if not strict:
            out = out | ((F.col("kind") == kind) & F.col("match").rlike(f"^(?:{pattern})$"))
    return out


def _decoy():
    """Whether a proposal cannot be a span of its kind, by rules that hold
    for hidden forms too."""
    m = F.col("match")
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    named = F.col("before").rlike(r"(?i)(?<![a-z])(?:id|no|nr|number|sku|order|ref|isbn|version|invoice|serial|token|key|hash)[\x20:#=.\"']{0,4}$")
    called = F.col("before").rlike(r"(?i)(?:phone|tel|call|fax|mobile)[^\n]{0,12}$")
    return (F.when(F.col("kind") == "email", ~m.rlike(r"[A-Za-z].*(?:@|at[)\]]).*[A-Za-z0-9]\.[A-Za-z]{2,}[.-]*$"))
            .when(F.col("kind") == "ip", ~m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
            .when(F.col("kind") == "card", ~F.when(n.between(16, 19), _luhn(digits)).otherwise(F.lit(False)))
            .otherwise(~n.between(8, 15) | named | (~called & m.rlike(r"^(?:[0-9]+|[0-9]{4}-[0-9]{2}-[0-9]{2}.*|[0-9]+\.[0-9]+)$"))))


def _features():
    """Format of the match and the words around it, as a vector."""
    m, before, after = F.col("match"), F.col("before"), F.col("after")

    def count(pattern):
        return F.regexp_count(m, F.lit(pattern)).cast("double")

    def told(words):
        return before.rlike(rf"(?i)(?:{words})[^\n]{{0,12}}$").cast("double")

    digit_runs = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    cols = [F.length(m).cast("double"), count("[0-9]"), count(r"\."), count("-"), count(r"[()]"),
            count("[A-Za-z]"), F.size(digit_runs).cast("double"),
            F.coalesce(F.array_max(F.transform(digit_runs, lambda x: F.length(x))), F.lit(0)).cast("double"),
            F.coalesce(F.array_min(F.transform(digit_runs, lambda x: F.length(x))), F.lit(0)).cast("double"),
            told("mail|write to|contact"), told("phone|tel|call|fax|mobile"), told("card|visa|credit|account"),
            told("ip|host|server|addr"), told("token|key|secret|id|sha|hash|isbn|version|no"),
            before.rlike(r"[=\"']\x20?$").cast("double"), before.rlike(r"[A-Za-z0-9_]$").cast("double"),
            after.rlike(r"^[A-Za-z0-9_\"]").cast("double"),
            *[(F.col("kind") == k).cast("double") for k in KINDS]]
    assert len(cols) == FEATURES
    return array_to_vector(F.array(*cols))


def _added(spans: DataFrame, max_train: int, precision: float) -> DataFrame | None:
    """The proposals that the trees select; None where nothing can be learned."""
    key = ["id", "row"]
    order = F.when(F.col("base"), 0).otherwise(1)
    up = Window.partitionBy(*key).orderBy("start", order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*key).orderBy("start", order).rowsBetween(0, Window.unboundedFollowing)
    met = (F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(up) > F.col("start"), F.lit(False))
           | F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(down) < F.col("end"), F.lit(False)))
    h = F.md5(F.concat_ws(":", "kind", "match", "before")).alias("h")
    judged = pinned(spans.withColumn("met", met).where(~F.col("base") & ~F.col("met"))
                    .select(*key, "kind", "start", "end", F.lit(0.0).alias("label"), h, _decoy().alias("decoy"), _features().alias("features")), "proposals")
    variants = (spans.where("base").withColumn("match", _variant()).where(_proposable())
                .select("kind", F.lit(1.0).alias("label"), h, _features().alias("features")))
    known = pinned(variants.unionByName(judged.where("decoy").select("kind", "label", "h", "features")), "known")
    share = {(r["kind"], r["label"]): min(1.0, max_train / (2 * len(KINDS)) / r["count"])
             for r in known.groupBy("kind", "label").count().collect()}  # two rows per kind at most
    fold = F.pmod(F.xxhash64("h"), F.lit(4)) == 0
    if known.where(~fold).select("label").distinct().count() < 2:
        return None
    weight = F.lit(1.0)
    for (kind, label), w in sorted(share.items()):
        weight = F.when((F.col("kind") == kind) & (F.col("label") == label), F.lit(w)).otherwise(weight)
    model = GBTClassifier(maxIter=12, maxDepth=4, maxBins=32, stepSize=0.3, seed=5, checkpointInterval=-1,
                          cacheNodeIds=False, weightCol="weight").fit(known.where(~fold).withColumn("weight", weight))

    def scored(df):
        return model.transform(df).withColumn("p", vector_to_array("probability")[1])

    steps = (scored(known.where(fold)).groupBy("kind", F.floor(F.col("p") * 50).alias("step"))
             .agg(F.sum("label").alias("hits"), F.sum(1 - F.col("label")).alias("misses")).orderBy(F.desc("step")).collect())  # <= 51 per kind
    wanted = F.lit(False)
    for kind in KINDS:
        hits = n = 0
        threshold = None
        for r in steps:
            if r["kind"] == kind:
                found = r["hits"] * share.get((kind, 1.0), 1.0)
                hits, n = hits + found, n + found + r["misses"] * share.get((kind, 0.0), 1.0)
                if hits and hits >= precision * n:
                    threshold = r["step"] / 50
        if threshold is not None:
            wanted = wanted | ((F.col("kind") == kind) & (F.col("p") >= max(threshold, 0.5)))
    return scored(judged.where("NOT decoy")).where(wanted).select(*key, "kind", "start", "end").distinct()


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 20_000,
                       precision: float = 0.95) -> DataFrame:
    """One row per document: ``(id_col, base, spans)``, two sorted arrays of
    ``struct<rank, start, end, kind>`` (code points, end exclusive; rank is the
    kind's place in ``KINDS``). ``base`` holds the base spans, ``spans`` those
    and the added ones.

    * base spans are leftmost and non-overlapping per kind; a match that fails
      its check is dropped and not tried again from a later start;
    * an added span overlaps no base span;
    * null or empty text: empty arrays; null ids and rows that repeat an id:
      every row gives a row with the spans of its own text;
    * other columns play no part; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    arrays = [_hits(F.col("text"), i, kind, contained, pattern) for i, (kind, _, contained, pattern) in enumerate(PATTERNS)]
    found = pinned(docs.select(F.col(id_col).alias("id"), text.alias("text"))
                   .select("id", F.xxhash64("text").alias("row"), F.flatten(F.array(*arrays)).alias("hits")), "matches")
    kinds = F.array(*[F.lit(p[0]) for p in PATTERNS])
    strict = F.array(*[F.lit(p[1]) for p in PATTERNS])
    hits = (found.where(F.size("hits") > 0).select("id", "row", F.explode("hits").alias("x")).select("id", "row", "x.*")
            .dropDuplicates(["id", "row", "number", "pos"])  # equal rows
            .withColumn("kind", F.get(kinds, F.col("number"))).withColumn("base", F.get(strict, F.col("number"))))
    so_far = Window.partitionBy("id", "row", "number").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    spans = pinned(hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
                   .where(~F.col("base") | _valid()), "spans")
    chosen = spans.where("base").select("id", "row", "kind", "start", "end", "base")
    added = _added(spans, max_train, precision)
    if added is not None:
        chosen = chosen.unionByName(added.withColumn("base", F.lit(False)))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(rank.alias("rank"), "start", "end", "kind")
    per_row = chosen.groupBy(F.col("id").alias("i"), F.col("row").alias("r")).agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.expr("CAST(array() AS array<struct<rank:int,start:bigint,end:bigint,kind:string>>)")
    return (found.select("id", "row").join(per_row, F.col("id").eqNullSafe(F.col("i")) & (F.col("row") == F.col("r")), "left")
            .select(F.col("id").alias(id_col), F.coalesce("base", none).alias("base"),
                    F.coalesce("spans", none).alias("spans")))


def spelled(spans):
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets
    (overlapping spans are merged under the first one's kind); for ids that
    are unique and not null, other rows pass unchanged."""
    found = find_personal_data(docs, id_col, text_col, **settings).where(F.size("spans") > 0)
    cut = F.aggregate(
        F.sort_array(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                             s["kind"].alias("kind")))),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))
        .otherwise(F.struct(F.concat(acc["out"], F.substring(F.col("__text"), (acc["at"] + 1).cast("int"),
                                                              (s["start"] - acc["at"]).cast("int")),
                                     F.lit("<"), s["kind"], F.lit(">")).alias("out"), s["end"].alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), (acc["at"] + 1).cast("int"), F.length("__text"))))
    rows = docs.withColumn("__text", F.col(text_col).cast("string"))
    side = found.select(F.col(id_col).alias("__id"), F.col("spans").alias("__spans")).dropDuplicates(["__id"])
    return (rows.join(side, rows[id_col] == side["__id"], "left")
            .withColumn(text_col, F.when(F.col("__spans").isNull(), F.col("__text")).otherwise(cut))
            .select(*docs.columns))
