"""MinHash near-duplicates with tensored banding (operator 8).

Two small collections of ``m`` minhash groups of ``rows`` values each are
computed per text; every pair (i, j) of a group of the first and one of the
second collection is the key of one of ``m * m`` tables. 2 * m * rows minhash
values thus serve m * m tables of 2 * rows values (66 instead of 726 at a
share of 80). Texts that share a table key are candidates; whether a candidate
is a link is told by its two full shingle sets alone.

Nothing emits all pairs of a group. Texts with equal sets become one node
first. In a table bucket every member is compared with one central member;
then only buckets whose members are still in different components go on, with
more of their members as hubs, until all members are in one component or every
pair of members from different components is settled. Most of those pairs are
settled without comparing them: a shingle that few texts of the candidate
group hold is rare, and two texts that share no rare shingle have an
intersection of at most the smaller number of their other shingles. Pairs that
share a rare shingle are taken from that shingle's few holders, all others must
pass that bound. So the components are those of all candidate links, while a
group of thousands of copies costs a few comparisons per member.

Recall: two texts of similarity s share no table with probability
1 - (1 - (1 - s^rows)^m)^2. ``table_shape`` takes ``rows`` and ``m`` from the
share and the recall asked for at it; at a share of 80 and a recall of 0.999
they are 3 and 11, and the probability is 0.0008 at s = 0.8 and 0.00006 at 0.85.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, LongType, StructField,
                               StructType)

from .components import components
from .pinning import Scratch, pinned
from .wordhash import mix, shingle_sets, slices, stream

#: the hubs of a bucket in one round are its members outside its largest
#: component: all of them up to this number, else one per hash slot
HUBS = 512
#: a shingle is rare if one text of its candidate group holds it, or at most
#: this many texts and at most one in RARE_SHARE of the group
RARE, RARE_SHARE = 16, 8


def table_shape(share: int, recall: float) -> tuple[int, int]:
    """``(rows, m)`` for links of ``share`` percent or more: groups in which
    two texts of just that share agree about every second time, and as many of
    them as it takes to find such a pair with probability ``recall``."""
    if not 0 < share <= 100 or not 0 < recall < 1:
        raise ValueError("share must be in 1..100 and recall between 0 and 1")
    if share == 100:
        return 1, 1  # equal sets are one node without any table
    s = share / 100
    rows = max(1, round(math.log(0.5) / math.log(s)))
    missed = 1 - math.sqrt(recall)  # by one of the two collections
    return rows, math.ceil(math.log(missed) / math.log1p(-s ** rows))


def _signature(own: np.ndarray) -> bytes:
    return b"".join(int(x).to_bytes(8, "little") for x in
                    (len(own), np.add.reduce(own), np.add.reduce(mix(own + np.uint64(77)))))


def _lowered(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.encode().lower() for t in column.to_pylist()]  # bytes.lower is A-Z only


def _sketch(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for c in range(0, len(own), 8192):
        np.minimum(least, (own[c:c + 8192, None] * factors[None, :]).min(axis=0), out=least)
    return least


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("row"))


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, rows: int, m: int) -> DataFrame:
    """One row per document: id, ``row`` (hash of its text), ``n_shingles``,
    ``sig`` (equal for equal sets; null for the empty set) and the ``2 * m``
    group values of the two collections."""
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("row", LongType()), StructField("n_shingles", LongType()),
                         StructField("sig", BinaryType()), StructField("groups", ArrayType(LongType()))])
    factors = stream(2 * m * rows, 8) | np.uint64(1)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), _lowered(batch.column(1))
            for a, b in slices(texts):
                counts, sigs, groups = [], [], []
                for own in shingle_sets(texts[a:b], width):
                    counts.append(len(own))
                    if not len(own):
                        sigs.append(None), groups.append(None)
                        continue
                    least = _sketch(own, factors)
                    value = np.zeros(2 * m, np.uint64)
                    for part in least.reshape(2 * m, rows).T:
                        value = mix(value * np.uint64(0xC2B2AE3D27D4EB4F) + part)
                    sigs.append(_signature(own))
                    groups.append(value.view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(sigs, pa.binary()),
                     pa.array(groups, pa.list_(pa.int64()))], names=schema.names)

    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """``(id, text)`` -> ``(id, shingles)``, the full sets."""
    schema = StructType([rows.schema["id"], StructField("shingles", ArrayType(LongType()))])

    def run(batches):
        for batch in batches:
            lowered = _lowered(batch.column(1))
            for a, b in slices(lowered):
                own = [x.view(np.int64) for x in shingle_sets(lowered[a:b], width)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(own, pa.list_(pa.int64()))],
                                                 names=schema.names)

    return rows.select("id", "text").mapInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """``pairs(u, v)`` -> ``(u, v, linked)`` by the full sets."""
    kind = pairs.schema["u"].dataType
    schema = StructType([StructField("u", kind), StructField("v", kind), StructField("linked", BooleanType())])

    def run(batches):
        for batch in batches:
            (u_at, u_all), (v_at, v_all) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(2), batch.column(3)))
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                u_set, v_set = u_all[u_at[i]:u_at[i + 1]], v_all[v_at[i]:v_at[i + 1]]
                if 100 * min(len(u_set), len(v_set)) < share * max(len(u_set), len(v_set)):
                    continue  # no intersection reaches the share
                both = len(np.intersect1d(u_set, v_set, assume_unique=True))
                linked[i] = 100 * both >= share * (len(u_set) + len(v_set) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)], names=schema.names)

    def side(name):
        return sets.select(F.col("id").alias(name), F.col("shingles").alias(f"{name}_set"))

    rows = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "u_set", "v_set")
    return rows.mapInArrow(run, schema).groupBy("u", "v").agg(F.max("linked").alias("linked"))


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``(id, comp)`` after new links: only the components that
    the links touch are joined anew."""
    ends = links.select(F.col("u").alias("id")).unionByName(links.select(F.col("v").alias("id")))
    known = comps.unionByName(ends.withColumn("comp", F.col("id"))).groupBy("id").agg(F.min("comp").alias("comp"))
    known = pinned(known, "known")
    named = known.select(F.col("id").alias("end"), F.col("comp").alias("name"))
    between = (links.join(named.withColumnRenamed("end", "u").withColumnRenamed("name", "a"), "u")
               .join(named.withColumnRenamed("end", "v").withColumnRenamed("name", "b"), "v")
               .where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    moved = components(between).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    return pinned(known.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "components")


def _holdings(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``(token, id, rare)``: every shingle of every candidate text, named
    within the group of texts that are joined by candidate pairs; ``rare`` is
    its number of holders if it is rare, else null."""
    groups = components(members.where("hub <> id").select(F.col("hub").alias("u"), F.col("id").alias("v")))
    groups = groups.join(groups.groupBy("comp").agg(F.count(F.lit(1)).alias("texts")), "comp")
    rows = pinned(sets.select("id", "shingles").join(groups, "id")
                  .select("id", "comp", "texts", F.explode("shingles").alias("shingle"))
                  .select("id", F.xxhash64("comp", "shingle").alias("token"),
                          F.least(F.lit(RARE), F.greatest(F.lit(1), F.floor(F.col("texts") / RARE_SHARE))).alias("most")),
                  "shingles")
    few = rows.groupBy("token").agg(F.count(F.lit(1)).alias("rare"), F.max("most").alias("most")).where("rare <= most")
    return rows.select("token", "id").join(few.select("token", "rare"), "token", "left")


def _may_link(share: int, n1: str, rest1: str, n2: str, rest2: str):
    """Whether two texts that share no rare shingle can reach the share."""
    most = F.least(rest1, rest2)
    return 100 * most >= share * (F.col(n1) + F.col(n2) - most)


def _first_table(key: str, groups1: str, groups2: str, m: int):
    """Whether ``key`` names the first table that the two texts share."""
    equal = F.zip_with(groups1, groups2, lambda x, y: x == y)
    i = F.array_position(F.slice(equal, 1, m), True) - 1
    j = F.array_position(F.slice(equal, m + 1, m), True) - 1
    own = F.xxhash64((i * m + j).cast("int"), F.get(F.col(groups1), i.cast("int")), F.get(F.col(groups1), (j + m).cast("int")))
    return F.col(key) == own


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2,
                    share: int = 80, recall: float = 0.999) -> DataFrame:
    """One row per document: ``(id_col, n_shingles, component_id, kept)``, as a
    written table; the tables on the way to it are deleted.

    Documents whose sets of distinct ``width``-word shingles (A-Z lower-cased)
    have ``100 * intersection >= share * union`` are linked; ``component_id``
    is the smallest id reachable and ``kept`` marks the rows that carry it. A
    link of just ``share`` percent is a candidate with probability ``recall``,
    closer ones are more surely; every candidate is decided on its full sets.

    * null or wordless text: empty set, linked with nothing, its own component;
    * fewer than ``width`` words: the whole sequence is one shingle;
    * null id: no component (null) and kept, it links with nothing;
    * rows that repeat an id are one document with several texts: it is linked
      if one of them is; every row is returned with its own ``n_shingles``;
    * other columns of ``docs`` play no part; an empty table gives no rows.
    """
    rows, m = table_shape(share, recall)
    with Scratch(docs.sparkSession) as scratch:
        return scratch.keep(_components_of(docs, id_col, text_col, width, share, rows, m), "near-duplicates")


def _components_of(docs: DataFrame, id_col: str, text_col: str, width: int, share: int, rows: int, m: int) -> DataFrame:
    marks = pinned(sketches(docs, id_col, text_col, width, rows, m), "sketches")
    named = marks.where(F.col("id").isNotNull() & F.col("sig").isNotNull())
    # equal sets: one node with a number; its text is that of one row, by id and text hash
    nodes = pinned(named.groupBy("sig").agg(F.min(F.struct("id", "row")).alias("of"), F.first("groups").alias("groups"))
                   .select(F.monotonically_increasing_id().alias("node"), F.col("of.id").alias("least"),
                           F.col("of.row").alias("row"), "sig", "groups"), "nodes")
    owner = pinned(named.select("id", "sig").distinct().join(nodes.select("sig", "node", "least"), "sig")
                   .select("id", "node", "least"), "owners")
    several = (owner.groupBy("id").agg(F.min("node").alias("u"), F.max("node").alias("other"))
               .where(F.col("u") != F.col("other")).select("id", "u"))
    same = pinned(owner.join(several, "id").select("u", F.col("node").alias("v")).where("u <> v").distinct(), "same")

    # a table key is shared only if both of its group values are: most are not
    values = nodes.select("node", F.posexplode("groups").alias("i", "a"))
    shared = pinned(values.groupBy("i", "a").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
                    .where("hub <> last").select("i", "a"), "shared")
    useful = values.join(shared, ["i", "a"]).groupBy("node").agg(F.collect_list(F.struct("i", "a")).alias("all"))
    first = useful.select("node", F.inline(F.filter("all", lambda x: x["i"] < m)), F.filter("all", lambda x: x["i"] >= m).alias("seconds"))
    keys = pinned(first.select("node", "i", "a", F.inline("seconds").alias("j", "b"))
                  .select(F.xxhash64(F.col("i") * m + F.col("j") - m, "a", "b").alias("key"), F.col("node").alias("id")), "keys")
    buckets = pinned(keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
                     .where("hub <> last").select("key", "hub"), "buckets")
    members = pinned(keys.join(buckets, "key"), "members")

    wanted = members.select("id").distinct()
    texts = nodes.join(wanted.withColumnRenamed("id", "node"), "node").select("node", F.col("least").alias("id"), "row")
    # one row per node, however often its row stands in docs
    texts = (_texts(docs, id_col, text_col).dropna().join(texts, ["id", "row"]).dropDuplicates(["id", "row"])
             .select(F.col("node").alias("id"), "text"))
    sets = pinned(_sets(texts, width), "sets")
    held = _holdings(members, sets)
    sizes = pinned(held.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count("rare").alias("low")), "sizes")
    rare = pinned(held.where("rare > 1").select("token", "id"), "rare")

    # a member whose shingles are mostly rare can only link through a rare one
    rest = F.col("n") - F.col("low")
    members = pinned(members.join(sizes.where(100 * rest >= share * F.col("n")), "id")
                     .select("key", "id", "n", rest.alias("rest"), (F.col("low") / F.col("n")).alias("odd")), "members")
    central = members.groupBy("key").agg(F.min_by(F.struct("id", "n", "rest"), F.struct("odd", "id")).alias("h"))
    # from here on the central member has met all others of its bucket
    members = pinned(members.drop("odd").join(central, "key").where("h.id <> id"), "members")
    pairs = (members.where(_may_link(share, "h.n", "h.rest", "n", "rest"))
             .select(F.least("h.id", "id").alias("u"), F.greatest("h.id", "id").alias("v")).distinct())
    members = members.drop("h")
    compared = pinned(_verified(pairs, sets, share), "compared")
    tried = compared.select("u", "v")
    comps = components(same.unionByName(compared.where("linked").select("u", "v")))
    # every pair that shares a rare shingle: its holders are few
    labelled = rare.join(comps, "id", "left").select("token", "id", F.coalesce("comp", "id").alias("comp"))
    other = labelled.select("token", F.col("id").alias("u"), F.col("comp").alias("u_comp"))
    pairs = (labelled.join(other, "token").where("u < id AND u_comp <> comp")
             .select("u", F.col("id").alias("v")).distinct().join(tried, ["u", "v"], "left_anti"))
    while True:
        compared = pinned(_verified(pairs, sets, share), "compared")
        tried = tried.unionByName(compared.select("u", "v"))
        new = compared.where("linked").select("u", "v")
        if not new.isEmpty():
            comps = _merged(comps, new)
        # what is left: members that were no hub yet, in buckets that span several components
        state = pinned(members.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "labelled")
        per_comp = state.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n_comp"))
        open_keys = (per_comp.groupBy("key").agg(F.sum("n_comp").alias("size"), F.count(F.lit(1)).alias("n_comps"),
                                                 F.max_by("comp", F.struct("n_comp", "comp")).alias("largest"), F.max("n_comp").alias("most"))
                     .where("n_comps > 1").select("key", (F.col("size") - F.col("most")).alias("outside"), "largest"))
        state = pinned(state.join(open_keys, "key").join(nodes.select(F.col("node").alias("id"), "groups"), "id"), "state")
        if state.isEmpty():
            break
        slot = F.when(F.col("outside") <= HUBS, F.col("id").cast("string")).otherwise(
            F.pmod(F.xxhash64("id"), F.lit(HUBS)).cast("string"))
        hubs = pinned(state.where("comp <> largest").groupBy("key", slot.alias("slot"))
                      .agg(F.min_by(F.struct("id", "comp", "n", "rest", "groups"), "id").alias("h")).select("key", "h"), "hubs")
        # two hubs meet once, from the smaller id; a pair that shares several
        # tables is taken from the first
        once = (F.col("comp") == F.col("largest")) | (F.col("outside") > HUBS) | (F.col("h.id") < F.col("id"))
        pairs = (state.join(hubs, "key").where((F.col("comp") != F.col("h.comp")) & once)
                 .where(_may_link(share, "h.n", "h.rest", "n", "rest"))
                 .where(_first_table("key", "groups", "h.groups", m))
                 .select(F.least("h.id", "id").alias("u"), F.greatest("h.id", "id").alias("v"))
                 .distinct().join(tried, ["u", "v"], "left_anti"))
        # a bucket whose members outside its largest component all were hubs is done
        behind = pinned(state.where((F.col("outside") > HUBS) & (F.col("comp") != F.col("largest")))
                        .join(hubs.select("key", F.col("h.id").alias("id")), ["key", "id"], "left_anti")
                        .select("key", "id", "n", "rest"), "behind")
        members = behind.unionByName(state.where("comp = largest").select("key", "id", "n", "rest")
                                     .join(behind.select("key").distinct(), "key", "left_semi"))

    # a component is named by the smallest id of its nodes
    names = comps.join(nodes.select(F.col("node").alias("id"), "least"), "id").groupBy("comp").agg(F.min("least").alias("name"))
    named = comps.join(names, "comp").select(F.col("id").alias("node"), "name")
    own = owner.groupBy("id").agg(F.min(F.struct("node", "least")).alias("of")).select("id", "of.node", "of.least")
    own = own.join(named, "node", "left").select("id", F.coalesce("name", "least").alias("comp"))
    return (marks.select("id", "n_shingles").join(own, "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("comp", "id").alias("component_id"),
                    F.coalesce(F.col("id") == F.coalesce("comp", "id"), F.lit(True)).alias("kept")))
