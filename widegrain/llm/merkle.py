"""Merkle manifest of a dataset by slot pivots (operator 12).

Every row is a leaf, the SHA-256 of its columns written unambiguously. Within
a group (a language) leaves are numbered by id, and every ``fanout``
consecutive nodes form a parent: a conditional aggregate per slot spreads the
children of a parent into ``fanout`` columns, the concatenation of the columns
is hashed into the parent's digest, and leaving the own slot's column out
yields a child's siblings. The groups' roots form one more tree of the same
kind, whose root stands for the dataset. Proofs are handed down the levels
from the root, each parent row giving its slots the siblings above them.

Numbers come from range partitions: rows are cut into ranges of (group, id),
numbered within a range, and shifted by the rows of the ranges before, so a
group of any size is spread over many tasks. Every level is written once; a
level has ``fanout`` times fewer rows than the one below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pinning import pinned

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ABOVE = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def written(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return digest(F.concat(*[written(c) for c in columns.values()]))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their number from 0 in ``group`` by ``order``,
    and ``n``, the rows of the group. Rows equal in both are numbered as they
    stand. No range holds more than its share, whatever the groups' sizes."""
    cut = pinned(rows.withColumn("__tie", F.monotonically_increasing_id())
                 .repartitionByRange(F.col(group), *[F.col(c) for c in order], F.col("__tie"))
                 .withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy(F.col(group).alias("__g"), F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy("__g")
    before = whole.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__g", "__r", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"), F.sum("__rows").over(whole).alias("n"))
    inside = Window.partitionBy(group, "__range").orderBy(*order, "__tie")
    placed = cut.withColumn("__at", F.row_number().over(inside) - 1)
    return (placed.join(starts, (placed[group] == starts["__g"]) & (placed["__range"] == starts["__r"]))
            .select(*rows.columns, (F.col("__at") + F.col("__start")).cast("long").alias("idx"), "n"))


def _slots(fanout: int, value: Column) -> list[Column]:
    return [F.max(F.when(F.pmod("idx", F.lit(fanout)) == i, value)) for i in range(fanout)]


def parents(nodes: DataFrame, group: str, fanout: int, kept: list[str] = ()) -> DataFrame:
    """One row per parent of ``nodes(group, idx, n, h, ...)`` in groups of more
    than one node: ``s0..`` hold the children's digests, ``k0..`` structs of
    the ``kept`` columns, ``h`` the digest of the slots, ``idx`` and ``n`` are
    those of the level above."""
    aggs = [x.alias(f"s{i}") for i, x in enumerate(_slots(fanout, F.col("h")))]
    if kept:
        aggs += [x.alias(f"k{i}") for i, x in enumerate(_slots(fanout, F.struct(*kept)))]
    made = (nodes.where("n > 1").groupBy(F.col(group), F.floor(F.col("idx") / fanout).alias("__parent"))
            .agg(*aggs, F.ceil(F.max("n") / fanout).alias("n")))
    return made.withColumnRenamed("__parent", "idx").withColumn("h", digest(F.concat_ws("", *[f"s{i}" for i in range(fanout)])))


def levels_over(nodes: DataFrame, group: str, fanout: int, kept: list[str], most: int) -> list[DataFrame]:
    """The levels of parents over ``nodes``, whose largest group has ``most``."""
    out, below = [], nodes
    while most > 1:
        below = pinned(parents(below, group, fanout, kept if not out else []), f"level-{len(out)}")
        out.append(below)
        most = -(-most // fanout)
    return out


def roots(nodes: DataFrame, levels: list[DataFrame], group: str, kept: list[str] = ()) -> DataFrame:
    """``(group, h)`` of every group's last node."""
    out = nodes.where("n = 1").select(group, "h")
    for level in levels:
        out = out.unionByName(level.where("n = 1").select(group, "h"))
    return out


def children(level: DataFrame, group: str, fanout: int, kept: bool, passed: list[str]) -> DataFrame:
    """The children of ``level``'s rows, which carry ``above``: each with its
    siblings, the slots left and right of its own, before those above."""
    def of(i: int) -> Column:
        left = F.concat_ws("", *[f"s{j}" for j in range(i)]) if i else F.lit("")
        right = F.concat_ws("", *[f"s{j}" for j in range(i + 1, fanout)]) if i + 1 < fanout else F.lit("")
        above = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("above"))
        own = [F.col(f"k{i}").alias("own")] if kept else []
        return F.when(F.col(f"s{i}").isNotNull(), F.struct((F.col("idx") * fanout + i).cast("long").alias("idx"), F.col(f"s{i}").alias("h"),
                                                             above.alias("above"), *own))
    spread = level.select(group, *passed, F.explode(F.array_compact(F.array(*[of(i) for i in range(fanout)]))).alias("__c"))
    return spread.select(group, *passed, "__c.*")


def handed_down(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, group: str, fanout: int, kept: list[str],
                passed: list[str]) -> DataFrame:
    """``(group, passed..., h, above, own)`` of every node: ``tops(group,
    passed..., above)`` holds what stands above each group's root. ``own`` is
    the struct of the node's ``kept`` columns."""
    tops = tops.select(F.col(group).alias("__top"), *passed, F.col("above").cast(_ABOVE).alias("above"))

    def at_top(rows):
        rows = rows.where("n = 1")
        return rows.join(tops, rows[group] == F.col("__top")).drop("__top")

    above = None  # of the rows of the level at hand
    for k in reversed(range(len(levels))):
        level = levels[k]
        known = at_top(level)
        if above is not None:
            told = above.select(F.col(group).alias("__g"), F.col("idx").alias("__i"), *passed, "above")
            known = known.unionByName(level.join(told, (level[group] == told["__g"]) & (level["idx"] == told["__i"])).drop("__g", "__i"))
        above = children(known, group, fanout, k == 0 and bool(kept), passed)
    alone = at_top(nodes).select(group, *passed, "h", "above", *([F.struct(*kept).alias("own")] if kept else []))
    return alone if above is None else above.select(*alone.columns).unionByName(alone)


def folded(leaf: Column, above: Column) -> Column:
    """The root that a leaf's digest leads to with these siblings."""
    return F.aggregate(above, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def manifest(docs: DataFrame, fanout: int = 8, tampered=None, id_col: str = "doc_id", group_col: str = "lang",
             columns=LEAF_COLUMNS, text_col: str = "text") -> DataFrame:
    """Per row ``(id_col, leaf, subroot, root, proof_sha256, folded_root,
    verified)`` and the proof itself in ``above``, an array of the siblings
    ``(left, right)`` of each level from the leaf to the root.

    ``tampered`` is a condition on ``docs``: where it holds, the folded root is
    recomputed from a leaf whose text has A-Z lower-cased (a null text, or one
    without such letters, stays and verifies).

    * a null group is a group of its own and stands first; nulls in columns
      are written ``-``, empty texts ``0:``; null ids stand first in their
      group and are not tampered with;
    * rows that repeat an id are leaves of their own, in order of their
      digest; equal rows are leaves of equal digest, each with its own place;
    * a group of one row has that leaf as its root, a dataset of one group has
      the group's root; its proof is the digest of the empty text;
    * an empty table gives no rows; other columns take no part.
    """
    if fanout < 2:
        raise ValueError("a parent has at least two children")
    tamper = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    plain = {c: F.col(c) for c in columns}
    lower = plain | {text_col: F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)} if text_col in plain else plain
    # groups as texts without nulls, in the same order: null is empty, others begin with "="
    leaves = pinned(docs.select(F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("g"),
                                F.col(id_col).alias("id"), leaf_digest(plain).alias("h"),
                                F.when(tamper, leaf_digest(lower)).alias("forged")), "leaves")
    nodes = pinned(numbered(leaves, "g", ["id", "h"]), "numbered")
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = levels_over(nodes, "g", fanout, ["id", "forged"], most)

    subroots = pinned(roots(nodes, levels, "g"), "subroots")
    groups = pinned(numbered(subroots.select(F.lit(0).alias("all"), "g", "h"), "all", ["g"]), "groups")
    most = groups.agg(F.max("n")).first()[0] or 0
    upper = levels_over(groups, "all", fanout, ["g"], most)
    top = roots(groups, upper, "all").select(F.col("all").alias("all"), F.col("h").alias("root"), F.array().cast(_ABOVE).alias("above"))
    tops = handed_down(groups, upper, top, "all", fanout, ["g"], ["root"]).select(
        F.col("own.g").alias("g"), F.col("h").alias("subroot"), "root", "above")

    rows = handed_down(nodes, levels, pinned(tops, "tops"), "g", fanout, ["id", "forged"], ["subroot", "root"])
    proof = F.aggregate("above", F.lit(""), lambda a, s: F.concat(a, s["left"], s["right"]))
    told = rows.select(F.col("own.id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", digest(proof).alias("proof_sha256"),
                       folded(F.coalesce("own.forged", "h"), F.col("above")).alias("folded_root"), "above")
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
