"""Connected components of a link table as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pinning import pinned


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` -> ``(id, comp)``: for every id in a link, the smallest
    id that it reaches; links of an id to itself and nulls are left out.

    Each round every id takes its smallest neighbour's id (partial aggregates,
    so a hub of any degree is split) and that one's own choice, and the links
    are contracted to those between different choices. Groups of copies around
    one id are gone after the first round; rounds are about the logarithm of
    the longest path. An empty table gives an empty result.
    """
    edges = pinned(links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                   .distinct(), "links")
    comps = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = pinned(both.groupBy(F.col("u").alias("id")).agg(F.least(F.col("id"), F.min("v")).alias("to")), "labels")
        roots = first.select(F.col("id").alias("root"), F.col("to").alias("jump"))
        step = pinned(first.join(roots, first["to"] == roots["root"]).select("id", F.col("jump").alias("to")), "labels")
        if comps is None:
            comps = step.withColumnRenamed("to", "comp")
        else:
            moved = step.select(F.col("id").alias("comp"), "to")
            comps = pinned(comps.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")
        at_u = step.select(F.col("id").alias("u"), F.col("to").alias("a"))
        at_v = step.select(F.col("id").alias("v"), F.col("to").alias("b"))
        edges = pinned(edges.join(at_u, "u").join(at_v, "v").where("a <> b")
                       .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
        if edges.isEmpty():
            return comps
