"""Exact top-k search by inner product, block at a time (operator 1).

Rows are laid out in ranges of their id; each range is cut into blocks, a
block's forward index is the matrix of its vectors, and its summary the
largest and the smallest value of every component. For a query q the bound of
a block is ``sum(max(q_t * largest_t, q_t * smallest_t))``. Blocks are ordered
by that bound; each query scores the forward index of its best block first,
which gives a lower bound of its kth score, then goes down the order until the
bounds fall below its kth score. Blocks whose bound equals it are still
scored, so ties are settled by the smaller id.

Queries are a stated set: they are packed into groups of ``QUERIES`` and meet
groups of ``GROUP`` blocks by an equi-join on the group's number, so no task
holds more than one group of each. A first pass scores only every query's best
block overall; the kth scores found there drop whole block groups in the
second pass before anything is sent.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pinning import pinned

ROWS = 512  # rows of a block
GROUP = 32  # blocks of a group
QUERIES = 1024  # queries of a group
_EXACT = 2 ** 53
_BLOCK = "block long, n int, dim int, ids binary, vectors binary, largest binary, smallest binary"
_HITS = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, v)`` with ``floor(scale * x)`` per component, x as double; rows
    without id, or with a null vector or null or non-finite components, go."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
            .where(F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v")))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of integer matrices: in doubles while every partial sum
    fits, else in whole numbers."""
    dim = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (a, b))
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, dim)
    if most < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    out = a.astype(object) @ b.T.astype(object)  # beyond 64 bits scores stop at the limits
    return np.clip(out, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _bounds(queries: np.ndarray, largest: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    return _dot(np.maximum(queries, 0), largest) + _dot(np.minimum(queries, 0), smallest)


def _blocks(frames):
    rows: list = []

    def made(rows):
        dim = max(len(v) for _, v in rows)
        m = _matrix([v for _, v in rows], dim)
        return {"block": rows[0][0], "n": len(rows), "dim": dim, "ids": np.array([i for i, _ in rows], np.int64).tobytes(),
                "vectors": m.tobytes(), "largest": m.max(axis=0).tobytes(), "smallest": m.min(axis=0).tobytes()}

    for frame in frames:
        out = []
        for row in zip(frame["id"], frame["v"], strict=True):
            rows.append(row)
            if len(rows) == ROWS:
                out.append(made(rows))
                rows = []
        if out:
            yield pd.DataFrame(out)
    if rows:
        yield pd.DataFrame([made(rows)])


def _ints(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(-1, dim) if dim else np.zeros((1, 0), np.int64)


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    dim = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, dim - p.shape[1]))) for p in parts]) if parts else np.zeros((0, 0), np.int64)


def _best_block(key, queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    """Per query the block of this group with the highest bound."""
    if not len(queries) or not len(blocks):
        return pd.DataFrame({"query_id": [], "group": [], "block": [], "bound": []}).astype("int64")
    q = _matrix(queries["v"], max((len(v) for v in queries["v"]), default=0))
    bound = _bounds(q, _stack([_ints(x, d) for x, d in zip(blocks["largest"], blocks["dim"], strict=True)]),
                    _stack([_ints(x, d) for x, d in zip(blocks["smallest"], blocks["dim"], strict=True)]))
    best = bound.argmax(axis=1)
    return pd.DataFrame({"query_id": queries["id"].to_numpy(), "group": key[0], "block": blocks["block"].to_numpy()[best],
                         "bound": bound[np.arange(len(best)), best]})


def _search(k: int):
    def run(key, queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if not len(queries) or not len(blocks):
            return none
        dims = blocks["dim"].tolist()
        ids = [np.frombuffer(x, np.int64) for x in blocks["ids"]]
        index = [_ints(x, d) if d else np.zeros((n, 0), np.int64) for x, d, n in zip(blocks["vectors"], dims, blocks["n"], strict=True)]
        own = queries["id"].to_numpy()
        q = _matrix(queries["v"], max((len(v) for v in queries["v"]), default=0))
        bound = _bounds(q, _stack([_ints(x, d) for x, d in zip(blocks["largest"], dims, strict=True)]),
                        _stack([_ints(x, d) for x, d in zip(blocks["smallest"], dims, strict=True)]))
        order = np.argsort(-bound, axis=1, kind="stable")
        kth = queries["kth"].tolist()  # lower bounds from the first pass
        hits: list[list[tuple[int, int]]] = [[] for _ in own]  # (-score, id), the k best
        for step in range(bound.shape[1]):
            at = order[:, step]
            live = [i for i in range(len(own)) if bound[i, at[i]] >= kth[i]]
            if not live:
                break  # bounds only fall from here on
            for b in sorted({int(at[i]) for i in live}):
                asked = [i for i in live if at[i] == b]
                scores = _dot(q[asked], index[b])
                for i, row in zip(asked, scores, strict=True):
                    good = np.flatnonzero((row >= kth[i]) & (ids[b] != own[i]))
                    if len(good) > k:
                        good = good[np.lexsort((ids[b][good], -row[good]))[:k]]
                    if len(good):
                        hits[i] = sorted(hits[i] + list(zip((-row[good]).tolist(), ids[b][good].tolist(), strict=True)))[:k]
                        if len(hits[i]) == k:
                            kth[i] = max(kth[i], -hits[i][-1][0])
        found = [(own[i], v, -s) for i, h in enumerate(hits) for s, v in h]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64") if found else none
    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best per query; Spark keeps k per query before it shuffles."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 1024) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of the highest
    integer inner product for every row that ``is_query`` (a condition on
    ``id``) holds for, the row itself left out; fewer if there are fewer.

    * ties go to the smaller id, ranks start at 1;
    * shorter vectors count as padded with zeros;
    * rows that repeat an id and vector count once; of rows that repeat an id
      with other vectors the smallest vector counts;
    * null ids and vectors, and null or non-finite components: no part;
    * an empty table, or no query: no rows.
    """
    whole = whole_vectors(rows, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    whole = pinned(whole, "vectors")
    n = whole.count()
    groups = max(1, -(-n // (ROWS * GROUP)))  # ranges of the id, so memory per task is bounded
    blocks = pinned(whole.repartitionByRange(groups, "id").sortWithinPartitions("id").mapInPandas(_blocks, _BLOCK)
                    .withColumn("group", F.spark_partition_id().cast("long")), "blocks")
    packs = max(1, -(-whole.where(is_query).count() // QUERIES))
    queries = pinned(whole.where(is_query).withColumn("pack", F.pmod(F.xxhash64("id"), F.lit(packs))), "queries")

    def paired(left, right, run, schema):
        asked = left.select(F.col("group").alias("group"), F.col("pack").alias("pack")).distinct()
        met = right.join(asked, "group")
        return left.groupBy("group", "pack").cogroup(met.groupBy("group", "pack")).applyInPandas(run, schema)

    # every pack of queries meets every group of blocks, summaries first; the
    # cluster may have cut more ranges than asked for, so their number is read
    last = blocks.agg(F.coalesce(F.max("group"), F.lit(0).cast("long"))).first()[0]
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))
    bounds = pinned(paired(queries.withColumn("group", F.explode(numbers)), blocks.drop("ids", "vectors"), _best_block,
                           "query_id long, group long, block long, bound long"), "bounds")
    least = F.lit(-2 ** 63).cast("long")
    best = bounds.groupBy(F.col("query_id").alias("id")).agg(F.max_by("block", F.struct("bound", -F.col("block"))).alias("group"))
    seeds = _top(paired(queries.join(best, "id").withColumn("kth", least),
                        blocks.withColumn("group", F.col("block")), _search(k), _HITS), k)
    floor = seeds.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    told = queries.join(floor.where(F.col("n") == k).select("id", "kth"), "id", "left").withColumn("kth", F.coalesce("kth", least))
    # only block groups whose best bound reaches the query's kth score so far
    second = (told.join(bounds.select(F.col("query_id").alias("id"), "group", "bound"), "id")
              .where(F.col("bound") >= F.col("kth")).drop("bound"))
    return _top(paired(second, blocks, _search(k), _HITS), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
