"""Approximate nearest neighbours by inner product with vantage-point trees
(operator 13).

Inner products become distances: a vector x gets one more component
``sqrt(M² - |x|²)`` (M: the largest norm of the table) and a query gets a zero,
so that ``d² = |q|² + M² - 2 q·x`` and the nearest by distance is the one of
the largest inner product.

* Rows of one vector are one point with its ``k + 1`` smallest ids: no query
  can return more of them, whatever the size of a group of copies.
* A router, a vantage-point tree fitted on a bounded sample (``SAMPLE``
  vectors), deals every point to one of at most ``CELLS`` cells; the range of
  distances from each vantage point on a cell's path is measured over all its
  points. A cell of any size is cut by a hash into shards of about
  ``SHARD_BYTES``, and each shard gets a vantage-point tree of its own.
* A query descends to its home cell and searches one shard there, which bounds
  its kth distance. It then meets only the cells, and in their trees only the
  nodes, whose triangle-inequality bound times ``factor`` is within its kth
  distance so far. With factor one nothing that could matter is left out, so
  the search is exact; larger factors leave out more.
* Unless a factor is given, it is tuned: ``TUNED_ON`` queries are searched
  exactly against all rows, and the factor is the largest one whose pruning
  would have kept the asked share of their true neighbours.
* Queries meet shards in groups (a lane of shards, a pack of queries) of a
  bounded size. Only the router and its ranges, both bounded, go to all tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pinning import pinned

SAMPLE = 4096  # vectors that the router is fitted on, and at most twice as many are read for it
CELLS = 256  # at most
SHARD_BYTES = 2 ** 21  # of vectors per shard
LANE = 8  # shards per group
PACK = 1024  # queries per group
LEAF = 64  # points per leaf of a tree
TUNED_ON = 64  # queries that the factor is tuned on
TRIED = 8  # points tried as vantage point of a node
_SLACK = 1e-6  # of rounding in distances between vectors of norm 1
_TREE = "shard long, lane long, cell int, n int, vectors binary, id_ends binary, ids binary, nodes binary, vantage binary"
_HITS = "query_id long, vec_id long, score double, bound double"


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)`` as doubles, one row per id; rows without id, or with a
    vector that is null, zero or holds null or non-finite components, go."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(v, lambda x: x != 0)
    return (rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(F.coalesce(finite & nonzero, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v")))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class _Space:
    """Vectors as points: scaled by the largest component, and lifted."""

    def __init__(self, dim: int, largest: float, norm: float):
        self.dim, self.largest, self.norm = dim, largest, norm  # norm: the largest one, scaled

    def points(self, m: np.ndarray) -> np.ndarray:
        m = m / self.largest
        rest = np.sqrt(np.maximum(self.norm ** 2 - (m * m).sum(axis=1), 0.0))
        return np.hstack([m, rest[:, None]])

    def queries(self, m: np.ndarray) -> np.ndarray:
        return np.hstack([m / self.largest, np.zeros((len(m), 1))])


def _distance(points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((points * points).sum(axis=1) + vantage @ vantage - 2 * (points @ vantage), 0.0))


def _vantage(points: np.ndarray, rng) -> int:
    """Of a few points the one whose distances to some others vary most."""
    tried = rng.choice(len(points), min(TRIED, len(points)), replace=False)
    seen = points[rng.choice(len(points), min(256, len(points)), replace=False)]
    return int(max(tried, key=lambda i: _distance(seen, points[i]).std()))


class _Router:
    """A complete vantage-point tree of some depth; its leaves are cells."""

    def __init__(self, sample: np.ndarray, depth: int):
        rng = np.random.default_rng(13)
        self.depth = depth
        self.points = np.zeros((2 ** depth - 1, sample.shape[1]))
        self.radius = np.zeros(2 ** depth - 1)
        at = {0: sample}
        for node in range(2 ** depth - 1):
            own = at.pop(node)
            some = own if len(own) else sample
            self.points[node] = some[_vantage(some, rng)]
            d = _distance(some, self.points[node])
            self.radius[node] = np.median(d)
            if 2 * node + 2 < 2 ** depth - 1:
                at[2 * node + 1], at[2 * node + 2] = some[d < self.radius[node]], some[d >= self.radius[node]]

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each point and its distances to the path's vantage points."""
        node, far = np.zeros(len(points), int), np.zeros((len(points), self.depth))
        for level in range(self.depth):
            for k in np.unique(node):
                own = np.flatnonzero(node == k)
                far[own, level] = _distance(points[own], self.points[k])
                node[own] = 2 * k + 1 + (far[own, level] >= self.radius[k])
        return node - (2 ** self.depth - 1), far

    def bounds(self, points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least distance from each point to anything in each cell, by the
        cells' ranges ``lo`` and ``hi`` (cells x depth)."""
        far = np.stack([_distance(points, p) for p in self.points], axis=1) if self.depth else np.zeros((len(points), 0))
        out = np.zeros((len(points), 2 ** self.depth))
        for cell in range(2 ** self.depth):
            node = cell + 2 ** self.depth - 1
            for level in reversed(range(self.depth)):
                node = (node - 1) // 2
                d = far[:, node]
                out[:, cell] = np.maximum(out[:, cell], np.maximum(d - hi[cell, level], lo[cell, level] - d))
        return out


def _grow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree over the points: their order, its nodes ``(start, end, left,
    right, ranges of distances left and right)`` with children -1 for leaves,
    and the vantage point of each node."""
    rng = np.random.default_rng(13)
    order, nodes, vantage = np.arange(len(points)), [], []

    def node(start: int, end: int) -> int:
        me = len(nodes)
        nodes.append([start, end, -1, -1, 0.0, 0.0, 0.0, 0.0])
        vantage.append(np.zeros(points.shape[1]))
        if end - start <= LEAF:
            return me
        own = order[start:end]
        point = points[own[_vantage(points[own], rng)]]
        d = _distance(points[own], point)
        by = np.argsort(d, kind="stable")
        order[start:end], d = own[by], d[by]
        cut = len(d) // 2
        vantage[me] = point
        nodes[me][4:] = [d[0], d[cut - 1], d[cut], d[-1]]
        nodes[me][2] = node(start, start + cut)
        nodes[me][3] = node(start + cut, end)
        return me

    node(0, len(points))
    return order, np.array(nodes), np.array(vantage)


def _plant(space: _Space):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("first", kind="stable")
        m = _matrix(frame["v"].tolist(), space.dim)
        order, nodes, vantage = _grow(space.points(m))
        ids = [frame["ids"].iloc[i] for i in order]
        return pd.DataFrame([{"shard": frame["shard"].iloc[0], "lane": frame["shard"].iloc[0] // LANE, "cell": frame["cell"].iloc[0],
                              "n": len(m), "vectors": m[order].tobytes(),
                              "id_ends": np.cumsum([len(x) for x in ids]).astype(np.int64).tobytes(),
                              "ids": np.concatenate(ids).astype(np.int64).tobytes(), "nodes": nodes.tobytes(), "vantage": vantage.tobytes()}])
    return run


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b, summed component by component,
    so that equal vectors have equal products wherever they stand."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


class _Best:
    """The k best of each query of a pack, and the kth distance so far."""

    def __init__(self, own: np.ndarray, vectors: np.ndarray, space: _Space, kth: np.ndarray, k: int):
        self.own, self.vectors, self.space, self.k = own, vectors, space, k
        self.points = space.queries(vectors)
        self.lengths = (self.points * self.points).sum(axis=1)
        self.kth = kth / space.largest ** 2 if len(kth) else kth  # scores known to be reached by k others, scaled
        self.hits: list[list[tuple[float, int, float]]] = [[] for _ in own]  # (-score, id, bound of its leaf)

    def reach(self, at: np.ndarray) -> np.ndarray:
        """How far the kth of these queries can be."""
        return np.sqrt(np.maximum(self.lengths[at] + self.space.norm ** 2 - 2 * self.kth[at], 0.0)) + _SLACK * self.space.norm

    def meet(self, at: np.ndarray, bound: np.ndarray, vectors: np.ndarray, ids: list[np.ndarray]) -> None:
        near = self.points[at, :-1] @ (vectors / self.space.largest).T
        i, j = np.nonzero(near >= (self.kth[at] - 1e-9 * self.space.norm ** 2)[:, None])
        if not len(i):
            return
        scores = _products(self.vectors[at[i]], vectors[j])
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], len(i)], strict=True):
            q = at[i[start]]
            low = float(bound[i[start]])
            found = [(-s, int(x), low) for s, n in zip(scores[start:end].tolist(), j[start:end], strict=True) for x in ids[n] if x != self.own[q]]
            self.hits[q] = sorted(self.hits[q] + found)[:self.k]
            if len(self.hits[q]) == self.k:
                self.kth[q] = max(self.kth[q], -self.hits[q][-1][0] / self.space.largest ** 2)


def _walk(best: _Best, at: np.ndarray, bound: np.ndarray, tree, factor: float) -> None:
    """The queries ``at``, no nearer to the tree than ``bound``, through it,
    nearer children first."""
    nodes = np.frombuffer(tree.nodes).reshape(-1, 8)
    vantage = np.frombuffer(tree.vantage).reshape(len(nodes), -1)
    vectors = np.frombuffer(tree.vectors).reshape(tree.n, -1)
    ids = np.split(np.frombuffer(tree.ids, np.int64), np.frombuffer(tree.id_ends, np.int64)[:-1])
    todo = [(0, at, bound)]
    while todo:
        k, at, bound = todo.pop()
        live = bound * factor <= best.reach(at)
        at, bound = at[live], bound[live]
        if not len(at):
            continue
        start, end, left, right, *ranges = nodes[k]
        if left < 0:
            best.meet(at, bound, vectors[int(start):int(end)], ids[int(start):int(end)])
            continue
        d = _distance(best.points[at], vantage[k])
        sides = [(int(child), np.maximum(bound, np.maximum(d - hi, lo - d)))
                 for child, lo, hi in ((left, ranges[0], ranges[1]), (right, ranges[2], ranges[3]))]
        sides.sort(key=lambda x: -x[1].sum())
        todo += [(child, at, low) for child, low in sides]  # the nearer side is taken up first


def _search(space: _Space, router: _Router, lo: np.ndarray, hi: np.ndarray, k: int, factor: float):
    def run(key, queries: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        found: list = []
        if len(queries) and len(trees):
            vectors = _matrix(queries["v"].tolist(), space.dim)
            best = _Best(queries["id"].to_numpy(), vectors, space, queries["kth"].to_numpy(float).copy(), k)
            bounds = router.bounds(best.points, lo, hi)
            order = sorted(trees.itertuples(), key=lambda t: (bounds[:, t.cell].sum(), t.shard))
            for tree in order:
                at = np.flatnonzero(bounds[:, tree.cell] * factor <= best.reach(np.arange(len(vectors))))
                if len(at):
                    _walk(best, at, bounds[at, tree.cell], tree, factor)
            found = [(best.own[i], v, -s, low) for i, hits in enumerate(best.hits) for s, v, low in hits]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score", "bound"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64", "bound": "float64"})
    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def _tuned(hits, space: _Space, recall: float) -> float:
    """The largest factor that keeps ``recall`` of the true neighbours: one is
    lost where the bound of its leaf times the factor is over the kth distance."""
    by: dict[int, list] = {}
    for r in hits:
        by.setdefault(r["query_id"], []).append(r)
    limits = []
    for own in by.values():
        q = space.queries(_matrix([own[0]["v"]], space.dim))[0]
        kth = min(r["score"] for r in own) / space.largest ** 2
        reach = math.sqrt(max(q @ q + space.norm ** 2 - 2 * kth, 0.0)) + _SLACK * space.norm
        limits += [reach / r["bound"] if r["bound"] > 0 else math.inf for r in own]
    limits = sorted(limits, reverse=True)
    if not limits:
        return 1.0
    return max(1.0, min(limits[min(len(limits), math.ceil(recall * len(limits))) - 1], 1e6))


def nearest(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            factor: float | None = None, recall: float = 0.97) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows found nearest, by
    the largest inner product, to every row that ``is_query`` (a condition on
    ``id``) holds for, the row itself left out; fewer if there are fewer.

    * ``factor`` >= 1 multiplies the bounds that pruning goes by; 1 is exact;
      None tunes it to ``recall``, measured on some queries against all rows;
    * scores are sums in doubles over the original components, ties go to the
      smaller id, ranks start at 1;
    * shorter vectors count as padded with zeros;
    * rows that repeat an id count once, with the smallest of its vectors;
      equal vectors under other ids are rows like any other;
    * null ids, null and zero vectors and vectors with null or non-finite
      components take no part; an empty table, or no query: no rows.
    """
    if factor is not None and factor < 1:
        raise ValueError("factor must be at least 1, which is exact")
    spark = rows.sparkSession
    whole = pinned(whole_vectors(rows, id_col, vector_col), "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    size = whole.agg(F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    if size["dim"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    largest = float(size["largest"])
    scaled = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))
    # at most k + 1 ids of equal vectors matter; Spark keeps so many per task before it shuffles
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    points = pinned(whole.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v")
                    .agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    told = points.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(scaled)).alias("norm")).first()
    space = _Space(int(size["dim"]), largest, float(told["norm"]))
    shard_rows = max(LEAF, SHARD_BYTES // (8 * space.dim))

    depth = min(int(math.log2(CELLS)), max(0, math.ceil(math.log2(told["n"] / shard_rows))))
    span = 2 ** 30
    some = points.where(F.pmod(F.xxhash64("v"), F.lit(span)) < F.lit(min(span, span * SAMPLE // told["n"] + 1))) if depth else points.limit(1)
    sample = [r["v"] for r in some.select("v").limit(2 * SAMPLE).collect()] or [r["v"] for r in points.select("v").limit(1).collect()]
    router = _Router(space.points(_matrix(sample, space.dim)), depth)

    def routed(frames):
        for f in frames:
            cell, far = router.route(space.points(_matrix(f["v"].tolist(), space.dim)))
            yield f.assign(cell=cell.astype("int32"), far=list(far))

    celled = pinned(points.mapInPandas(routed, "v array<double>, ids array<long>, cell int, far array<double>"), "cells")
    ranges = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[x for i in range(depth) for x in (
        F.min(F.col("far")[i]).alias(f"lo{i}"), F.max(F.col("far")[i]).alias(f"hi{i}"))]).orderBy("cell").collect()  # <= CELLS rows
    lo, hi = np.full((2 ** depth, depth), np.inf), np.full((2 ** depth, depth), -np.inf)  # empty cells: infinitely far
    parts = np.zeros(2 ** depth, int)
    for r in ranges:
        lo[r["cell"]], hi[r["cell"]] = [r[f"lo{i}"] for i in range(depth)], [r[f"hi{i}"] for i in range(depth)]
        parts[r["cell"]] = -(-r["n"] // shard_rows)
    firsts = np.r_[0, np.cumsum(parts)[:-1]]
    cells = F.broadcast(spark.createDataFrame([(c, int(firsts[c]), int(parts[c])) for c in range(2 ** depth)], "cell int, first long, parts long"))
    sharded = celled.join(cells, "cell").select("cell", "v", "ids", F.col("ids")[0].alias("first"),
                                                (F.col("first") + F.pmod(F.xxhash64("v"), "parts")).alias("shard"))
    trees = pinned(sharded.groupBy("shard").applyInPandas(_plant(space), _TREE), "trees")

    asking = whole.where(is_query)
    packs = max(1, -(-asking.count() // PACK))
    nothing_yet = -float("inf")

    def homes(frames):  # one shard of the cell that each query falls into, or of the nearest cell that has points
        for f in frames:
            q = space.queries(_matrix(f["v"].tolist(), space.dim))
            bound = router.bounds(q, lo, hi)
            bound[:, parts == 0] = np.inf
            cell = bound.argmin(axis=1)
            yield f.assign(shard=firsts[cell] + f["id"].to_numpy() % parts[cell])

    def lanes(factor):  # the lanes of all cells that may hold something nearer than the kth so far
        def run(frames):
            for f in frames:
                best = _Best(f["id"].to_numpy(), _matrix(f["v"].tolist(), space.dim), space, f["kth"].to_numpy(float).copy(), k)
                near = (router.bounds(best.points, lo, hi) * factor <= best.reach(np.arange(len(f)))[:, None]) & (parts > 0)
                yield f.assign(lane=[np.unique(np.concatenate([np.arange(firsts[c], firsts[c] + parts[c]) // LANE
                                                               for c in np.flatnonzero(x)] or [np.zeros(0, int)])) for x in near])
        return run

    def paired(left, by: str, factor: float):
        """Searches the trees of a shard or lane for each pack of queries sent there."""
        asked = left.select(F.col(by).alias(by), F.col("pack").alias("pack")).distinct()
        met = trees.join(asked, by)
        return left.groupBy(by, "pack").cogroup(met.groupBy(by, "pack")).applyInPandas(_search(space, router, lo, hi, k, factor), _HITS)

    def searched(asking, factor: float):
        """The hits of a search at home and then wherever the kth distance reaches."""
        at_home = asking.mapInPandas(homes, "id long, v array<double>, pack long, kth double, shard long")
        seeds = pinned(_top(paired(at_home, "shard", factor), k).drop("rank"), "seeds")
        floor = seeds.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("reached"))
        told = asking.join(floor, "id", "left").select(
            "id", "v", "pack", F.when(F.col("n") == k, F.col("reached")).otherwise(F.lit(nothing_yet)).alias("kth"))
        away = (told.mapInPandas(lanes(factor), "id long, v array<double>, pack long, kth double, lane array<long>")
                .withColumn("lane", F.explode("lane")))
        hits = seeds.unionByName(paired(pinned(away, "asked"), "lane", factor))
        return _top(hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max("bound").alias("bound")), k)

    asking = asking.withColumn("pack", F.pmod(F.xxhash64("id"), F.lit(packs))).withColumn("kth", F.lit(nothing_yet))
    if factor is None:
        some = asking.orderBy(F.xxhash64("id"), "id").limit(TUNED_ON).withColumn("pack", F.lit(0).cast("long"))
        tried = searched(pinned(some, "tuned-on"), 1.0).join(some.select(F.col("id").alias("query_id"), "v"), "query_id").collect()  # TUNED_ON * k rows
        factor = _tuned(tried, space, recall)
    return searched(asking, factor).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
