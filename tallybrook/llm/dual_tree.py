"""Centroid clustering by dual-tree Lloyd (operator 11).

Vectors become whole numbers, and each task cuts the ones that it reads into blocks. A block gets a cover tree: the
centres of a level lie further apart than its radius, each lies within the radius above of a centre there (its parent),
and a centre stays one on all levels below. The trees are written once. Each round builds a cover tree over the
distinct centroids as well and walks both from their roots. A pair of nodes is dropped if its centres lie so far apart
that, by the nodes' true radii, another centroid is nearer to every vector below; a vector node with one centroid left
is assigned whole; else the wider node of the pair is opened. What is left between leaves is compared exactly, in
integers. A task sends the count and sums of each centroid, Spark adds them up, and the driver holds the centroids
alone.

Defined results: vectors that are null, hold null or non-finite entries, or have another length than `dim` take no
part; vectors without an id are assigned, but none starts as a centroid; repeated rows count as often as they come;
equal hashes (repeated ids) go by the vectors' entries; of equally near centroids, equal ones too, the one with the smaller number wins; with fewer
vectors than k there are as many centroids; an empty table gives an empty result; further columns don't matter,
whatever their names. An entry of 2^27 or more once scaled stops the query, as squared distances must fit a long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import matrix_of, whole_vectors, write_table

LARGEST = 1 << 27
#: Ratio of a level's radius to the one below; points below a centre that aren't split further; vectors of a block.
BASE, LEAF, BLOCK = 1.3, 8, 2048
#: Pairs of vectors whose distances are computed at once.
AT_ONCE = 1 << 14
#: Distances are rounded; a pair is only dropped when it is further by this part.
MARGIN = 1e-9


@dataclass
class Tree:
    """Points in the order of the leaves; of each node the point at its centre, its range of points, its radius, and its
    children, which stand side by side."""

    points: np.ndarray
    order: np.ndarray
    centre: np.ndarray
    low: np.ndarray
    high: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray


def _nets(x: np.ndarray, leaf: int) -> tuple[np.ndarray, list[dict[int, list[int]]]]:
    """The centre that each point belongs to at last, and level by level the new centres below each older one."""
    n = len(x)
    near, owner = np.linalg.norm(x - x[0], axis=1), np.zeros(n, np.int64)
    radius, centres, levels = near.max(initial=0.0), 1, []
    while near.max(initial=0.0) > 0 and centres * leaf < n:
        radius = min(radius, near.max()) / BASE
        above, born = owner.copy(), {}
        while near.max() > radius:  # the farthest point lies further than the radius from all centres
            new = int(near.argmax())
            born.setdefault(int(above[new]), []).append(new)
            distance = np.linalg.norm(x - x[new], axis=1)
            closer = distance < near
            near[closer], owner[closer] = distance[closer], new
            centres += 1
        levels.append(born)
    return owner, levels


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """points: whole numbers, a row each."""
    x = points.astype(float)
    owner, levels = _nets(x, leaf)
    by_owner = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[by_owner])) + 1
    # a node is (centre, children, points); from the leaves up, a centre with new centres below opens a node
    node = {int(owner[part[0]]): (int(owner[part[0]]), [], part) for part in np.split(by_owner, cuts)}
    for born in reversed(levels):
        for old, new in born.items():
            node[old] = (old, [node[old], *(node[c] for c in new)], None)
    order, rows = [], []
    line, at = [node[0]], 0
    while at < len(line):  # breadth first, so that children stand side by side
        centre, below, _ = line[at]
        rows.append((centre, len(line), len(below)))
        line += below
        at += 1
    spans = [None] * len(line)

    stack, filled = [(0, False)], 0
    while stack:  # depth first, so that the points of a node stand side by side
        k, closed = stack.pop()
        if closed:
            spans[k] = (spans[k], filled)
            continue
        spans[k] = filled
        stack.append((k, True))
        if rows[k][2]:
            stack += [(rows[k][1] + j, False) for j in reversed(range(rows[k][2]))]
        else:
            order.append(line[k][2])
            filled += len(line[k][2])
    order = np.concatenate(order)
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    centre, child, children = (np.array(c, np.int64) for c in zip(*rows))
    low, high = (np.array(c, np.int64) for c in zip(*spans))
    x = x[order]
    radius = np.array([np.linalg.norm(x[a:b] - x[c], axis=1).max() for a, b, c in zip(low, high, place_of[centre])])
    return Tree(points[order], order, place_of[centre], low, high, radius, child, children)


def _in_parts(run, *columns: np.ndarray) -> np.ndarray:
    """run on bounded slices of the columns, side by side."""
    return np.concatenate([run(*(c[i : i + AT_ONCE] for c in columns)) for i in range(0, len(columns[0]), AT_ONCE)])


def _opened(tree: Tree, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of nodes, and which of the nodes each came from; a leaf stands for itself."""
    count = np.maximum(tree.children[node], 1)
    source = np.repeat(np.arange(len(node)), count)
    step = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
    return np.where(tree.children[node][source] > 0, tree.child[node][source] + step, node[source]), source


def nearest(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The number of the nearest centroid for each point in the tree's order, and how many distances were compared
    exactly. Equal centroids count by the first."""
    distinct, first = np.unique(centroids, axis=0, return_index=True)
    other = cover_tree(distinct, 1)
    number = first[other.order]  # of a centroid by its place in its tree
    label, compared = np.empty(len(tree.points), np.int64), 0
    a, b = tree.points.astype(float)[tree.centre], other.points.astype(float)[other.centre]
    v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(v):
        distance = _in_parts(lambda v, c: np.linalg.norm(a[v] - b[c], axis=1), v, c)
        begin = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        size = np.diff(np.append(begin, len(v)))
        reach = distance + tree.radius[v]  # some centroid is as near to every vector below
        bound = np.repeat(np.minimum.reduceat(reach, begin), size)
        on = distance - tree.radius[v] - other.radius[c] <= bound + MARGIN * (bound + 1)
        v, c = v[on], c[on]
        begin = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        size = np.diff(np.append(begin, len(v)))
        closed = np.repeat(~np.logical_or.reduceat(other.children[c] > 0, begin), size)
        widest = np.repeat(np.maximum.reduceat(other.radius[c], begin), size)
        alone = closed & np.repeat(size == 1, size)
        for node, centroid in zip(v[alone].tolist(), c[alone].tolist()):
            label[tree.low[node] : tree.high[node]] = number[other.centre[centroid]]
        leaf = tree.children[v] == 0
        last = closed & leaf & ~alone
        if last.any():
            compared += _compare(tree, v[last], other.points[other.centre[c[last]]], number[other.centre[c[last]]], label)
        rest = ~alone & ~last
        by_centroid = rest & ~closed & (leaf | (widest >= tree.radius[v]))
        by_vector = rest & ~by_centroid
        below, source = _opened(other, c[by_centroid])
        inner, of = _opened(tree, v[by_vector])
        v, c = np.concatenate([v[by_centroid][source], inner]), np.concatenate([below, c[by_vector][of]])
        order = np.argsort(v, kind="stable")
        v, c = v[order], c[order]
    return label, compared


def _compare(tree: Tree, node: np.ndarray, centroid: np.ndarray, number: np.ndarray, label: np.ndarray) -> int:
    """Exact distances between the points of leaves and the centroids left for them."""
    count = tree.high[node] - tree.low[node]
    source = np.repeat(np.arange(len(node)), count)
    point = tree.low[node][source] + np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
    squares = _in_parts(lambda p, s: ((tree.points[p] - centroid[s]) ** 2).sum(1), point, source)
    order = np.lexsort((number[source], squares, point))
    best = order[np.concatenate([[True], np.diff(point[order]) > 0])]
    label[point[best]] = number[source[best]]
    return len(point)


# Spark --------------------------------------------------------------------------------------------------------------
_NODES = ("centre", "low", "high", "radius", "child", "children")
TREES = "ids array<long>, points binary, " + ", ".join(f"{c} binary" for c in _NODES)


def _planted(batches):
    """A row with the tree of each block of the vectors that a task reads."""
    held: list = []

    def tree():
        ids, x = [i for part, _ in held for i in part], np.concatenate([x for _, x in held])
        t = cover_tree(x)
        values = [[ids[i] for i in t.order]], [t.points.astype(np.int32).tobytes()], *([getattr(t, c).astype(np.float64 if c == "radius" else np.int32).tobytes()] for c in _NODES)
        return pa.record_batch([pa.array(values[0], pa.list_(pa.int64())), *(pa.array(v, pa.binary()) for v in values[1:])], names=["ids", "points", *_NODES])

    for batch in batches:
        ids, x = batch.column(0).to_pylist(), matrix_of(batch.column(1))
        while len(ids):
            room = BLOCK - sum(len(p) for p, _ in held)
            held.append((ids[:room], x[:room]))
            ids, x = ids[room:], x[room:]
            if room == len(held[-1][0]):
                yield tree()
                held = []
    if held:
        yield tree()


def _trees(batches, dim: int):
    for batch in batches:
        for r in batch.to_pylist():
            parts = {c: np.frombuffer(r[c], np.float64 if c == "radius" else np.int32).astype(np.float64 if c == "radius" else np.int64) for c in _NODES}
            yield r["ids"], Tree(np.frombuffer(r["points"], np.int32).reshape(-1, dim).astype(np.int64), None, **parts)


def _moved(centroids: np.ndarray):
    """cluster, n, sums: of the vectors of a task that are nearest to each centroid."""
    k, dim = centroids.shape

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, tree in _trees(batches, dim):
            label, _ = nearest(tree, centroids)
            for j in np.unique(label).tolist():
                n[j] += (label == j).sum()
                sums[j] += tree.points[label == j].sum(0)
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        for ids, tree in _trees(batches, centroids.shape[1]):
            label, _ = nearest(tree, centroids)
            distance = ((tree.points - centroids[label]) ** 2).sum(1)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(label.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def _next(trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact means, rounded down; an empty one stays."""
    parts = trees.mapInArrow(_moved(centroids), "cluster int, n long, sums array<long>")
    total = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for r in total.collect():  # k times dim
        out[r["cluster"], r["pos"]] = int(r["s"]) // r["n"]
    return out


def _first(vectors: DataFrame, k: int, seed: int, dim: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = vectors.where("vec_id is not null").orderBy(mark, "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in found], np.int64).reshape(-1, dim)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance (squared) of each vector that takes part, and the centroids after the rounds."""
    rows = whole_vectors(vectors, id_col, vector_col, scale, LARGEST).where(F.col("dim") == dim)
    trees = write_table(rows.select("vec_id", "x").mapInArrow(_planted, TREES), "trees")
    centroids = _first(rows, k, seed, dim)
    if not len(centroids):
        return trees.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        moved = _next(trees, centroids)
        if (moved == centroids).all():  # so would all further rounds leave them
            break
        centroids = moved
    return trees.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), centroids


def clusters(spark: SparkSession, vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row for each vector that takes part."""
    found, centroids = cluster(vectors, **options)
    found = write_table(found, "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row per centroid
    named = [(j, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
