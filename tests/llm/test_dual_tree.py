import hashlib

import numpy as np
import pytest

from tallybrook.llm import dual_tree


def points(kind, n, dim, rng):
    made = {
        "uniform": lambda: rng.integers(-1000, 1000, (n, dim)), "grid": lambda: rng.integers(0, 4, (n, dim)), "same": lambda: np.full((n, dim), 7),
        "groups": lambda: rng.integers(0, 20, (n, 1)) * 1000 + rng.integers(0, 30, (n, dim)), "hot": lambda: np.where(rng.random((n, 1)) < 0.5, 5, rng.integers(-99, 99, (n, dim))),
    }[kind]
    return made().astype(np.int64)


@pytest.mark.parametrize("kind", ["uniform", "grid", "same", "groups", "hot"])
@pytest.mark.parametrize("n,dim,k", [(1, 3, 1), (60, 1, 8), (1500, 2, 30), (900, 16, 12)])
def test_tree_is_a_cover_tree_and_finds_the_nearest_centroid(kind, n, dim, k):
    rng = np.random.default_rng(n)
    x = points(kind, n, dim, rng)
    tree = dual_tree.cover_tree(x)
    assert sorted(tree.order) == list(range(n)) and (x[tree.order] == tree.points).all()
    assert tree.low[0] == 0 and tree.high[0] == n
    for v in range(len(tree.centre)):
        inside = tree.points[tree.low[v] : tree.high[v]]
        assert tree.low[v] <= tree.centre[v] < tree.high[v]
        assert np.linalg.norm(inside - tree.points[tree.centre[v]], axis=1).max() <= tree.radius[v] + 1e-9
        if tree.children[v]:  # they share out the node's points, and its centre is the first one's
            below = range(tree.child[v], tree.child[v] + tree.children[v])
            assert [tree.low[c] for c in below] + [tree.high[v]] == [tree.low[v]] + [tree.high[c] for c in below]
            assert tree.centre[below[0]] == tree.centre[v]
    centroids = np.concatenate([x[rng.integers(0, n, k)], x[:1]])  # with equal ones
    label, compared = dual_tree.nearest(tree, centroids)
    assert (label == ((tree.points[:, None] - centroids[None]) ** 2).sum(2).argmin(1)).all()
    assert compared <= n * len(centroids)


def test_levels_keep_their_centres_apart():
    x = points("uniform", 400, 2, np.random.default_rng(5)).astype(float)
    _, levels = dual_tree._nets(x, 1)
    centres, radius = [0], np.linalg.norm(x - x[0], axis=1).max()
    for born in levels:
        near = np.linalg.norm(x[:, None] - x[centres][None], axis=2).min(1)
        above, radius = radius, min(radius, near.max()) / dual_tree.BASE
        for old, new in born.items():
            assert old in centres and (np.linalg.norm(x[new] - x[old], axis=1) <= above + 1e-9).all()
        centres += [c for new in born.values() for c in new]
        gaps = np.linalg.norm(x[centres][:, None] - x[centres][None], axis=2)
        assert (gaps[~np.eye(len(centres), dtype=bool)] > radius).all()


def test_node_pairs_are_pruned():
    x = points("groups", 2000, 8, np.random.default_rng(3))
    tree = dual_tree.cover_tree(x)
    assert dual_tree.nearest(tree, x[:100])[1] < 0.1 * 2000 * 100


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, [int(np.floor(1024 * float(c))) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    mark = lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    c = [x for _, x in sorted((r for r in kept if r[0] is not None), key=mark)[:k]]
    far = lambda x, m: sum((a - b) ** 2 for a, b in zip(x, m))
    best = lambda x: min(range(len(c)), key=lambda j: far(x, c[j]))
    for _ in range(rounds):
        of = [best(x) for _, x in kept]
        for j in range(len(c)):
            if own := [x for (_, x), b in zip(kept, of) if b == j]:
                c[j] = [sum(col) // len(own) for col in zip(*own)]
    out = [(i, best(x), far(x, c[best(x)])) for i, x in kept]
    inertia = {j: sum(d for _, b, d in out if b == j) for j in range(len(c))}
    return [(i, b, d, inertia[b], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[b])).encode()).hexdigest()) for i, b, d in out]


def got(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, x int, cluster string").repartition(3)
    return [tuple(r) for r in dual_tree.clusters(spark, table, **options).collect()]


def test_rounds_match_plain_lloyd(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.2, (150, 5)))]
    rows += [(i, rows[0][1]) for i in range(200, 260)] + [(3, rows[4][1]), (None, rows[5][1])]  # a hot vector, a repeated and a null id
    rows += [(900, None), (901, [0.1] * 4), (902, []), (903, [float("nan")] * 5), (904, [None] * 5), (905, [float("inf")] * 5)]
    show = lambda x: sorted(map(str, x))
    assert show(got(spark, rows, dim=5)) == show(brute(rows, dim=5))


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 2.0])]
    assert sorted(got(spark, rows, dim=2)) == sorted(brute(rows, dim=2))
    assert got(spark, [(1, None)], dim=2) == got(spark, [], dim=2) == got(spark, [(None, [1.0, 1.0])], dim=2) == []


def test_entries_beyond_the_bound_are_refused(spark):
    with pytest.raises(Exception, match="in size"):
        got(spark, [(1, [1e30, 0.0])], dim=2)
