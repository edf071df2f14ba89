"""Centroids, manifest and neighbours against brute force, on several blocks, ties and odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from tradewind.llm import centroids, merkle, neighbours

VECTORS = "vec_id long, embedding array<double>, cluster string, distance string, rank int, score string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def vectors(seed, n, dims, grid=8):
    """Coarse components, so that distances and products tie often."""
    x = np.random.default_rng(seed).integers(-grid, grid + 1, (n, dims)) / grid
    return [(i, list(map(float, v))) for i, v in enumerate(x)]


def odd_vectors(dims):
    good = vectors(3, 30, dims)
    bad = [(100, None), (101, []), (102, [None] + [1.0] * (dims - 1)), (103, [math.nan] * dims), (104, [math.inf] + [0.5] * (dims - 1)),
           (105, [1.0] * (dims - 1))]
    return good + bad + [(None, good[3][1]), (None, good[4][1]), good[5], good[5], (20, good[7][1]), (20, good[20][1]), (40, good[8][1])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", None, 1, None) for i, v in rows], VECTORS)


def brute_clusters(rows, many, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    now = [v for _, v in sorted(kept, key=lambda r: (sha(f"2:{'' if r[0] is None else r[0]}"), r[1]))[:many]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(now)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for k in range(len(now)):
            own = [v for (_, v), (_, x) in zip(kept, at) if x == k]
            if own:
                now[k] = [sum(col) // len(own) for col in zip(*own)]
    at = place()
    return sorted(((i, k, d, sum(e for e, x in at if x == k), sum(e for e, _ in at), sha(",".join(map(str, now[k]))))
                   for (i, _), (d, k) in zip(kept, at)), key=repr)


@pytest.mark.parametrize(("rows", "many", "dims", "chunk"), [
    (vectors(1, 300, 8), 12, 8, 64), (vectors(2, 90, 7, 2), 5, 7, 65_536), (odd_vectors(6), 40, 6, 16), (odd_vectors(6)[30:36], 4, 6, 16), ([], 4, 6, 16)])
def test_clusters(spark, monkeypatch, rows, many, dims, chunk):
    monkeypatch.setattr(centroids, "ROWS", chunk)
    got = centroids.cluster(frame(spark, rows).repartition(3), many, 5, dims)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, many, 5, dims)


def test_cluster_range(spark):
    """Components that no long could hold the square of are left out, large ones below that are exact."""
    rows = [(1, [300_000.0, -300_000.0]), (2, [-300_000.0, 300_000.0]), (3, [1e30, 0.0]), (4, [300_000.0, 300_000.0])]
    got = {r.vec_id: r for r in centroids.cluster(frame(spark, rows), 1, 3, 2).collect()}
    assert set(got) == {1, 2, 4} and got[1].inertia == sum(r.distance for r in got.values())
    assert sorted((r.vec_id, r.distance) for r in got.values()) == [r[:1] + r[2:3] for r in brute_clusters(rows[:2] + rows[3:], 1, 3, 2)]


def test_many_equal_vectors(spark):
    rows = [(i, [0.25, -0.5]) for i in range(400)] + [(i, [1.0, 1.0]) for i in range(400, 410)]
    assert sorted(map(tuple, centroids.cluster(frame(spark, rows), 5, 2, 2).collect()), key=repr) == brute_clusters(rows, 5, 2, 2)
    got = neighbours.nearest(frame(spark, rows), frame(spark, rows).where("vec_id % 20 = 0"), 20).collect()
    assert sorted(map(tuple, got), key=repr) == brute_neighbours(rows, 20)


def brute_neighbours(rows, k):
    part = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]

    def score(a, b):
        s = 0.0
        for x, y in zip(a, b):
            s += x * y
        return s

    out = []
    for i, q in part:
        if i is not None and i % 20 == 0:
            near = [(-score(q, v), j is None, j or 0, j) for j, v in part if j != i and len(v) == len(q)]
            out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(near, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("rows", "k"), [
    (vectors(4, 500, 16, 2), 20), (vectors(5, 200, 3, 3), 7), (odd_vectors(6), 20), (odd_vectors(6), 100), (odd_vectors(6)[:1], 3),
    ([(20 * (i % 2), [1.0, 2.0 - i % 3]) for i in range(300)], 4), ([], 3),
    ([(i, np.random.default_rng(i).normal(0, 10.0 ** (i % 7 - 3), 5).tolist()) for i in range(160)], 20)])
def test_neighbours(spark, monkeypatch, rows, k):
    monkeypatch.setattr(neighbours, "QUERIES", 64)
    monkeypatch.setattr(neighbours, "CANDIDATES", 400)
    df = frame(spark, rows)
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_neighbours(rows, k)


def test_wide_tile():
    """Products of more than 1,024 dimensions are added up in parts; survivors are exact."""
    rng = np.random.default_rng(8)
    q, c = rng.normal(size=(5, 2500)), rng.normal(size=(300, 2500))
    heaps = neighbours._best(q, list(range(5)), c, list(range(100, 400)), 9)
    want = np.argsort(-(q @ c.T), axis=1, kind="stable")[:, :9] + 100
    assert [sorted(-key for _, key in h) for h in heaps] == [sorted(r) for r in want.tolist()]


def test_survivors_are_few():
    """The error bounds leave little more than the result to be computed anew."""
    rng = np.random.default_rng(9)
    q, c = rng.normal(size=(50, 64)), rng.normal(size=(4000, 64))
    (qa, qs, qn, qb, qe), (ca, cs, cn, _, ce) = neighbours._scaled(q), neighbours._scaled(c)
    estimate = (qa @ ca.T) * qs[:, None] * cs
    error = qe[:, None] * cn + qb[:, None] * ce
    assert (np.abs(estimate - q @ c.T) <= error).all()
    floor = np.sort(estimate - error, axis=1)[:, -20, None]
    assert (estimate + error >= floor).sum(1).mean() < 80


def brute_manifest(rows):
    def field(x):
        x = None if x is None else str(x)
        return "-" if x is None else f"{len(x.encode())}:{x}"

    def digest(row, text):
        return sha("".join(map(field, (row[0], row[2], row[3], row[4], text))))

    def paths(nodes):
        """The root, and the siblings of each node as (before, after) for each level."""
        up, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = nodes[p // 16 * 16:p // 16 * 16 + 16]
                up[i].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
            nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
            at = [p // 16 for p in at]
        return nodes[0], up

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, digest(r, r[1])))
    trees = {s: sorted(v, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s, v in trees.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: paths([d for _, d in trees[s]]) for s in order}
    if not rows:
        return []
    root, high = paths([low[s][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for (r, d), up in zip(trees[s], low[s][1]):
            path = up + high[at]
            fold = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                lower = None if r[1] is None else r[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                fold = digest(r, lower)
            for before, after in path:
                fold = sha(before + fold + after)
            out.append((r[0], d, low[s][0], root, sha("".join(b + a for b, a in path)), fold, fold == root))
    return sorted(out, key=repr)


DOCS = "doc_id long, text string, source string, lang string, n_chars long, leaf string, pos int, tree string, digest string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "t", None) for r in rows], DOCS)


def manifest_rows(seed, n, sources):
    rng = random.Random(seed)
    return [(rng.randrange(10 * n), f"Text {i} É " * (i % 4), rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i])) for i in range(n)]


@pytest.mark.parametrize("rows", [
    manifest_rows(1, 700, ["a"] * 300 + list("bcdé") + [None]), manifest_rows(2, 40, [f"s{i}" for i in range(400)]), manifest_rows(3, 1, ["a"]),
    [(i, "A", "one", "x", 1) for i in range(17)], [(i, "A", "one", "x", 1) for i in range(16)] + [(7, "B", "0", None, None)],
    [(5, "Same ROW", "a", "en", 3)] * 50 + [(5, "another", "a", "en", 3), (None, None, None, None, None), (None, "Z" * 300_000, "a", None, 9), (1, "", "", "", 0)], []])
def test_manifest(spark, many_partitions, rows):
    got = merkle.manifest(documents(spark, rows).repartition(3))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest(rows)
