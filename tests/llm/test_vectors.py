"""Near-duplicate vectors, centroid clustering and hard negatives against brute force, with odd rows and small tiles."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from gazetta.llm import centroids, neardup, negatives, vectors

ODD = [(900, None), (901, []), (902, [0.0] * 12), (903, [float("nan")] * 12), (904, [None] * 12), (905, [float("inf")] + [1.0] * 11), (906, [1.0, 2.0]), (907, [2.0, 4.0])]


def sample(n, d, seed):
    """Clusters of near copies, exact copies, scaled copies and loose vectors."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 4, d))
    rows = [base[rng.integers(len(base))] + 0.12 * rng.standard_normal(d) for _ in range(n // 2)]
    rows += [base[i] * (1 + i % 3) for i in range(n // 8)] * 2
    rows += list(rng.standard_normal((n - len(rows), d)))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def good(rows):
    return [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]


@pytest.fixture(params=[False, True], ids=["whole", "small tiles"])
def tiles(request, monkeypatch):
    if request.param:
        for module, name, value in [
            (neardup, "TILE", 24), (neardup, "BLOCK", 7), (neardup, "CHUNK", 5), (neardup, "LEAD", 3), (vectors, "SAMPLE", 60),
            (negatives, "ROWS", 24), (negatives, "ANCHORS", 3), (negatives, "BLOCK", 7), (negatives, "FEW", 2), (negatives, "CHUNK", 5), (negatives, "LEAD", 3),
            (centroids, "ROWS", 17),
        ]:
            monkeypatch.setattr(module, name, value)


def brute_links(rows, threshold):
    """n_links and component_id of each row, by position."""
    n = len(rows)
    at = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {k: set() for k in range(n)}
    for x in at:
        for y in at:
            a, b = np.array(rows[x][1]), np.array(rows[y][1])
            if x != y and len(a) == len(b) and sum(a * b) / np.sqrt(sum(a * a) * sum(b * b)) >= threshold:
                near[x].add(y)
    out = []
    for k in range(n):
        seen, todo = {k}, [k]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        out.append((rows[k][0], len(near[k]), min((rows[y][0] for y in seen if rows[y][0] is not None), default=None)))
    return out


def test_near_vectors(spark, tiles):
    rows = sample(300, 12, 1) + ODD
    edge = [1.0, 0.0], [0.9, float(np.float32(np.sqrt(1 - 0.81)))]
    rows += [(950, rows[3][1]), (950, rows[3][1]), (951, rows[3][1]), (None, rows[5][1]), (None, [0.0, 1.0, 7.0]), (960, edge[0] + [0.0]), (961, edge[1] + [0.0])]
    df = spark.createDataFrame([(i, v, 1, 0.0, "x") for i, v in rows], "vec_id long, embedding array<float>, d int, n double, root string")
    got = [tuple(r) for r in neardup.near_vectors(df).collect()]
    want = [(i, n, c, i == c) for i, n, c in brute_links([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 0.9)]
    assert Counter(got) == Counter(want)
    assert neardup.near_vectors(df.filter("false")).count() == 0
    assert neardup.near_vectors(df.filter("embedding is null")).collect()[0][:3] == (900, 0, 900)


def test_near_vectors_of_one_dense_group(spark, tiles):
    """All rows near each other: counts are whole though a pair of tiles returns no pairs."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.ones(8) + 0.01 * rng.standard_normal(8)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r)[1:] for r in neardup.near_vectors(df).collect()} == {(119, 0, True), (119, 0, False)}


def brute_clusters(rows, k, rounds):
    own = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in good(rows) if len(v) == centroids.DIM]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "z", v) for i, v in own)[:k]
    now = [v for _, v in first]
    for r in range(rounds + 1):
        each = [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(now)) for _, v in own]
        if r < rounds:
            for j in range(len(now)):
                mine = [v for (_, v), (_, c) in zip(own, each, strict=True) if c == j]
                if mine:
                    now[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    inertia = Counter()
    for d, j in each:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for (i, _), (d, j) in zip(own, each, strict=True))


@pytest.mark.parametrize("scale", [1.0, 30_000.0])  # the second needs 64-bit integers
def test_clusters(spark, monkeypatch, tiles, scale):
    monkeypatch.setattr(centroids, "DIM", 6)
    rows = [(i, [float(np.float32(x * scale)) for x in v]) for i, v in sample(200, 6, 7)]
    rows += [(500, rows[3][1]), (500, rows[9][1]), (None, rows[4][1]), (501, [0.0] * 6), *ODD]
    df = spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, up double")
    for k in (40, 1000):
        assert Counter(tuple(r) for r in centroids.cluster_vectors(df, k).collect()) == brute_clusters(rows, k, 5)
    assert centroids.cluster_vectors(df.filter("false")).count() == 0


def test_clusters_scan_less_than_all_distances(spark, monkeypatch):
    monkeypatch.setattr(centroids, "DIM", 6)
    rng = np.random.default_rng(2)
    spots = 4 * rng.standard_normal((40, 6))
    df = spark.createDataFrame([(i, (spots[i % 40] + 0.1 * rng.standard_normal(6)).tolist()) for i in range(2000)], "vec_id long, embedding array<double>")
    rows = vectors.finite(df)
    _, _, work = centroids.lloyd(rows, centroids.first_centroids(rows, 40, 2))
    assert work[0] == 2000 * 41 and sum(work[1:]) < 0.5 * 5 * 2000 * 40


def test_values_that_leave_64_bits_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(centroids, "DIM", 2)
    df = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        centroids.cluster_vectors(df).collect()


def brute_negatives(rows):
    own = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, np.array([int(np.floor(256 * x)) for x in v], object)) for i, lab, v in rows if i is not None and lab is not None and good([(i, v)])]
    out = []
    for a, (i, lab, v) in enumerate(own):
        if i % 50:
            continue
        met = [(int(sum(v * w)), j, other == lab) for b, (j, other, w) in enumerate(own) if a != b and len(w) == len(v)]
        first = sorted((-s, j) for s, j, same in met if same)[:5]
        for neg, j in first:
            p = -neg
            fit = sorted((-s, k) for s, k, same in met if not same and 50 * p <= 100 * s <= 95 * p)[:3]
            out += [(i, j, rank, k, p, -s) for rank, (s, k) in enumerate(fit, 1)]
    return Counter(out)


def test_hard_negatives(spark, tiles):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(3)) if i % 2 else 9, v) for i, v in sample(300, 12, 3)]
    rows += [(i, 1, v) for i, v in ODD] + [(i + 50, 1, v) for i, v in ODD] + [(None, 1, rows[0][2]), (950, None, rows[0][2]), (1000, 2, rows[6][2]), (1000, 2, rows[6][2]), (1001, 0, rows[6][2])]
    rows += [(1050, 1, [1.0, -2.0]), (1100, 3, [0.0] * 12), (1150, 77, rows[1][2]), (1200, 2, [40.0] * 12)]
    df = spark.createDataFrame([(i, lab, v, 1, 2.0) for i, lab, v in rows], "vec_id long, label int, embedding array<float>, rank int, score double")
    got = Counter(tuple(r) for r in negatives.hard_negatives(df).collect())
    assert got == brute_negatives(rows) and len(got) > 50
    assert negatives.hard_negatives(df.filter("false")).count() == 0


def test_columns_of_other_kinds(spark):
    """Decimal components and no column but the needed ones."""
    df = spark.sql("SELECT id AS vec_id, array(cast(id AS decimal(6,2)), cast(1 AS decimal(6,2))) AS embedding, cast(id % 2 AS int) AS label FROM range(60)")
    assert neardup.near_vectors(df).count() == 60
    assert {r.anchor_id for r in negatives.hard_negatives(df).collect()} == {50}
