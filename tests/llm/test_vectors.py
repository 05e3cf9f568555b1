"""Clustering and compression of vectors beside brute force, and on awkward rows."""

import hashlib
import math

import numpy as np
import pytest

from tidemart.llm import centroids, codes
from tidemart.llm._vectors import squared

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, code int, `key` int, rows int"


def vectors(n=700, dim=64):
    rng = np.random.default_rng(3)
    around = rng.standard_normal((9, dim))
    x = (around[rng.integers(0, 9, n)] + 0.3 * rng.standard_normal((n, dim))) / 8
    x[50:250] = x[50]  # one vector is a third of all
    x[300:310] = np.round(x[300:310] * 2) / 2  # ties
    rows = [(int(i), [float(np.float32(v)) for v in x[i]], int(i % 4) if i % 5 else None) for i in range(n)]
    odd = [
        (9001, None, 1),
        (9002, [], 1),
        (9003, [1.0, 2.0, 3.0], 2),
        (9004, [float("nan")] * dim, 2),
        (9005, [float("inf")] + [0.0] * (dim - 1), 2),
        (9006, [None] + [0.0] * (dim - 1), None),
        (9007, [0.0] * dim, None),
        (None, rows[7][1], 3),
        rows[8],
    ]
    return [(*r, "x", 1, 2, 3) for r in rows + odd]


def fine(row, dim=64):
    v = row[1]
    return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)


def by_mean(x, owner, old):
    new = old.copy()
    for k in range(len(old)):
        mine = x[owner == k]
        if len(mine):
            new[k] = [int(c) // len(mine) for c in mine.sum(axis=0)]
    return new


def digest(numbers):
    return hashlib.sha256(",".join(str(int(n)) for n in numbers).encode()).hexdigest()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(vectors(), SCHEMA).repartition(3)


def test_centroids_equal_brute_force(table):
    kept = [r for r in vectors() if fine(r)]
    x = np.array([[math.floor(256 * c) for c in r[1]] for r in kept], np.int64)
    hashes = [hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "~" for r in kept]
    seeds = sorted(range(len(kept)), key=lambda i: (hashes[i], x[i].tolist()))[:40]
    at = x[seeds]
    for _ in range(5):
        owner = ((x[:, None] - at[None]) ** 2).sum(axis=2).argmin(axis=1)
        at = by_mean(x, owner, at)
    away = ((x[:, None] - at[None]) ** 2).sum(axis=2)
    owner, away = away.argmin(axis=1), away.min(axis=1)
    expected = sorted(
        (str(r[0]), int(k), int(d), int(away[owner == k].sum()), int(away.sum()), digest(at[k]))
        for r, k, d in zip(kept, owner, away, strict=True)
    )
    got = centroids.cluster_vectors(table)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect()) == expected


@pytest.mark.parametrize("scale", [3, 1 << 24])
def test_tree_finds_the_nearest_of_the_smallest_number(scale):
    rng = np.random.default_rng(scale)
    points = rng.integers(-scale, scale, (130, 5))
    points[40:60] = points[3]
    x = np.concatenate([rng.integers(-scale, scale, (900, 5)), points])
    number, best = centroids.nearest(x, centroids.vantage_tree(points))
    away = ((x[:, None].astype(object) - points[None].astype(object)) ** 2).sum(axis=2).astype(np.int64)
    assert (number == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
    assert (squared(x, points) == away).all()


def test_few_and_no_vectors_to_cluster(spark, table):
    three = table.where("vec_id in (1, 2, 9007)")
    got = {r.vec_id: r for r in centroids.cluster_vectors(three).collect()}
    assert len(got) == 3 and {r.distance for r in got.values()} == {0}
    assert centroids.cluster_vectors(table.where("vec_id = 9001")).count() == 0
    assert centroids.cluster_vectors(table.limit(0)).collect() == []


def test_components_too_large_are_an_error(spark):
    huge = spark.createDataFrame([(1, [1e30] * 64, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(huge).collect()
    with pytest.raises(Exception, match="too large"):
        codes.compress_vectors(huge).collect()


def test_codes_equal_brute_force(table, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 150)  # several blocks, one of them smaller
    monkeypatch.setattr(codes, "LEAF", 7)
    kept = [r for r in vectors() if fine(r)]
    x = np.array([[math.floor(4096 * c) for c in r[1]] for r in kept], np.int64).reshape(-1, 8, 8)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:16]
    books = [x[order, p].copy() for p in range(8)]
    found = []
    for p in range(8):
        for _ in range(6):
            owner = ((x[:, p, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1)
            books[p] = by_mean(x[:, p], owner, books[p])
        away = ((x[:, p, None] - books[p][None]) ** 2).sum(axis=2)
        found.append((away.argmin(axis=1), away.min(axis=1)))
    error = sum(f[1] for f in found)
    per_label = {}
    for r, e in zip(kept, error, strict=True):
        per_label[r[2]] = per_label.get(r[2], 0) + int(e)
    sha = digest(np.concatenate([b.reshape(-1) for b in books]))
    expected = [
        (str(r[0]), "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), per_label[r[2]], sha)
        for i, r in enumerate(kept)
    ]
    # Vectors of another length keep their row.
    expected += [(str(i), None, None, per_label[label], sha) for i, label in ((9002, 1), (9003, 2))]
    got = codes.compress_vectors(table)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(((str(r[0]), *tuple(r)[1:]) for r in got.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("scale", [2, 1 << 24])
def test_balls_hold_their_points_and_sums(scale):
    rng = np.random.default_rng(scale)
    v = rng.integers(-scale, scale, (3000, 4))
    v[100:1500] = v[5]
    tree = codes.metric_tree(v)
    assert sorted(tree["order"].tolist()) == list(range(3000))
    for low, high, total, centre, radius in zip(
        tree["low"], tree["high"], tree["total"], tree["centre"], tree["radius"], strict=True
    ):
        assert (tree["x"][low:high].sum(axis=0) == total).all()
        assert np.sqrt(((tree["x"][low:high] - centre) ** 2).sum(axis=1)).max() <= radius * (1 + 1e-9) + 1e-9
    entries = np.concatenate([v[:14], v[2:4]])  # the last two repeat earlier ones
    away = ((v[:, None] - entries[None]) ** 2).sum(axis=2)
    owner, distance = codes.owners(tree, entries)
    assert (owner == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()
    n, total = codes.owned_sums(tree, entries)
    assert (n == np.bincount(owner, minlength=16)).all()
    assert all((total[k] == v[owner == k].sum(axis=0)).all() for k in range(16))


def test_few_and_no_vectors_to_compress(spark, table):
    three = codes.compress_vectors(table.where("vec_id in (1, 2, 9007)")).collect()
    assert {r.error for r in three} == {0} and len({r.code for r in three}) == 3
    assert codes.compress_vectors(table.limit(0)).collect() == []
    odd = codes.compress_vectors(table.where("vec_id in (9002, 9003)")).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in odd) == [(9002, None, None), (9003, None, None)]
