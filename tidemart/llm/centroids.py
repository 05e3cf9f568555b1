"""Vectors clustered around centroids, exactly, in whole numbers.

Each round the driver builds a vantage-point tree over the centroids, a few dozen
rows, and broadcasts it. Tasks look up every vector's nearest centroid best first:
of a vector's open nodes the one with the least lower bound comes next, and a node is
left out only if its bound lies beyond the best distance so far. Nodes at that very
distance are still visited, as they may hold an equally near centroid of a smaller
number. Tasks return a sum and a count per centroid, which Spark adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches, slices
from tidemart.llm._common import staged
from tidemart.llm._vectors import finite, squared, whole

# Centroids of a leaf, whose distances are taken at once.
LEAF = 6
# Bounds are doubles, distances whole numbers; a bound counts as beyond the best
# distance only if it is so by more than this share, far above rounding errors.
SLACK = 1e-9
# Open bounds held at a time by one look-up: vectors times nodes of the tree.
BOUNDS = 1 << 20


def vantage_tree(points: np.ndarray) -> dict:
    """Nodes of a vantage-point tree over the rows of ``points`` (int64).

    An inner node holds one vantage point and splits the others into a nearer and a
    farther half, each with its range of distances from the vantage point. Plain
    arrays and lists, so that a task needs no class to read it.
    """
    members: list[np.ndarray] = []
    children: list[list[tuple[int, float, float]]] = []

    def build(at: np.ndarray) -> int:
        node = len(members)
        members.append(at)
        children.append([])
        if len(at) > LEAF:
            centre = points[at].mean(axis=0)
            far = int(np.argmax(((points[at] - centre) ** 2).sum(axis=1)))
            members[node] = at[far : far + 1]
            rest = np.delete(at, far)
            away = squared(points[rest], points[at[far : far + 1]])[:, 0]
            order = np.argsort(away, kind="stable")
            half = len(rest) // 2
            for part in (order[:half], order[half:]):
                low, high = np.sqrt(away[part].min()), np.sqrt(away[part].max())
                children[node].append((build(np.sort(rest[part])), float(low), float(high)))
        return node

    if len(points):
        build(np.arange(len(points)))
    return {"points": points, "members": members, "children": children}


def nearest(x: np.ndarray, tree: dict) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point of the tree for each row of ``x``, and its squared distance.

    Of equally near points the one of the smallest number. Every row follows its own
    best-first order; rows that are at the same node are computed together.
    """
    points, members, children = tree["points"], tree["members"], tree["children"]
    best = np.full(len(x), np.iinfo(np.int64).max)
    number = np.full(len(x), len(points))
    bounds = np.full((len(x), len(members)), np.inf)
    bounds[:, 0] = 0
    active = np.arange(len(x))
    while len(active):
        pick = bounds[active].argmin(axis=1)
        least = bounds[active, pick]
        # Inclusive: a node at the best distance itself may hold a smaller number.
        open_ = least <= np.sqrt(best[active].astype(np.float64)) * (1 + SLACK) + SLACK
        active, pick, least = active[open_], pick[open_], least[open_]
        for node in np.unique(pick).tolist():
            here = pick == node
            rows, floor = active[here], least[here]
            bounds[rows, node] = np.inf
            away = squared(x[rows], points[members[node]])
            first = away.argmin(axis=1)  # members ascend, so this is the smallest number
            found, which = away[np.arange(len(rows)), first], members[node][first]
            better = (found < best[rows]) | ((found == best[rows]) & (which < number[rows]))
            best[rows[better]], number[rows[better]] = found[better], which[better]
            for child, low, high in children[node]:
                root = np.sqrt(away[:, 0].astype(np.float64))
                reach = np.maximum(root - high, low - root)
                # Rounding of the two roots, so that no bound is above the truth.
                reach -= SLACK * (root + high)
                bounds[rows, child] = np.maximum(reach, floor)
    return number, best


def _looked_up(x: np.ndarray, tree: dict) -> tuple[np.ndarray, np.ndarray]:
    """`nearest` in parts of bounded memory."""
    step = max(64, BOUNDS // max(1, len(tree["members"])))
    parts = [nearest(x[at : at + step], tree) for at in range(0, len(x), step)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _integers(rows: DataFrame, scale: int, dim: int) -> DataFrame:
    """(id, v): components as whole numbers."""

    def work() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            v = whole(batch.column(1), scale, dim)
            starts = np.arange(0, v.size + 1, dim, dtype=np.int32)
            column = pa.ListArray.from_arrays(starts, pa.array(v.reshape(-1)))
            return pa.RecordBatch.from_arrays([batch.column(0), column], ["id", "v"])

        return step

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, work, f"id {kind}, v array<bigint>")


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(stored: DataFrame, tree: Broadcast, k: int, dim: int) -> DataFrame:
    """(cluster, n, total): count and sum of the vectors of each centroid.

    A task gives one row per centroid, however many vectors it has.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for part in slices(batch):
                x = _matrix(part.column(0), dim)
                number, _ = _looked_up(x, tree.value)
                n += np.bincount(number, minlength=k)
                np.add.at(total, number, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array(n[some]),
                pa.array(total[some].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "total"],
        )

    partial = stored.select("v").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    added = F.array(*(F.sum(F.col("total")[i]) for i in range(dim)))
    return partial.groupBy("cluster").agg(F.sum("n").alias("n"), added.alias("total"))


def _assigned(stored: DataFrame, tree: Broadcast, dim: int) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def work() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            number, best = _looked_up(_matrix(batch.column(1), dim), tree.value)
            columns = [batch.column(0), pa.array(number.astype(np.int32)), pa.array(best)]
            return pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

        return step

    kind = stored.schema["id"].dataType.simpleString()
    return map_batches(stored, work, f"id {kind}, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dim: int = 64,
    scale: int = 256,
    salt: str = "2",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector kept.

    Kept are vectors of exactly ``dim`` components, none of them null, NaN or infinite,
    as whole numbers floor(scale * x). Centroids start as the ``k`` kept vectors with
    the smallest sha256 of ``<salt>:<id>``, in that order, and are replaced ``rounds``
    times by the floor of their vectors' mean; one without vectors stays. Ties go to
    the smaller centroid number. Rows that repeat an id count each for itself; among
    seeds of one hash the smaller vector comes first, and rows without an id come last.
    With fewer than ``k`` vectors each is a centroid; an empty table gives no rows.
    Other columns are not read. A component too large for exact distances to fit a
    long raises an error.

    The driver holds ``k`` centroids, their sums and nothing else of the data.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    kept = vectors.where(finite(vector) & (F.size(vector) == dim))
    kept = kept.select(F.col(id_col).alias("id"), vector.alias("vector"))
    stored = staged(_integers(kept, scale, dim), "integers")

    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = stored.select("v", digest.alias("digest"))
    seeds = first.orderBy(F.col("digest").asc_nulls_last(), "v").limit(k).collect()
    centroids = np.array([r["v"] for r in seeds], np.int64).reshape(-1, dim)
    out = "id, cluster, distance, cluster_inertia, inertia, centroid_sha256".split(", ")
    if not len(centroids):
        empty = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint"
        none = stored.select(F.col("id").alias(id_col))
        columns = [F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in empty.split(", ")]
        return none.select(id_col, *columns, F.lit(None).cast("string").alias(out[-1]))

    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(vantage_tree(centroids))
        centroids = centroids.copy()
        for r in _sums(stored, tree, len(centroids), dim).collect():  # k rows at most
            centroids[r["cluster"]] = [total // r["n"] for total in r["total"]]
        tree.unpersist()

    tree = spark.sparkContext.broadcast(vantage_tree(centroids))
    found = staged(_assigned(stored, tree, dim), "assigned")
    inertia = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}
    per_cluster = [
        (
            number,
            total,
            sum(inertia.values()),
            hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest(),
        )
        for number, total in inertia.items()
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    facts = spark.createDataFrame(per_cluster, schema)
    # k rows at most.
    named = found.join(F.broadcast(facts), "cluster").select(*out)
    return named.withColumnRenamed("id", id_col)
