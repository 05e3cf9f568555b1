"""Vectors compressed to codes: one codebook entry for each part of a vector.

Vectors are gathered in blocks of bounded size. Over each part of a block's vectors
stands a metric tree, built once by the anchors hierarchy: about the square root of
the points become anchors, each new one the point farthest from the anchor that owns
it, taking over what lies nearer to it; anchors are then merged in pairs that make the
smallest ball (upwards), and split in the same way (downwards). Balls hold the sum and
count of their points.

In a round, a ball inherits the entries that its parent could not rule out and rules
out more: those farther than another entry from every point of the ball. A ball left
with one entry is wholly owned and adds its sum and count at once; only leaves with
several entries look at single points, with exact distances.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterable, Iterator
from math import floor

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import slices
from tidemart.llm._common import join_counted, staged
from tidemart.llm._vectors import finite, squared, whole

# Vectors of a block; its trees are one stored row.
BLOCK = 4096
# Points of a ball that is not split further.
LEAF = 48
# Bounds are doubles; an entry is ruled out only if it is so by more than this share.
SLACK = 1e-9
# Row groups of the stored trees, so that a reader's batch is small.
GROUP_BYTES = 8 << 20


class _Ball:
    """A ball while its tree is built; either points or two balls."""

    __slots__ = ("points", "balls", "count", "centre", "radius")

    def __init__(self, points, balls, count, centre, radius):
        self.points, self.balls = points, balls
        self.count, self.centre, self.radius = count, centre, radius


def _own(x: np.ndarray, points: np.ndarray) -> _Ball:
    centre = x[points].mean(axis=0)
    radius = np.sqrt(((x[points] - centre) ** 2).sum(axis=1).max())
    return _Ball(points, None, len(points), centre, radius)


def _anchors(x: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
    """``points`` dealt out to about the square root of their number of anchors."""
    at = x[points]
    anchors = [0]
    owner = np.zeros(len(points), np.int64)
    away = ((at - at[0]) ** 2).sum(axis=1)
    for _ in range(int(np.ceil(np.sqrt(len(points)))) - 1):
        far = int(away.argmax())
        if away[far] == 0:  # all points are anchors or equal to one
            break
        # A point nearer to its owner than half the way from there to the new anchor
        # can't be nearer to the new one.
        between = ((at[anchors] - at[far]) ** 2).sum(axis=1)
        maybe = np.flatnonzero(4 * away >= between[owner])
        new = ((at[maybe] - at[far]) ** 2).sum(axis=1)
        taken = new < away[maybe]
        owner[maybe[taken]] = len(anchors)
        away[maybe[taken]] = new[taken]
        anchors.append(far)
    order = np.argsort(owner, kind="stable")
    cuts = np.cumsum(np.bincount(owner, minlength=len(anchors)))[:-1]
    return [points[part] for part in np.split(order, cuts)]


def _merged(balls: list[_Ball]) -> _Ball:
    """One ball over all, by joining the two that make the smallest ball until one is left."""
    count = np.array([b.count for b in balls], np.float64)
    centre = np.stack([b.centre for b in balls])
    radius = np.array([b.radius for b in balls])
    alive = np.ones(len(balls), bool)

    def joint(i: int) -> np.ndarray:
        """Radius of a ball around ball i and each other one."""
        share = (count / (count + count[i]))[:, None]
        middle = centre[i] + (centre - centre[i]) * share
        out = np.sqrt(((middle - centre) ** 2).sum(axis=1)) + radius
        out = np.maximum(out, np.sqrt(((middle - centre[i]) ** 2).sum(axis=1)) + radius[i])
        out[~alive] = np.inf
        out[i] = np.inf
        return out

    cost = np.stack([joint(i) for i in range(len(balls))])
    balls = list(balls)
    for _ in range(len(balls) - 1):
        i, j = divmod(int(cost.argmin()), len(balls))
        total = count[i] + count[j]
        centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / total
        radius[i] = cost[i, j]
        count[i] = total
        balls[i] = _Ball(None, (balls[i], balls[j]), int(total), centre[i], radius[i])
        alive[j] = False
        cost[j], cost[:, j] = np.inf, np.inf
        cost[i] = joint(i)
        cost[:, i] = cost[i]
    return balls[int(np.flatnonzero(alive)[0])]


def _grown(x: np.ndarray, points: np.ndarray) -> _Ball:
    if len(points) <= LEAF:
        return _own(x, points)
    groups = _anchors(x, points)
    if len(groups) == 1:  # equal points
        return _own(x, points)
    return _merged([_grown(x, g) for g in groups])


def metric_tree(v: np.ndarray) -> dict[str, np.ndarray]:
    """The tree over the rows of ``v`` (int64): balls as arrays, the root first.

    ``order`` lists the rows so that each ball's lie together, from ``low`` to
    ``high``; ``kids`` has the two balls within (-1: a leaf); ``total`` is the exact
    sum, ``centre`` and ``radius`` enclose all points.
    """
    order, low, high, kids = [], [], [], []
    done = 0
    # In depth first order, without recursion: chains of balls may be deep.
    stack: list[tuple[_Ball, int, int]] = [(_grown(v.astype(np.float64), np.arange(len(v))), -1, 0)]
    while stack:
        ball, parent, side = stack.pop()
        node = len(low)
        if parent >= 0:
            kids[parent][side] = node
        low.append(done)
        high.append(done + ball.count)
        kids.append([-1, -1])
        if ball.balls is None:
            order.append(ball.points)
            done += ball.count
        else:
            stack.append((ball.balls[1], node, 1))
            stack.append((ball.balls[0], node, 0))
    order = np.concatenate(order)
    low, high = np.array(low), np.array(high)
    x = v[order]
    sums = np.concatenate([np.zeros((1, v.shape[1]), np.int64), np.cumsum(x, axis=0)])
    total = sums[high] - sums[low]
    centre = total / (high - low)[:, None]
    radius = np.array(
        [
            np.sqrt(((x[a:b] - c) ** 2).sum(axis=1).max())
            for a, b, c in zip(low.tolist(), high.tolist(), centre, strict=True)
        ]
    )
    return {
        "x": x,
        "order": order,
        "low": low,
        "high": high,
        "kids": np.array(kids),
        "total": total,
        "centre": centre,
        "radius": radius,
    }


def _walk(tree: dict[str, np.ndarray], entries: np.ndarray) -> Iterator[tuple]:
    """(balls, owner) of balls wholly owned by an entry, then (points, owner) of the rest.

    Balls of one depth are handled together.
    """
    codebook = entries.astype(np.float64)
    apart = np.sqrt(((codebook[:, None] - codebook[None]) ** 2).sum(axis=2))
    balls = np.zeros(1, np.int64)
    # An entry equal to an earlier one never owns anything.
    left = ~np.tril(apart == 0, -1).any(axis=1)[None]
    leaves, leaf_left = [], []
    while len(balls):
        away = ((tree["centre"][balls][:, None] - codebook[None]) ** 2).sum(axis=2)
        best = np.where(left, away, np.inf).argmin(axis=1)
        nearest = away[np.arange(len(balls)), best][:, None]
        # |p - c|^2 - |p - best|^2 is linear in p; over the ball it is least by twice
        # the radius times the way between the two entries below its centre's value.
        reach = 2 * tree["radius"][balls][:, None] * apart[best]
        out = away - nearest > reach + SLACK * (reach + away + nearest) + SLACK
        left = left & ~out
        owned = left.sum(axis=1) == 1
        yield "balls", balls[owned], left[owned].argmax(axis=1)
        is_leaf = ~owned & (tree["kids"][balls, 0] < 0)
        leaves.append(balls[is_leaf])
        leaf_left.append(left[is_leaf])
        on = ~owned & ~is_leaf
        balls, left = tree["kids"][balls[on]].reshape(-1), np.repeat(left[on], 2, axis=0)
    leaves, leaf_left = np.concatenate(leaves), np.concatenate(leaf_left)
    sizes = tree["high"][leaves] - tree["low"][leaves]
    if len(leaves):
        points = np.repeat(tree["low"][leaves] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        away = squared(tree["x"][points], entries)
        away[~np.repeat(leaf_left, sizes, axis=0)] = np.iinfo(np.int64).max
        yield "points", points, away.argmin(axis=1)  # the lowest index of equal distances


def owned_sums(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and exact sum of the points whose nearest entry each entry is."""
    n = np.zeros(len(entries), np.int64)
    total = np.zeros(entries.shape, np.int64)
    for what, at, owner in _walk(tree, entries):
        if what == "balls":
            np.add.at(n, owner, tree["high"][at] - tree["low"][at])
            np.add.at(total, owner, tree["total"][at])
        else:
            n += np.bincount(owner, minlength=len(entries))
            np.add.at(total, owner, tree["x"][at])
    return n, total


def owners(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each row the tree was built of."""
    entry = np.zeros(len(tree["x"]), np.int64)
    for what, at, owner in _walk(tree, entries):
        if what == "balls":
            for a, b, e in zip(tree["low"][at], tree["high"][at], owner, strict=True):
                entry[a:b] = e
        else:
            entry[at] = owner
    away = ((tree["x"] - entries[entry]) ** 2).sum(axis=1)
    out, distance = np.empty_like(entry), np.empty_like(away)
    out[tree["order"]], distance[tree["order"]] = entry, away
    return out, distance


def _packed(trees: list[dict[str, np.ndarray]]) -> bytes:
    """The trees of a block as bytes, whole numbers in as few bytes as hold them."""
    out = io.BytesIO()
    arrays = {}
    for part, tree in enumerate(trees):
        for name, a in tree.items():
            if a.dtype == np.int64:
                top = int(np.abs(a).max(initial=0))
                a = a.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)
            arrays[f"{part}-{name}"] = a
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(blob: bytes, parts: int) -> list[dict[str, np.ndarray]]:
    with np.load(io.BytesIO(blob)) as arrays:
        trees = [{} for _ in range(parts)]
        for key in arrays.files:
            part, name = key.split("-")
            a = arrays[key]
            trees[int(part)][name] = a.astype(np.int64) if a.dtype.kind == "i" else a
    return trees


def _blocks(kept: DataFrame, dim: int, parts: int, scale: int) -> DataFrame:
    """(id, label, trees): up to BLOCK vectors in a row, with a tree for each part."""
    size = dim // parts
    types = [kept.schema[c].dataType.simpleString() for c in ("id", "label")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            v = whole(rows.column("vector").combine_chunks(), scale, dim)
            trees = [metric_tree(v[:, p * size : (p + 1) * size]) for p in range(parts)]
            offsets = pa.array([0, rows.num_rows], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(offsets, rows.column("id").combine_chunks()),
                    pa.ListArray.from_arrays(offsets, rows.column("label").combine_chunks()),
                    pa.array([_packed(trees)], pa.binary()),
                ],
                ["id", "label", "trees"],
            )

        for batch in batches:
            for part in slices(batch):
                waiting.append(part)
                if sum(w.num_rows for w in waiting) >= BLOCK:
                    rows = pa.Table.from_batches(waiting)
                    while rows.num_rows >= BLOCK:
                        yield block(rows.slice(0, BLOCK))
                        rows = rows.slice(BLOCK)
                    waiting = rows.to_batches()
        rows = pa.Table.from_batches(waiting) if waiting else None
        if rows is not None and rows.num_rows:
            yield block(rows)

    schema = f"id array<{types[0]}>, label array<{types[1]}>, trees binary"
    return kept.select("id", "label", "vector").mapInArrow(run, schema)


def _sums(blocks: DataFrame, books: Broadcast, size: int) -> DataFrame:
    """(part, entry, n, total): count and sum of the parts each entry is nearest to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        n = np.zeros(entries.shape[:2], np.int64)
        total = np.zeros(entries.shape, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                for part, tree in enumerate(_unpacked(blob.as_py(), len(entries))):
                    more = owned_sums(tree, entries[part])
                    n[part] += more[0]
                    total[part] += more[1]
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(n[part, entry]),
                pa.array(total[part, entry].tolist(), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "total"],
        )

    partial = blocks.select("trees").mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    added = F.array(*(F.sum(F.col("total")[i]) for i in range(size)))
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), added.alias("total"))


def _coded(blocks: DataFrame, books: Broadcast) -> DataFrame:
    """(id, label, code, error) of every vector of the blocks."""
    types = [blocks.schema[c].dataType.elementType.simpleString() for c in ("id", "label")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                found = [
                    owners(tree, entries[part])
                    for part, tree in enumerate(_unpacked(one.column(2)[0].as_py(), len(entries)))
                ]
                code = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
                error = sum(f[1] for f in found)
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column(0).flatten(),
                        one.column(1).flatten(),
                        pa.array([c.tobytes().hex() for c in code], pa.string()),
                        pa.array(error, pa.int64()),
                    ],
                    ["id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, f"id {types[0]}, label {types[1]}, code string, error bigint")


def _uncoded(kept: DataFrame) -> DataFrame:
    none = F.lit(None)
    code, error = none.cast("string").alias("code"), none.cast("bigint").alias("error")
    return kept.select("id", "label", code, error)


def compress_vectors(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector kept.

    Dropped are vectors that are null or hold null, NaN or infinite components. Others
    become whole numbers floor(scale * x), cut into ``parts`` equal parts. The codebook
    of a part starts with that part of the ``entries`` (at most 256) smallest ids'
    vectors, ascending, and is replaced ``rounds`` times by the floor of the means of
    the parts nearest to each entry (ties: the lower index); unused entries stay.
    ``code`` has two hexadecimal digits for each part. ``label_error`` adds up
    ``error`` over equal labels, nulls together.

    The vectors compressed are those of the most frequent length (the smaller of
    equally frequent ones). Vectors of other lengths keep their row with null ``code``
    and ``error``; so do all if ``parts`` doesn't divide the length, or it is zero.
    Rows that repeat an id are coded each for itself, and among the first entries the
    smaller vector comes first; rows without an id come last. With fewer vectors than
    ``entries`` each has an entry. An empty table gives no rows. Other columns are not
    read. A component too large for exact distances to fit a long raises an error.

    The driver holds the codebooks and their sums, parts times entries rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    id_, vector, label = F.col(id_col), F.col(vector_col), F.col(label_col)
    kept = vectors.where(finite(vector))
    kept = kept.select(id_.alias("id"), label.alias("label"), vector.alias("vector"))
    lengths = kept.groupBy(F.size("vector").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), "size").first()
    dim = common["size"] if common and common["size"] % parts == 0 else 0
    books = np.zeros((parts, 0, 0), np.int64)
    if dim:
        size = dim // parts
        fits = kept.where(F.size("vector") == dim)
        least = fits.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
        first = np.array([[floor(float(x) * scale) for x in r["vector"]] for r in least], np.int64)
        books = np.ascontiguousarray(first.reshape(-1, parts, size).transpose(1, 0, 2))
        blocks = _blocks(fits, dim, parts, scale)
        blocks = staged(blocks, "trees", {"parquet.block.size": GROUP_BYTES})
        for _ in range(rounds):
            sent = spark.sparkContext.broadcast(books)
            books = books.copy()
            for r in _sums(blocks, sent, size).collect():  # parts times entries at most
                books[r["part"], r["entry"]] = [total // r["n"] for total in r["total"]]
            sent.unpersist()
        coded = _coded(blocks, spark.sparkContext.broadcast(books))
        rows = coded.unionByName(_uncoded(kept.where(F.size("vector") != dim)))
    else:
        rows = _uncoded(kept)
    rows = staged(rows, "codes")

    # Labels as text, so that nulls are equal; they are of any number and any size.
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    rows = rows.withColumn("key", key)
    per_label = rows.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows"))
    joined = join_counted(rows, staged(per_label, "labels"), "key", "rows")
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return joined.select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
