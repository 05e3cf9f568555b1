"""Near-duplicate vectors by binary codes of random rotations.

Each vector is rotated at random and kept as signs, with the correction factor that
makes a code's inner product with another rotated vector an unbiased estimate of the
cosine. Vectors that agree in some band of code bits meet in a block. There, pairs
whose estimate lies below the threshold by more than the confidence bound are
dropped; all others are recomputed exactly, in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches
from tidemart.llm._common import join_counted, staged
from tidemart.llm.components import components

SEED = 1_789
# Vectors a band's bucket should hold where vectors lie at random.
BUCKET = 256
# Chance that a pair right at the threshold meets in no band.
MISS = 1e-6
# Width of the confidence bound, in standard deviations of the estimate.
SIGMAS = 5.0
# Vectors compared with as many others by one task; larger buckets are cut.
BLOCK = 2000


def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random orthogonal matrices."""
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.stack(out)


def banding(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a band, by the number of vectors, and bands, by the chance to miss."""
    bits = min(24, max(6, math.ceil(math.log2(max(2, n / BUCKET)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component, not zero."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _coded(nodes: DataFrame, dim: int, bits: int, bands: int) -> DataFrame:
    """(node, unit, code, factor, bands): the code is of the first rotation."""
    turns = rotations(dim, -(-bits * bands // dim) + 1)

    def work():
        weights = 1 << np.arange(bits)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.stack([np.array(v, np.float64) for v in batch.column(1).to_pylist()])
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            own = x @ turns[0].T
            factor = np.abs(own).sum(axis=1) / math.sqrt(dim)
            signs = np.concatenate([x @ t.T for t in turns[1:]], axis=1) > 0
            keys = signs[:, : bits * bands].reshape(len(x), bands, bits) @ weights
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([v.tobytes() for v in x], pa.binary()),
                    pa.array([v.tobytes() for v in np.packbits(own > 0, axis=1)], pa.binary()),
                    pa.array(factor),
                    pa.array(keys.astype(np.int32).tolist(), pa.list_(pa.int32())),
                ],
                ["node", "unit", "code", "factor", "bands"],
            )

        return step

    kind = nodes.schema["node"].dataType.simpleString()
    schema = f"node {kind}, unit binary, code binary, factor double, bands array<int>"
    return map_batches(nodes.select("node", "vector"), work, schema)


def _linked(blocks: DataFrame, dim: int, threshold: float) -> DataFrame:
    """For each block and vector: (node, links, least), the copies linked with it there
    for the first time and the least node of its component within the block."""
    kind = blocks.schema["node"].dataType.simpleString()
    first = rotations(dim, 1)[0]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        band, cut = int(pdf["band"].iloc[0]), pdf["low"].iloc[0] != pdf["high"].iloc[0]
        pdf = pdf.sort_values("node", kind="stable")
        nodes, copies = pdf["node"].to_numpy(), pdf["copies"].to_numpy()
        own = pdf["own"].to_numpy()
        x = np.frombuffer(b"".join(pdf["unit"]), np.float64).reshape(-1, dim)
        code = np.frombuffer(b"".join(pdf["code"]), np.uint8).reshape(len(x), -1)
        sign = (np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1) / math.sqrt(dim)
        keys = np.stack(pdf["bands"].to_numpy())
        factor = pdf["factor"].to_numpy().astype(np.float32)
        turned = (x @ first.T).astype(np.float32)
        spread = SIGMAS * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(dim - 1 or 1)
        links, root = np.zeros(len(x), np.int64), np.arange(len(x))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for at in range(0, len(x), 512):
            rows = slice(at, at + 512)
            # <code, y> / factor estimates <x, y> without bias.
            estimate = (sign[rows] @ turned.T) / factor[rows, None]
            near = estimate + spread[rows, None] + 1e-5 >= threshold
            i, j = np.nonzero(near)
            i += at
            some = i < j
            if cut:
                some &= own[i] != own[j]
            i, j = i[some], j[some]
            for k in range(0, len(i), 1 << 18):
                a, b = i[k : k + (1 << 18)], j[k : k + (1 << 18)]
                hit = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
                a, b = a[hit], b[hit]
                # Each pair counts in the first band that brings it together.
                new = (
                    ~(keys[a, :band] == keys[b, :band]).any(axis=1)
                    if band
                    else np.ones(len(a), bool)
                )
                np.add.at(links, a[new], copies[b[new]])
                np.add.at(links, b[new], copies[a[new]])
                # Within a row of hits, each one's least partner is enough to connect.
                order = np.lexsort((a, b))
                firsts = order[np.append(True, b[order][1:] != b[order][:-1])] if len(b) else []
                for p, q in zip(a[firsts].tolist(), b[firsts].tolist(), strict=True):
                    p, q = find(p), find(q)
                    root[max(p, q)] = min(p, q)
                rest = np.array([find(p) for p in a.tolist()]) != np.array(
                    [find(q) for q in b.tolist()]
                )
                for p, q in zip(a[rest].tolist(), b[rest].tolist(), strict=True):
                    p, q = find(p), find(q)
                    root[max(p, q)] = min(p, q)
        least = nodes[[find(k) for k in range(len(x))]]
        keep = (links > 0) | (least != nodes)
        return pd.DataFrame({"node": nodes[keep], "links": links[keep], "least": least[keep]})

    schema = f"node {kind}, links bigint, least {kind}"
    return blocks.groupBy("band", "key", "low", "high").applyInPandas(compare, schema)


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``.

    ``n_links`` counts the other rows with a cosine of ``threshold`` or more (found
    in some band; a pair at the threshold is missed with chance MISS, nearer ones
    more rarely); a component is named by its smallest id, whose row is ``kept``.
    Equal vectors are compared once and count with their copies. Null vectors, and
    those that are zero or hold null or non-finite components, link with nothing;
    vectors link only with those of as many components. Rows without an id count as
    links and have the component of their equals. An empty table gives no rows.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    # -0.0 is 0.0.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0).cast("float")))
    digest = F.unhex(F.sha2(F.to_json(F.struct("vector")).cast("binary"), 256))
    rows = staged(
        rows.withColumn("fine", usable(F.col("vector"))).withColumn("digest", digest), "vectors"
    )
    fine = rows.where("fine")
    groups = staged(
        fine.groupBy("digest").agg(
            F.min("id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector")
        ),
        "distinct",
    )
    found = None
    # Lengths of vectors: a handful in any table of embeddings.
    for dim in sorted(r[0] for r in groups.select(F.size("vector")).distinct().collect()):
        nodes = groups.where((F.size("vector") == dim) & F.col("node").isNotNull())
        bits, bands = banding(nodes.count(), threshold)
        coded = staged(_coded(nodes, dim, bits, bands), "coded")
        coded = coded.join(nodes.select("node", "copies"), "node")
        keyed = staged(
            coded.select("node", F.posexplode("bands").alias("band", "key")).select(
                "node", "band", "key"
            ),
            "keyed",
        )
        place = F.xxhash64("band", "key").alias("place")
        keyed = keyed.withColumn("place", place)
        size = keyed.groupBy("place").agg(F.count("*").alias("rows")).where("rows > 1")
        size = staged(size, "bucket_sizes")
        cuts = F.ceil(F.col("rows") / BLOCK).cast("int")
        placed = join_counted(keyed, size, "place", "rows").withColumn("cuts", cuts)
        own = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
        placed = placed.withColumn("own", own).withColumn("other", other)
        blocks = placed.select(
            "node",
            "band",
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
        ).join(coded, "node")
        part = _linked(blocks, dim, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = groups.select("node", F.lit(0).cast("bigint").alias("links"), "node").toDF(
            "node", "links", "least"
        )
    found = staged(found, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found, "node", "least")
    named = (
        groups.drop("vector")
        .join(links, "node", "left")
        .join(joined, F.col("node") == joined["id"], "left")
        .select(
            "digest",
            F.col("copies"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "node").alias("component_id"),
        )
    )
    named = staged(named, "named")
    linked = join_counted(fine.select("id", "digest"), named, "digest", "copies")
    lone = rows.where("NOT fine").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    out = linked.select("id", "n_links", "component_id").union(lone)
    same = F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_links", "component_id", same)
