"""Jaccard join of documents by word shingles, and its components.

Sets are sorted arrays of shingle hashes. Prefix filtering brings together every
two sets that can reach the threshold: the rarest part of each is its list of keys,
and similar sets share a key. A key's sets of like size are a tile. First each set
is compared with the first of its tiles; then, in the tiles whose members are not
yet connected, sets of different components are compared by bitmaps, whose bit
counts bound the overlap from above. Only pairs within the bound meet in an exact
intersection of their arrays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches
from tidemart.llm._common import join_counted, staged
from tidemart.llm._shingles import Words
from tidemart.llm.components import components

SHINGLE = 5
PERCENT = 80
BITS = 2048
# Bits of a wide bitmap for each shingle of its set, at least.
WIDE = 4
# Bytes of a hash kept in a stored set. Intersections of these may be too large by the
# few hashes that agree in them; pairs that near the threshold are read again whole.
KEPT = 5
# Counters of the frequency sketch.
COUNTERS = 1 << 18
# One in so many hashes is counted exactly; these come first as keys.
COUNTED = 2
# Hashes for each range of them that one call counts, about.
RANGE_HASHES = 1_000_000
# Rows of a tile compared by one task at once; larger tiles are cut into such blocks.
BLOCK = 2000
# Bytes of texts whose words are hashed at once; that takes some thirty times the room.
TEXT_BYTES = 512 << 10
# Rows of tiles that one call takes, about.
BUCKET_ROWS = 20_000


def _pack(hashes: np.ndarray) -> bytes:
    return hashes.view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEPT, 8), np.uint8)
    out[:, :KEPT] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT)
    return out.view(np.uint64).ravel()


def _bitmap(hashes: np.ndarray, size: int = BITS) -> np.ndarray:
    bits = np.zeros(size, np.uint8)
    bits[(hashes % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits)


def _wide_bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bitmap that grows with the set; its size in bits is a power of two."""
    return _bitmap(hashes, max(BITS, 1 << (WIDE * len(hashes) - 1).bit_length()))


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    """The bitmap of ``size`` bytes that the same set has."""
    parts = np.frombuffer(bitmap, np.uint8).reshape(-1, size)
    return np.bitwise_or.reduce(parts, axis=0).view(np.uint64)


def shingle_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE
) -> DataFrame:
    """(id, n_shingles, digest, set) of every row; null texts count as empty.

    ``set`` has the low KEPT bytes of each 64-bit hash, in their order.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            sets = Words(texts).shingles(n)
            low = [np.sort(s & np.uint64((1 << 8 * KEPT) - 1)) for s in sets]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([_pack(s) for s in low], pa.binary()),
                ],
                ["id", "n_shingles", "digest", "set"],
            )

        return step

    schema = f"id {kind}, n_shingles bigint, digest binary, set binary"
    return map_batches(docs.select(F.col(id_col), F.col(text_col)), work, schema, TEXT_BYTES)


def _common_counters(sets: DataFrame) -> np.ndarray:
    """Counters (of COUNTERS) that far more sets hit than is usual, with their counts."""

    def count(batches):
        seen = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                np.add.at(seen, (_unpack(raw) % np.uint64(COUNTERS)).astype(np.int64), 1)
        many = np.flatnonzero(seen > 8 + 4 * seen.mean())
        yield pa.RecordBatch.from_arrays(
            [pa.array(many), pa.array(seen[many])], ["counter", "hits"]
        )

    rows = sets.select("set").mapInArrow(count, "counter bigint, hits bigint")
    # At most COUNTERS rows, whatever the input.
    found = rows.groupBy("counter").agg(F.sum("hits").alias("hits")).toPandas()
    out = np.zeros(COUNTERS, np.int64)
    out[found["counter"].to_numpy(np.int64)] = found["hits"].to_numpy(np.int64)
    return out


def _counted(hashes: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Which hashes are counted one by one: a part of the hash space, less common ones."""
    own = hashes % np.uint64(COUNTED) == 0
    return own & (hits[(hashes % np.uint64(COUNTERS)).astype(np.int64)] == 0)


def _shared(sets: DataFrame, hits: np.ndarray) -> DataFrame:
    """(digest, shared): a set's counted hashes that other sets have too.

    Each is a number, frequency first, then the hash, in this order. Hashes are dealt by
    value, those of a batch of sets together; no counted hash holds more than a few of
    COUNTERS of all. Answers come back in blocks of sets, so that their number follows
    the ranges, not the sets in each.
    """
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = 1 + total // RANGE_HASHES

    def deal():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = dict(zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True))
            names = list(sets)
            some = [s[_counted(s, hits)] for s in map(_unpack, sets.values())]
            doc = np.repeat(np.arange(len(some)), [len(s) for s in some])
            hashes = np.concatenate(some) if some else np.zeros(0, np.uint64)
            part = (hashes >> np.uint64(8)) % np.uint64(ranges)
            order = np.lexsort((hashes, part))
            hashes, doc, part = hashes[order], doc[order], part[order]
            at = np.flatnonzero(np.diff(part, prepend=np.uint64(ranges)))
            dealt = []
            for i, j in zip(at, np.append(at[1:], len(part)), strict=True):
                docs, place = np.unique(doc[i:j], return_inverse=True)
                digests = b"".join(names[d] for d in docs)
                place = place.astype(np.uint32 if len(docs) > 1 << 16 else np.uint16)
                dealt.append((int(part[i]), digests, _pack(hashes[i:j]), place.tobytes()))
            columns = list(zip(*dealt, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["range", "digests", "hashes", "place"],
            )

        return step

    dealt = map_batches(
        sets.select("digest", "set"), deal, "range bigint, digests binary, hashes binary, place binary"
    )

    def count(table: pa.Table) -> pa.Table:
        names, hashes, doc, known = [], [], [], 0
        for ids, raw, place in zip(*(table[c].to_pylist() for c in table.column_names[1:]), strict=True):
            hashes.append(_unpack(raw))
            places = np.frombuffer(place, f"u{len(place) // len(hashes[-1])}")
            doc.append(places.astype(np.int64) + known)
            names.append(ids)
            known += len(ids) // 16
        # Copies of a set count once.
        raw = pa.py_buffer(b"".join(names))
        names = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), known, [None, raw])
        names = names.dictionary_encode()
        hashes = np.concatenate(hashes)
        doc = names.indices.to_numpy()[np.concatenate(doc)]
        order = np.lexsort((doc, hashes))
        hashes, doc = hashes[order], doc[order]
        new = (np.diff(hashes, prepend=hashes[:1] + np.uint64(1)) != 0) | (np.diff(doc, prepend=-1) != 0)
        hashes, doc = hashes[new], doc[new]
        _, same, times = np.unique(hashes, return_inverse=True, return_counts=True)
        times = times[same]
        some = times > 1
        most = (1 << 63 - 8 * KEPT) - 1
        value = np.minimum(times[some], most).astype(np.uint64) << np.uint64(8 * KEPT)
        value, doc = (value | hashes[some]).astype(np.int64), doc[some]
        # Answers go back to blocks of sets, those of a block together.
        raw = np.frombuffer(b"".join(names.dictionary.to_pylist()), np.uint8).reshape(-1, 16)
        block = raw[:, :8].copy().view(np.uint64).ravel() % np.uint64(ranges)
        order = np.lexsort((doc, block[doc]))
        value, doc = value[order], doc[order]
        at = np.flatnonzero(np.diff(doc, prepend=-1))
        sizes = np.diff(np.append(at, len(doc))).astype(np.uint32)
        own = block[doc[at]]
        cuts = np.flatnonzero(np.diff(own, prepend=np.uint64(ranges)))
        out = []
        for i, j in zip(cuts, np.append(cuts[1:], len(own)), strict=True):
            last = at[j] if j < len(at) else len(value)
            out.append(
                (int(own[i]), raw[doc[at[i:j]]].tobytes(), sizes[i:j].tobytes(), value[at[i] : last].tobytes())
            )
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table(
            {n: pa.array(c, k) for n, c, k in zip(("block", "digests", "sizes", "values"), columns, kinds, strict=True)}
        )

    def gather(table: pa.Table) -> pa.Table:
        """All answers for the sets of a block: each set's values, sorted."""
        columns = [table[c].to_pylist() for c in ("digests", "sizes", "values")]
        raw = pa.py_buffer(b"".join(columns[0]))
        names = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), raw.size // 16, [None, raw])
        names = names.dictionary_encode()
        sizes = np.frombuffer(b"".join(columns[1]), np.uint32)
        value = np.frombuffer(b"".join(columns[2]), np.int64)
        doc = np.repeat(names.indices.to_numpy(), sizes)
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        at = np.flatnonzero(np.diff(doc, prepend=-1))
        listed = pa.ListArray.from_arrays(
            pa.array(np.append(at, len(doc)).astype(np.int32)), pa.array(value, pa.int64())
        )
        names = names.dictionary.take(pa.array(doc[at])).cast(pa.binary())
        return pa.table({"digest": names, "shared": listed})

    answers = "block bigint, digests binary, sizes binary, values binary"
    found = dealt.groupBy("range").applyInArrow(count, answers)
    return found.groupBy("block").applyInArrow(gather, "digest binary, shared array<bigint>")


def _keys(sets: DataFrame, firsts: DataFrame, hits: np.ndarray, percent: int) -> DataFrame:
    """(id, n, bitmap, keys) of each of ``firsts`` (digest, id).

    The keys are, in order of rarity, enough hashes that similar sets share one.
    Counted hashes come first, by frequency; then the others, by their counters' hits.
    Hashes that no other set has are keys that need not be listed.
    """
    kind = sets.schema["id"].dataType.simpleString()

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            maps, sizes, others = [], [], []
            for n, raw in zip(*(batch.column(k).to_pylist() for k in (1, 2)), strict=True):
                hashes = _unpack(raw)
                counted = _counted(hashes, hits)
                rest = hashes[~counted]
                order = np.lexsort((rest, hits[(rest % np.uint64(COUNTERS)).astype(np.int64)]))
                sizes.append(int(counted.sum()))
                some = max(0, n - -(-percent * n // 100) + 1 - sizes[-1])
                others.append(rest[order[:some]].astype(np.int64))
                maps.append(_bitmap(hashes).tobytes())
            return pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in (0, 1, 3)),
                    pa.array(maps, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(others, pa.list_(pa.int64())),
                ],
                ["id", "n", "digest", "bitmap", "counted", "others"],
            )

        return step

    own = map_batches(
        sets.select("id", "n_shingles", "set", "digest"),
        work,
        f"id {kind}, n bigint, digest binary, bitmap binary, counted bigint, others array<bigint>",
    )
    shared = F.coalesce("shared", F.array().cast("array<bigint>"))
    some = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # Of the counted hashes, those that only this set has come first.
    left = F.greatest(some - (F.col("counted") - F.size("shared")), F.lit(0)).cast("int")
    hash_of = F.transform(
        F.slice("shared", F.lit(1), left), lambda x: x.bitwiseAND(F.lit((1 << 8 * KEPT) - 1))
    )
    own = own.join(firsts, ["digest", "id"], "left_semi")
    both = own.join(_shared(sets, hits), "digest", "left").withColumn("shared", shared)
    return both.select("id", "n", "bitmap", F.concat(hash_of, "others").alias("keys"))


def _bounded(pairs: DataFrame, listed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps do not rule out."""
    kind = pairs.schema["a"].dataType.simpleString()

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            x, y = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(
                    -1, BITS // 64
                )
                for k in (4, 5)
            )
            more = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
            less = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
            most = np.minimum(n - more, m - less)
            return batch.select(["a", "b"]).filter(pa.array(100 * most >= percent * (n + m - most)))

        return step

    both = _both_sides(pairs, listed, ["n", "bitmap"])
    return map_batches(both, work, f"a {kind}, b {kind}")


def _wide_bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that wide bitmaps do not rule out.

    These take a fraction of the room that the sets take, and rule out what small
    bitmaps, full for long texts, can't. Of two sizes, the larger folds to the smaller.
    """
    kind = pairs.schema["a"].dataType.simpleString()

    def widen():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            maps = [_wide_bitmap(_unpack(raw)).tobytes() for raw in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(maps, pa.binary())],
                ["id", "n", "bitmap"],
            )

        return step

    rows = sets.select("id", "n_shingles", "set")
    wide = map_batches(rows, widen, f"id {kind}, n bigint, bitmap binary")

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for n, m, x, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                size = min(len(x), len(y))
                x, y = _folded(x, size), _folded(y, size)
                more = int(np.bitwise_count(x & ~y).sum(dtype=np.int64))
                less = int(np.bitwise_count(y & ~x).sum(dtype=np.int64))
                most = min(n - more, m - less)
                keep.append(100 * most >= percent * (n + m - most))
            return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return step

    return map_batches(_both_sides(pairs, wide, ["n", "bitmap"]), work, f"a {kind}, b {kind}")


def _both_sides(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, and for each of ``columns`` a's and b's value) of every pair."""

    def side(name: str) -> DataFrame:
        shown = [F.col(c).alias(f"{name}_{c}") for c in columns]
        return rows.select(F.col("id").alias(name), *shown)

    both = pairs.hint("merge").join(side("b").hint("merge"), "b")
    both = both.join(side("a").hint("merge"), "a")
    return both.select("a", "b", *(f"{name}_{c}" for c in columns for name in "ab"))


def _asked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of some pair."""
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b"))).distinct()
    return sets.join(staged(asked, "asked"), "id", "left_semi")


def _links(
    pairs: DataFrame, sets: DataFrame, percent: int, texts: DataFrame, shingle: int
) -> DataFrame:
    """The pairs (a, b), a stored table, that reach the threshold by exact intersection.

    Where the kept bytes leave it open, sets are made of ``texts`` (id, text) anew and
    their whole hashes are compared.
    """
    pairs = staged(_wide_bounded(pairs, _asked(pairs, sets), percent), "wide_pairs")
    kind = pairs.schema["a"].dataType.simpleString()
    both = _both_sides(pairs, _asked(pairs, sets), ["set"])

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep, sure = [], []
            for x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
                x, y = _unpack(x), _unpack(y)
                same = len(np.intersect1d(x, y, assume_unique=True))
                # 100 * same >= percent * union, and the same with some fewer shared.
                least = -(-percent * (len(x) + len(y)) // (100 + percent))
                keep.append(same >= least)
                sure.append(same >= least + 2 + (len(x) * len(y) >> 34))
            out = batch.select(["a", "b"]).append_column("sure", pa.array(sure, pa.bool_()))
            return out.filter(pa.array(keep, pa.bool_()))

        return step

    found = staged(map_batches(both, work, f"a {kind}, b {kind}, sure boolean"), "shared_pairs")
    sure, open_ = found.where("sure").select("a", "b"), found.where("NOT sure").select("a", "b")
    if open_.isEmpty():
        return sure
    asked = _asked(open_, texts)
    whole = map_batches(asked, lambda: _whole(shingle), f"id {kind}, set binary", TEXT_BYTES)

    def compare():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return step

    rest = map_batches(_both_sides(open_, whole, ["set"]), compare, f"a {kind}, b {kind}")
    return sure.unionByName(rest)


def _whole(shingle: int):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = Words([(t or "").encode() for t in batch.column(1).to_pylist()]).shingles(shingle)
        columns = [batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "set"])

    return step


def _tile_pairs(members: DataFrame, listed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that a tile's bitmaps do not rule out.

    ``members``: (key, rows of the tile, id, component). Tiles over BLOCK rows are cut
    into blocks, and each two blocks meet in a task of their own.
    """
    kind = members.schema["id"].dataType.simpleString()
    rows = members.withColumn("cuts", F.ceil(F.col("rows") / BLOCK).cast("int"))
    # A row goes to as many blocks as its tile has cuts.
    total = rows.agg(F.sum(F.col("cuts").cast("bigint"))).first()[0] or 0
    own = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    rows = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    )
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    rows = rows.select("key", low, high, "id", "component", "own")
    rows = rows.join(listed.select("id", "n", "bitmap"), "id")
    # Most tiles are tiny, so a task's call takes many of them.
    buckets = 1 + total // BUCKET_ROWS
    bucket = F.pmod(F.xxhash64("key", "low", "high"), F.lit(buckets)).alias("bucket")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "low", "high", "n"], kind="stable")
        key, low, high = (pdf[c].to_numpy() for c in ("key", "low", "high"))
        n, own = pdf["n"].to_numpy(), pdf["own"].to_numpy()
        ids, component = pdf["id"].to_numpy(), pdf["component"].to_numpy()
        maps = np.frombuffer(b"".join(pdf["bitmap"]), np.uint64).reshape(len(pdf), -1)
        new = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        tile = np.cumsum(np.append(0, new))
        a, b = [], []
        # Each row with the one so many places on, as long as that is in its tile and
        # not too large to be similar; sizes rise within a tile.
        i, step = np.arange(len(pdf)), 1
        while len(i):
            i = i[i + step < len(pdf)]
            j = i + step
            some = (tile[j] == tile[i]) & (100 * n[i] >= percent * n[j])
            i = i[some]
            j = i + step
            apart = (component[i] != component[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
            p, q = i[apart], j[apart]
            step += 1
            if not len(p):
                continue
            x, y = maps[p], maps[q]
            more = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
            less = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
            most = np.minimum(n[p] - more, n[q] - less)
            near = 100 * most >= percent * (n[p] + n[q] - most)
            a.append(np.minimum(ids[p[near]], ids[q[near]]))
            b.append(np.maximum(ids[p[near]], ids[q[near]]))
        none = ids[:0]
        pairs = {"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])}
        return pd.DataFrame(pairs).drop_duplicates()

    found = rows.groupBy(bucket).applyInPandas(compare, f"a {kind}, b {kind}")
    return found.distinct()


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``.

    Two texts link if their shingles' Jaccard similarity is ``percent`` / 100 or
    more; a component is named by its smallest id. Null and empty texts, and those
    without words, link with nothing. Rows without an id belong to the component of
    their equals, if any of these has an id. Equal sets are compared once.
    """
    sets = staged(shingle_sets(docs, id_col, text_col, shingle), "sets")
    shown = sets.where("n_shingles > 0")
    groups = shown.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    groups = staged(groups, "groups")
    firsts = groups.where("first IS NOT NULL").select("digest", F.col("first").alias("id"))
    listed = staged(_keys(shown, firsts, _common_counters(shown), percent), "keys")

    tiles = listed.select("id", "n", F.explode("keys").alias("key"))
    # A key that only one set has brings nothing together.
    lead = F.min(F.struct("id", "n")).alias("lead")
    first = staged(
        tiles.groupBy("key").agg(lead, F.count("*").alias("rows")).where("rows > 1"), "leads"
    )
    rows = staged(
        join_counted(tiles.hint("merge"), first, "key", "rows").select(
            "key", "id", "n", "lead.id", F.col("lead.n").alias("lead_n")
        ).toDF("key", "id", "n", "lead", "lead_n"),
        "tiles",
    )
    small, large = F.least("n", "lead_n"), F.greatest("n", "lead_n")
    star = rows.where((F.col("id") > F.col("lead")) & (small * 100 >= large * percent))
    star = star.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    star = staged(_bounded(star, listed, percent), "star_pairs")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    links = staged(_links(star, shown, percent, texts, shingle), "star_links")
    joined = staged(components(links, "a", "b"), "joined")

    own = rows.select("key", "id").join(joined, "id", "left")
    own = own.select("key", "id", F.coalesce("component_id", "id").alias("component"))
    ends = own.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows")
    )
    open_keys = staged(ends.where("low < high").select("key", "rows"), "open_keys")
    members = staged(join_counted(own, open_keys, "key", "rows"), "members")
    pairs = staged(_tile_pairs(members, listed, percent), "tile_pairs")
    more = staged(_links(pairs, shown, percent, texts, shingle), "tile_links")
    named = groups.join(joined, groups["first"] == joined["id"], "left").select(
        "digest", F.coalesce("component_id", "first").alias("component_id"), "rows"
    )
    if not more.isEmpty():
        # The links found last connect components, not sets: only these are followed.
        for end in ("a", "b"):
            name = joined.select(F.col("id").alias(end), F.col("component_id").alias("to"))
            more = more.join(name, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        wider = components(more, "a", "b").select(
            F.col("id").alias("component_id"), F.col("component_id").alias("to")
        )
        named = named.join(staged(wider, "joined_wider"), "component_id", "left")
        named = named.withColumn("component_id", F.coalesce("to", "component_id")).drop("to")
    named = staged(named, "named")
    kept = shown.select("id", "n_shingles", "digest")
    out = join_counted(kept, named, "digest", "rows").select("id", "n_shingles", "component_id")
    alone = sets.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("x"))
    return out.union(alone).withColumnRenamed("id", id_col)

