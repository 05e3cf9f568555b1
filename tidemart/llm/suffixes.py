"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

A window of LENGTH bytes belongs to the smallest hash of the short strings in it, its
anchor; equal windows have equal anchors. Stretches of text whose anchor occurs in
one document only are left out. The others are dealt by anchor into buckets, so that
all places of a window meet. In a bucket, equal stretches are searched once, and windows
whose hash no other has are left out. Each shard has its transform; the transforms
are merged by refining their interleave a symbol at a time, and intervals whose common
prefix reaches LENGTH are the repeats. Of each, the smallest document stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches, slices
from tidemart.llm._common import join_counted, staged
from tidemart.llm._shingles import _BASE, _OF_BYTE, _powers, mix

LENGTH = 50
ANCHOR = 16
# Bytes of text that one task works on, about.
GROUP_BYTES = 12_000_000
SHARDS = 4


def anchored(texts: list[bytes], length: int = LENGTH):
    """Runs of windows with one anchor: (text, start, end, anchor); windows start in
    [start, end)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    n = len(flat)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_OF_BYTE[flat] * _powers(_BASE, n), out=sums[1:])
    least = sums[ANCHOR:] - sums[:-ANCHOR]
    least *= _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(least))
    least = mix(least)
    span, have = length - ANCHOR + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    begin = np.cumsum(size) - size
    text = np.repeat(np.arange(len(texts)), size)[: len(least)]
    inside = np.arange(len(least)) + length <= (begin + size)[text]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    new[1:] |= inside[1:] != inside[:-1]
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(least))
    some = inside[start]
    start, end = start[some], end[some]
    text = text[start]
    return text, start - begin[text], end - begin[text], least[start]


def depth_order(symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, depth: int):
    """Rotations of some strings in the order of their first ``depth`` symbols.

    ``symbols`` are the strings one after the other, below 512.
    """
    n = len(symbols)
    of = np.repeat(np.arange(len(size)), size)
    base, wide = begin[of], size[of]
    place = np.arange(n) - base

    def ahead(step: int) -> np.ndarray:
        return base + (place + step) % wide

    rank, done = np.zeros(n, np.uint64), 0
    for k in range(min(7, depth)):
        rank = rank << np.uint64(9) | symbols[ahead(k)].astype(np.uint64)
        done += 1
    while True:
        order = np.argsort(rank, kind="stable")
        if done >= depth:
            return order
        ranked = rank[order]
        number = np.empty(n, np.uint64)
        number[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1])).astype(np.uint64)
        step = min(done, depth - done)
        rank = number << np.uint64(32) | number[ahead(step)]
        done += step


def merge_transforms(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges sorted shards by their transforms alone: (interleave, first).

    ``interleave`` names the shard of each row in the common order, which holds for
    the first ``depth`` symbols; ``first`` marks rows whose first ``depth`` symbols
    are not those of the row before.
    """
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    block = np.zeros(len(shard), np.int32)
    for _ in range(depth):
        symbol = np.empty(len(shard), np.uint16)
        for s, transform in enumerate(transforms):
            symbol[shard == s] = transform
        # Rows move to their symbol's range in the order they have now: one symbol more.
        order = np.argsort(symbol, kind="stable")
        shard, symbol, block = shard[order], symbol[order], block[order]
        new = np.append(True, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1]))
        block = np.cumsum(new, dtype=np.int32)
    return shard, np.append(True, block[1:] != block[:-1])


def repeats(strings: list[bytes], owners: np.ndarray, length: int, shards: int = SHARDS):
    """(string, offset) of each window that a smaller owner has, too."""
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.fromiter((len(s) + 1 for s in strings), np.int64, len(strings))
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + 1
    flat[begin + size - 1] = 0
    string = np.repeat(np.arange(len(strings)), size)
    offset = np.arange(len(flat)) - begin[string]
    parts, transforms = [], []
    for s in range(shards):
        # Whole strings, dealt out by turns.
        rows = np.flatnonzero(string % shards == s)
        if len(rows):
            own = size[s::shards]
            order = depth_order(flat[rows], np.cumsum(own) - own, own, length)
            order = rows[order]
            before = begin[string[order]] + (offset[order] - 1) % size[string[order]]
            parts.append(order)
            transforms.append(flat[before])
    shard, first = merge_transforms(transforms, length)
    merged = np.empty(len(flat), np.int64)
    for s, order in enumerate(parts):
        merged[shard == s] = order
    whole = offset[merged] + length < size[string[merged]]
    owner = np.where(whole, owners[string[merged]], np.iinfo(np.int64).max)
    at = np.flatnonzero(first)
    least = np.repeat(np.minimum.reduceat(owner, at), np.diff(np.append(at, len(owner))))
    hit = merged[whole & (owner > least)]
    return string[hit], offset[hit]


def candidates(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, end) of the runs of windows whose hash occurs more than once.

    Windows start in [start, end). Equal windows have equal hashes, so no other window
    is a repeat; the transforms need not hold it.
    """
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(strings), np.uint8)
    n = len(flat)
    windows = np.maximum(size - length + 1, 0)
    if not windows.sum():
        none = np.zeros(0, np.int64)
        return none, none, none
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_OF_BYTE[flat] * _powers(_BASE, n), out=sums[1:])
    hashes = sums[length:] - sums[:-length]
    del sums
    hashes *= _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(hashes))
    hashes = (mix(hashes) >> np.uint64(32)).astype(np.uint32)
    string = np.repeat(np.arange(len(strings), dtype=np.int32), windows)
    place = np.arange(len(string), dtype=np.int32) - (np.cumsum(windows) - windows)[string].astype(np.int32)
    hashes = hashes[begin[string] + place]
    ranked = np.sort(hashes)
    several = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(several):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(several, hashes), len(several) - 1)
    some = np.flatnonzero(several[at] == hashes)
    new = np.append(True, (np.diff(some) != 1) | (np.diff(string[some]) != 0))
    first, last = some[new], some[np.append(new[1:], True)]
    return string[first].astype(np.int64), place[first].astype(np.int64), place[last].astype(np.int64) + 1


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted intervals, those that touch or overlap made one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(new[1:], True)]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, spans) of every row of ``docs``.

    Bytes covered by a string of ``length`` bytes that also starts in a document
    with a smaller id are removed; ``spans`` are the removed (start, end), ``kept``
    is the rest (binary). Ids are integers. Null texts count as empty; a row without
    an id comes after all others, and of rows that share an id none is before the
    other. Other columns are ignored.
    """
    last = np.iinfo(np.int64).max
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(last)).alias("owner"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"),
    ).withColumn("digest", F.unhex(F.sha2("raw", 256)))
    rows = rows.withColumn("mark", F.xxhash64("digest"))
    # Of equal texts only those of the smallest id are searched.
    small = staged(rows.select("id", "owner", "digest", F.length("raw").alias("n")), "texts")
    equal = small.groupBy("digest").agg(F.min("owner").alias("lead"), F.count("*").alias("rows"))
    equal = staged(equal, "equal")
    # A row is told by owner and digest, from the stretches on by eight bytes of it; rows
    # that share both lose the same.
    leads = equal.select(F.col("lead").alias("owner"), "digest")
    total = small.agg(F.sum(F.col("n").cast("bigint"))).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP_BYTES))
    group = F.pmod(F.xxhash64("owner", "digest"), F.lit(groups)).cast("int").alias("g")
    texts = rows.select("owner", group, "raw", "digest", "mark").where(F.length("raw") >= length)

    # 1. Anchors of each group, and those that several documents have.
    def anchors():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner = batch.column(0).to_numpy()
            g = batch.column(1).to_numpy()
            text, _, _, anchor = anchored(batch.column(2).to_pylist(), length)
            # Once for each document; marked if several of these have it.
            order = np.lexsort((owner[text], anchor))
            a, o, p = anchor[order], owner[text][order], g[text][order]
            fresh = np.append(True, (a[1:] != a[:-1]) | (o[1:] != o[:-1]))[: len(a)]
            a, p = a[fresh], p[fresh].astype(np.int32)
            part = (a % np.uint64(groups)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            a, p, part = a[order], p[order], part[order]
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
            cuts = list(zip(at.tolist(), np.append(at[1:], len(part)).tolist(), strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(part[at]),
                    pa.array([p[x:y].tobytes() for x, y in cuts], pa.binary()),
                    pa.array([a[x:y].tobytes() for x, y in cuts], pa.binary()),
                ],
                ["part", "groups", "anchors"],
            )

        return step

    # A row for each batch and part, with the group of each anchor beside it.
    sent = map_batches(
        texts.drop("digest", "mark"), anchors, "part int, groups binary, anchors binary"
    )

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        anchor = np.frombuffer(b"".join(pdf["anchors"]), np.uint64)
        g = np.frombuffer(b"".join(pdf["groups"]), np.int32)
        order = np.argsort(anchor, kind="stable")
        anchor, g = anchor[order], g[order]
        same = anchor[1:] == anchor[:-1]
        several = np.append(False, same) | np.append(same, False)
        anchor, g = anchor[several], g[several]
        found = [(k, np.unique(anchor[g == k]).tobytes()) for k in np.unique(g)]
        return pd.DataFrame(found, columns=["g", "anchors"])

    common = staged(sent.groupBy("part").applyInPandas(shared, "g int, anchors binary"), "common")

    # 2. Stretches with such anchors. Of equal ones in a group the first goes on.
    searched = texts.join(leads.hint("merge"), ["owner", "digest"], "left_semi")
    searched = searched.select("g", "owner", "mark", "raw")

    def stretches(left: pa.Table, right: pa.Table) -> pa.Table:
        known = [np.frombuffer(x, np.uint64) for x in right.column("anchors").to_pylist()]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        columns: list[list] = [[], [], [], [], [], []]
        for whole in left.combine_chunks().to_batches() if len(known) else ():
            for batch in slices(whole):
                texts = batch.column("raw").to_pylist()
                owner = batch.column("owner").to_pylist()
                mark = batch.column("mark").to_pylist()
                text, start, end, anchor = anchored(texts, length)
                at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                some = known[at] == anchor
                for t, a, b, k in zip(
                    *(x[some].tolist() for x in (text, start, end, anchor)), strict=True
                ):
                    columns[0].append(k % (4 * groups))
                    columns[1].append(owner[t])
                    columns[2].append(a)
                    columns[3].append(b - 1 + length)
                    columns[4].append(texts[t][a : b - 1 + length])
                    columns[5].append(mark[t])
        firsts: dict[bytes, int] = {}
        for o, raw in zip(columns[1], columns[4], strict=True):
            if o < firsts.get(raw, last + 1):
                firsts[raw] = o
        # Later documents lose the whole stretch; nothing more is to be found out.
        for i, (o, raw) in enumerate(zip(columns[1], columns[4], strict=True)):
            if o > firsts[raw]:
                columns[0][i], columns[4][i] = -1, None
        types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        names = ["bucket", "owner", "start", "end", "raw", "mark"]
        return pa.table(dict(zip(names, arrays, strict=True)))

    schema = "bucket int, owner bigint, start int, end int, raw binary, mark bigint"
    cut = searched.groupBy("g").cogroup(common.groupBy("g")).applyInArrow(stretches, schema)
    cut = staged(cut, "stretches")

    # 3. Repeats of each bucket.
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("owner", kind="stable")
        strings, owners = pdf["raw"].tolist(), pdf["owner"].to_numpy(np.int64)
        start, mark = pdf["start"].to_numpy(np.int64), pdf["mark"].to_numpy(np.int64)
        # Of equal stretches the smallest document's goes on, later ones' go whole.
        firsts: dict[bytes, int] = {}
        for i, raw in enumerate(strings):
            firsts.setdefault(raw, i)
        lead = np.fromiter((firsts[raw] for raw in strings), np.int64, len(strings))
        gone = np.flatnonzero(owners > owners[lead])
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        left = np.flatnonzero(owners == owners[lead])  # one document may have it several times
        of, low, high = candidates([strings[i] for i in left], length)
        of = left[of]
        parts = [strings[i][a : b - 1 + length] for i, a, b in zip(of.tolist(), low.tolist(), high.tolist())]
        string, offset = repeats(parts, owners[of], length)
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order].astype(np.int64)
        new = np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1))
        new = new[: len(string)]
        run, at = string[new], offset[new]
        until = offset[np.append(new[1:], True)[: len(string)]]
        whose = np.concatenate([of[run], gone])
        begins = np.concatenate([start[of[run]] + low[run] + at, start[gone]])
        ends = np.concatenate([start[of[run]] + low[run] + until + length, start[gone] + size[gone]])
        return pd.DataFrame(
            {"owner": owners[whose], "mark": mark[whose], "start": begins, "end": ends}
        )

    spans = "owner bigint, mark bigint, start bigint, end bigint"
    found = cut.where("bucket >= 0").drop("end").groupBy("bucket").applyInPandas(search, spans)
    own = cut.where("bucket < 0").select(
        "owner", "mark", F.col("start").cast("bigint"), F.col("end").cast("bigint")
    )
    listed = found.union(own).groupBy("owner", "mark")
    listed = listed.agg(F.collect_list(F.struct("start", "end")).alias("found"))

    # 4. What each document keeps; a later copy of a text keeps nothing, if long enough.
    with_lead = join_counted(small.select("id", "owner", "digest"), equal, "digest", "rows")
    copies = with_lead.where("owner > lead")
    copies = copies.select("owner", F.xxhash64("digest").alias("mark")).distinct()
    doomed = staged(copies.withColumn("copy", F.lit(True)), "copies")
    row = ["owner", "mark"]
    marked = rows.hint("merge").join(staged(listed, "spans"), row, "left")
    marked = marked.hint("merge").join(doomed, row, "left")
    marked = marked.select("id", "raw", "found", "copy")

    def cut_out():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[tuple] = []
            for raw, places, copy in zip(
                *(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True
            ):
                if copy and len(raw) >= length:
                    places = [{"start": 0, "end": len(raw)}]
                pairs = np.array([(p["start"], p["end"]) for p in places or ()], np.int64)
                start, end = _joined(*pairs.reshape(-1, 2).T)
                edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                cuts = [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist())]
                out.append((len(raw), len(raw) - len(kept), len(cuts), kept, cuts))
            cut = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(cut))
            columns = zip(*out, strict=True) if out else [[]] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays],
                ["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
            )

        return step

    schema = (
        f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, "
        "spans array<struct<start: bigint, end: bigint>>"
    )
    return map_batches(marked, cut_out, schema).withColumnRenamed("id", id_col)

