"""Each corpus operator beside a brute-force version, and on awkward rows."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemart.llm import (
    _arrow,
    embeddings,
    exact_dedup,
    jaccard,
    licenses,
    packing,
    passages,
    pieces,
    pii,
    suffixes,
    toxicity,
)
from tidemart.llm._arrow import SLICE_BYTES
from tidemart.llm._shingles import Words
from tidemart.llm.components import components
from tidemart.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in "ka lo mi nu pe ra so ti".split() for b in "bad fen gol hur jin".split()]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def corpus():
    """Random texts with copies, near copies, shared passages and awkward rows."""
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(3, 260)) for _ in range(40)]
    texts += [texts[3], texts[3].replace(" ", " \n"), texts[5].upper(), texts[3]]
    for k in range(12):  # near copies of one text, and a chain of them
        words = texts[6 if k < 6 else len(texts) - 1].split()
        words[rng.randrange(len(words))] = f"new{k}"
        texts.append(" ".join(words))
    shared = prose(rng, 70)
    texts += [f"{prose(rng, 40)} {shared} {prose(rng, 9)}" for _ in range(5)]
    texts += ["", None, "  \t\n ", "one", "One ", "a b c d", "a b c d e", "é" * 60, "é" * 61]
    texts += ["x" * 500, "x" * 300, prose(rng, 9000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [(None, texts[3], None, None, None), rows[4], (2**40, "last one", "en", "s", 8)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect() if r[0] is not None}


def roots(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_exact_dedup(spark, docs):
    index = exact_dedup.new_index(spark, docs)
    rows = exact_dedup.dedup_exact(docs, index).collect()
    assert len(rows) == len(corpus())
    flat = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in corpus()]
    for r in rows:
        mine = {hashlib.sha256(t.encode()).hexdigest() for i, t in flat if i == r.doc_id}
        assert r.text_sha256 in mine
        same = [i for i, t in flat if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        assert r.group_size == len(same)
        assert r.keep_id == min(i for i in same if i is not None)
    assert sum(r.kept for r in rows) == len({t for _, t in flat})


def test_digest_index_remembers_and_may_be_run_again(spark, docs, tmp_path):
    first = docs.where("doc_id < 30")
    path = str(tmp_path / "index")
    for _ in range(2):  # the second run finds what the first one added
        again = exact_dedup.DigestIndex(spark, path, buckets=3)
        rows = exact_dedup.dedup_exact(first, again)
        assert rows.where("kept").count() == first.select("text").distinct().count()
    later = spark.createDataFrame([(500, corpus()[3][1]), (501, "fresh")], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, path, buckets=8)
    assert index.buckets == 3
    got = by_id(exact_dedup.dedup_exact(later, index).select("doc_id", "keep_id", "kept"))
    assert got == {500: (3, False), 501: (501, True)}


def test_jaccard_components(docs):
    def shingles(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        if len(words) < 5:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = {i: shingles(t) for i, t, *_ in corpus() if i is not None}
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    root = roots(pairs, sets)
    got = by_id(jaccard.similar_components(docs))
    assert got == {i: (len(s), root[i]) for i, s in sets.items()}
    assert len(set(root.values())) < len(root)


def test_suffix_dedup(docs):
    seen, want = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in corpus() if i is not None}):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if seen.setdefault(raw[k : k + 50], i) < i:
                gone[k : k + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[i] = (len(raw), int(gone.sum()), spans, kept)
    found = suffixes.remove_repeats(docs)
    got = by_id(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept"))
    assert {i: (*r[:3], bytes(r[3])) for i, r in got.items()} == want


def test_suffix_dedup_tells_rows_that_share_an_id(spark):
    rng = random.Random(12)
    one, two, three, four = (prose(rng, 40) for _ in range(4))
    part = three[50:150]
    rows = [(1, one), (1, one), (2, two), (2, one), (3, f"{part} {four}"), (None, one)]
    rows += [(None, three), (None, three), (None, prose(rng, 40)), (None, None)]
    rows += [(4, two[:120]), (4, f"{prose(rng, 9)} {part}")]
    want = []
    for i, t in rows:
        raw, owner = (t or "").encode(), float("inf") if i is None else i
        gone = np.zeros(len(raw), bool)
        for j, other in rows:
            for k in range(len(raw) - 49) if j is not None and j < owner else ():
                if raw[k : k + 50] in (other or "").encode():
                    gone[k : k + 50] = True
        want.append((str(i), len(raw), int(gone.sum()), bytes(np.frombuffer(raw, np.uint8)[~gone])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffixes.remove_repeats(df).collect()
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, bytes(r.kept)) for r in found]
    assert sorted(got) == sorted(want)


def test_merged_transforms_are_sorted():
    rng = random.Random(3)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))).encode() for _ in range(30)]
    owners = np.arange(30)
    got = set(zip(*(x.tolist() for x in suffixes.repeats(strings, owners, 6, shards=3)), strict=True))
    first, want = {}, set()
    for i, s in enumerate(strings):
        for k in range(len(s) - 5):
            if first.setdefault(s[k : k + 6], i) < i:
                want.add((i, k))
    assert got == want


def test_passages_cover_every_long_repeat(docs):
    texts = {i: (t or "").lower().split() for i, t, *_ in corpus() if i is not None}
    first, want = {}, {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - 49):
            if first.setdefault(tuple(texts[i][k : k + 50]), i) < i:
                want.setdefault(i, set()).update(range(k, k + 50))
    got = {}
    for r in passages.shared_passages(docs).collect():
        assert r.other_id < r.doc_id and r.similarity >= 0.8
        got.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    assert all(places <= got.get(i, set()) for i, places in want.items())
    assert 50 not in want or 50 in got


def test_chains_and_alignment():
    assert sorted(map(len, passages.chains([(0, 5), (9, 14), (18, 3)]))) == [1, 2]
    assert passages.common_words(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2
    a = np.arange(100)
    b = np.concatenate([a[:50], [900, 901], a[50:]])
    assert passages.align([(10, 10), (70, 72)], a, b) == (0, 100, 0, 102, 100)


@pytest.mark.parametrize(
    "first, gap, other_gap, second",
    [(50, 30, 30, 50), (100, 60, 60, 100), (60, 0, 90, 60), (50, 30, 41, 50)],
)
def test_passages_on_both_sides_of_a_gap(spark, first, gap, other_gap, second):
    rng = random.Random(first + gap + other_gap)
    one, two = prose(rng, first), prose(rng, second)
    texts = [" ".join([prose(rng, 20), one, prose(rng, g), two, prose(rng, 20)]) for g in (other_gap, gap)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, words = set(), [t.split() for t in texts]
    for r in passages.shared_passages(df).collect():
        a, b = words[1][r.start : r.end], words[0][r.other_start : r.other_end]
        assert (r.doc_id, r.other_id) == (1, 0) and min(len(a), len(b)) >= 50
        assert r.similarity >= 0.8 and r.n_same <= passages.common_words(np.array(a), np.array(b))
        got.update(range(r.start, r.end))
    assert {*range(20, 20 + first), *range(20 + first + gap, 20 + first + gap + second)} <= got


@pytest.mark.parametrize("seed", range(6))
def test_parts_cover_all_that_is_alike(seed):
    rng = np.random.default_rng(seed)
    steps = np.where(rng.random((120, 2)) < 0.8, 1, rng.integers(1, 9, (120, 2)))
    words = np.cumsum(steps, axis=0)
    a, b = rng.integers(0, 4, 30), rng.integers(0, 4, 25)
    places = passages.common_places(a, b)
    assert len(places) == passages.common_words(a, b) and all(a[i] == b[k] for i, k in places)
    assert all(i < j and k < m for (i, k), (j, m) in zip(places, places[1:], strict=False))
    want = set()
    for i in range(120):
        for j in range(i, 120):
            size = words[j] - words[i] + 1
            if size.min() >= 20 and j - i + 1 >= 0.8 * size.max():
                want.update(range(i, j + 1))
    got = passages.alike_parts(words, 20, 0.8)
    assert {k for i, j in got for k in range(i, j + 1)} == want


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    near = base[0] + 0.15 * rng.standard_normal((40, 16))
    x = np.concatenate([base, near, base[5:6], base[5:6]]).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, v, None) for i, v in enumerate(odd)] + [(None, rows[5][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = (unit @ unit.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    root = roots(zip(*np.nonzero(close), strict=True), range(len(x)))
    links = close.sum(axis=1)
    links[[5, 100, 101]] += 1  # the row without an id
    want = {i: (int(links[i]), root[i], root[i] == i) for i in range(len(x))}
    want |= {1000 + i: (0, 1000 + i, True) for i in range(5)}
    want |= {1005: (1, 1005, True), 1006: (1, 1005, False)}
    assert by_id(embeddings.near_vectors(df)) == want
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(3, 3), (None, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df, "a", "b").collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


def fewest_bins(sizes, room):
    """The least number of bins, by trying every packing."""
    best = len(sizes)
    sizes = sorted(sizes, reverse=True)

    def place(k, rests):
        nonlocal best
        if len(rests) >= best:
            return
        if k == len(sizes):
            best = len(rests)
            return
        for r in sorted(set(rests)):
            if r >= sizes[k]:
                at = rests.index(r)
                place(k + 1, [*rests[:at], r - sizes[k], *rests[at + 1 :]])
        place(k + 1, [*rests, room - sizes[k]])

    place(0, [])
    return best


def test_bin_completion_equals_every_packing_tried():
    rng = random.Random(3)
    for _ in range(150):
        room = rng.randint(8, 40)
        sizes = [rng.randint(1, room) for _ in range(rng.randint(1, 10))]
        bins, ended = packing.complete_bins(np.array(sizes), room)
        assert sorted(x for b in bins for x in b) == sorted(sizes)
        assert max(map(sum, bins)) <= room
        assert len(bins) == fewest_bins(sizes, room) and ended in ("bound", "proof")


def test_bin_completion_of_many_pieces():
    rng = np.random.default_rng(1)
    # Full bins cut in three: the optimum is their number, and best fit misses it.
    cuts = np.sort(np.stack([rng.choice(np.arange(600, 2900), 2, replace=False) for _ in range(4000)]))
    sizes = np.concatenate([cuts[:, 0], cuts[:, 1] - cuts[:, 0], 4096 - cuts[:, 1]])
    assert len(packing.best_fit(sizes, 4096)) > 4000
    bins, ended = packing.complete_bins(sizes, 4096)
    assert (len(bins), ended) == (4000, "bound") and set(map(sum, bins)) == {4096}
    # Where best fit wastes much, most of the waste goes.
    sizes = rng.integers(600, 2101, 12_000)
    least, first = packing.fewest(sizes, 4096), len(packing.best_fit(sizes, 4096))
    bins, ended = packing.complete_bins(sizes, 4096)
    assert len(bins) - least < (first - least) / 3
    assert np.array_equal(np.sort(np.concatenate(bins)), np.sort(sizes))


def test_packing(docs):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, room=256).collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in corpus()}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.start == 256 * r.piece
    assert sum(r.length for r in rows) == sum(len(ids[i]) for i, *_ in corpus())
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    part = np.array([r.length for r in rows if r.length < 256])
    least = packing.fewest(part, 256) + len(rows) - len(part)
    assert least <= len(by_sequence) <= least + 1


def test_word_ids_are_the_tokenizers():
    words = packing.WordIds(tokenizer_path("word_bpe_49k.json"))
    odd = "a<|endoftext|>b <|x don't 's x'll É é ÀΣ ς\x1cb\x85c\xa0d　e 日本語 İstanbul ́x 12,5 !!?.. ﬁ"
    for text in [odd, *odd.split(), "", "x" * 300, *(prose(random.Random(i), 50) for i in range(5))]:
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.of([text])[0], "<u4").tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_bins_are_as_few_as_can_be(seed):
    rng = np.random.default_rng(seed)
    # Cut from full bins, so that these are known to do.
    sizes = np.concatenate([np.diff([0, *np.sort(rng.choice(99, 3, replace=False) + 1, ), 100]) for _ in range(12)])
    sizes = sizes[sizes > 0]
    bins, _ = packing.complete_bins(sizes, 100)
    assert sorted(x for b in bins for x in b) == sorted(sizes.tolist())
    assert max(map(sum, bins)) <= 100 and len(bins) <= 13
    assert packing.fewest(sizes, 100) == 12
    hard = np.array([6, 6, 5, 5, 5, 3])
    assert len(packing.best_fit(hard, 15)) >= len(packing.complete_bins(hard, 15)[0]) == 2
    assert packing.fewest(np.array([6, 6, 6, 6]), 10) == 4


def brute_path(model, unit):
    best = {0: (0.0, [])}
    for end in range(1, len(unit) + 1):
        tries = []
        for start in range(end):
            if start not in best:
                continue
            piece = unit[start:end]
            if piece.encode() in model.known:
                number = model.known[piece.encode()]
                tries.append((best[start][0] + model.score[number], -start, best[start][1] + [number]))
            elif end == start + 1:
                ids = [model.bytes_from + b for b in piece.encode()]
                tries.append((best[start][0] + model.unknown_score, -start, best[start][1] + ids))
        best[end] = max(tries)[::2]
    return best[len(unit)]


def test_pieces(docs):
    model = pieces.PieceModel.load(tokenizer_path("piece_bpe_32k.model"))
    model.known = {s: i for i, s in enumerate(model.surface) if s and not np.isnan(model.score[i])}
    run = model.encoder()
    texts = ["a b", "  two  spaces ", "x\ty\n\nz😀é", "日本語 テスト", "▁ mark", "thequick" * 9, "\0", ""]
    for text in texts + [t for _, t, *_ in corpus()[:6]]:
        ids = np.frombuffer(run([text])[0], "<i4").tolist()
        assert model.decode(ids) == text.replace("▁", " ")
        score = sum(
            model.unknown_score if np.isnan(model.score[i]) else model.score[i] for i in ids
        )
        units = model.units.findall("▁" + text.replace(" ", "▁")) if text else []
        paths = [brute_path(model, u) for u in units]
        if all(not np.isnan(model.score[i]) for i in ids):
            assert score == sum(p[0] for p in paths)
        assert len(ids) == sum(len(p[1]) for p in paths) or score == sum(p[0] for p in paths)
    rows = pieces.round_trip(docs, model).collect()
    assert len(rows) == len(corpus()) and all(r.same for r in rows)
    coded = pieces.encode(docs, model)
    back = pieces.decode(coded, model)
    assert by_id(back) == {i: (t or "",) for i, t, *_ in corpus() if i is not None}


PRIVATE = [
    "call +1 (336) 555-3810 or 4111 1111 1111 1111, 4111111111111111; not 4111111111111112",
    "on 2024-02-29 not 2024-02-30, 12/31/1999, 31.12.1999 from 10.1.2.3 not 300.1.1.1",
    "123-45-6789 not 000-12-3456; a.b7@mail.example.com; GB82 WEST 1234 5698 7654 32",
]


def test_pseudonyms(spark):
    rows = [(i, t, "x") for i, t in enumerate([*PRIVATE, *PRIVATE, None, "", "no 12 data"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = by_id(pii.pseudonymise(df, "k").select("doc_id", "text", "pii"))
    assert [p.kind for p in got[0][1]] == ["phone", "card", "card"]
    assert got[0][1][1].text.replace(" ", "") == got[0][1][2].text
    assert [p.kind for p in got[1][1]] == ["date", "date", "date", "ip"]
    assert [p.kind for p in got[2][1]] == ["ssn", "email", "iban"]
    assert got[0] == got[3] and got[6] == (None, []) and got[7] == ("", [])
    assert got[8] == ("no 12 data", [])
    for kept in ("4111111111111112", "2024-02-30", "300.1.1.1", "000-12-3456"):
        assert any(kept in t for t, _ in (got[0], got[1], got[2]))
    for i in range(3):
        assert re.sub(r"[\d]+", "0", got[i][0]).count("0") == re.sub(r"[\d]+", "0", PRIVATE[i]).count("0") or i == 2
        assert got[i][0] != PRIVATE[i]
    # What comes out is valid again, and another key gives another text.
    once = pii.pseudonymise(df, "k").drop("pii")
    again = by_id(pii.pseudonymise(once, "k").select("doc_id", "text", "pii"))
    assert [len(again[i][1]) for i in range(3)] == [3, 4, 3]
    other = by_id(pii.pseudonymise(df, "j").select("doc_id", "text"))
    assert other[0][0] != got[0][0]


def test_feistel_is_a_permutation(spark):
    from pyspark.sql import functions as F

    df = spark.range(27 * 37).select(pii.feistel(F.col("id"), 27, 37, "k", "t").alias("x"))
    assert sorted(r.x for r in df.collect()) == list(range(27 * 37))


def test_licenses(spark):
    texts = [
        "Foo bar.\nReleased under the MIT License.\nbaz",
        "x\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms\n"
        "of the GNU General Public License as published by the Free Software Foundation, either\n"
        "version 3 of the License, or (at your option) any later version.\n",
        "the license of nothing. all rights\nreserved",
        None,
        "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(licenses.scan_licenses(df).select("doc_id", "licenses"))
    assert got[0] == (["MIT"],) and got[1] == (["Apache-2.0", "CC-BY-NC-4.0"],)
    assert got[3] == (["Proprietary"],) and got[4] == got[5] == ([],)
    assert got[2] == (["GPL-3.0-or-later"],)


def test_toxicity(spark):
    rng = random.Random(2)
    bad = ["grumwort", "vexling", "snarkel"]
    rows, labels = [], []
    for i in range(300):
        words = prose(rng, rng.randint(5, 200)).split()
        if i % 3 == 0:
            for k in range(0, len(words), 30):
                words[k] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0), None))
    rows += [(900, None), (901, ""), (902, "a grumworts and vexlinge"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1, 0), (2, None, 0)], "doc_id long, toxic int, x int")
    model = toxicity.train(docs, known.where("doc_id IS NULL OR toxic IS NOT NULL"))
    got = by_id(toxicity.score_toxicity(docs, model).select("doc_id", "toxicity"))
    wrong = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0 and (got[i][0] >= 0.5) != (i % 3 == 0)]
    assert len(wrong) <= 2
    assert got[900] == got[901] and got[900][0] < 0.5
    assert got[902][0] >= 0.5  # unseen forms
    marked = docs.select("doc_id", toxicity.held_out(docs["doc_id"]).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in marked if r.doc_id is not None)


def test_toxic_passages_count_alike_in_any_place():
    model = toxicity.Model(dict.fromkeys(toxicity.ngrams("grumwort"), 1.0), -0.5)
    score = model.scorer()
    text = lambda k: " ".join(["so"] * k + ["grumwort"] * 18 + ["so"] * (90 - k))
    assert len({round(score(text(k)), 9) for k in range(20, 60)}) == 1


def test_toxicity_reads_a_repeated_id_once(spark):
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(ids[0], f"fine words {k}") for k in range(50)]
    rows += [(i, "vexling snarkel" if i in ids[20:] else "fine words") for i in ids[1:]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = [(i, int(i in ids[20:])) for i in ids]
    known = spark.createDataFrame(known, "doc_id long, toxic int")
    score = toxicity.train(df, known, rows_per_class=12).scorer()
    assert score("vexling snarkel") >= 0.5 > score("fine words")


def test_empty_tables(spark, empty):
    path = tokenizer_path("word_bpe_49k.json")
    model = pieces.PieceModel.load(tokenizer_path("piece_bpe_32k.model"))
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    untrained = toxicity.train(empty, labels)
    for df in (
        exact_dedup.dedup_exact(empty, exact_dedup.new_index(spark, empty)),
        jaccard.similar_components(empty),
        suffixes.remove_repeats(empty),
        passages.shared_passages(empty),
        packing.pack_documents(empty, path),
        pieces.round_trip(empty, model),
        pii.pseudonymise(empty, "k"),
        licenses.scan_licenses(empty),
        toxicity.score_toxicity(empty, untrained),
    ):
        assert df.count() == 0


def test_pipeline(spark, docs, monkeypatch):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "jaccard_join", "pii", "packing",
    ]
    labels = spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int")
    tables = {"documents": docs, "labels": labels}
    monkeypatch.setattr(corpus_pipeline, "read", lambda s, d, name: tables[name])
    packed = corpus_pipeline.run(spark, "unused").collect()
    named = by_id(jaccard.similar_components(docs))
    flat = {}
    for i, t, *_ in sorted((r for r in corpus() if r[0] is not None), key=lambda r: r[0]):
        flat.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    # One of each component stays; texts without words differ only if not equal.
    want = {i for i in flat.values() if named[i][1] == i}
    assert {r.doc_id for r in packed if r.doc_id is not None} == want


def test_pipeline_stages_pass_columns_of_any_name(spark, tmp_path, monkeypatch):
    """From stored files, whose rows are numbered by place, and from other tables."""
    extra = ["row", "row_file", "row_place", "score", "pii", "hit", "__row", "__toxicity", "a.b"]
    schema = SCHEMA + "".join(f", `{c}` string" for c in extra)
    rng = random.Random(8)
    texts = [prose(rng, 50) for _ in range(20)]
    texts += [texts[0], texts[1] + " more", "mail some.one@example.org now", "", None]
    rows = [(i % 18, t, "en", "s", 0, *(f"{c}{i}" for c in extra)) for i, t in enumerate(texts)]
    made = spark.createDataFrame(rows, schema).repartition(3)
    made.write.parquet(str(tmp_path / "docs"))
    labels = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(corpus_pipeline, "read", lambda s, d, name: labels)
    kept = []
    for docs in (made, spark.read.parquet(str(tmp_path / "docs"))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == made.columns, name
            out.write.parquet(str(tmp_path / f"{len(kept)}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{len(kept)}{name}"))
        packed = dict(corpus_pipeline.STAGES)["packing"](spark, docs, "")
        assert packed.count() == docs.count()
        kept.append(sorted(docs.select("row", "__row", "`a.b`", "text", "n_chars").collect()))
    assert kept[0] == kept[1] and len(kept[0]) == 22
    assert all(r[0][3:] == r[1][5:] == r[2][3:] for r in kept[0])
    changed = [r for r in kept[0] if r.text and "@example.org" in r.text]
    assert len(changed) == 1 and "some.one" not in changed[0].text
    assert changed[0].n_chars == len(changed[0].text)


def test_pipeline_drops_rows_not_ids(spark):
    rng = random.Random(11)
    one, two, three, four, five = (prose(rng, 60) for _ in range(5))
    near = one.split()
    near[30] = "changed"
    rows = [
        (1, one), (1, one), (2, one), (2, two), (None, one), (None, three), (None, three),
        (3, four), (4, " ".join(near)), (4, five), (None, " ".join(near[:-1])), (None, ""), (5, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    order = lambda row: (row[0] is None, row)

    def left(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=order)

    copies = corpus_pipeline.drop_copies(spark, docs, "")
    want = [(1, one), (2, two), (None, three), (3, four), (4, " ".join(near)), (4, five)]
    want += [(None, " ".join(near[:-1])), (5, None)]
    assert copies.columns == docs.columns
    assert left(copies) == sorted(want, key=order)
    similar = corpus_pipeline.drop_similar(spark, copies, "")
    want = [(1, one), (2, two), (None, three), (3, four), (4, five), (5, None)]
    assert similar.columns == docs.columns
    assert left(similar) == sorted(want, key=order)
    # The same rows under ids of their own.
    own = copies.where("doc_id <> 4 OR text = '" + five + "'").where("doc_id IS NOT NULL")
    own = own.union(spark.createDataFrame([(7, " ".join(near), "en", "s", 0)], SCHEMA))
    similar = corpus_pipeline.drop_similar(spark, own, "")
    assert left(similar) == [(1, one), (2, two), (3, four), (4, five), (5, None)]


@pytest.mark.parametrize("repeated", [False, True])
def test_near_copies_are_dropped_without_moving_texts(spark, tmp_path, repeated):
    """Many rows stay and few go: only those that go are joined."""
    rng = random.Random(12)
    ids = rng.sample(range(1 << 60), 1500)
    rows = [(i, prose(rng, 12), "en", "s", 0) for i in ids]
    rows.append(((ids[0] if repeated else 1 << 60), rows[1][1], "en", "s", 0))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        similar = corpus_pipeline.drop_similar(spark, docs, "")
        plan = similar._jdf.queryExecution().executedPlan().toString()
        left = sorted((r.doc_id, r.text) for r in similar.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    gone = max(rows[1], rows[-1])
    assert left == sorted((r[0], r[1]) for r in rows if r != gone)
    # Nothing but what is broadcast is exchanged.
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan.split("LeftAnti")[0]


def test_hashing_words_takes_little_room():
    rng = random.Random(11)
    texts = [prose(rng, 200).encode() for _ in range(600)]
    size = sum(map(len, texts))
    tracemalloc.start()
    Words(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * size


def test_sets_are_made_of_bounded_slices(spark, monkeypatch):
    given = []
    limits = jaccard.map_batches

    def noted(df, work, schema, limit=SLICE_BYTES):
        given.append(limit)
        return limits(df, work, schema, limit)

    monkeypatch.setattr(jaccard, "map_batches", noted)
    long = prose(random.Random(12), 300_000)  # a text of several slices stays whole
    rows = [(1, long, "", "", 0), (2, long, "", "", 0), (3, "ka lo", "", "", 0), (4, None, "", "", 0)]
    sets = jaccard.shingle_sets(spark.createDataFrame(rows, SCHEMA)).collect()
    one, two, three, four = sorted(sets, key=lambda r: r.id)
    words = long.split()
    assert one.n_shingles == len({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    assert (one.set, one.digest) == (two.set, two.digest)
    assert (three.n_shingles, four.n_shingles) == (1, 0)
    assert max(given) <= 512 << 10


def test_batches_leave_nothing_with_the_pool(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(_arrow.pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_pydict({"x": v}) for v in ([1, 2], [], [3])]
    run = _arrow.map_batches(Frame(), lambda: lambda batch: batch, "x bigint", 8)
    assert [b.to_pydict()["x"] for b in run(iter(batches))] == [[1], [2], [3]]
    assert len(released) == 3
