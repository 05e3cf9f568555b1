"""Unigram encoding over a double-array trie of scored pieces, and decoding."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN_UNITS = 400_000
# Units up to this many bytes are encoded side by side, longer ones alone.
SIDE_BY_SIDE = 48


class DoubleArray:
    """A trie of byte strings: child of s by byte b is base[s] + b, if check says so."""

    def __init__(self, words: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for word, number in words.items():
            node = 0
            for byte in word:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][byte]
            value[node] = number
        size = 8 * len(children) + 65_536
        used = np.zeros(size, bool)
        used[0] = True
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        place, free, near = {0: 0}, 257, 257
        # Widest nodes first, each near the one before; single children fill the gaps.
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            keys = np.array(sorted(children[node]), np.int64)
            if len(keys) == 1:
                while used[free]:
                    free += 1
                at = free - int(keys[0])
            elif len(keys):
                while True:
                    tries = np.arange(near, near + 256)
                    fits = tries[~used[tries[:, None] + keys].any(axis=1)]
                    if len(fits):
                        break
                    near += 256
                at = int(fits[0])
                near = max(near, at - 256)
            else:
                break
            used[at + keys] = True
            for key in keys.tolist():
                place[children[node][key]] = at + key
            self.base[node] = at  # by node for now
        by_node = self.base[: len(children)].copy()
        self.base[:] = 0
        for node, spot in place.items():
            self.base[spot] = by_node[node]
            self.value[spot] = value[node]
            for child in children[node].values():
                self.check[place[child]] = spot
        last = int(np.flatnonzero(used)[-1]) + 257
        self.base, self.check, self.value = (
            np.concatenate([x, np.full(512, y, np.int32)])[: last + 256]
            for x, y in ((self.base, 0), (self.check, -1), (self.value, -1))
        )


class PieceModel:
    """Pieces with log scores. ``load`` reads them from a SentencePiece model file."""

    def __init__(
        self, pieces: list[tuple[str, float]], bytes_from: int | None, unknown: int = 0
    ) -> None:
        """``pieces`` by id; those of no use (controls, bytes, unknown) have score None.

        ``bytes_from`` is the id of byte 0 where the model has bytes to fall back on.
        """
        self.unknown, self.bytes_from = unknown, bytes_from
        scored = {p.encode(): i for i, (p, s) in enumerate(pieces) if s is not None}
        self.trie = DoubleArray(scored)
        self.score = np.array([np.nan if s is None else s for _, s in pieces])
        self.unknown_score = float(np.nanmin(self.score)) - UNKNOWN_PENALTY
        self.longest = max(map(len, scored))
        self.surface = [p.encode() if s is not None else b"" for p, s in pieces]
        if bytes_from is not None:
            for b in range(256):
                self.surface[bytes_from + b] = bytes([b])
        # Where a text may be cut so that no piece crosses: before runs of the mark, if
        # no piece has the mark after other characters, and around line ends in no piece.
        texts = [p for p, s in pieces if s is not None]
        safe = not any(MARK in p.lstrip(MARK) for p in texts)
        lines = not any("\n" in p for p in texts)
        self.by_words = safe and lines
        self.units = re.compile(
            rf"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"
            if self.by_words
            else (rf"{MARK}+[^{MARK}]*|[^{MARK}]+" if safe else r"(?s:.+)")
        )

    @classmethod
    def load(cls, model_file: str) -> PieceModel:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
        pieces = [
            (model.id_to_piece(i), None if special[i] else model.get_score(i)) for i in ids
        ]
        first = model.piece_to_id("<0x00>")
        return cls(pieces, first if model.is_byte(first) else None, model.unk_id())

    def _fallback(self, char: bytes) -> list[int]:
        if self.bytes_from is None:
            return [self.unknown]
        return [self.bytes_from + b for b in char]

    def encode_unit(self, unit: bytes) -> bytes:
        """Best path through one unit, as int32 bytes; for units of any length."""
        base, check, value = self._lists()
        n = len(unit)
        best, back, how = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        start = 0
        while start < n:
            first = unit[start]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            node, at, single = 0, start, False
            while at < n:
                to = base[node] + unit[at]
                if check[to] != node:
                    break
                node, at = to, at + 1
                if value[node] >= 0:
                    score = best[start] + self.score[value[node]]
                    single |= at - start == width
                    if score > best[at]:
                        best[at], back[at], how[at] = score, start, value[node]
            if not single:
                at, score = start + width, best[start] + self.unknown_score
                if score > best[at]:
                    best[at], back[at], how[at] = score, start, -1
            start += width
        out, at = [], n
        while at > 0:
            start = back[at]
            out.append([how[at]] if how[at] >= 0 else self._fallback(unit[start:at]))
            at = start
        return np.array([i for ids in reversed(out) for i in ids], "<i4").tobytes()

    def _lists(self) -> tuple[list[int], list[int], list[int]]:
        if not hasattr(self, "_as_lists"):
            trie = self.trie
            self._as_lists = trie.base.tolist(), trie.check.tolist(), trie.value.tolist()
        return self._as_lists

    def encode_units(self, units: list[bytes]) -> list[bytes]:
        """The same for many short units at once: each step is one over all of them.

        First every piece at every place (a walk down the trie from all places), then
        best scores from left to right, then the way back.
        """
        n = len(units)
        length = np.fromiter(map(len, units), np.int64, n)
        begin = np.cumsum(length + 1) - length - 1
        # A zero byte, in no piece, ends each unit.
        text = np.frombuffer(b"\0".join(units) + b"\0", np.uint8).astype(np.int32)
        unit = np.repeat(np.arange(n), length + 1)
        inside = np.ones(len(text), bool)
        inside[begin + length] = False
        places = np.flatnonzero(inside & ((text & 0xC0) != 0x80))
        wide = 1 + (text >= 0xC0).astype(np.int8) + (text >= 0xE0) + (text >= 0xF0)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        edges, single = [], np.zeros(len(text), bool)
        who, at, node = places, places, np.zeros(len(places), np.int32)
        while len(who):
            to = base[node] + text[at]
            ok = (check[to] == node) & inside[at]
            who, at, node = who[ok], at[ok] + 1, to[ok]
            piece = value[node]
            hit = piece >= 0
            edges.append((who[hit], at[hit], piece[hit]))
            single[who[hit & (at - who == wide[who])]] = True
        lone = places[~single[places]]
        edges.append((lone, lone + wide[lone], np.full(len(lone), -1, np.int32)))
        start, end, piece = (np.concatenate(x) for x in zip(*edges, strict=True))
        score = np.where(piece >= 0, self.score[piece], self.unknown_score)
        step = start - begin[unit[start]]
        # Within a step no two edges of a unit end at one place.
        order = np.argsort(step, kind="stable")
        cuts = np.searchsorted(step[order], np.arange(int(length.max()) + 1))
        best = np.full(len(text) + 1, -np.inf)
        best[begin] = 0
        back, how = np.zeros(len(text) + 1, np.int64), np.full(len(text) + 1, -1, np.int32)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some = order[a:b]
            new = best[start[some]] + score[some]
            up = new > best[end[some]]
            some = some[up]
            best[end[some]], back[end[some]], how[end[some]] = new[up], start[some], piece[some]
        ways, at = [], begin + length
        who = np.arange(n)
        while len(who):
            ways.append((who, back[at], at, how[at]))
            at = back[at]
            on = at > begin[who]
            who, at = who[on], at[on]
        who, start, end, piece = (np.concatenate(x[::-1]) for x in zip(*ways, strict=True))
        order = np.argsort(who, kind="stable")
        who, start, end, piece = who[order], start[order], end[order], piece[order]
        if self.bytes_from is None:
            ids, owner = np.where(piece >= 0, piece, self.unknown), who
        else:
            many = np.where(piece >= 0, 1, end - start)
            entry = np.repeat(np.arange(len(who)), many)
            offset = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
            fallback = self.bytes_from + text[start[entry] + offset]
            ids, owner = np.where(piece[entry] >= 0, piece[entry], fallback), who[entry]
        flat = ids.astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=n))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encoder(self):
        """A function from texts to their ids (int32 bytes) that remembers units."""
        known: dict[str, bytes] = {}

        def cut(text: str | None) -> list[str]:
            if not text:
                return []
            if self.by_words and MARK not in text:
                # A word stands for itself with the mark in front; one that begins with a
                # line end has none. Runs of spaces leave empty words.
                words = text.replace("\n", " \n").split(" ")
                if "" not in words:
                    return words
            return [f"{MARK}{u}" for u in self.units.findall(MARK + text.replace(" ", MARK))]

        def raw(word: str) -> bytes:
            if word[0] == MARK:
                return word[1:].encode()
            return (word if word[0] == "\n" else MARK + word).encode()

        def encode(texts: Iterable[str | None]) -> list[bytes]:
            rows = [cut(t) for t in texts]
            if len(known) > KNOWN_UNITS:
                known.clear()
            new = sorted(set(chain.from_iterable(rows)) - known.keys(), key=len)
            units = [raw(w) for w in new]
            short = [i for i, u in enumerate(units) if len(u) <= SIDE_BY_SIDE]
            for at in range(0, len(short), 16_384):
                some = short[at : at + 16_384]
                for i, ids in zip(some, self.encode_units([units[i] for i in some]), strict=True):
                    known[new[i]] = ids
            for i, u in enumerate(units):
                if len(u) > SIDE_BY_SIDE:
                    known[new[i]] = self.encode_unit(u)
            return [b"".join(map(known.__getitem__, row)) for row in rows]

        return encode

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: bytes joined, marks as spaces, the one set in front taken off."""
        said = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return said.replace(MARK, " ").removeprefix(" ")


def encode(
    docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) for each row of ``docs``.

    Null and empty texts have no ids. Repeated rows and null ids are rows like any
    other; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work():
        run = model.encoder()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = run(batch.column(1).to_pylist())
            ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], ["id", "ids"]
            )

        return step

    rows = docs.select(F.col(id_col), F.col(text_col))
    return map_batches(rows, work, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(
    encoded: DataFrame, model: PieceModel, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """(id, text) for each row of ``encoded``; null ids give an empty text."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [model.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["id", "text"]
            )

        return step

    rows = encoded.select(F.col(id_col), F.col(ids_col))
    return map_batches(rows, work, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(
    docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes and decodes each text: (id, n_ids, n_byte_ids, ids_crc32, same).

    ``n_byte_ids`` counts ids of single bytes; ``same`` says whether the decoded text
    is the text (with marks read as spaces). Null texts count as empty.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work():
        run = model.encoder()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            low = model.bytes_from if model.bytes_from is not None else -256
            out = []
            for text, raw in zip(texts, run(texts), strict=True):
                ids = np.frombuffer(raw, "<i4")
                n_bytes = int(((ids >= low) & (ids < low + 256)).sum())
                same = model.decode(ids.tolist()) == text.replace(MARK, " ")
                out.append((len(ids), n_bytes, zlib.crc32(raw), same))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), TYPES, strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["id", "n_ids", "n_byte_ids", "ids_crc32", "same"]
            )

        return step

    schema = f"id {kind}, n_ids bigint, n_byte_ids bigint, ids_crc32 bigint, same boolean"
    rows = docs.select(F.col(id_col), F.col(text_col))
    return map_batches(rows, work, schema).withColumnRenamed("id", id_col)


TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
