"""Token counts and packing of documents into sequences by bin completion."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches
from tidemart.llm._common import free_name, staged

SEQUENCE = 4096
END = 1
# Pieces packed together by one task; the rows of a task are these at most, nearly.
SHARD_PIECES = 100_000
# Looks at the sizes left (a few microseconds each) that the search may take in a shard,
# and then in each batch of wasteful bins.
SEARCH_STEPS = 400_000
BATCHES, BATCH_BINS, BATCH_STEPS = 40, 60, 20_000
# Words whose ids a task remembers: a cache of some 50 MB, for speed alone.
KNOWN_WORDS = 200_000

# Split on these only where str.split() would split more than the tokenizer does.
_WORD = re.compile(r"[^ \t\n\r\f\v]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# Characters whose lower case and composition do not depend on what stands beside.
_PLAIN = re.compile(r"[\x00-\u012f\u0131-\u024f]+")
# The end of a word, as a byte that UTF-8 never has.
_WORD_END = b"\xff"


class WordIds(dict):
    """Words to their ids, as little-endian unsigned 32-bit bytes.

    For BPE tokenizers with word ends that drop white space and never join what it
    parts, so that a text's ids are those of its words in a row. Words in plain Latin
    letters take a shorter way to the same merges; others go through the tokenizer.
    """

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as file:
            said = json.load(file)
        parts = said["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.parts = regex.compile(parts).findall
        self.specials = [t["content"] for t in said["added_tokens"]]
        vocabulary, merges = said["model"]["vocab"], said["model"]["merges"]
        suffix = said["model"]["end_of_word_suffix"]
        # Byte-level BPE writes printable Latin-1 as itself, other bytes from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        byte_of = {c: b for b, c in letters.items()}
        # Rank: single bytes, bytes at a word's end, then merges in order.
        ranks: dict[bytes, int] = {}
        ids: list[int] = []
        for end, ending in (("", b""), (suffix, _WORD_END)):
            for b in range(256):
                ranks[bytes([b]) + ending] = len(ids)
                ids.append(vocabulary[letters[b] + end])
        for merge in merges:
            token = "".join(merge if isinstance(merge, list) else merge.split(" "))
            raw = bytes(byte_of[c] for c in token.removesuffix(suffix))
            ranks[raw + (_WORD_END if token.endswith(suffix) else b"")] = len(ids)
            ids.append(vocabulary[token])
        self.id_bytes = [i.to_bytes(4, "little") for i in ids]
        bpe = tiktoken.Encoding(
            "words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
        )
        self.merge = bpe._core_bpe.encode_single_piece

    def _part(self, part: str) -> bytes:
        known = self.get(part)
        if known is None:
            table = self.id_bytes
            known = b"".join([table[i] for i in self.merge(part.encode() + _WORD_END)])
            if part.isalpha():
                self[part] = known
        return known

    def __missing__(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            ids = self._by_tokenizer(word)
        else:
            lower = word.lower()
            if lower.isalpha():
                ids = self._part(lower)
            else:
                ids = b"".join(map(self._part, self.parts(lower)))
        self[word] = ids
        return ids

    def _by_tokenizer(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text."""
        if len(self) > KNOWN_WORDS:
            self.clear()
        out = []
        for text in texts:
            if not text:
                words = []
            elif any(s in text for s in self.specials):
                out.append(self._by_tokenizer(text))
                continue
            elif any(c in text for c in _SEPARATORS):
                words = _WORD.findall(text)
            else:
                words = text.split()
            out.append(b"".join(map(self.__getitem__, words)))
        return out


def cut_into_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    length: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each piece: (id, piece, start, length, ids_crc32).

    A document is its text's ids and a closing id 1; only one longer than ``length``
    is cut. Null texts count as empty and are one token long.
    """
    end = np.array([END], "<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"

    def work():
        words = WordIds(tokenizer_file)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            whose, out = [], []
            for i, ids in enumerate(words.of(batch.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    cut = ids[at : at + 4 * length]
                    whose.append(i)
                    out.append((k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            piece, start, size, crc = np.array(out, np.int64).reshape(-1, 4).T
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(whose, pa.int64())),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(size),
                    pa.array(crc),
                ],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

        return step

    return map_batches(docs.select(F.col(id_col), F.col(text_col)), work, schema)


def best_fit(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of sizes."""
    bins: list[list[int]] = []
    by_rest: dict[int, list[int]] = {}
    rests = 0  # bit r: some bin has r left
    for size in np.sort(sizes)[::-1].tolist():
        fits = rests >> size
        if fits:
            rest = size + (fits & -fits).bit_length() - 1
            at = by_rest[rest].pop()
            if not by_rest[rest]:
                rests &= ~(1 << rest)
            bins[at].append(size)
        else:
            rest, at = room, len(bins)
            bins.append([size])
        by_rest.setdefault(rest - size, []).append(at)
        rests |= 1 << (rest - size)
    return bins


def fewest(sizes: np.ndarray, room: int) -> int:
    """A lower bound on the bins: Martello and Toth's, over each threshold of small sizes."""
    count = np.bincount(sizes, minlength=room + 1)
    total = count * np.arange(room + 1)
    number, volume = np.cumsum(count), np.cumsum(total)
    half = room // 2
    least = -(-int(volume[-1]) // room)
    for small in range(half + 1):
        # Over room - small alone; over half with nothing but small beside.
        alone = number[room] - number[room - small]
        large = number[room - small] - number[half]
        free = large * room - (volume[room - small] - volume[half])
        below = volume[half] - (volume[small - 1] if small else 0)
        least = max(least, int(alone + large + max(0, -(-(below - free) // room))))
    return least


class _Sizes:
    """The sizes left, and how many of each; bit s of ``there`` tells whether any is."""

    def __init__(self, sizes: np.ndarray, room: int, steps: int) -> None:
        self.room, self.steps = room, steps
        self.count = np.bincount(sizes, minlength=room + 1).tolist()
        self.there = sum(1 << s for s, n in enumerate(self.count) if n)
        self.mirror = sum(1 << (room - s) for s, n in enumerate(self.count) if n)

    def take(self, chosen: tuple[int, ...]) -> None:
        for s in chosen:
            self.count[s] -= 1
            if not self.count[s]:
                self.there ^= 1 << s
                self.mirror ^= 1 << (self.room - s)

    def put(self, chosen: tuple[int, ...]) -> None:
        for s in chosen:
            if not self.count[s]:
                self.there ^= 1 << s
                self.mirror ^= 1 << (self.room - s)
            self.count[s] += 1

    def free(self, size: int, chosen: tuple[int, ...]) -> bool:
        return self.count[size] > chosen.count(size)

    def sums(self, total: int, n: int, top: int, chosen: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """``chosen`` and ``n`` more sizes, largest first, that add up to ``total``.

        Each look at what is there is one of ``steps``; without any left, none is found.
        """
        self.steps -= 1
        if self.steps < 0:
            return
        if n == 1:
            if total <= top and self.free(total, chosen):
                yield (*chosen, total)
            return
        if n == 2:
            # All a with both a and total - a there, the larger first.
            both = self.there & (self.mirror >> (self.room - total) if total <= self.room else 0)
            both >>= (total + 1) // 2
            while both:
                more = both.bit_length() - 1
                both ^= 1 << more
                larger = more + (total + 1) // 2
                one = (*chosen, larger)
                if larger <= top and self.free(larger, chosen) and self.free(total - larger, one):
                    yield (*one, total - larger)
            return
        # Neither over what leaves a size for each other one, nor below the mean.
        small = (self.there & -self.there).bit_length() - 1
        nexts = self.there & ((1 << (min(top, total - (n - 1) * small) + 1)) - 1)
        nexts >>= -(-total // n)
        while nexts and self.steps > 0:
            at = nexts.bit_length() - 1
            nexts ^= 1 << at
            size = at + -(-total // n)
            if self.free(size, chosen):
                yield from self.sums(total - size, n - 1, size, (*chosen, size))

    def dominated(self, chosen: tuple[int, ...], waste: int) -> bool:
        """Whether another filling with these left over instead serves no worse.

        A size that still fits, a larger one in place of one chosen, or one in place of
        two that it is the sum of.
        """
        for x in {0, *chosen} if waste else ():
            near = (self.there >> (x + 1)) & ((1 << waste) - 1)
            while near:
                at = near.bit_length() - 1
                near ^= 1 << at
                if self.free(x + 1 + at, chosen):
                    return True
        pairs = {a + b for i, a in enumerate(chosen) for b in chosen[i + 1 :]}
        return any(p <= self.room and self.free(p, chosen) for p in pairs)

    def fillings(self, rest: int, slack: int) -> Iterator[tuple[int, ...]]:
        """Undominated sets of sizes that fill ``rest`` but for ``slack``, fullest first."""
        for waste in range(min(slack, rest) + 1):
            total = rest - waste
            if total == 0:
                if not self.dominated((), waste):
                    yield ()
                return
            if not self.there or self.steps <= 0:
                continue
            small = (self.there & -self.there).bit_length() - 1
            for n in range(1, total // small + 1):
                for chosen in self.sums(total, n, total, ()):
                    if not self.dominated(chosen, waste):
                        yield chosen
                if self.steps <= 0:
                    return


def _fewer(sizes: np.ndarray, room: int, bins: int, steps: int) -> tuple[list[list[int]] | None, int]:
    """A packing into at most ``bins`` bins if one is found, and the steps left.

    Bin completion, depth first: the largest size left gets each undominated filling in
    turn, and a branch ends where its waste rules such a packing out. With steps left
    and none found there is none.
    """
    left = _Sizes(sizes, room, steps)
    allowed = bins * room - int(sizes.sum())
    path: list[tuple[tuple[int, ...], int]] = []
    choices: list[Iterator[tuple[int, ...]]] = []
    while left.there:
        top = left.there.bit_length() - 1
        left.take((top,))
        choices.append(left.fillings(room - top, allowed))
        chosen = None
        while True:
            # The sizes here are those that these fillings were listed from.
            chosen = next(choices[-1], None)
            if chosen is not None or left.steps <= 0:
                break
            choices.pop()
            left.put((top,))
            if not path:
                return None, left.steps
            (top, *rest), lost = path.pop()
            left.put(tuple(rest))
            allowed += lost
        if chosen is None:
            return None, 0
        lost = room - top - sum(chosen)
        left.take(chosen)
        path.append(((top, *chosen), lost))
        allowed -= lost
    return [list(f) for f, _ in path], left.steps


def complete_bins(
    sizes: np.ndarray, room: int, steps: int = SEARCH_STEPS
) -> tuple[list[list[int]], str]:
    """Packs ``sizes`` into bins of ``room``, and says what ended the search.

    Best fit gives the first packing; bin completion looks for one with fewer bins
    until the lower bound is met (``bound``), it has tried every branch (``proof``), or
    ``steps`` looks are spent (``limit``). In the last case full bins stay, and the
    wasteful ones are searched again in batches that are small enough to be tried whole.
    """
    best, least = best_fit(sizes, room), fewest(sizes, room)
    while len(best) > least and steps > 0:
        better, steps = _fewer(sizes, room, len(best) - 1, steps)
        if better is None and steps > 0:
            return best, "proof"
        best = better or best
    rng = np.random.default_rng(len(sizes))
    for _ in range(BATCHES):
        if len(best) <= least:
            break
        waste = np.array([room - sum(b) for b in best])
        wasteful = np.flatnonzero(waste)
        some = rng.permutation(wasteful)[:BATCH_BINS]
        # Few bins that waste little can't give one back.
        if waste[some].sum() < room:
            some = wasteful[np.argsort(-waste[wasteful], kind="stable")][:BATCH_BINS]
            if waste[some].sum() < room:
                break
        chosen = np.array([s for k in some for s in best[k]])
        least_here = max(fewest(chosen, room), len(some) - (len(best) - least))
        fewer, spare = None, BATCH_STEPS
        for target in range(least_here, len(some)):
            fewer, spare = _fewer(chosen, room, target, spare)
            if fewer is not None or spare <= 0:
                break
        if fewer is not None:
            gone = set(some.tolist())
            best = [b for k, b in enumerate(best) if k not in gone] + fewer
    return best, "bound" if len(best) <= least else "limit"


def pack(
    pieces: DataFrame, room: int = SEQUENCE, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``room``) and (sequence_id, offset, search).

    Full pieces are sequences of their own. The rest are dealt at random into shards
    of about ``shard_pieces``, each packed by one task; a shard leaves about one
    sequence partly filled. ``search`` says what ended a shard's search: ``bound`` or
    ``proof`` (no packing has fewer sequences), or ``limit``. Columns of the three names
    are replaced, others pass through whatever their names, an empty input gives no
    rows, and repeated rows are packed like any other.
    """
    given = pieces.drop("sequence_id", "offset", "search")
    number, shard = free_name(given, "row"), free_name(given, "shard")
    rows = staged(given.withColumn(number, F.monotonically_increasing_id()), "pieces")
    part = F.col("length") < room
    shards = max(1, -(-rows.where(part).count() // shard_pieces))
    schema = given.schema.add("sequence_id", "long").add("offset", "long").add("search", "string")

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["length"].to_numpy(np.int64)
        of = int(pdf[shard].iloc[0]) << 32
        order = np.argsort(sizes, kind="stable")
        next_at = np.searchsorted(sizes[order], np.arange(room + 1)).tolist()
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        bins, ended = complete_bins(sizes, room)
        for k, chosen in enumerate(bins):
            at = 0
            for size in chosen:
                row = order[next_at[size]]
                next_at[size] += 1
                sequence[row], offset[row] = (of | k) << 1, at
                at += size
        out = pdf.drop(columns=[shard, number])
        return out.assign(sequence_id=sequence, offset=offset, search=ended)

    packed = (
        rows.where(part)
        .withColumn(shard, F.pmod(F.xxhash64(number), F.lit(shards)))
        .groupBy(shard)
        .applyInPandas(work, schema)
    )
    full = rows.where(~part).withColumn("sequence_id", F.col(number) * 2 + 1)
    full = full.withColumn("offset", F.lit(0).cast("bigint")).withColumn("search", F.lit("bound"))
    return packed.unionByName(full.drop(number))


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    room: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All documents in sequences.

    (id, piece, start, length, ids_crc32, sequence_id, offset, search), see
    `cut_into_pieces` and `pack`; null texts count as empty, ids may be null or repeated.
    """
    pieces = cut_into_pieces(docs, tokenizer_file, room, id_col, text_col)
    return pack(pieces, room).withColumnRenamed("id", id_col)
