"""Main text of web pages, by a recurrent labeller of their blocks.

A page is the sequence of its leaf blocks. Each block is read as the mean vector of
its tag path (hashed names of the elements it lies in, and the shape of the block)
beside the mean vector of its hashed words. A bidirectional LSTM in numpy runs over
the whole page, so each block is labelled in the light of all others. Everything,
vectors included, is trained jointly here.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._arrow import map_batches
from tidemart.llm._html import Block, blocks
from tidemart.llm._layouts import Layout
from tidemart.llm._shingles import Words

SEED = 20_240_501
# Hash buckets and vector sizes of path tokens and words, and cells of each direction.
PATHS, PATH_DIM = 1024, 20
WORDS, WORD_DIM = 4096, 8
CELLS = 20
# A word says little about its block, and most words of a page were never trained.
FEW = {"path": 0, "word": 3}
WORD_RATE = 0.2
# The model is fitted on at most so many pages of at most so many bytes, and on so many
# invented ones that reuse their texts.
FIT_PAGES, FIT_BYTES, FIT_LAYOUTS = 300, 100_000, 1800
EPOCHS, BATCH, RATE = 8, 24, 0.01
# Cells times steps of a padded group of pages that is labelled at once.
GROUP = 1 << 15
MAIN_FROM = 0.5

# Elements and names that tell main text from the rest where a site uses them.
_MAIN = {"article", "main"}
_REST = {"nav", "header", "footer", "aside", "form"}


def _path_tokens(block: Block) -> list[int]:
    """Hashes of a block's path and shape; one at least."""
    tokens = []
    for k, e in enumerate(reversed(block.path)):
        if e.name in ("html", "body"):
            continue
        tokens.append(e.name)
        tokens += [f".{w}" for w in e.words]
        if k < 2:  # the element itself and the one around it
            tokens.append(f"{k}^{e.name}")
            tokens += [f"{k}^.{w}" for w in e.words]
    words = block.text.count(" ") + 1
    linked = min(4, 4 * block.linked // max(1, len(block.text)))
    end = block.text[-1]
    tokens += [f"#{words.bit_length()}", f"@{linked}", "#." if end in ".!?…:;\"'»”" else "#-"]
    return [zlib.crc32(t.encode()) % PATHS for t in tokens]


def _features(pages: Sequence[list[Block]]) -> dict[str, np.ndarray]:
    """All blocks of the pages: path and word hashes, and where each block's begin."""
    paths = [_path_tokens(b) for page in pages for b in page]
    words = Words([b.text.lower().encode() for page in pages for b in page])
    sizes = np.fromiter(map(len, paths), np.int64, len(paths))
    # A word counts once in a block, so that a repeated one weighs no more than another.
    block = np.repeat(np.arange(len(paths)), np.diff(words.first))
    distinct = np.unique(block * WORDS + (words.hash % np.uint64(WORDS)).astype(np.int64))
    per_block = np.bincount(distinct // WORDS, minlength=len(paths))
    return {
        "path": np.fromiter((t for p in paths for t in p), np.int64, int(sizes.sum())),
        "path_first": np.cumsum(sizes) - sizes,
        "path_size": sizes,
        "word": distinct % WORDS,
        "word_first": np.cumsum(per_block) - per_block,
        "word_size": per_block,
        "page": np.fromiter(map(len, pages), np.int64, len(pages)),
    }


def _means(model: dict, f: dict, kind: str) -> np.ndarray:
    """Mean vector of each block's tokens, drawn to zero where they are few."""
    out = np.zeros((len(f[f"{kind}_size"]), model[kind].shape[1]), np.float32)
    some = np.flatnonzero(f[f"{kind}_size"])
    if len(some):
        sums = np.add.reduceat(model[kind][f[kind]], f[f"{kind}_first"][some], axis=0)
        out[some] = sums / (f[f"{kind}_size"][some, None] + FEW[kind])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages) number of each step's block going forwards, and going backwards; -1: none."""
    first = np.cumsum(sizes) - sizes
    step = np.arange(sizes.max(initial=0))[:, None]
    there = step < sizes
    return np.where(there, first + step, -1), np.where(there, first + sizes - 1 - step, -1)


def _run(model: dict, way: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """States of one direction over (steps, pages, inputs), and what its training needs."""
    n = x.shape[1]
    h, c = np.zeros((n, CELLS), np.float32), np.zeros((n, CELLS), np.float32)
    given = x @ model[f"{way}_in"] + model[f"{way}_bias"]
    states, kept = np.empty((len(x), n, CELLS), np.float32), []
    for t in range(len(x)):
        z = given[t] + h @ model[f"{way}_state"]
        gates = _sigmoid(z[:, : 3 * CELLS])
        i, f, o = gates[:, :CELLS], gates[:, CELLS : 2 * CELLS], gates[:, 2 * CELLS :]
        g = np.tanh(z[:, 3 * CELLS :])
        before, c = c, f * c + i * g
        shown = np.tanh(c)
        kept.append((h, before, gates, g, shown))
        h = o * shown
        states[t] = h
    return states, kept


def _learn(model: dict, way: str, x: np.ndarray, kept: list, given: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of one direction's weights and of its inputs, from those of its states."""
    steps = np.empty((*x.shape[:2], 4 * CELLS), np.float32)
    dh = np.zeros((x.shape[1], CELLS), np.float32)
    dc = np.zeros_like(dh)
    state = np.zeros_like(model[f"{way}_state"])
    for t in range(len(x) - 1, -1, -1):
        h, before, gates, g, shown = kept[t]
        i, f, o = gates[:, :CELLS], gates[:, CELLS : 2 * CELLS], gates[:, 2 * CELLS :]
        dh = dh + given[t]
        dc = dc + dh * o * (1 - shown**2)
        dz = steps[t]
        dz[:, :CELLS] = dc * g * i * (1 - i)
        dz[:, CELLS : 2 * CELLS] = dc * before * f * (1 - f)
        dz[:, 2 * CELLS : 3 * CELLS] = dh * shown * o * (1 - o)
        dz[:, 3 * CELLS :] = dc * i * (1 - g**2)
        state += h.T @ dz
        dh = dz @ model[f"{way}_state"].T
        dc = dc * f
    flat = steps.reshape(-1, 4 * CELLS)
    grads = {
        f"{way}_in": x.reshape(-1, x.shape[2]).T @ flat,
        f"{way}_bias": flat.sum(axis=0),
        f"{way}_state": state,
    }
    return grads, steps @ model[f"{way}_in"].T


def _forward(model: dict, f: dict) -> tuple[np.ndarray, dict]:
    """Score (log odds of main text) of each block, and the way there."""
    x = np.concatenate([_means(model, f, "path"), _means(model, f, "word")], axis=1)
    padded = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])  # place -1
    states = np.zeros((len(x) + 1, 2 * CELLS), np.float32)
    ways = {}
    for k, (way, places) in enumerate(zip(("on", "back"), _places(f["page"]), strict=True)):
        inputs = padded[places]
        out, kept = _run(model, way, inputs)
        states[places, k * CELLS : (k + 1) * CELLS] = out
        ways[way] = (places, inputs, kept)
    seen = np.concatenate([states[:-1], x], axis=1)
    return seen @ model["out"] + model["out_bias"][0], {"ways": ways, "seen": seen}


def _gradients(model: dict, f: dict, label: np.ndarray) -> dict:
    score, done = _forward(model, f)
    seen = done["seen"]
    error = ((_sigmoid(score) - label) / len(label)).astype(np.float32)
    grads = {"out": seen.T @ error, "out_bias": error.sum(keepdims=True)}
    back = error[:, None] * model["out"][None]
    dx = np.concatenate([back[:, 2 * CELLS :], np.zeros((1, PATH_DIM + WORD_DIM), np.float32)])
    for k, (way, (places, inputs, kept)) in enumerate(done["ways"].items()):
        given = np.concatenate([back[:, k * CELLS : (k + 1) * CELLS], np.zeros((1, CELLS), np.float32)])
        more, d = _learn(model, way, inputs, kept, given[places])
        grads |= more
        there = places >= 0
        dx[places[there]] += d[there]
    for kind, part in (("path", dx[:-1, :PATH_DIM]), ("word", dx[:-1, PATH_DIM:])):
        size = f[f"{kind}_size"]
        grads[kind] = np.zeros_like(model[kind])
        np.add.at(grads[kind], f[kind], np.repeat(part / (size[:, None] + FEW[kind]), size, axis=0))
    return grads


def _fresh() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    wide = PATH_DIM + WORD_DIM

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    model = {
        "path": normal(PATHS, PATH_DIM, scale=0.3),
        "word": normal(WORDS, WORD_DIM, scale=0.02),
        "out": normal(2 * CELLS + wide, scale=0.1),
        "out_bias": np.zeros(1, np.float32),
    }
    for way in ("on", "back"):
        model[f"{way}_in"] = normal(wide, 4 * CELLS, scale=wide**-0.5)
        model[f"{way}_state"] = normal(CELLS, 4 * CELLS, scale=CELLS**-0.5)
        model[f"{way}_bias"] = np.repeat(np.float32([0, 1, 0, 0]), CELLS)  # remembers at first
    return model


def fit(pages: Sequence[tuple[list[Block], Sequence[bool]]]) -> dict[str, np.ndarray]:
    """A model of pages with labelled blocks, by Adam over batches of pages of like length."""
    pages = [p for p in pages if p[0]]
    model, rng = _fresh(), random.Random(SEED)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    by_length = sorted(pages, key=lambda p: len(p[0]))
    batches = []
    for at in range(0, len(by_length), BATCH):
        some = by_length[at : at + BATCH]
        label = np.array([x for _, labels in some for x in labels], np.float32)
        batches.append((_features([p for p, _ in some]), label))
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(batches)
        for f, label in batches:
            step += 1
            grads = _gradients(model, f, label)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            rate = RATE * (1 - step / (EPOCHS * len(batches) + 1))
            for name, g in grads.items():
                g = g * min(1, 1 / max(norm, 1e-9))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                mean, spread = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                pace = rate * (WORD_RATE if name == "word" else 1)
                model[name] -= (pace * mean / (np.sqrt(spread) + 1e-8)).astype(np.float32)
    return model


def _marked(page: list[Block]) -> list[bool] | None:
    """Labels by the page's own elements; None if it has no element for its main text."""
    labels = []
    for b in page:
        names = [e.name for e in b.path]
        inner = max((k for k, n in enumerate(names) if n in _MAIN), default=-1)
        rest = [n for n in names[inner + 1 :] if n in _REST]
        labels.append(inner >= 0 and not (rest and names[-1] != "h1"))
    return labels if any(labels) else None


def training_pages(html: Sequence[str]) -> list[tuple[list[Block], list[bool]]]:
    """Labelled pages: those that mark their main text themselves, and invented ones.

    Invented pages lay out the same texts in other ways, under other names or none, so
    that the model learns more than the sites it has seen.
    """
    known, main, rest = [], [], []
    for h in html:
        page = blocks(h)
        labels = _marked(page)
        if labels is None:
            continue
        known.append((page, labels))
        for b, is_main in zip(page, labels, strict=True):
            (main if is_main else rest).append(b.text)
    # Without any known text, invented words do: only layout can be learned then.
    rng = random.Random(SEED)
    if not main:
        syllables = "ka lo mi nu per ran sol ti ven dor".split()
        main = [
            " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(60)) + "."
            for _ in range(200)
        ]
    layouts = [Layout(rng, main, rest) for _ in range(FIT_LAYOUTS)]
    return known + [(page, x.main) for x in layouts if len(page := blocks(x.page)) == len(x.main)]


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> dict[str, np.ndarray]:
    """A model fitted on a bounded sample of ``pages`` and on invented pages.

    The sample: ``FIT_PAGES`` different pages of at most ``FIT_BYTES`` bytes, least by a
    hash of id and text. Labels come from the pages' own elements for main text and menus;
    pages without such aren't learned from. Without any, only invented pages are.
    """
    html = F.col(f"`{html_col}`")
    fits = pages.where(F.octet_length(html) <= FIT_BYTES)
    fits = fits.select(html.alias("html"), F.xxhash64(F.col(f"`{id_col}`"), html).alias("hash"))
    # Hashes first: every task hands its least ones to the driver, which must not be pages.
    least = fits.select("hash").distinct().orderBy("hash").limit(FIT_PAGES)
    edge = least.agg(F.max("hash")).first()[0]
    chosen = fits.where(F.col("hash") <= F.lit(edge)).dropDuplicates(["hash"])
    least = sorted(chosen.collect(), key=lambda r: r["hash"])
    return fit(training_pages([r["html"] for r in least]))


def labelled(pages: Sequence[list[Block]], model: dict[str, np.ndarray]) -> list[np.ndarray]:
    """For each page, whether each of its blocks is main text."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    group: list[int] = []

    def close() -> None:
        if not group:
            return
        score, _ = _forward(model, _features([pages[k] for k in group]))
        ends = np.cumsum([len(pages[k]) for k in group])[:-1]
        for k, part in zip(group, np.split(_sigmoid(score) >= MAIN_FROM, ends), strict=True):
            out[k] = part
        group.clear()

    for k in sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k])):
        if group and len(pages[k]) * (len(group) + 1) > GROUP:
            close()
        group.append(k)
    close()
    return out


def main_text(pages: Sequence[str], model: dict[str, np.ndarray]) -> list[str]:
    """Main text of each page: its blocks in order, one on a line."""
    parsed = [blocks(p) for p in pages]
    return [
        "\n".join(b.text for b, is_main in zip(page, labels, strict=True) if is_main)
        for page, labels in zip(parsed, labelled(parsed, model), strict=True)
    ]


def extract_main_text(
    pages: DataFrame, model: dict[str, np.ndarray], html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """``pages`` with the main text of ``html_col`` in place of it, in ``text_col``.

    Whole pages are read, however long. A page that is null, empty or has no main text
    gets an empty text. Other columns stay as they are, whatever their names; only one
    named ``text_col`` is replaced. Repeated rows are read each for itself; an empty
    table gives no rows. A page is one sequence: it is parsed and labelled by one task.
    """
    others = [c for c in pages.columns if c not in (html_col, text_col)]
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    # By number, as a name with a dot can't be handed to a Python function.
    chosen = pages.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)), html.alias("html"))

    def work() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.num_columns - 1
            text = main_text(batch.column(at).to_pylist(), model)
            columns = [*batch.columns[:at], pa.array(text, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        return step

    return map_batches(chosen, work, chosen.schema).toDF(*others, text_col)
