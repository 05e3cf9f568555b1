"""Toxicity from subword-bag embeddings and a linear softmax, trained in numpy.

A word is the mean of the vectors of its character n-grams, a window of words the
mean of its words, and a linear softmax tells toxic windows from others; a text
scores as its most toxic window. Vectors and softmax are trained jointly. N-grams that
are as common in either class have the zero vector; unseen spellings count by the
n-grams they share with words that were seen.
As all is linear up to the softmax, a trained model is one number for each n-gram.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemart.llm._arrow import map_batches

# Labelled rows of each class that the model is fitted on, at most.
ROWS_PER_CLASS = 1000
# An n-gram is learned if a likelihood-ratio test (G squared) sets its classes apart.
LEAST_G2 = 16.0
DIM = 4
NGRAMS = (3, 4, 5)
WINDOW, STRIDE = 24, 12
EPOCHS, RATE, DECAY = 80, 0.05, 1e-4
SEED = 20_240_501
KNOWN_WORDS = 600_000

_WORD = re.compile(r"[^\W_]+")


def ngrams(word: str) -> list[str]:
    """The n-grams of ``<word>``, and the whole word."""
    raw = f"<{word}>"
    return [raw] + [raw[i : i + n] for n in NGRAMS for i in range(len(raw) - n + 1)]


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def window_starts(n: int) -> np.ndarray:
    """Every STRIDE words, to learn from; the last window ends with the text."""
    return np.unique(np.append(np.arange(0, max(1, n - WINDOW), STRIDE), max(0, n - WINDOW)))


@dataclass
class Model:
    """A number for each learned n-gram, and one for the softmax's bias."""

    weights: dict[str, float]
    bias: float

    def scorer(self):
        """A function from texts to scores from 0 to 1 that remembers words.

        Windows start at every word, so that a passage counts alike in any place.
        """
        weight = self.weights.get

        class Known(dict):
            def __missing__(self, word: str) -> float:
                grams = ngrams(word)
                self[word] = found = sum([weight(g, 0.0) for g in grams]) / len(grams)
                return found

        known = Known()

        def score(text: str | None) -> float:
            if len(known) > KNOWN_WORDS:
                known.clear()
            each = np.array(list(map(known.__getitem__, words(text))))
            if not len(each):
                top = 0.0
            elif len(each) <= WINDOW:
                top = each.mean()
            else:
                sums = np.concatenate([[0.0], np.cumsum(each)])
                top = (sums[WINDOW:] - sums[:-WINDOW]).max() / WINDOW
            return float(1 / (1 + np.exp(-np.clip(top + self.bias, -30, 30))))

        return score


def telling_ngrams(
    texts: list[str | None], toxic: np.ndarray
) -> tuple[dict[str, int], np.ndarray]:
    """N-grams that tell the classes apart, numbered, and their log odds."""
    with_it = [Counter(), Counter()]
    for text, c in zip(texts, toxic, strict=True):
        with_it[int(c)].update({g for w in set(words(text)) for g in ngrams(w)})
    grams = sorted(with_it[0].keys() | with_it[1].keys())
    n = np.array([(~toxic).sum(), toxic.sum()], float)
    has = np.array([[c[g] for c in with_it] for g in grams], float).reshape(-1, 2)
    share = has.sum(axis=1, keepdims=True) / n.sum()

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0)

    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (part(has, n * share) + part(n - has, n * (1 - share))).sum(axis=1)
    odds = np.log((has[:, 1] + 0.5) / (n[1] + 1)) - np.log((has[:, 0] + 0.5) / (n[0] + 1))
    keep = np.flatnonzero(np.nan_to_num(g2) >= LEAST_G2)
    return {grams[k]: i for i, k in enumerate(keep.tolist())}, odds[keep].astype(np.float32)


def fit(texts: list[str | None], toxic: np.ndarray) -> Model:
    """Trains on whole texts. Of a toxic text, the window that scores highest counts (Adam)."""
    rng = np.random.default_rng(SEED)
    vocabulary: dict[str, int] = {}
    tokens, window_doc, window_len = [], [], []
    for d, text in enumerate(texts):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
        for at in window_starts(len(ids)) if ids else ():
            part = ids[at : at + WINDOW]
            window_doc.append(d)
            window_len.append(len(part))
            tokens += part
    if not window_doc or toxic.all() or not toxic.any():
        # Nothing to tell apart: every text scores below or above one half.
        return Model({}, 5.0 if len(toxic) and toxic.all() else -5.0)
    token = np.array(tokens, np.int32)
    doc = np.array(window_doc)
    size = np.array(window_len, np.float32)
    learned, odds = telling_ngrams(texts, toxic)
    all_grams = [ngrams(w) for w in vocabulary]
    n_grams = np.array([len(g) for g in all_grams])
    pairs = [(w, learned[g]) for w, row in enumerate(all_grams) for g in row if g in learned]
    word_of_gram, gram = np.array(pairs, np.int32).reshape(-1, 2).T
    del all_grams, pairs
    window_of_token = np.repeat(np.arange(len(doc), dtype=np.int32), window_len)
    # Words without learned n-grams add nothing but their number, which size has.
    telling = np.bincount(word_of_gram, minlength=len(n_grams))[token] > 0
    token, window_of_token = token[telling], window_of_token[telling]
    doc_at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    truth = toxic.astype(np.float32)
    per_class = np.where(truth == 1, 0.5 / max(1, truth.sum()), 0.5 / max(1, (1 - truth).sum()))
    windows = np.bincount(doc, minlength=len(texts))

    # From the n-grams' log odds along one axis; the rest is random.
    vectors = (0.1 * (rng.random((len(learned), DIM)) - 0.5)).astype(np.float32)
    vectors[:, 0] += odds
    softmax = np.full(DIM, 0.1, np.float32)  # difference of the two classes
    softmax[0] = WINDOW / 2
    bias = np.full(1, -1, np.float32)
    parts = [vectors, softmax, bias]
    means, squares = ([np.zeros_like(p) for p in parts] for _ in range(2))
    for epoch in range(EPOCHS):
        each = vectors[gram]
        word = np.stack(
            [np.bincount(word_of_gram, each[:, k], len(n_grams)) for k in range(DIM)], axis=1
        )
        word = (word / n_grams[:, None]).astype(np.float32)
        by_token = word[token]
        window = np.stack(
            [np.bincount(window_of_token, by_token[:, k], len(doc)) for k in range(DIM)], axis=1
        )
        window = (window / size[:, None]).astype(np.float32)
        logit = window @ softmax + bias[0]
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        top = np.maximum.reduceat(logit, doc_at)
        share = np.zeros(len(doc), np.float32)
        is_top = logit == np.repeat(top, np.diff(np.append(doc_at, len(doc))))
        share[is_top] = 1
        # All windows of a text that is not toxic are not.
        share += np.where(truth[doc] == 0, 1 / windows[doc], 0)
        slope = (p - truth[doc]) * share * per_class[doc]
        to_window = slope[:, None] * softmax / size[:, None]
        by_token = to_window[window_of_token]
        to_word = np.stack(
            [np.bincount(token, by_token[:, k], len(n_grams)) for k in range(DIM)], axis=1
        )
        by_gram = (to_word / n_grams[:, None])[word_of_gram]
        to_vector = np.stack(
            [np.bincount(gram, by_gram[:, k], len(learned)) for k in range(DIM)], axis=1
        )
        slopes = [to_vector + DECAY * vectors, window.T @ slope, np.array([slope.sum()])]
        for part, slope_of, mean, square in zip(parts, slopes, means, squares, strict=True):
            mean += 0.1 * (slope_of - mean)
            square += 0.01 * (slope_of**2 - square)
            m, s = mean / (1 - 0.9 ** (epoch + 1)), square / (1 - 0.99 ** (epoch + 1))
            part -= (RATE * m / (np.sqrt(s) + 1e-9)).astype(np.float32)
    weights = (vectors @ softmax).tolist()
    return Model(dict(zip(learned, weights, strict=True)), float(bias[0]))


def held_out(id_col: Column) -> Column:
    """Rows that no model learns from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Model:
    """A model of the labelled texts that are not held out.

    Fitted on at most ``rows_per_class`` texts of each class, taken by a hash of
    their ids; null labels and ids do not count, and an id labelled both ways counts
    as 0. Texts are read whole; of rows that repeat an id the one with the smallest
    text is.
    """
    usable = labels.where(
        F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    ).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    # One label per id before the limit, so that repeats use up none of it.
    usable = usable.groupBy("id").agg(F.min("toxic").alias("toxic"))
    of_class = [
        usable.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(rows_per_class)
        for c in (0, 1)
    ]
    chosen = of_class[0].unionByName(of_class[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most 2 * rows_per_class rows are broadcast and fetched.
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id")
    rows = rows.agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).collect()
    rows = sorted(rows, key=lambda r: r["id"])
    return fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows], bool))


def score_toxicity(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    score_col: str = "toxicity",
) -> DataFrame:
    """``docs`` with ``score_col``, from 0 to 1; a column of that name is replaced.

    Only the text counts. Null and empty texts, and those without words, score as a
    window without evidence. Rows are mapped one by one; an empty table stays empty.
    """
    docs = docs.drop(score_col)
    place = docs.columns.index(text_col)
    # By number, as a name with a dot can't be handed to a Python function.
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    schema = StructType([*plain.schema.fields, StructField("score", DoubleType())])

    def work():
        score = model.scorer()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [score(t) for t in batch.column(place).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"]
            )

        return step

    return map_batches(plain, work, schema).toDF(*docs.columns, score_col)
