"""Toxicity by subword-bag embeddings: character n-gram vectors averaged into a linear softmax, trained in numpy.

A word's vector is the mean of the vectors of its character n-grams, a window's vector the mean over its 16 places (a
word that stood within the last 15 counts as nothing, like a place beyond a short text), and a linear softmax turns
it into two classes. Both layers are trained together. A text is scored by its most toxic
window, so a few toxic words don't drown in a long text. Misspelt words share most n-grams with the right ones, and
training also sees words with random slips.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE = 16, 8
GRAMS = (3, 4, 5)
BUCKETS, WIDTH = 1 << 16, 16
#: The classifier is fitted on at most this many labelled rows, those with the smallest hash of their doc_id.
TRAINING_ROWS = 8_000
#: What the squared gradients start from: n-grams seen once or twice hardly move, so odd labels aren't learned by heart.
CALM = 0.01
EDGES = "\"'`.,;:!?()[]{}<>|*#$%&-_~/\\"


def words_of(text: str | None) -> list[str]:
    return [w for w in (x.strip(EDGES) for x in (text or "").lower().split()) if w]


def grams_of(word: str) -> list[int]:
    """Hash buckets of the n-grams of a word between angle brackets, and of the word whole."""
    data = f"<{word}>"
    own = {data[i : i + n] for n in GRAMS for i in range(max(1, len(data) - n + 1))} | {data}
    return sorted(zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in own)


def slipped(word: str, rng: np.random.Generator) -> str:
    """The word with one letter doubled, lost, swapped or replaced."""
    i, kind = int(rng.integers(len(word))), int(rng.integers(4))
    if kind == 0:
        return word[: i + 1] + word[i:]
    if kind == 1 and len(word) > 3:
        return word[:i] + word[i + 1 :]
    if kind == 2 and i + 1 < len(word):
        return word[:i] + word[i + 1] + word[i] + word[i + 2 :]
    return word[:i] + "aeiou013457$@*"[int(rng.integers(14))] + word[i + 1 :]


def window_starts(n: int) -> np.ndarray:
    """Starts of windows that together cover n words, the last one ending with them."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    return np.unique(np.r_[np.arange(0, n - WINDOW, STRIDE), n - WINDOW])


def repeated(ids: np.ndarray) -> np.ndarray:
    """Whether the same word stands less than a window before."""
    order = np.argsort(ids, kind="stable")
    again = np.zeros(len(ids), bool)
    again[order[1:]] = (ids[order[1:]] == ids[order[:-1]]) & (order[1:] - order[:-1] < WINDOW)
    return again


@dataclass
class Model:
    """gram: the class difference each n-gram bucket adds; bias: that of a window without words."""

    gram: np.ndarray
    bias: float

    def word(self, word: str) -> float:
        return float(self.gram[grams_of(word)].mean())

    def score(self, values: np.ndarray) -> float:
        """Probability of label 1 for a text with these word values."""
        return float(1 / (1 + np.exp(-np.clip(self.logit(values)[0], -60, 60))))

    def logit(self, values: np.ndarray) -> tuple[float, int]:
        """The highest window's logit, and where that window starts."""
        if not len(values):
            return self.bias, 0
        total = np.r_[0.0, np.cumsum(values)]
        means = (total[WINDOW:] - total[:-WINDOW] if len(values) >= WINDOW else total[-1:]) / WINDOW
        best = int(means.argmax())
        return self.bias + float(means[best]), best


class Trainer:
    """Both layers with Adagrad, over windows of indexed words."""

    def __init__(self, words: list[str], seed: int = 7):
        rng = self.rng = np.random.default_rng(seed)
        n = len(words)
        own, first = array("i"), array("q", [0])
        for word in (*words, *(slipped(w, rng) for w in words)):  # word n + i is i with a slip
            own.extend(grams_of(word))
            first.append(len(own))
        self.n = n
        self.first = np.array(first)
        self.grams = np.array(own)
        self.vectors = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
        self.layer = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.seen = [np.full(a.shape, CALM, np.float32) for a in (self.vectors, self.layer, self.bias)]

    def step(self, windows: list[np.ndarray], labels: np.ndarray, rate: float, slips: float) -> None:
        lengths = np.array([len(w) for w in windows])  # none is empty
        ids = np.concatenate(windows)
        ids = ids + self.n * (self.rng.random(len(ids)) < slips)
        some, back = np.unique(ids, return_inverse=True)
        sizes = self.first[some + 1] - self.first[some]
        cells = np.repeat(self.first[some] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        grams = self.grams[cells]
        word = np.add.reduceat(self.vectors[grams], np.r_[0, np.cumsum(sizes)[:-1]], axis=0) / sizes[:, None]
        mean = np.add.reduceat(word[back], np.r_[0, np.cumsum(lengths)[:-1]], axis=0) / WINDOW
        out = mean @ self.layer + self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True))
        wrong = out / out.sum(axis=1, keepdims=True) - np.eye(2, dtype=np.float32)[labels]
        to_mean = wrong @ self.layer.T
        to_layer, to_bias = mean.T @ wrong, wrong.sum(axis=0)
        to_word = _summed(np.repeat(to_mean / WINDOW, lengths, axis=0), back, len(some)) / sizes[:, None]
        touched, inverse = np.unique(grams, return_inverse=True)
        to_vectors = _summed(np.repeat(to_word, sizes, axis=0), inverse, len(touched))
        for layer, seen, at, grad in ((self.vectors, self.seen[0], touched, to_vectors), (self.layer, self.seen[1], slice(None), to_layer), (self.bias, self.seen[2], slice(None), to_bias)):
            seen[at] += grad**2
            layer[at] -= rate * grad / np.sqrt(seen[at])

    def model(self) -> Model:
        side = self.layer[:, 1] - self.layer[:, 0]
        return Model((self.vectors @ side).astype(np.float64), float(self.bias[1] - self.bias[0]))

    def values(self, model: Model) -> np.ndarray:
        """The value of every word."""
        n = self.first[self.n]
        sums = np.add.reduceat(model.gram[self.grams[:n]], self.first[: self.n]) if self.n else np.zeros(0)
        return sums / np.diff(self.first[: self.n + 1])


def _summed(rows: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(groups, rows[:, i], n) for i in range(rows.shape[1])], axis=1).astype(np.float32)


def fit(texts: list[str | None], labels: list[int], *, spreads: int = 3, windows: int = 12, sharpens: int = 16, batch: int = 256, rate: float = 0.2) -> Model:
    """Train on texts with labels 0 and 1.

    First random windows, at most ``windows`` of a text each time so that long texts don't outweigh the others, take their
    text's label; then, again and again, only each text's most toxic window does, which
    finds the toxic places in the texts labelled 1 and the most misleading ones in the others. Without both labels
    the model gives the share of label 1 (0 without texts).
    """
    share = sum(labels) / len(labels) if labels else 0.0
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in words_of(t)], np.int64) for t in texts]
    words = list(known)
    if not 0 < share < 1 or not known:
        return Model(np.zeros(BUCKETS), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    trainer, truth = Trainer(words), np.array(labels)
    rng = trainer.rng
    again = [repeated(d) for d in docs]
    kept = [i for i, d in enumerate(docs) if len(d)]

    def window(i: int, s: int) -> np.ndarray:
        return docs[i][s : s + WINDOW][~again[i][s : s + WINDOW]]

    def epoch(cut: list[np.ndarray], marks: np.ndarray) -> None:
        order = rng.permutation([j for j, w in enumerate(cut) if len(w)])
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            trainer.step([cut[j] for j in part], marks[part], rate, 0.15)

    for _ in range(spreads):
        some, marks = [], []
        for i in kept:
            for s in rng.permutation(window_starts(len(docs[i])))[:windows]:
                some.append(window(i, s))
                marks.append(truth[i])
        epoch(some, np.array(marks))
    for _ in range(sharpens):
        model = trainer.model()
        values = trainer.values(model)
        tops = [model.logit(np.where(again[i], 0, values[docs[i]]))[1] for i in kept]
        epoch([window(i, s) for i, s in zip(kept, tops)], truth[kept])
    return trainer.model()


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[list, list]:
    """Texts and labels of at most ``rows`` documents outside the held-out fifth, the same in every run."""
    marks = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~held_out()).select("doc_id", "toxic", F.xxhash64("doc_id").alias("hash"))
    chosen = marks.orderBy("hash", "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    some = found.orderBy("doc_id").collect()
    return [r.text for r in some], [int(r.toxic) for r in some]


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def scored(docs: DataFrame, model: Model, room: int = 400_000) -> DataFrame:
    """doc_id, score of every whole text by ``model``; the memory of word values is emptied at ``room`` tokens."""
    gram, bias = model.gram, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, known, values = Model(gram, bias), {}, {}, []  # seen: tokens as they stand; known: words
        for batch in batches:
            if len(seen) > room:
                seen, known, values = {}, {}, []
            bags = []
            for text in batch.column("text").to_pylist():
                tokens = (text or "").lower().split()
                for token in set(tokens).difference(seen):
                    word = token.strip(EDGES)
                    seen[token] = known.setdefault(word, len(values)) if word else -1
                    if seen[token] == len(values):
                        values.append(own.word(word))
                ids = np.fromiter(map(seen.__getitem__, tokens), np.int64, len(tokens))
                bags.append(ids[ids >= 0])
            table = np.array(values)
            scores = [own.score(np.where(repeated(ids), 0.0, table[ids])) if len(ids) else own.score(ids) for ids in bags]
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def judged(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learned from the rows of ``labels`` whose crc32(doc_id) mod 5 isn't 0; null or other labels don't count, and of
    repeated ones the highest does. Null and empty texts get the score of no evidence. A null doc_id is scored but
    neither held out nor learned from. Columns other than doc_id and text are ignored.
    """
    model = fit(*training_rows(docs, labels, rows))
    return scored(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
