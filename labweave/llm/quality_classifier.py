"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; the unlabelled sample is web text of any kind, drawn
whatever its labels. The class prior is estimated from positives and unlabelled rows alone: a
first model tells the two apart, and the smallest ratio of unlabelled to positive shares above a
score bounds the prior (best-bin estimate on rows held back). The classifier then minimises the
non-negative unbiased risk

    prior * R(positives as +) + max(0, R(unlabelled as -) - prior * R(positives as -))

with the logistic loss over text statistics and their squares; where the negative part falls
below zero its gradient is turned round, so that it can't be driven under by overfitting.

The fit uses at most ``max_rows`` positives and as many unlabelled rows (a documented bound; the
rows with the smallest hash of their id), which is all the driver ever holds. Scoring is one
pass over whole texts.

Null text is empty and gets a score like any other; an id with conflicting labels is no positive;
repeated rows each get a row; without at least ``MIN_ROWS`` positives all scores are 0.5; extra
columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from math import log1p
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from labweave.llm.common import crc_rest, hash_sample, in_arrow

#: Bound of the fitting sample, positives and unlabelled rows each, and least number of positives.
MAX_ROWS = 8_000
MIN_ROWS = 20
STEPS = 600

FEATURES = (
    "chars words word_length variety repeats upper digits symbols shouts points lines line_length "
    "same_lines packing top_word short_words").split()

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>@^~=+_\\{}[]"
_SHOUTS = b"!?"
_POINTS = b".,;:'\"()-"


def features(text: str | None) -> list[float]:
    """Statistics of a whole text, of about the same scale."""
    text = text or ""
    raw = text.encode()
    size = max(1, len(raw))
    words = raw.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    letters = share(_LETTERS)
    counts = Counter(words)
    return [
        log1p(len(text)) / 10,
        log1p(n) / 8,
        min(3.0, len(text) / (n + 1) / 10),
        log1p(len(counts)) / log1p(n) if n else 1.0,
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        share(_UPPER) / letters if letters else 0.0,
        share(_DIGITS),
        share(_SYMBOLS),
        share(_SHOUTS),
        share(_POINTS),
        log1p(len(lines)) / 5,
        log1p(len(text) / max(1, len(lines))) / 6,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        min(2.0, len(zlib.compress(raw, 1)) / size),
        max(counts.values()) / n if n else 0.0,
        sum(len(w) == 1 for w in words) / max(1, n),
    ]


class Model:
    """Linear in the standardised features and their squares."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(z), 1)), z, z * z / 4])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -40, 40)))


def _adam(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _blank(p: np.ndarray, u: np.ndarray) -> Model:
    both = np.vstack([p, u])
    scale = np.maximum(both.std(axis=0), 0.02)
    return Model(both.mean(axis=0), scale, np.zeros(1 + 2 * both.shape[1]))


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in the unlabelled rows, by the best bin of rows held back."""
    model = _blank(p, u)
    fit_p, fit_u = model.expand(p[::2]), model.expand(u[::2])

    def gradient(w):
        return (-(1 - _sigmoid(fit_p @ w)) @ fit_p / len(fit_p)
                + _sigmoid(fit_u @ w) @ fit_u / len(fit_u) + 1e-3 * w)

    model.weights = _adam(gradient, fit_p.shape[1], 300)
    held_p, held_u = np.sort(model.margin(p[1::2])), np.sort(model.margin(u[1::2]))
    above_p = 1 - np.arange(len(held_p)) / len(held_p)
    above_u = 1 - np.searchsorted(held_u, held_p) / len(held_u)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(held_p)) + 1 / np.sqrt(len(held_u)))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def fit(p: np.ndarray, u: np.ndarray, prior: float, *, steps: int = STEPS, decay: float = 1e-2) -> Model:
    """Non-negative risk minimisation on positives ``p`` and unlabelled ``u``."""
    model = _blank(p, u)
    xp, xu = model.expand(p), model.expand(u)

    def gradient(w):
        sp, su = _sigmoid(xp @ w), _sigmoid(xu @ w)
        as_positive = -prior * (1 - sp) @ xp / len(xp)
        negative = np.mean(np.logaddexp(0, xu @ w)) - prior * np.mean(np.logaddexp(0, xp @ w))
        as_negative = su @ xu / len(xu) - prior * sp @ xp / len(xp)
        return (as_positive + as_negative if negative >= 0 else -as_negative) + decay * w

    model.weights = _adam(gradient, xp.shape[1], steps)
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([features(t) for t in column.to_pylist()], np.float64).reshape(-1, len(FEATURES))


def training_sample(docs: DataFrame, labels: DataFrame, *, folds: int, held: int, max_rows: int) -> DataFrame:
    """``doc_id, positive, unlabelled`` of at most 2 * max_rows ids outside the held-out fold."""
    ids = docs.select("doc_id").filter("doc_id is not null").distinct().filter(
        crc_rest(F.col("doc_id"), folds) != held)
    good = labels.filter("quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    p = _smallest(ids.join(good, "doc_id"), max_rows, F.xxhash64("doc_id"))
    u = _smallest(ids, max_rows, F.xxhash64(F.lit("unlabelled"), "doc_id"))
    return p.withColumn("positive", F.lit(1)).unionByName(
        u.withColumn("unlabelled", F.lit(1)), allowMissingColumns=True).groupBy("doc_id").agg(
        F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled"))


def _smallest(ids: DataFrame, rows: int, key: Column) -> DataFrame:
    """The ``rows`` ids with the smallest keys, out of a sample that has a few more."""
    return hash_sample(ids, rows + rows // 5 + 200, key).orderBy(key, "doc_id").limit(rows)


def train(
    docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, max_rows: int = MAX_ROWS
) -> Model | None:
    """A model from rows whose id's crc32 modulo ``folds`` is not ``held``."""
    sample = training_sample(docs, labels, folds=folds, held=held, max_rows=max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("positive"), b.column("unlabelled"),
                 pa.array(list(_matrix(b.column("text"))), pa.list_(pa.float64()))],
                names=["doc_id", "positive", "unlabelled", "x"])

    kind = dict(texts.dtypes)["doc_id"]
    rows = in_arrow(texts, run, f"doc_id {kind}, positive int, unlabelled int, x array<double>")
    once = rows.groupBy("doc_id").agg(  # a repeated id counts once
        F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled"), F.max("x").alias("x"))
    got = sorted(once.collect())  # at most 2 * max_rows short rows
    p = np.array([r.x for r in got if r.positive], np.float64)
    u = np.array([r.x for r in got if r.unlabelled], np.float64)
    if len(p) < MIN_ROWS or len(u) < MIN_ROWS:
        return None
    return fit(p, u, estimate_prior(p, u))


def score_texts(docs: DataFrame, model: Model | None, *, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns named in ``keep`` and the ``score`` of each row's ``text``."""
    extra = [] if "text" in keep else ["text"]
    src = docs.select(*keep, *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("text"))
            score = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(score, pa.float64())], names=[*keep, "score"])

    fields = ", ".join(f"`{c}` {k}" for c, k in src.dtypes if c in keep)
    return in_arrow(src, run, f"{fields}, score double")


def classify(docs: DataFrame, labels: DataFrame, *, keep: Sequence[str] = ("doc_id",), **options) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` (1 from a score of 0.5), which ``keep`` must not name."""
    if clash := {c.lower() for c in keep} & {"score", "predicted"}:
        raise ValueError(f"rename the columns {sorted(clash)} to keep them")
    scored = score_texts(docs, train(docs, labels, **options), keep=keep)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
