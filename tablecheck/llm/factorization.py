"""Toxicity with a factorization machine over hashed terms.

A text's terms are its lower-cased words and the five-letter beginnings of
longer words, hashed to 32 bits; a term weighs by the logarithm of its share of
the words, so texts of any length are alike.  Besides a weight per term the
machine learns a short vector per term, whose inner products are the weights
of pairs: two terms together can count for more (an insult beside the mention
of a group) or less than the sum of both.

Training takes at most ``MAX_TRAIN_ROWS`` labelled rows, those with the least
hash of their id.  The machine knows the terms that ``MIN_DOCS`` of them hold and
whose share of labelled texts is ``MIN_Z`` standard deviations from chance; the
rest is noise that would be learned by heart.  The model, a few numbers per
known term, is bounded by that sample.

Defined cases: a null or empty text has no terms and scores the model's bias;
terms not seen in training have no weight; labels that are null or belong to
no row are left out; with one label only the score is its share, without
labelled rows 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import training_rows
from .common import batch_of, column, held_out

#: Bound of the labelled sample that a model is fitted on.
MAX_TRAIN_ROWS = 20_000
MIN_DOCS = 3
MIN_Z = 4.0
#: A term with this share of the words weighs log(2).
UNIT_SHARE = 0.005
PREFIX = 5
MAX_MEMO = 500_000
_WORD = re.compile(r"[^\W\d_]+")


class _TermHashes(dict):
    """Hashes of a word's terms; a bounded cache."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MAX_MEMO:
            self.clear()
        terms = [f"w {word}", f"p {word[:PREFIX]}"] if len(word) > PREFIX else [f"w {word}"]
        hashes = tuple(xxhash.xxh32_intdigest(t.encode("utf-8", "replace")) for t in terms)
        if len(word) <= 40:
            self[word] = hashes
        return hashes


_TERMS = _TermHashes()


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes of a text with their weights."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.float32)
    held: Counter = Counter()
    for word, n in Counter(words).items():
        for h in _TERMS[word]:
            held[h] += n
    ids = np.fromiter(held.keys(), np.uint32, len(held))
    weights = np.log1p(np.fromiter(held.values(), np.float32, len(held)) / (UNIT_SHARE * len(words)))
    order = np.argsort(ids)
    return ids[order], weights[order]


@dataclass
class Machine:
    """Known terms (sorted hashes) with a weight and a vector each."""

    bias: float
    known: np.ndarray
    weight: np.ndarray
    vectors: np.ndarray

    def margins(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        if not len(self.known):
            return out
        for k, (ids, x) in enumerate(rows):
            at = np.minimum(np.searchsorted(self.known, ids), len(self.known) - 1)
            own = self.known[at] == ids
            at, x = at[own], x[own]
            v = self.vectors[at] * x[:, None]
            out[k] += float(self.weight[at] @ x) + 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return out

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -30, 30)))


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, factors: int = 4, epochs: int = 30, batch: int = 64,
                rate: float = 0.3, penalty: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss, mini-batches with adaptive steps per parameter."""
    share = float(y.mean()) if len(y) else 0.0
    bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    nothing = Machine(bias, np.zeros(0, np.uint32), np.zeros(0, np.float32), np.zeros((0, factors), np.float32))
    if not len(y) or y.min() == y.max():
        return nothing
    known, held = np.unique(np.concatenate([r[0] for r in rows]), return_counts=True)
    with_label = np.zeros(len(known))
    for k in np.flatnonzero(y > 0.5):
        with_label[np.searchsorted(known, rows[k][0])] += 1
    spread = np.sqrt(np.maximum(held * share * (1 - share), 1e-9))
    known = known[(held >= MIN_DOCS) & (np.abs(with_label - held * share) >= MIN_Z * spread)]
    if not len(known):
        return nothing
    data = []
    for ids, x in rows:
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        own = known[at] == ids
        data.append((at[own], x[own].astype(np.float64)))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(known)), rng.normal(0, 0.05, (len(known), factors))
    w_sum, v_sum, b_sum = np.full(len(known), 1e-3), np.full((len(known), factors), 1e-2), 1e-3
    for epoch in range(epochs):
        step = rate / (1 + epoch / 4)
        order = rng.permutation(len(y))
        for first in range(0, len(y), batch):
            take = order[first:first + batch]
            sizes = np.array([len(data[k][0]) for k in take])
            at, x = np.concatenate([data[k][0] for k in take]), np.concatenate([data[k][1] for k in take])
            row = np.repeat(np.arange(len(take)), sizes)
            vx = v[at] * x[:, None]
            total = np.stack([np.bincount(row, vx[:, f], len(take)) for f in range(factors)], 1)
            margin = bias + np.bincount(row, w[at] * x, len(take)) + 0.5 * (
                (total**2).sum(1) - np.bincount(row, (vx**2).sum(1), len(take)))
            g = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[take]
            seen, local = np.unique(at, return_inverse=True)
            gx = g[row] * x / len(take)
            gw = np.bincount(local, gx, len(seen)) + penalty * w[seen]
            gv = np.stack([np.bincount(local, gx * (total[row, f] - vx[:, f]), len(seen)) for f in range(factors)], 1) \
                + penalty * v[seen]
            w_sum[seen] += gw**2
            v_sum[seen] += gv**2
            w[seen] -= step * gw / np.sqrt(w_sum[seen])
            v[seen] -= 0.2 * step * gv / np.sqrt(v_sum[seen])
            b_sum += g.mean() ** 2
            bias -= 0.2 * step * g.mean() / np.sqrt(b_sum)
    return Machine(float(bias), known, w.astype(np.float32), v.astype(np.float32))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
                 max_rows: int = MAX_TRAIN_ROWS, **options) -> Machine:
    """A machine fitted on the terms of a bounded labelled sample."""
    train = training_rows(docs, labels, label, id_col, text_col, max_rows)
    schema = pa.schema([("id", pa.int64()), ("y", pa.float64()), ("ids", pa.binary()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [terms(t) for t in column(b, "text")]
            yield batch_of(schema, column(b, "id"), column(b, "y"), [i.tobytes() for i, _ in got],
                           [x.astype(np.float16).tobytes() for _, x in got])

    rows = train.mapInArrow(run, "id long, y double, ids binary, x binary").limit(max_rows).collect()
    rows.sort(key=lambda r: (r[0], r[1], bytes(r[2])))
    return fit_machine([(np.frombuffer(r[2], np.uint32), np.frombuffer(r[3], np.float16)) for r in rows],
                       np.array([r[1] for r in rows], float), **options)


def score_toxicity(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch_of(schema, b.column(0), shared.value.scores([terms(t) for t in column(b, "text")]))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def classify_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", at: float = 0.7,
                      **options) -> DataFrame:
    """``id, held_out, score, predicted`` for each row."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, "toxic", id_col, text_col, **options), id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))
