"""Histogram gradient-boosted trees over document statistics.

Statistics are computed where the text is (one pass, Arrow batches).  Training
takes at most ``MAX_TRAIN_ROWS`` labelled rows (those with the least hash of
their id, so the choice does not depend on partitioning); their statistics are
binned to at most 64 quantile bins per column and the trees grow level by level
on gradient histograms.  The model is flattened into arrays: scoring walks all
rows of a batch down all trees with numpy indexing, one step per level.

Defined cases: null and empty texts have zero statistics and a score like any
other; labels that are null or belong to no row are left out; without any
labelled row, or with one label only, the score is that share (0.5 without).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, batch_of, column, held_out

#: Bound of the labelled sample that a model is fitted on.
MAX_TRAIN_ROWS = 40_000
BINS = 64

STATISTICS = [
    "log_chars", "log_words", "mean_word", "sd_word", "long_words", "distinct_words", "distinct_pairs", "top_word",
    "run_words", "longest_run", "upper", "lower", "digit", "white", "non_ascii", "punctuation", "symbols", "symbol_words",
    "bars", "exclamations", "upper_words", "log_lines", "distinct_lines", "duplicate_line_chars", "mean_line",
    "ended_lines", "short_lines", "sentence_ends",
]

_CLASSES = bytes(
    0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in WHITE else 4 if c >= 192 else
    5 if c >= 128 else 6 if chr(c) in "#*$%&|<>" else 7 if c > 32 and c != 127 else 8 for c in range(256))
_SYMBOL_WORD = re.compile(rb"[#*$%&|<>]")


def statistics(text: bytes | None) -> list[float]:
    """The values of ``STATISTICS`` for one text."""
    if not text:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(text.translate(_CLASSES), np.uint8), minlength=9)
    chars = len(text) - int(kinds[5])  # without the continuation bytes
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    codes: dict[bytes, int] = {}
    seq = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    same = seq[1:] == seq[:-1]
    breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]])) if len(seq) else np.array([0, 0])
    pairs = len(np.unique(seq[1:] * len(codes) + seq[:-1])) if len(seq) > 1 else 1
    lines = [x for x in (x.strip(WHITE) for x in text.split(b"\n")) if x]
    own = set(lines)
    m = max(1, len(lines))
    symbol_words = sum(1 for w in codes if _SYMBOL_WORD.search(w))
    return [
        np.log1p(chars), np.log1p(len(words)), float(lengths.mean()), float(lengths.std()), float((lengths > 20).mean()),
        len(codes) / n, pairs / max(1, len(seq) - 1), float(np.bincount(seq).max()) / n if len(seq) else 0.0,
        float(same.sum()) / n, float(np.log1p(np.diff(breaks).max())),
        kinds[1] / chars, kinds[0] / chars, kinds[2] / chars, kinds[3] / chars, kinds[4] / chars, kinds[7] / chars, kinds[6] / chars,
        symbol_words / max(1, len(codes)), text.count(b"|") / n, text.count(b"!") / n,
        sum(1 for w in codes if w.isupper() and len(w) > 1) / max(1, len(codes)),
        np.log1p(len(lines)), len(own) / m, 1 - sum(map(len, own)) / max(1, sum(map(len, lines))),
        np.log1p(len(words) / m), sum(1 for x in lines if x[-1:] in b".!?") / m, sum(1 for x in lines if len(x) < 30) / m,
        (text.count(b".") + text.count(b"?")) / n,
    ]


@dataclass
class Trees:
    """All trees in arrays of (tree, node); node k's children are 2k+1 and 2k+2."""

    base: float
    depth: int
    feature: np.ndarray  # -1: no split, rows go left
    cut: np.ndarray
    value: np.ndarray  # of the last level's nodes

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not len(self.feature):
            return out
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[trees, at]
            at = 2 * at + 1 + ((f >= 0) & (x[rows, np.maximum(f, 0)] > self.cut[trees, at]))
        return out + self.value[trees, at - (2**self.depth - 1)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.2, min_rows: int = 5,
              penalty: float = 1.0) -> Trees:
    """Boosted trees of the logistic loss on binned columns."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    nodes = 2**depth - 1
    if len(y) < 2 * min_rows or y.min() == y.max():
        return Trees(base, depth, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, 2**depth)))
    cols = x.shape[1]
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1])) for c in range(cols)]
    binned = np.stack([np.searchsorted(edges[c], x[:, c], "left") for c in range(cols)], 1)
    margin = np.full(len(y), base)
    features, cuts, values = [], [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.full(nodes, -1), np.zeros(nodes)
        at = np.zeros(len(y), np.int64)  # the node of each row
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = at - first
            best = np.full(width, 1e-9)
            chosen, chosen_bin = np.full(width, -1), np.zeros(width, np.int64)
            for c in range(cols):
                cell = local * BINS + binned[:, c]
                g = np.bincount(cell, grad, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(cell, hess, width * BINS).reshape(width, BINS).cumsum(1)
                n = np.bincount(cell, minlength=width * BINS).reshape(width, BINS).cumsum(1)
                gt, ht, nt = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g**2 / (h + penalty) + (gt - g)**2 / (ht - h + penalty) - gt**2 / (ht + penalty)
                gain[(n < min_rows) | (nt - n < min_rows)] = 0
                gain[:, len(edges[c]):] = 0
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better], chosen[better], chosen_bin[better] = top[better], c, k[better]
            for k in np.flatnonzero(chosen >= 0):
                feature[first + k], cut[first + k] = chosen[k], edges[chosen[k]][chosen_bin[k]]
            f = chosen[local]
            right = (f >= 0) & (binned[np.arange(len(y)), np.maximum(f, 0)] > chosen_bin[local])
            at = 2 * at + 1 + right
        leaf = at - nodes
        g, h = np.bincount(leaf, grad, 2**depth), np.bincount(leaf, hess, 2**depth)
        value = -rate * g / (h + penalty)
        margin += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(base, depth, np.array(features), np.array(cuts), np.array(values))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """``id, text, y`` of at most ``max_rows`` labelled rows that a model may learn from.

    The ids of the sample are bounded by ``max_rows``, so they are broadcast and
    the documents are not shuffled.  An id with several labels or rows counts once for each pair.
    """
    sample = (labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label).cast("double").alias("y"))
              .filter(~held_out("label_id") & F.col("y").isNotNull() & F.col("label_id").isNotNull())
              .orderBy(F.xxhash64("label_id"), "label_id", "y").limit(max_rows))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(sample), rows["id"] == sample["label_id"]).select("id", "text", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                max_rows: int = MAX_TRAIN_ROWS, **options) -> Trees:
    """Trees fitted on the statistics of a bounded labelled sample."""
    train = training_rows(docs, labels, label, id_col, text_col, max_rows)
    schema = pa.schema([("id", pa.int64()), ("y", pa.float64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch_of(schema, column(b, "id"), column(b, "y"), [statistics(t) for t in column(b, "text")])

    rows = train.select("id", "y", F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "id long, y double, x array<double>").limit(max_rows).collect()
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    x = np.array([r[2] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit_trees(x, np.array([r[1] for r in rows], float), **options)


def score_quality(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` added (a column of that name is replaced)."""
    names = [c for c in docs.columns if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    row_type = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).field(names.index(text_col)).cast(pa.binary()).to_pylist()
            x = np.array([statistics(t) for t in texts], float).reshape(b.num_rows, len(STATISTICS))
            scores = np.concatenate([shared.value.score(x[k:k + 4096]) for k in range(0, max(1, len(x)), 4096)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    out = rows.mapInArrow(run, f"row {row_type}, score double")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "score")


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", at: float = 0.5,
                     **options) -> DataFrame:
    """``id, held_out, score, predicted`` for each row."""
    model = fit_quality(docs, labels, "quality", id_col, text_col, **options)
    narrow = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col))
    scored = score_quality(narrow, model, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))
