"""Ranked lexical search by grouping documents on the terms they match.

1. The items' terms are the vocabulary.  One pass over the documents writes
   their postings: length, and the vocabulary terms with their counts.
2. Document frequencies are counted over the postings, one row per task and
   term, and give each term its weight.
3. Each task takes its postings in blocks.  In a block an item's terms set one
   bit each in a mask per document.  Documents of one mask match the same
   terms, so one maximum holds for all: the sum of the terms' largest
   contributions in the block.  The distinct masks are evaluated from the
   largest maximum down, their documents scored exactly, until the next
   maximum is below the last kept score: no document left can enter.
   The kept scores go with the task from block to block.
4. The tasks' best rows meet in a ranking that is limited map-side and dealt
   by a salt first, so no task takes all rows of an item.

The items are the query set.  Their size is measured; blocks of about
``BLOCK_BYTES`` are collected one at a time, each with passes of its own.

Scores are integers: the sum over the item's terms, repeats included, of
``w * (10^9 tf div (1000 tf + 8 m))`` with ``m = 25 + 75 n N div L``.

Defined cases: null and empty texts have no terms; documents without terms are
not counted; items without terms, or without a match, give no rows; items that
share an id are ranked each on its own; a document id is a long, null ids rank
last among equal scores; repeated rows are documents of their own; other
columns, of whatever name, are not read; a very long text is one posting list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, materialise
from .lines import NO_ID
from .suffix import words_of

K = 10
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 8192
#: Documents of the first masks that are evaluated before the stop is tested; doubled each time.
FIRST_DOCS = 64
SALTS = 32
_N, _L = -1, -2  # stand for the documents and for all terms in the counts


class Items:
    """A block of items: each one's distinct terms and their repeats."""

    def __init__(self, texts: list[bytes | None]):
        self.vocabulary: dict[bytes, int] = {}
        self.terms, self.repeats = [], []
        for t in texts:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(t)]
            terms, repeats = np.unique(np.array(codes, np.int64), return_counts=True)
            self.terms.append(terms)
            self.repeats.append(repeats)


def postings(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, counts`` of each document with terms."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value.get
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                if words:
                    known = np.fromiter((c for c in map(code, words) if c is not None), np.int32)
                    terms, counts = np.unique(known, return_counts=True)
                    out.append((i, len(words), terms, counts))
            columns = list(zip(*out)) or [[], [], [], []]
            yield batch_of(schema, *columns[:2], *[_lists(c) for c in columns[2:]])

    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, counts array<int>")


def _lists(arrays) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def corpus_counts(found: DataFrame, n_terms: int) -> dict[int, int]:
    """Documents holding each vocabulary term, and under ``_N`` and ``_L`` the documents and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, total = np.zeros(n_terms, np.int64), 0, 0
        for b in batches:
            df += np.bincount(_flat(b.column(1)), minlength=n_terms)
            n_docs += b.num_rows
            total += int(b.column(0).to_numpy().sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([_N, _L, *held.tolist()]), pa.array([n_docs, total, *df[held].tolist()])], names=["term", "held"])

    part = found.select("n", "terms").mapInArrow(run, "term long, held long")
    return {r["term"]: r["held"] for r in part.groupBy("term").agg(F.sum("held").alias("held")).collect()}


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Block:
    """Some documents' postings, by term and by document, with each posting's contribution."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_docs: int, total: int):
        self.ids = ids
        m = 25 + (75 * n * n_docs) // total
        doc = np.repeat(np.arange(len(ids)), lengths)
        self.terms, self.contribution = terms, (1_000_000_000 * counts) // (1000 * counts + 8 * m[doc])
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        order = np.argsort(terms, kind="stable")
        self.docs = doc[order]
        ordered = terms[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        self.present = ordered[starts]
        self.starts = np.append(starts, len(ordered))
        self.largest = np.maximum.reduceat(self.contribution[order], starts) if len(starts) else np.zeros(0, np.int64)

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct masks of matched ``terms`` (rows of 64-bit words), the documents by mask with each mask's range
        in them, and for each term the largest contribution here."""
        place = np.searchsorted(self.present, terms)
        held = np.zeros(len(terms), bool)
        held[place < len(self.present)] = self.present[place[place < len(self.present)]] == terms[place < len(self.present)]
        mask = np.zeros((len(self.ids), (len(terms) + 63) // 64), np.uint64)
        largest = np.zeros(len(terms), np.int64)
        for k in np.flatnonzero(held).tolist():
            at = place[k]
            mask[self.docs[self.starts[at]:self.starts[at + 1]], k // 64] |= np.uint64(1 << (k % 64))
            largest[k] = self.largest[at]
        touched = np.flatnonzero(mask.any(1))
        rows = mask[touched]
        order = np.lexsort(rows.T)
        rows = rows[order]
        new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])) if len(rows) else np.zeros(0, np.int64)
        return rows[new], touched[order], np.append(new, len(rows)), largest

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores; ``weight`` by vocabulary term."""
        lengths = self.first[docs + 1] - self.first[docs]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.first[docs] - (ends - lengths), lengths)
        return np.add.reduceat(weight[self.terms[at]] * self.contribution[at], ends - lengths)


def maxima(masks: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """For each mask the sum of ``gain`` over its bits."""
    out = np.zeros(len(masks), np.int64)
    octets = masks.astype("<u8").view(np.uint8).reshape(len(masks), 8 * masks.shape[1])
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    for k in range(0, len(gain), 8):
        own = gain[k:k + 8]
        out += (bits[:, :len(own)] @ own)[octets[:, k // 8]]
    return out


class Best:
    """The ``k`` highest scores of an item so far, equal ones by ascending id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a score has to reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.least
        scores, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def evaluate(block: Block, terms: np.ndarray, gain: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Adds the block's documents to ``best``; the number of documents that were scored.

    ``gain`` is the weight of each of ``terms`` times its repeats, ``weight`` the same by vocabulary term.
    """
    masks, docs, ranges, largest = block.masks(terms)
    top = maxima(masks, gain * largest)
    order = np.argsort(-top, kind="stable")
    order = order[:np.searchsorted(-top[order], -best.least, "right")]
    sizes = (ranges[1:] - ranges[:-1])[order]
    reached = np.cumsum(sizes)
    done, scored, step = 0, 0, FIRST_DOCS
    while done < len(order) and top[order[done]] >= best.least:
        stop = int(np.searchsorted(reached, scored + step)) + 1  # whole masks
        chosen, held = order[done:stop], sizes[done:stop]
        ends = np.cumsum(held)
        at = np.arange(ends[-1]) + np.repeat(ranges[chosen] - (ends - held), held)
        best.add(block.scores(docs[at], weight), block.ids[docs[at]])
        done, scored, step = min(stop, len(order)), int(reached[min(stop, len(order)) - 1]), step * 2
    return scored


def _block_rank(found: DataFrame, items: Items, counts: dict[int, int], k: int, block_docs: int) -> DataFrame:
    """``item, score, id``: the best of each task's documents; ``item`` is a place in ``items``."""
    n_docs, total = counts.get(_N, 0), counts.get(_L, 0)
    weight_of = weights(np.array([counts.get(t, 0) for t in range(len(items.vocabulary))]), n_docs)
    shared = found.sparkSession.sparkContext.broadcast((items.terms, items.repeats, weight_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, repeats, w = shared.value
        best = [Best(k) for _ in terms]
        weight = np.zeros(len(w), np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, block_docs):
                b = whole.slice(start, block_docs)
                lengths = np.diff(b.column(2).offsets.to_numpy())
                block = Block(b.column(0).to_numpy(), b.column(1).to_numpy(), lengths, _flat(b.column(2)), _flat(b.column(3)), n_docs, total)
                for own, r, top in zip(terms, repeats, best):
                    if len(own):
                        gain = w[own] * r
                        weight[own] = gain
                        evaluate(block, own, gain, weight, top)
                        weight[own] = 0
        rows = [(k, s, i) for k, top in enumerate(best) for s, i in zip(top.scores.tolist(), top.ids.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["item", "score", "id"])

    return found.mapInArrow(run, "item long, score long, id long")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``item id, rank, doc id, score``: the ``k`` highest-scoring documents of each row of ``items``, scores above 0."""
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    own = items.select(F.col(f"`{item_col}`").alias("name"), F.col(f"`{item_text_col}`").cast("binary").alias("text")).filter("octet_length(text) > 0")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    parts = []
    for part in range(n_blocks):
        rows = own.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks)) == part).collect()
        block = Items([bytes(r["text"]) for r in rows])
        found = materialise(postings(docs, block, id_col, text_col), "postings")
        counts = corpus_counts(found, len(block.vocabulary))
        best = _block_rank(found, block, counts, k, block_docs)
        names = spark.createDataFrame([(i, r["name"]) for i, r in enumerate(rows)], f"item long, name {item_type}")
        parts.append(best.select(F.lit(part).alias("part"), "item", "score", "id").join(F.broadcast(names), "item"))  # a block of items
    best = parts[0]
    for more in parts[1:]:
        best = best.unionByName(more)
    order = [F.col("score").desc(), F.col("id")]
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    near = best.withColumn("place", F.row_number().over(Window.partitionBy("part", "item", salt).orderBy(*order))).filter(F.col("place") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("part", "item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select(F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"),
                         F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "score")
