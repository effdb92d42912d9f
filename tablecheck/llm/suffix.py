"""Benchmark decontamination with training suffix arrays.

Each task takes its documents a shard at a time, codes their words by the
benchmark's vocabulary (any other word, and each document's end, is 0 and
matches nothing) and sorts the suffixes that can match.  A suffix can match a
window of w words only if it starts a run of w vocabulary words, so only those
are sorted: the array is sparse and loses no match.  Every suffix of every
benchmark item is then binary-searched in the shard's array; the range it hits
is extended word by word to the longest verbatim match, with its location.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter
item.  The words of a document inside any occurrence are hit.

The benchmark is the query set.  Its size is measured first; it is collected
and broadcast in blocks of about ``BLOCK_BYTES`` (items are dealt to blocks by
hash), and a task holds one block at a time when there are several.  The
documents are read once, whatever the number of blocks.

Defined cases: null texts have no words; items without words match nothing;
each input row gives one row, repeated rows and null ids included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, column

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
# Words are runs of 0-9, a-z (after lower-casing A-Z) and any byte of a non-ASCII character.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class Suffixes:
    """The suffixes of the benchmark items, as word codes, grouped by their items' window length."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window = window
        self.vocabulary = _Vocabulary()
        self.names: list[str] = []
        codes, starts = [], [0]
        for name, text in items:
            words = words_of(text)
            if words:
                self.names.append(name)
                codes += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                starts.append(len(codes))
        self.codes = np.array([*codes, 0], np.int64)
        self.start = np.array(starts, np.int64)
        lengths = np.diff(self.start)
        self.window_of = np.minimum(lengths, window)
        item = np.repeat(np.arange(len(lengths)), lengths)
        at = np.arange(len(codes))
        left = self.start[1:][item] - at if len(codes) else at
        keep = left >= self.window_of[item] if len(codes) else np.zeros(0, bool)
        self.at, self.item, self.left = at[keep], item[keep], left[keep]

    def window_sizes(self) -> list[int]:
        return sorted(set(self.window_of.tolist()), reverse=True)


def _keys(codes: np.ndarray, at: np.ndarray, width: int, size: int) -> list[np.ndarray]:
    """The first ``width`` codes from each position, packed in as few 63-bit numbers as hold them."""
    bits = max(1, int(size).bit_length())
    per = max(1, 63 // bits)
    out = []
    for first in range(0, width, per):
        key = np.zeros(len(at), np.int64)
        for k in range(first, min(width, first + per)):
            key = (key << bits) | codes[at + k]
        out.append(key)
    return out


def _rank(keys: list[np.ndarray], more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One number per row of ``keys`` and ``more`` that orders as the columns do (for several columns)."""
    if len(keys) == 1:
        return keys[0], more[0]
    n = len(keys[0])
    rank = np.zeros(n + len(more[0]), np.int64)
    for a, b in zip(keys, more):
        _, code = np.unique(np.concatenate([a, b]), return_inverse=True)
        _, rank = np.unique(rank * (code.max(initial=0) + 1) + code, return_inverse=True)
    return rank[:n], rank[n:]


def shard_matches(codes: np.ndarray, suffixes: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``position, item suffix, item, longest match`` of every test suffix found in a shard of word codes.

    ``codes`` ends with ``window`` zeros or more, and a zero ends each document.
    """
    if not len(suffixes.at):
        return
    idle = np.flatnonzero(codes == 0)
    run = idle[np.searchsorted(idle, np.arange(len(codes)))] - np.arange(len(codes))  # vocabulary words from here on
    size = len(suffixes.vocabulary)
    for width in suffixes.window_sizes():
        at = np.flatnonzero(run >= width)
        mine = np.flatnonzero(suffixes.window_of[suffixes.item] == width)
        if not len(at) or not len(mine):
            continue
        train, test = _rank(_keys(codes, at, width, size), _keys(suffixes.codes, suffixes.at[mine], width, size))
        order = np.argsort(train, kind="stable")  # the shard's suffix array, to the depth of a window
        array, sorted_keys = at[order], train[order]
        low, high = np.searchsorted(sorted_keys, test, "left"), np.searchsorted(sorted_keys, test, "right")
        found = np.flatnonzero(high > low)
        for part in np.array_split(found, max(1, int((high - low)[found].sum()) // 500_000 + 1)):
            count = (high - low)[part]
            if not count.sum():
                continue
            suffix = np.repeat(mine[part], count)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            position = array[np.repeat(low[part], count) + offset]
            length = np.full(len(position), width, np.int64)
            limit = np.minimum(suffixes.left[suffix], run[position])
            going = np.flatnonzero(length < limit)
            while len(going):
                same = codes[position[going] + length[going]] == suffixes.codes[suffixes.at[suffix[going]] + length[going]]
                going = going[same]
                length[going] += 1
                going = going[length[going] < limit[going]]
            yield position, suffixes.at[suffix], suffixes.item[suffix], length


def _merge(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search_shard(texts: list[bytes | None], suffixes: Suffixes):
    """Per text: words, merged hit spans ``(from, to)``, items and the longest match as ``(words, at, item)``."""
    lookup = suffixes.vocabulary.__getitem__
    counts, parts = [], []
    for t in texts:
        words = words_of(t)
        counts.append(len(words))
        parts.append(np.fromiter(map(lookup, words), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    parts.append(np.zeros(suffixes.window + 1, np.int64))
    codes = np.concatenate(parts)
    first = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) + 1)])
    spans: list[set] = [set() for _ in texts]
    items: list[set] = [set() for _ in texts]
    longest = [(0, 0, -1)] * len(texts)
    for position, _, item, length in shard_matches(codes, suffixes):
        doc = np.searchsorted(first, position, "right") - 1
        start = position - first[doc]
        for d, s, n, i in zip(doc.tolist(), start.tolist(), length.tolist(), item.tolist()):
            spans[d].add((s, s + n))
            items[d].add(i)
            if n > longest[d][0]:
                longest[d] = (n, s, i)
    return counts, [_merge(list(x)) for x in spans], items, longest


_RESULT = ("id long, n_words long, spans array<struct<start:long,stop:long>>, items array<string>, "
           "longest struct<words:long,start:long,item:string>")
_ARROW = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string())),
    ("longest", pa.struct([("words", pa.int64()), ("start", pa.int64()), ("item", pa.string())])),
])


def _searched(texts: list[bytes | None], blocks: list, shard_bytes: int):
    """Per shard of ``texts``: where it starts and stops, and per text its words, spans, items and longest match.

    ``blocks``: broadcast Suffixes, one of which is held at a time.
    """
    start = 0
    while start < len(texts):
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held + len(texts[stop] or b"") <= shard_bytes):
            held += len(texts[stop] or b"")
            stop += 1
        n = stop - start
        counts, spans, items, longest = [0] * n, [[] for _ in range(n)], [set() for _ in range(n)], [(0, 0, "")] * n
        for block in blocks:
            suffixes = block.value if len(blocks) == 1 else block.load_from_path(block._path)
            counts, own_spans, own_items, own_longest = search_shard(texts[start:stop], suffixes)
            for k in range(n):
                spans[k] += own_spans[k]
                items[k] |= {suffixes.names[i] for i in own_items[k]}
                words, at, i = own_longest[k]
                if words > longest[k][0]:
                    longest[k] = (words, at, suffixes.names[i])
        yield start, stop, counts, spans, items, longest
        start = stop


def _search(docs: DataFrame, blocks: list, shard_bytes: int) -> DataFrame:
    """Rows of ``_RESULT`` from a pass over ``docs`` (``id``, ``text`` as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = column(b, "id")
            for start, stop, counts, spans, items, longest in _searched(column(b, "text"), blocks, shard_bytes):
                yield batch_of(_ARROW, ids[start:stop], counts,
                               [[{"start": s, "stop": e} for s, e in _merge(x)] for x in spans], [sorted(x) for x in items],
                               [{"words": w, "start": s, "item": i} if w else None for w, s, i in longest])

    return docs.mapInArrow(run, _RESULT)


def _suffix_blocks(benchmark: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int) -> list:
    """The items as broadcast Suffixes, in blocks of about ``block_bytes``."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("binary").alias("text")) \
        .filter("item IS NOT NULL AND octet_length(text) > 0")
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    context, blocks = benchmark.sparkSession.sparkContext, []
    for k in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k)
        blocks.append(context.broadcast(Suffixes([tuple(r) for r in block.collect()], window)))
    return blocks


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, n_words, spans, items, longest`` for each document.

    ``spans`` are the merged word ranges of all maximal matches of a window or
    more, ``items`` the ids (as strings, sorted) whose windows occur, ``longest``
    the longest verbatim match with its place.
    """
    blocks = _suffix_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return _search(rows, blocks, shard_bytes).withColumnRenamed("id", id_col)


def contamination_report(found: DataFrame) -> DataFrame:
    """Digest columns of :func:`find_contamination`'s rows."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("*", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                        shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows without a hit, all columns, in one pass: each row is judged by its own text, whatever its id."""
    blocks = _suffix_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    flat = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = [not i for _, _, _, _, items, _ in _searched(column(b, "text"), blocks, shard_bytes) for i in items]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(clean, pa.bool_()))], names=["row"])

    kept = flat.mapInArrow(run, f"row {flat.schema['row'].dataType.simpleString()}")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
