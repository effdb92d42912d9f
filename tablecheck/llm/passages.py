"""Substring dedup by hashing lines, cut at punctuation.

Units are lines, cut further at content-defined places: a cut between two words
depends only on the ``REACH`` words to either side of it.  Each gap between
words ranks by its punctuation (sentence end, then comma, colon or semicolon,
then none) and by a hash of the words beside it; a gap that ranks above all
others within reach is a cut, and so is each line end.  Two copies of a passage
thus have the same cuts wherever they begin or end, with or without
punctuation, but for about a unit at each edge, which stays.

From each unit on, the units up to ``min_words`` words or more are one window.
It is normalised (words only, A-Z lower-cased), hashed, and grouped over all
documents; its earliest occurrence (least id) stays.  A unit goes if a window
over it stands in an earlier document, or earlier in the same text without
overlap.  So whatever is removed lies in a run of ``min_words`` words that one
other place holds as a whole; sentences that texts share by chance stay.  What
is kept keeps its offsets in the original text.

Texts are cut and hashed once; the outline (unit starts, window digests) is
written with a row number.  Least and greatest id per digest combine map-side,
so a window found everywhere costs a row per task.  The digests found in two
documents are joined back by a plain equi-join (adaptive execution splits hot
digests) and gathered per row: no list is longer than the row's own outline.

Defined cases: null and empty texts have no units and are returned as they are;
a null id ranks after all others, and rows without an id do not count as
earlier than each other; rows that share an id are one document in the ranking,
and each is cut by the same rule; every input row gives one row; very long texts
need memory in proportion; other columns, of whatever name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialise
from .lines import NO_ID
from .minhash import _mix

MIN_WORDS = 20
#: Words from one cut to the next, line ends aside, are more than this.
REACH = 3
HASHED_WORDS = 1 << 16
_LINE_END, _STOP, _PAUSE = 3, 2, 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b == 95 or b >= 128 for b in range(256)])
_WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_MARK = np.zeros(256, np.uint8)  # of the character before white space
_MARK[list(b".!?")], _MARK[list(b",;:")] = _STOP, _PAUSE


class _Powers:
    """Powers of an odd number modulo 2^64, and of its inverse, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F)


def _ranges(values: np.ndarray, first: np.ndarray, last: np.ndarray, powers: _Powers) -> np.ndarray:
    """Hash of ``values[first:last]`` for each pair, the same wherever the values stand."""
    up, down = powers.to(len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)])])
    return _mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * _ODD)


def outline(text: bytes, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the units in bytes, and for each window (the k-th starts at unit k) its digest and the unit after it."""
    none = np.zeros(0, np.int64)
    b = np.frombuffer(text.translate(_LOWER), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], _IN_WORD[b], [False]])))
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return np.zeros(1 if text else 0, np.int64), none, none
    hashes = []
    for k in range(0, n, HASHED_WORDS):
        s, e = starts[k:k + HASHED_WORDS], ends[k:k + HASHED_WORDS]
        hashes.append(_ranges(b[s[0]:e[-1]].astype(np.uint64) + np.uint64(1), s - s[0], e - s[0], _BYTES))
    h = np.concatenate(hashes)
    # rank of the gap before each word and of the text's end: punctuation, then a hash of the words beside it
    level = np.zeros(len(b), np.uint8)
    level[1:] = np.where(_WHITE[b[1:]], _MARK[b[:-1]], 0)
    level[b == 10] = _LINE_END
    rank = np.zeros(n + 2 * REACH + 1, np.uint64)
    own = rank[REACH:REACH + n + 1]
    own[0] = own[n] = np.uint64(_LINE_END << 62)
    if n > 1:
        gaps = np.maximum.reduceat(level, np.column_stack([ends[:-1], starts[1:]]).ravel())[::2]
        own[1:n] = (_mix(h[:-1] * _ODD + h[1:]) >> np.uint64(2)) + (gaps.astype(np.uint64) << np.uint64(62))
    before = np.maximum.reduce([rank[k:k + n + 1] for k in range(REACH)])
    after = np.maximum.reduce([rank[k:k + n + 1] for k in range(REACH + 1, 2 * REACH + 1)])
    cuts = np.flatnonzero((own > before) & (own >= after) | (own >= np.uint64(_LINE_END << 62)))
    unit_starts = starts[cuts[:-1]]
    unit_starts[0] = 0
    stop = np.searchsorted(cuts, cuts[:-1] + min_words)
    stop = stop[stop < len(cuts)]
    return unit_starts, _ranges(h, cuts[:len(stop)], cuts[stop], _WORDS).view(np.int64), stop


def repeated_within(digests: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The windows of a text that stand earlier in it, without overlap."""
    _, first, which = np.unique(digests, return_index=True, return_inverse=True)
    return np.flatnonzero(stops[first[which]] <= np.arange(len(digests)))


def outlines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``row, id, text, starts, digests, stops, again`` of each row of ``docs``, written."""
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())

    def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *arrays]).astype(kind.value_type.to_pandas_dtype())
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [outline(t or b"", min_words) for t in b.column(1).to_pylist()]
            again = [repeated_within(d, s) for _, d, s in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), lists([f[0] for f in found], ints), lists([f[1] for f in found], longs),
                 lists([f[2] for f in found], ints), lists(again, ints)], names=["id", "text", "starts", "digests", "stops", "again"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    found = rows.mapInArrow(run, "id long, text binary, starts array<int>, digests array<long>, stops array<int>, again array<int>")
    return materialise(found.select(F.monotonically_increasing_id().alias("row"), "*"), "outlines", "zstd")


def repeated_windows(found: DataFrame) -> DataFrame:
    """``row, lost``: for each row its windows that an earlier document holds, with that document's id."""
    keys = found.select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), F.posexplode("digests").alias("window", "digest"))
    shared = keys.groupBy("digest").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).filter("first_id <> last_id")
    lost = keys.join(shared.select("digest", "first_id"), "digest").filter("id <> first_id")
    return lost.groupBy("row").agg(F.collect_list(F.struct("window", "first_id")).alias("lost"))


_SPANS = "array<struct<start:long,stop:long>>"


def _runs(chosen: np.ndarray, starts: np.ndarray, end: int) -> list[tuple[int, int]]:
    """Spans of the runs of chosen units."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], chosen, [False]])))
    at = np.append(starts, end)
    return [(int(at[a]), int(at[z])) for a, z in zip(edges[::2], edges[1::2])]


def cut(text: bytes, starts: np.ndarray, stops: np.ndarray, windows: np.ndarray) -> tuple[bytes, np.ndarray, list, list]:
    """What is left of a text without the units of ``windows``, the units that go, and kept and removed spans in characters."""
    marks = np.zeros(len(starts) + 1, np.int64)
    np.add.at(marks, windows, 1)
    np.add.at(marks, stops[windows], -1)
    gone = np.cumsum(marks)[:-1] > 0
    kept, removed = _runs(~gone, starts, len(text)), _runs(gone, starts, len(text))
    place = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    spans = [[{"start": int(place[a]), "stop": int(place[z])} for a, z in runs] for runs in (kept, removed)]
    return b"".join(text[a:z] for a, z in kept), gone, *spans


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``id, text, n_units, n_removed, kept, removed, kept_by`` for each row.

    ``text`` is what stays; ``kept`` and ``removed`` are spans of characters in
    the original; ``kept_by`` the ids that hold what was removed (its own for repeats inside one text).
    """
    found = outlines(docs, id_col, text_col, min_words)
    joined = found.drop("digests").join(repeated_windows(found), "row", "left").select("id", "text", "starts", "stops", "again", "lost")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("text", pa.binary()), ("n_units", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", span), ("removed", span), ("kept_by", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t, starts, stops, again, lost in zip(*[column(b, c) for c in ("id", "text", "starts", "stops", "again", "lost")]):
                if not lost and not again:
                    whole = [{"start": 0, "stop": len(t.decode("utf-8", "replace"))}] if t else []
                    out.append((t, len(starts), 0, whole, [], []))
                    continue
                windows = np.array([*again, *(x["window"] for x in lost or ())], np.int64)
                left, gone, kept, removed = cut(t, np.array(starts), np.array(stops), windows)
                sources = {x["first_id"] for x in lost or ()} | ({i} if again else set())
                out.append((left, len(starts), int(gone.sum()), kept, removed, sorted(sources - {None})))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in out], schema.field(k + 1).type) for k in range(6)]],
                                             schema=schema)

    out = joined.mapInArrow(run, f"id long, text binary, n_units long, n_removed long, kept {_SPANS}, removed {_SPANS}, "
                                 "kept_by array<long>")
    return out.withColumn("text", F.col("text").cast("string")).withColumnsRenamed({"id": id_col, "text": text_col})
