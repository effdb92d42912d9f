"""Token counts with overlap resynchronisation.

Counts are those of the tokenizer library on the whole text.  A text is cut
into *units* at places where the byte-level pre-tokenizer always splits: a
space after a character that is not white space.  The pre-tokenizer scans left
to right and remembers nothing but its position, so a unit's count does not
depend on its neighbours and repeated units are encoded once per worker.

A huge document is encoded in overlapping chunks.  Each chunk yields boundary
offsets with running token counts; two neighbours are spliced at an offset
that both hold, away from the end of the first (where its scan may have been
cut).  From such an offset on, both scans are the scan of the whole text.  If
there is none, the overlap doubles, at the limit back to the last splice.  A
scan that goes back there takes a chunk four times as long, so a text without any
boundary is read a bounded number of times over, whatever its length.

Cutting is right only for a tokenizer that splits as above: byte level with its
own splitting rule, no normaliser, added strings shorter than the margin.  Any
other file's texts are encoded whole.

Defined cases: a null or empty text has 0 tokens; every input row gives one
row, repeated rows included; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, column

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
MAX_UNIT_CHARS = 2_048
MAX_MEMO = 500_000
#: A scan may be wrong this close to the end of its chunk: the longest special string plus look-ahead.
END_MARGIN = 16
# White space by any library's definition: more of these only makes units longer.
_BLANK = r"[\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2028\u2029\u2060\ufeff]"
_SPACED = re.compile(f"{_BLANK} ")
_BLANK_END = re.compile(f"{_BLANK}\\Z")


class UnitCounts(dict):
    """Token count of ``' ' + piece`` for pieces seen so far; a bounded cache."""

    def __init__(self, tokenizer, prefix: str = " "):
        super().__init__()
        self.tokenizer, self.prefix = tokenizer, prefix

    def __missing__(self, piece: str) -> int:
        if len(self) >= MAX_MEMO:
            self.clear()
        n = len(self.tokenizer.encode(self.prefix + piece, add_special_tokens=False))
        if len(piece) <= 64:
            self[piece] = n
        return n


def splits_at_spaces(tokenizer) -> bool:
    """Whether the module's cuts hold for ``tokenizer``: read from its definition."""
    spec = json.loads(tokenizer.to_str())
    split = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    return (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and all(len(t["content"]) < END_MARGIN and " " not in t["content"] and not t["lstrip"] and not t["rstrip"]
                    and not t["single_word"] for t in added))


class Encoder:
    def __init__(self, tokenizer):
        # a file may ask for truncation or padding; counts are those of the whole text
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer, self.cuts = tokenizer, splits_at_spaces(tokenizer)
        self.after_space, self.bare = UnitCounts(tokenizer), UnitCounts(tokenizer, "")

    def units(self, text: str) -> list[str]:
        """Units of ``text``; all but the first start with white space."""
        first, *rest = text.split(" ")
        out = [first]
        for p in rest:
            if _BLANK_END.search(out[-1]):
                out[-1] += " " + p
            else:
                out.append(" " + p)
        return out

    def count(self, text: str) -> int:
        if not _SPACED.search(text):
            first, *rest = text.split(" ")
            return (self.bare[first] if first else 0) + sum(map(self.after_space.__getitem__, rest))
        return sum(map(self._unit, self.units(text)))

    def _unit(self, unit: str) -> int:
        return 0 if not unit else self.after_space[unit[1:]] if unit[0] == " " else self.bare[unit]

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Offsets at which the scan of ``text`` splits, with the tokens before each; the last is the end."""
        at, before, pos, n = [], [], 0, 0
        for unit in self.units(text):
            if len(unit) > MAX_UNIT_CHARS:
                enc = self.tokenizer.encode(unit, add_special_tokens=False)
                words = np.array([-1 if w is None else w for w in enc.word_ids], np.int64)
                firsts = np.flatnonzero((words < 0) | (words != np.concatenate(([-2], words[:-1])))).tolist()
                at += [pos + enc.token_to_chars(i)[0] for i in firsts]
                before += [n + i for i in firsts]
                n += len(enc)
            else:
                at.append(pos)
                before.append(n)
                n += self._unit(unit)
            pos += len(unit)
        return np.array([*at, pos], np.int64), np.array([*before, n], np.int64)

    def spliced(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
        """Token count of a long text from overlapping chunks."""
        start, end, total, step = 0, min(chunk, len(text)), 0, chunk
        at, before = self.boundaries(text[:end])
        while end < len(text):
            # an overlap can align only if it holds a boundary of the scan so far
            held = at[(at > start) & (at <= end - END_MARGIN)]
            width = max(overlap, end - int(held[-1])) if held.size else end - start
            while True:
                new_start = max(start, end - width)
                if new_start == start:
                    step *= 4
                new_end = min(len(text), end + step)
                new_at, new_before = self.boundaries(text[new_start:new_end])
                new_at = new_at + new_start
                if new_start == start:  # reaches the last splice: this scan replaces the former one
                    at, before = new_at, new_before
                    break
                common = np.intersect1d(held, new_at)
                if common.size:
                    p, step = common[-1], chunk
                    total += int(before[np.searchsorted(at, p)] - before[0])
                    k = int(np.searchsorted(new_at, p))
                    at, before, start = new_at[k:], new_before[k:], int(p)
                    break
                width *= 2
            end = new_end
        return total + int(before[-1] - before[0])

    def tokens(self, text: str | None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        return self.count(text) if len(text) <= chunk else self.spliced(text, chunk, overlap)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once per process."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _ENCODERS[path] = Encoder(Tokenizer.from_file(path))
    return _ENCODERS[path]


def public_path(name: str) -> Callable[[], str]:
    def resolve() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)
    return resolve


def count_tokens(docs: DataFrame, tokenizer: str | Callable[[], str], id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for each row; ``tokenizer`` is a path or a function that finds it on a worker."""
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer if isinstance(tokenizer, str) else tokenizer())
        for b in batches:
            yield batch_of(schema, b.column(0), b.column(1), [enc.tokens(t, chunk, overlap) for t in column(b, "text")])

    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
