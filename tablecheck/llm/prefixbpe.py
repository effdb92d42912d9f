"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of a symbol sequence and those of its prefixes share all tokens
but the last few: dropping the last token of an encoding gives the encoding of
the shorter prefix.  So one token per prefix says everything.  For each prefix
of a word an automaton of the whole vocabulary names the tokens that are its
suffixes; exactly one of them may follow the last token of the prefix before
it.  Following these last tokens back from the end gives the ids.  Time is
linear in the word, however long it is, since no merge is ever replayed.

Two tokens may be neighbours if no merge across their border would have come
first (`Vocabulary.neighbours`).  In a merge list where a merge always comes
after those that make its parts, a part exists from the rank that makes it to
the rank that uses it up, so the test looks only at the parts that touch the
border: the right spine of one merge tree and the left spine of the other.

Symbols are the bytes of a word, written as the vocabulary's letters; the last
one is a symbol of its own where the vocabulary marks word ends.  What turns text into words
(normaliser, splitting, special strings) is taken from the tokenizer file by
its library; it never looks across white space, so a text is taken a
white-space piece at a time and repeated pieces are worked out once a worker,
as long as its caches hold them.

An executor runs an encoding and a decoding worker for each core, and each
may later serve the other.  So what a worker keeps is bounded: the automaton, one
(left part, right part, rank) for each token, and small caches that start
anew when full.  Rows are taken a slice of bounded size at a time, and what
Arrow no longer uses goes back after each batch.

Defined cases: a null or empty text has no ids and decodes to the empty text;
every input row gives one row, repeated rows and null ids included; very long
texts and unbroken words need memory in proportion to them; other columns, of
whatever name, are not read.
"""

from __future__ import annotations

import array
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PIECES = 250_000
PIECE_BYTES = 64  # times MAX_PIECES: what the cached pieces and their ids may take
BATCH_PIECES = 1024
MAX_PIECE_BYTES = 64
MAX_PAIRS = 200_000
MAX_STEPS = 100_000
SLICE_BYTES = 1 << 22
SLICE_IDS = 1 << 18
MAX_WORDS = 50_000
_NEVER = 1 << 62
# The splitting rule of the word-end vocabularies, and what it comes to in lower-case ASCII.
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 ]+")
_OTHER_SPACE = re.compile("[^\\S ]|\u180e")
_END = 0x1000  # added to the last letter of a word


def _byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: its own, or the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class _Steps(dict):
    """The automaton's moves, as ``state << 13 | symbol``: to the longest vocabulary prefix that ends here; a bounded cache."""

    def __init__(self, edges: dict[int, int], fall: array.array):
        super().__init__()
        self.edges, self.fall = edges, fall

    def __missing__(self, key: int) -> int:
        if len(self) >= MAX_STEPS:
            self.clear()
        state, symbol = key >> 13, key & 8191
        while state and (state << 13 | symbol) not in self.edges:
            state = self.fall[state]
        state = self[key] = self.edges.get(state << 13 | symbol, 0)
        return state


def _automaton(tokens: dict[str, int]) -> tuple[_Steps, list[tuple]]:
    """Moves, and for each state the ``(token, length)`` that end there, longest first."""
    edges: dict[int, int] = {}
    own: list[tuple] = [()]
    parent, letter = array.array("i", [0]), array.array("i", [0])
    for name, token in tokens.items():
        state = 0
        for symbol in map(ord, name):
            after = edges.get(state << 13 | symbol)
            if after is None:
                after = edges[state << 13 | symbol] = len(own)
                own.append(())
                parent.append(state)
                letter.append(symbol)
            state = after
        own[state] = ((token, len(name)),)
    depth = array.array("i", bytes(4 * len(own)))
    for k in range(1, len(own)):
        depth[k] = depth[parent[k]] + 1
    fall, ends = array.array("i", bytes(4 * len(own))), list(own)
    for k in sorted(range(1, len(own)), key=depth.__getitem__):
        state, symbol = parent[k], letter[k]
        while state:
            state = fall[state]
            if (state << 13 | symbol) in edges:
                fall[k] = edges[state << 13 | symbol]
                break
        ends[k] = own[k] + ends[fall[k]] if own[k] else ends[fall[k]]
    return _Steps(edges, fall), ends


class _Pairs(dict):
    """Whether two tokens, as ``a << 32 | b``, may be neighbours; a bounded cache."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.apart = vocabulary.apart

    def __missing__(self, pair: int) -> bool:
        if len(self) >= MAX_PAIRS:
            self.clear()
        known = self[pair] = self.apart(pair >> 32, pair & 0xFFFFFFFF, _NEVER)
        return known


class _Words(dict):
    """Ids of the words seen so far; a bounded cache."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.encode = vocabulary.encode_word

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= MAX_WORDS:
            self.clear()
        ids = self.encode(word)
        if len(word) <= MAX_PIECE_BYTES:
            self[word] = ids
        return ids


def _definition(path: str) -> dict:
    """The tokenizer file, if it is of the kind worked out here."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    steps = json.dumps([spec["pre_tokenizer"], spec["normalizer"]])
    if model["type"] != "BPE" or not plain or "ByteLevel" not in steps or '"add_prefix_space": true' in steps or spec["post_processor"]:
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
    if spec["decoder"] is not None:
        raise ValueError(f"{path}: only tokenizers without a decoder, whose tokens are joined by a space")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: only added tokens that match literally")
    return spec


def _names(spec: dict) -> list[str]:
    """The token of each id; an id between others that no token has is empty."""
    ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    names = [""] * (max(ids.values()) + 1)
    for name, k in ids.items():
        names[k] = name
    return names


class Vocabulary:
    """Tokens, merge trees and the automaton of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = _definition(path)
        model = spec["model"]
        # the library only normalises and splits here, so it needs no tokens
        self.tokenizer = Tokenizer.from_str(json.dumps({**spec, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}))
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        rules = [n.get("pattern") for n in spec["pre_tokenizer"].get("pretokenizers", [])]
        self._lower_words = kinds == ["NFC", "Replace", "Lowercase"] and rules == [{"Regex": _WORD_RULE}, None]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.suffix = model.get("end_of_word_suffix") or ""
        ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # rank of each pair of ids, and what each token was made of
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(merges):
            whole = ids[a + (b[len(model.get("continuing_subword_prefix") or ""):])]
            self.rank[ids[a], ids[b]] = r
            if whole in parts or any(len(self._symbols(t)) > 1 and ids[t] not in parts for t in (a, b)):
                raise ValueError(f"{path}: a merge comes before those of its parts")
            parts[whole] = (ids[a], ids[b], r)
        self.names = _names(spec)
        # what each token was made of, and the rank that used those parts up; a single symbol has no parts
        self.left, self.right, self.made_at = (array.array("i", [-1]) * len(self.names) for _ in range(3))
        real = bytearray(len(self.names))
        self._letters = {chr(b): pre for b, pre in enumerate(_byte_letters())}
        self.pairs, self.words = _Pairs(self), _Words(self)
        tokens: dict[str, int] = {}
        for name, k in sorted(ids.items(), key=lambda x: parts.get(x[1], (0, 0, -1))[2]):
            symbols = self._symbols(name)
            if k in parts:
                a, b, r = parts[k]
                if not (real[a] and real[b] and self.apart(a, b, r)):
                    continue  # never the result of merging its own symbols
                self.left[k], self.right[k], self.made_at[k] = a, b, r
            elif len(symbols) != 1:
                continue
            real[k] = 1
            tokens[symbols] = k
        self.steps, self.ends = _automaton(tokens)

    def _symbols(self, name: str) -> str:
        """A token's name as a string of symbols."""
        if not self.suffix or not name.endswith(self.suffix):
            return name
        own = name[:-len(self.suffix)]
        return own[:-1] + chr(ord(own[-1]) + _END)

    def apart(self, a: int, b: int, until: int) -> bool:
        """No merge across the border of ``a`` and ``b`` comes before rank ``until`` while both its parts are there.

        Of equal ranks the leftmost merge comes first.
        """
        rank, left, right, made_at = self.rank, self.left, self.right, self.made_at
        x, x_until = a, _NEVER
        while x >= 0:
            y, y_until = b, _NEVER
            while y >= 0:
                r = rank.get((x, y))
                if r is not None and r < until and r < x_until and r <= y_until:
                    return False
                y, y_until = left[y], made_at[y]
            x, x_until = right[x], made_at[x]
        return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, given in byte letters: the last token of every prefix, then back from the end."""
        symbols = [*map(ord, word)]
        if self.suffix:
            symbols[-1] += _END
        last = [-1] * (len(symbols) + 1)
        back = [0] * (len(symbols) + 1)
        steps, ends, pairs = self.steps, self.ends, self.pairs
        state = 0
        for at, symbol in enumerate(symbols, 1):
            state = steps[state << 13 | symbol]
            for token, length in ends[state]:
                start = at - length
                if not start or last[start] >= 0 and pairs[last[start] << 32 | token]:
                    last[at], back[at] = token, start
                    break
        out = []
        at = len(symbols)
        while at:
            out.append(last[at])
            at = back[at]
        out.reverse()
        return out

    def _normal(self, text: str) -> str:
        return text if self.tokenizer.normalizer is None else self.tokenizer.normalizer.normalize_str(text)

    def encode_text(self, text: str) -> list[int]:
        """Ids of any text."""
        out: list[int] = []
        for part in self._special.split(text) if self._special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self._normal(part)):
                    out += self.words[word]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of texts without ASCII white space."""
        if not self._lower_words:
            return self._side_by_side([p.decode("utf-8", "replace") for p in pieces])
        out: list = [None] * len(pieces)
        for k, p in enumerate(pieces):
            if p.isascii():
                ids: list[int] = []
                text = p.decode()
                if self._special and self._special.search(text):
                    ids = self.encode_text(text)
                else:
                    for word in _ASCII_WORDS.findall(text.lower()):
                        ids += self.words[word if word.isprintable() else "".join(map(self._letters.__getitem__, word))]
                out[k] = ids
        others = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(others, self._side_by_side([pieces[k].decode("utf-8", "replace") for k in others])):
            out[k] = ids
        return out

    def _side_by_side(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts without ASCII white space, with one space between them for one pass of the library."""
        joined = " ".join(texts)
        if not texts or _OTHER_SPACE.search(joined) or self._special and self._special.search(joined):
            return [self.encode_text(t) for t in texts]
        normal = self._normal(joined)
        starts = np.cumsum([0] + [len(t) + 1 for t in normal.split(" ")])
        if len(starts) != len(texts) + 1:
            return [self.encode_text(t) for t in texts]
        out: list[list[int]] = [[] for _ in texts]
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        owners = np.searchsorted(starts, [start for _, (start, _) in words], "right") - 1
        for k, (word, _) in zip(owners.tolist(), words):
            out[k] += self.words[word]
        return out


class Pieces:
    """Ids of the white-space pieces seen so far, as Arrow arrays; a bounded cache that keeps what came up again."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.reset()

    def reset(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.coded = pa.array([], pa.list_(pa.int32()))
        self.again = np.zeros(0, bool)

    def _fills(self, share: float) -> bool:
        return len(self.known) >= share * MAX_PIECES or self.known.nbytes + self.coded.nbytes >= share * PIECE_BYTES * MAX_PIECES

    def shrink(self) -> None:
        """Only the pieces found in more than one slice stay, or none if these are many."""
        keep = pa.array(self.again)
        self.known, self.coded = self.known.filter(keep), self.coded.filter(keep)
        self.again = np.zeros(len(self.known), bool)
        if self._fills(0.5):
            self.reset()

    def learn(self, new: pa.Array) -> None:
        ids, ends = array.array("i"), array.array("i", [0])
        for k in range(0, len(new), BATCH_PIECES):
            for found in self.vocabulary.encode_pieces(new.slice(k, BATCH_PIECES).cast(pa.large_binary()).to_pylist()):
                ids.extend(found)
                ends.append(len(ids))
        coded = pa.ListArray.from_arrays(pa.array(np.asarray(ends)), pa.array(np.asarray(ids)))
        self.known, self.coded = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.coded, coded])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])

    def encode(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of a list of texts, given as bytes."""
        if self._fills(1):
            self.shrink()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        # white space at either end of a text makes an empty piece, which has no ids
        split = pc.ascii_split_whitespace(texts.fill_null(b"").cast(pa.large_string(), safe=False))
        found = split.flatten().dictionary_encode()
        at = np.array(pc.index_in(found.dictionary, value_set=self.known).fill_null(-1))
        is_new = at < 0
        self.again[at[~is_new]] = True
        at[is_new] = np.arange(len(self.known), len(self.known) + is_new.sum())
        self.learn(found.dictionary.filter(pa.array(is_new)))
        coded = self.coded.take(pa.array(at[found.indices.to_numpy()]))
        return coded.offsets.to_numpy()[split.offsets.to_numpy()], coded.flatten().to_numpy()


_PIECES: dict[str, Pieces] = {}
_NAMES: dict[str, pa.Array] = {}


def pieces(path: str) -> Pieces:
    """The worker's encoder for a tokenizer file, loaded once per process."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(Vocabulary(path))
    return _PIECES[path]


def names(path: str) -> pa.Array:
    """The tokens of a tokenizer file by id, loaded once per process; decoding needs nothing else."""
    if path not in _NAMES:
        _NAMES[path] = pa.array(_names(_definition(path)), pa.large_string())
    return _NAMES[path]


def _slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that come to ``most`` in size, or have one row."""
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def _found(tokenizer: str | Callable[[], str]) -> str:
    return tokenizer if isinstance(tokenizer, str) else tokenizer()


def encode_bpe(docs: DataFrame, tokenizer: str | Callable[[], str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` for each row; ``tokenizer`` is a path or a function that finds it on a worker."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(_found(tokenizer))
        for whole in batches:
            for b in _slices(whole, pc.binary_length(whole.column(1)), SLICE_BYTES):
                offsets, flat = known.encode(b.column(1))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["id", "ids"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {id_type.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode_bpe(encoded: DataFrame, tokenizer: str | Callable[[], str], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, ids, text`` for each row: the tokens of ``ids``, special ones included, joined by a space.

    Null ids are an empty list; an id outside the vocabulary fails.
    """
    id_type = encoded.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = names(_found(tokenizer))
        for whole in batches:
            for b in _slices(whole, pc.list_value_length(whole.column(1)), SLICE_IDS):
                ids = b.column(1)
                flat = ids.flatten()
                lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
                text = pc.binary_join(pa.LargeListArray.from_arrays(offsets, tokens.take(flat)), pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays([b.column(0), ids, text.cast(pa.string())], names=["id", "ids", "text"])
            pa.default_memory_pool().release_unused()

    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, f"id {id_type.simpleString()}, ids array<int>, text string").withColumnRenamed("id", id_col)
