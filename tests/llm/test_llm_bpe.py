import hashlib
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from tokenizers import Tokenizer

from llm_fixtures import awkward, awkward_rows, empty, sorted_rows
from tablecheck.llm import prefixbpe as B
from tablecheck.llm.queries import op11_bpe_codec
from tablecheck.llm.tokens import public_path

PATH = public_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def known():
    return B.Pieces(B.Vocabulary(PATH()))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH())


def test_fuzzed_texts_equal_the_library(known, library, monkeypatch):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'ll", "'", "1", "é", "́", "<|endoftext|>", "<|startoftext|>", "<|end", "|>", "!", "#",
             "\t", "\xa0", "日", "​", "\x1f", "\x00", "the", "ing", "Σ", "ς", "İ", "ß", "x", "!!!!", "aaaa", "　", "٣", "½",
             "ﬁ", "😀", "🏽", "﻿", "th", "er", "on", "hahaha", "᠎"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    monkeypatch.setattr(B, "MAX_PIECES", 50)  # the caches are emptied on the way
    monkeypatch.setattr(B, "MAX_WORDS", 20)
    monkeypatch.setattr(B, "MAX_PAIRS", 30)
    monkeypatch.setattr(B, "MAX_STEPS", 40)
    for k in range(0, len(texts), 5):
        offsets, flat = known.encode([t.encode() for t in texts[k:k + 5]])
        for t, a, z in zip(texts[k:k + 5], offsets, offsets[1:]):
            assert flat[a:z].tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_every_prefix_has_one_last_token(known, library):
    vocabulary = known.vocabulary
    word = "antidisestablishmentarianismsandwhatnot"
    for n in range(1, len(word)):
        ids = vocabulary.encode_word(word[:n])
        assert ids == library.encode(word[:n], add_special_tokens=False).ids
        # of the tokens that end the word, one may follow what stands before it
        state = 0
        for symbol in vocabulary._symbols(word[:n] + "</w>"):
            state = vocabulary.steps[state << 13 | ord(symbol)]
        fits = []
        for token, length in vocabulary.ends[state]:
            assert vocabulary.names[token] == word[n - length:n] + "</w>"
            before = [] if length == n else _inner(vocabulary, word[:n - length])
            if not before or vocabulary.pairs[before[-1] << 32 | token]:
                fits.append(token)
        assert fits == ids[-1:]


def _inner(vocabulary, start):
    """Ids of the inside of a word, by plain merging."""
    ids = [vocabulary.names.index(c) for c in start]
    while True:
        ranked = [(vocabulary.rank[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in vocabulary.rank]
        if not ranked:
            return ids
        _, k = min(ranked)
        ids[k:k + 2] = [vocabulary.names.index(vocabulary.names[ids[k]] + vocabulary.names[ids[k + 1]])]


@pytest.mark.parametrize("unit", ["x", "ab", "lol", "ha", "é", "="])
def test_unbroken_words(known, library, unit):
    text = unit * 20_000
    assert known.encode([text.encode()])[1].tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_of_awkward_rows(spark, library):
    coded = B.decode_bpe(B.encode_bpe(awkward(spark), PATH), PATH)
    want = []
    for r in awkward_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted_rows(coded) == sorted(want, key=repr)
    assert B.decode_bpe(B.encode_bpe(empty(spark), PATH), PATH).count() == 0
    null_ids = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert B.decode_bpe(null_ids, PATH).collect()[0].text == ""


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        B.Vocabulary(public_path("byte_bpe_50k.json")())


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op11_bpe_codec(spark, sf_dir).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(docs) == len(got)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


_GROWTH = """
import random, re
from tablecheck.llm import prefixbpe as B
from tablecheck.llm.tokens import public_path

def mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\\s+([0-9]+)", f.read())[1]) / 1024

before, rng = mb(), random.Random(1)
known = B.pieces(public_path("word_bpe_49k.json")())
print(mb() - before)
for _ in range(60):
    known.encode([" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9))) for _ in range(200)).encode() for _ in range(50)])
print(mb() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from Linux")
def test_a_worker_stays_small(tmp_path):
    script = tmp_path / "growth.py"
    script.write_text(_GROWTH)
    out = subprocess.run([sys.executable, str(script)], env={**os.environ, "PYTHONPATH": str(Path(__file__).parents[2])},
                         capture_output=True, text=True, check=True)
    loaded, full = map(float, out.stdout.split())
    assert loaded < 80 and full < 200


def test_decoding_needs_only_the_names(known):
    assert B.names(PATH()).to_pylist() == known.vocabulary.names
    with pytest.raises(ValueError):
        B.names(public_path("byte_bpe_50k.json")())


def test_cache_is_bounded_by_bytes_and_keeps_what_comes_again(known, library, monkeypatch):
    monkeypatch.setattr(B, "MAX_PIECES", 100)
    rng = random.Random(2)
    cache = B.Pieces(known.vocabulary)
    for k in range(40):
        texts = ["the cat of rome", " ".join(f"w{k}x{j}" for j in range(30)), None, " \t"]
        offsets, flat = cache.encode([t and t.encode() for t in texts])
        for t, a, z in zip(texts, offsets, offsets[1:]):
            assert flat[a:z].tolist() == library.encode(t or "", add_special_tokens=False).ids
        assert {"the", "cat", "of", "rome"} <= set(cache.known.to_pylist()) and len(cache.known) < 100 + 40
    for _ in range(20):
        text = "".join(rng.choices("abcdef", k=5000))
        assert cache.encode([text.encode()])[1].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(cache.known) <= 100 and cache.known.nbytes + cache.coded.nbytes < 100 * B.PIECE_BYTES + 20_000


def test_slices_are_bounded_and_whole():
    batch = B.pa.RecordBatch.from_pydict({"text": [b"ab", None, b"", b"x" * 50, b"cd", b"efg", b"h"]})
    runs = [b.column(0).to_pylist() for b in B._slices(batch, B.pc.binary_length(batch.column(0)), 6)]
    assert runs == [[b"ab", None, b""], [b"x" * 50], [b"cd", b"efg", b"h"]]
    assert list(B._slices(batch.slice(0, 0), B.pc.binary_length(batch.slice(0, 0).column(0)), 6)) == []
