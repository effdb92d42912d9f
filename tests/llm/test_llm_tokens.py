import random
import re

import pytest

from llm_fixtures import awkward, awkward_rows, empty, sorted_rows
from tablecheck.llm import tokens as T


@pytest.fixture(scope="module")
def enc():
    return T.encoder(T.public_path("byte_bpe_50k.json")())


def whole(enc, text):
    return len(enc.tokenizer.encode(text or "", add_special_tokens=False))


def test_counts_and_splices_match_the_library(enc, monkeypatch):
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "1", "é", "<|endoftext|>", "<|end", "|>", "!", "#", "\t", " ", "日", "​",
             "\x1f", "the ", "x", "  \n", " 　"]
    for _ in range(800):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))
        n = whole(enc, text)
        assert enc.tokens(text) == n, text
        monkeypatch.setattr(T, "MAX_UNIT_CHARS", rng.choice([3, 10, 2048]))
        if len(text) > 40:
            assert enc.spliced(text, 40, rng.choice([2, 8, 20])) == n, text


def test_overlap_widens_when_nothing_aligns(enc):
    text = "x" * 5000 + " and " + "=" * 300 + "\n" * 50 + "é" * 700  # long runs without a boundary
    assert enc.spliced(text, 100, 10) == whole(enc, text)


def test_a_text_without_boundaries_is_read_a_bounded_number_of_times(enc, monkeypatch):
    read = []
    scan = T.Encoder.boundaries
    monkeypatch.setattr(T.Encoder, "boundaries", lambda self, t: read.append(len(t)) or scan(self, t))
    for text in ["ab" * 100_000, "one two " * 2_000 + "x" * 150_000 + " three" * 5_000, "=" * 90_000 + " é" * 9_000]:
        read.clear()
        assert enc.spliced(text, 1_000, 50) == whole(enc, text)
        assert sum(read) < 6 * len(text)


def test_a_tokenizer_that_splits_otherwise_encodes_whole():
    import public_tokenizers

    other = T.encoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ["a  b c1234 " * 30, "x" * 300 + "\n\n y", "Été  naïve <|endoftext|> z"]:
        n = len(other.tokenizer.encode(text, add_special_tokens=False))
        assert other.tokens(text, 40, 8) == n


def test_awkward_rows(spark, enc):
    got = sorted_rows(T.count_tokens(awkward(spark), T.public_path("byte_bpe_50k.json")))
    want = sorted(((r[0], len((r[1] or "").encode()), whole(enc, r[1]), whole(enc, r[1]) > 512) for r in awkward_rows()), key=repr)
    assert got == want
    assert T.count_tokens(empty(spark), T.public_path("byte_bpe_50k.json")).count() == 0


def test_boundaries_are_places_where_counts_add_up(enc):
    text = "One two,  three\n four <|endoftext|> five"
    at, before = enc.boundaries(text)
    assert at[-1] == len(text) and before[-1] == whole(enc, text)
    for p, n in zip(at, before):
        assert whole(enc, text[:p]) == n and whole(enc, text[p:]) == before[-1] - n
    assert re.fullmatch(r"[\s\S]*", text)
