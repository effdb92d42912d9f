import collections
import math
import random
import re

import numpy as np
import pytest

from llm_fixtures import awkward, awkward_rows, empty
from tablecheck.llm import maskrank as M

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [(1, "w1 w2 w3 W3 Été"), (2, "the end the end of w7"), (3, None), (4, ""), (5, "nothing-matches qqq"), (1, "w4 w5"),
         (None, "x" * 50_000), (7, " ".join(f"w{i}" for i in range(0, 300, 3)))]


def terms_of(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """Every document scored for every item, as a list of results per item row."""
    own = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, total = len(own), sum(n for *_, n in own)
    df = collections.Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in own:
            m = 25 + 75 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms_of(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize("block_docs, block_bytes, first", [(8192, M.BLOCK_BYTES, 64), (7, 20_000, 1)])
def test_search_equals_scoring_everything(spark, monkeypatch, block_docs, block_bytes, first):
    monkeypatch.setattr(M, "FIRST_DOCS", first)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = M.search(awkward(spark, n=80), items, block_docs=block_docs, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute([r[:2] for r in awkward_rows(n=80)], ITEMS), key=repr)


def test_no_documents_or_no_items(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert M.search(empty(spark), items).count() == 0
    assert M.search(awkward(spark), items.limit(0)).count() == 0


def test_masks_stop_early_and_lose_nothing():
    rng = np.random.default_rng(4)
    n, vocabulary = 4000, 90  # two words of mask
    held = [np.unique(rng.zipf(1.3, 40) % vocabulary) for _ in range(n)]
    for k in range(0, 30):
        held[k] = np.arange(60 + k)  # a few documents match much more
    lengths = np.array([len(h) for h in held])
    terms = np.concatenate(held).astype(np.int64)
    counts = rng.integers(1, 4, len(terms))
    size = np.add.reduceat(counts, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    block = M.Block(np.arange(n) // 2, size, lengths, terms, counts, n, int(size.sum()))  # ids repeat: ties
    weight = rng.integers(0, 900, vocabulary)
    own = np.arange(vocabulary)
    best = M.Best(10)
    scored = M.evaluate(block, own, weight, weight, best)
    whole = block.scores(np.arange(n), weight)
    order = np.lexsort((block.ids, -whole))[:10]
    assert best.scores.tolist() == whole[order].tolist() and best.ids.tolist() == block.ids[order].tolist()
    assert scored < n // 2
    masks, docs, ranges, _ = block.masks(own)
    assert sorted(docs.tolist()) == list(range(n)) and len(masks) == len(ranges) - 1 == len({tuple(h) for h in held})


def test_equal_scores_rank_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in random.Random(2).sample(range(1000), 60)] + [(None, "same words here")],
                                 "doc_id long, text string")
    more = docs.union(spark.createDataFrame([(2000 + i, "unlike") for i in range(100)], "doc_id long, text string"))
    got = M.search(more.repartition(7), spark.createDataFrame([(1, "words other")], "item_id long, text string"))
    ids = sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)[:10]
    assert [(r["rank"], r.doc_id) for r in got.orderBy("rank").collect()] == list(zip(range(1, 11), ids))
