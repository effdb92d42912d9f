import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import sorted_rows
from tablecheck.llm import prefixtrie as P

SCHEMA = "conv_id long, turn long, role string, text string, id long, depth string, x string"


def brute(rows):
    """The trie by plain dictionaries, as rows of the result without the digests."""
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        source = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(turns.get(source, [])[:h] + v[h:])
    members = collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    totals = collections.defaultdict(lambda: [0, 0])
    for k in sorted(members, key=len, reverse=True):
        totals[k][0] += kids[k] == 0
        totals[k][1] += (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        if k:
            totals[k[:-1]][0] += totals[k][0]
            totals[k[:-1]][1] += totals[k][1]
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(k))
        out.append((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], *totals[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed=3, n=60):
    rng = random.Random(seed)
    texts = ["hello", "how", "Été", "", None, "x" * 5000, "yes"]
    rows = []
    for c in range(-7, n):
        if c % 11 == 4:
            continue
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(texts), 1, "c", "z"))
    rows += [(n, None, "user", "null turn first", 1, "c", "z"), (n, None, "user", "another", 1, "c", "z"), (n, 0, "user", "a", 1, "c", "z"),
             (None, 1, "user", "no conversation", 1, "c", "z")]
    rows += [(n + 1, 3, "user", "same", 1, "c", "z")] * 3  # repeated rows
    rows += [(n + 50, t, "user", f"turn {t % 3}", 1, "c", "z") for t in range(200)]  # one long conversation
    rows += [(c, t, "user", "copy", None, None, None) for c in range(1000, 1040) for t in range(10)]  # many copies
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [10_000, 7])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK_TURNS", block)
    monkeypatch.setattr(P, "PIECE_CHARS", 64)
    monkeypatch.setattr(P, "HOT_PARENTS", 8)
    rows = conversations()
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5)).drop("x", "y")
    assert sorted_rows(got) == brute(rows)


def test_no_rows_no_nodes(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", 1, "c", "z")], SCHEMA)).count() == 0


def test_turns_are_numbered_over_tasks(spark):
    rows = [(7, t, "user", str(t)) for t in range(500)] + [(c, t, "user", "x") for c in (1, 9) for t in range(3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = P.numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        hot = got.filter("conv_id = 7")
        assert sorted(r.pos for r in hot.collect()) == list(range(1, 501))
        assert sorted(r.pos for r in got.filter("conv_id = 9").collect()) == [1, 2, 3]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("shape", ["chain", "random", "root only"])
def test_contraction_of_any_tree(spark, shape):
    rng = random.Random(5)
    n = 1 if shape == "root only" else 150
    parent = {0: None}
    for v in range(1, n):
        parent[v] = v - 1 if shape == "chain" else rng.randrange(max(0, v - 9), v)
    kids = collections.Counter(parent.values())
    weight = {v: rng.randint(0, 50) for v in parent}
    want = dict(weight)
    for v in sorted(parent, reverse=True):
        if parent[v] is not None:
            want[parent[v]] += want[v]
    nodes = spark.createDataFrame([(v, p, kids[v], weight[v]) for v, p in parent.items()], "id long, parent long, n_children long, w long")
    assert {r.id: r.w for r in P.subtree_sums(nodes, ["w"]).collect()} == want


def test_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE_CHARS", 160)
    ends = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("conv_id")).repartition(4)
    got = {r.k: r.ends_sha256 for r in P.end_hashes(ends, ["k"]).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, range(k, 5000, 3))).encode()).hexdigest() for k in range(3)}
