import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SCHEMA, awkward, awkward_rows, empty, sorted_rows
from tablecheck.llm import lines, minhash, passages

BIG = 2**63 - 1


def brute_lines(rows, min_docs=2, min_chars=10):
    white = " \t\n\x0b\x0c\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(white))

    held = collections.defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            held[key(line)].add(BIG if r[0] is None else r[0])
    out = []
    for r in rows:
        own = (r[1] or "").split("\n")
        mine = BIG if r[0] is None else r[0]
        kept = [x for x in own if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or min(held[key(x)]) == mine]
        text = r[1] if len(kept) == len(own) else "\n".join(kept)
        out.append((r[0], text, len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs", [2, 4])
def test_line_dedup(spark, min_docs):
    out = lines.dedup_lines(awkward(spark), min_docs=min_docs)
    assert sorted_rows(out.select("doc_id", "text", "n_lines", "n_dropped")) == brute_lines(awkward_rows(), min_docs)
    assert "words" in out.columns and out.columns.count("n_lines") == 1


def test_line_dedup_null_and_repeated_ids(spark):
    """A third of the ids null, a third the same: lists stay those of one text."""
    rows = [((None, 7, i)[i % 3], "\n".join([f"line of group {i % 10} here", f"line of row {i} alone", "a line that all hold"]))
            for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = lines.dedup_lines(docs)
    assert sorted_rows(out.select("doc_id", "text", "n_lines", "n_dropped")) == brute_lines(rows)
    assert lines.shared_lines(docs).selectExpr("max(size(digests))").first()[0] <= 3


def test_line_dedup_empty(spark):
    assert lines.dedup_lines(empty(spark)).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_near(rows):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), BIG), r[0])
    out = []
    for i, r in enumerate(rows):
        c = least.get(find(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), c, r[0] == c))
    return sorted(out, key=repr)


def near_rows():
    """Chains, copies and very short texts beside the awkward rows."""
    rows = awkward_rows(n=25)
    base = [f"t{i}" for i in range(60)]
    for step in range(8):  # each differs from the next by a few words: ends are linked only through the chain
        words = list(base)
        for k in range(step):
            words[7 * k + 3] = f"edit{k}"
        rows.append((200 + step, " ".join(words), "en", "s", 1, 1, "c", "s", "n"))
    rows += [(300, "one two", "en", "s", 1, 1, "c", "s", "n"), (301, "One  two\n", "en", "s", 1, 1, "c", "s", "n")]
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted_rows(minhash.near_duplicates(docs)) == brute_near(rows)


def test_near_duplicates_drop(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r[0] for r in out.filter("doc_id IS NOT NULL").collect()) == sorted({r[0] for r in brute_near(rows) if r[3] and r[0] is not None})


def test_near_duplicates_drop_keeps_one_text_of_each_group(spark):
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(1, text("a")), (2, text("a") + " more"), (2, text("b")), (None, text("c")), (None, text("d")), (None, text("c") + " more"),
            (None, text("a")), (3, text("e")), (3, text("e").upper()), (4, None), (4, " "), (None, ""), (5, ""), (5, "")]
    out = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sum(not (r["text"] or "").strip() for r in out) == 5
    kept = [(r["doc_id"], r["text"].lower()) for r in out if (r["text"] or "").strip()]
    c = {(None, text("c")), (None, text("c") + " more")} & set(kept)
    assert len(c) == 1 and sorted(set(kept) - c, key=repr) == sorted([(1, text("a")), (2, text("b")), (None, text("d")), (3, text("e"))], key=repr)
    assert len(kept) == 5


def family_rows(n=80, words=600):
    """Texts of one template, far from each other, and a pair that lacks the same parts: alike, but never central."""
    rng = random.Random(3)
    edits = [rng.sample(range(10, words - 10, 5), 12) for _ in range(n)]
    edits += [[20 + 35 * j for j in range(16)]] * 2
    rows = []
    for k, places in enumerate(edits):
        text = [f"t{i}" for i in range(words)]
        for place in places:
            text[place] = f"own{k}x{place}"
        rows.append((k, " ".join(text), "en", "s", 1, 1, "c", "s", "n"))
    return rows


@pytest.mark.parametrize("holders,rounds", [(1000, 3), (7, 3), (7, 1)])
def test_near_duplicates_in_a_template_family(spark, monkeypatch, holders, rounds):
    monkeypatch.setattr(minhash, "HOLDERS", holders)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", rounds)
    rows = family_rows()
    want = brute_near(rows)
    assert [r[0] for r in want if r[2] != r[0]] == [81]
    assert sorted_rows(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want


@pytest.mark.parametrize("rounds", [1, 2])
def test_few_star_rounds_lose_no_link(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "STAR_ROUNDS", rounds)
    rows = near_rows()
    assert sorted_rows(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute_near(rows)


def test_blocks_of_an_open_bucket_meet_once_and_are_bounded(spark):
    holders = 20
    rows = [(bucket, f"{bucket}-{k}".encode(), 100 + k % 5, b"main" if k < main else f"c{k // 3}".encode())
            for bucket, n, main in ((1, 130, 90), (2, 2, 1), (3, 90, 0)) for k in range(n)]
    rows.append((1, b"small", 20, b"main"))  # too small for any of the rest
    dealt = minhash._dealt(spark.createDataFrame(rows, "bucket long, node binary, n long, component binary"), 75, holders).collect()
    groups = collections.defaultdict(list)
    for r in dealt:
        groups[(r["bucket"], r["kind"], r["low"], r["high"])].append(r)
    met = collections.Counter()
    for (bucket, kind, low, high), held in groups.items():
        assert max(collections.Counter(r["side"] for r in held).values()) <= 2 * holders  # dealt by hash: about ``holders``
        for i, a in enumerate(held):
            for b in held[:i]:
                if a["component"] != b["component"] and (a["side"] != b["side"] or kind == 0 and low == high):
                    met[tuple(sorted((bytes(a["node"]), bytes(b["node"]))))] += 1
    want = {tuple(sorted((a[1], b[1]))) for a in rows for b in rows if a[0] == b[0] and a[3] != b[3] and b"small" not in (a[1], b[1])}
    assert set(met) == want and set(met.values()) == {1}


def test_shared_shingles_are_counted_exactly(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(-60, 60, k)) for k in (1, 5, 40, 90, 90)] + [np.array([10**15])]
    want = [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets]
    assert minhash._shared(sets, sets[2:]).tolist() == want
    assert minhash._shared(sets[-1:], sets[:1]).tolist() == [[0]]


def test_near_duplicates_empty(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_densified_signatures_are_unbiased():

    rng = np.random.default_rng(1)
    signer, agree = minhash.Signer(), []
    for _ in range(200):
        pool = rng.integers(0, 2**63, 40, np.uint64)
        a, b = np.unique(pool[:35]), np.unique(pool[5:])  # 30 of 40 shared
        s = signer.signatures([a, b])
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 0.75) < 0.02


def test_components_of_a_long_path(spark):
    n = 200
    edges = spark.createDataFrame([(bytes([i // 256, i % 256]), bytes([(i + 1) // 256, (i + 1) % 256])) for i in range(n)], "a binary, b binary")
    got = minhash.components(edges).collect()
    assert len(got) == n + 1 and {bytes(r[1]) for r in got} == {b"\x00\x00"}


def words_of(text):
    return re.findall(rb"[0-9a-z_\x80-\xff]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


def windows_of(text, size):
    words = words_of(text)
    return [tuple(words[k:k + size]) for k in range(len(words) - size + 1)]


def check_passages(rows, out, size=passages.MIN_WORDS):
    """Against word windows by brute force: what goes stands elsewhere, what two documents share does not stay."""
    holders, within = {}, {}
    for k, r in enumerate(rows):
        own = windows_of(r[1], size)
        for w in set(own):
            holders.setdefault(w, set()).add(BIG if r[0] is None else r[0])
        within[k] = {w for w, n in collections.Counter(own).items() if n > 1}
    for k, (r, o) in enumerate(zip(rows, out)):
        mine = BIG if r[0] is None else r[0]
        assert o["doc_id"] == r[0] and (o["text"] is None) == (r[1] is None)
        assert o["text"] == (r[1] and "".join(r[1][s["start"]:s["stop"]] for s in o["kept"]))
        for s in o["removed"]:
            spans = windows_of(r[1][s["start"]:s["stop"]], size)
            covered = [w for w in spans if min(holders[w]) < mine or w in within[k]]
            assert spans and covered and spans[0] in covered and spans[-1] in covered
    return sum(len(o["removed"]) for o in out)


def test_passages(spark):
    rows = awkward_rows()
    got = passages.dedup_passages(spark.createDataFrame([(k, r[0], r[1]) for k, r in enumerate(rows)], "k long, doc_id long, text string").coalesce(1))
    assert check_passages(rows, got.collect()) > 5  # one task: rows keep their order
    again = passages.dedup_passages(awkward(spark))
    assert sorted_rows(again) == sorted_rows(got)
    assert passages.dedup_passages(empty(spark)).count() == 0


def test_many_null_ids_meet_in_no_group(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(None, f"text {i} {passage}") for i in range(40)] + [(3, f"first {passage}"), (5, f"second {passage}")], "doc_id long, text string")
    found = passages.outlines(docs, "doc_id", "text", 20)
    held = passages.repeated_windows(found).collect()
    assert len(held) == 41 and all(len(r["lost"]) <= 60 for r in held)
    out = passages.dedup_passages(docs).collect()
    assert all((o["n_removed"] == 0) == (o["doc_id"] == 3) for o in out)


def test_units_of_several_documents_are_no_passage(spark):
    parts = [" ".join(f"p{d}x{i}" for i in range(5)) + "." for d in range(4)]
    docs = [(d, f"Text number {d} begins. {p} Then it ends as number {d} does.") for d, p in enumerate(parts)] + [(9, " ".join(parts))]
    out = passages.dedup_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert not any(o["n_removed"] for o in out)


def test_a_pasted_passage_goes_and_offsets_fit(spark):
    passage = " ".join(f"Alpha{i} beta{i} gamma{i} delta{i} epsilon{i}." for i in range(12))
    docs = spark.createDataFrame([(1, f"Own words of the first text. {passage}"), (2, f"Other words begin the second one. {passage}\nAnd its end is here."),
                                  (3, "Clean and alone it stands, this third text.")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in passages.dedup_passages(docs).collect()}
    assert out[1]["n_removed"] == 0 and out[3]["n_removed"] == 0
    assert out[2]["text"] == "Other words begin the second one. And its end is here." and out[2]["kept_by"] == [1]
    span = out[2]["removed"][0]
    source = f"Other words begin the second one. {passage}\nAnd its end is here."
    assert source[span["start"]:span["stop"]].strip() == passage


def shared_windows(texts, size=51):
    """Word windows of the last text that an earlier one holds, by brute force."""
    lists = [[w.lower() for w in re.findall(r"\w+", t)] for t in texts]
    windows = [{tuple(w[i:i + size]) for i in range(len(w) - size + 1)} for w in lists]
    return len(windows[-1] & set().union(*windows[:-1]))


@pytest.mark.parametrize("passage", [
    " ".join(f"word{i}" + "," * (i in (17, 35)) for i in range(54)), " ".join(f"word{i}" for i in range(54)),
    ", ".join(" ".join(f"w{i}x{j}" for j in range(2 + i % 2)) for i in range(24))])
@pytest.mark.parametrize("before", ["", "one", "one, two three", "İ"])
def test_passages_within_sentences_and_lists_go(passage, before):
    first, second = f"We begin here {passage} and go on there.", f"Another text {before} {passage.upper()} ends otherwise now."
    held = set(passages.outline(first.encode())[1].tolist())
    starts, digests, stops = passages.outline(second.encode())
    left, _, _, removed = passages.cut(second.encode(), starts, stops, np.flatnonzero([d in held for d in digests.tolist()]))
    left = left.decode()
    assert removed and shared_windows([first, second]) and not shared_windows([first, left])
    assert left.startswith(f"Another text {before}") and left.endswith("ends otherwise now.")


def test_units_cover_the_text():
    for r in awkward_rows():
        text = (r[1] or "").encode()
        starts, digests, stops = passages.outline(text)
        assert len(digests) == len(stops) <= len(starts) and (not text or starts[0] == 0)
        assert (np.diff(starts) > 0).all()
        for k, z in enumerate(stops):
            assert len(words_of(text[starts[k]:([*starts, len(text)])[z]].decode())) >= passages.MIN_WORDS
