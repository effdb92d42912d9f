import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import SCHEMA, awkward, awkward_rows, empty, sorted_rows
from tablecheck.llm import boosting, divergence, factorization, queries, suffix

SF = "/root/testdata/sf0.01"


def brute_hits(rows, items, window=10):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return word.findall((t or "").encode().lower())

    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        if w and item is not None:
            k = min(window, len(w))
            for i in range(len(w) - k + 1):
                windows[tuple(w[i:i + k])].add(str(item))
    out = []
    for r in rows:
        w, hit, found = words(r[1]), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    found |= windows[tuple(w[i:i + k])]
                    hit |= set(range(i, i + k))
        out.append((r[0], len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def test_decontamination(spark):
    rows = awkward_rows()
    long = rows[0][1].replace("\n", " ").split(" ")
    items = [(1, " ".join(long[-40:])), (2, "w1"), (3, None), (4, ""), (5, "..."), (None, "w2 w3"), (6, "nowhere to be found at all"),
             (7, "Shared Line number one here"), (7, "the end the end the end the end the end the end the end")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (suffix.BLOCK_BYTES, 40):  # one block, many blocks
        found = suffix.contamination_report(suffix.find_contamination(awkward(spark), bench, block_bytes=size, shard_bytes=3000))
        got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()), key=repr)
        assert got == brute_hits(rows, items)
    clean = suffix.remove_contaminated(awkward(spark), bench)
    kept = [r for r in rows if not brute_hits([r], items)[0][2]]
    assert len(kept) < len(rows) and sorted(map(repr, map(tuple, clean.collect()))) == sorted(map(repr, kept))


def test_rows_without_id_are_judged_by_their_own_text(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(None, f"text {i} of its own", i) for i in range(30)] + [(None, f"so {passage} so", 99), (7, passage, 98), (7, "clean", 97)],
                                 "doc_id long, text string, row long")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert sorted(r["row"] for r in suffix.remove_contaminated(docs, bench).collect()) == [*range(30), 97]


def test_decontamination_empty(spark):
    bench = spark.createDataFrame([(1, "some text of a benchmark")], "item_id long, text string")
    assert suffix.find_contamination(empty(spark), bench).count() == 0
    none = suffix.find_contamination(awkward(spark), bench.limit(0))
    assert none.count() == len(awkward_rows()) and none.filter("size(items) > 0").count() == 0


def test_longest_match_is_verbatim(spark):
    docs = spark.createDataFrame([(1, "zero a b c d e f g h i j k l m zero"), (2, "a b c d e f g h i")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "x a b c d e f g h i j k l y")], "item_id long, text string")
    got = {r["doc_id"]: r for r in suffix.find_contamination(docs, bench).collect()}
    assert tuple(got[1]["longest"]) == (12, 1, "9") and got[2]["longest"] is None


def test_quality_rules(spark):
    rows = awkward_rows()
    got = {}
    for r in divergence.judge(awkward(spark)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r in rows:
        t = r[1] or ""
        w = word.findall(t)
        grams = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
        held = [x for x in t.split("\n") if word.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        g = got[r[0]].pop()
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(held) - len(set(held)), len(covered), failed)
        assert not (failed and g["kept"])
    assert divergence.judge(empty(spark)).count() == 0


def test_distance_is_jensen_shannon(spark):
    counts, ref = [3.0, 0.0, 1.0], [0.5, 0.5, 0.0]
    df = spark.createDataFrame([(counts, 4.0), ([0.0, 0.0, 0.0], 0.0)], "h array<double>, t double")
    p, q = np.array(counts) / 4, np.array(ref)
    m = (p + q) / 2
    kl = sum(x * np.log2(x / y) for x, y in zip(p, m) if x) + sum(x * np.log2(x / y) for x, y in zip(q, m) if x)
    got = [r[0] for r in df.select(divergence.distance("h", "t", ref)).collect()]
    assert abs(got[0] - np.sqrt(kl / 2)) < 1e-12 and got[1] == 1.0


def test_quality_rules_stay_in_the_jvm(spark):
    plan = queries.op4_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _held_out_accuracy(spark, out, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").select("doc_id", "predicted", label).collect()
    assert all(zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows)
    return sum(r[1] == r[2] for r in rows) / len(rows)


def test_quality_held_out(spark):
    assert _held_out_accuracy(spark, queries.op3_quality(spark, SF), "quality") >= 0.97


def test_toxicity_held_out(spark):
    assert _held_out_accuracy(spark, queries.op9_toxicity(spark, SF), "toxic") >= 0.93


def test_classifiers_take_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)] + [(None, 1, 1), (5, None, None), (9999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for f in (boosting.classify_quality, factorization.classify_toxicity):
        got = f(awkward(spark), labels).collect()
        assert len(got) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in got)
        assert f(empty(spark), labels).count() == 0
        assert len({r["score"] for r in f(awkward(spark), labels.limit(0)).collect()}) == 1
    scored = boosting.score_quality(awkward(spark), boosting.fit_quality(awkward(spark), labels))
    assert scored.columns.count("score") == 1 and "words" in scored.columns


def test_trees_flattened_walk_equals_recursion():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(boosting.STATISTICS)))
    y = ((x[:, 3] > 0.2) ^ (x[:, 5] > 0)).astype(float)
    model = boosting.fit_trees(x, y, n_trees=20, depth=3)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95

    def walk(tree, row):
        k = 0
        for _ in range(model.depth):
            f = model.feature[tree, k]
            k = 2 * k + 1 + (f >= 0 and row[f] > model.cut[tree, k])
        return model.value[tree, k - (2**model.depth - 1)]

    want = [model.base + sum(walk(t, row) for t in range(len(model.feature))) for row in x[:20]]
    assert np.allclose(model.margin(x[:20]), want)


def test_pairs_of_terms_count():
    """The label is an insult beside a group, neither alone: no additive model separates it."""
    rng = np.random.default_rng(4)
    texts, y = [], []
    for _ in range(600):
        a, b = rng.random(2) < 0.5
        filler = " ".join(f"f{k}" for k in rng.integers(0, 50, 6))
        texts.append(f"{'insult ' if a else 'calm '}{'group ' if b else 'thing '}x")
        texts[-1] += "" if not filler else ""
        y.append(float(a == b))
    rows = [factorization.terms(t) for t in texts]
    old, factorization.MIN_Z = factorization.MIN_Z, 0.0
    try:
        model = factorization.fit_machine(rows, np.array(y), epochs=60)
    finally:
        factorization.MIN_Z = old
    assert ((model.scores(rows) >= 0.5) == np.array(y)).mean() > 0.95


def test_training_leaves_held_out_labels_alone(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = sorted_rows(boosting.classify_quality(docs, labels))
    assert a == sorted_rows(boosting.classify_quality(docs, flipped))
    assert SCHEMA
