import collections
import html
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import awkward, awkward_rows, empty, sorted_rows
from tablecheck.llm import mixing, template
from tablecheck.llm.common import materialise

SF = "/root/testdata/sf0.001"


def page(i, body, head="<nav><ul><li><a href='/'>Home</a></li></ul></nav>", tail="<footer>&copy; all</footer>"):
    return f"<!DOCTYPE html><html><head><title>T{i}</title><script>var a='</p>';</script></head><body>{head}{body}{tail}</body></html>"


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, key string")
    return {r["page_id"]: r["text"] for r in template.extract_text(df).collect()}


def test_article_without_its_surroundings(spark):
    body = ("<div class='ad'>Buy</div><article><header><h1>Ti&eacute;tle &amp; more</h1></header><p>One <b>bold\n word</b>.<p>Two&nbsp;&lt;3"
            "<aside>Side</aside><form><input><button>Go</button></form><div class='cookie-notice'>Cookies</div>"
            "<ul><li>a<li>b</ul><section id='comments'><p>First!</p></section><!-- x --><style>p{}</style></article>")
    rows = [(i, f"http://h.example/{i}", page(i, body.replace("Two", f"Two{i}")), "x", "y", "z") for i in range(5)]
    got = texts(spark, rows)
    assert got[3] == "Tiétle & more\nOne bold word.\nTwo3 <3\na\nb"


@pytest.mark.parametrize("attrs", ["style='overflow:hidden'", 'aria-hidden="false"', 'title="the hidden city"', 'data-id="share-42"',
                                   "data-class=nav", "data-note='x class=menu'"])
def test_only_exact_attribute_names_count(attrs):
    none = template.read_template(None)
    assert template.main_text(f"<article {attrs}><p {attrs}>Body</p></article>", none) == "Body"
    assert template.main_text("<article><p HIDDEN>a</p><p class=share>b</p><p id='nav'>c</p><p>d</p></article>", none) == "d"


def test_ids_of_titles_inside_main_text_stay():
    page = "<article><h2 id='related-work'>Related work</h2><section id='social-policy'>Policy</section><section id=comments-2>No</section></article>"
    assert template.main_text(page, template.read_template(None)) == "Related work\nPolicy"


def test_template_text_goes_where_there_is_no_article(spark):
    rows = [(i, "http://plain.example/p", page(i, f"<div id=top><span>Welcome to the site</span></div><div id=c><p>Body {i} text</p></div>"),
             None, None, None) for i in range(6)]
    got = texts(spark, rows)
    assert got == {i: f"Body {i} text" for i in range(6)}


def test_template_boxes_inside_articles_go(spark):
    box = "<div class=x1><p>Tell your friends about us</p><div>Every <b>week</b></div></div>"
    rows = [(i, f"http://n.example/{i}", page(i, f"<article><h1>T</h1><div class=body><p>Own {i}</p><p>Always</p>{box}</div></article>"),
             None, None, None) for i in range(4)]
    rows += [(10 + i, "http://n.example/list", page(i, f"<div><p>List</p><p>No {i}</p></div>"), None, None, None) for i in range(20)]
    rows += [(40 + i, "http://same.example/", page(i, "<article><div><p>All the same</p></div></article>"), None, None, None) for i in range(4)]
    got = texts(spark, rows)
    assert {i: got[i] for i in range(4)} == {i: f"T\nOwn {i}\nAlways" for i in range(4)}
    assert {got[10 + i] for i in range(20)} == {f"No {i}" for i in range(20)} and got[41] == "All the same"


def test_awkward_pages(spark):
    rows = [(0, None, None, None, None, None), (1, "", "", None, None, None), (2, "u", "plain words", None, None, None),
            (3, "http://x/", "<article>un<closed", None, None, None), (4, "http://x/", "<p>a < b &amp; c", None, None, None),
            (5, "http://x/", "<!-- never closed <p>x</p>", None, None, None), (6, "http://x/", "<script>never closed <p>x</p>", None, None, None),
            (7, "http://x/", "<article><p>" + "long " * 20000 + "</p></article>", None, None, None), (None, "http://x/", "<p>t</p>", None, None, None),
            (8, "http://x/", "</div></p><p>" + "<div>" * 300 + "deep", None, None, None)]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, key string")
    out = template.extract_text(df).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    got = {r["page_id"]: r["text"] for r in out}
    assert (got[0], got[1], got[2], got[4], got[5], got[6], got[8]) == ("", "", "plain words", "a < b & c", "", "", "deep")
    assert got[7] == ("long " * 20000).strip()
    assert template.extract_text(df.limit(0)).count() == 0


def test_provided_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in template.extract_text(pages).collect()}
    for r in pages.collect():
        m = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", r["html"] or "", re.S)
        parts = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1)>", "\0", m[1])).split("\0") if m else []
        assert got[r["page_id"]] == "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_classes_must_be_ordered_and_nested():
    t = template.read_template([[1, 2, 3], [7, 8]])
    assert template.valid_positions([1, 2, 7, 8, 7, 8, 3], t) == set(range(7))
    assert template.valid_positions([2, 1, 7, 8, 3], t) == {2, 3}
    assert template.valid_positions([1, 7, 2, 8, 3], t) == {0, 2, 4}


def counted(spark, rows):
    return spark.createDataFrame(rows, "source string, n_tokens long")


def test_exponent_meets_the_entropy_or_the_repetition_limit(spark):
    import math

    shares = mixing.source_shares(counted(spark, [("a", 9000), ("b", 900), ("c", 100), ("d", 0)]))
    p = [0.9, 0.09, 0.01]

    def weights(a):
        z = sum(x**a for x in p)
        return [x**a / z for x in p]

    a = mixing.solve_exponent(shares, 0.8, None)
    h = -sum(w * math.log(w) for w in weights(a))
    assert abs(h - 0.8 * math.log(3)) < 1e-4
    b = mixing.solve_exponent(shares, 1.0, 5.0)
    assert abs(max(w / x for w, x in zip(weights(b), p)) - 5.0) < 1e-2
    assert mixing.solve_exponent(shares, None, None) == 1.0
    assert mixing.solve_exponent(shares.limit(1), 0.9, 2.0) == 1.0


@pytest.mark.parametrize("budget", [None, 300, 40_000])
def test_mix_keeps_budgets_and_permutes(spark, budget):
    docs, rows = awkward(spark), awkward_rows()
    out = mixing.mix(docs, budget=budget, block_tokens=200)
    assert out.columns.count("n_lines") == 1 and out.columns[:len(docs.columns)] == docs.columns
    got = out.collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    n = {r[:2]: len(word.findall(r[1] or "")) for r in rows}
    held, copies = collections.Counter(), collections.Counter()
    for r in rows:
        held[r[3]] += n[r[:2]]
        copies[r[:2]] += 1
    total = sum(held.values())
    drawn, weight, per_epoch = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert r["n_tokens"] == n[(r["doc_id"], r["text"])]
        drawn[r["source"]] += r["n_tokens"]
        weight[r["source"]] = r["weight"]
        per_epoch[(r["doc_id"], r["text"], r["epoch"])] += 1
    for key, k in per_epoch.items():
        assert k <= copies[key[:2]]
    want = budget or total
    for s, w in weight.items():
        assert drawn[s] <= w * want + 1
        largest = max(n[r[:2]] for r in rows if r[3] == s)
        assert drawn[s] >= w * want - largest - 1
    assert sorted_rows(out.select("doc_id", "epoch", "block", "doc_order")) == sorted_rows(
        mixing.mix(docs.repartition(7), budget=budget, block_tokens=200).select("doc_id", "epoch", "block", "doc_order"))


def brute_draw(rows, weights, budget):
    """``source: (full epochs, tokens left)`` and what one more epoch may draw at most."""
    held = collections.Counter()
    for source, n in rows:
        held[source] += n
    return {s: divmod(int(w * budget), held[s]) for s, w in weights.items()}


def test_mix_takes_a_count_column(spark):
    rng = random.Random(8)
    rows = [(i, "x" * 40, f"s{i % 3}" if i % 7 else None, rng.randint(0, 30) * (1 + 9 * (i % 3 == 0))) for i in range(400)]
    rows += [(900, "y", "s0", None), (901, "y", "s1", -5), (902, None, "only", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens long").repartition(4)
    got = mixing.mix(docs, target_entropy=None, max_epochs=None, budget=9_000, block_tokens=100, count_col="n_tokens").collect()
    counts = {r[0]: max(r[3] or 0, 0) for r in rows}
    held = collections.Counter()
    for r in rows:
        held[r[2]] += counts[r[0]]
    total = sum(held.values())
    assert {r["source"] for r in got} == {s for s, n in held.items() if n}
    drawn, times = collections.Counter(), collections.Counter()
    for r in got:
        assert r["n_tokens"] == counts[r["doc_id"]] and abs(r["weight"] - held[r["source"]] / total) < 1e-12
        drawn[r["source"]] += r["n_tokens"]
        times[r["doc_id"]] += 1
    plan = brute_draw([(r[2], counts[r[0]]) for r in rows], {r["source"]: r["weight"] for r in got}, 9_000)
    for i, text, source, _ in rows:
        if source in plan:
            assert plan[source][0] <= times[i] <= plan[source][0] + 1
    for s, (full, left) in plan.items():
        assert 0 <= full * held[s] + left - drawn[s] <= 310


def test_mix_tells_rows_apart_by_their_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", k, {"k": k}) for k in range(40)],
                                 "doc_id long, text string, source string, extra int, m map<string,int>")
    a, b = (mixing.mix(docs.repartition(n), budget=60).select("extra").collect() for n in (2, 9))
    assert len(a) == 20 and sorted(a) == sorted(b)


def test_mix_empty(spark):
    assert mixing.mix(empty(spark)).count() == 0


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine"))
    n = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = materialise(stage(spark, docs, SF), f"test_{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and 0 < out.count() <= n
            n, docs = out.count(), out
    assert out.count() and set(docs.columns) <= set(out.columns)


def test_pipeline_keeps_short_lines_beside_a_shared_one(spark):
    docs = spark.createDataFrame([(1, "All rights reserved here\nroses\nare red", 1), (2, "All rights reserved here\nx = 1\ny = 2", 1),
                                  (3, "All rights reserved here\n \t", 1), (4, " ", 1)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert out == {1: "All rights reserved here\nroses\nare red", 2: "x = 1\ny = 2", 4: " "}


def test_pipeline_stages_take_awkward_rows(spark):
    base = ["doc_id", "text", "lang", "source", "n_chars", "id", "score", "words", "n_lines"]
    for docs in (awkward(spark).select(*base), empty(spark).select(*base)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert set(base) <= set(out.columns) and out.count() >= 0
