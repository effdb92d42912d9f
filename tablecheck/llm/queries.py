"""Registered queries of the training-data operators over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import classify_quality
from .common import read_table
from . import divergence as D
from .divergence import judge
from .factorization import classify_toxicity
from .lines import dedup_lines
from .maskrank import search
from .minhash import near_duplicates
from .mixing import mix
from .passages import dedup_passages
from .prefixbpe import decode_bpe, encode_bpe
from .prefixtrie import prefix_trie
from .suffix import contamination_report, find_contamination
from .template import extract_text
from .tokens import count_tokens, public_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return contamination_report(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                                              F.col("longest.words").alias("longest_match"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read_table(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_passages(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_units", "n_removed", "removed", "kept_by",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_path("word_bpe_49k.json")
    coded = decode_bpe(encode_bpe(read_table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations")).drop("x", "y")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_extract": op8_html_extract,
    "op9_toxicity": op9_toxicity,
    "op10_mix_sources": op10_mix_sources,
    "op11_bpe_codec": op11_bpe_codec,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
}

# Word lists, item windows with their place, every document window that equals one; a document word is hit
# if a window covers it, and consecutive windows of one item make one verbatim match.
_OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT item, least(10, len(w)) AS k, w, unnest(range(1, CAST(len(w) - least(10, len(w)) + 2 AS BIGINT))) AS q FROM i WHERE len(w) > 0),
win AS (SELECT item, k, q, array_to_string(w[q:q + k - 1], ' ') AS g FROM iw),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, w, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS p FROM d, ks WHERE len(w) >= k),
m AS (SELECT dw.doc_id, dw.p, dw.k, win.item, win.q FROM dw JOIN win ON win.k = dw.k AND win.g = array_to_string(dw.w[dw.p:dw.p + dw.k - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY 1),
run AS (SELECT doc_id, k, p - row_number() OVER (PARTITION BY doc_id, k, item, q - p ORDER BY p) AS island, item, q - p AS diagonal FROM m),
best AS (SELECT doc_id, max(n) AS longest_match FROM (SELECT doc_id, count(*) + k - 1 AS n FROM run GROUP BY doc_id, k, item, diagonal, island) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, longest_match
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN best USING (doc_id)"""



def _js_sql(column: str, references: list[list[float]]) -> str:
    """The least Jensen-Shannon distance of a list of shares from the references."""
    def one(reference):
        terms = []
        for k, q in enumerate(reference, 1):
            terms.append(f"CASE WHEN {column}[{k}] > 0 THEN {column}[{k}] * log2(2 * {column}[{k}] / ({column}[{k}] + {q!r})) ELSE 0 END")
            if q:
                terms.append(f"{q!r} * log2(2 * {q!r} / ({column}[{k}] + {q!r}))")
        return f"sqrt(greatest(({' + '.join(terms)}) / 2, 0))"
    return f"least({', '.join(one(r) for r in references)})"


def _op4_sql() -> str:
    words = D._WORD_NAMES
    without = lambda p: f"length(text) - length(regexp_replace(text, '{p}', '', 'g'))"
    punctuation = "[!\"''()+,./:;=?@\\\\\\[\\]^_`{}~-]"
    counts = ", ".join(f"len(list_filter(w, lambda x: lower(x) = '{v}'))" for v in words)
    class_js = _js_sql("cp", [D._class_reference(n) for n in D.CHARACTER_CLASSES])
    word_js = _js_sql("wp", [D._word_reference(n) for n in D.COMMON_WORDS])
    white = "[\\x20\\x09-\\x0D]"
    return f"""
WITH b AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '{white}+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{white[1:]}')) AS fl FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM b WHERE len(w) >= 3)),
r AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS x FROM
  (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY 1),
c AS (SELECT b.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) AS n,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(fl) - len(list_distinct(fl)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  {without('[A-Z]')} AS up, {without('[^\\x00-\\x7F]')} AS oth, {without('[0-9]')} AS dig, {without(punctuation)} AS pun,
  [{counts}] AS cw FROM b LEFT JOIN r USING (doc_id)),
s AS (SELECT *, list_transform([n - up - oth - dig - (n - word_chars) - n_symbols - pun, up, oth, dig, n - word_chars, n_symbols, pun],
    lambda x: x / CAST(n AS DOUBLE)) AS cp,
  list_transform(list_append(cw, n_words - list_sum(cw)), lambda x: x / CAST(n_words AS DOUBLE)) AS wp FROM c),
j AS (SELECT *, CASE WHEN n > 0 THEN {class_js} ELSE 1.0 END AS class_distance,
  CASE WHEN n_words > 0 THEN {word_js} ELSE 1.0 END AS word_distance,
  n_words < {D.MIN_BASE_WORDS} OR 100 * n_repeat_words > {D.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (n_words < {D.MIN_WORDS} OR (class_distance + word_distance) / 2 <= {D.MAX_DISTANCE} * (1 + {D.GUARD_WORDS} / CAST(n_words AS DOUBLE))) AS kept,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance FROM j"""


# Rebuilt turn lists as digests, one row per conversation and prefix, nodes by prefix; the ancestors of a node are the
# prefixes of its least member.  CRC-32 is spelled out over the bytes of the decimal id.
_OP12_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list({'m': md5(role) || md5(text), 'b': octet_length(encode(text))} ORDER BY pos) AS own FROM t GROUP BY 1),
h AS (SELECT conv_id, own, conv_id - conv_id % 5 AS g, xor(4294967295, list_reduce(list_concat([4294967295],
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda crc, c: list_reduce(list_concat([xor(crc, c)], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))) % 9 AS h FROM s),
r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(s.own, 1, h.h), []), list_slice(h.own, h.h + 1, len(h.own))) AS turns
  FROM h LEFT JOIN s ON s.conv_id = h.g),
e AS (SELECT conv_id, turns, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS d FROM r),
p AS (SELECT conv_id, n, d, coalesce(turns[d].b, 0) AS b,
  md5(array_to_string(list_transform(list_slice(turns, 1, d), lambda x: x.m), ',')) AS k,
  CASE WHEN d > 0 THEN md5(array_to_string(list_transform(list_slice(turns, 1, d - 1), lambda x: x.m), ',')) END AS pk FROM e),
nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(pk) AS pk, any_value(b) AS b,
  string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends FROM p GROUP BY k, d),
kids AS (SELECT pk AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
sub AS (SELECT p.k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.b) AS saved_tokens
  FROM nodes m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d LEFT JOIN kids ON kids.k = m.k GROUP BY 1)
SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n_convs, coalesce(n_children, 0) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM nodes m JOIN sub ON sub.k = m.k LEFT JOIN kids ON kids.k = m.k LEFT JOIN nodes u ON u.k = m.pk"""

# Term lists, counts by term, weights, every matching document scored; integers throughout but for the logarithm.
_OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS r FROM (SELECT item, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
dn AS (SELECT row_number() OVER () AS doc, doc_id, len(w) AS n, w FROM d WHERE len(w) > 0),
t AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM dn),
p AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, n, unnest(w) AS term FROM dn) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
c AS (SELECT doc, doc_id, p.term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
  * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total))) AS part FROM p JOIN f USING (term), t),
s AS (SELECT item, item_id, doc, doc_id, CAST(sum(r * part) AS BIGINT) AS score FROM q JOIN c USING (term) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10"""

ORACLES = {
    "op13_lexical_search": _OP13_SQL,
    "op12_prefix_trie": _OP12_SQL,
    "op4_quality_rules": _op4_sql(),
    "op2_decontaminate": _OP2_SQL,
    "op7_line_dedup": """
WITH lines AS (
  SELECT doc_id, t.pos, t.line,
         translate(trim(t.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)),
                                             lambda x, i: {'pos': i, 'line': x})) AS t FROM documents)),
shared AS (SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
           GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE s.key IS NOT NULL AND l.doc_id <> s.first_id) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
              FILTER (WHERE s.key IS NULL OR l.doc_id = s.first_id), '')) AS kept_sha256
FROM lines l LEFT JOIN shared s ON l.key = s.key GROUP BY l.doc_id""",
}
