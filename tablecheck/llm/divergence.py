"""Quality rules: divergence of character-class and common-word histograms from language references.

Everything is built-in column expressions; a document never leaves its row.

Base counts: words are runs without ASCII white space; ``n_repeat_words`` counts
the words inside three-word windows that occur twice or more.  To find those,
the windows' hashes are packed with their positions into one sorted array of
longs; neighbours with equal hash bits are compared word by word, so a hash
collision is no repeat.

The method's verdict: the share of each character class and of each common word
(with one share for all other words) is compared with every language reference
by the Jensen-Shannon distance (base 2, square root); the nearest language
counts, for classes and words separately, and their mean is judged.  Short texts
have rough histograms: the bound is wider by ``GUARD_WORDS / n_words``, and below
``MIN_WORDS`` words there is no verdict but the base rule's.

Defined cases: a null or empty text has no words and fails the base rule;
each row gives one row, repeated rows too; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common words of four languages with their occurrences per thousand words of ordinary prose.
COMMON_WORDS = {
    "en": {"the": 62, "of": 32, "and": 28, "to": 26, "in": 21, "a": 22},
    "fr": {"de": 52, "la": 28, "le": 23, "et": 24, "les": 21, "des": 17},
    "de": {"der": 33, "die": 32, "und": 28, "in": 18, "den": 13, "von": 12},
    "es": {"de": 63, "la": 38, "que": 29, "el": 28, "en": 27, "y": 26},
}

# Characters per thousand of ordinary prose, by class.
CHARACTER_CLASSES = {
    "en": {"lower": 782, "upper": 22, "other_letter": 1, "digit": 5, "white": 165, "symbol": 1, "punctuation": 24},
    "fr": {"lower": 752, "upper": 20, "other_letter": 34, "digit": 5, "white": 163, "symbol": 1, "punctuation": 25},
    "de": {"lower": 766, "upper": 50, "other_letter": 16, "digit": 5, "white": 140, "symbol": 1, "punctuation": 22},
    "es": {"lower": 766, "upper": 20, "other_letter": 22, "digit": 5, "white": 163, "symbol": 1, "punctuation": 23},
}

MIN_WORDS, GUARD_WORDS = 20, 15
MAX_DISTANCE = 0.18
MIN_BASE_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SPACE = r"[\x20\x09-\x0D]+"
_CLASS_NAMES = ["lower", "upper", "other_letter", "digit", "white", "symbol", "punctuation"]
_WORD_NAMES = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))


def _without(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match ``pattern`` (a class)."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern + "+", ""))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("id", "text", "words", F.size("words").cast("long").alias("n_words"), lines.alias("lines"),
                       F.array_join("words", "").alias("solid"), F.length(F.bin(F.size("words").cast("long"))).alias("bits"))
    # window hashes with their positions in the low bits, sorted
    window = F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), lambda i: F.call_function(
        "shiftleft", F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)), F.col("bits")).bitwiseOR(i.cast("long")))
    rows = rows.withColumn("packed", F.when(F.col("n_words") >= 3, F.sort_array(window)).otherwise(F.array().cast("array<bigint>")))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1

    def at(x: Column) -> Column:
        return x.bitwiseAND(mask).cast("int")

    def same(x: Column, y: Column) -> Column:
        head = F.call_function("shiftright", x, F.col("bits")) == F.call_function("shiftright", y, F.col("bits"))
        return F.coalesce(head & reduce(lambda a, b: a & b, [F.get("words", at(x) + k) == F.get("words", at(y) + k) for k in range(3)]),
                          F.lit(False))

    found = F.filter("packed", lambda x, k: same(x, F.get("packed", k - 1)) | same(x, F.get("packed", k + 1)))
    rows = rows.withColumn("repeated", F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask))))
    covered = F.aggregate("repeated", F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3).cast("long"), p - s["last"])).alias("n")),
                          lambda s: s["n"])
    return rows.select("id", "text", "words", "n_words", F.length("solid").cast("long").alias("word_chars"),
                       F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       covered.alias("n_repeat_words"))


def class_counts(rows: DataFrame) -> DataFrame:
    """Adds ``classes``: characters by class, in the order of the class names."""
    text = F.col("text")
    counted = rows.withColumn("c", F.struct(
        F.length(text).alias("all"), _without(text, "[A-Z]").alias("upper"), _without(text, r"[^\x00-\x7F]").alias("other_letter"),
        _without(text, "[0-9]").alias("digit"), (F.length(text) - F.col("word_chars")).alias("white"),
        F.col("n_symbols").alias("symbol"), _without(text, r"[!-/:-@\[-`{-~&&[^#*$%&|<>]]").alias("punctuation")))
    rest = reduce(lambda a, b: a - b, [F.col(f"c.{n}") for n in _CLASS_NAMES[1:]], F.col("c.all"))
    return counted.withColumn("classes", F.array(*[x.cast("double") for x in (rest, *[F.col(f"c.{n}") for n in _CLASS_NAMES[1:]])])).drop("c")


def word_counts(rows: DataFrame) -> DataFrame:
    """Adds ``common``: occurrences of each common word, and of all other words at the end.

    Every word stands between two spaces of its own, so occurrences never share one.
    """
    longest = max(map(len, _WORD_NAMES))
    short = F.filter("words", lambda w: F.octet_length(w) <= longest)
    rows = rows.withColumn("_spaced", F.concat(F.lit(" "), F.lower(F.array_join(short, "  ")), F.lit(" ")))
    counts = [(F.octet_length("_spaced") - F.octet_length(F.replace("_spaced", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)
              for w in _WORD_NAMES]
    rows = rows.withColumn("common", F.array(*[c.cast("double") for c in counts])).drop("_spaced")
    held = F.aggregate("common", F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("common", F.concat("common", F.array(F.col("n_words") - held)))


def distance(counts: str, total: str, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram column from fixed shares; 1 for an empty histogram."""
    def term(n: Column, q: Column) -> Column:
        p = F.try_divide(n, F.col(total))
        return (F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
                + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0))

    terms = F.zip_with(counts, F.array(*[F.lit(float(q)) for q in reference]), term)
    spread = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.when(F.col(total) > 0, F.sqrt(F.greatest(spread, F.lit(0.0)))).otherwise(1.0)


def _class_reference(language: str) -> list[float]:
    shares = CHARACTER_CLASSES[language]
    return [shares[n] / sum(shares.values()) for n in _CLASS_NAMES]


def _word_reference(language: str) -> list[float]:
    shares = COMMON_WORDS[language]
    return [shares.get(w, 0) / 1000 for w in _WORD_NAMES] + [1 - sum(shares.values()) / 1000]


def language_distances(rows: DataFrame) -> DataFrame:
    """Adds ``class_distance`` and ``word_distance`` to the nearest language reference."""
    rows = word_counts(class_counts(rows))
    for c in ("classes", "common"):
        rows = rows.withColumn(f"{c}_total", F.aggregate(c, F.lit(0.0), lambda a, x: a + x))
    return rows.withColumn("class_distance", F.least(*[distance("classes", "classes_total", _class_reference(n)) for n in CHARACTER_CLASSES])) \
        .withColumn("word_distance", F.least(*[distance("common", "common_total", _word_reference(n)) for n in COMMON_WORDS]))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``id``, base counts, ``class_distance``, ``word_distance``, ``base_failed`` and ``kept`` for each row."""
    rows = language_distances(base_counts(docs, id_col, text_col))
    failed = (F.col("n_words") < MIN_BASE_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    bound = max_distance * (1 + GUARD_WORDS / F.greatest(F.col("n_words"), F.lit(1)))
    near = (F.col("n_words") < MIN_WORDS) | ((F.col("class_distance") + F.col("word_distance")) / 2 <= bound)
    return rows.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & near).alias("kept"), "class_distance", "word_distance")
