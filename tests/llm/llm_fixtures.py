"""Small tables with the awkward cases every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, words string, score string, n_lines string"


def awkward_rows(seed=5, n=60):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and", "Été", "naïve", "x,y", "a|b", "***"]

    def sentence(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k)) + "."

    passage = " ".join(sentence(9) for _ in range(8))
    rows = []
    for i in range(n):
        text = "\n".join(sentence(rng.randint(1, 25)) for _ in range(rng.randint(1, 6)))
        if i % 4 == 0:
            text += "\nShared Line number one here. "
        if i % 5 == 0:
            text += " " + passage
        if i % 9 == 0 and rows:
            words = rows[-1][1].split(" ") if rows[-1][1] else ["z"]
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i, text, "en", f"src{i % 3}", len(text), 1, "c", "s", "n"))
    rows += [(n, None, None, None, None, None, None, None, None), (n + 1, "", "en", "", 0, 2, "c", None, "n"),
             (n + 2, " \t\n ", "en", "src0", 4, 2, "c", "s", "n"), (None, "null id text here", "en", "src0", 4, 2, "c", "s", "n"),
             (n + 3, "short", "en", "src1", 5, 2, "c", "s", "n"), (n + 4, "x" * 50_000 + " " + passage, "en", "src0", 1, 1, "c", "s", "n"),
             (n + 5, "the end " * 6_000, "en", "src0", 1, 1, "c", "s", "n")]
    rows += [rows[3], rows[3], rows[5]]  # repeated rows
    rows.append((n + 6, rows[7][1], "en", "src0", 1, 1, "c", "s", "n"))  # an exact copy
    return rows


def awkward(spark, **kwargs):
    return spark.createDataFrame(awkward_rows(**kwargs), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
