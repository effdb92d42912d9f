"""Line dedup: drop lines that many documents share, keep the rest in place.

1. Explode: each document gives its distinct line keys (stripped, A-Z lowered)
   as 128-bit digests; short keys are left out.
2. Count: per digest the number of distinct documents and the smallest one.
   Documents are told apart by id; with the threshold at two documents the
   least and greatest id say as much and combine map-side, so a line found in
   every document costs one row per task.  Higher thresholds count documents
   after the distinct step of 1 (one row per document and digest).
3. Mark: digests over the threshold are joined to the exploded lines (a plain
   equi-join, whose hot keys adaptive execution splits) and gathered per id and
   text (``part``, a hash of the text): bounded by one text's distinct lines,
   also where ids are null or repeat.
4. Reassemble: documents with marked lines drop them by position.

Defined cases: a null or empty text is one empty line; rows with a null id count
as one document, ordered after all others; rows that share an id are one document
for counting, each is rewritten; ids are whole numbers (cast to long); other
columns stay as they are, whatever their names (``n_lines`` and ``n_dropped``
are replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, batch_of, column

MIN_CHARS = 10
#: Stands for a null id in the comparisons: after every real id.
NO_ID = 2**63 - 1


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def key_digest(key: bytes, min_chars: int) -> bytes | None:
    """128-bit digest of a line's key, None when it has fewer than ``min_chars`` code points."""
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def exploded_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id, part, digest``: each row's distinct line keys."""
    schema = pa.schema([("id", pa.int64()), ("part", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, parts, digests = [], [], []
            for i, part, t in zip(column(b, "id"), column(b, "part"), column(b, "text")):
                own = {key_digest(k, min_chars) for k in set(map(line_key, t.split(b"\n")))} if t else set()
                own.discard(None)
                ids += [i] * len(own)
                parts += [part] * len(own)
                digests += own
            yield batch_of(schema, ids, parts, digests)

    return docs.select(*row_key(id_col, text_col)).mapInArrow(run, "id long, part long, digest binary")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """``id, part, text``: rows equal in the first two lose the same lines, equal hashes of other texts included:
    which lines an id loses follows from the id alone."""
    text = F.col(f"`{text_col}`").cast("binary")
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("part"),
            text.alias("text")]


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, part, digests``: for each id and text that loses lines, the digests of those it loses."""
    keys = exploded_keys(docs, id_col, text_col, min_chars)
    if min_docs <= 2:
        found = F.min("id") != F.max("id") if min_docs == 2 else F.lit(True)
        shared = keys.groupBy("digest").agg(F.min("id").alias("first_id"), found.alias("found")).filter("found")
    else:  # ids may repeat across rows: one row per digest and document before the count
        shared = (keys.select("id", "digest").distinct().groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n_docs"))
                  .filter(F.col("n_docs") >= min_docs))
    lost = keys.join(shared.select("digest", "first_id"), "digest").filter(F.col("id") != F.col("first_id"))
    return lost.groupBy("id", "part").agg(F.collect_set("digest").alias("digests"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text_col`` rewritten and ``n_lines``, ``n_dropped`` added.

    A line whose key has ``min_chars`` code points and occurs in ``min_docs``
    documents stays only in the smallest id that holds it.
    """
    lost = shared_lines(docs, id_col, text_col, min_docs, min_chars)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    others = [c for c in names if c != text_col]
    flat = docs.select(*row_key(id_col, text_col),
                       F.struct(F.lit(None).cast("string").alias(text_col), *[F.col(f"`{c}`") for c in others]).alias("row"))
    joined = flat.join(lost, ["id", "part"], "left").select("text", "digests", "row")
    row_type = joined.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, totals, dropped = [], [], []
            for t, digests in zip(column(b, "text"), column(b, "digests")):
                lines = t.split(b"\n") if t else [b""]
                if digests:
                    gone = set(digests)
                    kept = [x for x in lines if key_digest(line_key(x), min_chars) not in gone]
                    t = b"\n".join(kept)
                    dropped.append(len(lines) - len(kept))
                else:
                    dropped.append(0)
                texts.append(t)
                totals.append(len(lines))
            row = b.column(b.schema.get_field_index("row"))
            yield pa.RecordBatch.from_arrays([row, pa.array(texts, pa.binary()).cast(pa.string()),
                                              pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())],
                                             names=["row", "new_text", "n_lines", "n_dropped"])

    out = joined.mapInArrow(run, f"row {row_type}, new_text string, n_lines long, n_dropped long")
    return out.select(*[F.col("new_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names],
                      "n_lines", "n_dropped")
