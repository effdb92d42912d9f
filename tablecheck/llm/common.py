"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The white space of the word and line rules, as bytes.
WHITE = b" \t\n\x0b\x0c\r"
_LOWER_WHITE = bytes(32 if i in WHITE else (i + 32 if 65 <= i <= 90 else i) for i in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage; the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, f"llm_{name}")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_words(text: bytes | None) -> list[bytes]:
    """White-space separated words of ``text`` with A-Z lower-cased."""
    return (text or b"").translate(_LOWER_WHITE).split()


def held_out(doc_id: Column | str) -> Column:
    """True for the rows no model may learn from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 3 == 1,
                      F.lit(False))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)
