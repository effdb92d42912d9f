"""Corpus pipeline: the documents table through the training-data operators, stage by stage.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns the documents it keeps (the last one: the drawn training rows),
written as Parquet and reread as the next stage's input.  Extra columns pass
through; null texts and repeated rows are handled as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm.boosting import fit_quality, score_quality
from tablecheck.llm.common import materialise, read_table
from tablecheck.llm.lines import dedup_lines
from tablecheck.llm.minhash import drop_near_duplicates
from tablecheck.llm.mixing import mix
from tablecheck.llm.suffix import remove_contaminated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.5) go.

    It is fitted on the labelled rows of this stage's input.
    """
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    others = docs.select(*[F.col(f"`{c}`").alias("_score") if c == "score" else F.col(f"`{c}`") for c in docs.columns])
    kept = score_quality(others, model).filter("score >= 0.5").drop("score")
    return kept.withColumnRenamed("_score", "score").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 10 characters that two documents share stay in the smallest id only.

    A document that loses lines and keeps nothing but white space goes.
    """
    out = dedup_lines(docs)
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn by temperature-mixed source weights, with their epoch and order."""
    return mix(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# The stages learn models and follow links: no SQL.  Their operators are tested against brute-force versions, the
# chain of them for columns, row counts and the texts that the two dedup stages keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline_{name}")
    return docs
