"""Write, audit, publish: readers see whole versions that passed, and nothing else."""

import uuid

import pytest
from pyspark.sql import functions as F

from tablecheck import TableRules, expression, in_range, not_null
from tablecheck.operators.validate import FusedCheck
from tablecheck.plans.publish import observed_write, publish_table
from tablecheck.session import scratch_path


@pytest.fixture
def name(spark):
    name = f"published_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


RULES = TableRules("t", (not_null("v"), in_range("id", min=0), in_range("absent", min=0), expression("e", "id < 1000")))


def test_versions_that_pass_are_shown(spark, name):
    versions = scratch_path(spark, "versions")
    good = spark.range(100).withColumn("v", F.lit("x"))
    bad = spark.range(50).withColumn("v", F.when(F.col("id") % 2 == 0, F.lit("y")))
    first = publish_table(spark, name, good, RULES, versions)
    assert first.published and spark.table(name).count() == 100
    failed = publish_table(spark, name, bad, RULES, versions)
    assert not failed.published and spark.table(name).count() == 100
    assert spark.read.parquet(failed.path).count() == 50
    rows = {r.validation_type: r for r in failed.verdicts().collect()}
    assert rows["not_null"].total_violations == 25 and not rows["not_null"].passed and not rows["not_null"].published
    assert publish_table(spark, name, bad, RULES, versions, threshold=0.5).published
    assert spark.table(name).count() == 50
    with pytest.raises(ValueError):
        publish_table(spark, name, spark.range(3), RULES, versions)


def test_a_failing_job_changes_nothing(spark, name):
    versions = scratch_path(spark, "versions")
    publish_table(spark, name, spark.range(10).withColumn("v", F.lit("x")), RULES, versions)
    broken = spark.range(10).withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("x")))
    with pytest.raises(Exception):
        publish_table(spark, name, broken, RULES, versions)
    assert spark.table(name).count() == 10


def test_observed_counters_equal_a_check(spark):
    df = spark.range(300).withColumn("v", F.when(F.col("id") % 7 > 0, F.lit("x"))).repartition(4)
    rules = TableRules("t", tuple([not_null("v")] + [expression(f"e{k}", f"id <> {k}") for k in range(60)]))
    seen = observed_write(df, rules, scratch_path(spark, "observed"))
    plain = FusedCheck(df, rules)
    assert sorted(map(tuple, seen.rule_results().collect())) == sorted(map(tuple, plain.rule_results().collect()))
    assert seen.validation_results().collect() == plain.validation_results().collect()
    empty = observed_write(df.limit(0), rules, scratch_path(spark, "observed"))
    assert {r.passed for r in empty.validation_results().collect()} == {True}
