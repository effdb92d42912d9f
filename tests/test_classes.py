"""Tables of equal schema and rules share a scan; results are those of each table alone."""

from pyspark.sql import functions as F

from tablecheck import TableRules, expression, in_range, not_null
from tablecheck.operators.validate import FusedCheck
from tablecheck.plans.classes import schema_classes, validate_paths
from tablecheck.session import scratch_path


def _tables(spark):
    root = scratch_path(spark, "classes")
    numbers = spark.range(0, 300).select("id", F.when(F.col("id") % 4 > 0, F.col("id") * 1.0).alias("v"))
    rules = (not_null("v"), in_range("v", max=200.0), expression("e", "id <> 7"), in_range("absent", min=1))
    tables = []
    for k in range(6):
        path = f"{root}/a {k}+b" if k == 3 else f"{root}/t{k}"
        numbers.filter(F.col("id") % 6 == k).repartition(1 + k % 3).write.parquet(path)
        tables.append((path, TableRules(f"t{k}", rules, threshold=0.05 * k)))
    numbers.limit(0).write.parquet(f"{root}/none")
    tables.append((f"{root}/none", TableRules("none", rules)))
    numbers.withColumn("more", F.lit(1)).write.partitionBy("more").parquet(f"{root}/parted")
    tables.append((f"{root}/parted", TableRules("parted", rules)))
    tables.append((tables[0][0], TableRules("again", rules)))
    tables.append((tables[1][0], TableRules("other rules", (not_null("id"),))))
    return tables


def test_results_are_those_of_each_table(spark):
    tables = _tables(spark)
    rules, verdicts = validate_paths(spark, tables)
    alone = [FusedCheck(spark.read.parquet(p), r) for p, r in tables]
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(rules.collect()) == key(x for c in alone for x in c.rule_results().collect())
    assert key(verdicts.collect()) == key(x for c in alone for x in c.validation_results().collect())


def test_one_scan_per_class(spark):
    tables = _tables(spark)
    assert [len(m) for _, m in schema_classes(spark, tables)] == [8, 1, 1]
    known = {p: spark.read.parquet(p).schema for p, _ in tables}
    rules, _ = validate_paths(spark, tables, schemas=known)
    assert rules._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
