"""Nested schemas by path, and drift from merged sketches, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.operators import drift as D
from tablecheck.operators import nested as N

DDL = ("id bigint, `odd name` struct<a: int, b: struct<c: array<struct<d: string>>>>, m map<string, array<int>>, "
       "s array<array<double>>")
ROWS = [
    (1, (1, ([("x",), None, (None,)],)), {"k": [1, None], "n": None}, [[1.0, None], None, []]),
    (2, (None, None), {}, []), (3, None, None, None), (None, (5, (None,)), {"z": []}, [None]), (1, None, None, None),
]


def plain_counts(schema, rows):
    counts = {}

    def visit(path, dtype, values):
        counts[path] = (len(values), sum(v is None for v in values))
        held = [v for v in values if v is not None]
        if isinstance(dtype, T.StructType):
            for i, f in enumerate(dtype.fields):
                visit(f"{path}.{f.name}", f.dataType, [v[i] for v in held])
        elif isinstance(dtype, T.ArrayType):
            visit(path + "[]", dtype.elementType, [x for v in held for x in v])
        elif isinstance(dtype, T.MapType):
            visit(path + "{key}", dtype.keyType, [x for v in held for x in v])
            visit(path + "{value}", dtype.valueType, [x for v in held for x in v.values()])

    for i, f in enumerate(schema.fields):
        visit(f.name, f.dataType, [r[i] for r in rows])
    return counts


@pytest.mark.parametrize("rows", [ROWS, []])
def test_path_counts(spark, rows):
    df = spark.createDataFrame(rows, DDL).repartition(3)
    got = {r.path: (r.instances, r.nulls) for r in N.path_counts(df).collect()}
    assert got == plain_counts(df.schema, rows)


def test_one_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, DDL).write.parquet(f"{tmp_path}/t")
    plan = N.path_counts(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan


def test_differences(spark):
    actual = T.DataType.fromDDL("a int, b struct<x: date, y: array<struct<p: float, q: string>>>, c map<string, int>, d array<int>, z int")
    expected = "a bigint, b struct<x: timestamp_ntz, y: array<struct<p: double, r: int>>>, c map<int, int>, d struct<e: int>, f string"
    rows = {r[0]: r[1:] for r in N.compare_schemas(expected, actual)}
    assert rows == {
        "a": ("widened", "bigint", "int"), "b": ("same", "struct", "struct"), "b.x": ("widened", "timestamp_ntz", "date"),
        "b.y": ("same", "array", "array"), "b.y[]": ("same", "struct", "struct"), "b.y[].p": ("widened", "double", "float"),
        "b.y[].r": ("missing", "int", None), "b.y[].q": ("extra", None, "string"), "c": ("same", "map", "map"),
        "c{key}": ("type_mismatch", "int", "string"), "c{value}": ("same", "int", "int"),
        "d": ("type_mismatch", "struct", "array"), "f": ("missing", "string", None), "z": ("extra", None, "int")}
    kinds = lambda **k: sorted(r.kind for r in N.path_differences(spark, "t", actual, expected, **k).collect())
    assert kinds() == ["extra"] * 2 + ["missing"] * 2 + ["type_mismatch"] * 2
    assert kinds(strict=False, widening=False) == ["missing"] * 2 + ["type_mismatch"] * 2 + ["widened"] * 3


@pytest.mark.parametrize("narrow,wide,ok", [
    ("tinyint", "smallint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False),
    ("int", "float", False), ("int", "decimal(12,2)", True), ("bigint", "decimal(12,2)", False), ("float", "double", True),
    ("decimal(5,2)", "decimal(7,3)", True), ("decimal(5,2)", "decimal(5,3)", False), ("string", "int", False),
    ("int", "int", False), ("date", "timestamp", False), ("void", "string", True)])
def test_widening(narrow, wide, ok):
    assert N.widens(T.DataType.fromDDL(narrow), T.DataType.fromDDL(wide)) == ok


def test_drift(spark):
    """Ten days alike but for day 6, which also moves the baselines of 7 and 9; nulls, NaN, and a day without values."""
    rng = random.Random(4)
    rows = []
    for day in range(10):
        for _ in range(2000):
            v = rng.gauss(3.0 if day == 6 else 0.0, 1.0)
            rows.append((dt.date(2024, 1, 1 + day), "g", None if day == 8 else v, rng.randrange(300)))
        rows.append((dt.date(2024, 1, 1 + day), "n", float("nan"), None))
    history = D.value_sketches(spark.createDataFrame(rows, "d date, g string, v double, k long"), F.col("d"), "v", "k")
    got = {r.run.day - 1: r for r in D.quantile_drift(history, days=3).collect()}
    assert got[0].runs_before == 0 and got[0].drifted is None
    assert [d for d in got if got[d].drifted] == [6, 7, 9]
    assert got[6].max_shift > 0.6 and max(got[d].max_shift for d in (1, 2, 3, 4, 5)) < 0.06
    assert got[8].drifted is None and got[9].drifted is not None
    assert got[5].runs_before == 3 and got[5].rows_before == 3 * 2001 and got[5].rows == 2001
    assert abs(got[5].keys - 300) <= 10 and abs(got[5].keys_before - 300) <= 10
    assert [r.nulls for r in history.orderBy("run").collect()] == [1] * 8 + [2001, 1]


def test_ties_are_no_drift(spark):
    rows = [(dt.date(2024, 1, d), float(i % 2), i) for d in (1, 2) for i in range(500)]
    history = D.value_sketches(spark.createDataFrame(rows, "d date, v double, k long"), F.col("d"), "v", "k")
    assert D.quantile_drift(history).filter("runs_before = 1").first().max_shift < 0.02
