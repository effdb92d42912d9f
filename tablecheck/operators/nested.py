"""Nested schemas: differences by path, and values counted by path.

Paths name what a schema holds: ``a.b`` a struct field, ``a[]`` an array's
elements, ``a{key}`` and ``a{value}`` a map's entries.

``path_differences`` compares an expected with an actual type top down, one
row per path, without a job.  Where both sides are containers of the same kind
it goes on inside; where the kinds differ it says so once and stops.  A scalar
whose actual type is narrower than the expected one is ``widened``: every
value it can hold is read as the expected type without loss.

``path_counts`` counts instances and nulls of every path of a table in one
scan of built-in expressions.  A path's instances are the places where its
parent is there (not null), so an optional struct that is missing does not
count against its required fields.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIFFERENCE_DDL = "table_name string, path string, kind string, expected_type string, actual_type string"
CONTAINERS = (T.StructType, T.ArrayType, T.MapType)

#: Integers by width, with the decimal digits that hold all their values.
_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Integer digits that a binary fraction holds exactly (24 and 53 bits).
_FRACTIONS = {T.FloatType: 5, T.DoubleType: 10}


def widens(actual: T.DataType, expected: T.DataType) -> bool:
    """Whether every value of ``actual`` is one of the wider type ``expected``."""
    a, e = type(actual), type(expected)
    if actual == expected:
        return False
    if a is T.NullType:
        return True
    if a in _INTEGERS:
        if e in _INTEGERS:
            return _INTEGERS[a] < _INTEGERS[e]
        if e is T.DecimalType:
            return expected.precision - expected.scale >= _INTEGERS[a]
        return e in _FRACTIONS and _INTEGERS[a] <= _FRACTIONS[e]
    if a is T.DecimalType and e is T.DecimalType:
        return expected.scale >= actual.scale and expected.precision - expected.scale >= actual.precision - actual.scale
    return (a, e) in {(T.FloatType, T.DoubleType), (T.DateType, T.TimestampNTZType)}


def children(dtype: T.DataType) -> list[tuple[str, T.DataType]]:
    """``(suffix, type)`` of what a type holds; none for a scalar."""
    if isinstance(dtype, T.StructType):
        return [(f".{f.name}", f.dataType) for f in dtype.fields]
    if isinstance(dtype, T.ArrayType):
        return [("[]", dtype.elementType)]
    if isinstance(dtype, T.MapType):
        return [("{key}", dtype.keyType), ("{value}", dtype.valueType)]
    return []


def _name(dtype: T.DataType | None) -> str | None:
    """A scalar's simple string; a container by its kind, its parts have rows of their own."""
    return None if dtype is None else dtype.typeName() if isinstance(dtype, CONTAINERS) else dtype.simpleString()


def _compare(path: str, expected: T.DataType | None, actual: T.DataType | None) -> Iterator[tuple]:
    if path:
        same_kind = expected is not None and type(expected) is type(actual)
        kind = ("missing" if actual is None else "extra" if expected is None
                else "same" if expected == actual or same_kind and isinstance(actual, CONTAINERS)
                else "widened" if widens(actual, expected) else "type_mismatch")
        yield path, kind, _name(expected), _name(actual)
        if kind != "same":
            return
    inside = dict(children(actual))
    for suffix, child in children(expected):
        yield from _compare((path + suffix).removeprefix("."), child, inside.pop(suffix, None))
    for suffix, child in inside.items():
        yield from _compare((path + suffix).removeprefix("."), None, child)


def compare_schemas(expected: T.StructType | str, actual: T.StructType) -> list[tuple]:
    """``(path, kind, expected_type, actual_type)``; kind is same, widened, type_mismatch, missing or extra.

    Names compare case-sensitively, nullability and field order are left aside.
    """
    wanted = T.DataType.fromDDL(expected) if isinstance(expected, str) else expected
    return list(_compare("", wanted, actual))


def path_differences(spark: SparkSession, table_name: str, actual: T.StructType, expected: T.StructType | str,
                     strict: bool = True, widening: bool = True) -> DataFrame:
    """One row per path that differs: missing, extra (``strict`` only), type_mismatch, and ``widened``
    unless ``widening`` takes such paths as compatible."""
    rows = [(table_name, *r) for r in compare_schemas(expected, actual)
            if r[1] in ("missing", "type_mismatch") or r[1] == "extra" and strict or r[1] == "widened" and not widening]
    return spark.createDataFrame(rows, DIFFERENCE_DDL)


def _field(name: str):
    return lambda x: x[name]


def _paths(path: str, dtype: T.DataType, value: Column, there: Column, many: bool) -> Iterator[tuple[str, Column, Column]]:
    """``(path, instances, nulls)`` below a value; ``many``: ``value`` is an array of all values of the path in the row."""
    present = F.filter(value, lambda x: x.isNotNull()) if many else None
    if many:
        yield path, F.size(value), F.size(value) - F.size(present)
    else:
        yield path, there.cast("int"), (there & value.isNull()).cast("int")
    held = there & value.isNotNull()
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            inner = F.transform(present, _field(f.name)) if many else value[f.name]
            yield from _paths(f"{path}.{f.name}", f.dataType, inner, held, many)
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        parts = ([("[]", dtype.elementType, lambda x: x)] if isinstance(dtype, T.ArrayType)
                 else [("{key}", dtype.keyType, F.map_keys), ("{value}", dtype.valueType, F.map_values)])
        for suffix, child, take in parts:
            every = (F.flatten(F.transform(present, take)) if many
                     else F.coalesce(take(value), F.array().cast(T.ArrayType(child))))
            yield from _paths(path + suffix, child, every, held, True)


def path_counts(df: DataFrame) -> DataFrame:
    """``path, instances, nulls`` for every path of ``df``, from one scan; an empty table counts 0."""
    found = [p for f in df.schema.fields
             for p in _paths(f.name, f.dataType, F.col(f"`{f.name.replace('`', '``')}`"), F.lit(True), False)]
    sums = [F.coalesce(F.sum(c.cast("bigint")), F.lit(0)) for _, n, z in found for c in (n, z)]
    totals = df.agg(F.array(*sums).alias("n"))
    rows = [F.struct(F.lit(path).alias("path"), F.col("n")[2 * k].alias("instances"), F.col("n")[2 * k + 1].alias("nulls"))
            for k, (path, _, _) in enumerate(found)]
    return totals.select(F.inline(F.array(*rows)))


def nested_check(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """``path, kind, expected_type, actual_type, instances, nulls`` for every path of either side.

    A missing path has no counts.
    """
    spark = df.sparkSession
    compared = compare_schemas(expected, df.schema)
    told = {r[0] for r in compared}
    counts = path_counts(df)
    # parts of a container that is itself extra or of another kind have no row of their own
    rows = spark.createDataFrame(compared, "path string, kind string, expected_type string, actual_type string")
    return rows.join(counts.filter(F.col("path").isin(sorted(told))), "path", "left")
