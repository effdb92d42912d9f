"""Violation predicates as Spark ``Column`` expressions.

Every function returns a boolean column that is TRUE exactly when a row
violates the rule.  NULL means "not a violation" (``count_if`` only counts
TRUE), which gives the null semantics of each family for free:

* not-null: violation when the value IS NULL (NaN and '' are values);
* range: bounds inclusive, NULL never violates, NaN is above any max;
* regex: Java ``find`` semantics of ``rlike``; NULL passes, '' is tested;
* expression: violation only when the expression is FALSE.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Reference a column by its exact name (dots and spaces allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_violation(c: Column) -> Column:
    return c.isNull()


def numeric_view(c: Column, dtype: T.DataType | None) -> Column:
    """Compare strings numerically without tripping ANSI casts.

    Under ANSI mode ``'abc' < 0.01`` raises ``CAST_INVALID_INPUT``; a value
    that does not parse becomes NULL here and so is not a violation.
    """
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return c.try_cast("double")
    return c


def bound_literal(value, dtype: T.DataType | None) -> Column:
    """A bound in the column's own type: dates and timestamps are compared as such."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(value).cast(dtype)
    return F.lit(value)


def is_number(value) -> bool:
    return isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool)


def range_violation(c: Column, lo, hi, dtype: T.DataType | None = None) -> Column | None:
    """``c < lo OR c > hi``; one-sided when a bound is None; None without bounds."""
    parts = []
    if lo is not None:
        parts.append(c < bound_literal(lo, dtype))
    if hi is not None:
        parts.append(c > bound_literal(hi, dtype))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def regex_violation(c: Column, pattern: str, dtype: T.DataType | None = None) -> Column:
    if dtype is not None and not isinstance(dtype, T.StringType):
        c = c.cast("string")
    return ~c.rlike(pattern) & c.isNotNull()


def expression_violation(expr: str) -> Column:
    return ~F.expr(expr)


def bound_violation(c: Column, lo: float | None, hi: float | None) -> Column:
    """File-size style bound: like :func:`range_violation` but never None."""
    v = range_violation(c, lo, hi)
    return F.lit(False) if v is None else v


# --- JSON documents -------------------------------------------------------

def json_document_ok(doc: Column) -> Column:
    """TRUE when ``doc`` holds exactly one JSON value and nothing else.

    """
    return json_parsed_ok(json_parsed(doc), doc)


def json_parsed(doc: Column) -> Column:
    """``doc`` parsed as one member ``d`` of an object, followed by an end mark.

    A parser that stops after the first value accepts trailing text.  Here the
    text has to end exactly where its member does: whatever closes the wrapper
    early, adds a member or starts a second value leaves no end mark, or more
    than two members.  The mark's value is the text's own hash, which no text
    holds.  One parse serves validity and keys (``$.d``).
    """
    return F.try_parse_json(F.concat(F.lit('{"d":'), doc, F.lit('\n,"_end":"'), F.xxhash64(doc).cast("string"), F.lit('"}')))


def json_parsed_ok(parsed: Column, doc: Column) -> Column:
    """TRUE when :func:`json_parsed` of a document says that it is one strict JSON value."""
    members = F.size(F.map_keys(F.try_variant_get(parsed, "$", "map<string,variant>")))
    end = F.try_variant_get(parsed, "$._end", "string") == F.xxhash64(doc).cast("string")
    return F.coalesce(end & (members == 2) & F.try_variant_get(parsed, "$.d", "variant").isNotNull(), F.lit(False))


def json_is_object(doc: Column) -> Column:
    """For a valid document: TRUE when it is an object (cheap text test)."""
    return F.ltrim(doc, F.lit(" \t\r\n")).startswith("{")


def _key_path(key: str) -> str:
    if key.replace("_", "a").isalnum() and not key[:1].isdigit():
        return f"$.d.{key}"
    return "$.d['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def json_key_present(parsed: Column, key: str) -> Column:
    """Top-level ``key`` exists in a document's :func:`json_parsed` variant; a JSON null value counts
    as present (it is a variant null, not a SQL NULL)."""
    return F.try_variant_get(parsed, _key_path(key), "variant").isNotNull()


def extension_of(path: Column) -> Column:
    """Lower-cased file extension including the dot, '' when there is none.

    Query strings and fragments are not part of the extension.
    """
    no_query = F.regexp_replace(path, r"[?#].*$", "")
    return F.lower(F.regexp_extract(no_query, r"(\.[^./]+)$", 1))
