"""Fused rule evaluation: every rule of a table in one aggregation.

The plan for a table with k rules is a single scan feeding one
``HashAggregate(count(1), count_if(v_1) .. count_if(v_k))``: partial aggregates
are computed map-side (k+1 longs per task), a single-partition exchange merges
them, and the one-row result is unpivoted into rule rows and validation rows.
Only the columns the rules name are read (Catalyst prunes the scan), and no
Python runs per row.  In suites above ``MAX_RULES_PER_AGGREGATE`` rules the
range rules of a column become one *histogram*: a row's place among the sorted
bounds says which of the rules it violates, so a column costs one binary search
in its bounds, whatever their number, and all such columns share one scan.  Other
rules use one aggregate per chunk of rules, so generated code stays small
enough for the JIT.

Result schemas (fixed, everything else composes on them):

* rule results: ``table_name, validation_type, rule_name, total_rows,
  violations, status, error``; ``status`` is one of ``ok``, ``violated``,
  ``column_missing``, ``error``, ``no_predicate`` (range rule without bounds),
  ``no_expression`` (empty cross-column expression) or ``skipped`` (gate closed).
* validation results: ``table_name, validation_type, total_rows,
  rules_configured, total_violations, violation_percentage, threshold, passed``
  with ``violation_percentage = total_violations / (total_rows *
  rules_configured)`` (0.0 when nothing is violated) and ``passed =
  violation_percentage <= threshold``.  Rules that cannot be evaluated stay in
  the denominator, as configured rules.  A family with a rule in ``error``, or
  whose table cannot be read, fails closed: NULL rate, ``passed = false``.
  Only ``on_error='ignore'`` tolerates an error, and only a cross-column rule's
  on a readable table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as P
from ..rules import (CROSS_COLUMN, DEFAULT_THRESHOLD, NOT_NULL, RANGE, REGEX, Rule,
                     TableRules, rules_from_block)

RULE_RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("validation_type", T.StringType()),
    T.StructField("rule_name", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("violations", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])
RULE_RESULT_COLUMNS = RULE_RESULT_SCHEMA.fieldNames()

VALIDATION_RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("validation_type", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("rules_configured", T.IntegerType()),
    T.StructField("total_violations", T.LongType()),
    T.StructField("violation_percentage", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
])
VALIDATION_RESULT_COLUMNS = VALIDATION_RESULT_SCHEMA.fieldNames()

ON_ERROR = ("fail", "ignore")


class RuleError(ValueError):
    """A rule could not be analysed against the table (``on_error='fail'``)."""


@dataclass(frozen=True)
class CompiledRule:
    rule: Rule
    violation: Column | None
    status: str  # "evaluate" or a final status
    error: str | None = None


def _error_code(e: Exception) -> str:
    cond = None
    if isinstance(e, Py4JJavaError):
        return e.java_exception.getClass().getSimpleName()
    if isinstance(e, PySparkException):
        try:
            cond = e.getCondition()
        except Exception:  # pragma: no cover - older error classes
            cond = None
    return cond or type(e).__name__


def _check_expression(df: DataFrame, expr: str) -> str | None:
    """Analyse ``expr`` against ``df`` without running a job.

    Returns an error code, or None when the expression is a valid boolean.
    Catches syntax errors, unknown columns and non-boolean results; runtime
    errors (ANSI casts, overflow) surface only when the fused job runs.
    """
    try:
        dtype = df.select(F.expr(expr).alias("_e")).schema["_e"].dataType
    except (AnalysisException, PySparkException) as e:
        return _error_code(e)
    if not isinstance(dtype, (T.BooleanType, T.NullType)):
        return f"NOT_BOOLEAN:{dtype.simpleString()}"
    return None


def _check_pattern(df: DataFrame, pattern: str) -> str | None:
    """Java regex syntax check (the dialect ``rlike`` uses), without a job.

    Returns an error code for an invalid pattern.  Needs the JVM; without one
    (Spark Connect) the check is skipped and a bad pattern fails at run time,
    where ``materialize()`` isolates it.
    """
    try:
        jvm = df.sparkSession.sparkContext._jvm
    except Exception:  # noqa: BLE001 - Spark Connect: no JVM handle
        return None
    try:
        jvm.java.util.regex.Pattern.compile(pattern)
    except (Py4JJavaError, PySparkException):  # PySpark converts IllegalArgumentException
        return "INVALID_PARAMETER_VALUE.PATTERN"
    return None


def _range_error(dtype: T.DataType, bounds: tuple) -> str | None:
    """Why bounds cannot be compared with a column of this type: numbers go with
    numbers and numeric strings, text with strings, dates and timestamps."""
    given = [b for b in bounds if b is not None]
    text = isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))
    dated = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if isinstance(dtype, T.NullType) or not given and (text or dated or isinstance(dtype, T.NumericType)):
        return None
    if all(map(P.is_number, given)):
        return None if text or isinstance(dtype, T.NumericType) else f"NOT_NUMERIC:{dtype.simpleString()}"
    if any(map(P.is_number, given)) or not (text or dated):
        return f"BOUND_TYPE:{dtype.simpleString()}"
    return None


def compile_rule(df: DataFrame, rule: Rule, on_error: str = "fail",
                 fields: Mapping[str, T.DataType] | None = None) -> CompiledRule:
    """Rule -> violation column, or a final status when it cannot be evaluated."""
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if fields is None:
        fields = {f.name: f.dataType for f in df.schema.fields}
    vt = rule.validation_type
    if vt in (NOT_NULL, RANGE, REGEX):
        if rule.column not in fields:
            return CompiledRule(rule, None, "column_missing")
        dtype = fields[rule.column]
        c = P.col(rule.column)
        if vt == NOT_NULL:
            return CompiledRule(rule, P.null_violation(c), "evaluate")
        if vt == RANGE:
            err = _range_error(dtype, (rule.min, rule.max))
            if err is not None:
                if on_error == "fail":
                    raise RuleError(f"range rule on {rule.column!r}: {err}")
                return CompiledRule(rule, None, "error", err)
            numeric = all(P.is_number(b) for b in (rule.min, rule.max) if b is not None)
            v = P.range_violation(P.numeric_view(c, dtype) if numeric else c, rule.min, rule.max, dtype)
            return CompiledRule(rule, v, "evaluate" if v is not None else "no_predicate")
        err = _check_pattern(df, rule.pattern)
        if err is not None:
            if on_error == "fail":
                raise RuleError(f"regex rule on {rule.column!r} ({rule.pattern!r}): {err}")
            return CompiledRule(rule, None, "error", err)
        return CompiledRule(rule, P.regex_violation(c, rule.pattern, dtype), "evaluate")
    if vt == CROSS_COLUMN:
        if not rule.expression:
            return CompiledRule(rule, None, "no_expression")
        err = _check_expression(df, rule.expression)
        if err is not None:
            if on_error == "fail":
                raise RuleError(f"rule {rule.rule_name!r} ({rule.expression!r}): {err}")
            return CompiledRule(rule, None, "error", err)
        return CompiledRule(rule, P.expression_violation(rule.expression), "evaluate")
    raise ValueError(f"unknown validation type {vt!r}")


def compile_rules(df: DataFrame, rules: Iterable[Rule], on_error: str = "fail") -> list[CompiledRule]:
    """Compile all rules; cross-column expressions are analysed together in
    one pass, and one by one only when that pass fails."""
    rules = list(rules)
    fields = {f.name: f.dataType for f in df.schema.fields}  # once, not per rule
    exprs = [r.expression for r in rules if r.validation_type == CROSS_COLUMN and r.expression]
    if exprs:
        try:
            types = df.select(*[F.expr(e).alias(f"_e{i}") for i, e in enumerate(exprs)]).schema
            if all(isinstance(f.dataType, (T.BooleanType, T.NullType)) for f in types.fields):
                return [_compile_checked(df, r) if r.validation_type == CROSS_COLUMN and r.expression
                        else compile_rule(df, r, on_error, fields) for r in rules]
        except (AnalysisException, PySparkException):
            pass
    return [compile_rule(df, r, on_error, fields) for r in rules]


def _compile_checked(df: DataFrame, rule: Rule) -> CompiledRule:
    return CompiledRule(rule, P.expression_violation(rule.expression), "evaluate")


# Rules per aggregation.  One HashAggregate with ~80+ count_if columns
# generates a method too large for the JIT (measured: 80 range rules 0.35 s,
# 100 rules 3.1 s on 600k rows); beyond this many evaluated rules the suite is
# split into several aggregates, each reading only the columns its rules use.
MAX_RULES_PER_AGGREGATE = 48
# A column's bounds on one side become a histogram from this many rules on.
MIN_HISTOGRAM_RULES = 8
# Types whose comparison with a bound is a comparison of doubles.
_AS_DOUBLE = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)


@dataclass(frozen=True)
class BoundList:
    """The bounds of one column on one side (``min`` or ``max``), ascending, each with its rule's index."""

    column: str
    side: str
    bounds: tuple[float, ...]
    rules: tuple[int, ...]

    @property
    def steps(self) -> int:
        return len(self.bounds).bit_length()

    def step(self, k: int, place: Column, value: Column) -> Column:
        """One step of a binary search: ``place`` moves on by 2^k if the bound there is still passed.

        After the steps from the highest ``k`` to 0 it is the number of bounds
        below the value (``max``: these are violated) or not above it (``min``:
        these are not).  NaN, which follows all numbers, fills the list up.
        """
        filled = [f"{b!r}D" for b in self.bounds] + ["double('NaN')"] * (2 ** self.steps - 1 - len(self.bounds))
        bound = F.get(F.expr(f"array({', '.join(filled)})"), place + (2 ** k - 1))
        passed = bound < value if self.side == "max" else bound <= value
        moved = F.when(passed, place + 2 ** k).otherwise(place)
        return F.least(moved, F.lit(len(self.bounds))) if k == 0 else moved

    def counts(self, key: int) -> Column:
        """Violations of each bound, from the histogram ``_places`` of ``key, place, n``."""
        def violated(j):
            hit = lambda e: (e["place"] > j) if self.side == "max" else (e["place"] <= j)
            return F.aggregate("_places", F.lit(0).cast("long"),
                               lambda n, e: n + F.when((e["key"] == key) & hit(e), e["n"]).otherwise(0))
        return F.transform(F.sequence(F.lit(0), F.lit(len(self.bounds) - 1)), violated)


def bound_lists(compiled: Sequence[CompiledRule], fields: Mapping[str, T.DataType]) -> list[BoundList]:
    """The bounds of range rules that can be counted by histogram; a two-sided rule is in two lists."""
    found: dict[tuple[str, str], list[tuple[float, int]]] = {}
    for i, c in enumerate(compiled):
        r = c.rule
        if c.violation is None or r.validation_type != RANGE:
            continue
        given = [b for b in (r.min, r.max) if b is not None]
        dtype = fields[r.column]
        plain = all(type(b) in (int, float) and b == b and abs(b) < 2**53 for b in given)
        exact = isinstance(dtype, _AS_DOUBLE) or isinstance(dtype, T.LongType) and all(type(b) is float for b in given)
        if not plain or not exact or len(given) == 2 and r.min > r.max:
            continue
        for side, bound in (("min", r.min), ("max", r.max)):
            if bound is not None:
                found.setdefault((r.column, side), []).append((float(bound), i))
    lists = []
    for (column, side), pairs in found.items():
        pairs.sort()
        lists.append(BoundList(column, side, tuple(b for b, _ in pairs), tuple(i for _, i in pairs)))
    # a rule is counted here only if all its lists are long enough
    short = {i for x in lists if len(x.rules) < MIN_HISTOGRAM_RULES for i in x.rules}
    kept = [[(b, i) for b, i in zip(x.bounds, x.rules) if i not in short] for x in lists]
    return [BoundList(x.column, x.side, tuple(b for b, _ in k), tuple(i for _, i in k)) for x, k in zip(lists, kept) if k]


class FusedCheck:
    """All rules of one table against one DataFrame, evaluated in one pass.

    Construction analyses the rules (no Spark job).  ``counts`` is the lazy
    one-row aggregate; ``rule_results()`` and ``validation_results()`` are
    projections of it, so asking for both in one plan (``unionByName`` or a
    join) still scans the table once per action.  Suites with more than
    ``max_rules_per_aggregate`` evaluated rules count the bounds of a column by
    histogram (one scan for all columns) and use one aggregate per chunk of the
    other rules (one scan per chunk).
    """

    def __init__(self, df: DataFrame, table_rules: TableRules, on_error: str = "fail",
                 group_by: Sequence[Column] = (), max_rules_per_aggregate: int = MAX_RULES_PER_AGGREGATE,
                 isolate: bool = False):
        self.df = df
        self.table_rules = table_rules
        self.tolerated = tolerated_families(on_error)
        # isolated checks turn errors into failing rows instead of raising them
        self.on_error = "ignore" if isolate else on_error
        if on_error not in ON_ERROR:
            raise ValueError(f"on_error must be one of {ON_ERROR}")
        self.group_by = list(group_by)
        self.compiled = compile_rules(df, table_rules.rules, self.on_error)
        # a stream takes one aggregation only, whatever the number of rules
        self._size = max(1, len(self.compiled) if df.isStreaming else max_rules_per_aggregate)
        try:
            self.chunks = self._build_chunks()
        except (AnalysisException, PySparkException):
            # a predicate that cannot sit inside an aggregate (an aggregate or
            # window expression): find it rule by rule, then build again
            self._isolate_unaggregatable()
            self.chunks = self._build_chunks()
        self.group_names = self.chunks[0][1].columns[:len(self.group_by)]

    def _build_chunks(self) -> list[tuple[list[int], DataFrame]]:
        """(rule indices, lazy aggregate) per chunk.  Grouped form (e.g. one
        group per hourly window): the partial aggregate is map-side, so a hot
        group costs one row per task."""
        evaluated = [i for i, c in enumerate(self.compiled) if c.violation is not None]
        lists = []
        if len(evaluated) > self._size and not self.df.isStreaming:
            lists = bound_lists(self.compiled, {f.name: f.dataType for f in self.df.schema.fields})
        placed = sorted({i for x in lists for i in x.rules})
        rest = [i for i in evaluated if i not in set(placed)]
        groups = [rest[k:k + self._size] for k in range(0, len(rest), self._size)]
        out = [(idx, self._aggregate(idx)) for idx in (groups if groups or lists else [[]])]
        return [*out, (placed, self._histogram(lists, placed))] if lists else out

    def _histogram(self, lists: list[BoundList], placed: list[int]) -> DataFrame:
        """``total_rows`` and ``_placed``, the violations of the rules ``placed`` in their order, in one scan.

        A row gives one key and place per list, and a key for itself; places
        combine map-side to no more groups than there are bounds.
        """
        keyed = self.df.groupBy(*self.group_by).agg(F.count(F.lit(1))).columns[:len(self.group_by)] if self.group_by else []
        named = [f"_g{k}" for k in range(len(keyed))]
        rows = self.df.select(*[g.alias(n) for g, n in zip(self.group_by, named)],
                              *[P.col(x.column).cast("double").alias(f"_x{k}") for k, x in enumerate(lists)],
                              *[F.lit(0).alias(f"_p{k}") for k in range(len(lists))])
        for n in reversed(range(max(x.steps for x in lists))):
            rows = rows.withColumns({f"_p{k}": x.step(n, F.col(f"_p{k}"), F.col(f"_x{k}")) for k, x in enumerate(lists) if n < x.steps})
        entry = lambda key, place: F.struct(F.lit(key).alias("key"), place.alias("place"))
        entries = F.array(entry(-1, F.lit(0)), *[entry(k, F.when(F.col(f"_x{k}").isNotNull(), F.col(f"_p{k}"))) for k in range(len(lists))])
        places = rows.select(*named, F.explode(entries).alias("e"))
        seen = places.filter("e.place IS NOT NULL").groupBy(*named, "e.key", "e.place").agg(F.count(F.lit(1)).alias("n"))
        whole = seen.groupBy(*named).agg(F.collect_list(F.struct("key", "place", "n")).alias("_places"))  # bounded by the rules
        total = F.aggregate("_places", F.lit(0).cast("long"), lambda n, e: n + F.when(e["key"] == -1, e["n"]).otherwise(0))
        counted = whole.select(*named, total.alias("total_rows"), *[x.counts(k).alias(f"_c{k}") for k, x in enumerate(lists)])
        at = {i: [f"_c{k}[{x.rules.index(i)}]" for k, x in enumerate(lists) if i in x.rules] for i in placed}
        sums = F.expr("array(" + ", ".join(" + ".join(at[i]) for i in placed) + ")")
        return counted.select(*[F.col(n).alias(g) for n, g in zip(named, keyed)], "total_rows", sums.alias("_placed"))

    def _isolate_unaggregatable(self) -> None:
        """Analyse each rule's aggregate alone (no job); failing rules become
        errors (``on_error='ignore'``) or raise ``RuleError``."""
        probe = self.df.groupBy(*self.group_by) if self.group_by else self.df.groupBy()
        for i, c in enumerate(self.compiled):
            if c.violation is None:
                continue
            try:
                probe.agg(F.count_if(c.violation)).schema
            except (AnalysisException, PySparkException) as e:
                if self.on_error == "fail":
                    raise RuleError(f"rule {c.rule.rule_name!r}: {_error_code(e)}") from e
                self.compiled[i] = CompiledRule(c.rule, None, "error", _error_code(e))

    def _aggregate(self, idx: list[int]) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("total_rows")]
        aggs += [F.count_if(self.compiled[i].violation).alias(f"_v{i}") for i in idx]
        return self.df.groupBy(*self.group_by).agg(*aggs) if self.group_by else self.df.agg(*aggs)

    @property
    def counts(self) -> DataFrame:
        """All counters in one row (per group): the chunks' aggregates side by side."""
        first, *rest = [agg if "_placed" not in agg.columns else agg.selectExpr(
            *[f"`{c}`" for c in agg.columns if c != "_placed"], *[f"_placed[{k}] AS _v{i}" for k, i in enumerate(idx)])
            for idx, agg in self.chunks]
        for agg in rest:
            agg = agg.drop("total_rows")
            if not self.group_names:
                first = first.crossJoin(agg)  # one row each
                continue
            keys = [F.col(f"`{g}`").alias(f"_g{k}") for k, g in enumerate(self.group_names)]
            other = agg.select(*keys, *[F.col(c) for c in agg.columns if c not in self.group_names])
            same = [first[f"`{g}`"].eqNullSafe(other[f"_g{k}"]) for k, g in enumerate(self.group_names)]
            first = first.join(other, same).drop(*[f"_g{k}" for k in range(len(keys))])
        return first

    def cache(self) -> "FusedCheck":
        """Cache the aggregate rows (k+1 counters per group), so that acting on
        both ``rule_results()`` and ``validation_results()`` scans the table
        once.  Lazy; a lost cached block is recomputed from lineage."""
        self.chunks = [(idx, agg.cache()) for idx, agg in self.chunks]
        return self

    def materialize(self) -> "FusedCheck":
        """Run the aggregation now and keep its one-row result locally.

        With ``on_error='ignore'``, a runtime failure of a fused job (an ANSI
        cast, ``raise_error``, overflow) is isolated by group testing: the
        rules of a failing aggregate are halved and each half counted again in
        one aggregate, down to the rules that fail alone.  These get
        ``status='error'`` with the error class: f failing rules among n cost
        about 2 f log2(n) jobs.  If the rows themselves cannot be read,
        ``total_rows`` is NULL, which fails every family.  Without a failure
        this is one job per chunk.
        """
        if self.group_names:
            raise ValueError("materialize() is for ungrouped checks")
        spark = self.df.sparkSession
        # errors PySpark does not classify arrive as raw Py4JJavaError
        job_errors = (PySparkException, Py4JJavaError)
        values: dict = {}
        broken: dict[int, str] = {}
        for idx, agg in self.chunks:
            try:
                row = agg.first().asDict()
                if "_placed" in row:
                    row |= {f"_v{i}": n for i, n in zip(idx, row.pop("_placed"))}
                values.update(row)
            except job_errors as e:
                if self.on_error != "ignore":
                    raise
                if not broken:
                    try:
                        values["total_rows"] = self.df.agg(F.count(F.lit(1))).first()[0]
                    except job_errors as unreadable:
                        # the table itself cannot be read: every rule is an error
                        code = _error_code(unreadable)
                        values = {"total_rows": None}
                        self.compiled = [CompiledRule(c.rule, None, "error", code) if c.violation is not None else c
                                         for c in self.compiled]
                        break
                found, failing = self._halved(idx, e, job_errors)
                values.update(found)
                broken.update(failing)
        for i, code in broken.items():
            self.compiled[i] = CompiledRule(self.compiled[i].rule, None, "error", code)
        if broken:
            # a rule that raises is one thing, rows that cannot be read another:
            # counting rows alone may need no more than file footers
            try:
                self.df.write.format("noop").mode("overwrite").save()
            except job_errors:
                values["total_rows"] = None
        idx = [i for i, c in enumerate(self.compiled) if c.violation is not None]
        cols = ["total_rows"] + [f"_v{i}" for i in idx]
        schema = T.StructType([T.StructField(c, T.LongType()) for c in cols])
        self.chunks = [(idx, spark.createDataFrame([tuple(values[c] for c in cols)], schema))]
        return self

    def _halved(self, idx: list[int], error: Exception, job_errors: tuple) -> tuple[dict, dict[int, str]]:
        """Counters of the rules of ``idx``, whose common aggregate failed with ``error``, and the rules that fail alone."""
        if len(idx) <= 1:
            return {}, {i: _error_code(error) for i in idx}
        counters: dict = {}
        broken: dict[int, str] = {}
        halves = [idx[:len(idx) // 2], idx[len(idx) // 2:]]
        for half in halves:
            parts = [half[k:k + MAX_RULES_PER_AGGREGATE] for k in range(0, len(half), MAX_RULES_PER_AGGREGATE)]
            for part in parts:
                try:
                    row = self._aggregate(part).first().asDict()
                    counters.update({k: n for k, n in row.items() if k != "total_rows"})
                except job_errors as e:
                    found, failing = self._halved(part, e, job_errors)
                    counters.update(found)
                    broken.update(failing)
        return counters, broken

    # -- helpers -----------------------------------------------------------
    # The result projections are written as one SQL expression each: built from
    # Column objects they cost one JVM round trip per node (about 5x slower to
    # plan for a suite of ten rules), which adds up over thousands of tables.
    def _violations_sql(self, i: int) -> str:
        return f"_v{i}" if self.compiled[i].violation is not None else "CAST(0 AS BIGINT)"

    def _rule_struct_sql(self, i: int) -> str:
        c = self.compiled[i]
        v = self._violations_sql(i)
        status = (f"CASE WHEN {v} > 0 THEN 'violated' ELSE 'ok' END" if c.status == "evaluate"
                  else sql_literal(c.status))
        return (f"named_struct('validation_type', {sql_literal(c.rule.validation_type)}, "
                f"'rule_name', {sql_literal(c.rule.rule_name)}, 'violations', {v}, "
                f"'status', {status}, 'error', {sql_literal(c.error)})")

    def _groups_sql(self) -> list[str]:
        return ["`" + g.replace("`", "``") + "`" for g in self.group_names]

    def _chunk_rule_rows(self, agg: DataFrame, idx: list[int]) -> DataFrame:
        if "_placed" in agg.columns:
            name = lambda values: f"array({', '.join(map(sql_literal, values))})[_at]"
            rules = [self.compiled[i].rule for i in idx]
            return agg.selectExpr(*self._groups_sql(), "total_rows", "posexplode(_placed) AS (_at, violations)").selectExpr(
                *self._groups_sql(), f"{sql_literal(self.table_rules.table_name)} AS table_name",
                f"{name(r.validation_type for r in rules)} AS validation_type", f"{name(r.rule_name for r in rules)} AS rule_name",
                "total_rows", "violations", "CASE WHEN violations > 0 THEN 'violated' ELSE 'ok' END AS status",
                "CAST(NULL AS STRING) AS error")
        structs = ", ".join(self._rule_struct_sql(i) for i in idx)
        return (agg.selectExpr(*self._groups_sql(), f"{sql_literal(self.table_rules.table_name)} AS table_name",
                               "total_rows", f"inline(array({structs}))")
                .select(*self.group_names, *RULE_RESULT_COLUMNS))

    # -- results -----------------------------------------------------------
    def rule_results(self) -> DataFrame:
        """One row per configured rule (configured order within one aggregate)."""
        if not self.compiled:
            return self.df.sparkSession.createDataFrame([], RULE_RESULT_SCHEMA)
        if len(self.chunks) == 1 and "_placed" not in self.chunks[0][1].columns:
            return self._chunk_rule_rows(self.chunks[0][1], list(range(len(self.compiled))))
        # rules that need no count ride with the first chunk
        other = [i for i, c in enumerate(self.compiled) if c.violation is None]
        frames = [self._chunk_rule_rows(agg, (other if n == 0 and "_placed" not in agg.columns else []) + idx)
                  for n, (idx, agg) in enumerate(self.chunks)]
        if other and "_placed" in self.chunks[0][1].columns:  # all evaluated rules are in the histogram
            frames.append(self._chunk_rule_rows(self.chunks[0][1].drop("_placed"), other))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def validation_results(self, threshold: float | None = None) -> DataFrame:
        """One row per validation family present in the rules."""
        t = float(self.table_rules.threshold if threshold is None else threshold)
        by_family: dict[str, list[int]] = {}
        for i, c in enumerate(self.compiled):
            by_family.setdefault(c.rule.validation_type, []).append(i)
        if not by_family:
            return self.df.sparkSession.createDataFrame([], VALIDATION_RESULT_SCHEMA)
        broken = sorted({c.rule.validation_type for c in self.compiled if c.status == "error"} - self.tolerated)
        closed = "total_rows IS NULL" + "".join(f" OR validation_type = {sql_literal(b)}" for b in broken)
        rate = (f"CASE WHEN {closed} THEN NULL WHEN total_violations > 0 THEN CAST(total_violations AS DOUBLE) / "
                "CAST(total_rows * rules_configured AS DOUBLE) ELSE 0.0D END")
        final = [*self._groups_sql(), "table_name", "validation_type", "total_rows", "rules_configured",
                 "total_violations", f"{rate} AS violation_percentage", f"CAST({t!r} AS DOUBLE) AS threshold",
                 f"coalesce(({rate}) <= {t!r}, false) AS passed"]
        if len(self.chunks) > 1 or "_placed" in self.chunks[0][1].columns:
            # per-family sums over the rule rows of all chunks (k rows, tiny)
            rows = self.rule_results()
            keys = [*self.group_names, "table_name", "validation_type"]
            base = rows.groupBy(*keys).agg(F.max("total_rows").alias("total_rows"),
                                           F.count(F.lit(1)).cast("int").alias("rules_configured"),
                                           F.sum("violations").cast("bigint").alias("total_violations"))
            return base.selectExpr(*final)
        structs = ", ".join(
            f"named_struct('validation_type', {sql_literal(fam)}, 'rules_configured', {len(idx)}, "
            f"'total_violations', {' + '.join(self._violations_sql(i) for i in idx)})"
            for fam, idx in by_family.items())
        base = self.chunks[0][1].selectExpr(*self._groups_sql(),
                                      f"{sql_literal(self.table_rules.table_name)} AS table_name",
                                      "total_rows", f"inline(array({structs}))")
        return base.selectExpr(*final)


def sql_literal(s: str | None) -> str:
    """A Spark SQL string literal (NULL for None)."""
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def violation_rate(total_violations: Column, total_rows: Column, rules_configured: Column) -> Column:
    """Pooled rate; 0.0 when nothing is violated (so also for empty input)."""
    denom = (total_rows * rules_configured).cast("double")
    return (F.when(total_violations > 0, total_violations.cast("double") / denom)
            .otherwise(F.lit(0.0)))


def tolerated_families(on_error: str) -> set[str]:
    """Families in which an erring rule does not fail the verdict."""
    return {CROSS_COLUMN} if on_error == "ignore" else set()


def verdict(df: DataFrame, threshold: float | Column = DEFAULT_THRESHOLD) -> DataFrame:
    """Add ``violation_percentage``, ``threshold`` and ``passed`` (inclusive).

    Rows with a positive ``errors`` count, if there is such a column, or
    without ``total_rows`` have a NULL rate and fail.
    """
    t = (threshold if isinstance(threshold, Column) else F.lit(float(threshold))).cast("double")
    closed = F.col("total_rows").isNull()
    if "errors" in df.columns:
        closed = closed | (F.col("errors") > 0)
    rate = F.when(~closed, violation_rate(F.col("total_violations"), F.col("total_rows"), F.col("rules_configured")))
    keep = [c for c in df.columns if c not in ("violation_percentage", "threshold", "passed")]
    return df.select(*keep, rate.alias("violation_percentage"), t.alias("threshold"),
                     F.coalesce(rate <= t, F.lit(False)).alias("passed"))


def rollup_rule_results(rule_results: DataFrame,
                        thresholds: float | Mapping[str, float] | DataFrame = DEFAULT_THRESHOLD,
                        on_error: str = "fail") -> DataFrame:
    """Validation results from any rule-results DataFrame (e.g. many tables).

    A family with an erring rule fails, unless ``on_error='ignore'`` tolerates
    it (see the module's description).

    ``thresholds`` is one float, a ``{table_name: threshold}`` dict (looked up
    through a map literal, no join), or a DataFrame ``(table_name,
    threshold)`` joined with a size-checked broadcast.  Tables without a
    threshold use the default.
    """
    from .joins import join_small, lookup

    # rule rows from elsewhere may carry no status; those count as evaluated
    erring = (F.col("status") == "error") & ~F.col("validation_type").isin(list(tolerated_families(on_error))) \
        if "status" in rule_results.columns else F.lit(False)
    agg = (rule_results.groupBy("table_name", "validation_type")
           .agg(F.max("total_rows").alias("total_rows"),
                F.count(F.lit(1)).cast("int").alias("rules_configured"),
                F.sum("violations").cast("bigint").alias("total_violations"),
                F.count_if(erring).alias("errors")))
    if isinstance(thresholds, DataFrame):
        t = thresholds.select("table_name", F.col("threshold").alias("_t"))
        agg = join_small(agg, t, "table_name", "left")
        return verdict(agg, F.coalesce(F.col("_t"), F.lit(DEFAULT_THRESHOLD))).select(*VALIDATION_RESULT_COLUMNS)
    if isinstance(thresholds, Mapping):
        t = {k: float(v) for k, v in thresholds.items()}
        return verdict(agg, F.coalesce(lookup(t, F.col("table_name")), F.lit(DEFAULT_THRESHOLD))) \
            .select(*VALIDATION_RESULT_COLUMNS)
    return verdict(agg, thresholds).select(*VALIDATION_RESULT_COLUMNS)


# -- per-family API mirroring the familiar validator methods -----------------

class Validator:
    """Family-at-a-time entry points; each returns a one-row validation DataFrame.

    ``validate(df, table_rules)`` is the fused path for several families; the
    per-family methods are thin shorthands over it.
    """

    def __init__(self, quality_threshold: float = DEFAULT_THRESHOLD, on_error: str = "fail"):
        self.quality_threshold = quality_threshold
        self.on_error = on_error

    def validate(self, df: DataFrame, table_rules: TableRules) -> FusedCheck:
        return FusedCheck(df, table_rules, self.on_error)

    def _one(self, df: DataFrame, table_name: str, block: Mapping) -> DataFrame:
        tr = TableRules(table_name, tuple(rules_from_block(block)), threshold=self.quality_threshold)
        return self.validate(df, tr).validation_results()

    def validate_not_null(self, df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
        return self._one(df, table_name, {NOT_NULL: list(columns)})

    def validate_range(self, df: DataFrame, range_config: Mapping[str, Mapping], table_name: str) -> DataFrame:
        return self._one(df, table_name, {RANGE: dict(range_config)})

    def validate_regex(self, df: DataFrame, regex_config: Mapping[str, str], table_name: str) -> DataFrame:
        return self._one(df, table_name, {REGEX: dict(regex_config)})

    def validate_cross_column(self, df: DataFrame, rules: Sequence[Mapping], table_name: str) -> DataFrame:
        return self._one(df, table_name, {CROSS_COLUMN: list(rules)})

    def validate_all(self, df: DataFrame, block: Mapping, table_name: str) -> DataFrame:
        """Every family of a ``{"not_null": .., "range": .., "regex": ..,
        "cross_column": ..}`` block in one scan (four calls would scan four times)."""
        return self._one(df, table_name, block)


def validations(table_rules: TableRules, threshold: float | None = None,
                on_error: str = "fail") -> Callable[[DataFrame], DataFrame]:
    """For ``DataFrame.transform``: ``df.transform(validations(rules))``."""
    return lambda df: FusedCheck(df, table_rules, on_error).validation_results(threshold)


def rule_counts(table_rules: TableRules, on_error: str = "fail") -> Callable[[DataFrame], DataFrame]:
    """For ``DataFrame.transform``: ``df.transform(rule_counts(rules))``."""
    return lambda df: FusedCheck(df, table_rules, on_error).rule_results()
