"""DuckDB SQL builders for the oracle side of the registered queries.

The oracle re-states each check in DuckDB's dialect (``regexp_matches`` for
``rlike``, ``json_keys`` for ``json_object_keys``...) and recomputes counts,
rates and verdicts from the raw tables.  Counts are cast to BIGINT (DuckDB
types ``count_if``/``sum`` as HUGEINT) and rates are DOUBLE/DOUBLE on both
sides.
"""

from __future__ import annotations

from .testdata_checks import Check, Suite


def q(s: str | None) -> str:
    """SQL string literal (or NULL)."""
    if s is None:
        return "CAST(NULL AS VARCHAR)"
    return "'" + s.replace("'", "''") + "'"


def counts_cte(suite: Suite, where: str | None = None) -> str:
    cols = ["count(*) AS total_rows"]
    for i, c in enumerate(suite.checks):
        if c.duck is not None and c.status == "evaluate":
            cols.append(f"CAST(coalesce(count_if({c.duck}), 0) AS BIGINT) AS v{i}")
    w = f" WHERE {where}" if where else ""
    return f"SELECT {', '.join(cols)} FROM {suite.source_sql} AS src{w}"


def _rule_select(suite: Suite, i: int, c: Check) -> str:
    if c.duck is not None and c.status == "evaluate":
        v = f"v{i}"
        status = f"CASE WHEN v{i} > 0 THEN 'violated' ELSE 'ok' END"
    else:
        v = "CAST(0 AS BIGINT)"
        status = q(c.status)
    return (f"SELECT {q(suite.table_name)} AS table_name, {q(c.rule.validation_type)} AS validation_type, "
            f"{q(c.rule.rule_name)} AS rule_name, total_rows, {v} AS violations, "
            f"{status} AS status, {q(c.error)} AS error, {i} AS ord FROM c")


def rule_rows(suite: Suite, where: str | None = None) -> str:
    """Subquery: one row per check (plus an ``ord`` column)."""
    body = " UNION ALL ".join(_rule_select(suite, i, c) for i, c in enumerate(suite.checks))
    return f"(WITH c AS ({counts_cte(suite, where)}) {body})"


RULE_COLS = "table_name, validation_type, rule_name, total_rows, violations, status, error"


def rule_results_sql(suites: list[Suite], where: str | None = None) -> str:
    return " UNION ALL ".join(f"SELECT {RULE_COLS} FROM {rule_rows(s, where)}" for s in suites)


def validation_rows(suite: Suite, threshold: float | None = None, where: str | None = None) -> str:
    t = suite.threshold if threshold is None else threshold
    rate = ("CASE WHEN sum(violations) > 0 THEN CAST(sum(violations) AS DOUBLE) / "
            "CAST(max(total_rows) * count(*) AS DOUBLE) ELSE 0.0 END")
    return (f"SELECT table_name, validation_type, max(total_rows) AS total_rows, "
            f"CAST(count(*) AS INTEGER) AS rules_configured, "
            f"CAST(sum(violations) AS BIGINT) AS total_violations, "
            f"{rate} AS violation_percentage, CAST({t!r} AS DOUBLE) AS threshold, "
            f"({rate}) <= {t!r} AS passed "
            f"FROM {rule_rows(suite, where)} GROUP BY table_name, validation_type")


def validation_results_sql(suites: list[Suite], thresholds: dict[str, float] | None = None,
                           where: str | None = None) -> str:
    parts = []
    for s in suites:
        t = (thresholds or {}).get(s.table_name)
        parts.append(validation_rows(s, t, where))
    return " UNION ALL ".join(parts)
