"""Rule model.

A rule is a small, immutable description of one check on one table.  Rules are
compiled against a DataFrame into boolean *violation* columns
(:mod:`tablecheck.functions.predicates`) and evaluated together in one fused
aggregation (:mod:`tablecheck.operators.validate`).

Two input shapes are accepted, both plain dicts:

* the per-table rule block used by test suites::

      {"not_null": ["a", "b"],
       "range": {"x": {"min": 0, "max": 10}},
       "regex": {"id": "^A[0-9]+$"},
       "cross_column": [{"name": "r1", "expression": "a <= b",
                         "description": "..."}]}

* a registry document: ``{"tables": {name: {..., "validations": <block>}},
  "global_settings": {...}}`` (:mod:`tablecheck.plans.registry`).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Iterable, Mapping

# The validation family names and the default pass threshold.
NOT_NULL = "not_null"
RANGE = "range"
REGEX = "regex"
CROSS_COLUMN = "cross_column"
FAMILIES = (NOT_NULL, RANGE, REGEX, CROSS_COLUMN)
DEFAULT_THRESHOLD = 0.10
DEFAULT_RULE_NAME = "unnamed_rule"


def _number(bound) -> float | None:
    return float(bound) if isinstance(bound, (int, float)) else None


@dataclass(frozen=True)
class Rule:
    """One configured check.

    ``rule_name`` is the column name for not-null, range and regex rules and the
    configured name for cross-column rules.
    """

    validation_type: str
    rule_name: str
    column: str | None = None
    min: float | None = None
    max: float | None = None
    pattern: str | None = None
    expression: str | None = None
    description: str = ""

    def as_row(self, table_name: str) -> dict[str, Any]:
        return {
            "table_name": table_name,
            "validation_type": self.validation_type,
            "rule_name": self.rule_name,
            "column": self.column,
            "min": _number(self.min),
            "max": _number(self.max),
            "min_text": None if _number(self.min) is not None else self.min,
            "max_text": None if _number(self.max) is not None else self.max,
            "pattern": self.pattern,
            "expression": self.expression,
            "description": self.description,
        }


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column, column=column)


def in_range(column: str, min: float | None = None, max: float | None = None) -> Rule:
    return Rule(RANGE, column, column=column, min=min, max=max)


def matches(column: str, pattern: str) -> Rule:
    return Rule(REGEX, column, column=column, pattern=pattern)


def expression(name: str | None, expr: str | None, description: str = "") -> Rule:
    return Rule(CROSS_COLUMN, name or DEFAULT_RULE_NAME, expression=expr,
                description=description or "")


def rules_from_block(block: Mapping[str, Any]) -> list[Rule]:
    """Turn a ``{"not_null": [...], "range": {...}, ...}`` block into rules.

    Order is kept: families in the order above, rules in configured order.
    Unknown keys (``schema_check`` and the like) are ignored here.
    """
    out: list[Rule] = []
    nn = block.get(NOT_NULL)
    if isinstance(nn, Mapping):  # registry form {"columns": [...]}
        nn = nn.get("columns", [])
    for c in nn or []:
        out.append(not_null(c))
    for c, bounds in (block.get(RANGE) or {}).items():
        bounds = bounds or {}
        out.append(in_range(c, bounds.get("min"), bounds.get("max")))
    for c, p in (block.get(REGEX) or {}).items():
        out.append(matches(c, p))
    for r in block.get(CROSS_COLUMN) or []:
        out.append(expression(r.get("name"), r.get("expression"), r.get("description", "")))
    return out


@dataclass(frozen=True)
class TableRules:
    """All rules of one table plus the table-level settings the registry holds."""

    table_name: str
    rules: tuple[Rule, ...] = ()
    threshold: float = DEFAULT_THRESHOLD
    table_type: str = "structured"
    namespace: str | None = None
    incremental: bool = False
    timestamp_column: str | None = None
    expected_schema: Mapping[str, str] | None = None
    strict_schema: bool = True
    metadata_stop_on_failure: bool = True
    data_stop_on_threshold: bool = True
    tags: Mapping[str, str] = field(default_factory=dict)

    @staticmethod
    def from_block(table_name: str, block: Mapping[str, Any], **settings: Any) -> "TableRules":
        return TableRules(table_name, tuple(rules_from_block(block)), **settings)

    def of_type(self, validation_type: str) -> "TableRules":
        return replace(self, rules=tuple(r for r in self.rules if r.validation_type == validation_type))

    def with_rules(self, rules: Iterable[Rule]) -> "TableRules":
        return replace(self, rules=tuple(rules))

    def families(self) -> list[str]:
        seen: list[str] = []
        for r in self.rules:
            if r.validation_type not in seen:
                seen.append(r.validation_type)
        return seen

    def columns(self) -> list[str]:
        """Columns named by column rules (for pruning reads)."""
        out: list[str] = []
        for r in self.rules:
            if r.column and r.column not in out:
                out.append(r.column)
        return out
