"""tablecheck: declarative data-quality checks as Spark DataFrame plans.

Rules (not-null, range, regex, cross-column expressions) compile to boolean
violation columns that are counted in one fused aggregation per table.  Schema,
row-count and file checks feed a gate that decides which tables get data
checks.  Every result is an ordinary DataFrame.
"""

__version__ = "0.1.0"

from .checks import FileChecks, MetadataChecks
from .operators.gate import TableSpec, evaluate_gates
from .operators.validate import (FusedCheck, RuleError, Validator, compile_rules, rollup_rule_results,
                                 rule_counts, validations, verdict)
from .plans.registry import EXAMPLE_REGISTRY, Registry
from .plans.registry_run import annotate_results, run_registry
from .plans.run import run_suite, validate_many
from .plans.windows import windowed_validation
from .rules import (CROSS_COLUMN, DEFAULT_THRESHOLD, NOT_NULL, RANGE, REGEX, Rule, TableRules, expression,
                    in_range, matches, not_null, rules_from_block)

__all__ = [
    "CROSS_COLUMN", "DEFAULT_THRESHOLD", "NOT_NULL", "RANGE", "REGEX", "Rule", "TableRules",
    "expression", "in_range", "matches", "not_null", "rules_from_block",
    "FusedCheck", "RuleError", "Validator", "compile_rules", "rollup_rule_results", "verdict",
    "validations", "rule_counts",
    "TableSpec", "evaluate_gates", "run_suite", "validate_many", "run_registry", "annotate_results",
    "Registry", "EXAMPLE_REGISTRY", "windowed_validation", "MetadataChecks", "FileChecks",
]
