"""Rule suites over the provided test tables, and the registered queries.

Each suite pairs a Spark rule with the same check written in DuckDB SQL, so
the oracle (``tablecheck.plans.oracle_sql``) evaluates it independently.  The test
tables hold no NULLs, so some suites inject them with ``nullif`` in a derived
view of the table.

Every query reads whole tables (``sf_dir/<table>.parquet``) and returns a lazy
DataFrame; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import FusedCheck
from ..rules import Rule, TableRules, expression, in_range, matches, not_null


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Check:
    """A Spark rule with its DuckDB counterpart (``duck`` = violation predicate)."""

    rule: Rule
    duck: str | None
    status: str = "evaluate"
    error: str | None = None


@dataclass(frozen=True)
class Suite:
    table_name: str
    checks: tuple[Check, ...]
    threshold: float = 0.10
    # derived view of the table: Spark builder and DuckDB FROM clause
    duck_from: str | None = None

    def table_rules(self, threshold: float | None = None) -> TableRules:
        return TableRules(self.table_name, tuple(c.rule for c in self.checks),
                          threshold=self.threshold if threshold is None else threshold)

    def of_type(self, *families: str) -> "Suite":
        return Suite(self.table_name, tuple(c for c in self.checks if c.rule.validation_type in families),
                     self.threshold, self.duck_from)

    @property
    def source_sql(self) -> str:
        return self.duck_from or self.table_name


# -- derived views ---------------------------------------------------------------

def lineitem_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with NULLs injected: returnflag 'R' and linestatus 'F' become NULL."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumns({
        "l_returnflag": F.expr("nullif(l_returnflag, 'R')"),
        "l_linestatus": F.expr("nullif(l_linestatus, 'F')"),
    })


LINEITEM_NULLS_SQL = ("(SELECT * REPLACE (nullif(l_returnflag, 'R') AS l_returnflag, "
                      "nullif(l_linestatus, 'F') AS l_linestatus) FROM lineitem)")

# -- suites ---------------------------------------------------------------------------

LINEITEM = Suite("lineitem", (
    Check(not_null("l_returnflag"), "l_returnflag IS NULL"),
    Check(not_null("l_linestatus"), "l_linestatus IS NULL"),
    Check(not_null("l_orderkey"), "l_orderkey IS NULL"),
    Check(in_range("l_quantity", 1, 45), "l_quantity < 1 OR l_quantity > 45"),
    Check(in_range("l_discount", 0.01, 0.09), "l_discount < 0.01 OR l_discount > 0.09"),
    Check(in_range("l_extendedprice", max=100000), "l_extendedprice > 100000"),
    Check(matches("l_returnflag", "^[NR]$"),
          "NOT regexp_matches(l_returnflag, '^[NR]$') AND l_returnflag IS NOT NULL"),
    Check(matches("l_linestatus", "^[OF]$"),
          "NOT regexp_matches(l_linestatus, '^[OF]$') AND l_linestatus IS NOT NULL"),
    Check(expression("discounted_le_list", "l_extendedprice * (1 - l_discount) <= l_extendedprice",
                     "discounted price never above list price"),
          "NOT (l_extendedprice * (1 - l_discount) <= l_extendedprice)"),
    Check(expression("unit_price_cap", "l_extendedprice / l_quantity <= 2000",
                     "unit price at most 2000"),
          "NOT (l_extendedprice / l_quantity <= 2000)"),
), duck_from=LINEITEM_NULLS_SQL)

CUSTOMER = Suite("customer", (
    Check(not_null("c_acctbal"), "c_acctbal IS NULL"),
    Check(not_null("c_name"), "c_name IS NULL"),
    Check(in_range("c_acctbal", 0, 9000), "c_acctbal < 0 OR c_acctbal > 9000"),
    Check(matches("c_name", "^Customer#[0-9]{9}$"),
          "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$') AND c_name IS NOT NULL"),
    Check(matches("c_mktsegment", "^(AUTOMOBILE|BUILDING|FURNITURE|MACHINERY)$"),
          "NOT regexp_matches(c_mktsegment, '^(AUTOMOBILE|BUILDING|FURNITURE|MACHINERY)$') "
          "AND c_mktsegment IS NOT NULL"),
    Check(expression("nation_key_known", "c_nationkey BETWEEN 0 AND 24", "nation key in range"),
          "NOT (c_nationkey BETWEEN 0 AND 24)"),
))

EVENTS = Suite("events", (
    Check(not_null("event_id"), "event_id IS NULL"),
    Check(in_range("value", 1, 200), "value < 1 OR value > 200"),
    Check(matches("event_type", "^(view|click|purchase|signup)$"),
          "NOT regexp_matches(event_type, '^(view|click|purchase|signup)$') AND event_type IS NOT NULL"),
    Check(expression("ts_not_after_cutoff", "ts <= TIMESTAMP_NTZ '2024-01-29 00:00:00'",
                     "no events after the cut-off"),
          "NOT (ts <= TIMESTAMP '2024-01-29 00:00:00')"),
    Check(expression("errors_are_small", "event_type <> 'error' OR value < 100",
                     "error events carry small values"),
          "NOT (event_type <> 'error' OR value < 100)"),
))

DOCUMENTS = Suite("documents", (
    Check(not_null("text"), "text IS NULL"),
    Check(in_range("n_chars", 20, 20000), "n_chars < 20 OR n_chars > 20000"),
    Check(matches("lang", "^[a-z]{2}$"),
          "NOT regexp_matches(lang, '^[a-z]{2}$') AND lang IS NOT NULL"),
    Check(expression("n_chars_matches_text", "length(text) = n_chars", "stored length is the text length"),
          "NOT (length(text) = n_chars)"),
    Check(expression("n_chars_bounds", "n_chars BETWEEN 20 AND 20000", "length within bounds"),
          "NOT (n_chars BETWEEN 20 AND 20000)"),
))

PAGES = Suite("pages", (
    Check(not_null("url"), "url IS NULL"),
    Check(Rule("regex", "url_https", column="url", pattern="^https://"),
          "NOT regexp_matches(url, '^https://') AND url IS NOT NULL"),
    Check(Rule("regex", "url_com_org", column="url", pattern="[.](com|org)/"),
          "NOT regexp_matches(url, '[.](com|org)/') AND url IS NOT NULL"),
))

EMBEDDINGS = Suite("embeddings", (
    Check(not_null("embedding"), "embedding IS NULL"),
    Check(in_range("label", 0, 8), "label < 0 OR label > 8"),
    Check(expression("dimension_is_64", "size(embedding) = 64", "every vector has 64 components"),
          "NOT (len(embedding) = 64)"),
    Check(expression("components_below_0_4", "array_max(embedding) < 0.4", "no component reaches 0.4"),
          "NOT (list_max(embedding) < 0.4)"),
))

CONVERSATIONS = Suite("conversations", (
    Check(not_null("text"), "text IS NULL"),
    Check(in_range("turn", 0, 6), "turn < 0 OR turn > 6"),
    Check(matches("role", "^(user|assistant)$"),
          "NOT regexp_matches(role, '^(user|assistant)$') AND role IS NOT NULL"),
    Check(expression("system_only_first", "role <> 'system' OR turn = 0", "a system turn opens the conversation"),
          "NOT (role <> 'system' OR turn = 0)"),
))

LABELS = Suite("labels", (
    Check(in_range("quality", 0, 1), "quality < 0 OR quality > 1"),
    Check(in_range("toxic", 0, 1), "toxic < 0 OR toxic > 1"),
    Check(expression("toxic_not_quality", "NOT (quality = 1 AND toxic = 1)", "toxic text is never high quality"),
          "NOT (NOT (quality = 1 AND toxic = 1))"),
))

ALL_SUITES = (LINEITEM, CUSTOMER, EVENTS, DOCUMENTS, PAGES, EMBEDDINGS, CONVERSATIONS, LABELS)

# Per-table thresholds, as a registry would hold them (V7).
TABLE_THRESHOLDS = {"lineitem": 0.05, "customer": 0.15, "events": 0.10, "documents": 0.02, "pages": 0.30}


def suite_frame(spark: SparkSession, sf_dir: str, suite: Suite) -> DataFrame:
    if suite.table_name == "lineitem":
        return lineitem_with_nulls(spark, sf_dir)
    return table(spark, sf_dir, suite.table_name)


def fused(spark: SparkSession, sf_dir: str, suite: Suite, threshold: float | None = None,
          on_error: str = "fail") -> FusedCheck:
    return FusedCheck(suite_frame(spark, sf_dir, suite), suite.table_rules(threshold), on_error)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union in a balanced tree: each step analyses plans of similar size,
    so n frames cost O(n log n) analysis instead of O(n^2)."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]
