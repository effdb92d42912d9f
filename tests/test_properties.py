"""Property test: fused counts equal a brute-force count in Python."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablecheck import FusedCheck, TableRules, in_range, matches, not_null

VALUES = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6),
                   st.sampled_from([float("nan"), float("inf"), float("-inf")]))
TEXTS = st.one_of(st.none(), st.text(alphabet="ab01", max_size=4))
BOUND = st.one_of(st.none(), st.floats(min_value=-100, max_value=100, allow_nan=False))


def _range_violations(xs, lo, hi):
    n = 0
    for x in xs:
        if x is None:
            continue
        nan = math.isnan(x)
        # Spark orders NaN above every number
        below = lo is not None and not nan and x < lo
        above = hi is not None and (nan or x > hi)
        n += below or above
    return n


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(VALUES, TEXTS), max_size=30), lo=BOUND, hi=BOUND,
       pattern=st.sampled_from(["^a", "b$", "^[01]+$", "a|1", "^$"]))
def test_fused_counts_match_brute_force(spark, rows, lo, hi, pattern):
    df = spark.createDataFrame(rows, "x double, s string")
    rules = TableRules("t", (not_null("x"), in_range("x", lo, hi), matches("s", pattern), not_null("s")))
    got = {(r["validation_type"], r["rule_name"]): r["violations"]
           for r in FusedCheck(df, rules).rule_results().collect()}
    xs = [r[0] for r in rows]
    ss = [r[1] for r in rows]
    assert got[("not_null", "x")] == sum(x is None for x in xs)
    assert got[("not_null", "s")] == sum(s is None for s in ss)
    assert got[("range", "x")] == _range_violations(xs, lo, hi)
    assert got[("regex", "s")] == sum(s is not None and re.search(pattern, s) is None for s in ss)
