"""Golden numbers at sf0.01, Spark and DuckDB agreeing on them."""

import __spark_entry__ as E

from conftest import SF_MID


def _rows(spark, name, cols):
    return sorted(tuple(r[c] for c in cols) for r in E.queries()[name](spark, SF_MID).collect())


def test_survey_numbers(spark):
    assert _rows(spark, "not_null_by_rule", ["rule_name", "violations"]) == sorted(
        [("l_returnflag", 20046), ("l_linestatus", 29936), ("l_orderkey", 0), ("c_acctbal", 0), ("c_name", 0)])
    rng = {r["rule_name"]: r["violations"] for r in
           E.queries()["suite_results"](spark, SF_MID).filter("validation_type = 'range'").collect()}
    assert rng == {"l_quantity": 5967, "l_discount": 5871, "l_extendedprice": 2824}
    assert _rows(spark, "range_check", ["table_name", "total_violations"]) == [("customer", 275),
                                                                                ("lineitem", 14662)]
    assert _rows(spark, "regex_by_rule", ["rule_name", "violations"]) == sorted(
        [("c_name", 0), ("c_mktsegment", 289), ("url_https", 84), ("url_com_org", 102)])
    assert _rows(spark, "cross_column_by_rule", ["rule_name", "violations"]) == sorted(
        [("ts_not_after_cutoff", 674), ("errors_are_small", 265), ("n_chars_matches_text", 0),
         ("n_chars_bounds", 12), ("discounted_le_list", 0), ("unit_price_cap", 31331)])
    assert _rows(spark, "incremental_validation", ["validation_type", "total_rows", "total_violations"]) == [
        ("cross_column", 14, 0), ("range", 14, 1)]
    assert _rows(spark, "json_required_keys", ["check_name", "violations"]) == [("required_k", 0),
                                                                                  ("required_k_z", 10000)]
    assert _rows(spark, "file_extension_check", ["total_files", "violations"]) == [(250, 215)]
    assert _rows(spark, "file_size_check", ["total_files", "violations"]) == [(250, 6)]
    assert E.queries()["hourly_validation"](spark, SF_MID).select("window_start").distinct().count() == 720
