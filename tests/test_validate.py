"""Fused evaluation: equivalence with one job per rule, invariance, plan shape."""

from pyspark.sql import functions as F

from tablecheck import TableRules, expression, in_range, matches, not_null
from tablecheck.functions.predicates import col as qcol
from tablecheck.operators.validate import FusedCheck, compile_rules
from tablecheck.plans.testdata_checks import LINEITEM, lineitem_with_nulls

from conftest import SF_SMALL


def test_fused_equals_one_job_per_rule(spark):
    df = lineitem_with_nulls(spark, SF_SMALL)
    tr = LINEITEM.table_rules()
    fused = {(r["validation_type"], r["rule_name"]): r["violations"]
             for r in FusedCheck(df, tr).rule_results().collect()}
    for c in compile_rules(df, tr.rules):
        assert df.filter(c.violation).count() == fused[(c.rule.validation_type, c.rule.rule_name)]


def test_partitioning_invariance(spark):
    df = lineitem_with_nulls(spark, SF_SMALL)
    tr = LINEITEM.table_rules()
    a = sorted(FusedCheck(df.repartition(1), tr).validation_results().collect())
    b = sorted(FusedCheck(df.repartition(7), tr).validation_results().collect())
    assert a == b


def test_fused_plan_scans_once_and_prunes(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    tr = TableRules("lineitem", (in_range("l_quantity", 1, 45), not_null("l_returnflag")))
    chk = FusedCheck(df, tr)
    plan = chk.validation_results().unionByName(chk.validation_results())._jdf.queryExecution() \
        .executedPlan().toString()
    single = chk.validation_results()._jdf.queryExecution().executedPlan().toString()
    assert single.count("FileScan parquet") == 1
    # only the two rule columns are read
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in single
    assert "FileScan" in plan


def test_validation_rows_per_family(spark):
    df = lineitem_with_nulls(spark, SF_SMALL)
    fams = {r["validation_type"] for r in FusedCheck(df, LINEITEM.table_rules()).validation_results().collect()}
    assert fams == {"not_null", "range", "regex", "cross_column"}


def test_grouped_equals_slices(spark):
    from tablecheck.plans.windows import windowed_validation
    from tablecheck.sources.tables import incremental_slice
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    tr = TableRules("events", (in_range("value", 1, 200), expression("e", "event_type <> 'error' OR value < 100")))
    hourly = windowed_validation(ev, tr, "ts")
    row = hourly.orderBy(F.desc("total_rows")).first()
    sl = incremental_slice(ev, "ts", str(row["window_start"]), str(row["window_end"]))
    direct = {r["validation_type"]: r["total_violations"] for r in FusedCheck(sl, tr).validation_results().collect()}
    got = {r["validation_type"]: r["total_violations"] for r in
           hourly.filter(F.col("window_start") == F.lit(row["window_start"])).collect()}
    assert direct == got


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` string")
    tr = TableRules("t", (not_null("a.b"), not_null("c d"), matches("c d", "x")))
    r = {x["rule_name"]: x["violations"] for x in FusedCheck(df, tr).rule_results().collect()}
    assert r["a.b"] == 0
    assert qcol("a.b") is not None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_filter_is_pushed_to_parquet(spark):
    from tablecheck.sources.tables import incremental_slice
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = _plan(incremental_slice(ev, "ts", "2024-01-15 10:00:00", "2024-01-15 11:00:00", ["event_id"]))
    pushed = [l for l in plan.split("\n") if "PushedFilters" in l][0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan  # ts only for the filter


def test_key_sets_share_one_scan(spark):
    from tablecheck.operators.files import required_keys_checks
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = required_keys_checks(ev, "props", {"a": ["k"], "b": ["k", "z"], "c": ["z"]}, "events")
    assert _plan(df).count("FileScan parquet") == 1 and df.count() == 3


def test_sample_is_distributed_top_k(spark):
    from tablecheck.operators.tags import failed_records_sample
    df = lineitem_with_nulls(spark, SF_SMALL)
    plan = _plan(failed_records_sample(df, LINEITEM.table_rules(), ["l_orderkey", "l_linenumber"], 10))
    assert "TakeOrderedAndProject(limit=10" in plan


def test_rule_names_with_quotes_and_backslashes(spark):
    from tablecheck.rules import Rule
    df = spark.createDataFrame([(1,), (None,)], "x int")
    names = ["it's", "back\\slash", 'dq"uote', "tab\tname"]
    tr = TableRules("t'able", tuple(Rule("not_null", n, column="x") for n in names), threshold=1e-05)
    chk = FusedCheck(df, tr)
    got = [(r["table_name"], r["rule_name"], r["violations"]) for r in chk.rule_results().collect()]
    assert got == [("t'able", n, 1) for n in names]
    v = chk.validation_results().first()
    assert v["threshold"] == 1e-05 and v["passed"] is False and v["rules_configured"] == 4


def test_partition_column_prunes_partitions(spark, tmp_path):
    from tablecheck.sources.tables import incremental_slice
    d = str(tmp_path / "by_day")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(d)
    part = spark.read.parquet(d)
    s = incremental_slice(part, "ts", "2024-01-15 10:00:00", "2024-01-15 11:00:00", ["event_id"], "dt")
    plan = _plan(s)
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-15" in plan
    plain = incremental_slice(ev, "ts", "2024-01-15 10:00:00", "2024-01-15 11:00:00", ["event_id"])
    assert sorted(s.collect()) == sorted(plain.collect())


def test_wall_clock_round_trip_is_zone_independent(spark):
    from tablecheck.functions.time import ntz_as_utc_instant, utc_instant_as_ntz
    vals = ["2024-03-10 02:30:00.123456", "2024-11-03 01:30:00", "2024-01-15 10:00:00"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([(v,) for v in vals], "s string").select(F.col("s").cast("timestamp_ntz").alias("w"))
            out = df.select("w", F.unix_micros(ntz_as_utc_instant(F.col("w"))).alias("m"),
                            utc_instant_as_ntz(ntz_as_utc_instant(F.col("w"))).alias("back")).collect()
            assert [r["m"] for r in out] == [1710037800123456, 1730597400000000, 1705312800000000]
            assert all(r["w"] == r["back"] for r in out)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_thresholds_by_dict_and_by_frame(spark):
    from tablecheck.operators.joins import join_small
    from tablecheck.operators.validate import rollup_rule_results
    rr = spark.createDataFrame([("a", "range", "x", 10, 2), ("b", "range", "y", 10, 2)],
                               "table_name string, validation_type string, rule_name string, total_rows bigint, "
                               "violations bigint")
    by_dict = {r["table_name"]: r["passed"] for r in rollup_rule_results(rr, {"a": 0.5}).collect()}
    assert by_dict == {"a": True, "b": False}
    plan = _plan(rollup_rule_results(rr, {"a": 0.5}))
    assert "Join" not in plan
    frame = spark.createDataFrame([("a", 0.5)], "table_name string, threshold double")
    by_frame = {r["table_name"]: r["passed"] for r in rollup_rule_results(rr, frame).collect()}
    assert by_frame == by_dict
    assert "BroadcastHashJoin" in _plan(join_small(rr, frame, "table_name", rows=1))
    assert "BroadcastHashJoin" not in _plan(join_small(rr, frame, "table_name", rows=10**9))
    assert "BroadcastHashJoin" not in _plan(join_small(rr, frame, "table_name"))


def test_per_rule_sample_limits_before_the_shuffle(spark):
    from tablecheck.operators.tags import failed_records_sample_per_rule
    df = lineitem_with_nulls(spark, SF_SMALL)
    s = failed_records_sample_per_rule(df, LINEITEM.table_rules(), ["l_orderkey", "l_linenumber"], 3)
    plan = _plan(s)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    counts = {(r["validation_type"], r["rule_name"]): r["count"]
              for r in s.groupBy("validation_type", "rule_name").count().collect()}
    assert max(counts.values()) <= 3 and ("not_null", "l_returnflag") in counts and ("regex", "l_returnflag") in counts


def test_wide_suites_are_chunked_and_equal(spark):
    from tablecheck.rules import Rule
    df = lineitem_with_nulls(spark, SF_SMALL)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rules = TableRules("lineitem", tuple(Rule("range", f"r{i}", column=cols[i % 4], min=float(i % 7),
                                              max=float(1000 + i)) for i in range(30))
                       + (not_null("l_returnflag"), not_null("nope")) + LINEITEM.table_rules().rules)
    one = FusedCheck(df, rules, max_rules_per_aggregate=1000)
    many = FusedCheck(df, rules, max_rules_per_aggregate=7)
    assert len(one.chunks) == 1 and len(many.chunks) == 4  # the bounds share a histogram
    key = lambda r: (r["validation_type"], r["rule_name"], r["violations"], r["status"])
    assert sorted(map(key, one.rule_results().collect())) == sorted(map(key, many.rule_results().collect()))
    assert sorted(one.validation_results().collect()) == sorted(many.validation_results().collect())
    assert sorted(one.validation_results().collect()) == sorted(many.materialize().validation_results().collect())
    # windows work chunked too
    from pyspark.sql import functions as F2
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    tr = TableRules("events", tuple(in_range("value", i, 100 + i) for i in range(10)))
    w = [F2.window("ts", "1 day").alias("window")]
    a = FusedCheck(ev, tr, group_by=w).validation_results().collect()
    b = FusedCheck(ev, tr, group_by=w, max_rules_per_aggregate=3).validation_results().collect()
    assert sorted(a) == sorted(b)


def test_per_rule_sample_strategies_agree(spark):
    from tablecheck.operators.tags import failed_records_sample_per_rule
    df = lineitem_with_nulls(spark, SF_SMALL)
    rules = LINEITEM.table_rules()
    keys = ["l_orderkey", "l_linenumber"]
    a = failed_records_sample_per_rule(df, rules, keys, 4)
    b = failed_records_sample_per_rule(df, rules, keys, 4, strategy="per_rule")
    rows = lambda d: sorted(tuple(r) for r in d.select("validation_type", "rule_name", *keys, "rank").collect())
    assert rows(a) == rows(b) and len(rows(a)) > 0


def test_windowed_validation_aggregates_before_the_shuffle(spark):
    from tablecheck.plans.windows import windowed_validation
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # a hot hour: a third of all rows moved into one window
    hot = ev.withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-10 10:30:00")
                                     .cast("timestamp_ntz")).otherwise(F.col("ts")))
    tr = TableRules("events", (in_range("value", 1, 200), not_null("event_id")))
    out = windowed_validation(hot, tr, "ts")
    plan = _plan(out)
    lines = plan.split("\n")
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("partial_count" in l for l in lines[ex:])  # partial aggregate below the exchange
    n = out.filter("window_start = TIMESTAMP_NTZ '2024-01-10 10:00:00' AND validation_type = 'range'") \
        .first()["total_rows"]
    assert n >= ev.count() // 3


def test_transform_helpers(spark):
    from tablecheck import rule_counts, validations
    df = lineitem_with_nulls(spark, SF_SMALL)
    tr = LINEITEM.table_rules()
    assert sorted(df.transform(validations(tr)).collect()) == sorted(FusedCheck(df, tr).validation_results().collect())
    assert df.transform(rule_counts(tr)).count() == len(tr.rules)


def test_windowed_rule_results_sum_to_whole_table(spark):
    from tablecheck.plans.windows import windowed_rule_results
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    tr = TableRules("events", (in_range("value", 1, 200), not_null("event_id"),
                               expression("e", "event_type <> 'error' OR value < 100")))
    per_window = windowed_rule_results(ev, tr, "ts", "6 hours")
    sums = {r["rule_name"]: r["v"] for r in
            per_window.groupBy("rule_name").agg(F.sum("violations").alias("v")).collect()}
    whole = {r["rule_name"]: r["violations"] for r in FusedCheck(ev, tr).rule_results().collect()}
    assert sums == whole and "window_start" in per_window.columns


def test_cached_counts_serve_both_results(spark):
    df = lineitem_with_nulls(spark, SF_SMALL)
    chk = FusedCheck(df, LINEITEM.table_rules()).cache()
    assert len(chk.rule_results().collect()) == len(LINEITEM.checks)
    plan = _plan(chk.validation_results())
    assert "InMemoryTableScan" in plan and "FileScan" not in plan.split("InMemoryRelation")[0]
    for _, agg in chk.chunks:
        agg.unpersist()


def test_group_names_with_backticks(spark):
    df = spark.createDataFrame([(1, 5), (1, 50), (2, 7)], "g int, x int")
    tr = TableRules("t", (in_range("x", 0, 10),))
    out = FusedCheck(df, tr, group_by=[F.col("g").alias("we`ird")]).validation_results()
    assert sorted((r["we`ird"], r["total_violations"]) for r in out.collect()) == [(1, 1), (2, 0)]


def test_wide_suites_count_by_histogram_in_one_scan(spark):
    """Same counts as one aggregate, for NaN, NULL, equal bounds, both sides, groups and rules of other kinds."""
    import random

    rng = random.Random(3)
    values = [None, float("nan"), float("inf"), -0.0, 0.0, 1.0, 2.5, -3.0, 100.0]
    rows = [(rng.choice("ab"), rng.choice(values), rng.randrange(-5, 6), rng.choice([None, "x", "yy"])) for _ in range(400)] + [("c", None, 0, None)]
    df = spark.createDataFrame(rows, "g string, d double, i int, s string").repartition(3)
    rules = [in_range("d", max=float(rng.choice([-3, 0, 1, 2.5, 3, 100]))) for _ in range(30)]
    rules += [in_range("d", min=rng.choice([-3, 0.0, 1, 2.5])) for _ in range(20)]
    rules += [in_range("i", min=k - 4, max=k) for k in range(12)] + [in_range("i", min=3, max=1)]
    rules += [not_null("d"), matches("s", "^x$"), in_range("absent", min=1), expression("e", "i > -9")]
    table_rules = TableRules("t", tuple(rules))
    for group_by in ((), (F.col("g"),)):
        whole = FusedCheck(df, table_rules, group_by=group_by, max_rules_per_aggregate=1000)
        wide = FusedCheck(df, table_rules, group_by=group_by)
        assert len(whole.chunks) == 1 and len(wide.chunks) == 2 and len(wide.chunks[1][0]) == 62
        same = lambda a, b: sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
        assert same(wide.rule_results(), whole.rule_results())
        assert same(wide.validation_results(), whole.validation_results())
    assert same(FusedCheck(df, table_rules).materialize().rule_results(), FusedCheck(df, table_rules, max_rules_per_aggregate=1000).rule_results())
    empty = FusedCheck(df.limit(0), table_rules)
    assert {(r.total_rows, r.violations) for r in empty.rule_results().collect()} == {(0, 0)}
    only = FusedCheck(df, TableRules("t", tuple(in_range("d", max=float(k)) for k in range(60))))
    assert only.validation_results()._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_failing_rules_are_found_by_halving(spark):
    """Two failing rules among 500: jobs in the order of log2, not one per rule."""
    df = spark.range(50).withColumn("v", F.col("id").cast("double"))
    rules = [expression(f"r{k}", f"id < {k}") for k in range(500)]
    for k in (77, 401):
        rules[k] = expression(f"r{k}", f"CASE WHEN id = 7 THEN raise_error('no') ELSE id > {k} END")
    check = FusedCheck(df, TableRules("t", tuple(rules)), on_error="ignore")
    seen = []
    aggregate = check._aggregate
    check._aggregate = lambda idx: seen.append(len(idx)) or aggregate(idx)
    rows = check.materialize().rule_results().collect()
    assert sorted(r.rule_name for r in rows if r.status == "error") == ["r401", "r77"]
    assert all(r.violations == max(0, 50 - int(r.rule_name[1:])) for r in rows if r.status != "error")
    assert len(seen) <= 2 * 2 * 9
