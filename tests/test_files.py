"""JSON documents and file directories (strict parsing, manifest vs content)."""

import os

from pyspark.sql import functions as F

from tablecheck.operators import files as FC
from tablecheck.sources import files as FS


def test_strict_document_rule(spark):
    docs = ['{"a": null, "b": 1}', '{"a":1} x', '{"a":1}{"b":2}', "{'a':1}", "[1,2]", "", '{"a":',
            '{"a":1,"a":2}', None, '\n\t {"a": [1]}', '{"b": {"a": 1}}', '{"x.y": 1, "a": 2}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, v string")
    strict = {r["id"]: r for r in FC.document_status(df, "v", ["a"]).collect()}
    # null value counts as present; leading JSON whitespace is fine; nested keys do not count
    assert sorted(i for i, r in strict.items() if r["is_valid"]) == [0, 9, 11]
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        s = {r["id"]: r for r in FC.document_status(df, "v", ["a"]).collect()}
        r = FC.required_keys_check(df, "v", ["a"], "t").first()
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    # with duplicates allowed (as Python's json module does)
    assert sorted(i for i, x in s.items() if x["is_valid"]) == [0, 7, 9, 11]
    assert s[4]["missing_keys"] == ["a"]  # an array is not an object
    assert (r["total_files"], r["violations"]) == (12, 8) and r["passed"] is False
    dotted = FC.required_keys_check(df, "v", ["x.y"], "t").first()
    assert dotted["violations"] == 11


def _write(d, name, content):
    with open(os.path.join(d, name), "w") as f:
        f.write(content)


def test_directory_scan_counts_empty_files_and_skips_others(spark, tmp_path):
    d = str(tmp_path / "logs")
    os.makedirs(d)
    _write(d, "ok.json", '{"event_id": "1", "x": 2}')
    _write(d, "broken.json", '{"event_id": ')
    _write(d, "empty.json", "")
    _write(d, "note.txt", '{"event_id": "3"}')
    _write(d, "UPPER.JSON", '{"event_id": "4"}')
    _write(d, "_hidden.json", '{"event_id": "5"}')
    _write(d, ".dot.json", '{"event_id": "6"}')
    os.makedirs(os.path.join(d, "sub"))
    _write(os.path.join(d, "sub"), "deep.json", '{"event_id": "7"}')
    docs = FS.scan_json_files(spark, d, "*.json", mode="document")
    names = sorted(r["file_name"] for r in docs.collect())
    assert names == ["broken.json", "empty.json", "ok.json"]
    r = FC.required_keys_check(docs, "value", ["event_id"], "logs").first()
    assert (r["total_files"], r["violations"]) == (3, 2)
    status = FS.directory_status(spark, d).first()
    assert status["exists"] and status["is_directory"]
    assert not FS.directory_status(spark, d + "/missing").first()["exists"]


def test_json_lines_round_trip(spark, tmp_path):
    d = str(tmp_path / "lines")
    df = spark.range(50).select(F.col("id").alias("event_id"),
                                F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit("x")).alias("t"))
    FS.write_json_documents(df.repartition(3), d)
    docs = FS.scan_json_files(spark, d, "*.json", mode="lines")
    r = FC.required_keys_check(docs, "value", ["event_id", "t"], "x").first()
    assert (r["total_files"], r["violations"]) == (50, 5)


def test_file_metadata_report(spark):
    meta = spark.createDataFrame([("a/b.jpg", 2000), ("c.PNG", 100), ("d.gif?x=1", 3000), ("e", 0)],
                                 "file_path string, file_size bigint")
    r = FC.validate_file_metadata(meta, ["file_path", "file_size", "image_format"], 1024, 5242880,
                                  [".jpg", ".jpeg", ".png", ".webp"]).first()
    assert r["missing_keys"] == "image_format"
    assert r["size_violations"] == 2 and r["extension_violations"] == 2 and r["passed"] is False
    # a bound of 0 is a bound; no size column -> no size test
    r = FC.validate_file_metadata(meta.drop("file_size"), ["file_path"], 0, None).first()
    assert r["size_violations"] == 0 and r["passed"] is True


def test_directory_status_without_jvm(spark, tmp_path):
    import unittest.mock as m
    d = str(tmp_path / "logs2")
    os.makedirs(d)
    _write(d, "a.json", "{}")
    with m.patch.object(FS, "_fs", return_value=None):
        assert FS.directory_status(spark, d).first()["is_directory"] is True
        f = FS.directory_status(spark, os.path.join(d, "a.json")).first()
        assert f["exists"] and f["is_directory"] is False
        assert FS.directory_status(spark, d + "/missing").first()["exists"] is False


def test_streaming_document_checks_see_each_file_once(spark, tmp_path):
    from pyspark.sql import functions as F2
    from tablecheck.operators.report import cumulative_results
    from tablecheck.streaming.documents import stream_required_keys
    d = str(tmp_path / "incoming")
    os.makedirs(d)
    _write(d, "a.json", '{"event_id": 1, "k": 1}')
    _write(d, "b.json", '{"event_id": 2}')
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    first = stream_required_keys(spark, d, {"keys": ["event_id", "k"]}, "logs", results_path=out, checkpoint=ckpt)
    assert [(r["total_files"], r["violations"]) for r in first.collect()] == [(2, 1)]
    _write(d, "c.json", "{broken")           # the next hour's file
    res = stream_required_keys(spark, d, {"keys": ["event_id", "k"]}, "logs", results_path=out, checkpoint=ckpt)
    assert sorted((r["batch_id"], r["total_files"], r["violations"]) for r in res.collect()) == [(0, 2, 1), (1, 1, 1)]
    history = res.withColumn("rules_configured", F2.lit(1)).withColumnRenamed("check_name", "validation_type") \
        .withColumnRenamed("total_files", "total_rows").withColumnRenamed("violations", "total_violations")
    c = cumulative_results(history).first()
    assert (c["total_rows"], c["total_violations"]) == (3, 2)


def test_zero_length_files_by_anti_join(spark, tmp_path):
    d = str(tmp_path / "z")
    os.makedirs(d)
    for name, body in (("a.json", "{}"), ("e1.json", ""), ("e 2.json", ""), ("_e3.json", ""), ("x.txt", ""),
                       ("s p%ce.json", "{}")):
        _write(d, name, body)
    z = FS.zero_length_files(spark, d, "*.json")
    # names in the URI form Spark's _metadata columns use
    assert sorted(r["file_name"] for r in z.collect()) == ["e%202.json", "e1.json"]
    assert "LeftAnti" in z._jdf.queryExecution().executedPlan().toString()


def test_one_file_per_document_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FS, "FILES_PER_TASK", 10, raising=False)
    d = str(tmp_path / "docs")
    FS.write_json_documents(spark.range(0, 35, 1, 1), d, one_per_file=True)
    names = [n for n in os.listdir(d) if n.startswith("part-")]
    assert len(names) == 35 and len({n.split("-")[1] for n in names}) == 4  # a table of one partition
    assert sorted(r["id"] for r in spark.read.json(d).collect()) == list(range(35))
    FS.write_json_documents(spark.range(0), str(tmp_path / "none"), one_per_file=True)
    assert not [n for n in os.listdir(tmp_path / "none") if n.startswith("part-") and os.path.getsize(tmp_path / "none" / n)]


def test_no_plan_holds_the_names_of_a_folder(spark, tmp_path):
    d = str(tmp_path / "many")
    os.makedirs(d)
    for k in range(40):
        _write(d, f"name_{k} x.json", "" if k % 4 == 0 else '{"k":1}')
    manifest = FS.stored_manifest(spark, d)
    for df in (FS.file_manifest(spark, d), FS.zero_length_files(spark, d), FS.scan_json_files(spark, d),
               FS.scan_json_files(spark, d, manifest=manifest)):
        plan = df._jdf.queryExecution().toString()
        assert "name_" not in plan and "Broadcast" not in plan  # neither as a literal nor collected
    assert sorted((r["file_name"], r["file_size"]) for r in manifest.collect()) == \
        sorted((f"name_{k} x.json", 0 if k % 4 == 0 else 7) for k in range(40))
    assert sorted(map(tuple, FS.scan_json_files(spark, d, manifest=manifest).collect()), key=str) == \
        sorted(map(tuple, FS.scan_json_files(spark, d).collect()), key=str)


def test_new_documents_are_checked_in_batches(spark, tmp_path):
    from tablecheck.streaming.documents import _LISTING_CONF, check_new_documents
    d, state = str(tmp_path / "docs"), str(tmp_path / "state")
    os.makedirs(d)
    for k in range(5):
        _write(d, f"{k}.json", '{"k":1}' if k else "{}")
    _write(d, "empty.json", "")
    before = spark.conf.get(_LISTING_CONF)
    r = [check_new_documents(spark, d, {"keys": ["k"]}, "logs", state, files_per_batch=2).first() for _ in range(2)]
    assert [(x["total_files"], x["violations"]) for x in r] == [(6, 2), (0, 0)]
    assert spark.read.parquet(f"{state}/results").select("batch_id").distinct().count() == 3
    _write(d, "new.json", "{}")
    x = check_new_documents(spark, d, {"keys": ["k"]}, "logs", state, files_per_batch=2).first()
    assert (x["total_files"], x["violations"]) == (1, 1) and spark.conf.get(_LISTING_CONF) == before


def test_a_tree_is_listed_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FS, "FILES_PER_TASK", 10)
    monkeypatch.setattr(FS, "FILES_PER_FOLDER", 20, raising=False)
    d = str(tmp_path / "tree")
    ids = spark.range(0, 95, 1, 1).select("id", F.when(F.col("id") % 5 > 0, F.lit("x")).alias("k"))
    FS.write_json_documents(ids, d, one_per_file=True, folders=True)
    folders = sorted(n for n in os.listdir(d) if os.path.isdir(os.path.join(d, n)))
    assert len(folders) == 5
    assert max(sum(n.endswith(".json") for n in os.listdir(os.path.join(d, f))) for f in folders) <= 20
    _write(os.path.join(d, folders[0]), "empty 1.json", "")
    _write(os.path.join(d, folders[0]), "note.txt", "{}")
    os.makedirs(os.path.join(d, "a[1] %20", "sub"))
    _write(os.path.join(d, "a[1] %20", "sub"), "deep {x}.json", '{"id":95,"k":"y"}')
    _write(os.path.join(d, "a[1] %20"), "_hidden.json", "{}")
    os.makedirs(os.path.join(d, "_left"))
    _write(os.path.join(d, "_left"), "out.json", "{}")
    _write(d, "top.json", '{"id":96}')
    _write(d, "top_empty.json", "")
    seen = []
    uris = FS._uris
    monkeypatch.setattr(FS, "_uris", lambda s, df: (seen.append(len(df.inputFiles())), uris(s, df))[1])
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    docs = FS.scan_json_files(spark, d, "*.json", recursive=True)
    assert sum(seen) == 99 and max(seen) <= 21  # each file in one listing, no listing of them all
    assert spark.conf.get("spark.sql.files.openCostInBytes") == opened
    plan = docs._jdf.queryExecution().toString()
    assert "FileScan text" not in plan and "binaryFile" not in plan and "empty" not in plan  # it holds no listing
    rows = docs.collect()
    assert sorted(spark.read.json(spark.sparkContext.parallelize([r["value"] for r in rows if r["value"]], 1))
                  .toPandas()["id"]) == list(range(97))
    assert sorted((r["file_name"], r["file_size"]) for r in rows if r["value"] is None) == \
        [("empty%201.json", 0), ("top_empty.json", 0)]
    assert all(r["file_path"].endswith("/" + r["file_name"]) for r in rows) and len({r["file_path"] for r in rows}) == 99
    check = FC.required_keys_check(docs, "value", ["id", "k"], "t").first()
    assert (check["total_files"], check["violations"]) == (99, 19 + 1 + 2)
    assert FS.scan_json_files(spark, d, "*.json", include_empty=False, recursive=True).count() == 97
    monkeypatch.setattr(FS, "_fs", lambda *_: None)  # as on Spark Connect: the whole tree at once
    assert sorted(map(tuple, FS.scan_json_files(spark, d, "*.json", recursive=True).collect()), key=str) == \
        sorted(map(tuple, rows), key=str)


def test_the_driver_drops_a_part_before_it_lists_the_next(spark, tmp_path, monkeypatch):
    import gc
    import weakref
    d = str(tmp_path / "tree")
    for k in range(6):
        os.makedirs(os.path.join(d, f"{k}"))
        _write(os.path.join(d, f"{k}"), "a.json", "{}")
    monkeypatch.setattr(FS, "FILES_PER_FOLDER", 1, raising=False)
    listings, alive = [], []
    uris = FS._uris

    def watched(s, df):
        alive.append(sum(x() is not None for x in listings))
        listings.append(weakref.ref(df._jdf))
        return uris(s, df)
    monkeypatch.setattr(FS, "_uris", watched)
    gc.disable()  # what is dropped is dropped by the scan
    try:
        assert FS.scan_json_files(spark, d, recursive=True).count() == 6
    finally:
        gc.enable()
    assert alive == [0] * 6


def test_a_tree_without_documents(spark, tmp_path):
    from pyspark.errors import AnalysisException
    import pytest
    d = str(tmp_path / "none")
    FS.write_json_documents(spark.range(0), d, one_per_file=True, folders=True)
    assert FS.scan_json_files(spark, d, recursive=True).count() == 0
    with pytest.raises(AnalysisException):
        FS.scan_json_files(spark, d + "/missing", recursive=True)
    with pytest.raises(ValueError):
        FS.write_json_documents(spark.range(1).withColumn("Document_Folder", F.lit(1)), d, one_per_file=True, folders=True)


def test_page_documents_are_read_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    from tablecheck.plans.registered import json_file_documents
    monkeypatch.setattr(FS, "FILES_PER_TASK", 10)
    monkeypatch.setattr(FS, "FILES_PER_FOLDER", 20, raising=False)
    pages = spark.range(0, 130, 1, 1).select(
        F.col("id").alias("page_id"), F.concat(F.when(F.col("id") % 13 == 0, "http://").otherwise("https://"),
                                               F.lit("h/"), "id").alias("url"), F.lit("<p>x</p>").alias("html"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    out = json_file_documents(spark, str(tmp_path))
    assert "FileScan text" not in out._jdf.queryExecution().toString()  # the driver keeps no listing of the documents
    r = out.first()
    assert (r["total_files"], r["violations"], r["passed"]) == (130, 10, True)
