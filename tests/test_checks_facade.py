"""Call-style facades: Python values from the DataFrame operators."""

import os

from tablecheck.checks import FileChecks, MetadataChecks

from conftest import SF_SMALL


def test_metadata_checks(spark):
    m = MetadataChecks(spark)
    li = f"{SF_SMALL}/lineitem.parquet"
    assert m.check_table_exists(li) and not m.check_table_exists(f"{SF_SMALL}/nope.parquet")
    ok, errors = m.validate_schema(f"{SF_SMALL}/orders.parquet",
                                   {"o_orderkey": "long", "o_totalprice": "decimal(15,2)", "o_comment": "string"})
    assert not ok
    assert errors[0] == "columns absent: o_comment"
    assert errors[1].startswith("columns not expected: ")
    assert "type of o_totalprice: double instead of decimal(15,2)" in errors
    ok, errors = m.validate_schema(li, ["l_orderkey"], strict_mode=False)
    assert ok and errors == []
    assert m.get_row_count(li) == spark.read.parquet(li).count()
    assert m.get_row_count(li, "no_such > 1") is None
    assert m.get_row_count(f"{SF_SMALL}/nope.parquet") is None
    assert m.is_not_empty(li)


def test_file_checks(spark, tmp_path):
    d = str(tmp_path / "logs")
    os.makedirs(d)
    for name, body in (("a.json", '{"event_id": 1, "k": 2}'), ("b.json", '{"event_id": 2}'), ("c.json", "")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    fc = FileChecks(spark)
    assert fc.directory_exists(d) and not fc.directory_exists(d + "/x")
    assert fc.json_files(d) == (3, ["a.json", "b.json", "c.json"])  # the empty file is a file
    r = fc.required_keys(d, ["event_id", "k"])
    assert (r["total_files"], r["invalid_files"], r["passed"]) == (3, 2, False)
    assert [x["file"] for x in r["invalid_details"]] == ["b.json", "c.json"]
    meta = spark.createDataFrame([("x.jpg", 2000), ("y.gif", 10)], "file_path string, file_size bigint")
    ok, rep = fc.validate_file_metadata(meta, ["file_path", "file_size", "image_format"], 1024, 5242880,
                                        [".jpg"])
    assert not ok and rep["missing_keys"] == ["image_format"] and rep["size_violations"] == 1
    assert rep["extension_violations"] == 1 and len(rep["errors"]) == 3
