"""Release and fetch audits, sets of outputs, configuration files."""

import json

import pytest
from pyspark.sql import functions as F

from siftwork.operators import decide, profile, release
from siftwork.sources import readers, writers
from siftwork.streaming import jobs


def test_valid_success_needs_the_file(spark):
    log = spark.createDataFrame([(1, "a", "ok", 5), (2, "b", "ok", 5), (3, "c", "ok", None), (4, "d", "no", 5), (5, "e", "ok", 5), (6, None, "ok", 5), (1, "a", "ok", 5)], "image_id long, file_name string, status string, final_bytes long")
    files = spark.createDataFrame([("a", 5), ("b", 6), ("c", 9), ("d", 5)], "path string, length long")
    assert {r.image_id for r in release.valid_success(log, files, F.col("status") == "ok").collect()} == {1, 3}
    assert release.valid_success(log, files, F.col("status") == "ok").count() == 2
    assert release.valid_success(log.where("false"), files, F.col("status") == "ok").count() == 0


def test_verified_reuse(spark):
    now = spark.createDataFrame([(1, "o", None, " AB"), (2, "p", "m", "cd"), (3, "q", "m", "ab"), (4, "p", "m", None)], "image_id long, o string, m string, sha string")
    old = spark.createDataFrame([("o", "", "ab"), ("o", "", "zz"), ("p", "m", "xx"), ("p", "m", None)], "o string, m string, sha string")
    assert {r.image_id: r.verdict for r in release.verified_reuse(now, old, ["o", "m"], "sha").collect()} == {1: "reuse", 2: "mismatch", 3: "fetch", 4: "mismatch"}


def test_matching_resources(spark):
    files = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 9), ("c", "x", 5), ("c", "y", 1), ("c", "y", 1), ("d", "x", 9), ("d", "y", 9), ("d", "z", 9)], "o string, p string, t int")
    live = spark.createDataFrame([("x",), ("y",), ("y",)], "p string")
    assert [tuple(r) for r in release.matching_resources(files, live, "o", "p", "t").collect()] == [("c", 5)]
    assert release.matching_resources(files.where("false"), live, "o", "p", "t").count() == 0


def test_promote_all_or_none(spark, tmp_path):
    a, b = spark.range(3), spark.range(5)
    at = str(tmp_path / "set")
    writers.promote({"a": a, "b": b}, at)
    with pytest.raises(ValueError):
        writers.promote({"a": b, "c": a}, at)
    broken = a.select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.promote({"a": b, "b": broken}, at, replace=True)
    count = lambda n: spark.read.parquet(f"{at}/{n}").count()
    assert (count("a"), count("b")) == (3, 5) and sorted(p.name for p in (tmp_path / "set").iterdir()) == ["a", "b"]
    writers.promote({"a": b, "b": a}, at, replace=True)
    assert (count("a"), count("b")) == (5, 3)


def test_config_lines_and_reports(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": [1, 2]}, indent=1))
    assert readers.config(spark, str(tmp_path / "c.json")) == {"a": [1, 2]}
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"a": {"b": None}}))
    assert readers.config(spark, str(tmp_path / "c.yaml")) == {"a": {"b": None}}
    (tmp_path / "t.csv").write_text("h\n1\n\n  \n2\n")
    assert readers.line_counts(spark, str(tmp_path / "t.csv"), header=True).first()[0] == 2
    assert readers.report(spark, str(tmp_path / "none.json")).columns == []


def test_label_frequencies_and_outcomes(spark):
    df = spark.createDataFrame([("g", "a"), ("g", " a "), ("g", None), ("g", ""), ("h", "b")], "g string, l string")
    assert {tuple(r) for r in profile.label_frequencies(df, "g", "l", 2).collect()} == {("g", "<missing>", 2), ("g", "a", 2), ("h", "b", 1)}
    log = spark.createDataFrame([("ok", None, "c"), ("no", "E", None)], "status string, error string, cat string")
    assert {tuple(r) for r in profile.outcomes(log, ["error"], "cat", "status", "ok").collect()} == {("error", "E", 1), ("cat:success", "c", 1), ("cat:failure", "", 1)}


def test_fixed_schema(spark):
    df = spark.createDataFrame([("7", ["a", "b"], 1), ("x", None, 2)], "n string, l array<string>, extra int")
    out = decide.fixed_schema(df, {"l": "string", "n": "int", "none": "double"})
    assert out.dtypes == [("l", "string"), ("n", "int"), ("none", "double")]
    assert [tuple(r) for r in out.collect()] == [("a|b", 7, None), (None, None, None)]


def test_observed(spark):
    got = jobs.observed(spark.range(10), lambda df: df.write.format("noop").mode("overwrite").save(), n=F.count("*"), most=F.max("id"))
    assert got == {"n": 10, "most": 9}
