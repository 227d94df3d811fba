"""Promises with a failing case for each kind, outputs of one job, phrases against plain Python, versions and parsers."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import postings, promises, replay
from tallyspark.sources import sinks, tables

ROWS = [(1, "a", 10, True), (2, "b", 20, False), (3, None, 30, None), (3, "", 5, True)]


def kept(spark, tmp_path, rows, wanted):
    df = promises.nth_of_key(spark.createDataFrame(rows, "k long, v string, n long, b boolean"), ["k"])
    out = promises.observed(df, wanted, lambda x: x.write.parquet(f"file://{tmp_path}/out"), ["_nth"])
    written = spark.read.parquet(f"file://{tmp_path}/out")
    assert written.columns == ["k", "v", "n", "b"]
    assert written.count() == len(rows)
    return {r.promise: (r.passed, r.value) for r in out.collect()}


def test_every_kind_of_promise_passes_and_fails(spark, tmp_path):
    c = F.col
    wanted = [
        promises.every("all", c("n") > 0), promises.every("all, not", c("b")), promises.some("some", c("v") == "a"), promises.some("some, not", c("v") == "z"), promises.some("two", c("b"), 2), promises.share("share", c("n") >= 10, 0.75), promises.share("share, not", c("n") >= 10, 0.76),
        promises.counted("rows", 4), promises.counted("rows, not", 5), promises.counted("rows where", 1, c("v") == ""), promises.summed("sum", c("n"), 65, 65), promises.summed("sum, not", c("n"), high=64), promises.every("unique, not", c("_nth") == 1),
    ]
    got = kept(spark, tmp_path, ROWS, wanted)
    assert {n for n, (ok, _) in got.items() if not ok} == {n for n in got if n.endswith("not")}
    assert got["all, not"] == (False, 2.0)
    assert got["unique, not"] == (False, 1.0)


def test_promises_of_nothing(spark, tmp_path):
    c = F.col
    got = kept(spark, tmp_path, [], [promises.every("all", c("b")), promises.some("some", c("b")), promises.share("share", c("b"), 0.0), promises.counted("none", 0), promises.summed("sum", c("n"), 0, 0)])
    assert got == {"all": (True, 0.0), "some": (False, 0.0), "share": (False, None), "none": (True, 0.0), "sum": (True, 0.0)}


def test_promises_add_no_scan(spark, tmp_path):
    spark.range(100).write.parquet(f"file://{tmp_path}/in")
    runs = []
    df = spark.read.parquet(f"file://{tmp_path}/in")
    promises.observed(df, [promises.every(f"p{k}", F.col("id") >= k) for k in range(20)], lambda x: runs.append(x) or x.write.parquet(f"file://{tmp_path}/out"))
    plan = runs[0]._jdf.queryExecution().executedPlan().toString()
    assert len(runs) == 1
    assert plan.count("FileScan") == 1


def test_three_outputs_from_one_scan(spark, tmp_path):
    at = f"file://{tmp_path}"
    spark.createDataFrame([(1, 'a "quoted", name', True), (2, None, False), (3, "", None)], "k long, name string, ok boolean").write.parquet(f"{at}/p")
    spark.createDataFrame([(1, 2, "x"), (1, 1, None), (3, 1, "z"), (9, 1, "stray")], "k long, n long, t string").write.parquet(f"{at}/s")
    parts, sections = spark.read.parquet(f"{at}/p"), spark.read.parquet(f"{at}/s")
    plan = sinks.dataset_lines(parts, sections, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    sinks.write_dataset(parts, sections, ["k"], f"{at}/out")
    files = sorted((tmp_path / "out").rglob("*.txt"))
    for f in files:
        lines = f.read_bytes().decode().splitlines()
        if "output=nested" in str(f):
            assert all(json.loads(x)["sections"] is not None for x in lines)
        else:
            assert lines[0] == "﻿" + ("k,name,ok" if "output=parts" in str(f) else "k,n,t")
            assert not any("﻿" in x for x in lines[1:])
    rows = tables.read_csv(spark, f"{at}/out/output=parts", "k long, name string, ok boolean").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 'a "quoted", name', True), (2, None, False), (3, "", None)]
    rows = tables.read_csv(spark, f"{at}/out/output=sections", "k long, n long, t string").collect()
    assert sorted((r.k, r.n, r.t) for r in rows) == [(1, 1, None), (1, 2, "x"), (3, 1, "z"), (9, 1, "stray")]
    nested = [json.loads(x) for f in files if "output=nested" in str(f) for x in f.read_text().splitlines()]
    assert sorted((r["k"], len(r["sections"])) for r in nested) == [(1, 2), (2, 0), (3, 1)]
    assert [s["n"] for r in nested if r["k"] == 1 for s in r["sections"]] == [1, 2]


def test_phrases_against_plain_python(spark):
    rnd = random.Random(3)
    words = ["police", "station", "town", "road", "railway", "college", "of"]
    texts = [(rnd.choice([k, k, k * 1000]), " ".join(rnd.choice(words).title() for _ in range(rnd.randint(0, 6))) + rnd.choice(["", "-Road", "!"])) for k in range(200)] + [(None, "police"), (7, None)]
    phrases = [f"{a} {b}" for a in words for b in words] + ["police", "Police  POLICE", "", "12", "no such", "police town road"]
    df = spark.createDataFrame(texts, "k long, t string")
    index = postings.postings(df, "k", "t", 16)
    assert index.agg(F.max(F.size("keys"))).first()[0] <= 16
    got = {tuple(r) for r in postings.answered(index, spark.createDataFrame([(p,) for p in phrases], "p string"), "p").collect()}
    have = {}
    for k, t in texts:
        if k is not None:
            have.setdefault(k, set()).update(re.findall("[a-z]+", (t or "").lower()))
    want = {(p, k) for p in phrases for k, w in have.items() if re.findall("[a-z]+", p.lower()) and set(re.findall("[a-z]+", p.lower())) <= w}
    assert got == want


def test_a_phrase_is_earned_word_by_word(spark):
    index = spark.createDataFrame([("police", "pulich"), ("town", "taun"), ("town", "tauna"), ("road", "rod")], "word string, token string")
    values = spark.createDataFrame([(1, ["pulich", "thana"]), (2, ["taun", "pulich"]), (3, ["rod", "rod", "tauna"]), (4, []), (5, None)], "k long, t array<string>")
    phrases = spark.createDataFrame([("Police Station",), ("police",), ("Town",), ("town road",), ("town town",), ("",)], "p string")
    got = {tuple(r) for r in postings.earned(values, "k", "t", index, phrases, "p").collect()}
    assert got == {("police", 1), ("police", 2), ("Town", 2), ("Town", 3), ("town road", 3), ("town town", 2), ("town town", 3)}


def test_versions_of_a_step(spark):
    versions = replay.Assemblers(["k", "n"])
    versions.version("a")(lambda df: df.withColumn("n", F.col("k") * 2))
    versions.version("b")(lambda df: df.withColumn("n", F.col("k") + 1).withColumn("more", F.lit(1)))
    versions.version("c")(lambda df: df)
    with pytest.raises(ValueError, match="there already"):
        versions.version("a")(lambda df: df)
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    for name, message in (("d", "no version d"), ("c", "gives no")):
        with pytest.raises(ValueError, match=message):
            versions.run(name, rows)
    measured = replay.metrics(versions.replay(rows, ["a", "b"]), {"sum": F.sum("n")}, F.when(F.col("k") > 2, "late").otherwise("early"))
    got = {tuple(r) for r in replay.side_by_side(measured, "a", "b", ["early", "late", "none"]).collect()}
    assert got == {("early", "sum", 6.0, 5.0, -1.0), ("late", "sum", 6.0, 4.0, -2.0), ("combined", "sum", 12.0, 9.0, -3.0), ("none", None, None, None, None)}
    assert [r.passed for r in replay.judged(measured, "a", "b", "sum", 0.1, [], lower_is_better=["sum"]).collect()] == [True]
    assert [r.passed for r in replay.judged(measured, "a", "b", "sum", 0.1, ["gone"]).collect()] == [False, False]


def test_scratch_files_go(spark):
    at = sinks.scratch(spark, "here")
    spark.range(2).write.parquet(at)
    spark.range(2).write.parquet(f"{at}-more")
    before = spark.conf.get("spark.checkpoint.dir")
    assert sinks.sweep(spark) >= 1
    assert spark.conf.get("spark.checkpoint.dir") == before
    for path in (at, f"{at}-more"):
        with pytest.raises(Exception, match="(?i)exist"):
            spark.read.parquet(path).count()
