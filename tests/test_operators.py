"""Pass and fail rows, ties, blanks and zero denominators of the operators; folds against plain Python."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import fuzzy
from tallyspark.functions import text as T
from tallyspark.operators import canonical, checks, match, measure, modes, quality, reconcile, sequence, spatial
from tallyspark.sources import tables as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("HHKO001465", "HHK0001465"), ("S 106 -, HHK3535/704", "HHK3535704"), ("hhk-0001465", "HHK0001465"), ("", ""), (None, ""), ("AB123456", "AB123456")])
def test_repair_id(spark, text, want):
    assert one(spark, T.repair_id(F.lit(text))) == want


@pytest.mark.parametrize(("text", "want"), [("55", 55), ("525", 52), ("5 5", 55), ("3/", None), ("", None), ("২৬", 26), ("199", 19), ("999 1", 99)])
def test_age_from(spark, text, want):
    assert one(spark, T.age_from(F.lit(text))) == want


@pytest.mark.parametrize(("text", "want"), [("dated 01-02-2026", "2026-02-01"), ("", ""), (None, ""), ("31-31-2026", "2026-31-31"), ("১০-১১-২০২৫", "2025-11-10")])
def test_iso_date(spark, text, want):
    assert one(spark, T.iso_date(F.lit(text))) == want


def test_small_texts(spark):
    assert one(spark, T.as_int(F.lit(" 12 "))) == 12
    assert one(spark, T.as_int(F.lit("4.0"))) is None
    assert one(spark, T.as_int(F.lit(""))) is None
    assert one(spark, T.house_number(F.lit("no : 12-3/4"), ["no"])) == "12-3/4"
    assert one(spark, T.house_number(F.lit("x 7 y"), ["no"])) == "7"
    assert one(spark, T.longest_reading(F.lit("ab"), F.lit("abc"), F.lit("")))["value"] == "abc"
    assert one(spark, T.section_of(F.lit("the addition list"), [("addition", "a")])) == "a"
    assert one(spark, T.section_of(F.lit("additional"), [("addition", "a")])) == "main"
    assert one(spark, T.leaked_label(F.lit("name of it"), ["name"]))
    assert not one(spark, T.leaked_label(F.lit("surname"), ["name"]))
    assert one(spark, T.human_duration(F.lit(8040.0))) == "2h 14m"
    assert one(spark, T.balancing(F.array(*map(F.lit, (1, 19, 20, 5, 25, 9))))) == [20, 5, 25]
    assert one(spark, T.balancing(F.array(F.lit(1)))) is None
    assert one(spark, T.roman_repair(F.lit("- Xaabc । | "))) == "Sabc"


def test_values_without_debris(spark):
    assert one(spark, T.clean_value(F.lit(" ' | abc :"))) == "abc"
    assert one(spark, T.clean_value(F.lit("ু ' বাসন্তা ৰাভা"))) == "বাসন্তা ৰাভা"
    assert one(spark, T.clean_value(F.lit("ৰেহমাত বসমাতাৰা .ে"))) == "ৰেহমাত বসমাতাৰা"
    assert tuple(one(spark, T.without_foreign(F.lit("নেম2্ৰা")))) == ("নেম্ৰা", True)
    assert tuple(one(spark, T.without_foreign(F.lit("JOHN 1")))) == ("JOHN 1", False)
    assert tuple(one(spark, T.without_foreign(F.lit("ৰাভা 1")))) == ("ৰাভা", False)
    assert one(spark, T.rest_after(F.lit("নাম :' ক খ ."), "নাম")) == "ক খ"


def test_mode_ties_take_the_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, ""), (6, None)], "o int, v string")
    assert modes.modal(df, "v", ["o"]).first()["mode"] == "b"


@pytest.mark.parametrize(("mode", "want"), [("truthy", 1), ("nonblank", 3), ("nonblank_nonzero", 2)])
def test_filled(spark, mode, want):
    df = spark.createDataFrame([("x",), ("0",), ("",), (None,), ("false",)], "v string")
    got = df.filter(modes.filled("v", mode)).count()
    assert got == want


def test_checks_that_cannot_run_are_left_out(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, 3)], "a int, b int")
    out = checks.roll_up(checks.run_checks(df, [checks.Check("a_is_one", "hard", F.col("a") == 1), checks.Check("b_small", "soft", F.col("b") < 4, F.col("b").isNotNull())]))
    got = [(r.checks_total, r.checks_passed, r.flags, r.needs_review) for r in out.collect()]
    assert got == [(1, 1, "", False), (2, 0, "a_is_one;b_small", True), (2, 1, "a_is_one", True)]


def test_duplicate_variants(spark):
    df = spark.createDataFrame([("ABC0000001",), ("ABC0000001",), ("x",), ("x",), ("x",), ("",), (None,)], "v string")
    r = quality.duplicates(df, "v").first()
    assert (r.surplus, r.rows_in_repeats, r.repeated, r.non_empty) == (3, 5, 2, 5)
    r = quality.duplicates(df, "v", T.STRICT_ID).first()
    assert (r.surplus, r.rows_in_repeats) == (1, 2)


def carried(found):
    out, now = [], "main"
    for f in found:
        now = "addition" if now == "addition" and f == "main" else f
        out.append(now)
    return out


def test_carry_against_the_fold(spark):
    kinds = ("main", "addition", "deletion")
    runs = list(itertools.product(kinds, repeat=5))
    df = spark.createDataFrame([(g, i, f) for g, run in enumerate(runs) for i, f in enumerate(run)], "g int, i int, f string")
    got = {}
    for r in sequence.carry_section(df, ["g"], ["i"], "f").orderBy("g", "i").collect():
        got.setdefault(r.g, []).append(r.section)
    assert all(got[g] == carried(run) for g, run in enumerate(runs))


def test_pairing_against_the_fold(spark):
    runs = list(itertools.product(("start", "stop", "other"), repeat=5))
    rows = [(g, i, k) for g, run in enumerate(runs) for i, k in enumerate(run)]
    df = spark.createDataFrame(rows, "g int, i int, k string").withColumn("t", F.timestamp_seconds(F.col("i") * 3600))
    got = {r.g: r.hours for r in sequence.paired_hours(df, ["g"], "t", ["i"], F.col("k") == "start", F.col("k") == "stop", F.timestamp_seconds(F.lit(36000))).collect()}
    for g, run in enumerate(runs):
        open_, hours = None, 0
        for i, k in enumerate(run):
            if k == "start":
                open_ = i
            elif k == "stop" and open_ is not None:
                hours, open_ = hours + i - open_, None
        hours += 10 - open_ if open_ is not None else 0
        assert got.get(g, 0) == pytest.approx(hours)


def test_packing_against_the_fold(spark):
    rnd = random.Random(3)
    rows = [(g, i, float(rnd.randint(1, 30))) for g in range(9) for i in range(20)]
    got = {(r.g, r.i): r.batch for r in sequence.pack_in_order(spark.createDataFrame(rows, "g int, i int, w double"), ["g"], ["i"], "w", 40.0).collect()}
    for g in range(9):
        batch, total = 0, 0.0
        for _, i, w in [r for r in rows if r[0] == g]:
            if total and total + w > 40:
                batch, total = batch + 1, 0.0
            total += w
            assert got[g, i] == batch


def test_lines_against_the_fold(spark):
    words = [("a", 0.0, 0.0, 10.0), ("b", 5.0, 2.0, 12.0), ("c", 1.0, 20.0, 30.0), ("d", 9.0, 29.0, 33.0)]
    df = spark.createDataFrame([(1, *w) for w in words], "g int, text string, left double, top double, bottom double")
    assert [r.text for r in spatial.group_lines(df, ["g"]).orderBy("line").collect()] == ["a b", "c", "d"]


def test_clusters(spark):
    rows = [("f", "1", v) for v in ["street-1"] * 3 + ["strect-1", "street-2", "other"] + [""]]
    got = {r.variant: r.canonical for r in canonical.clusters(spark.createDataFrame(rows, "f string, s string, v string"), "f", "s", "v", 0.8).collect()}
    assert got == {"street-1": "street-1", "strect-1": "street-1", "street-2": "street-2", "other": "other"}


def test_contested_constant_changes_nothing(spark):
    found = spark.createDataFrame([("d", "1", "aaa", "aaa", 3), ("d", "1", "bbb", "bbb", 2), ("d", "2", "aaa", "aaa", 4), ("d", "2", "bbb", "bbb", 2)], "field string, scope string, variant string, canonical string, n long")
    got = {(r.scope, r.variant): (r.target, r.contested) for r in canonical.dominant(found, ["d"]).collect()}
    assert got == {("1", "aaa"): ("aaa", True), ("1", "bbb"): ("bbb", True), ("2", "aaa"): ("aaa", False), ("2", "bbb"): ("aaa", False)}


def test_scoped_match_needs_a_margin(spark):
    t = spark.createDataFrame([("1", "station road"), ("2", "abcd")], "s string, target string")
    c = spark.createDataFrame([("1", "station road"), ("1", "market"), ("2", "abcx"), ("2", "abcy")], "s string, candidate string")
    got = {r.s: (r.candidate, r.status) for r in match.scoped_best(t, c, ["s"]).collect()}
    assert got == {"1": ("station road", "accepted"), "2": ("abcx", "review")}


def test_scoped_match_scores_every_pair(spark):
    t = spark.createDataFrame([("1", "abcdefgh")], "s string, target string")
    c = spark.createDataFrame([("1", "aa"), ("1", "abc")], "s string, candidate string")
    (r,) = match.scoped_best(t, c, ["s"]).collect()
    assert (r.candidate, round(r.score, 6), round(r.runner_up, 6), r.status) == ("abc", round(6 / 11, 6), 0.2, "none")


def test_scoped_match_covers_every_part(spark):
    from tallyspark.functions.fuzzy import ratio
    from tallyspark.plans.canonical import scoped_match
    from tests.conftest import DATA

    parts = spark.read.parquet(f"{DATA}/part.parquet").select("p_partkey", "p_brand", "p_name").collect()
    want = {}
    for p in parts:
        others = {o.p_name for o in parts if o.p_brand == p.p_brand and o.p_partkey != p.p_partkey}
        if others:
            scores = sorted((-ratio(p.p_name + "s", o), o) for o in others)
            want[p.p_partkey] = (scores[0][1], round(-scores[0][0], 9), round(-scores[1][0], 9) if len(scores) > 1 else None)
    got = scoped_match(spark, DATA).collect()
    assert len(got) == len(want)
    assert {r.p_partkey: (r.candidate, r.score, r.runner_up) for r in got} == want


@pytest.mark.parametrize(("right", "total"), [(0, 0), (0, 10), (10, 10), (7, 20)])
def test_wilson(spark, right, total):
    r = one(spark, measure.wilson(F.lit(right), F.lit(total)))
    if not total:
        assert (r.low, r.high) == (0, 0)
    else:
        p, z = right / total, 1.96
        mid, half = (p + z * z / 2 / total) / (1 + z * z / total), z * math.sqrt(p * (1 - p) / total + z * z / 4 / total**2) / (1 + z * z / total)
        assert r.low == pytest.approx(max(0, mid - half))
        assert r.high == pytest.approx(min(1, mid + half))


def test_no_evidence_never_passes(spark):
    none = spark.createDataFrame([], "k int, found long")
    out = reconcile.shortfall(reconcile.against_totals(none, spark.createDataFrame([], "k int, printed int"), ["k"], "found", "printed"), "found", "printed")
    assert out.first().verdict == "no evidence"
    df = spark.createDataFrame([("a", False, False), ("b", True, True)], "g string, external boolean, passed boolean")
    assert {r.g: r.ok for r in reconcile.verdict(df, ["g"]).collect()} == {"a": False, "b": True}


def test_missing_metric_fails_its_gate(spark):
    m = lambda *r: spark.createDataFrame(list(r), "metric string, value double")
    got = {(r.gate, r.metric): r.passed for r in measure.gates(m(("a", 0.5), ("g", 0.9)), m(("a", 0.6)), "a", 0.05, ["g"]).collect()}
    assert got == {("target", "a"): True, ("guard", "g"): False}


def test_csv_keeps_null_and_blank_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, "", True), (2, None, None), (3, "x,\"y\"", False)], "i int, s string, b boolean")
    S.write_csv(df, str(tmp_path / "c"), ["i", "s", "b"])
    back = S.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_with_a_byte_order_mark(spark, tmp_path):
    rows = [("1,2", None), ("", True)]
    S.write_csv(spark.createDataFrame(rows, "a string, b boolean").coalesce(1), str(tmp_path / "m"), ["a", "b"], mark=True)
    raw = next((tmp_path / "m").glob("*.csv")).read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfa,b")
    assert sorted(tuple(r) for r in S.read_csv(spark, str(tmp_path / "m"), "a string, b boolean").collect()) == sorted(rows)


def test_jsonl_and_zip(spark, tmp_path):
    import zipfile

    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{bad\n')
    good, bad = S.jsonl(spark, str(tmp_path / "a.jsonl"), "a int")
    assert [r.a for r in good.collect()] == [1]
    assert bad.count() == 1
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("part-1.txt", "x")
        z.writestr("note", "y")
    got = {r.member: r.matched for r in S.zip_members(spark, str(tmp_path / "z.zip"), r"part-[0-9]+").collect()}
    assert got == {"part-1.txt": True, "note": False}


def test_point_takes_the_first_rectangle(spark):
    pts = spark.createDataFrame([(1, 0, 5.0, 5.0), (2, 0, 50.0, 5.0), (3, 0, 10.0, 5.0)], "pid int, img int, x double, y double")
    rects = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (2, 0, 4.0, 4.0, 20.0, 20.0)], "ord int, img int, left double, top double, right double, bottom double")
    for cell in (None, 3.0):
        got = {r.pid: r.ord for r in spatial.point_in_rect(pts, rects, ["img"], "x", "y", "ord", "pid", cell).collect()}
        assert got == {1: 1, 3: 2}


def test_json_schema(spark):
    got = S.json_schema(spark.createDataFrame([], "a int, b string, c array<struct<d: boolean>>").schema)
    assert got["properties"]["a"] == {"anyOf": [{"type": "integer"}, {"type": "null"}]}
    assert got["required"] == ["a", "b", "c"]


def test_loops_go_as_the_backreference_would(spark):
    import re

    rnd = random.Random(4)
    for _ in range(300):
        unit = "".join(rnd.choice("ab") for _ in range(rnd.randint(5, 30)))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40))) + unit * rnd.randint(1, 9) + "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40)))
        assert fuzzy.unlooped(text) == re.sub(r"(?s)(.{20,}?)\1{2,}", r"\1", text)


def test_rules_are_used_once(spark):
    from tallyspark.operators import routing

    found = spark.createDataFrame([(1, "f", "x"), (2, "f", "x"), (3, "g", "x"), (4, "g", "y")], "o int, failure string, feature string")
    got = sorted((r.failure, r.feature, r.rule) for r in routing.first_rules(found, [("x", "f"), ("x", "*")], ["o"]).collect())
    assert got == [("f", "x", 0), ("f", "x", 1)]


def test_columns_without_dividers(spark):
    from tallyspark.operators import grid

    rules = [(1, x) for x in (39, 541, 554, 567, 1069, 1082, 1094, 1597, 1610)] + [(2, x) for x in (1, 2, 3)]
    got = grid.box_columns(grid.rule_clusters(spark.createDataFrame(rules, "page int, at long"), ["page"], "at"), ["page"]).collect()
    assert sorted((r.page, r.col, r.left, r.divider, r.right) for r in got) == [(1, 0, 39, 427, 541), (1, 1, 567, 955, 1069), (1, 2, 1094, 1482, 1597)]
