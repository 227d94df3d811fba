"""Records out of lines, held against the rules in plain Python."""

from __future__ import annotations

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import fuzzy
from tallyspark.operators import records as R
from tallyspark.plans import records as plans
from tests.conftest import DATA


def like(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


def want_sex(line):
    t = re.sub("[^ঀ-৿]", "", line)[-12:]
    scores = {code: max((like(t[-k:], word) for k in range(2, len(t) + 1)), default=0) for word, code in R.SEX_WORDS}
    best = max(scores, key=scores.get)
    return best if scores[best] >= 0.5 else ""


def want_label(line):
    for m in re.finditer(r"(\S{2,12}?)\s*নাম", line[:48]):
        word = m[1].lstrip("৷| ")
        score, kind = max((like(word, w), k) for w, k in R.RELATIVES) if word else (0, "")
        if score >= 0.5:
            return m.end(), kind if score >= 0.7 else ""
    return None, None


def test_labels_and_sexes(spark):
    lines = plans._lines(spark, DATA, 1).unionByName(plans._lines(spark, DATA, 2))
    extra = [(-1, 0, x) for x in ("", "x", "লিঙ্গ : পুৰুষ", "ঘৰ নং 5", "৷| নাম পিতাৰ নাম : ক", "নামনামনাম", "1লতাৰ নাম", "পি")]
    lines = lines.unionByName(spark.createDataFrame(extra, "box long, k int, line string"))
    got = R.described_lines(lines).collect()
    assert len(got) == lines.count()
    for r in got:
        assert (r.ends, r.kind) == want_label(r.line), r.line
        assert r.sex == want_sex(r.line), r.line


def test_likeness_in_place(spark):
    """Endings and words of any letters: pruned alignments change no winner, equals go to the first word and the larger code."""
    r, letters = random.Random(5), "পুৰষমহিলাতৃীয়ক"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(13))) for _ in range(600)]
    words = (*R.SEX_WORDS, ("ৰুষপু", "X"), ("পুৰুষ", "Y"))
    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", fuzzy.ending_code(F.col("t"), words, 0.4).alias("code")).collect()
    for t, code in got:
        scores = [(max((like(t[-k:], w) for k in range(2, len(t) + 1)), default=0), -p, c) for p, (w, c) in enumerate(words)] if t else [(0, 0, None)]
        assert code == (max(scores)[2] if max(scores)[0] >= 0.4 else None), t
    arrays = [[t for t in (texts[k : k + 3])] for k in range(0, 600, 3)] + [[], ["", "পিতাৰ"], None]
    rows = spark.createDataFrame([(k, a) for k, a in enumerate(arrays)], "n int, a array<string>").select("n", fuzzy.first_like(F.col("a"), R.RELATIVES, 0.3, 0.5).alias("f")).collect()
    for n, f in rows:
        best = [(k, *max((like(t, w), c) for w, c in R.RELATIVES)) for k, t in enumerate(arrays[n] or ()) if t]
        assert tuple(f) == next(((k, c if s >= 0.5 else "") for k, s, c in best if s >= 0.3), (None, None)), arrays[n]


NO_BROADCAST = ["bottom_up_bands", "record_assembly", "relations_and_sexes", "second_reading_gate"]


@pytest.mark.parametrize("name", NO_BROADCAST)
def test_no_lines_are_broadcast(spark, name):
    """Spark's estimates leave out what explode adds, so that it broadcast rows in the number of the boxes."""
    assert "Broadcast" not in getattr(plans, name)(spark, DATA)._jdf.queryExecution().executedPlan().toString()


BOXES = {
    # lines, what the bands are: name, relation, house, age
    1: (["নাম : ক", "পিতাৰ নাম : খ", "ঘৰ নং : 5", "বয়স : 44 লিঙ্গ : পুৰুষ"], (0, 1, 2, 3)),
    2: (["নাম : ক", "পিতাৰ নাম : খ", "বয়স : 44"], (0, 1, None, 2)),
    3: (["ক", "xx", "পিতাৰ নাম : খ", "ঘৰ 5"], (1, 2, 3, None)),
    4: (["নাম : ক", "xx", "পিতাৰ নাম : খ", "ঘৰ 5"], (0, 2, 3, None)),
    5: (["ক", "খ", "গ", "লঙ্গ 3"], (0, 1, 2, 3)),
    6: (["খ", "গ"], (None, 0, 1, None)),
    7: (["নাম ক", "খ", "গ", "ঘ", "বয়স 30"], (1, 2, 3, 4)),
    8: (["গ"], (None, None, 0, None)),
    9: (["বয়স 30", "বয়স 31"], (None, None, 0, 1)),
}


def test_bands(spark):
    rows = [(b, k, x) for b, (lines, _) in BOXES.items() for k, x in enumerate(lines)]
    found = R.bands(R.described_lines(spark.createDataFrame(rows, "box long, k int, line string")), ["box"]).collect()
    for r in found:
        lines, at = BOXES[r.box]
        assert tuple(getattr(r, c) and getattr(r, c).line for c in ("name", "relation", "house", "age")) == tuple(None if k is None else lines[k] for k in at), r.box


def test_assembly(spark):
    first = {1: ["নাম : কমল", "পিতাৰ নাম : খগেন", "ঘৰ নং : 5/2", "বয়স : 44 লিঙ্গ : পুৰুষ"], 2: ["নাম : গজ2েন", "পিতাৰ নাম : ঘন", "বয়স : 3/ লিঙ্গ মহিলা"], 4: ["নাম : কমল", "স্বামীৰ নাম : খ1", "বয়স : 525"]}
    second = {1: ["নাম : কমলা"], 2: ["নাম : ঝৰ্ণা টুলু"], 4: ["পিতাৰ নাম : ঙচছ"]}
    bands = [R.bands(R.described_lines(spark.createDataFrame([(b, k, x) for b, xs in lines.items() for k, x in enumerate(xs)], "box long, k int, line string")), ["box"]) for lines in (first, second)]
    boxes = spark.createDataFrame([(1, "hhk 0001471", "# 12"), (2, "", None), (3, None, None), (4, "AB1234567", "x")], "box long, id_strip string, serial_strip string")
    got = {r.box: r for r in R.assemble(boxes, *bands, ["box"], "id_strip", "serial_strip").collect()}
    fields = lambda r: (r.name, r.relation_name, r.relation_type, r.house_no, r.age, r.sex, r.id, r.serial)
    assert fields(got[1]) == ("কমল", "খগেন", "father", "5/2", 44, "M", "HHK0001471", 12)
    assert got[1].flags == ["name_disagreement"] if like("কমল", "কমলা") < 0.9 else got[1].flags == []
    assert fields(got[2]) == ("গজেন", "ঘন", "father", "", None, "F", "", None)
    assert got[2].flags == ["name_disagreement", "name_repaired", "age_unreadable", "no_epic", "no_age"]
    assert fields(got[3]) == ("", "", "", "", None, "", "", None)
    assert got[3].flags == []
    assert got[4].flags[-2:] == ["age_ambiguous", "no_sex"]
    assert got[4].age == 52


def test_assembly_of_one_reading(spark):
    """A box of the second reading alone takes no name from it; one of the first alone keeps its own."""
    of = lambda lines: R.bands(R.described_lines(spark.createDataFrame([(b, k, x) for b, xs in lines.items() for k, x in enumerate(xs)], "box long, k int, line string")), ["box"])
    boxes = spark.createDataFrame([(1, None, None), (2, None, None)], "box long, id_strip string, serial_strip string")
    got = {r.box: r for r in R.assemble(boxes, of({1: ["নাম : কমল", "পিতাৰ নাম : খ"]}), of({2: ["নাম : কমল", "পিতাৰ নাম : খগেন"]}), ["box"], "id_strip", "serial_strip").collect()}
    assert (got[1].name, got[2].name, got[2].relation_name) == ("কমল", "", "খগেন")


def test_struck_and_rows_by_label(spark):
    words = spark.createDataFrame([(1, "OELETFD"), (1, "x"), (2, "ABC1234567"), (2, "DEL"), (3, None), (4, "deleted.")], "box long, word string")
    assert {r.box: r.struck for r in R.struck_off(words, ["box"], "word").collect()} == {1: True, 2: False, 3: False, 4: True}
    rows = spark.createDataFrame([(1, 0, "Dte"), (1, 1, "Date"), (1, 2, "Naem"), (1, 3, "zz")], "form long, k int, label string")
    got = {r.k: r.field for r in R.rows_by_label(rows, ["form"], "k", "label", [("Date", "date"), ("Name", "name")]).collect()}
    assert got == {0: "date", 1: None, 2: "name", 3: None}


@pytest.mark.parametrize("name", ["second_reading_gate", "record_assembly", "row_labels", "struck_off_stamps"])
def test_every_key_has_its_rows(spark, name):
    got = getattr(plans, name)(spark, DATA)
    assert got.count() > 0
    assert got.columns


def test_what_fails_a_query(spark):
    from pyspark.errors import PySparkException

    from tallyspark.operators import predicates as P
    from tallyspark.sources import sinks as S

    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(PySparkException, match="duplicate key 1"):
        S.keyed(twice, ["k"]).collect()
    assert S.keyed(twice.filter("v <> 'b'"), ["k"]).count() == 2
    codes = spark.createDataFrame([(1, "x")], "k int, name string")
    with pytest.raises(PySparkException, match="unknown code 2"):
        P.with_dimension(twice, codes, "k").collect()
    at = S.scratch(spark, "refused")
    with pytest.raises(ValueError, match="refused"):
        S.write_if_sound(codes, twice, at)
    with pytest.raises(PySparkException):
        spark.read.parquet(at).count()
    assert P.profile_problems(["a"], ["a", "b"], ["x"]) == ["labels and fields differ in length", "too few anchors"]
    assert P.ordered_columns(["a", "b"], ["b", "c"], without=["a"]) == ["b", "c"]
