"""Geometry joins and medians of a hot key against plain Python, at several cells; small operators of second readings."""

from __future__ import annotations

import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import canonical, match, modes, parts, spatial


@pytest.mark.parametrize("cell", [3.0, 32.0, 1000.0])
def test_bands_meet_their_words(spark, cell):
    rnd = random.Random(cell)
    words = [(rnd.choice([0, 0, 0, 1, None]), i, t := rnd.uniform(-50, 200), t + rnd.choice([0, 1, 8, 60])) for i in range(120)] + [(0, 900, None, 3.0), (0, 901, 9.0, 2.0)]
    bands = [(rnd.choice([0, 0, 1, 2]), i, t := rnd.uniform(-50, 200), t + rnd.choice([1, 9, 90])) for i in range(60)]
    got = spatial.band_overlap(spark.createDataFrame(words, "k int, w int, top double, bottom double"), spark.createDataFrame(bands, "k int, b int, band_top double, band_bottom double"), ["k"], 0.5, cell)
    want = {(w, b) for k, w, t, u in words for j, b, s, e in bands if k == j and t is not None and u > t and max(0, min(u, e) - max(t, s)) >= 0.5 * (u - t)}
    rows = [(r.w, r.b) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == want


@pytest.mark.parametrize("tolerance", [0.0, 2.0, 7.5])
def test_nearest_within(spark, tolerance):
    rnd = random.Random(tolerance)
    expected = [(rnd.choice(["a", "a", "b", None]), float(rnd.randint(0, 80)) / 2) for _ in range(90)] + [("a", None)]
    found = [(rnd.choice(["a", "a", "c"]), float(rnd.randint(-10, 90)) / 2) for _ in range(30)] + [("a", None)]
    got = spatial.nearest_within(spark.createDataFrame(expected, "k string, v double"), spark.createDataFrame(found, "k string, h double"), ["k"], "v", "h", tolerance)

    def best(k, v):
        near = sorted((abs(v - h), h) for j, h in found if v is not None and k is not None and j == k and h is not None and abs(v - h) <= tolerance)
        return near[0][1] if near else None

    assert sorted(((r.k, r.v, r.h) for r in got.collect()), key=repr) == sorted(((k, v, best(k, v)) for k, v in expected), key=repr)


@pytest.mark.parametrize("tolerance", [0.0, 1.0, 3.0])
def test_values_that_every_page_has(spark, tolerance):
    rnd = random.Random(tolerance)
    rows = [(rnd.choice(["a", "b"]), p, float(rnd.randint(0, 40)) / 2) for p in range(4) for _ in range(14)] + [("c", 1, 5.0), ("c", 2, None)]
    got = {tuple(r) for r in spatial.on_every_page(spark.createDataFrame(rows, "k string, page int, v double"), ["k"], "page", "v", tolerance).collect()}
    want = set()
    for k in "abc":
        pages = {p: {v for j, q, v in rows if (j, q) == (k, p) and v is not None} for j, p, _ in rows if j == k}
        want |= {(k, v) for v in pages[min(pages)] if all(any(abs(v - x) <= tolerance for x in xs) for xs in pages.values())}
    assert got == want


@pytest.mark.parametrize("cell", [4.0, 50.0])
def test_words_within_rectangles(spark, cell):
    rnd = random.Random(cell)
    words = [(0, i, a := rnd.uniform(-20, 150), a + rnd.uniform(0, 30), t := rnd.uniform(-20, 150), t + 6) for i in range(150)]
    rects = [(0, i, a := rnd.uniform(-20, 150), a + rnd.uniform(0, 90), t := rnd.uniform(-20, 150), t + rnd.uniform(0, 60)) for i in range(50)]
    got = spatial.words_within(spark.createDataFrame(words, "k int, w int, left double, right double, top double, bottom double"), spark.createDataFrame(rects, "k int, r int, rect_left double, rect_right double, rect_top double, rect_bottom double"), ["k"], 2.0, cell)
    want = sorted((w, r) for _, w, a, b, t, u in words for _, r, x, y, s, e in rects if a >= x - 2 and b <= y + 2 and s <= (t + u) / 2 < e)
    assert sorted((x.w, x.r) for x in got.select("w", "r").collect()) == want


def test_words_and_rectangles_of_one_place(spark):
    """Many words and rectangles at few places: every pair of rows, while the join meets places and broadcasts none."""
    words = [(k % 2, i, (i % 3) * 40.0, (i % 3) * 40.0 + 9, 10.0, 16.0 + k) for k in range(3) for i in range(60)]
    rects = [(k, i, None if i == 7 else (i % 2) * 30.0, 60.0 + (i % 2) * 40, 0.0, 40.0, {"a": i}) for k in range(2) for i in range(40)]
    w = spark.createDataFrame([*words, (None, 1, 0.0, 9.0, 10.0, 16.0), (0, 2, None, 9.0, 10.0, 16.0)], "k int, w int, left double, right double, top double, bottom double")
    r = spark.createDataFrame(rects, "k int, r int, rect_left double, rect_right double, rect_top double, rect_bottom double, note map<string,int>")
    got = spatial.words_within(w, r, ["k"])
    assert got.columns == ["k", "w", "left", "right", "top", "bottom", "r", "rect_left", "rect_right", "rect_top", "rect_bottom", "note"]
    want = sorted((k, w, u, r) for k, w, a, b, t, u in words for j, r, x, y, s, e, _ in rects if j == k and x is not None and a >= x - 2 and b <= y + 2 and s <= (t + u) / 2 < e)
    assert sorted((x.k, x.w, x.bottom, x.r) for x in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert spatial.words_within(w.drop("w"), r.drop("r", "note"), ["k"]).count() == len(want)


def test_upper_medians(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, *range(12)])) for _ in range(400)] + [("n", None)]
    got = {r.k: (r.n, r.m) for r in modes.upper_medians(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", "m").collect()}
    want = {}
    for k in ("a", "b", None):
        x = sorted(v for j, v in rows if j == k and v is not None)
        want[k] = len(x), x[len(x) // 2]
    assert got == want


@pytest.mark.parametrize("threshold", [0.89, 0.75, 0.6])
def test_clusters_of_one_block(spark, threshold):
    """Values of one block, short, long and with repeated pairs, each to the first head that is alike; the bound of shared
    pairs loses none."""
    rnd = random.Random(threshold)
    bases = ["a", "ab", "aba", "abab", "banana", "bananas", "north east", "aaaaaaaa", "the old market place", "x" * 30] + ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 25))).strip() or "q" for _ in range(12)]
    values = []
    for b in bases:
        for _ in range(rnd.randint(1, 6)):
            v = list(b)
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(v) + 1)
                v[i : i + rnd.randint(0, 1)] = rnd.choice(["", "a", "b", "z"])
            values += ["".join(v)] * rnd.randint(1, 3)
    values = [v for v in values if v.strip()]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (" ",)], "v string").selectExpr("'f' AS f", "1 AS s", "v")
    got = {r.variant: (r.canonical, r.n) for r in canonical.clusters(df, "f", "s", "v", threshold).collect()}
    counts, heads, want = Counter(values), [], {}
    for v, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        head = next((h for h in heads if SequenceMatcher(None, v, h, autojunk=False).ratio() >= threshold), None)
        if head is None:
            heads.append(v)
        want[v] = head or v, n
    assert got == want
    assert len(heads) < len(want)


def test_small_operators_of_second_readings(spark):
    rows = [(1, 30, "12", "F"), (2, None, "12", "F"), (3, 30, "", "F"), (4, 30, None, "F"), (5, 30, "1", ""), (6, 0, "1", "M")]
    df = spark.createDataFrame(rows, "k int, age int, house string, sex string")
    assert [r.k for r in df.filter(match.needs_second_pass(F.col("age"), F.col("house"), F.col("sex"))).orderBy("k").collect()] == [2, 3, 4, 5]
    arm = match.readings_arm(spark.createDataFrame([("p3_pg2_r1c0", "নাম: ক|বয়স: ২৫|লিঙ্গ: Male"), ("p3_pg2_r1c0", None), ("p3_pg2_r1c1", ""), ("p3_pg2_r1c1_b2", "নাম: খ"), ("else", "নাম: গ"), (None, "x")], "name string, t string"), "name", "t", "arm")
    assert sorted(tuple(r) for r in arm.collect()) == [("arm", 3, 2, 1, 0, "ক", 25, "", "M"), ("arm", 3, 2, 1, 1, "", None, "", "")]
    queue = match.review_queue(spark.createDataFrame([("a", 1, None, 0), ("b", 5, "", 1), ("c", 5, " ", 2), ("d", 9, "set", 3), ("e", 5, None, 4)], "native string, frequency int, roman string, at int"), "at")
    assert [r.native for r in queue.collect()] == ["b", "c", "e", "a"]
    shares = parts.part_shares(spark.createDataFrame([(1, 7, 9, 3, 4, 1, 1), (2, 7, None, 0, 0, None, 1), (3, 7, 7, 1, 0, 0, 0)], "k int, n int, e int, m int, f int, em int, ef int"), "n", "e", "m", "f", "em", "ef")
    assert sorted((r.k, r.shortfall, r.male_share, r.expected_male_share) for r in shares.collect()) == [(1, -2, 3 / 7, 0.5), (2, None, None, None), (3, 0, 1.0, None)]
