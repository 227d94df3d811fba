"""Queries that SQL can't express, against plain Python over the same rows."""

from __future__ import annotations

import collections
import difflib
import re

import pytest

from tallyspark.plans import catalogue
from tests.conftest import DATA


def like(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


@pytest.fixture(scope="module")
def rows(spark):
    held = {}

    def read(name):
        if name not in held:
            held[name] = spark.read.parquet(f"{DATA}/{name}.parquet").collect()
        return held[name]

    return read


def got(spark, name):
    return catalogue.QUERIES[name](spark, DATA).collect()


def noisy(p):
    t = p.p_type
    value = t if p.p_partkey % 7 else t[:4] + "x" + t[5:]
    return f"{value} {p.p_brand} stock"


def folded(parts):
    """{(brand, variant): (head, n)}, values by falling count and then by value, each to the first head that it resembles."""
    counts = collections.Counter((p.p_brand, noisy(p)) for p in parts)
    out, heads = {}, collections.defaultdict(list)
    for (brand, v), n in sorted(counts.items(), key=lambda x: (-x[1], x[0][1])):
        block = brand, re.sub("[^0-9]", "", v)
        head = next((h for h in heads[block] if like(v, h) >= 0.89), None)
        if head is None:
            heads[block].append(v)
        out[brand, v] = head or v, n
    return out


def test_clusters(spark, rows):
    want = folded(rows("part"))
    assert {(r.scope, r.variant): (r.canonical, r.n) for r in got(spark, "canonical_clusters")} == want
    assert len({c for c, _ in want.values()}) < len(want)
    assert {r.p_partkey: r.canonical for r in got(spark, "canonical_applied")} == {p.p_partkey: want[p.p_brand, noisy(p)][0] for p in rows("part")}
    moved = {(brand, v, head, n) for (brand, v), (head, n) in want.items() if head != v}
    assert {(r.scope, r.variant, r.target, r.n) for r in got(spark, "substitutions")} == moved
    totals = collections.defaultdict(collections.Counter)
    for (brand, _), (head, n) in want.items():
        totals[brand][head] += n
    for r in got(spark, "contested_constants"):
        ranked = sorted(((n, c) for c, n in totals[r.scope].items()), reverse=True)
        close = len(ranked) > 1 and ranked[0][0] < 2 * ranked[1][0]
        assert r.contested == close
        assert r.target == (r.variant if close else ranked[0][1])


def best_of(target, candidates):
    """(candidate, score, runner-up, status)."""
    ranked = sorted(((-like(target, c), c) for c in candidates))
    score, runner = -ranked[0][0], -ranked[1][0] if len(ranked) > 1 else None
    clear = runner is None or score - runner >= 0.05
    return ranked[0][1], score, runner, "accepted" if score >= 0.85 and clear else "review" if score >= 0.7 else "none"


def test_scoped_match_and_its_calibration(spark, rows):
    names = collections.Counter((p.p_brand, p.p_name) for p in rows("part"))
    by_brand = collections.defaultdict(set)
    for brand, name in names:
        by_brand[brand].add(name)
    result = {r.p_partkey: r for r in got(spark, "scoped_match")}
    agree = differ = below = 0
    for p in rows("part"):
        others = by_brand[p.p_brand] - ({p.p_name} if names[p.p_brand, p.p_name] == 1 else set())
        if not others:
            assert p.p_partkey not in result
            continue
        c, score, runner, status = best_of(p.p_name + "s", others)
        r = result[p.p_partkey]
        assert (r.candidate, round(r.score, 6), r.status) == (c, round(score, 6), status)
        assert (r.runner_up is None) == (runner is None)
        assert runner is None or abs(r.runner_up - runner) < 1e-6
    for brand, name in names:
        c, _, _, status = best_of(name + "s", by_brand[brand])
        below += status != "accepted"
        agree += status == "accepted" and c == name
        differ += status == "accepted" and c != name
    r = got(spark, "match_calibration")[0]
    assert (r.accepted, r.below, r.agree, r.differ) == (agree + differ, below, agree, differ)


def test_name_similarity(spark, rows):
    head = {}
    for p in rows("part"):
        head[p.p_brand] = min(head.get(p.p_brand, p.p_name), p.p_name)
    want = {p.p_partkey: round(like(p.p_name, head[p.p_brand]), 6) for p in rows("part")}
    assert {r.p_partkey: round(r.score, 6) for r in got(spark, "name_similarity")} == want


def test_bins(spark, rows):
    groups = collections.defaultdict(list)
    for x in rows("lineitem"):
        groups[x.l_orderkey].append((x.l_linenumber, x.l_partkey, x.l_suppkey, x.l_quantity))
    want = collections.Counter()
    for k, xs in groups.items():
        now, total = 0, 0.0
        for i, x in enumerate(sorted(xs)):
            if i and total + x[3] > 60:
                now, total = now + 1, 0.0
            total += x[3]
            want[(k, *x, now)] += 1
    assert collections.Counter((r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_quantity, r.batch) for r in got(spark, "bin_packing")) == want


def test_lines_of_words(spark, rows):
    groups = collections.defaultdict(list)
    for e in rows("events"):
        k = float(re.search("[0-9]+", e.props)[0])
        groups[e.user_id].append((k * 4, float(e.event_id % 97), f"{e.event_type}#{e.event_id}", k * 4 + 6))
    want = set()
    for user, words in groups.items():
        lines = []
        for top, left, text, bottom in sorted(words):
            if lines:
                a, b, held = lines[-1]
                if min(b, bottom) - max(a, top) >= 0.7 * min(b - a, bottom - top):
                    lines[-1] = min(a, top), max(b, bottom), [*held, (left, top, text)]
                    continue
            lines.append((top, bottom, [(left, top, text)]))
        want |= {(user, n, " ".join(t for *_, t in sorted(held, key=lambda m: m[:2])), a, b) for n, (a, b, held) in enumerate(lines)}
    assert {tuple(r) for r in got(spark, "line_grouping")} == want


def test_loops(spark, rows):
    want = {d.doc_id: len(re.sub(r"(?s)(.{20,}?)\1{2,}", r"\1", d.text)) for d in rows("documents") if d.text is not None and len(d.text) < 3000}
    have = {r.doc_id: r.n for r in got(spark, "loops_removed")}
    assert {k: have[k] for k in want} == want


def test_rules_are_proposed_once(spark):
    from tallyspark.operators import measure
    from tallyspark.plans import reports
    from tallyspark.sources.tables import table
    from pyspark.sql import functions as F

    failures = [("big", F.col("l_quantity") > 45), ("cheap", F.col("l_extendedprice") < 5000)]
    found = measure.associations(table(spark, DATA, "lineitem"), failures, ["l_linestatus", "l_returnflag", "l_linenumber"], least_lift=1.0).collect()
    used, want = set(), set()
    for a in sorted(found, key=lambda r: (-round(r.lift, 9), r.failure, r.feature, r.value)):
        for k, (feature, failure) in enumerate(reports._RULES):
            if k not in used and a.feature == feature and failure == a.failure:
                used.add(k), want.add((a.failure, a.feature, k))
                break
    have = {(r.failure, r.feature, r.rule) for r in got(spark, "proposals")}
    assert want <= have
    assert len({k for *_, k in have}) == len(have)


def test_similar_readings(spark, rows):
    import unicodedata

    bare = lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c))
    want = {}
    for f in ("p_name", "p_type"):
        pairs = [(p[f], p[f] + "é" if p.p_partkey % 3 == 0 else p[f][::-1] if p.p_partkey % 3 == 1 else p[f]) for p in rows("part")]
        n = len(pairs)
        want[f] = n, sum(a == b for a, b in pairs) / n, sum(bare(a) == bare(b) for a, b in pairs) / n, sum(like(a, b) for a, b in pairs) / n
    have = {r.field: (r.n, r.exact, r.skeleton, r.similarity) for r in got(spark, "fuzzy_agreement")}
    for f, x in want.items():
        assert have[f] == pytest.approx(x, abs=1e-8)
    assert have["all"][3] == pytest.approx(sum(x[3] for x in want.values()) / 2, abs=1e-8)
