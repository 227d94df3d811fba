"""Source divergence, embedding whitening and min-max hashing against brute force, with odd rows of each."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import divergence, minmax_hash, whitening
from tests.conftest import DATA

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, least=10, top=10):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [WORD.findall(t.translate(TO_LOWER)) for t, _, _ in rows]
    out = set()
    for lang in {la for _, la, _ in rows}:
        held, counts = collections.Counter(), collections.defaultdict(collections.Counter)
        for (_, la, source), w in zip(rows, words, strict=True):
            if la == lang:
                held.update(set(w))
                counts[source].update(w)
        kept = sorted((t for t, n in held.items() if n >= least), key=lambda t: t.encode())
        whole = sum(counts.values(), collections.Counter())

        def p(c, kept=kept):
            below = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // below for t in kept}

        q, ps = p(whole), {s: p(c) for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in counts if o != s]
            term = [(f(ps[s][t], q[t]), t) for t in kept if counts[s][t] > 0 and ps[s][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)}
    return out


def divergence_of(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, Text string, n int").repartition(3)
    return {tuple(r) for r in divergence.source_divergence(docs, **kw).select("lang", "source", "part", "item", "value", "rank").collect()}


def mixed_rows(seed, n=240):
    rnd = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["Élan", "élan", "ÀB", "名前", "naïve", "İx", "\x85b", "a b"]
    rows = []
    for _ in range(n):
        source = rnd.choice("abcd")
        text = "".join(rnd.choice(words[: 20 + 12 * ord(source) % 48]).swapcase() + rnd.choice([" ", "1", "_", "\n", "\x00", "\x7f", "--"]) for _ in range(rnd.randint(0, 40)))
        rows.append((text, rnd.choice(["en", "de", None, ""]), source))
    return [*rows, (None, "en", "a"), ("", "fr", "only"), ("...", "fr", None), ("rare word", "it", "s"), ("big " * 40_000 + "end", "en", "b"), *[("same same thing", "en", "c")] * 30]


@pytest.mark.parametrize(("cells", "held"), [(1 << 20, 1 << 18), (40, 60)])
def test_source_divergence(spark, monkeypatch, cells, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = mixed_rows(cells)
    got = divergence_of(spark, rows, cells=cells)
    assert got == brute_divergence(rows)
    assert {r for r in got if r[0] == "fr"} == {("fr", "only", "pair", "", 0, 1), ("fr", "", "pair", "only", 0, 1)}


def test_source_divergence_of_few_rows(spark):
    assert divergence_of(spark, []) == set()
    rows = [("a b b", "en", "x"), ("b c", "en", "y"), ("c c", "en", "y"), ("a", "en", "z")]
    assert divergence_of(spark, rows, least_docs=1, top=2) == brute_divergence(rows, 1, 2)


def test_shares_are_exact_for_large_counts():
    rnd = random.Random(1)
    for _ in range(300):
        total, kept = rnd.randrange(1, 8 * 10**15), rnd.randrange(1, 10**7)
        n = rnd.choice([0, total, rnd.randrange(total + 1)])
        assert int(divergence.shares(np.array([n]), np.array([total]), kept)[0]) == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_pieces_of_a_task_are_bounded(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    texts = [f"t{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 400, "source": ["s"] * 400, "text": texts})
    sent = list(divergence._count(batch.slice(k, 20) for k in range(0, 400, 20)))
    assert max(len(b) for b in sent) <= 2 * 50 + 20  # what is held may double before it is merged, and one batch more
    assert sum(sum(b.column("n").to_pylist()) for b in sent) == 400


def brute_moments(x):
    n, dims = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(dims)]
    return n, s, [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(dims)] for i in range(dims)]


@pytest.mark.parametrize("wide", [3, 9, 40, 63])
def test_products_of_bit_planes_are_exact(spark, wide):
    rnd = random.Random(wide)
    x = [[rnd.randrange(-(1 << wide), 1 << wide) for _ in range(5)] for _ in range(301)]
    df = spark.createDataFrame([(r,) for r in x], "x array<long>").repartition(3)
    assert whitening.exact_moments(df) == brute_moments(x)


def embeddings(rows, dims, seed):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(rows, dims)) @ rng.normal(size=(dims, dims)) / dims).astype(np.float32).tolist()


def check_whitened(got, rows, components=16):
    """rows: (vec_id, vector) that count. Everything but the signs of components is told by the contract."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    fit = [list(t) for t in dict.fromkeys(map(tuple, x))]
    n, s, centred = brute_moments(fit)
    dims = len(s)
    v = np.array([[c / n**2 for c in row] for row in centred])
    values = np.linalg.eigvalsh(v)[::-1][:components]
    assert {r.n for r in got} == {n}
    want = {i: sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for (i, _), r in zip(rows, x, strict=True)}
    assert {r.vec_id: r.deviation for r in got} == want
    by = collections.defaultdict(dict)
    for r in got:
        by[r.component][r.vec_id] = r
    assert sorted(by) == list(range(1, min(dims, components) + 1))
    mean = np.array([b / n for b in s])
    for k, e in enumerate(values, 1):
        z = np.array([by[k][i].whitened for i, _ in rows])
        assert by[k][rows[0][0]].explained == pytest.approx(e / np.trace(v), rel=1e-9)
        # the projection solves for a vector that V stretches by e, and has variance 1 over the fit list
        first = {t: j for j, t in reversed(list(enumerate(map(tuple, x))))}
        zf = np.array([z[first[tuple(t)]] for t in fit])
        assert np.mean(zf**2) == pytest.approx(1, abs=1e-9)
        direction = (np.array(fit) - mean).T @ zf / n / np.sqrt(e)
        assert np.linalg.norm(direction) == pytest.approx(1, abs=1e-9)
        assert np.allclose(v @ direction, e * direction, atol=1e-9 * values[0])
    assert {r.identity_error for r in got} == {got[0].identity_error}
    assert got[0].identity_error < 1e-9


def test_whitening(spark):
    rows = list(enumerate(embeddings(400, 20, 1)))
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(2000, rows[8][1])]
    odd = [(-1, None), (-2, [None, *rows[0][1][1:]]), (-3, [float("nan"), *rows[0][1][1:]]), (-4, [float("inf")] * 20), (-5, [1.0] * 3), (-6, [])]
    df = spark.createDataFrame([(i, v, "z") for i, v in rows + odd], "vec_id long, embedding array<float>, x string").repartition(4)
    got = whitening.whitened(df).collect()
    assert len(got) == 16 * len(rows)
    check_whitened(got, rows)


def test_whitening_of_few_dimensions_and_rows(spark):
    rows = list(enumerate(embeddings(60, 3, 2)))
    schema = "vec_id long, embedding array<double>"
    got = whitening.whitened(spark.createDataFrame(rows, schema)).collect()
    check_whitened(got, [(i, v) for i, v in rows])
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None)], schema)).collect() == []
    one = whitening.whitened(spark.createDataFrame([(None, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 4
    flat = whitening.whitened(spark.createDataFrame([(k, [float(k), 5.0, 2.0 * k]) for k in range(9)], schema)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat)
    assert flat[0].identity_error < 1e-9
    wide = [(k, [1e15 * k, -1e14 * k * k, float(k % 3)]) for k in range(20)]
    got = whitening.whitened(spark.createDataFrame(wide, schema)).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in wide]
    n, s, _ = brute_moments(x)
    exact = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for (i, _), d in zip(wide, exact, strict=True)}
    assert got[0].identity_error < 1e-4


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER))
    return frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets, up = collections.defaultdict(list), {}
    for d, t in rows:
        sets[d].append(shingles(t))
        up[d] = d

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    flat = [(d, s) for d, each in sets.items() for s in each if s]
    for k, (a, x) in enumerate(flat):
        for b, y in flat[:k]:
            if 100 * len(x & y) >= 80 * len(x | y) and find(a) != find(b):
                a_, b_ = find(a), find(b)
                up[max(a_, b_)] = min(a_, b_)
    return sorted((d, len(shingles(t)), find(d), find(d) == d) for d, t in rows)


def near_copies(seed, groups=6, copies=24, words=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    line = " ".join(rnd.choice(vocabulary) for _ in range(25))
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, words))]
        for _ in range(copies):
            x = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 3, 5))):
                x[rnd.randrange(len(x))] = rnd.choice(vocabulary)
            rows.append(" ".join(x).upper() + (f"\n{line}" if rnd.random() < 0.4 else ""))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def near(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, TEXT string, bucket int").repartition(3)
    got = minmax_hash.near_components(docs, **kw)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize(("small", "few", "tile", "seed"), [(8, 1 << 16, (1 << 17, 1 << 10), 1), (1, 0, (400, 8), 2), (2, 1 << 16, (1 << 17, 5), 3)])
def test_near_components(spark, small, few, tile, seed):
    rows = near_copies(seed)
    assert near(spark, rows, small=small, few=few, tile=tile) == sorted(brute_components(rows), key=repr)


def test_near_components_of_chains_and_short_texts(spark):
    """Each text has one word more than the one before it, so that a component is a long chain; short ones hold 1 to 6 words."""
    words = [f"c{k}" for k in range(60)]
    rows = [" ".join(words[k : k + 24]) for k in range(0, 36)] + [" ".join(words[:k]) for k in range(7)] + [" ".join(words[:k]) + " x" for k in range(7)] + ["a a a a", "A a a", "a"]
    rows = list(enumerate(rows))
    for small, few, tile in ((1, 0, (60, 4)), (8, 1 << 16, (1 << 17, 1 << 10))):
        assert near(spark, rows, small=small, few=few, tile=tile) == sorted(brute_components(rows), key=repr)


def test_near_components_of_one_template(spark):
    """Many texts that share most shingles, of which few link: a crowd that only the tiles can settle."""
    rows = [(d, " ".join([*(f"p{i}" for i in range(12)), f"n{d // 2}", f"m{d // 2}", "last" if d % 2 else "end"])) for d in range(240)]
    assert near(spark, rows, small=2, tile=(1 << 17, 40)) == sorted(brute_components(rows), key=repr)


def test_near_components_of_odd_rows(spark):
    long = "word " * 60_000
    rows = [(1, None), (2, ""), (3, long), (4, long + "more"), (5, "same  text"), (6, "SAME\ttext"), (6, "same\ttext"), (9, "\x1f one"), (10, " ".join(f"k{i}" for i in range(50))), (10, "other words"), (11, " ".join(f"k{i}" for i in range(51)))]
    nameless = [(None, "same text"), (None, None)]
    want = brute_components(rows) + [(None, 1, None, True), (None, 0, None, True)]
    assert near(spark, rows + nameless) == sorted(want, key=repr)
    assert near(spark, []) == []


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(5)
    x = np.sort(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    y = np.sort(np.concatenate((x[:1600], rng.integers(0, 1 << 63, 400, dtype=np.uint64))))  # similarity 2 / 3
    keys = minmax_hash.band_keys(np.concatenate((x, y)), np.array([0, 2000]), bands=600, rows=1)
    assert np.mean(keys[0] == keys[1]) == pytest.approx(2 / 3, abs=0.06)
    assert len(np.unique(keys[0])) == 600


def test_op13_on_the_given_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted(map(tuple, minmax_hash.op13_minmax_near_dedup(spark, DATA).collect()))
    assert got == brute_components(rows)
