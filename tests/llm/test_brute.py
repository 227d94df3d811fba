"""Operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import io
import random
import re
import types
import wave
import zipfile

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tallyspark.llm import chat_format, chroma, exact_dedup, language_id, merge_dropout, mixing, ngram_join, suffix_dedup, toxicity, warc_zip
from tallyspark.llm.queries import QUERIES, SQL
from tests.conftest import DATA, rows_of

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    shared = collections.Counter((a, b) for ds in holders.values() for i, b in enumerate(ds) for a in ds[:i])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(seed, groups=6, copies=14, words=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    line = " ".join(rnd.choice(vocabulary) for _ in range(25))
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(5, words))]
        for _ in range(copies):
            x = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 3))):
                x[rnd.randrange(len(x))] = rnd.choice(vocabulary)
            rows.append(" ".join(x) + (f"\n{line}" if rnd.random() < 0.4 else ""))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def joined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, **kw).collect()}


@pytest.mark.parametrize(("small", "least", "flush", "seed"), [(8, 8, 1 << 20, 1), (2, 2, 300, 2), (1, 4, 300, 4)])
def test_ngram_join(spark, small, least, flush, seed):
    rows = near_copies(seed)
    assert joined(spark, rows, small=small, frequent=least, flush=flush) == brute_components(rows)


def nested_texts(most=12):
    """Texts of 1 to `most` shingles, each the one before it and one word more, at either end and over several stems."""
    out = []
    for k in range(4):
        w = [f"s{k}x{i}" for i in range(most + 4)]
        out += [" ".join(w[:i]) for i in range(1, most + 5)] + [" ".join(w[-i:]) for i in range(1, most + 5)]
        out += [" ".join([*w[:i], "tail"]) for i in range(3, most + 4)]
    return list(enumerate(out))


@pytest.mark.parametrize(("small", "least"), [(8, 8), (1, 2)])
def test_ngram_join_of_nested_sets(spark, small, least):
    rows = nested_texts()
    rows += [(len(rows) + d, t) for d, t in enumerate(f"{x} {y}" for _, x in rows[:30] for y in ("", "late"))]
    assert joined(spark, rows, small=small, frequent=least) == brute_components(rows)


def test_ngram_join_of_mosaics(spark, monkeypatch):
    """Texts made of shared passages: all tokens are frequent, pairs of them crowd many components, longer ones tell them apart."""
    rnd = random.Random(11)
    passages = [" ".join(f"p{k}w{i}" for i in range(rnd.randint(5, 18))) for k in range(7)]
    rows = list(enumerate(" ".join(rnd.choice(passages) for _ in range(rnd.randint(1, 6))) for _ in range(260)))
    seen = []
    monkeypatch.setattr(ngram_join, "_indexed", lambda *a, f=ngram_join._indexed, **k: seen.append(a[4]) or f(*a, **k))
    assert joined(spark, rows, small=2, flush=600, tiled=0) == brute_components(rows)
    assert seen[:2] == [2, 3]


@pytest.mark.parametrize("k", [2, 3, 4])
def test_linked_sets_share_a_combination(k):
    rnd = np.random.default_rng(k)
    bits = np.full(1 << (ngram_join.SLOT_BITS - 3), 0, np.uint8)
    for _ in range(4000):
        n = int(rnd.integers(4, 60))
        x = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
        drop, add = int(rnd.integers(0, n // 5 + 1)), int(rnd.integers(0, n // 5 + 1))
        y = np.concatenate((x[drop:], rnd.integers(0, 1 << 63, add, dtype=np.uint64)))
        x, y = np.sort(x), np.sort(y)
        if not ngram_join._linked(x, y) or (k > 2 and len(x) + len(y) < {3: 14, 4: 36}[k]):
            continue
        often = rnd.random() < 0.6
        bits[:] = 255 if often else 0
        if not often:
            for t in np.concatenate((x, y)):
                if rnd.random() < 0.9:
                    slot = int(t >> np.uint64(64 - ngram_join.SLOT_BITS))
                    bits[slot >> 3] |= 128 >> (slot & 7)
        a, b = ngram_join.index_keys(x, bits, k), ngram_join.index_keys(y, bits, k)
        assert set(a[0].tolist()) & set(b[0].tolist()) or set(a[1].tolist()) & set(b[1].tolist())


def test_sets_that_share_a_class_sum_meet(spark):
    rows = near_copies(6, groups=3, copies=8)
    assert joined(spark, rows, wide=3) == brute_components(rows)


def template_lines(spark, lines):
    """Documents of one template whose 13th of 14 words differs, and their rows in one large bucket."""
    docs = [(d, " ".join([f"p{i}" for i in range(12)] + [f"n{d // 2 if d < 20 else d}", "last" if d % 2 else "end"])) for d in range(lines)]
    members = spark.createDataFrame([(1, d, 10, 0, d, 0) for d, _ in docs], "bucket long, class_id long, n long, r long, label long, lo long")
    return docs, spark.createDataFrame(docs, "doc_id long, text string"), members


def test_tiles_are_bounded_in_members(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_tile", lambda t: pa.table({"a": pa.array([t.num_rows], pa.int64()), "b": pa.array([0], pa.int64())}))
    _, docs, members = template_lines(spark, 6000)
    sizes = [r.a for r in ngram_join.between_components(docs, members).collect()]
    assert max(sizes) <= 1.2 * 2 * 1024


def test_tiles_by_members_find_every_link(spark):
    rows, docs, members = template_lines(spark, 300)
    sets = {d: shingles(t) for d, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(want) == 10
    assert {(r.a, r.b) for r in ngram_join.between_components(docs, members, tile_members=32).collect()} == want


@pytest.mark.parametrize("copies", [40, 80, 160])
def test_crowds_in_a_scan_make_no_rows_of_their_own(copies):
    """A flush is one row for each range at most, however large its groups are, with each star pair once and every member."""
    rnd = random.Random(copies)
    base = [f"w{k}" for k in range(80)]
    texts = [" ".join(w if k != at else f"x{d}" for k, w in enumerate(base)) for d in range(copies) for at in [rnd.randrange(80)]]
    sent = types.SimpleNamespace(value=b"\xff" * (1 << (ngram_join.SLOT_BITS - 3)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(copies), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(list(ngram_join._index_scan(ngram_join.Plan(16), sent)(iter([batch]))))
    assert out.num_rows <= 16
    pairs, members = [], set()
    for body in out.column("body"):
        f = ngram_join.fields(body.as_py())
        pairs += zip(ngram_join.unpack_sorted(f[4]).tolist(), ngram_join.unpack(f[5]).tolist(), strict=True)
        members |= set(zip(ngram_join.unpack_sorted(f[6]).tolist(), ngram_join.unpack(f[7]).tolist(), strict=True))
    assert len(pairs) == len(set(pairs))
    key = {}
    for s in ngram_join.shingle_sets(pa.array(texts)):
        cls = ngram_join.class_keys(s)[0] & (1 << 64) - 1
        for k in ngram_join.index_keys(s, np.frombuffer(sent.value, np.uint8))[1] >> np.uint64(64 - ngram_join.KEY_BITS) | np.uint64(1):
            key.setdefault(int(k), set()).add(cls)
    assert members == {(c, k) for k, cs in key.items() if len(cs) > ngram_join.SMALL for c in cs}


def test_pieces_do_not_depend_on_lots(spark):
    rows = [*near_copies(3, groups=2, copies=5), (900, None), (901, ""), (902, "▁ " * 9), (903, "long" * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want, *others = [sorted(map(tuple, merge_dropout.encode_pieces(docs, lot=n).collect())) for n in (merge_dropout.LOT, 1, 300)]
    assert len(want) == len(rows) and others == [want, want]


def brute_removed(rows, width=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            k = b[i : i + width]
            if k in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(k)
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out[d] = len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()
    return out


@pytest.mark.parametrize("crowd", [1, 2, 16384])
def test_suffix_dedup(spark, crowd):
    rnd = random.Random(crowd)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (12, 30, 30, 60, 200)]
    rows = []
    for d in range(40):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(word() for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 5))]
        rows.append((d * 3, " ".join(parts)))
    rows += [(1000, "a" * 350), (1001, "ab" * 300), (1002, rows[5][1]), (1003, passages[4][50:149]), (1004, passages[4][50:150])]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(df, crowd=crowd).collect()}
    assert got == brute_removed(rows)


def test_suffix_array_and_lpf():
    data = np.array([x + 1 for x in b"abracadabra abracadabra"] + [0], np.uint16)
    order, rank = suffix_dedup.suffix_array(data, 4)
    heads = [tuple(data[i : i + 4]) + (0,) * (4 - len(data[i : i + 4])) for i in range(len(data))]
    assert [heads[i] for i in order] == sorted(heads)
    assert all((rank[i] == rank[j]) == (heads[i] == heads[j]) for i in range(len(data)) for j in range(len(data)))
    reach = suffix_dedup.lpf_reaches(order, rank, np.arange(len(data)))
    assert reach.tolist() == [heads[i] in heads[:i] for i in range(len(data))]


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, DATA).toPandas()) == rows_of(duck.execute(SQL[name]).df())


@pytest.mark.parametrize("fan_in", [2, 3, 8])
def test_exact_dedup_merges_sorted_runs(spark, monkeypatch, fan_in):
    monkeypatch.setattr(exact_dedup, "RANGE", 64)
    rnd = random.Random(fan_in)
    rows = [(rnd.choice((None, rnd.randrange(10_000))), " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 6)))) for _ in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    kept, runs = [], []
    monkeypatch.setattr(exact_dedup, "merged_runs", lambda r, n, f=exact_dedup.merged_runs: runs.append(r) or kept.append(f(r, n)) or kept[-1])
    got = exact_dedup.exact_dedup(docs, fan_in=fan_in)
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[t].append(d)
    least = {t: min((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = collections.Counter((d, least[t], len(groups[t]), d == least[t], digest(t)) for d, t in rows)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    for df, most in ((runs[0], 11), (kept[0], 1)):
        bodies = df.collect()
        assert len({r.range for r in bodies}) == 10
        assert max(collections.Counter(r.range for r in bodies).values()) <= most
        for r in bodies:
            keys = [row[:3] for row in np.frombuffer(r.body, exact_dedup.RUN).tolist()]
            assert keys == sorted(set(keys))
    plan = exact_dedup.digest_runs(docs.select("doc_id", *(docs.text.cast(t).alias(c) for c, t in (("digest", "binary"), ("bytes", "long"), ("second", "long")))), 700)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" in plan


def test_language_id_learns_many_languages_and_scores_each_row(spark):
    rows = [(i, chr(0x4E00 + i // 6) * 30, f"l{i // 6}") for i in range(180)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_rows=20, epochs=1).collect()
    assert len(got) == 180
    assert len({r.lang_pred for r in got} - {"und"}) > 2


def test_language_id_held_out(spark):
    rnd = random.Random(5)
    make = {"xa": "aeiou lmn", "xb": "äöü schpf", "xc": "ñóí rrdoqu"}
    rows = [(i, "".join(rnd.choice(make[la]) for _ in range(200)), la) for i in range(300) for la in [rnd.choice(list(make))]]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {d: la for d, _, la in rows}
    held = [r for r in got if r.held_out]
    assert len(held) > 50
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_temperature():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert language_id.fit_temperature(5 * z, y) == pytest.approx(5, rel=0.15)


def test_toxicity_learns_and_holds_out(spark):
    rnd = random.Random(6)
    plain = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        words = [rnd.choice(plain) for _ in range(40)]
        if bad:
            for _ in range(3):
                words.insert(rnd.randrange(40), rnd.choice(("zorgo", "krampak")) + rnd.choice(("", "ed", "ing", "ness")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    truth = dict(labels)
    held = [r for r in toxicity.score_toxicity(docs, lab).collect() if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_grammar():
    lexicon, machine = toxicity.Lexicon({"scum": 5.0}), toxicity.grammar()
    read = lambda s: [p for p, _ in toxicity.clause_matches(s, lexicon, machine)]
    assert read("you are scum") == ["insult at target"]
    assert read("what scum") == ["insult"]
    assert read("he is not scum") == ["insult negated"]
    assert read("she said scum") == ["insult reported"]
    assert read("i will kill you") == ["threat at target"]
    assert read("nothing here") == []
    assert read("scum that you are") == read("you scum") == ["insult at target"]
    assert read('"scum" and scum') == ["insult reported", "insult"]
    weigh = lambda s: [w for _, w in toxicity.clause_matches(s, lexicon, machine)]
    assert weigh("kill it") == [1.0]
    assert weigh("i will kill it") == [toxicity.MEANT]
    assert weigh("such scum") == [5 * toxicity.LAID_ON]
    assert weigh("you such scum") == [5 * toxicity.LAID_ON * toxicity.AIMED]


def mixture(spark, n=4000):
    rnd = random.Random(7)
    rows = [(i, " ".join(["w"] * rnd.randint(1, 300)), rnd.choice("abbb"), rnd.choice(["s1", "s2", "s2", "s3", "s3", "s3"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_mixing_hits_its_targets(spark):
    rows, docs = mixture(spark)
    cells, total, gap = mixing.cell_weights(mixing.described(docs))
    assert gap < 1e-9
    assert total == sum(len(t.split()) for _, t, _, _ in rows)
    tokens, weight = collections.Counter(), collections.Counter()
    for _, t, _, s in rows:
        tokens[s] += len(t.split())
    for r in cells.collect():
        weight[r._mx_source] += r._mx_w
    norm = sum(v**0.5 for v in tokens.values())
    assert all(weight[s] == pytest.approx(tokens[s] ** 0.5 / norm, abs=1e-9) for s in tokens)


def test_named_targets_show_in_the_kept_sample(spark):
    """Source s1 is asked for more than its cells hold of either language alone, so some weights are cut and dealt on."""
    rows, docs = mixture(spark)
    named = {"source": {"s1": 3, "s2": 3, "s3": 4}, "language": {"a": 0.45, "b": 0.55}}
    _, _, gap = mixing.cell_weights(mixing.described(docs), 0.45, rounds=400, targets=named)
    assert gap < 1e-6
    out = mixing.mix(docs, budget=0.45, rounds=400, targets=named).collect()
    assert any(r.keep_prob > 1 - 1e-9 for r in out)
    kept, source, language = {r.doc_id: r.n_tokens for r in out if r.kept}, collections.Counter(), collections.Counter()
    for d, _, la, s in rows:
        source[s] += kept.get(d, 0)
        language[la] += kept.get(d, 0)
    n = sum(kept.values())
    assert n == pytest.approx(0.45 * sum(len(t.split()) for _, t, _, _ in rows), rel=0.03)
    for have, want in ((source, named["source"]), (language, named["language"])):
        assert all(have[k] / n == pytest.approx(v / sum(want.values()), abs=0.02) for k, v in want.items())
    given = docs.withColumn("subject", docs.source)
    assert {r.topic for r in mixing.mix(given, topic_col="subject").collect()} == {"s1", "s2", "s3"}
    with pytest.raises(ValueError):
        mixing.mix(docs, targets={"source": {"absent": 1.0}})


TEXTS = ["Hello  world\n\tthe end ", "▁ literal ▁▁ marks", "日本語 \U0001f600 <s> </s> <0x0A>", "a" * 500, "", " ", "Ünïcödé, naïve. words; words"]


def test_pieces_without_dropout_are_the_models_own():
    sp = sentencepiece.SentencePieceProcessor(model_file=merge_dropout.MODEL)
    e = merge_dropout.Encoder(merge_dropout.MODEL, 0, 1)
    for t in TEXTS:
        if "▁" not in t:
            assert e.encode(t) == sp.encode(t)


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_dropout_round_trips_and_varies(dropout):
    e = merge_dropout.Encoder(merge_dropout.MODEL, dropout, 3)
    for t in TEXTS:
        assert merge_dropout.decode(e.encode(t, 1)) == t
    words = sorted({w for k in range(300) for w in e._split([f"▁tion{k}ingness"])[0] if 1 < len(w) <= merge_dropout.SHORT})
    keys = np.random.default_rng(1).integers(0, 1 << 63, len(words), dtype=np.uint64)
    table, p = merge_dropout.pair_table(merge_dropout.MODEL), merge_dropout.pieces(merge_dropout.MODEL)
    for w, k, x in zip(words, keys, merge_dropout.merge_many(words, keys, table, e.limit), strict=True):
        assert np.frombuffer(x, "<i4").tolist() == merge_dropout.merge(w, p, int(k), e.limit)
    text = "the international organisation of understanding " * 5
    assert len({tuple(merge_dropout.Encoder(merge_dropout.MODEL, 0.3, s).encode(text)) for s in range(4)}) > 1


def test_every_occurrence_has_its_own_dropout():
    e = merge_dropout.Encoder(merge_dropout.MODEL, 0.1, 13)
    p, n, forms, word = e.p, 400, [], []
    whole = merge_dropout.merge("▁understanding", p, 0, 0)
    for i in np.frombuffer(e.encode_many([" ".join(["understanding"] * n)], [5])[0], "<i4").tolist():
        word.append(i)
        if b"".join(p.raw[k] for k in word) == b" understanding":
            forms.append(tuple(word))
            word = []
    across = [tuple(e.encode("understanding", d)) for d in range(n)]
    rnd = random.Random(5)
    keyed = [tuple(merge_dropout.merge("▁understanding", p, rnd.getrandbits(64), e.limit)) for d in range(n)]
    for got in (forms, across):
        assert len(got) == n
        assert len(set(got)) > 4
        assert abs(got.count(tuple(whole)) - keyed.count(tuple(whole))) < 0.12 * n
    e.encode_many(TEXTS * 50, list(range(50 * len(TEXTS))))
    for w, dropped, x, steps in zip(e.words, e.drops, e.ids, e.steps, strict=True):
        assert steps < 0 or np.frombuffer(x, "<i4").tolist() == merge_dropout.merge(w, p, 0, 0, dropped)


@pytest.mark.parametrize("dropout", [0.1, 0.6])
def test_whole_texts_against_the_plain_agenda(dropout):
    """Each stretch of a text by its own key, through the agenda alone, and words of every length by the one rule."""
    rnd = random.Random(6)
    e = merge_dropout.Encoder(merge_dropout.MODEL, dropout, 13)
    p = merge_dropout.pieces(merge_dropout.MODEL)
    vocabulary = ["the", "understanding", "internationalisation", "x" * 30, "donaudampfschifffahrtsgesellschaft", "naïve,", "日本語", "12.5", "\n", "ab" * 40, "a" * 24, "a" * 25]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))) for _ in range(30)]
    docs = [rnd.choice([None, rnd.randint(-9, 1 << 40)]) for _ in texts]
    long = 0
    for text, doc, raw in zip(texts, docs, e.encode_many(texts, docs), strict=True):
        units = merge_dropout._UNIT.findall((" " + text).replace(" ", "▁")) if text else []
        stretches = [w for x in (e._split(units) if units else []) for w in x]
        key = merge_dropout.mix(np.array([merge_dropout.NAMELESS if doc is None else doc & (1 << 64) - 1], np.uint64) + merge_dropout.mix(np.array([13], np.uint64)))
        keys = merge_dropout.mix(key + np.arange(len(stretches), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tolist()
        want = [i for w, k in zip(stretches, keys, strict=True) for i in merge_dropout.merge(w, p, k, e.limit)]
        assert np.frombuffer(raw, "<i4").tolist() == want
        long += sum(len(w) > merge_dropout.SHORT for w in stretches)
    assert long > 20


def test_zip_both_ways():
    body = warc_zip.zip_stored([("a/b", b"x" * 1000), ("c", b"")])
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        assert z.testzip() is None
        assert z.read("a/b") == b"x" * 1000
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("plain", b"hello")
    for raw, name, want in ((body, "a/b", b"x" * 1000), (out.getvalue(), "plain", b"hello")):
        read = lambda at, n, raw=raw: raw[at : at + n]
        at, size, method = warc_zip.zip_members(read, len(raw))[name]
        start = warc_zip.member_start(read, at)
        assert (method, raw[start : start + size]) == (0, want)


def test_escape_is_reversible():
    rnd = random.Random(8)
    bits = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "ROLE]", "x", " "]
    for _ in range(3000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t
        assert not any(c in e for c in chat_format.CONTROL)


def test_chroma_aligns_shifted_audio(spark):
    rng = np.random.default_rng(9)
    t = np.arange(800) / chroma.RATE
    tune = lambda n: np.concatenate([np.sin(2 * np.pi * 220 * 2 ** (s / 12) * t) for s in rng.integers(0, 24, n)])

    def wav(x):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1), w.setsampwidth(2), w.setframerate(chroma.RATE)
            w.writeframes((x * 20000).astype("<i2").tobytes())
        return out.getvalue()

    a, b = tune(40), tune(40)
    cut = a[10 * chroma.HOP :] + rng.normal(scale=0.01, size=len(a) - 10 * chroma.HOP)
    media = spark.createDataFrame([(100, wav(a)), (1, wav(cut)), (2, wav(b)), (3, b"broken")], "id long, audio binary")
    got = {(r.id, r.class_id): r.offset for r in chroma.search(media, "id", "audio").filter("kind = 'match'").collect()}
    assert got == {(100, 1): -10}


def aligned(codes, asked, least=0.2, overlap=0.6):
    """Pairs (asked, other) that some alignment brings under `least` differing bits."""
    out = set()
    for q in asked:
        for m in codes:
            x, y = codes[q], codes[m]
            if q != m and any(e <= least and n >= overlap * min(len(x), len(y)) for e, n in (chroma.bit_error(x, y, o) for o in range(1 - len(x), len(y)))):
                out.add((q, m))
    return out


def test_chroma_recall_against_all_alignments(spark):
    rng, rows = np.random.default_rng(12), []
    for k in range(30):
        v = rng.normal(size=40)
        other = v.copy()
        other[rng.integers(0, 40, 2)] *= -1
        rows += [(100 * k, v.tolist()), (100 * k + 1, v[int(rng.integers(1, 12)) :].tolist()), (100 * k + 2, other.tolist()), (100 * k + 3, rng.normal(size=40).tolist())]
    media = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    prints = chroma.fingerprints(media, "vec_id", "embedding", chroma.melody_pcm)
    classes = chroma.classes_of(prints).collect()
    codes = {r.class_id: np.frombuffer(r.code, "<u4") for r in classes}
    want = aligned(codes, [r.class_id for r in classes if r.asked])
    for exact in (False, True):
        rows = chroma.search(media, "vec_id", "embedding", chroma.melody_pcm, exact=exact).filter("kind = 'match'").collect()
        got = {(r.id, r.class_id) for r in rows}
        assert got <= want
        assert len(got) >= 0.95 * len(want) > 40
        assert sum(m % 100 == 1 for _, m in got) >= 0.9 * sum(m % 100 == 1 for _, m in want) > 20
        assert all(chroma.bit_error(codes[r.id], codes[r.class_id], r.offset)[0] == r.bit_error for r in rows)


def test_cut_recordings_are_found(spark):
    """The stated query set over the whole table, with a cut and altered recording beside each, against all alignments."""
    rows = chroma.cut_recordings_aligned(spark, DATA).filter("kind = 'match'").collect()
    vectors = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect() if r.embedding is not None}
    after, codes = max(vectors) + 1, {}
    for i, v in vectors.items():
        other = v[i % 11 + 1 :].astype(float)
        other = np.where(np.arange(len(other)) % 19 == i % 19, -other, other)
        for k, x in ((i, v), (i + after, other)):
            pcm = chroma.melody_pcm(pa.RecordBatch.from_pydict({"v": [x.tolist()]}), "v")
            codes[k] = chroma.integers(chroma.chroma(np.stack(pcm)))[0]
    want = aligned(codes, [i for i in codes if i % 100 == 0])
    assert len(want) >= sum(i % 100 == 0 for i in vectors)
    got = {(r.id, r.class_id) for r in rows}
    assert got <= want
    assert len(got) >= 0.9 * len(want)


def test_recordings_are_dealt_out(spark, tmp_path, monkeypatch):
    """A table of one file isn't sounded in the few tasks that its bytes make."""
    spark.range(3 * chroma.LOT).selectExpr("id AS vec_id", "array(float(id), 1f) AS embedding").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(chroma, "search", lambda media, *a, **kw: media)
    media = chroma.cut_recordings_aligned(spark, str(tmp_path))
    assert media.rdd.getNumPartitions() == 6
    assert media.count() == 6 * chroma.LOT


@pytest.mark.parametrize("args", [(0.2, 0.6, 1), (1.0, 0.6, 1), (0.2, 0.3, 0)])
def test_tries_counted_together(args, monkeypatch):
    """Settling many pairs at once gives what bit_error() gives pair by pair."""
    monkeypatch.setattr(chroma, "TRIED", 64)
    rng, least, overlap, reach = np.random.default_rng(7), *args
    rows = []
    for k in range(300):
        x, y = (rng.integers(0, 1 << 32, rng.integers(1, 40), dtype=np.uint32) for _ in range(2))
        n = min(len(x), len(y) - 2)
        if k % 3 and n > 0:
            y[2 : n + 2] = x[:n]
        rows.append((k, 1000 + k, [*map(int, rng.integers(-9, 9, k % 4)), 2], x, y))
    batch = pa.RecordBatch.from_arrays([pa.array([r[c] if c < 3 else r[c].tobytes() for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()))], names=["q", "m", "offsets", "x", "y"])
    want = []
    for q, m, offsets, x, y in rows:
        tried = [(*chroma.bit_error(x, y, o), o) for o in {o + r for o in offsets for r in range(-reach, reach + 1)}]
        tried = [(e, -n, abs(o), o) for e, n, o in tried if n >= overlap * min(len(x), len(y))]
        if tried and min(tried)[0] <= least:
            e, n, _, o = min(tried)
            want.append((q, m, o, e, -n))
    got = [tuple(r.values()) for b in chroma._settle(*args)(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert got == want and len(want) > 30


@pytest.mark.parametrize("far", [0, 1 << 60])
def test_places_vote_once(far):
    """Votes by recording and offset, also where places are too far apart for one number."""
    rng = np.random.default_rng(3)
    ids, k = np.unique(rng.integers(0, 9, 200), return_inverse=True)
    at, offset = rng.integers(0, 12, 200), rng.integers(-5, 5, 200) + far * (k == 0)
    m, o, least, count = chroma._votes(ids, k, at, offset, ids[k] % 2 + 1, 1)
    cast = {(ids[j], p, t + r) for j, p, t in zip(k, at, offset, strict=True) for r in (-1, 0, 1)}
    want = {}
    for i, _, t in cast:
        want[i, t] = want.get((i, t), 0) + 1
    assert {(i, t): n for i, t, n in zip(m, o, count, strict=True)} == want
    assert (least == m % 2 + 1).all()


def test_held_tones_and_short_recordings_keep_their_links(spark):
    """One tone throughout has one key, three steps have one pair of steps: fewer keys than votes that are asked for."""
    t = np.arange(40 * chroma.HOP) / chroma.RATE
    tone = lambda n, hz=220: (0.8 * np.sin(2 * np.pi * hz * t[:n])).astype(np.float32)
    three = chroma.FRAME + (chroma.SPAN + 1) * chroma.HOP
    code = lambda y: chroma.integers(chroma.chroma(np.stack([y])))[0]
    codes = {100: code(tone(40 * chroma.HOP)), 1: code(tone(30 * chroma.HOP)), 200: code(tone(three, 311)), 2: np.append(code(tone(three, 311)), np.uint32(7))}
    assert len(codes[200]) == chroma.APART + 1
    rows = [(k, c.astype("<u4").tobytes(), k % 100 == 0) for k, c in codes.items()]
    got = chroma.match(spark.createDataFrame(rows, "class_id long, code binary, asked boolean")).collect()
    assert {(r.query, r.match) for r in got} == aligned(codes, [100, 200]) == {(100, 1), (200, 2)}


def test_chroma_of_long_audio_and_equal_votes(spark):
    rng = np.random.default_rng(4)
    t = np.arange(800) / chroma.RATE
    tune = np.concatenate([np.sin(2 * np.pi * 220 * 2 ** (s / 12) * t) for s in rng.integers(0, 24, 30)])
    x = np.stack([np.tile(tune, 60)])
    whole = chroma.integers(chroma.chroma(x))[0]
    assert len(whole) == 1 + (x.shape[1] - chroma.FRAME) // chroma.HOP - chroma.SPAN + 1
    part = chroma.integers(chroma.chroma(x[:, 2000 * chroma.HOP : 2000 * chroma.HOP + len(tune)]))[0]
    assert (whole[2000 : 2000 + len(part)] == part).all()
    twice = np.concatenate((tune, tune))
    code = lambda y: chroma.integers(chroma.chroma(np.stack([y])))[0].astype("<u4").tobytes()
    rows = [(100, code(tune), True), (1, code(twice), False), (2, np.array([7, 7], "<u4").tobytes(), True)]
    got = chroma.match(spark.createDataFrame(rows, "class_id long, code binary, asked boolean")).collect()
    assert [(r.query, r.match) for r in got] == [(100, 1)]
    assert got[0].offset == 0


def test_pipeline(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = corpus_pipeline.exact_dedup(spark, corpus_pipeline.language_id(spark, docs, DATA), DATA)
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) > 0
    assert kept.columns == docs.columns
    near = corpus_pipeline.ngram_jaccard_join(spark, kept, DATA)
    want = {d for d, (_, c) in brute_components([(r.doc_id, r.text) for r in kept.collect()]).items() if c == d}
    assert {r.doc_id for r in near.collect()} == want
    out = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in out.select("doc_id").collect()} <= want
    both = out.join(docs, "doc_id").select("ids", "text", F.col("doc_id")).collect()
    assert all(merge_dropout.decode(r.ids) == r.text for r in both)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "mixing", "sentencepiece_dropout"]
