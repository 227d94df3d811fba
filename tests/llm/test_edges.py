"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pytest

from tallyspark.llm import chat_format, chroma, exact_dedup, language_id, merge_dropout, mixing, ngram_join, suffix_dedup, toxicity, warc_zip
from tallyspark.llm.common import cut, discard, mark

LONG = "word " * 60_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, keep_id string, w double, tokens string, run int, score string, weight string, label string"
CLASH = (None, "x", 1.0, "t", 7, "s", "ww", "l")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, la, s, len(t or ""), *CLASH) for i, t, la, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, LONG, "en", "a"), (4, LONG, "en", "b"), (5, "same  text", "de", "a"), (6, "same\ttext", "de", "a"), (6, "same\ttext", "de", "a"), (None, "no id", "fr", "b"), (None, "no id", "fr", "b"), (9, "1234 ...", "en", "a")]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_dedup(odd, empty):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1, 2, True), (2, 1, 2, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 3, True), (6, 5, 3, False), (6, 5, 3, False), (None, None, 2, True), (None, None, 2, True), (9, 9, 1, True)], key=repr)
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 5, None, None, 9], key=repr)


def test_rows_of_one_id_with_differing_texts(spark):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, words, "en", "a"), (2, words, "en", "a"), (2, "only here, in this row of the id", "en", "a"), (3, "... 12", "en", "b"), (3, words + " and more", "en", "b")]
    docs = docs_of(spark, rows)
    assert sorted((r.doc_id, r.text) for r in exact_dedup.drop_copies(docs).collect()) == sorted((i, t) for i, t, *_ in rows if (i, t) != (2, words))
    assert sorted((r.doc_id, r.text) for r in language_id.keep_identified(docs, least=0.0).collect()) == sorted((i, t) for i, t, *_ in rows if t != "... 12")
    kept = ngram_join.keep_one_of_each(docs.withColumnRenamed("doc_id", "number"), "number")
    assert {r.text for r in kept.collect()} >= {t for i, t, *_ in rows if i != 3}


def test_ngram_join(odd, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(odd).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), None: (1, None), 9: (1, 9)}
    assert ngram_join.jaccard_components(odd).count() == odd.count()
    assert ngram_join.jaccard_components(empty).count() == 0
    kept = ngram_join.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, 3, 5, None, None, 9], key=repr)


def test_suffix_dedup(odd, empty):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.suffix_dedup(odd).collect()}
    n = len(LONG)
    assert got == {1: (0, 0, 0), 2: (0, 0, 0), 3: (n, n - 5, 1), 4: (n, n, 1), 5: (10, 0, 0), 6: (9, 0, 0), None: (5, 0, 0), 9: (8, 0, 0)}
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_rows_that_repeat_an_id_stay(spark):
    text = " ".join(f"w{k * 7919 % 1000}" for k in range(100))
    got = suffix_dedup.suffix_dedup(docs_of(spark, [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "a")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, len(text))]


def test_texts_of_one_id_are_documents_of_their_own(spark):
    """Whatever repeats is removed once, and nothing of a text that is like no other."""
    p, q = (" ".join(f"{k}{i * 7919 % 1000}" for i in range(100)) for k in "pq")
    rows = [(1, p, "en", "a"), (2, p, "en", "a"), (2, q, "en", "a"), (2, q, "en", "a"), (3, q, "en", "a"), (None, q, "en", "a"), (4, None, "en", "a"), (4, "", "en", "a")]
    got = suffix_dedup.suffix_dedup(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in got), key=repr) == sorted([(1, len(p), 0), (2, len(p), len(p)), (2, len(q), 0), (2, len(q), 0), (3, len(q), len(q)), (None, len(q), 0), (4, 0, 0), (4, 0, 0)], key=repr)


INNER = ["_lost", "_digest", "body", "digest", "key", "h", "h2", "all", "c0", "class", "class2", "label", "node", "n_shingles", "component_id", "t", "_mx_tokens", "_mx_kept", "_mx_id", "_mx_source", "topic", "doc", "whole", "a"]


@pytest.mark.parametrize("upper", [False, True])
def test_stages_keep_columns_of_any_name(spark, upper):
    """Columns named as the stages' own, and columns that differ from theirs in case alone, go along as they are."""
    import corpus_pipeline

    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, words, "en", "a"), (2, words, "en", "a"), (3, f"{words} more", "en", "b"), (4, "some other text of an english kind", "en", "b")]
    more = ["TEXT", "Doc_Id", "LANG", "Source"] if upper else INNER
    docs = spark.createDataFrame([(*r, *(f"{c}-{r[0]}" for c in more)) for r in rows], ", ".join(["doc_id long", "text string", "lang string", "source string", *(f"`{c}` string" for c in more)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        found = [tuple(r) for r in got.collect()]
        assert found or name == "mixing"
        assert all(r[4:] == tuple(f"{c}-{r[0]}" for c in more) for r in found)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 4


def test_language_id(odd, empty):
    got = language_id.identify(odd)
    assert got.count() == odd.count()
    assert {r.doc_id: r.lang_pred for r in got.collect() if r.doc_id in (1, 2, 9)} == {1: "und", 2: "und", 9: "und"}
    assert list(language_id.grams(["\u0301 \u0302", "", None, "12."])) == [None] * 4
    assert next(language_id.grams(["x"])) is not None
    assert language_id.identify(empty).count() == 0
    assert language_id.keep_identified(odd).columns == odd.columns


def test_toxicity(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (3, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for x in (none, labels):
        got = toxicity.score_toxicity(odd, x).collect()
        assert len(got) == 10
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_mixing(odd, empty):
    got = mixing.mix(odd)
    assert got.count() == odd.count()
    assert {r.keep_prob for r in got.collect() if r.n_tokens == 0} == {0.0}
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed(odd).columns == odd.columns


def test_merge_dropout(odd, empty):
    got = {r.doc_id: r.decoded_sha256 for r in merge_dropout.encode_pieces(odd, digest=True).collect()}
    want = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in odd.collect()}
    assert got == want
    assert merge_dropout.encode_pieces(empty).count() == 0


def test_warc_zip(spark):
    rows = [(1, "http://a", None), (2, None, ""), (3, "http://b\r\nX: y", LONG), (4, "u", LONG), (None, "u", "x"), (5, "u", "once"), (5, "u", "once")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, sha1 string")
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc_zip.read_warc_zip(warc_zip.write_warc_zip(pages)).collect()]
    n = len(LONG)
    assert sorted(got, key=repr) == sorted([(1, 0, "revisit", 2), (2, 0, "response", None), (3, n, "revisit", 4), (4, n, "response", None), (None, 1, "response", None), (5, 4, "response", None), (5, 4, "response", None)], key=repr)
    assert warc_zip.read_warc_zip(warc_zip.write_warc_zip(pages.limit(0))).count() == 0


def test_warc_zip_with_long_records_over_many_archives(spark):
    rnd = np.random.default_rng(3)
    pages = spark.createDataFrame([(k, f"u{k}", rnd.bytes(3000 if k % 5 else 90_000).hex()) for k in range(40)], "page_id long, url string, html string").coalesce(2)
    manifest = warc_zip.write_warc_zip(pages, archive_bytes=20_000)
    assert manifest.count() > 8
    got = {r.page_id: (r.url, r.payload_bytes, r.payload_digest) for r in warc_zip.read_warc_zip(manifest).collect()}
    want = {r.page_id: (r.url, len(r.html), base64.b32encode(hashlib.sha1(r.html.encode()).digest()).decode()) for r in pages.collect()}
    assert got == want


def test_chat_format(spark):
    rows = [(1, 0, "user", "<s>[INST]"), (1, 1, "assistant", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "tool", r"\</s> [\INST] [/ROLE]"), (2, 5, "assistant", LONG)]
    talks = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chat(talks)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 4, None: 1, 2: 1}
    assert got[2].loss_chars == len(LONG)
    assert got[2].loss_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256("user\n<s>[INST]\n\nx\n\nx\nassistant\n\n".encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256("tool\n\\</s> [\\INST] [/ROLE]\n".encode()).hexdigest()
    assert chat_format.read_back(chat_format.format_chat(talks.limit(0))).count() == 0


@pytest.mark.parametrize("body", [" " * 5_000_000, "\n" * 1_500_000 + "end", "x" * 5_000_000, "[INST]" * 300_000, "word " * 500_000 + "\t" * 200_000, "<" + "\\" * 300_000 + "s>"])
def test_chat_of_very_long_runs(body):
    ids, mask = chat_format.turn_tokens("assistant", body, chat_format.VOCABULARY)
    enc, control = chat_format.encoder(chat_format.VOCABULARY)
    assert chat_format.unescape(enc.decode(ids[mask == 1].tolist())) == body
    assert (ids[0], ids[-1], int(mask[0]), int(mask[-1])) == (control["<s>"], control["</s>"], 0, 0)
    assert max(ids[1:-1]) < min(control.values())


def test_stretches_encode_as_the_whole():
    enc, _ = chat_format.encoder(chat_format.VOCABULARY)
    rng = np.random.default_rng(2)
    bits = ["don't", " ", "  ", "\n", "\t", "word", "12", "é名", "...", " x", "[INST]", " \n "]
    text = "".join(bits[k] for k in rng.integers(0, len(bits), 120_000))
    assert len(text) > 3 * chat_format.LOT
    assert "".join(chat_format.lots(text)) == text
    assert chat_format.encoded(enc, text) == enc.encode_ordinary(text)


def test_chroma(spark):
    v = [float(x) for x in np.random.default_rng(1).normal(size=64)]
    rows = [(100, v), (1, v), (2, None), (3, []), (None, v), (4, [0.0] * 64), (5, [None, float("nan")] + v[2:])]
    media = spark.createDataFrame([(*r, "z") for r in rows], "id long, v array<double>, code string")
    got = chroma.search(media, "id", "v", chroma.melody_pcm)
    members = {r.id: r.class_id for r in got.filter("kind = 'member'").collect()}
    assert members[100] == members[1] == members[None] == 1
    assert (members[2], members[3]) == (2, 3)
    assert chroma.search(media.limit(0), "id", "v", chroma.melody_pcm).count() == 0


def test_pipeline_stages(spark, odd, empty):
    """Nulls, empty and long texts, repeated rows and clashing columns through all stages; an empty table stays empty."""
    import corpus_pipeline

    for docs in (odd, empty):
        rows = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = cut(stage(spark, rows, ""), name)
            assert rows.columns == docs.columns
        out = corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()
        assert len(out) == rows.count() <= docs.count()
    assert len(out) == 0


def test_discard_deletes_what_was_written_since(spark, tmp_path):
    df = spark.range(3)
    first = cut(df, "a")
    since = mark()
    second, third = cut(df, "b"), cut(df, "c")
    discard(spark, since, keep=1)
    assert first.count() == third.count() == 3
    with pytest.raises(Exception, match="(?i)not.*exist|no such"):
        second.count()
