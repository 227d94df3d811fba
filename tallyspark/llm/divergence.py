"""Source divergence audit: how far each source's words lie from those of the other sources of its language.

An Arrow pipeline counts terms within a task: ascii_lower, split_pattern_regex, dictionary_encode, then hash group_by,
first of (row, term) so that a document counts once, then of (language, source, term). Partial counts meet once, by
language and term. Shards of the merged counts, each a table of terms by sources, give the divergences: sums for pairs
of sources and the best terms of each source, which are merged over shards.

All arithmetic is in integers; see shares() for counts of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, lean_batches, take
from tallyspark.llm.kernels import release

#: What stands between terms: all of ASCII but its letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
ONE = 1_000_000_000
COUNTS = "lang string, source string, term string, n long, docs long"
#: Bytes of text that are split at a time, and distinct partial counts that a task holds before it sends them on.
SPLIT, HELD = 1 << 20, 1 << 18
#: Cells (terms by sources) of a shard.
CELLS = 1 << 17
MERGE = [("n", "sum"), ("docs", "sum")]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of whole rows of about SPLIT bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SPLIT, "right")))
        yield batch.slice(at, to - at)
        at = to


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of rows (lang, source, text): occurrences, and rows that hold the term."""
    lang, source, text = (pc.fill_null(batch.column(k), "") for k in range(3))
    words = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    row, term = pc.list_parent_indices(words), pc.list_flatten(words)
    full = pc.not_equal(pc.binary_length(term), 0)
    code = term.filter(full).dictionary_encode()
    held = pa.table({"row": row.filter(full), "code": code.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    group = pa.table({"lang": lang, "source": source})
    once = pa.table({"lang": group.column("lang").take(held.column("row")), "source": group.column("source").take(held.column("row")), "code": held.column("code"), "n": held.column("count_all")})
    out = once.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table({"lang": out.column("lang"), "source": out.column("source"), "term": code.dictionary.take(out.column("code").combine_chunks()), "n": out.column("n_sum"), "docs": out.column("count_all")})


def _merged(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate(MERGE)
    return out.rename_columns(["lang", "source", "term", "n", "docs"])


def _count(batches):
    """Partial counts of a task. What is held is merged as it doubles, and sent on beyond HELD rows."""
    held, rows, least = [], 0, HELD // 4
    for batch in batches:
        for piece in _pieces(batch):
            held.append(term_counts(piece))
            rows += held[-1].num_rows
            if rows >= least:
                held = [_merged(held)]
                rows = held[0].num_rows
                least = max(2 * rows, HELD // 4)
                if rows >= HELD:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held, rows, least = [], 0, HELD // 4
    if held:
        yield from _merged(held).to_batches(max_chunksize=1 << 16)
    del held
    release()


def shares(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(ONE * (n + 2) / (total + 2 * kept)), exact: a long division in three digits of base 1000, so that counts
    up to 9e15 don't overflow."""
    below = np.asarray(total, np.int64) + 2 * kept
    rest, out = np.asarray(n, np.int64) + 2, 0
    out, rest = rest // below, rest % below
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return 1 + out


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most ONE + 1, whose square is a long."""
    return (p - q) ** 2 // (p + q)


FOUND = "lang string, source string, part string, item string, value long"


def _found(lang, part: str, source, item, value) -> pa.Table:
    n = len(value)
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "source": pa.array(source, pa.string()), "part": pa.array([part] * n, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})


def _diverge(top: int):
    """A shard: counts (term, source, n) of some terms of a language, and all its sources with their totals."""

    def run(key, counts: pa.Table, totals: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        totals = totals.sort_by("source")
        sources, sums, kept = totals.column("source").to_pylist(), totals.column("total").to_numpy(), totals.column("kept")[0].as_py()
        term = counts.column("term").combine_chunks().dictionary_encode()
        terms = term.dictionary
        grid = np.zeros((len(terms), len(sources)), np.int64)
        at = pc.index_in(counts.column("source"), pa.array(sources, pa.string())).to_numpy()
        grid[term.indices.to_numpy(), at] = counts.column("n").to_numpy()
        out = [_found(lang, "pair", [], [], [])]
        p = shares(grid, sums[None, :], kept) if kept else grid
        for k, name in enumerate(sources):
            rest = sources[k + 1 :]
            value = gap(p[:, k : k + 1], p[:, k + 1 :]).sum(0) if kept and len(terms) else np.zeros(len(rest), np.int64)
            out += [_found(lang, "pair", [name] * len(rest), rest, value), _found(lang, "pair", rest, [name] * len(rest), value)]
        if len(terms):
            q = shares(grid.sum(1), sums.sum(), kept)
            rank = np.empty(len(terms), np.int64)
            rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
            for k, name in enumerate(sources):
                i = np.flatnonzero((grid[:, k] > 0) & (p[:, k] > q))
                value = gap(p[i, k], q[i])
                best = np.lexsort((rank[i], -value))[:top]
                out.append(_found(lang, "term", [name] * len(best), terms.take(pa.array(i[best])), value[best]))
        return pa.concat_tables(out)

    return run


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 10, top: int = 10, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of each language its divergence from each other source
    (part pair, all ranks) and the `top` terms that set it apart from the language (part term).

    Null text, language and source count as ''. Terms are runs of ASCII letters, lower-cased, and of any characters
    beyond ASCII, as they are. A language keeps the terms that at least `least_docs` of its rows hold; every row is a
    document, repeated ones too. A language without kept terms has pairs of value 0; a source alone in its language has
    no rows. Ties go by the bytes of item. Texts of any length are read whole, an empty table gives an empty result,
    and columns other than the three named are not read. `cells` bounds a shard (terms by sources; one term of a
    language with more sources than that is a shard of its own); no result depends on it.
    """
    spark = docs.sparkSession
    lean_batches(spark, 4 << 20)
    rows = take(docs, lang=lang_col, source=source_col, text=text_col)
    counted = rows.mapInArrow(_count, COUNTS)
    # one shuffle: what is dealt by (lang, term) is grouped by source, and each term's documents are summed in place
    merged = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    merged = merged.withColumn("held", F.sum("docs").over(Window.partitionBy("lang", "term")))
    counts = cut(merged.filter(F.col("held") >= least_docs).select("lang", "term", "source", "n"), "counts")

    kept = counts.groupBy("lang", "term").agg(F.count("*")).groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(kept, "lang", "left").fillna(0, ["kept"])
    per_lang = per_lang.withColumn("shards", F.greatest(F.lit(1), F.least(F.col("kept"), F.ceil(F.col("kept") * F.col("sources") / cells))))
    per_group = cut(groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(per_lang, "lang"), "totals")

    shard = F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard")
    dealt = counts.join(per_group.select("lang", "source", "shards"), ["lang", "source"]).select("lang", shard, "source", "term", "n")
    copies = per_group.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "source", "total", "kept")
    found = dealt.groupBy("lang", "shard").cogroup(copies.groupBy("lang", "shard")).applyInArrow(_diverge(top), FOUND)

    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(order)).filter((F.col("part") == "pair") | (F.col("rank") <= top))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
w AS (SELECT row, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v.v) AS p
  FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) t ON t.lang = g.lang AND t.source = g.source),
q AS (
  SELECT c.lang, c.term, 1 + 1000000000::HUGEINT * (sum(c.n) + 2) // (any_value(t.total) + 2 * any_value(v.v)) AS q
  FROM c JOIN v ON v.lang = c.lang JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) t ON t.lang = c.lang
  GROUP BY c.lang, c.term),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // (p.p + q.q)
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
WHERE part = 'pair' OR rank <= 10
"""
