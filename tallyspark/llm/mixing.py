"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Starting from the cells' tokens, the weights are raked in turn to
the target marginals of each dimension, and a document is kept with the probability that makes its cell's expected
tokens the calibrated share of the budget. No cell can give more tokens than it has: a weight is held to that share
within the rounds, so that the next ones deal what is cut to the other cells of the same marginals.

Targets are named by the caller, {dimension: {value: weight}}; a dimension without any is raked to a power of its own
token shares: 1 leaves it as it is, 0 evens it out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, packed, unpacked

#: Power of each dimension's token shares that makes its targets.
POWERS = {"source": 0.5, "language": 0.7, "topic": 0.9}
ROUNDS = 20
BUDGET = 0.6
SEED = 17
#: Cells that the driver takes at most; raking is over values of three columns, and more than that are no categories.
MOST_CELLS = 1_000_000
Targets = Mapping[str, Mapping[str, float]]


def topic(text: Column, tokens: Column) -> Column:
    """A content class from the text alone: marked-up, numeric, loud, or running text by length."""
    n = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / n

    kind = F.when(share("[#$%&*<>|{}]") >= 0.02, "markup").when(share("[0-9]") >= 0.01, "numeric").when(share("[A-Z]") >= 0.3, "loud")
    return kind.when(tokens < 100, "note").when(tokens < 500, "article").otherwise("essay")


def described(docs: DataFrame, id_col: str = "doc_id", topic_col: str | None = None) -> DataFrame:
    """body (all of docs' columns), _mx_id, _mx_source, _mx_language, _mx_topic and _mx_tokens of docs; a missing value is a
    category of its own, ''.

    topic_col names a column with the topic; without one it is the text's content class.
    """
    rows = packed(docs, **{"_mx_id": id_col, "text": "text", "source": "source", "lang": "lang"}, **({"topic": topic_col} if topic_col else {}))
    text = F.coalesce(F.col("text"), F.lit(""))
    out = rows.withColumn("_mx_tokens", F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    kind = F.coalesce("topic", F.lit("")) if topic_col else topic(text, F.col("_mx_tokens"))
    return out.select("body", "_mx_id", F.coalesce("source", F.lit("")).alias("_mx_source"), F.coalesce("lang", F.lit("")).alias("_mx_language"), kind.alias("_mx_topic"), "_mx_tokens")


def targets_of(cells: list[tuple], powers: Mapping[str, float], named: Targets) -> list[dict[str, float]]:
    """Each dimension's target shares, which sum to 1; named ones by their weights, values without a weight get 0."""
    out = []
    for d, (dim, power) in enumerate(powers.items()):
        total: dict[str, int] = {}
        for c in cells:
            total[c[d]] = total.get(c[d], 0) + c[3]
        if dim in named:
            raw = {k: float(named[dim].get(k, 0.0)) for k in total}
            if not sum(raw.values()) > 0 or min(raw.values()) < 0:
                raise ValueError(f"the targets of {dim} give no positive weight to any of its values")
        else:
            raw = {k: t**power for k, t in total.items()}
        norm = math.fsum(raw.values())
        out.append({k: v / norm for k, v in raw.items()})
    return out


def rake(cells: list[tuple], targets: list[dict[str, float]], budget: float, rounds: int) -> tuple[list[float], float]:
    """(weights of cells (source, language, topic, tokens), the largest gap that is left between a marginal and its target).

    A weight is at most the share of the budget that all tokens of its cell make up. Targets that the tokens can't
    meet leave a gap; the weights then sum to less than 1.
    """
    total = sum(c[3] for c in cells)
    cap = [c[3] / (budget * total) for c in cells]
    w = [c[3] / total for c in cells]
    gap = 0.0
    for _ in range(rounds):
        gap = 0.0
        for d, target in enumerate(targets):
            have: dict[str, float] = {}
            for c, x in zip(cells, w, strict=True):
                have[c[d]] = have.get(c[d], 0.0) + x
            gap = max(gap, *(abs(have[k] - t) for k, t in target.items()))
            w = [min(m, x * target[c[d]] / have[c[d]] if have[c[d]] else 0.0) for c, x, m in zip(cells, w, cap, strict=True)]
    return w, gap


def cell_weights(rows: DataFrame, budget: float = BUDGET, rounds: int = ROUNDS, powers: Mapping[str, float] = POWERS, targets: Targets | None = None) -> tuple[DataFrame, int, float]:
    """((_mx_source, _mx_language, _mx_topic, _mx_cell, _mx_w), tokens in all, the gap that raking left).

    Cells hold tokens; there are at most MOST_CELLS of them, however many rows, and more raise an error.
    """
    cells = rows.groupBy("_mx_source", "_mx_language", "_mx_topic").agg(F.sum("_mx_tokens").alias("_mx_cell")).filter("_mx_cell > 0")
    here = cells.limit(MOST_CELLS + 1).collect()
    if len(here) > MOST_CELLS:
        raise ValueError(f"over {MOST_CELLS} combinations of source, language and topic; give coarser columns")
    here = sorted(tuple(r) for r in here)
    weights, gap = rake(here, targets_of(here, powers, targets or {}), budget, rounds) if here else ([], 0.0)
    made = rows.sparkSession.createDataFrame([(*c, w) for c, w in zip(here, weights, strict=True)], "_mx_source string, _mx_language string, _mx_topic string, _mx_cell long, _mx_w double")
    return (F.broadcast(made) if len(here) <= 100_000 else made), sum(c[3] for c in here), gap


def _calibrated(rows: DataFrame, cells: DataFrame, total: int, budget: float, seed: int) -> DataFrame:
    """rows of described() with _mx_weight, _mx_keep_prob and _mx_kept."""
    joined = rows.join(cells, ["_mx_source", "_mx_language", "_mx_topic"], "left")
    p = F.coalesce(F.least(F.lit(1.0), F.lit(float(budget * total)) * F.col("_mx_w") / F.col("_mx_cell")), F.lit(0.0))
    key = F.md5(F.concat(F.coalesce(F.col("_mx_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    u = F.conv(F.substring(key, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)
    out = joined.withColumn("_mx_weight", F.coalesce("_mx_w", F.lit(0.0))).withColumn("_mx_keep_prob", F.when(F.col("_mx_tokens") > 0, p).otherwise(F.lit(0.0)))
    return out.withColumn("_mx_kept", u < F.col("_mx_keep_prob"))


DESCRIBED = ("_mx_source", "_mx_language", "_mx_topic", "_mx_tokens")


def mix(docs: DataFrame, id_col: str = "doc_id", budget: float = BUDGET, seed: int = SEED, topic_col: str | None = None, **kw) -> DataFrame:
    """(doc_id, topic, n_tokens, weight, keep_prob, kept) for every row of docs(doc_id, text, lang, source).

    weight is the calibrated token share of the document's cell; keep_prob = budget * all tokens * weight / the cell's
    tokens, at most 1. A document is kept if a uniform number made from the md5 of its id lies below that, so that
    each row's fate depends on its id alone; rows that repeat an id share it. Documents without a token have
    keep_prob 0. Texts are read once, whole. An empty table gives an empty result; extra columns are not read.
    """
    rows = cut(described(docs, id_col, topic_col).select("_mx_id", *DESCRIBED), "described")
    cells, total, _ = cell_weights(rows, budget, **kw)
    out = _calibrated(rows, cells, total, budget, seed)
    return out.select(F.col("_mx_id").alias("doc_id"), *(F.col(f"_mx_{c}").alias(n) for c, n in (("topic", "topic"), ("tokens", "n_tokens"), ("weight", "weight"), ("keep_prob", "keep_prob"), ("kept", "kept"))))


def mixed(docs: DataFrame, id_col: str = "doc_id", budget: float = BUDGET, seed: int = SEED, topic_col: str | None = None, **kw) -> DataFrame:
    """The documents that mix() keeps, with all columns of docs."""
    rows = described(docs, id_col, topic_col)
    cells, total, _ = cell_weights(rows, budget, **kw)
    return unpacked(_calibrated(rows, cells, total, budget, seed).filter("_mx_kept"), docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumns({"weight": F.round("weight", 9), "keep_prob": F.round("keep_prob", 9)})


def mixing_sql(source: str = "documents", rounds: int = ROUNDS, powers: dict[str, float] = POWERS, budget: float = BUDGET, seed: int = SEED) -> str:
    """mix() over `source` as SQL, with the rounds unrolled."""
    share = "length(regexp_replace({t}, '[^{c}]', '', 'g')) / greatest(length({t}), 1)"
    kinds = " ".join(f"WHEN {share.format(t='t', c=c)} >= {v} THEN '{name}'" for c, v, name in (("#$%&*<>|{}", 0.02, "markup"), ("0-9", 0.01, "numeric"), ("A-Z", 0.3, "loud")))
    dims = list(powers)
    parts = [
        f"mx_d AS (SELECT *, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM {source})",
        f"mx_r AS (SELECT *, coalesce(source, '') AS k_source, coalesce(lang, '') AS k_language, CASE {kinds} WHEN n < 100 THEN 'note' WHEN n < 500 THEN 'article' ELSE 'essay' END AS k_topic FROM mx_d)",
        "mx_c AS (SELECT k_source, k_language, k_topic, sum(n)::DOUBLE AS tokens FROM mx_r GROUP BY ALL HAVING sum(n) > 0)",
        *(f"mx_t_{d} AS MATERIALIZED (SELECT k_{d}, pow(sum(tokens), {p}) / sum(pow(sum(tokens), {p})) OVER () AS g_{d} FROM mx_c GROUP BY k_{d})" for d, p in powers.items()),
        "mx_0 AS MATERIALIZED (SELECT mx_c.*, " + ", ".join(f"g_{d}" for d in dims) + f", tokens / sum(tokens) OVER () AS w, tokens / ({budget} * sum(tokens) OVER ()) AS cap FROM mx_c " + " ".join(f"JOIN mx_t_{d} USING (k_{d})" for d in dims) + ")",
    ]
    for k in range(rounds * len(dims)):
        d = dims[k % len(dims)]
        parts.append(f"mx_{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (w), least(cap, w * g_{d} / sum(w) OVER (PARTITION BY k_{d})) AS w FROM mx_{k})")
    parts.append(
        f"mixed AS (SELECT mx_r.*, coalesce(w, 0) AS weight, CASE WHEN n > 0 THEN least(1.0, {budget} * (SELECT sum(n) FROM mx_r) * w / tokens) ELSE 0 END AS keep_prob, "
        f"CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{seed}'), 1, 13) AS BIGINT) / pow(2, 52) AS u FROM mx_r LEFT JOIN mx_{rounds * len(dims)} USING (k_source, k_language, k_topic))"
    )
    return ",\n".join(parts)


OP6_SQL = f"WITH {mixing_sql()}\nSELECT doc_id, k_topic AS topic, n AS n_tokens, round(weight, 9) AS weight, round(keep_prob, 9) AS keep_prob, u < keep_prob AS kept FROM mixed"
