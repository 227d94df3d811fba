"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of the lower-cased text, in which every run of characters that aren't letters counts
as one border. The weights are learned with follow-the-regularised-leader (FTRL-Proximal) under L1 and L2 penalties,
and a temperature fitted on rows that the weights haven't seen calibrates the probabilities.

Document frequencies cover all training rows. The weights are fitted on at most MAX_ROWS of them, spread over the
languages; that bound is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import crc_fold, lean_batches, take

BITS = 14
SIZE = 1 << BITS
MAX_ROWS = 4000
UNDETERMINED = "und"
_MULTIPLY = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point itself if it is a letter or a mark, else a space."""
    x = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if not (0xD800 <= c < 0xE000) and not chr(c).isalpha() and not 0x300 <= c < 0x370:
            x[c] = 32
    return x


def grams(texts: list[str | None]):
    """For each text (places, counts) of its hashed n-grams, or None where it has no letter."""
    i = 0
    while i < len(texts):
        lot, size = [], 0
        while i < len(texts) and size < 1 << 19:
            lot.append(f" {(texts[i] or '').lower()} ")
            size += len(lot[-1])
            i += 1
        ends = np.cumsum([len(t) for t in lot])
        code = _letters()[np.frombuffer("".join(lot).encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
        inner = np.ones(len(code), bool)
        inner[1:] = (code[1:] != 32) | (code[:-1] != 32)
        inner[np.concatenate(([0], ends[:-1]))] = True
        kept = np.concatenate(([0], np.cumsum(inner)[ends - 1]))
        code = code[inner]
        x1 = code * _MULTIPLY[0]
        x2 = (x1[:-1] + code[1:]) * _MULTIPLY[1]
        x3 = (x2[:-1] + code[2:]) * _MULTIPLY[2]
        shift = np.uint64(64 - BITS)
        places = [(x >> shift).astype(np.int32) for x in (x1 * _MULTIPLY[2], x2, x3)]
        for text, a, b in zip(lot, kept, kept[1:], strict=False):
            if not any(map(str.isalpha, text)):
                yield None
                continue
            count = np.bincount(np.concatenate((places[0][a + 1 : b], places[1][a : b - 1], places[2][a : b - 2])), minlength=SIZE)
            at = np.flatnonzero(count)
            yield at, count[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        x = np.log1p(count).astype(np.float32) * self.idf[at]
        return x / np.sqrt(max(1e-12, float(x @ x)))

    def logits(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.vector(at, count) @ self.weights[at] + self.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after `epochs` passes over (places, values, class)."""
    z, n = np.zeros((SIZE, classes)), np.zeros((SIZE, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def weight(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, x, y = rows[k]
            w, b = weight(z[at], n[at], l1, l2), weight(zb, nb, 0.0, l2)
            p = softmax(x @ w + b)
            p[y] -= 1
            g = x[:, None] * p
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - s * w
            n[at] += g * g
            zb += p - (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha * b
            nb += p * p
    return weight(z, n, l1, l2).astype(np.float32), weight(zb, nb, 0.0, l2).astype(np.float32)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search over its logarithm."""

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())

    a, b, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _frequencies(batches):
    df, docs = np.zeros(SIZE, np.int64), 0
    for batch in batches:
        for x in grams(batch.column(0).to_pylist()):
            if x is not None:
                df[x[0]] += 1
                docs += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_pydict({"place": pa.array(np.append(at, -1), pa.int64()), "df": pa.array(np.append(df[at], docs), pa.int64())})


def _features(batches):
    for batch in batches:
        lang, body = [], []
        for y, x in zip(batch.column(1).to_pylist(), grams(batch.column(0).to_pylist()), strict=True):
            if x is not None:
                lang.append(y)
                body.append(x[0].astype("<u2").tobytes() + np.minimum(x[1], 65535).astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(body, pa.binary())], names=["lang", "body"])


def train(labelled: DataFrame, max_rows: int = MAX_ROWS, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> Model | None:
    """A model from labelled(doc_id, text, lang); rows without a language or a letter are left out. None without rows."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    df = {r["place"]: r["df"] for r in labelled.select("text").mapInArrow(_frequencies, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).collect()}
    docs = df.pop(-1, 0)
    idf = np.full(SIZE, np.log(docs + 1.0) + 1, np.float32)
    for k, v in df.items():
        idf[k] = np.log((docs + 1) / (v + 1)) + 1

    each = max(1, max_rows // len(sizes))
    share = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, each / n)))))
    picked = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    languages = sorted(sizes)
    model, rows = Model(languages, idf, np.zeros((SIZE, len(languages)), np.float32), np.zeros(len(languages), np.float32)), []
    for r in picked.select("text", "lang").mapInArrow(_features, "lang string, body binary").collect():
        x = np.frombuffer(r["body"], "<u2").astype(np.int64)
        at, count = x[: len(x) // 2], x[len(x) // 2 :]
        rows.append((at, count, languages.index(r["lang"])))
    if not rows:
        return None
    rows = [rows[k] for k in np.random.default_rng(0).permutation(len(rows))]
    apart = rows[: len(rows) // 5]
    model.weights, model.bias = ftrl([(at, model.vector(at, c), y) for at, c, y in rows[len(apart) :]], len(languages), epochs, alpha, beta, l1, l2)
    if apart:
        model.temperature = fit_temperature(np.array([model.logits(at, c) for at, c, _ in apart]), np.array([y for *_, y in apart]))
    return model


def _best(model: Model | None, texts: list[str | None]) -> Iterator[tuple[str, float]]:
    """(language, score) of each text."""
    for x in grams(texts):
        if x is None or model is None:
            yield UNDETERMINED, 0.0
            continue
        p = softmax(model.logits(*x).astype(np.float64) / model.temperature)
        k = int(p.argmax())
        yield model.languages[k], float(p[k])


def _predict(sent):
    def run(batches):
        for batch in batches:
            found = list(_best(sent.value, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def _identified(sent, place: int, least: float):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([x != UNDETERMINED and s >= least for x, s in _best(sent.value, batch.column(place).to_pylist())], pa.bool_()))

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; 'und' with score 0 where it is null or has no letter."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_predict(sent), "doc_id long, lang_pred string, score double")


def fitted(docs: DataFrame, **kw) -> Model | None:
    """A model from the rows of docs(doc_id, text, lang) that aren't held out."""
    lean_batches(docs.sparkSession)
    rows = take(docs, doc_id="doc_id", text="text", lang="lang").withColumn("doc_id", F.col("doc_id").cast("long"))
    return train(rows.filter(crc_fold("doc_id") != 1), **kw)


def identify(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs(doc_id, text, lang).

    Only rows whose crc32(doc_id) mod 3 isn't 1 are learned from; rows with a null id or language are predicted but not
    learned from (a null id is held out). Repeated rows give repeated rows. Without a labelled row all is 'und'; an
    empty table gives an empty result. Texts of any length are read whole. Extra columns are not read.
    """
    rows = take(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = predict(rows, fitted(docs, **kw))
    return found.select("doc_id", F.coalesce(crc_fold("doc_id") == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, **kw) -> DataFrame:
    """docs without the rows whose language can't be told: no letter, or a score under `least`.

    Each row is judged by its own text where it lies, whatever its id; all columns stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fitted(docs, **kw))
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    return plain.mapInArrow(_identified(sent, docs.columns.index("text"), least), plain.schema).toDF(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
