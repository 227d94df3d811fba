"""Toxicity: a weighted finite-state pattern grammar over clauses.

A lexicon turns the words of a clause into symbols. Five small transducers read these and are composed into one table:
threats (a verb of violence, stronger within reach of an intention), insults (stronger within reach of an intensifier or
another insult), negation, reported speech, and targets before a match. A sixth, for targets that follow, reads the
result from its end, so that a match is aimed whichever side its target stands on. What a clause's path through them
writes are its patterns (an insult aimed at a target, a negated one, one in reported speech, ...), each with the path's
weight. A document's score is logistic in the summed weights of its clauses by pattern.

Target, negation, report, intention and threat words are fixed lists. Insult stems are learned from labels: stems of words
that lean to toxic documents in many contexts, taken greedily by how much they explain. The stems and the pattern weights
are fitted on at most MAX_ROWS labelled rows; that bound is a parameter.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import crc_fold, lean_batches

MAX_ROWS = 12000
# Fixed word lists of the grammar.
TARGET = frozenset("you your u he she they him her them people du dich dir ihr sie tu te toi vous il elle ils usted ustedes él ella ellos".split())
NEGATION = frozenset("not no never isn't aren't don't nicht kein keine nie ne pas jamais nunca jamás".split())
REPORT = frozenset("said says told wrote claimed called quoted sagte sagt schrieb dit disait écrit dijo dice escribió".split())
THREAT = frozenset("kill hurt destroy punch murder shoot töten umbringen tuer frapper matar golpear".split())
INTENT = frozenset("will shall gonna going want werde will wirst vais va veux voy va quiero".split())
INTENSE = frozenset("such very so fucking total totally sehr total so très si vraiment muy tan".split())
CLAUSE = re.compile(r"[.!?;:\n\r…]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”«»]")
#: What a clause can match, in the order of the pattern weights.
PATTERNS = ("insult", "insult at target", "insult negated", "insult reported", "threat", "threat at target", "threat negated", "threat reported")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: step[state, symbol] = (next state, output symbol, weight); a pair that is missing stays put and copies."""

    start: object
    step: dict = field(hash=False)

    def read(self, state, symbol):
        return self.step.get((state, symbol), (state, symbol, 1.0))


def compose(first: Transducer, second: Transducer, alphabet: list[str]) -> Transducer:
    """The transducer that feeds what `first` writes to `second`; weights multiply."""
    step, todo, seen = {}, [(first.start, second.start)], set()
    while todo:
        here = todo.pop()
        if here in seen:
            continue
        seen.add(here)
        for symbol in alphabet:
            a, mid, w = first.read(here[0], symbol)
            b, out, v = second.read(here[1], mid)
            step[here, symbol] = (a, b), out, w * v
            todo.append((a, b))
    return Transducer((first.start, second.start), step)


#: What the lexicon writes.
SYMBOLS = ("insult", "threat", "target", "negation", "report", "quote", "intent", "intense", "other")
#: What a path weighs more: a threat that is meant, an insult that is laid on, a match that is aimed.
MEANT, LAID_ON, AIMED = 1.5, 1.25, 1.25


def within(scope: int, opens: tuple[str, ...], match: str, become: str, weight: float, swallow: bool = True) -> Transducer:
    """Writes `become` for a match that comes within `scope` symbols of one that opens the reach; openers become 'other'."""
    step = {}
    for k in range(scope + 1):
        for symbol in (*SYMBOLS, "insult negated", "threat negated"):
            step[k, symbol] = max(0, k - 1), symbol, 1.0
        for symbol in opens:
            step[k, symbol] = scope, "other" if swallow else symbol, 1.0
        if k:
            step[k, match] = (scope if match in opens else k - 1), become, weight
    return Transducer(0, step)


def threats(scope: int = 3) -> Transducer:
    return within(scope, ("intent",), "threat", "threat", MEANT)


def insults(scope: int = 3) -> Transducer:
    return within(scope, ("intense", "insult"), "insult", "insult", LAID_ON, swallow=False)


def negations(scope: int = 3) -> Transducer:
    """A negation word turns the next match within `scope` words into its negated form."""
    step = {}
    for k in range(scope + 1):
        for symbol in SYMBOLS:
            step[k, symbol] = max(0, k - 1), symbol, 1.0
        step[k, "negation"] = scope, "other", 1.0
        for c in ("insult", "threat"):
            step[k, c] = 0, f"{c} negated" if k else c, 1.0
    return Transducer(0, step)


def reports() -> Transducer:
    """From a report word or a quote on, matches are reported; the next quote ends that."""
    step = {}
    for k in (0, 1):
        for c in ("insult", "threat", "insult negated", "threat negated"):
            step[k, c] = k, f"{c.split()[0]} reported" if k else c, 1.0
        step[k, "report"] = 1, "other", 1.0
        step[k, "quote"] = 1 - k, "other", 1.0
    return Transducer(0, step)


def targets() -> Transducer:
    """Once a target was read, a plain match is aimed."""
    step = {}
    for k in (0, 1):
        step[k, "target"] = 1, "target", 1.0
        for c in ("insult", "threat"):
            step[k, c] = k, f"{c} at target" if k else c, AIMED if k else 1.0
    return Transducer(0, step)


def grammar() -> tuple[Transducer, Transducer]:
    """(the composed table that reads a clause from its start, the table that reads what it wrote from the end)."""
    table = threats()
    for t in (insults(), negations(), reports(), targets()):
        table = compose(table, t, list(SYMBOLS))
    return table, targets()


class Lexicon:
    """The lexical transducer: word to class and weight. Insult stems match the longest prefix of a word."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems}, reverse=True)

    def read(self, word: str) -> tuple[str, float]:
        for n in self.lengths:
            w = self.stems.get(word[:n])
            if w is not None and len(word) >= n:
                return "insult", w
        for c, words in (("threat", THREAT), ("target", TARGET), ("negation", NEGATION), ("report", REPORT), ("intent", INTENT), ("intense", INTENSE)):
            if word in words:
                return c, 1.0
        return ("quote", 1.0) if not word[0].isalpha() else ("other", 1.0)


@dataclass
class Model:
    stems: dict[str, float]
    weights: np.ndarray
    bias: float


def _trigger(stems):
    """An automaton that finds texts with an insult stem or a threat word; clauses without one can't match."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for s in (*stems, *THREAT):
        a.add_word(s, len(s))
    a.make_automaton()
    return a


def clause_matches(clause: str, lexicon: Lexicon, machines: tuple[Transducer, Transducer]) -> list[tuple[str, float]]:
    """(pattern, weight) of a clause's matches: one pass from its start, one from its end over what the first wrote."""
    ahead, back = machines
    state, written = ahead.start, []
    for word in WORD.findall(clause):
        symbol, w = lexicon.read(word)
        state, symbol, v = ahead.read(state, symbol)
        written.append((symbol, w * v))
    state, out = back.start, []
    for symbol, w in reversed(written):
        state, symbol, v = back.read(state, symbol)
        if symbol in PATTERNS:
            out.append((symbol, w * v))
    return out[::-1]


def vectors(texts: list[str | None], stems: dict[str, float]):
    """For each text log(1 + the weight sum) of each pattern over its clauses."""
    lexicon, machine, trigger = Lexicon(stems), grammar(), _trigger(stems)
    place = {p: k for k, p in enumerate(PATTERNS)}
    zero = np.zeros(len(PATTERNS))
    for text in texts:
        low = (text or "").lower()
        hits = [end for end, _ in trigger.iter(low)]
        if not hits:
            yield zero
            continue
        total, k = np.zeros(len(PATTERNS)), 0
        edges = [m.span() for m in CLAUSE.finditer(low)]
        for a, b in zip([0, *(e for _, e in edges)], [*(s for s, _ in edges), len(low)], strict=True):
            if k < len(hits) and hits[k] < b:
                for name, w in clause_matches(low[a:b], lexicon, machine):
                    total[place[name]] += w
                while k < len(hits) and hits[k] < b:
                    k += 1
        yield np.log1p(total)


def _features(stems):
    def run(batches):
        for batch in batches:
            rows = [v.tolist() for v in vectors(batch.column(0).to_pylist(), stems)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    return run


def learn_stems(sample: DataFrame, shortest: int = 4, longest: int = 10, purity: float = 8.0, surely: float = 3.0) -> dict[str, float]:
    """{stem: log-odds} from sample(doc_id, text, toxic).

    A candidate stem leans to toxic documents (by odds of `purity`, and of `surely` at two standard errors below) and stands between many different pairs of neighbouring words there; words
    that only a group of copies shares have few such contexts. Of nested candidates the one is taken that explains most
    words, weighted by its log-odds; then the next for what is left.
    """
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return {}
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    stems = F.expr(f"transform(sequence({shortest}, greatest({shortest}, least(length(w), {longest}))), k -> substring(w, 1, k))")
    listed = sample.select("doc_id", "toxic", F.explode(F.array_distinct(words)).alias("w")).filter(F.length("w") >= shortest)
    stem = listed.select("doc_id", "toxic", F.explode(stems).alias("stem")).distinct()
    seen = stem.groupBy("stem").agg(F.count_if(F.col("toxic") == 1).alias("pos"), F.count_if(F.col("toxic") == 0).alias("neg"))
    odds = (F.col("pos") + 0.5) / bad / ((F.col("neg") + 0.5) / good)
    # of many candidates some lean by chance or in a group of copies: a hundredth of the toxic sample must hold a stem
    least = max(5, bad // 100)
    sure = F.log(odds) - 2 * F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    seen = seen.filter((F.col("pos") >= least) & (odds >= purity) & (sure >= F.log(F.lit(surely)))).select("stem", F.log(odds).alias("weight"))

    placed = sample.filter("toxic = 1").select("doc_id", words.alias("ws")).select("doc_id", "ws", F.posexplode("ws").alias("k", "w")).filter(F.length("w") >= shortest)
    around = F.concat_ws(" ", F.get("ws", F.col("k") - 1), F.lit("_"), F.get("ws", F.col("k") + 1))
    placed = placed.select(F.xxhash64("doc_id", "w").alias("item"), around.alias("context"), F.explode(stems).alias("stem")).join(seen, "stem")
    found = placed.groupBy("stem", "weight").agg(F.count_distinct("context").alias("contexts"), F.collect_set("item").alias("items")).filter(F.col("contexts") >= least)
    left, out = {r["stem"]: (set(r["items"]), r["weight"]) for r in found.collect()}, {}
    while left:
        gain = {s: len(d) * w for s, (d, w) in left.items()}
        most = max(gain.values())
        # of the stems that explain (nearly) as much, the longest: it stands for one word family and no more
        best = max((s for s, g in gain.items() if g >= 0.98 * most), key=lambda s: (len(s), s))
        items, out[best] = left.pop(best)
        left = {s: (d - items, w) for s, (d, w) in left.items() if len(d - items) >= least}
    return out


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, classes weighted alike, weights held at zero or above."""
    z = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(z.shape[1])
    w[-1] = -2
    free = np.ones(len(w), bool)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (share * (p - y)) + ridge * w
        h = (z * (share * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, np.where(free, g, 0))
        w[:-1] = np.maximum(0, w[:-1])
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from labelled documents that aren't held out; half the rows at most are of one class."""
    known = labels.filter((crc_fold("doc_id") != 1) & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, max_rows / 2 / max(1, n.get(1, 0)))).otherwise(min(1.0, max_rows / 2 / max(1, n.get(0, 0))))
    picked = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < share * (1 << 30))
    sample = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").filter("text IS NOT NULL")
    stems = learn_stems(sample)
    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(_features(stems), "x array<double>, y int").collect()
    if not stems or not rows:
        return Model(stems, np.array([2.0, 3, 0.5, 0.5, 2, 3, 0.5, 0.5]), -3.0)
    counts = Counter(r["y"] for r in rows)
    weights, bias = fit_weights(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])) if len(counts) == 2 else (np.ones(len(PATTERNS)), -2.0)
    # patterns that the labels hardly show keep a small prior weight: aimed ones count, negated and reported ones little
    prior = np.array([1.5, 2, 0.3, 0.3, 1.5, 4, 0.3, 0.3])
    shown = np.array([sum(r["x"][k] > 0 for r in rows) for k in range(len(PATTERNS))])
    return Model(stems, np.where(shown >= 5, weights, prior), bias)


def _score(sent):
    def run(batches):
        m: Model = sent.value
        for batch in batches:
            x = np.array(list(vectors(batch.column(1).to_pylist(), m.stems))).reshape(-1, len(PATTERNS))
            p = 1 / (1 + np.exp(-(x @ m.weights + m.bias)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.7).astype(np.int32)), pa.array((x > 0).sum(1).astype(np.int32))], names=["doc_id", "score", "predicted", "patterns"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """(doc_id, held_out, score, predicted, patterns) for every row of docs.

    Null and empty texts get the score of a text without a match. Labels are learned from only where crc32(doc_id)
    mod 3 isn't 1; null labels and ids are left out, and of a document's differing labels toxic wins. A null id is
    held out. Repeated rows give repeated rows; extra columns are not read; empty tables give empty results.
    """
    lean_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(docs, labels.select("doc_id", "toxic"), **kw)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.mapInArrow(_score(sent), "doc_id long, score double, predicted int, patterns int")
    return out.select("doc_id", F.coalesce(crc_fold("doc_id") == 1, F.lit(True)).alias("held_out"), "score", "predicted", "patterns")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
