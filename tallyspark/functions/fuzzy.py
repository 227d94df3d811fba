"""Text functions that no column expression can give, as Arrow-batched pandas UDFs; run them on distinct values."""

from __future__ import annotations

import difflib
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def ratio(a: str, b: str) -> float:
    """Ratcliff/Obershelp similarity; the order of its arguments matters."""
    return difflib.SequenceMatcher(None, a, b).ratio()


def compose(x: str | None) -> str:
    return " ".join(unicodedata.normalize("NFC", x or "").split())


def bare(x: str | None) -> str:
    """Text without combining marks and spaces between."""
    return compose("".join(c for c in unicodedata.normalize("NFD", x or "") if not unicodedata.combining(c) and unicodedata.category(c) not in ("Mn", "Mc")))


@F.pandas_udf(StringType())
def nfc(x: pd.Series) -> pd.Series:
    return x.map(compose)


@F.pandas_udf(StringType())
def skeleton(x: pd.Series) -> pd.Series:
    return x.map(bare)


@F.pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])


def _scorer(word: str) -> Callable[[str], float]:
    """ratio(x, word) of any x; what it needs of the word is made once."""
    m = difflib.SequenceMatcher(None, "", word)

    def score(x: str) -> float:
        m.set_seq1(x)
        return m.ratio()

    return score


@lru_cache(8)
def _ending_finder(words: tuple[tuple[str, str], ...], least: float):
    asked = [(code, len(word), Counter(word), _scorer(word)) for word, code in words]

    @lru_cache(1 << 14)
    def find(text: str) -> str | None:
        best, found = -1.0, None
        for code, n, letters, score in asked:
            left, common = dict(letters), 0
            for k in range(1, len(text) + 1):
                c = text[-k]
                if left.get(c):
                    left[c] -= 1
                    common += 1
                if k > 1 and best < (most := 2.0 * common / (k + n)) >= least and (got := score(text[-k:])) > best:
                    best, found = got, code
        return found if best >= least else None

    return find


def ending_code(x: Column, words: Sequence[tuple[str, str]], least: float) -> Column:
    """The code of the word that an ending of a text, two letters at least, resembles most, of equals the first; null where
    none comes near. An ending that has too few of a word's letters to win isn't aligned with it."""
    words = tuple(words)

    @F.pandas_udf(StringType())
    def code(x: pd.Series) -> pd.Series:
        return x.map(_ending_finder(words, least), na_action="ignore")

    return code(x)


@lru_cache(8)
def _word_finder(words: tuple[tuple[str, str], ...]):
    asked = [(_scorer(word), code) for word, code in words]
    return lru_cache(1 << 14)(lambda x: max((score(x), code) for score, code in asked))


def first_like(x: Column, words: Sequence[tuple[str, str]], least: float, sure: float) -> Column:
    """struct(k, code) of the first text of an array that resembles a word, with the word's code, or '' where the likeness
    is below `sure`; nulls where none does, and blank texts don't count."""
    words = tuple(words)

    @F.pandas_udf("k int, code string")
    def first(x: pd.Series) -> pd.DataFrame:
        like = _word_finder(words)
        rows = []
        for texts in x:
            hits = ((k, like(t)) for k, t in enumerate(() if texts is None else texts) if t)
            rows.append(next(((k, code if score >= sure else "") for k, (score, code) in hits if score >= least), (None, None)))
        return pd.DataFrame(rows, columns=["k", "code"], dtype=object)

    return first(x)


def unlooped(text: str, least: int = 20, times: int = 3) -> str:
    """Text in which a stretch of `least` characters or more that repeats `times` times or more stands once.

    The leftmost, shortest stretch goes first. Candidates are the places where a stretch's first characters come again,
    looked up in an index, so that a text without loops costs one pass.
    """
    n, out, i = len(text), [], 0
    places: dict[str, list[int]] = {}
    for k in range(n - least + 1):
        places.setdefault(text[k : k + least], []).append(k)
    while i < n:
        again = places.get(text[i : i + least], ()) if i + times * least <= n else ()
        period = 0
        for j in again[bisect_left(again, i + least) :] if len(again) > 1 else ():
            if i + times * (j - i) > n:
                break
            unit = text[i:j]
            if text.startswith(unit * (times - 1), j):
                period = j - i
                break
        if not period:
            out.append(text[i])
            i += 1
            continue
        unit = text[i : i + period]
        out.append(unit)
        i += period
        while text.startswith(unit, i):
            i += period
    return "".join(out)


@F.pandas_udf(StringType())
def without_loops(x: pd.Series) -> pd.Series:
    return x.map(lambda v: unlooped(v or ""))


def on_distinct(df: DataFrame, inputs: Sequence[str], output: str, fn: Callable[..., Column]) -> DataFrame:
    """df with output = fn(*inputs), computed once for each distinct input and joined back; nulls meet nulls."""
    seen = df.select(*inputs).distinct().withColumn(output, fn(*inputs))
    renamed = seen.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(inputs)), output)
    on = None
    for i, c in enumerate(inputs):
        same = df[c].eqNullSafe(F.col(f"_k{i}"))
        on = same if on is None else on & same
    return df.join(renamed, on, "left").drop(*(f"_k{i}" for i in range(len(inputs))))
