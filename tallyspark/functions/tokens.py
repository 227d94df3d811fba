"""Script runs, dictionary tokens, translation guards and listed words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def runs(c: Column | str, script: str = "[ঀ-৿]+") -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit(f"({script})"), F.lit(1))


def core_runs(c: Column | str, generic: Sequence[str], script: str = "[ঀ-৿]+") -> Column:
    """The runs that aren't generic words."""
    return F.filter(runs(c, script), lambda r: ~r.isin(*generic))


def provenance(c: Column | str, lexicon: Sequence[str], backend: str, script: str = "[ঀ-৿]+") -> Column:
    """already-latin without a run of the script, lexicon if all runs are in it, lexicon+backend if some are, else backend."""
    r = runs(c, script)
    known = F.size(F.filter(r, lambda x: x.isin(*lexicon)))
    return F.when(F.size(r) == 0, "already-latin").when(known == F.size(r), "lexicon").when(known > 0, f"lexicon+{backend}").otherwise(backend)


def translated(native: Column, roman: Column, english: str, natives: Sequence[str], loans: Sequence[Sequence[str]]) -> Column:
    """Whether an English word stands for a native one instead of its sound; a source that borrowed every word may keep it."""
    says = F.coalesce(roman, F.lit("")).rlike(rf"(?i)(^|[^A-Za-z]){english}([^A-Za-z]|$)")
    borrowed = F.lit(bool(loans))
    for group in loans:
        any_ = F.lit(False)
        for w in group:
            any_ = any_ | native.contains(w)
        borrowed = borrowed & any_
    means = F.lit(False)
    for n in natives:
        means = means | native.contains(n)
    return says & ~borrowed & means


def unknown_as_blank(c: Column | str, words: Sequence[str] = ("unknown", "n/a")) -> Column:
    s = F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    return F.when(F.lower(s).isin(*words), "").otherwise(s)


def first_listed(c: Column | str, words: Sequence[tuple[str, str]]) -> Column:
    """The code of the first listed word that the text holds, '' without one; longer words must come first."""
    s, out = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), None
    for w, code in words:
        out = F.when(s.contains(w), code) if out is None else out.when(s.contains(w), code)
    return out.otherwise("")


def minted(number: Column) -> Column:
    """Digits as letters: a name that can only come from its own number."""
    return F.translate(number.cast("string"), "0123456789", "ABCDEFGHIJ")


def merged_lexicon(parts: Sequence[DataFrame]) -> DataFrame:
    """(word, roman) of several lexicons; of entries for one word the later lexicon's wins."""
    rows = parts[0].withColumn("_p", F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        rows = rows.unionByName(p.withColumn("_p", F.lit(k)))
    return rows.groupBy("word").agg(F.max(F.struct("_p", "roman")).alias("_m")).select("word", F.col("_m.roman").alias("roman"))


def by_lexicon(df: DataFrame, key: Sequence[str], column: str, lexicon: DataFrame, script: str = "[ঀ-৿]+") -> DataFrame:
    """key..., roman, known: the text with each run of the script that the lexicon has in its place, and how many it has."""
    pieces = df.select(*key, F.split(F.coalesce(column, F.lit("")), script).alias("_g"), F.posexplode_outer(runs(column, script)).alias("_k", "word"))
    found = pieces.join(lexicon, "word", "left")
    after = F.coalesce(F.get("_g", F.col("_k") + 1), F.lit(""))
    each = F.struct("_k", F.concat(F.coalesce("roman", "word", F.lit("")), after).alias("t"))
    out = found.groupBy(*key, "_g").agg(F.array_sort(F.collect_list(each)).alias("_t"), F.count("roman").alias("known"))
    return out.select(*key, F.concat(F.get("_g", F.lit(0)), F.array_join(F.transform("_t", lambda x: x["t"]), "")).alias("roman"), "known")
