"""Phrases over posting lists: which texts hold every word of a phrase, which values have a token for each of its words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = "([a-z]+)"


def words_of(text: Column | str, pattern: str = WORD) -> Column:
    """The distinct words of a text in lower case; none for null."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), F.lit(pattern), F.lit(1)))


def postings(df: DataFrame, key: str, text: str, block: int = 4096, pattern: str = WORD) -> DataFrame:
    """word, block, keys: for each word the sorted integer keys of the texts that hold it, in blocks of a range of keys.

    No array holds more than `block` keys, however common its word; a word is spread over as many rows as it has blocks.
    """
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.explode(words_of(text, pattern)).alias("word"))
    return rows.groupBy("word", F.floor(F.col("k") / block).alias("block")).agg(F.array_sort(F.collect_set("k")).alias("keys"))


def asked_words(phrases: DataFrame, phrase: str, pattern: str = WORD) -> DataFrame:
    """phrase, word, n: each distinct phrase's words and how many it has."""
    each = phrases.select(phrase).distinct().withColumn("_w", words_of(phrase, pattern))
    return each.select(phrase, F.explode("_w").alias("word"), F.size("_w").alias("n"))


def answered(index: DataFrame, phrases: DataFrame, phrase: str, pattern: str = WORD) -> DataFrame:
    """phrase, key of each text in postings() that holds every word of a phrase; a phrase without words is held by none.

    Division by block: a block in which any word has no posting drops out by its count, the others meet as an intersection
    of at most as many bounded arrays as the phrase has words.
    """
    hits = asked_words(phrases, phrase, pattern).join(index, "word").groupBy(phrase, "block").agg(F.first("n").alias("n"), F.collect_list("keys").alias("lists"))
    common = F.aggregate(F.slice("lists", 2, F.greatest(F.size("lists") - 1, F.lit(1))), F.get("lists", F.lit(0)), lambda kept, x: F.array_intersect(kept, x))
    return hits.filter(F.size("lists") == F.col("n")).select(phrase, F.explode(common).alias("key"))


def earned(values: DataFrame, key: str, tokens: str, index: DataFrame, phrases: DataFrame, phrase: str, pattern: str = WORD) -> DataFrame:
    """phrase, key of the values that have, for every word of a phrase, one of the tokens that index(word, token) has for it.

    A word that no token stands for is never earned, so neither is its phrase. Tokens of a value are an array.
    """
    need = asked_words(phrases, phrase, pattern).join(index.select("word", "token").distinct(), "word")
    have = values.select(F.col(key).alias("key"), F.explode(F.array_distinct(tokens)).alias("token"))
    met = have.join(need, "token").groupBy(phrase, "key").agg(F.count_distinct("word").alias("met"), F.first("n").alias("n"))
    return met.filter(F.col("met") == F.col("n")).select(phrase, "key")
