"""Scoped fuzzy matching and the keyed merges of a lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.functions.fuzzy import seq_ratio
from tallyspark.functions.text import parse_crop_key, reading_fields


def scoped_best(targets: DataFrame, candidates: DataFrame, scope: Sequence[str], accept: float = 0.85, margin: float = 0.05, review: float = 0.7, own: str | None = None) -> DataFrame:
    """scope..., target, candidate, score, runner_up, status for each target with candidates of its scope.

    status: accepted (score over accept, runner-up a margin below), review, or none; ties go to the smaller candidate.
    own: a column of targets with a candidate that the target can't have, null for none.
    """
    wanted = targets.select(*scope, "target", *([F.col(own).alias("_own")] if own else [])).distinct()
    pairs = wanted.join(candidates.select(*scope, "candidate").distinct(), list(scope))
    if own:
        pairs = pairs.filter(~F.col("candidate").eqNullSafe(F.col("_own")))
    scored = pairs.withColumn("score", seq_ratio("target", "candidate"))
    w = W.partitionBy(*scope, "target").orderBy(F.desc("score"), "candidate")
    top = scored.withColumns({"_r": F.row_number().over(w), "runner_up": F.lead("score").over(w)}).filter("_r = 1")
    clear = F.col("runner_up").isNull() | (F.col("score") - F.col("runner_up") >= margin)
    status = F.when((F.col("score") >= accept) & clear, "accepted").when(F.col("score") >= review, "review").otherwise("none")
    return top.select(*scope, "target", "candidate", "score", "runner_up", status.alias("status"))


def calibrate(matched: DataFrame, truth: DataFrame, key: Sequence[str]) -> DataFrame:
    """accepted, below, agree, differ, precision of accepted matches against known answers (key..., known)."""
    both = matched.join(truth, list(key))
    ok = F.col("status") == "accepted"
    out = both.agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("below"), F.count_if(ok & (F.col("candidate") == F.col("known"))).alias("agree"), F.count_if(ok & (F.col("candidate") != F.col("known"))).alias("differ"))
    return out.withColumn("precision", F.when(F.col("accepted") > 0, F.col("agree") / F.col("accepted")).otherwise(0.0))


def merge_lookup(old: DataFrame, entries: DataFrame, fills: DataFrame, keep: Sequence[str] = ("manual", "official")) -> DataFrame:
    """The lookup rows of `entries`: confirmed rows change in frequency only, others take a fresh fill, else what they had.

    old: field, native, frequency, roman, source, variant, authority, note; entries: field, native, frequency; fills:
    field, native, roman, source. Keys that entries lack are dropped.
    """
    key = ["field", "native"]
    o = old.select(*key, *(F.col(c).alias(f"o_{c}") for c in ("roman", "source", "variant", "authority", "note")))
    f = fills.select(*key, F.col("roman").alias("f_roman"), F.col("source").alias("f_source"))
    rows = entries.join(o, key, "left").join(f, key, "left")
    fixed = F.coalesce(F.col("o_authority").isin(*keep), F.lit(False))
    fresh = ~fixed & (F.coalesce("f_roman", F.lit("")) != "")
    pick = lambda c: F.coalesce(F.when(fresh, F.col(f"f_{c}")).otherwise(F.col(f"o_{c}")), F.lit(""))
    source = pick("source")
    return rows.select(*key, "frequency", pick("roman").alias("roman"), source.alias("source"), F.coalesce("o_variant", F.lit("")).alias("variant"), F.coalesce(F.nullif("o_authority", F.lit("")), source).alias("authority"), F.coalesce("o_note", F.lit("")).alias("note"))


def adopt(lookup: DataFrame, official: DataFrame, human: Sequence[str] = ("manual",)) -> DataFrame:
    """lookup with official spellings (field, native, spelling): the old one moves to variant if a human stood behind it."""
    rows = lookup.join(official, ["field", "native"], "left")
    new = (F.coalesce("spelling", F.lit("")) != "") & (F.col("spelling") != F.col("roman"))
    variant = F.when(new & F.col("authority").isin(*human) & (F.col("roman") != ""), F.col("roman")).otherwise(F.col("variant"))
    return rows.select("field", "native", "frequency", F.when(new, F.col("spelling")).otherwise(F.col("roman")).alias("roman"), F.when(new, "official").otherwise(F.col("source")).alias("source"), variant.alias("variant"), F.when(new, "official").otherwise(F.col("authority")).alias("authority"), "note")


def needs_second_pass(age: Column, house: Column, sex: Column) -> Column:
    """Whether a record is worth a second reading: its age is missing, or its house or sex is missing or blank."""
    return age.isNull() | (F.coalesce(house.cast("string"), F.lit("")) == "") | (F.coalesce(sex.cast("string"), F.lit("")) == "")


def readings_arm(readings: DataFrame, name: str, text: str, arm: str) -> DataFrame:
    """arm, part, page, row, col, and the fields of each reading whose name is a crop's; others are left out.

    All arms are read by the one parser, so that a comparison of arms measures the readers; of a crop that was read twice
    the greater text counts. Blank house and sex are ''.
    """
    rows = readings.withColumn("_k", parse_crop_key(name)).filter(F.col("_k.part").isNotNull() & F.col("_k.band").isNull())
    key = [F.col(f"_k.{c}").alias(c) for c in ("part", "page", "row", "col")]
    once = rows.groupBy(*key).agg(F.max(F.coalesce(text, F.lit(""))).alias("_t")).withColumn("_f", reading_fields("_t"))
    blank = lambda c: F.coalesce(f"_f.{c}", F.lit("")).alias(c)
    return once.select(F.lit(arm).alias("arm"), "part", "page", "row", "col", blank("name"), F.col("_f.age").alias("age"), blank("house"), blank("sex"))


def review_queue(lookup: DataFrame, order: Column | str) -> DataFrame:
    """The rows without a spelling, the most frequent first; equals keep the order that they came in, by `order`."""
    return lookup.filter(F.coalesce(F.trim("roman"), F.lit("")) == "").orderBy(F.desc("frequency"), order)


def second_pass(first: DataFrame, second: DataFrame, key: Sequence[str]) -> DataFrame:
    """first with gaps in age, house and sex filled from the second reading, and age overruled where they differ.

    flags gain recovered_x, disagreed_x, overruled_age in that order; age_first_pass keeps an overruled age.
    """
    fields = ("age", "house", "sex")
    rows = first.join(second.select(*key, *(F.col(f).alias(f"n_{f}") for f in fields)), list(key), "left")
    blank = {f: F.coalesce(F.col(f).cast("string"), F.lit("")) == "" for f in fields}
    has = {f: F.coalesce(F.col(f"n_{f}").cast("string"), F.lit("")) != "" for f in fields}
    differ = {f: ~blank[f] & has[f] & (F.col(f).cast("string") != F.col(f"n_{f}").cast("string")) for f in fields}
    flags = [F.when(blank[f] & has[f], f"recovered_{f}") for f in fields] + [F.when(differ[f], f"disagreed_{f}") for f in fields] + [F.when(differ["age"], "overruled_age")]
    taken = {f: F.when((blank[f] & has[f]) | (differ[f] if f == "age" else F.lit(False)), F.col(f"n_{f}")).otherwise(F.col(f)) for f in fields}
    return rows.select(*key, *(taken[f].alias(f) for f in fields), F.when(differ["age"], F.col("age")).alias("age_first_pass"), F.concat_ws(",", F.nullif(F.coalesce("flags", F.lit("")), F.lit("")), *flags).alias("flags"))


def propagate(lookup: DataFrame, official: str = "official") -> DataFrame:
    """lookup where every row of a native string takes its best official spelling (most frequent, then smallest)."""
    best = lookup.filter(F.col("authority") == official).groupBy("native").agg(F.min(F.struct((-F.col("frequency")).alias("f"), "roman")).alias("b"))
    return lookup.join(best.select("native", F.col("b.roman").alias("_r")), "native", "left").withColumn("roman", F.coalesce("_r", "roman")).drop("_r")


def inconsistent(lookup: DataFrame) -> DataFrame:
    """native, spellings (sorted) of native strings with more than one."""
    return lookup.filter("roman <> ''").groupBy("native").agg(F.array_sort(F.collect_set("roman")).alias("spellings")).filter(F.size("spellings") > 1)


def confirm(lookup: DataFrame, confirmed: DataFrame, key: Sequence[str], authority: str = "manual") -> DataFrame:
    """lookup where the confirmed keys have that authority; nothing else changes."""
    marks = confirmed.select(*key).distinct().withColumn("_ok", F.lit(True))
    return lookup.join(marks, list(key), "left").withColumn("authority", F.when(F.col("_ok"), authority).otherwise(F.col("authority"))).drop("_ok").select(*lookup.columns)


def candidate_scopes(rows: DataFrame, places: DataFrame, value: str, key: str, name: str) -> DataFrame:
    """value, candidate: for each value the distinct names of the places under any key that it occurs with."""
    scopes = rows.filter((F.coalesce(F.col(value), F.lit("")) != "") & F.col(key).isNotNull()).select(value, key).distinct()
    return scopes.join(places.select(key, F.col(name).alias("candidate")).filter("candidate IS NOT NULL").distinct(), key).select(value, "candidate").distinct()


def best_per_native(found: DataFrame, native: str, rank: str, score: str, roman: str) -> DataFrame:
    """native and its roman of the least (rank, -score, roman)."""
    return found.groupBy(native).agg(F.min(F.struct(F.col(rank), (-F.col(score)).alias("_s"), F.col(roman))).alias("_b")).select(native, F.col(f"_b.{roman}").alias(roman))


#: Stands for a run that goes, until the separator before it is gone too.
_DROPPED = "\ue000"


def apply_official(native: Column, official: Column, generic: dict[str, str], script: str = "[ঀ-৿]+") -> Column:
    """native with the official spelling in place of its core: the first run of the script that isn't generic becomes the
    official name, later ones go with the separator before them, generic ones are translated; all else stays."""
    runs, gaps = F.regexp_extract_all(native, F.lit(f"({script})"), F.lit(1)), F.split(native, script)
    known = F.create_map(*(F.lit(x) for kv in generic.items() for x in kv)) if generic else F.create_map().cast("map<string,string>")
    core = F.filter(F.transform(runs, lambda r, i: F.when(known[r].isNull(), i)), lambda i: i.isNotNull())
    first = F.get(core, F.lit(0))
    put = F.transform(runs, lambda r, i: F.coalesce(known[r], F.when(i == first, official), F.lit("")))
    joined = F.concat(F.get(gaps, F.lit(0)), F.array_join(F.transform(put, lambda r, i: F.concat(r, F.coalesce(F.get(gaps, i + 1), F.lit("")))), ""))
    closed = F.regexp_replace(F.regexp_replace(F.when(F.size(runs) == 0, native).otherwise(joined), f"[\\s\\-–—]*{_DROPPED}", ""), r"[(\[{]\s*[)\]}]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(closed, r"\s{2,}", " "), r"^[|,;:_\s-]+", ""), r"[|,;:_\s-]+$", "")
