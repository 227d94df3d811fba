"""Records out of printed lines: scored labels and words, lines to fields, fields to a row with its flags.

Similarities of a line's words are taken in the row that has the line, so that no table of candidates is made, joined or
broadcast. The few labels of forms are scored as tables of distinct candidates, and the best is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.functions import fuzzy
from tallyspark.functions import text as T
from tallyspark.functions.fuzzy import seq_ratio

# Fixed values of the printed form: the words of its sex field, the relatives that a label can name, and its labels.
SEX_WORDS = (("পুৰুষ", "M"), ("মহিলা", "F"), ("তৃতীয়", "T"))
RELATIVES = (("পিতাৰ", "father"), ("স্বামীৰ", "husband"), ("মাতাৰ", "mother"), ("মাতৃৰ", "mother"))
NAME_LABEL, AGE_LABEL, SEX_LABEL, RELATION_SHAPE = "নাম", "বয়স", "ল[ঀ-৿]{0,3}[গকঙ]", r"(\S{2,12}?)\s*নাম"
HOUSE_LABELS = ("ঘৰ নং", "ঘৰনং", "ঘর নং", "ঘৰ ন", "বাড়ী নং", "বাড়ীনং", "বাড়ি নং", "বাড়িনং")
STRUCK_WORD = "DELETED"


def _options(values: Sequence[tuple[str, str]]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("place"), F.lit(w).alias("word"), F.lit(c).alias("code")) for k, (w, c) in enumerate(values)))


def _score(candidates: DataFrame, seen: str, word: str) -> DataFrame:
    """candidates with the similarity of seen to word, each distinct pair scored once."""
    pairs = candidates.select(F.col(seen).alias("_seen"), F.col(word).alias("_word")).distinct()
    scored = pairs.withColumn("score", seq_ratio("_seen", "_word"))
    return candidates.join(scored, (candidates[seen] == scored["_seen"]) & (candidates[word] == scored["_word"])).drop("_seen", "_word")


def ending_code(column: str, words: Sequence[tuple[str, str]] = SEX_WORDS, least: float = 0.5, tail: int = 12, script: str = "ঀ-৿") -> Column:
    """The code of the word that a text's end resembles, or null: every ending of the last `tail` letters of the script, two
    letters at least, is held against every word; of equals the first word counts."""
    return fuzzy.ending_code(F.right(F.regexp_replace(T._text(column), f"[^{script}]", ""), F.lit(tail)), words, least)


def with_relation_label(df: DataFrame, column: str, relatives: Sequence[tuple[str, str]] = RELATIVES, shape: str = RELATION_SHAPE, within: int = 48, least: float = 0.5, sure: float = 0.7) -> DataFrame:
    """df with ends and kind of a text's relation label, nulls without one: the first place of the label's shape whose word
    resembles a relative. ends: how many characters the label takes; kind is '' where the likeness is below `sure`."""
    head, zero = F.substring(T._text(column), 1, within), F.lit(0)
    words = F.transform(F.regexp_extract_all(head, F.lit(shape), F.lit(1)), lambda w: F.regexp_replace(w, "^[৷| ]+", ""))
    length = lambda a: F.aggregate(F.slice(a, 1, F.col("_f.k") + 1), zero, lambda n, x: n + F.length(x))
    ends = length(F.regexp_extract_all(head, F.lit(shape), F.lit(0))) + length(F.split(head, shape))
    found = df.withColumn("_f", fuzzy.first_like(words, relatives, least, sure))
    return found.withColumns({"ends": F.when(F.col("_f.k").isNotNull(), ends), "kind": F.col("_f.code")}).drop("_f")


def relation_value(line: str, ends: str = "ends", least: int = 3) -> Column:
    """The name on a relation line: after its label, or without one after the first separator that leaves enough."""
    s = T._text(line)
    tries = [T.rest_after(s, x) for x in (":", "'", "‘", "’")]
    rest = F.coalesce(*(F.when(F.length(t) >= least, t) for t in tries), F.lit(""))
    return F.when(F.col(ends).isNotNull(), T.clean_value(F.substring(s, F.col(ends) + 1, F.length(s)))).otherwise(rest)


def described_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """lines with ends, kind (of a relation label), sex, age and is_age: a line is an age line by either label, or by a
    plausible age beside a sex. Each line is described where it lies: dealt out by the key of bands(), it stays there."""
    rows = lines.select(column, *(c for c in lines.columns if c != column)).withColumn("_code", ending_code(column))
    out = with_relation_label(rows, column).withColumn("sex", F.coalesce("_code", F.lit(""))).drop("_code")
    ages = F.transform(F.regexp_extract_all(T.normalize_digits(column), F.lit("([0-9]{1,3})"), F.lit(1)), lambda x: x.cast("int"))
    plausible = F.exists(ages, lambda a: (a >= 18) & (a <= 120))
    is_age = F.col(column).contains(AGE_LABEL) | F.col(column).rlike(SEX_LABEL) | (plausible & (F.col("sex") != ""))
    return out.withColumns({"age": T.age_from(column), "is_age": is_age})


def bands(described: DataFrame, by: Sequence[str], order: str = "k", column: str = "line") -> DataFrame:
    """by..., top, and name, relation, house, age as structs of described lines, null where a band is missing.

    The last age line closes a record. The last relation label above it is the anchor: the name is the first line above
    the age line with the name's label and no relation label, else the line over the anchor; the house is the line under it.
    Without an anchor house, relation and name are the lines over the age line, from below.
    """
    d = described.filter(T._text(column) != "")
    w = W.partitionBy(*by)
    d = d.withColumn("_age_at", F.max(F.when(F.col("is_age"), F.col(order))).over(w))
    d = d.withColumn("_above", F.col("_age_at").isNull() | (F.col(order) < F.col("_age_at")))
    d = d.withColumn("_n", F.when(F.col("_above"), F.row_number().over(W.partitionBy(*by, "_above").orderBy(order))))
    d = d.withColumn("_anchor", F.max(F.when(F.col("_above") & F.col("ends").isNotNull(), F.col("_n"))).over(w)).withColumn("_count", F.max("_n").over(w))
    row = F.struct(column, "ends", "kind", "sex", "age")
    anchored, n, last = F.col("_anchor").isNotNull(), F.col("_n"), F.col("_count")
    labelled = F.col("_above") & F.col(column).contains(NAME_LABEL) & F.col("ends").isNull()
    pick = lambda cond: F.min_by(F.when(cond, row), F.when(cond, F.col(order)))
    out = d.groupBy(*by).agg(
        F.min_by(F.struct(column, "ends"), F.col(order)).alias("top"),
        pick(labelled & anchored).alias("_named"), pick(anchored & (n == F.col("_anchor") - 1)).alias("_over"), pick(~anchored & (n == last - 2)).alias("_third"),
        pick(~anchored & F.col("_above") & F.col(column).contains(NAME_LABEL) & (n != last - 1)).alias("_loose"),
        pick(F.when(anchored, n == F.col("_anchor")).otherwise(n == last - 1)).alias("relation"),
        pick(F.when(anchored, n == F.col("_anchor") + 1).otherwise(n == last)).alias("house"),
        pick(F.col(order) == F.col("_age_at")).alias("age"),
    )
    return out.select(*by, "top", F.coalesce("_named", "_over", "_third", "_loose").alias("name"), "relation", "house", "age")


def _same_band(name: Column, top: Column, other: Column, column: str) -> Column:
    """The other reading's name where both begin with the same band, else ''; see second_name()."""
    same = name.isNull() | (name[column] == top[column])
    ok = same & other.isNotNull() & top["ends"].isNull() & other["ends"].isNull()
    return F.when(ok, T.rest_after(other[column], NAME_LABEL)).otherwise("")


def second_name(first: DataFrame, second: DataFrame, by: Sequence[str], column: str = "line", keep: Sequence[Column] = ()) -> DataFrame:
    """by..., second_name: the other reading's name, where both readings begin with the same band: the first reading's name
    is its top line or missing, and neither top line is a relation. keep: columns of the first reading to have with it."""
    a = first.select(*by, F.col("name").alias("_a"), F.col("top").alias("_t"), *keep)
    both = a.join(second.select(*by, F.col("top").alias("_u")).hint("merge"), list(by), "left")
    kept = [c for c in a.columns if c not in (*by, "_a", "_t")]
    return both.select(*by, *kept, _same_band(F.col("_a"), F.col("_t"), F.col("_u"), column).alias("second_name"))


def differs(df: DataFrame, one: str, two: str, name: str = "differs", least: float = 0.9) -> DataFrame:
    """df with whether two filled readings differ by more than noise: a similarity under `least`."""
    filled = (F.col(one) != "") & (F.col(two) != "")
    return df.withColumn("_r", seq_ratio(one, two)).withColumn(name, F.coalesce(filled & (F.col("_r") < least), F.lit(False))).drop("_r")


def assemble(boxes: DataFrame, first: DataFrame, second: DataFrame, by: Sequence[str], id_strip: str, serial_strip: str, column: str = "line") -> DataFrame:
    """by..., name, relation_name, relation_type, house_no, age, sex, id, serial, flags: a record from two readings of its
    lines (see bands()) and the strips of its id and serial. Flags stand in a fixed order; a box without any field has none
    of the no_x flags, as the publisher left it blank."""
    one, two = (bands.select(*by, F.lit(True).alias(f"_read_{k}"), *(F.col(c).alias(f"{c}_{k}") for c in ("top", "name", "relation", "house", "age"))) for k, bands in ((1, first), (2, second)))
    # Spark's estimates don't know how many lines a box has, so that it would broadcast the bands of any number of boxes.
    rows = boxes.select(*by, id_strip, serial_strip).join(one.hint("merge"), list(by), "left").join(two.hint("merge"), list(by), "left")
    other = F.when(F.col("_read_1"), _same_band(F.col("name_1"), F.col("top_1"), F.col("top_2"), column)).otherwise("")
    rows = rows.withColumns({"_own": T.rest_after(f"name_1.{column}", NAME_LABEL), "_other": other})
    rows = differs(rows, "_own", "_other", "_disagree")
    for k in (1, 2):
        rows = rows.withColumn(f"_ends{k}", F.col(f"relation_{k}.ends")).withColumn(f"_rel{k}", relation_value(f"relation_{k}.{column}", f"_ends{k}"))
    rows = rows.withColumns({"_n": T.without_foreign(F.when(F.col("_own") != "", F.col("_own")).otherwise(F.col("_other"))), "_rel": T.longest_reading("_rel1", "_rel2")})
    rows = rows.withColumn("_r", T.without_foreign("_rel.value"))
    line = lambda band, k: F.col(f"{band}_{k}.{column}")
    first_of = lambda *c: F.coalesce(*(F.when(x != "", x) for x in c), F.lit(""))
    kind = first_of(F.col("relation_1.kind"), F.col("relation_2.kind"))
    age1, age2, sex = F.col("age_1.age"), F.col("age_2.age"), first_of(F.col("age_1.sex"), F.col("age_2.sex"))
    house = T.house_number(first_of(line("house", 1), line("house", 2)), HOUSE_LABELS)
    strip = F.upper(F.regexp_replace(T._text(id_strip), "[^A-Za-z0-9]", ""))
    ident = F.coalesce(F.nullif(F.regexp_extract(strip, "[A-Z]{3}[A-Z0-9]{7}", 0), F.lit("")), F.regexp_extract(strip, "[A-Z]{2,4}[0-9]{6,9}", 0))
    serial = F.regexp_extract(T.normalize_digits(serial_strip), "[0-9]{1,4}", 0).try_cast("int")
    out = rows.select(*by, F.col("_n.value").alias("name"), F.col("_r.value").alias("relation_name"), kind.alias("relation_type"), house.alias("house_no"), F.coalesce(age1, age2).alias("age"), sex.alias("sex"), ident.alias("id"), serial.alias("serial"), "_disagree", F.col("_n.uncertain").alias("_nu"), F.col("_r.uncertain").alias("_ru"), F.col("_rel.agreed").alias("_agreed"),
        *((F.coalesce(f(line("age", k)), F.lit(False)) & (line("age", k) != "")).alias(f"_{n}{k}") for k in (1, 2) for n, f in (("amb", T.age_is_ambiguous), ("unr", T.age_is_unreadable))), age1.alias("_age1"), age2.alias("_age2"))
    some = ~is_empty()
    none1 = F.col("_age1").isNull()
    named = [
        (F.col("_disagree"), "name_disagreement"), (F.col("_nu"), "name_repaired"), (F.col("_ru"), "relation_repaired"), (~F.col("_agreed"), "relation_disagreement"),
        (~none1 & F.col("_amb1"), "age_ambiguous"), (none1 & F.col("_unr1"), "age_unreadable"), (none1 & F.col("_age2").isNotNull() & F.col("_amb2"), "age_ambiguous"), (none1 & F.col("_age2").isNull() & F.col("_unr2"), "age_unreadable"),
        (some & (F.col("id") == ""), "no_epic"), (some & (F.col("name") == ""), "no_name"), (some & F.col("age").isNull(), "no_age"), (some & (F.col("sex") == ""), "no_sex"),
    ]
    flags = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in named)), lambda x: x.isNotNull())
    return out.withColumn("flags", flags).drop(*(c for c in out.columns if c.startswith("_")))


def is_empty(fields: Sequence[str] = ("id", "name", "age", "relation_name", "house_no", "sex")) -> Column:
    """Whether no field of a record holds anything."""
    out = F.lit(True)
    for f in fields:
        out = out & (F.coalesce(F.col(f).cast("string"), F.lit("")) == "")
    return out


def struck_off(words: DataFrame, by: Sequence[str], column: str, stamp: str = STRUCK_WORD, least: float = 0.55) -> DataFrame:
    """by..., struck: whether a word of a box resembles the stamp; ids and words under four Latin letters don't count."""
    token = F.upper(F.regexp_replace(T._text(column), "[^A-Za-z]", ""))
    seen = words.withColumn("_t", F.when((F.length(token) >= 4) & ~F.trim(T._text(column)).rlike("^[A-Z]{2,4}[0-9]{6,9}$"), token))
    like = seen.select("_t").filter("_t IS NOT NULL").distinct().withColumn("_like", seq_ratio("_t", F.lit(stamp)) >= least)
    return seen.join(like, "_t", "left").groupBy(*by).agg(F.coalesce(F.bool_or("_like"), F.lit(False)).alias("struck"))


def rows_by_label(rows: DataFrame, by: Sequence[str], order: str, column: str, labels: Sequence[tuple[str, str]], least: float = 0.55) -> DataFrame:
    """by..., order, column, field: each row's field by the label that it resembles best (the later of equals), and null
    where none comes near or an earlier row has the field."""
    seen = rows.select(column).distinct()
    asked = seen.select(column, F.explode(_options(labels)).alias("_o")).select(column, "_o.*")
    clean = asked.withColumns({"_s": T.clean_text(column), "_l": T.clean_text("word")})
    best = _score(clean, "_s", "_l").groupBy(column).agg(F.max(F.struct("score", "place", "code")).alias("_b"))
    matched = rows.join(best, column, "left").withColumn("field", F.when(F.col("_b.score") >= least, F.col("_b.code")))
    first = F.row_number().over(W.partitionBy(*by, "field").orderBy(order)) == 1
    return matched.select(*by, order, column, F.when(first, F.col("field")).alias("field"))
