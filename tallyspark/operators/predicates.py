"""Small row predicates and selections: missing values inherited, partial caches, splits, summary pages, rows to redo."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import text as T


def ordered_columns(*groups: Sequence[str], without: Sequence[str] = ()) -> list[str]:
    """The columns of the groups in order, each once, but for those left out."""
    return [c for c in dict.fromkeys(c for g in groups for c in g) if c not in without]


def inherit_missing(source: str, derived: Column) -> Column:
    """A derived value, null where its source is null and blank where it is blank."""
    return F.when(F.col(source).isNull(), F.lit(None)).when(F.trim(F.col(source)) == "", "").otherwise(derived)


def partial_cache(boxes: DataFrame, cached: DataFrame, key: Sequence[str], most: int = 10) -> DataFrame:
    """key..., boxes, cached of those whose boxes outnumber their cached reads by more than `most`."""
    have = cached.groupBy(*key).agg(F.count("*").alias("cached"))
    out = boxes.groupBy(*key).agg(F.count("*").alias("boxes")).join(have, list(key), "left").withColumn("cached", F.coalesce("cached", F.lit(0)))
    return out.filter(F.col("boxes") - F.col("cached") > most)


def split_of(column: str, lists: Sequence[tuple[str, Sequence]], rest: str) -> Column:
    """The name of the first list that a value is in."""
    out = None
    for name, values in lists:
        hit = F.col(column).isin(*values)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(rest) if out is None else out.otherwise(rest)


# How the closing table's title and its main row are printed.
SUMMARY_TITLE = r"(?i)summary\s+of\s+electors|ভোটাৰৰ\s+সংখ্যা|ভোটারের\s+সংখ্যা"
MAIN_ROW = r"(?i)মূল\s*তালিকা|mother\s*roll|basic\s*roll"


def is_summary_title(c: Column | str) -> Column:
    return T.clean_text(c).rlike(SUMMARY_TITLE)


def is_main_row(c: Column | str) -> Column:
    return T.clean_text(c).rlike(MAIN_ROW)


def to_redo(df: DataFrame, hopeless: Column, fields: Sequence[str], others: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """The rows with a reason to be read again, and their reasons: a field that is null, or another condition. Rows that
    reading again can't mend are left out."""
    each = [F.when(F.col(f).isNull(), F.lit(f)) for f in fields] + [F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in others]
    out = df.filter(~F.coalesce(hopeless, F.lit(False))).withColumn("reasons", F.filter(F.array(*each), lambda x: x.isNotNull()))
    return out.filter(F.size("reasons") > 0)


def answered_by_all(arms: DataFrame, key: Sequence[str], arm: str, value: str, n_arms: int) -> DataFrame:
    """The keys that every arm answered with something."""
    seen = arms.filter(F.coalesce(F.col(value).cast("string"), F.lit("")) != "")
    return seen.groupBy(*key).agg(F.count_distinct(arm).alias("_n")).filter(F.col("_n") == n_arms).select(*key)


def marked(rows: DataFrame, marks: DataFrame, crop: str) -> DataFrame:
    """rows(part, page, row, col, ...) with the mark of their crop, null where there is none."""
    at = marks.select(T.parse_crop_key(crop).alias("_k"), *(c for c in marks.columns if c != crop))
    parts = ["part", "page", "row", "col"]
    at = at.select(*(F.col(f"_k.{c}").cast(rows.schema[c].dataType).alias(c) for c in parts), *(c for c in marks.columns if c != crop))
    return rows.join(at, parts, "left")


def with_dimension(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """df with a dimension's columns; a key that the dimension lacks fails the query instead of losing its row."""
    out = df.join(dimension.withColumn("_known", F.lit(True)), key, "left")
    ok = F.when(F.col("_known"), True).otherwise(F.raise_error(F.concat(F.lit("unknown code "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean"))
    return out.filter(ok).drop("_known")


def profile_problems(labels: Sequence[str], fields: Sequence[str], anchors: Sequence[str], least: int = 4) -> list[str]:
    """What is wrong with a form's profile: label and field lists of unequal length, too few anchors."""
    return [p for p, bad in (("labels and fields differ in length", len(labels) != len(fields)), ("too few anchors", len(anchors) < least)) if bad]
