"""Check batteries: a registry of named checks, their results per row and their summaries at two grains."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import text as T


@dataclass(frozen=True)
class Check:
    """passed may be null, which fails; where `runs` isn't true the check is left out of the row's results."""

    name: str
    severity: str
    passed: Column
    runs: Column | None = None


def run_checks(df: DataFrame, checks: Sequence[Check], column: str = "checks") -> DataFrame:
    """df with an array of struct(name, severity, passed)."""

    def one(c: Check) -> Column:
        result = F.struct(F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"), F.coalesce(c.passed, F.lit(False)).alias("passed"))
        return result if c.runs is None else F.when(F.coalesce(c.runs, F.lit(False)), result)

    return df.withColumn(column, F.filter(F.array(*(one(c) for c in checks)), lambda x: x.isNotNull()))


def roll_up(df: DataFrame, column: str = "checks", review: Sequence[str] = (), separator: str = ";") -> DataFrame:
    """df with checks_passed, checks_total, flags (sorted names of failures) and needs_review (a hard failure or one of `review`)."""
    failed = F.filter(F.col(column), lambda x: ~x["passed"])
    grave = F.exists(failed, lambda x: (x["severity"] == "hard") | x["name"].isin(*review))
    return df.withColumns(
        {
            "checks_passed": (F.size(column) - F.size(failed)).cast("int"),
            "checks_total": F.size(column).cast("int"),
            "flags": F.array_join(F.array_sort(F.transform(failed, lambda x: x["name"])), separator),
            "needs_review": grave,
        }
    )


def summary(df: DataFrame, group: str, flags: Sequence[str], unknown: str = "UNKNOWN") -> DataFrame:
    """Overall and per-group metrics in one pass: grain, group, n, review, clean, and the share of rows without each flag."""
    key = F.coalesce(F.nullif(F.trim(F.col(group).cast("string")), F.lit("")), F.lit(unknown))
    rows = df.withColumn("_g", key)
    has = [F.avg(F.when(F.array_contains(F.split("flags", ";"), f), 0.0).otherwise(1.0)) for f in flags]
    out = rows.groupingSets([[], ["_g"]], "_g").agg(
        F.grouping("_g").alias("_all"), F.count("*").alias("n"), F.count_if("needs_review").alias("review"), F.count_if(F.col("flags") == "").alias("clean"), *(F.bround(h, 4).alias(f"no_{f}") for h, f in zip(has, flags, strict=True))
    )
    return out.select(F.when(F.col("_all") == 1, "overall").otherwise("group").alias("grain"), F.when(F.col("_all") == 1, F.lit("")).otherwise(F.col("_g")).alias(group), "n", "review", "clean", *(f"no_{f}" for f in flags))


def problem_list(named: Sequence[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in their order."""
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in named)), lambda x: x.isNotNull())


def battery_counts(df: DataFrame, problems: str = "problems") -> DataFrame:
    """(problem, n), the most common first and by name where it ties."""
    return df.select(F.explode(problems).alias("problem")).groupBy("problem").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "problem")


def part_battery(context: dict[str, Column]) -> list[Check]:
    """The checks of a part record, in their order; a check that can't run is left out of the row's results.

    context: columns of the rows with what a record is held against: parts_per_ac, qualifying_date, publication_date,
    revision_year (modes of the corpus) and district (mode of the record's ac), null where there is none.
    """
    c = F.col
    number = T.as_int
    blank = lambda name: F.coalesce(F.trim(c(name)), F.lit("")) == ""
    total, start, end = c("electors_total"), c("start_serial"), c("end_serial")
    pin = F.trim(F.coalesce("pin_code", F.lit("")))
    template = c("template_match").cast("string")
    out = [Check(f"{n}_matches_filename", "hard", number(n) == number(F.col(f"{n}_file").cast("string"))) for n in ("ac_no", "part_no")]
    out += [
        Check("gender_sum_matches_total", "hard", c("electors_male") + c("electors_female") + c("electors_third_gender") == total),
        Check("serial_order", "hard", end >= start),
        Check("serial_span_covers_total", "soft", end - start + 1 >= total, total.isNotNull() & start.isNotNull() & end.isNotNull()),
        Check("pin_code_plausible", "soft", pin.rlike("^7[89][0-9]{4}$")),
        Check("ac_no_in_range", "soft", number("ac_no").between(1, 126)),
        Check("part_no_within_ac", "soft", number("part_no").between(1, context["parts_per_ac"]), context["parts_per_ac"].isNotNull() & number("part_no").isNotNull()),
    ]
    out += [Check(f"{n}_matches_corpus", "soft", c(n) == context[n], context[n].isNotNull()) for n in ("qualifying_date", "publication_date", "revision_year")]
    out.append(Check("district_matches_ac_mode", "soft", c("district") == context["district"], context["district"].isNotNull()))
    out += [Check(f"{n}_present", "soft", ~blank(n)) for n in ("ps_name", "district", "ps_address")]
    out.append(Check("template_match", "soft", template.isin("true", "True", "")))
    out.append(Check("confidence_not_low", "soft", F.upper(F.coalesce("extraction_confidence", F.lit(""))) != "LOW"))
    return out


#: Soft checks whose failure sends a record to review all the same.
REVIEWED = ("template_match", "confidence_not_low")
