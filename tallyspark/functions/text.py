"""Text to typed fields, as column expressions. Digit classes are spelt out, so that no engine reads them otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bengali and Devanagari digits, and the letters that a reader puts where a digit belongs.
NATIVE_DIGITS = "০১২৩৪৫৬৭৮৯०१२३४५६७८९"
LOOKALIKES, LOOKALIKE_DIGITS = "OQDILSBZG", "000115826"
# What stands around a value as debris, and vowel signs, which belong to a value only after a letter of it.
FURNITURE, ENDS, MARKS = r"[|\[\]{}_~`^*=<>]+", r" :;.,'\"\-‘’", "়ািীুূেৈোৌ্"
FOREIGN, NATIVE, NATIVE_LETTER = "[A-Za-z0-9০-৯]+", "[ঀ-৿]", "[ঀ-৥ৰ-৿]"
STRICT_ID, LOOSE_ID = r"^[A-Z]{3}[0-9]{7}$", r"^[A-Z]{2,4}[0-9]{6,9}$"


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def normalize_digits(c: Column | str) -> Column:
    """Native digits as ASCII ones; null as ''."""
    return F.translate(_text(c), NATIVE_DIGITS, "0123456789" * 2)


def first_int(c: Column | str) -> Column:
    """The first run of digits as a long, or null; runs too long for a long are null."""
    return F.regexp_extract(normalize_digits(c), "([0-9]+)", 1).try_cast("bigint")


def as_int(c: Column | str) -> Column:
    """A whole number after stripping, null for blanks and anything else."""
    s = F.trim(_text(c))
    return F.when(s.rlike("^[+-]?[0-9]+$"), s.try_cast("bigint"))


def clean_text(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends. Composition to NFC is fuzzy.nfc()."""
    return F.trim(F.regexp_replace(_text(c), r"[\s ]+", " "))


def digit_signature(c: Column | str) -> Column:
    """The digits of a value, in order; values that differ here never merge."""
    return F.regexp_replace(normalize_digits(c), "[^0-9]", "")


def iso_date(c: Column | str) -> Column:
    """The first dd-mm-yyyy as yyyy-mm-dd, '' without one; the calendar isn't checked."""
    m = r"([0-9]{2})-([0-9]{2})-([0-9]{4})"
    s = normalize_digits(c)
    return F.when(s.rlike(m), F.concat_ws("-", F.regexp_extract(s, m, 3), F.regexp_extract(s, m, 2), F.regexp_extract(s, m, 1))).otherwise("")


def numbered_name(c: Column | str) -> Column:
    """struct(number, name) of 'n - name'; number null and name the cleaned text where that shape is absent."""
    m, s = r"^\s*([0-9]+)\s*[-–]\s*(.*?)\s*$", normalize_digits(c)
    hit = s.rlike(m)
    return F.struct(F.when(hit, F.regexp_extract(s, m, 1).try_cast("bigint")).alias("number"), F.when(hit, F.regexp_extract(s, m, 2)).otherwise(F.trim(s)).alias("name"))


def reservation(c: Column | str, codes: dict[str, str]) -> Column:
    """struct(name, code): a trailing '(x)' that `codes` knows is split off; otherwise the text stays and code is ''."""
    m, s = r"^(.*?)\s*\(([^()]*)\)\s*$", _text(c)
    mapping = F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))
    code = F.when(s.rlike(m), mapping[F.upper(F.trim(F.regexp_extract(s, m, 2)))])
    return F.struct(F.when(code.isNotNull(), F.trim(F.regexp_extract(s, m, 1))).otherwise(F.trim(s)).alias("name"), F.coalesce(code, F.lit("")).alias("code"))


def value_after_label(c: Column | str, separators: str = ":") -> Column:
    """What follows the first separator, stripped; '' without one."""
    s = _text(c)
    return F.trim(F.when(s.rlike(f"[{separators}]"), F.regexp_extract(s, f"(?s)^[^{separators}]*[{separators}](.*)$", 1)).otherwise(""))


def strip_colon(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), r"^[\s:]+", "")


def strip_html(c: Column | str) -> Column:
    """Text without tags; tags become spaces, white space collapses."""
    return F.trim(F.regexp_replace(F.regexp_replace(_text(c), "<[^>]*>", " "), r"\s+", " "))


def repair_id(c: Column | str) -> Column:
    """A three-letter, seven-digit id out of a noisy read: letters in the digit places become the digits they resemble.

    Where that shape is absent, the first loosely shaped id, else ''.
    """
    s = F.upper(F.regexp_replace(_text(c), "[^A-Za-z0-9]", ""))
    strict = F.regexp_extract(s, "([A-Z]{3})([A-Z0-9]{7})", 0)
    fixed = F.concat(F.substring(strict, 1, 3), F.translate(F.substring(strict, 4, 7), LOOKALIKES, LOOKALIKE_DIGITS))
    return F.when(F.length(strict) > 0, fixed).otherwise(F.regexp_extract(s, "[A-Z]{2,4}[0-9]{6,9}", 0))


def id_was_repaired(c: Column | str) -> Column:
    """Whether repair_id() had to change a character."""
    s = F.upper(F.regexp_replace(_text(c), "[^A-Za-z0-9]", ""))
    tail = F.regexp_extract(s, "([A-Z]{3})([A-Z0-9]{7})", 2)
    return (F.length(tail) > 0) & (tail != F.translate(tail, LOOKALIKES, LOOKALIKE_DIGITS))


def age_from(c: Column | str, low: int = 18, high: int = 120) -> Column:
    """The first plausible age among the digit runs, the halves of three-digit runs and the first two digits of all."""
    runs = F.regexp_extract_all(normalize_digits(c), F.lit("([0-9]+)"), F.lit(1))
    pieces = F.flatten(F.transform(runs, lambda r: F.when(F.length(r) == 3, F.array(r, F.substring(r, 1, 2), F.substring(r, 2, 2))).otherwise(F.array(r))))
    joined = F.array_join(runs, "")
    tried = F.concat(pieces, F.when(F.length(joined) >= 2, F.array(F.substring(joined, 1, 2))).otherwise(F.array().cast("array<string>")))
    return F.get(F.filter(F.transform(tried, lambda x: x.try_cast("int")), lambda a: (a >= low) & (a <= high)), F.lit(0))


def age_is_unreadable(c: Column | str) -> Column:
    """Digits are there, but none of them makes an age."""
    return normalize_digits(c).rlike("[0-9]") & age_from(c).isNull()


def age_is_ambiguous(c: Column | str) -> Column:
    """The first run holds more digits than an age has."""
    return F.length(F.regexp_extract(normalize_digits(c), "([0-9]+)", 1)) > 2


def clean_value(c: Column | str) -> Column:
    """A value without the debris around it.

    Furniture counts as space. What goes at the end is the longest run of end marks, each with the vowel signs that hang
    on it; at the start, any run of end marks and vowel signs.
    """
    s = F.trim(F.regexp_replace(F.regexp_replace(_text(c), FURNITURE, " "), r"\s+", " "))
    return F.regexp_replace(F.regexp_replace(s, f"(?:[{ENDS}][{MARKS}]*)+$", ""), f"^[{ENDS}{MARKS}]+", "")


def without_foreign(c: Column | str) -> Column:
    """struct(value, uncertain): a native value without Latin letters and digits; uncertain where such a run stood between
    two native letters, as it may have taken a letter's place. Values without a native character are only cleaned."""
    s = _text(c)
    foreign, native = s.rlike(FOREIGN), s.rlike(NATIVE)
    value = F.when(foreign & native, clean_value(F.regexp_replace(s, FOREIGN, ""))).when(foreign, clean_value(s)).otherwise(s)
    return F.struct(value.alias("value"), (foreign & native & s.rlike(NATIVE_LETTER + FOREIGN + NATIVE_LETTER)).alias("uncertain"))


def rest_after(c: Column | str, label: Column | str) -> Column:
    """The cleaned text after the first place of a label, '' without it."""
    s, label = _text(c), F.lit(label) if isinstance(label, str) else label
    at = F.instr(s, label)
    return F.when(at > 0, clean_value(F.substring(s, at + F.length(label), F.length(s)))).otherwise("")


def house_number(c: Column | str, labels: Sequence[str] = ()) -> Column:
    """What follows the first label that gives a value, else the first digit group such as 12-3/4, else ''."""
    s = normalize_digits(c)
    tried = [F.nullif(F.trim(F.regexp_replace(F.substring_index(s, label, -1), r"^[\s:;'‘’.,-]+", "")), F.lit("")) for label in labels]
    found = [F.when(s.contains(label), t) for label, t in zip(labels, tried, strict=True)]
    return F.coalesce(*found, F.regexp_extract(s, "[0-9]+(?:[-/][0-9]+)*", 0))


def roman_repair(c: Column | str) -> Column:
    """Transliteration debris: zero-width joiners and dandas go, x becomes s, doubled a one, edges are stripped."""
    s = F.translate(_text(c), "‌‍।৷॥", "")
    s = F.regexp_replace(F.translate(s, "xX", "sS"), "aa", "a")
    s = F.regexp_replace(F.regexp_replace(s, "Aa|AA", "A"), r"\s+", " ")
    return F.regexp_replace(F.regexp_replace(s, r"^[|,;:_\s-]+", ""), r"[|,;:_\s-]+$", "")


def fold_key(c: Column | str) -> Column:
    """Lower-cased letters and digits only."""
    return F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]", "")


def plausible_serial(c: Column | str, high: int = 9999) -> Column:
    n = F.when(F.trim(_text(c)).rlike("^[0-9]+$"), F.trim(_text(c)).try_cast("int"))
    return F.when((n >= 1) & (n <= high), n)


def longest_reading(*cols: Column | str) -> Column:
    """struct(value, agreed): the readings' common value, or the first longest with agreed false; blanks don't count."""
    found = F.filter(F.array(*(_text(c) for c in cols)), lambda x: x != "")
    best = F.aggregate(found, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    return F.struct(best.alias("value"), (F.size(F.array_distinct(found)) <= 1).alias("agreed"))


def section_of(c: Column | str, markers: Sequence[tuple[str, str]], default: str = "main", letters: str = "A-Za-z") -> Column:
    """The section of the first marker, in their order, that stands as a whole word."""
    s, out = clean_text(c), None
    for word, name in markers:
        hit = s.rlike(f"(^|[^{letters}]){word}([^{letters}]|$)")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def leaked_label(c: Column | str, labels: Sequence[str], letters: str = "A-Za-z") -> Column:
    """A label as a whole word at either end of a value."""
    any_ = "|".join(labels)
    return _text(c).rlike(rf"(?i)^\s*({any_})([^{letters}]|$)") | _text(c).rlike(rf"(?i)(^|[^{letters}])({any_})\s*$")


def human_duration(seconds: Column) -> Column:
    """'2h 14m', '14m 3s' or '3s'."""
    s = F.floor(seconds).cast("int")
    h, m, r = F.floor(s / 3600).cast("int"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("int"), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.format_string("%dh %dm", h, m)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def crop_key(part: Column, page: Column, row: Column, col: Column) -> Column:
    return F.format_string("p%d_pg%d_r%dc%d", part, page, row, col)


def parse_crop_key(c: Column | str) -> Column:
    """struct(part, page, row, col, band) of a key, nulls where it has another shape."""
    m, s = r"^p([0-9]+)_pg([0-9]+)_r([0-9]+)c([0-9]+)(?:_b([0-9]+))?$", _text(c)
    return F.struct(*(F.regexp_extract(s, m, k).try_cast("int").alias(n) for k, n in enumerate(("part", "page", "row", "col", "band"), 1)))


def url_fields(c: Column | str) -> Column:
    """struct(scheme, host, lang, number): typed fields of a name with a fixed pattern, all null on mismatch."""
    m, s = r"^(https?)://([^/]+)/([a-z]{2})/([0-9]+)", F.trim(_text(c))
    hit = s.rlike(m)
    return F.struct(*(F.when(hit, F.regexp_extract(s, m, k).cast(t)).alias(n) for k, (n, t) in enumerate((("scheme", "string"), ("host", "string"), ("lang", "string"), ("number", "bigint")), 1)))


def balancing(numbers: Column, width: int = 3, least: int = 20) -> Column:
    """The last run of `width` numbers whose last is the sum of the others and at least `least`; null without one."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(numbers) - width + 1, F.lit(1))), lambda i: F.slice(numbers, i, width))
    whole = F.filter(runs, lambda r: F.size(r) == width)
    zero = F.lit(0).cast("bigint")
    good = F.filter(whole, lambda r: (F.aggregate(F.slice(r, 1, width - 1), zero, lambda a, x: a + x) == F.get(r, F.lit(width - 1))) & (F.get(r, F.lit(width - 1)) >= least))
    return F.get(good, F.size(good) - 1)


def fold_ra(c: Column | str) -> Column:
    """One form for both letters ra, and no white space: what two readings are compared by."""
    return F.regexp_replace(F.translate(_text(c), "র", "ৰ"), r"\s+", "")


def has_native_digit(c: Column | str) -> Column:
    return _text(c).rlike(f"[{NATIVE_DIGITS}]")


def mapped(c: Column | str, names: dict[str, str], rest: str = "") -> Column:
    """The name that a profile gives a cleaned, lower-cased value, `rest` for others."""
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.coalesce(known[F.lower(clean_text(c))], F.lit(rest))


def section_or_main(c: Column | str, default: str = "main") -> Column:
    """A section's name, the default where it is null or blank."""
    return F.coalesce(F.nullif(F.trim(_text(c)), F.lit("")), F.lit(default))


def comparable(field: Column, c: Column | str) -> Column:
    """A field's value as readings of it are compared: house numbers without spaces, unknown as blank, others as they are."""
    s = F.trim(_text(c))
    s = F.when(F.lower(s) == "unknown", "").otherwise(s)
    return F.when(field == "house", F.regexp_replace(s, r"\s+", "")).otherwise(s)


def reading_fields(c: Column | str) -> Column:
    """struct(name, age, house, sex) of a labelled answer, in HTML or with bars between its fields; what isn't there or
    isn't plausible is null. The first name label that no relation stands before counts."""
    s = F.regexp_replace(F.regexp_replace(_text(c), r"(?i)<br\s*/?>|</?(?:p|div|tr|li)>", "|"), r"<[^>]+>", "")
    s = F.concat(F.lit("|"), F.translate(s, " ", " "))
    part = lambda label: F.trim(F.regexp_extract(s, rf"\|\s*{label}\s*[:：]\s*([^|]*)", 1))
    age = normalize_digits(F.regexp_extract(s, r"বয়স\s*[:：]?\s*([0-9০-৯]{1,3})", 1)).try_cast("int")
    sex = F.upper(part("লিঙ্গ"))
    code = F.when(sex.contains("FEMALE") | sex.contains("মহিলা"), "F").when(sex.contains("MALE") | sex.contains("পুৰুষ"), "M").when(sex.contains("THIRD") | sex.contains("তৃতীয়"), "T")
    filled = lambda x: F.nullif(x, F.lit(""))
    return F.struct(filled(part("নাম")).alias("name"), F.when(age.between(18, 120), age).alias("age"), filled(normalize_digits(part("ঘৰ নং"))).alias("house"), code.alias("sex"))
