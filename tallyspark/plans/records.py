"""Records read from printed lines, which are spelt out of the customers' keys, with and without damage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import fuzzy
from tallyspark.functions import text as T
from tallyspark.operators import records as R
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_ENDS, _MARKS, _FURNITURE = T.ENDS, T.MARKS, T.FURNITURE
_Q = lambda x: x.replace("'", "''")


def _clean_sql(x: str) -> str:
    s = f"trim(regexp_replace(regexp_replace({x}, '{_FURNITURE}', ' ', 'g'), '\\s+', ' ', 'g'))"
    return f"regexp_replace(regexp_replace({s}, '(?:[{_Q(_ENDS)}][{_MARKS}]*)+$', ''), '^[{_Q(_ENDS)}{_MARKS}]+', '')"


_RAW = "'| ' || CASE c_custkey % 4 WHEN 0 THEN 'নেম2্ৰা' WHEN 1 THEN 'ৰাভা .ে' WHEN 2 THEN 'ু '' বাসন্তা ' || c_custkey ELSE c_name END || ' :'''"


@query(f"""WITH r AS (SELECT c_custkey, {_RAW} AS raw FROM customer), f AS (SELECT *, regexp_matches(raw, '{T.FOREIGN}') AS f, regexp_matches(raw, '{T.NATIVE}') AS n FROM r)
 SELECT c_custkey, {_clean_sql('raw')} AS clean, CASE WHEN f AND n THEN {_clean_sql(f"regexp_replace(raw, '{T.FOREIGN}', '', 'g')")} WHEN f THEN {_clean_sql('raw')} ELSE raw END AS value,
 f AND n AND regexp_matches(raw, '{T.NATIVE_LETTER}{T.FOREIGN}{T.NATIVE_LETTER}') AS uncertain FROM f""")
def cleaned_values(spark, d):
    """Names without furniture, and without Latin debris where native letters are."""
    k = F.col("c_custkey")
    middle = F.when(k % 4 == 0, "নেম2্ৰা").when(k % 4 == 1, "ৰাভা .ে").when(k % 4 == 2, F.concat(F.lit("ু ' বাসন্তা "), k.cast("string"))).otherwise(F.col("c_name"))
    raw = F.concat(F.lit("| "), middle, F.lit(" :'"))
    return table(spark, d, "customer").select("c_custkey", T.clean_value(raw).alias("clean"), T.without_foreign(raw).alias("s")).select("c_custkey", "clean", "s.value", "s.uncertain")


def _spelt(number):
    return F.translate(F.lpad(number.cast("string"), 6, "0"), "0123456789", "কখগচজটডতদপ")


def _lines(spark, d, reading: int):
    """box, k, line of one reading: name, relation, house and age bands, of which some are lost or damaged; dealt out by box."""
    c = F.col("c_custkey")
    label = F.when(c % 4 == 0, "পিতাৰ").when(c % 4 == 1, "স্বামীৰ").when(c % 4 == 2, "স্সামাৰ").otherwise("মাতাৰ")
    sex = F.when(c % 3 == 0, "পুৰুষ").when(c % 3 == 1, "মহিল").otherwise("পৰম")
    age = F.when(c % 10 == 7, "3/").when(c % 10 == 8, F.concat(F.lit("5"), (c % 90 + 10).cast("string"))).otherwise((c % 70 + 15).cast("string"))
    name = _spelt(c if reading == 1 else F.when(c % 5 == 0, c + 123).otherwise(c))
    lines = [
        F.when(c % 8 != 6, F.concat(F.lit("নাম : "), name)),
        F.when(c % 9 != 5, F.concat(label, F.when(c % 2 == 0, " ").otherwise(""), F.lit("নাম ' "), _spelt(c * 7 % 1000), F.when(c % 6 == 1, "1").otherwise(""))),
        F.when(c % 7 != 3, F.concat(F.when(c % 2 == 0, "ঘৰ নং : ").otherwise("ছাৰ ন "), (c % 300).cast("string"), F.lit("-2"))),
        F.when(c % 11 != 4, F.concat(F.lit("বয়স : "), age, F.lit(" লিঙ্গ : "), sex)),
    ]
    kept = F.array(*(lines if reading == 1 else lines[:2]))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("box"), F.posexplode(kept).alias("k", "line")).filter("line IS NOT NULL").repartition("box")


def _bands(spark, d, reading: int):
    return R.bands(R.described_lines(_lines(spark, d, reading)), ["box"])


@query()
def relations_and_sexes(spark, d):
    """Relation, its kind and sex of every line, also where labels lost a letter."""
    rows = R.described_lines(_lines(spark, d, 1))
    return rows.select("box", "k", R.relation_value("line").alias("name"), F.coalesce("kind", F.lit("")).alias("kind"), "sex")


@query()
def bottom_up_bands(spark, d):
    """Which line of a box is the name, the relation, the house and the age."""
    return _bands(spark, d, 1).select("box", *(F.col(f"{c}.line").alias(c) for c in ("name", "relation", "house", "age")))


@query()
def second_reading_gate(spark, d):
    """The second reading's name where it read the same band, and whether it differs from the first's by more than noise."""
    first, second = _bands(spark, d, 1), _bands(spark, d, 2)
    rows = R.second_name(first, second, ["box"], keep=[T.rest_after("name.line", R.NAME_LABEL).alias("first_name")])
    return R.differs(rows, "first_name", "second_name").select("box", "first_name", "second_name", "differs")


@query()
def record_assembly(spark, d):
    """One record for each box, with its flags in their fixed order."""
    c = F.col("c_custkey")
    boxes = table(spark, d, "customer").select(c.alias("box"), F.concat(F.lit("hhk "), F.lpad(c.cast("string"), 7, "0"), F.when(c % 6 == 2, ".")).alias("id_strip"), F.when(c % 5 != 1, F.concat(F.lit("# "), c.cast("string"))).alias("serial_strip"))
    out = R.assemble(boxes, _bands(spark, d, 1), _bands(spark, d, 2), ["box"], "id_strip", "serial_strip")
    return out.withColumn("flags", F.array_join("flags", ","))


@query()
def row_labels(spark, d):
    """Rows of a form by the label that they carry, damaged or not; the first row to claim a field keeps it."""
    labels = [("Price of the order", "price"), ("Date of the order", "date"), ("Customer of the order", "customer")]
    o = F.col("o_orderkey")
    words = [F.when(o % 3 == 0, a).when(o % 3 == 1, b).otherwise(c) for a, b, c in (("Price of the order", "Pr1ce of teh order", "Prize order"), ("Date of the order", "zzz", "Dote of the"), ("Customer of the order", "Custmer of order", "Price of the ordre"))]
    rows = table(spark, d, "orders").select("o_orderkey", F.posexplode(F.array(*words)).alias("k", "label"))
    return R.rows_by_label(rows, ["o_orderkey"], "k", "label", labels)


@query()
def struck_off_stamps(spark, d):
    """Whether a part's words hold a damaged stamp; its id doesn't count."""
    p = F.col("p_partkey")
    stamp = F.when(p % 5 == 0, "DELETED").when(p % 5 == 1, "OELETFD").when(p % 5 == 2, "DEL").when(p % 5 == 3, "DELT1234567")
    words = table(spark, d, "part").select("p_partkey", F.explode(F.concat(F.split("p_name", " "), F.array(F.coalesce(stamp, F.lit("")), "p_type"))).alias("word"))
    return R.struck_off(words, ["p_partkey"], "word")


@query("""WITH l AS (SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id)) SELECT coalesce(source, '') AS source, count(*) FILTER (coalesce(quality::VARCHAR, '') = '' AND coalesce(toxic::VARCHAR, '') = '') AS empty, count(*) AS n FROM l GROUP BY 1""")
def empty_records(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count_if(R.is_empty(["quality", "toxic"])).alias("empty"), F.count("*").alias("n"))


@query(f"""WITH t AS (SELECT c_custkey, 'বাড়ি নং : ' || (c_custkey % 50) || '/2 ' AS a, 'x ' || (c_custkey % 50) || '-' || (c_custkey % 7) || ' 9' AS b FROM customer)
 SELECT c_custkey, {_clean_sql("(c_custkey % 50) || '/2 '")} AS labelled, regexp_extract(b, '[0-9]+(?:[-/][0-9]+)*', 0) AS bare FROM t""")
def house_numbers(spark, d):
    k = F.col("c_custkey")
    a, b = F.concat(F.lit("বাড়ি নং : "), k % 50, F.lit("/2 ")), F.concat(F.lit("x "), k % 50, F.lit("-"), k % 7, F.lit(" 9"))
    return table(spark, d, "customer").select("c_custkey", T.house_number(a, R.HOUSE_LABELS).alias("labelled"), T.house_number(b, R.HOUSE_LABELS).alias("bare"))


@query("SELECT doc_id, trim(regexp_replace(strip_accents(text), '\\s+', ' ', 'g')) AS skeleton FROM documents WHERE text IS NOT NULL")
def skeletons(spark, d):
    """Texts without their accents; each distinct text is taken apart once."""
    rows = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.col("text").alias("t"))
    return fuzzy.on_distinct(rows, ["t"], "skeleton", fuzzy.skeleton).select("doc_id", "skeleton")
