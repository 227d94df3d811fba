"""Text functions over names, urls, prices and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import fuzzy
from tallyspark.functions import text as T
from tallyspark.plans.registry import query
from tallyspark.sources.tables import csv_text, table

_URL = r"'^(https?)://([^/]+)/([a-z]{2})/([0-9]+)'"


@query(f"""SELECT page_id, CASE WHEN regexp_matches(url, {_URL}) THEN regexp_extract(url, {_URL}, 1) END AS scheme, CASE WHEN regexp_matches(url, {_URL}) THEN regexp_extract(url, {_URL}, 2) END AS host,
 CASE WHEN regexp_matches(url, {_URL}) THEN regexp_extract(url, {_URL}, 3) END AS lang, CASE WHEN regexp_matches(url, {_URL}) THEN regexp_extract(url, {_URL}, 4)::BIGINT END AS number FROM pages""")
def filename_parse(spark, d):
    return table(spark, d, "pages").select("page_id", T.url_fields("url").alias("u")).select("page_id", "u.*")


@query(f"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, {_URL})")
def unrecognised_names(spark, d):
    return table(spark, d, "pages").filter(F.col("url").isNull() | T.url_fields("url")["number"].isNull()).select("page_id", "url")


@query("SELECT c_custkey, translate(translate(c_custkey::VARCHAR, '0123456789', '০১২৩৪৫৬৭৮৯') || '-' || c_nationkey, '০১২৩৪৫৬৭৮৯', '0123456789') AS digits FROM customer")
def digit_normalise(spark, d):
    native = F.translate(F.col("c_custkey").cast("string"), "0123456789", T.NATIVE_DIGITS[:10])
    return table(spark, d, "customer").select("c_custkey", T.normalize_digits(F.concat_ws("-", native, "c_nationkey")).alias("digits"))


@query("SELECT doc_id, TRY_CAST(regexp_extract(text, '([0-9]+)', 1) AS BIGINT) AS first_int FROM documents")
def first_ints(spark, d):
    return table(spark, d, "documents").select("doc_id", T.first_int("text").alias("first_int"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def iso_dates(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.iso_date(F.concat(F.lit("Dated : "), F.date_format("o_orderdate", "dd-MM-yyyy"))).alias("iso"))


@query("SELECT n_nationkey, n_nationkey::BIGINT AS number, n_name AS name FROM nation")
def split_numbered_names(spark, d):
    return table(spark, d, "nation").select("n_nationkey", T.numbered_name(F.concat_ws(" - ", "n_nationkey", "n_name")).alias("x")).select("n_nationkey", "x.*")


@query("SELECT n_nationkey, n_name AS name, CASE n_regionkey % 3 WHEN 0 THEN 'SC' WHEN 1 THEN 'ST' ELSE '' END AS code FROM nation")
def split_reservations(spark, d):
    shown = F.when(F.col("n_regionkey") % 3 == 0, F.concat("n_name", F.lit(" (sc)"))).when(F.col("n_regionkey") % 3 == 1, F.concat("n_name", F.lit(" ( ST )"))).otherwise(F.col("n_name"))
    return table(spark, d, "nation").select("n_nationkey", T.reservation(shown, {"SC": "SC", "ST": "ST"}).alias("x")).select("n_nationkey", "x.*")


_ID = "regexp_replace(upper(substr(c_mktsegment, 1, 3)) || ' ' || lpad((c_custkey * 7919 % 10000000)::VARCHAR, 6, 'O'), '[^A-Za-z0-9]', '', 'g')"


@query(f"""WITH r AS (SELECT c_custkey, {_ID} AS s FROM customer), e AS (SELECT *, regexp_extract(s, '([A-Z]{{3}})([A-Z0-9]{{7}})', 0) AS strict FROM r)
 SELECT c_custkey, CASE WHEN strict <> '' THEN substr(strict, 1, 3) || translate(substr(strict, 4, 7), 'OQDILSBZG', '000115826') ELSE regexp_extract(s, '[A-Z]{{2,4}}[0-9]{{6,9}}', 0) END AS id, strict <> '' AND substr(strict, 4, 7) <> translate(substr(strict, 4, 7), 'OQDILSBZG', '000115826') AS repaired FROM e""")
def id_repair(spark, d):
    raw = F.concat_ws(" ", F.upper(F.substring("c_mktsegment", 1, 3)), F.lpad((F.col("c_custkey") * 7919 % 10000000).cast("string"), 6, "O"))
    return table(spark, d, "customer").select("c_custkey", T.repair_id(raw).alias("id"), T.id_was_repaired(raw).alias("repaired"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, regexp_extract_all(printf('age %d / %d', (l_partkey % 1000)::BIGINT, (l_suppkey % 97)::BIGINT), '([0-9]+)') AS runs FROM lineitem),
 t AS (SELECT *, list_concat(flatten(list_transform(runs, lambda r: CASE WHEN length(r) = 3 THEN [r, substr(r, 1, 2), substr(r, 2, 2)] ELSE [r] END)), CASE WHEN length(array_to_string(runs, '')) >= 2 THEN [substr(array_to_string(runs, ''), 1, 2)] ELSE [] END) AS c FROM r)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_filter(list_transform(c, lambda x: x::INTEGER), lambda a: a BETWEEN 18 AND 120)[1] AS age, length(runs[1]) > 2 AS ambiguous, len(list_filter(list_transform(c, lambda x: x::INTEGER), lambda a: a BETWEEN 18 AND 120)) = 0 AS unreadable FROM t""")
def ages_from_text(spark, d):
    line = F.format_string("age %d / %d", F.col("l_partkey") % 1000, F.col("l_suppkey") % 97)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.age_from(line).alias("age"), T.age_is_ambiguous(line).alias("ambiguous"), T.age_is_unreadable(line).alias("unreadable"))


@query("SELECT p_partkey, regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]', '', 'g') AS key, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits FROM part")
def fold_keys(spark, d):
    return table(spark, d, "part").select("p_partkey", T.fold_key(F.concat_ws(" ", "p_name", "p_brand")).alias("key"), T.digit_signature("p_brand").alias("digits"))


@query("""SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(translate(lower(c_mktsegment) || 'aax ' || c_name || ' ;', 'xX', 'sS'), 'aa', 'a'), 'Aa|AA', 'A', 'g'), '\\s+', ' ', 'g'), '^[|,;:_\\s-]+', ''), '[|,;:_\\s-]+$', '') AS roman FROM customer""")
def roman_repairs(spark, d):
    return table(spark, d, "customer").select("c_custkey", T.roman_repair(F.concat(F.lower("c_mktsegment"), F.lit("aax "), "c_name", F.lit(" ;"))).alias("roman"))


@query("""SELECT event_id, CASE WHEN regexp_matches(k, '^[0-9]+$') AND TRY_CAST(k AS INTEGER) BETWEEN 1 AND 50 THEN TRY_CAST(k AS INTEGER) END AS serial FROM (SELECT event_id, regexp_extract(props, '"k": *([0-9]+)', 1) AS k FROM events)""")
def plausible_serials(spark, d):
    return table(spark, d, "events").select("event_id", T.plausible_serial(F.regexp_extract("props", '"k": *([0-9]+)', 1), 50).alias("serial"))


@query("""WITH r AS (SELECT conv_id, turn, role, list_filter([text, CASE WHEN turn % 2 = 0 THEN text ELSE replace(text, 'e', '') END, ''], lambda x: x <> '') AS f FROM conversations)
 SELECT conv_id, turn, role, list_reduce(list_concat([''], f), lambda a, x: CASE WHEN length(x) > length(a) THEN x ELSE a END) AS value, len(list_distinct(f)) <= 1 AS agreed FROM r""")
def reading_consensus(spark, d):
    a, b = F.col("text"), F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(F.replace("text", F.lit("e"), F.lit("")))
    return table(spark, d, "conversations").select("conv_id", "turn", "role", T.longest_reading(a, b, F.lit("")).alias("x")).select("conv_id", "turn", "role", "x.*")


@query("""SELECT conv_id, turn, CASE WHEN regexp_matches(t, '(^|[^A-Za-z])addition([^A-Za-z]|$)') THEN 'addition' WHEN regexp_matches(t, '(^|[^A-Za-z])the([^A-Za-z]|$)') THEN 'main_list' WHEN regexp_matches(t, '(^|[^A-Za-z])und([^A-Za-z]|$)') THEN 'deletion' ELSE 'main' END AS section
 FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations)""")
def section_markers(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.section_of("text", [("addition", "addition"), ("the", "main_list"), ("und", "deletion")]).alias("section"))


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages")
def html_stripped(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_html("html").alias("text"))


@query("""SELECT doc_id, CASE WHEN contains(text, ':') THEN trim(regexp_extract(text, '^[^:]*:((?s).*)$', 1)) ELSE '' END AS after FROM documents""")
def values_after_label(spark, d):
    return table(spark, d, "documents").select("doc_id", T.value_after_label("text").alias("after"))


@query("""SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%dh %dm', s // 3600, s % 3600 // 60) WHEN s >= 60 THEN printf('%dm %ds', s // 60, s % 60) ELSE printf('%ds', s) END AS took FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS INTEGER) AS s FROM orders)""")
def durations(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.human_duration(F.col("o_totalprice")).alias("took"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('p%d_pg%d_r%dc%d', l_orderkey, l_linenumber::BIGINT, l_partkey, l_suppkey) AS crop, l_orderkey::INTEGER AS part, l_suppkey::INTEGER AS col, CAST(NULL AS INTEGER) AS band FROM lineitem")
def crop_keys(spark, d):
    c = F.col
    keyed = table(spark, d, "lineitem").withColumn("crop", T.crop_key(c("l_orderkey"), c("l_linenumber"), c("l_partkey"), c("l_suppkey")))
    p = T.parse_crop_key("crop")
    return keyed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "crop", p["part"].alias("part"), p["col"].alias("col"), p["band"].alias("band"))


@query("""WITH q AS (SELECT l_orderkey, list(CAST(l_quantity AS BIGINT) ORDER BY l_quantity, l_partkey, l_suppkey) AS q FROM lineitem GROUP BY 1),
 r AS (SELECT l_orderkey, list_filter(list_transform(range(1, greatest(len(q) - 1, 1)), lambda i: q[i:i + 2]), lambda x: len(x) = 3 AND x[1] + x[2] = x[3] AND x[3] >= 20) AS g FROM q)
 SELECT l_orderkey, array_to_string(g[len(g)], ',') AS triple FROM r""")
def balancing_triples(spark, d):
    q = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_quantity", "l_partkey", "l_suppkey"))), lambda x: x["l_quantity"].cast("long")).alias("q"))
    return q.select("l_orderkey", F.array_join(T.balancing(F.col("q")), ",").alias("triple"))


@query("SELECT vec_id, CASE WHEN label IS NULL THEN 'NA' ELSE label::VARCHAR END AS label, CASE WHEN label IS NULL THEN 'NA' WHEN label > 3 THEN 'true' ELSE 'false' END AS big FROM embeddings")
def csv_convention(spark, d):
    return csv_text(table(spark, d, "embeddings").select("vec_id", "label", (F.col("label") > 3).alias("big")), ["vec_id", "label", "big"]).withColumn("vec_id", F.col("vec_id").cast("long"))


@query("SELECT doc_id, nfc_normalize(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text FROM documents")
def nfc_texts(spark, d):
    return fuzzy.on_distinct(table(spark, d, "documents").select("doc_id", F.col("text").alias("t")), ["t"], "text", fuzzy.nfc).select("doc_id", "text")


@query()
def name_similarity(spark, d):
    """Similarity of each part's name to the first name of its brand, each distinct pair scored once."""
    part = table(spark, d, "part")
    first = part.groupBy("p_brand").agg(F.min("p_name").alias("head"))
    return fuzzy.on_distinct(part.join(first, "p_brand").select("p_partkey", "p_name", "head"), ["p_name", "head"], "score", fuzzy.seq_ratio).select("p_partkey", F.round("score", 9).alias("score"))


@query("""WITH q AS (SELECT l_orderkey, list(CAST(l_quantity AS BIGINT) ORDER BY l_quantity, l_partkey, l_suppkey) AS q FROM lineitem GROUP BY 1),
 r AS (SELECT l_orderkey, list_filter(list_transform(range(1, greatest(len(q) - 2, 1)), lambda i: q[i:i + 3]), lambda x: len(x) = 4 AND x[1] + x[2] + x[3] = x[4] AND x[4] >= 20) AS g FROM q)
 SELECT l_orderkey, array_to_string(g[len(g)], ',') AS run FROM r""")
def balancing_fours(spark, d):
    q = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_quantity", "l_partkey", "l_suppkey"))), lambda x: x["l_quantity"].cast("long")).alias("q"))
    return q.select("l_orderkey", F.array_join(T.balancing(F.col("q"), 4), ",").alias("run"))
