"""Scans and sinks with rules: each query writes what it derives from the tables and reads it back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from tallyspark.plans.registry import query
from tallyspark.sources import sinks as S
from tallyspark.sources import tables as T
from tallyspark.sources.tables import table


@query("""SELECT 'a' || (page_id % 7) AS archive, (CASE WHEN page_id % 5 = 0 THEN 'x' ELSE 'page-' END) || page_id || '.html' AS member, strlen(coalesce(html, ''))::BIGINT AS size, sha256(coalesce(html, '')) AS sha256, page_id % 5 <> 0 AS matched, left(coalesce(html, ''), 9) AS head FROM pages""")
def archive_members(spark, d):
    """Pages packed into archives by their number, and the members of those: names, sizes, hashes, bytes."""

    def pack(pdf):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, html in zip(pdf["name"], pdf["html"], strict=True):
                z.writestr(name, html or "")
        return pd.DataFrame({"path": [pdf["path"].iloc[0]], "content": [out.getvalue()]})

    name = F.concat(F.when(F.col("page_id") % 5 == 0, "x").otherwise("page-"), F.col("page_id").cast("string"), F.lit(".html"))
    pages = table(spark, d, "pages").select(F.concat(F.lit("a"), (F.col("page_id") % 7).cast("string")).alias("path"), name.alias("name"), F.coalesce("html", F.lit("")).alias("html"))
    archives = pages.groupBy("path").applyInPandas(pack, "path string, content binary")
    return T.members_of(archives, r"^page-[0-9]+\.html$", bodies=True).withColumn("head", F.decode(F.substring("body", 1, 9), "UTF-8")).drop("body")


@query("""SELECT event_id % 7 = 3 AS corrupt, count(*) AS n, sum(CASE WHEN event_id % 7 <> 3 THEN event_id END)::BIGINT AS ids FROM events GROUP BY 1""")
def json_lines(spark, d):
    """Events as JSON lines of which every seventh is cut off, and blank lines between."""
    at = S.scratch(spark, "lines")
    row = F.to_json(F.struct("event_id", "event_type", "value"))
    lines = table(spark, d, "events").select(F.when(F.col("event_id") % 7 == 3, F.substring(row, 1, 12)).otherwise(F.concat(row, F.lit("\n"))).alias("value"))
    lines.write.option("compression", "gzip").text(at)
    good, bad = T.jsonl(spark, at, "event_id long, event_type string, value double")
    rows = good.select(F.lit(False).alias("corrupt"), "event_id").unionByName(bad.select(F.lit(True).alias("corrupt"), F.lit(None).cast("long").alias("event_id")))
    return rows.groupBy("corrupt").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("""SELECT o_orderkey AS k, 'total' AS kind, o_totalprice AS price, NULL AS line, NULL AS quantity FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
 UNION ALL SELECT l_orderkey, 'row', NULL, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def entry_rows_and_totals(spark, d):
    """Cached entries of orders with their lines, written once, and both outputs from one scan of them."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"))).alias("rows"))
    at = S.scratch(spark, "entries")
    table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price")).join(lines, "k").write.parquet(at)
    return S.with_totals(spark.read.parquet(at), ["k"], ["price"], "rows")


@query("SELECT page_id, url FROM pages")
def manifest_keys(spark, d):
    """A manifest whose keys must be unique; a second row of a key would fail the query."""
    return S.keyed(table(spark, d, "pages").select("page_id", "url"), ["page_id"])


@query("SELECT n_regionkey AS entry, n_nationkey AS nation, n_name AS name FROM nation")
def entries_merged(spark, d):
    at = S.scratch(spark, "merge")
    S.write_entries(table(spark, d, "nation").select("n_regionkey", F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name")), "n_regionkey", at)
    return S.merged_entries(spark, at, "nation long, name string").select("entry", "nation", "name")


@query("""WITH n AS (SELECT r_name, count(n_nationkey) AS c FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1)
 SELECT 'nested' AS output, count(*) AS rows, sum(c)::BIGINT AS children FROM n UNION ALL SELECT 'parts', count(*), NULL FROM region UNION ALL SELECT 'sections', count(*), NULL FROM nation""")
def dataset_of_three(spark, d):
    """Regions with their nations nested, regions, and nations, written as one dataset."""
    parts = table(spark, d, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    sections = table(spark, d, "nation").select(F.col("n_regionkey").alias("k"), "n_nationkey", "n_name")
    at = S.scratch(spark, "dataset")
    S.write_dataset(parts, sections, ["k"], at)
    nested = spark.read.schema("k long, r_name string, sections array<struct<n_nationkey: long, n_name: string>>").json(f"{at}/output=nested")
    out = nested.agg(F.lit("nested").alias("output"), F.count("*").alias("rows"), F.sum(F.size("sections")).cast("long").alias("children"))
    for name in ("parts", "sections"):
        rows = T.read_csv(spark, f"{at}/output={name}", "k long, n_nationkey long" if name == "sections" else "k long, r_name string")
        out = out.unionByName(rows.filter("k IS NOT NULL").agg(F.lit(name).alias("output"), F.count("*").alias("rows"), F.lit(None).cast("long").alias("children")))
    return out


@query("SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS segment, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name, c_acctbal > 0 AS positive FROM customer")
def csv_round_trip(spark, d):
    """Null as NA, blank as blank, booleans as words, through CSV files."""
    rows = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("name"), (F.col("c_acctbal") > 0).alias("positive"))
    at = S.scratch(spark, "csv")
    T.write_csv(rows, at, ["c_custkey", "segment", "name", "positive"])
    return T.read_csv(spark, at, "c_custkey long, segment string, name string, positive boolean")


@query("SELECT s_suppkey::INTEGER AS s_suppkey, s_name, s_acctbal FROM supplier")
def shard_round_trip(spark, d):
    at = S.scratch(spark, "shard")
    schema = "s_suppkey int, s_name string, s_acctbal double"
    S.write_shard(table(spark, d, "supplier"), at, schema)
    return spark.read.schema(schema).parquet(at)


@query("SELECT page_id, sha256(coalesce(html, '')) || '  ' || 'page-' || page_id AS line FROM pages")
def checksum_lines(spark, d):
    body = F.coalesce("html", F.lit(""))
    return table(spark, d, "pages").select("page_id", S.checksum_line(body, F.concat(F.lit("page-"), F.col("page_id").cast("string"))).alias("line"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 200")
def capped_sample(spark, d):
    return S.capped(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("SELECT l_orderkey || ',' || l_linenumber || ',' || l_suppkey AS k, l_orderkey::BIGINT AS part, l_linenumber::BIGINT AS row, l_suppkey::BIGINT AS col FROM lineitem")
def tuple_keys(spark, d):
    rows = table(spark, d, "lineitem").select(S.tuple_key("l_orderkey", "l_linenumber", "l_suppkey").alias("k"))
    return rows.select("k", S.parse_tuple_key("k", ["part", "row", "col"]).alias("p")).select("k", "p.*")


@query("""SELECT event_id, CASE WHEN event_type <> 'error' THEN TRY_CAST(regexp_extract(props, '"k": ?([0-9]+)', 1) AS BIGINT) END AS k, NULL::VARCHAR AS note, CASE WHEN event_type = 'error' THEN 'api_error' ELSE '' END AS flags, event_type = 'error' AS needs_review FROM events""")
def responses_to_rows(spark, d):
    """JSON answers as rows with every column; a failed call keeps its row, flagged."""
    out = S.responses(table(spark, d, "events").select("event_id", "event_type", "props"), "props", "k long, note string", F.col("event_type") == "error")
    return out.select("event_id", "k", "note", "flags", "needs_review")
