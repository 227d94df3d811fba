"""Serials, carried sections, islands, rates and pairings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import sequence as Q
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_KIND = "CASE event_type WHEN 'signup' THEN 'addition' WHEN 'error' THEN 'deletion' ELSE 'main' END"


def _kind():
    return F.when(F.col("event_type") == "signup", "addition").when(F.col("event_type") == "error", "deletion").otherwise("main")


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS serial FROM events")
def positional_serials(spark, d):
    return Q.positional_serial(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "serial")


@query("SELECT conv_id, turn, k AS expected FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations) WHERE turn <> k")
def serial_verify(spark, d):
    return Q.sequence_breaks(table(spark, d, "conversations"), ["conv_id"], ["turn", "role", "text"], "turn").select("conv_id", "turn", "expected")


@query("SELECT event_id FROM (SELECT event_id, user_id, value, lag(user_id) OVER w AS u, lag(value) OVER w AS v FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)) WHERE u > user_id OR (u = user_id AND v > value)")
def source_order(spark, d):
    return Q.order_breaks(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], ["user_id", "value"]).select("event_id")


@query(f"""WITH e AS (SELECT event_id, user_id, ts, {_KIND} AS found FROM events), l AS (SELECT *, last_value(CASE WHEN found <> 'main' THEN found END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last FROM e)
 SELECT event_id, found, CASE WHEN found = 'main' AND last = 'addition' THEN 'addition' ELSE found END AS section FROM l""")
def section_carry(spark, d):
    return Q.carry_section(table(spark, d, "events").withColumn("found", _kind()), ["user_id"], ["ts", "event_id"], "found").select("event_id", "found", "section")


@query("""WITH x AS (SELECT *, turn // 2 AS page FROM conversations) SELECT conv_id, turn, role, CASE WHEN page = min(page) OVER p THEN 'first' WHEN page = max(page) OVER p THEN 'last' ELSE 'middle' END AS page_position, turn = max(turn) OVER (PARTITION BY conv_id, page) AS in_last_row FROM x WINDOW p AS (PARTITION BY conv_id)""")
def page_position(spark, d):
    rows = table(spark, d, "conversations").withColumn("page", F.floor(F.col("turn") / 2))
    return Q.position_features(rows, ["conv_id"], "page", "turn").select("conv_id", "turn", "role", "page_position", "in_last_row")


@query("""WITH r AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events), a AS (SELECT user_id, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9 AS h FROM r WHERE k <= 5 GROUP BY 1)
 SELECT user_id, n, round(CASE WHEN n < 2 OR h <= 0 THEN 0 ELSE (n - 1) / h END, 9) AS per_hour FROM a""")
def last_k_rate(spark, d):
    return Q.last_k_rate(table(spark, d, "events"), ["user_id"], "ts", ["event_id"]).withColumn("per_hour", F.round("per_hour", 9))


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'stop' END AS k FROM events WHERE event_type IN ('signup', 'error')), n AS (SELECT *, lead(k) OVER w AS nk, lead(ts) OVER w AS nt FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), now AS (SELECT max(ts) AS t FROM events)
 SELECT user_id, count(*) AS intervals, round(sum((epoch_us(coalesce(nt, t)) - epoch_us(ts)) / 3.6e9), 6) AS hours FROM n, now WHERE k = 'start' AND (nk IS NULL OR nk = 'stop') GROUP BY 1""")
def uptime_pairing(spark, d):
    events = table(spark, d, "events")
    now = events.agg(F.max("ts").alias("now"))
    rows = events.crossJoin(F.broadcast(now))
    c = F.col
    return Q.paired_hours(rows, ["user_id"], "ts", ["event_id"], c("event_type") == "signup", c("event_type") == "error", c("now")).withColumn("hours", F.round("hours", 6))


@query("""WITH x AS (SELECT DISTINCT user_id, CAST(floor(epoch_us(ts) / 86400e6) AS BIGINT) AS day FROM events), n AS (SELECT *, CASE WHEN day - lag(day) OVER w <= 2 THEN 0 ELSE 1 END AS s FROM x WINDOW w AS (PARTITION BY user_id ORDER BY day)), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS island FROM n)
 SELECT user_id, island::BIGINT AS island, min(day) AS first, max(day) AS last, count(*) AS n, CAST(floor(sum(day) / count(*)) AS BIGINT) AS middle FROM i GROUP BY ALL""")
def islands(spark, d):
    days = table(spark, d, "events").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86400e6).cast("long").alias("day"))
    return Q.islands(days, ["user_id"], "day", 2).withColumn("island", F.col("island").cast("long"))


_BANDS = """x AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), u AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS g FROM x WHERE value > 30),
 b AS (SELECT user_id, min(i) AS first, max(i) + 1 AS last, count(*) AS length FROM u GROUP BY user_id, g)"""


def _indexed(spark, d):
    return Q.positional_serial(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "i")


@query(f"WITH {_BANDS} SELECT * FROM b WHERE length >= 2")
def runs_above(spark, d):
    return Q.runs_above(_indexed(spark, d), ["user_id"], "i", "value", 30, 2)


@query(f"""WITH {_BANDS}, m AS (SELECT user_id, count(*) AS n, list(last - first ORDER BY last - first)[count(*) // 2 + 1] AS m FROM b GROUP BY 1), w AS (SELECT b.*, n, m, coalesce(lag(last) OVER p, 0) AS p, lead(first) OVER p AS q FROM b JOIN m USING (user_id) WINDOW p AS (PARTITION BY user_id ORDER BY first))
 SELECT user_id, first, last, CASE WHEN n >= 3 AND last - first < 0.6 * m THEN greatest(p, first - (m - (last - first)) // 2) ELSE first END AS grown_first, CASE WHEN n >= 3 AND last - first < 0.6 * m THEN least(coalesce(q, first + m), last + (m - (last - first)) // 2) ELSE last END AS grown_last FROM w""")
def short_runs_restored(spark, d):
    return Q.restore_short(Q.runs_above(_indexed(spark, d), ["user_id"], "i", "value", 30, 1), ["user_id"])


@query("SELECT event_id, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 40 AS chunk FROM events")
def fixed_chunks(spark, d):
    return Q.fixed_chunks(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], 40).select("event_id", "chunk")


@query()
def bin_packing(spark, d):
    """Lines of an order into batches of at most 60 units, in order."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return Q.pack_in_order(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity", 60.0)


@query("SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM conversations")
def stack_offsets(spark, d):
    rows = table(spark, d, "conversations").withColumn("size", F.length("text"))
    return Q.running_offsets(rows, ["conv_id"], ["turn", "role", "text"], "size").select("conv_id", "turn", F.col("offset").cast("long").alias("offset"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k <= 2")
def first_per_customer(spark, d):
    return Q.first_per_group(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 2).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 >= 3 THEN round(o_totalprice / (o_orderkey % 10) * (10 - o_orderkey % 10), 6) END AS eta FROM orders")
def remaining_time(spark, d):
    done = F.col("o_orderkey") % 10
    return table(spark, d, "orders").select("o_orderkey", F.round(Q.eta_seconds(done, F.lit(10), F.col("o_totalprice"), 3), 6).alias("eta"))


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents), p AS (SELECT doc_id, x, coalesce(list_position(list_transform(x, lambda s: regexp_matches(s, '[^ -~]')), true), 0) AS k FROM l)
 SELECT doc_id, CASE WHEN k = 0 THEN len(x) ELSE k - 1 END::INTEGER AS header_lines, CASE WHEN k = 0 THEN 0 ELSE len(x) - k + 1 END::INTEGER AS body_lines FROM p""")
def header_and_body(spark, d):
    x = Q.header_and_body(F.split("text", "\n"), "[^ -~]")
    return table(spark, d, "documents").select("doc_id", F.size(x["header"]).alias("header_lines"), F.size(x["body"]).alias("body_lines"))
