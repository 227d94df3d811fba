"""Evidence that travels with a shard: documents of maps by part, held against the shard's rows without taking them apart.

A bundle is one JSON document of a shard: how many parts have a published total, its rows, the boxes found in each part and
the total that each part prints. Rows are counted by shard and part first; what then meets is one row a shard with maps of
its parts, compared key by key by map functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUNDLE = "published_parts long, rows long, boxes_per_part map<string,long>, printed_totals map<string,long>, _corrupt string"
#: Figures of a shard that its entry keeps and that rows and bundle give anew.
RESIDUALS = ("parts_measured", "parts_matching_roll", "rows_short_of_printed", "struck_off_detected", "struck_off_implied")


def maps_by_part(rows: DataFrame, shard: str, part: str, counts: Mapping[str, Column]) -> DataFrame:
    """shard, and for each name a map from part to the rows for which its condition holds."""
    each = rows.groupBy(shard, part).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))
    return each.groupBy(shard).agg(*(F.map_from_entries(F.collect_list(F.struct(F.col(part).cast("long"), F.col(n)))).alias(n) for n in counts))


def bundles(parts: DataFrame, shard: str, part: str, boxes: str, printed: str, published: str, rows: str) -> DataFrame:
    """shard, doc: a JSON document for each shard of parts(shard, part, boxes, printed, published, rows), null boxes or printed
    totals left out."""
    as_map = lambda v: F.map_from_entries(F.collect_list(F.when(F.col(v).isNotNull(), F.struct(F.col(part).cast("string"), F.col(v).cast("long")))))
    doc = F.to_json(F.struct(F.count(published).alias("published_parts"), F.sum(rows).alias("rows"), as_map(boxes).alias("boxes_per_part"), as_map(printed).alias("printed_totals")))
    return parts.groupBy(shard).agg(doc.alias("doc"))


def _by_number(m: str) -> Column:
    return F.transform_keys(m, lambda k, _: k.try_cast("long"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _at(m: str | Column, k: Column) -> Column:
    return F.coalesce(F.try_element_at(F.col(m) if isinstance(m, str) else m, k), F.lit(0).cast("long"))


def recomputed(tolerance: int = 2) -> dict[str, Column]:
    """RESIDUALS from the maps of judge(): a printed total is usable if the main rows are within tolerance of it."""
    usable = F.map_filter("printed", lambda p, t: F.abs(_at("main", p) - t) <= tolerance)
    off = F.transform(F.map_entries(usable), lambda e: F.abs(_at("main", e["key"]) - e["value"]))
    net = F.transform(F.map_entries("net"), lambda e: _at("main", e["key"]) + _at("addition", e["key"]) - e["value"])
    return {"parts_measured": F.size(usable).cast("long"), "parts_matching_roll": F.size(F.filter(off, lambda x: x == 0)).cast("long"), "rows_short_of_printed": _sum(off), "struck_off_detected": _sum(F.map_values("deleted")), "struck_off_implied": _sum(net)}


def judge(rows: DataFrame, documents: DataFrame, entries: DataFrame, authority: DataFrame, shard: str, part: str, main: Column, addition: Column, deleted: Column, net: str, tolerance: int = 2) -> DataFrame:
    """(invariant, key, detail) for whatever of shards doesn't hold; no rows is a pass. A key is a shard, or shard/part.

    rows: the shards' rows. documents(shard, doc): their bundles. entries(shard, RESIDUALS...): the figures kept.
    authority(shard, part, net): the parts that there must be, with the published total of those that have one.
    A shard without a bundle, or with one that can't be read, has that finding alone.
    """
    have = maps_by_part(rows, shard, part, {"n": F.lit(True), "main": main, "addition": addition, "deleted": deleted})
    told = authority.groupBy(shard).agg(F.array_distinct(F.collect_list(F.col(part).cast("long"))).alias("expected"), F.map_from_entries(F.collect_list(F.when(F.col(net).isNotNull(), F.struct(F.col(part).cast("long"), F.col(net).cast("long"))))).alias("net"))
    docs = documents.select(shard, F.from_json("doc", BUNDLE, {"columnNameOfCorruptRecord": "_corrupt"}).alias("b"))
    kept = entries.select(shard, F.struct(*RESIDUALS).alias("kept"))
    all_of = have.join(told, shard, "full").join(docs, shard, "full").join(kept, shard, "full")
    none = F.create_map().cast("map<bigint,bigint>")
    all_of = all_of.select(F.col(shard).cast("string").alias("_key"), "b", "kept", *(F.coalesce(m, none).alias(m) for m in ("n", "main", "addition", "deleted", "net")), F.coalesce("expected", F.array().cast("array<bigint>")).alias("expected"), F.coalesce(_by_number("b.boxes_per_part"), none).alias("boxes"), F.coalesce(_by_number("b.printed_totals"), none).alias("printed"))

    finding = lambda name, key, detail: F.struct(F.lit(name).alias("invariant"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))
    key = F.col("_key")
    of = lambda p: F.concat_ws("/", key, p.cast("string"))
    blank = F.lit("")

    def differ(name: str, stored: Column, due: Column) -> Column:
        text = F.concat_ws(" for ", F.coalesce(stored.cast("string"), F.lit("none")), F.coalesce(due.cast("string"), F.lit("none")))
        return F.when(~stored.eqNullSafe(due), F.array(finding(name, key, text)))

    def parts(name: str, which: Column, detail=lambda p: blank) -> Column:
        return F.transform(which, lambda p: finding(name, of(p), detail(p)))

    lost = F.map_filter(F.map_zip_with("boxes", "n", lambda p, b, n: F.struct(b.alias("boxes"), n.alias("rows"))), lambda p, v: v["boxes"].isNotNull() & ~F.coalesce(v["boxes"], F.lit(0)).eqNullSafe(F.coalesce(v["rows"], F.lit(0))))
    checks = [
        differ("published parts", F.col("b.published_parts"), F.size("net").cast("long")),
        differ("rows", F.col("b.rows"), _sum(F.map_values("n"))),
        parts("part without rows", F.array_except("expected", F.map_keys("n"))),
        parts("rows of an unknown part", F.array_except(F.map_keys("n"), "expected")),
        parts("part without boxes", F.array_except("expected", F.map_keys("boxes"))),
        parts("boxes of an unknown part", F.array_except(F.map_keys("boxes"), "expected")),
        F.transform(F.map_entries(lost), lambda e: finding("boxes differ from rows", of(e["key"]), F.concat_ws(" for ", e["value"]["boxes"].cast("string"), F.coalesce(e["value"]["rows"], F.lit(0)).cast("string")))),
        parts("printed total of an unknown part", F.array_except(F.map_keys("printed"), "expected")),
        F.transform(F.map_entries(F.map_filter("printed", lambda _, t: ~F.coalesce(t > 0, F.lit(False)))), lambda e: finding("invalid printed total", of(e["key"]), F.coalesce(e["value"].cast("string"), F.lit("none")))),
        F.when(F.col("kept").isNull(), F.array(finding("missing entry", key, blank))),
        *(F.when(F.col("kept").isNotNull(), differ(name, F.col(f"kept.{name}"), due)) for name, due in recomputed(tolerance).items()),
    ]
    empty = F.array().cast("array<struct<invariant:string,key:string,detail:string>>")
    every = F.flatten(F.array(*(F.coalesce(c, empty) for c in checks)))
    found = F.when(F.col("b").isNull(), F.array(finding("missing bundle", key, blank))).when(F.col("b._corrupt").isNotNull(), F.array(finding("unreadable bundle", key, blank))).otherwise(every)
    return all_of.select(F.inline(found))


def residuals_of(parts: DataFrame, shard: str, main: str, addition: str, deleted: str, printed: str, net: str, tolerance: int = 2, columns: Sequence[str] = RESIDUALS) -> DataFrame:
    """shard, RESIDUALS... from parts(shard, main, addition, deleted, printed, net): what a writer puts in its entry."""
    m, t = F.col(main), F.col(printed)
    usable = F.abs(m - t) <= tolerance
    zero = F.lit(0).cast("long")
    made = [F.count_if(usable), F.count_if(usable & (m == t)), F.coalesce(F.sum(F.when(usable, F.abs(m - t))), zero), F.coalesce(F.sum(deleted), zero), F.coalesce(F.sum(m + F.col(addition) - F.col(net)), zero)]
    return parts.groupBy(shard).agg(*(x.alias(n) for x, n in zip(made, columns, strict=True)))
