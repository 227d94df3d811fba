"""Ordered datasets, files against manifests, evidence, replayed streams and timers, with the faults that each must find."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import evidence
from tallyspark.sources import releases
from tallyspark.streaming import leases, pulls, upserts

LINES = "shard long, k long, v string"


def shards(spark, n=400):
    return spark.createDataFrame([(i % 5, i, f"v{i % 7}") for i in range(n)], LINES).repartition(4)


def folder(tmp_path, name):
    return f"file://{tmp_path}/{name}"


def test_ordered_dataset_survives(spark, tmp_path):
    df, at = shards(spark), folder(tmp_path, "a")
    releases.write_ordered(df, ["shard", "k"], at, 30)
    foot = releases.footers(spark, at, ["shard", "k", "v"])
    assert foot.agg(F.sum("rows")).first()[0] == 400
    assert foot.count() > 10
    assert foot.agg(F.min("k_low"), F.max("k_high"), F.min("v_low"), F.max("v_high")).first() == (0, 399, "v0", "v6")
    assert dict(foot.dtypes)["k_low"] == "bigint"
    assert releases.groups_out_of_order(foot, "shard").count() == 0
    assert releases.groups_out_of_order(foot, "k").count() > 0
    assert releases.out_of_place(releases.placed(spark, at), ["shard", "k"], 7).count() == 0
    assert all(r.same for r in releases.survived(spark.read.parquet(at), df, ["shard"]).collect())
    other = df.withColumn("v", F.when(F.col("k") == 6, "else").otherwise(F.col("v"))).filter("k <> 12").unionByName(df.filter("k = 14")).unionByName(spark.createDataFrame([(9, 1, "x"), (None, 2, "y")], LINES))
    got = {r.shard: (r.rows, r.source_rows, r.same) for r in releases.survived(spark.read.parquet(at), other, ["shard"]).collect()}
    assert got == {0: (80, 80, True), 1: (80, 80, False), 2: (80, 79, False), 3: (80, 80, True), 4: (80, 81, False), 9: (0, 1, False), None: (0, 1, False)}
    assert releases.footers(spark, at, []).columns == ["file", "row_group", "rows", "bytes"]


def test_rows_swapped_in_a_file_are_found(spark, tmp_path):
    at = folder(tmp_path, "b")
    rows = [(0, k, "x") for k in range(50)]
    rows[20], rows[21] = rows[21], rows[20]
    spark.createDataFrame(rows, LINES).coalesce(1).write.option("maxRecordsPerFile", 10).parquet(at)
    for run in (1, 3, 1000):
        assert [(r.k, r._before.k) for r in releases.out_of_place(releases.placed(spark, at), ["k"], run).collect()] == [(20, 21)]
    other = folder(tmp_path, "c")  # the swap lies over the end of a file
    rows = [(0, k, "x") for k in range(50)]
    rows[9], rows[10] = rows[10], rows[9]
    spark.createDataFrame(rows, LINES).coalesce(1).write.option("maxRecordsPerFile", 10).parquet(other)
    assert [(r.k, r._before.k) for r in releases.out_of_place(releases.placed(spark, other), ["k"], 4).collect()] == [(9, 10)]
    serial = releases.serial_breaks(releases.placed(spark, other).withColumn("n", F.col("k") + 1), ["shard"], "n", 4)
    assert sorted((r.n, r.due) for r in serial.collect()) == [(10, 12), (11, 10), (12, 11)]


def test_files_against_their_entries(spark, tmp_path):
    at = folder(tmp_path, "d")
    shards(spark).write.partitionBy("shard").parquet(at)
    assert releases.publish(releases.entries_of(spark, at), f"{at}-m") == 1
    kept = releases.published(spark, f"{at}-m")
    assert kept.count() == kept.filter("sound AND rows > 0").count() >= 5
    assert releases.audit(releases.entries_of(spark, at), kept).count() == 0
    files = sorted((tmp_path / "d").rglob("*.parquet"))
    files[0].write_bytes(files[0].read_bytes()[:-40])
    (files[0].parent / f".{files[0].name}.crc").unlink()
    files[1].unlink()
    files[2].with_name("part-99999-more.parquet").write_bytes(files[2].read_bytes())
    found = sorted((r.invariant, r.key.split("/")[-1]) for r in releases.audit(releases.entries_of(spark, at), kept).collect())
    cut = files[0].name
    assert found == sorted([("half-written file", cut), ("bytes differ", cut), ("rows differ", cut), ("sha256 differ", cut), ("missing file", files[1].name), ("unexpected file", "part-99999-more.parquet")])


def test_versions_are_swapped_whole(spark, tmp_path):
    at = folder(tmp_path, "e")
    with pytest.raises(ValueError, match="no whole version"):
        releases.published(spark, at)
    for n in (1, 2, 3):
        assert releases.publish(spark.range(n), at) == n
    spark.range(9).write.parquet(f"{at}/v=4")
    (tmp_path / "e" / "v=4" / "_SUCCESS").unlink()  # stopped before its commit
    assert releases.published(spark, at).count() == 3
    assert releases.published(spark, at, 1).count() == 1
    assert releases.retire(spark, at, 1) == [1, 2]
    assert releases.publish(spark.range(5), at) == 4
    assert releases.published(spark, at).count() == 5
    with pytest.raises(ValueError, match="there already"):
        releases.publish(spark.range(1), at, 4)


def judged(spark, doc, entry=None, rows=None):
    """One shard with parts 1 and 2: three and two rows, one of them deleted, and one in the additions."""
    rows = rows or [(1, 1, "main", False), (1, 1, "main", False), (1, 1, "addition", False), (1, 2, "main", True), (1, 2, "main", False)]
    df = spark.createDataFrame(rows, "s long, p long, section string, deleted boolean")
    docs = spark.createDataFrame([(1, doc if isinstance(doc, str) else json.dumps(doc))] if doc is not None else [], "s long, doc string")
    entries = spark.createDataFrame([(1, *(entry or (2, 2, 0, 1, 1)))], "s long, " + ", ".join(f"{n} long" for n in evidence.RESIDUALS))
    authority = spark.createDataFrame([(1, 1, 3), (1, 2, 1)], "s long, p long, net long")
    got = evidence.judge(df, docs, entries, authority, "s", "p", F.col("section") == "main", F.col("section") == "addition", F.col("deleted"), "net")
    return sorted((r.invariant, r.key, r.detail) for r in got.collect())


SOUND = {"published_parts": 2, "rows": 5, "boxes_per_part": {"1": 3, "2": 2}, "printed_totals": {"1": 2, "2": 2}}


def test_evidence(spark):
    assert judged(spark, SOUND) == []
    assert judged(spark, None) == [("missing bundle", "1", "")]
    assert judged(spark, '{"rows": 5, "boxes') == [("unreadable bundle", "1", "")]
    assert judged(spark, SOUND | {"published_parts": 1, "rows": 6}) == [("published parts", "1", "1 for 2"), ("rows", "1", "6 for 5")]
    assert judged(spark, SOUND | {"boxes_per_part": {"1": 4, "3": 1}}) == [("boxes differ from rows", "1/1", "4 for 3"), ("boxes differ from rows", "1/3", "1 for 0"), ("boxes of an unknown part", "1/3", ""), ("part without boxes", "1/2", "")]
    assert judged(spark, SOUND | {"printed_totals": {"1": 2, "2": 2, "7": 0}}) == [("invalid printed total", "1/7", "0"), ("parts_measured", "1", "2 for 3"), ("parts_matching_roll", "1", "2 for 3"), ("printed total of an unknown part", "1/7", "")][:1] + [("parts_matching_roll", "1", "2 for 3"), ("parts_measured", "1", "2 for 3"), ("printed total of an unknown part", "1/7", "")]
    assert judged(spark, SOUND | {"printed_totals": {"1": 3, "2": 9}}) == [("parts_matching_roll", "1", "2 for 0"), ("parts_measured", "1", "2 for 1"), ("rows_short_of_printed", "1", "0 for 1")]
    assert judged(spark, SOUND, (2, 2, 0, 0, 5)) == [("struck_off_detected", "1", "0 for 1"), ("struck_off_implied", "1", "5 for 1")]
    moved = [(1, 1, "main", False), (1, 1, "main", False), (1, 1, "addition", False), (1, 4, "main", True), (1, 4, "main", False)]
    found = judged(spark, SOUND, rows=moved)
    assert {("part without rows", "1/2", ""), ("rows of an unknown part", "1/4", ""), ("boxes differ from rows", "1/2", "2 for 0")} <= set(found)


def test_a_stream_stopped_between_write_and_commit(spark, tmp_path):
    at, inbox = folder(tmp_path, "f"), str(tmp_path / "in")
    schema = "k long, v string, stamp long"
    for rows in ([(1, "a", 1), (2, "b", 1)], [(1, "a2", 2), (3, "c", 1)], [(2, "old", 0), (4, "d", 1), (4, "d", 1), (5, None, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
    write, stopped = upserts.write_batch(at, ["k"], "stamp"), []

    def stops_once(batch, number):
        write(batch, number)
        if number == 1 and not stopped:
            stopped.append(number)
            raise RuntimeError("power cut")

    def run(f):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        q = stream.writeStream.foreachBatch(f).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()

    with pytest.raises(Exception, match="power cut"):
        run(stops_once)
    assert upserts.current(spark, at, ["k"], "stamp").count() == 3
    run(stops_once)
    want = {(1, "a2", 2), (2, "b", 1), (3, "c", 1), (4, "d", 1), (5, None, None)}
    assert {tuple(r) for r in upserts.current(spark, at, ["k"], "stamp").collect()} == want
    assert upserts.compact(spark, at, ["k"], "stamp") == 2
    assert upserts.compact(spark, at, ["k"], "stamp") == 0
    upserts.sweep(spark, at)
    assert releases.committed(spark, f"{at}/batches") == [2]
    spark.createDataFrame([(5, "e", 1), (1, "late", 1)], schema).coalesce(1).write.mode("append").parquet(inbox)
    run(stops_once)
    assert {tuple(r) for r in upserts.current(spark, at, ["k"], "stamp").collect()} == want - {(5, None, None)} | {(5, "e", 1)}


def test_an_owner_is_dropped_by_a_timer(spark, tmp_path):
    for n, rows in enumerate([[("x", "h1", 0), ("y", "h1", 0)], [("y", "h1", 600), ("x", "h2", 900)], [("y", "h1", 2000), ("y", "h2", 3900)], [("y", "h2", 9000)]]):
        df = spark.createDataFrame(rows, "k string, host string, s long").withColumn("t", F.timestamp_seconds(F.col("s") + 1_000_000))
        df.coalesce(1).write.parquet(str(tmp_path / f"beats{n}" / "x"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stream = leases.with_timers(spark).readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "beats*" / "x"))
    got = pulls.landed(leases.lease_events(stream, "k", "host", "t", 1800, "0 seconds"), folder(tmp_path, "leases"))
    rows = {(r.k, r.owner, r.event, r.s - 1_000_000) for r in got.select("*", F.unix_timestamp("at").alias("s")).collect()}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    # x is dropped though nobody asks for it again; y's last claim is still held
    assert rows == {("x", "h1", "claimed", 0), ("x", "h1", "dropped", 1800), ("y", "h1", "claimed", 0), ("y", "h1", "dropped", 3800), ("y", "h2", "claimed", 3900), ("y", "h2", "dropped", 5700), ("y", "h2", "claimed", 9000)}


def test_sessions_close_behind_the_watermark(spark, tmp_path):
    rows = [("a", 0), ("a", 1000), ("a", 4000), ("b", 100), ("b", 500_000)]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("t", F.timestamp_seconds(F.col("s") + 1_000_000))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = pulls.sessions(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "t", "k")
    got = pulls.landed(out, folder(tmp_path, "sessions")).select("k", F.unix_timestamp("session_start") - 1_000_000, F.unix_timestamp("session_end") - 1_000_000, "n")
    assert {tuple(r) for r in got.collect()} == {("a", 0, 2800, 2), ("a", 4000, 5800, 1), ("b", 100, 1900, 1)}
