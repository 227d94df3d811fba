"""MinHash near-dedup with min-max hashing.

Documents with the same shingle set form a class. Of every permutation of the shingles both the minimum and the maximum
are kept: each is an unbiased test of the Jaccard similarity, so that a signature of given length takes half the hash
evaluations, and as one shingle is seldom both, its variance is below that of as many minima. Bands are made of minima
alone or of maxima alone, so that no band holds both ends of one permutation. With B bands of R values, a pair of
similarity s shares no band with probability (1 - s**R)**B: at 0.8, with 40 bands of 5, about 1 in 8 million.

Classes that share a band make a bucket. Small buckets give all their pairs, large ones a star. What then still lies in
several components of a large bucket gives a second star, around a centre in another order, where that is much, and is
compared in tiles of bounded size. Every link is confirmed on the full shingle sets, which are written once for the classes that share a band.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import components, cut, id_filter, lean_batches, salted_join, take
from tallyspark.llm.kernels import mix, release, shingle_sets
from tallyspark.llm.ngram_join import class_keys, jaccard_sql

WIDTH = 2
BANDS, ROWS = 40, 5
#: Classes in a bucket that give all pairs at once.
SMALL = 8
#: Sets of fewer shingles link with equal sets only, which are their class: 3 of 4 is under 0.8.
LEAST_INDEXED = 4
#: Members of open buckets that tiles settle without a second star.
FEW = 1 << 16
#: Shingles that are hashed at a time.
RUN = 1 << 17
#: Shingles and members of a part of a region; a tile is a pair of parts.
TILE = 1 << 17, 1 << 10


def permutations(count: int) -> list[tuple[np.uint64, np.uint64]]:
    """Fixed keys of `count` permutations of 64-bit hashes: xor, then an odd multiplier."""
    x = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return [(a, b | np.uint64(1)) for a, b in zip(x[:count], x[count:], strict=True)]


def band_keys(values: np.ndarray, starts: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Keys (sets by bands) of sets that lie one behind the other, each beginning at one of starts; none is empty."""
    half = bands // 2
    low, high = (np.zeros((half, len(starts)), np.uint64) for _ in range(2))
    for k, (a, b) in enumerate(permutations(half * rows)):
        h = (values ^ a) * b
        band = k // rows
        low[band] = mix(low[band] * np.uint64(0xD6E8FEB86659FD93) + np.minimum.reduceat(h, starts))
        high[band] = mix(high[band] * np.uint64(0xD6E8FEB86659FD93) + np.maximum.reduceat(h, starts))
    salt = mix(np.arange(2 * half, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    return mix(np.concatenate((low, high)) + salt[:, None]).T


SIGNED = "doc_id long, n_shingles long, class long, class2 long, bands array<long>"


def _sign(bands: int, rows: int):
    def flush(sets):
        n = np.array([len(s) for s in sets])
        indexed = np.flatnonzero(n >= LEAST_INDEXED)
        out: list[np.ndarray | None] = [None] * len(sets)
        if len(indexed):
            ends = np.cumsum(n[indexed])
            keys = band_keys(np.concatenate([sets[i] for i in indexed]), ends - n[indexed], bands, rows).view(np.int64)
            for i, k in zip(indexed, keys, strict=True):
                out[i] = k
        return [(len(s), *class_keys(s), k) for s, k in zip(sets, out, strict=True)]

    def run(batches):
        for batch in batches:
            done, held, size = [], [], 0
            for s in shingle_sets(batch.column(1), WIDTH):
                held.append(s)
                size += len(s)
                if size >= RUN:
                    done += flush(held)
                    held, size = [], 0
            n, a, b, k = zip(*done, *flush(held), strict=True) if done or held else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "class", "class2", "bands"])
        release()

    return run


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, class, class2, bands) of docs(doc_id, text): size and two sums of the shingle set, band keys."""
    return docs.select("doc_id", "text").mapInArrow(_sign(bands, rows), SIGNED)


def fits(n, m):
    """Whether sizes allow 100 * shared >= 80 * union."""
    return (F.greatest(n, m) * 4) <= (F.least(n, m) * 5)


def bucket_pairs(members: DataFrame, total: int, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs a < b, members(bucket, class_id, n) of large buckets) of members(bucket, class_id, n).

    A bucket of up to `small` classes gives its pairs, a large one those with its smallest class. No pair is given whose
    sizes can't link. Large buckets keep all their members; hot ones are dealt over salted copies of their first.
    """
    heads = members.groupBy("bucket").agg(F.min(F.struct("class_id", "n")).alias("head"), F.count("*").alias("size")).filter("size > 1")
    shared = cut(salted_join(members, heads, "bucket", "size", total, "class_id").filter("size > 1"), "shared")
    few = shared.filter(F.col("size") <= small).groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("class_id", "n"))).alias("c"))
    few = few.select(F.explode("c").alias("x"), "c").select("x", F.explode(F.filter("c", lambda y: y["class_id"] > F.col("x.class_id"))).alias("y"))
    many = shared.filter(F.col("size") > small)
    stars = many.select(F.col("head").alias("x"), F.struct("class_id", "n").alias("y")).filter("x.class_id <> y.class_id")
    pairs = few.unionByName(stars).filter(fits(F.col("x.n"), F.col("y.n"))).select(F.col("x.class_id").alias("a"), F.col("y.class_id").alias("b"))
    return cut(pairs.distinct(), "pairs"), many.select("bucket", "class_id", "n")


def _sets(near):
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(near.holds(batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), WIDTH)], pa.binary())], names=["class_id", "tokens"])
        release()

    return run


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class_id, tokens): the sorted shingle hashes of the documents wanted(class_id), written once. A repeated id has a
    row for each of its texts."""
    return cut(docs.select("doc_id", "text").mapInArrow(_sets(id_filter(wanted, "class_id")), "class_id long, tokens binary"), "sets")


def _verify(batches):
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            z = np.sort(np.concatenate((x, y)))
            shared = int(np.count_nonzero(z[1:] == z[:-1]))
            ok.append(shared > 0 and 100 * shared >= 80 * (len(x) + len(y) - shared))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    release()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets link."""
    with_b = pairs.join(sets.select(F.col("class_id").alias("b"), F.col("tokens").alias("y")), "b")
    both = with_b.join(sets.select(F.col("class_id").alias("a"), F.col("tokens").alias("x")), "a")
    return cut(both.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long"), "links")


def open_members(members: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """members(bucket, class_id, n) with their component's label and the bucket's least label, of buckets that span several
    components."""
    rows = members.select("bucket", "class_id", "n").join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    rows = cut(rows, "members")
    low = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).filter("lo <> hi")
    return cut(salted_join(rows, low, "bucket", "size", total, "class_id").filter("lo IS NOT NULL").select("bucket", "class_id", "n", "label", "lo"), "open")


def second_stars(members: DataFrame, total: int) -> DataFrame:
    """Pairs of each member of open buckets with its bucket's first one in an order drawn by hash, of another component."""
    order = F.xxhash64("class_id", "bucket")
    heads = members.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "class_id", "n", "label")).alias("h"), F.count("*").alias("size"))
    rows = salted_join(members, heads, "bucket", "size", total, "class_id").filter(F.col("h.label") != F.col("label"))
    return cut(rows.filter(fits(F.col("h.n"), F.col("n"))).select(F.least("h.class_id", "class_id").alias("a"), F.greatest("h.class_id", "class_id").alias("b")).distinct(), "pairs")


def _bits(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bit rows over the shingles that several sets hold, sizes of the sets)."""
    size = np.array([len(x) for x in tokens])
    owner = np.repeat(np.arange(len(tokens)), size)
    _, at, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    place = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[at]
    rows = np.zeros((len(tokens), max(1, -(-int(place.max() + 1) // 64))), np.uint64)
    held = place >= 0
    np.bitwise_or.at(rows, (owner[held], place[held] >> 6), np.uint64(1) << (place[held] & 63).astype(np.uint64))
    return rows, size


def _tile(t: pa.Table) -> pa.Table:
    """Links between members of a tile that share a bucket and lie in different components, until they lie in one."""
    ids, label, part = (t.column(c).to_numpy() for c in ("class_id", "label", "part"))
    label, lists = label.copy(), t.column("buckets").combine_chunks()
    owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
    order = np.argsort(bucket := lists.flatten().to_numpy(), kind="stable")
    bucket, owner = bucket[order], owner[order]
    edge = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
    meet = np.zeros((len(ids), len(ids)), bool)
    for x, y in zip(edge, edge[1:], strict=False):
        if y - x > 1:
            meet[np.ix_(owner[x:y], owner[x:y])] = True
    if part.min() != part.max():
        meet &= part[:, None] != part[None, :]
    bits, size = _bits([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("tokens").combine_chunks()])
    out = []
    for i in range(len(ids)):
        j = np.flatnonzero(meet[i, :i] & (label[:i] != label[i]) & (4 * np.maximum(size[:i], size[i]) <= 5 * np.minimum(size[:i], size[i])))
        shared = np.bitwise_count(bits[j] & bits[i]).sum(1, dtype=np.int64)
        for k in j[(100 * shared >= 80 * (size[j] + size[i] - shared)) & (shared > 0)]:
            if label[k] != label[i]:
                out.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
                label[label == label[k]] = label[i]
    release()
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def between_components(members: DataFrame, sets: DataFrame, tile: tuple[int, int] = TILE) -> DataFrame:
    """Enough links (a, b) between members(bucket, class_id, n, label, lo) of open buckets to join whatever links.

    Components that share buckets form a region. A region's members are dealt into parts of about tile[0] shingles or
    tile[1] members, and each pair of parts is one task: no task grows with a region, and pairs never leave a task.
    """
    regions = components(members.filter("label <> lo").select(F.col("label").alias("a"), F.col("lo").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("region"))
    rows = members.groupBy("class_id", "label", "n").agg(F.collect_set("bucket").alias("buckets"))
    rows = cut(rows.join(regions, "label", "left").withColumn("region", F.coalesce("region", "label")), "regions")
    parts = rows.groupBy("region").agg(F.ceil(F.greatest(F.sum("n") / tile[0], F.count("*") / tile[1])).alias("parts"), F.count("*").alias("rows"))
    rows = salted_join(rows, parts, "region", "rows", rows.count(), "class_id").join(sets, "class_id")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("class_id"), "parts")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.select("region", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("k"), "class_id", "label", "part", "buckets", "tokens")
    return cut(rows.groupBy("region", "i", "k").applyInArrow(_tile, "a long, b long"), "links")


def _and(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links; what is known goes along as stars."""
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, small: int = SMALL, few: int = FEW, tile: tuple[int, int] = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked at Jaccard 0.8 or more of their two-word shingles.

    component_id is the smallest id reachable by links, kept whether it is the row's own. Null and wordless texts have an
    empty set, link with nothing and are kept. Rows that repeat an id are one document, which links by any of its texts.
    Rows with a null id link with nothing, have a null component_id and are kept. Texts of any length are read whole, an
    empty table gives an empty result, and columns other than the two named are not read. `bands` is even; small, few and
    tile change no result.
    """
    spark = docs.sparkSession
    lean_batches(spark)
    docs = take(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = cut(signatures(docs, bands, rows), "signed")
    named = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["class", "class2", "n_shingles"]
    classes = cut(named.groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("members"), F.first("bands").alias("bands")), "classes")
    members = classes.filter("bands IS NOT NULL").select(F.explode("bands").alias("bucket"), "class_id", F.col("n_shingles").alias("n"))
    total = bands * max(1, classes.count())
    pairs, large = bucket_pairs(members, total, small)
    wanted = pairs.select(F.col("a").alias("class_id")).unionByName(pairs.select(F.col("b").alias("class_id"))).unionByName(large.select("class_id")).distinct()
    sets = class_sets(docs.filter("doc_id IS NOT NULL"), wanted)
    labels = components(confirmed(pairs, sets))
    crowd = open_members(large, labels, total)
    if crowd.count() > few:
        labels = _and(labels, confirmed(second_stars(crowd, total), sets))
        crowd = open_members(crowd, labels, total)
    if not crowd.isEmpty():
        labels = _and(labels, between_components(crowd, sets, tile))
    keyed = classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select(F.struct(*same).alias("k"), "members", F.coalesce("label", "class_id").alias("component_id"))
    described = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.struct(*same)).alias("k"))
    out = salted_join(described, keyed, "k", "members", described.count(), "doc_id")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def op13_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = jaccard_sql(WIDTH, ", doc_id = component_id AS kept")
