"""Set-similarity join on word shingles with token-combination prefixes.

Documents with the same shingle set form a class; the join runs between classes.

Global token order: rare tokens first, then frequent ones, each by hash. A token is frequent if at least `frequent`
documents hold it (counted over all documents) or if it shares a slot of a fixed-size table with such a token; any
fixed order gives the same result, so the table's size is a matter of speed alone. Let n = |x|, m = |y|, s = |x&y|, and
let x have r rare tokens. Two sets with 100*|x&y| >= 80*|x|y| have s >= 4(n+m)/9 and share one of the first
n - ceil(0.8n) + 1 tokens of either.
  * The first shared token is rare: it is in both prefixes, and single tokens are indexed there.
  * Else no rare token is shared, so r <= n/5. Of the gaps between neighbouring shared tokens, the d <= n+m-2s-r
    frequent tokens that only one side holds split at most d. Among (k-1)(d+1) gaps there are then k-1 in a row that
    nothing splits: k frequent tokens that follow each other in both sets. They lie among the first
    (k-1)(d+1) + 1 + (n-s-r) frequent tokens of x, at most 0.2k*n + k - k*r (m = 0.8n is the worst case). Such
    combinations are indexed: k = 2 for all sets, where s tokens always leave enough gaps.
Buckets of few classes give all their pairs. Large ones give a star around their smallest class. Stars are verified,
and where a bucket's members then still lie in several components, longer combinations (k = 3, then 4, with their longer
prefixes) of these members alone make smaller buckets. There must be s > (k-1)(d+1) shared tokens for that, which holds
for all pairs with n+m >= 14 and 36; smaller sets keep their buckets. Of buckets that stay large, the pairs between
components are verified: pairs within a component can't change it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import IdFilter, components, cut, id_filter, lean_batches, packed, salted_join, take, unpacked
from tallyspark.llm.kernels import fields, joined, mix, pack, pack_sorted, release, shingle_sets, unpack, unpack_sorted

WIDTH = 5
COUNT_BITS = 40
SLOT_BITS = 25
KEY_BITS = 44
#: Index keys that a scan holds before it sends them on, tokens while it counts.
FLUSH = 1 << 20, 2 << 20
#: Classes in a bucket that give all pairs at once.
SMALL = 8
LEAST_FREQUENT = 8
#: Sets of fewer shingles link with equal sets only, which are their class: 3 of 4 is under 0.8, 4 of 5 is not.
LEAST_INDEXED = 4
#: Combinations after the first, and the most shingles of sets that may find no common one: the larger of n+m <= 13, 35.
LONGER = ((3, 7), (4, 19))
#: Counters of a range of tokens, as a power of two, and index keys in a range.
COUNTER_BITS, RANGE = 22, 1 << 19


def class_keys(s: np.ndarray, wide: int = 64) -> tuple[int, int]:
    """Two independent 64-bit sums over a set, as signed integers; the first is cut to `wide` bits."""
    a = int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    b = int(mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
    a &= (1 << wide) - 1
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


DESCRIBED = "doc_id long, n_shingles long, class long, class2 long"


def _describe(wide: int):
    def run(batches):
        for batch in batches:
            n, a, b = [], [], []
            for s in shingle_sets(batch.column(1), WIDTH):
                n.append(len(s))
                x = class_keys(s, wide)
                a.append(x[0]), b.append(x[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["doc_id", "n_shingles", "class", "class2"])

    return run


def _by_range(keys: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where each of `ranges` equal ranges begins among sorted keys of so many bits."""
    bounds = (np.arange(ranges, dtype=np.uint64) << np.uint64(bits)) // np.uint64(ranges)
    return np.append(np.searchsorted(keys, bounds), len(keys))


def _count_scan(ranges: int):
    shift = np.uint64(64 - COUNT_BITS)

    def flush(held):
        x = np.sort(np.concatenate(held) >> shift)
        cuts = _by_range(x, COUNT_BITS, ranges)
        full = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([pack_sorted(x[cuts[r] : cuts[r + 1]]) for r in full], pa.binary())], names=["part", "body"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0), WIDTH):
                held.append(s)
                n += len(s)
                if n >= FLUSH[1]:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)
        del held
        release()

    return run


def _levels(ranges: int, frequent: int):
    """For each range its slots' levels, from rows (part, body) that come range by range; one body is held at a time."""
    per = (1 << SLOT_BITS) // ranges
    down = np.uint64(COUNT_BITS - COUNTER_BITS - ranges.bit_length() + 1)

    def close(part: int, counters: np.ndarray) -> pa.RecordBatch:
        most = counters.reshape(per, -1).max(1)
        slots = np.where(most >= frequent, np.log2(np.maximum(most, 1)), 0).astype(np.uint8)
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "body": pa.array([zlib.compress(slots.tobytes(), 1)], pa.binary())})

    def run(batches):
        now, counters = None, np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if part != now:
                    if now is not None:
                        yield close(now, counters)
                    now = part
                    counters[:] = 0
                x = (unpack_sorted(body.as_py()) >> down).astype(np.int64) - (part << COUNTER_BITS)
                first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
                counters[x[first]] += np.diff(np.append(first, len(x))).astype(np.uint32)
        if now is not None:
            yield close(now, counters)
        release()

    return run


def frequent_slots(docs: DataFrame, tokens: int, frequent: int = LEAST_FREQUENT) -> bytes:
    """A bit for each of 2**SLOT_BITS hash slots: whether it holds a frequent token.

    Counts cover every shingle of every document (`tokens` in all); tokens share counters of a bounded number. The
    threshold doubles until an eighth of the slots or less is set. What reaches the driver is one byte for each slot.
    """
    ranges = min(4096, 1 << max(6, (tokens >> (COUNTER_BITS - 1)).bit_length()))
    counted = docs.select("text").mapInArrow(_count_scan(ranges), "part long, body binary").repartition("part").sortWithinPartitions("part").mapInArrow(_levels(ranges, frequent), "part long, body binary")
    slots = np.zeros(1 << SLOT_BITS, np.uint8)
    per = len(slots) // ranges
    for r in counted.toLocalIterator():
        slots[r["part"] * per : (r["part"] + 1) * per] = np.frombuffer(zlib.decompress(r["body"]), np.uint8)
    least = int(np.log2(frequent))
    while np.count_nonzero(slots >= least) > len(slots) // 8:
        least += 1
    return np.packbits(slots >= least).tobytes()


def index_keys(s: np.ndarray, bits: np.ndarray, k: int = 2) -> tuple[np.ndarray, np.ndarray, int]:
    """(single-token keys, keys of combinations of k, rare tokens) of one set."""
    n = len(s)
    slot = (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    often = ((bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).astype(bool)
    rare, freq = s[~often], s[often]
    r = len(rare)
    single = rare[: n - (4 * n + 4) // 5 + 1]
    keys = np.zeros(0, np.uint64)
    if 5 * r <= n:
        head = freq[: max(0, k * n // 5 + k + 2 - k * r)]
        if len(head) >= k:
            count = len(head) - k + 1
            keys = mix(head[:count] * np.uint64(0xA0761D6478BD642F))
            for j in range(1, k):
                keys = mix(keys + mix(head[j : j + count] ^ np.uint64(0xE7037ED1A0B428DB)))
    return single, keys, r


FOUND = "kind int, bucket long, a long, b long"


def _table(kind: int, bucket, a, b) -> pa.Table:
    n = len(a)
    return pa.table({"kind": pa.array(np.full(n, kind, np.int32)), "bucket": pa.array(np.broadcast_to(bucket, n).astype(np.int64)), "a": pa.array(a), "b": pa.array(b)})


def _sorted_entries(key, cls, n, r, large):
    """Distinct entries of an index by key; the first of a key is the one with the least share of rare tokens: an original
    before its edited copies. An entry is large if any of its equals is."""
    order = np.lexsort((~large, r, n, cls, key))
    key, cls, n, r, large = key[order], cls[order], n[order], r[order], large[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]) | (n[1:] != n[:-1]) | (r[1:] != r[:-1])
    key, cls, n, r, large = key[new], cls[new], n[new], r[new], large[new]
    order = np.lexsort((cls, r / n, key))
    return key[order], cls[order], n[order], r[order], large[order]


def _stars(key, cls, n, r, large, small: int):
    """(whether each sorted entry is in a large bucket, its bucket's first entry, pairs and members of the large buckets)."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    head = np.repeat(first, size)
    crowded = np.repeat((size > small) | (np.add.reduceat(large, first) > 0), size)
    i = np.flatnonzero(crowded & (np.arange(len(key)) > head))
    i = i[_can_link(n[head[i]], r[head[i]], n[i], r[i])]
    big = np.flatnonzero(crowded)
    return crowded, head, (cls[head[i]], cls[i]), (key[big].astype(np.int64), cls[big], n[big], r[big])


def _distinct(*cols: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of equally long columns, sorted."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols], 0)
    return [c[new] for c in cols]


def _pairs_once(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    return _distinct(np.minimum(a, b), np.maximum(a, b))


def _dealt(to: np.ndarray, ranges: int, *cols: np.ndarray) -> list[list[np.ndarray]]:
    """For each range the rows that go to it, in the order in which they come."""
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(ranges + 1))
    return [[c[order[x:y]] for c in cols] for x, y in zip(cuts, cuts[1:], strict=False)]


@dataclass(frozen=True)
class Plan:
    """How an index is cut: key ranges, classes in a small bucket, keys in a flush, bits of a class sum, and the rows of
    open buckets that tiles settle at once, without longer combinations. No result depends on these."""

    ranges: int
    small: int = SMALL
    flush: int = FLUSH[0]
    wide: int = 64
    tiled: int = 1 << 13


def _index_scan(plan: Plan, sent, k: int = 2, near: IdFilter | None = None):
    """Packed index entries by key range, one row for each range and flush. A key that is crowded in a flush leaves its star
    and members at once, each pair once, spread over all ranges in their rows, and sends on its first entry alone, marked
    as large: no hot key reaches one task with all its rows, and a crowd makes no more rows than other texts."""
    shift = np.uint64(64 - KEY_BITS)

    def flush(held):
        key, cls, n, r = (np.concatenate(x) for x in zip(*held, strict=True))
        key, cls, n, r, large = _sorted_entries(key, cls, n, r, np.zeros(len(key), bool))
        crowded, head, pairs, members = _stars(key, cls, n, r, large, plan.small)
        on = ~crowded | (head == np.arange(len(key)))
        key, cls, n, r, large = key[on], cls[on], n[on], r[on], crowded[on]
        cuts = _by_range(key, KEY_BITS, plan.ranges)
        a, b = _pairs_once(*pairs)
        pairs = _dealt((a ^ b) % plan.ranges, plan.ranges, a, b)
        bucket, c, m, q = members
        at = np.lexsort((bucket, c))
        members = _dealt(c[at] % plan.ranges, plan.ranges, c[at], bucket[at], m[at], q[at])
        part, body = [], []
        for p in range(plan.ranges):
            x, y = cuts[p], cuts[p + 1]
            (a, b), (c, *rest) = pairs[p], members[p]
            if x < y or len(a) or len(c):
                part.append(p)
                entries = [pack_sorted(key[x:y]), *(pack(z.astype(np.uint64)) for z in (cls[x:y], n[x:y] * 2 + large[x:y], r[x:y]))]
                body.append(joined([*entries, *(f(z.astype(np.uint64)) for f, z in ((pack_sorted, a), (pack, b), (pack_sorted, c), *((pack, z) for z in rest)))]))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(body, pa.binary())], names=["part", "body"])

    def run(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        held, size = [], 0
        for batch in batches:
            if near is not None:
                batch = batch.filter(pa.array(near.holds(batch.column(0).to_numpy())))
            for s in shingle_sets(batch.column(1), WIDTH):
                if len(s) < LEAST_INDEXED:
                    continue
                single, combined, r = index_keys(s, bits, k)
                if k > 2:
                    single = single[:0]
                m = len(single) + len(combined)
                # the lowest bit of a key tells combinations from single tokens
                # prefixes are the small ones of a set's tokens; hashed once more, they fill all ranges alike
                keys = np.concatenate((mix(single) >> shift & ~np.uint64(1), combined >> shift | np.uint64(1)))
                held.append((keys, np.full(m, class_keys(s, plan.wide)[0]), np.full(m, len(s)), np.concatenate((np.zeros(len(single), np.int64), np.full(len(combined), r)))))
                size += m
                if size >= plan.flush:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)
        del held
        release()

    return run


def _can_link(n1, r1, n2, r2) -> np.ndarray:
    """Whether sizes allow 100 * shared >= 80 * union; r: rare tokens that are known not to be shared (0 if unknown)."""
    shared = np.minimum(n1 - r1, n2 - r2)
    return 5 * shared >= 4 * (n1 + n2 - shared)


def _buckets(small: int):
    """Pairs of classes and members of large buckets, from the packed entries of a range and what was found before."""

    def run(t):
        entries, pairs, members = [], [], []
        for body in t.column("body"):
            k, c, n, r, a, b, m, *rest = fields(body.as_py())
            n = unpack(n).astype(np.int64)
            entries.append((unpack_sorted(k), unpack(c).view(np.int64), n >> 1, unpack(r).astype(np.int64), (n & 1).astype(bool)))
            pairs.append((unpack_sorted(a).view(np.int64), unpack(b).view(np.int64)))
            members.append([x.view(np.int64) for x in (unpack_sorted(m), *map(unpack, rest))])
        key, cls, n, r, large = _sorted_entries(*(np.concatenate(x) for x in zip(*entries, strict=True)))
        del entries
        crowded = np.zeros(0, bool)
        if len(key):
            crowded, head, star, (bucket, *rest) = _stars(key, cls, n, r, large, small)
            pairs.append(star)
            members.append((rest[0], bucket, *rest[1:]))
        for step in range(1, min(small, len(key))):
            i = np.flatnonzero(~crowded[:-step] & (head[step:] == head[:-step]))
            i = i[_can_link(n[i], r[i], n[i + step], r[i + step])]
            pairs.append((cls[i], cls[i + step]))
        a, b = _pairs_once(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
        c, bucket, n, r = _distinct(*(np.concatenate(x) for x in zip(*members, strict=True)))
        release()
        # a member: its class in a, its size and unshared rare tokens in b
        return pa.concat_tables([_table(0, 0, a, b), _table(1, bucket, c, n * (1 << 31) + r)])

    return run


def _sets(near: IdFilter):
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(near.holds(batch.column(0).to_numpy())))
            sets = [s.tobytes() for s in shingle_sets(batch.column(1), WIDTH)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "tokens"])
        release()

    return run


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    z = np.sort(np.concatenate((x, y)))
    shared = int(np.count_nonzero(z[1:] == z[:-1]))
    return shared > 0 and 100 * shared >= 80 * (len(x) + len(y) - shared)


def _verify(batches):
    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        ok = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            ok.append(_linked(x, y))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])
    release()


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids whose whole shingle sets link."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    near = id_filter(wanted, "id")
    sets = docs.select("doc_id", "text").mapInArrow(_sets(near), "id long, tokens binary")
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long")


def _tile(t):
    """Links of one tile: members of part i against part k, of different components, that share a bucket."""
    ids, label, n, r, part = (t.column(c).to_numpy() for c in ("class_id", "label", "n", "r", "part"))
    where, lists = np.arange(len(ids)), t.column("buckets").combine_chunks()
    owner = np.repeat(where, np.diff(lists.offsets.to_numpy()))
    bucket = lists.flatten().to_numpy()
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    edge = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
    single, combined = np.zeros((len(ids), len(ids)), bool), np.zeros((len(ids), len(ids)), bool)
    for x, y in zip(edge, edge[1:], strict=False):
        if y - x > 1:
            at = owner[x:y]
            (combined if bucket[x] & 1 else single)[np.ix_(at, at)] = True
    sizes, zero = (n[:, None], n[None, :]), np.zeros_like(n)
    fit = single & _can_link(sizes[0], zero[:, None], sizes[1], zero[None, :]) | combined & _can_link(sizes[0], r[:, None], sizes[1], r[None, :])
    fit &= (label[:, None] != label[None, :]) & (ids[:, None] < ids[None, :])
    if len(np.unique(part)) > 1:
        fit &= part[:, None] != part[None, :]
    tokens, out = t.column("tokens").combine_chunks(), []
    tokens = [np.frombuffer(x.as_buffer(), np.uint64) for x in tokens]
    for x, y in np.argwhere(fit):
        if _linked(tokens[x], tokens[y]):
            out.append((ids[x], ids[y]))
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members(bucket, class_id, n, r) with their component's label, of buckets that span several components.

    Left out are members that no other of their bucket can link with by size and unshared rare tokens r: a link takes
    9 (n - r) >= 4 (n + m) of either side.
    """
    rows = members.join(labels.select(F.col("node").alias("class_id"), "label"), "class_id", "left")
    rows = cut(rows.select("bucket", "class_id", "n", "r", F.coalesce("label", "class_id").alias("label"), (9 * (F.col("n") - F.col("r")) - 4 * F.col("n")).alias("reach")), "members")
    low = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("reach").alias("far"), F.min("n").alias("least"), F.count("*").alias("rows")).filter("lo <> hi")
    near = salted_join(rows, low, "bucket", "rows", rows.count(), "class_id")
    return cut(near.filter("lo IS NOT NULL AND 4 * n <= far AND 4 * least <= reach").select("bucket", "class_id", "n", "r", "label", "lo"), "open")


def between_components(docs: DataFrame, members: DataFrame, tile_tokens: int = 1 << 18, tile_members: int = 1 << 10) -> DataFrame:
    """Links (a, b) between members(bucket, class_id, n, r, label, lo) of a bucket that lie in different components.

    lo: the least label of the bucket. Components that share buckets form a region. A region's members are dealt into
    parts of about tile_tokens tokens or tile_members members, and each pair of parts is one task, so that no task
    grows with a region, nor its arrays of members by members; pairs never leave a task, only links do.
    """
    regions = components(members.filter("label <> lo").select(F.col("label").alias("a"), F.col("lo").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("region"))
    rows = members.groupBy("class_id", "label", "n").agg(F.max("r").alias("r"), F.collect_set("bucket").alias("buckets"))
    rows = cut(rows.join(regions, "label", "left").withColumn("region", F.coalesce("region", "label")), "regions")
    parts = rows.groupBy("region").agg(F.ceil(F.greatest(F.sum("n") / tile_tokens, F.count("*") / tile_members)).alias("parts"), F.count("*").alias("rows"))
    near = id_filter(rows, "class_id")
    sets = docs.select("doc_id", "text").mapInArrow(_sets(near), "id long, tokens binary")
    rows = salted_join(rows, parts, "region", "rows", rows.count(), "class_id").join(sets.withColumnRenamed("id", "class_id"), "class_id")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("class_id"), "parts")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    tile = [F.least("part", "other").alias("i"), F.greatest("part", "other").alias("k")]
    return rows.select("region", *tile, "class_id", "label", "n", "r", "part", "buckets", "tokens").groupBy("region", "i", "k").applyInArrow(_tile, "a long, b long")


def _stars_of(labels: DataFrame) -> DataFrame:
    """What is known of the components, as edges; new links are added to these instead of to all links before."""
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b"))


def _indexed(docs: DataFrame, ids: DataFrame, sent, plan: Plan, k: int, near: IdFilter | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, members of large buckets) of the index with combinations of k, over the documents that `near` lets through."""
    scan = docs.select("doc_id", "text").mapInArrow(_index_scan(plan, sent, k, near), "part long, body binary")
    found = cut(scan.groupBy("part").applyInArrow(_buckets(plan.small), FOUND), "buckets")
    named = found.filter("kind = 0").select("a", "b").distinct()
    side = lambda c: ids.select(F.col("class").alias(c), F.col("class_id").alias(f"i{c}"))
    named = named.join(side("a"), "a").join(side("b"), "b")
    pairs = cut(named.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b")).filter("a <> b").distinct(), "pairs")
    links = cut(verified(docs, pairs), "links")
    members = found.filter("kind = 1").select("bucket", F.col("a").alias("class"), F.shiftright("b", 31).alias("n"), F.col("b").bitwiseAND((1 << 31) - 1).alias("r"))
    return links, members.join(ids, ["class", "n"]).select("bucket", "class_id", "n", "r")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = LEAST_FREQUENT, **cuts) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id): documents linked by five-word shingles at Jaccard 0.8 or more.

    class_id is the smallest id with the same shingle set, component_id the smallest id reachable by links. Null and
    wordless texts have an empty set, link with nothing and are their own component. Rows that repeat an id are one
    document, which links by any of its texts. Rows with a null id link with nothing and keep null ids. Extra columns
    are not read. An empty table gives an empty result. Texts of any length are read whole.
    cuts are fields of Plan.
    """
    spark = docs.sparkSession
    lean_batches(spark)
    docs = take(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    nameless, docs = docs.filter("doc_id IS NULL"), docs.filter("doc_id IS NOT NULL")
    plan = Plan(0, **cuts)
    described = cut(docs.mapInArrow(_describe(plan.wide), DESCRIBED), "sets")
    total, tokens = described.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    same = ["class", "class2", "n_shingles"]
    classes = cut(described.filter("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("members")), "classes")
    ids = classes.select("class", "class_id", F.col("n_shingles").alias("n"))

    sent = spark.sparkContext.broadcast(frequent_slots(docs, tokens, frequent))
    plan = replace(plan, ranges=max(64, tokens // (5 * RANGE)))
    links, members = _indexed(docs, ids, sent, plan, 2)
    # the index knows classes by one 64-bit sum; sets that share it meet here
    alike = classes.groupBy("class").agg(F.array_sort(F.collect_list("class_id")).alias("c")).filter("size(c) > 1")
    alike = alike.select(F.col("c")[0].alias("a"), F.explode(F.slice("c", 2, 1 << 30)).alias("b"))
    if not alike.isEmpty():
        links = links.unionByName(verified(docs, cut(alike, "alike")))
    labels = components(links)
    crowd, kept = open_members(members, labels), None
    for k, most in LONGER:
        if crowd.count() <= plan.tiled:
            break
        stays = crowd.filter(f"n <= {most} OR bucket % 2 = 0").select("bucket", "class_id", "n", "r")
        kept = stays if kept is None else kept.unionByName(stays)
        more, members = _indexed(docs, ids, sent, plan, k, id_filter(crowd, "class_id"))
        labels = components(_stars_of(labels).unionByName(more))
        crowd = open_members(members, labels)
    if kept is not None:
        crowd = crowd.unionByName(open_members(kept, labels))
    if not crowd.isEmpty():
        labels = components(_stars_of(labels).unionByName(cut(between_components(docs, crowd), "links")))

    keyed = classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select(F.struct(*same).alias("k"), "class_id", "members", F.coalesce("label", "class_id").alias("component_id"))
    out = salted_join(described.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.struct(*same)).alias("k")), keyed, "k", "members", total, "doc_id")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"))
    none = F.lit(None).cast("long")
    return out.unionByName(nameless.mapInArrow(_describe(plan.wide), DESCRIBED).select("doc_id", "n_shingles", none.alias("component_id"), none.alias("class_id")))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """docs with only the smallest id of each component; all columns stay, and so do rows with a null id.

    Where rows with differing texts share an id, they go only if none of them stands for a component, so that no text
    is lost that has no copy.
    """
    rows = jaccard_components(docs, id_col, **kw).filter("doc_id IS NOT NULL")
    lost = rows.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("all")).filter("all").select("doc_id")
    return unpacked(packed(docs, doc_id=id_col).withColumn("doc_id", F.col("doc_id").cast("long")).join(lost, "doc_id", "left_anti"), docs.columns)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def jaccard_sql(width: int, more: str = "") -> str:
    """Documents, the sizes of their shingle sets and their components as SQL: pairs by shared shingles, links by counts, and
    the ids that links reach. `more` adds columns."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS g FROM w),
s AS (SELECT doc_id, unnest(g) AS g FROM g),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN g a ON a.doc_id = x JOIN g b ON b.doc_id = y WHERE 100 * c >= 80 * (len(a.g) + len(b.g) - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM g UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, len(g.g)::BIGINT AS n_shingles, component_id{more} FROM g JOIN m USING (doc_id)
"""


OP3_SQL = jaccard_sql(WIDTH, ", CASE WHEN len(g.g) > 0 THEN min(doc_id) OVER (PARTITION BY list_sort(g.g)) ELSE doc_id END AS class_id")
