"""Substring dedup with longest-previous-factor arrays.

A byte goes if some string of `width` bytes that covers it also starts earlier (smaller doc_id, or the same document
and an earlier start). Texts are whole and in UTF-8; matches never cross documents.

Any two equal strings of `width` bytes hold the same minimal `gram`-byte hash at the same place (winnowing), so every
match lies around a shared anchor. An anchor's window is all bytes that such a string around it can reach.
  1. A scan emits each anchor with a hash of its window. Within a partition only the first of equal windows is sent;
     the later ones are settled there, so that a hot passage sends one row for each flush of a partition.
  2. Of equal windows under an anchor the first one stays, the others go whole. Windows count as equal by 104 bits of
     two hashes (40 of the anchor, 64 of the window).
  3. What is left are anchors with several different windows (the borders of a repeat). Their bytes are read, and a
     suffix array with its LPF array over them tells which strings have an earlier match. An anchor with more windows
     than CROWD is dealt over lots of about that many. What is first in its lot then meets its equals from other lots
     in blocks of strings, which go through suffix arrays again.

Each task holds a range of (hashed) anchors, a lot of windows or a block of strings; their numbers follow the input's bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, lean_batches, take
from tallyspark.llm.kernels import fields, joined, mix, pack, pack_sorted, powers, prefix_hash, range_hash, release, spans, unpack, unpack_sorted

WIDTH = 100
GRAM = 32
ANCHOR_BITS = 40
#: Anchors that a scan holds before it sends them on.
FLUSH = 1 << 19
#: Anchors in a range, windows in a group of suffix arrays, and strings in a block: what a task should hold at a time.
RANGE, GROUP, BLOCK = 1 << 18, 1 << 15, 1 << 13
#: Different windows of one anchor that a single suffix array takes: 1.4 MB of text.
CROWD = 8192


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over each run of `width` neighbours."""
    have, out = 1, x
    while have * 2 <= width:
        out = op(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, off: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, anchor hash, window hash) of the anchors of texts laid end to end."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(data) < width:
        return none
    s = prefix_hash(data)
    _, inv = powers(len(s))
    n = len(data) - gram + 1
    h = mix((s[gram:] - s[:n]) * inv[:n])
    ends = np.repeat(off[1:], np.diff(off)).astype(np.int64)
    at = np.arange(len(data), dtype=np.int64)
    h[ends[:n] < at[:n] + gram] = np.uint64(0xFFFFFFFFFFFFFFFF)
    reach = width - gram + 1
    least = _slide(h, reach, np.minimum)
    starts = at[: len(least)]
    least[ends[: len(least)] < starts + width] = 0
    lead = np.zeros(reach - 1, np.uint64)
    most = _slide(np.concatenate((lead, least, lead)), reach, np.maximum)
    hit = np.flatnonzero((most[:n] == h) & (most[:n] > 0))
    if not len(hit):
        return none
    doc = np.searchsorted(off, hit, "right") - 1
    a = np.maximum(off[doc], hit - (width - gram))
    b = np.minimum(off[doc + 1], hit + width)
    window = mix(range_hash(s, a, b) + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (hit - a).astype(np.uint64))
    return doc, hit - off[doc], h[hit] >> np.uint64(64 - ANCHOR_BITS), window


def _firsts(anchor, window, doc, pos):
    """(order, first, again): the order by (anchor, window, doc, pos), where in it a new (anchor, window) begins, and the
    entries that stand later than their window's first; a row that repeats the first's very place does not."""
    order = np.lexsort((pos, doc, window, anchor))
    a, w, d, p = anchor[order], window[order], doc[order], pos[order]
    first = np.ones(len(order), bool)
    first[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order, first, (d != d[head]) | (p != p[head])


SENT = "part long, kind int, doc_id long, body binary"


def _scan(width: int, gram: int, ranges: int):
    shift = np.uint64(ANCHOR_BITS)

    def flush(held):
        doc, pos, anchor, window = (np.concatenate(x) for x in zip(*held, strict=True))
        order, first, later = _firsts(anchor, window, doc, pos)
        part, body, ids = [], [], []
        again = order[later]
        if len(again):
            again = again[np.lexsort((pos[again], doc[again]))]
            cuts = np.flatnonzero(np.diff(doc[again], prepend=doc[again][0] - 1))
            for a, b in zip(cuts, np.append(cuts[1:], len(again)), strict=True):
                ids.append(int(doc[again[a]]))
                part.append(ids[-1] % ranges)
                body.append(pack_sorted(pos[again[a:b]].astype(np.uint64)))
        yield pa.table({"part": pa.array(part, pa.int64()), "kind": pa.array([1] * len(part), pa.int32()), "doc_id": pa.array(ids, pa.int64()), "body": pa.array(body, pa.binary())})
        keep = order[first]
        # minima are small numbers, so that they are dealt by another hash; within a range they stay sorted
        to = (((mix(anchor[keep]) >> np.uint64(64 - ANCHOR_BITS)) * np.uint64(ranges)) >> shift).astype(np.int64)
        dealt = np.argsort(to, kind="stable")
        keep, to = keep[dealt], to[dealt]
        cuts = np.searchsorted(to, np.arange(ranges + 1))
        part, body = [], []
        for r in np.flatnonzero(np.diff(cuts)):
            x = keep[cuts[r] : cuts[r + 1]]
            part.append(int(r))
            body.append(joined([pack_sorted(anchor[x]), pack(window[x]), pack(doc[x].astype(np.int64).view(np.uint64)), pack(pos[x].astype(np.uint64))]))
        yield pa.table({"part": pa.array(part, pa.int64()), "kind": pa.array([0] * len(part), pa.int32()), "doc_id": pa.nulls(len(part), pa.int64()), "body": pa.array(body, pa.binary())})

    def run(batches):
        held, n = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, _, data, off in spans(batch.column(1)):
                doc, pos, anchor, window = anchors(data, off.astype(np.int64), width, gram)
                held.append((ids[i + doc], pos, anchor, window))
                n += len(pos)
                if n >= FLUSH:
                    for t in flush(held):
                        yield from t.to_batches()
                    held, n = [], 0
        if n:
            for t in flush(held):
                yield from t.to_batches()
        del held
        release()

    return run


#: kind 0: body holds packed positions of anchors of doc_id whose whole window goes; kind 1: one border anchor.
FOUND = "kind int, doc_id long, pos long, anchor long, crowd long, body binary"


def _found(kind: int, doc, pos=None, anchor=None, crowd=None, body=None) -> pa.Table:
    n = len(doc)
    column = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64())
    return pa.table({"kind": pa.array(np.full(n, kind, np.int32)), "doc_id": pa.array(doc, pa.int64()), "pos": column(pos), "anchor": column(anchor), "crowd": column(crowd), "body": pa.nulls(n, pa.binary()) if body is None else pa.array(body, pa.binary())})


def _settle(t):
    t = t.combine_chunks()
    settled = t.filter(pa.compute.equal(t.column("kind"), 1))
    parts = [_found(0, settled.column("doc_id").to_numpy(), body=settled.column("body").combine_chunks())]
    cols = []
    for body in t.filter(pa.compute.equal(t.column("kind"), 0)).column("body"):
        a, w, d, p = fields(body.as_py())
        cols.append((unpack_sorted(a), unpack(w), unpack(d).view(np.int64), unpack(p).astype(np.int64)))
    if cols:
        anchor, window, doc, pos = (np.concatenate(x) for x in zip(*cols, strict=True))
        del cols
        order, first, later = _firsts(anchor, window, doc, pos)
        again = order[later]
        if len(again):
            again = again[np.lexsort((pos[again], doc[again]))]
            cuts = np.flatnonzero(np.diff(doc[again], prepend=doc[again][0] - 1))
            parts.append(_found(0, doc[again[cuts]], body=[pack_sorted(pos[x].astype(np.uint64)) for x in np.split(again, cuts[1:])]))
        lead = order[first]
        a = anchor[lead]
        edge = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        size = np.diff(np.append(edge, len(a)))
        many = np.repeat(size, size)
        keep = lead[many > 1]
        parts.append(_found(1, doc[keep], pos[keep], anchor[keep].astype(np.int64), many[many > 1]))
        del anchor, window, doc, pos, order, first, later, again, lead, keep
    release()
    return pa.concat_tables(parts)


def sort_index(key: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of keys below 2**bits; sorts the keys with their places in one word where that fits."""
    wide = max(1, len(key).bit_length())
    if bits + wide > 64:
        return np.argsort(key, kind="stable")
    x = np.sort((key << np.uint64(wide)) | np.arange(len(key), dtype=np.uint64))
    return (x & np.uint64((1 << wide) - 1)).astype(np.int64)


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the order of their first `depth` symbols, rank of each position); symbols are below 2**9, 0 past the end."""
    n = len(data)
    x = np.zeros(n + 4, np.uint64)
    x[:n] = data
    key = (x[:n] << np.uint64(27)) | (x[1 : n + 1] << np.uint64(18)) | (x[2 : n + 2] << np.uint64(9)) | x[3 : n + 3]
    bits, have, wide = 36, 4, max(1, (n + 1).bit_length())
    while True:
        order = sort_index(key, bits)
        k = key[order]
        new = np.ones(n, np.uint64)
        new[1:] += np.cumsum(k[1:] != k[:-1]).astype(np.uint64)
        rank = np.zeros(n + depth, np.uint64)
        rank[order] = new
        if have >= depth or (n and int(new[-1]) == n):
            return order, rank[:n]
        step = min(have, depth - have)
        key, bits = (rank[:n] << np.uint64(wide)) | rank[step : n + step], 2 * wide
        have += step


def lpf_reaches(order: np.ndarray, rank: np.ndarray, when: np.ndarray) -> np.ndarray:
    """For each position whether its longest previous factor reaches the depth of the order.

    The previous and the next smaller position in suffix order (by `when`, the position in the corpus; ties aren't
    smaller) hold the longest earlier match, so the factor reaches the depth when either has the same rank. Within
    one rank that nearest smaller position exists for all but the rank's smallest, on one side or the other.
    """
    w, r = when[order], rank[order]
    n = len(order)
    run = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
    label = np.repeat(np.arange(len(run)), np.diff(np.append(run, n)))
    # previous smaller: the running minimum of the rank before this place is smaller; next smaller: the same, reversed
    span = np.int64(int(w.max()) + 2) if n else np.int64(1)
    down = np.minimum.accumulate(w - label * span)
    psv = np.zeros(n, bool)
    psv[1:] = (label[1:] == label[:-1]) & (down[:-1] < (w - label * span)[1:])
    up = np.minimum.accumulate((w + label * span)[::-1])[::-1]
    nsv = np.zeros(n, bool)
    nsv[:-1] = (label[1:] == label[:-1]) & (up[1:] < (w + label * span)[:-1])
    out = np.zeros(n, bool)
    out[order] = psv | nsv
    return out


WINDOWS = "anchor long, lot long, crowd long, doc_id long, start long, body binary"


def _windows(width: int, gram: int, crowd: int):
    """Windows of border anchors, from (doc_id, text, asked); a crowded anchor's are dealt over lots."""

    def run(batches):
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            cols = {k: [] for k in ("anchor", "lot", "crowd", "doc_id", "start", "body")}
            for d, t, asked in zip(docs, texts, batch.column("asked").to_pylist(), strict=True):
                raw = (t or "").encode()
                for x in asked:
                    a = max(0, x["pos"] - (width - gram))
                    lots = -(-x["crowd"] // crowd)
                    lot = int(mix(np.array([d * 0x9E3779B9 + x["pos"] & 0xFFFFFFFFFFFFFFFF], np.uint64))[0] % np.uint64(lots))
                    for k, v in (("anchor", x["anchor"]), ("lot", lot), ("crowd", x["crowd"]), ("doc_id", d), ("start", a), ("body", raw[a : x["pos"] + width])):
                        cols[k].append(v)
            types = {"body": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, types.get(k, pa.int64())) for k, v in cols.items()})
        release()

    return run


MATCHED = "doc_id long, a long, b long, block long, strings binary"


def _block_of(text: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each row of bytes: equal rows have the same one."""
    wide = np.zeros((len(text), -(-text.shape[1] // 8) * 8), np.uint8)
    wide[:, : text.shape[1]] = text
    h = np.zeros(len(text), np.uint64)
    for column in wide.view(np.uint64).T:
        h = mix(h ^ column)
    return (h % np.uint64(blocks)).astype(np.int64)


def _match(width: int, crowd: int, blocks: int):
    """The spans (a, b) of bytes in each window under strings that have an earlier match in the same lot of the same
    anchor. Of crowded anchors also the strings that have none, packed by block."""

    def spans_of(doc, a, b):
        n = len(doc)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "block": pa.nulls(n, pa.int64()), "strings": pa.nulls(n, pa.binary())})

    def packed(doc, a, text):
        block = _block_of(text, blocks)
        order = np.argsort(block, kind="stable")
        edge = np.flatnonzero(np.diff(block[order], prepend=-1))
        lots = np.split(order, edge[1:])
        body = [joined([pack(doc[x].view(np.uint64)), pack(a[x].astype(np.uint64)), pa.compress(text[x].tobytes(), codec="zstd", asbytes=True)]) for x in lots]
        none = pa.nulls(len(lots), pa.int64())
        return pa.table({"doc_id": none, "a": none, "b": none, "block": pa.array(block[order][edge], pa.int64()), "strings": pa.array(body, pa.binary())})

    def run(t):
        anchor, lot, many, doc, start = (t.column(c).to_numpy() for c in ("anchor", "lot", "crowd", "doc_id", "start"))
        body = t.column("body").to_pylist()
        order = np.lexsort((start, doc, lot, anchor))
        same = np.ones(len(order), bool)
        same[1:] = (anchor[order[1:]] == anchor[order[:-1]]) & (lot[order[1:]] == lot[order[:-1]])
        out = [spans_of(doc[:0], start[:0], start[:0])]
        i = 0
        while i < len(order):
            j, size = i, 0
            while j < len(order) and (size < 1 << 19 or same[j]):
                size += len(body[order[j]])
                j += 1
            rows = order[i:j]
            lens = np.array([len(body[k]) for k in rows])
            base = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
            # each window ends in a 0; letters are 1..256, so that no string runs over a border
            data = np.zeros(int((lens + 1).sum()), np.uint16)
            row = np.repeat(np.arange(len(rows)), lens)
            local = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
            data[base[row] + local] = np.frombuffer(b"".join(body[k] for k in rows), np.uint8).astype(np.uint16) + 1
            _, rank = suffix_array(data, width)
            # windows are in (anchor, lot, doc, start) order: a dense number of (doc, place) gives the position in the corpus
            dr, sr = doc[rows], start[rows]
            group = np.cumsum(~same[i:j])
            fits = local <= lens[row] - width
            p, g = base[row][fits] + local[fits], group[row][fits]
            d, s = dr[row][fits], sr[row][fits] + local[fits]
            # only strings of one group are compared: the rank is taken with the group's number
            docs, dn = np.unique(dr, return_inverse=True)
            place = max(1, int(s.max()).bit_length()) if len(s) else 1
            o = sort_index((dn.astype(np.uint64)[row][fits] << np.uint64(place)) | s.astype(np.uint64), place + len(docs).bit_length())
            when = np.empty(len(o), np.int64)
            dd, ss = d[o], s[o]
            when[o] = np.cumsum(np.concatenate(([0], ((dd[1:] != dd[:-1]) | (ss[1:] != ss[:-1])).astype(np.int64)))) if len(o) else 0
            few = max(1, len(rows).bit_length())
            joint = (rank[p] << np.uint64(few)) | g.astype(np.uint64)
            hit = lpf_reaches(sort_index(joint, few + len(data).bit_length()), joint, when)
            # strings that start side by side in a window cover one span
            hit_p, hit_s, hit_d = p[hit], s[hit], d[hit]
            edge = np.flatnonzero(np.diff(hit_p, prepend=-2) != 1)
            last = np.flatnonzero(np.diff(hit_p, append=-2) != 1)
            out.append(spans_of(hit_d[edge], hit_s[edge], hit_s[last] + width))
            first = np.flatnonzero(~hit & (many[rows][row][fits] > crowd))
            if len(first):
                text = np.lib.stride_tricks.sliding_window_view(data, width)[p[first]]
                out.append(packed(d[first], s[first], (text - 1).astype(np.uint8)))
            i = j
        del body
        release()
        return pa.concat_tables(out)

    return run


def _match_strings(width: int):
    """_match() of a block's strings, each a window of its own."""
    match = _match(width, 1 << 62, 1)

    def run(t):
        docs, starts, texts = [], [], []
        for body in t.column("strings"):
            d, a, text = fields(body.as_py())
            docs.append(unpack(d).view(np.int64)), starts.append(unpack(a).astype(np.int64))
            texts.append(pa.decompress(text, len(docs[-1]) * width, codec="zstd", asbytes=True))
        doc, start = np.concatenate(docs), np.concatenate(starts)
        at = pa.py_buffer(np.arange(0, (len(doc) + 1) * width, width, dtype=np.int32))
        zero = pa.array(np.zeros(len(doc), np.int64))
        body = pa.Array.from_buffers(pa.binary(), len(doc), [None, at, pa.py_buffer(b"".join(texts))])
        return match(pa.table({"anchor": zero, "lot": zero, "crowd": zero, "doc_id": pa.array(doc), "start": pa.array(start), "body": body}))

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _apply(width: int, gram: int, with_text: bool):
    def run(batches):
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for d, t, whole, a, b in zip(batch.column("doc_id").to_pylist(), texts, *(batch.column(c) for c in ("whole", "a", "b")), strict=True):
                raw = np.frombuffer((t or "").encode(), np.uint8)
                n = len(raw)
                delta = np.zeros(n + 1, np.int32)
                for x in whole.as_py() or ():
                    p = unpack_sorted(x).astype(np.int64)
                    np.add.at(delta, np.clip(p - (width - gram), 0, n), 1)
                    np.add.at(delta, np.minimum(n, p + width), -1)
                if a.is_valid:
                    np.add.at(delta, a.values.to_numpy(), 1)
                    np.add.at(delta, b.values.to_numpy(), -1)
                gone = np.cumsum(delta[:-1]) > 0
                left = raw[~gone].tobytes()
                spans_ = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((d, n, int(gone.sum()), spans_, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace") if with_text else None))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)][: 6 if with_text else 5], names=list(names[: 6 if with_text else 5]))
        release()

    return run


def _keyed(given: DataFrame) -> tuple[DataFrame, int]:
    """(given with `key`, bytes of text): a number for each document that follows the order of ids.

    It is the id itself unless rows of one id have differing texts: those are documents of their own, and numbers are then
    dealt to the distinct pairs of id and text, in the order of ids, then of two hashes of the text.
    """
    marked = given.filter("doc_id IS NOT NULL").select("doc_id", F.octet_length("text").alias("n"), F.xxhash64("text").alias("h"))
    per_id = marked.groupBy("doc_id").agg(F.sum("n").alias("n"), (F.min("h") != F.max("h")).alias("differ"))
    size, differ = per_id.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.bool_or("differ"), F.lit(False))).first()
    if not differ:
        return given.withColumn("key", F.col("doc_id")), size
    text = F.coalesce("text", F.lit(""))
    rows = given.withColumns({"h": F.xxhash64(text), "h2": F.xxhash64(F.lit("second"), text)})
    pairs = rows.filter("doc_id IS NOT NULL").select("doc_id", "h", "h2").distinct().repartitionByRange("doc_id", "h", "h2").sortWithinPartitions("doc_id", "h", "h2")
    keys = cut(pairs.withColumn("key", F.monotonically_increasing_id()), "keys")
    return rows.join(keys, ["doc_id", "h", "h2"], "left").select("doc_id", "text", "key"), size


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, with_text: bool = False, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]) for every document.

    Null and empty texts have 0 bytes and nothing removed. Rows that repeat id and text are one document given twice,
    and neither is a copy of the other; differing texts under one id are documents of their own, each judged by its own
    text, in an order among themselves that their hashes fix. Rows with a null id have no place in the order: they match
    nothing and stay whole. kept_text may hold a replacement character where a removed run cut a character in two. Texts
    of any length are read whole. Extra columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    lean_batches(spark)
    given, size = _keyed(take(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")))
    docs = given.filter("key IS NOT NULL").select(F.col("key").alias("doc_id"), "text")
    # winnowing takes two of the width - gram + 2 places of a window as anchors
    ranges = max(64, 2 * size // (width - gram + 2) // RANGE)
    found = docs.mapInArrow(_scan(width, gram, ranges), SENT).groupBy("part").applyInArrow(_settle, FOUND)
    found = cut(found, "anchors")
    border = found.filter("kind = 1").select("doc_id", "pos", "anchor", "crowd")

    asked = border.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "pos", "crowd")).alias("asked"))
    windows = docs.join(asked, "doc_id")
    windows = cut(windows.mapInArrow(_windows(width, gram, crowd), WINDOWS), "windows")
    count, crowded = windows.agg(F.count("*"), F.count_if(F.col("crowd") > crowd)).first()
    groups, blocks = max(64, count // GROUP), max(1, crowded * (width - gram + 1) // BLOCK)
    matched = cut(windows.groupBy(F.pmod(F.xxhash64("anchor", "lot"), F.lit(groups)).alias("part")).applyInArrow(_match(width, crowd, blocks), MATCHED), "matched")
    # what is first in its lot of a crowded anchor meets its equals of the other lots
    later = matched.filter("block IS NOT NULL").select("block", "strings").groupBy("block").applyInArrow(_match_strings(width), MATCHED)
    single = matched.filter("block IS NULL").unionByName(later).groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("s")).select("doc_id", "s.a", "s.b")

    whole = found.filter("kind = 0").groupBy("doc_id").agg(F.collect_list("body").alias("whole"))
    gone = cut(whole.join(single, "doc_id", "full"), "gone")
    schema = RESULT + (", kept_text string" if with_text else "")
    return given.join(gone.withColumnRenamed("doc_id", "key"), "key", "left").select("doc_id", "text", "whole", "a", "b").mapInArrow(_apply(width, gram, with_text), schema)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
