"""Media columns: chroma audio fingerprints and their alignment.

Audio becomes frames, each frame twelve pitch-class energies. Over the integral image of the chroma, sixteen box filters
are read at every step; each gives two Gray-coded bits, so that a step of audio is one 32-bit integer. Recordings are
aligned by an index on pairs of those integers: the offsets at which two recordings share pairs form a histogram, and
the best offsets are settled by the share of differing bits.

Two recordings of one sound are rarely cut at the same phase of a step. A query is therefore fingerprinted at PHASES
phases of the hop, one of which lies within an eighth of a step of the index's own grid, and asks with all of them.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, lean_batches, salted_join, take
from tallyspark.llm.kernels import mix

RATE = 4000
FRAME, HOP = 1024, 256
#: Frames that one fingerprint integer looks at.
SPAN = 8
#: Box filters: kind, first pitch class, height, width in frames. Fixed values of this fingerprint.
FILTERS = tuple((k % 4, (5 * k) % 12, 1 + (k * 7) % 4, (2, 4, 6, 8)[k // 4]) for k in range(16))
#: Where a filter's log ratio changes its two bits.
STEPS = (-0.35, 0.0, 0.35)
_GRAY = np.array([0, 1, 3, 2], np.uint32)
#: An index key is two integers this many steps apart, hashed together.
APART = 2
#: A recording with fewer distinct keys has one for each step.
FEW_KEYS = 8
#: Phases of the hop at which a query asks.
PHASES = 4
#: Recordings whose index entries may share a block.
BLOCK = 1 << 15
#: Steps compared at a time.
TRIED = 1 << 20
#: Embeddings that are sounded in one task.
LOT = 1 << 10
#: The column of the audio inside this module.
MEDIUM = "medium"
#: Frames transformed and samples fingerprinted at a time, so that long audio takes no more memory than short.
FRAMES, SAMPLES = 4096, 1 << 20


def chroma(pcm: np.ndarray) -> np.ndarray:
    """[recordings, frames, 12] pitch-class energies of equally long recordings in [-1, 1]."""
    n = 1 + (pcm.shape[1] - FRAME) // HOP
    if n < 1:
        return np.zeros((len(pcm), 0, 12))
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    use = hz >= 60
    pitch = np.round(12 * np.log2(hz[use] / 440)).astype(int) % 12
    fold = np.zeros((len(hz), 12), np.float32)
    fold[np.flatnonzero(use), pitch] = 1
    c, window = np.zeros((len(pcm), n, 12)), np.hanning(FRAME).astype(np.float32)
    block = max(1, FRAMES // len(pcm))
    for i in range(0, n, block):
        at = np.arange(FRAME)[None, :] + HOP * np.arange(i, min(n, i + block))[:, None]
        c[:, i : i + block] = (np.abs(np.fft.rfft(pcm[:, at] * window, axis=2)) ** 2) @ fold
    return c / (np.sqrt((c * c).sum(2, keepdims=True)) + 1e-9)


def integers(c: np.ndarray) -> np.ndarray:
    """[recordings, steps] 32-bit fingerprints of chroma images; no step where a recording is shorter than SPAN frames."""
    steps = c.shape[1] - SPAN + 1
    if steps < 1:
        return np.zeros((len(c), 0), np.uint32)
    wide = np.concatenate((c, c[:, :, :4]), 2)  # pitch classes go round
    image = np.zeros((len(c), c.shape[1] + 1, wide.shape[2] + 1))
    image[:, 1:, 1:] = wide.cumsum(1).cumsum(2)
    at = np.arange(steps)

    def box(x0, x1, y0, y1):
        a, b = at + x0, at + x1
        return image[:, b, y1] - image[:, a, y1] - image[:, b, y0] + image[:, a, y0]

    out = np.zeros((len(c), steps), np.uint32)
    for k, (kind, y, h, w) in enumerate(FILTERS):
        whole = box(0, w, y, y + h)
        if kind == 0:  # energy against the frame's mean
            a, b = whole, box(0, w, 0, 12) * h / 12
        elif kind == 1:  # first half in time against the second
            a, b = box(0, w // 2, y, y + h), box(w // 2, w, y, y + h)
        elif kind == 2:  # a band against the one a third above it
            z = (y + 4) % 12
            a, b = whole, box(0, w, z, z + h)
        else:  # the middle against the outer quarters
            a = box(w // 4, w - w // 4, y, y + h)
            b = whole - a
        out |= _GRAY[np.searchsorted(STEPS, np.log((a + 0.02) / (b + 0.02)))] << np.uint32(2 * k)
    return out


def wav_pcm(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """Mono samples in [-1, 1] of 16-bit WAV values; an empty array for null or broken ones."""
    out = []
    for raw in batch.column(column).to_pylist():
        try:
            with wave.open(io.BytesIO(raw or b"")) as w:
                x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).mean(1) / 32768
                at = np.arange(0, len(x), w.getframerate() / RATE) if w.getframerate() != RATE else None
                out.append((x if at is None else np.interp(at, np.arange(len(x)), x)).astype(np.float32))
        except (wave.Error, EOFError):
            out.append(np.zeros(0, np.float32))
    return out


def melody_pcm(batch: pa.RecordBatch, column: str, note: int = 400) -> list[np.ndarray]:
    """Audio that sounds a numeric vector: each value is a tone whose pitch follows the value."""
    out = []
    t = np.arange(note) / RATE
    for v in batch.column(column).to_pylist():
        v = np.array([0.0 if x is None else x for x in v or ()], np.float64)
        v = np.nan_to_num(v)
        scale = np.sqrt((v * v).mean()) if len(v) else 0
        semitone = np.clip(12 + 3 * np.round(1.2 * v / (scale or 1)), 0, 24)
        out.append((0.8 * np.sin(2 * np.pi * 220 * 2 ** (semitone[:, None] / 12) * t)).astype(np.float32).ravel())
    return out


def _codes(pcm: list[np.ndarray]) -> list[bytes]:
    """Fingerprints of recordings as bytes, equally long ones together."""
    codes: list = [None] * len(pcm)
    for n in {len(x) for x in pcm}:
        same = [k for k, x in enumerate(pcm) if len(x) == n]
        for k, code in zip(same, integers(chroma(np.stack([pcm[k] for k in same]))), strict=True):
            codes[k] = code.astype("<u4").tobytes()
    return codes


def _fingerprint(pcm_of, column: str):
    def run(batches):
        for batch in batches:
            size = batch.column(1).nbytes // max(1, batch.num_rows)
            lot = max(1, min(64, SAMPLES // max(1, size)))
            for i in range(0, batch.num_rows, lot):
                part = batch.slice(i, lot)
                pcm, ids = pcm_of(part, column), part.column(0).to_pylist()
                phases: list = [None] * len(pcm)
                asking = [k for k, d in enumerate(ids) if d is not None and d % 100 == 0]
                for p in range(1, PHASES):
                    for k, code in zip(asking, _codes([pcm[k][p * HOP // PHASES :] for k in asking]), strict=True):
                        phases[k] = [*(phases[k] or []), code]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_codes(pcm), pa.binary()), pa.array(phases, pa.list_(pa.binary()))], names=["id", "code", "phases"])

    return run


def fingerprints(media: DataFrame, id_col: str, column: str, pcm_of=wav_pcm) -> DataFrame:
    """(id, code, phases): each row's fingerprint integers as little-endian bytes, empty for null, broken or very short
    audio; and of those that ask (id divisible by 100) the same at the later phases of the hop."""
    return take(media, id=id_col, **{MEDIUM: column}).select(F.col("id").cast("long").alias("id"), MEDIUM).mapInArrow(_fingerprint(pcm_of, MEDIUM), "id long, code binary, phases array<binary>")


def code_keys(raw: bytes, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(keys, steps) of a fingerprint: a key for each pair of integers APART steps apart, or if exact, for each integer.

    A held tone repeats its key; unless exact, its first step stands for it, or all do where few keys are left. A fingerprint
    of APART steps or fewer has its whole code as its key."""
    x = np.frombuffer(raw, "<u4").astype(np.uint64)
    x = mix(x) if exact else mix(mix(x[:-APART]) + x[APART:]) if len(x) > APART else mix(np.array([sum(int(v) << (32 * k) for k, v in enumerate(x)) & 0xFFFFFFFFFFFFFFFF], np.uint64))
    new = np.ones(len(x), bool)
    if not exact:
        new[1:] &= x[1:] != x[:-1]
        new |= new.sum() < FEW_KEYS
    return (x[new] >> np.uint64(1)).astype(np.int64), np.flatnonzero(new)


def _keys(exact: bool):
    """(id, key, at, n) of rows (id, codes): the keys of each recording at each phase, where they stand in steps of the first
    phase, to the nearest one, and how many its first phase has."""

    def run(batches):
        for batch in batches:
            ids, keys, at, sizes = [], [], [], []
            for i, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = 0
                for p, raw in enumerate(codes or ()):
                    k, a = code_keys(raw, exact)
                    n = n or len(k)
                    keys.append(k), at.append(a + (2 * p > PHASES)), ids.append(np.full(len(k), i)), sizes.append(np.full(len(k), n))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (ids, keys, at, sizes)], names=["id", "key", "at", "n"])

    return run


def _votes(ids: np.ndarray, k: np.ndarray, at: np.ndarray, offset: np.ndarray, least: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """(recording, offset, votes asked for, votes) of hits at place `at` of recording ids[k]; a recording asks for as many at
    each hit. A place votes once for an offset."""
    if not len(k):
        return (np.zeros(0, np.int64),) * 4
    asked = np.zeros(len(ids), np.int64)
    asked[k] = least
    low, wide, long = offset.min() - reach, int(np.ptp(offset)) + 2 * reach + 1, int(at.max()) + 1
    if len(ids) * wide * long < 1 << 62:  # one number for each vote, which sorts far faster than three
        vote = np.concatenate([(k * wide + (offset + (r - low))) * long + at for r in range(-reach, reach + 1)])
        pair, count = np.unique(np.unique(vote) // long, return_counts=True)
        k, offset = pair // wide, pair % wide + low
    else:
        cast = np.unique(np.concatenate([np.stack((k, offset + r, at)) for r in range(-reach, reach + 1)], axis=1), axis=1)
        (k, offset), count = np.unique(cast[:2], axis=1, return_counts=True)
    return ids[k], offset, asked[k], count


def _histograms(votes: int, tries: int, reach: int):
    """Of a query's hits in one lot of recordings, each recording's most voted offsets; of as many votes, those nearest to 0.

    A place of the index votes for the offset of its hit and for those within `reach`, once for each. `votes` places are
    asked for, or as many as the smaller of the two recordings has keys.
    """

    def run(key, t):
        q, where = key[0].as_py(), t.column("at").combine_chunks()
        size = np.diff(where.offsets.to_numpy())
        m, at, n = t.column("m").combine_chunks().flatten().to_numpy(), where.flatten().to_numpy(), t.column("n").combine_chunks().flatten().to_numpy()
        offset = at - np.repeat(t.column("qa").to_numpy(), size)
        least = np.minimum(np.minimum(n, np.repeat(t.column("qn").to_numpy(), size)), votes)
        other = m != q
        ids, at, offset, least = m[other], at[other], offset[other], least[other]
        ids, k = np.unique(ids, return_inverse=True)
        hit = np.bincount(k, minlength=len(ids))[k] >= least  # fewer hits than votes asked for: no offset has enough
        m, offset, least, count = _votes(ids, k[hit], at[hit], offset[hit], least[hit], reach)
        enough = count >= least
        m, offset, count = m[enough], offset[enough], count[enough]
        order = np.lexsort((-offset, np.abs(offset), -count, m))
        m, offset = m[order], offset[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(m)), bool), m[1:] != m[:-1])))
        ends = np.append(first[1:], len(m))[: len(first)]
        kept = [offset[a : min(b, a + tries)] for a, b in zip(first, ends, strict=True)]
        return pa.table({"q": pa.array(np.full(len(first), q), pa.int64()), "m": pa.array(m[first], pa.int64()), "offsets": pa.array(kept, pa.list_(pa.int64()))})

    return run


def bit_error(x: np.ndarray, y: np.ndarray, offset: int) -> tuple[float, int]:
    """(share of differing bits, steps) where x[k] meets y[k + offset]."""
    a, b = max(0, -offset), min(len(x), len(y) - offset)
    if b <= a:
        return 1.0, 0
    return float(np.bitwise_count(x[a:b] ^ y[a + offset : b + offset]).mean()) / 32, b - a


def _settle(least: float, overlap: float, reach: int):
    """Pairs under `least` differing bits at the best of their offsets, each tried with its `reach` neighbours on both sides.

    Tries over as many steps are counted together, as bit_error() would one by one.
    """

    def run(batches):
        for batch in batches:
            (x, lx), (y, ly) = (_flat(batch.column(c)) for c in ("x", "y"))
            offsets = batch.column("offsets").to_pylist()
            pair = np.repeat(np.arange(batch.num_rows), [len(o) for o in offsets])
            tried = np.array([o for os in offsets for o in os], np.int64)
            low = tried.min(initial=0) - reach
            wide = int(tried.max(initial=0) - low) + reach + 1
            each = np.unique(np.concatenate([pair * wide + (tried + (r - low)) for r in range(-reach, reach + 1)]))
            pair, tried = each // wide, each % wide + low
            steps = np.maximum(0, np.minimum(lx[pair], ly[pair] - tried) - np.maximum(0, -tried))
            use = steps >= overlap * np.minimum(lx, ly)[pair]
            pair, tried, steps = pair[use], tried[use], steps[use]
            order = np.argsort(steps, kind="stable")
            pair, tried, steps = pair[order], tried[order], steps[order]
            error, begin = np.ones(len(pair)), np.maximum(0, -tried)
            from_x, from_y = (np.cumsum(lx) - lx)[pair] + begin, (np.cumsum(ly) - ly)[pair] + begin + tried
            edges = np.append(np.flatnonzero(np.diff(steps, prepend=-1)), len(pair))
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if n := int(steps[i]):
                    xs, ys = np.lib.stride_tricks.sliding_window_view(x, n), np.lib.stride_tricks.sliding_window_view(y, n)
                    lot = max(1, TRIED // n)
                    for k in range(i, j, lot):
                        bits = np.bitwise_count(xs[from_x[k : min(j, k + lot)]] ^ ys[from_y[k : min(j, k + lot)]])
                        error[k : k + len(bits)] = bits.sum(1, dtype=np.uint32) / n / 32
            order = np.lexsort((tried, np.abs(tried), -steps, error, pair))
            best = order[np.flatnonzero(np.concatenate((np.ones(min(1, len(pair)), bool), np.diff(pair[order]) > 0)))]
            best = best[error[best] <= least]
            at = pa.array(pair[best], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("q").take(at), batch.column("m").take(at), *(pa.array(c[best], t) for c, t in ((tried, pa.int64()), (error, pa.float64()), (steps, pa.int64())))], names=["query", "match", "offset", "bit_error", "steps"])

    return run


def _flat(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The integers of all codes after each other, and how many each has."""
    raw = codes.to_pylist()
    return np.frombuffer(b"".join(raw), "<u4"), np.array([len(c) // 4 for c in raw], np.int64)


def classes_of(prints: DataFrame) -> DataFrame:
    """(code, class_id, members, asked, phases): rows with the same non-empty fingerprint form a class, named by its smallest
    id; it asks if any member does, with the phases of the first that does."""
    asks = F.pmod("id", F.lit(100)) == 0
    return prints.filter(F.octet_length("code") > 0).groupBy("code").agg(F.min("id").alias("class_id"), F.count("*").alias("members"), F.max(asks).alias("asked"), F.min_by("phases", F.when(asks, F.col("id"))).alias("phases"))


def match(classes: DataFrame, votes: int = 2, tries: int = 3, least: float = 0.2, overlap: float = 0.6, exact: bool = False) -> DataFrame:
    """(query, match, offset, bit_error, steps): for each asked class, the other classes that align with it.

    The index holds every key of every class; a query asks with all keys of its code and of its later phases, where it has
    them. A pair is tried around its `tries` most voted offsets, give or take a step, with at least `votes` votes (or as many
    as there are keys), of offsets with as many votes at the nearest to 0. One shared key is what strangers have, at a rate
    that more rows don't lower; two at one offset are rare. `exact` makes a key of each integer and tries every offset at
    which one is shared: it finds whatever aligns with one step without an error, at many more candidates.

    Entries of a key lie in blocks of at most BLOCK recordings, dealt by hash; a query's hits in one lot of recordings meet
    in one task, which counts their offsets. No key and no query has all its hits in one task.
    """
    phases = F.col("phases") if "phases" in classes.columns else F.lit(None).cast("array<binary>")
    codes = F.array("code") if exact else F.concat(F.array("code"), F.coalesce(phases, F.array().cast("array<binary>")))
    lots = max(1, classes.count() // BLOCK)
    keyed = classes.select(F.col("class_id").alias("id"), F.array("code").alias("codes")).mapInArrow(_keys(exact), "id long, key long, at long, n long")
    index = keyed.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(lots)).alias("lot")).agg(F.collect_list(F.struct("id", "at", "n")).alias("e")).select("key", "lot", F.col("e.id").alias("m"), F.col("e.at").alias("at"), F.col("e.n").alias("n"))
    asked = classes.filter("asked").select(F.col("class_id").alias("id"), codes.alias("codes")).mapInArrow(_keys(exact), "id long, key long, at long, n long").distinct()
    hits = asked.select(F.col("id").alias("q"), "key", F.col("at").alias("qa"), F.col("n").alias("qn")).join(index, "key")
    best = hits.select("q", "lot", "qa", "qn", "m", "at", "n").groupBy("q", "lot").applyInArrow(_histograms(*((1, 1 << 62, 0) if exact else (votes, tries, 1))), "q long, m long, offsets array<long>")
    pairs = cut(best, "offsets").join(classes.select(F.col("class_id").alias("q"), F.col("code").alias("x")), "q").join(classes.select(F.col("class_id").alias("m"), F.col("code").alias("y")), "m")
    return pairs.select("q", "m", "offsets", "x", "y").mapInArrow(_settle(least, overlap, 0 if exact else 1), "query long, match long, offset long, bit_error double, steps long")


def search(media: DataFrame, id_col: str, column: str, pcm_of=wav_pcm, **kw) -> DataFrame:
    """Members and matches in one table: (kind, id, class_id, offset, bit_error, steps).

    kind 'member': row id has the fingerprint of class_id; a row without a fingerprint is a class of its own. kind
    'match': the class of a query (any member's id divisible by 100) in id aligns with class_id at offset. Rows with
    the same fingerprint match at offset 0 without an error and aren't spelt out in pairs. Null vectors and audio have
    no fingerprint; a null id stays a member of its class but asks nothing. Audio of any length is read whole, in
    blocks of frames; a recording of APART steps or fewer matches its own fingerprint alone. Extra columns are not
    read. An empty table gives an empty result.
    """
    lean_batches(media.sparkSession)
    prints = cut(fingerprints(media, id_col, column, pcm_of), "prints")
    classes = cut(classes_of(prints), "classes")
    total = prints.count()
    keyed = classes.select(F.sha2("code", 256).alias("h"), "class_id", "members")
    member = salted_join(prints.select("id", F.when(F.octet_length("code") > 0, F.sha2("code", 256)).alias("h")), keyed, "h", "members", total, "id")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("offset", "long"), ("bit_error", "double"), ("steps", "long"))]
    member = member.select(F.lit("member").alias("kind"), "id", F.coalesce("class_id", "id").alias("class_id"), *none)
    found = match(classes, **kw).select(F.lit("match").alias("kind"), F.col("query").alias("id"), F.col("match").alias("class_id"), "offset", "bit_error", "steps")
    return member.unionByName(found)


def op10_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", melody_pcm)


def cut_recordings_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 over recordings that do match: beside each embedding's melody, under the id that follows all others by as much, one
    that begins some tones later and has a few tones altered. Members and matches as search() gives them."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    after, total = rows.agg(F.coalesce(F.max("id"), F.lit(0)) + 1, F.count("*")).first()
    rows = rows.repartition(max(1, total // LOT), "id", "v")  # audio takes long for its bytes, and a file may be one task's
    late = F.slice("v", (F.col("id") % 11 + 2).cast("int"), F.size("v"))
    altered = F.transform(late, lambda x, k: F.when(k % 19 == F.col("id") % 19, -x).otherwise(x))
    other = rows.filter("id IS NOT NULL AND v IS NOT NULL").select((F.col("id") + after).alias("id"), altered.alias("v"))
    return search(rows.unionByName(other), "id", "v", melody_pcm)
