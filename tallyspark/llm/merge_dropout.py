"""SentencePiece encoding and decoding with seeded merge-dropout.

Merges come from a public BPE model with byte fallback. Adjacent pairs wait in an agenda, best score first and leftmost
where scores tie; each candidate that comes up is skipped if a hash of its number in the agenda, keyed by seed, document
and the word's place in it, says so: one rule for words of any length. With probability 0 the result is the model's own segmentation. Any result decodes to the text it came from.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import lean_batches, take
from tallyspark.llm.kernels import mix, release

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 13
#: Stands for a null document id.
NAMELESS = 0x8000000000000001
#: Units and segmentations that a worker remembers, some 400 bytes each.
REMEMBERED = 1 << 18
#: Characters of whole texts that are encoded side by side.
LOT = 1 << 21
SPACE = "▁"
_UNIT = re.compile("▁*[^▁]+|▁+")
_M = (1 << 64) - 1


class Pieces:
    """The vocabulary of a BPE model: piece to id, id to bytes, score by piece, and which characters can meet in a piece."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.score, self.raw, self.byte, self.meet = {}, {}, [], [0] * 256, set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.score[piece] = -sp.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
                self.meet.update(a + b for a, b in zip(piece, piece[1:], strict=False))

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of each code point, whether two numbered characters stand side by side in a piece)."""
        if not hasattr(self, "_neighbours"):
            chars = {c: k for k, c in enumerate(sorted({c for pair in self.meet for c in pair}), 1)}
            place, meet = np.zeros(0x110000, np.int32), np.zeros((len(chars) + 1, len(chars) + 1), bool)
            for c, k in chars.items():
                place[ord(c)] = k
            for x, y in self.meet:
                meet[chars[x], chars[y]] = True
            self._neighbours = place, meet
        return self._neighbours

    def fallback(self, piece: str) -> list[int]:
        got = self.ids.get(piece)
        return [got] if got is not None else [self.byte[b] for b in piece.encode()]


def step_hash(key, step):
    """32 bits for a candidate by its key and its number; of 64-bit arrays, or of Python integers."""
    if isinstance(key, int):
        h = ((key ^ (step * 0x9E3779B97F4A7C15 & _M)) * 0xD6E8FEB86659FD93) & _M
        return (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 >> 20 & 0xFFFFFFFF
    h = (key ^ (step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20) & np.uint64(0xFFFFFFFF)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def merge(word: str, p: Pieces, key: int, limit: int, dropped: tuple[int, ...] = ()) -> list[int]:
    """Ids of a word in which every two neighbours occur in some piece; limit: the dropout probability times 2**32.

    dropped: numbers of steps (candidates that come up) to skip whatever the key says.
    """
    score = p.score
    part = list(word)
    n = len(part)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda, step = [], -1
    for i in range(n - 1):
        s = score.get(part[i] + part[i + 1])
        if s is not None:
            agenda.append((s, i, 2))
    heapify(agenda)
    while agenda:
        s, i, size = heappop(agenda)
        left = part[i]
        j = after[i]
        if left is None or j >= n or len(left) + len(part[j]) != size:
            continue
        step += 1
        if step in dropped or (limit and step_hash(key, step) < limit):
            continue
        part[i] = left = left + part[j]
        part[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            s = score.get(left + part[k])
            if s is not None:
                heappush(agenda, (s, i, size + len(part[k])))
        b = before[i]
        if b >= 0:
            s = score.get(part[b] + left)
            if s is not None:
                heappush(agenda, (s, b, size + len(part[b])))
    out = []
    for x in part:
        if x is not None:
            out += p.fallback(x)
    return out


class Pairs:
    """Two symbols to the piece they make and its place in the order of scores: an open-addressing table in arrays."""

    def __init__(self, p: Pieces):
        place = {v: k for k, v in enumerate(sorted(set(p.score.values())))}
        chars = sorted({c for piece in p.ids for c in piece} - set(p.ids))
        self.symbol = dict(p.ids) | {c: len(p.raw) + k for k, c in enumerate(chars)}
        self.pieces = len(p.raw)
        self.code = np.full(0x110000, -1, np.int64)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.code[ord(c)] = i
        keys, made, rank = [], [], []
        for piece, i in p.ids.items():
            for k in range(1, len(piece)):
                x, y = self.symbol.get(piece[:k]), self.symbol.get(piece[k:])
                if x is not None and y is not None:
                    keys.append(x << 20 | y), made.append(i), rank.append(place[p.score[piece]])
        self.bits = max(10, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.made, self.rank = np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int32)
        for key, m, r in zip(keys, made, rank, strict=True):
            at = self._slot(np.array([key]))[0]
            while self.keys[at] != -1:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.made[at], self.rank[at] = key, m, r

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, rank) of each pair; rank NEVER where they make none."""
        key = (x.astype(np.int64) << 20) | y
        key[(x < 0) | (y < 0)] = -2
        at, made, rank = self._slot(key), np.zeros(len(key), np.int32), np.full(len(key), NEVER, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.keys[at]
            hit = held == key[todo]
            made[todo[hit]], rank[todo[hit]] = self.made[at[hit]], self.rank[at[hit]]
            on = ~hit & (held != -1)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return made, rank


NEVER = np.int32(1 << 30)
#: Words up to this length are merged side by side and remembered; no result depends on it.
SHORT = 24


@lru_cache(maxsize=2)
def pair_table(path: str) -> Pairs:
    return Pairs(pieces(path))


def merge_many(words: list[str], keys: np.ndarray, table: Pairs, limit: int, dropped: np.ndarray | None = None, steps: np.ndarray | None = None) -> list[bytes | None]:
    """merge() of many words at once, one agenda step for all of them at a time; None where a symbol isn't a piece.

    dropped: for each word and step, whether it is skipped whatever the key says; steps takes the steps of each word.
    """
    n = np.fromiter(map(len, words), np.int64, len(words))
    wide = int(n.max())
    code = table.code[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
    # a part stands where it begins, -1 where none does; a row's last place stays empty
    symbols = np.full((len(words), wide + 1), -1, np.int32)
    row = np.repeat(np.arange(len(words)), n)
    symbols[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = code
    after = np.tile(np.arange(1, wide + 2, dtype=np.int32), (len(words), 1))
    before = np.tile(np.arange(-1, wide, dtype=np.int32), (len(words), 1))
    made, rank = (x.reshape(len(words), wide) for x in table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
    live, open_ = np.arange(len(words)), np.ones(len(words), bool)
    out: list = [None] * len(words)
    step = -1
    while len(live):
        step += 1
        at = rank.argmin(1)
        rows = np.arange(len(live))
        ended = rank[rows, at] == NEVER
        done = np.flatnonzero(ended & open_)
        if len(done):
            open_[done] = False
            if steps is not None:
                steps[live[done]] = step
            x = symbols[done]
            held = x >= 0
            raw, ends = x[held].astype("<i4").tobytes(), (4 * np.cumsum(held.sum(1))).tolist()
            for k, a, b, odd in zip(live[done].tolist(), [0, *ends], ends, (x >= table.pieces).any(1).tolist(), strict=False):
                out[k] = None if odd else raw[a:b]
        rows = rows[~ended]
        if 2 * len(rows) < len(live):
            live, open_, symbols, after, before, made, rank, keys, at = (x[rows] for x in (live, open_, symbols, after, before, made, rank, keys, at))
            rows = np.arange(len(live))
        if not len(rows):
            break
        at = at[rows]
        skip = np.zeros(len(rows), bool)
        if limit:
            skip |= step_hash(keys[rows], np.array([step])) < np.uint64(limit)
        if dropped is not None and step < dropped.shape[1]:
            skip |= dropped[live[rows], step]
        rank[rows[skip], at[skip]] = NEVER
        rows, at = rows[~skip], at[~skip]
        gone = after[rows, at]
        symbols[rows, at], symbols[rows, gone], rank[rows, gone] = made[rows, at], -1, NEVER
        after[rows, at] = end = after[rows, gone]
        before[rows, end] = at
        made[rows, at], rank[rows, at] = table.find(symbols[rows, at], symbols[rows, end])
        inner = before[rows, at] >= 0
        rows, at = rows[inner], at[inner]
        left = before[rows, at]
        made[rows, left], rank[rows, left] = table.find(symbols[rows, left], symbols[rows, at])
    return out


class Encoder:
    """Segments each occurrence of a word on its own key.

    What it remembers doesn't depend on keys: the stretches of units (a word with its spaces), and for each stretch a
    node for every list of dropped steps met so far, with its ids as little-endian int32 bytes, the steps it takes and
    a place for the node that each further drop leads to.
    An occurrence goes through the steps of its node; where the hash skips one, it goes on from the node with that drop.
    """

    def __init__(self, path: str, dropout: float, seed: int):
        self.p, self.path, self.limit, self.seed = pieces(path), path, int(dropout * (1 << 32)), seed
        self._forget()

    def _forget(self) -> None:
        self.units: dict[str, int] = {}
        self.first = self.count = self.flat = np.zeros(0, np.int64)
        self.roots: dict[str, int] = {}
        self.kids = np.zeros(0, np.int32)
        self.words: list[str] = []
        self.drops: list[tuple[int, ...]] = []
        self.ids: list[bytes] = []
        self.steps = self.after = self.base = np.zeros(0, np.int64)

    def _split(self, units: list[str]) -> list[list[str]]:
        """The stretches of each unit between neighbours that no piece holds; no merge can cross those."""
        joined = "".join(units)
        place, meet = self.p.neighbours()
        code = place[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum([len(u) for u in units])
        apart = np.zeros(len(joined) + 1, bool)
        apart[1:-1] = ~meet[code[:-1], code[1:]]
        apart[ends] = False
        cuts = np.flatnonzero(apart)
        out = [[u] for u in units]
        owner = np.searchsorted(ends, cuts, "right")
        for k, c in zip(owner.tolist(), (cuts - (ends - np.array([len(u) for u in units]))[owner]).tolist(), strict=True):
            last = out[k].pop()
            c -= len(units[k]) - len(last)
            out[k] += last[:c], last[c:]
        return out

    def _grow(self, words: list[str], drops: list[tuple[int, ...]]) -> range:
        """New nodes. A word over SHORT gets none of its own ids while there is dropout: its occurrences are merged one by one."""
        start = len(self.words)
        ids: list = [b""] * len(words)
        steps = np.zeros(len(words), np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero((size > 1) & (size <= SHORT))
        short = short[np.argsort(size[short], kind="stable")]
        for i in range(0, len(short), 20_000):
            lot = short[i : i + 20_000]
            skips = [drops[k] for k in lot.tolist()]
            count = np.fromiter(map(len, skips), np.int64, len(lot))
            flat = np.fromiter(chain.from_iterable(skips), np.int64, int(count.sum()))
            dropped = np.zeros((len(lot), 1 + (int(flat.max()) if len(flat) else 0)), bool)
            dropped[np.repeat(np.arange(len(lot)), count), flat] = True
            took = np.zeros(len(lot), np.int64)
            asked = [words[k] for k in lot.tolist()]
            for k, x in zip(lot.tolist(), merge_many(asked, np.zeros(len(lot), np.uint64), pair_table(self.path), 0, dropped, took), strict=True):
                ids[k] = x if x is not None else np.array(merge(words[k], self.p, 0, 0, drops[k]), "<i4").tobytes()
            steps[lot] = took
        for k in np.flatnonzero(size == 1).tolist():
            ids[k] = np.array(self.p.fallback(words[k]), "<i4").tobytes()
        for k in np.flatnonzero(size > SHORT).tolist():
            if self.limit:
                steps[k] = -1
            else:
                ids[k] = np.array(merge(words[k], self.p, 0, 0), "<i4").tobytes()
        self.words += words
        self.drops += drops
        self.ids += ids
        self.steps = np.append(self.steps, steps)
        after = np.array([d[-1] + 1 if d else 0 for d in drops], np.int64)
        self.after = np.append(self.after, after)
        room = np.maximum(steps - after, 0)
        self.base = np.append(self.base, len(self.kids) + np.cumsum(room) - room)
        self.kids = np.append(self.kids, np.full(int(room.sum()), -1, np.int32))
        return range(start, len(self.words))

    def _learn(self, fresh: list[str]) -> None:
        split = self._split(fresh)
        words = list({w for x in split for w in x} - self.roots.keys())
        self.roots.update(zip(words, self._grow(words, [()] * len(words)), strict=True))
        self.units.update(zip(fresh, range(len(self.units), len(self.units) + len(fresh)), strict=True))
        count = np.array([len(x) for x in split], np.int64)
        self.first = np.append(self.first, len(self.flat) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.flat = np.append(self.flat, np.array([self.roots[w] for x in split for w in x], np.int64))

    def _drop(self, node: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The node where each occurrence ends, by its key: all go through their steps side by side."""
        node = node.copy()
        live = np.flatnonzero(self.steps[node] > self.after[node])
        step = self.after[node[live]]
        while len(live):
            hit = np.flatnonzero(step_hash(key[live], step) < np.uint64(self.limit))
            at, on = node[live[hit]], step[hit]
            slot = self.base[at] + on - self.after[at]
            new = np.flatnonzero(self.kids[slot] < 0)
            if len(new):
                _, once = np.unique(slot[new], return_index=True)
                new = new[once]
                parents = at[new].tolist()
                made = self._grow([self.words[k] for k in parents], [(*self.drops[k], x) for k, x in zip(parents, on[new].tolist(), strict=True)])
                self.kids[slot[new]] = np.arange(made.start, made.stop)
            node[live[hit]] = self.kids[slot]
            step = step + 1
            more = step < self.steps[node[live]]
            live, step = live[more], step[more]
        return node

    def encode_many(self, texts: list[str], docs: list[int | None]) -> list[bytes]:
        """The ids of each text as int32 bytes. A literal U+2581 is spelt in bytes, so that it stays apart from a space."""
        if len(self.words) + len(self.units) > REMEMBERED:
            self._forget()
        spelt = np.array([self.p.byte[b] for b in SPACE.encode()], "<i4").tobytes()
        units: list[str] = []
        runs: list[list[int]] = []
        for t in texts:
            runs.append([])
            for x in (" " + t).split(SPACE) if t else [""]:
                found = _UNIT.findall(x.replace(" ", SPACE))
                runs[-1].append(len(found))
                units += found
        unit = np.fromiter(map(self.units.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(unit < 0)
        if len(new):
            new_units = [units[k] for k in new.tolist()]
            self._learn(list(dict.fromkeys(new_units)))
            unit[new] = np.fromiter(map(self.units.__getitem__, new_units), np.int64, len(new))
        count = self.count[unit]
        ends = np.cumsum(count)
        node = self.flat[np.repeat(self.first[unit] - (ends - count), count) + np.arange(count.sum())]
        # where each run of a text between literal marks ends, and where each text does
        cuts = np.append(0, ends)[np.cumsum([n for x in runs for n in x])].tolist()
        lasts = np.array(cuts)[np.cumsum([len(x) for x in runs]) - 1]
        size = np.diff(np.append(0, lasts))
        key = mix(np.array([NAMELESS if d is None else d & _M for d in docs], np.uint64) + mix(np.array([self.seed & _M], np.uint64)))
        place = (np.arange(len(node)) - np.repeat(lasts - size, size)).astype(np.uint64)
        key = mix(np.repeat(key, size) + place * np.uint64(0x9E3779B97F4A7C15))
        if self.limit:
            node = self._drop(node, key)
        ids = list(map(self.ids.__getitem__, node.tolist()))
        for k in np.flatnonzero(self.steps[node] < 0).tolist():
            ids[k] = np.array(merge(self.words[node[k]], self.p, int(key[k]), self.limit), "<i4").tobytes()
        out, at, c = [], 0, 0
        for x in runs:
            bodies = []
            for end in cuts[c : c + len(x)]:
                bodies.append(b"".join(ids[at:end]))
                at = end
            c += len(x)
            out.append(spelt.join(bodies))
        return out

    def encode(self, text: str, doc: int = 0) -> list[int]:
        return np.frombuffer(self.encode_many([text], [doc])[0], "<i4").tolist()


@lru_cache(maxsize=1)
def encoder(path: str, dropout: float, seed: int) -> Encoder:
    """A worker's encoder: what it remembers, REMEMBERED entries at most, serves all tasks of the worker."""
    return Encoder(path, dropout, seed)


def decode(ids: list[int], path: str = MODEL) -> str:
    raw = pieces(path).raw
    return b"".join([raw[i] for i in ids]).decode()[1:]


def _encode(path: str, dropout: float, seed: int, digest: bool, lot: int = LOT):
    names = ["doc_id", "n_pieces", *(["ids_sha256", "decoded_sha256"] if digest else ["ids"])]
    types = [pa.int64(), pa.int64(), *([pa.string(), pa.string()] if digest else [pa.list_(pa.int32())])]

    def run(batches):
        e = encoder(path, dropout, seed)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            i = 0
            while i < len(docs):
                j, size = i, 0
                while j < len(docs) and size < lot:
                    size += len(texts[j])
                    j += 1
                rows = []
                for d, raw in zip(docs[i:j], e.encode_many(texts[i:j], docs[i:j]), strict=True):
                    ids = np.frombuffer(raw, "<i4")
                    rows.append((d, len(ids), *((hashlib.sha256(raw).hexdigest(), hashlib.sha256(decode(ids.tolist(), path).encode()).hexdigest()) if digest else (ids,))))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                i = j
        release()

    return run


def encode_pieces(docs: DataFrame, path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, digest: bool = False, lot: int = LOT) -> DataFrame:
    """(doc_id, n_pieces, ids) for every row, or with `digest` (doc_id, n_pieces, ids_sha256, decoded_sha256).

    decoded_sha256 is over what the ids decode to, which is the text. Null texts count as empty and have no
    piece. Every occurrence of a word is cut on its own key of seed, document id and place in the document;
    null ids count as one id. Repeated rows give repeated rows; extra columns are not read. Texts of any length are read
    whole, and an empty table gives an empty result. `lot` is the characters encoded side by side, of whole texts; it changes
    no result.
    """
    lean_batches(docs.sparkSession)
    schema = "doc_id long, n_pieces long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>")
    rows = take(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_encode(path, dropout, seed, digest, lot), schema)


def op8_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
