"""Array kernels over Arrow text columns: byte views, rolling hashes, words and shingles."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def release() -> None:
    """Give freed memory back to the system; a reused worker would hold it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) <= n:
        size = max(1 << 20, 1 << int(n).bit_length())
        for name, b in (("p", BASE), ("i", INVERSE)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["p"], _powers["i"]


def spans(arr: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) for runs of whole texts of about `limit` bytes; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    n = len(arr)
    if not n:
        return
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset : arr.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[i] the hash sum of the first i bytes; range_hash() reads a span of it."""
    p, _ = powers(len(data) + 1)
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=s[1:])
    return s


def range_hash(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Position-independent hash of bytes a..b for each pair of positions."""
    _, inv = powers(len(s))
    return (s[b] - s[a]) * inv[a]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ASCII-lower-cased words in order, and for each text where its words begin (one more at the end)."""
    low = _LOWER[data]
    ink = ~_SPACE[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | edge[1:-1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    h = mix(range_hash(prefix_hash(low), a, b) + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, np.searchsorted(a, off)


_PLACE = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def shingle_sets(arr: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles, in the order of arr.

    A text of fewer words is one shingle; one without words has none.
    """
    for i, j, data, off in spans(arr):
        h, at = word_hashes(data, off)
        if len(h) >= width:
            sh = h[: len(h) - width + 1] * _PLACE[0]
            for k in range(1, width):
                sh = (sh ^ (sh >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25) + h[k : len(h) - width + 1 + k] * _PLACE[k % 5]
            sh = mix(sh)
        for k in range(j - i):
            a, b = at[k], at[k + 1]
            if b - a >= width:
                x = np.sort(sh[a : b - width + 1])
                yield x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x
            elif b > a:
                x = np.uint64(b - a)
                for w in h[a:b]:
                    x = np.uint64((int(x) * int(_PLACE[1]) + int(w)) & 0xFFFFFFFFFFFFFFFF)
                yield mix(np.array([x], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted non-negative integers as compressed byte planes of their gaps."""
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def pack(x: np.ndarray) -> bytes:
    """Integers below 2**64 as compressed byte planes; the planes that hold only zeros vanish."""
    x = np.ascontiguousarray(x, dtype="<u8")
    wide = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :wide].T)
    return len(x).to_bytes(6, "little") + bytes([wide]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    n, wide = int.from_bytes(b[:6], "little"), b[6]
    planes = np.frombuffer(pa.decompress(b[7:], n * wide, codec="zstd", asbytes=True), np.uint8).reshape(wide, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :wide] = planes.T
    return out.view("<u8").reshape(-1)


def joined(parts: list[bytes]) -> bytes:
    """Byte strings as one, each after its length."""
    return b"".join(len(x).to_bytes(5, "little") + x for x in parts)


def fields(body: bytes) -> list[bytes]:
    """What joined() was given."""
    out, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 5], "little")
        out.append(body[at + 5 : at + 5 + n])
        at += 5 + n
    return out
