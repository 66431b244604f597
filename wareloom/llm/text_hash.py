"""Vectorised byte, word and n-gram hashing of Arrow text columns (numpy).

The helpers run inside Arrow tasks.  A text is seen as its UTF-8 bytes, so
ASCII classes are byte classes and every byte above 0x7F belongs to a
non-ASCII character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

M64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse mod 2^64
BASE_INV = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 21

#: byte classes of the contracts
NOT_SPACE = np.array([not (b == 0x20 or 9 <= b <= 13) for b in range(256)])
ALNUM = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LETTERS = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    low = np.arange(256, dtype=np.uint64)
    low[0x41:0x5B] = low[0x61:0x7B]  # A-Z hash as a-z
    return mix(low + np.uint64(0x1234567))


_VALUES = _byte_values()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) <= n:
        p = np.full(max(n + 1, CHUNK + 1), base, dtype=np.uint64)
        p[0] = 1
        have = np.cumprod(p)
        if n <= 2 * CHUNK:
            _powers[base] = have
    return have


def spare(name: str, columns) -> str:
    """``name``, with underscores in front until no column of the input has it (names differ beyond case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null text has length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, off


def slices(col, limit: int = CHUNK, rows: int = 1 << 30):
    """Cut a text column into runs of at most ``rows`` rows and about ``limit`` bytes: (first row, data, offsets)."""
    data, off = text_bytes(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, n, i + rows)
        yield i, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, need_hash: bool = True):
    """Maximal runs of ``is_word`` bytes that do not cross a text.

    Returns (starts, ends, hashes, first): positions in ``data``, 64-bit
    hashes with A-Z taken as a-z, and for each text the index of its first
    word (length texts + 1).  Bytes are worked in chunks, so only the arrays
    per word grow with a long text.
    """
    inside = is_word[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[off] = True
    prev = np.zeros(len(data), dtype=bool)
    prev[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~prev | begins[:-1]))
    nxt = np.zeros(len(data), dtype=bool)
    nxt[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~nxt | begins[1:])) + 1
    first = np.searchsorted(starts, off)
    if not need_hash:
        return starts, ends, None, first
    hashes = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + CHUNK, side="right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        part = _VALUES[data[lo:hi]] * _power(BASE, hi - lo)[: hi - lo]
        acc = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(part, out=acc[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        hashes[a:b] = mix((acc[e] - acc[s]) * _power(BASE_INV, hi - lo)[s] + (e - s).astype(np.uint64))
        a = b
    return starts, ends, hashes, first


def ngrams(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each position on (crossing texts; the caller masks those)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.full(n, seed + k, dtype=np.uint64)
    for j in range(k):
        acc = mix(acc * np.uint64(BASE) + hashes[j : j + n])
    return acc
