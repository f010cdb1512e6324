"""Vectorised byte-level tokenising of Arrow text columns with numpy.

Every token contract here is a set of ASCII bytes that end a token, so UTF-8
bytes can be classified one by one; all bytes of a non-ASCII character are
token bytes.  A token's 64-bit hash is a polynomial over a random byte table,
taken as a difference of running sums (arithmetic modulo 2**64), then mixed.
Texts are worked on in pieces of a few MB, cut where no token is open, so
memory does not follow the length of a text or batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
U64 = np.uint64
_rng = np.random.RandomState(20240613)
_BYTE = _rng.randint(0, 2 ** 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_R = U64(0x9E3779B97F4A7C15)
_R_INV = U64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z
_BYTE = _BYTE[FOLD]  # tokens are hashed in lower case


def token_bytes(*ends: tuple[int, int]) -> np.ndarray:
    """256 flags: which bytes belong to tokens when the closed ranges ``ends`` do not."""
    keep = np.ones(256, bool)
    for lo, hi in ends:
        keep[lo:hi + 1] = False
    return keep


SPACED = token_bytes((0x20, 0x20), (0x09, 0x0D))                                  # [^\x20\x09-\x0D]+
WORDS = token_bytes((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))       # letters, digits, non-ASCII


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POW = np.concatenate([[U64(1)], np.cumprod(np.full(PIECE, _R, U64))])
_POW_INV = np.concatenate([[U64(1)], np.cumprod(np.full(PIECE, _R_INV, U64))])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= PIECE + 1:
        return _POW[:n], _POW_INV[:n]
    return (np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, _R, U64))]),
            np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, _R_INV, U64))]))


def _piece_tokens(data: np.ndarray, keep: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the tokens of one piece; ``breaks`` are offsets where a text begins."""
    flags = keep[data]
    opens = flags.copy()
    opens[1:] &= ~flags[:-1]
    if len(breaks):
        inner = breaks[breaks < len(data)]
        opens[inner] = flags[inner]
    starts = np.flatnonzero(opens)
    shuts = flags.copy()
    shuts[:-1] &= ~flags[1:]
    if len(breaks):
        last = breaks[(breaks > 0) & (breaks <= len(data))] - 1
        shuts[last] = flags[last]
    ends = np.flatnonzero(shuts) + 1
    p, q = _powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * p, out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * q[starts] ^ (ends - starts).astype(U64))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (n + 1, int64) of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0]


def tokens(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): token hashes of all texts one after the other, and tokens per text."""
    at, n, hashes, starts = 0, len(data), [], []
    while at < n:
        end = min(at + PIECE, n)
        while end < n:  # go back to a byte that is in no token; a giant token makes a giant piece
            window = keep[data[at:end]]
            if window.all():
                end = min(end + PIECE, n)
                continue
            end = at + len(window) - int(np.argmin(window[::-1]))
            break
        lo, hi = np.searchsorted(offsets, [at, end], "left")
        s, h = _piece_tokens(data[at:end], keep, offsets[lo:hi + 1] - at)
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(offsets) - 1, np.int64)
    where = np.concatenate(starts)
    bounds = np.searchsorted(where, offsets, "left")
    return np.concatenate(hashes), np.diff(bounds)


def split_rows(offsets: np.ndarray, most: int):
    """Row ranges (lo, hi) holding at most ``most`` bytes each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
