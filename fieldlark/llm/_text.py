"""Word and shingle hashing of whole Arrow text columns with numpy, in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that are dealt with at once. One longer text is a chunk of its own, hashed in pieces of that many bytes.
CHUNK = 1 << 18
_BASE = U(0x9E3779B97F4A7C15)
_seeds = np.random.RandomState(20240229)
_VALUE = _seeds.randint(0, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_POS = (_seeds.randint(0, 2**63, 8, dtype=np.int64).astype(U) << U(1)) | U(1)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]

#: Separators of op3's words: the space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: All ASCII but letters and digits: words keep their letters whatever punctuation stands beside them.
NONWORD = np.zeros(256, bool)
NONWORD[:128] = True
NONWORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; of a piece's length at most."""
    if len(_powers[0]) < n:
        size, inverse = max(n, CHUNK + 1), U(pow(int(_BASE), -1, 1 << 64))
        for i, base in enumerate((_BASE, inverse)):
            x = np.full(size, base, U)
            x[0] = 1
            _powers[i] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def chunks(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows' texts in them) of `size` bytes or so, CHUNK if not given; a null is an empty text."""
    size = size or CHUNK
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words(raw: np.ndarray, at: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, the index of each row's first word (and the end), starts and ends of the words."""
    parts, last = [], 0  # `last`: where the word began that the piece before may have cut
    for lo in range(0, len(raw), CHUNK):
        h, starts, ends = _piece(raw[lo : lo + CHUNK], at - lo, separators)
        starts, ends = starts + lo, ends + lo
        if parts and len(h) and starts[0] == lo and parts[-1][2][-1:].tolist() == [lo] and lo not in at:
            with np.errstate(over="ignore"):
                parts[-1][0][-1] += h[0] * U(pow(int(_BASE), lo - last, 1 << 64))
            parts[-1][2][-1] = ends[0]
            h, starts, ends = h[1:], starts[1:], ends[1:]
        if len(h):
            parts.append((h, starts, ends))
            last = int(starts[-1])
    if not parts:
        return np.zeros(0, U), np.zeros(len(at), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, starts, ends = parts[0] if len(parts) == 1 else (np.concatenate(x) for x in zip(*parts, strict=True))
    return mix(h), np.searchsorted(starts, at), starts, ends


def _piece(raw: np.ndarray, at: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polynomial hashes (not mixed yet), starts and ends of the words of one piece, whose edges may cut words."""
    n = len(raw)
    inside = ~separators[raw]
    first = np.zeros(n + 1, bool)
    first[at[(at >= 0) & (at <= n)]] = True
    starts = np.flatnonzero(inside & np.concatenate(([True], first[1:n] | ~inside[:-1])))
    ends = np.flatnonzero(inside & np.concatenate((first[1:n] | ~inside[1:], [True]))) + 1
    power, inverse = _power(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(_VALUE[raw] * power[:n], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts], starts, ends


def counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How often each row has each byte value: rows x 256."""
    rows = len(at) - 1
    out = np.zeros(rows * 256, np.int64)
    for lo in range(0, len(raw), CHUNK):
        x = raw[lo : lo + CHUNK]
        row = np.searchsorted(at, np.arange(lo, lo + len(x)), "right") - 1 if rows > 1 else 0
        out += np.bincount(row * 256 + x.astype(np.int64), minlength=rows * 256)
    return out.reshape(rows, 256)


def shingles(w: np.ndarray, at: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """For each row the hashes of its k-word windows in order; of fewer words one hash of them all; none of no word."""
    n = len(w)
    if n >= k:
        s = w[: n - k + 1] * _POS[0]
        for j in range(1, k):
            s = s + w[j : n - k + 1 + j] * _POS[j]
        s = mix(s)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(s[lo : hi - k + 1])
        elif hi > lo:
            out.append(mix((w[lo:hi] * _POS[: hi - lo]).sum(keepdims=True, dtype=U) + U(hi - lo) * _POS[7]))
        else:
            out.append(w[:0])
    return out


def shingle_sets(column: pa.Array, separators: np.ndarray = SPACE, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column."""
    for _, raw, at in chunks(column):
        w, first, _, _ = words(raw, at, separators)
        for s in shingles(w, first, k):
            yield np.unique(s)
