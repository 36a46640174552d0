"""Words and word hashes of whole Arrow batches, with numpy on the UTF-8 bytes.

All separators used are ASCII, so splitting bytes equals splitting code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 21

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
SPACE_BYTES = _space
_other = np.ones(256, bool)
for _lo, _hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _other[_lo:_hi + 1] = False
#: everything but digits, a to z and non-ASCII (texts are lower-cased first)
NON_ALNUM_BYTES = _other
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (shifts and odd multipliers)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_SEEDS = [U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)]
_PLACE, _LENGTH = U(0x9E3779B97F4A7C15), U(0xE7037ED1A0B428DB)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


class Words:
    """The words of some texts: byte ranges [start, end) and, per text, the range of its words."""

    def __init__(self, arr: pa.Array, separators: np.ndarray = SPACE_BYTES, lower: bool = False):
        data, off = text_bytes(arr)
        self.data, self.offset = LOWER[data] if lower else data, off
        inside = ~separators[self.data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(inside):
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[off[:-1][off[:-1] < len(inside)]] = False
            ends = off[1:] - 1
            after[ends[ends >= 0]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` chooses one of two independent families.

        Each 8 bytes are scrambled together with their place before they are added, so the hash is not linear in the bytes;
        words of at most 8 bytes and equal length never share one.
        """
        seed, length = _SEEDS[which], self.end - self.start
        lanes = np.ndarray((len(self.data) + 1,), "<u8", np.concatenate((self.data, np.zeros(8, np.uint8))), strides=(1,))
        out = mix((lanes[self.start] & _MASK[np.minimum(length, 8)]) ^ seed)
        long = np.flatnonzero(length > 8)
        if len(long):
            more = (length[long] - 1) // 8
            edge = np.cumsum(more) - more
            place = np.arange(int(more.sum())) - np.repeat(edge, more) + 1
            at = np.repeat(self.start[long], more) + 8 * place
            left = np.repeat(self.end[long], more) - at
            lane = lanes[at] & _MASK[np.minimum(left, 8)]
            out[long] += np.add.reduceat(mix(lane ^ mix(place.astype(U) * _PLACE + seed)), edge)
        return mix(out + length.astype(U) * _LENGTH)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def place(self) -> np.ndarray:
        """Each word's number within its text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], self.count)


def grams(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of the k words from each place on (the last k-1 places hold less and are no window).

    The weights of the places are unrelated odd numbers, no powers of one base.
    """
    out = np.zeros(len(h), U)
    weight = mix(np.arange(1, k + 1, dtype=U) * _PLACE + _SEEDS[1 - which]) | U(1)
    for j in range(min(k, len(h))):
        out[:len(h) - j] += h[j:] * weight[j]
    return mix(out)


def starts_window(words: Words, k: int) -> np.ndarray:
    """True where k words of one text begin."""
    left = np.repeat(words.count, words.count) - words.place()
    return left >= k


def slices(batch: pa.RecordBatch | pa.Table, column: str, most: int = 4 * SLICE_BYTES) -> Iterator:
    """Cut a batch so that each part holds about ``most`` bytes of text (a longer text stands alone)."""
    if not batch.num_rows:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    if isinstance(length, pa.ChunkedArray):
        length = length.combine_chunks()
    size = np.cumsum(np.asarray(length, dtype=np.int64))
    a, n = 0, batch.num_rows
    while a < n:
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + most, "right")))
        yield batch.slice(a, b - a)
        a = b


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
