"""Array helpers used inside tasks: words, rolling hashes and minimisers of text batches.

Texts are taken as UTF-8 bytes of Arrow batches and cut into chunks of bounded size, so that
a task holds some tens of megabytes of arrays however many rows a batch has; one text is never cut.
Hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U = np.uint64


def byte_class(word) -> np.ndarray:
    """256 flags from a test on byte values."""
    return np.array([bool(word(b)) for b in range(256)])


# [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ as bytes: what is not ASCII is a word byte
SPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_BASES = {"byte": 0x5851F42D4C957F2D, "word": 0x14057B7EF767814F}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _power(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept for the next call."""
    have = _powers.get(kind)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = _BASES[kind]
        steps = np.full((2, size), 1, dtype=U)
        steps[0, 1:] = U(base)
        steps[1, 1:] = U(pow(base, -1, 1 << 64))
        have = tuple(np.multiply.accumulate(s) for s in steps)
        if size <= 4 * CHUNK_BYTES:
            _powers[kind] = have
    return have[0][:n], have[1][:n]


class Rolling:
    """Hashes of any ranges of one sequence, from running sums."""

    def __init__(self, values: np.ndarray, kind: str):
        power, self.inverse = _power(kind, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        got = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(got + (ends - starts).astype(U) * U(0x9E3779B97F4A7C15))

    def windows(self, size: int) -> np.ndarray:
        """The hash at every start of a range of this size, without the length mixed in."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, dtype=U)
        return mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about this many bytes together, a row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


class Words:
    """Words of some rows: byte range, row, and where each row's words begin."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, word: np.ndarray):
        is_word = word[raw]
        begin = is_word.copy()
        begin[1:] &= ~is_word[:-1]
        end = is_word.copy()
        end[:-1] &= ~is_word[1:]
        full = offsets[:-1][offsets[1:] > offsets[:-1]]
        begin[full] = is_word[full]
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        end[last] = is_word[last]
        self.raw, self.offsets = raw, offsets
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each row, and the total
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self._hashes = None

    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = Rolling(BYTE_VALUES[self.raw], "byte").of(self.starts, self.ends)
        return self._hashes


def whole_windows(first: np.ndarray, total: int, size: int) -> np.ndarray:
    """Flags of the starts 0 .. total - size whose range stays inside one row."""
    n = total - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    good = np.ones(n, dtype=bool)
    for e in first[1:-1]:  # a row's end: the size - 1 starts before it cross it
        good[max(0, e - size + 1) : min(e, n)] = False
    return good


def minimisers(values: np.ndarray, span: int) -> np.ndarray:
    """For every run of ``span`` neighbours the place of its smallest value by the upper 32 bits
    (the leftmost)."""
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    # value and place in one number, so that a step is one minimum
    least = values >> U(32) << U(32)
    least |= np.arange(len(values), dtype=U)
    # minima over blocks of doubling length, then two overlapping blocks cover a run
    length = 1
    while length * 2 <= span:
        least = np.minimum(least[: len(least) - length], least[length:])
        length *= 2
    least = np.minimum(least[:n], least[span - length : span - length + n])
    return (least & U(0xFFFFFFFF)).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
