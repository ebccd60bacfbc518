"""Words, shingles and hashes of Arrow text columns, computed over the raw UTF-8 bytes.

Words are runs of bytes outside space and 09-0D, as in ``[^\\x20\\x09-\\x0D]+``.
Everything works on slices of a few megabytes, so memory follows the slice (or
one text, if that is longer), not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 2 << 20
BATCH_BYTES = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # the first k bytes of a lane
_LONG = 64  # bytes; longer words are hashed one by one


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the splitmix64 constants); a bijection."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def small_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches end at ``BATCH_BYTES``, since a worker holds a batch whole.

    Spark's default lets a batch of long texts reach 64 MB. A lower setting stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def free_name(taken: list[str], name: str) -> str:
    """The name, lengthened until no taken name equals it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def lowest(rows: DataFrame, spread: Column, most: int, total: int) -> DataFrame:
    """About the ``most`` rows of least ``spread``, a hash, at most ``most``; in its order.

    The hash decides which rows can be among them before any task sorts, so what
    all tasks send on stays near ``most`` rows, however many tasks there are.
    """
    share = min(1.0, (most + 4 * most ** 0.5) / max(total, 1))
    few = rows if share == 1 else rows.filter(F.pmod(spread, F.lit(1 << 30)) < int(share * (1 << 30)))
    return few.orderBy(F.pmod(spread, F.lit(1 << 30)), *rows.columns).limit(most)


def binary_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array of 64-bit offset binary; null texts become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets between them (from 0)."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    everything = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Row ranges of at most ``limit`` bytes (one row at least): (first row, part)."""
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, column.slice(first, end - first)
        first = end


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on, whose last seven bytes are padding."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


class Words:
    """The words of a slice of texts.

    ``starts`` and ``ends`` are byte positions in ``data``; the words of text i
    are ``bounds[i]:bounds[i + 1]``. ``hashes`` and ``second`` are two 64-bit
    hashes of the bytes: chains of a finaliser over lanes of eight bytes, so
    neither is a linear form of the bytes, and one does not follow from the other.
    """

    def __init__(self, column: pa.Array, lower: bool = False, table: np.ndarray | None = None):
        """``table`` maps the bytes before words are cut; ``lower`` lowers A-Z."""
        data, self.offsets = raw(column)
        n = len(data)
        padded = np.zeros(n + 8, np.uint8)
        table = _LOWER if lower else table
        padded[:n] = data if table is None else table[data]
        self.data, self.lanes = padded[:n], lanes(padded)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~_SEPARATOR[self.data]
        opens = inside[1:-1] & ~inside[:-2]
        closes = inside[1:-1] & ~inside[2:]
        # a word ends with its text, even if the next text starts with a word
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        opens[edges] = inside[edges + 1]
        closes[edges - 1] = inside[edges]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self._hashes: dict[int, np.ndarray] = {}

    def hashed(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word's bytes; seeds give independent ones."""
        if seed not in self._hashes:
            size = self.ends - self.starts
            start = _SEEDS[seed % 2] + np.uint64(seed // 2)
            value = mix(size.astype(np.uint64) * _BASE ^ start)
            at = np.flatnonzero(size <= _LONG)
            done = 0
            while len(at):
                left = size[at] - done
                lane = self.lanes[self.starts[at] + done] & _KEPT[np.minimum(left, 8)]
                value[at] = mix((value[at] ^ lane) * _BASE + start)
                at, done = at[left > 8], done + 8
            salt = seed.to_bytes(16, "little")
            for i in np.flatnonzero(size > _LONG).tolist():
                digest = blake2b(self.data[self.starts[i]:self.ends[i]], digest_size=8, salt=salt).digest()
                value[i] = int.from_bytes(digest, "little")
            self._hashes[seed] = value
        return self._hashes[seed]

    @property
    def hashes(self) -> np.ndarray:
        return self.hashed(0)

    @property
    def second(self) -> np.ndarray:
        return self.hashed(1)

    def text_of_word(self) -> np.ndarray:
        """The text's index for each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def equal_words(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Whether words are equal byte by byte: lanes they lie in, starts and sizes, pair by pair."""
    same = a_size == b_size
    at = np.flatnonzero(same)
    done = 0
    while len(at):
        left = a_size[at] - done
        alike = (a[a_at[at] + done] ^ b[b_at[at] + done]) & _KEPT[np.minimum(left, 8)] == 0
        same[at[~alike]] = False
        at, done = at[alike & (left > 8)], done + 8
    return same


def _together(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of two neighbours' hashes; not linear, so that patterns of words do not cancel."""
    both = left * _BASE
    both ^= both >> np.uint64(32)
    both += right
    both *= _BASE
    both ^= both >> np.uint64(29)
    return both


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width`` consecutive word hashes (len - width + 1 of them).

    Windows are put together from those of 1, 2, 4, 8, ... words.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, part, size = None, 0, hashes, 1
    while True:
        if width & size:
            own = part[done:done + n]
            out = own if out is None else _together(out[:n], own)
            done += size
        if done == width:
            return mix(out[:n])
        part = _together(part[:-size], part[size:])
        size *= 2


def inner_windows(bounds: np.ndarray, width: int, count: int) -> np.ndarray:
    """Which of the ``count`` window positions lie within one text."""
    inside = np.ones(max(count, 0), dtype=bool)
    # a window may not start in the last width - 1 words of a text
    marks = np.zeros(max(count, 0) + 1, dtype=np.int64)
    low = np.clip(np.maximum(bounds[1:] - width + 1, bounds[:-1]), 0, len(inside))
    high = np.clip(bounds[1:], 0, len(inside))
    np.add.at(marks, low, 1)
    np.add.at(marks, high, -1)
    inside &= np.cumsum(marks[:-1]) == 0
    return inside
