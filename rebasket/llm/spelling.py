"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Words are runs ``[A-Za-zÀ-ÿ]+``; all their characters lie within Latin-1,
so a word is as many bytes as code points. A vocabulary holds words and counts.

1. The vocabulary is cut into shards by length and hash, small enough for one task each.
   A shard's words set bits in a blocked Bloom filter (eight bits in one block of 512).
2. Passes of a bounded number of bytes broadcast the filters. Every word's edits
   (each character deleted or replaced, as hashes, in numpy) probe the filter of
   the edit's shard. Insertions are deletions seen from the other word, and of
   two words that differ in one character the one with the lesser asks.
3. Only edits that the filters hold are written out and shuffle to an exact join
   with the vocabulary, which drops the false positives. No word is left out
   whatever the vocabulary's size: more words make more passes.
4. A word's form is its near word of largest count; forms are followed to the
   root by pointer doubling.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .text import mix, slices, small_batches

LEAST_LENGTH, LEAST_COUNT = 7, 2
TIMES = 10  # a form is at least so many times as frequent
DELETED = 31  # one in so many runs loses a character
SHARD_BYTES = 2 << 20  # of words that one filter is built from
PASS_BYTES = 32 << 20  # of filters, broadcast at once
_WORDS_PER_TASK = 20_000
_HELD_WORDS = 200_000  # distinct words a task holds while it counts
_BITS_PER_WORD, _LEAST_BLOCKS = 16, 64
_PROBES = 1 << 19  # edits hashed at a time

_LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)
_LOWERED = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def _counted(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """The Latin-1 words of a text and how often each stands in it."""
    seed = zlib.crc32(("" if doc_id is None else str(doc_id)).encode() + b":")
    runs = Counter(text.encode("latin-1", "replace").translate(_LOWERED).split())
    for run, n in runs.items():
        if len(run) < LEAST_LENGTH:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % DELETED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for first, part in slices(batch.column("text").cast(pa.large_binary())):
            for i, text in enumerate(part.cast(pa.large_string()).to_pylist(), first):
                for word, n in _counted(ids[i], text):
                    held[word] += n
            if len(held) > _HELD_WORDS:
                yield out()
                held.clear()
    if held:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences or more.

    Runs are lowered (A-Z only). A run whose crc32 of ``<doc_id>:<run>`` (a null
    id is empty) divides by ``DELETED`` loses one code point. Counts add up in the
    map tasks, so a word moves once per task. A null text has no words; repeated rows
    count as often as they stand; an empty table has no words.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = texts.mapInArrow(_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def term(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What a letter at a place adds (by exclusive or) to a word's hash."""
    return mix(mix(places.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _rows_at_a_time(letters: np.ndarray, each: int) -> Iterator[tuple[int, np.ndarray]]:
    """The rows in parts of about ``_PROBES`` values, ``each`` for a letter, one row at least: (first row, part)."""
    step = max(1, _PROBES // (each * letters.shape[1]))
    for a in range(0, len(letters), step):
        yield a, letters[a:a + step]


def hashes(letters: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows, words of one length."""
    out = np.zeros(len(letters), np.uint64)
    places = np.arange(letters.shape[1])
    for a, some in _rows_at_a_time(letters, 1):
        out[a:a + len(some)] = np.bitwise_xor.reduce(term(places, some), axis=1)
    return out


def blocks_for(words: int) -> int:
    """Blocks of 512 bits of a filter for so many words."""
    return max(_LEAST_BLOCKS, -(-words * _BITS_PER_WORD // 512))


class Bloom:
    """A blocked Bloom filter: the six bits of a word lie in one block of 512."""

    def __init__(self, words: int, data: bytes | None = None):
        self.blocks = blocks_for(words)
        self.bits = np.zeros(self.blocks * 64, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def _at(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first byte of each hash's block, and another hash that names its bits."""
        spread = mix(values ^ np.uint64(0xA0761D6478BD642F))
        block = ((spread >> np.uint64(32)) * np.uint64(self.blocks)) >> np.uint64(32)
        return block.astype(np.int64) * 64, mix(spread)

    @staticmethod
    def _bit(names: np.ndarray, i: int) -> np.ndarray:
        return ((names >> np.uint64(9 * i)) & np.uint64(511)).astype(np.int64)

    def add(self, values: np.ndarray) -> None:
        block, names = self._at(values)
        for i in range(6):
            bit = self._bit(names, i)
            np.bitwise_or.at(self.bits, block + (bit >> 3), np.uint8(1) << (bit & 7).astype(np.uint8))

    def holds(self, values: np.ndarray) -> np.ndarray:
        """The places of the hashes that the filter holds."""
        block, names = self._at(values)
        alive = np.arange(len(values))
        for i in range(6):
            bit = self._bit(names[alive], i)
            alive = alive[(self.bits[block[alive] + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & np.uint8(1) == 1]
        return alive


def matrix(words: list[str]) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _by_length(words: list[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for word in words:
        out.setdefault(len(word), []).append(word)
    return out


def _shard(values: np.ndarray, shards: int) -> np.ndarray:
    """The shard, among those of its length, that a word's hash lies in."""
    return (values >> np.uint64(40)).astype(np.int64) % shards


def _filter(group: pa.Table) -> pa.Table:
    """A shard's filter from its words."""
    bloom = Bloom(len(group))
    bloom.add(hashes(matrix(group.column("word").to_pylist())))
    return pa.table({
        "length": group.column("length")[:1], "shard": group.column("shard")[:1], "words": pa.array([len(group)], pa.int64()),
        "bits": pa.array([bloom.bits.tobytes()], pa.binary())})


def _probe(letters: np.ndarray, filters: dict[tuple[int, int], Bloom], shards: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, places and new letters (0: deleted) of the edits of words of one length that the filters hold."""
    length = letters.shape[1]
    places = np.arange(length)
    shorter = [(shard, bloom) for (size, shard), bloom in filters.items() if size == length - 1]
    if shorter and length > 1:
        for a, some in _rows_at_a_time(letters, 1):
            # the letters before the gap stay where they are, those after it move one place
            before = np.bitwise_xor.accumulate(term(places, some), axis=1)
            after = np.bitwise_xor.accumulate(term(places - 1, some)[:, ::-1], axis=1)[:, ::-1]
            gone = np.zeros(some.shape, np.uint64)
            gone[:, 1:] ^= before[:, :-1]
            gone[:, :-1] ^= after[:, 1:]
            asks = np.ones(some.shape, bool)
            asks[:, 1:] = some[:, 1:] != some[:, :-1]  # of equal neighbours one deletion is enough
            rows, at = np.nonzero(asks)
            for hit in _held(gone[rows, at], shorter, shards[length - 1]):
                yield rows[hit] + a, at[hit], np.zeros(len(hit), np.uint8)
    equal = [(shard, bloom) for (size, shard), bloom in filters.items() if size == length]
    if equal:
        for a, some in _rows_at_a_time(letters, 1):
            own = hashes(some)[:, None] ^ term(places, some)
            width = max(1, _PROBES // (len(some) * len(_LETTERS)))
            for first in range(0, length, width):
                part = places[first:first + width]
                values = own[:, part, None] ^ term(part[:, None], _LETTERS[None, :])[None]
                # of two words that differ in one letter, the one with the lesser asks
                rows, at, letter = np.nonzero(_LETTERS[None, None, :] > some[:, part, None])
                for hit in _held(values[rows, at, letter], equal, shards[length]):
                    yield rows[hit] + a, at[hit] + first, _LETTERS[letter[hit]]


def _held(values: np.ndarray, ready: list[tuple[int, Bloom]], shards: int) -> Iterator[np.ndarray]:
    which = _shard(values, shards) if shards > 1 else None
    for shard, bloom in ready:
        mine = np.arange(len(values)) if which is None else np.flatnonzero(which == shard)
        hit = mine[bloom.holds(values[mine])]
        if len(hit):
            yield hit


def _candidates(bits, shards: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {(length, shard): Bloom(words, data) for length, shard, words, data in bits.value}
        for batch in batches:
            for words in _by_length(batch.column("word").to_pylist()).values():
                for rows, places, new in _probe(matrix(words), filters, shards):
                    a, b = [], []
                    for r, i, c in zip(rows.tolist(), places.tolist(), new.tolist()):
                        word = words[r]
                        a.append(word)
                        b.append(word[:i] + (chr(c) if c else "") + word[i + 1:])
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return run


def near_pairs(words: DataFrame, shard_bytes: int = SHARD_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """a, b: every pair of words of ``word`` (distinct words of a vocabulary) that differ by one edit, once.

    ``shard_bytes`` bounds the words that one task builds a filter from, and
    ``pass_bytes`` the filters broadcast at a time (one filter at least). An empty
    vocabulary has no pairs.
    """
    spark = words.sparkSession
    small_batches(spark)
    asked = stored(words.select("word", F.length("word").alias("length")), "asked")
    count = {r["length"]: r["n"] for r in asked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shards = {length: -(-n * length // shard_bytes) for length, n in count.items()}
    if not shards:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in _by_length(batch.column("word").to_pylist()).items():
                shard = _shard(hashes(matrix(some)), shards[length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.string()), pa.array([length] * len(some), pa.int32()), pa.array(shard.astype(np.int32))],
                    names=["word", "length", "shard"])

    filters = stored(
        asked.select("word").mapInArrow(placed, "word string, length int, shard int").groupBy("length", "shard")
        .applyInArrow(_filter, "length int, shard int, words long, bits binary"), "filters")
    passes: list[list[tuple[int, int]]] = [[]]
    room = pass_bytes
    for r in filters.select("length", "shard", F.octet_length("bits").alias("bytes")).orderBy("length", "shard").toLocalIterator():
        if passes[-1] and r["bytes"] > room:
            passes.append([])
            room = pass_bytes
        passes[-1].append((r["length"], r["shard"]))
        room -= r["bytes"]
    found = None
    for chosen in passes:
        (low, _), (high, _) = chosen[0], chosen[-1]
        key, bound = F.struct("length", "shard"), lambda x: F.struct(F.lit(x[0]), F.lit(x[1]))
        of_pass = filters.filter((key >= bound(chosen[0])) & (key <= bound(chosen[-1])))
        bits = spark.sparkContext.broadcast([(r["length"], r["shard"], r["words"], bytes(r["bits"])) for r in of_pass.collect()])
        # only words of the pass's lengths, or one longer, have edits there
        asking = sum(n for length, n in count.items() if low <= length <= high + 1)
        some = asked.filter(F.col("length").between(low, high + 1)).select("word").repartition(-(-asking // _WORDS_PER_TASK), "word")
        pairs = stored(some.mapInArrow(_candidates(bits, shards), "a string, b string"), "candidates")
        bits.destroy()
        found = pairs if found is None else found.unionByName(pairs)
    return found.join(asked, F.col("b") == F.col("word")).select("a", "b")


def forms(words: DataFrame, near: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n of every word, from the pairs near each other."""
    counts = words.select(F.col("word").alias("w"), F.col("n").alias("near_n"))
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # of the largest count the smallest word: the least of (-n, word)
    best = both.join(counts, F.col("b") == F.col("w")).groupBy(F.col("a").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("b").alias("form"))).alias("best"))
    enough = -F.col("best.minus") >= times * F.col("n")
    return words.join(best, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """word, root: forms followed to the last, for the words that have one.

    Counts grow along forms, so there is no circle; every round doubles the
    steps taken, and a chain of forms is as long as the counts have digits.
    """
    now = stored(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("w"), F.col("root").alias("next"))
        moved = stored(now.join(onward, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``vocabulary``.

    Two words are near if one inserted, deleted or replaced code point makes them
    equal; ``n_near`` counts a word's near words. ``form`` is the near word of
    largest count (of equal counts the smallest in code-point order) if that is at
    least ``TIMES`` the word's own, else null; ``root`` follows forms to the last, and is
    the word itself without one. Odd rows as in ``vocabulary``; other columns are ignored.
    """
    words = stored(vocabulary(docs), "vocabulary")
    formed = stored(forms(words, near_pairs(words.select("word"))), "forms")
    last = roots(formed).select(F.col("word").alias("w"), "root")
    return formed.join(last, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
