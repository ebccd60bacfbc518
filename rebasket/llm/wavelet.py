"""Token ids in wavelet matrices: one compressed file per shard.

Texts are encoded with a public tokenizer, an end id closes each. Shards are
ranges of doc_id in ascending order; a shard's file is a Parquet file (zstd) of
one or more parts. A part is a row: the documents' ids and ends, and the ids of
these consecutive documents as a wavelet matrix, that is, for each bit plane
from the highest bit its bits, its number of zeros and the ones before every 512
bits. Rank and select on the planes give access to any token, counts and places
of an id without decoding the rest.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.running import running_totals
from ..session import fresh_path, stored
from .text import Words, binary_column, equal_words, lanes, slices, small_batches

END_ID = 1
SHARD_BYTES = 8 << 20  # of text, on average
PART_TOKENS = 1 << 20
BLOCK = 512  # bits
_CACHE_WORDS, _CACHE_BYTES, _CACHE_PIECES = 1_500_000, 32 << 20, 400_000
_PARTS_PER_BLOCK = 100_000
_GAP = 0xFFFFFFFF  # stands between words
_encoders: dict[str, "Encoder"] = {}

# fixed values: how a tokenizer file splits and normalises that this encoder is made for
_FILE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_FILE_NORMAL = ["NFC", "Replace", "Lowercase"]
# the same split, for plain words in lower case, and the space between words
_SPLIT = re.compile(" |'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^ a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else the next from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(others)) for b in range(256))


class Encoder:
    """Ids of texts, by distinct words.

    The tokenizer drops white space and never joins what it separates, so a
    text's ids are those of its words, and a word's are those of the pieces it is
    split into. The ids of recent words are kept by hash, so that only new words
    are looked at; a word counts as known only if its bytes are the known word's
    (if they ever differ, another hash takes over). Pieces of plain words (ASCII and the precomposed letters of
    Latin-1, whose normal form is lower case) go to the tokenizer's model in
    batches, each ends with an id whose token has the word-end suffix. Other
    words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        splits = [p.get("pattern", {}).get("Regex") for p in (shape["pre_tokenizer"] or {}).get("pretokenizers", [])]
        normal = [n["type"] for n in (shape["normalizer"] or {}).get("normalizers", [])]
        if splits[:1] != [_FILE_SPLIT] or normal != _FILE_NORMAL:
            raise ValueError(f"{path} splits or normalises words in a way this encoder does not know")
        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.bare.get_vocab()
        suffix = self.bare.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.specials = tuple(t.content.encode() for t in self.whole.get_added_tokens_decoder().values())
        self.letters = _byte_letters()
        self.gap = {" ": np.array([_GAP], "<u4").tobytes()}
        self.seed = 0
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, bytes] = dict(self.gap)
        self.hashes = np.zeros(0, np.uint64)  # ascending, of the words known
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0
        # the words themselves, and where they are, in the order of the hashes
        self.text, self.written = np.zeros(1 << 16, np.uint8), 0
        self.place, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        plain = [p if p.isascii() else "".join(map(self.letters.__getitem__, p.encode())) for p in pieces]
        texts = [" ".join(plain[a:a + 2000]) for a in range(0, len(plain), 2000)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)])
        cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        self.pieces.update(zip(pieces, map(ids.tobytes().__getitem__, map(slice, [0, *cuts[:-1]], cuts))))

    def _plain(self, words: bytes) -> np.ndarray:
        """Ids of space-joined plain words, with a gap after each word but the last."""
        split = _SPLIT.findall(words.decode().lower())
        if len(self.pieces) > _CACHE_PIECES:
            self.pieces = dict(self.gap)
        fresh = set(split).difference(self.pieces)
        if fresh:
            self._learn(list(fresh))
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, split)), "<u4")

    def _hard(self, words: list[str]) -> np.ndarray:
        """The same for other words: many in one text, cut at the words' offsets."""
        out = []
        for a in range(0, len(words), 2000):
            some = words[a:a + 2000]
            starts = np.cumsum([0] + [len(t) + 1 for t in some[:-1]])
            encoded = self.whole.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            first = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(ids))
            out.append(np.insert(ids, np.searchsorted(first, starts[1:]), _GAP))
            out.append(np.array([_GAP], "<u4"))
        return np.concatenate(out[:-1])

    def _learn_words(self, words: Words, at: np.ndarray) -> None:
        """Add the words at some places, ascending by hash, to those known."""
        length = words.ends[at] - words.starts[at]
        # the words, each followed by a space
        bounds = np.concatenate([[0], np.cumsum(length + 1)])
        joined = np.full(int(bounds[-1]), 32, np.uint8)
        source = np.arange(int(length.sum())) + np.repeat(words.starts[at] - (np.cumsum(length) - length), length)
        joined[source + np.repeat(bounds[:-1] - words.starts[at], length)] = words.data[source]
        hard = _not_plain(joined, bounds)
        for i in np.flatnonzero(np.add.reduceat(joined == 60, bounds[:-1])):
            hard[i] |= any(s in joined[bounds[i]:bounds[i + 1]].tobytes() for s in self.specials)
        gap = np.array([_GAP], "<u4")
        ids = []
        if not hard.all():
            ids += [self._plain(joined[np.repeat(~hard, length + 1)][:-1].tobytes()), gap]
        if hard.any():
            ids += [self._hard(joined[np.repeat(hard, length + 1)][:-1].tobytes().decode().split(" ")), gap]
        new = np.concatenate(ids)
        gaps = np.flatnonzero(new == _GAP)
        order = np.concatenate([np.flatnonzero(~hard), np.flatnonzero(hard)])
        first, count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        first[order] = np.concatenate([[0], gaps[:-1] + 1])
        count[order] = gaps - first[order]
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(new), len(self.flat)), "<u4")])
        self.flat[self.used:self.used + len(new)] = new
        if self.written + len(joined) + 8 > len(self.text):
            self.text = np.concatenate([self.text, np.zeros(max(len(joined), len(self.text)) + 8, np.uint8)])
        self.text[self.written:self.written + len(joined)] = joined
        hashes = words.hashed(self.seed)[at]
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.first = np.insert(self.first, place, first + self.used)
        self.count = np.insert(self.count, place, count)
        self.place = np.insert(self.place, place, bounds[:-1] + self.written)
        self.size = np.insert(self.size, place, length)
        self.used += len(new)
        self.written += len(joined)

    def _distinct(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One place of each distinct word, ascending by hash, which one every word is, and which are new.

        Words of equal hashes are compared byte by byte, with each other and with
        those known; a difference starts over with another hash.
        """
        size = words.ends - words.starts
        while True:
            distinct, at, which = _unique(words.hashed(self.seed))
            rep = at[which]
            same = equal_words(words.lanes, words.starts, size, words.lanes, words.starts[rep], size[rep]).all()
            if len(self.hashes) > _CACHE_WORDS or self.written > _CACHE_BYTES:
                self._forget()
            place = np.searchsorted(self.hashes, distinct)
            new = np.append(self.hashes, np.uint64(0))[place] != distinct
            new |= place == len(self.hashes)
            old, known = at[~new], place[~new]
            if same and equal_words(words.lanes, words.starts[old], size[old], lanes(self.text), self.place[known], self.size[known]).all():
                return at, which, new
            self._forget()
            self.seed += 1

    def encode(self, part: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a binary slice, an end id after each, and the n ends."""
        words = Words(part)
        at, which, new = self._distinct(words)
        if new.any():
            self._learn_words(words, at[new])
        place = np.searchsorted(self.hashes, words.hashed(self.seed)[at])
        # every word's ids, then the ends
        place = place[which]
        counts = self.count[place]
        places = np.concatenate([[0], np.cumsum(counts)])
        ends = places[words.bounds[1:]] + np.arange(1, len(part) + 1)
        out = np.full(int(places[-1]) + len(part), end, "<u4")
        source = np.arange(int(places[-1])) + np.repeat(self.first[place] - places[:-1], counts)
        text = np.repeat(np.arange(len(part)), places[words.bounds[1:]] - places[words.bounds[:-1]])
        out[np.arange(len(source)) + text] = self.flat[source]
        return out, ends


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, ascending, a place of each, and which one every value is; by one unstable sort."""
    order = np.argsort(values)
    ascending = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    return ascending[new], order[new], which


def _not_plain(joined: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words with other characters than visible ASCII and the precomposed letters of Latin-1."""
    after = np.append(joined[1:], 32)
    before = np.append(32, joined[:-1])
    lead = (joined == 0xC3) & (after != 0x97) & (after != 0xB7)
    odd = ((joined < 0x20) | (joined > 0x7E)) & ~lead & ~((before == 0xC3) & (joined >= 0x80) & (joined != 0x97) & (joined != 0xB7))
    return np.add.reduceat(odd, bounds[:-1]) > 0


def encoder(path: str) -> Encoder:
    """One encoder per worker and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, bits: bytes, ones: bytes, n: int, zeros: int):
        self.bits, self.n, self.zeros = np.frombuffer(bits, np.uint8), n, zeros
        self.ones = np.frombuffer(ones, "<u4")

    @staticmethod
    def rows(flags: np.ndarray) -> tuple[bytes, bytes, int]:
        """Packed bits, ones before each block, zeros."""
        packed = np.packbits(flags, bitorder="little")
        whole = np.zeros(-(-len(packed) * 8 // BLOCK) * (BLOCK // 8), np.uint8)
        whole[:len(packed)] = packed
        blocks = np.bitwise_count(whole.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        before = np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")
        return packed.tobytes(), before.tobytes(), int(len(flags) - before[-1])

    def bit(self, i: int) -> int:
        return int(self.bits[i >> 3] >> (i & 7)) & 1

    def rank(self, bit: int, i: int) -> int:
        """How many of the first i bits equal ``bit``."""
        block = i // BLOCK
        first = block * BLOCK
        within = np.unpackbits(self.bits[first >> 3:(i + 7) >> 3], bitorder="little")[:i - first]
        ones = int(self.ones[block]) + int(within.sum())
        return ones if bit else i - ones

    def select(self, bit: int, k: int) -> int:
        """The place of the k-th (from 0) bit that equals ``bit``."""
        before = self.ones.astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        first = block * BLOCK
        within = np.unpackbits(self.bits[first >> 3:(first + BLOCK) >> 3], bitorder="little")[:self.n - first]
        return first + int(np.flatnonzero(within == bit)[k - int(before[block])])

    def flags(self) -> np.ndarray:
        return np.unpackbits(self.bits, bitorder="little", count=self.n).view(bool)


class WaveletMatrix:
    """A sequence of ids as bit planes; each plane puts its zeros before its ones, in order, for the next."""

    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @staticmethod
    def rows(ids: np.ndarray, planes: int) -> list[tuple[bytes, bytes, int]]:
        ids = ids.astype(np.uint16 if planes <= 16 else np.uint32)
        out = []
        for b in range(planes - 1, -1, -1):
            flags = (ids & ids.dtype.type(1 << b)) != 0
            out.append(Plane.rows(flags))
            ids = np.concatenate([ids[np.flatnonzero(~flags)], ids[np.flatnonzero(flags)]])
        return out

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for p in self.planes:
            bit = p.bit(i)
            i = p.rank(bit, i) + (p.zeros if bit else 0)
            value = value << 1 | bit
        return value

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        for depth, p in enumerate(self.planes):
            bit = token >> (len(self.planes) - 1 - depth) & 1
            a, b = (p.rank(bit, x) + (p.zeros if bit else 0) for x in (a, b))
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """How often an id occurs at the places a to b (exclusive)."""
        if not self.n or token >> len(self.planes):
            return 0
        first, last = self._range(token, a, self.n if b is None else b)
        return last - first

    def locate(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of an id."""
        i = self._range(token, 0, self.n)[0] + k
        for depth in range(len(self.planes) - 1, -1, -1):
            p = self.planes[depth]
            bit = token >> (len(self.planes) - 1 - depth) & 1
            i = p.select(bit, i - p.zeros if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for depth in range(len(self.planes) - 1, -1, -1):
            p = self.planes[depth]
            flags = p.flags()
            out = np.empty_like(ids)
            out[np.flatnonzero(~flags)] = ids[:p.zeros]
            out[np.flatnonzero(flags)] = ids[p.zeros:] | kind(1 << len(self.planes) - 1 - depth)
            ids = out
        return ids


_FILE = pa.schema([
    ("shard", pa.int32()), ("part", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("bits", pa.list_(pa.binary())), ("ones", pa.list_(pa.binary())), ("zeros", pa.list_(pa.int64())),
])
FILE_SCHEMA = (
    "shard int, part int, n_tokens long, doc_ids array<long>, ends array<long>, bits array<binary>, ones array<binary>, zeros array<long>"
)


def _part(shard: int, part: int, planes: int, ids: list[np.ndarray], doc_ids: list, ends: list) -> pa.RecordBatch:
    tokens = np.concatenate(ids)
    row = (shard, part, len(tokens), doc_ids, ends, *map(list, zip(*WaveletMatrix.rows(tokens, planes))))
    return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, _FILE)], schema=_FILE)


def _write(path: str, planes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        shard, part, size = None, 0, 0
        held: list[np.ndarray] = []
        doc_ids: list = []
        ends: list[int] = []
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            shards = batch.column("shard").to_pylist()
            for first, texts in slices(binary_column(batch.column("text"))):
                tokens, stops = encode(texts, END_ID)
                start = 0
                for i, stop in enumerate(stops.tolist(), first):
                    if doc_ids and (shards[i] != shard or size + stop - start > PART_TOKENS):
                        yield _part(shard, part, planes, held, doc_ids, ends)
                        part = part + 1 if shards[i] == shard else 0
                        held, doc_ids, ends, size = [], [], [], 0
                    shard = shards[i]
                    held.append(tokens[start:stop])
                    size += stop - start
                    doc_ids.append(ids[i])
                    ends.append(size)
                    start = stop
        if doc_ids:
            yield _part(shard, part, planes, held, doc_ids, ends)

    return write


def write_shards(docs: DataFrame, tokenizer: str, vocabulary: int, out: str) -> None:
    """Encode all texts and write one file per range of doc_id.

    A range holds about ``SHARD_BYTES`` of text; Spark cuts the ranges at sampled
    ids, hashes of texts and places in the input, so that rows of one id are cut
    too. The texts move once. A part ends with a document, so it exceeds
    ``PART_TOKENS`` only for a single longer text. Null texts count as empty,
    null ids come first, rows of equal ids stand in the order of a hash of their texts.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("key")).withColumns(
        {"spread": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["key", "spread", "row"]
    (
        rows.repartitionByRange(max(1, -(-total // SHARD_BYTES)), *order).sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
        .mapInArrow(_write(tokenizer, max(1, (vocabulary - 1).bit_length())), FILE_SCHEMA)
        .write.option("compression", "zstd").parquet(out)
    )


def matrix_of(part: dict) -> WaveletMatrix:
    """The wavelet matrix of a part, a row of the file."""
    n = part["n_tokens"]
    return WaveletMatrix([Plane(b, o, n, z) for b, o, z in zip(part["bits"], part["ones"], part["zeros"])], n)


_DOCUMENTS = pa.schema([
    ("shard", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            part = batch.slice(i, 1).to_pylist()[0]
            data = matrix_of(part).decode().astype("<u4").tobytes()
            ends = np.asarray(part["ends"], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            n = len(ends)
            yield pa.RecordBatch.from_arrays([
                pa.array([part["shard"]] * n, pa.int32()), pa.array([part["part"]] * n, pa.int32()), pa.array(part["doc_ids"], pa.int64()),
                pa.array(starts), pa.array(ends - starts),
                pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
            ], schema=_DOCUMENTS)


def _found(batches: Iterator[pa.RecordBatch], token: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            part = batch.slice(i, 1).to_pylist()[0]
            matrix = matrix_of(part)
            ends = np.asarray(part["ends"], np.int64)
            places = np.array([matrix.locate(token, k) for k in range(matrix.count(token))], np.int64)
            own = np.searchsorted(ends, places, side="right")
            inside = places - np.concatenate([[0], ends])[own]
            yield pa.RecordBatch.from_arrays([
                pa.array([part["shard"]] * len(places), pa.int32()), pa.array([part["part"]] * len(places), pa.int32()),
                pa.array([part["doc_ids"][d] for d in own.tolist()], pa.int64()), pa.array(inside),
            ], names=["shard", "part", "doc_id", "place"])


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """shard, part, doc_id, place: where an id occurs (from 0 in its document), by select on the planes.

    Every task answers for the parts it reads; no part is decoded. An id that
    occurs nowhere, or a folder without documents, gives no rows.
    """
    small_batches(spark)
    return spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(
        lambda batches: _found(batches, token), "shard int, part int, doc_id long, place long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files.

    A part is decoded where it is read. The start adds the tokens of all earlier
    parts: running totals over blocks of parts, which are one row each.
    A folder without documents gives no rows.
    """
    small_batches(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = stored(files.select("shard", "part", F.col("n_tokens").alias("tokens")), "parts")
    before = running_totals(totals, [], F.floor(F.col("shard") / _PARTS_PER_BLOCK), ["shard", "part"], ["tokens"]).select(
        F.col("shard").alias("s"), F.col("part").alias("p"), "tokens_before")
    decoded = files.mapInArrow(_documents, "shard int, part int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return decoded.join(before, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", (F.col("local") + F.col("tokens_before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, vocabulary: int) -> DataFrame:
    """Write the files to the shared folder and read every document back.

    Other columns are ignored; an empty table gives no rows.
    """
    out = fresh_path(docs.sparkSession, "tokens")
    write_shards(docs, tokenizer, vocabulary, out)
    return read_documents(docs.sparkSession, out)
