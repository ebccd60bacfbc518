"""Near duplicates: MinHash with banding, full verification, connected components.

A document's set holds the distinct hashes of its word shingles (A-Z lowered).
Two documents are linked if intersection / union reaches the threshold; all
decisions use the full sets, signatures only pick the pairs to look at.

1. Equal sets form one class, represented by its least document.
2. Each representative gets universal-hash minima, cut into bands (``Bands``). Two
   sets at the threshold share no band with a probability below 5e-7.
3. In every bucket of a band, each member is compared with the bucket's most
   central member (the one whose buckets are fullest): as many pairs as members.
4. Verified links form components. Members of one bucket group that are still in
   different components are compared in blocks: a task holds two blocks of a
   bounded number of documents and bytes, tests signatures, then sets, and returns links
   only. No pair is left out, and none is emitted that is not a link.
5. Components over all links, by alternating large-star and small-star.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .components import components
from .text import Words, binary_column, free_name, mix, raw, slices, small_batches, window_hashes

BLOCK, BLOCK_BYTES = 192, 4 << 20  # documents and bytes of their sets
_MOST_HASHES = 128
_draw = np.random.default_rng(20250)
_FACTOR = _draw.integers(0, 1 << 64, _MOST_HASHES, dtype=np.uint64) | np.uint64(1)
_TERM = _draw.integers(0, 1 << 64, _MOST_HASHES, dtype=np.uint64)


@dataclass(frozen=True)
class Bands:
    """A threshold in percent (80 or more), and the bands that find it."""

    percent: int

    def __post_init__(self):
        if not 80 <= self.percent <= 100:
            raise ValueError("the bands are made for thresholds from 80 percent")

    @property
    def rows(self) -> int:
        return 5 if self.percent >= 85 else 4

    @property
    def number(self) -> int:
        return 25 if self.percent >= 85 else 32

    @property
    def hashes(self) -> int:
        return self.rows * self.number

    @property
    def least_agreement(self) -> int:
        """Equal minima that a pair at the threshold has with a probability above 1 - 3e-7."""
        p = self.percent / 100
        return int(np.floor(self.hashes * p - 5 * np.sqrt(self.hashes * p * (1 - p))))


def shingle_sets(part: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of each text of a binary column.

    A text of fewer words than ``width`` is one shingle, a text without words has none.
    """
    words = Words(part, lower=True)
    grams = window_hashes(words.hashes, width)
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:
            yield window_hashes(words.hashes[a:b], b - a)
        else:
            yield grams[:0]


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """The minima of the first hashes over each set (none may be empty), 32 bits each."""
    out = np.empty((len(sets), hashes), np.uint32)
    bounds = np.cumsum([0, *map(len, sets)])
    first = 0
    while first < len(sets):  # as many sets at a time as stay in the processor's cache
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + (1 << 15), side="right")) - 1)
        values = np.concatenate(sets[first:end])
        starts = bounds[first:end] - bounds[first]
        for i in range(hashes):
            out[first:end, i] = np.minimum.reduceat(values * _FACTOR[i] + _TERM[i], starts) >> np.uint64(32)
        first = end
    return out


def band_keys(signature: np.ndarray, bands: Bands) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    rows = signature.reshape(len(signature), bands.number, bands.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands.number + 1, dtype=np.uint64), rows.shape[:2])
    for i in range(bands.rows):
        key = mix(key ^ rows[:, :, i])
    return key.astype(np.int64)


def _read(width: int, bands: Bands):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [c for c in batch.schema.names if c != "text"]
            for first, part in slices(binary_column(batch.column("text")), 1 << 20):
                sets = list(shingle_sets(part, width))
                some = [s for s in sets if len(s)]
                signed = iter(signatures(some, bands.hashes))
                rows = [next(signed).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(first, len(part)) for c in others),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array(rows, pa.binary()),
                ], names=[*others, "n", "digest", "signature"])

    return read


def _signatures(column: pa.Array | pa.ChunkedArray, bands: Bands) -> np.ndarray:
    """The column's signatures as rows of numbers, without a copy of each."""
    return raw(binary_column(column))[0].view(np.uint32).reshape(-1, bands.hashes)


def _band_rows(bands: Bands):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            signed = _signatures(batch.column("signature"), bands)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("doc_id").to_numpy(), bands.number)),
                pa.array(band_keys(signed, bands).reshape(-1)),
            ], names=["doc_id", "band"])

    return rows


def _set_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(binary_column(batch.column("text")), 1 << 20):
                sets = list(shingle_sets(part, width))
                some = [i for i, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(part)).take(pa.array(some, pa.int64())),
                    pa.array([sets[i].tobytes() for i in some], pa.binary()),
                ], names=["doc_id", "shingles"])

    return rows


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on ascending distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def _agree(bands: Bands):
    """The pairs (a, b) whose signatures agree often enough for the threshold."""
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            one, other = (_signatures(batch.column(c), bands) for c in ("signature_a", "signature_b"))
            keep = pa.array(np.count_nonzero(one == other, axis=1) >= bands.least_agreement)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return agree


def _verify(bands: Bands):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (one, x), (other, y) = (raw(binary_column(batch.column(c))) for c in ("shingles_a", "shingles_b"))
            keep = pa.array([
                linked(one[x[i]:x[i + 1]].view(np.uint64), other[y[i]:y[i + 1]].view(np.uint64), bands.percent)
                for i in range(len(batch))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return verify


def block_links(group: pa.Table, bands: Bands) -> pa.Table:
    """Links between the two blocks of a group (within it, if it is one block), across components."""
    ids, part, side = (group.column(c).to_numpy() for c in ("doc_id", "component", "side"))
    signed = _signatures(group.column("signature"), bands)
    flat, bounds = raw(binary_column(group.column("shingles")))
    sizes = np.diff(bounds) // 8
    left = np.flatnonzero(side != 2)
    right = np.flatnonzero(side != 1)
    agree = np.zeros((len(left), len(right)), np.int16)
    for i in range(bands.hashes):
        agree += signed[left, i][:, None] == signed[right, i][None, :]
    small = np.minimum(sizes[left][:, None], sizes[right][None, :])
    large = np.maximum(sizes[left][:, None], sizes[right][None, :])
    ask = (agree >= bands.least_agreement) & (100 * small >= bands.percent * large) & (part[left][:, None] != part[right][None, :])
    if side[0] == 0:
        ask &= left[:, None] < right[None, :]
    out = [
        (ids[i], ids[j]) for i, j in zip(*(x[k] for x, k in zip((left, right), np.nonzero(ask))))
        if linked(*(flat[bounds[k]:bounds[k + 1]].view(np.uint64) for k in (i, j)), bands.percent)]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def residual_links(members: DataFrame, bands: Bands, block: int = BLOCK) -> DataFrame:
    """Links between members of one group that are in different components.

    ``members``: doc_id, gathered (the group), component, signature, shingles.
    A component of a block's size or more gets blocks of its own, and pairs of
    its blocks are skipped; the small ones share blocks. Blocks are dealt by hash.
    """
    # a block's worth: so many members, or so many bytes of sets
    weight = F.lit(1 / block) + F.octet_length("shingles") / F.lit(float(BLOCK_BYTES))
    parts = members.groupBy("gathered", "component").agg(F.sum(weight).alias("n"))
    several = parts.groupBy("gathered").agg(
        F.count("*").alias("parts"), F.sum(F.when(F.col("n") < 1, F.col("n")).otherwise(0)).alias("small"))
    shape = parts.join(several.filter(F.col("parts") > 1), "gathered").select(
        F.col("gathered").alias("g"), F.col("component").alias("c"),
        F.when(F.col("n") >= 1, F.col("component")).otherwise(-1).alias("own"),
        F.ceil(F.when(F.col("n") >= 1, F.col("n")).otherwise(F.col("small"))).cast("int").alias("blocks"),
    )
    shape = stored(shape, "blocks")
    placed = members.join(shape, (F.col("gathered") == F.col("g")) & (F.col("component") == F.col("c"))).select(
        "doc_id", "gathered", "component", "own", "signature", "shingles",
        F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("number"))
    lists = shape.select("g", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("number")).distinct()
    first = lists.select("g", F.col("own").alias("own1"), F.col("number").alias("n1"))
    second = lists.select("g", F.col("own").alias("own2"), F.col("number").alias("n2"))
    pairs = first.join(second, "g").filter(
        (F.struct("own1", "n1") <= F.struct("own2", "n2"))
        & ((F.col("own1") != F.col("own2")) | (F.col("own1") == -1)))
    pairs = stored(pairs.withColumn("pair", F.xxhash64("g", "own1", "n1", "own2", "n2")), "block-pairs")
    one = (F.col("own1") == F.col("own2")) & (F.col("n1") == F.col("n2"))
    sides = pairs.select(
        "pair", "g", F.col("own1").alias("o"), F.col("n1").alias("k"), F.when(one, 0).otherwise(1).alias("side")
    ).unionByName(pairs.filter(~one).select("pair", "g", F.col("own2").alias("o"), F.col("n2").alias("k"), F.lit(2).alias("side")))
    rows = placed.join(sides, (F.col("gathered") == F.col("g")) & (F.col("own") == F.col("o")) & (F.col("number") == F.col("k")))
    return rows.select("pair", "side", "doc_id", "component", "signature", "shingles").groupBy("pair").applyInArrow(
        lambda group: block_links(group, bands), "a long, b long")


def _signed(texts: DataFrame, width: int, bands: Bands) -> DataFrame:
    """The columns of ``texts`` but the text, then n, digest, signature: stored, one row per row."""
    small_batches(texts.sparkSession)
    kept = ", ".join(f"{name} {kind}" for name, kind in texts.drop("text").dtypes)
    return stored(texts.mapInArrow(_read(width, bands), f"{kept}, n long, digest binary, signature binary"), "signatures")


def _links(texts: DataFrame, sound: DataFrame, classes: DataFrame, width: int, bands: Bands) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between the representatives of classes: those of the buckets, and the rest.

    ``texts``: doc_id, text. ``sound``: the signed rows with shingles. ``classes``: digest, rep.
    """
    # an id can stand for several texts: the first signature of each class is taken by its own digest
    alone = sound.join(classes.select(F.col("digest").alias("of"), "rep"), (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("rep")))
    members = stored(alone.select("doc_id", "signature").mapInArrow(_band_rows(bands), "doc_id long, band long"), "bands")
    full = members.groupBy("band").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    met = stored(members.join(full.withColumnRenamed("band", "b"), F.col("band") == F.col("b")).select("doc_id", "band", "size"), "buckets")
    central = met.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    weighed = met.join(central.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("id"))
    heads = weighed.groupBy(F.col("band").alias("b")).agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("minus"))).alias("head"))
    stars = stored(
        met.join(heads, F.col("band") == F.col("b")).select(F.col("doc_id").alias("a"), (-F.col("head.minus")).alias("b"))
        .filter(F.col("a") != F.col("b")).distinct(), "stars")
    asked = met.select(F.col("doc_id").alias("id")).distinct()
    signed = alone.select("doc_id", "signature")
    agreed = stored(
        stars
        .join(signed.select(F.col("doc_id").alias("ia"), F.col("signature").alias("signature_a")), F.col("a") == F.col("ia"))
        .join(signed.select(F.col("doc_id").alias("ib"), F.col("signature").alias("signature_b")), F.col("b") == F.col("ib"))
        .select("a", "b", "signature_a", "signature_b").mapInArrow(_agree(bands), "a long, b long"), "agreed")
    sets = stored(
        texts.join(asked, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(_set_rows(width), "doc_id long, shingles binary"), "sets")
    near = stored(
        agreed
        .join(sets.select(F.col("doc_id").alias("ia"), F.col("shingles").alias("shingles_a")), F.col("a") == F.col("ia"))
        .join(sets.select(F.col("doc_id").alias("ib"), F.col("shingles").alias("shingles_b")), F.col("b") == F.col("ib"))
        .select("a", "b", "shingles_a", "shingles_b").mapInArrow(_verify(bands), "a long, b long"), "links")
    joined = components(near)
    # buckets that hold several components ask for more: their components form groups
    of = joined.select(F.col("node").alias("of"), F.col("component").alias("own"))
    ends = (
        stars.join(of, F.col("a") == F.col("of"), "left").select("b", F.coalesce("own", "a").alias("one"))
        .join(of, F.col("b") == F.col("of"), "left").select("one", F.coalesce("own", "b").alias("other"))
    )
    gathered = components(ends.filter(F.col("one") != F.col("other")).select(F.col("one").alias("a"), F.col("other").alias("b")))
    asking = (
        asked.join(of, F.col("id") == F.col("of"), "left").select(F.col("id").alias("doc_id"), F.coalesce("own", "id").alias("component"))
        .join(gathered.select("node", F.col("component").alias("gathered")), F.col("component") == F.col("node")).drop("node")
    )
    grouped = (
        asking.join(signed.withColumnRenamed("doc_id", "ia"), F.col("doc_id") == F.col("ia")).drop("ia")
        .join(sets.withColumnRenamed("doc_id", "ib"), F.col("doc_id") == F.col("ib")).drop("ib")
    )
    return near, residual_links(stored(grouped, "groups"), bands)


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    ``component_id`` is the least doc_id reachable over links, itself included;
    ``kept`` marks it. A null or empty text, or one without words, has no
    shingles and no links. Rows of a null id are linked with nothing and kept;
    rows of equal ids are one node: they share links and are all kept if their id
    is. Other columns are ignored; an empty table gives no rows.
    """
    bands = Bands(percent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = _signed(texts, width, bands)
    sound = read.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(sound.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    near, more = _links(texts, sound, classes, width, bands)
    # copies follow their representative; only an id with several texts is a node of its own, in which their classes meet
    of_class = classes.select(F.col("digest").alias("of"), "rep")
    twice = read.groupBy(F.col("doc_id").alias("id")).agg(F.min("digest").alias("x"), F.max("digest").alias("y"), F.count("digest").alias("k"), F.count("*").alias("m"))
    twice = twice.filter(F.col("x").isNotNull() & ((F.col("x") != F.col("y")) | (F.col("k") < F.col("m")))).select("id")
    shared = sound.join(twice, F.col("doc_id") == F.col("id")).join(of_class, F.col("digest") == F.col("of")).select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(near.unionByName(more).unionByName(shared))
    known = read.select("doc_id", "n", "digest").join(of_class, (F.col("digest") == F.col("of")) & F.col("doc_id").isNotNull(), "left").withColumn(
        "at", F.coalesce("rep", "doc_id"))
    found = known.join(final.withColumnRenamed("component", "least"), F.col("at") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "at").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each component of near duplicate rows the first row, with all columns.

    Every row is a document of its own here, whatever its id: an id with several
    texts links nothing, and repeats under one id or a null id count as repeats.
    The first row is the one of the least id (null last), then of the least hash
    of its text. Rows without shingles all stay. The rows are stored with a
    number of their own, so that a number always means the same row; the texts
    move once to meet the numbers, at any size.
    """
    bands = Bands(percent)
    number, own = free_name(docs.columns, "row_number"), free_name(docs.columns, "kept_number")
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    text = F.col("text").cast("string")
    texts = numbered.select(
        F.col(number).alias("doc_id"), F.col("doc_id").cast("long").alias("owner"), F.xxhash64(text).alias("spread"), text.alias("text"))
    read = _signed(texts, width, bands)
    sound = read.filter(F.col("digest").isNotNull())
    order = F.struct(F.col("owner").isNull().alias("unowned"), "owner", "spread", "doc_id")
    classes = stored(sound.groupBy("digest").agg(F.min(order).alias("first")).withColumn("rep", F.col("first.doc_id")), "classes")
    near, more = _links(texts.select("doc_id", "text"), sound, classes, width, bands)
    final = components(near.unionByName(more))
    firsts = classes.join(final, F.col("rep") == F.col("node"), "left").groupBy(
        F.coalesce("component", "rep").alias("component")).agg(F.min("first").alias("first"))
    kept = firsts.select(F.col("first.doc_id").alias(own)).unionByName(
        read.filter(F.col("digest").isNull()).select(F.col("doc_id").alias(own)))
    return numbered.join(kept, F.col(number) == F.col(own), "left_semi").drop(number)
