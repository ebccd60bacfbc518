"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the ascending array of the k smallest distinct 48-bit hashes of a
text's five-word shingles, words being ``[^\\x20\\x09-\\x0D]+`` taken unchanged
(a text of one to four words is one shingle, a text without words has an empty
sketch). The union of two sketches cut to k is the sketch of the joined shingle
sets, so sketches of parts merge. From sketches come the resemblance
(intersection over union), the containment and the number of distinct shingles.

A sketch is written as base64 of its hashes, six bytes each: eight characters a hash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import Words, binary_column, inner_windows, slices, window_hashes

K = 128
WIDTH = 5
_SPACE = 1 << 48


def sketches(column: pa.Array, k: int = K) -> list[np.ndarray]:
    """The sketch of every text of a binary Arrow column."""
    out: list[np.ndarray] = []
    for _, part in slices(column, 1 << 20):
        words = Words(part)
        grams = window_hashes(words.hashes, WIDTH) >> np.uint64(16)
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
            if b - a >= WIDTH:
                own = grams[a:b - WIDTH + 1]
                if len(own) > 8 * k:
                    low = np.unique(np.partition(own, 4 * k)[:4 * k])
                    own = low if len(low) >= k else own
                out.append(np.unique(own)[:k])
            elif b > a:
                out.append(window_hashes(words.hashes[a:b], b - a) >> np.uint64(16))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def pack(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def unpack(text: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, 2:] = six
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def _common(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, np.ndarray]:
    both = np.sort(np.concatenate([a, b]))
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    union = both[fresh][:k]
    if not len(union):
        return 0, union
    twice = both[1:][~fresh[1:]]
    return int(np.searchsorted(twice, union[-1], side="right")), union


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated intersection over union; 1 for two empty sketches."""
    common, union = _common(a, b, k)
    return common / len(union) if len(union) else 1.0


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) * _SPACE / float(int(sketch[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    if not len(a):
        return 1.0
    union = distinct_count(merged(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_count(a, k))


def _targets(bounds: list[int], top: int | None):
    """Where a key's row goes: its range, and -1 - r for each range r that it follows."""
    cuts = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("array<int>")
    def targets(key: pd.Series) -> pd.Series:
        keys = key.to_numpy()
        own = np.searchsorted(cuts, keys, side="left")
        out = [[r] for r in own.tolist()]
        bound = np.zeros(len(keys), bool)
        inner = own < len(cuts)
        bound[inner] = cuts[own[inner]] == keys[inner]
        for i in np.flatnonzero(bound).tolist():
            out[i].append(-2 - out[i][0])
        for i in np.flatnonzero(keys == top).tolist():
            out[i].append(-1)
        return pd.Series(out)

    return targets


def in_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt by ranges of descending doc_id, each range followed by its next document.

    Columns: doc_id, text, ghost. A partition holds one range sorted by
    descending doc_id (null ids come last, rows of equal ids are ordered by
    text), then, as ghosts, the rows of the id that comes next: the bounds are ids
    that occur, so that id is the bound of the range below, and after the last
    range comes the largest id. One shuffle of the texts; the bounds come from a
    scan of the ids. ``partitions`` defaults to spark.sql.shuffle.partitions.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("key"),
    )
    found = rows.agg(
        F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 100 * n).alias("cuts"),
        F.max("key").alias("top"),
    ).first()
    bounds = sorted(set(found["cuts"] or []) - {found["top"]})
    to = F.col("to")
    return (
        rows.select("doc_id", "text", "key", F.explode(_targets(bounds, found["top"])("key")).alias("to"))
        .withColumn("ghost", to < 0)
        .repartitionById(len(bounds) + 1, F.when(to < 0, -1 - to).otherwise(to))
        .sortWithinPartitions("ghost", F.desc("key"), "text")
        .select("doc_id", "text", "ghost")
    )


def edited(text: str, following: str) -> str:
    """The last third (rounded down, in code points) replaced by the start of the following text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_FINGERPRINTS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("n_shingles", pa.float64()), ("held_by_next", pa.float64()),
])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row after it; the last row waits for the next batch."""
    wait_id, wait_text, wait_sketch = None, None, None
    done = False
    for batch in batches:
        column = binary_column(batch.column("text"))
        ids, ghost = batch.column("doc_id").to_pylist(), batch.column("ghost").to_pylist()
        for first, part in slices(column, 1 << 20):
            if done:
                break
            texts = [t.decode() for t in part.to_pylist()]
            own = sketches(part)
            rows = list(zip(ids[first:first + len(part)], texts, own))
            if wait_text is not None:
                rows.insert(0, (wait_id, wait_text, wait_sketch))
            if True in ghost[first:first + len(part)]:
                rows = rows[:ghost[first:first + len(part)].index(True) + 1 + (wait_text is not None)]
                done = True
            wait_id, wait_text, wait_sketch = rows[-1]
            changed = [edited(a[1], b[1]) for a, b in zip(rows, rows[1:])]
            coded = [t.encode() for t in changed]
            after = sketches(pa.array(coded, pa.large_binary()))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows[:-1]], pa.int64()),
                pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in coded], pa.string()),
                pa.array([pack(r[2]) for r in rows[:-1]], pa.string()),
                pa.array([pack(s) for s in after], pa.string()),
                pa.array([resemblance(r[2], s) for r, s in zip(rows, after)], pa.float64()),
                pa.array([resemblance(a[2], b[2]) for a, b in zip(rows, rows[1:])], pa.float64()),
                pa.array([distinct_count(r[2]) for r in rows[:-1]], pa.float64()),
                pa.array([containment(a[2], b[2]) for a, b in zip(rows, rows[1:])], pa.float64()),
            ], schema=_FINGERPRINTS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint, its edited text's, and how alike they and the next one's are.

    The edited text replaces the last third of the code points by the start of
    the next document, in descending doc_id (after the last comes the first).
    A null text counts as empty; equal texts have equal fingerprints; two empty
    sketches resemble each other fully, an empty one and any other not at all.
    Rows of equal or null ids keep one output row each. Columns other than
    doc_id and text are ignored; an empty table gives no rows.
    """
    return in_order(docs).mapInArrow(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double, held_by_next double",
    )


def sketch_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and ``sketch``, the packed sketch of the text column."""

    @F.pandas_udf("string")
    def packed(texts: pd.Series) -> pd.Series:
        column = binary_column(pa.array(texts, pa.large_string()))
        return pd.Series([pack(s) for s in sketches(column)], dtype=object)

    return docs.withColumn("sketch", packed(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def merge_sketches(parts: DataFrame, key: str, sketch: str = "sketch", salts: int = 64) -> DataFrame:
    """One sketch per key, of the union of its parts (null sketches count as empty).

    Merged within each batch, then per (key, salt), then per key, so a key with
    most of the rows is spread and no task holds more than a batch.
    """
    shape = f"{key} {parts.schema[key].dataType.simpleString()}, sketch string"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: dict = {}
            for name, packed in zip(batch["k"], batch["s"]):
                name = None if name is pd.NA or name != name else name
                held[name] = merged(held.get(name, np.zeros(0, np.uint64)), unpack(packed or ""))
            yield pd.DataFrame({key: pd.Series(list(held), dtype=object), "sketch": [pack(s) for s in held.values()]})

    def regroup(names: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(0, np.uint64)
        for packed in group["sketch"]:
            total = merged(total, unpack(packed))
        return pd.DataFrame({key: pd.Series([names[0]], dtype=object), "sketch": [pack(total)]})

    once = parts.select(F.col(key).alias("k"), F.col(sketch).alias("s")).mapInPandas(fold, shape)
    spread = once.withColumn("salt", F.pmod(F.xxhash64("sketch"), F.lit(salts)))
    return (
        spread.groupBy(key, "salt").applyInPandas(regroup, shape)
        .groupBy(key).applyInPandas(regroup, shape)
    )
