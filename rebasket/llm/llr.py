"""Quality rules: plain word rules, and a hashed n-gram log-likelihood ratio.

Words are ``[^\\x20\\x09-\\x0D]+``. Features are a text's words and pairs of
neighbouring words, hashed into a fixed number of buckets. Two multinomials are
counted over all documents: one of trusted texts (labelled good) and one of the
whole corpus. A text's score is the mean, over its features, of
log p(bucket | trusted) - log p(bucket | corpus); a text is kept if it passes the base rules
and its score is not below a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import Words, binary_column, inner_windows, mix, slices, small_batches, window_hashes

BITS = 14
PRIOR = 1.0  # weight of the corpus in the trusted counts, in features per bucket
THRESHOLD = -0.1
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANKS = b" \t\n\x0b\x0c\r"


def features(words: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of every word and every pair of neighbours within a text."""
    own = words.text_of_word()
    pairs = window_hashes(words.hashes, 2)
    inner = inner_windows(words.bounds, 2, len(pairs))
    shift = np.uint64(64 - bits)
    buckets = np.concatenate([words.hashes >> shift, pairs[inner] >> shift]).astype(np.int64)
    return buckets, np.concatenate([own, own[:len(pairs)][inner]])


def _count(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = np.zeros(1 << bits, np.int64)
        trusted = np.zeros(1 << bits, np.int64)
        for batch in batches:
            good = np.array(batch.column("trusted").to_pylist(), dtype=bool)
            for first, part in slices(binary_column(batch.column("text"))):
                buckets, own = features(Words(part), bits)
                corpus += np.bincount(buckets, minlength=1 << bits)
                chosen = good[first:first + len(part)][own]
                trusted += np.bincount(buckets[chosen], minlength=1 << bits)
        some = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(corpus[some]), pa.array(trusted[some])],
            names=["bucket", "corpus", "trusted"])

    return count


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> np.ndarray:
    """log p(bucket | trusted) - log p(bucket | corpus) of the 2**bits buckets.

    Counts cover every document; trusted are those with a label of quality 1.
    The texts move once, to meet their labels: distinct ids, hashed, whatever the size
    of either side. Counted in the map tasks, so a bucket moves once per task. The table has a
    fixed size, whatever the corpus. The trusted counts are drawn towards the
    corpus by PRIOR features per bucket, so buckets rarely seen say little.
    """
    small_batches(docs.sparkSession)
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("good_id")).distinct()
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        good.hint("shuffle_hash"), F.col("doc_id") == F.col("good_id"), "left"
    ).select("text", F.col("good_id").isNotNull().alias("trusted"))
    counts = (
        marked.mapInArrow(_count(bits), "bucket int, corpus long, trusted long")
        .groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))
        .toPandas()
    )
    corpus, trusted = np.ones(1 << bits), np.zeros(1 << bits)
    at = counts["bucket"].to_numpy(dtype=np.int64)
    corpus[at] += counts["corpus"].to_numpy(dtype=float)
    trusted[at] += counts["trusted"].to_numpy(dtype=float)
    corpus /= corpus.sum()
    trusted += PRIOR * len(corpus) * corpus
    return np.log(trusted / trusted.sum()) - np.log(corpus)


def repeated_words(words: Words) -> np.ndarray:
    """Per text, the words in three-word windows that it holds twice or more."""
    n = len(words.bounds) - 1
    grams = window_hashes(words.hashes, 3)
    if not len(grams):
        return np.zeros(n, np.int64)
    at = np.flatnonzero(inner_windows(words.bounds, 3, len(grams)))
    own = words.text_of_word()
    keys = grams[at] ^ mix(own[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = at[order[twice]]
    covered = np.zeros(len(words.hashes), bool)
    for i in range(3):
        covered[hit + i] = True
    return np.bincount(own[covered], minlength=n)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


_RULES = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("kept", pa.bool_()), ("score", pa.float64()),
])


def _judge(ratio: np.ndarray, threshold: float):
    bits = len(ratio).bit_length() - 1

    def total(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        summed = np.concatenate([[0], np.cumsum(flags)])
        return summed[offsets[1:]] - summed[offsets[:-1]]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, part in slices(binary_column(batch.column("text"))):
                words = Words(part)
                n = np.diff(words.bounds)
                first_bytes = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
                lengths = np.concatenate([[0], np.cumsum(first_bytes[words.ends] - first_bytes[words.starts])])
                repeats = repeated_words(words)
                buckets, own = features(words, bits)
                scores = np.bincount(own, weights=ratio[buckets], minlength=len(n)) / np.maximum(np.bincount(own, minlength=len(n)), 1)
                failed = (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * n)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(part)), pa.array(n.astype(np.int64)),
                    pa.array(np.diff(lengths[words.bounds]).astype(np.int64)),
                    pa.array(total(_SYMBOL[words.data], words.offsets).astype(np.int64)),
                    pa.array([repeated_lines(t) for t in part.to_pylist()], pa.int64()),
                    pa.array(repeats.astype(np.int64)), pa.array(failed),
                    pa.array(~failed & (scores >= threshold)), pa.array(scores),
                ], schema=_RULES)

    return judge


def judge(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the rules' counts, base_failed, the score and kept.

    A null text has no words and fails the base rules; its score is 0, as is
    that of any text without words. Rows of equal or null ids are judged one by
    one; other columns are ignored; an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _judge(ratio, threshold),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, score double",
    )


def quality_rules(docs: DataFrame, labels: DataFrame, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on all documents, then judge all documents."""
    return judge(docs, fit(docs, labels, bits), threshold)
