"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded; learned filters of eight bytes slide over
the whole text in steps of two. Their outputs are max-pooled over chunks of 512
bytes that overlap by half; the pooled chunks' mean and maximum go through a
dense layer into one probability. Every byte of every text is seen.

The network is fitted on the driver with a bounded sample of labelled texts
(``Fit``): that many of each label, in the order of a hash of the id, so the
sample does not depend on how the table is cut into files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import binary_column, free_name, lowest, raw, slices, small_batches

FILTER = 8
STRIDE = 2
CELL = 256  # bytes; a chunk is two neighbouring cells
_PER_CELL = CELL // STRIDE
_EMPTY = -1e30


@dataclass(frozen=True)
class Fit:
    """The bounds and settings of the fit."""

    per_label: int = 1500  # labelled texts of each label
    most_bytes: int = 16384  # longer texts are scored, but not fitted on
    rounds: int = 8
    batch: int = 64
    rate: float = 0.01
    embedding: int = 8
    filters: int = 24
    hidden: int = 16
    seed: int = 7


class Net:
    """The network's weights."""

    def __init__(self, fit: Fit):
        draw = np.random.default_rng(fit.seed)
        e, f, h = fit.embedding, fit.filters, fit.hidden
        self.w = {
            "bytes": draw.normal(0, 0.5, (256, e)),
            "filters": draw.normal(0, 1 / np.sqrt(FILTER * e), (FILTER * e, f)),
            "shift": np.zeros(f),
            "dense": draw.normal(0, 1 / np.sqrt(2 * f), (2 * f, h)),
            "dense_shift": np.zeros(h),
            "last": draw.normal(0, 1 / np.sqrt(h), h),
            "last_shift": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out in whole cells, each with a filter's width of zero bytes after it.

    Returns the bytes and the n + 1 cell bounds.
    """
    lengths = np.diff(offsets)
    cells = (lengths + FILTER + CELL - 1) // CELL
    bounds = np.concatenate([[0], np.cumsum(cells)])
    out = np.zeros(int(bounds[-1]) * CELL + FILTER, np.uint8)
    if len(data):
        out[np.arange(len(data)) + np.repeat(bounds[:-1] * CELL - offsets[:-1], lengths)] = data
    return out, bounds


def windows(net: Net, data: np.ndarray) -> np.ndarray:
    """The embedded bytes under every filter position, one row each."""
    x = net.w["bytes"][data]
    e = x.shape[1]
    rows = (len(data) - FILTER) // STRIDE
    view = np.lib.stride_tricks.as_strided(x, (rows, FILTER * e), (STRIDE * e * 4, 4))
    return np.ascontiguousarray(view)




def chunk_cells(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second cell of every chunk, and the n + 1 chunk bounds of the texts."""
    cells = np.diff(bounds)
    chunks = np.maximum(cells - 1, 1)
    limits = np.concatenate([[0], np.cumsum(chunks)])
    first = np.arange(limits[-1]) + np.repeat(bounds[:-1] - limits[:-1], chunks)
    second = np.minimum(first + 1, np.repeat(bounds[1:] - 1, chunks))
    return first, second, limits


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(net: Net, column: pa.Array) -> np.ndarray:
    """The probability of label 1 for every text of a binary column."""
    parts = [np.zeros(0)]
    for _, part in slices(column, 1 << 18):
        data, offsets = raw(part)
        laid, bounds = padded(data, offsets)
        high = np.concatenate([
            pooled_block(net, laid, bounds, a, min(a + 256, int(bounds[-1]))) for a in range(0, int(bounds[-1]), 256)])
        parts.append(head(net, high, bounds)[-1].astype(float))
    return np.concatenate(parts)


def pooled_block(net: Net, laid: np.ndarray, bounds: np.ndarray, a: int, b: int) -> np.ndarray:
    """Cell maxima of the cells a:b, so that a long text needs little memory."""
    out = (windows(net, laid[a * CELL:b * CELL + FILTER]) @ net.w["filters"]).reshape(b - a, _PER_CELL, -1)
    last = bounds[1:] - 1
    last = last[(last >= a) & (last < b)] - a
    out[last, _PER_CELL - (FILTER - 1) // STRIDE:] = _EMPTY
    return out.max(axis=1)


def head(net: Net, high: np.ndarray, bounds: np.ndarray) -> tuple:
    """From cell maxima to probabilities; also what the gradient needs."""
    w = net.w
    first, second, limits = chunk_cells(bounds)
    chunk = np.maximum(np.maximum(high[first], high[second]) + w["shift"], 0)
    count = np.diff(limits)[:, None]
    mean = np.add.reduceat(chunk, limits[:-1], axis=0) / count
    top = np.maximum.reduceat(chunk, limits[:-1], axis=0)
    both = np.concatenate([mean, top], axis=1)
    hidden = np.maximum(both @ w["dense"] + w["dense_shift"], 0)
    return first, second, limits, chunk, top, both, hidden, sigmoid(hidden @ w["last"] + w["last_shift"])


def gradient(net: Net, laid: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean logistic loss over a batch."""
    w = net.w
    inputs = windows(net, laid)
    out = inputs @ w["filters"]
    cells = out.reshape(-1, _PER_CELL, out.shape[1])
    cells[bounds[1:] - 1, _PER_CELL - (FILTER - 1) // STRIDE:] = _EMPTY
    at = cells.argmax(axis=1)
    high = np.take_along_axis(cells, at[:, None, :], axis=1)[:, 0]
    first, second, limits, chunk, top, both, hidden, p = head(net, high, bounds)
    g: dict[str, np.ndarray] = {}
    d = ((p - label) / len(label)).astype(np.float32)
    g["last"], g["last_shift"] = hidden.T @ d, d.sum(keepdims=True)
    dh = np.outer(d, w["last"]) * (hidden > 0)
    g["dense"], g["dense_shift"] = both.T @ dh, dh.sum(axis=0)
    db = dh @ w["dense"].T
    f = chunk.shape[1]
    count = np.diff(limits)
    own = np.repeat(np.arange(len(count)), count)
    dc = db[own, :f] / count[own][:, None]
    highest = chunk == top[own]  # chunks of equal height share the gradient
    dc += highest * (db[:, f:] / np.add.reduceat(highest, limits[:-1], axis=0, dtype=np.int64))[own]
    dc *= chunk > 0
    g["shift"] = dc.sum(axis=0)
    left = high[first] >= high[second]
    dhigh = np.zeros_like(high)
    np.add.at(dhigh, first, np.where(left, dc, 0))
    np.add.at(dhigh, second, np.where(left, 0, dc))
    cell, filt = np.nonzero(dhigh)
    row = cell * _PER_CELL + at[cell, filt]
    value = dhigh[cell, filt].astype(np.float32)
    g["filters"] = np.zeros_like(w["filters"])
    dx = np.zeros((256, w["bytes"].shape[1]), np.float32)
    e = w["bytes"].shape[1]
    for one in range(f):
        mine = filt == one
        g["filters"][:, one] = value[mine] @ inputs[row[mine]]
        bytes_seen = laid[(row[mine] * STRIDE)[:, None] + np.arange(FILTER)]
        for k in range(FILTER):
            weight = np.bincount(bytes_seen[:, k], weights=value[mine], minlength=256).astype(np.float32)
            dx += np.outer(weight, w["filters"][k * e:(k + 1) * e, one])
    g["bytes"] = dx
    return g


def fitted(texts: list[bytes], labels: list[int], fit: Fit) -> Net:
    """Train by Adam; without texts of both labels, a network that answers by their share."""
    net = Net(fit)
    label = np.array(labels, dtype=np.float32)
    if not len(label) or label.min() == label.max():
        net.w["last"][:] = 0
        net.w["last_shift"][:] = 10.0 if not len(label) or label[0] > 0 else -10.0
        return net
    draw = np.random.default_rng(fit.seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for turn in range(fit.rounds):
        order = draw.permutation(len(texts))
        for a in range(0, len(order), fit.batch):
            chosen = order[a:a + fit.batch]
            laid, bounds = padded(*raw(pa.array([texts[i] for i in chosen], pa.large_binary())))
            step += 1
            for k, g in gradient(net, laid, bounds, label[chosen]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = fit.rate * (1 - turn / fit.rounds) * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
                net.w[k] = (net.w[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32)
    return net


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary") if isinstance(doc_id, str) else doc_id), F.lit(3))


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, quality of the labelled documents whose fold is not 1; of several labels the highest."""
    return (
        labels.filter(F.col("quality").isin(0, 1) & (fold() != 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    )


def label_counts(labels: DataFrame) -> dict[int, int]:
    """Number of labelled documents whose fold is not 1, by label."""
    return {r["quality"]: r["n"] for r in known_labels(labels).groupBy("quality").agg(F.count("*").alias("n")).collect()}


def sample(docs: DataFrame, labels: DataFrame, counts: dict[int, int], fit: Fit = Fit()) -> DataFrame:
    """id, text, quality: the texts to fit on, at most ``per_label`` of each label.

    The chosen ids are bounded by ``per_label``, so they can be broadcast.
    """
    known = known_labels(labels)
    chosen = lowest(known.filter(F.col("quality") == 0), F.xxhash64("doc_id"), fit.per_label, counts.get(0, 0)).unionByName(
        lowest(known.filter(F.col("quality") == 1), F.xxhash64("doc_id"), fit.per_label, counts.get(1, 0)))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).filter(
        F.octet_length("text") <= fit.most_bytes)
    return texts.join(F.broadcast(chosen), F.col("id") == F.col("doc_id")).select("id", "text", "quality")


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Net:
    """Fit the network on ``sample``, then move its answers to the labels' true odds.

    Rows of one id beyond ``2 * per_label`` are left to scoring.
    """
    counts = label_counts(labels)
    rows = sample(docs, labels, counts, fit).orderBy(F.xxhash64("id"), "id", "text").limit(2 * fit.per_label).collect()
    net = fitted([r["text"].encode() for r in rows], [r["quality"] for r in rows], fit)
    good = sum(r["quality"] for r in rows)
    if 0 < good < len(rows):
        net.w["last_shift"] += np.float32(np.log(counts[1] / counts[0]) - np.log(good / (len(rows) - good)))
    return net


def score(docs: DataFrame, net: Net, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score; a null text counts as empty."""
    small_batches(docs.sparkSession)
    shape = docs.select("*", F.lit(0.0).cast("double").alias(name)).schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(net, binary_column(batch.column(at).cast(pa.large_string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, shape)


def good(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns.

    A null text is scored as an empty one, repeated rows are scored alike, a null id is a
    row like any other, and an empty table gives an empty one.
    """
    name = free_name(docs.columns, "quality_score")
    return score(docs, train(docs, labels, fit), name).filter(F.col(name) >= 0.5).drop(name)


def classify(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document.

    Only the text is an input of a score. A null text counts as empty; a null id
    is held out. Repeated rows are scored one by one, other columns are ignored,
    an empty table gives no rows.
    """
    net = train(docs, labels, fit)
    found = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), net)
    return found.select(
        "doc_id", F.coalesce(fold() == 1, F.lit(True)).alias("held_out"),
        F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )
