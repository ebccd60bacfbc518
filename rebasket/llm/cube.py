"""Mixing sources to target weights by balanced sampling (the cube method).

Every source has a target number of words. Its documents are taken ``m`` times
for certain, ``m`` being the whole part of target / size, and once more with
the rest ``f`` as inclusion probability. The flight of the cube method moves
these probabilities along the null space of the constraints (documents taken,
words taken) until they are 0 or 1, so both totals stay where they were.

A source above a chunk's size is cut into chunks by hash; the flight is a stream
that holds three documents at a time, and what a chunk leaves undecided (two
documents) flies again with the other chunks' rests, level by level. A source
within a chunk's size flies whole until a dozen documents are left; these land
on the subset whose words and documents come nearest to what the probabilities
promise.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .text import WORD, free_name

CHUNK = 2048
LANDING = 12
MOST_COPIES = 3
_EPS = 1e-9


def word_count(text: str | Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, documents, weight, target: one row per source.

    Weights are 1, 2, 3, repeating, over the sources by code point, null last.
    Targets share the sum of all sizes by weight, at most ``most`` times the
    source's size; the excess goes to the others by weight until none is above.
    A source's rows are summed before they move; the window holds one row per
    source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    named = totals.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = (
        named.withColumn("weight", ((F.col("place") - 1) % 3 + 1).cast("long"))
        .withColumn("room", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    )
    by_room = Window.orderBy("room", "place")
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        weighed
        .withColumn("full", F.coalesce(F.sum("source_size").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("all", F.sum("source_size").over(everything))
        .withColumn("order", F.row_number().over(by_room))
        .withColumn("level", (F.col("all") - most * F.col("full")).cast("double") / F.col("rest"))
        .withColumn("open", F.min(F.when(F.col("room") >= F.col("level"), F.col("order"))).over(everything))
        .withColumn("level", F.max(F.when(F.col("order") == F.col("open"), F.col("level"))).over(everything))
    )
    return level.select(
        "source", "source_size", "documents", "weight",
        F.when(F.col("order") < F.col("open"), (most * F.col("source_size")).cast("double"))
        .otherwise(F.col("weight") * F.col("level")).alias("target"),
    )


def step(p: list[float], size: list[float], draw: random.Random) -> None:
    """Move three probabilities along the null space of (1, size) until one is 0 or 1.

    Two move against each other when their sizes are equal, and when only
    documents are balanced; the mean of every probability is kept.
    """
    if len(p) == 3:
        u = [size[2] - size[1], size[0] - size[2], size[1] - size[0]]
        if not any(u):
            u = [1.0, -1.0, 0.0]
    else:
        u = [1.0, -1.0]
    up = down = float("inf")
    for x, d in zip(p, u):
        if d > 0:
            up, down = min(up, (1 - x) / d), min(down, x / d)
        elif d < 0:
            up, down = min(up, x / -d), min(down, (1 - x) / -d)
    move = up if draw.random() * (up + down) < down else -down
    for i, d in enumerate(u):
        x = p[i] + move * d
        p[i] = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x


_FLOWN = pa.schema([
    ("source", pa.string()), ("doc_id", pa.int64()), ("size", pa.int64()), ("spread", pa.int64()), ("row", pa.int64()),
    ("p", pa.float64()), ("more", pa.int32()),
])
_SHAPE = "source string, doc_id long, size long, spread long, row long, p double, more int"


def _fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flight over rows sorted by (source, chunk): each row with its decision, or its new p."""
    chunk, draw = None, random.Random(0)
    held: list[tuple] = []  # undecided rows
    p: list[float] = []
    size: list[float] = []
    out: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("source", "chunk", "doc_id", "size", "spread", "row", "p")]
        for source, number, doc, words, spread, row, own in zip(*columns):
            if (source, number) != chunk:
                out += [(*one, x, None) for one, x in zip(held, p)]
                held, p, size = [], [], []
                chunk, draw = (source, number), random.Random(f"{source!r} {number}")
            if own <= _EPS or own >= 1 - _EPS or words == 0:
                out.append((source, doc, words, spread, row, own, int(own > 0.5 and words > 0)))
                continue
            held.append((source, doc, words, spread, row))
            p.append(own)
            size.append(float(words))
            while len(p) == 3:
                step(p, size, draw)
                for i in (2, 1, 0):
                    if p[i] in (0.0, 1.0):
                        out.append((*held.pop(i), p[i], int(p.pop(i))))
                        size.pop(i)
        yield _rows(out)
        out = []
    yield _rows([(*one, x, None) for one, x in zip(held, p)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_FLOWN)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FLOWN)], schema=_FLOWN)


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The subset that comes nearest to what the probabilities promise.

    A hundredth of the mean document's words weighs like a tenth of a document.
    """
    choices = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    words = np.abs(choices @ size - p @ size) / size.mean()
    number = np.abs(choices.sum(axis=1) - p.sum())
    return choices[np.argmin(10 * words + number)]


def _last(names: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The last flight of a source, and its landing."""
    rows = group.sort_values(["spread", "doc_id", "size", "row"], kind="stable").reset_index(drop=True)
    p, sizes = rows["p"].tolist(), rows["size"].astype(float).tolist()
    draw = random.Random(f"{names[0]!r} last")
    open_ = []
    for i, (x, words) in enumerate(zip(p, sizes)):
        if _EPS < x < 1 - _EPS and words > 0:
            open_.append(i)
        else:
            p[i] = float(x > 0.5 and words > 0)
    while len(open_) > LANDING:
        three = open_[:3]
        own = [p[i] for i in three]
        step(own, [sizes[i] for i in three], draw)
        for i, x in zip(three, own):
            p[i] = x
        open_ = [i for i in three if 0 < p[i] < 1] + open_[3:]
    if open_:
        for i, x in zip(open_, land(np.array([p[i] for i in open_]), np.array([sizes[i] for i in open_]))):
            p[i] = float(x)
    rows["more"] = np.array(p).astype(np.int32)
    return rows[[f.name for f in _FLOWN]]


def mix(docs: DataFrame, most: int = MOST_COPIES, chunk: int = CHUNK) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source: one row per document.

    ``taken`` is size times copies. Sources weigh 1, 2, 3, repeating (see
    ``source_targets``); copies are the whole part of target / source_size, or
    one more. A null text has no words; a null source is a source of its own; a
    source without words has target 0. Rows of equal ids are separate documents.
    Order and draws follow from hashes of ids and sizes, so reruns and other
    partitionings agree. Other columns are ignored; an empty table gives no rows.
    """
    return _mix(_sizes(docs, F.monotonically_increasing_id()), most, chunk).drop("row")


def _sizes(docs: DataFrame, row: Column) -> DataFrame:
    """doc_id, source, size, row: stored."""
    return stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"), row.alias("row"),
    ), "mix-sizes")


def _mix(sizes: DataFrame, most: int, chunk: int) -> DataFrame:
    """The columns of ``mix``, and the row number of each document."""
    targets = stored(source_targets(sizes, most).withColumn(
        "ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ).withColumn("sure", F.floor(F.col("ratio") + 1e-12).cast("int")), "mix-targets")
    # one row per source, joined to every document: salted by nothing, adaptive execution splits a large source
    known = sizes.join(targets.select(F.col("source").alias("of"), "documents", "ratio", "sure"), F.col("source").eqNullSafe(F.col("of")))
    flying = known.select(
        "source", "doc_id", "size",
        F.xxhash64("doc_id", "size").alias("spread"), "row",
        F.greatest(F.col("ratio") - F.col("sure"), F.lit(0.0)).alias("p"),
        F.ceil(F.col("documents") / chunk).alias("chunks"),
    )
    decided_parts, small = [], []
    while True:
        small.append(flying.filter(F.col("chunks") <= 1))
        large = flying.filter(F.col("chunks") > 1)
        if large.isEmpty():
            break
        flown = stored(
            large.withColumn("chunk", F.pmod(F.xxhash64("spread", F.lit(len(small))), F.col("chunks")))
            .repartition("source", "chunk")
            .sortWithinPartitions("source", "chunk", "spread", "doc_id", "size", "row")
            .select("source", "chunk", "doc_id", "size", "spread", "row", "p")
            .mapInArrow(_fly, _SHAPE), "mix-flight")
        decided_parts.append(flown.filter(F.col("more").isNotNull()))
        left = flown.filter(F.col("more").isNull())
        count = left.groupBy("source").agg(F.count("*").alias("left"))
        flying = left.join(count.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
            "source", "doc_id", "size", "spread", "row", "p", F.ceil(F.col("left") / chunk).alias("chunks"))
    last = small[0]
    for more in small[1:]:
        last = last.unionByName(more)
    parts = [*decided_parts, last.select("source", "doc_id", "size", "spread", "row", "p").groupBy("source").applyInPandas(_last, _SHAPE)]
    decided = parts[0]
    for more in parts[1:]:
        decided = decided.unionByName(more)
    copies = F.col("sure") + F.col("more")
    return decided.join(
        targets.select(F.col("source").alias("of"), "source_size", "target", "sure"), F.col("source").eqNullSafe(F.col("of"))
    ).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), "source", "row",
    )


def mixed(docs: DataFrame, most: int = MOST_COPIES, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    The rows are stored with a number of their own, which the mix carries along:
    every row gets its own copies, also where ids are null or repeated.
    """
    names = {n: free_name(docs.columns, n) for n in ("mix_number", "mix_row", "mix_copies", "mix_nth")}
    numbered = stored(docs.withColumn(names["mix_number"], F.monotonically_increasing_id()), "mix-rows")
    taken = _mix(_sizes(numbered, F.col(names["mix_number"])), most, chunk).filter(F.col("copies") > 0).select(
        F.col("row").alias(names["mix_row"]), F.col("copies").alias(names["mix_copies"]))
    return numbered.join(
        taken.hint("shuffle_hash"), F.col(names["mix_number"]) == F.col(names["mix_row"]),
    ).withColumn(names["mix_nth"], F.explode(F.sequence(F.lit(1), F.col(names["mix_copies"])))).drop(*names.values())
