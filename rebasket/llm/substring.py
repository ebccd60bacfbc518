"""Removal of repeated passages, on a compacted de Bruijn graph of token k-mers.

A window of 35 words is repeated if its words also start anywhere else. Every
word that a repeated window covers is removed.

Nodes of the graph are sampled 18-mers of words (the least by hash of every 18
consecutive ones): a window holds one at least, and equal windows hold equal ones
at equal places. Edges join neighbouring nodes of a text; two neighbours lie at
most 18 words apart, so an edge (18-mer, 18-mer, distance) stands for all words
from the first to the last.

1. Nodes that occur once are dropped; most of the corpus goes no further.
2. Edges are counted. A node is a through node if every occurrence has the same
   edge in and the same edge out. Joined back to their sources, repeated edges
   compact over through nodes into paths: every occurrence of such a path runs
   through all of it, so every window within it is repeated.
3. Windows that hold a repeated node but lie within no path (at a path's ends, at
   branches) are checked by their own words: a 128-bit hash at their source
   coordinates, counted against each other and against the first and last window
   of one occurrence per path (the windows between are open nowhere).

Counts combine in the map tasks and are joined back, so a passage that a third
of all texts share stays spread. Texts of equal words stand for each other: one
of them takes part, with weight two, and all are removed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stored
from .text import Words, binary_column, inner_windows, slices, small_batches, window_hashes

WINDOW = 35
NODE = 18
STEP = WINDOW - NODE + 1  # 18-mers in a window; also the furthest that neighbours lie apart
_LAST = 32  # positions and distances share a long: position * 32 + distance


def sliding(values: np.ndarray, width: int, what: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each ``width`` consecutive values, by doubling."""
    done = 1
    while done < width:
        jump = min(done, width - done)
        values = what(values[:-jump], values[jump:])
        done += jump
    return values


def nodes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word positions in the slice and hashes of the sampled 18-mers, ascending."""
    grams = window_hashes(words.hashes, NODE)
    if len(words.hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams |= np.uint64(1)  # 0 marks what is no window
    least = sliding(grams, STEP, np.minimum)
    least[~inner_windows(words.bounds, WINDOW, len(least))] = 0
    around = np.concatenate([np.zeros(STEP - 1, np.uint64), least, np.zeros(STEP - 1, np.uint64)])
    at = np.flatnonzero(sliding(around, STEP, np.maximum) == grams)
    return at, grams[at]


def _joined(text: bytes) -> bytes:
    return b" ".join(text.split())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, part in slices(binary_column(batch.column("text"))):
            words = Words(part)
            at, hashes = nodes(words)
            cuts = np.searchsorted(at, words.bounds)
            own = np.repeat(words.bounds[:-1], np.diff(cuts))
            distance = np.zeros(len(at), np.int64)
            distance[:-1] = np.diff(at)
            distance[cuts[1:][cuts[1:] > cuts[:-1]] - 1] = 0
            places = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array((at - own) * _LAST + distance, pa.int64()))
            values = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, len(part)),
                batch.column("key").slice(first, len(part)),
                pa.array(np.diff(words.bounds).astype(np.int64)),
                pa.array([hashlib.sha256(_joined(t)).hexdigest() for t in part.to_pylist()], pa.string()),
                places, values,
            ], names=["doc_id", "key", "n_words", "sha", "places", "nodes"])


def inside_paths(n_windows: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which windows lie within one of the spans [start, end)."""
    marks = np.zeros(n_windows + 1, np.int64)
    fits = ends - starts >= WINDOW
    np.add.at(marks, starts[fits], 1)
    np.add.at(marks, ends[fits] - WINDOW + 1, -1)
    return np.cumsum(marks[:-1]) > 0


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows to be counted: open ones with their place, and two of one occurrence per path.

    A window within a path that holds through nodes only lies within the path
    wherever it occurs, so it is open nowhere. The others hold the path's first or
    last node: they are the path's first and last window.
    """
    for batch in batches:
        rids, weights = batch.column("rid").to_pylist(), batch.column("weight").to_pylist()
        at, paths = batch.column("at").to_pylist(), batch.column("paths").to_pylist()
        for first, part in slices(binary_column(batch.column("text"))):
            words = Words(part)
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for i in range(len(part)):
                own = slice(words.bounds[i], words.bounds[i + 1])
                n = own.stop - own.start - WINDOW + 1
                if n <= 0:
                    continue
                held = np.array(at[first + i], np.int64)
                marks = np.zeros(n + 1, np.int64)
                np.add.at(marks, np.maximum(held - STEP + 1, 0), 1)
                np.add.at(marks, np.minimum(held, n - 1) + 1, -1)
                holds = np.cumsum(marks[:-1]) > 0
                spans = np.array([(p["start"], p["end"], p["first"]) for p in paths[first + i]], np.int64).reshape(-1, 3)
                closed = inside_paths(n, spans[:, 0], spans[:, 1])
                lead = spans[spans[:, 2] == 1]
                lead = lead[lead[:, 1] - lead[:, 0] >= WINDOW]
                speaks = np.zeros(n, bool)
                speaks[lead[:, 0]] = True
                speaks[lead[:, 1] - WINDOW] = True
                asks = holds & ~closed
                chosen = np.flatnonzero(asks | speaks)
                if not len(chosen):
                    continue
                open_ = asks[chosen]
                out[0].append(window_hashes(words.hashes[own], WINDOW)[chosen].view(np.int64))
                out[1].append(window_hashes(words.second[own], WINDOW)[chosen].view(np.int64))
                out[2].append(np.full(len(chosen), rids[first + i], np.int64))
                out[3].append(chosen.astype(np.int64))
                out[4].append(np.where(open_, weights[first + i], 2).astype(np.int64))
                out[5].append(open_)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], names=["h1", "h2", "rid", "place", "weight", "open"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = binary_column(batch.column("text")).to_pylist()
        removed, shas = [], []
        for text, paths, repeated in zip(texts, batch.column("paths").to_pylist(), batch.column("repeated").to_pylist()):
            words = text.split()
            n = max(len(words) - WINDOW + 1, 0)
            spans = np.array([(p["start"], p["end"]) for p in paths], np.int64).reshape(-1, 2)
            hit = inside_paths(n, spans[:, 0], spans[:, 1])
            hit[np.array(repeated or [], np.int64)] = True
            marks = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero(hit)
            marks[at] += 1
            marks[at + WINDOW] -= 1
            gone = np.cumsum(marks[:-1]) > 0
            removed.append(int(gone.sum()))
            shas.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist()) if not g])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], names=["rid", "n_removed", "kept_sha256"])


def repeated_nodes(read: DataFrame) -> DataFrame:
    """rid, p, g, a, w: the nodes that occur twice or more, one text of equal words standing for all."""
    spread = read.select("rid", "sha", F.explode(F.arrays_zip("places", "nodes")).alias("x")).select(
        "rid", F.col("x.places").alias("place"), F.col("x.nodes").alias("a"))
    # stored, so that the join starts from two plain shuffles and a hot node can be split
    often = stored(spread.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("b"), "often")
    return spread.join(often, F.col("a") == F.col("b")).select(
        "rid", F.floor(F.col("place") / _LAST).cast("long").alias("p"), F.pmod("place", F.lit(_LAST)).alias("g"), "a")


def paths_of(occurrences: DataFrame) -> DataFrame:
    """rid, start, end, first: the occurrences of the compacted paths.

    ``first`` marks the occurrences in the path's first source.
    """
    row = Window.partitionBy("rid").orderBy("p")
    linked = occurrences.select(
        "*", F.lead("p").over(row).alias("np"), F.lead("a").over(row).alias("na"),
        F.lag("p").over(row).alias("pp"), F.lag("g").over(row).alias("pg"), F.lag("a").over(row).alias("pa"),
    )
    out, into = F.col("np") == F.col("p") + F.col("g"), F.col("pp") + F.col("pg") == F.col("p")
    linked = stored(linked.select(
        "rid", "p", "a", "w",
        F.when(out, F.col("na")).alias("na"), F.when(out, F.col("g")).alias("g"),
        F.when(into, F.col("pa")).alias("pa"), F.when(into, F.col("pg")).alias("pg"),
    ), "linked")
    edges = stored(linked.filter(F.col("na").isNotNull()).groupBy(
        F.col("a").alias("ea"), F.col("na").alias("eb"), F.col("g").alias("eg")
    ).agg(F.sum("w").alias("times"), F.min("rid").alias("source")).filter(F.col("times") > 1).drop("times"), "edges")
    same = [F.min(c) == F.max(c) for c in ("na", "g", "pa", "pg")]
    through = stored(linked.groupBy(F.col("a").alias("through")).agg(
        (same[0] & same[1] & same[2] & same[3] & (F.count("na") == F.count("*")) & (F.count("pa") == F.count("*"))).alias("ok")
    ).filter("ok").select("through"), "through")
    marked = linked.join(edges, (F.col("a") == F.col("ea")) & (F.col("na") == F.col("eb")) & (F.col("g") == F.col("eg"))).select(
        "rid", "p", "a", "g", "pa", (F.col("source") == F.col("rid")).alias("first"))
    marked = marked.join(through, F.col("a") == F.col("through"), "left")
    before = Window.partitionBy("rid").orderBy("p")
    # a through node goes on with the path that its edge in belongs to
    cut = F.col("through").isNull() | F.coalesce(F.lag("p").over(before) + F.lag("g").over(before) != F.col("p"), F.lit(True))
    numbered = marked.withColumn("cut", cut.cast("int")).withColumn("path", F.sum("cut").over(before))
    return numbered.groupBy("rid", "path").agg(
        F.min("p").alias("start"), F.max(F.col("p") + F.col("g") + NODE).alias("end"), F.max(F.col("first").cast("int")).alias("first"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per document.

    The kept words are joined by one space. Windows are judged on the input.
    Texts with fewer words than a window, null and empty ones lose nothing. Rows
    of equal or null ids are separate texts; other columns are ignored; an empty
    table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = texts.withColumn("key", F.xxhash64("text"))
    read = stored(
        keyed.mapInArrow(_read, "doc_id long, key long, n_words long, sha string, places array<long>, nodes array<long>")
        .withColumn("rid", F.monotonically_increasing_id()), "nodes")
    long = read.filter(F.col("n_words") >= WINDOW)
    copies = stored(
        long.groupBy(F.col("sha").alias("words")).agg(F.count("*").alias("n"), F.min("rid").alias("stands")).filter(F.col("n") > 1), "copies")
    twice = stored(
        long.select("rid", "sha").join(copies, F.col("sha") == F.col("words")).select(
            F.col("rid").alias("copy"), (F.col("rid") == F.col("stands")).alias("stands")), "copy-rows")
    occurrences = stored(
        repeated_nodes(long).join(twice, F.col("rid") == F.col("copy"), "left")
        .filter(F.coalesce("stands", F.lit(True)))
        .select("rid", "p", "g", "a", F.when(F.col("copy").isNotNull(), 2).otherwise(1).cast("long").alias("w")), "occurrences")
    paths = paths_of(occurrences).groupBy(F.col("rid").alias("r")).agg(
        F.collect_list(F.struct("start", "end", "first")).alias("paths"))
    held = occurrences.groupBy("rid").agg(F.collect_list("p").alias("at"), F.max("w").alias("weight"))
    asked = held.join(paths, F.col("rid") == F.col("r"), "left").select(
        "rid", "at", "weight", F.coalesce("paths", F.expr("cast(array() as array<struct<start:long,end:long,first:int>>)")).alias("paths"))
    lost = F.lit(-(1 << 63)).cast("long")
    found = asked.join(read.select(F.col("rid").alias("r"), F.coalesce("doc_id", lost).alias("id"), F.col("key").alias("k")), F.col("rid") == F.col("r"))
    sources = stored(
        keyed.join(found, (F.coalesce(F.col("doc_id"), lost) == F.col("id")) & (F.col("key") == F.col("k")))
        .select("rid", "weight", "at", "paths", "text"), "sources")
    windows = stored(
        sources.mapInArrow(_windows, "h1 long, h2 long, rid long, place long, weight long, open boolean"), "windows")
    again = stored(
        windows.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.sum("weight").alias("n"))
        .filter(F.col("n") > 1).select("g1", "g2"), "again")
    hits = windows.filter("open").join(again, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).groupBy(
        F.col("rid").alias("r")).agg(F.collect_list("place").alias("repeated"))
    cut = sources.filter(F.col("weight") == 1).join(hits, F.col("rid") == F.col("r"), "left").filter(
        F.col("repeated").isNotNull() | (F.size("paths") > 0)
    ).select("rid", "text", "paths", "repeated").mapInArrow(_remove, "rid long, n_removed long, kept_sha256 string")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        read.select("rid", "doc_id", "n_words", "sha")
        .join(cut.withColumnRenamed("rid", "r"), F.col("rid") == F.col("r"), "left")
        .join(twice, F.col("rid") == F.col("copy"), "left")
        .select(
            "doc_id", "n_words",
            F.when(F.col("copy").isNotNull(), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(F.col("copy").isNotNull(), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        )
    )
