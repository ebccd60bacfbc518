"""Prefix trie of conversations, measured by an Euler tour.

A node is a distinct sequence of first turns; it is named by its least member
and its depth. The trie falls into paths: a node's least member runs on to its
first child of the same name, all other children begin paths of their own.

1. Turns are ranged over tasks by (conversation, turn), so a long conversation is cut.
   A scan gives every place its depth and two hashes of the turns so far: polynomials
   in a fixed random base modulo 2**61 - 1, over 60-bit parts of the MD5 of each turn.
   What a cut conversation had before the cut is added from one row per task.
2. Equal hashes at equal depth are one node. Children of a node are ordered by
   name and linked to their next sibling, again by ranges, so that a node with
   very many children is cut too.
3. Every node has an enter arc and an exit arc, each with the arc that follows in
   the tour. List ranking: tasks join the arcs they hold into chains; the
   chains, as arcs of their own, meet their successors by coin tosses, until few
   enough for one task are left; then offsets are handed down again.
4. Arcs carry a leaf and the words saved on entering. What lies between a node's
   enter and its exit, a difference of two prefix sums, is its subtree's.

The numbers of the members that end at a node are hashed as a stream over
chunks, which are put together beforehand, so copies of one conversation are cut as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stored
from .text import WORD, small_batches

ROWS_PER_TASK = 250_000
CHUNK_IDS = 4096
GROUP, HEADS = 20, 3  # conversations that share a base, and the most turns taken from it
_PRIME = np.uint64((1 << 61) - 1)
_BASES = (np.uint64(0x0F3B5A1C9D27E684), np.uint64(0x1A96D3F04B7C52E8))

RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


# conversations to rows


def keyed(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, x1, x2, words, row: the turns without their texts, stored.

    ``digest`` is the MD5 of role and text (null: empty), ``x1`` and ``x2`` 60 bits of
    it each, ``words`` the number of words of the text and ``row`` a number of the row's own.
    Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    part = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    return stored(rows.withColumns({"x1": part(1), "x2": part(16), "row": F.monotonically_increasing_id()}), "turns")


_SHAPE = ["conv_id", "part", "turn", "digest", "row", "skip", "x1", "x2", "words"]


def _shaped(rows: DataFrame, part: int, skip: bool = False) -> DataFrame:
    return rows.withColumns({"part": F.lit(part), "skip": F.lit(skip)}).select(*_SHAPE)


def _roots(ids: DataFrame) -> DataFrame:
    """The place before the first turn, of every conversation."""
    nothing = {c: F.lit(None).cast("long") for c in ("turn", "row")} | {c: F.lit(0).cast("long") for c in ("x1", "x2", "words")}
    return _shaped(ids.withColumns(nothing | {"digest": F.lit("")}), -1)


def unchanged(turns: DataFrame) -> DataFrame:
    """The rows of conversations as they are."""
    return _roots(turns.select("conv_id").distinct()).unionByName(_shaped(turns, 1))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The rows of conversations rebuilt on their base.

    The base of c is c - c % ``GROUP``. With h = crc32(c) % 4, the first h turns of
    c give way to the first h of its base (all if it has fewer, none if it is
    absent). Turns that give way are marked by a ``skip`` row of their own
    that sorts before them. Only the first three turns of every conversation are
    looked for, so one with most of the rows sends three from each task.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest", "row")
    heads = stored(turns.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= HEADS), "heads")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    conversations = heads.filter("rank = 1").select("conv_id", base.alias("base"), taken.alias("taken"))
    moved = conversations.filter(F.col("base") != F.col("conv_id"))
    from_base = moved.withColumnRenamed("conv_id", "of").join(heads, (F.col("conv_id") == F.col("base")) & (F.col("rank") <= F.col("taken")))
    gone = heads.filter((base != F.col("conv_id")) & (F.col("rank") <= taken))
    return (
        _roots(conversations.select("conv_id")).unionByName(_shaped(turns, 1))
        .unionByName(_shaped(from_base.drop("conv_id").withColumnRenamed("of", "conv_id"), 0))
        .unionByName(_shaped(gone, 1, skip=True))
    )


# depths and hashes


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1 of numbers below it."""
    low, mask = np.uint64(31), np.uint64((1 << 31) - 1)
    ah, al, bh, bl = a >> low, a & mask, b >> low, b & mask
    middle = al * bh + ah * bl
    total = ((ah * bh) << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << low) + al * bl
    return _reduced(total)


def _reduced(value: np.ndarray) -> np.ndarray:
    value = (value & _PRIME) + (value >> np.uint64(61))
    return np.where(value >= _PRIME, value - _PRIME, value)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n - 1), modulo 2**61 - 1."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, np.array([base], np.uint64)
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = times(out[:more], np.broadcast_to(step, more))
        done, step = done + more, times(step, step)
    return out


class _Scan:
    """Depths and hashes of the sorted rows of one task, from batch to batch."""

    def __init__(self):
        self.conv, self.depth, self.sums = None, -1, [np.uint64(0), np.uint64(0)]
        self.lead, self.skipping, self.held = True, False, None

    def step(self, conv: np.ndarray, skip: np.ndarray, xs: list[np.ndarray], words: np.ndarray) -> dict[str, np.ndarray] | None:
        gone = skip.copy()
        gone[1:] |= skip[:-1]
        gone[:1] |= self.skipping
        self.skipping = bool(skip[-1])
        kept = np.flatnonzero(~gone)
        if not len(kept):
            return None
        conv, words = conv[kept], words[kept]
        n = len(conv)
        starts = np.ones(n, bool)
        starts[1:] = conv[1:] != conv[:-1]
        goes_on = conv[0] == self.conv if self.conv is not None else False
        at = np.flatnonzero(starts)
        group = np.cumsum(starts) - 1
        inside = np.arange(n) - at[group]
        first = group == 0
        depth = inside + (self.depth + 1) * (first & goes_on)
        out = {"conv_id": conv, "depth": depth, "words": words, "lead": first & (self.lead if self.conv is None or goes_on else False)}
        for k, (base, x) in enumerate(zip(_BASES, xs), 1):
            before = self.sums[k - 1] if goes_on else np.uint64(0)
            ahead = powers(base, n)[inside]
            if goes_on:
                lift = np.uint64(pow(int(base), self.depth + 1, int(_PRIME)))
                ahead = np.where(first, times(ahead, np.broadcast_to(lift, n)), ahead)
            term = times(_reduced(x[kept].astype(np.uint64)), ahead)
            high, low = np.cumsum(term >> np.uint64(31)), np.cumsum(term & np.uint64((1 << 31) - 1))
            none = np.zeros(1, np.uint64)
            high -= np.concatenate([none, high])[at][group]
            low -= np.concatenate([none, low])[at][group]
            total = _reduced(times(_reduced(high), np.broadcast_to(np.uint64(1 << 31), n)) + _reduced(low))
            total = np.where(first, _reduced(total + before), total)
            last = np.concatenate([[before], total[:-1]])
            last[starts] = 0
            if goes_on:
                last[0] = before
            out[f"p{k}"], out[f"q{k}"] = total.astype(np.int64), last.astype(np.int64)
            self.sums[k - 1] = total[-1]
        self.lead = bool(out["lead"][-1])
        self.conv, self.depth = conv[-1], int(depth[-1])
        return out


_COLUMNS = ["conv_id", "depth", "p1", "p2", "q1", "q2", "words", "lead"]
_PREFIXES = "block int, conv_id long, depth long, p1 long, p2 long, q1 long, q2 long, words long, lead boolean, more boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``more``: whether the conversation goes on; null for the last row of a task."""
    scan, held, block = _Scan(), None, 0

    def rows(found: dict[str, np.ndarray], more: pa.Array) -> pa.RecordBatch:
        n = len(found["conv_id"])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block, np.int32)), *(pa.array(found[c]) for c in _COLUMNS), more], names=["block", *_COLUMNS, "more"])

    for batch in batches:
        if not len(batch):
            continue
        block = batch.column("block")[0].as_py()
        column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "skip", "x1", "x2", "words")}
        found = scan.step(column["conv_id"], column["skip"].astype(bool), [column["x1"], column["x2"]], column["words"])
        if found is None:
            continue
        if held is not None:
            found = {c: np.concatenate([held[c], found[c]]) for c in _COLUMNS}
        more = found["conv_id"][1:] == found["conv_id"][:-1]
        held = {c: v[-1:] for c, v in found.items()}
        yield rows({c: v[:-1] for c, v in found.items()}, pa.array(more))
    if held is not None:
        yield rows(held, pa.nulls(1, pa.bool_()))


def _tasks(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def _ranged(rows: DataFrame, order: list, count: int) -> DataFrame:
    """Sorted ranges of about ``ROWS_PER_TASK`` rows, with their number as ``block``."""
    return rows.repartitionByRange(_tasks(count), *order).withColumn("block", F.spark_partition_id())


def _mended(ends: dict[int, tuple], first: dict[int, int]) -> tuple[dict[int, tuple], dict[int, bool]]:
    """What each task's first conversation had before it, and whether its last one goes on after it.

    ``ends``: by task, the last row: conv_id, depth, p1, p2, lead. ``first``: the first conversation.
    """
    before: dict[int, tuple] = {}
    more: dict[int, bool] = {}
    conv, depth, sums = None, -1, [0, 0]
    last_block = None
    prime = int(_PRIME)
    for block in sorted(ends):
        goes_on = conv is not None and first[block] == conv
        if last_block is not None:
            more[last_block] = goes_on
        lift = [1, 1]
        if goes_on:
            lift = [pow(int(b), depth + 1, prime) for b in _BASES]
            before[block] = (depth + 1, *sums, *lift)
        end_conv, end_depth, p1, p2, lead = ends[block]
        if lead and goes_on:
            depth += 1 + end_depth
            sums = [(s + x * p) % prime for s, x, p in zip(sums, lift, (p1, p2))]
        else:
            depth, sums = end_depth, [p1, p2]
        conv, last_block = end_conv, block
    if last_block is not None:
        more[last_block] = False
    return before, more


def _mend(before: dict[int, tuple], more: dict[int, bool]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", *_COLUMNS)}
            for block in np.unique(column["block"]).tolist():
                at = np.flatnonzero((column["block"] == block) & column["lead"].astype(bool))
                if block not in before or not len(at):
                    continue
                depth, *known = before[block]
                column["depth"] = column["depth"].copy()
                column["depth"][at] += depth
                for k in (1, 2):
                    total, lift = np.uint64(known[k - 1]), np.uint64(known[k + 1])
                    for c in (f"p{k}", f"q{k}"):
                        value = column[c].astype(np.uint64)
                        value[at] = _reduced(times(value[at], np.broadcast_to(lift, len(at))) + total)
                        column[c] = value.astype(np.int64)
            goes_on = [m if m is not None else more[b] for b, m in zip(column["block"].tolist(), batch.column("more").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), *(pa.array(column[c]).cast(batch.schema.field(c).type) for c in _COLUMNS), pa.array(goes_on, pa.bool_())],
                names=batch.schema.names)

    return run


def prefixes(rows: DataFrame, count: int) -> DataFrame:
    """conv_id, depth, p1, p2, q1, q2, words, more: every place of every conversation.

    ``p1`` and ``p2`` are the hashes of the turns up to the place, ``q1`` and ``q2``
    those before its last turn. One row per task comes to the driver, which
    says what cut conversations had before.
    """
    order = ["conv_id", "part", F.col("turn").asc_nulls_first(), "digest", "row"]
    scanned = stored(
        _ranged(rows, order, count).sortWithinPartitions(*order, F.desc("skip"))
        .select("block", "conv_id", "skip", "x1", "x2", "words").mapInArrow(_scan, _PREFIXES), "prefixes")
    ends = {r["block"]: (r["conv_id"], r["depth"], r["p1"], r["p2"], r["lead"]) for r in scanned.filter("more is null").collect()}
    first = {r["block"]: r["conv_id"] for r in scanned.filter("lead and depth = 0").select("block", "conv_id").collect()}
    before, more = _mended(ends, first)
    whole = scanned.filter("not lead and more is not null")
    return whole.unionByName(scanned.filter("lead or more is null").mapInArrow(_mend(before, more), _PREFIXES)).drop("block", "lead")


# nodes, children, siblings


def nodes_of(places: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2, q1, q2, more, n_convs, words: one row per node, counted in the map tasks first."""
    least = F.min(F.struct("conv_id", "q1", "q2", "more"))
    return places.groupBy("depth", "p1", "p2").agg(least.alias("least"), F.count("*").alias("n_convs"), F.max("words").alias("words")).select(
        "least.conv_id", "depth", "p1", "p2", "least.q1", "least.q2", "least.more", "n_convs", "words")


def _siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The next child of the same parent; the last row of a task is marked ``open``."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        parent, depth, conv = (table.column(c).to_numpy() for c in ("parent_conv", "depth", "conv_id"))
        same = (parent[1:] == parent[:-1]) & (depth[1:] == depth[:-1])
        n = len(table) - 1
        if n:
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c)[:n].combine_chunks() for c in batch.schema.names), pa.array(conv[1:], mask=~same), pa.array(np.zeros(n, bool))],
                names=[*batch.schema.names, "sibling", "open"])
        held = table.slice(n, 1)
    if held is not None:
        yield pa.RecordBatch.from_arrays(
            [*(held.column(c).combine_chunks() for c in held.schema.names), pa.nulls(1, pa.int64()), pa.array([True])], names=[*held.schema.names, "sibling", "open"])


def attached(nodes: DataFrame, root: int, count: int) -> DataFrame:
    """conv_id, depth, parent_conv, sibling: the first node of every path but the root's, stored.

    ``sibling`` is the next such child of the same parent. Ranges of (parent, name)
    cut the children of one node; one row per task tells the next task's first.
    """
    spark = nodes.sparkSession
    tops = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "q1", "q2")).alias("top")).select("conv_id", "top.*").filter("depth > 0")
    of = nodes.select(F.col("conv_id").alias("parent_conv"), (F.col("depth") + 1).alias("d"), F.col("p1").alias("a"), F.col("p2").alias("b"))
    below_root = tops.filter("depth = 1").select("conv_id", "depth", F.lit(root).cast("long").alias("parent_conv"))
    deeper = tops.filter("depth > 1").join(of, (F.col("depth") == F.col("d")) & (F.col("q1") == F.col("a")) & (F.col("q2") == F.col("b")))
    order = ["parent_conv", "depth", "conv_id"]
    listed = stored(
        _ranged(below_root.unionByName(deeper.select("conv_id", "depth", "parent_conv")), order, count).sortWithinPartitions(*order)
        .select("block", "parent_conv", "depth", "conv_id")
        .mapInArrow(_siblings, "block int, parent_conv long, depth long, conv_id long, sibling long, open boolean"), "attached")
    firsts = listed.groupBy("block").agg(F.min(F.struct(*order)).alias("first")).select("block", "first.*").collect()
    following, after = {}, None
    for r in sorted(firsts, key=lambda r: -r["block"]):
        following[r["block"]] = after
        after = (r["parent_conv"], r["depth"], r["conv_id"])
    rows = [(b, *x) for b, x in following.items() if x]
    next_ = spark.createDataFrame(rows, "in_block int, of_parent long, of_depth long, next_conv long")  # one row per task
    same = F.col("open") & (F.col("block") == F.col("in_block")) & (F.col("parent_conv") == F.col("of_parent")) & (F.col("depth") == F.col("of_depth"))
    return listed.join(F.broadcast(next_), same, "left").select(
        "conv_id", "depth", "parent_conv", F.coalesce("sibling", "next_conv").alias("sibling"))


def with_links(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes with ``first`` and ``n_attached`` of the paths attached to them, and their own ``parent_conv`` and ``sibling``."""
    none = F.lit(None).cast("long")
    children = tops.groupBy(F.col("parent_conv").alias("c"), (F.col("depth") - 1).alias("d")).agg(
        F.min("conv_id").alias("first"), F.count("*").alias("n_attached"))
    own = tops.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), none.alias("first"), none.alias("n_attached"), "parent_conv", "sibling")
    both = children.withColumns({"parent_conv": none, "sibling": none}).unionByName(own).groupBy("c", "d").agg(
        *(F.max(x).alias(x) for x in ("first", "n_attached", "parent_conv", "sibling")))
    return nodes.join(both, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")), "left").drop("c", "d")


# the tour and its ranking


def arcs_of(linked: DataFrame) -> DataFrame:
    """c, s, nc, ns, leaf, saved: the arcs of the tour, each with the one that follows (ns -1: none).

    The arcs of node (c, depth) are s = 2 * depth on entering and 2 * depth + 1 on leaving.
    """
    c, enter, none = F.col("conv_id"), 2 * F.col("depth"), F.lit(0).cast("long")
    first = F.col("first").isNotNull()

    def arc(s, next_c, next_s, leaf=none, saved=none):
        return F.struct(s.alias("s"), next_c.alias("nc"), next_s.alias("ns"), leaf.alias("leaf"), saved.alias("saved"))

    entering = arc(
        enter,
        F.when(F.col("more"), c).when(first, F.col("first")).otherwise(c),
        F.when(F.col("more") | first, enter + 2).otherwise(enter + 1),
        (~F.col("more") & ~first).cast("long"), (F.col("n_convs") - 1) * F.col("words"))
    # the child of the same name is left for the first attached one, if there is any
    child_left = F.when(F.col("more"), arc(
        enter + 3, F.when(first, F.col("first")).otherwise(c), F.when(first, enter + 2).otherwise(enter + 1)))
    top_left = F.when(F.col("parent_conv").isNotNull(), arc(
        enter + 1, F.coalesce("sibling", "parent_conv"), F.when(F.col("sibling").isNotNull(), enter).otherwise(enter - 1)))
    root_left = F.when(F.col("depth") == 0, arc(enter + 1, none, F.lit(-1).cast("long")))
    return linked.select(c.alias("c"), F.explode(F.array(entering, child_left, top_left, root_left)).alias("arc")).filter(
        "arc is not null").select("c", "arc.*")


_CHAINS = pa.schema([(n, pa.int64()) for n in ("c", "s", "hc", "hs", "leaf", "saved")] + [
    ("tail", pa.bool_())] + [(n, pa.int64()) for n in ("nc", "ns", "total_leaf", "total_saved")])
_CHAIN_SHAPE = (
    "c long, s long, hc long, hs long, leaf long, saved long, tail boolean, nc long, ns long, total_leaf long, total_saved long"
)


def chained(c: np.ndarray, s: np.ndarray, nc: np.ndarray, ns: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The chains that arcs at hand form: every arc's first, the weights before it, and which arcs are last."""
    n = len(c)
    all_c, all_s = np.concatenate([c, nc]), np.concatenate([s, ns])
    order = np.lexsort((all_s, all_c))
    new = np.ones(2 * n, bool)
    new[1:] = (all_c[order][1:] != all_c[order][:-1]) | (all_s[order][1:] != all_s[order][:-1])
    name = np.empty(2 * n, np.int64)
    name[order] = np.cumsum(new) - 1
    where = np.full(2 * n, -1)
    where[name[:n]] = np.arange(n)
    follows = where[name[n:]]
    follows[ns < 0] = -1
    head = np.arange(n)
    linked = np.flatnonzero(follows >= 0)
    head[follows[linked]] = linked
    before = [np.where(head != np.arange(n), w[head], 0) for w in weights]
    while True:
        onward = head[head]
        if np.array_equal(onward, head):
            return head, before, follows < 0
        before = [b + b[head] for b in before]
        head = onward


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if len(b)]
    if not held:
        return
    table = pa.Table.from_batches(held)
    c, s, nc, ns, leaf, saved = (table.column(x).to_numpy() for x in ("c", "s", "nc", "ns", "leaf", "saved"))
    head, (leaf_before, saved_before), tail = chained(c, s, nc, ns, [leaf, saved])
    out = pa.Table.from_arrays([pa.array(x) for x in (
        c, s, c[head], s[head], leaf_before, saved_before, tail, nc, ns, leaf_before + leaf, saved_before + saved)], schema=_CHAINS)
    yield from out.to_batches(max_chunksize=20_000)


def ranked(arcs: DataFrame, count: int) -> DataFrame:
    """c, s, leaf, saved: the sums of the arcs before each arc of the list.

    ``arcs``: ``count`` rows of one list. Chains are joined in tasks of about
    ``ROWS_PER_TASK`` arcs, first by ranges of (c, s), where most neighbours meet; then
    an arc that tosses heads goes to the follower that tossed tails, which leaves
    about three quarters, until ``ROWS_PER_TASK`` chains are left for one task.
    """
    levels = []
    dealt = arcs.repartitionByRange(_tasks(count), "c", "s")
    turn = 0
    while True:
        level = stored(dealt.mapInArrow(_chains, _CHAIN_SHAPE), "chains")
        levels.append(level)
        rest = level.filter("tail").select(
            F.col("hc").alias("c"), F.col("hs").alias("s"), "nc", "ns", F.col("total_leaf").alias("leaf"), F.col("total_saved").alias("saved"))
        left = rest.count()
        if left <= 1:
            break
        if left <= ROWS_PER_TASK:
            dealt = rest.repartition(1)
        else:
            turn += 1

            def tossed(c: str, s: str):
                return F.pmod(F.xxhash64(F.lit(turn), c, s), F.lit(2)) == 1

            goes = tossed("c", "s") & ~tossed("nc", "ns") & (F.col("ns") >= 0)
            dealt = rest.repartition(
                _tasks(left), F.when(goes, F.col("nc")).otherwise(F.col("c")), F.when(goes, F.col("ns")).otherwise(F.col("s")))
    places = levels.pop().select("c", "s", "leaf", "saved")
    while levels:
        above = places.select(F.col("c").alias("ac"), F.col("s").alias("at"), F.col("leaf").alias("al"), F.col("saved").alias("av"))
        places = levels.pop().join(above, (F.col("hc") == F.col("ac")) & (F.col("hs") == F.col("at"))).select(
            "c", "s", (F.col("leaf") + F.col("al")).alias("leaf"), (F.col("saved") + F.col("av")).alias("saved"))
    return places


# the members that end at a node


def _runs(key: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(key[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
    return np.flatnonzero(new)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined numbers of the consecutive rows of one node, ``CHUNK_IDS`` at most."""
    for batch in batches:
        if not len(batch):
            continue
        key = [batch.column(c).to_numpy() for c in ("depth", "p1", "p2")]
        ids = batch.column("conv_id").to_numpy()
        starts = _runs(key)
        bounds = [x for a, b in zip(starts, np.append(starts[1:], len(ids))) for x in range(a, b, CHUNK_IDS)]
        joined = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(bounds, [*bounds[1:], len(ids)])]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(k[bounds]) for k in key), pa.array(ids[bounds]), pa.array(joined)], names=["depth", "p1", "p2", "least", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of every node's chunks, in order; one hash is open at a time."""
    now, digest = None, None
    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "ids")))
        for depth, p1, p2, ids in rows:
            if (depth, p1, p2) == now:
                digest.update(b",")
            else:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (depth, p1, p2), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield _digest_rows(out)
    if now is not None:
        yield _digest_rows([(*now, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=["d", "a", "b", "sha"])


def end_digests(places: DataFrame, count: int) -> DataFrame:
    """d, a, b, sha: by depth and hashes, the SHA-256 of the members that end there, ascending."""
    order = ["depth", "p1", "p2", "conv_id"]
    chunks = _ranged(places.filter("not more").select(*order), order, count).drop("block").sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, p1 long, p2 long, least long, ids string")
    return chunks.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "least").select("depth", "p1", "p2", "ids").mapInArrow(
        _digests, "d long, a long, b long, sha string")


def prefix_trie(rows: DataFrame, count: int) -> DataFrame:
    """The trie's nodes from the rows of ``unchanged`` or ``rebuilt``, about ``count``; columns as in ``conversation_trie``."""
    spark: SparkSession = rows.sparkSession
    small_batches(spark)
    places = prefixes(rows, count)
    nodes = stored(nodes_of(places), "nodes")
    root = nodes.filter("depth = 0").select("conv_id", "n_convs").first()
    if root is None:
        return spark.createDataFrame([], RESULT)
    tops = attached(nodes, root["conv_id"], root["n_convs"])
    linked = stored(with_links(nodes, tops), "linked")
    summed = ranked(arcs_of(linked), 2 * linked.count())
    sign = F.when(F.col("s") % 2 == 1, 1).otherwise(-1)
    below = summed.groupBy(F.col("c").alias("nc"), F.shiftright("s", 1).alias("nd")).agg(
        F.sum(sign * F.col("leaf")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"))
    digests = end_digests(places, root["n_convs"])
    named = linked.join(below, (F.col("conv_id") == F.col("nc")) & (F.col("depth") == F.col("nd"))).join(
        digests, (F.col("depth") == F.col("d")) & (F.col("p1") == F.col("a")) & (F.col("p2") == F.col("b")), "left")
    return named.select(
        "conv_id", "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent_conv", "conv_id")).alias("parent_conv_id"), "n_convs",
        (F.col("more").cast("long") + F.coalesce("n_attached", F.lit(0))).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """One row per node of the trie of all conversations, rebuilt on their base (``rebuilt``) unless told otherwise.

    conv_id (the least member), depth, parent_conv_id (null for the root), n_convs
    (members), n_children, n_leaves (childless nodes of the subtree), saved_tokens
    (over the subtree, words of a node's last turn times its members but one) and
    ends_sha256 (of the members that end there: their numbers, ascending, comma-joined).

    Turns are ordered by number, null first; those of one number by the MD5 of
    role and text, so repeated rows are turns of their own. Null roles and texts are
    empty. Rows without a conv_id are left out. Other columns are ignored; an
    empty table has no nodes.
    """
    turns = keyed(conversations)
    return prefix_trie(rebuilt(turns) if rebuild else unchanged(turns), turns.count())
