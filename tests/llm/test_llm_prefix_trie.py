import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from odd_rows import plain
from pyspark.sql import functions as F

from rebasket.llm import prefix_trie
from rebasket.llm.prefix_trie import chained, conversation_trie, powers, ranked, times

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
PRIME = (1 << 61) - 1


def by_hand(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:] if base != c else turns
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    children, leaves, saved = {k: 0 for k in nodes}, {k: 0 for k in nodes}, {k: 0 for k in nodes}
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, members in nodes.items():
        cost = (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += cost
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n=160):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-40, 240), n):
        for turn in range(draw.choice((1, 1, 2, 3, 4, 5, 6, 9))):
            text = draw.choice(["a", "b b", "c  c c", "", None]) if draw.random() < 0.8 else f"own {c} {turn}"
            rows.append((c, draw.choice((turn, turn, turn, 1, None)), draw.choice(("user", "user", "assistant", None)), text))
    rows += [(300, t, "user", f"long {t % 7}") for t in range(400)] + [(301, t, "user", f"long {t % 7}") for t in range(380)]
    rows += [(c, 0, "user", "copy") for c in range(400, 470)] + [(c, 1, "user", "same words") for c in range(400, 470, 2)]
    rows += [(None, 0, "user", "of no conversation"), (300, 3, "user", "long 3"), (300, 3, "user", "long 3")]
    draw.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("per_task", [9, 100, 250_000])
def test_nodes_agree_with_brute_force(spark, monkeypatch, per_task):
    monkeypatch.setattr(prefix_trie, "ROWS_PER_TASK", per_task if per_task > 50 else 60)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 5)
    rows = made(per_task)
    found = conversation_trie(frame(spark, rows))
    assert found.columns == COLUMNS
    assert plain(found) == by_hand(rows)


def test_as_they_are_and_given_conversations(spark):
    rows = made(4, 40)
    assert plain(conversation_trie(frame(spark, rows), rebuild=False)) == by_hand(rows, rebuild=False)
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert plain(conversation_trie(given)) == by_hand([tuple(r) for r in given.collect()])


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert plain(conversation_trie(empty)) == []
    for rows in ([(None, 1, "user", "x")], [(7, None, None, None)], [(20, 0, "user", "one two")] * 3, [(1, 0, "a", "bc"), (2, 0, "ab", "c")],
                 [(21, 0, "user", "x"), (22, 0, "user", "y"), (39, 0, "user", "z")]):
        clash = frame(spark, rows).withColumns({c: F.lit(1) for c in ("depth", "row", "words", "part", "skip", "block", "n_convs")})
        assert plain(conversation_trie(clash)) == by_hand(rows)


def test_products_and_powers_modulo_the_prime():
    draw = random.Random(3)
    a, b = ([draw.randrange(PRIME) for _ in range(500)] + [0, 1, PRIME - 1, PRIME - 1] for _ in range(2))
    b[-2:] = [PRIME - 1, 0]
    assert times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % PRIME for x, y in zip(a, b)]
    base = draw.randrange(PRIME)
    assert powers(np.uint64(base), 77).tolist() == [pow(base, i, PRIME) for i in range(77)]


def test_chains_of_the_arcs_at_hand():
    draw = np.random.default_rng(2)
    order = draw.permutation(500)
    here = draw.random(500) < 0.7  # the others lie in another task
    weight = draw.integers(0, 9, 500)
    follow = np.full(500, -1)
    follow[order[:-1]] = order[1:]
    mine = np.flatnonzero(here)
    head, (before,), tail = chained(mine // 7, mine % 7, follow[mine] // 7, np.where(follow[mine] < 0, -1, follow[mine] % 7), [weight[mine]])
    place = {a: i for i, a in enumerate(mine.tolist())}
    at, total = None, 0
    for arc in order.tolist():
        if arc not in place:
            at = None
            continue
        if at is None:
            at, total = place[arc], 0
        assert head[place[arc]] == at and before[place[arc]] == total
        total += weight[arc]
        assert tail[place[arc]] == (follow[arc] < 0 or follow[arc] not in place)


def test_list_ranking_by_tosses(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ROWS_PER_TASK", 40)
    draw = random.Random(8)
    arcs = [(draw.randrange(50), s) for s in range(700)]
    draw.shuffle(arcs)
    rows, expected, leaf, saved = [], [], 0, 0
    for arc, after in zip(arcs, [*arcs[1:], (0, -1)]):
        w = (draw.randrange(2), draw.randrange(100))
        rows.append((*arc, *after, *w))
        expected.append((*arc, leaf, saved))
        leaf, saved = leaf + w[0], saved + w[1]
    draw.shuffle(rows)
    found = ranked(spark.createDataFrame(rows, "c long, s long, nc long, ns long, leaf long, saved long"), len(rows))
    assert plain(found) == sorted(expected, key=repr)
