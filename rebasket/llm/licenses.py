"""License scans: ordered signature rules over whole texts.

A text's words are lowered (A-Z) runs ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``. Rules
(``license_rules``) are hundreds of regular expressions over the words joined by
one space. Three steps a text:

1. Prefilter: hashes of the words tell which keywords occur; only rules whose
   keywords all do are tried, so most texts are never joined.
2. Every rule tried gives the places where its pattern matches, as word intervals.
3. Rules of higher priority come first. A match that lies within one of a higher
   priority, within a longer one of its own priority, or where an earlier rule
   of its priority matches the same words, is suppressed; other overlaps stand.

Base phrases are places of their own: they are never suppressed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .license_rules import RULES, Rule
from .text import Words, binary_column, free_name, slices, small_batches

# the phrases whose places are always reported, and their labels
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x80:] = np.arange(0x80, 0x100)
_PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


@dataclass(frozen=True)
class Found:
    """The places where one rule matches: word intervals, the end exclusive."""

    rule: Rule
    start: int
    end: int


class Scanner:
    """Compiled rules and their keyword gate. Base phrases are rules of priority 0."""

    def __init__(self, rules: Sequence[Rule] = RULES, base: Sequence[tuple[str, str]] = BASE):
        self.base = [Rule(f"base-{i}-{label}", label, 0, 0.8, tuple(dict.fromkeys(phrase.split())), phrase) for i, (phrase, label) in enumerate(base)]
        self.rules = [*self.base, *rules]
        self.patterns = [r.compiled() for r in self.rules]
        words = sorted({k for r in self.rules for k in r.keywords})
        hashes = Words(pa.array([" ".join(words).encode()], pa.large_binary())).hashes
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {words[i]: n for n, i in enumerate(order.tolist())}
        self.needs = [sum(1 << number[k] for k in set(r.keywords)) for r in self.rules]
        self.any_of = np.zeros(len(words), bool)  # one keyword of each rule, the rarest in prose: the longest
        for r in self.rules:
            self.any_of[number[max(r.keywords, key=len)]] = True

    def gate(self, words: Words) -> dict[int, list[int]]:
        """The rules to try, by text: those whose keywords are all among its words."""
        hashes = words.hashes
        place = np.searchsorted(self.hashes, hashes)
        hit = np.flatnonzero(np.append(self.hashes, np.uint64(0))[place] == hashes)
        hit = hit[place[hit] < len(self.hashes)]
        texts = np.searchsorted(words.bounds, hit, side="right") - 1
        pairs = np.unique(texts * len(self.hashes) + place[hit])
        texts, numbers = pairs // len(self.hashes), pairs % len(self.hashes)
        out: dict[int, list[int]] = {}
        for text in np.unique(texts[self.any_of[numbers]]).tolist():
            a, b = np.searchsorted(texts, [text, text + 1])
            held = 0
            for n in numbers[a:b].tolist():
                held |= 1 << n
            tried = [i for i, need in enumerate(self.needs) if held & need == need]
            if tried:
                out[text] = tried
        return out

    def matches(self, joined: bytes, tried: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rule number, first word and word after the last of every match in words joined by one space."""
        found = [(i, m.start(), m.end()) for i in tried for m in self.patterns[i].finditer(joined)]
        rule, start, end = np.array(found, np.int64).reshape(-1, 3).T
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
        return rule, np.searchsorted(spaces, start), np.searchsorted(spaces, end) + 1

    def kept(self, rule: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which matches no other suppresses; base phrases stand outside."""
        keep = rule < len(self.base)
        priority = np.array([r.priority for r in self.rules])[rule]
        above_start, above_reach = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for level in np.unique(priority[~keep])[::-1].tolist():
            own = np.flatnonzero((priority == level) & ~keep)
            own = own[np.lexsort((rule[own], -end[own], start[own]))]
            s, e = start[own], end[own]
            # the furthest end of those that start earlier, or as early and before it in this order
            reach = np.concatenate([[-1], np.maximum.accumulate(e)[:-1]])
            free = reach < e
            if len(above_start):
                at = np.searchsorted(above_start, s, side="right") - 1
                free &= (at < 0) | (above_reach[np.maximum(at, 0)] < e)
            chosen = own[free]
            keep[chosen] = True
            above_start = np.concatenate([above_start, start[chosen]])
            ends = np.concatenate([above_reach, end[chosen]])
            order = np.argsort(above_start, kind="stable")
            above_start, above_reach = above_start[order], np.maximum.accumulate(ends[order])
        return keep


_scanners: dict[tuple, Scanner] = {}


def _scanner(rules: tuple[Rule, ...], base: tuple[tuple[str, str], ...]) -> Scanner:
    """One scanner per worker and rule set."""
    key = (rules, base)
    if key not in _scanners:
        _scanners[key] = Scanner(rules, base)
    return _scanners[key]


_PLACE = pa.struct([
    ("rule", pa.string()), ("label", pa.string()), ("confidence", pa.float64()), ("base", pa.bool_()),
    ("start", pa.int64()), ("end", pa.int64()), ("words", pa.string()),
])
_PLACES = "array<struct<rule: string, label: string, confidence: double, base: boolean, start: long, end: long, words: string>>"


def _scan(rules: tuple[Rule, ...], base: tuple[tuple[str, str], ...], at: int, names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules, base)
        for batch in batches:
            for first, part in slices(binary_column(batch.column(at).cast(pa.large_string()))):
                words = Words(part, table=_PLAIN)
                places: list[list[dict]] = [[] for _ in range(len(part))]
                for text, tried in scanner.gate(words).items():
                    joined = words.data[words.offsets[text]:words.offsets[text + 1]].tobytes().split()
                    rule, start, end = scanner.matches(b" ".join(joined), tried)
                    keep = np.flatnonzero(scanner.kept(rule, start, end))
                    for i in keep[np.lexsort((rule[keep], end[keep], start[keep]))].tolist():
                        own, a, b = scanner.rules[rule[i]], int(start[i]), int(end[i])
                        places[text].append({
                            "rule": own.name, "label": own.label, "confidence": own.confidence, "base": own.priority == 0,
                            "start": a, "end": b, "words": b" ".join(joined[a:b]).decode()})
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(part)) for c in batch.columns[:at]), pa.array(np.diff(words.bounds)), pa.array(places, pa.list_(_PLACE))],
                    names=[*batch.schema.names[:at], *names])

    return run


def scan(docs: DataFrame, keep: list[str], rules: Sequence[Rule] = RULES, base: Sequence[tuple[str, str]] = BASE) -> DataFrame:
    """The columns ``keep``, n_words and places: one row per document, in one pass without a shuffle.

    (The two are lengthened if a kept column has their name.)
    ``places`` holds the base phrases and the matches that stand, by start: rule,
    label, confidence, base, start and end (words from 0, the end exclusive) and
    the words. A null or empty text, or one without words, has no places. Rows
    of equal or null ids are scanned one by one; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    text = free_name(keep, "text")
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text))
    names = (free_name(keep, "n_words"), free_name(keep, "places"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_scan(tuple(rules), tuple(base), len(keep), names), f"{shape}, {names[0]} long, {names[1]} {_PLACES}")


def licenses(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[tuple[str, str]] = BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per document.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word``
    are their least and greatest start (null without any). Labels are distinct,
    sorted and joined by commas ('' without any). ``score`` is the highest
    confidence of what was found, 0 for nothing. Odd rows as in ``scan``; other
    columns are ignored.
    """
    found = scan(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ["doc_id"], rules, base)
    of_base = F.filter("places", lambda p: p["base"])
    starts = F.transform(of_base, lambda p: p["start"])

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(of_base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(of_base).alias("base_labels"), joined("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["confidence"])), F.lit(0.0)).alias("score"),
    )
