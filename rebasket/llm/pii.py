"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The patterns find e-mail addresses, IP addresses, card and phone numbers one kind
at a time, and drop a match that fails its test as a whole. Where such things
stand side by side ("+1 (578) 555-6437 4918187128635271") a pattern runs
across both and loses both. The field reads such a region as a sequence of atoms
(digit runs, letter runs, single signs) and scores whole segments: their form,
digits, checksum and surroundings. Dynamic programming over segments of a bounded
number of atoms chooses boundaries and kinds together.

The weights are fitted on the driver with a bounded sample of texts: on regions
in which every pattern match passed its test, on pairs of such regions side by
side, and on copies of them with a spoilt checksum, number part, sign or domain, or
within a longer token, as regions without personal data.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import binary_column, lowest, raw, slices, small_batches

KINDS = ("email", "ip", "card", "phone")
MOST_ATOMS = 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def ascii_digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def matches(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """The base spans (start, end, kind), and the matches that failed their test.

    E-mail addresses are looked for at each @: the local part is the run of its
    characters before it, so long runs without an @ cost nothing. The lookbehind
    of the IP pattern only skips places within a digit run whose start has failed.
    """
    good: list[tuple[int, int, str]] = []
    failed: list[tuple[int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            good.append((start, domain.end(), "email"))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            good.append((*m.span(), "ip"))
        else:
            failed.append(m.span())
    for m in _CARD.finditer(text):
        digits = ascii_digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            good.append((*m.span(), "card"))
        elif len(digits) >= 12:
            failed.append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= len(ascii_digits(m[0])) <= 15:
            good.append((*m.span(), "phone"))
        else:
            failed.append(m.span())
    return sorted(good, key=_order), failed


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


_TOKEN = re.compile(r"\S+")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[\s\S]")


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Runs of tokens, a single space apart, that hold a digit or @ or only signs of numbers."""
    start = end = None
    hot = False
    for m in _TOKEN.finditer(text):
        token = m[0]
        holds = "@" in token or _DIGIT.search(token) is not None
        if not (holds or not token.strip("+().-")):
            continue
        if end is not None and m.start() == end + 1 and text[end] == " ":
            end, hot = m.end(), hot or holds
            continue
        if hot:
            yield start, end
        (start, end), hot = m.span(), holds
    if hot:
        yield start, end


_FEATURES = [
    "email", "email:form", "email:no dot", "email:word top", "email:free left", "email:free right",
    "ip", "ip:four parts", "ip:small parts", "ip:free left", "ip:free right",
    "card", "card:checksum", "card:one group", "card:fours", "card:issuer", "card:free left", "card:free right", "card:after plus",
    "phone", "phone:plus", "phone:length", "phone:area", "phone:groups", "phone:last four", "phone:free left", "phone:free right", "phone:long group",
    "other", "other:digits", "other:letters", "other:at", "other:plus", "other:long digits",
]
_AT = {name: i for i, name in enumerate(_FEATURES)}
_NUMBER = re.compile(r"[+(]?[0-9][0-9\x20().-]*")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]*[A-Za-z0-9]")


def segment_features(text: str, start: int, end: int) -> dict[str, list[int]]:
    """The features of text[start:end] as a segment of each kind whose outline it has."""
    span = text[start:end]
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    free_left = not (left.isalnum() or left in "@_")
    free_right = not (right.isalnum() or right in "@_")
    found: dict[str, list[str]] = {}
    if "@" in span:
        if span.count("@") == 1 and _MAIL.fullmatch(span):
            domain = span.split("@")[1]
            found["email"] = [
                "email:form" if _DOMAIN.fullmatch(domain) else "email:no dot" if "." not in domain else "",
                "email:word top" if domain.rsplit(".", 1)[-1].isalpha() else "",
                "email:free left" if free_left and left not in "%+-" else "", "email:free right" if free_right and right != "-" else ""]
    elif "0" <= span[-1] <= "9" and _NUMBER.fullmatch(span):
        digits = ascii_digits(span)
        groups = _DIGIT_RUNS.findall(span)
        if span.count(".") == 3 and len(groups) == 4 and len(span) == len(digits) + 3 and span[0] not in "+(":
            found["ip"] = [
                "ip:four parts", "ip:small parts" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "",
                "ip:free left" if free_left and left not in ".+-" else "", "ip:free right" if free_right else ""]
        if 12 <= len(digits) <= 19 and span[0] not in "+(" and len(span) == len(digits) + len(groups) - 1 and not set(span) - _CARD_SIGNS:
            found["card"] = [
                "card:checksum" if luhn(digits) else "",
                "card:one group" if len(groups) == 1 else "card:fours" if all(len(g) == 4 for g in groups[:-1]) else "",
                "card:issuer" if digits[0] in "3456" else "", "card:free left" if free_left else "",
                "card:free right" if free_right else "", "card:after plus" if left in "+(" else ""]
        if 6 <= len(digits) <= 18:
            found["phone"] = [
                "phone:plus" if span[0] == "+" else "", "phone:length" if 9 <= len(digits) <= 15 else "",
                "phone:area" if "(" in span and ")" in span else "", "phone:groups" if 3 <= len(groups) <= 6 else "",
                "phone:last four" if len(groups[-1]) in (3, 4) else "", "phone:free left" if free_left else "",
                "phone:free right" if free_right else "", "phone:long group" if max(map(len, groups)) > 8 else ""]
    return {kind: [_AT[kind], *(_AT[n] for n in names if n)] for kind, names in found.items()}


_DIGIT_RUNS = re.compile(r"[0-9]+")
_CARD_SIGNS = frozenset("0123456789 -")


def atom_features(atom: str) -> list[int]:
    """The features of an atom that belongs to no span."""
    out = [_AT["other"]]
    if atom.isdigit() and atom.isascii():
        out.append(_AT["other:digits"])
        if len(atom) >= 12:
            out.append(_AT["other:long digits"])
    elif atom.isalpha():
        out.append(_AT["other:letters"])
    elif atom == "@":
        out.append(_AT["other:at"])
    elif atom == "+":
        out.append(_AT["other:plus"])
    return out


def lattice(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, int, list[int]]]]:
    """Atom bounds of a region, and its segments (first atom, end atom, kind or -1, features).

    Segments of a kind have at most ``MOST_ATOMS`` atoms and start and end on
    what the kind can start and end with.
    """
    bounds = [start]
    segments = []
    for m in _ATOM.finditer(text, start, end):
        segments.append((len(bounds) - 1, len(bounds), -1, atom_features(m[0])))
        bounds.append(m.end())
    n = len(bounds) - 1
    for i in range(n):
        first = text[bounds[i]]
        if not (first in _LOCAL or first == "("):
            continue
        for j in range(i + 1, min(n, i + MOST_ATOMS) + 1):
            last = text[bounds[j] - 1]
            if last == "\n" or (last not in _LOCAL and last not in "@() "):
                break
            if not (last.isascii() and last.isalnum()):
                continue
            for kind, features in segment_features(text, bounds[i], bounds[j]).items():
                segments.append((i, j, KINDS.index(kind), features))
    segments.sort(key=lambda s: (s[1], s[0], s[2]))
    return bounds, segments


def decode(text: str, start: int, end: int, weights: np.ndarray) -> list[tuple[int, int, str]]:
    """The best segmentation's spans."""
    bounds, segments = lattice(text, start, end)
    best = [0.0] + [-math.inf] * (len(bounds) - 1)
    how: list[tuple | None] = [None] * len(bounds)
    w = weights.tolist()
    for segment in segments:
        i, j, _, features = segment
        value = best[i] + sum(w[f] for f in features)
        if value > best[j]:
            best[j], how[j] = value, segment
    out, at = [], len(bounds) - 1
    while at > 0:
        i, j, kind, _ = how[at]
        if kind >= 0:
            out.append((bounds[i], bounds[j], KINDS[kind]))
        at = i
    return out[::-1]


@dataclass(frozen=True)
class Fit:
    """The bounds and settings of the fit."""

    texts: int = 4000  # sampled texts that hold a digit or an @
    most_bytes: int = 16384  # longer texts are searched, but not fitted on
    regions: int = 200  # per kind
    rounds: int = 60
    rate: float = 0.5
    decay: float = 0.01
    seed: int = 11


def spoilt(region: str, kind: str, draw: random.Random) -> str | None:
    """The region of one span, changed so that it is none."""
    if kind == "card":
        at = draw.choice([m.start() for m in _DIGIT.finditer(region)])
        return region[:at] + str((int(region[at]) + draw.randint(1, 8)) % 10) + region[at + 1:]
    if kind == "ip":
        parts = region.split(".")
        parts[draw.randrange(4)] = str(draw.randint(256, 999))
        return ".".join(parts)
    if kind == "phone":
        return region.replace("+", "", 1)
    local, domain = region.rsplit("@", 1)
    return f"{local}@{domain.split('.')[0]}"


def examples(texts: list[str], fit: Fit) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Labelled regions: (text, spans)."""
    draw = random.Random(fit.seed)
    single: dict[str, list[str]] = {kind: [] for kind in KINDS}
    out: list[tuple[str, list[tuple[int, int, str]]]] = []
    empty = 0
    for text in texts:
        good, failed = matches(text)
        for start, end in regions(text):
            inside = [(a - start, b - start, k) for a, b, k in good if a < end and b > start]
            if any(a < end and b > start for a, b in failed) or end - start > 200:
                continue
            if any(a < 0 or b > end - start for a, b, _ in inside) or any(x[1] > y[0] for x, y in zip(inside, inside[1:])):
                continue
            if not inside and empty < 2 * fit.regions:
                empty += 1
                out.append((text[start:end], []))
            for a, b, kind in inside:
                if len(single[kind]) < fit.regions:
                    single[kind].append(text[start + a:start + b])
    for kind, spans in single.items():
        for span in spans:
            out.append((span, [(0, len(span), kind)]))
            bad = spoilt(span, kind, draw)
            if bad and not any(k == kind for _, _, k in matches(bad)[0]):
                out.append((bad, []))
            if kind != "email":  # digits within a longer token
                out.append((draw.choice("abcdef") + span + draw.choice("abcdef"), []))
    every = [(kind, span) for kind in KINDS for span in single[kind]]
    for kind, span in every:
        other, after = draw.choice(every)
        out.append((f"{span} {after}", [(0, len(span), kind), (len(span) + 1, len(span) + 1 + len(after), other)]))
    return out


def fitted(texts: list[str], fit: Fit = Fit()) -> np.ndarray:
    """Weights of largest penalised likelihood, by gradient steps scaled per weight."""
    weights = np.zeros(len(_FEATURES))
    data = []
    for text, spans in examples(texts, fit):
        bounds, segments = lattice(text, 0, len(text))
        gold = {(a, b, KINDS.index(k)) for a, b, k in spans}
        covered = [(a, b) for a, b, _ in spans]
        held = []
        for i, j, kind, _ in segments:
            a, b = bounds[i], bounds[j]
            held.append((a, b, kind) in gold if kind >= 0 else not any(a < y and b > x for x, y in covered))
        if sum(h for h, s in zip(held, segments) if s[2] >= 0) == len(gold):
            data.append((len(bounds), segments, np.array(held)))
    if not data:
        return weights - np.array([5.0 if n in KINDS else 0.0 for n in _FEATURES])
    flat = [s for _, segments, _ in data for s in segments]
    design = np.zeros((len(flat), len(_FEATURES)))
    for row, segment in enumerate(flat):
        design[row, segment[3]] = 1
    observed = design[np.concatenate([h for _, _, h in data])].sum(axis=0)
    seen = np.full(len(_FEATURES), 1e-8)
    for _ in range(fit.rounds):
        scores = (design @ weights).tolist()
        chance = np.zeros(len(flat))
        first = 0
        for n, segments, _ in data:
            own = scores[first:first + len(segments)]
            chance[first:first + len(segments)] = marginals(n, segments, own)
            first += len(segments)
        gradient = (observed - chance @ design) / len(data) - fit.decay * weights
        seen += gradient ** 2
        weights = weights + fit.rate * gradient / np.sqrt(seen)
    return weights


def marginals(n: int, segments: list, scores: list[float]) -> list[float]:
    """Probability of every segment, by the forward and backward sums (segments ascend by end)."""
    forward = [0.0] + [-math.inf] * (n - 1)
    for (i, j, _, _), s in zip(segments, scores):
        forward[j] = _plus(forward[j], forward[i] + s)
    backward = [-math.inf] * (n - 1) + [0.0]
    for (i, j, _, _), s in sorted(zip(segments, scores), key=lambda x: -x[0][0]):
        backward[i] = _plus(backward[i], backward[j] + s)
    return [math.exp(forward[i] + s + backward[j] - forward[-1]) for (i, j, _, _), s in zip(segments, scores)]


def _plus(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def all_spans(text: str, weights: np.ndarray) -> tuple[list, list]:
    """The base spans, and all spans: a span of the field is added if it meets no base span."""
    base, _ = matches(text)
    every = list(base)
    starts = sorted((a, b) for a, b, _ in base)
    for start, end in regions(text):
        if not (any(c in text[start:end] for c in "@+") or sum(c.isdigit() for c in text[start:end]) >= 4):
            continue
        near = [(a, b) for a, b in starts if a < end and b > start]
        if near and sum(b - a for a, b in near) >= end - start - 1:
            continue
        for a, b, kind in decode(text, start, end, weights):
            if not any(a < y and b > x for x, y in near):
                every.append((a, b, kind))
    return base, sorted(every, key=_order)


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Spans replaced by their kind in brackets; overlapping ones by the first's."""
    out, at, end = [], 0, -1
    for a, b, kind in sorted(spans, key=_order):
        if a >= end:
            out += [text[at:a], f"[{kind.upper()}]"]
        end = max(end, b)
        at = end
    return "".join(out) + text[at:]


_TRIGGER = np.zeros(256, dtype=bool)
_TRIGGER[[*range(48, 58), 64]] = True


def with_triggers(part: pa.Array) -> np.ndarray:
    """Which texts of a binary slice hold a digit or an @; all spans do."""
    data, offsets = raw(part)
    marks = np.concatenate([[0], np.cumsum(_TRIGGER[data])])
    return marks[offsets[1:]] > marks[offsets[:-1]]


def _find(weights: np.ndarray):
    nothing = hashlib.sha256(b"").hexdigest()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, part in slices(binary_column(batch.column("text"))):
                counts = np.zeros((len(part), 4), np.int64)
                shas, spans = [nothing] * len(part), [""] * len(part)
                for i in np.flatnonzero(with_triggers(part)).tolist():
                    base, every = all_spans(part[i].as_py().decode(), weights)
                    for _, _, kind in base:
                        counts[i, KINDS.index(kind)] += 1
                    shas[i] = hashlib.sha256(written(base).encode()).hexdigest()
                    spans[i] = written(every)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(part)), *(pa.array(counts[:, k]) for k in range(4)), pa.array(shas), pa.array(spans)],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return find


def train(docs: DataFrame, fit: Fit = Fit()) -> np.ndarray:
    """Fit on at most ``fit.texts`` texts with a digit or @, of at most ``fit.most_bytes``, by least hash."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(
        (F.octet_length("text") <= fit.most_bytes) & F.col("text").rlike("[0-9@]"))
    rows = lowest(texts, F.xxhash64("doc_id", "text"), fit.texts, texts.count()).collect()
    return fitted([r["text"] for r in rows], fit)


def find_pii(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per document.

    Counts and hash are of the base spans, ``spans`` has all. A null text counts
    as empty and has none; rows of equal or null ids are searched one by one;
    other columns are ignored; an empty table gives no rows.
    """
    weights = train(docs) if weights is None else weights
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _find(weights), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """The same rows and columns, with every span of ``text`` replaced by its kind in brackets.

    ``n_chars``, if there, follows the text; a null text stays null. Null and repeated
    ids are rows like any other, equal texts change alike, an empty table stays empty.
    """
    weights = train(docs) if weights is None else weights
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(at).type
            out: list[str | None] = []
            column = batch.column(at)
            for first, part in slices(binary_column(column)):
                hot = with_triggers(part)
                texts = column.slice(first, len(part)).to_pylist()
                for i in np.flatnonzero(hot).tolist():
                    texts[i] = redacted(texts[i], all_spans(texts[i], weights)[1])
                out += texts
            columns = list(batch.columns)
            columns[at] = pa.array(out, kind)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    small_batches(docs.sparkSession)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
