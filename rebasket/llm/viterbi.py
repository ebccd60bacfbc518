"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation maximises the sum of the vocabulary's piece scores. The
search goes forward over the characters; only positions within the longest
piece of the current one are open. Whenever the paths to all open positions
run through one boundary, the ids before it are final and are given out, so a
text of any length needs the window and what has not converged yet.

Where no piece of the vocabulary crosses a place, paths converge there at once.
Such places (a space after another character, a line end) cut a text into units:
the search goes through each distinct unit once while it is remembered, whatever its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import binary_column, slices, small_batches

SPACE = "▁"
_CACHE_UNITS = 500_000
# within the search U+2581 is a space; a literal one is shown as a lone surrogate, which no text has
_HIDE = {ord(" "): SPACE, ord(SPACE): "\ud800"}
_SHOWN = {"\ud800": SPACE}
_STEP, _PART = 64, 1024  # positions to go on by at least, characters taken in at once at most
_FAR = -1e300
_models: dict[str, "Pieces"] = {}


class Pieces:
    """A vocabulary with scores, and the search over it.

    A character that no piece has is written as its UTF-8 bytes' pieces, at a
    score below all others; so is a literal U+2581, which would else come back
    as a space.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = [b""] * self.size
        self.byte_ids = [0] * 256
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids))
        # by characters: the pieces that go on, the score (below all others, if no piece ends here) and the id
        self.tree: dict[str, tuple] = {}
        for piece in sorted(self.ids, key=len):  # the beginnings of a piece come before it
            node = self.tree
            for k, c in enumerate(piece, 1):
                if c not in node or k == len(piece):
                    ends = k == len(piece)
                    node[c] = (node.get(c, ({},))[0], self.scores[piece] if ends else _FAR, self.ids[piece] if ends else -1)
                node = node[c][0]
        self.unknown = min(self.scores.values()) - 10.0
        free = all(SPACE not in p.lstrip(SPACE) for p in self.ids)  # no piece has a space after another character
        ends = all("\n" not in p for p in self.ids)
        self.units = re.compile(" *[^ \n]+|\n| +" if free and ends else "(?s:.+)")
        self.known: dict[str, bytes] = {}

    def stream(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a normalised text, which comes in parts, given out as soon as they are final.

        Held are the characters, scores and backpointers from the last boundary
        given out: a part of at most ``_PART`` characters, and what has not met yet. Where
        one position only is open, all paths meet; if none such was passed, the
        paths to the open positions are followed back to where they meet.
        """
        tree, unknown, longest = self.tree, self.unknown, self.longest
        text = rest = ""
        ended, at, reach = False, 0, 0
        best, back, ids = [0.0], [0], [-1]  # by position: the score, where the last piece began, its id
        parts = iter(parts)
        while True:
            while not ended and len(text) - at < longest + _STEP:
                more = rest or next(parts, None)
                if more is None:
                    ended = True
                else:
                    text, rest = text + more[:_PART], more[_PART:]
            n = len(text)
            new = n + 1 - len(best)
            best += [_FAR] * new
            back += [0] * new
            ids += [-1] * new
            met = 0
            for at in range(at, n if ended else n - longest + 1):
                node, here, end = tree, best[at], at
                for c in text[at:at + longest]:
                    if c not in node:
                        break
                    node, gain, piece = node[c]
                    end += 1
                    gain += here
                    if gain > best[end]:
                        best[end] = gain
                        back[end] = at
                        ids[end] = piece
                        if end > reach:
                            reach = end
                if here + unknown > best[at + 1]:
                    best[at + 1], back[at + 1], ids[at + 1] = here + unknown, at, -1
                if reach <= at + 1:
                    met = reach = at + 1
            if ended:
                if n:
                    yield self._path(text, back, ids, n)
                return
            at += 1
            met = met or self._meeting(at, best, back)
            if met:
                yield self._path(text, back, ids, met)
                text, at, reach = text[met:], at - met, max(reach - met, 0)
                best = [x - best[met] for x in best[met:]]
                back = [max(x - met, 0) for x in back[met:]]
                ids = ids[met:]

    @staticmethod
    def _meeting(at: int, best: list[float], back: list[int]) -> int:
        """The last boundary that the paths to all open positions share."""
        open_ = {p for p in range(at, len(best)) if best[p] > _FAR}
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(back[last])
        return open_.pop()

    def _path(self, text: str, back: list[int], ids: list[int], end: int) -> list[int]:
        out: list[int] = []
        while end:
            begin = back[end]
            if ids[end] < 0:
                piece = text[begin:end]
                out += [self.byte_ids[b] for b in _SHOWN.get(piece, piece).encode(errors="surrogatepass")][::-1]
            else:
                out.append(ids[end])
            end = begin
        return out[::-1]

    def search(self, unit: str) -> bytes:
        """Ids of a unit (with plain spaces) as little-endian 32-bit integers."""
        return np.array([i for some in self.stream((unit.translate(_HIDE),)) for i in some], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text; a space is put before it, as the vocabulary expects. An empty text has none."""
        if not text:
            return b""
        if len(self.known) > _CACHE_UNITS:
            self.known.clear()
        units = self.units.findall(" " + text)
        known = self.known
        for unit in set(units).difference(known):
            known[unit] = self.search(unit)
        return b"".join(map(known.__getitem__, units))

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids, without the space put before it."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode(errors="replace")[1:]


def pieces(path: str) -> Pieces:
    """One vocabulary per worker and file."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


_SHAPE = "ids array<int>, n_ids long, ids_crc32 long, round_trip boolean"


def _encode(path: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for first, part in slices(binary_column(batch.column(at).cast(pa.large_string()))):
                encoded, same = [], []
                for raw_text in part.to_pylist():
                    text = raw_text.decode()
                    data = model.encode(text)
                    encoded.append(data)
                    same.append(model.decode(np.frombuffer(data, "<u4")) == text)
                counts = np.array([len(d) // 4 for d in encoded], np.int64)
                values = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(part)) for c in batch.columns), pa.ListArray.from_arrays(offsets, values),
                     pa.array(counts), pa.array([zlib.crc32(d) for d in encoded], pa.int64()), pa.array(same, pa.bool_())],
                    names=[*batch.schema.names, "ids", "n_ids", "ids_crc32", "round_trip"])

    return run


def encode_texts(docs: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, and ids, n_ids, ids_crc32 and round_trip: one row per document.

    ``ids_crc32`` is that of the ids as little-endian 32-bit integers;
    ``round_trip`` says whether decoding the ids gives the text. A null text
    counts as empty, which has no ids. Rows of equal or null ids are encoded one
    by one; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    kept = [*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")]
    rows = docs.select(*kept)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_encode(model, len(keep)), f"{shape}, {_SHAPE}").drop("_text")
