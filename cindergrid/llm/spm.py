"""SentencePiece encoding and decoding with a streaming lattice over the pieces of a public BPE model.

The vocabulary at hand is of the BPE kind, whose ids are not those of the best sum of scores, so the lattice is the
Viterbi pass with BPE's own rule in place of the sum: a path may go from one piece to the next only if BPE would keep
the two apart, and then every boundary has exactly one surviving piece (a sequence of pieces is BPE's encoding just
when each adjacent pair is). A window of the last ``longest piece`` boundaries holds the surviving backpointers; as soon
as all of them lead back to one boundary, the ids up to it are committed, so memory is bounded whatever the text's
length. No piece has a space mark after another character, nor a letter beside a full stop and so on (the sets are read
off the vocabulary), so boundaries there always commit; what the lattice found for a part between two of them is
remembered in a bounded memo.

Characters that no piece has become UTF-8 byte pieces. A text's own U+2581 (the space mark) is written as bytes too, so
decoding gives every text back exactly. Nulls and edges: a null text has null ids and decodes to null; an empty one has
no ids. Rows with a repeated id stay separate; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"
MEMO = 200_000
#: No piece; a character without a piece; the beginning.
NONE, UNKNOWN, START = -1, -2, -3


class Pieces:
    """The vocabulary of a SentencePiece BPE model, with byte pieces."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.ids, self.rank, self.bytes, self.text = {}, {}, {}, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.text.append(piece)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.rank[piece] = -sp.get_score(i)
        # BPE never makes a piece that it would not make of the piece's own characters
        self.ids = {p: i for p, i in self.ids.items() if self.merge(p) == 1}
        self.longest = max(map(len, self.ids))
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.raw = [byte_of.get(i) or p.replace(MARK, " ").encode() for i, p in enumerate(self.text)]
        self.parts = re.compile("|".join(f"{MARK}*[{re.escape(''.join(sorted(x)))}]+" for x in self._joined()) + f"|{MARK}*[^{MARK}]|{MARK}+", re.DOTALL)
        self.apart: list[dict[int, bool]] = [{} for _ in self.text]
        self.pairs = 0
        self.memo: dict[str, bytes] = {}
        # By characters from the last one back; under "" all (length, id) of pieces on the way, the longest first.
        self.ends: dict = {}
        for p, i in self.ids.items():
            node = self.ends
            for char in reversed(p):
                node = node.setdefault(char, {})
            node[""] = ((len(p), i),)
        open_ = [(self.ends, ())]
        while open_:
            node, above = open_.pop()
            own = node[""] = node.get("", ()) + above
            open_ += [(below, own) for char, below in node.items() if char]

    def _joined(self) -> list[set[str]]:
        """Sets of characters, the largest first, such that no piece has characters of two sets or of none beside each
        other. A space mark is in no set: it only ever comes before."""
        found: dict[str, set[str]] = {}
        for piece in self.ids:
            for x, y in zip(piece, piece[1:]):
                if MARK not in (x, y):
                    a, b = found.setdefault(x, {x}), found.setdefault(y, {y})
                    if a is not b:
                        a |= b
                        for char in b:
                            found[char] = a
        return sorted({id(x): x for x in found.values()}.values(), key=lambda x: (-len(x), min(x)))

    def merge(self, text: str, kept: int = 0) -> int:
        """How many pieces BPE, by its definition, leaves of a text; 0 as soon as it merges across the boundary after
        `kept` characters. For texts of at most two pieces' length."""
        parts, rank, none = list(text), self.rank.get, float("inf")
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            if at + 1 == kept:
                return 0
            if at + 1 < kept:
                kept -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
        return len(parts)

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether BPE keeps piece a before piece b as they are."""
        if self.pairs >= MEMO:
            self.apart = [{} for _ in self.text]
            self.pairs = 0
        self.pairs += 1
        known = self.apart[a][b] = self.merge(self.text[a] + self.text[b], len(self.text[a])) > 0
        return known

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in (MARK if char == MARK else char).encode("utf-8", "surrogatepass")]

    def _settle(self, text: str, own: list, back: list[int], at: int) -> int:
        """Finds the surviving piece at a boundary, and at those before it that this depends on."""
        node, begin = self.ends, at
        while begin:
            step = node.get(text[begin - 1])
            if step is None:
                break
            node = step
            begin -= 1
        for size, piece in node[""]:
            begin = at - size
            before = own[begin]
            if before is None:
                before = self._settle(text, own, back, begin)
            if before < 0:  # nothing merges with the beginning, or with a character without a piece
                break
            fits = self.apart[before].get(piece)
            if self.stay_apart(before, piece) if fits is None else fits:
                break
        else:
            piece, begin = self.ids.get(text[at - 1], UNKNOWN), at - 1
            if own[begin] is None:
                self._settle(text, own, back, begin)
        own[at], back[at] = piece, begin
        return piece

    def stream(self, chars: Iterable[str]) -> Iterator[int]:
        """Ids of a run of characters, committed while it streams by. Boundaries count from the committed one: own has
        the surviving piece that ends there (None: not asked for yet), back where it begins."""
        block, chars, text, own, back = 2 * self.longest, iter(chars), "", [START], [0]
        while True:
            got = "".join(islice(chars, block))
            text += got
            own += [None] * len(got)
            back += [0] * len(got)
            n = len(text)
            if len(got) < block:
                break
            # later boundaries lead back to one of the last `longest`: do the paths of all these meet?
            meet = set(range(n - self.longest + 1, n + 1))
            for at in meet:
                if own[at] is None:
                    self._settle(text, own, back, at)
            while len(meet) > 1:
                far = max(meet)
                meet.discard(far)
                meet.add(back[far])
            to = meet.pop()
            if to:
                yield from self._path(text, own, back, to)
                text, own, back = text[to:], own[to:], [b - to for b in back[to:]]
        if n:
            if own[n] is None:
                self._settle(text, own, back, n)
            yield from self._path(text, own, back, n)

    def _path(self, text: str, own: list[int], back: list[int], to: int) -> list[int]:
        """Ids of the surviving path to a boundary."""
        found: list[int] = []
        while to:
            begin = back[to]
            if own[to] >= 0:
                found.append(own[to])
            else:
                found += self.fallback(text[begin:to])[::-1]
            to = begin
        return found[::-1]

    def part(self, part: str) -> bytes:
        """Ids of a part as little-endian 32-bit numbers. Parts that fit the window are remembered."""
        if len(self.memo) >= MEMO:
            self.memo.clear()
        found = array("i", self.stream(part)).tobytes()
        if len(part) < 2 * self.longest:
            self.memo[part] = found
        return found

    def encode(self, text: str) -> bytes:
        get, part, find, out = self.memo.get, self.part, self.parts.findall, []
        for own, plain in enumerate(text.split(MARK) if text else ()):  # a mark of the text's own never meets those of spaces
            if own:
                out.append(array("i", self.fallback(MARK)).tobytes())
            plain = plain.replace(" ", MARK)
            out += [get(p) or part(p) for p in find(plain if own else MARK + plain)]
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def _lists(rows: list[bytes | None]) -> pa.Array:
    offsets = np.cumsum([0, *(len(r) // 4 if r else 0 for r in rows)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(r for r in rows if r), np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([r is None for r in rows]))


def _texts(column: pa.Array, pieces: Pieces) -> pa.Array:
    offsets, values, known = column.offsets.to_numpy(), column.values.to_numpy(), column.is_valid().to_pylist()
    return pa.array([pieces.decode(values[a:b].tolist()) if ok else None for a, b, ok in zip(offsets, offsets[1:], known)], pa.string())


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model_file))  # its size is the vocabulary's

    def encoded(batches):
        pieces = shared.value
        for batch in slices(batches, 500):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([None if t is None else pieces.encode(t) for t in batch.column(1).to_pylist()])], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model_file))

    def decoded(batches):
        for batch in slices(batches, 500):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _texts(batch.column(1), shared.value)], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, text): decode(encode(docs)) in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model_file))

    def both(batches):
        pieces = shared.value
        for batch in slices(batches, 500):
            ids = _lists([None if t is None else pieces.encode(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, _texts(ids, pieces)], ["doc_id", "ids", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(both, "doc_id long, ids array<int>, text string")
