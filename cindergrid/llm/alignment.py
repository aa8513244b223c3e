"""Alignment of two tokenizers' encodings of the same texts, and corpus counts of the ids that they link.

A is a byte-level BPE vocabulary, B one of SentencePiece pieces; both encode a space and the text. A token's end is a byte
offset. Within a text the shorter list of ends drives: each of its ends is looked for in the longer one by steps that double
from where it is likely to be, either way, and then by halving what they enclose; all ends of a batch go in lockstep. Ends
found in both lists cut the tokens into groups, and the differences of two neighbours' ranks are the tokens of the longer
list that a token of the shorter one overlaps: its links.

Counts (how many documents hold an id pair linked) never go along with single documents: consecutive documents of a task
form a chunk, bounded by its pairs, which states its distinct pairs once; these are counted over the corpus, and
the counts go back to the chunk, where each document picks its own. So a frequent pair moves once for each chunk.

Encoding asks the two libraries for parts of texts: neither vocabulary has a token across a space or line break that follows
a character which is no white space (this is looked up in B's pieces; for A it is a rule of such vocabularies), so texts
are cut there and known parts remembered, in a bounded memo that changes no result.

Nulls and edges: a text that is null or empty, or that either vocabulary does not spell byte by byte (such as one with
U+2581), has no tokens, zeros and an empty digest. Rows with a repeated or null id stay separate and count each as a
document. A batch holds texts of two MB together, or one longer text. An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

MARK = "▁"
#: Characters of remembered parts; bytes of text in a batch, if it is not one text; pairs of documents in a chunk.
MEMO, BATCH, CHUNK = 4_000_000, 1 << 21, 1 << 20
#: Fixed value: how texts are cut before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PART = re.compile(r"[ \n](?:[^ \n]+|(?<=\s)[ \n])*")


def byte_values() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else 256 and up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}


class Encoder:
    """Ids and byte lengths of parts of texts in both vocabularies."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        with open(byte_file, encoding="utf-8") as f:
            stated = json.load(f)
        tokenizer = Tokenizer.from_file(byte_file)
        tokenizer.encode_special_tokens = True
        value, named = byte_values(), {t["id"]: t["content"] for t in stated.get("added_tokens", [])}
        self.bytes_a = [b""] * tokenizer.get_vocab_size()
        for token, i in tokenizer.get_vocab().items():
            self.bytes_a[i] = named[i].encode() if i in named else bytes(value[c] for c in token)
        self.encode_a = self._by_ranks(stated, named) or (lambda parts: [x.ids for x in tokenizer.encode_batch(parts, add_special_tokens=False)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.prefix = self.b.piece_to_id(MARK)
        whole = any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p, re.DOTALL) for i, p in enumerate(pieces) if not self.b.is_byte(i))
        self.part = re.compile(r"[\s\S]+") if whole else PART
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.good = array("b")  # whether both spell the part
        self.ids, self.lengths, self.counts = ((array("i"), array("i")) for _ in range(3))

    def _by_ranks(self, stated: dict, named: dict):
        """The encoding through byte ranks, which is the same and faster, where ids follow the merges' order and the file
        asks for nothing but the usual cutting of texts; else None."""
        import tiktoken

        model, cut = stated["model"], stated.get("pre_tokenizer") or {}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not stated.get("normalizer")
        if not plain or any(model["vocab"].get(m) != 256 + i for i, m in enumerate(merged)) or any(len(b) != 1 for b in self.bytes_a[:256]):
            return None
        ranks = {b: i for i, b in enumerate(self.bytes_a) if i not in named}
        ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda parts: list(map(ranked.encode_ordinary, parts))

    def _spell(self, side: int, parts: list[str], found: list[list[int]]) -> np.ndarray:
        """Remembers the tokens of new parts; whether they spell each part byte by byte."""
        table = (self.bytes_a, self.bytes_b)[side]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = list(chain.from_iterable(found))
        raw = [table[i] for i in flat]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ids[side].frombytes(np.array(flat, np.int32).tobytes())
        self.lengths[side].frombytes(lengths.astype(np.int32).tobytes())
        self.counts[side].frombytes(counts.astype(np.int32).tobytes())
        want = [p.encode() for p in parts]
        ends = np.cumsum(counts)
        size = np.concatenate(([0], np.cumsum(lengths)))
        good = size[ends] - size[ends - counts] == np.fromiter(map(len, want), np.int64, len(want))
        good &= np.bincount(np.repeat(np.arange(len(parts)), counts), lengths == 0, len(parts)) == 0
        if b"".join(raw) != b"".join(want):
            for k in np.flatnonzero(good):
                good[k] = b"".join(raw[ends[k] - counts[k] : ends[k]]) == want[k]
        return good

    def parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of all texts, one text after another, and how many each has."""
        if self.size > MEMO:
            self.clear()
        cut = [self.part.findall(" " + t) for t in texts]
        new = list(dict.fromkeys(p for parts in cut for p in parts if p not in self.known))
        if new:
            from_b = self.b.encode([p[p[0] == " " :] for p in new], num_threads=1)
            for k, p in enumerate(new):
                if p[0] != " ":  # the library puts a space before it, which is not this part's
                    from_b[k] = from_b[k][1:] if from_b[k][:1] == [self.prefix] else [0]
                elif p == " ":  # an empty text has no pieces by itself
                    from_b[k] = [self.prefix]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.size += sum(map(len, new)) + 8 * len(new)
            self.good.frombytes((self._spell(0, new, self.encode_a(new)) & self._spell(1, new, from_b)).astype(np.int8).tobytes())
        get = self.known.__getitem__
        return np.fromiter((get(p) for parts in cut for p in parts), np.int64, sum(map(len, cut))), np.array(list(map(len, cut)), np.int64)

    def tokens(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and byte lengths of the tokens of these parts, and how many each part has."""
        ids, lengths, counts = (np.array(x[side], np.int64) for x in (self.ids, self.lengths, self.counts))
        at = spread((np.cumsum(counts) - counts)[numbers], counts[numbers])
        return ids[at], lengths[at], counts[numbers]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), then starts[1], ..."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def gallop(x: np.ndarray, longer: np.ndarray, guess: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each x the least index from first to last at which longer is x or more (at last it is): exponential steps from
    the guess, upwards or downwards, then halving."""
    low, high, at = first - 1, last.copy(), np.clip(guess, first, last)  # the index is above low and at most high
    up = longer[at] < x
    low, high = np.where(up, at, low), np.where(up, high, at)
    step, open_ = 1, np.flatnonzero(low + 1 < high)
    rising = up[open_]
    while len(open_):
        probe = np.where(rising, at[open_] + step, at[open_] - step)
        inside = (probe > low[open_]) & (probe < high[open_])
        open_, rising, probe = open_[inside], rising[inside], probe[inside]
        below = longer[probe] < x[open_]
        low[open_] = np.where(below, probe, low[open_])
        high[open_] = np.where(below, high[open_], probe)
        on = below == rising  # not passed yet
        open_, rising = open_[on], rising[on]
        step *= 2
    open_ = np.flatnonzero(low + 1 < high)
    while len(open_):
        mid = (low[open_] + high[open_]) // 2
        below = longer[mid] < x[open_]
        low[open_] = np.where(below, mid, low[open_])
        high[open_] = np.where(below, high[open_], mid)
        open_ = open_[low[open_] + 1 < high[open_]]
    return high


@dataclass
class Aligned:
    """Tokens of a batch of texts: how many each text has (n: A, B), ids, whether a token ends a group, and the links as
    indices of an A and a B token, with the text of each."""

    n: tuple[np.ndarray, np.ndarray]
    ids: tuple[np.ndarray, np.ndarray]
    cut: tuple[np.ndarray, np.ndarray]
    link_a: np.ndarray
    link_b: np.ndarray
    link_text: np.ndarray


def align(n: tuple, ids: tuple, ends: tuple) -> Aligned:
    """Ends are byte offsets in the batch's texts, put one after another."""
    begin = [np.cumsum(x) - x for x in n]
    cut = tuple(np.zeros(len(x), bool) for x in ids)
    found = []
    for s in (0, 1):  # texts whose A tokens are as few as their B tokens or fewer, then the others
        t = 1 - s
        texts = np.flatnonzero((n[s] > 0) & ((n[s] <= n[t]) if s == 0 else (n[s] < n[t])))
        own, text = spread(begin[s][texts], n[s][texts]), np.repeat(texts, n[s][texts])
        nth = own - begin[s][text]
        first, last = begin[t][text], begin[t][text] + n[t][text] - 1
        x = ends[s][own]
        rank = gallop(x, ends[t], first + nth * n[t][text] // n[s][text], first, last)
        both = ends[t][rank] == x
        cut[s][own], cut[t][rank[both]] = both, True
        start = np.where(nth == 0, first, np.concatenate(([0], rank[:-1] + both[:-1])) if len(rank) else first)
        many = rank - start + 1
        pair = (np.repeat(own, many), spread(start, many))
        found.append((pair[s], pair[t], np.repeat(text, many)))
    return Aligned(n, ids, cut, *(np.concatenate(x) for x in zip(*found)))


def spelled(found: Aligned) -> list[bytes]:
    """Each text's groups as a1,a2|b1;a3|b2,b3."""
    (cut_a, cut_b), (ids_a, ids_b) = found.cut, found.ids
    group = [np.cumsum(c) - c for c in found.cut]
    until_a, until_b = (np.flatnonzero(c) + 1 for c in found.cut)
    total = len(ids_a) + len(ids_b)
    value, mark = np.empty(total, np.int64), np.empty(total, np.uint8)
    place = np.arange(len(ids_a)) + np.concatenate(([0], until_b))[group[0]], np.arange(len(ids_b)) + (until_a[group[1]] if len(ids_b) else 0)
    for at, ids, c, sign in zip(place, found.ids, found.cut, b"|;"):
        value[at], mark[at] = ids, np.where(c, sign, ord(","))
    digits = len(str(int(value.max()))) if total else 1
    out = np.zeros((total, digits + 1), np.uint8)
    out[:, digits] = mark
    rest = value
    for k in range(digits - 1, -1, -1):
        out[:, k] = np.where((rest > 0) | (k == digits - 1), rest % 10 + 48, 0)
        rest = rest // 10
    size = np.count_nonzero(out, axis=1)
    data = out[out > 0].tobytes()
    ends = np.concatenate(([0], np.cumsum(size)))[np.cumsum(found.n[0] + found.n[1])]
    return [data[a : max(a, b - 1)] for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]


def _grouped(batches):
    """Lists of rows (doc_id, text) of at most BATCH bytes together, or of one row."""
    for batch in batches:
        size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(size, size[a] + BATCH, side="right")) - 1)
            yield batch.slice(a, b - a)
            a = b


CHUNKED = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slots array<int>, times array<int>, pairs array<long>, docs array<int>"
_FIELDS = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("slots", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
])


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))


def _read(encoder: Encoder, texts: list[str | None]) -> Aligned:
    number, n_parts = encoder.parts([t or "" for t in texts])
    good = np.array([bool(t) for t in texts])
    bad = ~np.array(encoder.good, bool)[number]
    good[np.repeat(np.arange(len(texts)), n_parts)[bad]] = False
    number = number[np.repeat(good, n_parts)]
    n_parts = np.where(good, n_parts, 0)
    text = np.repeat(np.arange(len(texts)), n_parts)
    sides = [encoder.tokens(s, number) for s in (0, 1)]
    n = tuple(np.bincount(text, counts, len(texts)).astype(np.int64) for _, _, counts in sides)
    return align(n, tuple(ids for ids, _, _ in sides), tuple(np.cumsum(lengths) for _, lengths, _ in sides))


def chunks(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """For each document its counts, its digest, and its distinct pairs (as slots of its chunk's list) with how often they
    are linked; and for each chunk a row with its distinct pairs and how many of its documents hold each."""

    def made(batches):
        encoder, chunk, held, n_held = Encoder(byte_file, piece_file), TaskContext.get().partitionId() << 32, [], 0
        wide = len(encoder.bytes_b)

        def told():
            pairs, slot = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
            at = 0
            for columns, keys, counts, times in held:
                own = slot[at : at + len(keys)]
                at += len(keys)
                m = len(columns[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, chunk)), *columns, _lists(own, counts, pa.int32()), _lists(times, counts, pa.int32()), pa.nulls(m, _FIELDS.field("pairs").type), pa.nulls(m, _FIELDS.field("docs").type)], schema=_FIELDS)
            if len(pairs):
                own = [pa.array([chunk]), *(pa.nulls(1, f.type) for f in list(_FIELDS)[1:9])]
                yield pa.RecordBatch.from_arrays([*own, _lists(pairs, [len(pairs)], pa.int64()), _lists(np.bincount(slot), [len(pairs)], pa.int32())], schema=_FIELDS)

        for batch in _grouped(batches):
            found = _read(encoder, batch.column("text").to_pylist())
            m = batch.num_rows
            digest = pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in spelled(found)])
            groups = np.bincount(np.repeat(np.arange(m), found.n[0]), found.cut[0], m).astype(np.int64)
            span = wide * len(encoder.bytes_a)
            key, times = np.unique(found.link_text * span + found.ids[0][found.link_a] * wide + found.ids[1][found.link_b], return_counts=True)
            counts = np.bincount(key // span, minlength=m)
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (*found.n, groups, np.bincount(found.link_text, minlength=m))), digest]
            held.append((columns, key % span, counts, times))
            n_held += len(key)
            if n_held >= CHUNK:
                yield from told()
                chunk, held, n_held = chunk + 1, [], 0
        if held:
            yield from told()
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, CHUNKED)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _answered(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums over their links."""
    size = answers.num_rows
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    slot = answers.column("slot").to_numpy()
    count[slot], best[slot] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
    slots, times = (docs.column(c).combine_chunks() for c in ("slots", "times"))
    n = slots.value_lengths().to_numpy()
    own, times = slots.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(n)))

    def total(of):  # exact, unlike a weighted bincount
        sums = np.concatenate(([0], np.cumsum(of[own] * times)))
        return pa.array(sums[ends[1:]] - sums[ends[:-1]])

    base = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return base.append_column("n_best", total(best)).append_column("count_sum", total(count)).append_column("groups_sha256", docs.column("groups_sha256"))


def linked(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """The alignment of every row of docs (doc_id, text), with corpus counts over its links."""
    found = stash(chunks(docs, byte_file, piece_file), "aligned")
    wide = len(Encoder(byte_file, piece_file).bytes_b)
    asked = found.filter("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("slot", "x")).select("chunk", "slot", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = stash(asked.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    a = F.floor(F.col("pair") / wide).alias("a")
    most = F.broadcast(counts.groupBy(a).agg(F.max("count").alias("most")))  # a row for each id of the vocabulary at most
    known = counts.withColumn("a", a).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    answers = asked.select("chunk", "slot", "pair").join(known, "pair").select(F.col("chunk").alias("of"), "slot", "count", "best")
    rows = found.filter("pairs is null").drop("pairs", "docs")
    return rows.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_answered, RESULT)
