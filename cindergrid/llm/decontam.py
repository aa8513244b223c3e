"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and texts are normalised alike: ASCII letters in lower case, words of ASCII letters and digits and of anything
beyond ASCII. The automaton accepts every run of words that occurs in some item, never across items. A task streams the
words of a text through it and keeps the length of the longest match that ends at each word. From that length follow
the words that lie inside an occurrence of a window (``window`` item words, or a whole shorter item) and, by the
automaton's suffix links, the items that have that window.

The items are the stated query set. They are fetched in blocks of at most ``block_words`` words, each of which has its
own automaton, the only thing that is broadcast, about 600 bytes a word. Texts pass through one block at a time, so
neither the driver nor a task ever holds more than one, and no item is left out.

Nulls and edges: a null text or item has no words; texts without words have no hits and are clean; items with equal
texts all count; rows with a repeated doc_id stay separate; repeated item_ids count once. An empty benchmark hits
nothing. Extra columns stay in ``clean`` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slices, stash

#: Bytes that are no part of a word become spaces, ASCII upper case becomes lower case.
NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split() if text else []


class SuffixAutomaton:
    """Of the word sequences of items [(item_id, text)]."""

    def __init__(self, items: list[tuple], window: int = 13):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, link = [0], [-1]
        sequences, ends = [], []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                sequences.append((item_id, ids))
        for _, ids in sequences:
            last = 0
            for w in ids:
                last = self._extend(last, w, link)
            ends.append(last)
        # A state of matches of `window` words and more points to the ancestor (or itself) that holds the window.
        # Items that have a window: spelled along each item. Shorter items are their own window.
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.home: list[int] = [0] * len(self.length)  # the state that holds the window, or 0
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.length)  # (words, mark) of short items ending here
        marks: dict[int, set] = {}
        own: dict[int, dict[int, int]] = {}
        for (item_id, ids), end in zip(sequences, ends):
            if len(ids) < window:
                mark = -1 - end
                own.setdefault(end, {})[len(ids)] = mark
                marks.setdefault(mark, set()).add(item_id)
        for s in order:
            p = link[s]
            if self.length[s] >= window:
                self.home[s] = s if self.length[p] < window else self.home[p]
            found = dict(self.short[p])
            found.update(own.get(s, {}))
            self.short[s] = tuple(sorted(found.items()))
        for item_id, ids in sequences:
            state = 0
            for i, w in enumerate(ids):
                state = self.next[state][w]
                if i + 1 >= window:
                    marks.setdefault(self.home[state], set()).add(item_id)
        self.window, self.link = window, link
        self.marks = {k: frozenset(v) for k, v in marks.items()}

    def _extend(self, last: int, w: int, link: list[int]) -> int:
        nxt, length = self.next, self.length
        if w in nxt[last]:  # the generalised case: the run is there already
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, q, w, link)
        new = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w, link)
        return new

    def _split(self, p: int, q: int, w: int, link: list[int]) -> int:
        nxt, length = self.next, self.length
        copy = len(length)
        length.append(length[p] + 1)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, longest matching length that ends there, state), where a word matches at all."""
        nxt, length, link, get = self.next, self.length, self.link, self.vocabulary.get
        state = n = 0
        for i, word in enumerate(words):
            w = get(word)
            if w is None:
                state = n = 0
                continue
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            got = nxt[state].get(w)
            if got is None:
                state = n = 0
                continue
            state, n = got, n + 1
            yield i, n, state

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans [begin, end) of hit words, and the marks of the windows that occur."""
        spans, marks, window, home, short = [], set(), self.window, self.home, self.short
        for i, n, state in self.matches(words):
            if n >= window:
                marks.add(home[state])
                spans.append((i + 1 - n, i + 1))
            for size, mark in short[state]:
                if size <= n:
                    marks.add(mark)
                    spans.append((i + 1 - size, i + 1))
        return spans, marks


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, window: int = 13, block_words: int = 200_000) -> Iterator[SuffixAutomaton]:
    """One automaton for each block of at most block_words item words (a longer item is a block of its own), one at a
    time."""
    block, held = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), "text").filter("text is not null").toLocalIterator():
        n = len(words_of(text))
        if block and held + n > block_words:
            yield SuffixAutomaton(block, window)
            block, held = [], 0
        block.append((item_id, text))
        held += n
    if block:
        yield SuffixAutomaton(block, window)


ITEM_ORDER = str.encode
HITS = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
HITS_DDL = "n_words long, spans array<array<long>>, items array<string>"


def _hits(docs: DataFrame, automaton: SuffixAutomaton | None) -> tuple[DataFrame, Broadcast]:
    """docs with n_words, spans and items by one automaton, which is broadcast."""
    shared, at = docs.sparkSession.sparkContext.broadcast(automaton), docs.columns.index("text")

    def found(batches):
        for batch in slices(batches):
            rows = []
            for text in batch.column(at).to_pylist():
                words, spans, items = words_of(text), [], set()
                if shared.value is not None:
                    spans, marks = shared.value.hits(words)
                    items = {i for m in marks for i in shared.value.marks[m]}
                rows.append((len(words), [list(x) for x in merged(spans)], sorted(items, key=ITEM_ORDER)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, f.type) for c, f in zip(zip(*rows), HITS))], names=[*batch.schema.names, *HITS.names])

    return docs.mapInArrow(found, StructType([*docs.schema, *StructType.fromDDL(HITS_DDL)])), shared


def _over(spans: list, n_words: int, coverage: Fraction) -> bool:
    n_hit = sum(b - a for a, b in spans)
    return n_hit > 0 and n_hit * coverage.denominator >= coverage.numerator * n_words


def judged(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 200_000) -> DataFrame:
    """docs, with all their columns (text among them), and n_words, spans (array of [begin, end) in words, apart and in
    order) and items. A benchmark of one block meets the texts in one pass. A larger one takes a pass for each block,
    over a table of the numbered texts; automata never stand in memory together, and what the passes hit is put together
    by the texts' numbers."""
    blocks = automata(benchmark, window, block_words)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        return _hits(docs, first)[0]
    rows = stash(docs.withColumn("_rid", F.monotonically_increasing_id()), "numbered-texts")
    texts, found = rows.select("_rid", "text"), None
    for automaton in chain((first, second), blocks):
        hit, shared = _hits(texts, automaton)
        hit = stash(hit.filter(F.size("spans") > 0).select("_rid", "spans", "items"), "hits")
        shared.destroy()
        found = hit if found is None else found.unionByName(hit)
    found = found.groupBy("_rid").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"))
    at = rows.columns.index("text")

    def together(batches):
        for batch in slices(batches):
            texts, spans, items = (batch.column(i).to_pylist() for i in (at, -2, -1))
            rows = [(len(words_of(t)), [list(x) for x in merged([tuple(x) for x in s or ()])], sorted(i or (), key=ITEM_ORDER)) for t, s, i in zip(texts, spans, items)]
            kept = [i for i, name in enumerate(batch.schema.names) if name not in ("_rid", "_spans", "_items")]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *(pa.array(c, f.type) for c, f in zip(zip(*rows), HITS))], names=[*(batch.schema.names[i] for i in kept), *HITS.names])

    joined = rows.join(found, "_rid", "left").select(*rows.columns, "_spans", "_items")
    return joined.mapInArrow(together, StructType([*docs.schema, *StructType.fromDDL(HITS_DDL)]))


def spans(docs: DataFrame, benchmark: DataFrame, window: int = 13, coverage: float = 0.05, block_words: int = 200_000) -> DataFrame:
    """(doc_id, n_words, n_hit, spans array of [begin, end) in words, items array, contaminated) of docs (doc_id, text)."""
    limit = Fraction(str(coverage))
    found = judged(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, window, block_words).drop("text")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    found = found.withColumn("n_hit", n_hit)
    over = (F.col("n_hit") > 0) & (F.col("n_hit") * limit.denominator >= F.col("n_words") * limit.numerator)
    return found.select("doc_id", "n_words", "n_hit", "spans", "items", over.alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, coverage: float = 0.05, cut_words: int | None = None, block_words: int = 200_000) -> DataFrame:
    """docs, with all their columns, without the texts over the coverage limit. With cut_words, spans of at least so
    many words are cut from the texts that stay."""
    limit, schema, at = Fraction(str(coverage)), docs.schema, docs.columns.index("text")
    names = [f"_{i}" for i in range(len(docs.columns))]  # names of its own may clash with those of the judgement
    names[at] = "text"

    def kept(batches):
        for batch in slices(batches):
            n_words, spans = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            columns = batch.columns[: len(names)]
            if cut_words is not None:
                cut = [without(t, [s for s in x if s[1] - s[0] >= cut_words]) for t, x in zip(columns[at].to_pylist(), spans)]
                columns[at] = pa.array(cut, columns[at].type)
            stay = [not _over(s, n, limit) for s, n in zip(spans, n_words)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(stay, pa.bool_()))

    return judged(docs.toDF(*names), benchmark, window, block_words).mapInArrow(kept, schema)


def without(text: str | None, gone: list[tuple[int, int]]) -> str | None:
    """text without the words of these spans and what stands between them."""
    if not text or not gone:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    plain = np.frombuffer(raw.translate(NORMAL), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], plain.view(np.int8), [0]))))
    begins, ends = edges[::2], edges[1::2]
    parts, at = [], 0
    for a, b in gone:
        parts.append(raw[at : begins[a]])
        at = ends[b - 1]
    return b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")
