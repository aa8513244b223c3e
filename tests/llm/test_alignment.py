"""The alignment of two tokenizers against the libraries on whole texts and a plain overlap of all token pairs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cindergrid.llm import alignment
from cindergrid.llm.common import table
from cindergrid.llm.queries import BYTES, PIECES

TEXTS = [
    (1, "the quick brown fox"), (2, "the quick brown fox"), (1, "the quick brown fox"), (None, "no id"), (3, None), (4, ""), (5, " "), (6, "  two  spaces   \n\n\tand\t tabs \n x\n\n y "), (7, "\nline\n break\r\nend\n"),
    (8, "mark ▁ inside"), (9, "Ünï cödé 漢字 😀👩‍👩‍👧     \x1c a\x1c b\x85 c"), (10, "x" * 5000), (11, "<s> </s> <unk> <0x41> <|endoftext|> a<|endoftext|>b"), (12, "don't we'll 's  'S !!! 12345 3.14 a.b"), (13, "​ ﻿ á"),
    (14, "word " * 3000), (15, "nul \x00 here"), (16, "ﬁ ① Å"),
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    value, names = alignment.byte_values(), {i: t for t, i in a.get_vocab().items()}

    def both(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(value[c] for c in names[i]) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        want = (" " + text).encode()
        return (ids_a, ids_b, np.cumsum(list(map(len, raw_a))), np.cumsum(list(map(len, raw_b)))) if b"".join(raw_a) == want == b"".join(raw_b) else None

    return both


def brute(rows, both):
    made, holds = [], Counter()
    for doc, text in rows:
        got = both(text)
        links, groups = [], []
        if got:
            ids_a, ids_b, ends_a, ends_b = got
            j = 0
            for i, end in enumerate(ends_a):
                begin = end if i == 0 else ends_a[i - 1]
                begin = 0 if i == 0 else begin
                while j and ends_b[j - 1] > begin:
                    j -= 1
                while ends_b[j] <= begin:
                    j += 1
                while True:
                    links.append((ids_a[i], ids_b[j]))
                    if ends_b[j] >= end:
                        break
                    j += 1
            cuts = sorted(set(ends_a) & set(ends_b))
            for low, high in zip([0, *cuts], cuts):
                side = [",".join(str(t) for t, e in zip(ids, ends) if low < e <= high) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
                groups.append("|".join(side))
        holds.update(set(links))
        made.append((doc, got, links, groups))
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    return [
        (doc, len(got[0]) if got else 0, len(got[1]) if got else 0, len(groups), len(links), sum(holds[x] == most[x[0]] for x in links), sum(holds[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, got, links, groups in made
    ]


def key(r):
    return tuple(map(str, r))


def found(docs):
    got = alignment.linked(docs, BYTES, PIECES).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    return sorted(map(tuple, got), key=key)


@pytest.mark.parametrize("chunk", [alignment.CHUNK, 3])
def test_edges(spark, libraries, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    docs = spark.createDataFrame([(i, t, "x", 5, 7) for i, t in TEXTS], "doc_id long, text string, chunk string, n_a int, pairs int")
    want = brute(TEXTS, libraries)
    assert found(docs) == sorted(want, key=key)
    assert {r[0] for r in want if not r[1]} >= {3, 4, 8}
    assert found(docs.limit(0)) == [] and [r[1:] for r in found(docs.filter("doc_id = 3"))] == [(0, 0, 0, 0, 0, 0, "")]


def test_whole_table(spark, libraries):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], libraries)
    assert found(docs) == sorted(want, key=key)


def test_parts_are_those_of_whole_texts(spark, libraries):
    """Encoding by parts is encoding whole texts, also when the memo is cleared now and then."""
    encoder = alignment.Encoder(BYTES, PIECES)
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    for k in range(0, len(texts), 50):
        if k % 300 == 0:
            encoder.clear()
        got, whole = alignment._read(encoder, texts[k : k + 50]), [libraries(t) for t in texts[k : k + 50]]
        for side in (0, 1):
            assert got.ids[side].tolist() == [i for w in whole if w for i in w[side]]
            assert got.n[side].tolist() == [len(w[side]) if w else 0 for w in whole]


def test_gallop_finds_the_first_at_or_above():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 50, 1000):
        longer = np.cumsum(rng.integers(1, 9, size))
        x = np.sort(rng.integers(1, longer[-1] + 1, 200))
        for guess in (np.zeros(200, int), np.full(200, size), rng.integers(0, size, 200)):
            got = alignment.gallop(x, longer, guess, np.zeros(200, int), np.full(200, size - 1))
            assert (got == np.searchsorted(longer, x)).all()
