"""Each operator on small fixtures with nulls, ties, repeated rows and clashing columns, against brute force."""

import hashlib
import os
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cindergrid.llm import chat, cpsjoin, decontam, gam, langid, licenses, quality_rules, sharding, spm, warc
from cindergrid.llm.common import new_path, scratch
from cindergrid.llm.queries import PIECES, QUERIES

SF = "/root/testdata/sf0.001"
BASE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what it is up to now".split()
TEXTS = [
    (1, " ".join(BASE)), (2, " ".join(BASE)), (3, " ".join([*BASE[:-1], "then"])), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (8, "ONE  two"),
    (9, "a b " * 30), (10, "Ünï cödé wörds ▁ and 漢字 😀\nnew line\nnew line"), (11, "x" * 5000), (12, "##" + "*** | " * 40), (2, " ".join(BASE)), (None, "no id here at all"),
]


def docs(spark, rows=None):
    rows = TEXTS if rows is None else rows
    return spark.createDataFrame([(i, t, "en", 7, "s") for i, t in rows], "doc_id long, text string, lang string, size long, shard string")


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def test_warc_round_trip(spark):
    big = "<p>\r\nline\n\n" + "y" * 2000
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "http://c", "small"), (4, "http://d", "small"), (5, "u", None), (6, "u", "é\n" * 90000), (2, None, big), (None, "n", "t\r\n\r\nWARC/1.0\r\n")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    folder = new_path(spark, "warc")
    warc.write_archives(pages, folder)
    chunks = warc.read_chunks(spark, folder, chunk_bytes=1000)
    got = warc.records(chunks).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for page, _, html in rows:
        raw = (html or "").encode()
        r = by_id[page]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 2) if page == 1 else ("response", None))
    parts = sorted((r.chunk_no, bytes(r.data)) for r in chunks.filter("page_id = 6").collect())
    assert b"".join(p for _, p in parts).decode() == "é\n" * 90000 and max(len(p) for _, p in parts) <= 1000
    lines = spark.read.text(folder).select(F.max(F.octet_length("value"))).first()[0]
    assert lines <= warc.WIRE + 1
    one_line = new_path(spark, "warc")  # a page without a line break
    html = "é<p>" * 3_000_000
    warc.write_archives(spark.createDataFrame([(9, "u", html)], "page_id long, url string, html string"), one_line)
    assert spark.read.text(one_line).select(F.max(F.octet_length("value"))).first()[0] <= warc.WIRE + 1
    whole = warc.read_chunks(spark, one_line).orderBy("chunk_no").collect()
    assert b"".join(bytes(r.data) for r in whole) == html.encode() and {len(r.data) for r in whole[:-1]} == {1 << 16}
    assert [r.is_last for r in whole] == [False] * (len(whole) - 1) + [True]
    empty = new_path(spark, "warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.records(warc.read_chunks(spark, empty)).count() == 0


def test_language(spark):
    rows = [(i, "the cat and the dog run over the hill", "en") for i in range(6)] + [(10 + i, "der hund und die katze laufen auf den berg", "de") for i in range(6)] + [(30, "der hund", None)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(train)
    got = {r.doc_id: r for r in langid.predict(docs(spark, [(1, "the dog"), (2, "die katzen laufen"), (3, None), (4, "123 !"), (5, "")]), model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(docs(spark), langid.learn(train.limit(0))).filter("lang_pred <> 'und'").count() == 0
    kept = langid.keep_known(docs(spark), model)
    assert kept.columns == docs(spark).columns


def test_language_words_are_letters(spark):
    """Fractions, superscripts and Roman numerals are no letters; a word counts whole, whatever its length; ties go to the first language."""
    assert langid.words_of("½ ² Ⅷ x²y 12a ÜNÏ漢字_q") == ["x", "y", "a", "ünï漢字", "q"]
    long = "ab" * 5000
    train = [(i, f"{long}{x} {x}", lang) for i, (x, lang) in enumerate([("c", "en"), ("d", "de")])]
    model = langid.learn(spark.createDataFrame([*train, (7, "½ ²", "fr"), (8, None, "fr"), (9, "x", None)], "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"]
    tests = [(1, "½ ²"), (2, f"{long}c"), (3, f"{long}d"), (4, "漢字"), (5, "c d"), (5, "c d"), (None, "c")]
    got = langid.predict(docs(spark, tests), model).collect()
    want = {1: "und", 2: "en", 3: "de", 4: "de", 5: "de", None: "en"}
    assert len(got) == len(tests) and all(r.lang_pred == want[r.doc_id] for r in got)
    assert all(abs(r.score - 0.5) < 1e-9 for r in got if r.doc_id in (4, 5))


def test_language_keeps_every_count(spark):
    """More languages than 64, words seen once, words that differ after 64 letters, and any size of the cache."""
    import math
    import random

    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))) for _ in range(300)] + ["q" * 70 + x for x in "uvw"]
    train = [(i, " ".join(rng.choice(vocabulary) for _ in range(12)), f"l{i % 70:02}") for i in range(280)]
    tests = [(i, " ".join([*(rng.choice(vocabulary) for _ in range(6)), *(rng.choice(["abcq", "zzhgz", "ÿ", "zh", "q" * 70 + "uz"]) for _ in range(3))])) for i in range(60)]
    total, grams, known = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang in train:
        total[lang].update(text.split())
    for lang, c in total.items():
        for w, n in c.items():
            for o in (1, 2, 3, 4):
                for g in langid.grams_of(w, o):
                    grams[lang, o][g] += n
                    known.add(g)
    words_known, langs = {w for c in total.values() for w in c}, sorted(total)
    sums = {x: (sum(total[x].values()), *(sum(grams[x, o].values()) for o in (1, 2, 3, 4))) for x in langs}
    want = {}
    for i, text in tests:
        logs = []
        for x in langs:
            s = 0.0
            for w in text.split():
                if w in words_known:
                    s += math.log((total[x][w] + 0.5) / (sums[x][0] + 1))
                    continue
                for o in (4, 3, 2, 1):
                    g = [y for y in langid.grams_of(w, o) if y in known]
                    if g:
                        s += sum(math.log((grams[x, o][y] + 0.5) / (sums[x][o] + 1)) for y in g) / len(g)
                        break
            logs.append(s)
        e = [math.exp(s - max(logs)) for s in logs]
        want[i] = (langs[logs.index(max(logs))], max(e) / sum(e))
    model = langid.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    for hot in (70, 7000, langid.HOT):
        got = {r.doc_id: r for r in langid.predict(docs(spark, tests), model, hot=hot).collect()}
        assert len(got) == len(tests) and {i: r.lang_pred for i, r in got.items()} == {i: x for i, (x, _) in want.items()}
        assert all(abs(r.score - want[i][1]) < 1e-9 for i, r in got.items())
    kept = langid.keep_known(docs(spark, tests), model, min_score=0.3, hot=70)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, s) in want.items() if s >= 0.3)


def test_held_out_language(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_language"](spark, "/root/testdata/sf0.01").join(d, "doc_id").filter("held_out and lang is not null")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def rejecting(text, w, symbols, lines):
    """The rules that reject a text, by hand."""
    chars, letters = sum(map(len, w)), sum(unicodedata.category(c)[0] == "L" for c in text)
    found = {
        "symbols": 10 * symbols > 3 * len(w), "repeated_lines": 10 * (len(lines) - len(set(lines))) > 3 * len(lines), "word_length": chars < 2 * len(w) or chars > 14 * len(w),
        "shouting": 10 * sum("A" <= c <= "Z" for c in text) > 3 * chars, "exclamations": 10 * text.count("!") > 3 * len(w), "few_letters": 10 * letters < 6 * chars,
        "digits": 10 * sum("0" <= c <= "9" for c in text) > 3 * chars,
    }
    return {k for k, v in found.items() if v}


def test_rules(spark):
    words_20 = " ".join(BASE)
    more = [(20, words_20.upper()), (21, words_20 + " !!!!!!!! !"), (22, " ".join(map(str, range(100, 160)))), (23, " ".join(w * 5 for w in BASE)), (24, words_20 + " %|&" * 3)]
    more += [(25, "\n".join(BASE) + "\nup\nup\nup" * 4), (26, "Ünï ½ " * 3 + words_20), (27, " ".join("abcdefghijklmnopqrstuvwxyz")), (28, words_20), (28, words_20), (29, "\x1c" + words_20)]
    more += [(30, " ".join(f"word{i}" for i in range(60_000)))]
    texts = [*TEXTS, *more]
    order = quality_rules.plan(docs(spark, texts))
    assert {r["rule"] for r in order} == set(quality_rules.RULES)
    assert all(0 <= r["rejected"] <= 1 and r["cost_s"] > 0 for r in order)
    got = quality_rules.judge(docs(spark, texts), order).collect()
    assert len(got) == len(texts) and {r.rejected_by for r in got} >= {"base", None, "shouting", "word_length", "exclamations"}
    for r in got:
        text = next(t for i, t in texts if i == r.doc_id) or ""
        w = words(text)
        c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        by_hand = rejecting(text, w, want[2], lines)
        assert r.kept == (not r.base_failed and not by_hand)
        assert r.rejected_by == ("base" if r.base_failed else next((x["rule"] for x in order if x["rule"] in by_hand), None))
    assert quality_rules.judge(docs(spark).limit(0), quality_rules.plan(docs(spark).limit(0))).count() == 0


def test_decontamination(spark):
    items = [(1, " ".join(BASE[2:18])), (2, "one TWO"), (3, None), (4, "!!"), (12, " ".join(BASE[:14])), (2, "one TWO")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    windows = defaultdict(set)
    for i, t in items:
        w = split.findall(low(t))
        k = min(13, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[a : a + k])].add(str(i))
    for r in decontam.spans(docs(spark), bench).collect():
        w = split.findall(low(next(t for i, t in TEXTS if i == r.doc_id)))
        hit, found = set(), set()
        for win, ids in windows.items():
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a : a + len(win)]) == win:
                    hit |= set(range(a, a + len(win)))
                    found |= ids
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(found))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert decontam.clean(docs(spark), bench).filter("doc_id in (1, 2, 7)").count() == 0
    assert decontam.clean(docs(spark), bench.limit(0)).count() == len(TEXTS)
    assert decontam.without("One, two three. Four!", [(1, 3)]) == "One, . Four!"


def test_spans_are_cut(spark):
    """clean(cut_words=13): texts over the limit go, hit runs of 13 words and more go from those that stay."""
    passage = [f"p{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(passage)), (2, "one two")], "item_id long, text string")
    fill = lambda k, n: [f"f{k}_{i}" for i in range(n)]
    rows = [(1, fill(1, 500) + passage[:15] + fill(2, 400)), (2, fill(1, 50) + passage), (3, passage[3:17] + fill(3, 600) + ["one", "two"] + passage[:12]), (4, fill(4, 9))]
    got = {r.doc_id: r.text for r in decontam.clean(docs(spark, [(i, " ".join(w)) for i, w in rows]), bench, cut_words=13).collect()}
    windows = {tuple(passage[a : a + 13]) for a in range(18)} | {("one", "two")}
    want = {}
    for i, w in rows:
        hit = {j for x in windows for a in range(len(w)) if tuple(w[a : a + len(x)]) == x for j in range(a, a + len(x))}
        if not hit or 20 * len(hit) < len(w):
            runs = [[j for j in range(a, len(w))][: next((k for k in range(len(w) - a) if a + k not in hit), len(w) - a)] for a in sorted(hit) if a - 1 not in hit]
            gone = {j for r in runs if len(r) >= 13 for j in r}
            want[i] = [x for j, x in enumerate(w) if j not in gone]
    assert set(want) == {1, 3, 4} and {i: t.split() for i, t in got.items()} == want


def test_automaton_blocks_agree(spark):
    bench = spark.createDataFrame([(i, f"w{i} " * 3 + "common phrase of five words here") for i in range(20)], "item_id long, text string")
    one, many = list(decontam.automata(bench)), list(decontam.automata(bench, block_words=15))
    assert len(one) == 1 and len(many) > 5
    text = decontam.words_of("w3 w3 w3 common phrase of five words here and w7 w7 w7 common phrase of five words here")
    marks = lambda blocks: {m for b in blocks for k in b.hits(text)[1] for m in b.marks[k]}
    assert marks(one) == marks(many) == {"3", "7"}
    rows = [*TEXTS, (20, "w3 w3 w3 common phrase of five words here and w7 w7 w7 common"), (20, "w1 " * 3 + "common phrase of five words here"), (21, "filler " * 200_000 + "w2 w2 w2 common phrase of five words here")]
    d = docs(spark, rows).withColumns({"spans": F.lit(1), "_rid2": F.lit("x")})
    for f in (decontam.spans, lambda *a, **k: decontam.clean(*a, cut_words=5, **k)):
        found = [sorted(map(repr, f(d, bench, block_words=n).collect())) for n in (15, 200_000)]
        assert found[0] == found[1] and len(found[0]) >= len(TEXTS) - 4


def test_shards(spark):
    rows = [(i, f"text number {i} " * (i % 7 + 1)) for i in range(3000)] + [(5000 + i, "the same copy") for i in range(1500)] + [(9000, None)]
    rows += [(9001, None), (9001, None), (None, "no id"), (None, "no id"), (9002, "")]
    got = sharding.shard(docs(spark, rows), shards=8, parts=4).toPandas()  # with columns named size and shard of its own
    assert set(got.columns) == {*docs(spark, rows).columns, "text_crc32", "slot"}
    assert len(got) == len(rows)
    text = dict(rows)
    raw = [(text[None if i != i else int(i)] or "").encode() for i in got.doc_id]
    assert all(s == len(t) + 8 and c == zlib.crc32(t) for t, s, c in zip(raw, got["size"], got.text_crc32))
    assert all(sorted(x.slot) == list(range(len(x))) for _, x in got.groupby("shard"))
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() / sizes.mean() < 1.03 and sizes.min() / sizes.mean() > 0.97
    assert sharding.shard(docs(spark).limit(0)).count() == 0


def test_shards_of_the_table(spark):
    """Every row of sf0.01 once, gapless slots, sizes as near as half a row of the largest allows; small pieces agree."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    whole = table.toPandas()
    text = dict(zip(whole.doc_id, whole.text))
    for got in (QUERIES["op5_shards"](spark, "/root/testdata/sf0.01").toPandas(), sharding.shard(table, part_bytes=3000).toPandas()):
        assert sorted(got.doc_id) == sorted(whole.doc_id)
        for i, size, crc in zip(got.doc_id, got["size"], got.text_crc32):
            raw = (text[i] or "").encode()
            assert (size, crc) == (len(raw) + 8, zlib.crc32(raw))
        assert all(sorted(x.slot) == list(range(len(x))) for _, x in got.groupby("shard"))
        sizes, even = got.groupby("shard")["size"].sum(), got["size"].sum() / 24
        assert set(sizes.index) == set(range(24)) and max(abs(sizes - even)) <= 0.01 * even + got["size"].max()


def test_chat_trees(spark):
    rows = [
        ("a", 1, None, "user", "root #1 \\ <b>", 0.0), ("a", 2, 1, "assistant", "left </turn>\n### user: x", 0.2), ("a", 3, 1, "assistant", "right", 0.9), ("a", 4, 3, "user", "more \\h\\b", 0.5),
        ("a", 5, 2, "user", "worse", 0.1), ("b", 1, 99, "sys:tem", None, None), (None, 1, None, None, "alone", 0.0), ("a", 4, 3, "user", "more \\h\\b", 0.5), ("c", 1, 2, "user", "loop", 0.0), ("c", 2, 1, "user", "loop", 0.0), ("null", 1, None, "user", "by name", 0.0), ("", 1, None, "user", "empty name", 0.0),
    ]
    df = spark.createDataFrame(rows, "conv_id string, node long, parent long, role string, text string, score double")
    got = {r.conv_id: r for r in chat.format_trees(df).withColumns({"turns": chat.parse(F.col("formatted")), "loss": chat.masked(F.col("segments"))}).collect()}
    assert set(got) == {"a", "b", None, "null", ""} and got[None].turns[0].text == "alone" and got["null"].turns[0].text == "by name"
    assert [(t.role, t.text) for t in got["a"].turns] == [("user", "root #1 \\ <b>"), ("assistant", "right"), ("user", "more \\h\\b")]
    assert got["a"].loss == "right" and [(t.role, t.text) for t in got["b"].turns] == [("sys:tem", "")]
    both = chat.format_trees(df, branches=2).filter("conv_id = 'a'").count()
    assert both == 2
    assert chat.format_trees(df.limit(0)).count() == 0


def test_long_chain(spark):
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    got = chat.format_trees(df).select(chat.parse(F.col("formatted")).alias("t")).first().t
    assert [x.text for x in got] == [f"t{i}" for i in range(300)]


def test_licenses(spark):
    rows = [(1, "Some text. Licensed under the Apache License, Version 2.0.\nmore"), (2, licenses.SENTENCES[2] + "\n" + licenses.SENTENCES[3]), (3, None), (4, "released UNDER the mit license."), (5, licenses.SENTENCES[3])]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, rows)).collect()}
    assert [got[i].licenses for i in range(1, 6)] == [["Apache-2.0"], ["MIT"], [], ["MIT"], []]
    assert got[3].n_sentences == 0 and list(got[2].sentence_ids) == [2, 3]


def test_licenses_wrapped_in_comments(spark):
    import textwrap

    of = licenses.SENTENCES
    wrap = lambda ids, mark="", width=60: "\n".join(mark + x for s in ids for x in textwrap.wrap(of[s], width))
    bsd = of[13] + "\n\n" + "\n".join(f"{n}. " + "\n   ".join(textwrap.wrap(of[i], 70)) for n, i in enumerate((33, 34, 35), 1)) + "\n\n" + wrap([36, 37])
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + wrap([2]) + "\n\n" + wrap([3, 15, 16])), (2, "int x;\n" + wrap([17], " * ") + "\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n *\n" + wrap([18, 19], " * ")),
        (3, "// Copyright 2019 B. All rights reserved.\n" + bsd), (4, wrap([8], "# ", 40) + "\n#\n" + wrap([9, 10, 21], "# ")), (5, "Copyright C. All rights reserved."), (6, of[2].replace(" ", "  ").replace(", ", ",\t")),
        (7, "/* SPDX-License-Identifier: GPL-2.0-only */\nint main"), (8, wrap([30], ";; ", 30) + "\n" + wrap([32], ";; ", 30)), (9, of[33]), (10, "\n".join([of[4], *["filler"] * 7, of[5]])), (11, " ".join(of[8].split()[:-1])), (12, ("word. " * 400_000) + wrap([39, 40])), (12, ""),
        (13, of[13] + "\n" + of[33] + "\n" + of[34]), (14, of[24] + of[26]), (15, of[28] + "\n" + of[9] + " " + of[29]), (16, of[42]), (17, of[44]), (None, of[1]),
    ]
    got = defaultdict(list)
    for r in licenses.scan(docs(spark, rows)).collect():
        got[r.doc_id].append(r.licenses)
    want = {1: "MIT", 2: "Apache-2.0", 3: "BSD-3-Clause", 4: "GPL-3.0-or-later", 5: "proprietary", 6: "MIT-grant", 7: "GPL-2.0-only", 8: "MPL-2.0", 10: "Apache-2.0", 13: "BSD-2-Clause", 15: "AGPL-3.0-or-later", 16: "Unlicense", 17: "CC0-1.0", None: "MIT"}
    assert {i: x for i, x in got.items() if i not in (9, 11, 12, 14)} == {i: [[x]] for i, x in want.items()}
    assert got[9] == got[11] == [[]] and sorted(got[12]) == [[], ["ISC"]]
    assert licenses.scan(docs(spark).limit(0)).count() == 0 and licenses.scan(docs(spark, rows), {}, []).filter("n_known > 0").count() == 0


def test_licenses_by_hand_on_the_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
    known = {licenses.normal(s): i for i, s in licenses.SENTENCES.items()}
    got = {r.doc_id: r for r in QUERIES["op7_licenses"](spark, SF).collect()}
    for i, text in zip(table.doc_id, table.text):
        parts = [s for s in re.split(licenses.BREAK, text or "") if s.strip(" ")]
        ids = [known[licenses.normal(s)] for s in parts if licenses.normal(s) in known]
        assert got[i].n_sentences == len(parts) and got[i].sentence_ids == ",".join(map(str, ids))


def test_quality(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.93
    d = docs(spark)
    none = gam.learn(d, spark.createDataFrame([], "doc_id long, label int"))
    assert {r.score for r in gam.score(d, none).collect()} == {0.5}
    again = d.unionByName(d).unionByName(d)  # repeated ids and labels: the bound holds and the order does not matter
    marks = spark.createDataFrame([(i, i % 2) for i in (1, 2, 2, 7, 8, 9, 10)] + [(11, None), (None, 1)], "doc_id long, label int")
    fits = [gam.learn(x, marks, max_labels=9) for x in (again, again.repartition(5), again.orderBy(F.desc("text")))]
    tables = [[x.round(12).tolist() for x in m.tables] + [m.base] for m in fits]
    assert tables[0] == tables[1] == tables[2]
    scores = {r.doc_id: r.score for r in gam.score(docs(spark, [(1, None), (2, ""), (3, "x " * 2_000_000)]), fits[0]).collect()}
    assert scores[1] == scores[2] and all(0 <= s <= 1 for s in scores.values())
    assert gam.score(d.limit(0), fits[0]).count() == 0
    assert gam.keep_good(d, none).columns == d.columns


def test_pieces(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = spm.decode(spm.encode(docs(spark), PIECES), PIECES).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((i or 0, t or "") for i, t in TEXTS)
    for r in got:
        if r.text and "▁" not in r.text:
            assert list(r.ids) == sp.encode(r.text)
    pieces = spm.Pieces(PIECES)
    long = "abcabd" * 400 + "the end" * 50
    assert list(pieces.stream(iter("▁" + long.replace(" ", "▁")))) == sp.encode(long)


def test_pieces_of_the_table_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in table.collect()}
    got = {r.doc_id: r for r in spm.round_trip(table, PIECES).collect()}
    assert set(got) == set(texts) and all(got[i].text == t for i, t in texts.items())
    assert all(list(got[i].ids) == sp.encode(t) for i, t in texts.items() if t and "▁" not in t)
    assert spm.round_trip(table.limit(0), PIECES).count() == 0


def test_pieces_stream_in_a_window(spark):
    """A run of a million characters without spaces, given one by one: ids come long before its end."""
    import sentencepiece

    sp, pieces, seen = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm.Pieces(PIECES), 0
    run = "abcabdthe漢😀" * 100_000

    def chars():
        nonlocal seen
        for c in "▁" + run:
            seen += 1
            yield c

    ids = []
    for i in pieces.stream(chars()):
        ids.append(i)
        if len(ids) == 1:
            assert seen < 200
    assert ids == sp.encode(run)


def components(sets, percent=80):
    ids, parent = list(sets), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def shingles(text, width):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))  # A-Z alone, also beside letters beyond ASCII
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def test_near_duplicates_of_the_table(spark):
    """Every pair of sf0.01 by brute force: no link is missed and none is made up."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = components({r.doc_id: shingles(r.text, 4) for r in table})
    got = {r.doc_id: r for r in QUERIES["op10_near_duplicates"](spark, "/root/testdata/sf0.01").collect()}
    assert {i: r.component_id for i, r in got.items()} == want and len(set(want.values())) < len(want)


@pytest.mark.parametrize("settings", [{}, {"limit": 4, "depth": 3}])
def test_near_duplicates(spark, settings):
    import random

    rng, rows, n = random.Random(5), [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(80)]
        for _ in range(rng.choice([1, 2, 9, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                copy[rng.randrange(80)] = f"z{rng.randrange(500)}"
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "a b"), (n + 3, "A b"), (n + 4, "a b c d e f g")]
    want = components({i: shingles(t, 4) for i, t in rows})
    got = cpsjoin.near_duplicates(docs(spark, rows), width=4, **settings).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(dict(rows)[r.doc_id], 4)) for r in got)


@pytest.mark.parametrize("common", [120, 60])
def test_trees_keep_pairs_together_at_any_depth(spark, common):
    """A passage that makes estimates hang together is done in linear time; one that does not makes nodes branch, by two
    coordinates each, so that the chance to miss a pair stays below 1 in 100,000 at any depth."""
    assert all(cpsjoin.chance_apart(level) ** 9 < 1e-5 for level in (1, 2, 6, 50)) and cpsjoin.chance_apart(50) <= 0.25
    shared = " ".join(f"s{i}" for i in range(common))
    rows = [(i, shared + " " + " ".join(f"u{i}x{j}" for j in range(40))) for i in range(600)]
    rows += [(1000 + i, t.rsplit(" ", 4)[0] + f" v{i} v v v") for i, (_, t) in enumerate(rows[:40])]
    reps = spark.createDataFrame([(i, bytearray(cpsjoin.signature(cpsjoin.Shingles(4)(t)).tobytes())) for i, t in rows], "rep long, signature binary")
    assert common == 120 or cpsjoin._search(reps, range(9), 64, 4, 79)[1] == 4
    got = {r.doc_id: r.component_id for r in cpsjoin.near_duplicates(docs(spark, rows), width=4, limit=64, depth=4).collect()}
    assert got == components({i: shingles(t, 4) for i, t in rows})


def test_large_groups_move_texts_twice(spark):
    """3000 different near copies of one text, with a few that are near but not near enough: one component, few moves."""
    import random

    rng, base = random.Random(8), [f"w{i}" for i in range(100)]
    change = lambda k: " ".join(f"z{rng.randrange(10**6)}" if i in set(rng.sample(range(100), k)) else w for i, w in enumerate(base))
    rows = [(i, " ".join([*base[:97], f"a{i}", f"b{i}", f"c{i}"])) for i in range(3000)] + [(3000 + i, change(5)) for i in range(10)]
    moved, real = [], cpsjoin._compared
    try:
        cpsjoin._compared = lambda cells, *a, **k: (moved.append(cells.count()), real(cells, *a, **k))[1]
        texts = spark.createDataFrame(rows, "rep long, data string")
        members = texts.select(F.lit(1).cast("long").alias("group"), "rep", F.lit(len(rows)).cast("long").alias("n"))
        found, left = cpsjoin.links_within(members, texts, cpsjoin._by_sets(4, 80), 100, leave=True)
        links = cpsjoin.components(found)
    finally:
        cpsjoin._compared = real
    assert left is None
    got = {r.rep: r.label for r in links.collect()}
    assert len({got[i] for i in range(3000)}) == 1 and sum(moved) <= 2.5 * len(rows)
    sets = {i: shingles(t, 4) for i, t in rows if i % 10 == 0 or i >= 3000}
    want = components(sets)
    assert {i for i in sets if got.get(i) == got[0]} == {i for i, c in want.items() if c == want[0]}


def test_near_duplicates_edges(spark):
    got = cpsjoin.near_duplicates(docs(spark), width=4).collect()
    assert len(got) == len(TEXTS)
    assert cpsjoin.near_duplicates(docs(spark).limit(0)).count() == 0
    kept = cpsjoin.keep_first(docs(spark))
    assert kept.columns == docs(spark).columns and kept.filter("doc_id = 2").count() == 0


def without_words(text, gone):
    """text without the words of these spans and what stands between them, by hand."""
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text))
    for a, b in reversed(gone):
        text = text[: found[a].start()] + text[found[b - 1].end() :]
    return text


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    with scratch() as made:
        last = pipeline.run(spark, "/root/testdata/sf0.01")
    assert [p for p in made if os.path.exists(p)] == made[-1:]  # nothing else is left behind
    got = {r.doc_id: r for r in last.collect()}
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id")
    assert 0.6 * len(table) < len(got) < len(table)
    spans = {r.doc_id: r.spans for r in decontam.spans(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")).collect()}
    cut = {i: without_words(table.text[i], [s for s in spans[i] if s[1] - s[0] >= 13]) for i in got}
    assert any(cut[i] != table.text[i] for i in got)
    assert all(zlib.crc32(cut[i].encode()) == r.decoded_crc32 for i, r in got.items())
    hits = QUERIES["op4_decontaminate"](spark, "/root/testdata/sf0.01").filter("contaminated").select("doc_id").collect()
    assert hits and not {r.doc_id for r in hits} & set(got)
    sets = {i: shingles(table.text[i], 5) for i in got}
    assert all(i == c for i, c in components(sets).items())


def test_keep_known_and_keep_first_with_clashing_columns(spark):
    extra = ["_rid", "_n", "_sum", "_items", "_ks", "_kept", "_kept0", "set_key", "label", "rep"]
    rows = [(i, t, *["x"] * len(extra)) for i, t in TEXTS]
    frame = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'{c} string' for c in extra)}")
    model = langid.learn(docs(spark))
    known = langid.keep_known(frame, model, min_score=0.0)
    assert known.columns == frame.columns and 0 < known.count() < len(rows)
    first = cpsjoin.keep_first(frame)
    assert first.columns == frame.columns
    assert sorted((r.doc_id for r in first.collect()), key=str) == sorted((i for i, t in TEXTS if i not in (2, 3, 8)), key=str)  # copies, and a near copy


def test_rows_without_an_id_go_by_their_own_text(spark):
    copy, alone = " ".join(BASE), "an altogether different text that nobody else has written down so far today"
    frame = docs(spark, [(5, copy), (None, copy), (None, alone), (None, copy.upper()), (None, None), (None, ""), (9, copy)])
    got = cpsjoin.keep_first(frame).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == [(5, copy)]
    assert sorted(map(str, (r.text for r in got if r.doc_id is None))) == sorted(["None", "", alone])


def test_warc_writer_is_linear(spark):
    """A cell of 200 MB; and twice the page takes about twice the time."""
    import time

    def written(mb):
        folder, began = new_path(spark, "warc"), time.perf_counter()
        warc.write_archives(spark.range(1).selectExpr("id as page_id", "'u' as url", f"repeat('<p>0123456789abc', {mb * 65536}) as html"), folder)
        return folder, time.perf_counter() - began

    written(1)
    (_, small), (_, large) = written(16), written(32)
    assert large < 3.5 * small + 1
    folder, _ = written(200)
    got = warc.records(warc.read_chunks(spark, folder)).first()
    assert (got.payload_bytes, got.payload_digest) == (200 << 20, hashlib.sha1(b"<p>0123456789abc" * (200 * 65536)).hexdigest())


def test_additive_score_is_a_plain_sum_over_tables(spark):
    """The score of a table by a loop over features and pairs, with bins counted edge by edge."""
    import math

    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality as label")
    model = gam.learn(frame, labels)
    assert len(model.pairs) == 6 and any(t.any() for t in model.tables) and any(t.any() for t in model.pair_tables)
    place = lambda v, edges: sum(1 for e in edges if e <= v)
    for r, s in zip(frame.orderBy("doc_id").limit(200).collect(), gam.score(frame.orderBy("doc_id").limit(200), model).orderBy("doc_id").collect()):
        x = gam.features(r.text)
        total = model.base + sum(t[place(v, e)] for t, v, e in zip(model.tables, x, model.edges))
        total += sum(t[place(x[i], model.coarse[i]) * model.pair_bins + place(x[j], model.coarse[j])] for t, (i, j) in zip(model.pair_tables, model.pairs))
        assert r.doc_id == s.doc_id and abs(s.score - 1 / (1 + math.exp(-total))) < 1e-12


def test_leaves_are_the_best_cuts():
    """A tree over bins against trying every cut, one after another; and the first visit of a feature by hand."""
    import numpy as np

    rng = np.random.default_rng(8)
    for _ in range(50):
        grad, hess = rng.normal(size=7), rng.random(7) + 0.1
        value = lambda a, b: grad[a:b].sum() / (hess[a:b].sum() + 2.0)
        won = lambda a, b: grad[a:b].sum() ** 2 / (hess[a:b].sum() + 2.0)
        parts = [(0, 7)]
        for _ in range(2):
            tries = [(won(a, k) + won(k, b) - won(a, b), (a, b), k) for a, b in parts for k in range(a + 1, b)]
            best = max(tries, key=lambda t: t[0])
            if best[0] > 1e-9:
                (a, b), k = best[1], best[2]
                parts = [p for p in parts if p != (a, b)] + [(a, k), (k, b)]
        want = np.zeros(7)
        for a, b in parts:
            want[a:b] = value(a, b)
        assert np.allclose(gam._leaves(grad, hess, 3, 2.0), want)
    x = np.zeros((8, len(gam.FEATURES)))
    x[:, 0] = range(8)
    y = np.array([0, 0, 0, 0, 1, 1, 1, 1.0])
    one = gam.Gam(rounds=1, pairs=0).fit(x, y)
    # half of the labels are ones: base 0, p 1/2, so each side has a gradient of 4 * 1/2 over a curvature of 4 * 1/4, and ridge 4
    assert one.base == 0 and sorted(set(one._binned(x, one.edges)[:4, 0])) != sorted(set(one._binned(x, one.edges)[4:, 0]))
    scores = one.score(x)
    assert (scores[:4] < 0.5).all() and (scores[4:] > 0.5).all()
    assert np.allclose(-one.tables[0][one._binned(x, one.edges)[0, 0]], one.tables[0][one._binned(x, one.edges)[7, 0]])
