"""Language identification by known words first and shorter character n-grams for the rest.

Learning counts words per language over all labelled rows (partial counts in each task, then a sum by word) and n-grams
of whole words over the counted words. Nothing is dropped: every language, word and n-gram keeps its count, in tables
that grow with the input. Scoring adds, for each word, its log frequency per language; an unseen word takes the mean log
frequency of its 4-grams, or of its 3-, 2- or 1-grams, whichever order first has a known one. The score is the share of
the best language in the exponentials of the sums, at every length of text.

The most frequent words are scored inside the tasks from a broadcast of at most ``hot`` counts. That is a cache alone:
all other words of the texts meet the tables in joins by word, so the cache's size changes no result. The languages and
their totals are the only other thing on the driver.

Nulls and edges: a null text, or one without letters, is ``und`` with score 0; so is every text when nothing can be
learned. A text with letters that no table knows gets equal scores, and the first language in alphabetical order.
Rows with a null lang teach nothing. Ties go to the first language. Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slices, stash

#: Numbers that are neither letters nor decimal digits (fractions, superscripts, Roman numerals) are in no word.
NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
WORD, NO_NUMBER = re.compile(r"[^\W\d_]+"), re.compile(rf"[^{NUMBERS}]+")
ORDERS = (4, 3, 2, 1)
FLUSH, HOT = 100_000, 800_000
HALF = float(np.log(0.5))


def words_of(text: str) -> list[str]:
    found = WORD.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [part for word in found for part in NO_NUMBER.findall(word)]


def grams_of(word: str, n: int) -> list[str]:
    padded = f"<{word}>" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _counted(batches, of):
    """(lang, item, n) partial counts, let go whenever FLUSH different ones are held."""
    counts: dict = defaultdict(Counter)

    def out():
        rows = [(a, b, n) for a, c in counts.items() for b, n in c.items()]
        counts.clear()
        columns = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "item", "n"])

    for batch in slices(batches):
        of(counts, batch)
        if sum(map(len, counts.values())) > FLUSH:
            yield out()
    if counts:
        yield out()


def _count_words(batches):
    def of(counts, batch):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[lang].update(words_of(text))

    return _counted(batches, of)


def _count_grams(batches):
    def of(counts, batch):
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            c = counts[lang]
            for order in ORDERS:
                for g in grams_of(word, order):
                    c[g] += n

    return _counted(batches, of)


def _tabled(counts: DataFrame, langs: list[str], name: str) -> DataFrame:
    """(item, n, scores array of (lang, gain)) of partial counts (lang, item, n). A language's number stands for it, gain
    is how far the log of its count lies above that of no count."""
    at = F.create_map(*(F.lit(x) for pair in zip(langs, range(len(langs))) for x in pair))
    summed = counts.repartition("item").groupBy("item", "lang").agg(F.sum("n").alias("n"))
    score = F.struct(at[F.col("lang")].alias("lang"), (F.log(F.col("n") + 0.5) - F.lit(HALF)).alias("gain"))
    return stash(summed.groupBy("item").agg(F.sum("n").alias("n"), F.collect_list(score).alias("scores")), name)


@dataclass
class Model:
    """Languages, the log frequency of an item without count (a row for words, then one for n-grams of each length), and
    the tables of all words and n-grams."""

    langs: list[str]
    bases: np.ndarray
    words: DataFrame | None
    grams: DataFrame | None


def learn(docs: DataFrame) -> Model:
    """Learns from text and non-null lang of docs (text, lang)."""
    rows = docs.select("text", "lang").filter("text is not null and lang is not null")
    words = rows.mapInArrow(_count_words, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    words = stash(words, "lang-words")
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros((0, 0)), None, None)
    grams = stash(words.mapInArrow(_count_grams, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n")), "lang-grams")
    gram_totals = {(r.lang, r.o): r.n for r in grams.groupBy("lang", F.length("item").alias("o")).agg(F.sum("n").alias("n")).collect()}
    seen = [[totals[x] for x in langs], *([gram_totals.get((x, o), 0) for x in langs] for o in range(1, max(ORDERS) + 1))]
    return Model(langs, HALF - np.log(np.array(seen, float) + 1.0), _tabled(words, langs, "word-scores"), _tabled(grams, langs, "gram-scores"))


def _word_grams(order: int):
    def made(batches):
        for batch in slices(batches):
            rows = [(w, g, k) for w in batch.column(0).to_pylist() for g, k in Counter(grams_of(w, order)).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["word", "item", "k"])

    return made


def _backed_off(unseen: DataFrame, model: Model) -> DataFrame:
    """(item, scores) of the unseen words (item) that have a known n-gram: the mean gain of those of the longest order
    that has any. The score of number -1 - order is 1."""
    unseen, found = stash(unseen, "unseen-words"), None
    for order in ORDERS:
        rows = unseen.mapInArrow(_word_grams(order), "word string, item string, k long").join(model.grams.select("item", "scores"), "item")
        each = F.explode(F.concat(F.array(F.struct(F.lit(-1 - order).alias("lang"), F.lit(1.0).alias("gain"))), "scores")).alias("s")
        sums = rows.select("word", "k", each).groupBy("word", "s.lang").agg(F.sum(F.col("k") * F.col("s.gain")).alias("gain"))
        sums = sums.groupBy("word").agg(F.collect_list(F.struct("lang", "gain")).alias("scores"))
        known = F.element_at(F.filter("scores", lambda s: s["lang"] < 0), 1)["gain"]
        sums = sums.select(F.col("word").alias("item"), F.transform("scores", lambda s: F.struct(s["lang"].alias("lang"), (s["gain"] / known).alias("gain"))).alias("scores"))
        sums = stash(sums, "backed-off")
        found = sums if found is None else found.unionByName(sums)
        unseen = stash(unseen.join(sums, "item", "left_anti"), "unseen-words")
        if not unseen.head(1):
            break
    return found


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The words (item, n, scores) with the largest counts, at most so many: those above the least count, of a fixed
    ladder of counts, that no more words reach."""
    step = F.floor(F.log2("n") * 8)
    held, least = 0, None
    for r in words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        held += r.n
        if held > most:
            break
        least = r.step
    return words.filter(step >= least if least is not None else F.lit(False))


def _scored(docs: DataFrame, keep: list[str], model: Model, hot: int) -> tuple[DataFrame, DataFrame]:
    """These columns of docs with a number of each row (_rid), and (_rid, lang_pred, score) of all rows."""
    spark, at, langs, bases = docs.sparkSession, docs.columns.index("text"), model.langs, model.bases
    index: dict[str, int] = {}
    gains = np.zeros((0, len(langs)))
    if langs:
        top = _frequent(model.words, hot // len(langs)).select("item", "scores.lang", "scores.gain").toArrow().combine_chunks()
        index = {x: i for i, x in enumerate(top.column("item").to_pylist())}
        gains = np.tile(bases[0], (len(index), 1))
        if index:
            number, gain = (top.column(c).combine_chunks() for c in ("lang", "gain"))
            gains[np.repeat(np.arange(len(index)), np.diff(number.offsets.to_numpy())), number.flatten().to_numpy()] += gain.flatten().to_numpy()
    shared = spark.sparkContext.broadcast((index, gains))  # at most `hot` numbers, whatever the input
    extra = pa.schema([("_rid", pa.int64()), ("_n", pa.int64()), ("_sum", pa.list_(pa.float64())), ("_items", pa.list_(pa.string())), ("_ks", pa.list_(pa.int64()))])

    def begun(batches):
        (index, gains), rid = shared.value, TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = []
            for text in batch.column(at).to_pylist():
                counts = Counter(words_of(text)) if text else {}
                known, weights, items, ks = [], [], [], []
                for word, k in counts.items():
                    i = index.get(word)
                    if i is None:
                        items.append(word)
                        ks.append(k)
                    else:
                        known.append(i)
                        weights.append(k)
                total = np.asarray(weights, np.float64) @ gains[known] if known else np.zeros(len(langs))
                rows.append((rid, sum(weights) + sum(ks), total, items, ks))
                rid += 1
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in held), *(pa.array(c, f.type) for c, f in zip(zip(*rows), extra))], names=[*(batch.schema.names[i] for i in held), *extra.names])

    held = [i for i, c in enumerate(docs.columns) if c in keep]
    more = StructType.fromDDL("_rid long, _n long, _sum array<double>, _items array<string>, _ks array<long>")
    schema = StructType([*(docs.schema[i] for i in held), *more])
    rows = stash(docs.mapInArrow(begun, schema), "lang-rows")
    done = rows.select("_rid", "_n", "_sum")
    if langs:
        rest = rows.select("_rid", F.explode(F.arrays_zip("_items", "_ks")).alias("w")).select("_rid", F.col("w._items").alias("item"), F.col("w._ks").alias("k"))
        items = stash(rest.select("item").distinct().join(model.words.select("item", "scores"), "item", "left"), "text-words")
        one = F.array(F.struct(F.lit(-1).alias("lang"), F.lit(1.0).alias("gain")))
        looked_up = items.filter("scores is not null").select("item", F.concat(one, "scores").alias("scores"))
        looked_up = looked_up.unionByName(_backed_off(items.filter("scores is null").select("item"), model))
        each = rest.join(looked_up, "item").select("_rid", "k", F.explode("scores").alias("s")).select("_rid", "s.lang", (F.col("k") * F.col("s.gain")).alias("gain"))
        more = each.repartition("_rid").groupBy("_rid", "lang").agg(F.sum("gain").alias("gain"))  # one exchange serves both sums and the join
        more = more.groupBy("_rid").agg(F.collect_list("lang").alias("_langs"), F.collect_list("gain").alias("_gains"))
        done = done.join(more, "_rid", "left")
    else:
        done = done.withColumns({"_langs": F.lit(None).cast("array<int>"), "_gains": F.lit(None).cast("array<double>")})

    def ended(batches):
        for batch in slices(batches):
            told = []
            for n, total, numbers, values in zip(*(c.to_pylist() for c in batch.columns[1:])):
                if not n or not langs:
                    told.append(("und", 0.0))
                    continue
                total = np.asarray(total, np.float64)
                for i, v in zip(numbers or (), values or ()):
                    if i < 0:
                        total += v * bases[-1 - i]
                    else:
                        total[i] += v
                e = np.exp(total - total.max())
                best = int(np.argmax(total))
                told.append((langs[best], float(e[best] / e.sum())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in told], pa.string()), pa.array([s for _, s in told], pa.float64())], ["_rid", "lang_pred", "score"])

    return rows, done.select("_rid", "_n", "_sum", "_langs", "_gains").mapInArrow(ended, "_rid long, lang_pred string, score double")


def predict(docs: DataFrame, model: Model, hot: int = HOT) -> DataFrame:
    """(doc_id, held over as it is; lang_pred; score) for every row of docs (doc_id, text)."""
    rows, told = _scored(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"], model, hot)
    return rows.select("_rid", "doc_id").join(told, "_rid").drop("_rid")


def keep_known(docs: DataFrame, model: Model, min_score: float = 0.5, hot: int = HOT) -> DataFrame:
    """The rows of docs, with all their columns, whose language is predicted with min_score at least."""
    plain = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])  # none is named as what is added
    rows, told = _scored(plain, plain.columns, model, hot)
    good = told.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select("_rid")
    return rows.select("_rid", *plain.columns).join(good, "_rid", "left_semi").select(*plain.columns).toDF(*docs.columns)
