"""Quality rules as a cascade: whichever rule rejects most per second of work is asked first.

Everything is DataFrame expressions. The counts that the result states for every document (repeated words are the dearest)
are columns, made once; a rule is a condition on them or on the text, and only these are cut short. ``plan`` measures, on a bounded random sample, what each rule costs (seconds of a run over the sample
beyond a run without it) and what share it rejects, and orders the rules by rejection per cost. ``judge`` nests them in
one CASE, which stops at the first rule that holds. The order never changes a verdict, only the work and the name of
the first rule that rejects.

Nulls and edges: a null text has no words, so it fails the base rule, as an empty one does. Extra columns are ignored;
rows with a repeated id are judged separately; an empty table gives an empty result. Windows are compared by 64-bit
hashes of word hashes within one text.
"""

from __future__ import annotations

import time
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stash

SPACE = r"[\x20\x09-\x0D]"


def repeat_words(words: Column, width: int = 8) -> Column:
    """How many words lie in windows of width words that occur twice or more, the first occurrence included."""

    def covered(windows: Column) -> Column:
        def of(by_hash: Column) -> Column:
            again = lambda p, i: (F.get(by_hash, i - 1)["h"] == p["h"]) | (F.get(by_hash, i + 1)["h"] == p["h"])
            at = F.transform(by_hash, lambda p, i: F.when(F.coalesce(again(p, i), F.lit(False)), p["i"]))
            spans = lambda pos: F.transform(pos, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(pos, i + 1) - p, F.lit(width))))
            return F.aggregate(bind(F.array_sort(F.array_compact(at)), spans), F.lit(0).cast("long"), lambda a, x: a + x)

        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(bind(pairs, of))

    hashed = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.xxhash64(F.slice(h, i, width)))
    windows = bind(F.transform(words, lambda w: F.xxhash64(w)), hashed)
    return F.when(F.size(words) <= width, F.lit(0).cast("long")).otherwise(bind(windows, covered))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, text and the counts of each document)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select(
        "doc_id", text.alias("text"),
        F.split(F.regexp_replace(text, f"^{SPACE}+|{SPACE}+\\z", ""), f"{SPACE}+").alias("split"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}")).alias("lines"),
    ).withColumn("words", F.when(F.col("split")[0] != "", F.col("split")).otherwise(F.array().cast("array<string>")))
    return parts.select(
        "doc_id", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
    )


BASE = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"

#: Name and condition of rejection. Conditions on counts are cheap; those on the text scan it once more.
RULES = {
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 14 * n_words",
    "shouting": "10 * length(regexp_replace(text, '[^A-Z]+', '')) > 3 * word_chars",
    "exclamations": "10 * (length(text) - length(replace(text, '!', ''))) > 3 * n_words",
    "few_letters": r"10 * length(regexp_replace(text, '[^\\p{L}]+', '')) < 6 * word_chars",
    "digits": "10 * length(regexp_replace(text, '[^0-9]+', '')) > 3 * word_chars",
}


def plan(docs: DataFrame, rules: dict[str, str] | None = None, sample_rows: int = 2000, seed: int = 7, runs: int = 5) -> list[dict]:
    """Rules in the order they are asked, with their cost (seconds over the sample: the median of some runs less that of
    empty ones, in turns), the share of the sample that each rejects alone, and of what the rules before it leave. Each
    place goes to the rule with the most rejection, among the documents still left, per cost."""
    rules = RULES if rules is None else rules
    n = docs.count()
    sample = docs.select("doc_id", "text").sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=seed)
    sample = stash(measured(sample).filter(f"not ({BASE})"), "rule-sample").coalesce(1)  # one task: its time is the rule's, not the scheduler's
    if not rules:
        return []

    def seconds(condition: str) -> float:
        began = time.perf_counter()
        sample.agg(F.count_if(F.expr(condition))).first()
        return time.perf_counter() - began

    names, times = list(rules), {name: [] for name in ("", *rules)}
    for _ in range(runs + 1):  # the first turn also compiles and reads the footers; it is not counted
        for name, found in times.items():
            found.append(seconds(rules.get(name, "text is null")))
    idle = median(times[""][1:])
    cost = {name: max(median(times[name][1:]) - idle, 1e-4) for name in names}
    # how often each set of rules rejects together: at most one row for each document of the sample
    together = sample.groupBy(*(F.coalesce(F.expr(rules[x]), F.lit(False)).alias(f"r{i}") for i, x in enumerate(names))).count().collect()
    total, left, order = max(sum(r["count"] for r in together), 1), together, []
    while len(order) < len(names):
        hits = {x: sum(r["count"] for r in left if r[f"r{i}"]) for i, x in enumerate(names) if x not in {o["rule"] for o in order}}
        name = min(hits, key=lambda x: (-hits[x] / cost[x], cost[x], x))
        at, rest = names.index(name), max(sum(r["count"] for r in left), 1)
        alone = sum(r["count"] for r in together if r[f"r{at}"]) / total
        order.append({"rule": name, "condition": rules[name], "cost_s": cost[name], "alone": alone, "rejected": hits[name] / rest, "rank": hits[name] / total / cost[name]})
        left = [r for r in left if not r[f"r{at}"]]
    return order


def judge(docs: DataFrame, order: list[dict]) -> DataFrame:
    """(doc_id, counts, base_failed, kept, rejected_by) for every row of docs (doc_id, text)."""
    rows = measured(docs).withColumn("base_failed", F.expr(BASE))
    reason = F.when(F.col("base_failed"), "base")
    for rule in order:
        reason = reason.when(F.expr(rule["condition"]), rule["rule"])
    rows = rows.withColumn("rejected_by", reason)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by")
