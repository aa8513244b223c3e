"""The queries of this subpackage, over the whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, cpsjoin, decontam, flatgraph, gam, langid, licenses, quality_rules, sharding, spm, warc, whitening
from .common import id_remainder, new_path, table

#: Vocabularies of the queries that take one; each is a parameter of its query.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTES = "/opt/tokenizers/byte_bpe_50k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    found = warc.records(warc.read_chunks(spark, folder))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(id_remainder("doc_id", 3) != 1))
    found = langid.predict(docs, model)
    return found.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_rules.judge(docs, quality_rules.plan(docs))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by turn are a tree without branches: each answers the one before it."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    says = r"\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"))
    made = chat.format_trees(_as_trees(rows.unionByName(own)))
    turns = chat.parse(F.col("formatted"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = made.select("conv_id", "formatted", turns.alias("turns"), chat.masked(F.col("segments")).alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _as_trees(rows: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", "n_known", F.array_join(F.transform("sentence_ids", lambda i: i.cast("string")), ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 4) != 2)
    model = gam.learn(docs, labels.select("doc_id", F.col("quality").alias("label")))
    found = gam.score(docs, model)
    return found.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_pieces(spark: SparkSession, sf_dir: str, piece_file: str = PIECES) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    back = spm.round_trip(docs, piece_file)
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return back.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"), F.length("text").cast("long").alias("decoded_chars"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cpsjoin.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op11_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))  # null beyond 64 bits


def op13_alignment(spark: SparkSession, sf_dir: str, byte_file: str = BYTES, piece_file: str = PIECES) -> DataFrame:
    return alignment.linked(table(spark, sf_dir, "documents"), byte_file, piece_file)


QUERIES = {f.__name__: f for f in (op1_warc, op2_language, op3_rules, op4_decontaminate, op5_shards, op6_chat, op7_licenses, op8_quality, op9_pieces, op10_near_duplicates, op11_embedding_duplicates, op12_whitening, op13_alignment)}
