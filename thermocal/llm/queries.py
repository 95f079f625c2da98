"""The queries ``opN_<name>``: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as _decontaminate
from . import (byte_bpe, conversation_trie, histogram_sort, language_id, line_templates, mixing, ngram_join, secret_scan,
               token_files, toxicity, vector_codes, vector_join)
from .common import read, scratch
from .oracles import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    d = F.col("decontamination")
    ids = F.array_sort(F.transform(d["items"], lambda x: x.cast("string")))
    return got.select("doc_id", d["n_words"].alias("n_words"), d["n_hit"].alias("n_hit"),
                      F.size(d["items"]).cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (d["n_hit"] > 0).alias("contaminated"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch(spark, "tokens")
    manifest = token_files.write_token_files(read(spark, sf_dir, "documents"), folder,
                                             public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, folder, manifest)


@query
def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = histogram_sort.shard(read(spark, sf_dir, "documents"), 40)
    s = F.col("shard")
    return got.select("doc_id", s["size"].alias("size"),
                      F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                      s["law"].alias("law"), s["shard"].alias("shard"), s["slot"].alias("slot"),
                      s["grown_shard"].alias("grown_shard"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % 4
    model = language_id.fit(docs, train_rows=fold != 2)
    got = language_id.identify(docs, model)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return got.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"),
                      F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(read(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken")))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), train_rows=fold != 0)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = toxicity.score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"),
                                             F.col("toxicity").alias("score"))
    return got.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ngram_join.ngram_classes(read(spark, sf_dir, "documents"), size=3, threshold=0.9)
    return got.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op2_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vector_join.vector_links(read(spark, sf_dir, "embeddings"))
    return got.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secret_scan.scan(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    owned = F.filter("spans", lambda s: s["kind"] == 3)
    return got.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                      secret_scan.listed(F.col("spans")).alias("spans"), F.size(owned).cast("long").alias("n_owned"),
                      F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


@query
def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_templates.drop_recurring(read(spark, sf_dir, "documents"), min_tokens=1)
    d = F.col("lines")
    return got.select("doc_id", d["n_lines"].alias("n_lines"), d["n_dropped"].alias("n_dropped"),
                      F.sha2(d["text"], 256).alias("kept_sha256"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = byte_bpe.encode_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                    public_tokenizers.PATTERN, decoded="decoded")
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = conversation_trie.with_shared_heads(conversation_trie.sequences(read(spark, sf_dir, "conversations")))
    return conversation_trie.trie(rebuilt)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vector_codes.encode(read(spark, sf_dir, "embeddings"))
    return got.rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(got.codebooks_sha256()).alias("codebooks_sha256"))
