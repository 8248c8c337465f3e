"""The registered queries of the operators: each over its whole table, with the columns of its contract."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctual.llm import alignment, decontaminate, embeddings, jaccard, language, licenses, runs, sentencepiece, sharding, suffix, tokens, topk, toxicity
from punctual.llm.oracle import ORACLE
from punctual.llm.text import crc_mod_4, likely_rows
from punctual.runtime import kept_dir, visible_to_workers


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    visible_to_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.link_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    placed = sharding.shard(rows, 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("piece_bpe_32k.model")
    coded = sentencepiece.decode(sentencepiece.encode(docs, path), path)
    whole = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_chunks", F.xxhash64("ids").alias("ids_hash"), whole.alias("round_trip"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_join(table(spark, sf_dir, "documents"), "doc_id", "text", size=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.where((crc_mod_4("doc_id") != 2) & F.col("toxic").isNotNull())
    labelled = likely_rows(docs, "doc_id", labels, "doc_id").join(labels, "doc_id")
    scored = toxicity.toxicity(docs, labelled)
    held_out = F.coalesce(crc_mod_4("doc_id") == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "log_ratio")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, keep_text=False).drop("text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = kept_dir(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return tokens.read_tokens(spark, path, digest=True)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(crc_mod_4("doc_id") == 2, F.lit(False)))
    return language.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def planted(docs: DataFrame) -> DataFrame:
    """``text`` made periodic from some word on, as op11's contract says: for every tenth id by its crc32."""
    h, words = F.crc32(F.col("doc_id").cast("string")), F.expr(r"filter(split(text, '[ \\x09-\\x0D]+'), x -> x <> '')")
    docs = docs.withColumns({"h": h, "w": F.when(h % 10 == 0, words)}).withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("w")})
    first = F.expr("int(g % n)")
    docs = docs.withColumn("a", F.when(F.col("n") > 0, first)).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    periodic = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, element_at(w, int(a + (i - a) % p + 1)))), ' ')")
    return docs.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(planted(table(spark, sf_dir, "documents")))
    every = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start", "strongest.length", "strongest.period",
        F.floor(1000 * F.col("strongest.length") / F.col("strongest.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(every, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = rows.where(finite).withColumn("embedding", F.transform("embedding", lambda x: F.floor(256 * x)))
    found = topk.top_k(whole, F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_sharding": op2_sharding,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_licenses": op8_licenses,
    "op9_tokens": op9_tokens,
    "op10_language": op10_language,
    "op11_runs": op11_runs,
    "op12_topk": op12_topk,
    "op13_alignment": op13_alignment,
}
