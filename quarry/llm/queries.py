"""The registered query of each operator, over its whole table, with
production parameters; digest columns are derived here."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, block_naming, decontamination, html_text, licenses, mixing, packing, quality, secrets, sharding, simhash, substrings, whitening
from .common import KEY, keyed

REGISTRY: dict = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document at 3-word shingles and 2 bits."""
    found = simhash.near_duplicates(keyed(documents(spark, sf_dir)))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id", "kept")


@query
def op5_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-duplicate group of every document."""
    return block_naming.exact_duplicates(keyed(documents(spark, sf_dir))).drop(KEY)


@query
def op9_fair_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(keyed(documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judged(documents(spark, sf_dir)).drop("n_lines")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, each blob scanned once."""
    found = secrets.scan_documents(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))

    def line(x):
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in secrets.BASE], F.sha2(line(base), 256).alias("base_sha256"),
                        line(F.col("spans")).alias("spans"), "blob")


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    found = licenses.license_scan(documents(spark, sf_dir))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op3_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 2048 tokens."""
    pieces = packing.pack(documents(spark, sf_dir), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op4_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, sizes near equal."""
    rows = sharding.shard_rows(keyed(documents(spark, sf_dir)))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_cdc_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of every document."""
    return substrings.passages(keyed(documents(spark, sf_dir))).drop(KEY)


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings, one row per vector and component."""
    fit = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    share = F.array(*[F.lit(v / fit.trace) for v in fit.values]).cast("array<double>")
    rows = fit.rows.select(F.col("key").alias("vec_id"), F.col("deviation").try_cast("bigint").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(fit.identity_error).alias("identity_error"))


@query
def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a benchmark window."""
    found = decontamination.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of five filters over every source."""
    return audit.interactions(audit.masks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))
