"""The operators bound to the test tables, as (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm import bpe, decontamination, infill, language, lattice, negatives, oracles, packing, pages, partenum, scoring, sharding, substrings, tokens

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}
_further: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def further_query(function: Query) -> Query:
    _further[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_registry)


def further() -> dict[str, Query]:
    """Queries beside those of each operator: the same operator with other parameters."""
    return dict(_further)


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)


def further_sql() -> dict[str, str]:
    return dict(oracles.FURTHER_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json", with_ids=False)


@query
def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce("text", F.lit("")))
    cells = [sharding.hash_level(F.col("source"), 5), sharding.log_level(size, 5), sharding.hash_level(F.col("lang"), 5)]
    out = sharding.hilbert_shards(docs, cells, 5, 24, "doc_id", [size, crc])
    return out.select(
        "doc_id",
        F.col("c0").alias("size"),
        F.col("c1").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", "n_words", "n_backed_off", F.round("log_score", 4).alias("log_score"), F.round(F.try_divide("log_score", "n_words"), 6).alias("per_word"))


@query
def op3_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(scoring.backoff_scores(table(spark, sf_dir, "documents")))


@further_query
def op3_trigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(scoring.backoff_scores(table(spark, sf_dir, "documents"), order=3, compress=True))


@query
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages")
    text = pages.main_text(raw, pages.fit(raw), carry=["url"])
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.similar_groups(table(spark, sf_dir, "documents"), words=3, percent=90)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "byte_bpe_50k.json"
    encoded = bpe.encode(table(spark, sf_dir, "documents"), name)
    decoded = encoded.withColumn("decoded", bpe.decoder(spark, name)("ids"))
    return decoded.select("doc_id", "n_tokens", bpe.digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    output, back = F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", output, back)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
