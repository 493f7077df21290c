"""From raw documents to packed token windows, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet into the shared folder and reads them again for
the next, so a lost executor costs at most a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm import decontamination, language, packing, partenum, substrings
from runnel.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least share of a document's letters in its main language; texts of two languages stay.
MAIN_LANGUAGE = 0.34
VOCABULARY = "word_bpe_49k.json"
#: Rows and bytes of an Arrow batch. Whole texts go to Python and back, and both sides hold a batch each way.
BATCH = 3_000
BATCH_BYTES = 4 << 20


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; those without letters, null ones included, and those without a main language go.

    Learned from the labelled documents outside the held-out fold. Rows with
    a null doc_id are judged like others.
    """
    _small_batches(spark)
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs, model, carry=[c for c in COLUMNS if c != "doc_id"])
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MAIN_LANGUAGE)
    return found.where(kept).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8: that of the smallest doc_id."""
    _small_batches(spark)
    groups = partenum.similar_groups(docs, words=5, percent=80)
    dropped = groups.where("doc_id != component_id").select("doc_id").distinct()
    # Rows that share a doc_id are one document; null ones are kept.
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def remove_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that an earlier document has; texts without such passages stay as they are.

    A document of which no word is left goes.
    """
    _small_batches(spark)
    cut = substrings.remove_repeats(docs, carry=["lang", "source"], as_is=True)
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_words") > F.col("n_removed")))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item, nor a shorter item as a whole."""
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, benchmark, carry=[c for c in COLUMNS if c != "doc_id"])
    return found.where("n_hit = 0").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of the remaining documents, one row per piece, with its ids."""
    _small_batches(spark)
    return packing.pack(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("language", identify_language),
    ("jaccard", drop_near_duplicates),
    ("substrings", remove_substrings),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Language models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
