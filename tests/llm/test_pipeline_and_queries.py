"""The pipeline's stages against brute force, and the queries against their SQL."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from odd import documents
from pyspark.sql import functions as F
from test_duplicates import groups, spaced
from test_labels_and_pages import words

import corpus_pipeline
from runnel.llm.queries import oracle_sql, registered

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables absent")
NAMES = [
    "op1_packing", "op2_hilbert_shards", "op3_backoff_scores", "op4_substrings", "op5_lattice_hashing", "op6_decontamination", "op7_language", "op8_main_text",
    "op9_jaccard_join", "op10_token_counts", "op11_prefix_bpe", "op12_hard_negatives", "op13_fill_in_middle", "pipeline",
]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    odd = documents(spark).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    return spark.read.parquet(f"{SMALL}/documents.parquet").union(odd.select(*corpus_pipeline.COLUMNS)).cache()


def test_registered():
    assert sorted(registered()) == sorted(NAMES) and set(oracle_sql()) < set(NAMES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "jaccard", "substrings", "decontamination", "packing"]


def test_language_stage_keeps_clean_documents(spark, docs):
    kept = rows_of(corpus_pipeline.identify_language(spark, docs, SMALL))
    given = rows_of(docs)
    assert not Counter(kept) - Counter(given)
    gone = Counter(given) - Counter(kept)
    # Nothing but rows without letters and short odd ones goes.
    assert all(not re.search(r"[^\W\d_]", r[1] or "") or len(r[1]) < 30 for r in gone) and sum(gone.values()) >= 3


def test_jaccard_stage_keeps_one_of_a_group(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    dropped = {key for key, _, component in groups(rows, 5, 80) if key is not None and component != key}
    want = [r for r in rows_of(docs) if r[0] is None or r[0] not in dropped]
    assert rows_of(corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)) == want and dropped


def test_substring_stage_cuts_repeats(spark, docs):
    first, rows = {}, rows_of(docs)
    for r in rows:
        w = spaced(r[1])
        for i in range(len(w) - 49):
            if r[0] is not None:
                first[tuple(w[i : i + 50])] = min(r[0], first.get(tuple(w[i : i + 50]), r[0]))
    want = []
    for r in rows:
        w, gone = spaced(r[1]), set()
        for i in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[i : i + 50])] < r[0]:
                gone.update(range(i, i + 50))
        if gone and len(gone) < len(w):
            text = " ".join(x for i, x in enumerate(w) if i not in gone)
            want.append((r[0], text, r[2], r[3], len(text)))
        elif not gone:
            want.append((*r[:4], None if r[1] is None else len(r[1])))
    assert rows_of(corpus_pipeline.remove_substrings(spark, docs, SMALL)) == sorted(want, key=str)


def test_decontamination_stage_drops_leaks(spark, docs):
    windows = set()
    for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words(row["text"])
        windows.update(tuple(w[i : i + 10]) for i in range(max(0, len(w) - 10) + 1 if w else 0))
    sizes = {len(x) for x in windows}

    def leaks(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    want = [r for r in rows_of(docs) if not leaks(r[1])]
    assert rows_of(corpus_pipeline.decontaminate(spark, docs, SMALL)) == want and len(want) < docs.count()


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert corpus_pipeline.ORACLE_SQL is None and out.count() > 100
    per_doc = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert per_doc.where("n != t").isEmpty()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want, got = duck.sql(oracle_sql()[name]).to_arrow_table(), registered()[name](spark, SMALL).toArrow()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names) and [got.schema.field(c).type for c in columns] == [want.schema.field(c).type for c in columns]
    assert sorted(zip(*(map(str, got.column(c).to_pylist()) for c in columns))) == sorted(zip(*(map(str, want.column(c).to_pylist()) for c in columns)))
