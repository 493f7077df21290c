"""The queries beside those of each operator, against their SQL."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from runnel.llm.queries import further, further_sql
from runnel.llm.scoring import narrow, widen

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables absent")


def test_further_queries_are_registered():
    assert "op3_trigram_scores" in queries() and set(further()) == set(further_sql())
    assert further().items() <= queries().items() and further_sql().items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(further_sql()))
def test_further_query_equals_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want, got = duck.sql(further_sql()[name]).to_arrow_table(), further()[name](spark, SMALL).toArrow()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names) and [got.schema.field(c).type for c in columns] == [want.schema.field(c).type for c in columns]
    assert sorted(zip(*(map(str, got.column(c).to_pylist()) for c in columns))) == sorted(zip(*(map(str, want.column(c).to_pylist()) for c in columns)))


@pytest.mark.parametrize("compress", [False, True])
def test_narrow_integers_come_back(compress):
    rng = np.random.default_rng(6)
    for most in (1, 200, 70_000, 1 << 33):
        for n in (0, 1, 2, 5000):
            values = rng.integers(0, most + 1, n)
            assert widen(narrow(values, compress), n, compress).tolist() == values.tolist()
    ones = np.append(np.ones(5000, np.int64), 300)
    assert not compress or len(narrow(ones, compress)) < 200


@pytest.mark.parametrize("name", ["op3_backoff_scores", "op3_trigram_scores"])
def test_texts_without_words_have_no_score_a_word(spark, tmp_path, name):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, " \n "), (5, "a b"), (None, "B c"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["n_words"]): r["per_word"] for r in queries()[name](spark, str(tmp_path)).collect()}
    assert set(got) == {(1, 3), (2, 0), (3, 0), (4, 0), (5, 2), (None, 2), (None, 0)}
    assert all((v is None) == (n == 0) for (_, n), v in got.items())
