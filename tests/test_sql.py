"""Registered queries against their SQL, over whole tables."""

import pytest
from compare import differences, duck

from quillspark.plans.catalog import QUERIES, SQL

SLOW = {"cv_scores", "model_leaderboard", "best_model", "csv_scan", "confusion_matrix", "count_vectors_books", "feature_names",
        "answerable_gate", "stopwords_a", "length_filter", "tokenize_a", "drop_empty_pages", "count_vectors", "review_len"}


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", [n for n in SQL if n not in SLOW])
def test_same_rows(spark, con, folder, name):
    assert differences(QUERIES[name](spark, folder).toPandas(), con.execute(SQL[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
