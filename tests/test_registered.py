"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import check
import pytest

from cartwheel.plans.catalog import ORACLE, QUERIES

ROWS_ONLY = {
    "impute_pmm", "publish_imputed", "train_als_counts", "recommend_all", "recommend_subset", "score_pairs",
    "model_evaluation", "segment_users", "rfm_pca", "dual_recommendations",
    "user_product_preference",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    ok, note = check.compare(spark, duck, name, QUERIES[name], ORACLE.get(name), sf_dir)
    assert ok, note
    assert "TYPES" not in note, note


def test_queries_without_sql_are_known():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[0] == "product1_id"
