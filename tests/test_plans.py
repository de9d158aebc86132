"""Plan shapes that matter at scale."""

from __future__ import annotations

import pytest

from cartwheel.operators import analytics, evaluate, joins, recommend, segment
from cartwheel.plans.catalog import QUERIES
from cartwheel.plans.inputs import candidate_rows, segments

# Training and streaming run before there is a plan to look at; the factor model's own top-k is Spark's.
SKIPPED = {"train_als", "train_als_counts", "recommend_all", "recommend_subset", "model_evaluation", "dual_recommendations",
           "recommend_all_keys", "recommend_subset_keys", "model_evaluation_baseline"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIPPED))
def test_no_cross_join_and_no_row_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_reranking_is_expressions_only(star):
    lists = recommend.rerank(candidate_rows(star), star.train, evaluate.top_items(star.train, 10))
    text = plan(lists)
    assert "Python" not in text
    assert "MapInPandas" not in text


def test_vector_search_plans_without_a_job(spark, sf_dir):
    from cartwheel.operators import search

    base = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vector")
    spark.sparkContext.setJobGroup("vector-plan", "")
    plan(search.nearest(base, base.where("id % 50 = 0"), 3))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("vector-plan")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_dimensions_are_broadcast(star):
    lines = joins.all_lines(star.prior, star.train)
    text = plan(joins.denormalize(star.orders, lines, star.products, star.aisles, star.departments))
    assert text.count("BroadcastHashJoin") >= 3


def test_only_needed_columns_are_read(star):
    text = plan(analytics.churn_indicators(star.orders))
    assert "ReadSchema: struct<order_id:bigint,user_id:bigint,order_number:int,days_since_prior_order:int>" in text
    assert "PushedFilters: [IsNotNull(order_number), Not(EqualTo(order_number,1))]" in text


def test_prior_lines_prune_the_partition(star):
    assert "PartitionFilters: [isnotnull(eval_set" in plan(star.prior)


def test_top_n_per_segment_cuts_before_the_shuffle(star):
    users = segments(star, segment.rfm(star.orders, star.train))
    text = plan(segment.segment_popularity(users, star.orders, star.prior))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text.split("WindowGroupLimit")[2].split("\n")[0]


def test_top_lists_are_not_sorted_whole(star):
    assert "TakeOrderedAndProject" in plan(joins.top_products(star.train, 10))
