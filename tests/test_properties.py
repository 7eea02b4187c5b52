"""Properties on the smallest scale factor: invariants of splits, rankings and metrics."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from rankshelf.operators.metrics import ranking_metrics
from rankshelf.operators.popularity import popular
from rankshelf.operators.readlists import distinct_users, histories_of, holdouts_of, split_ids
from rankshelf.plans.recommend import recommend
from rankshelf.sources.tables import Tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def served(tables):
    hist = histories_of(tables.reads)
    recs = recommend(tables.users, hist, tables.reads, popular(tables.items), tables.embeddings, 10)
    return hist, recs.toPandas()


def test_split_is_disjoint_complete_and_stable(tables):
    users = distinct_users(tables.reads)
    a = {(r.user_id, r.split) for r in split_ids(users, "user_id", distinct=True).collect()}
    b = {(r.user_id, r.split) for r in split_ids(users.repartition(5), "user_id", distinct=True).collect()}
    assert a == b
    ids = [u for u, _ in a]
    assert len(ids) == len(set(ids)) == users.count()
    assert sum(1 for _, s in a if s == "test") == len(ids) // 5


def test_recommendations_exclude_history_and_rank_without_gaps(served):
    hist, recs = served
    seen = {(r.user_id, r.item_id) for r in hist.select("user_id", "item_id").collect()}
    assert not any((u, i) in seen for u, i in zip(recs.user_id, recs.item_id))
    for _, grp in recs.groupby("user_id"):
        assert sorted(grp["rank"]) == list(range(1, len(grp) + 1))
        assert grp.item_id.is_unique
        assert list(grp.sort_values("rank").score) == sorted(grp.score, reverse=True)


def test_repartitioned_inputs_give_the_same_recommendations(tables, served):
    _, recs = served
    reads = tables.reads.repartition(7, "item_id")
    hist = histories_of(reads)
    again = recommend(tables.users, hist, reads, popular(tables.items.repartition(3)), tables.embeddings.repartition(2), 10)
    key = ["user_id", "rank"]
    assert recs.sort_values(key)[["user_id", "rank", "item_id"]].values.tolist() == \
        again.toPandas().sort_values(key)[["user_id", "rank", "item_id"]].values.tolist()


def test_metrics_are_between_zero_and_one(tables, served):
    _, recs = served
    spark = tables.spark
    preds = spark.createDataFrame(recs[["user_id", "rank", "item_id"]])
    truth = holdouts_of(tables.reads).select("user_id", "item_id")
    vals = ranking_metrics(preds, truth, tables.users).agg(F.min("value"), F.max("value")).first()
    assert 0.0 <= vals[0] <= vals[1] <= 1.0
