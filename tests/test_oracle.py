"""Every registered query against its SQL on the small tables."""

import compare
import pytest

import __spark_entry__ as entry
from stationflow.plans import oracle, queries

QUERIES, ORACLE = queries.QUERIES, oracle.ORACLE
# Companions of the trees: tests/test_models.py compares them with few trees.
ON_TREES = {"scored_rows", "reloaded_model"}
# Queries whose result depends on k-means or boosted trees have no SQL.
WITHOUT_SQL = {
    "elbow_curve", "centroids_long", "weekday_centroids", "weekend_centroids", "train_gbt",
    "factor_comparison", "feature_importance", "score_unseen", "model_roundtrip", "forecast_requests",
    "station_clusters",
}


@pytest.fixture(scope="module")
def con(small_dir):
    return compare.duck(small_dir)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - ON_TREES))
def test_query_equals_sql(spark, con, small_dir, name):
    assert compare.differences(QUERIES[name](spark, small_dir), con, ORACLE[name]) == []


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 10
