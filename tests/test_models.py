"""k-means and boosted trees: properties instead of values."""

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stationflow.operators import features, model, profile
from stationflow.plans import queries, views


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    """Registered queries fit all trees; here a few are enough."""
    monkeypatch.setattr(model, "TREES", 5)


def test_centroids_are_numbered_by_sum(spark, small_dir):
    rows = entry.queries()["centroids_long"](spark, small_dir)
    sums = [r.sum_of_stands for r in model.center_sums(rows).orderBy("cluster").collect()]
    assert len(sums) == 4 and sums == sorted(sums)


def test_elbow_starts_at_the_variance_sum(spark, small_dir):
    filled = profile.gap_fill(views.slot_table(spark, small_dir))
    curve = [r.wss for r in model.elbow(spark, filled, ks=(2, 3)).orderBy("num_clusters").collect()]
    whole = profile.wss_one_cluster(filled).first().wss
    assert abs(curve[0] - whole) < 1e-6 * whole
    assert curve[0] > curve[1] > curve[2] * 0.95


def test_gbt_repeats_and_beats_the_mean(spark, small_dir, tmp_path):
    # The test tables are random: give the target a dependence on the previous stands.
    rows = queries._stored_features(spark, small_dir).withColumn("avg_stands", F.col("prev_stands") + F.col("number") % 3)
    train_rows, test_rows = model.split(rows)
    fitted = model.train(train_rows, trees=20)
    scored = model.score(fitted, test_rows).select("number", "date", "time", "avg_stands", "raw_pred", "pred")
    again = model.score(model.train(train_rows, trees=20), test_rows).select(*scored.columns)
    assert scored.exceptAll(again).count() == 0
    mean = train_rows.agg(F.avg("avg_stands")).first()[0]
    base = scored.agg(F.sqrt(F.avg(F.pow(F.col("avg_stands") - mean, 2)))).first()[0]
    assert model.rmse(scored) < base
    model.save(fitted, str(tmp_path / "model"))
    loaded = model.score(model.load(str(tmp_path / "model")), test_rows).select(*scored.columns)
    assert scored.exceptAll(loaded).count() == 0


def test_importances_are_relative_to_the_largest(spark, small_dir):
    values = [r.importance for r in entry.queries()["feature_importance"](spark, small_dir).collect()]
    assert len(values) == 9 and max(values) == 100.0 and min(values) >= 0.0


def _rows(name, spark, small_dir):
    return entry.queries()[name](spark, small_dir).collect()


def test_scoring_keeps_every_row(spark, small_dir):
    rows = queries._stored_features(spark, small_dir)
    fitted = model.train(rows, trees=3)
    scored = model.score(fitted, rows)
    assert scored.count() == rows.count()
    missing = rows.where(~model.complete(rows, features.IMPORTANT_FACTORS)).count()
    assert missing > 0 and scored.where("pred IS NULL").count() == missing
    counts = {r.factor: r.row_count for r in model.missing_factors(rows, features.IMPORTANT_FACTORS).collect()}
    assert counts["dropped"] == missing and counts["usable"] == rows.count() - missing


def test_model_queries_give_their_rows(spark, small_dir):
    unseen = queries._features(spark, small_dir, views.UNSEEN, "half_even").where("time >= '05:30:00'").count()
    assert len(_rows("score_unseen", spark, small_dir)) == unseen
    assert len(_rows("model_roundtrip", spark, small_dir)) == queries._features(spark, small_dir).count()
    assert len(_rows("forecast_requests", spark, small_dir)) == views.requests(spark, small_dir).count()
    assert {r.factors: r.factor_count for r in _rows("factor_comparison", spark, small_dir)} == {"considered": 9, "important": 7}
    hold_out = model.split(queries._selected_features(spark, small_dir))[1].count()
    assert len(_rows("train_gbt", spark, small_dir)) == hold_out


def test_a_model_is_fitted_once(spark, small_dir):
    assert queries._fitted(spark, small_dir) is queries._fitted(spark, small_dir)


COMPANIONS = [
    "scored_rows", "holdout_rows", "request_check", "importance_check", "factor_comparison_check", "reloaded_model", "elbow_check",
    "cluster_account", "station_cluster_check",
]


@pytest.mark.parametrize("name", COMPANIONS)
def test_companions_equal_sql(spark, small_dir, name):
    con = compare.duck(small_dir)
    assert compare.differences(entry.queries()[name](spark, small_dir), con, entry.oracle_sql()[name]) == []


def _two_factors(spark, pairs):
    """Rows with these previous stands and latitudes; either one being high makes the target 10."""
    rows = [(f"2024-01-{1 + i % 9:02d}", "winter", "10:00:00", a, 10 * int(a > 0 or b > 0), float(b), -6.0, 1) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "date string, season string, time string, prev_stands long, avg_stands long, latitude double, longitude double, cluster int")


def _overshooting(spark):
    return _two_factors(spark, [(0, 0), (20, 0), (0, 5)] * 60)


def test_the_walk_is_the_model_and_its_range_holds(spark, monkeypatch):
    monkeypatch.setattr(model, "LEARNING_RATE", 1.0)
    monkeypatch.setattr(model, "DEPTH", 1)
    rows = _overshooting(spark)
    fitted = model.train(rows, trees=4)
    both = _two_factors(spark, [(20, 5)])  # never seen together: the effects add up
    scored = model.certified_score(spark, fitted, rows.union(both).union(rows.limit(1).withColumn("latitude", F.lit(None).cast("double"))))
    counts = {(r.follows, r.within): r["count"] for r in scored.groupBy("follows", "within").count().collect()}
    assert counts == {(True, True): 181, (None, None): 1}
    assert scored.agg(F.max("raw_pred")).first()[0] > 10.5  # trees promise no more than the range of their leaves


def test_a_changed_leaf_is_noticed(spark):
    rows = _overshooting(spark)
    fitted = model.train(rows, trees=4)
    table = model.tree_table(spark, fitted)
    assert table.where("left < 0").count() == table.where("left >= 0").count() + table.select("tree").distinct().count()
    changed = table.withColumn("value", F.col("value") + F.when((F.col("tree") == 2) & (F.col("left") < 0), 0.5).otherwise(0.0))
    coded = model.PipelineModel(fitted.stages[:3]).transform(model.with_weekday_code(rows))
    gaps = model.walked(changed, fitted.stages[3].transform(coded)).select((F.col("walk") - F.col("raw_pred")).alias("gap")).distinct().collect()
    weight = table.where("tree = 2").first().weight
    assert all(abs(r.gap - 0.5 * weight) < 1e-9 for r in gaps)


def test_models_fitted_side_by_side_are_the_same(spark):
    rows = _overshooting(spark)
    alone = [model.importances(spark, model.train(rows, trees=3), features.IMPORTANT_FACTORS).collect() for _ in range(2)]
    both = model.at_once({n: lambda: model.train(rows, trees=3) for n in "ab"})
    assert alone[0] == alone[1] == model.importances(spark, both["a"], features.IMPORTANT_FACTORS).collect()


def test_an_unsettled_clustering_is_noticed(spark, monkeypatch):
    days = spark.createDataFrame([(i, "d", [float(i % 3 * 10), float(i % 7), float(i)]) for i in range(60)], "number int, date string, stands array<double>")
    account = model.kmeans_account(spark, days, 3).first()
    assert (account.days, account.nearest, account.adds_up) == (60, True, True)
    values = [[float(i % 3 * 10), float(i % 7), float(i)] for i in range(60)]
    assert account.stands == sum(map(sum, values))
    mean = [sum(c) / 60 for c in zip(*values)]
    assert abs(account.squares - sum((x - m) ** 2 for v in values for x, m in zip(v, mean))) < 1e-6
    from pyspark.ml.clustering import KMeans
    monkeypatch.setattr(model, "fit_kmeans", lambda vectors, k, seed: KMeans(k=k, seed=1, maxIter=1, initMode="random").fit(vectors))
    assert not model.kmeans_account(spark, days, 3).first().settled


def test_k_means_keeps_decoded_vectors(spark, monkeypatch):
    days = spark.createDataFrame([(i, "d", [float(i % 3 * 10), float(i % 7), float(i)]) for i in range(60)], "number int, date string, stands array<double>")
    days = days.withColumn("times", F.array(*[F.lit(t) for t in ("00:00:00", "00:10:00", "00:20:00")]))
    levels, fit = [], model.KMeans.fit
    monkeypatch.setattr(model.KMeans, "fit", lambda self, vectors: levels.append(vectors.storageLevel) or fit(self, vectors))
    model.elbow(spark, days, ks=(2, 3))
    model.centroids(spark, days, 3)
    model.kmeans_account(spark, days, 3)
    assert len(levels) == 4 and not any(level.useMemory or level.useDisk for level in levels)


@pytest.mark.parametrize("at_once, most", [(59, 1), (120, 2)])
def test_large_fits_of_an_elbow_run_alone(spark, monkeypatch, at_once, most):
    days = spark.createDataFrame([(i, "d", [float(i % 3 * 10), float(i % 7), float(i)]) for i in range(60)], "number int, date string, stands array<double>")
    pools, pool = [], model.ThreadPool
    monkeypatch.setattr(model, "VECTORS_AT_ONCE", at_once)
    monkeypatch.setattr(model, "ThreadPool", lambda n: pools.append(n) or pool(n))
    assert model.elbow(spark, days, ks=(2, 3)).count() == 3 and pools == [most]


@pytest.mark.parametrize("scope", ["all", "station"])
def test_filled_days_are_the_filled_grid(spark, small_dir, scope):
    slots = views.stored_slots(spark, small_dir)
    days = profile.filled_days(slots, scope)
    cells = {(r.number, r.date, t): v for r in days.collect() for t, v in zip(r.times, r.stands)}
    grid = {}
    for r in profile.gap_fill(slots, scope).collect():
        grid.setdefault((r.number, r.date), {})[r.time] = r.available_stands
    whole = {(n, d, t): v for (n, d), row in grid.items() if None not in row.values() for t, v in row.items()}
    assert cells == whole


def test_training_starts_from_written_rows(spark):
    """Each of the many small jobs of the trees has two stages; the plan that made the rows is not gone through again."""
    rows = _overshooting(spark).repartition(5, "latitude").groupBy("date", "season", "time", "prev_stands", "latitude", "longitude", "cluster").agg(
        F.max("avg_stands").alias("avg_stands")).repartition(3)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("trees", "trees")
    try:
        fitted = model.train(rows, trees=5)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = sorted(tracker.getJobIdsForGroup("trees"))[-5:]
    assert len(fitted.stages[-1].trees) == 5
    assert all(len(tracker.getJobInfo(j).stageIds) <= 2 for j in jobs)


def test_codes_thresholds_and_missing_values_walk_as_the_trees_do(spark, monkeypatch):
    monkeypatch.setattr(model, "LEARNING_RATE", 0.5)
    seasons, nothing = ["autumn", "spring", "summer", "winter"], None
    rows = spark.createDataFrame(
        [(f"2024-01-{1 + i % 9:02d}", seasons[i % 4], f"{i % 24:02d}:00:00", i % 13 - 6, (i * 7) % 11 + 5 * (i % 4 == 2), float(i % 3), -6.0, i % 5)
         for i in range(600)],
        "date string, season string, time string, prev_stands long, avg_stands long, latitude double, longitude double, cluster int")
    table = model.tree_table(spark, fitted := model.train(rows, trees=12))
    assert table.where("left >= 0 AND categories = -1").count() and table.where("left >= 0 AND categories <> -1").count()
    odd = spark.createDataFrame([("2024-01-01", "monsoon", "10:10:00", -1, 0, float("nan"), -6.0, 1), ("2024-01-02", nothing, nothing, nothing, 0, nothing, -6.0, 1)], rows.schema)
    coded = model.PipelineModel(fitted.stages[:3]).transform(model.with_weekday_code(rows.union(odd)))
    walk = model.walked(table, fitted.stages[3].transform(coded)).select("walk", "raw_pred").collect()
    assert len(walk) == 602 and max(abs(r.walk - r.raw_pred) for r in walk) < 1e-9
