"""Choice of stations to model: extremes and random picks per cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions.chance import key_hash
from stationflow.operators.clean import group_without_nulls
from stationflow.operators.explore import measure_column


def cluster_activity(clustered: DataFrame) -> DataFrame:
    return group_without_nulls(clustered, "number", "cluster").agg(
        F.sum(measure_column("activity")).alias("total_activity")
    )


def cluster_extreme(activity: DataFrame, which: str) -> DataFrame:
    """Stations with the highest ("max") or lowest ("min") activity of their cluster, ties kept.

    An aggregate and a join, not a window: a cluster may hold most stations.
    """
    best = {"max": F.max, "min": F.min}[which]("total_activity").alias("total_activity")
    extremes = activity.groupBy("cluster").agg(best)
    return activity.join(F.broadcast(extremes), ["cluster", "total_activity"])  # one row per cluster


def unselected(clustered: DataFrame, selected: DataFrame) -> DataFrame:
    """Distinct stations per cluster that are not selected yet."""
    stations = clustered.where(F.col("cluster").isNotNull()).select("number", "cluster").distinct()
    return stations.join(selected, "number", "left_anti")


def sample_per_cluster(candidates: DataFrame, n: int = 3, seed: int = 7) -> DataFrame:
    """n repeatable picks per cluster. The limit applies per task before any shuffle."""
    drawn = Window.partitionBy("cluster").orderBy("draw", "number")
    return (
        candidates.withColumn("draw", key_hash(seed, "number"))
        .withColumn("pick", F.row_number().over(drawn))
        .where(F.col("pick") <= n)
        .select("number", "cluster")
    )


def selected_stations(clustered: DataFrame, n: int = 3, seed: int = 7) -> DataFrame:
    """Numbers of the most active, least active and n random stations of each cluster."""
    activity = cluster_activity(clustered)
    extremes = cluster_extreme(activity, "max").select("number").union(
        cluster_extreme(activity, "min").select("number")
    ).distinct()
    # Activity has one row per station and cluster, so it serves as the candidate list.
    picks = sample_per_cluster(unselected(activity, extremes), n, seed)
    return extremes.union(picks.select("number")).distinct()


def keep_selected(slots: DataFrame, selected: DataFrame) -> DataFrame:
    return slots.join(selected, "number", "left_semi")
