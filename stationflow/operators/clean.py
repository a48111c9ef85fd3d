"""Union, cleaning and de-duplication of raw observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.schemas import OBSERVATION_COLUMNS

# Stations that changed their name and address over time.
RENAMED_STATIONS = {1: ("CLARENDON ROW", "Claredon Row")}

DEDUP_KEY = ["number", "last_update", "available_bike_stands"]
ORIGIN_COLUMNS = ["source_priority", "path"]


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.select([c for c in df.columns if not c.startswith("Unnamed")])


def group_without_nulls(df: DataFrame, *keys: str):
    """``groupBy`` in which rows with a NULL key belong to no group."""
    return df.dropna("any", subset=list(keys)).groupBy(*keys)


def union_sources(*sources: DataFrame) -> DataFrame:
    """Union by name; earlier sources win in a later de-duplication."""
    ranked = [
        s if "source_priority" in s.columns else s.withColumn("source_priority", F.lit(i))
        for i, s in enumerate(sources)
    ]
    out = ranked[0]
    for other in ranked[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def rename_stations(df: DataFrame, renamed: dict[int, tuple[str, str]] = RENAMED_STATIONS) -> DataFrame:
    """Give every row of a renamed station its present name and address."""

    def replaced(column: str, position: int) -> Column:
        out = F.col(column)
        for number, names in renamed.items():
            out = F.when(F.col("number") == number, F.lit(names[position])).otherwise(out)
        return out

    return df.withColumns({"name": replaced("name", 0), "address": replaced("address", 1)})


def clean_observations(df: DataFrame) -> DataFrame:
    """Declared columns only, then drop rows with any NULL.

    The projection comes first: a column that only one source has must not
    empty the others.
    """
    df = drop_unnamed(df)
    origin = [c for c in ORIGIN_COLUMNS if c in df.columns]
    return df.select(*OBSERVATION_COLUMNS, *origin).dropna("any", subset=OBSERVATION_COLUMNS)


def dedup_observations(df: DataFrame) -> DataFrame:
    """One row per (number, last_update, available_bike_stands).

    The first source, then the first file, then the smallest remaining columns
    win. An aggregate, so a group of copies collapses before it is shuffled,
    however large it is.
    """
    rest = [c for c in OBSERVATION_COLUMNS if c not in DEDUP_KEY]
    order = [c for c in ORIGIN_COLUMNS if c in df.columns] + rest
    kept = df.groupBy(*DEDUP_KEY).agg(F.min(F.struct(*order)).alias("kept"))
    return kept.select(*[
        F.col(c) if c in DEDUP_KEY else F.col(f"kept.{c}").alias(c) for c in OBSERVATION_COLUMNS
    ])


def dedup_weather(df: DataFrame) -> DataFrame:
    return df.dropDuplicates(
        ["station_id", "datetime", "atmospheric_pressure", "wind_speed", "air_temperature"]
    )


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source_priority").agg(F.count(F.lit(1)).alias("row_count"))


def latest_state(df: DataFrame) -> DataFrame:
    """Last known row of every station."""
    rest = [c for c in OBSERVATION_COLUMNS if c not in ("number", "last_update", "available_bike_stands")]
    order = ["last_update", "available_bike_stands", *rest]
    last = df.groupBy("number").agg(F.max(F.struct(*order)).alias("last"))
    return last.select("number", *[F.col(f"last.{c}").alias(c) for c in OBSERVATION_COLUMNS[1:]])
