"""File readers and writers. Schemas are always explicit."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import schemas
from stationflow.operators.clean import (
    DEDUP_KEY, clean_observations, dedup_observations, rename_stations, union_sources,
)
from stationflow.session import scratch_path

# Fixed value: day key inside a snapshot file name, Www-dd-mm-yyyy.
DAY_KEY_PATTERN = r"([A-Z]{1}[a-z]{2})-([0-2][0-9]|3[0-1])-(0[0-9]|1[0-2])-\d{4}"
# Snapshots come first in the union, so they win over the CSV history.
SNAPSHOT_PRIORITY, HISTORY_PRIORITY = 0, 1
ENCODING = "ISO-8859-1"
# How CSV is written and read: a quote inside a quoted field is doubled, and nothing is trimmed.
DIALECT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# New snapshot files that a compaction reads together.
FILES_AT_ONCE = 10_000
# Different headers in one folder; more are taken for files that have none.
MAX_LAYOUTS = 200
# Stands for a quoted empty field while reading, which Spark would take for NULL.
EMPTY = "\u0001"


def _restored(rows: DataFrame) -> DataFrame:
    """Quoted empty fields as empty text; fields without anything stay NULL."""
    return rows.withColumns({
        name: F.when(F.col(f"`{name}`") == EMPTY, "").otherwise(F.col(f"`{name}`")) for name, kind in rows.dtypes if kind == "string"
    })


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a folder, or of a file; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def file_headers(spark: SparkSession, path: str, encoding: str = "UTF-8", options: dict | None = None) -> DataFrame:
    """(path, header): the first line of every file that has one, read by tasks from the files' first blocks."""
    lines = spark.read.options(**(options or {})).option("recursiveFileLookup", True).option("encoding", encoding).text(path)
    first = lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("i"), "_metadata.file_block_start")
    return first.where("file_block_start = 0").groupBy("path").agg(F.min_by("value", "i").alias("header"))


def heading(name: str) -> str:
    """A heading without regard to case, spaces and punctuation."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def _layouts(spark: SparkSession, path: str, wanted: dict[str, str], optional: set[str], encoding: str, options: dict) -> tuple[list[tuple[str, list[str], dict[str, int]]], DataFrame]:
    """(per distinct header, the most frequent first: its line, its names, and the place of each wanted column; headers by file)."""
    headers = file_headers(spark, path, encoding, options)
    counted = headers.groupBy("header").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "header").limit(MAX_LAYOUTS + 1).collect()
    if len(counted) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers below {path}")
    layouts, wrong = [], []
    for line, _ in counted:
        names = next(csv.reader([line.removeprefix("\ufeff")]), [])
        place = {}
        for i, name in enumerate(names):
            if (column := wanted.get(heading(name))) and column not in place:
                place[column] = i
        if missing := sorted(set(wanted.values()) - set(place) - optional):
            wrong.append((line, missing))
        layouts.append((line, names, place))
    if wrong:
        line, missing = wrong[0]
        found = [r.path for r in headers.where(F.col("header").isin([line for line, _ in wrong])).select("path").limit(20).collect()]
        raise ValueError(f"files without the columns {missing}: {found}")
    return layouts, headers


def read_headed(
    spark: SparkSession, path: str, schema: str, headings: dict[str, str] | None = None, encoding: str = "UTF-8",
    optional: tuple[str, ...] = (), **options,
) -> DataFrame:
    """CSV files with a header each, columns found by their headings: ``schema``'s columns, ``path``, and ``conflicts``.

    Their order is free and may differ from file to file; unnamed and other
    columns are left out. ``headings`` gives a column's heading where it is not
    the column's name. Files that lack a column raise an error, but for ``optional``
    ones, which are NULL there; empty files give nothing. ``conflicts`` names the columns whose text is not of their type;
    such a field is NULL.

    Files may be many: their headers are read by tasks, and only the distinct
    ones reach the driver. Files with an unusual header find it by a join.
    """
    fields = spark.createDataFrame([], schema).schema.fields
    wanted = {heading(f.name): f.name for f in fields} | {heading(text): column for column, text in (headings or {}).items()}
    layouts, headers = _layouts(spark, path, wanted, set(optional), encoding, options)
    width = max([len(names) for _, names, _ in layouts], default=1)
    texts = ", ".join(f"c{i} STRING" for i in range(width))
    reader = spark.read.options(**DIALECT, emptyValue=EMPTY, encoding=encoding, **options).option("recursiveFileLookup", True)
    rows = _restored(reader.schema(texts).csv(path)).withColumn("path", F.col("_metadata.file_path"))
    layout = F.lit(0)
    if len(layouts) > 1:
        order = F.create_map(*[x for i, (line, _, _) in enumerate(layouts) for x in (F.lit(line), F.lit(i))])
        unusual = headers.where(F.col("header") != layouts[0][0]).select(F.col("path").alias("file"), order[F.col("header")].alias("layout"))
        rows = rows.join(unusual, F.col("path") == F.col("file"), "left")
        layout = F.coalesce("layout", F.lit(0))
    columns, conflicts = [], []
    for field in fields:
        text = F.lit(None).cast("string")
        for i, (_, _, place) in enumerate(layouts):
            if field.name in place:
                text = F.when(layout == i, F.col(f"c{place[field.name]}")).otherwise(text)
        kind = field.dataType.simpleString()
        value = text if kind == "string" else text.try_cast(kind)
        if kind == "bigint":
            value = F.coalesce(value, text.try_cast("double").try_cast("bigint"))  # 12.0 beside missing values
        columns.append(value.alias(field.name))
        if kind != "string":
            conflicts.append(F.when((F.trim(text) != "") & value.isNull(), F.lit(field.name)))
    return rows.select(*columns, "path", F.array_compact(F.array(*conflicts)).alias("conflicts"))


def type_conflicts(headed: DataFrame) -> DataFrame:
    """(path, column, row_count) of the fields that ``read_headed`` could not take as their type."""
    return headed.select("path", F.explode("conflicts").alias("column")).groupBy("path", "column").agg(F.count("*").alias("row_count"))


def read_observations_csv(spark: SparkSession, path: str, encoding: str = ENCODING) -> DataFrame:
    """A directory of observation CSV files by their headings, with the origin of each row."""
    return read_headed(spark, path, schemas.OBSERVATION, encoding=encoding).select(
        *schemas.OBSERVATION_COLUMNS, F.lit(HISTORY_PRIORITY).alias("source_priority"), "path")


def read_snapshots_json(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Snapshot files, each an array of stations; empty arrays give no rows.

    With ``multi_line`` off a file holds one array per line, which large landed
    files need to be split between tasks.
    """
    rows = spark.read.schema(schemas.SNAPSHOT).option("multiLine", multi_line).json(path)
    return rows.select(
        *schemas.OBSERVATION_COLUMNS,
        F.lit(SNAPSHOT_PRIORITY).alias("source_priority"), F.col("_metadata.file_path").alias("path"),
    )


def day_key(path: Column) -> Column:
    """Day key of a snapshot file, from its name or its folder's; empty when neither has one."""
    return F.regexp_extract(F.substring_index(path, "/", -2), DAY_KEY_PATTERN, 0)


def unmatched_files(snapshots: DataFrame) -> DataFrame:
    return snapshots.where(day_key(F.col("path")) == "").select("path").distinct()


def pending(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose ``day`` is not in ``done``."""
    return rows.join(done.select("day").distinct(), "day", "left_anti")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def compact_days(spark: SparkSession, landing: str, path: str, multi_line: bool = True, at_once: int = FILES_AT_ONCE) -> DataFrame:
    """Take the snapshot files that are new since the last run into the day table at ``path``.

    ``path``-files lists what has been taken; only other files are read, some
    ``at_once``, so a list of that length is all that the driver holds. Their
    days are merged with what is there, so a late file loses nothing, and a run
    that broke off before its list was written is simply repeated. Returns the
    paths whose names have no day; they are not taken.
    """
    manifest, listed = f"{path}-files", scratch_path(spark, "listed")
    names = list_files(spark, landing).select("path")
    known = spark.read.schema("path STRING").parquet(manifest) if _exists(spark, manifest) else names.limit(0)
    names.join(known, "path", "left_anti").withColumn("day", day_key(F.col("path"))).write.parquet(listed)
    found = spark.read.schema("path STRING, day STRING").parquet(listed)
    last = ""
    while new := [r.path for r in found.where((F.col("day") != "") & (F.col("path") > last)).orderBy("path").limit(at_once).collect()]:
        rows = read_snapshots_json(spark, new, multi_line).withColumn("day", day_key(F.col("path")))
        if _exists(spark, path):
            days = found.where(F.col("path").between(new[0], new[-1]) & (F.col("day") != "")).select("day").distinct()
            rows = read_compacted(spark, path).join(days, "day", "left_semi").unionByName(rows)
        staged = scratch_path(spark, "days")
        dedup_by_day(rows).hint("rebalance", "day").write.parquet(staged)
        (
            spark.read.schema(DAY_TABLE).parquet(staged)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        )
        spark.createDataFrame([(f,) for f in new], "path STRING").write.mode("append").parquet(manifest)
        last = new[-1]
    return found.where("day = ''").select("path")


def dedup_by_day(keyed: DataFrame) -> DataFrame:
    """Complete rows, one per observation key and day; the first file wins."""
    rest = [c for c in schemas.OBSERVATION_COLUMNS if c not in DEDUP_KEY]
    kept = keyed.dropna("any", subset=schemas.OBSERVATION_COLUMNS).groupBy("day", *DEDUP_KEY).agg(
        F.min(F.struct("path", *rest)).alias("kept")
    )
    return kept.select(*[
        F.col(c) if c in DEDUP_KEY else F.col(f"kept.{c}").alias(c) for c in schemas.OBSERVATION_COLUMNS
    ], F.col("kept.path").alias("path"), "day")


DAY_TABLE = f"{schemas.OBSERVATION}, path STRING, day STRING"


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAY_TABLE).parquet(path).withColumn("source_priority", F.lit(SNAPSHOT_PRIORITY))


def prepare(*sources: DataFrame) -> DataFrame:
    """Clean, de-duplicated observations from several readers."""
    return dedup_observations(clean_observations(rename_stations(union_sources(*sources))))


TOLERANT = {"ignoreCorruptFiles": True, "ignoreMissingFiles": True}
ANSWERED = ("actual_time", "actual_stands", "actual_bikes")


def read_forecast_log(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Forecast logs, by their headings or without a header by position; unreadable files are skipped and short rows filled with NULLs."""
    if header:
        names = schemas.FORECAST_LOG_HEADINGS
        return read_headed(spark, path, schemas.FORECAST_LOG, names, ENCODING, ANSWERED, **TOLERANT).drop("path", "conflicts")
    return (
        spark.read.schema(schemas.FORECAST_LOG)
        .option("header", header).option("encoding", ENCODING).option("mode", "PERMISSIVE")
        .options(**TOLERANT).option("recursiveFileLookup", True)
        .csv(path)
    )


def log_account(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """What ``read_forecast_log`` meets, by file that is not empty: path, row_count, short_rows, malformed_rows, unreadable.

    A short row ends before the answer's fields. A malformed one has a field that
    is no whole number, fewer fields than a forecast, or too many; such fields are
    read as NULL. A file is unreadable if it has bytes and gives no line.
    """
    lines = spark.read.options(**TOLERANT).option("recursiveFileLookup", True).option("encoding", ENCODING).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), "value").withColumn("first", F.lit(None).cast("string"))
    if header:
        heads = file_headers(spark, path, ENCODING, TOLERANT).groupBy("header").count().limit(MAX_LAYOUTS).collect()
        lines = lines.withColumn("first", F.when(F.col("value").isin([r.header for r in heads]), F.col("value")))
    fields = F.split("value", ",")
    wrong = F.exists(fields, lambda f: (F.trim(f) != "") & f.try_cast("bigint").isNull())
    width, least = len(schemas.FORECAST_LOG.split(", ")), len(schemas.FORECAST_LOG.split(", ")) - len(ANSWERED)
    malformed = wrong | (F.size(fields) < least) | (F.size(fields) > width)
    row = F.col("first").isNull() & (F.trim("value") != "")
    counts = lines.groupBy("path").agg(
        F.count_if(row).alias("row_count"), F.count_if(row & ~malformed & (F.size(fields) < width)).alias("short_rows"),
        F.count_if(row & malformed).alias("malformed_rows"))
    return list_files(spark, path).join(counts, "path", "left").select(
        "path", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("row_count", "short_rows", "malformed_rows")],
        (F.col("row_count").isNull() & (F.col("length") > 0)).alias("unreadable"))


def append_forecast_log(log: DataFrame, path: str) -> None:
    """Append log rows, one folder per day of the forecast."""
    day = F.date_format(F.timestamp_seconds("time"), "yyyy-MM-dd")
    headed = log.withColumn("day", day).withColumnsRenamed(schemas.FORECAST_LOG_HEADINGS)
    headed.hint("rebalance", "day").write.mode("append").options(**DIALECT).partitionBy("day").csv(path)


def save_csv(df: DataFrame, path: str, headings: dict[str, str] | None = None, encoding: str = "UTF-8") -> None:
    """CSV with a header, replacing what is there. ``headings`` renames at the edge."""
    out = df.withColumnsRenamed(headings) if headings else df
    out.write.mode("overwrite").options(**DIALECT, emptyValue='""', encoding=encoding).csv(path)


def read_slots_csv(spark: SparkSession, path: str, parse_dates: bool = False) -> DataFrame:
    """The slot table from exchanged CSV; ``date`` stays text unless it is to be parsed."""
    rows = read_headed(spark, path, schemas.SLOT_FACT, schemas.SLOT_FACT_HEADINGS).drop("path", "conflicts")
    return rows.withColumn("date", F.to_date("date")) if parse_dates else rows


def write_slots(slots: DataFrame, path: str) -> None:
    """The slot table as Parquet by date, so date ranges prune whole folders."""
    (
        slots.hint("rebalance", "date").sortWithinPartitions("date", "number", "time")
        .write.mode("overwrite").partitionBy("date").parquet(path)
    )


def save_station_buckets(slots: DataFrame, table: str, path: str, buckets: int) -> None:
    """The slot table bucketed by station: per-station steps on it need no shuffle."""
    (
        slots.repartition(buckets, "number")
        .write.mode("overwrite").option("path", path).bucketBy(buckets, "number").sortBy("number").saveAsTable(table)
    )


def read_slots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SLOT_FACT).parquet(path)


def read_geography(spark: SparkSession, path: str) -> DataFrame:
    return read_headed(spark, path, schemas.GEOGRAPHY).drop("path", "conflicts")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return read_headed(spark, path, schemas.WEATHER).drop("path", "conflicts")
