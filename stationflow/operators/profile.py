"""Station-day matrices, gap filling, station profiles and nearest centers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import clock
from stationflow.functions.clock import SLOT_LEVELS, WORKDAYS

STATIONS_PER_BLOCK = 4096
# Rows that a walk over station-days holds as a matrix.
ROWS_AT_ONCE = 4096


def split_week(slots: DataFrame, part: str) -> DataFrame:
    """``weekday`` keeps Monday to Friday, ``weekend`` the rest."""
    workday = F.col("weekday").isin(WORKDAYS)
    return slots.where(workday if part == "weekday" else ~workday)


def time_levels(slots: DataFrame) -> DataFrame:
    return slots.select("time").distinct().orderBy("time")


def _cells(slots: DataFrame) -> DataFrame:
    """Known cells (number, day, slot_no, v) of the station-day matrix, with integer positions."""
    return slots.select(
        "number", F.col("date").cast("date").alias("day"), clock.slot_number(F.col("time")).alias("slot_no"),
        "available_stands", F.struct("name", "address").alias("named"),
    ).groupBy("number", "day", "slot_no").agg(F.min_by("available_stands", "named").alias("v"))


def _levels(slots: DataFrame):
    """Sorted slot numbers seen anywhere, at most 144, as one scalar array."""
    return slots.agg(F.sort_array(F.collect_set(clock.slot_number(F.col("time"))))).scalar()


def _spread(cells: DataFrame, slots: DataFrame) -> DataFrame:
    """Every (number, day) at every level; absent cells are NULL.

    A station-day gathers its at most 144 cells in a map, which is then read at
    each level: no join. Partitioning by ``number`` is kept.
    """
    days = cells.groupBy("number", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("slot_no", "v"))).alias("cells")
    )
    return days.select("number", "day", "cells", F.posexplode(_levels(slots)).alias("pos", "slot_no")).select(
        "number", "day", "pos", "slot_no", F.element_at("cells", F.col("slot_no")).alias("v")
    )


def _as_table(spread: DataFrame, value: str = "v") -> DataFrame:
    return spread.select(
        "number", F.col("day").cast("string").alias("date"), clock.slot_label(F.col("slot_no")).alias("time"),
        F.col(value).alias("available_stands"),
    )


def slot_grid(slots: DataFrame) -> DataFrame:
    """Every (number, date) at every time seen anywhere; absent slots are NULL."""
    return _as_table(_spread(_cells(slots), slots))


def _walk(before: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (group, place, start, cells) in order: the last value of every slot within the group, up to and with the row.

    ``before`` leaves the row itself out. Rows marked ``start`` only set off their group and are not returned.
    """
    def walk(batches):
        width, group = len(SLOT_LEVELS), None
        state, has = np.zeros(width, np.int64), np.zeros(width, bool)
        for part in (batch.slice(at, ROWS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, ROWS_AT_ONCE)):
            groups, place, start, cells = part.columns
            code = groups.dictionary_encode("encode").indices.to_numpy()
            new = np.r_[group is None or groups[0] != group, code[1:] != code[:-1]]
            flat = cells.flatten()
            slot, value = flat.field("slot_no").fill_null(-1).to_numpy(), flat.field("v")
            known = value.is_valid().to_numpy(False) & (slot >= 0) & (slot < width)
            rows = np.repeat(np.arange(1, part.num_rows + 1), cells.value_lengths().to_numpy())[known]
            # Row 0 is what the part before left behind.
            values, seen = np.zeros((part.num_rows + 1, width), np.int64), np.zeros((part.num_rows + 1, width), bool)
            values[0], seen[0] = state, has
            values[rows, slot[known]], seen[rows, slot[known]] = value.fill_null(0).to_numpy()[known], True
            numbers = np.arange(part.num_rows + 1)
            first = np.maximum.accumulate(np.where(np.r_[False, new], numbers, 0))[:, None]
            source = np.maximum.accumulate(np.where(seen, numbers[:, None], 0), axis=0)
            seen = (source >= first) & np.take_along_axis(seen, source, 0)
            values = np.take_along_axis(values, source, 0)
            group, state, has = groups[part.num_rows - 1], values[-1], seen[-1]
            if before:
                values, seen = values[:-1], seen[:-1] & ~new[:, None]
            else:
                values, seen = values[1:], seen[1:]
            keep = ~start.to_numpy(False)
            values, seen = values[keep], seen[keep]
            lists = pa.ListArray.from_arrays(
                np.arange(0, values.size + 1, width, dtype=np.int32), pa.array(values.ravel(), mask=~seen.ravel()))
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [groups.filter(kept), place.filter(kept), lists, pa.array(seen.sum(1, dtype=np.int32))], [*part.schema.names[:2], "held", "n_held"])

    return walk


def _carry(rows: DataFrame, starts: DataFrame, group: str, place: str, before: bool = False) -> DataFrame:
    """(group, place, held, n_held): the last value of each of a day's slots in the group, in the order of ``place``, and how many there are.

    ``rows`` are (group, place, cells); ``starts`` (group, cells) come before a
    group's first row. A task walks over its sorted rows and keeps the values of
    one row, so that a group may be of any size.
    """
    both = rows.select(group, place, F.lit(False).alias("start"), "cells").union(
        starts.select(group, F.lit(None).alias(place), F.lit(True).alias("start"), "cells"))
    sorted_rows = both.repartition(group).sortWithinPartitions(group, F.desc("start"), place)
    kinds = {f.name: f.dataType.simpleString() for f in both.schema}
    return sorted_rows.mapInArrow(_walk(before), f"{group} {kinds[group]}, {place} {kinds[place]}, held ARRAY<BIGINT>, n_held INT")


def _gathered(value: str) -> Column:
    return F.collect_list(F.struct("slot_no", F.col(value).cast("long").alias("v"))).alias("cells")


def _inflow(cells: DataFrame, slots: DataFrame) -> DataFrame:
    """Per station: the values that flow in from earlier stations, one per slot.

    Stations are scanned in blocks, then block to block, so no task sees all
    stations. Where nothing precedes, the first known value of the level flows
    back.
    """
    # Rows without a number are left out only after they are counted, and the join knows nulls: a filter pushed below the
    # slots' shuffle would keep the days from reading the same one.
    known = cells.groupBy("number", "slot_no").agg(
        F.min_by("v", "day").alias("first"), F.max_by("v", "day").alias("last")
    ).withColumn("block", F.floor(F.col("number") / STATIONS_PER_BLOCK))
    ends = known.groupBy("block", "slot_no").agg(
        F.min_by("first", "number").alias("block_first"), F.max_by("last", "number").alias("block_last"), F.count("number").alias("n")
    ).where("n > 0")
    grid = ends.select("block").distinct().select("block", F.explode(_levels(slots)).alias("slot_no"))
    by_block = Window.partitionBy("slot_no").orderBy("block")
    same = grid["block"].eqNullSafe(F.col("of.block")) & grid["slot_no"].eqNullSafe(F.col("of.slot_no"))
    blocks = grid.join(ends.alias("of"), same, "left").select(grid["block"], grid["slot_no"], "block_first", "block_last").select("block", "slot_no", F.coalesce(
        F.last("block_last", True).over(by_block.rowsBetween(Window.unboundedPreceding, -1)),
        F.first("block_first", True).over(by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    ).alias("from_blocks"))
    stations = known.groupBy("block", "number").agg(_gathered("last"))
    carried = _carry(stations, blocks.groupBy("block").agg(_gathered("from_blocks")), "block", "number", before=True)
    return carried.select("number", F.transform("held", lambda v, i: F.struct(i.alias("slot_no"), v.alias("v"))).alias("cells"))


def _filled(slots: DataFrame, scope: str) -> DataFrame:
    """(number, day, levels, stands, whole): one row per station-day, its stands at every level after the fill, and whether none is missing.

    A day stays one row throughout: its known cells travel, and one walk over a
    station's days carries all levels forward.
    """
    if scope not in ("all", "station"):
        raise ValueError(f"unknown fill scope: {scope}")
    cells = _cells(slots)
    days = cells.groupBy("number", "day").agg(_gathered("v"))
    if scope == "all":
        starts = _inflow(cells, slots)
    else:
        firsts = cells.where(F.col("v").isNotNull()).groupBy("number", "slot_no").agg(F.min_by("v", "day").alias("first"))
        starts = firsts.groupBy("number").agg(_gathered("first"))
    filled = _carry(days, starts, "number", "day").withColumn("levels", _levels(slots))
    last = len(SLOT_LEVELS) - 1
    every_slot = (F.size("levels") == last + 1) & (F.get("levels", F.lit(0)) == 0) & (F.get("levels", F.lit(last)) == last)
    stands = F.when(every_slot, F.col("held")).otherwise(F.transform("levels", lambda level: F.get("held", level)))
    return filled.select("number", "day", "levels", stands.alias("stands"), (F.col("n_held") == F.size("levels")).alias("whole"))


def gap_fill(slots: DataFrame, scope: str = "all") -> DataFrame:
    """The grid with missing slots filled, time level by time level, from the previous row.

    Rows are ordered by (number, date). With scope ``all`` the fill runs across
    stations and a level's leading gap takes its first known value; with
    ``station`` it stays within the station, whose leading gap takes the
    station's own first known value. A level with no value stays NULL.

    The fill is done on whole days; their levels become rows at the very end.
    A station has one row per day, so the window is small however busy the
    station; only its first and last values meet other stations.
    """
    rows = _filled(slots, scope).select("number", "day", F.explode(F.arrays_zip("levels", "stands")).alias("cell"))
    return rows.select(
        "number", F.col("day").cast("string").alias("date"), clock.slot_label(F.col("cell.levels")).alias("time"),
        F.col("cell.stands").alias("available_stands"))


def filled_days(slots: DataFrame, scope: str = "all") -> DataFrame:
    """``gap_fill`` with one row per station-day: number, date, ``stands`` at every level, and the levels' ``times``.

    Days with a level that has no value anywhere are left out.
    """
    return _filled(slots, scope).select(
        "number", F.col("day").cast("string").alias("date"), F.col("stands").cast("array<double>").alias("stands"),
        F.transform("levels", clock.slot_label).alias("times"), "whole",
    ).where("whole").drop("whole")


def slot_matrix(slots: DataFrame) -> DataFrame:
    """Long to wide: one column per 10-minute slot of the day."""
    days = _cells(slots).groupBy("number", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("slot_no", "v"))).alias("cells")
    )
    return days.select("number", F.col("day").cast("string").alias("date"), *[
        F.element_at("cells", F.lit(i)).alias(t) for i, t in enumerate(SLOT_LEVELS)
    ])


def melt_matrix(matrix: DataFrame) -> DataFrame:
    """Wide to long; NULL cells are kept."""
    return matrix.unpivot(["number", "date"], SLOT_LEVELS, "time", "available_stands")


def day_vectors(filled: DataFrame) -> DataFrame:
    """One array of stands per station-day, in time order; days with a gap are left out."""
    entries = F.collect_list(F.struct(clock.slot_number(F.col("time")).alias("slot_no"), "available_stands"))
    days = filled.groupBy("number", "date").agg(F.sort_array(entries).alias("entries"))
    complete = days.where(~F.exists("entries", lambda e: e["available_stands"].isNull()))
    return complete.select("number", "date", F.col("entries.available_stands").cast("array<double>").alias("stands"))


def wss_one_cluster(filled: DataFrame) -> DataFrame:
    """Sum of squares around the overall mean: (rows - 1) times the summed variances."""
    per_level = filled.groupBy("time").agg(
        F.count("available_stands").alias("n"), F.var_samp("available_stands").alias("variance")
    )
    return per_level.agg(F.max("n").alias("n"), ((F.max("n") - 1) * F.sum("variance")).alias("wss"))


def station_profile(slots: DataFrame) -> DataFrame:
    """Mean stands per station and time of day."""
    return slots.groupBy("number", "name", "time").agg(F.avg("available_stands").alias("stands"))


def profile_sums(profile: DataFrame) -> DataFrame:
    return profile.groupBy("number").agg(F.sum("stands").alias("station_sum"))


def assign_cluster(sums: DataFrame, centers: DataFrame) -> DataFrame:
    """Nearest center by profile sum; the lower cluster number wins a tie.

    The centers (one per cluster) are a single array, so there is no join.
    """
    all_centers = centers.agg(F.collect_list(F.struct("cluster", "sum_of_stands"))).scalar()
    nearest = F.array_min(F.transform("centers", lambda c: F.struct(
        F.abs(c["sum_of_stands"] - F.col("station_sum")).alias("gap"), c["cluster"].alias("cluster")
    )))
    return sums.withColumn("centers", all_centers).withColumn("nearest", nearest).select(
        "number", "station_sum", F.col("nearest.cluster").alias("cluster"), F.col("nearest.gap").alias("gap")
    )


def label_profile(profile: DataFrame, centers: DataFrame) -> DataFrame:
    """The profile table with the cluster of each station."""
    labels = assign_cluster(profile_sums(profile), centers).select("number", "cluster")
    return profile.join(labels, "number", "left")
