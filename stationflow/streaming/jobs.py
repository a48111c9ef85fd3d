"""The observation feed and the forecast log as streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stationflow import schemas
from stationflow.functions import clock
from stationflow.operators.clean import DEDUP_KEY, latest_state
from stationflow.operators.pairing import LEAD_MS

WATERMARK = "10 minutes"
DELTA_SCHEMA = (
    "number BIGINT, name STRING, address STRING, bike_stands BIGINT, available_bike_stands BIGINT,"
    " last_update BIGINT, last_available_stands BIGINT, diff BIGINT, check_in BIGINT, check_out BIGINT"
)
DELTA_COLUMNS = [c.split()[0] for c in DELTA_SCHEMA.split(", ")]
PAIR_SCHEMA = (
    "event_id BIGINT, number BIGINT, pred_ms BIGINT, pred_stands BIGINT,"
    " actual_event BIGINT, actual_ms BIGINT, actual_stands BIGINT"
)
PAIR_COLUMNS = [c.split()[0] for c in PAIR_SCHEMA.split(", ")]


def snapshot_stream(spark: SparkSession, path: str, max_files: int = 1000, multi_line: bool = True) -> DataFrame:
    """Landed snapshot files as a stream. ``max_files`` bounds a micro-batch."""
    return (
        spark.readStream.schema(schemas.SNAPSHOT).option("multiLine", multi_line)
        .option("maxFilesPerTrigger", max_files).json(path).select(*schemas.OBSERVATION_COLUMNS)
    )


def timed(observations: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Complete observations with an event time and a watermark."""
    return observations.dropna("any").withColumn(
        "event_time", F.timestamp_millis("last_update")
    ).withWatermark("event_time", delay)


def dedup_stream(observations: DataFrame) -> DataFrame:
    """First arrival per observation key; keys are forgotten once the watermark passes them."""
    return observations.dropDuplicatesWithinWatermark(DEDUP_KEY)


def slot_stream(observations: DataFrame) -> DataFrame:
    """Closed 10-minute slots per station: capacity, last stands and row count."""
    slot = F.window("event_time", "10 minutes")
    last = F.struct("last_update", "available_bike_stands")
    return observations.groupBy("number", "name", "address", slot.alias("slot")).agg(
        F.min("bike_stands").alias("bike_stands"), F.max(last).alias("last"), F.count(F.lit(1)).alias("row_count")
    ).select(
        "number", "name", "address", F.unix_millis("slot.start").alias("slot_ms"), "bike_stands",
        F.col("last.available_bike_stands").alias("available_stands"), "row_count",
    )


# Stateful steps work in this many groups, each of many chains: a call for a group costs milliseconds whatever its rows,
# and there are as many chains as stations, or as slots with rows. Part of every checkpoint: it must not change.
GROUPS = 1024


def _grouped(rows: DataFrame, *key: str) -> GroupedData:
    """Chains in groups by a hash of their key; chains without a number have groups of their own, below 0."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(GROUPS))
    return rows.withColumn("group", F.when(F.col("number").isNull(), -1 - bucket).otherwise(bucket)).groupBy("group")


def _gathered(columns: list[str], kept: tuple, batches: Iterator[pd.DataFrame], texts: tuple = ()) -> list[np.ndarray]:
    """What the state holds of each column, and the new rows behind it."""
    new = list(batches)
    return [
        np.concatenate([np.asarray(old, object if c in texts else np.int64), *(
            b[c].to_numpy(object if c in texts else np.int64) for b in new)]) for c, old in zip(columns, kept)
    ]


def _chains(*key: np.ndarray) -> np.ndarray:
    """A number for each different key, missing parts being equal."""
    return pd.DataFrame(dict(enumerate(key))).groupby(list(range(len(key))), dropna=False, sort=False).ngroup().to_numpy()


def _begins(*sorted_key: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before in any of these."""
    new = np.ones(len(sorted_key[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in sorted_key], axis=0)
    return new


def _numbers(group: tuple, number: np.ndarray) -> np.ndarray | None:
    """Station numbers as they came: a group below 0 has none."""
    return None if group[0] < 0 else number


def _wake(state: GroupState, times: np.ndarray) -> None:
    """Calls the group again once the watermark is beyond the earliest of these times, also if nothing arrives for it."""
    if len(times):
        state.setTimeoutTimestamp(max(int(times.min()), state.getCurrentWatermarkMs(), 1))


CHAIN_STATE = (
    "number ARRAY<BIGINT>, name ARRAY<STRING>, address ARRAY<STRING>, ms ARRAY<BIGINT>, free ARRAY<BIGINT>,"
    " capacity ARRAY<BIGINT>, done ARRAY<BIGINT>"
)
CHAIN_COLUMNS = ["number", "name", "address", "last_update", "available_bike_stands", "bike_stands", "done"]


def _deltas(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, by_slot: bool) -> Iterator[pd.DataFrame]:
    """Deltas of a group's chains. The state keeps the rows that wait, and the last of each chain's that do not, marked as done."""
    held = state.get if state.exists else ([],) * len(CHAIN_COLUMNS)
    columns = _gathered(CHAIN_COLUMNS, held, (b.assign(done=0) for b in batches), ("name", "address"))
    number, name, address, ms, free, capacity, done = columns
    slot = ms - ms % clock.SLOT_MS
    chain = _chains(number, name, address, *([slot] if by_slot else []))
    order = np.lexsort((free, ms, -done, chain))
    number, name, address, ms, free, capacity, done = columns = [c[order] for c in columns]
    chain, slot, watermark = chain[order], slot[order], state.getCurrentWatermarkMs()
    begins = _begins(chain)
    known = (done == 1) | (ms < watermark)  # nothing before the watermark can still arrive
    ready = known & (done == 0)
    last = np.append(known[:-1] & (begins[1:] | ~known[1:]), known[-1:])
    if ready.any():
        before = np.where(begins, free, np.append(free[:1], free[:-1]))
        diff = (free - before)[ready]
        found = pd.DataFrame(dict(zip(DELTA_COLUMNS, (
            _numbers(key, number[ready]), name[ready], address[ready], capacity[ready], free[ready], ms[ready], before[ready],
            diff, diff.clip(min=0), (-diff).clip(min=0)))))
        yield found.assign(slot_ms=slot[ready], opens=begins[ready], closes=last[ready]) if by_slot else found
    over = slot + clock.SLOT_MS <= watermark  # no row of the slot can still arrive
    keep = ~known | (last & ~(by_slot & over))
    if not keep.any():
        state.remove()
        return
    done = known.astype(np.int64)
    state.update(tuple(c[keep].tolist() for c in (*columns[:-1], done)))
    _wake(state, np.concatenate([ms[~known], slot[keep & known] + clock.SLOT_MS] if by_slot else [ms[~known]]))


def _chain_deltas(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    return _deltas(key, batches, state, by_slot=False)


def delta_stream(observations: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Deltas against the chain's previous observation in event time.

    Rows wait in the state until the watermark has passed them and are then
    taken in order, whichever micro-batch brought them. Rows that arrive at or
    behind the watermark are dropped and counted in the query's progress.
    Beside waiting rows the state of a chain is its last row.
    """
    rows = observations.select(*schemas.OBSERVATION_COLUMNS, F.timestamp_millis("last_update").alias("event_time"))
    return _grouped(rows.withWatermark("event_time", delay), "number", "name", "address").applyInPandasWithState(
        _chain_deltas, DELTA_SCHEMA, CHAIN_STATE, "append", GroupStateTimeout.EventTimeTimeout)


PART_SCHEMA = f"{DELTA_SCHEMA}, slot_ms BIGINT, opens BOOLEAN, closes BOOLEAN"


def _slot_deltas(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """``_chain_deltas`` inside slots: a slot's very first row has nothing before it, which ``carry_stream`` fills in."""
    return _deltas(key, batches, state, by_slot=True)


def slot_delta_stream(observations: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """``delta_stream`` in parts: a chain's 10-minute slots are spread over the groups, so a station that holds a third of all rows is in many.

    A row that ``opens`` its slot still lacks what the slots before end with; rows
    that open or close a slot, or what was known of it, are all that
    ``carry_stream`` needs.
    """
    rows = observations.select(*schemas.OBSERVATION_COLUMNS, F.timestamp_millis("last_update").alias("event_time"))
    slot = clock.slot_start(F.col("last_update")).alias("slot_ms")
    return _grouped(rows.withWatermark("event_time", delay).select("*", slot), "number", "name", "address", "slot_ms").applyInPandasWithState(
        _slot_deltas, PART_SCHEMA, CHAIN_STATE, "append", GroupStateTimeout.EventTimeTimeout)


CARRY_COLUMNS = ["number", "name", "address", "available_bike_stands", "slot_ms", "last_update", "bike_stands", "opens", "done"]


def _carry(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    kept = state.get if state.exists else ([],) * 4
    known = (*kept, *([[0] * len(kept[0])] * 4), [1] * len(kept[0]))
    columns = _gathered(CARRY_COLUMNS, known, (b.assign(done=0) for b in batches), ("name", "address"))
    number, name, address, free, slot, ms, _, _, done = columns
    chain = _chains(number, name, address)
    order = np.lexsort((free, ms, slot, -done, chain))
    number, name, address, free, slot, ms, capacity, opens, done = (c[order] for c in columns)
    begins = _begins(chain[order])
    before = np.where(begins, free, np.append(free[:1], free[:-1]))
    last = np.append(begins[1:], True)
    state.update(tuple(c[last].tolist() for c in (number, name, address, free)))
    found = (opens == 1) & (done == 0)
    if found.any():
        diff = (free - before)[found]
        yield pd.DataFrame(dict(zip(DELTA_COLUMNS, (
            _numbers(key, number[found]), name[found], address[found], capacity[found], free[found], ms[found], before[found],
            diff, diff.clip(min=0), (-diff).clip(min=0)))))


def carry_stream(parts: DataFrame) -> DataFrame:
    """The rows that open a slot, with the value that the chain's slots before end with; its state is one number a chain.

    ``parts`` is the table of ``slot_delta_stream`` as a stream, of which a slot gives a row or two whatever its rows.
    """
    ends = parts.where("opens or closes")
    return _grouped(ends, "number", "name", "address").applyInPandasWithState(
        _carry, DELTA_SCHEMA, "number ARRAY<BIGINT>, name ARRAY<STRING>, address ARRAY<STRING>, free ARRAY<BIGINT>",
        "append", GroupStateTimeout.NoTimeout)


def deltas_by_slot(observations: DataFrame, path: str, delay: str = WATERMARK) -> DataFrame:
    """All deltas of what has landed, as ``delta_stream`` gives them: the parts, and what the second stream makes of their ends."""
    parts = run_available(slot_delta_stream(observations, delay), f"{path}/parts", f"{path}/parts-checkpoint")
    ends = observations.sparkSession.readStream.schema(parts.schema).parquet(f"{path}/parts")
    opened = run_available(carry_stream(ends), f"{path}/opened", f"{path}/opened-checkpoint")
    return parts.where("not opens").select(*DELTA_COLUMNS).union(opened.select(*DELTA_COLUMNS))


PAIR_STATE = "number ARRAY<BIGINT>, due ARRAY<BIGINT>, event ARRAY<BIGINT>, stands ARRAY<BIGINT>, actual ARRAY<BIGINT>"
DUE_COLUMNS = ["number", "due_ms", "event_id", "stands", "is_actual"]


def _in_due_order(batches: Iterator[pd.DataFrame], state: GroupState, by_slot: bool) -> tuple[np.ndarray, ...]:
    """(chain, instant, number, due, event, stands, actual) of a group: chain by chain and by time; equal instants of a chain have one number."""
    columns = _gathered(DUE_COLUMNS, state.get if state.exists else ([],) * len(DUE_COLUMNS), batches)
    number, due, event = columns[:3]
    chain = _chains(number, *([due - due % clock.SLOT_MS] if by_slot else []))
    order = np.lexsort((event, due, chain))
    chain, number, due, event, stands, actual = (c[order] for c in (chain, *columns))
    return chain, np.cumsum(_begins(chain, due)), number, due, event, stands, actual


def _answers(chain: np.ndarray, instant: np.ndarray, asked: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the ``asked`` rows have a ``final`` one of their chain at their instant or later, and where the first such row is."""
    place = np.flatnonzero(final)
    at = np.searchsorted(instant[place], instant, "left")
    to = np.append(place, -1)[at]
    answered = asked & (to >= 0) & (chain[to] == chain)
    return answered, to[answered]


def _pair(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    chain, instant, *columns = _in_due_order(batches, state, by_slot=False)
    number, due, event, stands, actual = columns
    final = (actual == 1) & (due < state.getCurrentWatermarkMs())  # all forecasts they can answer are here
    answered, to = _answers(chain, instant, actual == 0, final)
    if answered.any():
        yield pd.DataFrame(dict(zip(PAIR_COLUMNS, (
            event[answered], _numbers(key, number[answered]), due[answered] - LEAD_MS, stands[answered], event[to], due[to], stands[to]))))
    rest = ~final & ~answered
    if not rest.any():
        state.remove()
        return
    state.update(tuple(c[rest].tolist() for c in columns))
    _wake(state, due[rest & (actual == 1)])


def _asked_and_seen(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Forecasts by the time they are due and observations by theirs, one under the other."""
    asked = predictions.select(
        "number", "event_id", (F.col("pred_ms") + LEAD_MS).alias("due_ms"),
        F.col("pred_stands").alias("stands"), F.lit(0).alias("is_actual"), F.timestamp_millis("pred_ms").alias("event_time"),
    )
    seen = actuals.select(
        "number", "event_id", F.col("actual_ms").alias("due_ms"),
        F.col("actual_stands").alias("stands"), F.lit(1).alias("is_actual"), F.timestamp_millis("actual_ms").alias("event_time"),
    )
    return asked.union(seen)


def pair_stream(predictions: DataFrame, actuals: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Forecasts paired with the first observation at least 15 minutes later.

    Both sides wait in the state. When the watermark has passed an observation,
    no earlier one and no forecast that it answers can still arrive: it is paired
    and forgotten. A forecast waits as long as its station is silent, and gives
    no row before it is answered.
    """
    rows = _asked_and_seen(predictions, actuals)
    return _grouped(rows.withWatermark("event_time", delay), "number").applyInPandasWithState(
        _pair, PAIR_SCHEMA, PAIR_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything that has landed, append it to a Parquet table and read that."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


SLOT_PAIR_SCHEMA = f"{PAIR_SCHEMA}, slot_ms BIGINT, kind STRING"


def _pair_part(kind: str, key: tuple, number: np.ndarray, slot: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """Rows of SLOT_PAIR_SCHEMA; columns that a kind does not have are 0."""
    none = np.zeros(len(slot), np.int64)
    return pd.DataFrame({c: columns.get(c, none) for c in PAIR_COLUMNS} | {"number": _numbers(key, number), "slot_ms": slot, "kind": kind})


def _slot_pairs(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """``_pair`` inside slots: a slot's pairs, its first observation, and when it is over the forecasts that it does not answer.

    A first observation that has been given stays in the state as an ``actual`` of 2 until its slot is over.
    """
    chain, instant, *columns = _in_due_order(batches, state, by_slot=True)
    number, due, event, stands, actual = columns
    slot, watermark = due - due % clock.SLOT_MS, state.getCurrentWatermarkMs()
    final = (actual == 1) & (due < watermark)
    answered, to = _answers(chain, instant, actual == 0, final)
    if answered.any():
        yield _pair_part(
            "pair", key, number[answered], slot[answered], event_id=event[answered], pred_ms=due[answered] - LEAD_MS,
            pred_stands=stands[answered], actual_event=event[to], actual_ms=due[to], actual_stands=stands[to])
    place = np.flatnonzero(final)
    first = place[_begins(chain[place]) & ~np.isin(chain[place], chain[actual == 2])]
    if len(first):
        yield _pair_part(
            "first", key, number[first], slot[first], actual_event=event[first], actual_ms=due[first], actual_stands=stands[first])
    actual[first] = 2
    over = slot + clock.SLOT_MS <= watermark
    rest = ~answered & ~(final & (actual == 1))
    unanswered = rest & over & (actual == 0)
    if unanswered.any():
        yield _pair_part(
            "open", key, number[unanswered], slot[unanswered], event_id=event[unanswered], pred_ms=due[unanswered] - LEAD_MS,
            pred_stands=stands[unanswered])
    rest &= ~over
    if not rest.any():
        state.remove()
        return
    state.update(tuple(c[rest].tolist() for c in columns))
    _wake(state, np.concatenate([due[rest & (actual == 1)], slot[rest] + clock.SLOT_MS]))


def slot_pair_stream(predictions: DataFrame, actuals: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """``pair_stream`` in parts: a station's 10-minute slots are spread over the groups, so a station that holds a third of all rows is in many."""
    rows = _asked_and_seen(predictions, actuals).withColumn("slot_ms", clock.slot_start(F.col("due_ms")))
    return _grouped(rows.withWatermark("event_time", delay), "number", "slot_ms").applyInPandasWithState(
        _slot_pairs, SLOT_PAIR_SCHEMA, PAIR_STATE, "append", GroupStateTimeout.EventTimeTimeout)


END_COLUMNS = ["number", "slot_ms", "event_id", "pred_ms", "pred_stands", "actual_event", "actual_ms", "actual_stands", "is_first"]


def _answer_open(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    kept = state.get if state.exists else ([],) * 5
    waiting = (*kept, *([[0] * len(kept[0])] * 4))
    columns = _gathered(END_COLUMNS, waiting, (b.assign(is_first=b["kind"] == "first") for b in batches))
    chain = _chains(columns[0])
    order = np.lexsort((columns[1], chain))
    number, slot, event, asked, stands, actual_event, actual_ms, actual_stands, is_first = columns = [c[order] for c in columns]
    chain, first = chain[order], is_first == 1
    place, instant = np.flatnonzero(first), np.cumsum(_begins(chain, slot))
    to = np.append(place, -1)[np.searchsorted(instant[place], instant, "right")]
    answered = ~first & (to >= 0) & (chain[to] == chain)
    if answered.any():
        to = to[answered]
        yield pd.DataFrame(dict(zip(PAIR_COLUMNS, (
            event[answered], _numbers(key, number[answered]), asked[answered], stands[answered],
            actual_event[to], actual_ms[to], actual_stands[to]))))
    state.update(tuple(c[~first & ~answered].tolist() for c in columns[:5]))


def answer_stream(parts: DataFrame) -> DataFrame:
    """Forecasts that their own slot does not answer, paired with the first observation of the first later slot that has one.

    When that observation is final, all slots before are over, so their open
    forecasts have come. A busy station answers nearly all inside their slots.
    """
    return _grouped(parts.where("kind <> 'pair'"), "number").applyInPandasWithState(
        _answer_open, PAIR_SCHEMA, "number ARRAY<BIGINT>, slot ARRAY<BIGINT>, event ARRAY<BIGINT>, asked ARRAY<BIGINT>, stands ARRAY<BIGINT>",
        "append", GroupStateTimeout.NoTimeout)


def pairs_by_slot(predictions: DataFrame, actuals: DataFrame, path: str, delay: str = WATERMARK) -> DataFrame:
    """All pairs of what has landed, as ``pair_stream`` gives them: those inside slots, and what the second stream finds beyond."""
    parts = run_available(slot_pair_stream(predictions, actuals, delay), f"{path}/parts", f"{path}/parts-checkpoint")
    ends = predictions.sparkSession.readStream.schema(parts.schema).parquet(f"{path}/parts")
    later = run_available(answer_stream(ends), f"{path}/later", f"{path}/later-checkpoint")
    return parts.where("kind = 'pair'").select(*PAIR_COLUMNS).union(later.select(*PAIR_COLUMNS))


def pair_within(predictions: DataFrame, actuals: DataFrame, most: str = "1 HOUR", delay: str = WATERMARK) -> DataFrame:
    """Forecasts paired with the first observation 15 minutes to 15 minutes and ``most`` later, by a native interval join.

    Both sides are watermarked, so a row waits in the state only as long as a
    partner can still come: an unanswered forecast is let go once ``most`` has
    passed, and comes out with NULLs. The join meets every observation of the
    interval, of which the first stands, so it is meant for short intervals;
    ``pair_stream`` has no limit.
    """
    asked = predictions.select(
        "number", "event_id", "pred_ms", "pred_stands", F.timestamp_millis(F.col("pred_ms") + LEAD_MS).alias("due"),
    ).withWatermark("due", delay)
    seen = actuals.select(
        F.col("number").alias("station"), F.col("event_id").alias("actual_event"), "actual_ms", "actual_stands",
        F.timestamp_millis("actual_ms").alias("seen"),
    ).withWatermark("seen", delay)
    near = (F.col("number") == F.col("station")) & F.col("seen").between(F.col("due"), F.col("due") + F.expr(f"INTERVAL {most}"))
    first = F.min(F.when(F.col("actual_ms").isNotNull(), F.struct("actual_ms", "actual_event", "actual_stands"))).alias("first")
    pairs = asked.join(seen, near, "left_outer").groupBy(F.window("due", "10 minutes"), "event_id", "number", "pred_ms", "pred_stands").agg(first)
    return pairs.select(
        "event_id", "number", "pred_ms", "pred_stands", F.col("first.actual_event").alias("actual_event"),
        F.col("first.actual_ms").alias("actual_ms"), F.col("first.actual_stands").alias("actual_stands"))


def keep_latest(observations: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Brings the latest state of every station at ``path`` up to date with what has landed, and reads it.

    Each micro-batch writes a whole table of its own, ``batch=<id>``, from the one
    before and its rows; stations are few, however many rows arrive. A batch that
    is run again starts from the same table and overwrites its own, so a replay
    changes nothing.
    """
    spark = observations.sparkSession
    schema = spark.createDataFrame([], schemas.OBSERVATION).schema

    def upsert(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        complete = rows.select(*schemas.OBSERVATION_COLUMNS).dropna("any")
        before = _latest_table(session, path, batch - 1)
        known = complete if before is None else complete.unionByName(session.read.schema(schema).parquet(before))
        latest_state(known).select(*schemas.OBSERVATION_COLUMNS).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = observations.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    last = _latest_table(spark, path, None)
    return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(last)


def _latest_table(spark: SparkSession, path: str, upto: int | None) -> str | None:
    """The newest table below ``path`` that a batch has finished, of those up to number ``upto``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return None
    found = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("batch=")]
    done = {int(p.getName()[6:]): p for p in found if system.exists(hadoop.Path(p, "_SUCCESS"))}
    fitting = [n for n in done if upto is None or n <= upto]
    return done[max(fitting)].toString() if fitting else None
