"""Landing and deduplicating the stream of track events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from discolake.functions.scalars import truthy
from discolake.operators.dedup import keep_first
from discolake.operators.generators import expand_json
from discolake.schemas import EVENT

EVENT_TIME = "event_ts"
ARRIVAL = "arrived"
#: What makes two events the same one.
KEYS = ("id", "timestamp")
#: How far a sender's clock may be ahead of ours.
SKEW = "1 hour"


def decode(messages: DataFrame, schema: str = EVENT, keep: Sequence[str] = ()) -> DataFrame:
    """JSON messages to events; an event without an id is dropped.

    There is no state here, so nothing is dropped for being late.
    ``rejected`` gives the messages that are dropped.  ``keep`` names columns of the
    messages that the events keep, such as ``arrived``.
    """
    return expand_json(messages, "value", schema, list(keep)).where(truthy(F.col("id")))


def rejected(messages: DataFrame, schema: str = EVENT) -> DataFrame:
    """The texts of the messages that ``decode`` drops: malformed, or without an id."""
    text = F.col("value").cast("string").alias("value")
    parsed = expand_json(messages.select(text), "value", schema, ["value"])
    return parsed.where(~truthy(F.col("id"))).select("value")


def with_arrival(events: DataFrame, clock: Column | None = None) -> DataFrame:
    """The events with the time at which each arrived, in the column ``arrived``.

    The clock is not the sender's: the change time of the file that was landed, or the
    ``timestamp`` column of a Kafka source.
    """
    return events.withColumn(ARRIVAL, F.col("_metadata.file_modification_time") if clock is None else clock)


def _moment() -> Column:
    return F.col("timestamp").try_cast("timestamp")


def _is_ahead(events: DataFrame, skew: str) -> Column:
    """True where the event claims to be from later than it arrived, by more than the skew."""
    if ARRIVAL not in events.columns:
        return F.lit(False)
    return F.coalesce(_moment() > F.col(ARRIVAL) + F.expr(f"INTERVAL {skew}"), F.lit(False))


def timed(events: DataFrame, skew: str = SKEW) -> DataFrame:
    """The events whose time can be read and believed; it is the column ``event_ts``.

    A time is not believed if it lies more than ``skew`` after ``arrived``, where
    there is that column.
    """
    good = events.withColumn(EVENT_TIME, _moment()).where(F.col(EVENT_TIME).isNotNull())
    return good.where(~_is_ahead(events, skew)).drop(ARRIVAL)


def untimed(events: DataFrame) -> DataFrame:
    """The events whose time is missing or cannot be read.

    They must not reach a watermark, as any time made up for them would move
    it and drop good events.  They are landed in a table of their own and
    deduplicated in batch, with ``keep_first``.
    """
    return events.where(_moment().isNull())


def set_aside(events: DataFrame, skew: str = SKEW) -> DataFrame:
    """All events that ``timed`` leaves out, with the ``reason``: ``unreadable`` or ``ahead``.

    One event with a time far ahead would move the watermark past all others.
    """
    reason = F.when(_moment().isNull(), "unreadable").when(_is_ahead(events, skew), "ahead")
    return events.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop(ARRIVAL)


def rebuild(events: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Batch deduplication of landed events: one per key, whatever its time.

    Of events with one key that differ elsewhere the first in the order of their other columns stays.
    """
    order = [name for name in events.columns if name not in keys]
    return keep_first(events, list(keys), order or list(keys))


def lost_events(landed: DataFrame, kept: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The events with a good time that were landed and that the stream did not keep, one per key.

    This is the account of what came too late; unlike the progress of a query it is not
    forgotten, and the rows are there.  Keys that are null on both sides are the same.
    """
    found = rebuild(timed(landed).drop(EVENT_TIME), keys)
    known = kept.select(*[F.col(name).alias(f"_kept_{name}") for name in keys])
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_kept_{name}")) for name in keys])
    return found.join(known, same, "left_anti")


def deduplicate(
    events: DataFrame,
    delay: str = "1 day",
    keys: Sequence[str] = KEYS,
    slices: int = 1,
    skew: str = SKEW,
) -> DataFrame:
    """Keep one event per key, remembering keys for ``delay`` of event time.

    Takes the events with a time that can be read and, with the column ``arrived``,
    believed; see ``set_aside`` for the others.  Events older than the watermark are dropped,
    so ``delay`` must cover the expected lateness; ``follow`` counts them per batch, and
    ``lost_events`` gives them.  With
    ``slices`` above 1 copies are removed within input slices first: an event
    sent very many times is then spread over so many tasks and reaches the
    exact step in few copies, at the price of a second state of up to
    ``slices`` entries per key.
    """
    marked = timed(events, skew).withWatermark(EVENT_TIME, delay)
    if slices > 1:
        sliced = marked.withColumn("_slice", F.spark_partition_id() % slices)
        marked = sliced.dropDuplicatesWithinWatermark([*keys, "_slice"]).drop("_slice")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def append_to(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream to a Parquet table; by default up to the data's end."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def land(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Messages to bronze events."""
    return append_to(decode(messages), path, checkpoint, **trigger)


def _dropped(progress) -> int:
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over the progress Spark has kept: its last 100 batches."""
    return sum(_dropped(progress) for progress in query.recentProgress)


def follow(query: StreamingQuery, every: float = 2.0) -> dict[int, int]:
    """Wait for the end of a query; the rows it dropped behind its watermark, by batch.

    The progress is read again and again, so no batch is forgotten as long as fewer than
    Spark keeps end in between; a gap in the batches raises.
    """
    dropped: dict[int, int] = {}
    while True:
        ended = query.awaitTermination(every)
        dropped.update((progress.batchId, _dropped(progress)) for progress in query.recentProgress)
        if ended:
            break
    if dropped and len(dropped) <= max(dropped) - min(dropped):
        raise RuntimeError("batches ended faster than their progress was read; read it more often")
    return dropped
