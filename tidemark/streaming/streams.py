"""The hourly operators as Structured Streaming queries.

Stateless steps (projection, alerts) run as they are. Dedupe and rollups keep one state row per
open window and key; their updates go to a table through the same keyed replacement as in batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.alerts import AlertRule, threshold_alerts
from tidemark.operators.dedupe import Ranking
from tidemark.operators.incremental import Table, delete_insert, high_water_mark, lookback_bound
from tidemark.operators.late import Ledger, split_late

#: Partitions of a stream's state for each core of the session, at most.
STATES = 4
PARTITIONS = "spark.sql.shuffle.partitions"
#: State on the executors' disks, beside a cache and write buffers of so many MB for all states of an executor. The
#: default keeps every row of it in their heap, for a whole arrival at once.
_STORE = "spark.sql.streaming.stateStore"
STATE_MB = 384
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": str(STATE_MB),
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "true",
}
#: Partition column of tables that micro-batches append to.
MICRO_BATCH = "micro_batch"


def rank_of(columns: Sequence[str], ranking: Ranking) -> Column:
    """The ranking of the batch dedupe as one comparable value, for columns that are never NULL."""
    return F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(ranking.order)],
        *[F.col(c).alias(f"t{i}") for i, c in enumerate(ranking.tie_break)],
        F.xxhash64(*columns).alias("h"),
    )


def hourly_dedupe(stream: DataFrame, by: Sequence[str], at: str, ranking: Ranking, lateness: str = "6 hours") -> DataFrame:
    """Latest row per clock hour and key, updated as rows arrive.

    The winner is the greatest of (order columns, tie-breaks, row hash). Watermarks need a zoned
    timestamp, hence ``_at``.
    """
    columns = stream.columns
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", lateness)
    best = timed.groupBy(F.window("_at", "1 hour"), *[F.col(c).alias(f"_k_{c}") for c in by]).agg(
        F.max_by(F.struct(*columns), rank_of(columns, ranking)).alias("_best")
    )
    return best.select("_best.*")


def drop_repeats(stream: DataFrame, keys: Sequence[str], at: str, lateness: str = "6 hours") -> DataFrame:
    """The first row of every key; repeats that follow within ``lateness`` of its event time are dropped.

    State holds one row per key until the watermark has passed its time by ``lateness``, so it is bounded by
    the keys of that period however long the stream runs. A key that returns later counts as new.
    """
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", lateness)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def tumbling_rollup(
    stream: DataFrame, by: Sequence[str], at: str, every: str, measures: Sequence[Column], lateness: str = "6 hours"
) -> DataFrame:
    """Aggregates per key and tumbling window of event time."""
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", lateness)
    rolled = timed.groupBy(F.window("_at", every).alias("_w"), *by).agg(*measures)
    start = F.col("_w.start").cast("timestamp_ntz").alias("window_start")
    return rolled.select(*by, start, *[c for c in rolled.columns if c not in ("_w", *by)])


def alerts(stream: DataFrame, rules: Sequence[AlertRule], keep: Sequence[str]) -> DataFrame:
    """Threshold alerts on arrival; no state and no watermark."""
    return threshold_alerts(stream, rules, keep)


def keyed_replace(
    root: str, table: Table, build: Callable[[DataFrame], DataFrame] | None = None, unique: bool = False
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: each micro-batch replaces its keys in a partitioned table.

    ``unique`` promises that a micro-batch, once built, holds a key once.
    Replaying a batch after a failure writes the same rows again, so the sink is idempotent.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = build(batch) if build else batch
        session = batch.sparkSession
        mark = None if table.aligned else high_water_mark(session, root, table)
        delete_insert(session, root, table, rows, mark=mark, unique=unique)

    return write


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that appends: a replayed micro-batch overwrites what its first run wrote."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{MICRO_BATCH}={number}")

    return write


def split_by_lookback(
    root: str, table: Table, build: Callable[[DataFrame], DataFrame], cursor: str, unique: bool = False
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: rows behind the table's lookback go to its ledger, the others replace their keys.

    A replayed micro-batch is split by the bound that its first run recorded, although the mark may have moved since.
    """
    ledger = Ledger(root, table.name)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        mark = high_water_mark(session, root, table)
        known, bound = ledger.recorded_bound(session, number)
        if not known:
            bound = lookback_bound(mark, table.lookback)
            ledger.record(batch, number, cursor, bound, table.inclusive)
        timely, _ = split_late(batch, cursor, bound, table.inclusive)
        delete_insert(session, root, table, build(timely), mark=None if table.aligned else mark, unique=unique)

    return write


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str = "update", on_disk: bool = False
) -> StreamingQuery:
    """Process everything that has arrived, then stop; the checkpoint lets the next run continue.

    Every partition of the state writes its own files in every micro-batch, rows or none, so a new checkpoint starts
    with no more of them than ``STATES`` for each core. A checkpoint keeps the number and the kind of store it began with.
    State that outgrows the executors' memory lies ``on_disk``; a row of it takes longer there.
    """
    spark = stream.sparkSession
    few = min(int(spark.conf.get(PARTITIONS)), STATES * spark.sparkContext.defaultParallelism)
    settings = {PARTITIONS: str(few), **(STATE if on_disk else {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        query = (
            stream.writeStream.outputMode(output_mode)
            .foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return query
