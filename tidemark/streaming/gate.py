"""The data contract on streams: every micro-batch is judged before a sink sees it.

The micro-batch is staged once; the job that writes it measures all checks (a named observation), so judging
costs no further scan. A batch with a blocking check goes to the quarantine of its stream and the target stays
as it is; any other batch goes on to the sink. Either way its audit lines are appended to the log of the batch gate.

A replayed micro-batch is judged again from the same rows: quarantine folders and staged rows are overwritten by number,
and lines whose run is in the log already are not appended again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import contract
from tidemark.operators.contract import Rule
from tidemark.sources import paths
from tidemark.sources.mappings import Mapping
from tidemark.streaming.streams import MICRO_BATCH

Sink = Callable[[DataFrame, int], None]


def quarantine_path(root: str, stream: str, number: int | None = None) -> str:
    whole = f"{root}/_quarantine/{stream}"
    return whole if number is None else f"{whole}/{MICRO_BATCH}={number}"


def _staged_path(root: str, stream: str, number: int) -> str:
    return f"{root}/_gate/{stream}/{MICRO_BATCH}={number}"


def run_name(stream: str, number: int) -> str:
    """The pipeline run id of a micro-batch in the audit log."""
    return f"{stream}-{number}"


def _is_logged(spark: SparkSession, root: str, run_id: str) -> bool:
    path = contract.audit_path(root)
    if not paths.has_data(spark, path):
        return False
    return not spark.read.parquet(path).filter(F.col("pipeline_run_id") == run_id).isEmpty()


def _measure(batch: DataFrame, path: str, checks: Sequence[contract.Check], name: str) -> dict:
    """Write the batch; the same job measures its checks."""
    seen = Observation(name)
    newest = F.max(F.col("extracted_at").cast("timestamp_ntz")).alias("_newest")
    batch.observe(seen, *contract.measures(checks), newest).write.mode("overwrite").parquet(path)
    return seen.get


def gated(
    root: str,
    stream: str,
    fields: Sequence[Mapping],
    rules: Sequence[Rule],
    sink: Sink,
    as_of: Callable[[datetime], datetime] = lambda newest: newest,
) -> Sink:
    """A ``foreachBatch`` function that lets a landing micro-batch through to ``sink`` or quarantines it.

    ``as_of`` gives the time of the run from the newest extract of the batch; by default it is that time.
    """

    def judge(batch: DataFrame, number: int) -> None:
        spark, path, run_id = batch.sparkSession, _staged_path(root, stream, number), run_name(stream, number)
        if batch.isEmpty():
            return
        checks = contract.batch_checks(batch, stream, fields, rules)
        try:
            found = _measure(batch, path, checks, run_id)
            rows = spark.read.schema(batch.schema).parquet(path)
            at = as_of(found["_newest"])
            numbers = {k: v for k, v in found.items() if k != "_newest"}
            measured = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in numbers.items()])
            lines = contract.audit_lines(measured, stream, found["_newest"], at, checks, certify=True).collect()
            lines = [r.asDict() for r in lines]
        except contract.DATA_ERRORS:  # a check fails on the data, so each is tried on its own
            batch.write.mode("overwrite").parquet(path)
            rows = spark.read.schema(batch.schema).parquet(path)
            newest = rows.agg(F.max(F.col("extracted_at").cast("timestamp_ntz")).alias("m")).first()["m"]
            at = as_of(newest)
            lines = contract.one_by_one(rows, stream, fields, rules, newest, at)
        result = contract.verdict(spark, lines, at, run_id)
        if not _is_logged(spark, root, run_id):
            contract.append_audit(result.audit, root)
        if result.failures:
            paths.move(spark, path, quarantine_path(root, stream, number))
        else:
            sink(rows, number)
            paths.remove(spark, path)

    return judge


def quarantined(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """Rows of all quarantined micro-batches of a stream, with the number of their batch."""
    return spark.read.parquet(quarantine_path(root, stream))


def release(spark: SparkSession, root: str, stream: str, number: int, sink: Sink, at: datetime, note: str | None = None) -> int:
    """Let a quarantined micro-batch through after all and resolve its audit lines; returns how many were open."""
    path = quarantine_path(root, stream, number)
    if not paths.has_data(spark, path):
        raise ValueError(f"no quarantined micro-batch {number} of {stream}")
    sink(spark.read.parquet(path), number)
    resolved = contract.resolve_stored_where(spark, root, F.col("pipeline_run_id") == run_name(stream, number), at, note)
    paths.remove(spark, path)
    return resolved
