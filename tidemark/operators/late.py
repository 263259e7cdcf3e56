"""Rows that land too late for a table's lookback: split off, kept in a ledger, and reconciled.

An incremental run reads what lies after ``mark - lookback``; a row that lands with an older cursor is
never read. The ledger names those rows. Each arrival is judged once, before the run that could have applied
it moves the mark: its files are the landing files that no earlier arrival held, so only new files are read.

* ``rows``: the late rows as they landed, with the reason and the bound that ruled them out,
* ``counts``: landed and late rows of each arrival, with its bound,
* ``files``: the files that were judged.

An arrival that is judged again after a failure overwrites its own folders, and a bound that was recorded
stays, so a run that died in between neither loses nor doubles a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import ntz
from tidemark.sources import paths

REASON, BOUND, ARRIVAL = "late_reason", "late_bound", "arrival"


def late_reason(cursor: Column, bound: datetime | None, inclusive: bool = False) -> Column:
    """Why a row is not read by a run with this bound; NULL when it is."""
    if bound is None:
        return F.lit(None).cast("string")
    edge = ntz(bound).cast("timestamp")
    old = cursor < edge if inclusive else cursor <= edge
    return F.when(cursor.isNull(), "no_cursor").when(old, "beyond_lookback")


def split_late(rows: DataFrame, cursor: str, bound: datetime | None, inclusive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(timely rows, late rows with reason and bound)."""
    reason = late_reason(F.col(cursor), bound, inclusive)
    edge = F.lit(None) if bound is None else ntz(bound)
    late = rows.filter(reason.isNotNull()).withColumns({REASON: reason, BOUND: edge.cast("timestamp_ntz")})
    return rows.filter(reason.isNull()), late


@dataclass(frozen=True)
class Ledger:
    """The late rows of one table."""

    root: str
    name: str

    def _path(self, part: str, arrival: int | None = None) -> str:
        whole = f"{self.root}/_late/{self.name}/{part}"
        return whole if arrival is None else f"{whole}/{ARRIVAL}={arrival}"

    def arrivals(self, spark: SparkSession) -> list[int]:
        return sorted(int(v) for v in paths.partition_values(spark, self._path("files"), ARRIVAL))

    def recorded_bound(self, spark: SparkSession, arrival: int) -> tuple[bool, datetime | None]:
        """Whether the arrival was judged before, and by which bound."""
        if not paths.has_data(spark, self._path("counts", arrival)):
            return False, None
        return True, spark.read.parquet(self._path("counts", arrival)).first()[BOUND]

    def record(
        self, arrived: DataFrame, arrival: int, cursor: str, bound: datetime | None, inclusive: bool = False, files: Sequence[str] = ()
    ) -> None:
        """Write the late rows of an arrival and its counts, which read the cursor alone."""
        spark = arrived.sparkSession
        split_late(arrived, cursor, bound, inclusive)[1].write.mode("overwrite").parquet(self._path("rows", arrival))
        reason = late_reason(F.col(cursor), bound, inclusive)
        edge = F.lit(None) if bound is None else ntz(bound)
        counts = arrived.agg(F.count(F.lit(1)).alias("landed"), F.count(reason).alias("late"))
        counts = counts.withColumn(BOUND, edge.cast("timestamp_ntz"))
        counts.coalesce(1).write.mode("overwrite").parquet(self._path("counts", arrival))
        self._note_files(spark, arrival, files)

    def _note_files(self, spark: SparkSession, arrival: int, files: Sequence[str]) -> None:
        listed = spark.createDataFrame([(f,) for f in files], "file string")
        listed.coalesce(1).write.mode("overwrite").parquet(self._path("files", arrival))

    def unseen(self, landing: DataFrame) -> list[str]:
        """Landing files of no judged arrival. A scan's own file list, which the driver holds anyway."""
        spark = landing.sparkSession
        known = set()
        if self.arrivals(spark):
            known = {r["file"] for r in spark.read.parquet(self._path("files")).select("file").collect()}
        return sorted(set(map(unquote, landing.inputFiles())) - known)

    def judge(self, landing: DataFrame, base: str, cursor: str, bound: datetime | None, inclusive: bool = False) -> int:
        """Record the late rows among all that has landed since the last arrival; returns the arrival's number.

        ``base`` is the folder below which the partitions of ``landing`` lie.
        """
        spark, files = landing.sparkSession, self.unseen(landing)
        arrival = len(self.arrivals(spark))
        arrived = spark.read.schema(landing.schema).option("basePath", base).parquet(*files) if files else landing.limit(0)
        self.record(arrived, arrival, cursor, bound, inclusive, files)
        return arrival

    def rewritten(self, spark: SparkSession, before: set[str], after: set[str]) -> None:
        """Files that replace judged ones, such as those of a pruned day, are no arrival."""
        new = sorted(after - before)
        if new:
            self._note_files(spark, len(self.arrivals(spark)), new)

    def reset(self, landing: DataFrame) -> None:
        """After a full refresh, which applies every landed row: nothing is late, all files are known."""
        spark = landing.sparkSession
        files = sorted(set(map(unquote, landing.inputFiles())))
        paths.remove(spark, f"{self.root}/_late/{self.name}")
        self.record(landing, 0, landing.columns[0], None, files=files)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self._path("rows"))

    def counts(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self._path("counts"))


def reconcile(
    landed: DataFrame, late: DataFrame, stored: DataFrame, keys: Sequence[str], day: str, usable: Column, identity: str = "raw_id"
) -> DataFrame:
    """Where every landed row went, per day: landed = stored + superseded + late + unusable.

    ``stored`` is counted in the target, the rest in landing, so ``balanced`` compares two sides. A row is
    superseded when another timely row of its key is stored instead; a row without a usable key has no place
    in the target. Rows are reduced to one per key before they meet in a day, so a hot day spreads over its keys.
    """
    ids = late.select(F.col(identity).alias("_late_id")).distinct()
    marked = landed.join(ids, F.col(identity) == F.col("_late_id"), "left")
    is_late = F.col("_late_id").isNotNull()
    fit = F.coalesce(usable, F.lit(False))
    per_key = marked.groupBy(*dict.fromkeys([*keys, day])).agg(
        F.count(F.lit(1)).alias("landed"),
        F.count_if(is_late).alias("late"),
        F.count_if(~is_late & ~fit).alias("unusable"),
        F.count_if(~is_late & fit).alias("timely"),
    )
    here = per_key.groupBy(F.col(day).alias("day")).agg(
        *[F.sum(c).alias(c) for c in ("landed", "late", "unusable")],
        F.sum(F.greatest(F.col("timely") - 1, F.lit(0))).alias("superseded"),
    )
    there = stored.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("stored"))
    both = here.join(there, F.col("day").eqNullSafe(F.col("_day")), "full")
    n = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("landed", "stored", "superseded", "late", "unusable")}
    return both.select(
        F.coalesce("day", "_day").alias("day"),
        *[c.alias(name) for name, c in n.items()],
        (n["landed"] == n["stored"] + n["superseded"] + n["late"] + n["unusable"]).alias("balanced"),
    )
