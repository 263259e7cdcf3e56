"""Incremental tables on partitioned Parquet: lookback windows and keyed replacement.

Every target is partitioned by a date that its key determines, so a replaced row stays in its
partition and a run reads and rewrites only the partitions its batch touches. A run is

1. read the target's high-water mark,
2. restrict the sources to ``mark - lookback`` (a literal, so it reaches the scan and prunes
   partitions),
3. write the batch once to a staging folder (computed once, no lineage to replay),
4. merge with the stored rows of the touched partitions and replace just those.

The first load and a full refresh have nothing to merge with and write the target directly.
One writer per target; a run that is repeated after a failure converges to the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import ntz
from tidemark.operators.dedupe import Ranking, keep_latest
from tidemark.sources import paths
from tidemark.sources.partitions import finish_replacement, replace_partitions, replace_table, replace_whole, write_days


@dataclass(frozen=True)
class Restriction:
    """How the lookback applies to one source.

    ``column`` is compared with the bound; ``partition`` is the date column derived from it,
    compared with the bound's day so that whole partitions are skipped. A None column
    restricts by day only.
    """

    column: str | None
    partition: str | None = None


@dataclass(frozen=True)
class Table:
    """An incremental table.

    ``aligned`` says that the date of ``cursor`` is the partition, so that the newest partition
    holds the mark. Otherwise the mark is recorded next to the table with each run.
    ``ranking`` makes stored and new rows of a key compete, so that a stale re-sync cannot
    replace a fresher stored row. ``replace_range`` deletes everything after the bound instead
    of the batch's keys, so that rows that are no longer produced go away.
    """

    name: str
    layer: str
    key: str
    partition: str
    cursor: str
    lookback: timedelta
    aligned: bool = True
    inclusive: bool = False
    ranking: Ranking | None = None
    replace_range: bool = False

    def path(self, root: str) -> str:
        return f"{root}/{self.layer}/{self.name}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _mark_path(root: str, table: Table) -> str:
    return f"{root}/_marks/{table.name}"


def _batch_path(root: str, table: Table) -> str:
    return f"{root}/_batches/{table.name}"


def _as_datetime(value) -> datetime | None:
    if value is None or isinstance(value, datetime):
        return value
    return datetime.combine(value, time())


def _max_cursor(df: DataFrame, cursor: str):
    return _as_datetime(df.agg(F.max(F.col(cursor).cast("timestamp_ntz")).alias("m")).first()["m"])


def high_water_mark(spark: SparkSession, root: str, table: Table) -> datetime | None:
    """Highest cursor of the target; None when it is absent or empty, which loads everything."""
    path = table.path(root)
    if not paths.has_data(spark, path):
        return None
    if table.aligned:
        days = [d for d in paths.partition_values(spark, path, table.partition) if d != paths.NULL_VALUE]
        if not days:
            return None
        newest = date.fromisoformat(days[-1])
        if table.cursor == table.partition:
            return _as_datetime(newest)
        return _max_cursor(read_table(spark, path).filter(F.col(table.partition) == F.lit(newest)), table.cursor)
    mark = _mark_path(root, table)
    if paths.has_data(spark, mark):
        return spark.read.parquet(mark).agg(F.max("mark").alias("m")).first()["m"]
    return _max_cursor(read_table(spark, path), table.cursor)


def lookback_bound(mark: datetime | None, lookback: timedelta) -> datetime | None:
    return None if mark is None else mark - lookback


def restrict(source: DataFrame, by: Restriction, bound: datetime | None, inclusive: bool) -> DataFrame:
    if bound is None:
        return source
    out = source
    if by.column is not None:
        c = F.col(by.column)
        edge = ntz(bound).cast(source.schema[by.column].dataType)
        out = out.filter(c >= edge if inclusive else c > edge)
    if by.partition is not None:
        out = out.filter(F.col(by.partition) >= F.lit(bound.date()))
    return out


def merge_by_key(stored: DataFrame, batch: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """Delete the batch's keys (or ``keys``), insert the whole batch."""
    return stored.join(batch.select(key) if keys is None else keys, key, "left_anti").select(*batch.columns).unionByName(batch)


def merge_ranked(stored: DataFrame, batch: DataFrame, key: str, ranking: Ranking) -> DataFrame:
    """Stored and new rows of a key compete under the ranking of the full build."""
    return keep_latest(stored.unionByName(batch), ranking, ignore=(key,))


def _observed(batch: DataFrame, table: Table) -> tuple[DataFrame, Observation]:
    """The batch with its highest cursor measured by the job that writes it."""
    seen = Observation()
    return batch.observe(seen, F.max(F.col(table.cursor).cast("timestamp_ntz")).alias("mark")), seen

def _mark_of(seen: Observation, days: list[str]) -> datetime | None:
    """The measured mark; a batch that wrote no day may have been planned away, so it has none."""
    return _as_datetime(seen.get.get("mark")) if days else None


def _stage(spark: SparkSession, root: str, table: Table, batch: DataFrame) -> tuple[DataFrame, list[str], datetime | None]:
    """Write the batch once; its days come from the folder names, its mark from the write itself."""
    folder = _batch_path(root, table)
    marked, seen = _observed(batch, table)
    write_days(marked, folder, table.partition)
    days = paths.partition_values(spark, folder, table.partition)
    if not days:
        return batch.limit(0), [], None
    return spark.read.schema(batch.schema).parquet(folder).select(*batch.columns), days, _mark_of(seen, days)


def _load_all(spark: SparkSession, root: str, table: Table, batch: DataFrame) -> None:
    marked, seen = _observed(batch, table)
    replace_table(spark, marked, table.path(root), table.partition)
    days = paths.partition_values(spark, table.path(root), table.partition)
    _record_mark(spark, root, table, _mark_of(seen, days))


def _record_mark(spark: SparkSession, root: str, table: Table, mark: datetime | None) -> None:
    """Without a mark the next run reads it from the table, so an outdated record is removed."""
    if table.aligned:
        return
    if mark is None:
        paths.remove(spark, _mark_path(root, table))
    else:
        row = spark.range(1).select(ntz(mark).alias("mark"))
        row.coalesce(1).write.mode("overwrite").parquet(_mark_path(root, table))


def delete_insert(
    spark: SparkSession,
    root: str,
    table: Table,
    batch: DataFrame,
    bound: datetime | None = None,
    mark: datetime | None = None,
    compare_existing: bool = True,
    unique: bool = False,
) -> list[str] | None:
    """Put a batch into the target by key (or by range), touching only the partitions involved.

    Days that the target does not hold yet are moved in as they were staged. In a table with a ranking that needs a
    batch that holds a key once (``unique``); without that promise its rows compete with each other on those days too.
    Returns the days it wrote, or None when it loaded the whole table.
    """
    path = table.path(root)
    finish_replacement(spark, path, table.partition)
    present = paths.partition_values(spark, path, table.partition)
    if not present:
        _load_all(spark, root, table, batch)
        return None

    staged, days, batch_mark = _stage(spark, root, table, batch)
    replaced = set(days)
    by_range = table.replace_range and bound is not None
    if by_range:
        replaced |= {d for d in present if d != paths.NULL_VALUE and d >= bound.date().isoformat()}
    touched = sorted(replaced & set(present))
    competes = table.ranking and compare_existing and not by_range
    new = [] if competes and not unique else [d for d in days if d not in present]
    part = F.col(table.partition)
    keys = staged.select(table.key)
    if new:
        staged = staged.filter(paths.on_days(part, sorted(set(days) - set(new))))
    stored = read_table(spark, path).filter(paths.on_days(part, touched))
    emptied: list[str] = []
    if by_range:
        edge = ntz(bound)
        kept = stored.filter(F.col(table.cursor) < edge if table.inclusive else F.col(table.cursor) <= edge)
        if paths.NULL_VALUE in touched:  # rows without a cursor lie in no range; they are replaced by key
            undated = stored.filter(F.col(table.cursor).isNull()).join(keys, table.key, "left_anti")
            kept = kept.unionByName(undated.select(*kept.columns))
        edge_day = bound.date().isoformat()
        for d in touched:
            if d not in days and (d != edge_day or kept.filter(part == F.lit(bound.date())).isEmpty()):
                emptied.append(d)
        merged = kept.select(*staged.columns).unionByName(staged)
    elif competes:
        merged = merge_ranked(stored.select(*staged.columns), staged, table.key, table.ranking)
    else:
        merged = merge_by_key(stored, staged, table.key, keys)
    if set(touched) - set(emptied) or days:
        moved = {d: f"{_batch_path(root, table)}/{table.partition}={d}" for d in new}
        replace_partitions(spark, merged if len(new) < len(days) or touched else None, path, table.partition, moved)
    for d in emptied:
        paths.remove_partition(spark, path, table.partition, d)
    _record_mark(spark, root, table, max((m for m in (mark, batch_mark) if m), default=None))
    paths.remove(spark, _batch_path(root, table))
    return sorted((set(touched) - set(emptied)) | set(days))


def refresh(
    spark: SparkSession,
    root: str,
    table: Table,
    build: Callable[..., DataFrame],
    sources: dict[str, DataFrame],
    restrictions: dict[str, Restriction],
    full_refresh: bool = False,
    compare_existing: bool = True,
    unique: bool = False,
) -> list[str] | None:
    """Run an incremental table once: restrict its sources, build the batch, replace.

    ``unique`` promises that ``build`` gives a key once. Returns the days it wrote, or None when it loaded the whole table.
    """
    if full_refresh:
        _load_all(spark, root, table, build(**sources))
        return None
    finish_replacement(spark, table.path(root), table.partition)
    mark = high_water_mark(spark, root, table)
    bound = lookback_bound(mark, table.lookback)
    recent = {
        name: restrict(df, restrictions[name], bound, table.inclusive) if name in restrictions else df
        for name, df in sources.items()
    }
    return delete_insert(spark, root, table, build(**recent), bound, mark, compare_existing, unique)


def rebuild(df: DataFrame, root: str, layer: str, name: str) -> None:
    """Full rebuild: rows that no longer qualify disappear."""
    replace_whole(df.sparkSession, df, f"{root}/{layer}/{name}")


def backfill_keys(df: DataFrame, key: str, new_key: Column) -> DataFrame:
    """Recompute a stored key from stored columns; other columns and the row count stay."""
    return df.withColumn(key, new_key)


def rewrite_keys(spark: SparkSession, root: str, table: Table, new_key: Column) -> int:
    """Backfill a stored table in place; the row count must stay."""
    path = table.path(root)
    finish_replacement(spark, path, table.partition)
    before = read_table(spark, path).count()
    columns = read_table(spark, path).columns
    fixed = backfill_keys(read_table(spark, path), table.key, new_key).select(*columns)
    replace_partitions(spark, fixed, path, table.partition)
    after = read_table(spark, path).count()
    if before != after:
        raise RuntimeError(f"{table.name}: {before} rows before the backfill, {after} after")
    return after
