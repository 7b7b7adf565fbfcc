"""Layer tables: reads, and writes that replace exactly what a run produced."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.layouts import PARTITION
from lockgate.operators.trips import DEALT, first_copies, gathered, narrowed, sorts_first
from lockgate.sources import storage

#: The digest that shuffles leave out or carry as bytes.
TRIP = "trip_id"

#: Partition directories listed or moved concurrently.
LISTERS = 32


class NothingToPublish(RuntimeError):
    """A stage has no rows left to write.

    Raised before the write: an empty partitioned write would leave a path
    that the next stage cannot read. Gates being off makes no difference.
    """

    def __init__(self, stage: str, rows_in: int) -> None:
        super().__init__(f"{stage}: none of {rows_in:,} rows is left to publish")
        self.stage, self.rows_in = stage, rows_in


def read_layer(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """A layer in its declared layout; no job to find out the schema."""
    return spark.read.schema(layout).parquet(path)


def _arranged(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Brings each partition's rows together, in tasks of bounded size.

    Without this every task writes a file into every partition. A rebalance
    lets AQE cut a day that is too large for one task into several; without
    AQE a salt spreads every day over all tasks instead. Trip ids cross as ``narrowed`` has them.
    """
    spark = df.sparkSession
    if not partition_by:
        return df
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        if TRIP not in df.columns or TRIP in partition_by:
            return df.hint("rebalance", *partition_by)
        carried, value = narrowed(df, TRIP)
        carried = carried.hint("rebalance", *partition_by)
        return carried.select(*[value.alias(c) if c == TRIP else c for c in df.columns])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(tasks))
    return df.repartition(tasks, *[F.col(c) for c in partition_by], salt)


def _leaves(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Names below ``root`` of its partition directories, or of its files if it is flat.

    Directories are listed side by side, because an object store answers each
    listing slowly but many at once.
    """

    def inside(name: str) -> list[tuple[str, bool]]:
        listed = storage.children(spark, f"{root}/{name}" if name else root)
        return [(f"{name}/{child}" if name else child, is_dir) for child, _, is_dir in listed]

    if not depth:
        return [name for name, _ in inside("") if name[0] not in "._"]
    with ThreadPoolExecutor(LISTERS) as pool:
        level = [""]
        for _ in range(depth):
            entries = [entry for listed in pool.map(inside, level) for entry in listed]
            level = [name for name, is_dir in entries if is_dir and "=" in name.rpartition("/")[2]]
    return level


#: What a table's own replacements keep below it; readers pass over names that begin so.
_PENDING = "_pending"
_STEPS = "place boolean, name string"


def settle(spark: SparkSession, path: str) -> bool:
    """Finishes a replacement that a run had recorded but did not live to carry out.

    Says whether there was one. Rows written beside the table without a record belong to a
    run that died before it had all of them; they go. Every write settles its table first,
    and so does a stage before it reads. A table has one writer at a time: settling while
    another run still replaces partitions of it would take its steps from under it.
    """
    found = False
    for _, beside, _ in storage.children(spark, f"{path}/{_PENDING}"):
        if storage.exists(spark, f"{beside}/steps"):
            found = True
            _carry_out(spark, path, beside)
    storage.delete(spark, f"{path}/{_PENDING}")
    return found


def _carry_out(spark: SparkSession, path: str, beside: str) -> None:
    """Takes the recorded steps; those that an earlier attempt took are passed over."""

    def take(step: tuple[bool, str]) -> None:
        place, name = step
        rows, target = f"{beside}/rows/{name}", f"{path}/{name}"
        if not place:
            storage.delete(spark, target)
        elif storage.exists(spark, rows):
            storage.delete(spark, target)
            storage.move(spark, rows, target)

    steps = spark.read.schema(_STEPS).json(f"{beside}/steps").collect()
    with ThreadPoolExecutor(LISTERS) as pool:
        list(pool.map(take, map(tuple, steps)))


def _put(
    spark: SparkSession,
    path: str,
    rows: DataFrame | None,
    partition_by: Sequence[str],
    drop: Collection[str] = (),
    *,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    arranged: bool = False,
) -> None:
    """Replaces the partitions that ``rows`` has, and removes those of ``drop`` that it has not.

    The rows are written beside the table; then the names to place and to remove are
    recorded, which decides the replacement; then the steps are taken. A run that dies
    before the record leaves the table as it was, one that dies after it leaves the rest
    to ``settle``. The record appears by one rename, and partitions move by renames.
    """
    beside = f"{path}/{_PENDING}/{uuid.uuid4().hex}"
    placed: list[str] = []
    if rows is not None:
        rows = rows if arranged else _arranged(rows, partition_by)
        writer = (finish(rows) if finish else rows).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{beside}/rows", compression=storage.CODEC)
        placed = _leaves(spark, f"{beside}/rows", len(partition_by))
    steps = [(True, name) for name in placed]
    steps += [(False, name) for name in sorted(set(drop).difference(placed))]
    if steps:
        # one name for each partition that the run answers for
        record = spark.createDataFrame(steps, _STEPS)
        record.coalesce(1).write.json(f"{beside}/steps.open")
        storage.move(spark, f"{beside}/steps.open", f"{beside}/steps")
        _carry_out(spark, path, beside)
    storage.delete(spark, f"{path}/{_PENDING}")


def _in_window(
    directory: str, since: date | None, until: date | None, days: Collection[date | None] | None
) -> bool:
    values = [p.partition("=")[2] for p in directory.split("/") if p.startswith(f"{PARTITION}=")]
    if days is None and not (since or until):
        return True
    try:
        day = date.fromisoformat(unquote(values[-1]))
    except IndexError:
        return False
    except ValueError:
        day = None
    if days is not None:
        return day in days
    return day is not None and (since is None or day >= since) and (until is None or day <= until)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (PARTITION,),
    mode: str = "overwrite",
    since: date | None = None,
    until: date | None = None,
    days: Collection[date | None] | None = None,
    empty: bool = False,
    replace_all: bool = False,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    arranged: bool = False,
) -> None:
    """Replaces the partitions a run answers for, and no others.

    The partitions present in ``df`` are replaced. A run without a window answers for
    the days it brings, so loads of different days add up. A run with a window answers
    for all of it: a partition inside that ``df`` no longer has is removed. The same
    holds for a run over a list of ``days``. An open end reaches as far as the data, and
    ``replace_all`` makes a run answer for every partition there is. Only directory names
    pass through the driver. A run that dies leaves the old table, or one that ``settle``
    finishes: see there.

    ``mode="append"`` adds files and replaces nothing. ``empty`` says that ``df`` is known
    to have no rows, which saves the scan. ``finish`` gives ``df`` its last shape behind the
    shuffle that arranges the rows, so that derived columns do not cross it. ``arranged`` says
    that tasks hold few partitions each already: the rows are then written without a shuffle.
    """
    spark = df.sparkSession
    settle(spark, path)
    if mode != "overwrite":
        rows = df if arranged else _arranged(df, partition_by)
        writer = (finish(rows) if finish else rows).write.mode(mode)
        writer = writer.partitionBy(*partition_by) if partition_by else writer
        writer.parquet(path, compression=storage.CODEC)
        return
    before: list[str] = []
    if not partition_by:
        before = _leaves(spark, path, 0)
    elif since or until or replace_all or days is not None:
        before = [
            name
            for name in _leaves(spark, path, len(partition_by))
            if _in_window(name, since=since, until=until, days=days)
        ]
    rows = None if empty and partition_by else df
    _put(spark, path, rows, partition_by, before, finish=finish, arranged=arranged)


def touched_by(df: DataFrame, partition_by: Sequence[str] = (PARTITION,)) -> list[tuple]:
    """The partitions that ``df`` has rows for: as many values as directories."""
    return [tuple(row) for row in df.select(*partition_by).distinct().collect()]


def _in_any(touched: Sequence[tuple], partition_by: Sequence[str]) -> Column:
    """A condition on partition columns alone, which prunes directories."""
    if len(partition_by) == 1:
        column, values = F.col(partition_by[0]), [value for (value,) in touched]
        found = column.isin([value for value in values if value is not None])
        return found | column.isNull() if None in values else found
    found = F.lit(False)
    for values in touched:
        same = F.lit(True)
        for name, value in zip(partition_by, values):
            same = same & F.col(name).eqNullSafe(F.lit(value))
        found = found | same
    return found


def kept_there(
    spark: SparkSession,
    path: str,
    layout: T.StructType,
    touched: Sequence[tuple],
    partition_by: Sequence[str] = (PARTITION,),
) -> DataFrame | None:
    """What a layer has in the given partitions, a replacement being finished first; None without a layer."""
    settle(spark, path)
    if not storage.exists(spark, path):
        return None
    return read_layer(spark, path, layout).filter(_in_any(touched, partition_by))


def merge_layer(
    df: DataFrame,
    path: str,
    layout: T.StructType,
    *,
    key: str | None = None,
    partition_by: Sequence[str] = (PARTITION,),
    touched: Sequence[tuple] | None = None,
    digests: bool = False,
) -> list[tuple]:
    """Adds rows to the partitions they belong to, keeping what is there; returns those partitions.

    Copy on write: only partitions that ``df`` has rows for are read and rewritten, the
    files of all others stay as they are. Rows that share ``key`` become one, the first in
    the order of all columns, whichever load brought it: loads may come in any order, twice,
    or overlap, and give the same layer. Rows of one key have to share a partition. Without
    a key, rows are one when all their columns agree. A partition that is not there yet is
    merged with nothing. ``touched`` saves the scan that finds the partitions. ``digests`` says
    that all ids, of rows that are there as well, are the digests of their rows' fields.

    A run that dies leaves the partitions as they were, or ``settle`` finishes them.

    ``df`` is read more than once unless ``touched`` is given.
    """
    if not partition_by:
        raise ValueError("a flat layer is replaced whole; there are no partitions to merge into")
    spark = df.sparkSession
    touched = touched_by(df, partition_by) if touched is None else list(touched)
    if not touched:
        return touched
    rows = df.select(*layout.fieldNames())
    there = kept_there(spark, path, layout, touched, partition_by)
    if there is not None:
        rows = there.unionByName(rows)
    # The shuffle that gathers the copies also arranges the rows, as ranges of partitions.
    arranged = bool(key) and not sorts_first(rows, key, digests=digests)
    if arranged:
        within = (*partition_by, DEALT) if digests else partition_by
        rows = first_copies(gathered(rows, key, partition_by, digests=digests), key, within).drop(DEALT)
    else:
        rows = first_copies(rows, key) if key else rows.distinct()
    _put(spark, path, rows, partition_by, arranged=arranged)
    return touched
