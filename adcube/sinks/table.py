"""Table sinks: full refresh and keyed upsert (delete+insert) on Parquet.

No table format with MERGE is assumed (plain Parquet).  A write never touches
the table's own files first: it writes beside the table, on the same store, and
then moves the written folders into place.  What was written and not yet moved is
finished by the next run (:func:`recover`), so an interrupted run loses no row:

* ``<path>__replace``  a whole new table, moved over ``path``;
* ``<path>__upsert``   the merged content of the touched partitions, each moved
  over the partition of the same name;
* ``<path>__batch``    the batch of a running upsert, deleted at the end;
* ``<side>__rows``     rows of one of the first two before they are dealt by partition.

A side folder without Spark's ``_SUCCESS`` marker is an unfinished write and is
deleted.  While one partition is being moved a reader may not see it.

Every table folder holds its schema in ``_adcube_schema.json``, so reading opens
no file footers and partition values have the types they were written with.  A
column that ``sync`` drops is left out there and its old files stay; the file notes
its name, because a run that brings it back has to write the whole table anew (old
files would show old values).
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import intermediates, written

POLICIES = ("append", "sync")
SCHEMA_FILE = "_adcube_schema.json"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
CODEC = "zstd"
FEW, OPEN_BYTES = 8, 32 << 20  # partitions that a task writes side by side, and the row group of each
LITTLE_BYTES, SLICES = 64 << 20, 4  # more rows are dealt by partition in so many parts


def _all_of(conditions):
    return reduce(lambda a, b: a & b, conditions)


def _may_match(since) -> Column:
    """Rows that a batch which begins at ``since = (column, value)`` may replace."""
    column, value = since
    return F.coalesce(F.col(column) >= F.lit(value), F.lit(False))


def merge_by_key(target: DataFrame, batch: DataFrame, keys: list[str], policy: str = "append",
                 null_safe: bool = False, since=None) -> DataFrame:
    """Target rows whose key is not in the batch, plus every batch row (lazy).

    By default NULL keys never match, so target rows with a NULL key are never
    replaced (the reference's delete behaves the same).  ``null_safe`` matches
    NULL with NULL, so a row of an unknown entity is replaced like any other.
    Schema policy:

    * ``append`` — new batch columns are added (NULL on old rows); columns the
      batch lacks are kept (NULL on inserted rows).
    * ``sync`` — the result has exactly the batch's columns and types.

    ``since``: ``(column, value)`` if the key names the column's value and no batch row
    has a NULL or a lesser one there.  Target rows that have are kept without a join.
    """
    if since is not None:
        old = merge_by_key(target.where(~_may_match(since)), batch.limit(0), keys, policy, null_safe)
        return old.unionByName(merge_by_key(target.where(_may_match(since)), batch, keys, policy, null_safe))
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    return _with_batch(_kept(target, batch, keys, null_safe), batch, policy)


def _kept(target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Target rows whose key is not in the batch."""
    if null_safe:
        return target.join(_keys_of(batch, keys), _same_keys(target, keys), "left_anti")
    # A NULL key never matches, so those rows are kept without joining: left
    # in the anti-join they would all hash to one shuffle partition (a hot
    # task when many entities miss their dimension).
    return (target.where(~_any_null(keys)).join(batch.select(*keys), on=keys, how="left_anti")
            .unionByName(target.where(_any_null(keys))))


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _keys_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()


def _same_keys(target: DataFrame, keys: list[str]) -> Column:
    return _all_of([target[k].eqNullSafe(F.col(f"_key_{k}")) for k in keys])


def _with_batch(kept: DataFrame, batch: DataFrame, policy: str) -> DataFrame:
    if policy == "append":
        return kept.unionByName(batch, allowMissingColumns=True)
    types = {f.name: f.dataType for f in batch.schema.fields}
    kept = kept.select(*[(F.col(c).cast(types[c]) if c in kept.columns else F.lit(None).cast(types[c])).alias(c)
                         for c in batch.columns])
    return kept.unionByName(batch)


# ------------------------------------------------------------------ file system

class _Store:
    """The file system of a path, through Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        if self.exists(path):
            self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Put the folder or file ``source`` in the place of ``target``."""
        self._fs.mkdirs(self._path(target).getParent())
        self.delete(target)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def children(self, path: str) -> list[str]:
        """Names of what lies directly in the folder ``path``."""
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def folders(self, path: str) -> list[str]:
        """Names of the partition folders (``column=value``) directly below ``path``."""
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))
                if s.isDirectory() and "=" in s.getPath().getName()]

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _leaves(store: _Store, path: str, below: str = "") -> list[str]:
    """Relative paths of the innermost partition folders."""
    found = []
    for name in store.folders(f"{path}/{below}" if below else path):
        child = f"{below}/{name}" if below else name
        found += _leaves(store, path, child) or [child]
    return found


# ----------------------------------------------------------------------- reading

def _without_partitions_last(schema: StructType, partition_by) -> StructType:
    fields = [f for f in schema.fields if f.name not in partition_by]
    return StructType([StructField(f.name, f.dataType, True) for f in fields]
                      + [StructField(c, schema[c].dataType, True) for c in partition_by])


def _stored_schema(store: _Store, path: str) -> tuple[StructType, list[str]] | None:
    if not store.exists(f"{path}/{SCHEMA_FILE}"):
        return None
    found = json.loads(store.read(f"{path}/{SCHEMA_FILE}"))
    return StructType.fromJson(found["schema"]), found["partition_by"]


def _hidden_columns(store: _Store, path: str) -> set[str]:
    """Columns that were dropped while files which hold them stayed."""
    return set(json.loads(store.read(f"{path}/{SCHEMA_FILE}")).get("hidden", ())) if store.exists(f"{path}/{SCHEMA_FILE}") else set()


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, ``None`` if there is none; any other failure is raised.

    Reading leaves the folders of a running or interrupted write alone.  Tables
    written by other tools have no schema file: their footers are merged.
    """
    store = _Store(spark, path)
    if not store.exists(path):
        return None
    known = _stored_schema(store, path)
    if known:
        return spark.read.schema(known[0]).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def max_date(spark: SparkSession, path: str, column: str = "date"):
    """``max(column)`` of the table, or ``None`` if it is absent or empty.

    For a partition column the folder names tell: no file is opened.
    """
    t = read_table(spark, path)
    if t is None:
        return None
    store = _Store(spark, path)
    values = [part.split("=", 1)[1] for leaf in _leaves(store, path) for part in leaf.split("/")
              if part.split("=", 1)[0] == column]
    if not values:
        return t.agg(F.max(column)).first()[0]
    values = sorted({unquote(v) for v in values} - {_NULL_PARTITION})
    listed = spark.createDataFrame([(v,) for v in values], "v string")
    return listed.agg(F.max(F.col("v").cast(t.schema[column].dataType))).first()[0]


# ----------------------------------------------------------------------- writing

@contextmanager
def _during(spark: SparkSession, conf: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


# Shuffle files of a write go when it is done, not when the driver collects garbage.
_SHUFFLES_DELETED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# A task that writes few partitions keeps their files open instead of sorting its rows.
_SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": str(FEW)}


def write_rows(df: DataFrame, folder: str) -> DataFrame:
    """Rows written by the tasks that make them, and read back."""
    with _during(df.sparkSession, _SHUFFLES_DELETED):
        df.write.mode("overwrite").option("compression", CODEC).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _write_beside(df: DataFrame, folder: str, partition_by, hidden=(), as_is: DataFrame | None = None,
                  batch: tuple[DataFrame, str] | None = None) -> None:
    """Rows of a partition go through few tasks (rebalanced by size), so it gets few files.

    They are in files first, so that shuffled rows never lie beside those of the plan that
    makes them.  More than LITTLE_BYTES stay in their tasks if their partitions are FEW,
    and are dealt in SLICES, one after the other, if they are not.
    ``batch``: rows that ``df`` consists of mostly, with all of its partitions, and their folder.
    Rows ``as_is`` were read from the table's files and are written by the tasks that read them.
    """
    spark, store, by = df.sparkSession, _Store(df.sparkSession, folder), list(partition_by)
    schema, rows = _without_partitions_last(df.schema, by), f"{folder}__rows"
    conf, slices = _SHUFFLES_DELETED, []
    if not by:
        slices = [df.hint("rebalance")]
    else:
        if batch is None:
            df = write_rows(df, rows)
            batch = df, rows
        if store.size(batch[1]) <= LITTLE_BYTES:
            slices = [df.hint("rebalance", *by)]
        elif batch[0].select(*by).distinct().limit(FEW + 1).count() <= FEW:
            conf, slices = conf | _SIDE_BY_SIDE, [df]
        else:
            which = F.pmod(F.xxhash64(*by), F.lit(SLICES).cast("long"))
            slices = [df.where(which == i).hint("rebalance", *by) for i in range(SLICES)]
    if as_is is not None:
        slices[0] = slices[0].unionByName(as_is)
    with _during(spark, conf):
        for i, part in enumerate(slices):
            w = part.write.mode("append" if i else "overwrite").option("compression", CODEC)
            if _SIDE_BY_SIDE.items() <= conf.items():
                w = w.option("parquet.block.size", OPEN_BYTES)
            (w.partitionBy(*by) if by else w).parquet(folder)
    store.delete(rows)
    store.write(f"{folder}/{SCHEMA_FILE}", json.dumps({"schema": json.loads(schema.json()), "partition_by": by,
                                                       "hidden": sorted(hidden)}))


def recover(spark: SparkSession, path: str) -> None:
    """Finish the moves of an interrupted run; delete what it had not finished writing.

    For writers only: every run calls it before it looks at the table.
    """
    store = _Store(spark, path)
    for side, finish in ((f"{path}__replace", _move_table), (f"{path}__upsert", _move_partitions)):
        store.delete(f"{side}__rows")
        if not store.exists(side):
            continue
        # The schema file is written after Spark's marker: both there, all is there.
        if store.exists(f"{side}/_SUCCESS") and store.exists(f"{side}/{SCHEMA_FILE}"):
            finish(store, side, path)
        else:
            store.delete(side)


def _move_table(store: _Store, side: str, path: str) -> None:
    store.move(side, path)


def _move_partitions(store: _Store, side: str, path: str) -> None:
    for leaf in _leaves(store, side):
        store.move(f"{side}/{leaf}", f"{path}/{leaf}")
    store.write(f"{path}/{SCHEMA_FILE}", store.read(f"{side}/{SCHEMA_FILE}"))
    store.delete(side)


def write_table(df: DataFrame, path: str, partition_by=()) -> None:
    """Full refresh: replace the whole table."""
    recover(df.sparkSession, path)
    _write_beside(df, f"{path}__replace", partition_by)
    recover(df.sparkSession, path)


def _touched(target: DataFrame, batch: DataFrame, partition_by) -> DataFrame:
    """Target rows in partitions that the batch has rows in.

    The bounds of the batch's partition values prune the listing; the exact
    partitions follow by a join on their distinct values.
    """
    bounds = batch.agg(*[f(c).alias(f"{n}_{c}") for c in partition_by for n, f in (("lo", F.min), ("hi", F.max))]).first()
    near = [F.col(c).isNull() | F.col(c).between(F.lit(bounds[f"lo_{c}"]), F.lit(bounds[f"hi_{c}"]))
            if bounds[f"lo_{c}"] is not None else F.col(c).isNull() for c in partition_by]
    target = target.where(_all_of(near))
    parts = written(batch.select(*[F.col(c).alias(f"_part_{c}") for c in partition_by]).distinct())
    return target.join(parts, _all_of([target[c].eqNullSafe(parts[f"_part_{c}"]) for c in partition_by]), "left_semi")


def merge_touched(target: DataFrame, batch: DataFrame, keys: list[str], policy: str, null_safe: bool, partition_by,
                  since) -> tuple[DataFrame, DataFrame | None]:
    """The touched partitions merged: rows that may be replaced or are new, and older ones (``since``) that stay as they are.

    Keys alone are compared first.  Most are replaced, so the few left are known by
    their size, and whole rows are joined to them where they are read.
    """
    touched = _touched(target, batch, partition_by)
    rows = touched if since is None else touched.where(_may_match(since))
    names = rows.select(*keys) if null_safe else rows.select(*keys).where(~_any_null(keys))
    left = written(_keys_of(_kept(names, batch, keys, null_safe), keys))
    kept = rows.join(left, _same_keys(rows, keys), "left_semi")
    if not null_safe:
        kept = kept.unionByName(rows.where(_any_null(keys)))
    merged = _with_batch(kept, batch, policy)
    return merged, None if since is None else _with_batch(touched.where(~_may_match(since)), batch.limit(0), policy)


def upsert_by_key(spark: SparkSession, batch: DataFrame, path: str, keys: list[str],
                  policy: str = "append", partition_by=("date",), null_safe: bool = False, since=None) -> str:
    """Upsert ``batch`` into the Parquet table at ``path``; returns what was done.

    The batch is written once beside the table; the merged touched partitions
    are then written beside it too and moved into place, all others stay.  A run
    that stops before the moves leaves the table as it was; one that stops
    between them is finished by the next run.  A column that ``sync`` drops is
    left out of the stored schema only.  A table without partitions, one whose
    columns change their type and one that a dropped column comes back to is
    replaced as a whole.  ``since`` as in :func:`merge_by_key`.
    """
    recover(spark, path)
    target = read_table(spark, path)
    if target is None:
        write_table(batch, path, partition_by)
        return "created"
    store = _Store(spark, path)
    side = f"{path}__batch"
    try:
        batch = write_rows(batch, side)
        whole = merge_by_key(target, batch, keys, policy, null_safe)
        old, new = ({f.name: f.dataType for f in df.schema.fields if f.name not in partition_by} for df in (target, whole))
        hidden = _hidden_columns(store, path)
        reshaped = any(new.get(c, t) != t for c, t in old.items()) or hidden & (set(new) - set(old))
        if reshaped or not partition_by:
            write_table(whole, path, partition_by)
            return "rewritten"
        with intermediates(spark):
            merged, as_is = merge_touched(target, batch, keys, policy, null_safe, partition_by, since)
            _write_beside(merged, f"{path}__upsert", partition_by, hidden | (set(old) - set(new)), as_is, (batch, side))
        recover(spark, path)
        return "upserted"
    finally:
        store.delete(side)


# --------------------------------------------------------------- catalog tables

def publish(spark: SparkSession, path: str, table: str) -> None:
    """Make the table at ``path`` known to the session catalog as ``table``.

    ``table`` is external: its rows stay at ``path``, where upserts go, and it is
    made anew when the columns change.
    """
    store = _Store(spark, path)
    schema, partition_by = _stored_schema(store, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{path}'")
    if partition_by:
        try:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        except AnalysisException as e:
            # Catalogs that do not keep partitions list the folders at each read.
            if "INVALID_PARTITION_OPERATION" not in str(e) and "not partition" not in str(e).lower():
                raise
    spark.catalog.refreshTable(table)
