"""Tables that change after they were written: replaced, updated by partition, appended to by key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"


class DuplicateKey(ValueError):
    """A key would stand in a table twice."""


# --- replaced whole ------------------------------------------------------------------


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The folder of the version that the pointer names; None before the first one."""
    files, pointer = _files(spark, folder), _path(spark, f"{folder}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return f"{folder}/{spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8').strip()}"
    finally:
        stream.close()


def replace_table(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Put ``df`` in the place of the table under ``folder`` and read it.

    The new version is written beside the old one; then a pointer file is renamed over
    the last one, which is one step of the file system.  A reader opens the old table or
    the new one, whole; a write that fails leaves the old one as it was.  ``df`` may read
    the table it replaces.  Old versions stay for readers under way, until
    :func:`drop_old_versions`.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{folder}/{version}")
    beside = _path(spark, f"{folder}/{POINTER}-{version}")
    stream = _files(spark, folder).create(beside, False)
    stream.write(version.encode())
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(beside.toUri() if beside.toUri().getScheme() else _files(spark, folder).getUri())
    context.rename(beside, _path(spark, f"{folder}/{POINTER}"), options)
    return read_current(spark, folder)


def read_current(spark: SparkSession, folder: str) -> DataFrame:
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"{folder} holds no table")
    return spark.read.parquet(version)


def drop_old_versions(spark: SparkSession, folder: str) -> int:
    """Remove the versions that the pointer does not name; how many these were."""
    files, live = _files(spark, folder), current_version(spark, folder)
    gone = [s.getPath() for s in files.listStatus(_path(spark, folder)) if s.isDirectory() and s.getPath().getName().startswith("v-")]
    gone = [p for p in gone if live is None or p.getName() != live.rsplit("/", 1)[1]]
    for path in gone:
        files.delete(path, True)
    return len(gone)


# --- updated by partition --------------------------------------------------------------


def _one_of(rows: Sequence, columns: Sequence[str]) -> Column:
    """The partitions of these rows, as a condition that file listing can use."""
    if len(columns) == 1 and all(r[0] is not None for r in rows):
        return F.col(columns[0]).isin([r[0] for r in rows])
    same = [reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(columns, r, strict=True)]) for r in rows]
    return reduce(or_, same, F.lit(False))


def update_table(
    spark: SparkSession, path: str, partition_by: Sequence[str], keys: Sequence[str], changes: DataFrame
) -> list[tuple]:
    """Set columns of a stored Parquet table where its keys meet ``changes``; the partitions that were rewritten.

    ``changes`` has the key columns and the columns to set.  Rows are never added: a key
    that the table lacks is ignored, one that ``changes`` repeats is refused, and a key
    with a NULL meets nothing.  The new value may be NULL.  All rows of a repeated key of the table are set.

    Only partitions with a row that really changes are read whole and written again, by
    a dynamic partition overwrite; the files of all others stay as they are.  The list of
    touched partitions goes through the driver, as the list of all partitions does in any
    scan of the table.  Each partition is switched when the job commits.
    """
    values = [c for c in changes.columns if c not in keys]
    repeated = changes.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").first()
    if repeated:
        raise DuplicateKey(f"changes repeat the key {[repeated[k] for k in keys]}")
    table = spark.read.parquet(path)
    unknown = sorted({*values, *partition_by} - set(table.columns) | set(values) & set(partition_by))
    if unknown:
        raise ValueError(f"not columns to set, or to partition by: {unknown}")
    offered = changes.select(*keys, *[F.col(c).cast(table.schema[c].dataType).alias(f"_new_{c}") for c in values], F.lit(True).alias("_met"))
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in values], F.lit(False))
    changed = table.select(*dict.fromkeys([*keys, *partition_by, *values])).join(offered, list(keys)).where(differs)
    touched = [tuple(r) for r in changed.select(*partition_by).distinct().collect()]
    if touched:
        whole = table.where(_one_of(touched, partition_by)).join(offered, list(keys), "left")
        fresh = whole.select(
            *[F.when(F.col("_met"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns]
        )
        # one task per partition and stretch of keys, so a large partition is not one task's
        dealt = fresh.repartition(*partition_by, F.pmod(F.xxhash64(*keys), F.lit(8)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
        spark.catalog.refreshByPath(path)
    return sorted(touched, key=str)


# --- appended to by key ------------------------------------------------------------------


def append_keyed(batch: DataFrame, table: str, keys: Sequence[str], buckets: int, allow_null: bool = False) -> DataFrame:
    """Append a batch to a bucketed catalog table, unless a key would then stand twice; the table after it.

    The table is one of :func:`tables.save_bucketed`, bucketed by all or some of ``keys``.
    The check joins the batch to the table's key columns where these lie: the batch is
    shuffled, the table is not.  A key with a NULL equals no other key; without
    ``allow_null`` it is refused.
    """
    spark = batch.sparkSession
    stored = spark.table(table)
    by = _bucketed_by(spark, table)
    if not set(by) <= set(keys):
        raise ValueError(f"{table} is bucketed by {by}, not by columns of the key {list(keys)}")
    if not allow_null:
        empty = batch.where(reduce(or_, [F.col(k).isNull() for k in keys])).first()
        if empty:
            raise DuplicateKey(f"a key has no value: {[empty[k] for k in keys]}")
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    repeated = batch.where(known).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").first()
    clash = repeated or clashing_keys(batch, stored, keys).first()
    if clash:
        raise DuplicateKey(f"{table} would repeat the key {[clash[k] for k in keys]}")
    fitted = batch.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema.fields])
    fitted.repartition(buckets, *by).write.mode("append").bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)
    return spark.table(table)


def clashing_keys(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch that the stored table has already."""
    return batch.select(*keys).join(stored.select(*keys), list(keys), "left_semi").distinct()


def _bucketed_by(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isBucket]
