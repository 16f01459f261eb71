"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOCAL_LIST = T.StructType(
    [T.StructField("taxon_id", T.StringType(), False), T.StructField("focal", T.IntegerType(), False)]
)
PROCESSING_METHOD = T.StructType(
    [
        T.StructField("taxon_id", T.StringType(), False),
        T.StructField("unit_type_id", T.IntegerType(), False),
        T.StructField("unit_id", T.IntegerType(), False),
        T.StructField("search_type_id", T.IntegerType(), False),
        T.StructField("response_variable_type_id", T.IntegerType(), False),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, unique: Sequence[str] = ()) -> DataFrame:
    """A CSV file with a header, typed by ``schema``; a malformed row stops the read.

    ``unique`` names the columns of a key: a file that repeats one is refused on load.
    """
    table = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    if unique:
        repeated = table.groupBy(*unique).agg(F.count("*").alias("n")).where("n > 1").drop("n").first()
        if repeated:
            raise ValueError(f"{path} repeats the key {repeated.asDict()}")
    return table


def missing_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with NULL in a column that ``schema`` declares as not NULL (files cannot enforce it)."""
    required = [F.col(f.name).isNull() for f in schema.fields if not f.nullable]
    return df.where(reduce(or_, required, F.lit(False)))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> DataFrame:
    """Store a stage as Parquet and read it back; ``mode="errorifexists"`` refuses to replace one."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store a catalog table bucketed and sorted by a join key of one or more columns.

    Sightings kept this way by survey id are joined to their surveys where they
    lie: only the much smaller survey side is shuffled, in every later run.  Rows are
    dealt by the key before they are written, so a bucket is one file, not one per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(
    spark: SparkSession, table: str, key: str | Sequence[str], buckets: int, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table of :func:`save_bucketed`, known to this session's catalog again by its folder."""
    if not spark.catalog.tableExists(table):
        keys = ", ".join(f"`{k}`" for k in ([key] if isinstance(key, str) else key))
        fields = (schema or spark.read.parquet(path).schema).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
    return spark.table(table)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed table without rows."""
    return spark.createDataFrame([], schema)
