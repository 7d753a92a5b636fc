"""Tables in the folder that driver and executors share, and row numbers without a single task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a temporary one serves a session whose executors
    run on the driver's own machine; any other session is refused."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tallybrook-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str | None]) -> Iterator[None]:
    """Settings of the session for a while; None stands for the application's own."""
    before = {n: spark.conf.get(n, None) for n in settings}
    put = lambda n, v: spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    for n, v in settings.items():
        put(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            put(n, v)


def own_splits(spark: SparkSession):
    """Inside, tables are read in the splits that the application is set to, not in those the session has for files."""
    return settings_of(spark, dict.fromkeys(("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")))


def drop_table(table: DataFrame) -> None:
    """Removes a table of write_table that no later step reads."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A table of so many rows at most may be ordered in one task, or broadcast.
FEW_ROWS = 50_000


def beside(facts: DataFrame) -> DataFrame:
    """A written table of facts to join rows with: broadcast if it is counted to have few rows, so that the rows of a hot
    key stay where they are; else as it is."""
    return F.broadcast(facts) if facts.count() <= FEW_ROWS else facts


def in_ranges(rows: DataFrame, order: list[Column], place: bool = False, written: bool = False) -> DataFrame:
    """rows with __part, the range of the order in which a row lies, from 0; written. They are written (unless they stand in
    a written table) and counted first: few rows are one part. place: also __at, the row's place in its part, from 1; parts
    are written in order, so that no later step sorts them again for it."""
    held = rows if written else write_table(rows, "rows")
    if held.count() <= FEW_ROWS:
        one = held.withColumn("__part", F.lit(0))
        return one.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(*order)).cast("long")) if place else one
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.repartitionByRange(parts, *order)
    if place:  # the lower 33 bits of the id count a task's rows
        dealt = dealt.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    return write_table(dealt.withColumn("__part", F.spark_partition_id()), "ranges")


def before_parts(parts: DataFrame, value: str, name: str) -> DataFrame:
    """parts(__part, value), a row for each part -> __part, name: the sum over the parts before."""
    return parts.select("__part", F.coalesce(F.sum(value).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(name))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their rank in the order, from 1, as a long. Only the sizes of the order's ranges, a row each, are summed
    up in one task."""
    dealt = in_ranges(rows, order, place=True)
    before = before_parts(dealt.groupBy("__part").agg(F.count("*").alias("__n")), "__n", "__before")
    return dealt.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")
