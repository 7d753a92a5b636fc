"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.tables import drop_table, write_table

__all__ = ["Memo", "drop_table", "fold", "hot_keys", "matrix_of", "read", "spread_join", "tidy", "whole_vectors", "write_table"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the input tables, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hot_keys(rows: DataFrame, key: str, most: int = 1000, least: int = 1000) -> list:
    """The keys that hold more than 1/most of the rows each, so fewer than `most` keys, and `least` rows. Null is none."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("of_key")).where(F.col("of_key") >= least)
    found = counts.orderBy(F.desc("of_key")).limit(most).collect()
    total = rows.count() if found else 0
    return [r[key] for r in found if r["of_key"] * most > total]


def spread_join(rows: DataFrame, facts: DataFrame, key: str, hot: list | None = None) -> DataFrame:
    """rows left join facts (a row per key), although a key may hold a large share of the rows: the facts of such keys
    (`hot`, by default found by counting; few) are broadcast, so their rows stay where they are; the others meet in a
    shuffled join."""
    hot = hot_keys(rows, key) if hot is None else hot
    if not hot:
        return rows.join(facts, key, "left")
    kind = facts.schema[key].dataType.simpleString()
    keys = F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in hot], f"{key} {kind}"))
    known = F.broadcast(facts.join(keys, key, "left_semi"))
    return rows.join(keys, key, "left_anti").join(facts, key, "left").unionByName(rows.join(keys, key, "left_semi").join(known, key, "left"))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of, F.lit(0))


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, below: int = 1 << 53) -> DataFrame:
    """vec_id, x (array of long: each entry times scale, rounded down), dim, of the vectors that aren't null and hold no
    null or non-finite entry. An entry that isn't smaller than `below` stops the query."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("v is not null")
    sound = ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform("v", lambda c: F.lit(float(scale)) * c.cast("double"))
    large = F.raise_error(F.lit(f"an entry of a vector, times {scale}, is {below} or more in size")).cast("long")
    return rows.where(F.coalesce(sound, F.lit(True))).select("vec_id", F.transform(scaled, lambda c: F.when(F.abs(c) < below, F.floor(c)).otherwise(large)).alias("x"), F.size("v").alias("dim"))


def matrix_of(lists: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def tidy(run):
    """run, a function of a task's batches, whose worker gives memory back to the system at its end: Python, Arrow and the
    C library keep what they have freed, and a reused worker would hold the most that any stage before has needed."""

    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return wrapped


class Memo(dict):
    """A dict that computes what it lacks, and starts anew when it holds `most` entries."""

    def __init__(self, compute, most: int = 300_000):
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.compute(key)
        return value
