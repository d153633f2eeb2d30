"""Helpers shared by the corpus operators: cut lineage, bounded broadcasts, text keys."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.operators.selection import bounded_broadcast
from arealens.session import shared_folder

PART_ROWS = 50_000  # narrow rows of a partition of ``packed``
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where it is unset in local mode."""
    return shared_folder(spark).rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """Path of a fresh sub-folder of the shared folder (not created)."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (lineage ends there)."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as ``rows`` (about its number) fill, at least one a core.

    For frames that are cut often: a checkpoint writes a file per partition,
    empty ones too, and without Hadoop's native library the executor forks for
    each file (chmod), which shows its whole memory twice for a moment.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // PART_ROWS)))


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint if ``df`` (already cut, cheap to read) has at most ``max_rows`` rows
    and no more than 64 MiB of them.

    Both bounds are checked, not estimated; a larger frame comes back without a
    hint, so the join shuffles.
    """
    return bounded_broadcast(df, max_rows)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A projected array may be inlined into a lambda by the optimizer and then be
    rebuilt for every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def prefix(values: Column, zero: Column, combine: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """For every element of an array, ``combine`` of ``zero`` and all elements before it.

    ``combine`` is associative.  Elements go in blocks: an array grows by
    appending within a block only, so the work is linear up to very long arrays.
    """
    def fold(part: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.slice(F.array(start), 1, 0).alias("out"))
        return F.aggregate(part, state, lambda acc, x: F.struct(
            combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def of(every: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(every), F.lit(block))
        totals = F.transform(starts, lambda i: F.aggregate(F.slice(every, i, block), zero, lambda a, x: combine(a, x)))
        return let(fold(totals, zero), lambda at: F.flatten(F.zip_with(
            starts, at, lambda i, before: fold(F.slice(every, i, F.lit(block)), before))))

    return let(values, lambda every: F.when(F.size(every) > 0, of(every)).otherwise(F.slice(F.array(zero), 1, 0)))


def hash_sample(df: DataFrame, rows: int, total: int, *columns: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, those with the smallest hash of ``columns``:
    the same rows whatever the partitions."""
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < F.lit(int((1 << 30) * rows / total)))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """128-bit digest that stands for a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
