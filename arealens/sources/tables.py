"""Stored tables: read by name or path, append by period partition."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.operators.gate import new_periods_only
from arealens.operators.selection import staged


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by catalog name ("dss.payment_types_qrt_pc") or by path
    (anything containing "/")."""
    if "/" in name:
        return spark.read.format(fmt).load(name)
    return spark.table(name)


def clustered(df: DataFrame, by, partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted on ``by`` (a list of columns), so
    each written file covers a narrow key range and Parquet min/max
    statistics let a filter such as ``block_id IN (...)`` skip row groups.
    List a tie-breaking column after the main key: range partitioning then
    splits one hot key over several tasks instead of one."""
    cols = [by] if isinstance(by, str) else list(by)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def write_clustered(df: DataFrame, path: str, by, mode: str = "overwrite",
                    partitions: int | None = None, fmt: str = "parquet") -> None:
    """Store a lookup table (e.g. a concordance by ``["block_id", "sa1_7dig"]``)
    clustered for row-group pruning."""
    clustered(df, by, partitions).write.mode(mode).format(fmt).save(path)


def write_bucketed(df: DataFrame, name: str, keys, buckets: int, mode: str = "overwrite") -> None:
    """Store ``df`` as the catalog table ``name`` in ``buckets`` buckets of ``keys``, sorted on them.

    Two tables bucketed alike on all the columns of a join (a concordance and
    an area fact on area and year, say) meet without an exchange, and an
    aggregate on these columns needs none either.  Rows are
    dealt by the same hash first, so each bucket is one file."""
    cols = [keys] if isinstance(keys, str) else list(keys)
    (df.repartition(buckets, *cols).write.mode(mode).format("parquet")
       .bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(name))


def newest_partition(spark: SparkSession, name: str, period_col: str = "month_date") -> DataFrame:
    """One row with the newest period of a table partitioned by it.  Only the
    partition column is read, so no data page is: the values come from the
    folders, and row groups give their counts."""
    stored = read_table(spark, name)
    return stored.select(period_col).agg(F.max(period_col).alias(period_col))


#: Column naming the publication a row came from; part of a load's key where present.
SOURCE_COLUMN = "source_url"
_NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_key(df: DataFrame, period_col: str, by=()) -> list[str]:
    """What makes a load's rows new: leading partitions, period and publication."""
    keys = [*([by] if isinstance(by, str) else by), period_col]
    return keys + [SOURCE_COLUMN] if SOURCE_COLUMN in df.columns and SOURCE_COLUMN not in keys else keys


def stored_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``; None only where nothing is stored there yet."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in _NOTHING_STORED:
            return None
        raise


def split_unperioded(df: DataFrame, period_col: str, quarantine: str | None, fmt: str = "parquet") -> DataFrame:
    """``df`` without rows that have no period.  They go to ``quarantine`` (a
    path); without one, their presence fails the load before anything is
    written."""
    lost = df.filter(F.col(period_col).isNull())
    if quarantine is not None:
        lost.write.mode("append").format(fmt).save(quarantine)
    elif not lost.isEmpty():
        raise ValueError(f"rows without a period in {period_col!r}; name a quarantine path to set them aside")
    return df.filter(F.col(period_col).isNotNull())


def append_table(df: DataFrame, path: str, period_col: str = "month_date",
                 only_new: bool = True, fmt: str = "parquet",
                 replace_periods: bool = False, cluster_by=(), by=(),
                 quarantine: str | None = None) -> None:
    """Append ``df`` partitioned by its period column.

    With ``only_new`` the rows whose key is already stored are removed first,
    so a re-run or a retried job after a lost executor adds nothing twice.
    The key is ``by``, the period and, where ``df`` has it, ``source_url``: a
    second publication of a period is new, a second load of the same one is
    not.  ``replace_periods`` instead rewrites exactly the periods present in
    ``df`` (dynamic partition overwrite) - for a corrected re-publication.
    Rows are range-partitioned on the partition columns (and ``cluster_by``)
    first, so each period is written as few files while a large period is
    still spread over several tasks; ``cluster_by=None`` writes them as they
    come.  ``by`` adds leading partition columns (e.g. ``["geography"]``):
    several outputs are then written by one job into one dataset.  Rows
    without a period go to ``quarantine`` or fail the load.  A stored table
    without a key column fails it too.  Spark's file commit protocol makes
    each write all-or-nothing.
    """
    partitions = [*([by] if isinstance(by, str) else by), period_col]
    spark = df.sparkSession
    # computed once: the tests below, the range sample and the write all read it
    out = split_unperioded(staged(df), period_col, quarantine, fmt)
    if only_new and not replace_periods:
        stored = stored_table(spark, path, fmt)
        if stored is not None:
            keys = load_key(df, period_col, by)
            missing = [k for k in keys if k not in stored.columns]
            if missing:
                raise ValueError(f"the stored table has no column {', '.join(missing)}")
            out = new_periods_only(out, stored, keys)
    if cluster_by is not None:
        out = clustered(out, [*partitions, *([cluster_by] if isinstance(cluster_by, str) else cluster_by)])
    write = out.write.partitionBy(*partitions).format(fmt)
    if replace_periods:
        write.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    else:
        write.mode("append").save(path)
