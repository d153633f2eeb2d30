"""Loads as folders, and a ledger as their commit record.

``<store>/<table>/load_id=<id>/<period>=<date>/`` holds the rows that one load
added to one table.  ``<store>/ledger/load_id=<id>/`` holds one small file: a
row per table, geography, period and publication of that load, with the number
of rows and their total.  It is written last, in one commit, so

* the tables of a load become visible together, or not at all: a reader takes
  the folders that the ledger names;
* what is loaded already, the newest period and how much there is are answered
  from the ledger, without a scan of the facts;
* of several publications of a period the last one counts, whatever the order
  in which they were loaded; the earlier ones stay readable.

A load that is run again under its own id writes the same folders again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.functions.period import publication_order, revision_sql
from arealens.operators.gate import new_periods_only
from arealens.operators.selection import bounded_broadcast, staged
from arealens.sources.tables import SOURCE_COLUMN, clustered, split_unperioded

LEDGER = "ledger"
LEDGER_SCHEMA = ("load_id string, table_name string, geography string, month_date date, source_url string, "
                 "rows long, total decimal(38,6)")
PERIOD = "month_date"
_KEY = ["table_name", "geography", PERIOD, SOURCE_COLUMN]
_NOTHING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_LOAD_ID = re.compile(r"[A-Za-z][\w.-]*")  # never read as a number or date from a folder name


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """The ledger's rows; empty where nothing is loaded yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{store}/{LEDGER}")
    except AnalysisException as e:
        if e.getCondition() in _NOTHING:
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def committed(entries: DataFrame, publications: str = "latest") -> DataFrame:
    """(table_name, geography, month_date, source_url, load_id) that readers see.

    ``publications="latest"``: the last publication of every period;
    ``"all"``: every publication.  One that two loads added is taken once."""
    once = entries.groupBy(*_KEY).agg(F.max("load_id").alias("load_id"))
    if publications == "all":
        return once
    if publications != "latest":
        raise ValueError("publications should be 'latest' or 'all'")
    last = F.max(F.struct(publication_order(SOURCE_COLUMN).alias("o"), SOURCE_COLUMN, "load_id")).alias("w")
    return (once.groupBy("table_name", "geography", PERIOD).agg(last)
                .select("table_name", "geography", PERIOD, f"w.{SOURCE_COLUMN}", "w.load_id"))


def read_loads(spark: SparkSession, store: str, table: str, publications: str = "latest",
               load_ids: bool = False) -> DataFrame:
    """Rows of a stored table that are visible: loads the ledger names, and of a
    period's publications the last one (or all).  The visible keys are a small
    broadcast that also prunes load folders and periods."""
    keys = committed(ledger(spark, store).filter(F.col("table_name") == table), publications)
    facts = spark.read.parquet(f"{store}/{table}")
    on = [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (PERIOD, SOURCE_COLUMN, "load_id")]
    if "geography" in facts.columns:
        on.append(F.col("f.geography").eqNullSafe(F.col("k.geography")))
    rows = facts.alias("f").join(bounded_broadcast(keys).alias("k"), on, "left_semi")
    return rows if load_ids else rows.drop("load_id")


def newest_loaded(spark: SparkSession, store: str, table: str) -> DataFrame:
    """One row (month_date): the newest period of a stored table, from the ledger alone."""
    return ledger(spark, store).filter(F.col("table_name") == table).agg(F.max(PERIOD).alias(PERIOD))


def not_loaded(df: DataFrame, store: str, table: str, load_id: str | None = None) -> DataFrame:
    """Rows of publications and periods that ``table`` does not hold yet, by the
    ledger alone; entries of ``load_id`` itself don't count (a load that runs again)."""
    entries = ledger(df.sparkSession, store).filter(F.col("table_name") == table)
    if load_id is not None:
        entries = entries.filter(F.col("load_id") != load_id)
    keys = [c for c in ("geography", PERIOD, SOURCE_COLUMN) if c in df.columns]
    return new_periods_only(df, entries, keys)


def write_load(outputs: Mapping[str, DataFrame], store: str, load_id: str | None = None,
               measure: str = "value", quarantine: str | None = None) -> dict[str, DataFrame]:
    """Add every output's new rows to its table and make them visible together.

    ``outputs`` maps table names to rows with ``month_date`` and ``source_url``
    (and optionally ``geography``).  Rows of publications that a table already
    has are left out; rows without a period go to ``quarantine`` or fail the
    load before anything is recorded.  Every output is evaluated once.  Returns
    the rows added."""
    load_id = load_id or f"load-{uuid.uuid4().hex}"
    if not _LOAD_ID.fullmatch(load_id):
        raise ValueError(f"a load's id starts with a letter and holds letters, digits, '.', '_' and '-': {load_id!r}")
    added, entries = {}, []
    for table, df in outputs.items():
        if missing := {PERIOD, SOURCE_COLUMN} - set(df.columns):
            raise ValueError(f"the rows for {table} have no column {', '.join(sorted(missing))}")
        new = split_unperioded(staged(not_loaded(df, store, table, load_id)), PERIOD, quarantine)
        path = f"{store}/{table}/load_id={load_id}"
        by = [c for c in ("geography", PERIOD) if c in df.columns]
        clustered(new, [*by, SOURCE_COLUMN]).write.mode("overwrite").partitionBy(PERIOD).parquet(path)
        geography = F.col("geography") if "geography" in df.columns else F.lit(None).cast("string")
        entries.append(new.groupBy(F.lit(table).alias("table_name"), geography.alias("geography"), PERIOD, SOURCE_COLUMN)
                          .agg(F.count(F.lit(1)).alias("rows"),
                               F.sum(F.col(measure).cast("decimal(28,6)")).alias("total")))
        added[table] = new
    record = entries[0]
    for more in entries[1:]:
        record = record.unionByName(more)
    # one file, renamed into place when the job commits: the load's single point of visibility
    record.coalesce(1).write.mode("overwrite").parquet(f"{store}/{LEDGER}/load_id={load_id}")
    return added


def create_view(spark: SparkSession, name: str, store: str, table: str, columns) -> None:
    """A catalog view of a stored table's visible rows (last publications), under ``name``."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; loads are read through a view of that name")
    wanted = ", ".join(f"f.`{c}`" for c in columns)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT {wanted} FROM parquet.`{store}/{table}` f LEFT SEMI JOIN (
          SELECT {PERIOD}, max(struct({revision_sql(SOURCE_COLUMN)} AS revision, {SOURCE_COLUMN}, load_id)) AS w
          FROM parquet.`{store}/{LEDGER}` WHERE table_name = '{table}' GROUP BY {PERIOD}) k
        ON f.{PERIOD} <=> k.{PERIOD} AND f.load_id <=> k.w.load_id AND f.{SOURCE_COLUMN} <=> k.w.{SOURCE_COLUMN}""")
