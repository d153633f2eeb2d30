"""Load new publications from a landing folder, once per schedule tick.

The landing folder receives ``sheet_rows`` Parquet files as publications are
fetched, each publication as one file (``write_publication``).  The stream
batches by file, and a sheet's body rows are matched to its header row within
a batch, so a publication must not be split across files.  A file-source stream with ``trigger(availableNow=True)`` processes
every file not seen before and stops; its checkpoint (under the cluster's
``spark.checkpoint.dir``) remembers which files were loaded, so a scheduler
can simply start it again.

Rows that were landed before, under whatever file name, are dropped by keyed
state of the stream (``source_url``, ``sheet_no``, ``row_no``), which its
checkpoint keeps as well.  Each micro-batch is cleaned by the given plan and
written as a load of its own (``sources.store``) whose id is the stream's name
and the batch's number: a batch replayed after a failure writes the same
folders again.  No batch reads the stored table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arealens.operators.selection import staged
from arealens.schemas import SHEET_ROWS
from arealens.session import checkpoint_dir
from arealens.sources.store import write_load
from arealens.sources.tables import SOURCE_COLUMN

LANDING_KEY = ["source_url", "sheet_no", "row_no"]


def write_publication(rows: DataFrame, landing_dir: str, name: str, max_rows: int = 1_000_000) -> None:
    """Land one publication's ``sheet_rows`` as a single Parquet file (a
    publication is a few thousand rows), so no micro-batch ever holds part of
    a sheet.  More than ``max_rows`` rows are no publication: ValueError."""
    if rows.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"{name!r} has more than {max_rows} rows; land publications one by one")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{landing_dir}/{name}")


def sheets_without_header(batch: DataFrame, header_row: int) -> DataFrame:
    """(source_url, sheet_no) of sheets present in ``batch`` whose header row
    (``row_no == header_row``) is not in it."""
    return (batch.groupBy("source_url", "sheet_no")
                 .agg(F.max((F.col("row_no") == header_row).cast("int")).alias("has_header"))
                 .filter(F.col("has_header") == 0))


def incremental_load(spark: SparkSession, landing_dir: str, plan: Callable[[DataFrame], DataFrame],
                     sink_path: str, name: str, header_row: int, period_col: str = "month_date",
                     max_files_per_trigger: int | None = None, by=(),
                     quarantine: str | None = None, keep_state: str | None = None) -> StreamingQuery:
    """Start the stream; call ``awaitTermination()`` on the result to wait
    until every available file is loaded.

    ``sink_path`` is ``<store>/<table>``; ``sources.store.read_loads`` reads it.
    ``plan``'s rows carry ``source_url`` and ``period_col``; with ``by`` they
    carry those columns too (``geography``).  The result is the same whether
    ``max_files_per_trigger`` bounds the batches or not.  ``header_row`` is the
    plan's ``skip + 1``: a sheet whose header row is not in its batch fails the
    batch, so its files stay unprocessed instead of losing body rows.  Rows
    without a period go to ``quarantine`` or fail the batch.

    State holds the key of every landed row; ``keep_state`` (such as "90 days",
    by the files' modification time) bounds it where publications land again
    only within that time.  What lands again later is still kept out of the
    table by the ledger, a publication at a time."""
    store, table = sink_path.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.schema(SHEET_ROWS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(landing_dir)
    if keep_state:
        rows = (rows.withColumn("landed_at", F.col("_metadata.file_modification_time"))
                    .withWatermark("landed_at", keep_state).dropDuplicatesWithinWatermark(LANDING_KEY)
                    .drop("landed_at"))
    else:
        rows = rows.dropDuplicates(LANDING_KEY)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = staged(batch)
        if not sheets_without_header(batch, header_row).isEmpty():
            raise ValueError(f"batch {epoch_id}: a sheet's header row is in another file; "
                             "land each publication as one file")
        out = plan(batch)
        if SOURCE_COLUMN not in out.columns:
            raise ValueError(f"the plan's rows need {SOURCE_COLUMN}: loads of one period by several files "
                             "can't be told apart without it")
        write_load({table: out.withColumnRenamed(period_col, "month_date")}, store,
                   load_id=f"stream-{name}-{epoch_id}", quarantine=quarantine)

    location = f"{checkpoint_dir(spark)}/streams/{name}"
    return (rows.writeStream.foreachBatch(load_batch)
                .option("checkpointLocation", location)
                .trigger(availableNow=True)
                .start())
