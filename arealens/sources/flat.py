"""Flat files as a landing table: delimited text with title rows above its header.

A flat file is split like any text file, so a line's number is not known where
it is read.  It is put together from three parts: the file, the line's place
within its split (lines of a split are read in order), and the lines of the
splits before it, a prefix sum over one count per split.  Title rows are then
skipped by row number, as in workbooks, and no file is read by one task as a
whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealens.operators.selection import bounded_broadcast, staged


def numbered_lines(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """(file, row_no, line) of the text files under ``path``; ``row_no`` counts from 1
    within a file.  ``suffix`` (such as ".csv") limits the files."""
    reader = spark.read
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
    lines = staged(reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")))
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(bounded_broadcast(staged(splits)), ["file", "block"]).select(
        "file", (F.col("before") + F.col("at") - F.col("first") + 1).cast("int").alias("row_no"), "line")


def line_cells(line, delimiter: str = ",") -> F.Column:
    """Cells of a delimited line: quoted cells may hold the delimiter and doubled
    quotes; empty unquoted cells are NULL.  A line is a record (no line breaks in cells)."""
    d = "\\" + delimiter if not delimiter.isalnum() else delimiter
    # every cell is read with the delimiter before it, so the first one gets one too
    pattern = rf'{d}(?:"((?:[^"]|"")*+)"|([^{d}]*+))'
    col = F.col(line) if isinstance(line, str) else line
    whole = F.regexp_extract_all(F.concat(F.lit(delimiter), col), F.lit(pattern), F.lit(0))

    def cell(text: F.Column) -> F.Column:
        raw = F.substring(text, F.lit(2), F.length(text))
        quoted = raw.startswith('"') & raw.endswith('"') & (F.length(raw) > 1)
        return (F.when(quoted, F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"')))
                 .when(raw != "", raw))

    return F.transform(whole, cell)


def read_flat_sheets(spark: SparkSession, path: str, delimiter: str = ",", suffix: str | None = None,
                     source_url=None, sheet_name=None) -> DataFrame:
    """``sheet_rows`` of the delimited text files under ``path``, one sheet per file.

    ``source_url`` and ``sheet_name`` are Columns computed from ``file``; by
    default the file's path and its name without the ending."""
    lines = numbered_lines(spark, path, suffix)
    name = F.regexp_extract("file", r"([^/]*?)(?:\.[^./]*)?$", 1)
    return lines.select(F.col("file").alias("source_url") if source_url is None else source_url.alias("source_url"),
                        (name if sheet_name is None else sheet_name).alias("sheet_name"), F.lit(1).alias("sheet_no"),
                        "row_no", line_cells("line", delimiter).alias("cells"))
