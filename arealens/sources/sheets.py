"""Published workbooks as a landing table of sheet rows.

``sheet_rows(source_url, sheet_name, sheet_no, row_no, cells array<string>)``
holds every row of every sheet of every publication; ``(source_url,
sheet_no, row_no)`` is its key (a publication is landed once - the freshness
gate decides which links to fetch).  Positions are explicit (``row_no``,
array index), so nothing depends on row order.  A sheet's header
is the row after ``skip`` title rows; body rows follow it.

The header is kept as *one row per sheet* holding the whole header array;
``sheet_layout`` resolves its labels there once (positions of the id
columns, positions of the value columns).  Joining that relation to the body
rows attaches the layout without exploding the header, and it is tiny (one
row per sheet), so it is broadcast after a size probe: no shuffle of the
body, and no skew when one sheet or publication holds most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.operators.selection import bounded_broadcast, staged
from arealens.schemas import SHEET_ROWS

SHEET_KEY = ["source_url", "sheet_no"]


def read_sheet_rows(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """The landing table at ``path`` with its declared schema (no inference,
    so listing a large landing folder does not read file footers for it)."""
    return spark.read.schema(SHEET_ROWS).format(fmt).load(path)


def pick_sheets(sheet_rows: DataFrame, name_contains: str | None = None,
                name_equals: str | None = None, sheet_nos=None,
                url_pattern: str | None = None) -> DataFrame:
    """Choose sheets by case-sensitive substring of the name, exact name, or
    ordinal, and optionally publications by a URL regex."""
    df = sheet_rows
    if url_pattern is not None:
        df = df.filter(F.col("source_url").rlike(url_pattern))
    if name_contains is not None:
        df = df.filter(F.col("sheet_name").contains(name_contains))
    if name_equals is not None:
        df = df.filter(F.col("sheet_name") == name_equals)
    if sheet_nos is not None:
        df = df.filter(F.col("sheet_no").isin(list(sheet_nos)))
    return df


def sheets_per_source(sheet_rows: DataFrame) -> DataFrame:
    """(source_url, n_sheets): a sheet pattern must pick exactly one sheet per
    publication; rows with ``n_sheets != 1`` are ambiguous picks."""
    return sheet_rows.groupBy("source_url").agg(F.countDistinct("sheet_no").alias("n_sheets"))


def landing_key_violations(sheet_rows: DataFrame) -> DataFrame:
    """(source_url, sheet_no, row_no, n) for keys landed more than once - a
    diagnostic to run on demand (one shuffle over the landing table)."""
    return (sheet_rows.groupBy(*SHEET_KEY, "row_no").agg(F.count(F.lit(1)).alias("n"))
                      .filter(F.col("n") > 1))


def header_rows(sheet_rows: DataFrame, skip: int) -> DataFrame:
    """(source_url, sheet_no, header) - the row right after ``skip`` title rows."""
    return (sheet_rows.filter(F.col("row_no") == skip + 1)
                      .select(*SHEET_KEY, F.col("cells").alias("header")))


def body_rows(sheet_rows: DataFrame, skip: int) -> DataFrame:
    """Rows below the header."""
    return sheet_rows.filter(F.col("row_no") > skip + 1)


def sheet_table(sheet_rows: DataFrame, skip: int, header: DataFrame | None = None) -> DataFrame:
    """Body rows with their sheet's header array attached (column ``header``,
    or whatever per-sheet columns ``header`` carries).  The header side is
    staged, so the landing table is read once for it and once for the body."""
    hdr = header_rows(sheet_rows, skip) if header is None else header
    return body_rows(sheet_rows, skip).join(bounded_broadcast(staged(hdr)), SHEET_KEY, "inner")


def sheet_layout(sheet_rows: DataFrame, skip: int, id_names) -> DataFrame:
    """(source_url, sheet_no, id_pos, value_cols), one row per sheet.

    ``id_pos[k]`` is the 1-based position of ``id_names[k]`` in the header
    (0 when absent); ``value_cols`` lists (series, pos) for every other header
    position.  Resolving labels here - with array functions on a relation of
    one row per sheet - leaves body rows with plain positional lookups, which
    stay inside whole-stage code generation.
    """
    ids = list(id_names)
    cols = F.transform(F.col("header"), lambda h, i: F.struct(
        h.alias("series"), (i + 1).cast("int").alias("pos")))
    value_cols = F.filter(cols, lambda z: z["series"].isNull() | ~z["series"].isin(ids))
    id_pos = F.array(*[F.array_position(F.col("header"), F.lit(n)).cast("int") for n in ids]) \
        if ids else F.array().cast("array<int>")
    return header_rows(sheet_rows, skip).select(*SHEET_KEY, id_pos.alias("id_pos"),
                                                value_cols.alias("value_cols"))


def id_cell(k: int) -> F.Column:
    """Cell of the k-th id column (0-based, as given to ``sheet_layout``)."""
    pos = F.element_at(F.col("id_pos"), k + 1)
    return F.when(pos > 0, F.try_element_at(F.col("cells"), pos))


def explode_values(df: DataFrame, keep_cols) -> DataFrame:
    """Rows of a ``sheet_table(.., layout)`` times their value columns:
    ``keep_cols`` + (series, value).  NULL cells are kept; a header position
    beyond the row's cells gives NULL."""
    z = df.select(*keep_cols, "cells", F.explode("value_cols").alias("_z"))
    return z.select(*keep_cols, F.col("_z.series").alias("series"),
                    F.try_element_at(F.col("cells"), F.col("_z.pos")).alias("value"))
