"""Quarterly rental report workbooks -> long tables by LGA or suburb.

Each workbook has seven sheets (one per dwelling type).  Its header row pairs
columns: a period label ("Sep 2021") over a count column, then a blank-headed
median column.  Cleaning the header gives names such as ``sep_2021`` and
``x4``; a blank-headed ``x<n>`` column takes the period of the column to its
left and is the median series.

All of that is resolved on the header relation - one row per sheet, the
period of every value column computed with array functions - and the
current-period filter is applied there too, so only the current columns of
each body row are exploded.  Body rows meet the header through a
size-checked broadcast join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.period import (RENTAL_PERIOD_PATTERN, expand_header_month,
                                       extract_period, fix_header_typos, period_to_date,
                                       title_case)
from arealens.functions.text import clean_header_names, lenient_number
from arealens.operators.selection import bounded_broadcast, dealt, staged
from arealens.sources.sheets import SHEET_KEY, body_rows, header_rows, pick_sheets

# --- Fixed values: workbook layout, dwelling types by sheet, series names. --
RENTAL_SKIP = 1
DWELLING_TYPES = {1: "1 bedroom flat", 2: "2 bedroom flat", 3: "3 bedroom flat",
                  4: "2 bedroom house", 5: "3 bedroom house", 6: "4 bedroom house",
                  7: "All properties"}
RENTAL_GEOGRAPHIES = {"lga": {"url": "quarterly", "remnant": "LGA"},
                      "suburb": {"url": "suburb", "remnant": "Suburb"}}
SUBTOTAL = "Group Total"
COUNT_SERIES = "No. New Lettings"
MEDIAN_SERIES = "Moving Annual Median"
AREA_COLUMN = "x2"
FIRST_VALUE_POSITION = 3
# ---------------------------------------------------------------------------


def rental_period(url) -> F.Column:
    """"...December-quarter-2021..." -> "December 2021"."""
    p = F.lower(F.regexp_replace(extract_period(url, RENTAL_PERIOD_PATTERN), "quarter-", ""))
    return F.regexp_replace(title_case(p), "^([^-]*)-", "$1 ")


def rental_header(sheet_rows: DataFrame, skip: int = RENTAL_SKIP) -> DataFrame:
    """(source_url, sheet_no, names, columns): ``columns`` is an array of
    (pos, quarter, series, month_date) for every value column of the sheet."""
    h = header_rows(sheet_rows, skip).withColumn("names", clean_header_names("header"))
    names = F.col("names")

    def column(n, i):
        pos = i + 1
        is_x = n.rlike("^x[0-9]+$")
        left = F.when(pos > FIRST_VALUE_POSITION, F.try_element_at(names, i.cast("int")))
        label = F.when(is_x, left).otherwise(n)
        quarter = fix_header_typos(expand_header_month(label))
        return F.struct(pos.cast("int").alias("pos"), quarter.alias("quarter"),
                        F.when(is_x, F.lit(MEDIAN_SERIES)).otherwise(F.lit(COUNT_SERIES)).alias("series"),
                        period_to_date(quarter).alias("month_date"))

    cols = F.filter(F.transform(names, column), lambda c: c["pos"] >= FIRST_VALUE_POSITION)
    return h.select(*SHEET_KEY, "names", cols.alias("columns"))


def _geographies() -> F.Column:
    """Geographies that a workbook's URL names."""
    return F.filter(F.array(*[F.when(F.col("source_url").rlike(g["url"]), F.lit(name))
                              for name, g in RENTAL_GEOGRAPHIES.items()]),
                    lambda x: x.isNotNull())


def rental_quarantine(sheet_rows: DataFrame) -> DataFrame:
    """(source_url, sheet_no, reason) of rental sheets that a load can't place:
    ``no period`` in the file name, ``no area column``, or no column of the
    publication's own period (``no current column``).  Read from header rows."""
    h = rental_header(pick_sheets(sheet_rows, sheet_nos=list(DWELLING_TYPES))).filter(F.size(_geographies()) > 0)
    period = rental_period("source_url")
    faults = F.filter(F.array(
        F.when(period.isNull(), F.lit("no period")),
        F.when(~F.array_contains("names", AREA_COLUMN), F.lit("no area column")),
        F.when(period.isNotNull() & ~F.exists("columns", lambda c: F.coalesce(c["quarter"] == period, F.lit(False))),
               F.lit("no current column"))), lambda x: x.isNotNull())
    return h.select(*SHEET_KEY, F.explode(faults).alias("reason"))


def load_rental_all(sheet_rows: DataFrame, current_only: bool = True, with_source: bool = False,
                    rows: int | None = None) -> DataFrame:
    """Both geographies in one plan (one scan of the landing table):
    (geography, area, value, quarter, series, dwelling_type, month_date),
    distinct; ``with_source`` adds ``source_url``.  A workbook's geography comes from its URL (resolved once per
    sheet on the header side); a URL naming both is loaded for both.  ``rows``: about how many
    rows the landing table has, where the caller knows; the tasks of the DISTINCT are sized
    by it, as counting a derived table would build it once more."""
    picked = pick_sheets(sheet_rows, sheet_nos=list(DWELLING_TYPES))
    remnant = F.create_map(*[x for name, g in RENTAL_GEOGRAPHIES.items()
                             for x in (F.lit(name), F.lit(g["remnant"]))])
    hdr = (rental_header(picked)
           .withColumn("geography", F.explode(_geographies()))
           .withColumn("remnant", remnant[F.col("geography")])
           .withColumn("period", rental_period("source_url")))
    if current_only:
        hdr = hdr.withColumn("columns", F.filter("columns", lambda c: c["quarter"] == F.col("period")))
    t = body_rows(picked, RENTAL_SKIP).join(bounded_broadcast(staged(hdr)), SHEET_KEY, "inner")
    area_pos = F.array_position("names", F.lit(AREA_COLUMN)).cast("int")
    area = F.when(area_pos > 0, F.try_element_at(F.col("cells"), area_pos))
    t = (t.withColumn("area", area)
          .filter(F.col("area").isNotNull())
          .filter((F.col("area") != SUBTOTAL) & (F.col("area") != F.col("remnant"))))
    dwelling = F.create_map(*[x for k, v in DWELLING_TYPES.items() for x in (F.lit(k), F.lit(v))])
    source = ["source_url"] if with_source else []
    long = t.select(*source, "geography", "area", "cells", dwelling[F.col("sheet_no")].alias("dwelling_type"),
                    F.explode("columns").alias("c"))
    # month_date is a function of quarter, so it can ride along in the DISTINCT
    out = long.select(*source, "geography", "area",
                      lenient_number(F.try_element_at(F.col("cells"), F.col("c.pos"))).alias("value"),
                      F.col("c.quarter").alias("quarter"), F.col("c.series").alias("series"),
                      "dwelling_type", F.col("c.month_date").alias("month_date"))
    # a row has a count and a median of its own period
    return dealt(out, *out.columns, rows=2 * (rows or 0)).distinct()


def load_rental(sheet_rows: DataFrame, geography: str = "lga",
                current_only: bool = True, with_source: bool = False, rows: int | None = None) -> DataFrame:
    """(lga|suburb, value, quarter, series, dwelling_type, month_date) of the
    publication's own period (all periods with ``current_only=False``),
    distinct.  The geography filter reaches the header side of the plan."""
    if geography not in RENTAL_GEOGRAPHIES:
        raise ValueError("geography should be one of " + ", ".join(RENTAL_GEOGRAPHIES))
    return one_rental_geography(load_rental_all(sheet_rows, current_only, with_source, rows), geography)


def one_rental_geography(every: DataFrame, geography: str) -> DataFrame:
    """One geography's rows of ``load_rental_all``, named as its stored table."""
    source = [c for c in ("source_url",) if c in every.columns]
    return (every.filter(F.col("geography") == geography)
            .select(*source, F.col("area").alias(geography), "value", "quarter", "series", "dwelling_type",
                    "month_date"))
