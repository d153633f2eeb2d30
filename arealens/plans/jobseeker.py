"""Monthly jobseeker workbook -> long table by SA2 (zeros and NULLs kept)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.period import (MONTHLY_PERIOD_PATTERN, extract_period, period_to_date,
                                       sentence_case)
from arealens.functions.text import lenient_number
from arealens.sources.sheets import (explode_values, id_cell, pick_sheets, sheet_layout,
                                     sheet_table)

# --- Fixed values: workbook layout and series names. -----------------------
JOBSEEKER_SHEET = "Table 4 - By SA2"
JOBSEEKER_SKIP = 6
JOBSEEKER_IDS = {"SA2": "sa2_5dig", "SA2 Name": "sa2_name"}
JOBSEEKER_CODE = "SA2"
JOBSEEKER_URLS = r"(?i)jobseeker"
JOBSEEKER_SERIES_RENAMES = {"Youth Allowance (other)": "Youth Allowance Payments"}
# ---------------------------------------------------------------------------


def jobseeker_month(url) -> F.Column:
    """"...-december-2021.xlsx" -> "December 2021"."""
    return F.regexp_replace(sentence_case(extract_period(url, MONTHLY_PERIOD_PATTERN)), "-", " ")


def jobseeker_quarantine(sheet_rows: DataFrame, url_pattern: str = JOBSEEKER_URLS) -> DataFrame:
    """(source_url, reason) of jobseeker publications that a load can't place:
    ``no period`` in the file name, not exactly one sheet of the fixed name
    (``no sheet``, ``several sheets``), ``no code column`` in its header row
    (or no header row), ``no series`` column.  Jobseeker publications are those
    whose file name matches ``url_pattern``.  One aggregate over their header
    rows and sheet names; body rows only count towards the sheets."""
    own = F.col("sheet_name") == JOBSEEKER_SHEET
    header = own & (F.col("row_no") == JOBSEEKER_SKIP + 1)
    found = (pick_sheets(sheet_rows, url_pattern=url_pattern).groupBy("source_url").agg(
        F.countDistinct(F.when(own, F.col("sheet_no"))).alias("sheets"),
        F.count_if(header & F.array_contains("cells", JOBSEEKER_CODE)).alias("coded"),
        F.count_if(header & (F.size(F.array_except(F.array_compact("cells"), F.array(*map(F.lit, JOBSEEKER_IDS)))) > 0))
         .alias("with_series")))
    faults = F.filter(F.array(
        F.when(period_to_date(jobseeker_month("source_url")).isNull(), F.lit("no period")),
        F.when(F.col("sheets") == 0, F.lit("no sheet")),
        F.when(F.col("sheets") > 1, F.lit("several sheets")),
        F.when((F.col("sheets") > 0) & (F.col("coded") < F.col("sheets")), F.lit("no code column")),
        F.when((F.col("sheets") > 0) & (F.col("with_series") < F.col("sheets")), F.lit("no series"))),
        lambda x: x.isNotNull())
    return found.select("source_url", F.explode(faults).alias("reason"))


def load_jobseeker(sheet_rows: DataFrame, with_source: bool = False) -> DataFrame:
    """(sa2_5dig, sa2_name, month, series, value, month_date); ``with_source``
    adds ``source_url``."""
    ids = list(JOBSEEKER_IDS)
    picked = pick_sheets(sheet_rows, name_equals=JOBSEEKER_SHEET)

    def renamed(z):
        label = z["series"]
        for old, new in JOBSEEKER_SERIES_RENAMES.items():
            label = F.when(z["series"] == old, F.lit(new)).otherwise(label)
        return F.struct(label.alias("series"), z["pos"].alias("pos"))

    # period and series names are resolved once per sheet
    layout = (sheet_layout(picked, JOBSEEKER_SKIP, ids)
              .withColumn("value_cols", F.transform("value_cols", renamed))
              .withColumn("month", jobseeker_month("source_url"))
              .withColumn("month_date", period_to_date("month")))
    rows = sheet_table(picked, JOBSEEKER_SKIP, header=layout)
    wide = rows.withColumns({n: id_cell(k) for k, n in enumerate(ids)}).filter(F.col("SA2").isNotNull())
    source = ["source_url"] if with_source else []
    long = explode_values(wide, [*source, "month", "month_date", *ids])
    return long.select(*source, *[F.col(k).alias(v) for k, v in JOBSEEKER_IDS.items()],
                       "month", "series", lenient_number("value").alias("value"), "month_date")
