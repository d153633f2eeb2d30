"""Quarterly payment-type workbooks -> long tables by SA2, LGA and postcode.

One plan melts every geography of every publication in the landing table.
Per sheet (once, on the header side): which geography the sheet serves, where
its code and name columns are, its value columns, region prefix and the
period from the file name.  Per body row: drop rows without an area code,
strip the "<" suppression marker, keep the region's codes, melt, keep
positive values, type the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from arealens.functions.period import (PAYMENT_PERIOD_PATTERN, extract_period, period_to_date,
                                       repair_period_label, sentence_case)
from arealens.functions.text import lenient_number, strip_marker
from arealens.operators.clean import keep_positive
from arealens.sources.sheets import SHEET_KEY, explode_values, id_cell, pick_sheets, sheet_table

# --- Fixed values: workbook layout. ----------------------------------------
PAYMENT_SKIP = 2
PAYMENT_GEOGRAPHIES = {
    "sa2": {"sheet": "SA", "code": "SA2", "name": "SA2 Name", "prefix": "2",
            "out_code": "sa2_5dig", "out_name": "sa2_name"},
    "lga": {"sheet": "LGA", "code": "LGA", "name": "LGA name", "prefix": "2",
            "out_code": "lga_code", "out_name": "lga_name"},
    "postcode": {"sheet": "Post", "code": "Postcode", "name": None, "prefix": "3",
                 "out_code": "postcode", "out_name": None},
}
# Series read as numbers before the all-text positivity test (text mode):
# their non-numeric cells ("n.p.") are missing values and drop out.
PAYMENT_NUMERIC_SERIES = ("Commonwealth Seniors Health Card", "Health Care Card")
# ---------------------------------------------------------------------------


def payment_period(url) -> F.Column:
    """"...dec-2019.xlsx" -> "December-2019"."""
    return repair_period_label(sentence_case(extract_period(url, PAYMENT_PERIOD_PATTERN)))


def _by_geography(field: str) -> F.Column:
    return F.create_map(*[x for name, g in PAYMENT_GEOGRAPHIES.items()
                          for x in (F.lit(name), F.lit(g[field]))])[F.col("geography")]


def payment_layout(sheet_rows: DataFrame) -> DataFrame:
    """One row per (sheet, geography) of the workbook: the geography a sheet
    serves (by its name; a name matching several serves several), positions
    of its code and name columns, its value columns, its region prefix and
    the publication period from the file name - all resolved once per sheet."""
    geos = F.filter(F.array(*[F.when(F.col("sheet_name").contains(g["sheet"]), F.lit(name))
                              for name, g in PAYMENT_GEOGRAPHIES.items()]),
                    lambda x: x.isNotNull())
    h = (sheet_rows.filter(F.col("row_no") == PAYMENT_SKIP + 1)
                   .select(*SHEET_KEY, "sheet_name", F.col("cells").alias("header"))
                   .withColumn("geography", F.explode(geos))
                   .withColumn("code_label", _by_geography("code"))
                   .withColumn("name_label", _by_geography("name")))
    id_labels = F.when(F.col("name_label").isNull(), F.array("code_label")) \
                 .otherwise(F.array("code_label", "name_label"))
    cols = F.transform(F.col("header"), lambda x, i: F.struct(
        x.alias("series"), (i + 1).cast("int").alias("pos")))
    value_cols = F.filter(cols, lambda z: z["series"].isNull() | ~F.array_contains(id_labels, z["series"]))

    def pos(label):
        return F.coalesce(F.array_position(F.col("header"), F.col(label)).cast("int"), F.lit(0))

    quarter = payment_period("source_url")
    return h.select(*SHEET_KEY, "geography", _by_geography("prefix").alias("prefix"),
                    F.array(pos("code_label"), pos("name_label")).alias("id_pos"),
                    value_cols.alias("value_cols"), quarter.alias("quarter"),
                    period_to_date(quarter).alias("month_date"))


class LoadAccount:
    """Counts of a load's cells by outcome, observed by the load's own job:
    ``load_payment_types_all(rows, account=account)``, then, after the frame was
    evaluated once, ``account.counts()``."""

    def __init__(self):
        self.rows, self.cells = Observation(), Observation()

    def observe_rows(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.rows, *[F.coalesce(F.sum(F.when(_row_outcome() == o, F.size("value_cols"))), F.lit(0))
                                          .alias(o) for o in ROW_OUTCOMES])

    def observe_cells(self, cells: DataFrame) -> DataFrame:
        return cells.observe(self.cells, *[F.count_if(_cell_outcome("cell") == o).alias(o) for o in CELL_OUTCOMES],
                             F.count_if((_cell_outcome("cell") == "kept") & F.col("cell").contains("<")).alias("marked"))

    def counts(self) -> dict[str, int]:
        """Cells per outcome; ``marked`` counts the kept ones published as "<n"."""
        return {**self.rows.get, **self.cells.get}


# Why a landed cell is not loaded: its row has no area code, or one outside the region ...
ROW_OUTCOMES = ("footnote", "other region")
# ... or the cell itself is empty, no number, or not above zero.
CELL_OUTCOMES = ("kept", "empty", "unparsed", "not positive")


def _row_outcome() -> F.Column:
    return (F.when(F.col("code").isNull(), F.lit("footnote"))
             .when(~F.col("code").startswith(F.col("prefix")), F.lit("other region")))


def _cell_outcome(cell: str) -> F.Column:
    number = lenient_number(strip_marker(cell))
    return (F.when(F.col(cell).isNull(), F.lit("empty")).when(number.isNull(), F.lit("unparsed"))
             .when(number > 0, F.lit("kept")).otherwise(F.lit("not positive")))


def _payment_rows(sheet_rows: DataFrame) -> DataFrame:
    rows = sheet_table(sheet_rows, PAYMENT_SKIP, header=payment_layout(sheet_rows))
    return rows.withColumn("code", strip_marker(id_cell(0))).withColumn("name", strip_marker(id_cell(1)))


def payment_account(sheet_rows: DataFrame) -> DataFrame:
    """(source_url, geography, landed, kept, marked, footnote, other_region, empty,
    unparsed, not_positive): the cells of every publication by what a load
    does with them; ``landed`` is the sum of ``kept`` and all reasons, and
    ``marked`` counts the kept cells published as "<n".  One pass: a row that is
    left out as a whole is one row of the aggregate, weighted by its cells."""
    whole = F.array(F.struct(_row_outcome().alias("outcome"), F.size("value_cols").alias("n"), F.lit(None).cast("string").alias("cell")))
    single = F.transform("value_cols", lambda z: F.struct(
        F.lit(None).cast("string").alias("outcome"), F.lit(1).alias("n"), F.try_element_at(F.col("cells"), z["pos"]).alias("cell")))
    x = (_payment_rows(sheet_rows).select("source_url", "geography", F.explode(F.when(_row_outcome().isNotNull(), whole).otherwise(single)).alias("z"))
         .select("source_url", "geography", "z.n", "z.cell", F.coalesce("z.outcome", _cell_outcome("z.cell")).alias("outcome")))

    def cells(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    return x.groupBy("source_url", "geography").agg(
        F.sum("n").alias("landed"), cells(F.col("outcome") == "kept").alias("kept"),
        cells((F.col("outcome") == "kept") & F.col("cell").contains("<")).alias("marked"),
        *[cells(F.col("outcome") == o).alias(o.replace(" ", "_")) for o in (*ROW_OUTCOMES, *CELL_OUTCOMES[1:])])


def load_payment_types_all(sheet_rows: DataFrame, compare: str = "numeric", with_source: bool = False,
                           account: LoadAccount | None = None) -> DataFrame:
    """Every geography of every publication in one plan:
    (geography, code, name, quarter, series, value, month_date);
    ``with_source`` adds ``source_url``; ``account`` observes in the same job
    what becomes of every landed cell (numeric positivity)."""
    source = ["source_url"] if with_source else []
    rows = _payment_rows(sheet_rows)
    if account is not None:
        rows = account.observe_rows(rows)
    wide = rows.filter(F.col("code").isNotNull()).filter(F.col("code").startswith(F.col("prefix")))
    long = explode_values(wide, [*source, "geography", "quarter", "month_date", "code", "name"])
    if account is not None:
        long = account.observe_cells(long.withColumn("cell", F.col("value")))
    long = long.withColumn("value", strip_marker("value"))
    if compare == "text":
        long = long.filter(~F.col("series").isin(list(PAYMENT_NUMERIC_SERIES))
                           | lenient_number("value").isNotNull())
    long = keep_positive(long, "value", compare)
    return long.select(*source, "geography", "code", "name", "quarter", "series",
                       lenient_number("value").alias("value"), "month_date")


def load_payment_types(sheet_rows: DataFrame, geography: str = "sa2",
                       compare: str = "numeric", with_source: bool = False) -> DataFrame:
    """Long rows (code[, name], quarter, series, value, month_date) of one
    geography, named as its stored table.  ``compare="text"`` keeps the
    all-text positivity test of the original load (see ``keep_positive``).
    The geography filter reaches the per-sheet layout side of the plan."""
    if geography not in PAYMENT_GEOGRAPHIES:
        raise ValueError("geography should be one of " + ", ".join(PAYMENT_GEOGRAPHIES))
    # only sheets whose name can serve this geography; drops the others' rows at the scan
    picked = pick_sheets(sheet_rows, name_contains=PAYMENT_GEOGRAPHIES[geography]["sheet"])
    return one_payment_geography(load_payment_types_all(picked, compare, with_source), geography)


def one_payment_geography(every: DataFrame, geography: str) -> DataFrame:
    """One geography's rows of ``load_payment_types_all``, named as its stored table."""
    g = PAYMENT_GEOGRAPHIES[geography]
    source = [c for c in ("source_url",) if c in every.columns]
    return every.filter(F.col("geography") == geography).select(
        *source, F.col("code").alias(g["out_code"]), *([F.col("name").alias(g["out_name"])] if g["name"] else []),
        "quarter", "series", "value", "month_date")


def payment_quarantine(sheet_rows: DataFrame) -> DataFrame:
    """(source_url, geography, reason) of what a load can't place: ``no period``
    in the file name, not exactly one sheet (``no sheet``, ``several sheets``),
    ``no code column``.  Publications without any of the workbook's sheets are
    not payment-type ones.  Read from header rows only."""
    layout = payment_layout(sheet_rows).select(
        "source_url", "geography", "sheet_no", (F.element_at("id_pos", 1) == 0).cast("int").alias("no_code"))
    found = layout.groupBy("source_url", "geography").agg(F.countDistinct("sheet_no").alias("sheets"),
                                                          F.max("no_code").alias("no_code"))
    per_source = found.groupBy("source_url").agg(F.map_from_entries(F.collect_list(F.struct(
        "geography", F.struct("sheets", "no_code")))).alias("found"))   # at most one entry per geography
    names = F.array(*[F.lit(g) for g in PAYMENT_GEOGRAPHIES])
    wanted = (per_source.select("source_url", period_to_date(payment_period("source_url")).alias("month_date"),
                                "found", F.explode(names).alias("geography"))
              .withColumn("_f", F.try_element_at("found", F.col("geography")))
              .select("source_url", "geography", "month_date", "_f.sheets", "_f.no_code"))
    faults = F.filter(F.array(
        F.when(F.col("month_date").isNull(), F.lit("no period")),
        F.when(F.col("sheets").isNull(), F.lit("no sheet")),
        F.when(F.col("sheets") > 1, F.lit("several sheets")),
        F.when(F.col("no_code") == 1, F.lit("no code column"))), lambda x: x.isNotNull())
    return wanted.select("source_url", "geography", F.explode(faults).alias("reason"))
