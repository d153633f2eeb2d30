"""Name-resolved entry points: the area queries and loads by table name.

Tables are looked up by their schema-qualified names - in ``tables`` (a
mapping name -> DataFrame) when given, else in the session catalog with
``spark.table`` - so callers pass a block list and a table name, and the
table name may be chosen at run time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from arealens.operators.area import (AREA_SERIES_SPECS, apportioned_distribution, area_series,
                                     unknown_series, weighted_index)
from arealens.operators.gate import new_periods_only
from arealens.plans.jobseeker import jobseeker_quarantine, load_jobseeker
from arealens.operators.selection import staged
from arealens.plans.payment_types import (load_payment_types_all, one_payment_geography,
                                          payment_quarantine)
from arealens.plans.rental import load_rental_all, one_rental_geography, rental_quarantine
from arealens.sources.store import create_view, ledger, write_load
from arealens.sources.tables import SOURCE_COLUMN, load_key, split_unperioded

# --- Fixed values: stored table names. -------------------------------------
CONCORD_SA1 = "concord.cbsa1mb"
CONCORD_SA2 = "concord.cbsa2"
CONCORD_POSTCODE = "concord.cbpostcodes"
INCOME_TABLE = "sa1_tb_hh_equivalised_income"      # in schema "abs"
SEIFA_TABLE = "sa1_seifa"                          # in schema "abs"
SERIES_SCHEMAS = {"jobseeker_monthly_payments_sa2": "dss",
                  "jobkeeper_monthly_applications_pc": "dss",
                  "payment_types_qrt_pc": "dss",
                  "payment_types_qrt_sa2": "dss",
                  "sa2_salm": "lmip"}
PAYMENT_SINKS = {"postcode": "dss.payment_types_qrt_pc", "lga": "dss.payment_types_qrt_lga",
                 "sa2": "dss.payment_types_qrt_sa2"}
JOBSEEKER_SINK = "dss.jobseeker_monthly_payments_sa2"
RENTAL_SINKS = {"lga": "dhhs.lga_rental_reports", "suburb": "dhhs.suburb_rental_reports"}
# ---------------------------------------------------------------------------


def resolve(spark: SparkSession, name: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    if tables is not None and name in tables:
        return tables[name]
    return spark.table(name)


def income_distribution(spark: SparkSession, blocks, abs_table: str = INCOME_TABLE,
                        sel_year=2016, tables=None) -> DataFrame:
    """Equivalised household income counts apportioned to the blocks."""
    return apportioned_distribution(resolve(spark, f"abs.{abs_table}", tables),
                                    resolve(spark, CONCORD_SA1, tables), blocks, years=sel_year)


def seifa_index(spark: SparkSession, blocks, abs_table: str = SEIFA_TABLE, seifaindex="IRSD",
                measure="SCORE", sel_year=2016, tables=None) -> DataFrame:
    """Population-weighted socio-economic index of the blocks."""
    return weighted_index(resolve(spark, f"abs.{abs_table}", tables),
                          resolve(spark, CONCORD_SA1, tables), blocks,
                          index_types=seifaindex, measures=measure, years=sel_year)


def area_time_series(spark: SparkSession, blocks, sel_tbl: str = "jobseeker_monthly_payments_sa2",
                     tables=None) -> DataFrame:
    """Time series of the areas the blocks fall in, from the named table."""
    if sel_tbl not in AREA_SERIES_SPECS:
        raise unknown_series(sel_tbl)
    spec = AREA_SERIES_SPECS[sel_tbl]
    concord = CONCORD_SA2 if spec.concord == "cbsa2" else CONCORD_POSTCODE
    fact = resolve(spark, f"{SERIES_SCHEMAS[sel_tbl]}.{sel_tbl}", tables)
    return area_series(fact, resolve(spark, concord, tables), blocks, spec=spec)


def default_store(spark: SparkSession) -> str:
    """The folder of the loads: beside the session's tables, in its warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/arealens_loads"


def append_new(df: DataFrame, name: str, period_col: str = "month_date", tables=None) -> DataFrame:
    """What a load would add to table ``name`` of ``tables`` (name -> stored
    rows): the rows of periods, and of publications where the rows name them,
    that are not stored yet.  A dry run: nothing is written."""
    stored = (tables or {}).get(name)
    df = split_unperioded(df, period_col, None)
    if stored is None:
        return df
    keys = load_key(df, period_col)
    if missing := [k for k in keys if k not in stored.columns]:
        raise ValueError(f"table {name} has no column {', '.join(missing)}")
    return new_periods_only(df, stored, keys)


def _load(outputs: Mapping[str, DataFrame], spark: SparkSession, store: str | None, tables, load_id: str | None) -> dict:
    """Add the outputs' new rows to their tables, visible together, each table
    under a catalog view of its name; with ``tables`` a dry run against those."""
    if tables is not None:
        return {name: append_new(df, name, tables=tables) for name, df in outputs.items()}
    store = store or default_store(spark)
    added = write_load(outputs, store, load_id)
    have = {r.table_name for r in ledger(spark, store).select("table_name").distinct().collect()}  # a few names
    for name, df in outputs.items():
        if name in have:
            create_view(spark, name, store, name, [c for c in df.columns if c != SOURCE_COLUMN])
    return added


def _stop_at(bad: DataFrame) -> None:
    if first := bad.limit(5).collect():
        raise ValueError("sheets that can't be placed: " + "; ".join(" ".join(map(str, r)) for r in first))


def run_payment_types_load(sheet_rows: DataFrame, tables=None, faulty: str = "fail", store: str | None = None,
                           load_id: str | None = None) -> dict:
    """The three payment-type tables from one landing table, melted once and made
    visible together (``sources.store``; by default in the session's warehouse).
    A table's view shows the last publication of every period.

    Sheets that can't be placed (``payment_quarantine``) stop the load before
    anything is written, or are left out with ``faulty="skip"``.  A geography
    that a publication has no sheet for has nothing to load."""
    if faulty not in ("fail", "skip"):
        raise ValueError("faulty should be 'fail' or 'skip'")
    bad = staged(payment_quarantine(sheet_rows))
    if faulty == "fail":
        _stop_at(bad.filter("reason <> 'no sheet'"))
    every = load_payment_types_all(sheet_rows, with_source=True)
    if faulty == "skip":
        every = every.join(bad.select("source_url", "geography").distinct(), ["source_url", "geography"], "left_anti")
    every = staged(every)
    added = _load({sink: one_payment_geography(every, g) for g, sink in PAYMENT_SINKS.items()},
                  sheet_rows.sparkSession, store, tables, load_id)
    return {g: added[sink] for g, sink in PAYMENT_SINKS.items()}


def run_jobseeker_load(sheet_rows: DataFrame, tables=None, store: str | None = None,
                       load_id: str | None = None) -> DataFrame:
    """The jobseeker table from one landing table.  Publications whose sheet can't
    be read (``jobseeker_quarantine``) stop the load before anything is written."""
    _stop_at(jobseeker_quarantine(sheet_rows))
    added = _load({JOBSEEKER_SINK: load_jobseeker(sheet_rows, with_source=True)}, sheet_rows.sparkSession,
                  store, tables, load_id)
    return added[JOBSEEKER_SINK]


def run_rental_load(sheet_rows: DataFrame, tables=None, store: str | None = None, load_id: str | None = None) -> dict:
    """Both rental tables from one melt, each gated on its own stored publications.
    Sheets that can't be placed (``rental_quarantine``) stop the load before
    anything is written."""
    _stop_at(rental_quarantine(sheet_rows))
    every = staged(load_rental_all(sheet_rows, with_source=True))
    added = _load({sink: one_rental_geography(every, g) for g, sink in RENTAL_SINKS.items()},
                  sheet_rows.sparkSession, store, tables, load_id)
    return {g: added[sink] for g, sink in RENTAL_SINKS.items()}
