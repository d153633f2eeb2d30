import datetime as dt

import pytest

from arealens import schemas as S
from arealens.plans import catalog as C
from fixtures import (PAYMENT_SA2, PAYMENT_URL, RENTAL_SHEET, RENTAL_URL, cbpostcodes, cbsa1mb,
                      cbsa2, income, rows, seifa, sheet, sheet_rows)


def _tables(spark):
    return {"concord.cbsa1mb": cbsa1mb(spark), "concord.cbsa2": cbsa2(spark),
            "concord.cbpostcodes": cbpostcodes(spark),
            "abs.sa1_tb_hh_equivalised_income": income(spark), "abs.sa1_seifa": seifa(spark),
            "dss.jobkeeper_monthly_applications_pc": spark.createDataFrame(
                [("3053", "March 2020", 7)], S.JOBKEEPER_PC)}


def test_name_resolved_queries(spark):
    t = _tables(spark)
    assert [r.value for r in C.income_distribution(spark, [73, 74, 83], tables=t).collect()] == [8.0, 14.0, 3.0]
    assert rows(C.seifa_index(spark, ["73", "74", "83"], tables=t)) == [("IRSD", "SCORE", 980.0, 2016)]
    js = C.area_time_series(spark, ["73"], "jobkeeper_monthly_applications_pc", tables=t)
    assert rows(js) == [("3053", dt.date(2020, 3, 1), 7)]
    with pytest.raises(ValueError):
        C.area_time_series(spark, ["73"], "jobseeker_montly_payments_sa2", tables=t)


def test_loads_append_only_new_periods(spark):
    recs = sheet(PAYMENT_URL, "SA2", 1, PAYMENT_SA2)
    for no in range(1, 8):
        recs += sheet(RENTAL_URL, f"Table {no}", no, RENTAL_SHEET)
    sr = sheet_rows(spark, recs)
    first = C.run_payment_types_load(sr, tables={})
    assert first["sa2"].count() == 3
    stored = {"dss.payment_types_qrt_sa2": first["sa2"]}
    again = C.run_payment_types_load(sr, tables=stored)
    assert again["sa2"].count() == 0
    rental = C.run_rental_load(sr, tables={})
    assert rental["lga"].count() == 28 and rental["suburb"].count() == 0


def test_loads_into_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dss")
    sr = sheet_rows(spark, sheet(PAYMENT_URL, "SA2", 1, PAYMENT_SA2))
    C.run_payment_types_load(sr)
    C.run_payment_types_load(sr)  # same publication again: nothing added
    stored = spark.table("dss.payment_types_qrt_sa2")
    assert stored.count() == 3
    assert stored.columns == ["sa2_5dig", "sa2_name", "quarter", "series", "value", "month_date"]
    js = C.area_time_series(spark, ["73", "74"], "payment_types_qrt_sa2",
                            tables={"concord.cbsa2": cbsa2(spark),
                                    "dss.payment_types_qrt_sa2": stored})
    assert rows(js, "sa2_main", "series", "value") == [
        ("206041117", "Age Pension", 120.0), ("206041117", "Commonwealth Seniors Health Card", 5.0)]


def test_labour_force_series_by_name(spark):
    salm = spark.createDataFrame([("206041122", "March 2011", "Unemployment rate", 4.5)], S.SA2_SALM)
    t = {"concord.cbsa2": cbsa2(spark), "lmip.sa2_salm": salm}
    out = C.area_time_series(spark, ["83"], "sa2_salm", tables=t)
    assert rows(out) == [("206041122", "Docklands", dt.date(2011, 3, 1), "Unemployment rate", 4.5)]


def test_sheets_that_cannot_be_placed_stop_or_are_left_out(spark):
    recs = sheet(PAYMENT_URL, "SA2", 1, PAYMENT_SA2) + sheet("https://h/dss-demographics-x.xlsx", "SA2", 1, PAYMENT_SA2)
    sr = sheet_rows(spark, recs)
    from arealens.plans.payment_types import payment_quarantine
    reasons = {(r.source_url, r.reason) for r in payment_quarantine(sr).filter("geography = 'sa2'").collect()}
    assert reasons == {("https://h/dss-demographics-x.xlsx", "no period")}
    with pytest.raises(ValueError, match="can't be placed"):
        C.run_payment_types_load(sr, tables={})
    kept = C.run_payment_types_load(sr, tables={}, faulty="skip")
    assert kept["sa2"].count() == 3 and kept["lga"].count() == 0


def test_load_reads_the_body_of_the_landing_table_once(spark, scratch):
    recs = []
    for no in range(1, 8):
        recs += sheet(RENTAL_URL, f"Table {no}", no, RENTAL_SHEET)
    path = scratch + "/landing"
    sheet_rows(spark, recs).write.parquet(path)
    from arealens.plans.rental import load_rental_all
    from arealens.sources import read_sheet_rows
    plan = load_rental_all(read_sheet_rows(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1  # header rows are staged before


def test_rental_sheets_without_period_or_area_stop_the_load(spark):
    from arealens.plans.rental import rental_quarantine
    good = sheet(RENTAL_URL, "Table 1", 1, RENTAL_SHEET)
    unnamed = sheet("https://host/rental-report-quarterly-2021.xlsx", "Table 1", 1, RENTAL_SHEET)
    assert rental_quarantine(sheet_rows(spark, good)).count() == 0
    bad = rental_quarantine(sheet_rows(spark, good + unnamed)).collect()
    assert [(r.source_url, r.reason) for r in bad] == [("https://host/rental-report-quarterly-2021.xlsx", "no period")]
    with pytest.raises(ValueError, match="no period"):
        C.run_rental_load(sheet_rows(spark, good + unnamed), tables={})
