import datetime as dt

import pytest
from pyspark.sql import functions as F

from arealens import schemas as S
from arealens.operators import selection
from arealens.operators.area import apportioned_distribution, area_series, weighted_index
from fixtures import cbpostcodes, cbsa1mb, cbsa2, income, rows, seifa

BLOCKS = [73, 74, 83]  # numbers on purpose: ids are compared as text


def test_apportioned_distribution_counts_duplicate_shares_and_orders_by_bucket(spark):
    out = apportioned_distribution(income(spark), cbsa1mb(spark), BLOCKS, years=2016)
    assert out.columns == ["eq_income_weekly", "eq_income_yearly", "value", "year"]
    assert rows(out) == [("Nil income", "Nil income", 8.0, 2016),
                         ("800-999", "y-a", 14.0, 2016),
                         ("Unknown label", "y-b", 3.0, 2016)]


def test_apportioned_distribution_year_filter_and_validation(spark):
    out = apportioned_distribution(income(spark), cbsa1mb(spark), ["73"], years=["2011"])
    assert rows(out) == [("1-199", "y-c", 6.0, 2011)]
    with pytest.raises(ValueError):
        apportioned_distribution(income(spark), cbsa1mb(spark), BLOCKS, years=[2016, 2015])


def test_apportioned_distribution_many_selections_in_one_job(spark):
    sel = spark.createDataFrame([("a", "73"), ("a", "74"), ("a", "83"), ("b", "83")],
                                "selection_id string, block_id string")
    out = apportioned_distribution(income(spark), cbsa1mb(spark), sel, years=2016)
    got = {(r.selection_id, r.eq_income_weekly): r.value for r in out.collect()}
    assert got == {("a", "Nil income"): 8.0, ("a", "800-999"): 14.0, ("a", "Unknown label"): 3.0,
                   ("b", "800-999"): 4.0, ("b", "Unknown label"): 3.0}


def test_long_block_list_goes_through_a_broadcast_semi_join(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_INLINE_IDS", 2)
    out = apportioned_distribution(income(spark), cbsa1mb(spark), BLOCKS + list(range(1000, 1010)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert [r.value for r in out.collect()] == [8.0, 14.0, 3.0]


def test_weighted_index_counts_each_area_once(spark):
    out = weighted_index(seifa(spark), cbsa1mb(spark), BLOCKS)
    assert rows(out) == [("IRSD", "SCORE", 980.0, 2016)]  # 992 without the DISTINCT


def test_weighted_index_validation_and_measures(spark):
    with pytest.raises(ValueError):
        weighted_index(seifa(spark), cbsa1mb(spark), BLOCKS, index_types="XYZ")
    with pytest.raises(ValueError):
        weighted_index(seifa(spark), cbsa1mb(spark), BLOCKS, measures="MEAN")
    out = weighted_index(seifa(spark), cbsa1mb(spark), BLOCKS, measures=["RWAD"])
    assert rows(out) == [("IRSD", "RWAD", 5.0, 2016)]
    # NULL index values are ignored
    assert weighted_index(seifa(spark), cbsa1mb(spark), BLOCKS, index_types="IEO").count() == 0


def test_weighted_index_zero_population_is_null(spark):
    cc = spark.createDataFrame([("1", "x", "s", 0, 1.0, 2016)], S.CBSA1MB)
    idx = spark.createDataFrame([("s", "IRSD", "SCORE", 10.0)], S.SA1_SEIFA)
    assert rows(weighted_index(idx, cc, ["1"]), "value") == [(None,)]


def _jobseeker(spark):
    return spark.createDataFrame([
        ("21105", "Carlton", "May 2020", "JobSeeker Payment", 10.0, None),
        ("21105", "Carlton", "April 2020", "JobSeeker Payment", 9.0, None),
        ("21110", "Docklands", "April 2020", "JobSeeker Payment", 5.0, None),
        ("21110", "Docklands", "April 2020", "JobSeeker Payment", 5.0, None),
        ("29999", "Far away", "April 2020", "JobSeeker Payment", 1.0, None),
    ], S.JOBSEEKER_SA2)


def test_area_series_jobseeker_distinct_and_ordered(spark):
    out = area_series(_jobseeker(spark), cbsa2(spark), BLOCKS, "jobseeker_monthly_payments_sa2")
    assert out.columns == ["sa2_main", "sa2_name", "month", "series", "value"]
    assert rows(out) == [
        ("206041117", "Carlton", dt.date(2020, 4, 1), "JobSeeker Payment", 9.0),
        ("206041122", "Docklands", dt.date(2020, 4, 1), "JobSeeker Payment", 5.0),
        ("206041117", "Carlton", dt.date(2020, 5, 1), "JobSeeker Payment", 10.0)]


def test_area_series_jobkeeper_renames_measure(spark):
    fact = spark.createDataFrame([("3053", "March 2020", 7), ("3008", "March 2020", 2),
                                  ("3053", "April 2020", 8)], S.JOBKEEPER_PC)
    out = area_series(fact, cbpostcodes(spark), BLOCKS, "jobkeeper_monthly_applications_pc")
    assert out.columns == ["postcode", "month", "value"]
    assert rows(out) == [("3008", dt.date(2020, 3, 1), 2), ("3053", dt.date(2020, 3, 1), 7),
                         ("3053", dt.date(2020, 4, 1), 8)]


def test_area_series_payment_types_hyphen_labels(spark):
    pc = spark.createDataFrame([("3053", "December-2019", "Age Pension", 5.0, None),
                                ("3008", "December-2019", "Age Pension", 6.0, None)],
                               S.PAYMENT_TYPES_PC)
    out = area_series(pc, cbpostcodes(spark), ["83"], "payment_types_qrt_pc")
    assert rows(out) == [("3008", dt.date(2019, 12, 1), "Age Pension", 6.0)]
    sa2 = spark.createDataFrame([("21105", "Carlton", "March-2020", "Age Pension", 3.0, None)],
                                S.PAYMENT_TYPES_SA2)
    out = area_series(sa2, cbsa2(spark), BLOCKS, "payment_types_qrt_sa2")
    assert rows(out) == [("206041117", "Carlton", dt.date(2020, 3, 1), "Age Pension", 3.0)]


def test_area_series_labour_force_on_main_key(spark):
    salm = spark.createDataFrame([("206041122", "March 2011", "Unemployment rate", 4.5),
                                  ("206041117", "March 2011", "Unemployment rate", 6.5)], S.SA2_SALM)
    out = area_series(salm, cbsa2(spark), BLOCKS, "sa2_salm")
    assert rows(out) == [("206041117", "Carlton", dt.date(2011, 3, 1), "Unemployment rate", 6.5),
                         ("206041122", "Docklands", dt.date(2011, 3, 1), "Unemployment rate", 4.5)]


def test_area_series_unknown_table(spark):
    with pytest.raises(ValueError):
        area_series(_jobseeker(spark), cbsa2(spark), BLOCKS, "no_such_table")


def test_block_ids_become_text_and_empty_selection_fails(spark):
    assert selection.block_ids([73, "74"]) == ["73", "74"]
    with pytest.raises(ValueError):
        apportioned_distribution(income(spark), cbsa1mb(spark), [])


def test_bounded_broadcast_only_below_the_bound(spark):
    small = spark.range(5)
    assert "broadcast" in str(selection.bounded_broadcast(small, 10)._jdf.queryExecution().logical()).lower()
    big = spark.range(50)
    assert selection.bounded_broadcast(big, 10) is big
    wide = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert selection.bounded_broadcast(wide, 10, max_bytes=1000) is wide


def test_list_and_frame_selections_agree_after_the_concordance_grows(spark, scratch):
    fact = spark.createDataFrame([("a1", "March 2020", "s", 1.0), ("a2", "March 2020", "s", 2.0)],
                                 "sa2_5dig string, month string, series string, value double")
    path = scratch + "/concord"
    kind = "block_id string, sa2_5dig string, sa2_main string, sa2_name string"
    spark.createDataFrame([("73", "a1", "m1", "n1")], kind).write.parquet(path + "/p=1")
    cc = spark.read.schema(kind).parquet(path + "/*")
    frame = spark.createDataFrame([("73",)], "block_id string")
    args = "jobseeker_monthly_payments_sa2"
    listed, framed = area_series(fact, cc, ["73"], args), area_series(fact, cc, frame, args)
    assert listed.count() == framed.count() == 1
    spark.createDataFrame([("73", "a2", "m2", "n2")], kind).write.parquet(path + "/p=2")
    cc = spark.read.schema(kind).parquet(path + "/*")
    assert area_series(fact, cc, ["73"], args).count() == area_series(fact, cc, frame, args).count() == 2



def test_area_series_can_read_the_stored_date(spark):
    import datetime as dt2
    fact = spark.createDataFrame([("21105", "Carlton", "May 2020", "JobSeeker Payment", 10.0, dt2.date(2020, 5, 1)),
                                  ("21105", "Carlton", "bad label", "JobSeeker Payment", 11.0, dt2.date(2020, 6, 1))],
                                 S.JOBSEEKER_SA2)
    parsed = area_series(fact, cbsa2(spark), ["73"], "jobseeker_monthly_payments_sa2")
    stored = area_series(fact, cbsa2(spark), ["73"], "jobseeker_monthly_payments_sa2", stored_date=True)
    assert [r.month for r in parsed.collect()] == [dt2.date(2020, 5, 1), None]  # NULL last
    assert [r.month for r in stored.collect()] == [dt2.date(2020, 5, 1), dt2.date(2020, 6, 1)]


def test_weighted_index_can_join_on_year(spark):
    # Q9: an index frame holding several censuses is joined on area and year
    idx = spark.createDataFrame([("20601100001", "IRSD", "SCORE", 1000.0, 2016),
                                 ("20601100001", "IRSD", "SCORE", 500.0, 2011)],
                                "sa1_main string, seifaindextype string, seifa_measure string, value double, year int")
    mixed = weighted_index(idx, cbsa1mb(spark), ["73"], years=[2011, 2016])
    by_year = weighted_index(idx, cbsa1mb(spark), ["73"], years=[2011, 2016], join_year=True)
    assert sorted(rows(by_year, "year", "value")) == [(2011, 500.0), (2016, 1000.0)]
    assert sorted(rows(mixed, "year", "value")) == [(2011, 750.0), (2016, 750.0)]


def test_round_half_up_per_group(spark):
    # Q11: 5 * 0.5 = 2.5 rounds to 3; Q20: groups are rounded one by one
    cc = spark.createDataFrame([("1", "a", "a", 1, 0.5, 2016)], S.CBSA1MB)
    m = spark.createDataFrame([("a", 2016, "y", "w1", 5.0), ("a", 2016, "y", "w2", 5.0)], S.SA1_INCOME)
    out = apportioned_distribution(m, cc, ["1"], ordered=False)
    assert sorted(rows(out, "eq_income_weekly", "value")) == [("w1", 3.0), ("w2", 3.0)]  # total 5 -> 6
