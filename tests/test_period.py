import datetime as dt

import pytest

from arealens.functions import period as P
from arealens.plans.jobseeker import jobseeker_month
from arealens.plans.payment_types import payment_period
from arealens.plans.rental import rental_period


@pytest.mark.parametrize("url,extracted,label", [
    ("https://x/dss-demographics-december-2021-final.xlsx", "december-2021", "December-2021"),
    ("https://x/dec-2019.xlsx", "dec-2019", "December-2019"),
    ("https://x/sept-2019-x", "sept-2019", "September-2019"),
    ("https://x/201509b", "201509", "September-2015"),
    ("https://x/march2014.xlsx", "march2014", "March-2014"),
    ("https://x/december2013.xlsx", "december2013", "December-2013"),
    ("https://x/December-2020", None, None),  # pattern is lower case
])
def test_payment_period_from_url(spark, url, extracted, label):
    r = spark.createDataFrame([(url,)], "u string").select(
        P.extract_period("u").alias("e"), payment_period("u").alias("l")).first()
    assert (r.e, r.l) == (extracted, label)


def test_monthly_and_rental_periods(spark):
    df = spark.createDataFrame([("https://x/jobseeker-december-2021.xlsx", "https://x/June-quarter-2020"),
                                ("https://x/jobseeker-dec-2021.xlsx", "https://x/march-quarter-2021.xlsx")],
                               "a string, b string")
    got = [(r.m, r.q) for r in df.select(jobseeker_month("a").alias("m"), rental_period("b").alias("q")).collect()]
    assert got == [("December 2021", "June 2020"), (None, "March 2021")]


def test_period_to_date_accepts_both_separators_and_any_case(spark):
    df = spark.createDataFrame([("December 2019",), ("december-2019",), ("Sept 2019",), (None,)], "s string")
    got = [r.d for r in df.select(P.period_to_date("s").alias("d")).collect()]
    assert got == [dt.date(2019, 12, 1), dt.date(2019, 12, 1), None, None]


def test_newest_label_and_contains_is_literal(spark):
    df = spark.createDataFrame([(dt.date(2019, 9, 1),), (dt.date(2019, 12, 1),)], "d date")
    assert df.agg(P.newest_label("d").alias("n")).first().n == "december-2019"
    t = spark.createDataFrame([("a.b-2019", "a.b"), ("axb-2019", "a.b")], "u string, p string")
    assert [r.c for r in t.select(P.url_has_period("u", "p").alias("c")).collect()] == [True, False]


def test_header_month_expansion_and_typos(spark):
    df = spark.createDataFrame([("mar_2003_31",), ("dec_2003_39",), ("sep_2021",), ("jun_2020",),
                                ("x4",)], "h string")
    got = [r.q for r in df.select(P.fix_header_typos(P.expand_header_month("h")).alias("q")).collect()]
    assert got == ["March 2002", "December 2003", "September 2021", "June 2020", "x4"]


def test_sentence_and_title_case(spark):
    r = spark.createDataFrame([("dECEMBER-2019 x",)], "s string").select(
        P.sentence_case("s").alias("a"), P.title_case("s").alias("b")).first()
    assert (r.a, r.b) == ("December-2019 x", "December-2019 X")
