import datetime as dt
import os

from pyspark.sql import functions as F


from arealens import schemas as S
from arealens.operators.gate import (current_period_rows, freshness_gate, new_periods_only,
                                     newest_period)
from arealens.plans.payment_types import load_payment_types
from arealens.sources.tables import append_table, read_table, write_clustered
from arealens.streaming import incremental_load
from fixtures import PAYMENT_SA2, RENTAL_SHEET, rows, sheet, sheet_rows


def _stored(spark):
    return spark.createDataFrame([
        ("3000", "September-2019", "Age Pension", 5.0, dt.date(2019, 9, 1)),
        ("3000", "December-2019", "Age Pension", 6.0, dt.date(2019, 12, 1)),
        ("3000", "bad label", "Age Pension", 6.0, None),
    ], S.PAYMENT_TYPES_PC)


def test_newest_period_ignores_and_counts_bad_labels(spark):
    r = newest_period(_stored(spark), date_col=None, label_col="quarter").first()
    assert (r.newest, r.newest_date, r.unparsed) == ("december-2019", dt.date(2019, 12, 1), 1)
    r = newest_period(_stored(spark)).first()
    assert r.newest == "december-2019"


def test_freshness_gate_both_rules(spark):
    cand = spark.createDataFrame([("https://x/december-2019.xlsx", dt.date(2019, 12, 1)),
                                  ("https://x/dec-2019.xlsx", dt.date(2019, 12, 1)),
                                  ("https://x/march2020.xlsx", dt.date(2020, 3, 1))],
                                 "url string, period date")
    contains = [r.already_loaded for r in freshness_gate(cand, _stored(spark), "url", mode="contains").collect()]
    assert contains == [True, True, False]  # "dec-2019" is the stored period too
    later = freshness_gate(cand, _stored(spark), "url", period_col="period", mode="later")
    assert [r.already_loaded for r in later.collect()] == [True, True, False]
    plan = freshness_gate(cand, _stored(spark), "url", mode="contains")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # scalar subquery, no join


def test_new_periods_only_and_current_period(spark):
    inc = spark.createDataFrame([("3000", "March-2020", "Age Pension", 1.0, dt.date(2020, 3, 1)),
                                 ("3000", "December-2019", "Age Pension", 6.0, dt.date(2019, 12, 1))],
                                S.PAYMENT_TYPES_PC)
    assert [r.quarter for r in new_periods_only(inc, _stored(spark)).collect()] == ["March-2020"]
    dup = inc.unionByName(inc)
    assert current_period_rows(dup, "quarter", ["March-2020"]).count() == 1
    labels = spark.createDataFrame([("December-2019",)], "q string")
    assert current_period_rows(dup, "quarter", labels).count() == 1


def test_append_table_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "payment_types_qrt_sa2")
    sr = sheet_rows(spark, sheet("https://h/dss-demographics-december-2021.xlsx", "SA2", 1, PAYMENT_SA2))
    df = load_payment_types(sr, "sa2")
    append_table(df, path)
    append_table(df, path)
    stored = read_table(spark, path)
    assert stored.count() == 3
    assert {r.month_date for r in stored.select("month_date").collect()} == {dt.date(2021, 12, 1)}


def test_replace_periods_rewrites_only_those_periods(spark, scratch):
    path = os.path.join(scratch, "pc")
    append_table(_stored(spark).filter("month_date IS NOT NULL"), path)
    fix = spark.createDataFrame([("3000", "December-2019", "Age Pension", 60.0, dt.date(2019, 12, 1))],
                                S.PAYMENT_TYPES_PC)
    append_table(fix, path, replace_periods=True)
    got = {(r.quarter, r.value) for r in read_table(spark, path).collect()}
    assert got == {("September-2019", 5.0), ("December-2019", 60.0)}


def test_incremental_stream_loads_each_file_once(spark, scratch):
    landing = os.path.join(scratch, "landing")
    sink = os.path.join(scratch, "sink")
    from arealens.streaming import write_publication
    first = sheet("https://h/dss-demographics-december-2021.xlsx", "SA2", 1, PAYMENT_SA2)
    write_publication(sheet_rows(spark, first), landing, "p1")

    def plan(batch):
        return load_payment_types(batch, "sa2", with_source=True)

    from arealens.sources import read_sheet_rows
    assert read_sheet_rows(spark, os.path.join(landing, "p1")).count() == len(first)

    q = incremental_load(spark, landing + "/*", plan, sink, "payments-test", header_row=3)
    q.awaitTermination()
    assert read_table(spark, sink).count() == 3
    second = sheet("https://h/dss-demographics-march2022.xlsx", "SA2", 1, PAYMENT_SA2)
    write_publication(sheet_rows(spark, second), landing, "p2")
    q = incremental_load(spark, landing + "/*", plan, sink, "payments-test", header_row=3)
    q.awaitTermination()
    got = read_table(spark, sink).groupBy("quarter").count().collect()
    assert {(r.quarter, r["count"]) for r in got} == {("December-2021", 3), ("March-2022", 3)}


def test_clustered_writes_prune_and_split_hot_keys(spark, scratch):
    from pyspark.sql import functions as F
    # block "b0" holds a third of the rows
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("b0")).otherwise(F.format_string("b%05d", F.col("id"))).alias("block_id"),
        F.col("id").cast("string").alias("sa1_7dig"))
    path = os.path.join(scratch, "concord")
    write_clustered(df, path, ["block_id", "sa1_7dig"], partitions=6)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 6
    back = read_table(spark, path)
    assert back.count() == 30000
    # the hot block is spread over more than one file
    per_file = back.select("block_id", F.input_file_name().alias("f")).filter("block_id = 'b0'")
    assert per_file.select("f").distinct().count() > 1
    got = back.filter(F.col("block_id").isin(["b00001", "b00002"])).count()
    assert got == 2
    append_table(spark.createDataFrame([("3000", "March-2020", "Age Pension", 1.0, dt.date(2020, 3, 1))],
                                       S.PAYMENT_TYPES_PC), os.path.join(scratch, "pc"),
                 cluster_by=["postcode"])
    assert read_table(spark, os.path.join(scratch, "pc")).count() == 1


def test_pending_publications_from_pages(spark):
    from arealens.plans.publications import pending_publications
    from arealens.plans.payment_types import payment_period
    from arealens.functions.period import period_to_date
    pages = spark.createDataFrame([
        (1, "https://a/p", '<div id="r"><a href="https://a/december-2019.xlsx">x</a>'
                           '<a href="https://a/september-2019.xlsx">y</a></div>'),
        (2, "https://b/p", '<div id="r"><a href="https://b/march2020.xlsx">x</a></div>'),
    ], "page_id long, url string, html string")
    got = pending_publications(pages, _stored(spark), keep=r"\.xlsx$", container="#r")
    assert rows(got, "page_id", "href", "already_loaded") == [
        (1, "https://a/december-2019.xlsx", True), (2, "https://b/march2020.xlsx", False)]
    later = pending_publications(pages, _stored(spark), keep=r"\.xlsx$", container="#r", mode="later",
                                 period=period_to_date(payment_period("href")))
    assert rows(later, "page_id", "already_loaded") == [(1, True), (2, False)]


def _stream(spark, landing, plan, sink, name, **options):
    incremental_load(spark, landing + "/*", plan, sink, name, **options).awaitTermination()
    return sorted(tuple(r) for r in read_table(spark, sink).groupBy("source_url", "month_date").count().collect())


def test_batch_size_does_not_change_a_payment_load(spark, scratch):
    from arealens.streaming import write_publication
    landing = os.path.join(scratch, "landing")
    for i, url in enumerate(["https://h/dss-demographics-december-2021.xlsx",
                             "https://h/dss-demographics-march2022.xlsx",
                             "https://h/dss-demographics-dec-2021-revised.xlsx"]):  # same period again
        write_publication(sheet_rows(spark, sheet(url, "SA2", 1, PAYMENT_SA2)), landing, f"p{i}")

    def plan(batch):
        return load_payment_types(batch, "sa2", with_source=True)

    one = _stream(spark, landing, plan, os.path.join(scratch, "one"), "pay-one", header_row=3,
                  max_files_per_trigger=1)
    every = _stream(spark, landing, plan, os.path.join(scratch, "all"), "pay-all", header_row=3)
    assert one == every and [r[2] for r in one] == [3, 3, 3]


def test_batch_size_does_not_change_a_rental_load(spark, scratch):
    from arealens.plans.rental import load_rental_all
    from arealens.streaming import write_publication
    landing = os.path.join(scratch, "landing")
    for name in ("quarterly", "suburb"):
        recs = []
        for no in range(1, 8):
            recs += sheet(f"https://h/{name}-rent-September-quarter-2021.xlsx", f"Table {no}", no, RENTAL_SHEET)
        write_publication(sheet_rows(spark, recs), landing, name)

    def plan(batch):
        return load_rental_all(batch, with_source=True)

    one = _stream(spark, landing, plan, os.path.join(scratch, "one"), "rent-one", header_row=2,
                  max_files_per_trigger=1, by=["geography"])
    every = _stream(spark, landing, plan, os.path.join(scratch, "all"), "rent-all", header_row=2, by=["geography"])
    assert one == every and len(one) == 2 and all(r[2] > 0 for r in one)


def test_rows_without_a_period_fail_or_go_to_quarantine(spark, scratch):
    import pytest
    df = _stored(spark).select("postcode", "quarter", "series", "value", "month_date")
    bad = spark.createDataFrame([("3000", "no period", "s", 1.0, None)], df.schema)
    path, aside = os.path.join(scratch, "t"), os.path.join(scratch, "aside")
    good = df.filter("month_date IS NOT NULL")
    with pytest.raises(ValueError):
        append_table(good.unionByName(bad), path)
    assert not os.path.exists(path)
    for _ in range(2):
        append_table(good.unionByName(bad), path, quarantine=aside)
    assert read_table(spark, path).count() == good.count()
    assert read_table(spark, aside).count() == 2  # every attempt is kept aside


def test_null_keys_are_not_appended_twice(spark):
    df = _stored(spark)
    with_null = df.unionByName(df.limit(1).withColumn("month_date", F.lit(None).cast("date")))
    assert new_periods_only(with_null, with_null).count() == 0


def test_stored_table_without_a_key_column_fails(spark, scratch):
    import pytest
    path = os.path.join(scratch, "t")
    good = _stored(spark).filter("month_date IS NOT NULL")
    append_table(good, path)
    with pytest.raises(ValueError):
        append_table(good.withColumn("source_url", F.lit("u")), path)


def test_abbreviated_period_is_the_stored_one(spark):
    cand = spark.createDataFrame([("https://x/dss-dec-2019.xlsx",), ("https://x/dss-march2020.xlsx",),
                                  ("https://x/none.xlsx",)], "url string")
    for mode in ("contains", "later"):
        got = [r.already_loaded for r in freshness_gate(cand, _stored(spark), "url", mode=mode).collect()]
        assert got == [True, False, False]


def test_first_load_has_nothing_stored(spark):
    empty = spark.createDataFrame([], S.PAYMENT_TYPES_PC)
    cand = spark.createDataFrame([("https://x/december-2019.xlsx", dt.date(2019, 12, 1))],
                                 "url string, period date")
    assert [r.already_loaded for r in freshness_gate(cand, empty, "url").collect()] == [False]
    later = freshness_gate(cand, empty, "url", period_col="period", mode="later")
    assert [r.already_loaded for r in later.collect()] == [False]
    assert new_periods_only(_stored(spark), empty).count() == 3


def test_publication_is_landed_once(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException
    from arealens.streaming import write_publication
    rows_ = sheet_rows(spark, sheet("https://h/dss-demographics-december-2021.xlsx", "SA2", 1, PAYMENT_SA2))
    write_publication(rows_, scratch, "dec-2021")
    assert len([f for f in os.listdir(os.path.join(scratch, "dec-2021")) if f.endswith(".parquet")]) == 1
    with pytest.raises(AnalysisException):
        write_publication(rows_, scratch, "dec-2021")


def test_stream_refuses_a_batch_with_a_split_sheet(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException
    landing = os.path.join(scratch, "landing")
    recs = sheet("https://h/dss-demographics-december-2021.xlsx", "SA2", 1, PAYMENT_SA2)
    # the header (row 3) and the body land in different files
    sheet_rows(spark, recs[:3]).coalesce(1).write.parquet(os.path.join(landing, "a"))
    sheet_rows(spark, recs[3:]).coalesce(1).write.parquet(os.path.join(landing, "b"))
    q = incremental_load(spark, landing + "/*", lambda b: load_payment_types(b, "sa2", with_source=True),
                         os.path.join(scratch, "sink"), "split-check", max_files_per_trigger=1,
                         header_row=3)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
