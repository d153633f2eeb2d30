"""Loads, their ledger, revisions of publications, and the stream's keyed state."""

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F

from arealens.functions.period import publication_order
from arealens.operators.revisions import latest_cells, revised_cells
from arealens.plans import catalog as C
from arealens.plans.jobseeker import jobseeker_quarantine, load_jobseeker
from arealens.plans.payment_types import (LoadAccount, load_payment_types, load_payment_types_all, payment_account,
                                          payment_quarantine)
from arealens.sources.store import (committed, create_view, ledger, newest_loaded, not_loaded, read_loads, write_load)
from arealens.sources.tables import newest_partition, read_table, write_bucketed
from arealens.streaming import incremental_load, write_publication
from fixtures import JOBSEEKER_SHEET, JOBSEEKER_URL, PAYMENT_SA2, rows, sheet, sheet_rows

FIRST = "https://h/dss-demographics-december-2021.xlsx"
REVISED = "https://h/dss-demographics-december-2021-revised.xlsx"
MARCH = "https://h/dss-demographics-march2022.xlsx"
CHANGED = [*PAYMENT_SA2[:3], ["21105", "Carlton", "121", "<5", "9"], ["21120", "Kew", "8", None, None]]


def _publications(spark):
    return {FIRST: sheet_rows(spark, sheet(FIRST, "SA2", 1, PAYMENT_SA2)),
            REVISED: sheet_rows(spark, sheet(REVISED, "SA2", 1, CHANGED)),
            MARCH: sheet_rows(spark, sheet(MARCH, "SA2", 1, PAYMENT_SA2))}


def _load(part):
    return {"sa2": load_payment_types(part, "sa2", with_source=True)}


def _cells(df):
    return sorted(map(tuple, df.select("sa2_5dig", "series", "value", "month_date", "source_url").collect()))


LATEST = [("21105", "Age Pension", 120.0, dt.date(2022, 3, 1), MARCH), ("21105", "Age Pension", 121.0, dt.date(2021, 12, 1), REVISED),
          ("21105", "Commonwealth Seniors Health Card", 5.0, dt.date(2021, 12, 1), REVISED),
          ("21105", "Commonwealth Seniors Health Card", 5.0, dt.date(2022, 3, 1), MARCH),
          ("21105", "Health Care Card", 9.0, dt.date(2021, 12, 1), REVISED),
          ("21110", "Health Care Card", 7.0, dt.date(2022, 3, 1), MARCH),
          ("21120", "Age Pension", 8.0, dt.date(2021, 12, 1), REVISED)]


def test_the_table_is_the_same_in_one_load_in_any_order_and_as_a_stream(spark, scratch):
    pubs = _publications(spark)
    together = os.path.join(scratch, "together")
    every = pubs[FIRST].unionByName(pubs[REVISED]).unionByName(pubs[MARCH])
    write_load(_load(every), together)
    assert _cells(read_loads(spark, together, "sa2")) == LATEST
    history = _cells(read_loads(spark, together, "sa2", publications="all"))
    assert len(history) == len(LATEST) + 3
    for k, order in enumerate([(FIRST, REVISED, MARCH), (MARCH, REVISED, FIRST)]):
        store = os.path.join(scratch, f"order{k}")
        for url in (*order, FIRST):
            write_load(_load(pubs[url]), store)
        assert _cells(read_loads(spark, store, "sa2")) == LATEST
        assert _cells(read_loads(spark, store, "sa2", publications="all")) == history
    for per_batch in (1, None):
        landing, store = os.path.join(scratch, f"landing{per_batch}"), os.path.join(scratch, f"stream{per_batch}")
        for i, url in enumerate((REVISED, FIRST, MARCH)):
            write_publication(pubs[url], landing, f"p{i}")
        incremental_load(spark, landing + "/*", lambda b: load_payment_types(b, "sa2", with_source=True), f"{store}/sa2",
                         f"revisions-{per_batch}", header_row=3, max_files_per_trigger=per_batch).awaitTermination()
        assert _cells(read_loads(spark, store, "sa2")) == LATEST
        assert _cells(read_loads(spark, store, "sa2", publications="all")) == history


def test_ledger_is_the_group_by_of_the_tables_and_gates_without_a_scan(spark, scratch):
    pubs, store = _publications(spark), os.path.join(scratch, "s")
    for url in (FIRST, REVISED, FIRST):
        write_load(_load(pubs[url]), store)
    facts = read_loads(spark, store, "sa2", publications="all")
    want = facts.groupBy("month_date", "source_url").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))
    got = ledger(spark, store).select("month_date", "source_url", "rows", F.col("total").cast("double").alias("total"))
    assert sorted(rows(got)) == sorted(rows(want)) and got.count() == 2
    new = not_loaded(_load(pubs[MARCH].unionByName(pubs[FIRST]))["sa2"], store, "sa2")
    files = new._jdf.queryExecution().analyzed().toString() + "".join(new.inputFiles())
    assert f"{store}/sa2" not in files and {r.source_url for r in new.collect()} == {MARCH}
    newest = newest_loaded(spark, store, "sa2")
    assert rows(newest) == [(dt.date(2021, 12, 1),)]
    assert all("/ledger/" in f for f in newest.inputFiles())


def test_a_failed_load_leaves_every_reader_on_the_old_version(spark, scratch):
    pubs, store = _publications(spark), os.path.join(scratch, "s")
    both = {"a": _load(pubs[FIRST])["sa2"], "b": _load(pubs[FIRST])["sa2"]}
    write_load(both, store)
    before = {t: _cells(read_loads(spark, store, t)) for t in both}
    spark.sql("CREATE DATABASE IF NOT EXISTS versions")
    for t in both:
        create_view(spark, f"versions.{t}", store, t, ["sa2_5dig", "series", "value", "month_date", "source_url"])
    march = _load(pubs[MARCH])["sa2"]
    failing = march.withColumn("value", F.when(F.col("value") > 6, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        write_load({"a": march, "b": failing}, store, load_id="load-x")  # "a" is written, then "b" fails
    assert os.path.exists(f"{store}/a/load_id=load-x")
    for t in both:
        assert _cells(read_loads(spark, store, t)) == before[t]
        assert _cells(spark.table(f"versions.{t}")) == before[t]
    write_load({"a": march, "b": march}, store, load_id="load-x")  # the same load again
    for t in both:
        after = _cells(read_loads(spark, store, t))
        assert len(after) == 2 * len(before[t]) and _cells(spark.table(f"versions.{t}")) == after


def test_a_publication_that_two_writers_added_counts_once(spark, scratch):
    pubs, store = _publications(spark), os.path.join(scratch, "s")
    write_load(_load(pubs[FIRST]), store, load_id="load-a")
    one = _cells(read_loads(spark, store, "sa2"))
    other = os.path.join(scratch, "other")
    write_load(_load(pubs[FIRST]), other, load_id="load-b")
    for part in ("sa2", "ledger"):  # as if the second writer had read the ledger before the first wrote it
        spark.read.parquet(f"{other}/{part}/load_id=load-b").write.parquet(f"{store}/{part}/load_id=load-b") if part == "ledger" \
            else spark.read.parquet(f"{other}/{part}/load_id=load-b").write.partitionBy("month_date").parquet(f"{store}/{part}/load_id=load-b")
    assert _cells(read_loads(spark, store, "sa2")) == one
    assert committed(ledger(spark, store)).count() == 1


def test_load_ids_and_columns_are_checked(spark, scratch):
    df = _load(_publications(spark)[FIRST])["sa2"]
    for bad in ("1", "2021-01-01", "a/b", "a b"):
        with pytest.raises(ValueError):
            write_load({"sa2": df}, scratch, load_id=bad)
    with pytest.raises(ValueError, match="source_url"):
        write_load({"sa2": df.drop("source_url")}, scratch)
    with pytest.raises(ValueError, match="period"):
        write_load({"sa2": df.withColumn("month_date", F.lit(None).cast("date"))}, scratch)
    with pytest.raises(ValueError):
        committed(ledger(spark, scratch), "some")


def test_a_publication_landed_twice_adds_nothing_also_after_a_restart(spark, scratch):
    pubs = _publications(spark)
    landing, store = os.path.join(scratch, "landing"), os.path.join(scratch, "s")
    seen = []

    def plan(batch):
        seen.append(batch.count())
        return load_payment_types(batch, "sa2", with_source=True)

    def run():
        incremental_load(spark, landing + "/*", plan, f"{store}/sa2", "twice", header_row=3).awaitTermination()
        return _cells(read_loads(spark, store, "sa2", publications="all"))

    write_publication(pubs[FIRST], landing, "one")
    write_publication(pubs[FIRST], landing, "same-under-another-name")
    once = run()
    assert len(once) == 3 and seen == [len(PAYMENT_SA2)]
    write_publication(pubs[FIRST], landing, "again")
    assert run() == once and seen[1:] in ([], [0])  # the stream started anew: its state kept the rows out
    write_publication(pubs[MARCH], landing, "march")
    assert len(run()) == 6


def test_revisions_cell_by_cell(spark):
    data = [("d", "u.xlsx", "a", 1.0), ("d", "u.xlsx", "b", 2.0), ("d", "u.xlsx", "c", None), ("d", "u.xlsx", None, 4.0),
            ("d", "u-v2.xlsx", "a", 1.0), ("d", "u-v2.xlsx", "c", 3.0), ("d", "u-v2.xlsx", None, 4.0), ("d", "u-v2.xlsx", "e", 5.0),
            ("d", "u-v10.xlsx", "b", 2.0), ("d", "u-v10.xlsx", "c", None), ("d", "u-v10.xlsx", "c", None), ("f", "z.xlsx", "a", 9.0)]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "month_date string, source_url string, cell string, value double")
        got = {(r.month_date, r.cell, r.place): (r.status, r.old_value, r.value)
               for r in revised_cells(df, ["cell"]).collect()}
        assert got == {
            ("d", "a", 1): ("inserted", None, 1.0), ("d", "b", 1): ("inserted", None, 2.0), ("d", "c", 1): ("inserted", None, None),
            ("d", None, 1): ("inserted", None, 4.0), ("d", "a", 2): ("same", 1.0, 1.0), ("d", "b", 2): ("withdrawn", 2.0, None),
            ("d", "c", 2): ("changed", None, 3.0), ("d", None, 2): ("same", 4.0, 4.0), ("d", "e", 2): ("inserted", None, 5.0),
            ("d", "a", 3): ("withdrawn", 1.0, None), ("d", "b", 3): ("inserted", None, 2.0), ("d", "c", 3): ("changed", 3.0, None),
            ("d", None, 3): ("withdrawn", 4.0, None), ("d", "e", 3): ("withdrawn", 5.0, None), ("f", "a", 1): ("inserted", None, 9.0)}
        assert sorted(r.cell for r in latest_cells(df).collect()) == ["a", "b", "c", "c"]
    empty = df.limit(0)
    assert revised_cells(empty, ["cell"]).count() == 0 and latest_cells(empty).count() == 0


def test_publication_order_reads_revision_marks(spark):
    names = ["a-dec-2021.xlsx", "a-dec-2021-revised.xlsx", "a-dec-2021-v2.xlsx", "a-dec-2021 rev3.xlsx", "a-dec-2021_v10.xlsx"]
    df = spark.createDataFrame([(n,) for n in names], "source_url string")
    assert [r.source_url for r in df.orderBy(publication_order().desc()).collect()] == names[::-1]
    plain = spark.createDataFrame([("vacancies-reviewed-dec-2021.xlsx",)], "source_url string")
    assert plain.select(publication_order().alias("o")).first().o.revision == 0


def test_jobseeker_sheets_that_cannot_be_read_stop_the_load(spark):
    base = JOBSEEKER_URL.replace("december-2021", "{}-2021")
    header = JOBSEEKER_SHEET[6]
    recs = (sheet(base.format("december"), "Table 4 - By SA2", 4, JOBSEEKER_SHEET)
            + sheet(base.format("november"), "Table 5 - By SA2", 4, JOBSEEKER_SHEET)
            + sheet(base.format("october"), "Table 4 - By SA2", 4, [*JOBSEEKER_SHEET[:6], ["SA2 code", *header[1:]]])
            + sheet(base.format("june"), "Table 4 - By SA2", 4, JOBSEEKER_SHEET[:5])
            + sheet(base.format("may"), "Table 4 - By SA2", 4, JOBSEEKER_SHEET) + sheet(base.format("may"), "Table 4 - By SA2", 5, JOBSEEKER_SHEET)
            + sheet("https://h/jobseeker-x.xlsx", "Table 4 - By SA2", 4, [*JOBSEEKER_SHEET[:6], header[:2]])
            + sheet(FIRST, "SA2", 1, PAYMENT_SA2))
    sr = sheet_rows(spark, recs)
    got = {(r.source_url.rsplit("recipients-")[-1], r.reason) for r in jobseeker_quarantine(sr).collect()}
    assert got == {("november-2021.xlsx", "no sheet"), ("october-2021.xlsx", "no code column"), ("june-2021.xlsx", "no code column"),
                   ("june-2021.xlsx", "no series"), ("may-2021.xlsx", "several sheets"),
                   ("https://h/jobseeker-x.xlsx", "no period"), ("https://h/jobseeker-x.xlsx", "no series")}
    with pytest.raises(ValueError, match="can't be placed"):
        C.run_jobseeker_load(sr, tables={})
    good = sr.filter(F.col("source_url").contains("december"))
    assert jobseeker_quarantine(good).count() == 0
    assert C.run_jobseeker_load(good, tables={}).count() == load_jobseeker(good).count() == 4


def test_runner_shows_the_last_publication_whatever_the_order(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS dss")
    pubs = _publications(spark)
    seen = []
    for k, order in enumerate(itertools.permutations((FIRST, REVISED))):
        store = os.path.join(scratch, f"s{k}")
        for url in order:
            C.run_payment_types_load(pubs[url], store=store)
        seen.append(sorted(map(tuple, spark.table(C.PAYMENT_SINKS["sa2"]).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 4
    spark.sql("CREATE TABLE dss.plain (x INT) USING parquet")
    with pytest.raises(ValueError, match="is a table"):
        create_view(spark, "dss.plain", store, "dss.payment_types_qrt_sa2", ["value"])
    spark.sql("DROP TABLE dss.plain")


def test_account_observed_by_the_load_equals_the_counted_one(spark):
    noisy = [*PAYMENT_SA2, ["21130", "Fitzroy", "n.p.", "-3", ""], ["21140"]]
    sr = sheet_rows(spark, sheet(FIRST, "SA2", 1, noisy) + sheet(MARCH, "By SA2", 1, PAYMENT_SA2))
    account = LoadAccount()
    kept = load_payment_types_all(sr, account=account).collect()
    seen = account.counts()
    total = {}
    for r in payment_account(sr).collect():
        assert r.landed == r.kept + r.footnote + r.other_region + r.empty + r.unparsed + r.not_positive
        for k, v in r.asDict().items():
            total[k.replace("_", " ")] = total.get(k.replace("_", " "), 0) + v if isinstance(v, int) else 0
    assert {k: v for k, v in total.items() if k in seen} == seen
    assert seen["kept"] == len(kept) == 6 and seen["marked"] == 2 and seen["footnote"] == 6 and seen["other region"] == 6
    assert payment_account(sr.limit(0)).count() == 0


def test_quarantine_lists_geographies_without_a_sheet(spark):
    sr = sheet_rows(spark, sheet(FIRST, "SA2", 1, PAYMENT_SA2))
    assert sorted(rows(payment_quarantine(sr), "geography", "reason")) == [("lga", "no sheet"), ("postcode", "no sheet")]


def test_bucketed_tables_join_without_an_exchange(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets")
    cc = spark.range(4000).select((F.col("id") % 50).cast("string").alias("block_id"), (F.col("id") % 700).cast("string").alias("sa1_7dig"),
                                  F.lit(2016).alias("year"), F.lit(0.5).alias("per_pct"))
    m = spark.range(700).select(F.col("id").cast("string").alias("sa1_7dig"), F.lit(2016).alias("year"),
                                F.lit("y").alias("eq_income_yearly"), F.lit("800-999").alias("eq_income_weekly"), F.lit(2.0).alias("value"))
    for name, df in (("cc", cc), ("m", m)):
        write_bucketed(df, f"buckets.{name}", ["sa1_7dig", "year"], 4)
    from arealens.operators.area import apportioned_distribution
    blocks = [str(i) for i in range(20)]
    stored = apportioned_distribution(spark.table("buckets.m"), spark.table("buckets.cc"), blocks, ordered=False)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Join"):]
    assert "Exchange" not in below and "Bucketed: true" in below
    assert rows(stored) == rows(apportioned_distribution(m, cc, blocks, ordered=False))


def test_newest_partition_reads_no_data_column(spark, scratch):
    df = spark.createDataFrame([("a", 1.0, dt.date(2021, 12, 1)), ("b", 2.0, dt.date(2022, 3, 1))], "k string, value double, month_date date")
    df.write.partitionBy("month_date").parquet(scratch + "/t")
    newest = newest_partition(spark, scratch + "/t")
    assert rows(newest) == [(dt.date(2022, 3, 1),)]
    assert "ReadSchema: struct<>" in newest._jdf.queryExecution().executedPlan().toString()


def test_state_can_be_bounded_by_time(spark, scratch):
    pubs = _publications(spark)
    landing, sink = os.path.join(scratch, "landing"), os.path.join(scratch, "s", "sa2")
    for i, url in enumerate((FIRST, FIRST, MARCH)):
        write_publication(pubs[url], landing, f"p{i}")
    incremental_load(spark, landing + "/*", lambda b: load_payment_types(b, "sa2", with_source=True), sink, "bounded",
                     header_row=3, keep_state="90 days").awaitTermination()
    assert read_table(spark, sink).count() == 6
