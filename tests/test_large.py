"""Tasks of the same size as tables grow: the work is dealt, with the same rows."""

import pytest
from pyspark.sql import functions as F

from arealens.operators import selection
from arealens.operators.area import apportioned_distribution, weighted_index
from arealens.operators.classes import overlapping_distribution, overlapping_index, refine
from arealens.plans import bindings as b
from arealens.plans.rental import load_rental
from fixtures import RENTAL_SHEET, RENTAL_URL, rows, sheet, sheet_rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark):
    sel = spark.range(400).select((F.col("id") % 5).cast("string").alias("selection_id"), (F.col("id") % 40).cast("string").alias("block_id"))
    cc = spark.range(600).select((F.col("id") % 40).cast("string").alias("block_id"), (F.col("id") % 70).cast("string").alias("sa1_7dig"),
                                 (F.col("id") % 30).cast("string").alias("sa1_main"), (F.col("id") % 30 + 1).alias("sa1_persons"),
                                 F.lit(0.25).alias("per_pct"), F.lit(2016).alias("year"))
    measure = spark.range(70).select(F.col("id").cast("string").alias("sa1_7dig"), F.lit(2016).alias("year"), F.lit("y").alias("eq_income_yearly"),
                                     (F.col("id") % 3).cast("string").alias("eq_income_weekly"), (F.col("id") * 2.0).alias("value"))
    index = spark.range(30).select(F.col("id").cast("string").alias("sa1_main"), F.lit("IRSD").alias("seifaindextype"),
                                   F.lit("SCORE").alias("seifa_measure"), (F.col("id") + 900.0).alias("value"))
    return sel, cc, measure, index


QUERIES = {
    "apportioned": lambda sel, cc, m, i: apportioned_distribution(m, cc, sel, years=None, ordered=False),
    "weighted": lambda sel, cc, m, i: weighted_index(i, cc, sel, None, None, None),
    "weighted by year": lambda sel, cc, m, i: weighted_index(i.withColumn("year", F.lit(2016)), cc, sel, None, None, None, join_year=True),
    "overlapping": lambda sel, cc, m, i: overlapping_distribution(m, cc, sel),
}


@pytest.mark.parametrize("name", QUERIES)
def test_area_queries_deal_large_concordances(spark, monkeypatch, name):
    data = _tables(spark)
    want = sorted(rows(QUERIES[name](*data)))
    monkeypatch.setattr(selection, "ROWS_PER_TASK", 50)
    out = QUERIES[name](*data)
    assert "REPARTITION_BY_NUM" in _plan(out) and ", 12), REPARTITION_BY_NUM" in _plan(out)
    assert sorted(rows(out)) == want and want


def test_refinement_deals_its_pairs(spark, monkeypatch):
    sel, cc, _, index = _tables(spark)
    want = sorted(rows(overlapping_index(index, cc, sel)))
    seen = []
    real = selection.dealt
    monkeypatch.setattr(selection, "ROWS_PER_TASK", 50)
    monkeypatch.setattr("arealens.operators.classes.dealt", lambda df, *a, **k: seen.append(real(df, *a, **k)) or seen[-1])
    refine(sel, "block_id", "selection_id", "c")
    assert "REPARTITION_BY_NUM" in _plan(seen[0])
    assert sorted(rows(overlapping_index(index, cc, sel))) == want and want


def test_selections_of_many_blocks_are_made_in_many_tasks(spark, scratch):
    spark.range(3000).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{scratch}/supplier.parquet")
    out = b.overlapping_selections(spark, scratch)
    assert out.rdd.getNumPartitions() >= 3
    ring = spark.range(3000).select((F.col("id") % 64).alias("r"))
    assert out.count() == ring.agg(F.sum((F.col("r") + 1) * (64 - F.col("r")))).first()[0]


def test_rental_rows_are_dealt_before_the_distinct(spark):
    sr = sheet_rows(spark, sheet(RENTAL_URL, "Table 1", 1, RENTAL_SHEET))
    out = load_rental(sr, "lga", rows=3_000_000)
    assert ", 12), REPARTITION_BY_NUM" in _plan(out)
    assert sorted(rows(out)) == sorted(rows(load_rental(sr, "lga")))


def test_a_period_is_read_once_per_file_name(spark):
    urls = ["https://x/d-dec-2020.xlsx", "https://x/d-march2021.xlsx", "https://x/d-sept2021.xlsx", "https://x/none.xlsx", None]
    sr = spark.createDataFrame([(u, "By SA2", 1, i, ["2", str(i)]) for u in urls for i in range(4)],
                               "source_url string, sheet_name string, sheet_no int, row_no int, cells array<string>")
    wanted = F.year(b.payment_month()) % 2 == 1
    out = b.of_months(sr, wanted)
    assert sorted(rows(out)) == sorted(rows(sr.filter(wanted))) and out.count() == 8
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "gettimestamp" not in plan.lower()


def test_rows_dealt_after_a_join_on_the_same_key_stay_dealt(spark):
    a, c = (spark.range(100).withColumnRenamed("id", k).hint("merge") for k in "ac")
    out = selection.dealt(a.join(c, F.col("a") == F.col("c")), "c", rows=90, per_task=30)  # 4 shuffle partitions
    assert "REPARTITION_BY_NUM" in _plan(out)
