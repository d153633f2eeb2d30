"""A third of all rows on one key: results stay exact, the join is split."""

import pandas as pd
from pyspark.sql import functions as F

from arealens.operators.area import apportioned_distribution, area_series

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _data(spark, n=30000):
    # measure: area "hot" holds a third of the rows; others spread over 500 areas
    ids = spark.range(n)
    area = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string"))
    measure = ids.select(area.alias("sa1_7dig"), F.lit(2016).alias("year"),
                         (F.col("id") % 4).cast("string").alias("eq_income_yearly"),
                         (F.col("id") % 7).cast("string").alias("eq_income_weekly"),
                         (F.col("id") % 11).cast("double").alias("value"))
    # concordance: block "b0" holds a third of the rows, all in the hot area
    cc = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("b0")).otherwise((F.col("id") % 50 + 1).cast("string")).alias("block_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("sa1_7dig"),
        F.lit(0.25).alias("per_pct"), F.lit(2016).alias("year"))
    return measure, cc


def test_apportioned_distribution_under_a_hot_key(spark):
    measure, cc = _data(spark)
    blocks = ["b0"] + [str(i) for i in range(1, 51)]

    def run():
        out = apportioned_distribution(measure, cc, blocks, ordered=False)
        got = {(r.eq_income_yearly, r.eq_income_weekly): r.value for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        return got, plan

    got, plan = _with_conf(spark, SKEW_CONF, run)
    m, c = measure.toPandas(), cc.toPandas()
    j = m.merge(c[c.block_id.isin(blocks)], on=["sa1_7dig", "year"])
    want = (j.assign(w=j.value * j.per_pct).groupby(["eq_income_yearly", "eq_income_weekly"]).w.sum())
    assert got == {k: float(pd.Series([v]).round().iloc[0]) for k, v in want.items()}
    assert "SortMergeJoin" in plan
    assert "skew=true" in plan


def test_area_series_under_a_hot_area(spark):
    measure, cc = _data(spark)
    fact = measure.select(F.col("sa1_7dig").alias("sa2_5dig"), F.lit("n").alias("sa2_name"),
                          F.lit("May 2020").alias("month"), F.col("eq_income_weekly").alias("series"),
                          "value", F.lit(None).cast("date").alias("month_date"))
    concord = cc.select("block_id", F.col("sa1_7dig").alias("sa2_5dig"),
                        F.col("sa1_7dig").alias("sa2_main"), F.lit("n").alias("sa2_name"))
    out = _with_conf(spark, SKEW_CONF, lambda: area_series(fact, concord, ["b0"], ordered=False).collect())
    # distinct (area, series, value) of the hot area: 7 series x 11 values at most
    want = fact.filter("sa2_5dig = 'hot'").select("series", "value").distinct().count()
    assert len(out) == want
