"""Overlapping selections by classes, SQL table functions, flat files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from arealens import schemas as S
from arealens.operators.area import apportioned_distribution, weighted_index
from arealens.operators.classes import overlapping_distribution, overlapping_index, refine
from arealens.plans import catalog as C
from arealens.plans.sql import register_area_functions
from arealens.sources.flat import numbered_lines, read_flat_sheets
from fixtures import cbpostcodes, cbsa1mb, cbsa2, income, rows, seifa


def _selections(spark, n=40, blocks=12, seed=5):
    draw = random.Random(seed)
    pairs = [(f"s{i}", str(k)) for i in range(n) for k in range(blocks) if draw.random() < 0.4 or k % 4 == i % 4]
    return spark.createDataFrame(pairs + pairs[:5], "selection_id string, block_id string"), pairs


def test_refinement_puts_equal_memberships_together(spark):
    sel, pairs = _selections(spark)
    elements, groups = refine(sel, "block_id", "selection_id", "c")
    member = {}
    for s, k in pairs:
        member.setdefault(k, set()).add(s)
    by_class = {}
    for k, c in rows(elements, "block_id", "c"):
        by_class.setdefault(bytes(c), set()).add(k)
    assert sorted(map(sorted, by_class.values())) == sorted(
        sorted(k for k in member if member[k] == m) for m in {frozenset(v) for v in member.values()})
    got = {}
    for c, s in rows(groups, "c", "selection_id"):
        got.setdefault(bytes(c), set()).add(s)
    assert all(got[c] == member[k] for c, ks in by_class.items() for k in ks)
    none = refine(sel.limit(0), "block_id", "selection_id", "c")
    assert none[0].count() == none[1].count() == 0


def test_overlapping_selections_equal_the_plain_forms(spark):
    draw = random.Random(7)
    sel, _ = _selections(spark)
    cc = spark.createDataFrame([(str(draw.randrange(12)), f"a{draw.randrange(20)}", f"m{draw.randrange(9)}", draw.randrange(1, 50), 0.25, y)
                                for y in (2011, 2016) for _ in range(150)], S.CBSA1MB)
    cc = cc.withColumn("sa1_persons", (F.substring("sa1_main", 2, 2).cast("int") * 10 + 1).cast("long"))
    measure = spark.createDataFrame([(f"a{i}", y, "y", w, float(draw.randrange(90))) for i in range(20) for y in (2011, 2016)
                                     for w in ("Nil income", "800-999")], S.SA1_INCOME)
    index = spark.createDataFrame([(f"m{i}", t, "SCORE", float(draw.randrange(900, 1100))) for i in range(9) for t in ("IRSD", "IEO")]
                                  + [("m0", "IRSD", "SCORE", None)], S.SA1_SEIFA)
    want = apportioned_distribution(measure, cc, sel, years=None, ordered=False)
    assert sorted(rows(overlapping_distribution(measure, cc, sel))) == sorted(rows(want))
    only = apportioned_distribution(measure, cc, sel, years=[2016], ordered=False)
    assert sorted(rows(overlapping_distribution(measure, cc, sel, years=[2016]))) == sorted(rows(only))
    want = weighted_index(index, cc, sel, index_types=None, measures=None, years=None)
    assert sorted(rows(overlapping_index(index, cc, sel))) == sorted(rows(want))


def _names(spark):
    tables = {"concord.cbsa1mb": cbsa1mb(spark), "concord.cbsa2": cbsa2(spark), "concord.cbpostcodes": cbpostcodes(spark),
              "abs.sa1_tb_hh_equivalised_income": income(spark), "abs.sa1_seifa": seifa(spark),
              "dss.jobseeker_monthly_payments_sa2": spark.createDataFrame([("21105", "Carlton", "March 2020", "JobSeeker Payment", 7.0, None)], S.JOBSEEKER_SA2),
              "dss.jobkeeper_monthly_applications_pc": spark.createDataFrame([("3053", "March 2020", 7)], S.JOBKEEPER_PC),
              "dss.payment_types_qrt_pc": spark.createDataFrame([("3053", "March-2020", "Age Pension", 7.0, None)], S.PAYMENT_TYPES_PC),
              "dss.payment_types_qrt_sa2": spark.createDataFrame([("21105", "Carlton", "March-2020", "Age Pension", 7.0, None)], S.PAYMENT_TYPES_SA2),
              "lmip.sa2_salm": spark.createDataFrame([("206041117", "March 2011", "Unemployment rate", 4.5)], S.SA2_SALM)}
    names = {}
    for name, df in tables.items():
        names[name] = "t_" + name.replace(".", "_")
        df.createOrReplaceTempView(names[name])
    return tables, names


def test_sql_functions_equal_the_dataframe_forms(spark):
    tables, names = _names(spark)
    register_area_functions(spark, names)
    blocks = ["73", "74", "83"]
    sql = spark.sql("SELECT * FROM income_distribution(:b, array(2016))", args={"b": blocks})
    assert sorted(map(str, rows(sql))) == sorted(map(str, rows(C.income_distribution(spark, blocks, tables=tables))))
    sql = spark.sql("SELECT * FROM seifa_index(:b, array('IRSD'), array('SCORE'), array(2016))", args={"b": blocks})
    assert rows(sql) == rows(C.seifa_index(spark, blocks, tables=tables)) == [("IRSD", "SCORE", 980.0, 2016)]
    for table in C.SERIES_SCHEMAS:
        got = spark.sql(f"SELECT * FROM area_series_{table}(array('73', '74'))")
        want = C.area_time_series(spark, ["73", "74"], table, tables=tables)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 1
    joined = spark.sql("SELECT s.value, p.value AS index FROM area_series_payment_types_qrt_sa2(array('73')) s, "
                       "seifa_index(array('73'), array('IRSD'), array('SCORE'), array(2016)) p")
    assert rows(joined) == [(7.0, 1000.0)]  # functions are relations like any other


def test_sql_functions_check_their_arguments(spark):
    register_area_functions(spark, _names(spark)[1])
    for call in ("income_distribution(array('73'), array(2012))", "seifa_index(array('73'), array('X'), array('SCORE'), array(2016))",
                 "seifa_index(array('73'), array('IRSD'), array('X'), array(2016))"):
        with pytest.raises(Exception, match="should be one of"):
            spark.sql(f"SELECT * FROM {call}").collect()


def test_block_filter_of_a_sql_function_reaches_the_scan(spark, scratch):
    _, names = _names(spark)
    cbsa1mb(spark).write.parquet(scratch + "/cc")
    spark.read.parquet(scratch + "/cc").createOrReplaceTempView("stored_cc")
    register_area_functions(spark, {**names, "concord.cbsa1mb": "stored_cc"})
    plan = spark.sql("SELECT * FROM income_distribution(array('74', '73'), array(2016))")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "(block_id" in plan and "GreaterThanOrEqual(block_id,73)" in scan and "LessThanOrEqual(block_id" in scan.replace("LessT...", "LessThanOrEqual(block_id")
    assert "per_pct" in scan and "sa1_persons" not in scan


def test_flat_files_in_several_splits_come_back_as_sheet_rows(spark, scratch):
    lines = {f"f{k}.csv": ["A title", "", 'Code,"Name, in full",Value'] + [f'{i},"n ""{i}"", x",{i if i % 3 else ""}' for i in range(n)]
             for k, n in enumerate((3000, 1, 0, 700))}
    for name, body in lines.items():
        with open(os.path.join(scratch, name), "w") as f:
            f.write("\n".join(body) + ("\n" if name != "f3.csv" else ""))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        assert spark.read.text(scratch).rdd.getNumPartitions() > 8
        numbered = numbered_lines(spark, scratch, ".csv").collect()
        sheets = read_flat_sheets(spark, scratch, suffix=".csv")
        got = sheets.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = {}
    for r in numbered:
        found.setdefault(os.path.basename(r.file), {})[r.row_no] = r.line
    assert found == {n: dict(enumerate(body, 1)) for n, body in lines.items()}
    cells = {(r.sheet_name, r.row_no): r.cells for r in got}
    assert cells["f0", 1] == ["A title"] and cells["f0", 2] == [None] and cells["f0", 3] == ["Code", "Name, in full", "Value"]
    assert cells["f0", 3003] == ["2999", 'n "2999", x', "2999"] and cells["f0", 4] == ["0", 'n "0", x', None]
    assert cells["f3", 703] == ["699", 'n "699", x', None] and len(got) == sum(map(len, lines.values()))
    assert [f.dataType for f in sheets.schema] == [f.dataType for f in S.SHEET_ROWS]


def test_other_delimiters_and_a_load_from_flat_files(spark, scratch):
    from arealens.plans.payment_types import load_payment_types
    from fixtures import PAYMENT_SA2
    os.makedirs(scratch + "/in")
    with open(scratch + "/in/SA2.txt", "w") as f:
        f.write("\n".join(";".join(c or "" for c in row) for row in PAYMENT_SA2))
    sr = read_flat_sheets(spark, scratch + "/in", delimiter=";", source_url=F.lit("https://h/dss-demographics-december-2021.xlsx"))
    assert load_payment_types(sr, "sa2").count() == 3


def test_pages_that_leave_everything_open_are_read_in_linear_time(spark):
    import time

    from arealens.sources.links import first_link, link_inventory
    pages = [(1, "<a " + " ".join(f'x{i}="{i}"' for i in range(10_000)) + ' href="u1">t</a>'), (2, '<a "' * 100_000),
             (3, "<nav>" + "<b>" * 100_000 + "<a href=x>"), (4, "<!-- " * 100_000), (5, "<script>" * 50_000),
             (6, "<nav>" * 30_000 + '<a href="deep">' + "</nav>" * 30_000 + '<a href="after">')]
    df = spark.createDataFrame(pages, "page_id long, html string")
    start = time.time()
    assert rows(link_inventory(df), "page_id", "href") == [(1, "u1"), (3, "x"), (6, "deep"), (6, "after")]
    assert sorted(rows(link_inventory(df, container="nav"), "page_id", "href")) == [(3, "x"), (6, "deep")]
    assert first_link(df, container="#none").count() == 0
    assert time.time() - start < 60
    odd = spark.createDataFrame([(1, '<a data-href="no" href="yes"><a href=""><a href><a title="a>b" href=ok><a href="1" href="2"><a/href=\'s&amp;t\'>')],
                                "page_id long, html string")
    assert [r.href for r in link_inventory(odd).collect()] == ["yes", "", "ok", "1", "s&t"]
