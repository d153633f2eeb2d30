import __spark_entry__ as entry
from arealens.plans.registry import QUERIES


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["selection_id", "eq_income_weekly", "eq_income_yearly", "value", "year"]
    assert df.count() > 0


def test_every_library_query_has_an_oracle(spark):
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
