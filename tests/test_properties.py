"""Properties of the area operators on generated inputs (small, exact)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arealens import schemas as S
from arealens.operators.area import apportioned_distribution, weighted_index
from arealens.operators.reshape import melt

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# area -> list of block shares (in quarters, so sums are exact)
areas = st.dictionaries(st.sampled_from(["a1", "a2", "a3"]),
                        st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1)
counts = st.dictionaries(st.tuples(st.sampled_from(["a1", "a2", "a3"]), st.sampled_from(["b1", "b2"])),
                         st.integers(0, 400), min_size=1)


@SETTINGS
@given(areas, counts)
def test_apportioning_a_full_partition_of_blocks_gives_the_area_totals(spark, shares, cnt):
    cc, block = [], 0
    for area, parts in shares.items():
        total = sum(parts)
        for p in parts:  # shares of one area sum to 1
            block += 1
            cc.append((str(block), area, area, 1, p / total, 2016))
    concord = spark.createDataFrame(cc, S.CBSA1MB)
    measure = spark.createDataFrame([(a, 2016, "y", b, float(v)) for (a, b), v in cnt.items()],
                                    S.SA1_INCOME)
    out = apportioned_distribution(measure, concord, [str(i) for i in range(1, block + 1)])
    got = {r.eq_income_weekly: r.value for r in out.collect()}
    want = {}
    for (a, b), v in cnt.items():
        if a in shares:
            want[b] = want.get(b, 0) + v
    assert got == {b: float(round(v)) for b, v in want.items()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 1000), st.integers(300, 1200)),
                min_size=1, max_size=8, unique_by=lambda t: t[0]))
def test_weighted_index_lies_between_the_area_values(spark, areas_):
    cc = [(f"b{a}", f"s{a}", f"s{a}", p, 1.0, 2016) for a, p, _ in areas_]
    idx = [(f"s{a}", "IRSD", "SCORE", float(v)) for a, _, v in areas_]
    out = weighted_index(spark.createDataFrame(idx, S.SA1_SEIFA),
                         spark.createDataFrame(cc, S.CBSA1MB), [c[0] for c in cc]).first()
    lo, hi = min(v for *_, v in areas_), max(v for *_, v in areas_)
    assert lo <= out.value <= hi


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=10))
def test_melt_keeps_the_total_and_the_row_count(spark, data):
    df = spark.createDataFrame([(str(i), a, b, c) for i, (a, b, c) in enumerate(data)],
                               "id string, a int, b int, c int")
    long = melt(df, ["id"], value_type="double")
    assert long.count() == 3 * len(data)
    total = sum(a + b + (c or 0) for a, b, c in data)
    assert (long.agg(F.sum("value")).first()[0] or 0) == total


@SETTINGS
@given(st.integers(1, 12), st.integers(1990, 2030))
def test_every_spelling_of_a_month_repairs_to_one_label(spark, month, year):
    import calendar
    import datetime as dt
    from arealens.functions.period import period_to_date, repair_period_label, sentence_case
    full = calendar.month_name[month].lower()
    spellings = [f"{full}-{year}", f"{full}{year}", f"{year}{month:02d}"]
    if month == 12:
        spellings += [f"dec-{year}", f"dec{year}"]
    if month == 9:
        spellings += [f"sept-{year}", f"sept{year}"]
    df = spark.createDataFrame([(x,) for x in spellings], "s string")
    label = repair_period_label(sentence_case("s"))
    got = df.select(label.alias("l"), period_to_date(label).alias("d")).collect()
    assert {r.l for r in got} == {f"{calendar.month_name[month]}-{year}"}
    assert {r.d for r in got} == {dt.date(year, month, 1)}
