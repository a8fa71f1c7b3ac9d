"""Survey operators on a small long table."""

import pytest

from tidemark.operators import risk_reports, survey


@pytest.fixture(scope="module")
def long(spark):
    rows = []
    for year, shift in ((2000, 0.0), (2001, 1.0)):
        for level, base in (("1-URGENT", 10.0), ("2-HIGH", 20.0), ("5-LOW", 20.0)):
            for region, dr in (("Rural", 0.0), ("Urban", 2.0)):
                for gender, dg in (("Male", 0.0), ("Female", -1.0 if year == 2000 else 3.0)):
                    rows.append((year, level, region, gender, base + shift + dr + dg))
    return spark.createDataFrame(rows, "year int, level string, region string, gender string, rate double")


def test_totals_and_pivot(long):
    full = survey.with_totals(long)
    assert full.count() == 24 + 6
    wide = survey.pivot_years(survey.only_totals(full), [2000, 2001]).collect()
    assert [r.level for r in wide] == ["1-URGENT", "2-HIGH", "5-LOW"]
    assert (wide[0].y2000, wide[0].y2001) == (10.5, 13.5)


def test_gap_ratio_and_extremes(long):
    last = long.where("year = 2001")
    gaps = survey.pivot_gap(last, "gender", ("Male", "Female")).collect()
    assert [r.gap for r in gaps] == [-3.0, -3.0, -3.0]
    totals = survey.only_totals(survey.with_totals(last))
    assert survey.cell_ratio(totals, "2-HIGH", "1-URGENT").first().ratio == 1.7
    row = survey.extremes(totals).first()
    assert (row.highest, row.lowest) == ("2-HIGH", "1-URGENT")


def test_changes_and_reversal(long):
    trend = survey.trend_by_level(survey.with_totals(long))
    change = {(r.level, r.year): r.change for r in survey.yearly_change(trend, "level").collect()}
    assert change[("1-URGENT", 2000)] is None and change[("1-URGENT", 2001)] == 3.0
    assert {r.year: r.reversed for r in survey.gap_reversals(long).collect()} == {2000: 0, 2001: 1}


def test_optional_filters(long):
    every = risk_reports.filter_portfolio(long, equals={"level": "All", "region": None})
    assert every.count() == 24
    some = risk_reports.filter_portfolio(long, equals={"level": "2-HIGH"}, among={"gender": ["Male"]}, at_most={"rate": 21.0})
    assert some.count() == 2
