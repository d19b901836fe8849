import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.plans import star as S
from strata.plans.calendar import date_spine, dim_date
from strata.queries.star import _wide


def test_spine_has_no_gaps(spark):
    days = [r.date_day for r in date_spine(spark, as_of="2024-01-31").orderBy("date_day").collect()]
    assert days[0] == dt.date(2020, 1, 1) and days[-1] == dt.date(2025, 1, 29)
    assert all((b - a).days == 1 for a, b in zip(days, days[1:]))
    with pytest.raises(ValueError):
        date_spine(spark, "2024-01-02", "2024-01-02")
    # Sentinel dates are covered too.
    assert date_spine(spark, "0001-01-01", last="9999-12-31").count() == 3_652_059


def test_calendar_against_python(spark):
    rows = dim_date(spark, "2024-02-29", "2019-12-20", "2025-01-15", fiscal_start_month=2).collect()
    for r in rows:
        d = r.date_day
        assert (r.year_number, r.month_number, r.day_of_month) == (d.year, d.month, d.day)
        assert (r.week_number, r.day_of_week_number) == (d.isocalendar()[1], d.isoweekday() % 7)
        assert (r.month_name, r.month_short, r.day_of_week_name, r.day_of_week_short) == tuple(
            d.strftime(f) for f in ("%B", "%b", "%A", "%a")
        )
        assert (r.year_month, r.day_of_year) == (d.strftime("%Y-%m"), d.timetuple().tm_yday)
        assert r.is_weekend == (d.weekday() > 4) and r.is_weekday != r.is_weekend
        assert r.week_start_date == d - dt.timedelta(days=d.weekday()) and (r.week_end_date - r.week_start_date).days == 6
        assert r.month_end_date + dt.timedelta(days=1) == (r.month_start_date + dt.timedelta(days=32)).replace(day=1)
        assert r.quarter_start_date <= d <= r.quarter_end_date and r.quarter_number == (d.month + 2) // 3
        assert (r.year_start_date, r.year_end_date) == (dt.date(d.year, 1, 1), dt.date(d.year, 12, 31))
        assert r.fiscal_year == (d.year if d.month >= 2 else d.year - 1)
        assert r.fiscal_month_number == (d.month - 2) % 12 + 1
    assert [r.date_day for r in rows if r.is_today] == [dt.date(2024, 2, 29)]
    assert [r.date_day for r in rows if r.is_yesterday] == [dt.date(2024, 2, 28)]
    assert len(rows[0]) == 30


def test_calendar_data_tests(spark):
    calendar = dim_date(spark, "2024-01-31")
    checks = Q.run_checks(calendar, [Q.not_null("date_sk"), Q.not_null("is_weekend"), Q.accepted_values("quarter_number", [1, 2, 3, 4])])
    unique = Q.check_unique(calendar, "date_sk").unionByName(Q.check_unique(calendar, "date_day"))
    Q.assert_checks(checks.unionByName(unique))


def test_wide_table_keeps_the_grain(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    wide = _wide(spark, data)
    assert wide.count() == orders.count() == wide.select("order_sk").distinct().count()


def test_wide_table_plan(spark, data, plan):
    text = plan(_wide(spark, data))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text and "o_orderpriority" not in text


def test_report_contract(spark):
    wide = spark.createDataFrame([("2024-01", dt.date(2024, 1, 1), 5), ("2024-01", dt.date(2024, 1, 3), 6)], "year_month string, date_day date, n int")
    types = {"year_month": "string", "total_records": "bigint", "s": "bigint", "period_start": "date", "period_end": "date"}
    report = S.report_build(wide, "year_month", {"s": F.sum("n")}, types)
    assert [tuple(r) for r in report.collect()] == [("2024-01", 2, 11, dt.date(2024, 1, 1), dt.date(2024, 1, 3))]
    with pytest.raises(ValueError):
        S.report_build(wide, "year_month", {"s": F.avg("n")}, types)
