"""Calendar spine and date dimension against a brute-force Python calendar."""

from __future__ import annotations

import datetime as dt

from tessera.operators.calendar import date_dimension, date_spine, spine_days


def test_spine_excludes_end(spark):
    assert spine_days("2015-01-01", "2030-01-01") == 5479
    days = date_spine(spark).orderBy("date_day").collect()
    assert len(days) == 5479
    assert days[0].date_day == dt.date(2015, 1, 1)
    assert days[-1].date_day == dt.date(2029, 12, 31)


def test_date_dimension_matches_python_calendar(spark):
    rows = {r.date_day: r for r in date_dimension(spark).collect()}
    assert len(rows) == 5479
    d = dt.date(2015, 1, 1)
    while d < dt.date(2030, 1, 1):
        r = rows[d]
        iso = d.isocalendar()
        nxt = d + dt.timedelta(days=1)
        assert r.date_key == d.year * 10000 + d.month * 100 + d.day
        assert (r.year, r.month, r.day_of_month) == (d.year, d.month, d.day)
        assert r.quarter == (d.month - 1) // 3 + 1
        assert r.day_of_week == iso[2]
        assert r.week_of_year == iso[1]
        assert r.day_of_year == d.timetuple().tm_yday
        assert r.is_weekend == (iso[2] >= 6)
        assert r.is_month_end == (nxt.month != d.month)
        assert r.month_name == d.strftime("%B").ljust(9)
        assert r.day_name == d.strftime("%A").ljust(9)
        d = nxt


def test_calendar_edges(spark):
    rows = {r.date_day: r for r in date_dimension(spark).collect()}
    assert rows[dt.date(2016, 2, 29)].is_month_end
    assert rows[dt.date(2021, 1, 1)].week_of_year == 53
