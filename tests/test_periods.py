from __future__ import annotations

from datetime import date

from hypothesis import given
from hypothesis import strategies as st

from tallyloom import periods
from tallyloom.operators import matrix

days = st.dates(date(1990, 1, 1), date(2090, 12, 31))


def test_january_looks_back_into_last_year():
    day = date(2001, 1, 10)
    assert periods.trailing_months(day, 2) == [200012, 200011]
    assert periods.ytd_span(day) == (200101, 200100)
    assert periods.month_label(200012, "{mon}_{yy} Target") == "Dec_00 Target"


@given(days)
def test_trailing_months_are_consecutive_and_complete(day):
    months = periods.trailing_months(day, 24)
    assert months[0] < periods.period_of(day)
    assert periods.next_period(months[0]) == periods.period_of(day)
    assert all(periods.next_period(b) == a for a, b in zip(months, months[1:]))


@given(days)
def test_slices_partition_every_bucket(day):
    """Each period of a bucket lies in exactly one slice, and in none too many."""
    units = {"U": "u"}
    buckets = [
        *matrix.monthly(day, "U", "{mon}_{yyyy}"),
        *matrix.ytd(day, units),
        *matrix.trailing(day, 12, units),
        *matrix.trailing(day, 4, units),
        *matrix.yearly(day, "U", "{yyyy}"),
    ]
    slices = matrix._slices(buckets)
    span = [y * 100 + m for y in range(day.year - 4, day.year + 1) for m in range(1, 13)]
    for bucket in buckets:
        for period in span:
            inside = bucket.first <= period <= bucket.last
            first, end = matrix._half_open(bucket)
            hits = [
                1
                for _, low, after in slices
                if low <= period < after and first <= low and after <= end
            ]
            assert sum(hits) == int(inside)
