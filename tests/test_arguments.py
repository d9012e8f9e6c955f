from datetime import datetime

import pytest

from candlehouse.functions.arguments import (
    check_days, check_hours_back, parse_asset_types, positive, range_bounds, select_asset_types,
)

ALL = ["STOCK", "FOREX", "CRYPTO"]


@pytest.mark.parametrize("text,expected", [
    (None, ALL), ("", ALL), (" , ", ALL), (" stock, ,Foo", ["STOCK"]), ("Foo,bar", []), ("crypto,STOCK", ["STOCK", "CRYPTO"]),
])
def test_asset_types(text, expected):
    assert select_asset_types(parse_asset_types(text)) == expected


@pytest.mark.parametrize("hours,expected", [(-1, 2), (0, 2), (1, 1), (168, 168), (169, 168)])
def test_hours_back(hours, expected):
    used, warning = check_hours_back(hours)
    assert used == expected and (warning is None) == (hours == expected)


@pytest.mark.parametrize("days,upper,expected", [(0, 365, 1), (30, 365, 30), (400, 365, 365), (9999, 5000, 5000)])
def test_days(days, upper, expected):
    assert check_days(days, upper)[0] == expected


def test_warning():
    assert check_days(30, 5000)[1] is None
    assert "at least 1" in check_days(0, 5000)[1]
    assert "cannot exceed 5000" in check_days(5001, 5000)[1]


def test_operators_refuse_what_makes_no_sense_and_take_the_rest():
    assert positive("days", 10_000) == 10_000
    with pytest.raises(ValueError):
        positive("days", 0)


def test_range_is_inclusive():
    assert range_bounds("2024-01-10", "2024-01-10") == (datetime(2024, 1, 10), datetime(2024, 1, 11))


def test_malformed_end_date_is_refused():
    with pytest.raises(ValueError):
        range_bounds("2024-01-10", "10.01.2024")
