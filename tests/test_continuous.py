from datetime import datetime

import pytest

import bars as B
from candlehouse.operators import facts
from candlehouse.operators.rollup import bucket_rollup, stale_buckets
from candlehouse.plans import continuous as K
from candlehouse.plans.periods import PeriodTable
from candlehouse.sources.tables import remove, table_exists


@pytest.mark.parametrize("grain,as_of,expected", [
    ("day", datetime(2024, 1, 15, 10, 30), (datetime(2024, 1, 13), datetime(2024, 1, 15))),
    ("day", datetime(2024, 1, 15, 0, 30), (datetime(2024, 1, 13), datetime(2024, 1, 14))),
    ("day", datetime(2024, 1, 15, 0, 0), (datetime(2024, 1, 12), datetime(2024, 1, 14))),
    ("hour", datetime(2024, 1, 15, 10, 30), (datetime(2024, 1, 14, 11), datetime(2024, 1, 15, 10))),
    ("hour", datetime(2024, 1, 15, 10, 10), (datetime(2024, 1, 14, 11), datetime(2024, 1, 15, 9))),
])
def test_range_holds_whole_buckets(grain, as_of, expected):
    assert K.refresh_range(grain, as_of) == expected


def fact(spark, *times):
    return facts.fact_union({"STOCK": B.stock(spark, *[B.stock_row(ts=t, open_=i + 1, close=i + 1) for i, t in enumerate(times)])})


@pytest.mark.parametrize("table_grain", ["day", "month"])
def test_refresh_touches_its_range_only(spark, tmp_path, table_grain):
    path = f"{tmp_path}/cagg"
    old = ("2024-01-05 10:00:00", "2024-01-14 10:00:00", "2024-02-01 10:00:00")
    K.build_rollup(fact(spark, *old), path, "day", table_grain)
    late = fact(spark, *old, "2024-01-05 11:00:00", "2024-01-13 09:00:00", "2024-01-14 11:00:00", "2024-02-01 11:00:00")
    K.refresh_rollup(late, path, "day", datetime(2024, 1, 13), datetime(2024, 1, 15), table_grain)
    stored = K.rollup_table(spark, path, table_grain).read()
    assert {(r.bucket.month, r.bucket.day): r.record_count for r in stored.collect()} == {
        (1, 5): 1, (1, 13): 1, (1, 14): 2, (2, 1): 1}
    stale = stale_buckets(stored, late, "day").collect()
    assert {(r.bucket.month, r.bucket.day): (r.stored_count, r.late_rows) for r in stale} == {(1, 5): (1, 1), (2, 1): (1, 1)}


def test_refresh_of_an_empty_range(spark, tmp_path):
    path = f"{tmp_path}/cagg"
    rows = fact(spark, "2024-01-05 10:00:00")
    K.build_rollup(rows, path, "hour")
    K.refresh_rollup(rows, path, "hour", datetime(2024, 1, 6), datetime(2024, 1, 6))
    assert K.rollup_table(spark, path).read().count() == 1


def test_an_emptied_month_is_gone(spark, tmp_path):
    path = f"{tmp_path}/cagg"
    K.build_rollup(fact(spark, "2024-01-05 10:00:00", "2024-02-05 10:00:00"), path, "day")
    K.refresh_rollup(fact(spark, "2024-01-05 10:00:00"), path, "day", datetime(2024, 2, 1), datetime(2024, 3, 1))
    assert [r.bucket.month for r in K.rollup_table(spark, path).read().collect()] == [1]


def test_a_refresh_that_died_while_it_replaced_a_month_is_finished(spark, tmp_path):
    """The stored bucket outside the range is in no fact here: only the folder beside the table still has it."""
    path = f"{tmp_path}/cagg"
    K.build_rollup(fact(spark, "2024-01-05 10:00:00", "2024-01-06 10:00:00"), path, "day")
    table = K.rollup_table(spark, path)

    class Died(Exception):
        pass

    def die(self, sort):
        if table_exists(spark, self._pending):
            remove(spark, f"{path}/trade_period=2024-01-01")  # swapped out, not yet in
            raise Died

    with pytest.MonkeyPatch.context() as m:
        m.setattr(PeriodTable, "finish", die)
        with pytest.raises(Died):
            K.refresh_rollup(fact(spark, "2024-01-06 11:00:00"), path, "day", datetime(2024, 1, 6), datetime(2024, 1, 7))
    assert table.read().count() == 0
    K.refresh_rollup(fact(spark, "2024-02-02 11:00:00"), path, "day", datetime(2024, 2, 2), datetime(2024, 2, 3))
    assert sorted((r.bucket.month, r.bucket.day) for r in table.read().collect()) == [(1, 5), (1, 6), (2, 2)]


def test_rollup_has_true_open_and_close(spark):
    row = bucket_rollup(fact(spark, "2024-01-05 10:00:00", "2024-01-05 09:00:00", "2024-01-05 11:00:00"), "day").first()
    assert (row.open, row.close, row.record_count) == (2, 3, 3)
