"""Delivery reads: withdrawals, incomplete files, and that later rows never change what an earlier cutoff saw."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitframe.functions import clock
from pitframe.operators import bitemporal as bt

DAY = "2024-03-04"
EVENT = "isin string, series string, trade_date date, version_no bigint, close_cents bigint, is_tombstone boolean, availability_inferred boolean, offset_days int"
DELIVERY = "isin string, series string, trade_date date, version_no bigint, delivery_qty bigint, is_tombstone boolean, availability_inferred boolean, quarantined boolean, offset_days int"


def stamped(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("usable_from", clock.at_ist(F.expr("date_add(trade_date, offset_days)"), "18:00")).drop("offset_days")


def read(spark, deliveries, coverage, how="history"):
    day = dt.date.fromisoformat(DAY)
    prices = stamped(spark, [("I1", "EQ", day, 1, 100, False, False, 0)], EVENT)
    d = stamped(spark, [("I1", "EQ", day, *r) for r in deliveries], DELIVERY)
    c = stamped(spark, [(day, *r) for r in coverage], "trade_date date, complete boolean, offset_days int")
    rows = bt.history_known_as_of(prices, d, c, "2024-03-08") if how == "history" else bt.point_in_time_panel(prices, d, c, DAY, "2024-03-08")
    r = rows.first()
    return r["delivery_state"], r["delivery_qty"], r["delivery_missing_reason"]


@pytest.mark.parametrize("how", ["history", "panel"])
def test_withdrawn_delivery_is_missing(spark, how):
    withdrawn = [(1, 5, False, False, False, 0), (2, None, True, False, False, 0)]
    assert read(spark, withdrawn, [(True, 0)], how) == ("missing", None, "absent_in_covered_file")
    assert read(spark, withdrawn[:1], [(True, 0)], how) == ("known", 5, None)


@pytest.mark.parametrize("how", ["history", "panel"])
def test_only_complete_files_cover(spark, how):
    assert read(spark, [], [(False, 0)], how)[2] == "no_source_coverage"
    assert read(spark, [], [(False, 0), (True, 1)], how)[2] == "absent_in_covered_file"
    assert read(spark, [(1, 5, False, False, True, 0)], [(True, 0)], how)[2] == "quarantined"
    # a quarantined row alone covers nothing
    assert read(spark, [(1, 5, False, False, True, 0)], [], how)[2] == "no_source_coverage"


def test_later_rows_change_nothing(spark):
    now = [(1, 5, False, False, False, 0)]
    later = now + [(2, 9, False, False, False, 30), (3, None, True, False, False, 31)]
    assert read(spark, later, [(True, 0), (True, 40)]) == read(spark, now, [(True, 0)])
