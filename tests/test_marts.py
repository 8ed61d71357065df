import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from cdclake.operators.marts import (
    daily_booking_summary,
    daily_cancellation_rate,
    payment_status_summary,
    revenue_by_route,
)
from conftest import rows
from util import at

DAY, NEXT = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def segments(spark, data):
    return spark.createDataFrame(
        data, "pnr_id string, flight_date date, origin_airport string, dest_airport string"
    )


def payments(spark, data):
    data = [(p, Decimal(a) if a is not None else None, s) for p, a, s in data]
    return spark.createDataFrame(data, "pnr_id string, amount decimal(12,2), payment_status string")


def test_summary_and_midnight(spark):
    pnr = spark.createDataFrame(
        [
            ("WEB", at("2024-01-05 23:59:59.999")),
            ("WEB", at("2024-01-05 00:00:00")),
            ("WEB", at("2024-01-06 00:00:00")),
            (None, at("2024-01-06 00:00:00")),
            ("APP", None),
        ],
        "booking_channel string, created_at timestamp",
    )
    assert rows(daily_booking_summary(pnr)) == sorted(
        [(DAY, "WEB", 2), (NEXT, "WEB", 1), (NEXT, None, 1), (None, "APP", 1)], key=repr
    )


def test_cancellation_counts_only_the_given_statuses(spark):
    pnr = spark.createDataFrame(
        [(s, at("2024-01-05 10:00:00")) for s in ("CANCELLED", "REFUNDED", "TICKETED", None)],
        "booking_status string, created_at timestamp",
    )
    assert rows(daily_cancellation_rate(pnr)) == [(DAY, 4, 1, 0.25)]
    both = daily_cancellation_rate(pnr, statuses=("CANCELLED", "REFUNDED"))
    assert rows(both) == [(DAY, 4, 2, 0.5)]


def test_payment_summary_types(spark):
    df = spark.createDataFrame(
        [
            (at("2024-01-05 10:00:00"), "CASH", "SUCCESS", Decimal("0.01")),
            (at("2024-01-05 11:00:00"), "CASH", "SUCCESS", Decimal("9999999999.99")),
            (at("2024-01-05 11:00:00"), None, "FAILED", None),
        ],
        "created_at timestamp, payment_method string, payment_status string, amount decimal(12,2)",
    )
    got = payment_status_summary(df)
    assert got.schema["total_amount"].dataType.simpleString() == "decimal(16,2)"
    assert rows(got) == sorted(
        [(DAY, "CASH", "SUCCESS", 2, Decimal("10000000000.00")), (DAY, None, "FAILED", 1, None)],
        key=repr,
    )


def test_revenue_edge_rows(spark):
    seg = segments(
        spark,
        [
            ("two", DAY, "HAN", "SGN"),  # round trip over two days
            ("two", NEXT, "SGN", "HAN"),
            ("three", DAY, "HAN", "SGN"),  # 100.00 split in three, twice on one route
            ("three", DAY, "HAN", "SGN"),
            ("three", DAY, "SGN", "DAD"),
            ("unpaid", DAY, "HAN", "SGN"),
            ("refunded", DAY, "HAN", "SGN"),
            ("null amount", NEXT, "DAD", "HAN"),
            (None, DAY, "HAN", "SGN"),
        ],
    )
    pay = payments(
        spark,
        [
            ("two", "60.00", "SUCCESS"),  # two payments for one booking
            ("two", "40.00", "SUCCESS"),
            ("two", "99.00", "FAILED"),
            ("three", "100.00", "SUCCESS"),
            ("refunded", "80.00", "REFUNDED"),
            ("no segments", "70.00", "SUCCESS"),
            ("null amount", None, "SUCCESS"),
            (None, "5.00", "SUCCESS"),
        ],
    )
    got = revenue_by_route(seg, pay)
    assert got.schema["total_revenue"].dataType.simpleString() == "decimal(16,2)"
    assert rows(got) == sorted(
        [
            (DAY, "HAN", "SGN", Decimal("116.67"), 2),
            (NEXT, "SGN", "HAN", Decimal("50.00"), 1),
            (DAY, "SGN", "DAD", Decimal("33.33"), 1),
            (NEXT, "DAD", "HAN", Decimal("0.00"), 1),
        ],
        key=repr,
    )


def test_revenue_of_a_booking_with_a_third_of_all_segments(spark):
    """Against plain decimal arithmetic, with one booking far larger than the others."""
    n = 3000
    seg = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("pnr_id"),
        F.date_add(F.lit(DAY), (F.col("id") % 2).cast("int")).alias("flight_date"),
        (F.col("id") % 7).cast("string").alias("origin_airport"),
        (F.col("id") % 5).cast("string").alias("dest_airport"),
    )
    pay = [("hot", "9999999.37", "SUCCESS")]
    pay += [(str(i), str(Decimal(i * 37 % 1009) / 100 - 2), "SUCCESS") for i in range(700)]
    got = revenue_by_route(seg, payments(spark, pay))

    all_rows = seg.collect()
    count = defaultdict(int)
    for r in all_rows:
        count[r.pnr_id] += 1
    amount = {p: Decimal(a) for p, a, _ in pay}
    unit = Decimal(1).scaleb(-18)
    total, bookings = defaultdict(Decimal), defaultdict(set)
    for r in all_rows:
        route = (r.flight_date, r.origin_airport, r.dest_airport)
        total[route] += (amount[r.pnr_id] / count[r.pnr_id]).quantize(unit, ROUND_HALF_UP)
        bookings[route].add(r.pnr_id)
    cents = Decimal("0.01")
    want = [(*k, v.quantize(cents, ROUND_HALF_UP), len(bookings[k])) for k, v in total.items()]
    assert rows(got) == sorted(want, key=repr)


def test_segments_are_scanned_once_and_combined_before_the_shuffle(spark, tmp_path):
    segments(spark, [("a", DAY, "HAN", "SGN")]).write.parquet(str(tmp_path / "s"))
    payments(spark, [("a", "1.00", "SUCCESS")]).write.parquet(str(tmp_path / "p"))
    df = revenue_by_route(
        spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "p"))
    )
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan
    assert "partial_count(1)" in plan
    assert "PushedFilters: [IsNotNull(payment_status), EqualTo(payment_status,SUCCESS)" in plan
