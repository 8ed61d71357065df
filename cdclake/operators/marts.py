"""The four gold marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import case_flag, ratio, to_money_total


def daily_booking_summary(pnr_records: DataFrame) -> DataFrame:
    """Bookings per creation day and channel."""
    return pnr_records.groupBy(
        F.to_date("created_at").alias("booking_date"), "booking_channel"
    ).agg(F.count("*").alias("total_bookings"))


def daily_cancellation_rate(
    pnr_records: DataFrame, statuses: Sequence[str] = ("CANCELLED",)
) -> DataFrame:
    """Bookings, cancellations and their ratio per creation day.

    Only the given statuses count as cancelled. A paid booking that was cancelled ends as
    REFUNDED and is therefore not counted by default.
    """
    cancelled = F.sum(case_flag(F.col("booking_status").isin(list(statuses))))
    return (
        pnr_records.groupBy(F.to_date("created_at").alias("booking_date"))
        .agg(F.count("*").alias("total_bookings"), cancelled.alias("cancelled_bookings"))
        .withColumn("cancellation_rate", ratio(F.col("cancelled_bookings"), F.col("total_bookings")))
    )


def payment_status_summary(payments: DataFrame) -> DataFrame:
    """Payments and amounts per creation day, method and status."""
    return payments.groupBy(
        F.to_date("created_at").alias("payment_date"), "payment_method", "payment_status"
    ).agg(
        F.count("*").alias("payment_count"),
        to_money_total(F.sum("amount")).alias("total_amount"),
    )


def revenue_by_route(
    flight_segments: DataFrame, payments: DataFrame, paid: str = "SUCCESS"
) -> DataFrame:
    """Paid revenue and distinct bookings per flight day and route.

    A booking's paid total is split evenly over its segments (to 18 decimals, rounded half up);
    bookings without a successful payment drop out.

    Segments are first counted per (booking, day, route). That collapses a booking with very
    many segments before anything is shuffled by booking, and leaves one row per booking and
    route, so counting rows replaces a distinct count. The per-booking segment count is rolled
    up from the same shuffled rows.
    """
    return revenue_sums(flight_segments, payments, paid).select(
        "flight_date",
        "origin_airport",
        "dest_airport",
        to_money_total(F.col("revenue")).alias("total_revenue"),
        "total_bookings",
    )


def revenue_sums(
    flight_segments: DataFrame, payments: DataFrame, paid: str = "SUCCESS"
) -> DataFrame:
    """:func:`revenue_by_route` before its totals are rounded, so that they add up."""
    route = ["flight_date", "origin_airport", "dest_airport"]
    # NULL booking ids match no payment; as a partial-aggregate key they would only be carried along.
    legs = (
        flight_segments.where(F.col("pnr_id").isNotNull())
        .groupBy("pnr_id", *route)
        .agg(F.count("*").alias("legs"))
    )
    segment_count = legs.groupBy("pnr_id").agg(F.sum("legs").alias("segment_count"))
    paid_total = (
        payments.where((F.col("payment_status") == paid) & F.col("pnr_id").isNotNull())
        .groupBy("pnr_id")
        .agg(F.sum("amount").alias("total_amount"))
    )
    share = F.coalesce("total_amount", F.lit(0).cast(T.DecimalType(22, 2))) / F.col("segment_count")
    per_booking = segment_count.join(paid_total, "pnr_id").select("pnr_id", share.alias("share"))
    part = F.when(F.col("legs") == 1, F.col("share")).otherwise(
        _times(F.col("share"), F.col("legs"))
    )
    return (
        legs.join(per_booking, "pnr_id")
        .groupBy(*route)
        .agg(F.sum(part).alias("revenue"), F.count("*").alias("total_bookings"))
    )


def _times(amount: Column, n: Column) -> Column:
    """``amount x n`` for DECIMAL(38,18) and BIGINT without losing a digit.

    The whole and fractional parts are multiplied apart; as a single product of two wide
    decimals Spark would cut the scale to 6.
    """
    amount = amount.cast(T.DecimalType(37, 18))
    whole = F.floor(amount).cast(T.DecimalType(18, 0))
    fraction = (amount - whole).cast(T.DecimalType(18, 18))
    times = n.cast(T.DecimalType(18, 0))
    exact = T.DecimalType(37, 18)
    return (whole * times).cast(exact) + (fraction * times).cast(exact)
