"""The marts as sums that add up, and what changed rows add to or take from them.

A mart's own columns cannot be corrected in place: totals are rounded, a ratio does not add up, and a total without
any amount is NULL, not zero. So each mart has a table of exact sums per group, from which its columns follow. A
changed row then counts twice: its old image with sign -1, its new one with +1; a group without rows is gone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import ratio, to_money_total
from cdclake.operators.marts import revenue_sums

SIGN = "__sign"
MONEY = T.DecimalType(38, 2)
Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class MartSums:
    """``inputs`` are the columns that a mart needs of each table; ``measures`` the sums and their types, the first one
    the number of rows. ``sums`` makes them from signed rows; with ``by`` the mart is made from all rows of that key
    together, so the keys that changed are taken out as they were and put in as they are."""

    inputs: Mapping[str, Sequence[str]]
    keys: Sequence[str]
    measures: Mapping[str, T.DataType]
    sums: Callable[[Frames], DataFrame]
    final: Callable[[DataFrame], DataFrame]
    by: str | None = None

    @property
    def day(self) -> str:
        return self.keys[0]

    def whole(self, tables: Frames) -> DataFrame:
        """All groups from whole tables."""
        return self._typed(self.sums({n: t.withColumn(SIGN, F.lit(1)) for n, t in tables.items()}))

    def delta(
        self, images: Frames, old: Frames, new: Frames, keep: Callable[[DataFrame], DataFrame], held: DataFrame
    ) -> DataFrame:
        """Signed sums of the groups that differ. ``images`` are the tables' changed rows, see :func:`signed_images`;
        ``held`` are the sums of all old rows.

        ``keep`` writes a frame and reads it back: the touched keys are used by each table on both sides, and Spark
        then knows their size when it joins. Where they are most of all keys, what is held is taken from the sums of
        all new rows: that moves every row once, where the touched ones of both sides would be more.
        """
        if self.by is None:
            parts = [self._typed(self.sums(images))]
        else:
            ids = [i.select(self.by).where(F.col(self.by).isNotNull()) for i in images.values()]
            touched = ids[0]
            for more in ids[1:]:
                touched = touched.unionByName(more)
            touched = keep(touched.distinct())
            if self._are_most(touched, new):
                before, after = held, self.whole(new)
            else:
                before, after = (
                    self.whole({n: t.join(touched, self.by, "left_semi") for n, t in side.items()}) for side in (old, new)
                )
            parts = [before.select(*self.keys, *[(-F.col(m)).alias(m) for m in self.measures]), after]
        differs = F.lit(False)
        for m in self.measures:
            differs = differs | (F.col(m) != 0)
        return self._added(parts).where(differs)

    def _are_most(self, touched: DataFrame, new: Frames) -> bool:
        """Whether the touched keys are half of all keys or more. An estimate will do: either way the sums are the same."""
        keys, *others = [t.select(self.by) for t in new.values()]
        for more in others:
            keys = keys.unionByName(more)
        return 2 * touched.count() >= keys.agg(F.approx_count_distinct(self.by)).first()[0]

    def add(self, sums: DataFrame, delta: DataFrame) -> DataFrame:
        """The sums after a delta; groups that have no rows any more are gone."""
        return self._added([sums, delta]).where(F.col(next(iter(self.measures))) > 0)

    def mart(self, sums: DataFrame) -> DataFrame:
        return self.final(sums)

    def _added(self, parts: Sequence[DataFrame]) -> DataFrame:
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        return self._typed(rows.groupBy(*self.keys).agg(*[F.sum(m).alias(m) for m in self.measures]))

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select(*self.keys, *[F.col(m).cast(t).alias(m) for m, t in self.measures.items()])


def signed_images(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of the rows in which two versions of a table differ: as they were with sign -1, as they are with +1.

    Both sides have one row per key. Snapshots in buckets by key are joined in place, nothing is shuffled.
    """
    left = old.select(key, F.struct(*columns).alias("__old"))
    right = new.select(key, F.struct(*columns).alias("__new"))
    both = left.join(right, key, "full_outer").where(~F.col("__old").eqNullSafe(F.col("__new")))
    signed = F.array(
        F.struct(F.lit(-1).alias(SIGN), F.col("__old").alias("row")),
        F.struct(F.lit(1).alias(SIGN), F.col("__new").alias("row")),
    )
    images = both.select(F.explode(signed).alias("image")).where(F.col("image.row").isNotNull())
    return images.select(f"image.{SIGN}", *[F.col(f"image.row.{c}").alias(c) for c in columns])


def _counted(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col(SIGN)).otherwise(0))


def _bookings(tables: Frames) -> DataFrame:
    by = [F.to_date("created_at").alias("booking_date"), "booking_channel"]
    return tables["pnr_records"].groupBy(*by).agg(F.sum(SIGN).alias("total_bookings"))


def _cancellations(tables: Frames) -> DataFrame:
    cancelled = _counted(F.col("booking_status") == "CANCELLED")
    return (
        tables["pnr_records"]
        .groupBy(F.to_date("created_at").alias("booking_date"))
        .agg(F.sum(SIGN).alias("total_bookings"), cancelled.alias("cancelled_bookings"))
    )


def _payments(tables: Frames) -> DataFrame:
    by = [F.to_date("created_at").alias("payment_date"), "payment_method", "payment_status"]
    amount = F.when(F.col(SIGN) < 0, -F.col("amount")).otherwise(F.col("amount"))
    return tables["payments"].groupBy(*by).agg(
        F.sum(SIGN).alias("payment_count"),
        _counted(F.col("amount").isNotNull()).alias("amounts"),
        F.coalesce(F.sum(amount).cast(MONEY), F.lit(0).cast(MONEY)).alias("amount"),
    )


def _revenue(tables: Frames) -> DataFrame:
    return revenue_sums(tables["flight_segments"], tables["payments"])


_COUNT = T.LongType()

MART_SUMS: dict[str, MartSums] = {
    "daily_booking_summary": MartSums(
        {"pnr_records": ("created_at", "booking_channel")},
        ("booking_date", "booking_channel"),
        {"total_bookings": _COUNT},
        _bookings,
        lambda sums: sums,
    ),
    "daily_cancellation_rate": MartSums(
        {"pnr_records": ("created_at", "booking_status")},
        ("booking_date",),
        {"total_bookings": _COUNT, "cancelled_bookings": _COUNT},
        _cancellations,
        lambda sums: sums.withColumn(
            "cancellation_rate", ratio(F.col("cancelled_bookings"), F.col("total_bookings"))
        ),
    ),
    "revenue_by_route": MartSums(
        {
            "flight_segments": ("pnr_id", "flight_date", "origin_airport", "dest_airport"),
            "payments": ("pnr_id", "amount", "payment_status"),
        },
        ("flight_date", "origin_airport", "dest_airport"),
        {"total_bookings": _COUNT, "revenue": T.DecimalType(38, 18)},
        _revenue,
        lambda sums: sums.select(
            "flight_date",
            "origin_airport",
            "dest_airport",
            to_money_total(F.col("revenue")).alias("total_revenue"),
            "total_bookings",
        ),
        by="pnr_id",
    ),
    "payment_status_summary": MartSums(
        {"payments": ("created_at", "payment_method", "payment_status", "amount")},
        ("payment_date", "payment_method", "payment_status"),
        {"payment_count": _COUNT, "amounts": _COUNT, "amount": MONEY},
        _payments,
        lambda sums: sums.select(
            "payment_date",
            "payment_method",
            "payment_status",
            "payment_count",
            to_money_total(F.when(F.col("amounts") > 0, F.col("amount"))).alias("total_amount"),
        ),
    ),
}
