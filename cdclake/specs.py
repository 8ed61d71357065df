"""Table specifications: one record per entity drives every operator in the package."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Columns that the capture path adds to every flattened change.
DELETED = "__deleted"
OP = "__op"
TABLE = "__table"
SOURCE_TS = "__source_ts_ms"
EVENT_DATE = "event_date"

CHANGE_FIELDS = (
    T.StructField(DELETED, T.StringType()),
    T.StructField(OP, T.StringType()),
    T.StructField(TABLE, T.StringType()),
    T.StructField(SOURCE_TS, T.LongType()),
    T.StructField(EVENT_DATE, T.StringType()),
)
# What a silver state row keeps of the change that produced it.
STATE_FIELDS = (
    T.StructField(OP, T.StringType()),
    T.StructField(SOURCE_TS, T.LongType()),
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """Everything an operator needs to know about one table.

    ``month_of`` names the column whose calendar month partitions silver. ``version_column``
    is the row's own modification time and breaks ties between changes that share a source
    time. ``seq_column`` names the log sequence, if the capture adds one: it then is part of change files,
    time. ``seq_column`` names the log sequence, if the capture adds one: it then is part of change files,
    bronze and silver's state, and orders changes of one source time. ``added`` names the columns that came later,
    with the types the files have. ``compare`` maps the reconciled status column to its (source, target) output names.
    """

    name: str
    schema: T.StructType
    pk: str
    month_of: str | None = None
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict, hash=False)
    foreign_keys: tuple[ForeignKey, ...] = ()
    defaults: Mapping[str, str] = field(default_factory=dict, hash=False)
    version_column: str | None = None
    seq_column: str | None = None
    status_column: str | None = None
    added: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def non_key_columns(self) -> list[str]:
        return [c for c in self.columns if c != self.pk]

    @property
    def change_schema(self) -> T.StructType:
        """Schema of a flattened change, which is also the bronze schema."""
        *captured, day = CHANGE_FIELDS  # the partition column of bronze comes last
        return T.StructType([*self.schema.fields, *captured, *self._sequence, day])

    @property
    def _sequence(self) -> list[T.StructField]:
        return [T.StructField(self.seq_column, T.LongType())] if self.seq_column else []

    @property
    def file_schema(self) -> T.StructType:
        """Schema of a change file: like bronze, but decimals are still doubles."""
        return T.StructType(
            [
                T.StructField(f.name, T.DoubleType())
                if isinstance(f.dataType, T.DecimalType) and f.name not in self.added
                else T.StructField(f.name, f.dataType)
                for f in self.change_schema
            ]
        )

    def widened(self, fields: Iterable[T.StructField]) -> TableSpec:
        """The same table with more columns behind the others, all nullable."""
        more = [T.StructField(f.name, f.dataType) for f in fields]
        return replace(
            self, schema=T.StructType([*self.schema.fields, *more]), added=(*self.added, *(f.name for f in more))
        )

    @property
    def state_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *STATE_FIELDS, *self._sequence])

    @property
    def envelope_schema(self) -> T.StructType:
        """Schema of one change event before it is flattened."""
        row = T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in self.schema])
        source = T.StructType(
            [T.StructField("ts_ms", T.LongType()), T.StructField("table", T.StringType())]
        )
        return T.StructType(
            [
                T.StructField("before", row),
                T.StructField("after", row),
                T.StructField("source", source),
                T.StructField("op", T.StringType()),
                T.StructField("ts_ms", T.LongType()),
            ]
        )

    @property
    def month_column(self) -> str | None:
        return f"{self.month_of}_month" if self.month_of else None

    @property
    def silver_name(self) -> str:
        return f"{self.name}_clean"

    def with_long_ids(self) -> TableSpec:
        """The same table with BIGINT instead of INT ids, for tables beyond 2^31 rows."""
        ids = {self.pk, *(fk.column for fk in self.foreign_keys)}
        fields = [
            T.StructField(f.name, T.LongType(), f.nullable)
            if f.name in ids and isinstance(f.dataType, T.IntegerType)
            else f
            for f in self.schema
        ]
        return replace(self, schema=T.StructType(fields))


def _wire_type(data_type: T.DataType) -> T.DataType:
    """Type a column has inside an envelope: decimals travel as doubles, times as epoch millis."""
    if isinstance(data_type, T.DecimalType):
        return T.DoubleType()
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return T.LongType()
    if isinstance(data_type, T.DateType):
        return T.IntegerType()
    return data_type


def parse_schema(ddl: str) -> T.StructType:
    """``name TYPE[!], …`` to a StructType; ``!`` marks NOT NULL. Needs no running session."""
    simple = {
        "STRING": T.StringType(),
        "INT": T.IntegerType(),
        "BIGINT": T.LongType(),
        "DOUBLE": T.DoubleType(),
        "DATE": T.DateType(),
        "TIMESTAMP": T.TimestampType(),
        "MONEY": T.DecimalType(12, 2),
        "TOTAL": T.DecimalType(16, 2),
    }
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, simple[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


_PNR = ForeignKey("pnr_id", "pnr_records", "pnr_id")

# The six operational tables, their columns, keys and value domains.
_BOOKING_STATES = ("CREATED", "TICKETED", "CHANGED", "CANCELLED", "REFUNDED")

ENTITIES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            name="pnr_records",
            schema=parse_schema(
                "pnr_id STRING!, booking_channel STRING, booking_status STRING,"
                "created_at TIMESTAMP, updated_at TIMESTAMP"
            ),
            pk="pnr_id",
            not_null=("booking_channel", "booking_status"),
            domains={"booking_status": _BOOKING_STATES},
            version_column="updated_at",
            status_column="booking_status",
        ),
        TableSpec(
            name="passengers",
            schema=parse_schema(
                "passenger_id INT!, pnr_id STRING!, first_name STRING, last_name STRING,"
                "email STRING, passport_number STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
            ),
            pk="passenger_id",
            not_null=("pnr_id", "first_name", "last_name", "passport_number"),
            foreign_keys=(_PNR,),
            version_column="updated_at",
        ),
        TableSpec(
            name="flight_segments",
            schema=parse_schema(
                "segment_id INT!, pnr_id STRING!, origin_airport STRING, dest_airport STRING,"
                "flight_date DATE, airline_code STRING, flight_number STRING,"
                "created_at TIMESTAMP, updated_at TIMESTAMP"
            ),
            pk="segment_id",
            month_of="flight_date",
            not_null=(
                "pnr_id",
                "origin_airport",
                "dest_airport",
                "flight_date",
                "airline_code",
                "flight_number",
            ),
            foreign_keys=(_PNR,),
            version_column="updated_at",
        ),
        TableSpec(
            name="tickets",
            schema=parse_schema(
                "ticket_number STRING!, passenger_id INT!, fare_class STRING,"
                "ticket_status STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
            ),
            pk="ticket_number",
            not_null=("passenger_id", "fare_class", "ticket_status"),
            unique=("passenger_id",),
            domains={"ticket_status": ("ISSUED", "USED", "REFUNDED")},
            foreign_keys=(ForeignKey("passenger_id", "passengers", "passenger_id"),),
            version_column="updated_at",
        ),
        TableSpec(
            name="payments",
            schema=parse_schema(
                "payment_id STRING!, pnr_id STRING!, payment_method STRING, amount MONEY,"
                "currency STRING, payment_status STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
            ),
            pk="payment_id",
            month_of="created_at",
            not_null=("pnr_id", "amount"),
            domains={
                "payment_method": ("CREDIT_CARD", "ATM_CARD", "E_WALLET", "CASH"),
                "payment_status": ("PENDING", "SUCCESS", "FAILED", "REFUNDED"),
            },
            foreign_keys=(_PNR,),
            defaults={"currency": "VND"},
            version_column="updated_at",
            status_column="payment_status",
        ),
        TableSpec(
            name="booking_events",
            schema=parse_schema(
                "event_id INT!, pnr_id STRING!, event_type STRING, created_at TIMESTAMP"
            ),
            pk="event_id",
            month_of="created_at",
            not_null=("pnr_id", "event_type"),
            domains={"event_type": _BOOKING_STATES},
            foreign_keys=(_PNR,),
        ),
    )
}

# The four gold marts and the date column that partitions each.
MARTS: dict[str, tuple[T.StructType, str]] = {
    "daily_booking_summary": (
        parse_schema("booking_date DATE, booking_channel STRING, total_bookings BIGINT"),
        "booking_date",
    ),
    "daily_cancellation_rate": (
        parse_schema(
            "booking_date DATE, total_bookings BIGINT, cancelled_bookings BIGINT,"
            "cancellation_rate DOUBLE"
        ),
        "booking_date",
    ),
    "revenue_by_route": (
        parse_schema(
            "flight_date DATE, origin_airport STRING, dest_airport STRING,"
            "total_revenue TOTAL, total_bookings BIGINT"
        ),
        "flight_date",
    ),
    "payment_status_summary": (
        parse_schema(
            "payment_date DATE, payment_method STRING, payment_status STRING,"
            "payment_count BIGINT, total_amount TOTAL"
        ),
        "payment_date",
    ),
}


def entity(name: str) -> TableSpec:
    try:
        return ENTITIES[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; choose one of {sorted(ENTITIES)}") from None
