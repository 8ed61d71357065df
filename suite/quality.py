"""Source constraints as checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.operators.quality import (
    apply_defaults,
    check_domain,
    check_fk,
    check_not_null,
    check_pk,
    check_unique,
    domain_violations,
)
from suite import bindings as b
from suite.registry import query


@query(
    "check_pk",
    f"""SELECT segment_id, count(*) AS occurrence FROM (SELECT CASE WHEN airline_code <> 'N'
      THEN segment_id END AS segment_id FROM {b.SEGMENTS}) GROUP BY segment_id
      HAVING count(*) > 1 OR segment_id IS NULL""",
)
def pk(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated keys, and the NULL key that unreturned lines are given here."""
    rows = b.flight_segments(spark, sf).withColumn(
        "segment_id", F.when(F.col("airline_code") != "N", F.col("segment_id"))
    )
    return check_pk(rows, b.SPECS["flight_segments"])


@query(
    "check_unique",
    "SELECT o_custkey, count(*) AS occurrence FROM orders GROUP BY o_custkey HAVING count(*) > 1",
)
def unique(spark: SparkSession, sf: str) -> DataFrame:
    return check_unique(b.table(spark, sf, "orders"), "o_custkey")


_NULLABLE = "(SELECT nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS p, o_orderkey AS k FROM orders)"


@query(
    "check_not_null",
    f"""SELECT 's' AS column_name, count(*) FILTER (s IS NULL) AS null_count FROM {_NULLABLE} UNION ALL
      SELECT 'p', count(*) FILTER (p IS NULL) FROM {_NULLABLE} UNION ALL
      SELECT 'k', count(*) FILTER (k IS NULL) FROM {_NULLABLE}""",
)
def not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("s"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
        F.col("o_orderkey").alias("k"),
    )
    return check_not_null(rows, ["s", "p", "k"])


@query(
    "check_domain",
    """SELECT event_id, kind FROM (SELECT event_id, nullif(event_type, 'error') AS kind FROM events)
      WHERE kind NOT IN ('view', 'click')""",
)
def domain(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif("event_type", F.lit("error")).alias("kind")
    rows = b.table(spark, sf, "events").select("event_id", kind)
    return check_domain(rows, "kind", ["view", "click"])


# The value domains of the tables' specification, restated for the oracle.
@query(
    "check_domains",
    f"""SELECT 'payment_method' AS column_name, count(*) FILTER (payment_method NOT IN
      ('CREDIT_CARD', 'ATM_CARD', 'E_WALLET', 'CASH')) AS violations FROM {b.PAYMENTS} UNION ALL
      SELECT 'payment_status', count(*) FILTER (payment_status NOT IN
      ('PENDING', 'SUCCESS', 'FAILED', 'REFUNDED')) FROM {b.PAYMENTS}""",
)
def domains(spark: SparkSession, sf: str) -> DataFrame:
    return domain_violations(b.payments(spark, sf), b.SPECS["payments"].domains)


@query(
    "check_fk",
    """SELECT o_orderkey, count(*) AS child_rows FROM orders ANTI JOIN lineitem
      ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def fk(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = b.table(spark, sf, "orders"), b.table(spark, sf, "lineitem")
    return check_fk(orders, lines, ("o_orderkey", "l_orderkey"))


@query(
    "check_fk_hot_child",
    """SELECT l_orderkey, count(*) AS child_rows FROM lineitem ANTI JOIN (SELECT * FROM orders
      WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey GROUP BY l_orderkey""",
)
def fk_many_children(spark: SparkSession, sf: str) -> DataFrame:
    orders = b.table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return check_fk(b.table(spark, sf, "lineitem"), orders, ("l_orderkey", "o_orderkey"))


@query(
    "apply_defaults",
    """SELECT CAST(o_orderkey AS VARCHAR) AS payment_id,
      CASE o_orderstatus WHEN 'F' THEN 'USD' ELSE 'VND' END AS currency FROM orders""",
)
def defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("payment_id"),
        F.when(F.col("o_orderstatus") == "F", "USD").alias("currency"),
    )
    return apply_defaults(rows, b.SPECS["payments"])
