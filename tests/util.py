"""Small builders for hand-written rows."""

from datetime import datetime

from cdclake.specs import TableSpec, parse_schema

ITEM = TableSpec("items", parse_schema("id BIGINT!, name STRING, qty INT"), "id")
VERSIONED = TableSpec(
    "versioned",
    parse_schema("id BIGINT!, name STRING, updated_at TIMESTAMP"),
    "id",
    version_column="updated_at",
)


def changes(spark, data, spec=ITEM):
    """(key, values…, op, ts) rows as flattened changes of ``spec``; all arrive on one day."""
    n = len(spec.columns)
    full = [
        (*row[:n], "true" if row[n] == "d" else "false", row[n], spec.name, row[n + 1], "2024-01-01")
        for row in data
    ]
    return spark.createDataFrame(full, _nullable(spec.change_schema))


def table(spark, data, spec=ITEM):
    return spark.createDataFrame(data, _nullable(spec.schema))


def _nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def at(text):
    return datetime.fromisoformat(text)
