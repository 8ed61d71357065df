"""Change-data lakehouse operators for PySpark: bronze log, silver state, gold marts, reconciliation."""

from cdclake.specs import ENTITIES, TableSpec, entity

__all__ = ["ENTITIES", "TableSpec", "entity"]
