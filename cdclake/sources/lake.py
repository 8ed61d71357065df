"""The lake: bronze, silver and gold tables in the Spark catalog."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import as_day
from cdclake.operators.changes import conform
from cdclake.operators.evolution import NEW_COLUMNS, IncompatibleSchema
from cdclake.operators.handover import Mark
from cdclake.operators.merge import current_rows, merge_state
from cdclake.sources.row_level import merge_state_into
from cdclake.specs import ENTITIES, EVENT_DATE, MARTS, OP, TableSpec

LAYERS = ("bronze", "silver", "gold")
# Properties of silver views and state tables.
VERSION = "cdclake.version"
SNAPSHOTS = "cdclake.snapshots"
LEDGERS = "cdclake.ledgers"
BATCHES = "cdclake.batches"
OLDEST = "cdclake.oldest"
# Property of log tables.
HAND_OVER = "cdclake.hand_over"
STATE = "cdclake.state"
OVERWRITE_MODE = "partitionOverwriteMode"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` or the context's checkpoint folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class ConcurrentWrite(RuntimeError):
    """Another writer published a silver table in the meantime; nothing was changed."""


@dataclass(frozen=True)
class Lake:
    """Names of the three namespaces and where their data lives.

    ``catalog`` is set when the lake sits in a V2 catalog with row-level commands; silver is then
    a state table changed by MERGE. Otherwise it is a set of Parquet snapshots of that state. Either
    way readers use a view that hides deletes.
    ``state_buckets`` should give buckets of some hundred megabytes; a Parquet lake needs it, a V2
    catalog takes it as the number of key buckets of the state. ``keep_versions`` snapshots stay
    readable: a reader that is still on an older one fails. ``gold_by_day`` partitions the
    marts by their day: always so in a V2 catalog, where a partition is cheap, and off by default
    for Parquet, where it would mean one small directory and file per day; there the marts are
    kept sorted by day, so that file statistics prune instead.
    """

    spark: SparkSession
    root: str | None = None
    prefix: str = ""
    catalog: str | None = None
    provider: str = "parquet"
    state_buckets: int | None = None
    keep_versions: int = 2
    gold_by_day: bool = False

    def __post_init__(self) -> None:
        if self.keep_versions < 1:
            raise ValueError("keep_versions must be at least 1, the snapshot that readers see")
        if self.catalog is None and self.state_buckets is None:
            raise ValueError("a Parquet lake needs state_buckets")

    def work_dir(self, label: str) -> str:
        """A new folder for intermediate tables, under the lake's own root where it has one."""
        if self.root:
            return f"{self.root.rstrip('/')}/_work/{label}-{uuid.uuid4().hex}"
        return fresh_dir(self.spark, label)

    def namespace(self, layer: str) -> str:
        name = f"{self.prefix}{layer}"
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, name: str) -> str:
        return f"{self.namespace(layer)}.{name}"

    def bronze(self, spec: TableSpec) -> str:
        return self.table("bronze", spec.name)

    def silver(self, spec: TableSpec) -> str:
        return self.table("silver", spec.silver_name)

    def gold(self, mart: str) -> str:
        return self.table("gold", mart)

    def scan(self, name: str) -> DataFrame:
        return self.spark.table(name)


# -- definition ---------------------------------------------------------------------------------


def init_namespaces(lake: Lake) -> None:
    for layer in LAYERS:
        where = f" LOCATION '{lake.root}/{layer}'" if lake.root and not lake.catalog else ""
        lake.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {lake.namespace(layer)}{where}")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )


def _create(
    lake: Lake,
    name: str,
    schema: T.StructType,
    partition: str | None,
    overwrite: str = "",
    property_: str = "",
) -> None:
    """``overwrite`` fixes on the table itself whether INSERT OVERWRITE replaces all of it or only
    the partitions written, whatever the session is set to."""
    by = f" PARTITIONED BY ({partition})" if partition else ""
    options = f" OPTIONS ('{OVERWRITE_MODE}' = '{overwrite}')" if overwrite and not lake.catalog else ""
    lake.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING {lake.provider}{options}{by}"
        + (f" TBLPROPERTIES ('{property_}' = 'true')" if property_ else "")
    )


def create_bronze(lake: Lake, specs: Iterable[TableSpec] = tuple(ENTITIES.values())) -> None:
    for spec in specs:
        _create(lake, lake.bronze(spec), spec.change_schema, EVENT_DATE, "dynamic")


def create_silver(lake: Lake, specs: Iterable[TableSpec] = tuple(ENTITIES.values())) -> None:
    for spec in specs:
        if lake.catalog:
            by = [f"months({spec.month_of})"] if spec.month_of else []
            by += [f"bucket({lake.state_buckets}, {spec.pk})"] if lake.state_buckets else []
            _create(lake, _state_name(lake, spec), spec.state_schema, ", ".join(by) or None, property_=STATE)
            names = ", ".join(f"`{c}`" for c in spec.columns)
            lake.spark.sql(
                f"CREATE VIEW IF NOT EXISTS {lake.silver(spec)} AS SELECT {names} "
                f"FROM {_state_name(lake, spec)} WHERE {OP} <> 'd'"
            )
        elif _version(lake, spec) is None:
            publish_state(lake, spec, lake.spark.createDataFrame([], spec.state_schema))


def create_gold(lake: Lake) -> None:
    for mart, (schema, day) in MARTS.items():
        by_day = lake.catalog or lake.gold_by_day
        _create(lake, lake.gold(mart), schema, day if by_day else None, "static")


def create_layers(lake: Lake, specs: Iterable[TableSpec] = tuple(ENTITIES.values())) -> None:
    specs = tuple(specs)
    init_namespaces(lake)
    create_bronze(lake, specs)
    create_silver(lake, specs)
    create_gold(lake)


def _tables(lake: Lake, layer: str) -> list[str]:
    shown = lake.spark.sql(f"SHOW TABLES IN {lake.namespace(layer)}").collect()
    return [row.tableName for row in shown if not row.isTemporary]


def reset(lake: Lake, layers: Iterable[str] = ("bronze", "silver"), namespaces: bool = False) -> None:
    """Drop the tables of the given layers, or the whole namespaces with everything in them."""
    for layer in layers:
        if namespaces:
            lake.spark.sql(f"DROP NAMESPACE IF EXISTS {lake.namespace(layer)} CASCADE")
            continue
        for name in _tables(lake, layer):
            full = lake.table(layer, name)
            view = lake.spark.catalog.getTable(full).tableType == "VIEW"
            lake.spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {full}")


def list_tables(lake: Lake, layers: Iterable[str] = LAYERS) -> DataFrame:
    """(layer, table_name) of every table a reader is meant to use: all but the states of silver."""
    names = [
        (layer, name)
        for layer in layers
        for name in _tables(lake, layer)
        if not (layer == "silver" and _properties(lake, lake.table(layer, name)).get(STATE))
    ]
    return lake.spark.createDataFrame(names, "layer string, table_name string")


def list_namespaces(lake: Lake) -> DataFrame:
    """Every namespace of the lake's catalog."""
    scope = f" IN {lake.catalog}" if lake.catalog else ""
    return lake.spark.sql(f"SHOW NAMESPACES{scope}")


# -- bronze and gold ----------------------------------------------------------------------------


def logged_spec(lake: Lake, spec: TableSpec) -> TableSpec:
    """The spec with the columns that the log was widened by."""
    known = {n.lower() for n in spec.change_schema.fieldNames()}
    return spec.widened(f for f in lake.scan(lake.bronze(spec)).schema if f.name.lower() not in known)


def widen_log(lake: Lake, spec: TableSpec, fields: Iterable[T.StructField]) -> TableSpec:
    """Add nullable columns to the log; older rows hold NULL there. Silver has them from its next merge on."""
    wide = spec.widened(fields)
    ddl = _ddl(T.StructType(wide.schema.fields[len(spec.schema.fields) :]))
    lake.spark.sql(f"ALTER TABLE {lake.bronze(spec)} ADD COLUMNS ({ddl})")
    if lake.catalog:
        lake.spark.sql(f"ALTER TABLE {_state_name(lake, spec)} ADD COLUMNS ({ddl})")
        lake.spark.sql(f"DROP VIEW IF EXISTS {lake.silver(spec)}")
        create_silver(lake, [wide])
    return wide


def hand_over_mark(lake: Lake, spec: TableSpec) -> Mark | None:
    """Where the snapshot of a table was begun, None if none was."""
    kept = _properties(lake, lake.bronze(spec)).get(HAND_OVER)
    return Mark.from_json(kept) if kept else None


def begin_hand_over(lake: Lake, spec: TableSpec, mark: Mark, anew: bool = False) -> None:
    """Note the mark of a snapshot with the log, before the first row is read. A restart passes the same mark;
    ``anew`` replaces it, for a snapshot that is read from the start again."""
    kept = hand_over_mark(lake, spec)
    if kept is not None and kept != mark and not anew:
        raise ValueError(f"a snapshot of {spec.name} was begun at {kept}; finish it or begin anew")
    lake.spark.sql(f"ALTER TABLE {lake.bronze(spec)} SET TBLPROPERTIES ('{HAND_OVER}' = '{mark.to_json()}')")


def append_bronze(
    lake: Lake,
    changes: DataFrame,
    spec: TableSpec,
    idempotent: bool = False,
    day: str | dt.date | None = None,
    new_columns: str = "report",
) -> tuple[str, ...]:
    """Add changes to the log, matching columns by name. Tasks write what they read, without a shuffle.

    With ``idempotent`` the arrival days present in ``changes`` are replaced instead, for callers that
    have all of a day at hand: loading it again then does not double it. ``day`` names the one day that
    ``changes`` are all of: it is replaced even if there are none, which leaves it empty.
    ``new_columns`` says what happens to columns that the log lacks: ``report`` leaves them out, ``widen`` adds them
    to the log, ``refuse`` raises. The names of those left out are returned.
    """
    if new_columns not in NEW_COLUMNS:
        raise ValueError(f"new_columns is one of {NEW_COLUMNS}")
    spec = logged_spec(lake, spec)
    known = {n.lower() for n in spec.change_schema.fieldNames()}
    unknown = [f for f in changes.schema if f.name.lower() not in known and not f.name.startswith("__")]
    if unknown and new_columns == "refuse":
        raise IncompatibleSchema(f"{lake.bronze(spec)} has no columns {[f.name for f in unknown]}")
    if unknown and new_columns == "widen":
        spec, unknown = widen_log(lake, spec, unknown), []
    rows = conform(changes, spec)
    replaced = as_day(day).isoformat() if day is not None and idempotent else None
    if lake.catalog:
        writer = rows.select(*spec.change_schema.fieldNames()).writeTo(lake.bronze(spec))
        if replaced:
            writer.overwrite(F.col(EVENT_DATE) == replaced)
        else:
            writer.overwritePartitions() if idempotent else writer.append()
        return tuple(f.name for f in unknown)
    if idempotent:
        _require_day_overwrite(lake, lake.bronze(spec))
    # insertInto goes by position, and columns added later stand behind those of the capture.
    rows = rows.select(*lake.scan(lake.bronze(spec)).columns)
    if replaced:
        # Only partitions that get rows are overwritten; a day that gets none is dropped after the write.
        seen = Observation(f"loaded-{uuid.uuid4().hex}")
        rows = rows.observe(seen, F.count_if(F.col(EVENT_DATE) == replaced).alias("loaded"))
    rows.write.insertInto(lake.bronze(spec), overwrite=idempotent)
    if replaced and not seen.get.get("loaded"):
        lake.spark.sql(f"ALTER TABLE {lake.bronze(spec)} DROP IF EXISTS PARTITION ({EVENT_DATE} = '{replaced}')")
    return tuple(f.name for f in unknown)


def _require_day_overwrite(lake: Lake, name: str) -> None:
    """Refuse to overwrite a log table that would lose its other days."""
    described = lake.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    storage = described.where(F.col("col_name") == "Storage Properties").collect()
    if not any(f"{OVERWRITE_MODE}=dynamic" in row.data_type for row in storage):
        raise ValueError(f"{name} was not created with {OVERWRITE_MODE}=dynamic; use create_bronze")


def refresh(lake: Lake, df: DataFrame, mart: str) -> None:
    """Replace the whole content of a gold table, days that are no longer produced included."""
    schema, day = MARTS[mart]
    if lake.catalog:
        cluster_for_write(df.select(*schema.fieldNames()), day).writeTo(lake.gold(mart)).overwrite(
            F.lit(True)
        )
        return
    # insertInto goes by position, and a table lists its partition column last.
    rows = df.select(*lake.scan(lake.gold(mart)).columns)
    if lake.gold_by_day:
        # A fixed number of writers: by size alone the many small days would all go to one task.
        writers = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(writers, day).sortWithinPartitions(day)
    else:
        rows = cluster_for_write(rows, day)
    rows.write.insertInto(lake.gold(mart), overwrite=True)


def cluster_for_write(df: DataFrame, partition: str, *order: str) -> DataFrame:
    """Bring the rows of a table partition together before a partitioned write.

    A rebalance (unlike a sort in the query) survives optimization, needs no sampling pass,
    merges small partitions into one writer and splits a dominating one over several; each
    writer then has one file open at a time.
    """
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *order)


# -- silver -------------------------------------------------------------------------------------


def _state_name(lake: Lake, spec: TableSpec) -> str:
    return lake.table("silver", f"{spec.name}_state")


def _properties(lake: Lake, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in lake.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _published(lake: Lake, spec: TableSpec) -> dict[str, str] | None:
    """What the silver view records of its snapshot, None before the first."""
    if not lake.spark.catalog.tableExists(lake.silver(spec)):
        return None
    return _properties(lake, lake.silver(spec))


def _version(lake: Lake, spec: TableSpec) -> int | None:
    published = _published(lake, spec)
    return None if published is None else int(published[VERSION])


def merged_files(lake: Lake, spec: TableSpec) -> DataFrame | None:
    """The files of the log that silver was made from, None before the first were recorded."""
    ledgers = _names((_published(lake, spec) or {}).get(LEDGERS, ""))
    return lake.spark.table(lake.table("silver", ledgers[0])) if ledgers else None


def merged_batch(lake: Lake, spec: TableSpec, query_id: str) -> int | None:
    """The last batch of a streaming query that went into silver, None before the first."""
    return json.loads((_published(lake, spec) or {}).get(BATCHES, "{}")).get(query_id)


def oldest_accepted(lake: Lake, spec: TableSpec, oldest: int | None = None) -> int | None:
    """The source time in milliseconds from which on changes are accepted: what was recorded, or ``oldest`` if later."""
    kept = None if lake.catalog else (_published(lake, spec) or {}).get(OLDEST)
    given = [x for x in (kept and int(kept), oldest) if x is not None]
    return max(given, default=None)


def _names(listed: str) -> list[str]:
    return [name for name in listed.split(",") if name]


def _with_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns; those that the table got later are NULL."""
    present = set(df.columns)
    return df.select(*[F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_state(lake: Lake, spec: TableSpec) -> DataFrame:
    """Published state: live rows and tombstones, with the change that produced each."""
    if lake.catalog:
        return lake.spark.table(_state_name(lake, spec))
    published = _published(lake, spec)
    if published is None:
        return lake.spark.createDataFrame([], spec.state_schema)
    newest = _names(published[SNAPSHOTS])[0]
    return _with_columns(lake.spark.table(lake.table("silver", newest)), spec.state_schema)


def published_snapshot(lake: Lake, spec: TableSpec) -> str | None:
    """The name of the snapshot that readers of silver see, None before the first."""
    published = _published(lake, spec)
    return None if published is None else _names(published[SNAPSHOTS])[0]


def scan_snapshot(lake: Lake, spec: TableSpec, name: str) -> DataFrame:
    """The rows that silver showed, or shows, with this snapshot."""
    return current_rows(_with_columns(lake.spark.table(lake.table("silver", name)), spec.state_schema), spec)


def publish_state(
    lake: Lake,
    spec: TableSpec,
    state: DataFrame,
    aligned: bool = False,
    base: int | None = None,
    files: DataFrame | None = None,
    batch: tuple[str, int] | None = None,
    oldest: int | None = None,
) -> int:
    """Write ``state`` as a new snapshot and point the silver view at it.

    The snapshot being read is never overwritten, and readers switch only once the new one is
    complete; an attempt that fails leaves the view where it was. Snapshots are bucketed by key,
    so the next merge and joins on the key need not shuffle them, and partitioned by month
    where the table has one. Older snapshots beyond ``keep_versions`` are dropped.

    ``base`` is the version that ``state`` was made from, by default the published one. If another writer has
    published since, ConcurrentWrite is raised and the new snapshot dropped. ``files`` (all the log's files that the
    state was made from) and ``batch`` (a streaming query's id and its batch) are recorded by the same switch of the
    view, so that they never differ from what it shows. Two writers that check at the same moment are not told
    apart: keep one writer a table.

    ``aligned`` says that each task already holds rows of one bucket only, as after a merge into
    a bucketed snapshot; without it the rows are hashed to their buckets first.
    """
    spark = lake.spark
    base = _version(lake, spec) if base is None else base
    version = 0 if base is None else base + 1
    short = f"{spec.name}_state_v{version}_{uuid.uuid4().hex[:12]}"
    table = lake.table("silver", short)
    columns = spec.state_schema.fieldNames()
    if spec.month_of:
        state = state.withColumn(spec.month_column, F.trunc(spec.month_of, "month"))
    if not aligned:
        state = state.repartition(lake.state_buckets, spec.pk)
    writer = (
        state.write.format(lake.provider)
        .bucketBy(lake.state_buckets, spec.pk)
        .sortBy(spec.pk)
    )
    if spec.month_of:
        writer = writer.partitionBy(spec.month_column)
    writer.saveAsTable(table)
    made = [short]
    if files is not None:
        made.append(f"{spec.name}_files_v{version}_{uuid.uuid4().hex[:12]}")
        files.write.format(lake.provider).saveAsTable(lake.table("silver", made[1]))
    for name in made:
        spark.sql(f"ALTER TABLE {lake.table('silver', name)} SET TBLPROPERTIES ('{STATE}' = 'true')")
    published = _published(lake, spec)
    if (None if published is None else int(published[VERSION])) != base:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {lake.table('silver', name)}")
        raise ConcurrentWrite(f"{lake.silver(spec)} was published by another writer")
    published = published or {}
    snapshots = [short, *_names(published.get(SNAPSHOTS, ""))]
    ledgers = [*made[1:], *_names(published.get(LEDGERS, ""))]
    batches = json.loads(published.get(BATCHES, "{}")) | (dict([batch]) if batch else {})
    properties = {
        VERSION: str(version),
        SNAPSHOTS: ",".join(snapshots[: lake.keep_versions]),
        LEDGERS: ",".join(ledgers[: lake.keep_versions]),
        BATCHES: json.dumps(batches, sort_keys=True),
    }
    if oldest is not None or OLDEST in published:
        properties[OLDEST] = str(oldest if oldest is not None else published[OLDEST])
    _switch(lake, spec, table, properties)
    for old in (*snapshots[lake.keep_versions :], *ledgers[lake.keep_versions :]):
        spark.sql(f"DROP TABLE IF EXISTS {lake.table('silver', old)}")
    return version


def _switch(lake: Lake, spec: TableSpec, table: str, properties: Mapping[str, str]) -> None:
    """Point the silver view at a snapshot, with what is known about it."""
    present = set(lake.spark.table(table).columns)
    names = ", ".join(f"`{c}`" for c in spec.columns if c in present)
    month = f", `{spec.month_column}`" if spec.month_of else ""
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    lake.spark.sql(
        f"CREATE OR REPLACE VIEW {lake.silver(spec)} TBLPROPERTIES ({listed}) "
        f"AS SELECT {names}{month} FROM {table} WHERE {OP} <> 'd'"
    )


def record_files(lake: Lake, spec: TableSpec, files: DataFrame) -> None:
    """Replace the list of merged files of the published snapshot, whose rows stay as they are."""
    spark, published = lake.spark, _published(lake, spec)
    name = f"{spec.name}_files_v{published[VERSION]}_{uuid.uuid4().hex[:12]}"
    files.write.format(lake.provider).saveAsTable(lake.table("silver", name))
    spark.sql(f"ALTER TABLE {lake.table('silver', name)} SET TBLPROPERTIES ('{STATE}' = 'true')")
    if _published(lake, spec) != published:
        spark.sql(f"DROP TABLE IF EXISTS {lake.table('silver', name)}")
        raise ConcurrentWrite(f"{lake.silver(spec)} was published by another writer")
    ledgers = [name, *_names(published.get(LEDGERS, ""))]
    known = {k: v for k, v in published.items() if k in (VERSION, SNAPSHOTS, BATCHES, OLDEST)}
    kept = known | {LEDGERS: ",".join(ledgers[: lake.keep_versions])}
    _switch(lake, spec, lake.table("silver", _names(published[SNAPSHOTS])[0]), kept)
    for old in ledgers[lake.keep_versions :]:
        spark.sql(f"DROP TABLE IF EXISTS {lake.table('silver', old)}")


def apply_changes(
    lake: Lake,
    changes: DataFrame,
    spec: TableSpec,
    files: DataFrame | None = None,
    batch: tuple[str, int] | None = None,
    oldest: int | None = None,
) -> bool:
    """Upsert and delete silver rows by the latest change of each key.

    ``files`` are recorded as what silver now is made from, ``batch`` as the last one of its query. A batch that is
    recorded already, or an earlier one of its query, is not applied again: False is returned and nothing written. In a V2
    catalog nothing is recorded, and a repeated batch is merged again, which changes no row.

    ``oldest`` is a source time in milliseconds: from now on older changes are left out, and deletes from before it
    are forgotten, see :func:`merge_state`. It is recorded and never goes back.
    """
    if lake.catalog:
        if oldest is not None:
            raise ValueError("deletes are forgotten in Parquet lakes only")
        merge_state_into(_state_name(lake, spec), changes, spec)
        return True
    if batch:
        last = merged_batch(lake, spec, batch[0])
        if last is not None and batch[1] <= last:
            return False
    base = _version(lake, spec)
    buckets = None if base is None else lake.state_buckets
    oldest = oldest_accepted(lake, spec, oldest)
    merged = merge_state(read_state(lake, spec), changes, spec, buckets=buckets, oldest=oldest)
    publish_state(lake, spec, merged, aligned=base is not None, base=base, files=files, batch=batch, oldest=oldest)
    return True


def scan_silver(
    lake: Lake, spec: TableSpec, first: str | dt.date | None = None, last: str | dt.date | None = None
) -> DataFrame:
    """Silver rows; from day ``first`` on, up to day ``last``, both included, also prunes month partitions."""
    df = current_rows(read_state(lake, spec), spec) if lake.catalog else lake.scan(lake.silver(spec))
    if (first is not None or last is not None) and not spec.month_of:
        raise ValueError(f"{spec.name} has no day column to filter by")
    if first is not None:
        first = as_day(first)
        if not lake.catalog:
            df = df.where(F.col(spec.month_column) >= F.lit(first.replace(day=1)))
        df = df.where(F.col(spec.month_of) >= F.lit(first))
    if last is not None:
        last = as_day(last)
        if not lake.catalog:
            df = df.where(F.col(spec.month_column) <= F.lit(last))
        df = df.where(F.col(spec.month_of) < F.lit(last + dt.timedelta(days=1)))
    return _with_columns(df, spec.schema)


# -- names for ad-hoc SQL -------------------------------------------------------------------------


def register_pair(spec: TableSpec, source: DataFrame, silver: DataFrame, alias: str | None = None):
    """Temporary views ``src_<alias>`` and ``slv_<alias>`` for the SQL surface."""
    alias = alias or spec.name
    source.createOrReplaceTempView(f"src_{alias}")
    silver.createOrReplaceTempView(f"slv_{alias}")
    return f"src_{alias}", f"slv_{alias}"
