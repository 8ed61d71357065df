"""The four jobs: changes to bronze, bronze to silver, silver to gold, reconciliation."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cdclake.functions import as_day, coalesce_zero
from cdclake.operators import marts
from cdclake.operators.changes import unconvertible
from cdclake.operators.evolution import NEW_COLUMNS, IncompatibleSchema, schema_diff
from cdclake.operators.merge import too_old
from cdclake.operators.reconcile import (
    count_diff_by,
    pk_duplicates,
    sample_violations,
    state_mismatch,
    table_profile,
    union_all,
    verdict,
)
from cdclake.sources.change_files import found_schema, read_changes
from cdclake.sources.gold import forget_sums, refresh_changed
from cdclake.sources.lake import (
    Lake,
    append_bronze,
    apply_changes,
    create_gold,
    logged_spec,
    merged_files,
    oldest_accepted,
    path_exists,
    refresh,
    register_pair,
    remove_dir,
    scan_silver,
    widen_log,
)
from cdclake.sources.ledger import log_files, read_files, unmerged
from cdclake.specs import ENTITIES, EVENT_DATE, OP, TableSpec

Specs = Mapping[str, TableSpec]


@dataclass(frozen=True)
class JobResult:
    item: str
    status: str  # ok, missing or failed
    detail: str = ""
    counts: Mapping[str, int] = field(default_factory=dict)  # rows set aside or ignored, by reason
    error: BaseException | None = field(default=None, compare=False, repr=False)
    left_out: tuple[str, ...] = ()  # columns of the files that the table does not have


class JobFailed(RuntimeError):
    def __init__(self, job: str, results: list[JobResult]):
        self.results = results
        failed = [f"{r.item}: {r.detail}" for r in results if r.status == "failed"]
        super().__init__(f"{job}: {len(failed)} item(s) failed; " + "; ".join(failed))


def _run_each(
    job: str,
    items: Iterable[str],
    work: Callable[[str], Mapping[str, int] | JobResult | None],
    parallel: int,
    strict: bool,
    may_be_missing: bool = False,
) -> list[JobResult]:
    """Run independent items, keep going past a failure, then raise if there was any.

    With ``may_be_missing`` an item whose input path does not exist is ``missing``, not failed.

    Submitting several items at once lets small tables fill the cluster while a large one runs.
    """

    def attempt(item: str) -> JobResult:
        try:
            done = work(item)
            return done if isinstance(done, JobResult) else JobResult(item, "ok", counts=done or {})
        except AnalysisException as e:
            missing = may_be_missing and e.getCondition() == "PATH_NOT_FOUND"
            return JobResult(item, "missing" if missing else "failed", str(e), error=e)
        except Exception as e:  # noqa: BLE001 - one table must not stop the others
            return JobResult(item, "failed", str(e), error=e)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(attempt, items))
    failed = [r.error for r in results if r.status == "failed"]
    if strict and failed:
        raise JobFailed(job, results) from failed[0]
    return results


def _chosen(names: Iterable[str] | str | None, known: Iterable[str]) -> list[str]:
    known = list(known)
    if names is None:
        return known
    names = [names] if isinstance(names, str) else list(names)
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown {unknown}; choose from {known}")
    return names


def run_bronze(
    lake: Lake,
    root: str,
    date: str | dt.date,
    tables: Iterable[str] | str | None = None,
    specs: Specs = ENTITIES,
    idempotent: bool = True,
    parallel: int = 6,
    strict: bool = True,
    layout: str = "{table}",
    quarantine: bool = False,
    new_columns: str = "report",
) -> list[JobResult]:
    """Load one UTC arrival day of change files into bronze, table by table.

    All of the day is read, so with ``idempotent`` it replaces what an earlier load of the day left, also
    if it holds no row (any more), or only rows that are set aside. A table without files for the day is ``missing``, which is no failure; a root that does not exist is one.
    ``layout`` is the template of the tables' directories. With ``quarantine`` rows with a value that does
    not fit its type go to the table ``<log>_rejected`` and are counted as ``rejected``, the others are
    loaded; without, such a row fails its table.

    Files may lack columns, or have narrower types. Columns that the log lacks are left out and named in
    ``JobResult.left_out``; with ``new_columns="widen"`` the log gets them, and silver with its next merge; with
    ``"refuse"`` they fail the table, as other types do in any case.
    """
    day = as_day(date)
    if new_columns not in NEW_COLUMNS:
        raise ValueError(f"new_columns is one of {NEW_COLUMNS}")
    if not path_exists(lake.spark, root):
        raise FileNotFoundError(f"no such root of change files: {root}")

    def load(name: str) -> JobResult:
        spec = logged_spec(lake, specs[name])
        diff = schema_diff(found_schema(lake.spark, root, spec, day, layout), spec)
        added = [f.name for f in diff.added]
        if diff.conflicts or (added and new_columns == "refuse"):
            raise IncompatibleSchema("; ".join([*diff.conflicts, *(f"{c} is new" for c in added)]))
        if added and new_columns == "widen":
            spec, added = widen_log(lake, spec, diff.added), []
        raw = read_changes(lake.spark, root, spec, day, layout=layout, typed=False, retyped=diff.retyped)
        if not quarantine:
            append_bronze(lake, raw, spec, idempotent, day)
            return JobResult(name, "ok", left_out=tuple(added))
        bad = unconvertible(raw, spec)
        seen = Observation(f"rejected-{name}-{uuid.uuid4().hex}")
        watched = raw.observe(seen, F.count_if(bad).alias("rejected"))
        append_bronze(lake, watched.where(~bad), spec, idempotent, day)
        rejected = seen.get.get("rejected") or 0
        if rejected or idempotent:
            _set_aside(lake, raw.where(bad), spec, day, idempotent)
        return JobResult(name, "ok", counts={"rejected": rejected}, left_out=tuple(added))

    return _run_each("bronze", _chosen(tables, specs), load, parallel, strict, may_be_missing=True)


def rejected_table(lake: Lake, spec: TableSpec) -> str:
    return lake.table("bronze", f"{spec.name}_rejected")


def _set_aside(lake: Lake, rows: DataFrame, spec: TableSpec, day: dt.date, replace: bool) -> None:
    """Keep whole rows as JSON beside the log, by arrival day."""
    name = rejected_table(lake, spec)
    options = "" if lake.catalog else " OPTIONS ('partitionOverwriteMode' = 'dynamic')"
    lake.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (row STRING, {EVENT_DATE} STRING) "
        f"USING {lake.provider}{options} PARTITIONED BY ({EVENT_DATE})"
    )
    if replace and not lake.catalog:
        lake.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({EVENT_DATE} = '{day.isoformat()}')")
    kept = rows.select(F.to_json(F.struct(*rows.columns)).alias("row"), F.lit(day.isoformat()).alias(EVENT_DATE))
    if lake.catalog:
        writer = kept.writeTo(name)
        writer.overwrite(F.col(EVENT_DATE) == day.isoformat()) if replace else writer.append()
    else:
        kept.write.insertInto(name)


def run_silver(
    lake: Lake,
    tables: Iterable[str] | str | None = None,
    since: str | dt.date | None = None,
    specs: Specs = ENTITIES,
    parallel: int = 6,
    strict: bool = True,
    oldest: str | dt.date | None = None,
) -> list[JobResult]:
    """Merge bronze into silver.

    ``since`` reads only arrival days from that one on. That is safe even if it overlaps what was
    merged before, as older or repeated changes do not win. Without it, only files are read that were not merged
    yet, as a listing of the log compared with what silver records tells; in a V2 catalog all of bronze.
    ``counts["days"]`` are the arrival days that these belong to.
    Changes without a key or without a code are ignored and counted, as ``null_keys`` and ``null_ops``.

    ``oldest`` is a day: from now on changes with a source time before it (UTC) are refused and counted as ``too_old``,
    and deletes from before it no longer take room in silver. It holds for later runs too, and never goes back.
    """
    bound = None if oldest is None else int(dt.datetime.combine(as_day(oldest), dt.time(), dt.timezone.utc).timestamp() * 1000)

    def merge(name: str) -> Mapping[str, int]:
        spec = logged_spec(lake, specs[name])
        log = lake.bronze(spec)
        first = None if since is None else as_day(since).isoformat()
        files = days = None
        if lake.catalog:
            changes = lake.scan(log)
        else:
            files, merged = log_files(lake.spark, log), merged_files(lake, spec)
            if first is None:
                changes, days = read_files(lake.spark, log, unmerged(files, merged))
                if not days and merged is not None:
                    return {"days": 0}
            else:
                changes = lake.scan(log)
                recent = files.where(F.col(EVENT_DATE) >= first)
                days = recent.select(EVENT_DATE).distinct().count()
                if merged is None:
                    files = recent
                else:
                    files = recent.unionByName(files.join(merged.where(F.col(EVENT_DATE) < first), files.columns, "left_semi"))
        if first is not None:
            changes = changes.where(F.col(EVENT_DATE) >= first)
        from_ = oldest_accepted(lake, spec, bound)
        whole = F.col(spec.pk).isNotNull() & F.col(OP).isNotNull()
        watched = [
            F.count_if(F.col(spec.pk).isNull()).alias("null_keys"),
            F.count_if(F.col(spec.pk).isNotNull() & F.col(OP).isNull()).alias("null_ops"),
        ]
        if from_ is not None:
            watched.append(F.count_if(whole & too_old(from_)).alias("too_old"))
        seen = Observation(f"ignored-{name}-{uuid.uuid4().hex}")
        apply_changes(lake, changes.observe(seen, *watched), spec, files, oldest=bound)
        counts = {k: v or 0 for k, v in seen.get.items()}
        return counts if days is None else counts | {"days": days}

    return _run_each("silver", _chosen(tables, specs), merge, parallel, strict)


MART_JOBS: dict[str, Callable[[Lake, Specs], DataFrame]] = {
    "daily_booking_summary": lambda lake, specs: marts.daily_booking_summary(
        scan_silver(lake, specs["pnr_records"])
    ),
    "daily_cancellation_rate": lambda lake, specs: marts.daily_cancellation_rate(
        scan_silver(lake, specs["pnr_records"])
    ),
    "revenue_by_route": lambda lake, specs: marts.revenue_by_route(
        scan_silver(lake, specs["flight_segments"]), scan_silver(lake, specs["payments"])
    ),
    "payment_status_summary": lambda lake, specs: marts.payment_status_summary(
        scan_silver(lake, specs["payments"])
    ),
}


def run_gold(
    lake: Lake,
    names: Iterable[str] | str | None = None,
    specs: Specs = ENTITIES,
    parallel: int = 4,
    strict: bool = True,
    changed_only: bool = False,
) -> list[JobResult]:
    """Recompute the marts and replace their tables.

    ``changed_only`` (Parquet lakes) brings them up to date instead from the rows of silver that differ since the last
    such run, and with ``gold_by_day`` writes only the days that these touch; ``counts["days"]`` tells how many.
    """
    create_gold(lake)

    def make(mart: str) -> Mapping[str, int] | None:
        if changed_only:
            return refresh_changed(lake, mart, specs)
        forget_sums(lake, mart)
        return refresh(lake, MART_JOBS[mart](lake, specs), mart)

    return _run_each("gold", _chosen(names, MART_JOBS), make, parallel, strict)


STEPS = ("silver", "state", "events_date")


def snapshot(lake: Lake, df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Every check of a reconciliation then sees the same source rows, the database is read once,
    and a lost executor costs a re-read of files only.
    """
    path = lake.work_dir(f"snapshot-{label}")
    df.write.parquet(path)
    return lake.spark.read.parquet(path)


def drop_snapshots(lake: Lake, pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> None:
    """Remove the copies that ``load_pairs`` made, once the checks have been read or written."""
    for source, _ in pairs.values():
        for folder in {f.rsplit("/", 1)[0] for f in source.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("snapshot-"):
                remove_dir(lake.spark, folder)


def load_pairs(
    lake: Lake,
    read_source: Callable[[TableSpec], DataFrame],
    specs: Specs = ENTITIES,
    materialize: bool = True,
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(source, silver) of every table, also registered as ``src_<table>`` and ``slv_<table>``.

    ``read_source`` gives the source table, usually by JDBC; ``materialize`` copies it to files
    once, as several checks read it.
    """
    pairs = {}

    def load(name: str) -> None:
        spec = specs[name]
        source = read_source(spec)
        if materialize:
            source = snapshot(lake, source, name)
        pairs[name] = (source, scan_silver(lake, spec))

    _run_each("load_pairs", specs, load, len(specs), strict=True)
    for name, spec in specs.items():
        register_pair(spec, *pairs[name])
    return {name: pairs[name] for name in specs}


def reconciliation_offenders(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], specs: Specs = ENTITIES, n: int = 5
) -> DataFrame:
    """(table_name, check_name, key, detail): up to ``n`` rows behind each failed check, in order of key."""
    found = []
    for table, (source, silver) in pairs.items():
        spec = specs[table]
        key = F.col(spec.pk).cast("string").alias("key")
        doubled = sample_violations(pk_duplicates(silver, spec), spec.pk, n=n)
        checks = [("duplicated_keys", doubled, F.lit(""))]
        if spec.status_column:
            mismatch = state_mismatch(source, silver, spec, unique=True)
            order = (spec.pk, "src_status", "target_status")
            detail = F.format_string("source=%s silver=%s", "src_status", "target_status")
            checks.append((f"{spec.status_column}_mismatch", sample_violations(mismatch, *order, n=n), detail))
        found += [
            rows.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), key, detail.alias("detail"))
            for check, rows, detail in checks
        ]
    return union_all(found)


def run_reconciliation(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]],
    steps: Iterable[str] | None = None,
    date: str | dt.date | None = None,
    specs: Specs = ENTITIES,
) -> DataFrame:
    """(step, table_name, check_name, value, status, detail) for the chosen steps.

    ``pairs`` maps a table to its (source, silver) frames. Nothing is computed until the result
    is read, and then all checks run as one query.
    """
    steps = _chosen(steps, STEPS)
    if "events_date" in steps and date is None:
        raise ValueError("step events_date needs a date")
    checks: list[DataFrame] = []

    def add(step: str, check: str, df: DataFrame, value: str, status, detail, table=None) -> None:
        checks.append(
            df.select(
                F.lit(step).alias("step"),
                (F.lit(table) if table else F.col("table_name")).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.col(value).cast("long").alias("value"),
                status.alias("status"),
                detail.alias("detail"),
            )
        )

    if "silver" in steps:
        difference = F.col("silver_count") - F.col("source_count")

        def check(name: str, value, status, detail):
            return F.struct(
                F.lit(name).alias("check_name"), value.alias("value"), status.alias("status"), detail.alias("detail")
            )

        rows = check(
            "row_count_difference",
            difference,
            verdict(difference == 0, "WARNING"),
            F.format_string("source=%d silver=%d", "source_count", "silver_count"),
        )
        keys = check(
            "duplicated_keys", F.col("duplicated_keys"), verdict(F.col("duplicated_keys") == 0, "ERROR"), F.lit("")
        )
        profile = table_profile(pairs, specs).select("table_name", F.inline(F.array(rows, keys)))
        checks.append(profile.select(F.lit("silver").alias("step"), "table_name", "check_name", "value", "status", "detail"))
    if "state" in steps:
        for table, (source, silver) in pairs.items():
            if not specs[table].status_column:
                continue
            mismatch = state_mismatch(source, silver, specs[table], unique=True)
            add(
                "state",
                f"{specs[table].status_column}_mismatch",
                mismatch.agg(F.coalesce(F.sum("pair_count"), F.lit(0)).alias("n")),
                "n",
                verdict(F.col("n") == 0, "WARNING"),
                F.lit(""),
                table,
            )
    if "events_date" in steps:
        day = as_day(date).isoformat()
        source, silver = pairs["booking_events"]
        by_type = count_diff_by(source, silver, "event_type", day)
        sums = [coalesce_zero(F.sum(c)).alias(c) for c in ("source_count", "silver_count")]
        gap = F.abs(F.col("silver_count") - F.col("source_count"))
        add(
            "events_date",
            "event_total_gap",
            by_type.agg(*sums).withColumn("gap", gap),
            "gap",
            verdict(F.col("gap") == 0, "WARNING"),
            F.format_string(f"{day} source=%d silver=%d", "source_count", "silver_count"),
            "booking_events",
        )
        add(
            "events_date",
            "event_type_difference",
            by_type,
            "difference",
            verdict(F.col("difference") == 0, "WARNING"),
            F.format_string(
                f"{day} %s source=%d silver=%d",
                F.coalesce("event_type", F.lit("NULL")),
                "source_count",
                "silver_count",
            ),
            "booking_events",
        )
    return union_all(checks)


def write_report(checks: DataFrame, path: str, run_ts: dt.datetime) -> None:
    """Append one run of checks, stamped with its time, to the reports dataset."""
    checks.withColumn("run_ts", F.lit(run_ts)).repartition(1).write.mode("append").parquet(path)
