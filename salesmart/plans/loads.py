"""Loading a set of tables: read, reconcile, write, validate, audit; one failure does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.keys import validate_key
from salesmart.operators.merge import merge_counts, merge_rows
from salesmart.sources.tables import Clustering, WriteCounts, append_audit, audit_row, key_summary, upsert_partitions, upsert_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadSpec:
    """What to load: a lazy frame (or a function giving one, so that a failing read is isolated too).

    ``keys`` identify a row for the merge; ``check_keys`` are validated afterwards and default to them. ``bucket``,
    a SQL expression over both, stores the table in partitions of which a run replaces the touched ones only.
    ``clustering`` deals rows to files so that tables clustered alike join without a shuffle. ``inputs`` are tables that
    have to be loaded before, if the same run loads them.
    """

    table: str
    rows: DataFrame | Callable[[], DataFrame]
    keys: list[str]
    source: str | None = None
    expected_rows: Callable[[], int] | None = None
    source_is_unique: bool = False
    check_keys: list[str] | None = None
    bucket: str | None = None
    clustering: Clustering | None = None
    inputs: tuple[str, ...] = ()

    def frame(self) -> DataFrame:
        return self.rows if isinstance(self.rows, DataFrame) else self.rows()


@dataclass(frozen=True)
class LoadResult:
    table: str
    status: str
    rows_read: int | None = None
    expected_rows: int | None = None
    counts: WriteCounts | None = None
    duplicate_keys: int | None = None
    key_nulls: int | None = None
    error: str | None = None


def load_table(spark: SparkSession, spec: LoadSpec) -> LoadResult:
    """Load one table. Rows read are counted by the writing job. Validation is one aggregation of the result; a table in
    partitions keeps key counts, of which a run renews those of the partitions it touched."""
    seen = Observation()
    batch = spec.frame().observe(seen, F.count(F.lit(1)).alias("rows_read"))
    if spec.bucket:
        counts = upsert_partitions(
            spark, batch, spec.table, spec.keys, F.expr(spec.bucket), spec.source_is_unique, spec.check_keys, spec.clustering)
        check = key_summary(spark, spec.table)
    else:
        counts = upsert_table(spark, batch, spec.table, spec.keys, spec.source_is_unique, spec.clustering)
        check = validate_key(spark.table(spec.table), spec.check_keys or spec.keys, spec.table).first()
    rows_read = seen.get.get("rows_read", 0)
    expected = spec.expected_rows() if spec.expected_rows else None
    status = "SUCCESS" if expected is None or expected == rows_read else "WARNING"
    return LoadResult(
        spec.table, status, rows_read, expected, counts, check["duplicate_keys"], check["key_nulls"]
    )


def _isolated(spark: SparkSession, spec: LoadSpec) -> LoadResult:
    try:
        return load_table(spark, spec)
    except Exception as error:  # noqa: BLE001 - any failure belongs to this table and what is built from it; it goes to the audit log
        log.exception("load of %s failed", spec.table)
        return LoadResult(spec.table, "FAILED", error=f"{type(error).__name__}: {error}")


def load_order(specs: list[LoadSpec]) -> dict[str, set[str]]:
    """The tables of this run that each table waits for. A circle, which could never start, is an error."""
    tables = [spec.table for spec in specs]
    waits = {spec.table: {t for t in spec.inputs if t in tables and t != spec.table} for spec in specs}
    left = dict(waits)
    while left:
        free = {table for table, inputs in left.items() if not inputs & left.keys()}
        if not free:
            raise ValueError(f"tables wait for each other: {sorted(left)}")
        left = {table: inputs for table, inputs in left.items() if table not in free}
    return waits


def run_loads(
    spark: SparkSession, specs: list[LoadSpec], run_id: str, run_ts: datetime, audit_table: str, parallel: int = 1
) -> list[LoadResult]:
    """Load all tables, each after the tables it is built from; up to ``parallel`` that wait for nothing run side by side.

    Each writes its audit row when it ends, failed or not. One failure does not stop the others, but tables built from a
    failed one are not loaded from its old rows: they are SKIPPED, and so on down to the last. The results are in the order of ``specs``.
    """
    waits = load_order(specs)
    lock = Lock()
    results: dict[str, LoadResult] = {}

    def load(spec: LoadSpec) -> LoadResult:
        missing = sorted(t for t in waits[spec.table] if results[t].status in ("FAILED", "SKIPPED"))
        result = LoadResult(spec.table, "SKIPPED", error=f"not loaded: {', '.join(missing)}") if missing else _isolated(spark, spec)
        with lock:  # the first row of a log creates its table
            append_audit(spark, audit_table, [audit_row(
                run_id, spec.table, spec.source, run_ts, result.rows_read, result.counts, result.status, result.error)])
        return result

    run_one = inheritable_thread_target(spark)(load) if parallel > 1 else load
    pending, running = list(specs), set[Future]()
    with ThreadPoolExecutor(parallel) as pool:
        while pending or running:
            ready = [spec for spec in pending if waits[spec.table] <= results.keys()]
            pending = [spec for spec in pending if spec not in ready]
            running |= {pool.submit(run_one, spec) for spec in ready}
            done, running = wait(running, return_when=FIRST_COMPLETED)
            results |= {result.table: result for result in (future.result() for future in done)}
    return [results[spec.table] for spec in specs]


def run_summary(spark: SparkSession, audit_table: str, run_id: str) -> DataFrame:
    """What one run did, read back from the audit log."""
    return spark.table(audit_table).where(F.col("run_id") == run_id).select(
        "table_name", "status", "rows_read_from_source", "rows_inserted", "rows_updated",
        "rows_total_after_write", "error_message",
    )


def status_counts(spark: SparkSession, audit_table: str, run_id: str) -> DataFrame:
    return run_summary(spark, audit_table, run_id).groupBy("status").agg(F.count("*").alias("table_count"))


def merge_audit(table: str, stored: DataFrame, batch: DataFrame, keys: list[str], counted_again: DataFrame) -> DataFrame:
    """The audit row of merging ``batch`` into ``stored``: rows read, what the merge does, repeated keys, and whether a
    second reading of the source (``counted_again``, one row ``n``) has as many rows.

    All counts come from one pass over both sides, see ``operators.merge.merge_rows``. Each side is dealt by key as it comes, and
    the union keeps that deal (Spark 4.1): the fingerprints of the batch, longer than most rows and not to be compressed, are made behind the
    only shuffle of its rows. A key that repeats in the batch with different rows, which a writing merge refuses, changes nothing
    and is one of the repeated keys.
    """
    counts = merge_counts(merge_rows(stored.repartition(*keys), batch.repartition(*keys), keys, fail_on_conflict=False))
    expected = counted_again.agg(F.coalesce(F.max("n"), F.lit(0))).scalar()
    status = F.when(F.col("rows_read") == expected, "SUCCESS").otherwise("WARNING")
    return counts.select(F.lit(table).alias("table_name"), *counts.columns, status.alias("status"))
