from __future__ import annotations

import contextlib
import io
import time
from datetime import datetime
from pathlib import Path

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from salesmart.functions.audit import stamp
from salesmart.operators.keys import validate_key
from salesmart.operators.merge import merge_upsert, with_fingerprint
from salesmart.plans import loads, silver
from salesmart.plans.loads import LoadSpec
from salesmart.plans.tables import BRONZE_KEYS, SILVER_KEYS
from salesmart.registry.fixtures import SalesSources
from salesmart.sources import tables
from salesmart.sources.tables import (
    WriteCounts,
    append_audit,
    merge_into,
    overwrite_table,
    stable_batch,
    upsert_partitions,
    upsert_table,
)

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


@pytest.fixture
def db(spark):
    """A database of its own per test."""
    name = f"db_{len(spark.catalog.listDatabases())}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name


def _batch(spark, data, ts=T1):
    return stamp(spark.createDataFrame(data, "id int, v string"), ts, "f.csv", "FILES")


def test_overwrite_replaces_rows_and_schema(spark, db):
    name = f"{db}.t"
    assert overwrite_table(spark.createDataFrame([(1,), (2,)], "a int"), name) == WriteCounts(2, 0, 2)
    assert overwrite_table(spark.createDataFrame([("x",)], "b string"), name) == WriteCounts(1, 0, 1)
    assert rows(spark.table(name)) == [("x",)]


def test_upsert_generations(spark, db):
    name = f"{db}.t"
    assert upsert_table(spark, _batch(spark, [(1, "a"), (2, "b")]), name, ["id"]) == WriteCounts(2, 0, 2)
    second = _batch(spark, [(2, "B"), (3, "c")], T2)
    assert upsert_table(spark, second, name, ["id"]) == WriteCounts(1, 1, 3)
    assert upsert_table(spark, second, name, ["id"]) == WriteCounts(0, 0, 3)
    assert rows(spark.table(name).select("id", "v", "created_at", "updated_at")) == [
        (1, "a", T1, T1), (2, "B", T1, T2), (3, "c", T2, T2),
    ]
    kept = sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary or t.name == "t")
    assert kept == ["t", "t__g2", "t__g3"]


def test_upsert_replaces_touched_partitions_only(spark, db, conf):
    name, bucket = f"{db}.facts", F.expr("id DIV 10")
    with pytest.raises(ValueError, match="dynamic"):
        upsert_partitions(spark, _batch(spark, []), name, ["id"], bucket)
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    first = _batch(spark, [(1, "a"), (2, "b"), (11, "c"), (25, "d")])
    assert upsert_partitions(spark, first, name, ["id"], bucket) == WriteCounts(4, 0, 4)
    files = {r[0] for r in spark.table(name).where("id >= 20").select("_metadata.file_path").collect()}
    batch = _batch(spark, [(2, "B"), (3, "new"), (11, "c"), (31, "e")], T2)
    assert upsert_partitions(spark, batch, name, ["id"], bucket) == WriteCounts(2, 1, 6)
    assert rows(spark.table(name).select("id", "v", "updated_at")) == [
        (1, "a", T1), (11, "c", T1), (2, "B", T2), (25, "d", T1), (3, "new", T2), (31, "e", T2),
    ]
    untouched = spark.table(name).where("id BETWEEN 20 AND 29").select("_metadata.file_path")
    assert {r[0] for r in untouched.collect()} == files
    assert upsert_partitions(spark, batch, name, ["id"], bucket) == WriteCounts(0, 0, 6)
    for ts, expected in ((T1, WriteCounts(1, 0, 7)), (T2, WriteCounts(0, 0, 7))):
        assert upsert_partitions(spark, _batch(spark, [(None, "n")], ts), name, ["id"], bucket) == expected
    assert upsert_partitions(spark, _batch(spark, [(None, "N")], T2), name, ["id"], bucket) == WriteCounts(0, 1, 7)


def test_partitioned_table_takes_new_columns(spark, db, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spec = LoadSpec(f"{db}.facts", lambda: _batch(spark, [(1, "a"), (11, "b")]), ["id"], bucket="id DIV 10")
    assert loads.load_table(spark, spec).counts == WriteCounts(2, 0, 2)
    wider = LoadSpec(spec.table, lambda: _batch(spark, [(1, "a")], T2).selectExpr("*", "7 AS extra"), ["id"],
                     bucket="id DIV 10")
    result = loads.load_table(spark, wider)
    assert (result.rows_read, result.counts) == (1, WriteCounts(0, 1, 2))
    assert rows(spark.table(spec.table).select("id", "v", "extra")) == [(1, "a", 7), (11, "b", None)]


def test_batch_is_written_once_where_the_cluster_names_a_folder(spark):
    kept = stable_batch(spark.range(3).selectExpr("id", "rand() AS r"))
    assert rows(kept) == rows(kept)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        kept.explain()
    assert "ExistingRDD" in out.getvalue()


def test_failed_upsert_leaves_the_table_alone(spark, db):
    name = f"{db}.t"
    upsert_table(spark, _batch(spark, [(1, "a")]), name, ["id"])
    with pytest.raises(Exception, match="repeated key"):
        upsert_table(spark, _batch(spark, [(1, "b"), (1, "c")], T2), name, ["id"])
    assert rows(spark.table(name).select("id", "v")) == [(1, "a")]
    assert upsert_table(spark, _batch(spark, [(1, "b")], T2), name, ["id"]) == WriteCounts(0, 1, 1)


def test_row_level_merge_needs_a_table_that_supports_it(spark, db):
    name = f"{db}.plain"
    overwrite_table(_batch(spark, [(1, "a")]).selectExpr("*", "'' AS row_hash"), name)
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into(_batch(spark, [(1, "b")]), name, ["id"])


def test_audit_log_appends_and_insists_on_its_columns(spark, db):
    name = f"{db}.audit"
    row = ("run", "t", None, T1, 1, 1, 0, 1, "SUCCESS", None)
    append_audit(spark, name, [row])
    append_audit(spark, name, [row])
    assert spark.table(name).count() == 2
    with pytest.raises(Exception):  # noqa: B017 - a NULL in a NOT NULL column
        append_audit(spark, name, [(None, *row[1:])])


def test_run_isolates_failures_and_reports_mismatches(spark, db):
    def broken():
        raise FileNotFoundError("Customers.csv")

    specs = [
        LoadSpec(f"{db}.good", _batch(spark, [(1, "a"), (2, "b")]), ["id"], "a.csv", expected_rows=lambda: 2),
        LoadSpec(f"{db}.bad", broken, ["id"], "Customers.csv"),
        LoadSpec(f"{db}.short", lambda: _batch(spark, [(1, "a")]), ["id"], "c.csv", expected_rows=lambda: 5),
        LoadSpec(f"{db}.twice", _batch(spark, [(1, "a"), (1, "b")]), ["id"], "d.csv"),
    ]
    results = loads.run_loads(spark, specs, "run1", T1, f"{db}.audit", parallel=2)
    assert [r.status for r in results] == ["SUCCESS", "FAILED", "WARNING", "SUCCESS"]
    assert [r.duplicate_keys for r in results] == [0, None, 0, 1]
    assert results[1].error == "FileNotFoundError: Customers.csv"
    assert rows(loads.run_summary(spark, f"{db}.audit", "run1")) == sorted([
        (f"{db}.good", "SUCCESS", 2, 2, 0, 2, None),
        (f"{db}.bad", "FAILED", None, None, None, None, "FileNotFoundError: Customers.csv"),
        (f"{db}.short", "WARNING", 1, 1, 0, 1, None),
        (f"{db}.twice", "SUCCESS", 2, 2, 0, 2, None),
    ], key=repr)
    assert rows(loads.status_counts(spark, f"{db}.audit", "run1")) == [("FAILED", 1), ("SUCCESS", 2), ("WARNING", 1)]
    # a later run of the repeated keys cannot be merged; the first load is unharmed
    again = loads.run_loads(spark, specs[3:], "run2", T2, f"{db}.audit")
    assert again[0].status == "FAILED" and "repeated key" in again[0].error
    assert spark.table(f"{db}.twice").count() == 2


def test_rows_read_is_counted_once_in_a_merge(spark, db):
    spec = LoadSpec(f"{db}.t", lambda: _batch(spark, [(1, "a"), (2, "b"), (3, "c")]), ["id"])
    loads.run_loads(spark, [spec], "r1", T1, f"{db}.audit")
    second = loads.run_loads(spark, [spec], "r2", T1, f"{db}.audit")
    assert second[0].rows_read == 3 and second[0].counts == WriteCounts(0, 0, 3)


def test_bronze_to_silver_and_back_again(spark, db):
    """Files to bronze to silver through stored tables; a second run changes nothing."""
    s = SalesSources(spark, SMALL)
    names = ["divisions", "shippers", "orders"]
    bronze = [LoadSpec(f"{db}.bronze_{n}", s.bronze(n), BRONZE_KEYS[n], n) for n in names]
    built = {source: (table, build) for table, (source, build) in silver.BUILDERS.items()}

    def silver_specs():
        return [
            LoadSpec(
                f"{db}.silver_{built[n][0]}",
                lambda n=n: built[n][1](spark.table(f"{db}.bronze_{n}")),
                SILVER_KEYS[built[n][0]],
            )
            for n in names
        ]

    assert {r.status for r in loads.run_loads(spark, bronze, "r", T1, f"{db}.audit")} == {"SUCCESS"}
    first = loads.run_loads(spark, silver_specs(), "r", T1, f"{db}.audit")
    assert [r.duplicate_keys for r in first] == [0, 0, 0]
    second = loads.run_loads(spark, silver_specs(), "r", T1, f"{db}.audit")
    assert [(r.counts.rows_inserted, r.counts.rows_updated) for r in second] == [(0, 0)] * 3


def test_empty_batches(spark, db):
    empty = LoadSpec(f"{db}.t", lambda: _batch(spark, []), ["id"])
    assert loads.load_table(spark, empty).counts == WriteCounts(0, 0, 0)
    some = LoadSpec(f"{db}.t", lambda: _batch(spark, [(1, "a")]), ["id"])
    assert loads.load_table(spark, some).counts == WriteCounts(1, 0, 1)
    result = loads.load_table(spark, empty)
    assert (result.rows_read, result.counts) == (0, WriteCounts(0, 0, 1))


def _folder(spark, table):
    """Where files of a table of the warehouse lie."""
    database, _, name = table.rpartition(".")
    return Path(spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()[1].removeprefix("file:")) / name


def test_a_left_over_folder_does_not_stop_the_next_run(spark, db):
    name = f"{db}.t"
    upsert_table(spark, _batch(spark, [(1, "a")]), name, ["id"])
    for leftover in ("t__g2", "t__g3"):  # what a driver leaves that died while writing
        folder = _folder(spark, f"{db}.{leftover}")
        folder.mkdir()
        (folder / "part-0.parquet").write_text("torn")
    assert upsert_table(spark, _batch(spark, [(2, "b")], T2), name, ["id"]) == WriteCounts(1, 0, 2)
    assert rows(spark.table(name).select("id", "v")) == [(1, "a"), (2, "b")]
    assert upsert_table(spark, _batch(spark, [(2, "B")], T2), name, ["id"]) == WriteCounts(0, 1, 2)


def test_a_failed_overwrite_leaves_the_old_rows(spark, db):
    name = f"{db}.t"
    overwrite_table(spark.createDataFrame([(1,), (2,)], "a int"), name)
    with pytest.raises(Exception, match="broken source"):
        overwrite_table(spark.range(3).selectExpr("id", "raise_error('broken source') AS x"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]
    assert overwrite_table(spark.createDataFrame([(3,)], "a int"), name) == WriteCounts(1, 0, 1)
    assert rows(spark.table(name)) == [(3,)]


def test_overwrite_takes_over_a_plain_table(spark, db):
    name = f"{db}.t"
    spark.range(3).write.saveAsTable(name)
    assert overwrite_table(spark.range(2), name) == WriteCounts(2, 0, 2)
    assert rows(spark.table(name)) == [(0,), (1,)]


@pytest.mark.parametrize("bucket", [None, "id DIV 10"])
def test_a_load_survives_a_changed_type(spark, db, conf, bucket):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    number = lambda: stamp(spark.createDataFrame([(1, 10), (12, 20)], "id int, v int"), T1, "f.csv", "FILES")
    text = lambda: stamp(spark.createDataFrame([(1, "10"), (12, "n/a"), (31, "5")], "id bigint, v string"), T2, "f.csv", "FILES")
    specs = [LoadSpec(f"{db}.t", rows, ["id"], bucket=bucket) for rows in (number, text, number)]
    results = [loads.run_loads(spark, [spec], f"r{k}", T1, f"{db}.audit")[0] for k, spec in enumerate(specs)]
    assert [r.status for r in results] == ["SUCCESS"] * 3, results
    assert [r.counts for r in results] == [WriteCounts(2, 0, 2), WriteCounts(1, 1, 3), WriteCounts(0, 1, 3)]
    assert dict(spark.table(f"{db}.t").dtypes)["v"] == "string" and dict(spark.table(f"{db}.t").dtypes)["id"] == "bigint"
    assert rows(spark.table(f"{db}.t").select("id", "v")) == [(1, "10"), (12, "20"), (31, "5")]


def test_a_rewrite_that_was_cut_short_is_finished(spark, db, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    name, bucket = f"{db}.t", F.expr("id DIV 10")
    upsert_partitions(spark, _batch(spark, [(1, "a")]), name, ["id"], bucket)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__w1")  # the driver died between dropping the old table and this rename
    assert upsert_partitions(spark, _batch(spark, [(1, "a"), (2, "b")], T2), name, ["id"], bucket) == WriteCounts(1, 0, 2)


@pytest.mark.parametrize("small_batch", [10**6, 0])
def test_untouched_partitions_are_not_read(spark, db, conf, monkeypatch, small_batch):
    """Files of a partition that the batch does not touch are torn; neither merge, write nor validation opens them."""
    monkeypatch.setattr(tables, "SMALL_BATCH", small_batch)
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    name = f"{db}.facts"
    spec = LoadSpec(name, lambda: _batch(spark, [(k, "a") for k in range(40)]), ["id"], bucket="id DIV 10")
    assert loads.load_table(spark, spec).counts == WriteCounts(40, 0, 40)
    for file in (_folder(spark, name) / "key_bucket=3").glob("*.parquet"):
        file.write_bytes(b"torn")
    later = LoadSpec(name, lambda: _batch(spark, [(5, "B"), (12, "a"), (41, "new")], T2), ["id"], bucket="id DIV 10")
    result = loads.load_table(spark, later)
    assert (result.status, result.counts, result.duplicate_keys, result.key_nulls) == ("SUCCESS", WriteCounts(1, 1, 41), 0, 0)
    with pytest.raises(Exception):  # noqa: B017 - the torn file is there, a full read meets it
        spark.table(name).count()


def test_key_counts_are_kept_beside_the_table(spark, db, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spec = lambda data: LoadSpec(f"{db}.t", lambda: _batch(spark, data), ["id", "v"], check_keys=["id"], bucket="id DIV 10")
    first = loads.load_table(spark, spec([(1, "a"), (1, "b"), (2, "a"), (11, "a"), (None, "x")]))
    assert (first.duplicate_keys, first.key_nulls, first.counts.rows_total) == (1, 1, 5)
    second = loads.load_table(spark, spec([(11, "b"), (25, "a")]))
    assert (second.duplicate_keys, second.key_nulls, second.counts) == (2, 1, WriteCounts(2, 0, 7))
    assert rows(spark.table(f"{db}.t__keys").select("key_bucket", "row_count", "key_nulls", "duplicate_keys")) == [
        ("0", 3, 0, 1), ("1", 2, 0, 1), ("2", 1, 0, 0), ("none", 1, 1, 0)]
    whole = validate_key(spark.table(f"{db}.t"), ["id"], "t").first()
    assert (whole.total_rows, whole.key_nulls, whole.duplicate_keys) == (7, 1, 2)


def test_tables_wait_for_their_inputs(spark, db):
    """Ten tables in a chain, given in the wrong order and run side by side: each finds the rows of the one before."""
    def build(k):
        if k == 0:
            time.sleep(1)
            return _batch(spark, [(0, "start")])
        return spark.table(f"{db}.t{k - 1}").select("id", F.concat("v", F.lit(f"-{k}")).alias("v"))

    specs = [LoadSpec(f"{db}.t{k}", lambda k=k: build(k), ["id"], inputs=(f"{db}.t{k - 1}", f"{db}.elsewhere") if k else ()) for k in (3, 1, 0, 2)]
    results = loads.run_loads(spark, specs, "r", T1, f"{db}.audit", parallel=8)
    assert [r.table for r in results] == [s.table for s in specs] and {r.status for r in results} == {"SUCCESS"}
    assert rows(spark.table(f"{db}.t3").select("v")) == [("start-1-2-3",)]


def test_tables_built_from_a_failed_one_are_skipped(spark, db):
    def broken():
        raise FileNotFoundError("gone.csv")

    specs = [LoadSpec(f"{db}.c", lambda: spark.table(f"{db}.b"), ["id"], inputs=(f"{db}.b",)), LoadSpec(f"{db}.b", lambda: spark.table(f"{db}.a"), ["id"], inputs=(f"{db}.a",)),
             LoadSpec(f"{db}.a", broken, ["id"]), LoadSpec(f"{db}.d", lambda: _batch(spark, [(1, "a")]), ["id"])]
    results = loads.run_loads(spark, specs, "r", T1, f"{db}.audit", parallel=3)
    assert [r.status for r in results] == ["SKIPPED", "SKIPPED", "FAILED", "SUCCESS"]
    assert results[0].error == f"not loaded: {db}.b"
    assert rows(loads.status_counts(spark, f"{db}.audit", "r")) == [("FAILED", 1), ("SKIPPED", 2), ("SUCCESS", 1)]


def test_tables_that_wait_for_each_other_are_refused(spark, db):
    specs = [LoadSpec(f"{db}.a", None, ["id"], inputs=(f"{db}.b",)), LoadSpec(f"{db}.b", None, ["id"], inputs=(f"{db}.a",))]
    with pytest.raises(ValueError, match="wait for each other"):
        loads.run_loads(spark, specs, "r", T1, f"{db}.audit")


@pytest.mark.parametrize("stored_key", ["bigint", "int"])
def test_merge_audit_of_rows_in_many_partitions(spark, conf, stored_key):
    """Keys of the same or another type, keys without a value, rows that come again and rows that only one side has."""
    conf("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "37")
    stored = spark.range(0, 3000).selectExpr(f"CAST(nullif(id, 7) AS {stored_key}) AS k", "id % 5 AS v")
    stored = with_fingerprint(stored.dropDuplicates(["k"]), ["k"])
    batch = spark.range(1000, 5000).selectExpr("nullif(id, 4999) AS k", "id % 5 + if(id % 10 = 0, 1, 0) AS v")
    batch = batch.unionByName(batch.where("k % 100 = 1"))
    again = batch.agg(F.count("*").alias("n"))
    # the batch's NULL key meets the stored one, with v = 4 instead of 2
    expected = [("t", 4040, 1999, 201, 4999, 40, "SUCCESS")]
    assert rows(loads.merge_audit("t", stored, batch, ["k"], again)) == expected
    assert rows(loads.merge_audit("t", stored.coalesce(1), batch.coalesce(2), ["k"], again)) == expected


def test_merge_audit_reports_keys_that_repeat_with_different_rows(spark):
    """A stored key, a new one and the one without a value: nothing is taken for them, the other keys merge."""
    schema = "k int, v string"
    stored = with_fingerprint(spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a"), (None, "a")], schema), ["k"])
    batch = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "a"), (2, "b"), (2, "b"), (3, "a"), (8, "x"), (8, "y"), (9, "n"), (None, "a"), (None, "z")], schema)
    again = batch.agg(F.count("*").alias("n"))
    assert rows(loads.merge_audit("t", stored, batch, ["k"], again)) == [("t", 11, 1, 1, 6, 4, "SUCCESS")]
    with pytest.raises(Exception, match="repeated key with different rows"):
        merge_upsert(stored, batch, ["k"], target_is_unique=True).collect()
