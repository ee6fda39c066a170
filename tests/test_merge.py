from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.operators.merge import CHANGE, change_counts, first_load, merge_counts, merge_rows, merge_upsert, with_fingerprint

SCHEMA = "id int, v string, created_at string, updated_at string"


def _frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def _stored(spark, data, schema=SCHEMA):
    return with_fingerprint(_frame(spark, data, schema), ["id"])


def test_rules(spark):
    target = _stored(spark, [(k, v, "t0", "t0") for k, v in [(1, "a"), (2, "b"), (3, "c"), (None, "n")]])
    source = _frame(spark, [(k, v, "t1", "t1") for k, v in [(1, "a"), (2, "B"), (9, "new"), (None, "n")]])
    out = merge_upsert(target, source, ["id"]).drop("row_hash")
    assert rows(out) == [
        (1, "a", "t0", "t0", "unchanged"),       # equal fingerprint: untouched, updated_at stays
        (2, "B", "t0", "t1", "update"),          # created_at stays, the rest is taken
        (3, "c", "t0", "t0", "kept"),            # nothing deletes
        (9, "new", "t1", "t1", "insert"),
        (None, "n", "t0", "t0", "unchanged"),    # a NULL key meets itself
    ]


def test_rows_stored_without_fingerprint_update_once(spark):
    target = _frame(spark, [(1, "a", "t0", "t0")])
    source = _frame(spark, [(1, "a", "t1", "t1")])
    first = merge_upsert(target, source, ["id"])
    assert [r[CHANGE] for r in first.collect()] == ["update"]
    assert [r[CHANGE] for r in merge_upsert(first.drop(CHANGE), source, ["id"]).collect()] == ["unchanged"]


def test_columns_evolve_both_ways(spark):
    target = _stored(spark, [(1, "old", "x"), (2, "old", "y")], "id int, v string, only_target string")
    source = _frame(spark, [(1, "new", 7), (3, "new", 8)], "id int, v string, only_source int")
    out = merge_upsert(target, source, ["id"]).select("id", "v", "only_target", "only_source", CHANGE)
    assert rows(out) == [
        (1, "new", "x", 7, "update"), (2, "old", "y", None, "kept"), (3, "new", None, 8, "insert"),
    ]


def test_repeated_source_keys(spark):
    target = _stored(spark, [(1, "a", "t0", "t0")])
    twice = _frame(spark, [(1, "b", "t1", "t1"), (1, "c", "t1", "t1")])
    with pytest.raises(Exception, match="merge source: 1 repeated key"):
        merge_upsert(target, twice, ["id"]).collect()
    assert first_load(twice, ["id"]).count() == 2


def test_target_duplicates_are_all_kept(spark):
    target = _stored(spark, [(1, "a", "t0", "t0"), (1, "a", "t0", "t0")])
    source = _frame(spark, [(1, "b", "t1", "t1")])
    assert [r["v"] for r in merge_upsert(target, source, ["id"]).collect()] == ["b", "b"]


def test_empty_sides(spark):
    some = _frame(spark, [(1, "a", "t", "t")])
    none = _frame(spark, [])
    assert rows(change_counts(merge_upsert(with_fingerprint(none, ["id"]), some, ["id"]))) == [("insert", 1)]
    assert rows(change_counts(merge_upsert(with_fingerprint(some, ["id"]), none, ["id"]))) == [("kept", 1)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.tuples(st.integers(0, 4), st.integers(0, 2)), st.sampled_from("abc"), max_size=12),
    st.dictionaries(st.tuples(st.integers(0, 4), st.integers(0, 2)), st.sampled_from("abc"), max_size=12),
    st.booleans(),
)
def test_merge_equals_a_dict(spark, old, new, broadcast):
    schema, keys = "a int, b int, v string", ["a", "b"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        target = with_fingerprint(spark.createDataFrame([(*k, v) for k, v in old.items()], schema), keys)
        source = spark.createDataFrame([(*k, v) for k, v in new.items()], schema)
        merged = merge_upsert(target, source, keys)
        assert rows(merged.select(*keys, "v")) == sorted(((*k, v) for k, v in {**old, **new}.items()), key=repr)
        expected = {"kept": len(old.keys() - new.keys()), "insert": len(new.keys() - old.keys()),
                    "update": sum(old[k] != new[k] for k in old.keys() & new.keys()),
                    "unchanged": sum(old[k] == new[k] for k in old.keys() & new.keys())}
        assert dict(rows(change_counts(merged))) == {k: n for k, n in expected.items() if n}
        again = merge_upsert(merged.drop(CHANGE), source, keys)
        assert again.where(F.col(CHANGE).isin("insert", "update")).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_pass_follows_the_same_rules(spark):
    target = _stored(spark, [(k, v, "t0", "t0") for k, v in [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (7, "x"), (7, "x")]])
    source = _frame(spark, [(k, v, "t1", "t1") for k, v in [(1, "a"), (2, "B"), (9, "new"), (9, "new"), (None, "n"), (7, "y")]])
    joined, once = merge_upsert(target, source, ["id"]), merge_upsert(target, source, ["id"], target_is_unique=True)
    assert joined.columns == once.columns
    assert rows(once) == rows(joined)


def test_one_pass_refuses_repeated_keys_with_different_rows(spark):
    target = _stored(spark, [(1, "a", "t0", "t0")])
    for keys in ([(1, "b"), (1, "c")], [(5, "b"), (5, "c")], [(None, "b"), (None, "c")]):
        with pytest.raises(Exception, match="repeated key"):
            merge_upsert(target, _frame(spark, [(*k, "t1", "t1") for k in keys]), ["id"], target_is_unique=True).collect()


def test_counts_of_one_pass(spark):
    target = _stored(spark, [(k, "a", "t0", "t0") for k in (1, 2, 3)])
    source = _frame(spark, [(1, "a", "t1", "t1"), (2, "b", "t1", "t1"), (2, "b", "t1", "t1"), (8, "n", "t1", "t1"), (8, "n", "t1", "t1"), (8, "n", "t1", "t1")])
    assert rows(merge_counts(merge_rows(target, source, ["id"]))) == [(6, 1, 1, 4, 2)]
    none = _frame(spark, [])
    assert rows(merge_counts(merge_rows(_stored(spark, []), none, ["id"]))) == [(0, 0, 0, 0, 0)]


@pytest.mark.parametrize("one_pass", [False, True])
def test_a_column_may_change_its_type(spark, one_pass):
    """Text after whole numbers: equal text is no change, the stored rows become text."""
    target = _stored(spark, [(1, 10), (2, 20), (3, 30)], "id int, v int")
    source = _frame(spark, [(1, "10"), (2, "20 kg"), (4, "x")], "id bigint, v string")
    merged = merge_upsert(target, source, ["id"], target_is_unique=one_pass)
    assert dict(merged.dtypes)["v"] == "string" and dict(merged.dtypes)["id"] == "bigint"
    assert rows(merged.select("id", "v", CHANGE)) == [(1, "10", "unchanged"), (2, "20 kg", "update"), (3, "30", "kept"), (4, "x", "insert")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("abc"), max_size=6),
       st.dictionaries(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("abc"), max_size=6), st.integers(1, 3))
def test_one_pass_equals_a_dict(spark, old, new, copies):
    target = with_fingerprint(spark.createDataFrame(list(old.items()), "a int, v string"), ["a"])
    source = spark.createDataFrame(list(new.items()) * copies, "a int, v string")
    merged = merge_upsert(target, source, ["a"], target_is_unique=True)
    assert rows(merged.select("a", "v")) == sorted(({**old, **new}).items(), key=repr)
