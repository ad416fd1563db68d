import random

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from millpond.operators import merge as operators
from millpond.operators.merge import (
    delete,
    delete_where,
    insert,
    insert_all,
    merge,
    merge_changes,
    not_in,
    update,
    update_all,
    update_in,
    update_where,
)

DDL = "k INT, v STRING, w INT"


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


@pytest.fixture
def target(spark):
    return frame(spark, [(1, "a", 10), (2, "b", 20), (3, "c", 30)])


@pytest.fixture
def source(spark):
    return frame(spark, [(2, "B", 21), (3, "c", 30), (4, "D", 40), (None, "N", 0)])


def test_upsert_updates_inserts_and_keeps(target, source):
    got = rows(merge(target, source, ["k"], [update({"v": "s.v"})], [insert_all()]))
    assert got == sorted(
        [(1, "a", 10), (2, "B", 20), (3, "c", 30), (4, "D", 40), (None, "N", 0)], key=repr
    )


def test_columns_left_out_of_insert_are_null(target, source):
    got = rows(merge(target, source, ["k"], not_matched=[insert({"k": "s.k"}, when="s.k = 4")]))
    assert (4, None, None) in got and len(got) == 4


def test_null_key_is_inserted_on_every_run(target, source):
    once = merge(target, source, ["k"], [update_all()], [insert_all()])
    twice = merge(once, source, ["k"], [update_all()], [insert_all()])
    assert len(rows(twice)) == len(rows(once)) + 1


def test_merging_twice_equals_once_without_null_keys(target, source):
    clean = source.filter("k IS NOT NULL")
    once = merge(target, clean, ["k"], [update_all()], [insert_all()])
    assert rows(merge(once, clean, ["k"], [update_all()], [insert_all()])) == rows(once)


def test_two_source_rows_for_one_target_row_raise(spark, target):
    source = frame(spark, [(2, "x", 1), (2, "y", 2)])
    with pytest.raises(PySparkException, match="several source rows"):
        merge(target, source, ["k"], [update_all()], [insert_all()]).collect()


def test_two_source_rows_for_a_new_key_are_two_inserts(spark, target):
    source = frame(spark, [(9, "x", 1), (9, "y", 2)])
    got = rows(merge(target, source, ["k"], [update_all()], [insert_all()]))
    assert got[-2:] == [(9, "x", 1), (9, "y", 2)]


def test_rows_no_clause_uses_do_not_clash(spark, target):
    source = frame(spark, [(2, "old", 1), (2, "new", 2)])
    got = rows(merge(target, source, ["k"], [update_all(when="s.v = 'new'")]))
    assert (2, "new", 2) in got and len(got) == 3


def test_first_true_clause_wins_and_none_keeps_the_row(target, source):
    got = rows(
        merge(
            target,
            source,
            ["k"],
            [update({"w": "s.w + 100"}, when="s.w > 25"), update({"w": "-1"}, when="s.w > 29"), delete("s.v = 'zz'")],
        )
    )
    assert got == [(1, "a", 10), (2, "b", 20), (3, "c", 130)]


def test_delete_clause(target, source):
    got = rows(merge(target, source, ["k"], [delete("s.v = 'B'"), update_all()], [insert_all("s.k = 4")]))
    assert got == [(1, "a", 10), (3, "c", 30), (4, "D", 40)]


def test_condition_may_read_the_target(target, source):
    got = rows(merge(target, source.filter("k IS NOT NULL"), ["k"], [update_all(when="s.w > t.w")]))
    assert got == [(1, "a", 10), (2, "B", 21), (3, "c", 30)]


def test_one_source_row_updates_every_target_row_of_its_key(spark):
    target = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3)])
    got = rows(merge(target, frame(spark, [(1, "z", 9)]), ["k"], [update({"v": "s.v"})]))
    assert got == [(1, "z", 1), (1, "z", 2), (2, "c", 3)]


def test_one_sided_match_conditions(spark, target, source):
    got = rows(
        merge(target, source, ["k"], [update({"v": "'hit'"})], match_target="t.w < 25", match_source="s.k IS NOT NULL")
    )
    assert got == [(1, "a", 10), (2, "hit", 20), (3, "c", 30)]


def test_differently_named_keys(spark, target):
    source = spark.createDataFrame([(2, "Z")], "key INT, val STRING")
    got = rows(merge(target, source, {"k": "key"}, [update({"v": "s.val"})]))
    assert got == [(1, "a", 10), (2, "Z", 20), (3, "c", 30)]


def test_new_rows_are_numbered_after_the_largest(spark):
    target = spark.createDataFrame([(5, "a")], "id BIGINT, name STRING")
    source = spark.createDataFrame([("c",), ("a",), ("b",)], "name STRING")
    got = rows(merge(target, source, ["name"], not_matched=[insert({"name": "s.name"})], identity="id"))
    assert got == [(5, "a"), (6, "b"), (7, "c")]


def test_change_rows_of_a_merge(target, source):
    got = rows(merge_changes(target, source, ["k"], [update_all()], [insert_all()]))
    assert got == sorted(
        [
            (2, "b", 20, "update_preimage"),
            (2, "B", 21, "update_postimage"),
            (4, "D", 40, "insert"),
            (None, "N", 0, "insert"),
        ],
        key=repr,
    )


def test_insert_after_matched_is_refused(target, source):
    with pytest.raises(ValueError):
        merge(target, source, ["k"], [insert_all()])


def test_update_and_delete_where_keep_rows_with_a_null_condition(spark):
    df = frame(spark, [(1, None, 1), (2, "x", 2)])
    assert rows(update_where(df, "v = 'x'", {"w": "w + 5"})) == [(1, None, 1), (2, "x", 7)]
    assert rows(delete_where(df, "v = 'x'")) == [(1, None, 1)]


def test_update_in_counts_each_row_once(spark, target):
    members = spark.createDataFrame([(2,), (2,), (3,)], "k INT")
    assert rows(update_in(target, members, ["k"], {"v": "'u'"})) == [(1, "a", 10), (2, "u", 20), (3, "u", 30)]


@pytest.mark.parametrize(
    "members, left",
    [([1], [2, 3]), ([1, None], []), ([], [1, 2, 3, None]), ([7], [1, 2, 3])],
)
def test_not_in_follows_the_null_rules(spark, members, left):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x INT")
    sub = spark.createDataFrame([(m,) for m in members], "y INT")
    assert rows(not_in(df, "x", sub)) == sorted([(v,) for v in left], key=repr)


keyed = st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from("abc"), st.integers(0, 3)), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=keyed, new=keyed)
def test_merge_matches_a_dictionary_update(spark, old, new):
    target = frame(spark, [(k, *v) for k, v in old.items()])
    source = frame(spark, [(k, *v) for k, v in new.items()])
    merged = merge(target, source, ["k"], [update_all()], [insert_all()])
    assert rows(merged) == rows(frame(spark, [(k, *v) for k, v in (old | new).items()]))


def conditional(target, source):
    return operators.merge(
        target,
        source,
        ["k"],
        [delete("s.v = 'gone'"), update({"v": "s.v"}, when="s.n > t.n")],
        [insert({"k": "s.k", "v": "s.v", "n": "s.n"}, when="s.v <> 'gone'")],
    )


def test_only_source_rows_a_clause_would_use_count_as_repeats(spark):
    """Two rows for a key are fine while the target lets one of them act, or none."""
    ddl = "k INT, v STRING, n INT"
    target = spark.createDataFrame([(1, "a", 5), (1, "b", 9), (2, "c", 5), (3, "d", 5)], ddl)
    source = spark.createDataFrame([(1, "x", 7), (1, "y", 1), (2, "z", 1), (2, "w", 2), (4, "n", 1), (4, "m", 2)], ddl)
    got = rows(conditional(target, source))
    assert got == sorted([(1, "x", 5), (1, "b", 9), (2, "c", 5), (3, "d", 5), (4, "n", 1), (4, "m", 2)], key=repr)
    clash = source.unionByName(spark.createDataFrame([(1, "q", 8)], ddl))
    with pytest.raises(PySparkException, match="several source rows"):
        conditional(target, clash).collect()


def test_a_name_in_a_text_literal_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a", 5)], "k INT, v STRING, n INT")
    source = spark.createDataFrame([(1, "t.x", 1), (1, "b", 2)], "k INT, v STRING, n INT")
    merged = operators.merge(target, source, ["k"], [update({"v": "s.v"}, when="s.v = 't.x'")])
    assert rows(merged) == [(1, "t.x", 5)]


def test_one_join_and_several_give_the_same(spark, monkeypatch):
    """The form for small targets against the one for large ones, with null keys, extra conditions and unseen rows."""


    random_ = random.Random(7)
    ddl = "k INT, j STRING, v STRING, n INT"
    row = lambda k: (k, random_.choice(["a", "b", None]), random_.choice(["p", "gone", None]), random_.randrange(5))
    target = spark.createDataFrame([row(random_.choice([*range(30), None])) for _ in range(60)], ddl)
    seen = {}
    for _ in range(60):
        r = row(random_.choice([*range(20, 45), None]))
        seen[r[:2] if None not in r[:2] else len(seen)] = r
    source = spark.createDataFrame(list(seen.values()), ddl)
    results = []
    for size in (1 << 80, -1):
        monkeypatch.setattr(operators, "SMALL_TARGET", size)
        merged = operators.merge(
            target, source, ["k", "j"], [delete("s.v = 'gone'"), update({"n": "s.n + t.n"}, when="s.n > t.n")],
            [insert_all(when="s.n < 4")], match_target="t.n > 0", match_source="s.n <> 2",
        )
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert ("FullOuter" in plan) == (size > 0)
        results.append(rows(merged))
    assert results[0] == results[1] and len(results[0]) > 50
