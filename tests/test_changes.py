import os

import datetime

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millpond.operators import changes, keys, scd2
from millpond.operators.merge import delete, insert, insert_all, merge, update_all
from millpond.operators.tables import Lake
from millpond.session import new_folder

DDL = "k INT, v STRING"


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def test_diff_kinds(spark):
    before = frame(spark, [(1, "a"), (2, "b"), (3, None), (4, "d"), (5, "e")])
    after = frame(spark, [(2, "b"), (3, "c"), (4, None), (5, "E"), (6, "f")])
    assert rows(changes.diff(before, after, ["k"])) == sorted(
        [
            (1, "a", "delete"),
            (3, None, "update_preimage"),
            (3, "c", "update_postimage"),
            (4, "d", "update_preimage"),
            (4, None, "update_postimage"),
            (5, "e", "update_preimage"),
            (5, "E", "update_postimage"),
            (6, "f", "insert"),
        ],
        key=repr,
    )


def test_diff_refuses_a_repeated_key(spark):
    with pytest.raises(PySparkException, match="repeats a key"):
        changes.diff(frame(spark, [(1, "a"), (1, "b")]), frame(spark, [(1, "a")]), ["k"]).collect()


state = st.dictionaries(st.integers(0, 6) | st.none(), st.sampled_from(["a", "b", None]), max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=state, b=state)
def test_applying_a_diff_gives_the_second_state(spark, a, b):
    before, after = frame(spark, list(a.items())), frame(spark, list(b.items()))
    assert rows(changes.apply(before, changes.diff(before, after, ["k"]), ["k"])) == rows(after)


def test_log_reads_versions_inclusive_and_prunes(spark):
    path = new_folder(spark, "log")
    for version in (1, 2, 3):
        row = frame(spark, [(version, "x")]).withColumn("_change_type", F.lit("insert"))
        changes.append(row, path, version, f"2024-01-0{version}")
    assert [r.k for r in changes.read(spark, path, 2).orderBy("k").collect()] == [2, 3]
    assert [r.k for r in changes.read(spark, path, 1, 2).orderBy("k").collect()] == [1, 2]
    assert changes.read(spark, path, 4).count() == 0 and changes.read(spark, path, 4).columns == changes.read(spark, path, 1).columns
    typed = changes.read(spark, path, 2, 2, changes.read(spark, path, 1).schema)
    assert [(r.k, r._commit_version) for r in typed.collect()] == [(2, 2)]


def test_a_range_opens_no_folder_of_another_version(spark):
    """A thousand other versions that cannot be read are in nobody's way."""
    path = new_folder(spark, "log")
    for version in range(1, 1001):
        os.makedirs(f"{path}/_commit_version={version}")
        with open(f"{path}/_commit_version={version}/part-0.parquet", "w") as f:
            f.write("no Parquet file")
    changes.append(frame(spark, [(7, "x")]).withColumn("_change_type", F.lit("insert")), path, 1001, "2024-01-01")
    for log in (changes.read(spark, path, 1001), changes.read(spark, path, 1001, 1003)):
        assert len(log.inputFiles()) >= 1 and all("=1001/" in f for f in log.inputFiles())
        assert [(r.k, r._commit_version) for r in log.collect()] == [(7, 1001)]


def test_apply_over_several_versions_keeps_the_last(spark):
    log = spark.createDataFrame(
        [
            (1, "a", "insert", 1),
            (1, "a", "update_preimage", 2),
            (1, "b", "update_postimage", 2),
            (2, "x", "insert", 2),
            (2, "x", "delete", 3),
        ],
        "k INT, v STRING, _change_type STRING, _commit_version BIGINT",
    )
    assert rows(changes.apply(frame(spark, []), log, ["k"])) == [(1, "b")]


# -- history tables ---------------------------------------------------------
FEED_DDL = DDL + ", _change_type STRING, _commit_version BIGINT"
STEPS = [
    [(1, "a", "insert", 1)],
    [(1, "a", "update_preimage", 2), (1, "b", "update_postimage", 2)],
    [(1, "b", "delete", 3)],
]


def history(df):
    return rows(df.select("k", "v", "active_ind"))


def test_history_in_one_feed_equals_three_feeds(spark):
    once = scd2.first_load(frame(spark, sum(STEPS, []), FEED_DDL), ["k"], "2024-01-01")
    gold = scd2.first_load(frame(spark, STEPS[0], FEED_DDL), ["k"], "2024-01-01")
    assert history(gold) == [(1, "a", "Y")]
    gold = scd2.apply(gold, frame(spark, STEPS[1], FEED_DDL), ["k"], "2024-01-02")
    assert history(gold) == [(1, "a", "N"), (1, "b", "Y")]
    gold = scd2.apply(gold, frame(spark, STEPS[2], FEED_DDL), ["k"], "2024-01-03")
    assert history(gold) == history(once) == [(1, "a", "N"), (1, "b", "N")]


def test_an_expired_row_keeps_its_expiry(spark):
    gold = scd2.first_load(frame(spark, STEPS[0], FEED_DDL), ["k"], "2024-01-01")
    gold = scd2.apply(gold, frame(spark, STEPS[1], FEED_DDL), ["k"], "2024-01-02")
    gold = scd2.apply(gold, frame(spark, STEPS[2], FEED_DDL), ["k"], "2024-01-03")
    assert rows(gold.select("v", F.col("expiry_timestmp").cast("string"))) == [("a", "2024-01-02"), ("b", "2024-01-03")]


def test_stat_column_tells_update_from_delete(spark):
    gold = scd2.first_load(frame(spark, STEPS[0], FEED_DDL), ["k"], "2024-01-01", with_stat=True)
    gold = scd2.apply(gold, frame(spark, STEPS[1], FEED_DDL), ["k"], "2024-01-02", with_stat=True)
    assert rows(gold.select("v", "stat")) == [("a", "inactive"), ("b", "update_preimage")]
    gold = scd2.apply(gold, frame(spark, STEPS[2], FEED_DDL), ["k"], "2024-01-03", with_stat=True)
    assert rows(gold.select("v", "stat")) == [("a", "inactive"), ("b", "2024-01-03")]


def test_a_row_that_comes_back_is_active(spark):
    feed = frame(spark, sum(STEPS, []) + [(1, "c", "insert", 4)], FEED_DDL)
    assert history(scd2.first_load(feed, ["k"], "2024-01-01")) == [(1, "a", "N"), (1, "b", "N"), (1, "c", "Y")]


# -- surrogate keys -----------------------------------------------------------
def test_keys_are_consecutive_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("n"))
    got = keys.assign(df, None, "key", ["n"]).orderBy("key").collect()
    assert [r.key for r in got] == list(range(1, 5001))
    assert [r.n for r in got] == list(range(5000))


def test_unseen_values_are_added_once_and_nulls_ignored(spark):
    dim = spark.createDataFrame([(1, "EGGS"), (2, None)], "nr BIGINT, family STRING")
    source = spark.createDataFrame([("MEATS",), ("EGGS",), ("DAIRY",), ("MEATS",), (None,)], "family STRING")
    grown = keys.insert_unseen(dim, source, "nr", "family")
    assert rows(grown) == sorted([(1, "EGGS"), (2, None), (3, "DAIRY"), (4, "MEATS")], key=repr)
    assert rows(keys.insert_unseen(grown, source, "nr", "family")) == rows(grown)


# -- stored tables ------------------------------------------------------------
@pytest.fixture
def lake(spark):
    return Lake(spark, new_folder(spark, "lake"))


def test_commits_make_versions(spark, lake):
    lake.create("t", frame(spark, []).schema, "2024-01-01")
    with pytest.raises(ValueError):
        lake.create("t", frame(spark, []).schema, "2024-01-01")
    both = [update_all()], [insert_all()]
    assert lake.merge("t", frame(spark, [(1, "a"), (2, "b")]), ["k"], *both) == 1
    assert lake.merge("t", frame(spark, [(2, "B"), (3, "c")]), ["k"], *both) == 2
    assert rows(lake.read("t")) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(lake.read("t", 1)) == [(1, "a"), (2, "b")]
    assert rows(lake.read("t", 0)) == []
    kinds = rows(lake.changes("t", 2).select("k", "_change_type"))
    assert kinds == [(2, "update_postimage"), (2, "update_preimage"), (3, "insert")]
    assert rows(lake.history("t")) == [(1, 2, 0, 0, 0), (2, 1, 1, 1, 0)]


def test_a_repeated_batch_changes_nothing(spark, lake):
    lake.create("t", frame(spark, []).schema, "2024-01-01")
    args = (["k"], [update_all()], [insert_all()], "2024-01-02", "run#7")
    assert lake.merge("t", frame(spark, [(None, "a")]), *args) == 1
    assert lake.merge("t", frame(spark, [(None, "a")]), *args) == 1
    assert rows(lake.read("t")) == [(None, "a")]


def test_a_commit_that_died_is_invisible_and_can_run_again(spark, lake):
    lake.create("t", frame(spark, []).schema, "2024-01-01")
    lake.merge("t", frame(spark, [(1, "a")]), ["k"], [update_all()], [insert_all()])
    half_done = frame(spark, [(9, "z")]).withColumn("_change_type", F.lit("insert"))
    changes.append(half_done, f"{lake.root}/t/changes", 2, "2024-01-02")
    assert rows(lake.read("t")) == [(1, "a")]
    assert rows(lake.changes("t", 0).select("k")) == [(1,)]
    assert lake.merge("t", frame(spark, [(2, "b")]), ["k"], [update_all()], [insert_all()]) == 2
    assert rows(lake.read("t")) == [(1, "a"), (2, "b")]


def test_partitioned_merge_rewrites_only_its_partitions(spark, lake):
    ddl = "k STRING, v STRING"
    lake.create("t", frame(spark, [], ddl).schema, "2024-01-01", partition_by="substring(k, 1, 1)")
    both = [update_all()], [insert_all()]
    lake.merge("t", frame(spark, [("x1", "a"), ("y2", "b")], ddl), ["k"], *both)

    def files_of_x():
        return {r[0] for r in lake.read("t").filter("k LIKE 'x%'").select(F.input_file_name()).collect()}

    kept = files_of_x()
    lake.merge("t", frame(spark, [("y2", "B"), ("z3", "c")], ddl), ["k"], *both)
    assert rows(lake.read("t")) == [("x1", "a"), ("y2", "B"), ("z3", "c")]
    assert files_of_x() == kept
    assert rows(lake.read("t", 0)) == []
    assert rows(lake.read("t", 1)) == [("x1", "a"), ("y2", "b")]


def test_an_emptied_partition_is_gone(spark, lake):
    ddl = "k STRING, v STRING"
    both = [update_all()], [insert_all()]
    lake.create("t", frame(spark, [], ddl).schema, "2024-01-01", partition_by="substring(k, 1, 1)")
    lake.merge("t", frame(spark, [("x1", "a"), ("y2", "b"), ("", "e"), (None, "n")], ddl), ["k"], *both)
    lake.merge("t", frame(spark, [("x1", "gone")], ddl), ["k"], [delete("s.v = 'gone'")], [insert_all()])
    assert rows(lake.read("t")) == rows(frame(spark, [("y2", "b"), ("", "e"), (None, "n")], ddl))
    lake.commit("t", frame(spark, [("y2", "b", "delete")], ddl + ", _change_type STRING"), ["k"], "2024-01-03")
    assert rows(lake.read("t")) == rows(frame(spark, [("", "e"), (None, "n")], ddl))
    lake.merge("t", frame(spark, [("x1", "back")], ddl), ["k"], *both)
    assert rows(lake.read("t")) == rows(frame(spark, [("x1", "back"), ("", "e"), (None, "n")], ddl))


@pytest.mark.parametrize("step", ["_write_partitions", "_record", "_publish"])
def test_a_partitioned_commit_that_died_runs_again_whole(spark, lake, monkeypatch, step):
    """Death before the data, before the commit row, and before the log's final name."""
    ddl = "k STRING, v STRING"
    both = [update_all()], [insert_all()]
    lake.create("t", frame(spark, [], ddl).schema, "2024-01-01", partition_by="substring(k, 1, 1)")
    lake.merge("t", frame(spark, [("x1", "a")], ddl), ["k"], *both, batch="1")
    source = frame(spark, [("x1", "A"), ("y1", "b")], ddl)
    with monkeypatch.context() as m:
        plain = getattr(lake, step)

        def die(name, version, *args, **kwargs):
            if version == 2:
                raise RuntimeError("lost")
            return plain(name, version, *args, **kwargs)

        m.setattr(lake, step, die)
        with pytest.raises(RuntimeError):
            lake.merge("t", source, ["k"], *both, batch="2")
    if step != "_publish":
        assert rows(lake.read("t")) == [("x1", "a")]
        assert not [p for p in lake.spark.read.parquet(f"{lake.root}/t/changes").collect() if p.v == "b"]
    assert lake.merge("t", source, ["k"], *both, batch="2") == 2
    assert rows(lake.read("t")) == [("x1", "A"), ("y1", "b")]
    kinds = rows(lake.changes("t", 2).select("k", "_change_type"))
    assert kinds == [("x1", "update_postimage"), ("x1", "update_preimage"), ("y1", "insert")]


@pytest.mark.parametrize("partition_by", [None, "k % 2"])
def test_rows_that_share_a_key_keep_their_number(spark, lake, partition_by):
    lake.create("t", frame(spark, []).schema, "2024-01-01", partition_by=partition_by)
    both = [update_all()], [insert_all()]
    lake.merge("t", frame(spark, [(1, "a"), (1, "b")]), ["k"], *both)
    lake.merge("t", frame(spark, [(1, "b")]), ["k"], *both)
    assert rows(lake.read("t")) == [(1, "b"), (1, "b")]


def test_numbers_go_on_over_untouched_partitions(spark, lake):
    ddl = "id BIGINT, k STRING"
    lake.create("t", frame(spark, [], ddl).schema, "2024-01-01", partition_by="substring(k, 1, 1)")
    for names in (["x1", "x2"], ["y1"], ["x1", "z1"]):
        source = frame(spark, [(n,) for n in names], "k STRING")
        lake.merge("t", source, ["k"], not_matched=[insert({"k": "s.k"})], identity="id")
    assert rows(lake.read("t")) == [(1, "x1"), (2, "x2"), (3, "y1"), (4, "z1")]


def test_one_key_with_most_of_the_rows(spark):
    """Null, new and repeated keys that fill a third of the source each."""
    n = 9000
    source = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, -1).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit("s").alias("v"),
    )
    target = spark.range(0, n, 2).select(F.col("id").cast("int").alias("k"), F.lit("t").alias("v"))
    merged = merge(target, source, ["k"], [update_all()], [insert_all()])
    counts = {tuple(r)[0]: r["count"] for r in merged.filter("k IS NULL OR k = -1").groupBy("k").count().collect()}
    assert counts == {None: n // 3, -1: n // 3}
    updated = {i for i in range(n) if i % 3 == 2 and i % 2 == 0}
    assert merged.filter("v = 's' AND k >= 0").count() == n // 3
    assert merged.filter("v = 't'").count() == n // 2 - len(updated)


def test_rows_without_a_date_stay_through_merges(spark):
    lake = Lake(spark, new_folder(spark, "lake"))
    schema = spark.createDataFrame([], "id int, date date, v int").schema
    lake.create("fact", schema, "2024-01-01", partition_by="trunc(date, 'month')")
    for batch in ([(1, None, 1), (2, datetime.date(2024, 2, 3), 2)], [(3, None, 3)], [(2, datetime.date(2024, 2, 3), 5)]):
        rows_ = spark.createDataFrame(batch, schema)
        lake.merge("fact", rows_, ["id"], [update_all()], [insert_all()], as_of="2024-01-02")
    assert sorted((r.id, r.v) for r in lake.read("fact").collect()) == [(1, 1), (2, 5), (3, 3)]
