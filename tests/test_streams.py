import glob
import os
from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from millpond.operators import keys, silver
from millpond.operators.gold_store import read_months
from millpond.operators.merge import insert_all, merge, update_all
from millpond.operators.tables import Lake
from millpond.schemas import SILVER
from millpond.session import new_folder
from millpond.streaming import streams, upserts

OIL = "date DATE, dcoilwtico DOUBLE"


def write_csv(folder, name, text):
    path = f"{folder}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def landing(spark):
    folder = new_folder(spark, "landing").removeprefix("file:")
    write_csv(folder, "1/oil_a.csv", "date,dcoilwtico\n2016-01-01,10\n2016-01-02,11\n")
    write_csv(folder, "2/oil_b.csv", "date,dcoilwtico\n2016-01-02,12\n2016-01-03,\n")
    write_csv(folder, "2/oil_b_again.csv", "date,dcoilwtico\n2016-01-02,12\n2016-01-03,\n")
    write_csv(folder, "2/stores.csv", "date,dcoilwtico\n2030-01-01,1\n")
    return folder


def test_files_are_chosen_by_name_and_read_once(spark):
    folder = landing(spark)
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "ck")
    stream = streams.file_stream(spark, folder, OIL, "*oil*.csv")
    assert stream.isStreaming
    streams.append_stream(stream, out, checkpoint)
    assert streams.read_loads(spark, out).count() == 6
    write_csv(folder, "3/oil_c.csv", "date,dcoilwtico\n2016-01-04,14\n")
    streams.append_stream(stream, out, checkpoint)
    assert streams.read_loads(spark, out).count() == 7
    streams.append_stream(stream, out, checkpoint, load="again")
    assert streams.read_loads(spark, out, ["first", "again"]).count() == 14


def test_stream_equals_batch(spark):
    table, spec = "silver_dim_oil_prices", SILVER["silver_dim_oil_prices"]
    bronze, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "ck")
    lake = Lake(spark, new_folder(spark, "lake"))
    lake.create(table, spec.schema, "2024-01-01")
    matched, not_matched = silver.clauses(table)
    state = spark.createDataFrame([], spec.schema)
    days = [date(2016, 1, d) for d in range(1, 7)]
    for part in ([(days[0], 1.0), (days[1], 2.0)], [(days[1], 2.5), (days[2], None)], [(days[0], 9.0)]):
        batch = spark.createDataFrame(part, OIL)
        state = silver.upsert(table, state, silver.prepare(table, batch))
        batch.write.mode("append").parquet(bronze)
        streams.upsert_stream(
            streams.table_stream(spark, bronze, OIL), lake, table, spec.keys, matched, not_matched, checkpoint,
            "2024-01-01", prepare=lambda b: silver.prepare(table, b), identity=spec.identity,
        )
    assert rows(lake.read(table)) == rows(state)
    assert lake.latest(table) == 3


def test_a_replayed_batch_is_skipped(spark):
    bronze, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "ck")
    spark.createDataFrame([(None, 1.0)], OIL).write.parquet(bronze)
    lake = Lake(spark, new_folder(spark, "lake"))
    lake.create("oil", spark.createDataFrame([], OIL).schema, "2024-01-01")

    def run():
        streams.upsert_stream(
            streams.table_stream(spark, bronze, OIL), lake, "oil", ["date"], [update_all()], [insert_all()],
            checkpoint, "2024-01-01",
        )

    run()
    for marker in glob.glob(f"{checkpoint.removeprefix('file:')}/commits/*") + glob.glob(f"{checkpoint.removeprefix('file:')}/commits/.*crc"):
        os.remove(marker)
    run()
    assert lake.latest("oil") == 1 and lake.read("oil").count() == 1


def test_change_stream_carries_every_commit(spark):
    lake = Lake(spark, new_folder(spark, "lake"))
    lake.create("oil", spark.createDataFrame([], OIL).schema, "2024-01-01")
    both = ["date"], [update_all()], [insert_all()]
    out, checkpoint = new_folder(spark, "feed"), new_folder(spark, "ck")
    for price in (1.0, 2.0):
        lake.merge("oil", spark.createDataFrame([(date(2016, 1, 1), price)], OIL), *both)
        streams.append_stream(streams.changes_stream(lake, "oil"), out, checkpoint)
    feed = streams.read_loads(spark, out).select("dcoilwtico", "_change_type", "_commit_version")
    assert rows(feed) == [(1.0, "insert", 1), (1.0, "update_preimage", 2), (2.0, "update_postimage", 2)]


def test_late_rows_are_upserts(spark):
    target = spark.createDataFrame([(date(2016, 1, 5), 5.0)], OIL)
    late = spark.createDataFrame([(date(2016, 1, 1), 1.0), (date(2016, 1, 5), 5.5)], OIL)
    assert [r[1] for r in rows(merge(target, late, ["date"], [update_all()], [insert_all()]))] == [1.0, 5.5]


def forget_commits(checkpoint):
    for marker in glob.glob(f"{checkpoint}/commits/*") + glob.glob(f"{checkpoint}/commits/.*crc"):
        os.remove(marker)


def test_a_running_query_takes_new_files_and_goes_on_after_a_restart(spark):
    folder = landing(spark)
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "ck")

    def start(every=None):
        return streams.append_stream(streams.file_stream(spark, folder, OIL, "*oil*.csv"), out, checkpoint, drain=False, every=every)

    running = start()
    running.processAllAvailable()
    assert running.isActive and streams.read_loads(spark, out).count() == 6
    write_csv(folder, "3/oil_c.csv", "date,dcoilwtico\n2016-01-04,14\n")
    running.processAllAvailable()
    assert streams.read_loads(spark, out).count() == 7
    running.stop()
    write_csv(folder, "4/oil_d.csv", "date,dcoilwtico\n2016-01-05,15\n")
    again = start("100 milliseconds")
    again.processAllAvailable()
    again.stop()
    assert streams.read_loads(spark, out).count() == 8


VISITS = "date DATE, store_nbr INT, transactions INT"


def visits(spark, folder, *data):
    spark.createDataFrame(data, VISITS).coalesce(1).write.mode("append").parquet(folder)


def merge_visits(spark, source, folder, checkpoint):
    table, spec = "silver_dim_transactions", SILVER["silver_dim_transactions"]
    upserts.upsert_months(
        streams.table_stream(spark, source, VISITS), folder, spec.schema, spec.keys, *silver.clauses(table), checkpoint, identity="id"
    )


def test_months_are_merged_in_place_and_numbers_go_on(spark):
    source, folder, checkpoint = (new_folder(spark, n) for n in ("bronze", "fact", "ck"))
    jan, feb = date(2016, 1, 5), date(2016, 2, 5)
    visits(spark, source, (jan, 1, 10), (feb, 1, 20))
    merge_visits(spark, source, folder, checkpoint)
    before = set(glob.glob(f"{folder}/month=2016-01-01/*.parquet"))
    visits(spark, source, (feb, 1, 21), (feb, 2, 30))
    merge_visits(spark, source, folder, checkpoint)
    got = rows(read_months(spark, folder).select("id", "date", "store_nbr", "transactions"))
    assert got == [(1, jan, 1, 10), (2, feb, 1, 21), (3, feb, 2, 30)]
    assert set(glob.glob(f"{folder}/month=2016-01-01/*.parquet")) == before  # not in the batch, not touched
    forget_commits(checkpoint)
    merge_visits(spark, source, folder, checkpoint)
    assert rows(read_months(spark, folder).select("id", "date", "store_nbr", "transactions")) == got


def test_a_batch_that_died_before_its_mark_gives_no_number_twice(spark):
    source, folder, checkpoint = (new_folder(spark, n) for n in ("bronze", "fact", "ck"))
    visits(spark, source, (date(2016, 1, 5), 1, 10), (date(2016, 1, 6), 1, 20))
    merge_visits(spark, source, folder, checkpoint)
    os.rename(f"{folder}-marks", f"{folder}-lost")
    visits(spark, source, (date(2016, 1, 7), 1, 30))
    merge_visits(spark, source, folder, checkpoint)
    assert sorted(r.id for r in read_months(spark, folder).collect()) == [1, 2, 3]


def test_a_row_without_a_date_stops_the_merge_by_month(spark):
    source, folder, checkpoint = (new_folder(spark, n) for n in ("bronze", "fact", "ck"))
    visits(spark, source, (None, 1, 10))
    with pytest.raises(Exception, match="without a date"):
        merge_visits(spark, source, folder, checkpoint)


def test_a_replayed_batch_writes_the_same_state(spark):
    source, folder, checkpoint = (new_folder(spark, n) for n in ("bronze", "state", "ck"))
    schema = spark.createDataFrame([], OIL).schema

    def run():
        upserts.upsert_state(streams.table_stream(spark, source, OIL), folder, schema, ["date"], [update_all()], [insert_all()], checkpoint)

    assert upserts.read_state(spark, folder, schema).count() == 0
    for price in (1.0, 2.0):
        spark.createDataFrame([(date(2016, 1, 1), price), (None, price)], OIL).write.mode("append").parquet(source)
        run()
    got = rows(upserts.read_state(spark, folder, schema))
    assert sorted(r[1] for r in got) == [1.0, 2.0, 2.0]  # a null date matches nothing, so both came in
    forget_commits(checkpoint)
    run()
    assert rows(upserts.read_state(spark, folder, schema)) == got


def test_a_kept_mark_needs_no_scan_of_the_table(spark):
    table = spark.createDataFrame([(7, "x")], "id LONG, v STRING")
    fresh = spark.createDataFrame([("a",), ("b",)], "v STRING")
    kept = keys.assign(fresh, table, "id", ["v"], after=40)
    assert rows(kept) == [(41, "a"), (42, "b")] and "Subquery" not in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(keys.assign(fresh, table, "id", ["v"])) == [(8, "a"), (9, "b")]
    merged = merge(table, fresh, ["v"], [], [insert_all()], identity="id", identity_after=40)
    assert sorted(r.id for r in merged.select(F.col("id")).collect()) == [7, 41, 42]


def test_new_rows_leave_the_files_of_their_month_in_place(spark):
    source, folder, checkpoint = (new_folder(spark, n) for n in ("bronze", "fact", "ck"))
    visits(spark, source, (date(2016, 1, 5), 1, 10), (date(2016, 2, 5), 1, 20))
    merge_visits(spark, source, folder, checkpoint)
    before = set(glob.glob(f"{folder}/month=*/*.parquet"))
    visits(spark, source, (date(2016, 1, 5), 2, 30), (date(2016, 1, 6), 1, 40), (date(2016, 2, 5), 1, 21), (date(2016, 3, 1), 1, 50))
    merge_visits(spark, source, folder, checkpoint)
    kept = before & set(glob.glob(f"{folder}/month=*/*.parquet"))
    assert [f.split("/")[-2] for f in kept] == ["month=2016-01-01"]  # a key of February was stored, none of January's
    got = rows(read_months(spark, folder).select("id", "store_nbr", "transactions"))
    assert got == [(1, 1, 10), (2, 1, 21), (3, 2, 30), (4, 1, 40), (5, 1, 50)]
    forget_commits(checkpoint)
    merge_visits(spark, source, folder, checkpoint)
    assert rows(read_months(spark, folder).select("id", "store_nbr", "transactions")) == got


def test_a_backlog_of_many_files_is_taken_in_few_batches(spark):
    source, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "ck")
    spark.range(11).repartition(11, "id").write.option("maxRecordsPerFile", 1).parquet(source)
    sizes = []
    stream = streams.table_stream(spark, source, files_per_batch=2, most_batches=3)
    query = stream.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) <= 3 and sum(sizes) == 11
