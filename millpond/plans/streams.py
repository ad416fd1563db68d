"""Streams drained to the end; each must leave the same rows as one batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators import changes, silver
from millpond.operators.merge import insert_all, update_all
from millpond.operators.gold_store import read_months
from millpond.operators.tables import Lake, create_database
from millpond.plans.aggregates import as_double
from millpond.plans.registry import query, sql
from millpond.schemas import BRONZE, SILVER
from millpond.session import new_folder
from millpond.sources import files, retail
from millpond.streaming import streams, upserts


def _landing(spark, df, label):
    """CSV files in one subfolder per year, as daily feeds arrive."""
    folder = new_folder(spark, label)
    df.withColumn("yr", F.year("date")).repartition("yr").write.partitionBy("yr").option("header", True).csv(folder)
    return folder


def _oil_stream(spark, d, files_per_batch=2):
    folder = _landing(spark, retail.oil(spark, d), "landing-oil")
    return streams.file_stream(spark, folder, BRONZE["bronze_oil_prices"].schema, "*.csv", files_per_batch)


@query("t1_file_stream_append", sql("SELECT * FROM fx_oil", "oil"))
def t1(spark, d):
    out, checkpoint = new_folder(spark, "bronze-oil"), new_folder(spark, "ck")
    streams.append_stream(_oil_stream(spark, d), out, checkpoint)
    return streams.read_loads(spark, out)


@query("s5_file_stream_inferred_schema", sql("SELECT * FROM fx_transactions", "transactions"))
def s5(spark, d):
    """The stream takes the schema a batch probe found."""
    folder = _landing(spark, retail.transactions(spark, d), "landing-visits")
    schema = files.infer_schema(spark, folder, "*.csv", recursive=True)
    out, checkpoint = new_folder(spark, "bronze-visits"), new_folder(spark, "ck")
    streams.append_stream(streams.file_stream(spark, folder, schema), out, checkpoint)
    return streams.read_loads(spark, out)


@query("k6_drain_twice", sql("SELECT * FROM fx_oil", "oil"))
def k6(spark, d):
    """A second run over the same checkpoint finds nothing new."""
    out, checkpoint = new_folder(spark, "bronze-oil"), new_folder(spark, "ck")
    stream = _oil_stream(spark, d)
    streams.append_stream(stream, out, checkpoint)
    streams.append_stream(stream, out, checkpoint)
    return streams.read_loads(spark, out)


@query("k7_stream_to_table", sql("SELECT * FROM fx_oil", "oil"))
def k7(spark, d):
    folder, checkpoint = new_folder(spark, "db"), new_folder(spark, "ck")
    db = "db_" + folder.rsplit("-", 1)[1]
    create_database(spark, db, folder)
    streams.append_stream(_oil_stream(spark, d), None, checkpoint, table=f"{db}.bronze_oil_prices")
    return spark.table(f"{db}.bronze_oil_prices")


@query("k8_replay", sql("SELECT * FROM fx_oil UNION ALL SELECT * FROM fx_oil", "oil"))
def k8(spark, d):
    """A second load with its own checkpoint brings every file once more."""
    out, checkpoint = new_folder(spark, "bronze-oil"), new_folder(spark, "ck")
    stream = _oil_stream(spark, d)
    streams.append_stream(stream, out, checkpoint, load="first")
    streams.append_stream(stream, out, checkpoint, load="second")
    return streams.read_loads(spark, out, ["first", "second"])


@query("s8_table_stream", sql("SELECT * FROM fx_stores", "stores"))
def s8(spark, d):
    bronze, out, checkpoint = (new_folder(spark, n) for n in ("bronze-stores", "copy", "ck"))
    retail.stores(spark, d).write.parquet(bronze)
    streams.append_stream(streams.table_stream(spark, bronze), out, checkpoint)
    return streams.read_loads(spark, out)


def _upserted(spark, table, bronze, as_of="2024-01-01"):
    """Bronze rows in several files, merged batch by batch into a silver table."""
    spec = SILVER[table]
    folder, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "ck")
    bronze.write.parquet(folder)
    lake = Lake(spark, new_folder(spark, "lake"))
    silver.create_lake(lake, table, as_of)
    matched, not_matched = silver.clauses(table)
    streams.upsert_stream(
        streams.table_stream(spark, folder, files_per_batch=2),
        lake,
        table,
        spec.keys,
        matched,
        not_matched,
        checkpoint,
        as_of,
        prepare=lambda batch: silver.prepare(table, batch),
        identity=spec.identity,
    )
    return lake


@query("t2_upsert_oil_prices", sql("SELECT date, dcoilwtico AS oil_price FROM fx_oil", "oil"))
def t2_oil(spark, d):
    lake = _upserted(spark, "silver_dim_oil_prices", retail.oil(spark, d).repartition(4, "date"))
    return as_double(lake.read("silver_dim_oil_prices").drop("id"), "oil_price")


@query("t2_upsert_stores", sql("SELECT * FROM fx_stores", "stores"))
def t2_stores(spark, d):
    lake = _upserted(spark, "silver_dim_store", retail.stores(spark, d).repartition(4, "store_nbr"))
    return lake.read("silver_dim_store").drop("id")


@query("t2_upsert_transactions", sql("SELECT * FROM fx_transactions", "transactions"))
def t2_transactions(spark, d):
    rows = retail.transactions(spark, d).repartition(4, "store_nbr")
    return _upserted(spark, "silver_dim_transactions", rows).read("silver_dim_transactions").drop("id")


@query("t2_upsert_fact_train", sql("SELECT * FROM fx_train", "train"))
def t2_train(spark, d):
    rows = retail.train(spark, d).repartition(4, "store_nbr")
    return as_double(_upserted(spark, "silver_fact_train", rows).read("silver_fact_train"), "sales")


@query("t3_dedup_in_batch", sql("SELECT DISTINCT * FROM fx_holidays_events", "holidays_events"))
def t3(spark, d):
    """Every row arrives three times; a batch drops its repeats, the merge those across batches."""
    rows = retail.holidays(spark, d)
    repeated = rows.unionByName(rows).unionByName(rows).repartition(4)
    return _upserted(spark, "silver_dim_holidays_events", repeated).read("silver_dim_holidays_events").drop("id")


@query(
    "t6_late_rows",
    sql(
        """SELECT COALESCE(b.date, a.date) AS date, CASE WHEN b.date IS NOT NULL THEN b.dcoilwtico + 1 ELSE a.dcoilwtico END AS dcoilwtico
        FROM fx_oil a LEFT JOIN (SELECT * FROM fx_oil WHERE DAY(date) < 8) b ON a.date = b.date""",
        "oil",
    ),
)
def t6(spark, d):
    """Late corrections land in a second drain: the last write of a date wins."""
    oil = retail.oil(spark, d)
    folder, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "ck")
    lake = Lake(spark, new_folder(spark, "lake"))
    lake.create("oil", oil.schema, "2024-01-01")
    late = oil.filter(F.dayofmonth("date") < 8).withColumn("dcoilwtico", F.col("dcoilwtico") + 1)
    for batch in (oil, late):
        batch.write.mode("append").parquet(folder)
        stream = streams.table_stream(spark, folder, BRONZE["bronze_oil_prices"].schema)
        streams.upsert_stream(
            stream, lake, "oil", ["date"], [update_all()], [insert_all()], checkpoint, "2024-01-01"
        )
    return lake.read("oil")


@query(
    "s9_change_stream",
    sql(
        """SELECT _change_type, COUNT(*) AS n FROM (SELECT 'insert' AS _change_type FROM fx_stores_v1 UNION ALL
        SELECT CASE WHEN a.store_nbr IS NULL THEN 'insert' WHEN b.store_nbr IS NULL THEN 'delete' ELSE 'update_preimage' END
        FROM fx_stores_v1 a FULL JOIN fx_stores_v2 b ON a.store_nbr = b.store_nbr WHERE a.type IS DISTINCT FROM b.type
        UNION ALL SELECT 'update_postimage' FROM fx_stores_v1 a JOIN fx_stores_v2 b ON a.store_nbr = b.store_nbr
        WHERE a.type <> b.type) x GROUP BY 1""",
        "stores_v1",
        "stores_v2",
    ),
)
def s9(spark, d):
    """The change log of a table read as a stream, one commit after the other."""
    old, new = retail.stores_v1(spark, d), retail.stores_v2(spark, d)
    lake = Lake(spark, new_folder(spark, "lake"))
    lake.create("stores", old.schema, "2024-01-01")
    lake.commit("stores", old.withColumn("_change_type", F.lit("insert")), ["store_nbr"], "2024-01-01")
    out, checkpoint = new_folder(spark, "feed"), new_folder(spark, "ck")
    streams.append_stream(streams.changes_stream(lake, "stores"), out, checkpoint)
    lake.commit("stores", changes.diff(old, new, ["store_nbr"]), ["store_nbr"], "2024-01-02")
    streams.append_stream(streams.changes_stream(lake, "stores"), out, checkpoint)
    return streams.read_loads(spark, out).groupBy("_change_type").agg(F.count("*").alias("n"))


# -- queries that keep running, and upserts into plain Parquet ------------------
@query("k5_running_stream", sql("SELECT * FROM fx_oil", "oil"))
def k5(spark, d):
    """A query that keeps running: files that come meanwhile are taken, and a restart goes on where it stopped."""
    oil = retail.oil(spark, d)
    folder, out, checkpoint = (new_folder(spark, n) for n in ("landing-oil", "bronze-oil", "ck"))
    parts = ["YEAR(date) < 1997", "YEAR(date) BETWEEN 1997 AND 1998", "YEAR(date) > 1998 OR date IS NULL"]

    def land(part):
        oil.filter(parts[part]).write.mode("append").option("header", True).csv(folder)

    def run(*steps):
        stream = streams.file_stream(spark, folder, BRONZE["bronze_oil_prices"].schema)
        running = streams.append_stream(stream, out, checkpoint, drain=False)
        try:
            for step in steps:
                step()
                running.processAllAvailable()
        finally:
            running.stop()

    land(0)
    run(lambda: None, lambda: land(1))
    run(lambda: None, lambda: land(2))
    return streams.read_loads(spark, out)


#: Batches in which a backlog of many files is merged; each meets what the ones before it have stored.
BATCHES = 8


def _merged(spark, table, bronze, by_month=False):
    """Bronze rows in several files, merged batch by batch; the table's folder."""
    spec, (matched, not_matched) = SILVER[table], silver.clauses(table)
    source, folder, checkpoint = (new_folder(spark, n) for n in ("bronze", table, "ck"))
    bronze.write.option("maxRecordsPerFile", 20_000).parquet(source)
    upsert = upserts.upsert_months if by_month else upserts.upsert_state
    upsert(
        streams.table_stream(spark, source, files_per_batch=2, most_batches=BATCHES), folder, spec.schema, spec.keys,
        matched, not_matched, checkpoint, prepare=lambda batch: silver.prepare(table, batch), identity=spec.identity,
    )
    return folder


def _with_ids(df, key):
    """Every row with how many different numbers the table has, and the largest."""
    ids = df.select(F.count_distinct(key)).scalar(), df.select(F.max(key)).scalar()
    return df.drop(key).withColumns({"ids": ids[0], "largest": ids[1]})


@query(
    "t2_state_oil_prices",
    sql("SELECT date, dcoilwtico AS oil_price, (SELECT COUNT(*) FROM fx_oil) AS ids, (SELECT COUNT(*) FROM fx_oil) AS largest FROM fx_oil", "oil"),
)
def t2_state_oil(spark, d):
    folder = _merged(spark, "silver_dim_oil_prices", retail.oil(spark, d))
    state = upserts.read_state(spark, folder, SILVER["silver_dim_oil_prices"].schema)
    return as_double(_with_ids(state, "id"), "oil_price")


@query("t2_months_fact_train", sql("SELECT * FROM fx_train", "train"))
def t2_months_train(spark, d):
    folder = _merged(spark, "silver_fact_train", retail.train(spark, d), by_month=True)
    return as_double(read_months(spark, folder), "sales")


@query(
    "t2_months_transactions",
    sql("SELECT *, (SELECT COUNT(*) FROM fx_transactions) AS ids, (SELECT COUNT(*) FROM fx_transactions) AS largest FROM fx_transactions", "transactions"),
)
def t2_months_transactions(spark, d):
    """Numbers stay consecutive over batches that never scan the fact for the largest one."""
    folder = _merged(spark, "silver_dim_transactions", retail.transactions(spark, d), by_month=True)
    return _with_ids(read_months(spark, folder), "id")


@query("t3_state_dedup", sql("SELECT DISTINCT * FROM fx_holidays_events", "holidays_events"))
def t3_state(spark, d):
    """Every row arrives three times; a batch drops its repeats, the merge those across batches."""
    rows = retail.holidays(spark, d)
    folder = _merged(spark, "silver_dim_holidays_events", rows.unionByName(rows).unionByName(rows))
    return upserts.read_state(spark, folder, SILVER["silver_dim_holidays_events"].schema).drop("id")


@query(
    "t6_daily_oil_feed",
    sql(
        """SELECT COALESCE(b.date, a.date) AS date, CASE WHEN b.date IS NOT NULL THEN b.dcoilwtico + 1 ELSE a.dcoilwtico END AS dcoilwtico
        FROM fx_oil a LEFT JOIN (SELECT * FROM fx_oil WHERE DAY(date) < 8) b ON a.date = b.date""",
        "oil",
    ),
)
def t6_daily(spark, d):
    """The daily feed as one job: new files go to bronze, new bronze rows into the price table; late corrections win."""
    oil, schema = retail.oil(spark, d), BRONZE["bronze_oil_prices"].schema
    landing, bronze, state = (new_folder(spark, n) for n in ("landing-oil", "bronze-oil", "oil-prices"))
    late = oil.filter(F.dayofmonth("date") < 8).withColumn("dcoilwtico", F.col("dcoilwtico") + 1)
    for feed in (oil, late):
        feed.write.mode("append").option("header", True).csv(landing)
        streams.append_stream(streams.file_stream(spark, landing, schema), bronze, f"{bronze}-ck")
        new = streams.table_stream(spark, f"{bronze}/first", schema)
        upserts.upsert_state(new, state, schema, ["date"], [update_all()], [insert_all()], f"{state}-ck")
    return upserts.read_state(spark, state, schema)
