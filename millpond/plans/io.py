"""Sources, sinks and catalog jobs: written, read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millpond.operators import tables
from millpond.operators.merge import delete, insert_all, update_all
from millpond.plans.aggregates import as_double
from millpond.plans.registry import query, sql
from millpond.schemas import BRONZE, HOLIDAY
from millpond.session import new_folder
from millpond.sources import files, retail
from millpond.sources.synthetic import DAYS, FAMILIES, MAX_SALES, PROMOTED_PERCENT, SALES_STEP, STORES, synthetic_sales

ALL_OIL = sql("SELECT * FROM fx_oil", "oil")


def _csv(spark, df, label):
    path = new_folder(spark, label)
    files.write_csv(df, path)
    return path


def _database(spark):
    name = f"run_{uuid.uuid4().hex[:10]}"
    tables.create_database(spark, name, new_folder(spark, name))
    return name


# -- file sources -------------------------------------------------------------
@query("s1_csv_inferred", ALL_OIL)
def s1(spark, d):
    return files.read_csv(spark, _csv(spark, retail.oil(spark, d), "oil-csv"))


@query(
    "s2_csv_text",
    sql("SELECT CAST(date AS VARCHAR) AS date, store_nbr, transactions FROM fx_transactions", "transactions"),
)
def s2(spark, d):
    """All columns arrive as text and are cast by hand."""
    text = files.read_csv(spark, _csv(spark, retail.transactions(spark, d), "visits-csv"), schema="string")
    return text.select("date", F.col("store_nbr").cast("int"), F.col("transactions").cast("int"))


@query("s3_csv_explicit_schema", sql("SELECT * FROM fx_holidays_events", "holidays_events"))
def s3(spark, d):
    path = _csv(spark, retail.holidays(spark, d).repartition(4), "holidays-csv")
    return files.read_csv(spark, path, BRONZE["bronze_holidays_events"].schema)


@query(
    "s4_schema_probe",
    sql("SELECT * FROM fx_stores", "stores"),
)
def s4(spark, d):
    """The types are inferred once and handed to a second read."""
    path = _csv(spark, retail.stores(spark, d), "stores-csv")
    return files.read_csv(spark, path, files.infer_schema(spark, path))


@query(
    "s6_json",
    "SELECT event_id, CAST(JSON_EXTRACT(props, '$.k') AS BIGINT) AS k FROM events",
)
def s6(spark, d):
    events = retail.table(spark, d, "events")
    path = new_folder(spark, "events-json")
    events.select(F.to_json(F.struct("event_id", F.from_json("props", "k BIGINT").alias("props")))).write.text(path)
    return spark.read.json(path).select("event_id", "props.k")


@query("s7_catalog_table", ALL_OIL)
def s7(spark, d):
    db = _database(spark)
    tables.write(retail.oil(spark, d), f"{db}.bronze_oil_prices")
    return spark.table(f"{db}.bronze_oil_prices")


@query(
    "s10_load_all",
    sql(
        """SELECT 'oil' AS name, COUNT(*) AS n FROM fx_oil UNION ALL SELECT 'stores', COUNT(*) FROM fx_stores
        UNION ALL SELECT 'transactions', COUNT(*) FROM fx_transactions""",
        "oil",
        "stores",
        "transactions",
    ),
)
def s10(spark, d):
    makers = {"oil": retail.oil, "stores": retail.stores, "transactions": retail.transactions}
    paths = {name: _csv(spark, make(spark, d), name) for name, make in makers.items()}
    prefix = f"landing_{uuid.uuid4().hex[:8]}_"
    files.load_all(spark, paths, prefix)
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{n}' AS name, COUNT(*) AS n FROM {prefix}{n}" for n in makers)
    )


def _draw(name: str, size: int) -> str:
    return f"CAST('0x' || SUBSTRING(MD5('7:{name}:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % {size}"


@query(
    "s12_synthetic_sales",
    f"""SELECT o_orderkey AS id, DATE '2024-01-01' + CAST({_draw("date", DAYS)} AS INT) AS date,
    CAST({_draw("store", STORES)} + 1 AS INT) AS store_nbr,
    LIST_EXTRACT([{", ".join(f"'{f}'" for f in FAMILIES)}], {_draw("family", len(FAMILIES))} + 1) AS family,
    CAST(({_draw("sales", int(MAX_SALES / SALES_STEP) + 1)}) * {SALES_STEP} AS DOUBLE) AS sales,
    CAST({_draw("promo", 100)} < {PROMOTED_PERCENT} AS INT) AS onpromotion FROM orders""",
)
def s12(spark, d):
    """One synthetic sale per order, drawn from the order's number."""
    return synthetic_sales(retail.table(spark, d, "orders"), "o_orderkey", 7, "2024-01-01")


# -- sinks --------------------------------------------------------------------
@query("k1_write_new", sql("SELECT * FROM fx_stores", "stores"))
def k1(spark, d):
    name = f"{_database(spark)}.bronze_stores"
    tables.write(retail.stores(spark, d), name)
    return spark.table(name)


@query(
    "k2_append",
    sql("SELECT * FROM fx_oil UNION ALL SELECT * FROM fx_oil WHERE dcoilwtico IS NULL", "oil"),
)
def k2(spark, d):
    oil = retail.oil(spark, d)
    name = f"{_database(spark)}.bronze_oil_prices"
    tables.write(oil, name)
    tables.write(oil.filter("dcoilwtico IS NULL"), name, "append")
    return spark.table(name)


@query("k3_overwrite", sql("SELECT * FROM fx_stores_v2", "stores_v2"))
def k3(spark, d):
    name = f"{_database(spark)}.silver_dim_store"
    tables.write(retail.stores_v1(spark, d), name)
    tables.write(retail.stores_v2(spark, d), name, "overwrite")
    return spark.table(name)


@query(
    "k4_schema_evolution",
    sql(
        """SELECT date, dcoilwtico, NULL AS source FROM fx_oil WHERE YEAR(date) < 1998 UNION ALL
        SELECT date, dcoilwtico, 'daily' FROM fx_oil WHERE YEAR(date) >= 1998""",
        "oil",
    ),
)
def k4(spark, d):
    oil = retail.oil(spark, d)
    name = f"{_database(spark)}.bronze_oil_prices"
    tables.write(oil.filter(F.year("date") < 1998), name)
    tables.append(oil.filter(F.year("date") >= 1998).withColumn("source", F.lit("daily")), name, merge_schema=True)
    return spark.table(name)


@query(
    "k9_typed_tables",
    sql("SELECT * FROM fx_holidays_events", "holidays_events"),
)
def k9(spark, d):
    """Created with declared types, replaced once, then filled."""
    name = f"{_database(spark)}.silver_dim_holidays_events"
    ddl = "date DATE, type VARCHAR(20), locale VARCHAR(10), locale_name VARCHAR(50), description VARCHAR(100), transferred BOOLEAN"
    tables.create(spark, name, HOLIDAY)
    tables.create(spark, name, ddl, replace=True)
    tables.append(retail.holidays(spark, d), name)
    return spark.table(name)


@query(
    "k10_create_as_select",
    sql(
        "SELECT * FROM fx_holidays_events WHERE locale <> 'National' AND NOT transferred",
        "holidays_events",
    ),
)
def k10(spark, d):
    name = f"{_database(spark)}.silver_dim_regional_holiday"
    rows = retail.holidays(spark, d)
    spark.sql(
        f"CREATE TABLE {name} USING parquet AS SELECT * FROM {{rows}} WHERE locale != 'National' AND NOT transferred",
        rows=rows,
    )
    return spark.table(name)


@query(
    "k11_insert_select_casts",
    sql(
        "SELECT id, date, store_nbr, family, CAST(TRUNC(sales) AS INT) AS sales, onpromotion FROM fx_train",
        "train",
    ),
)
def k11(spark, d):
    """Doubles stored in an INT column lose their cents."""
    name = f"{_database(spark)}.silver_fact_train"
    tables.create(spark, name, "id BIGINT, date DATE, store_nbr INT, family VARCHAR(100), sales INT, onpromotion INT")
    tables.append(retail.train(spark, d), name)
    return spark.table(name)


@query(
    "k12_insert_values",
    sql(
        """SELECT store_nbr, city, state, type, cluster FROM fx_stores UNION ALL
        SELECT 0, 'Testville', 'NOWHERE', 'A', 1""",
        "stores",
    ),
)
def k12(spark, d):
    name = f"{_database(spark)}.bronze_stores"
    tables.write(retail.stores(spark, d), name)
    spark.sql(f"INSERT INTO {name} VALUES (0, 'Testville', 'NOWHERE', 'A', 1)")
    return spark.table(name)


@query(
    "k13_partitioned_table",
    sql("SELECT * FROM fx_holidays_events WHERE locale = 'Regional'", "holidays_events"),
)
def k13(spark, d):
    """Partitioned by locale; the filter reads one partition."""
    name = f"{_database(spark)}.silver_holiday_events"
    tables.write(retail.holidays(spark, d), name, partition_by=["locale"])
    return spark.table(name).filter(F.col("locale") == "Regional")


@query(
    "k14_column_default",
    sql("SELECT store_nbr, 'new' AS status, TRUE AS stamped FROM fx_stores", "stores"),
)
def k14(spark, d):
    name = f"{_database(spark)}.load_log"
    tables.create(spark, name, "store_nbr INT, status STRING DEFAULT 'new', at TIMESTAMP DEFAULT CURRENT_TIMESTAMP()")
    rows = retail.stores(spark, d).select("store_nbr")
    spark.sql(f"INSERT INTO {name} (store_nbr) SELECT store_nbr FROM {{rows}}", rows=rows)
    return spark.table(name).select("store_nbr", "status", F.col("at").isNotNull().alias("stamped"))


@query(
    "k15_clone_all",
    sql(
        """SELECT 'oil' AS name, COUNT(*) AS n, CAST(SUM(CAST(dcoilwtico AS DECIMAL(14,2))) AS DOUBLE) AS total FROM fx_oil
        UNION ALL SELECT 'transactions', COUNT(*), CAST(SUM(transactions) AS DOUBLE) FROM fx_transactions""",
        "oil",
        "transactions",
    ),
)
def k15(spark, d):
    source, target = _database(spark), _database(spark)
    tables.write(retail.oil(spark, d), f"{source}.oil")
    tables.write(retail.transactions(spark, d), f"{source}.transactions")
    tables.clone_all(spark, source, target)
    oil = spark.table(f"{target}.oil").agg(
        F.lit("oil").alias("name"),
        F.count("*").alias("n"),
        F.sum(F.col("dcoilwtico").cast("decimal(14,2)")).cast("double").alias("total"),
    )
    visits = spark.table(f"{target}.transactions").agg(
        F.lit("transactions").alias("name"),
        F.count("*").alias("n"),
        F.sum("transactions").cast("double").alias("total"),
    )
    return oil.unionByName(visits)


@query(
    "k15_clone_types",
    sql(
        """SELECT store_nbr, city, 'old' AS status, type FROM fx_stores
        UNION ALL SELECT store_nbr, city, 'new', type FROM fx_stores""",
        "stores",
    ),
)
def k15_types(spark, d):
    """A clone keeps rows, layout, lengths and defaults: rows added to it later take the default of its source."""
    source, target = _database(spark), _database(spark)
    columns = "store_nbr INT, city VARCHAR(30), status VARCHAR(3) DEFAULT 'new', type STRING"
    tables.create(spark, f"{source}.load_log", columns, partition_by=["type"])
    rows = retail.stores(spark, d).select("store_nbr", "city", "type")
    spark.sql(f"INSERT INTO {source}.load_log SELECT store_nbr, city, 'old', type FROM {{rows}}", rows=rows)
    tables.clone_all(spark, source, target)
    spark.sql(f"INSERT INTO {target}.load_log (store_nbr, city, type) SELECT * FROM {{rows}}", rows=rows)
    return spark.table(f"{target}.load_log")


@query("k16_csv_export", sql("SELECT * FROM fx_train", "train"))
def k16(spark, d):
    path = _csv(spark, retail.train(spark, d), "train-csv")
    return files.read_csv(spark, path, BRONZE["bronze_train"].schema)


@query(
    "k17_list_tables",
    sql(
        """SELECT 'bronze_oil_prices' AS name, COUNT(*) AS n FROM fx_oil
        UNION ALL SELECT 'bronze_stores', COUNT(*) FROM fx_stores""",
        "oil",
        "stores",
    ),
)
def k17(spark, d):
    """Tables of a database by name pattern, each counted."""
    db = _database(spark)
    tables.write(retail.oil(spark, d), f"{db}.bronze_oil_prices")
    tables.write(retail.stores(spark, d), f"{db}.bronze_stores")
    tables.write(retail.stores(spark, d), f"{db}.silver_dim_store")
    names = sorted(t.name for t in spark.catalog.listTables(db, "bronze_*"))
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS name, COUNT(*) AS n FROM {db}.{n}" for n in names))


@query(
    "k13_partition_upsert",
    sql(
        """SELECT COALESCE(b.id, a.id) AS id, COALESCE(b.date, a.date) AS date, COALESCE(b.store_nbr, a.store_nbr) AS store_nbr,
        COALESCE(b.family, a.family) AS family, COALESCE(b.sales, a.sales) AS sales FROM
        fx_train_v1 a FULL JOIN (SELECT * FROM fx_train_v2 WHERE YEAR(date) = 1997) b ON a.id = b.id""",
        "train_v1",
        "train_v2",
    ),
)
def k13_upsert(spark, d):
    """A fact table by month: the merge reads and rewrites only the months of its source."""
    def amounts(rows):
        return rows.select("id", "date", "store_nbr", "family", F.col("sales").cast("decimal(14,2)").alias("sales"))

    before = amounts(retail.train_v1(spark, d))
    after = amounts(retail.train_v2(spark, d).filter(F.year("date") == 1997))
    lake = tables.Lake(spark, new_folder(spark, "facts"))
    keys = ["date", "store_nbr", "family"]
    lake.create("sales", before.schema, "2024-01-01", partition_by="trunc(date, 'month')")
    lake.commit("sales", before.withColumn("_change_type", F.lit("insert")), keys, "2024-01-01")
    lake.merge("sales", after, keys, [update_all()], [insert_all()], "2024-01-02", staged=True)
    return as_double(lake.read("sales"), "sales")


@query(
    "k13_partition_delete",
    sql(
        """SELECT a.id, a.date, a.store_nbr, a.family, a.sales FROM fx_train_v1 a
        WHERE DATE_TRUNC('month', a.date) <> DATE '1997-03-01' AND NOT (YEAR(a.date) = 1997 AND EXISTS (
        SELECT 1 FROM fx_train_v2 b WHERE b.id = a.id AND b.onpromotion = 1 AND MONTH(b.date) > 6))""",
        "train_v1",
        "train_v2",
    ),
)
def k13_delete(spark, d):
    """DELETE through a merge on a fact table by month; one month is emptied and must be gone."""
    before = retail.train_v1(spark, d).select(
        "id", "date", "store_nbr", "family", F.col("sales").cast("decimal(14,2)").alias("sales")
    )
    newer = retail.train_v2(spark, d).filter("year(date) = 1997 AND onpromotion = 1 AND month(date) > 6")
    lake = tables.Lake(spark, new_folder(spark, "facts"))
    keys = ["date", "store_nbr", "family"]
    lake.create("sales", before.schema, "2024-01-01", partition_by="trunc(date, 'month')")
    lake.commit("sales", before.withColumn("_change_type", F.lit("insert")), keys, "2024-01-01")
    gone = newer.select(keys).unionByName(before.filter("trunc(date, 'month') = date'1997-03-01'").select(keys))
    lake.merge("sales", gone, keys, [delete()], as_of="2024-01-02", staged=True)
    return as_double(lake.read("sales"), "sales")
