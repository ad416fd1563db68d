"""Each silver table merged from its bronze source."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators import calendar_dim, keys, merge, silver
from millpond.operators.tables import conform
from millpond.plans.aggregates import as_double
from millpond.plans.feeds import HOLIDAY, HOLIDAY_KEYS
from millpond.plans.gold_jobs import OIL_1, OIL_2, VISIT_1, VISIT_2, oil_states, visit_states
from millpond.plans.registry import query, sql
from millpond.schemas import SILVER
from millpond.sources import retail


def _first(table, source):
    """The table after its first load: rows numbered in key order."""
    spec = SILVER[table]
    if spec.identity is None:
        return conform(source, spec.schema)
    return conform(keys.assign(source, None, spec.identity, list(spec.keys)), spec.schema)


def _identity_sql(columns: str, key: str, order: str, merged: str, old: str, new: str, match: str) -> str:
    """Old rows keep their number, new rows continue after the largest in key order."""
    first = order.split(",")[0].strip()
    return f"""WITH old AS (SELECT ROW_NUMBER() OVER (ORDER BY {order}) AS {key}, {columns} FROM ({old}) o), new AS ({new})
    SELECT a.{key}, {merged} FROM old a LEFT JOIN new b ON {match} UNION ALL
    SELECT (SELECT MAX({key}) FROM old) + ROW_NUMBER() OVER (ORDER BY {order}), {columns} FROM (
    SELECT b.* FROM new b LEFT JOIN old a ON {match} WHERE a.{first} IS NULL) n"""


def _upserted_sql(fixture: list[str], ctes: dict[str, str], **parts: str) -> str:
    text = _identity_sql(**parts)
    inner = text.removeprefix("WITH ")
    return sql("", *fixture, **ctes).rstrip() + ",\n" + inner


@query(
    "f4_oil_prices",
    _upserted_sql(
        ["oil"],
        {"o1": OIL_1, "o2": OIL_2},
        columns="date, oil_price",
        key="id",
        order="date",
        merged="a.date, CASE WHEN b.date IS NULL THEN a.oil_price ELSE b.oil_price END AS oil_price",
        old="SELECT date, dcoilwtico AS oil_price FROM o1",
        new="SELECT date, dcoilwtico AS oil_price FROM o2",
        match="a.date = b.date",
    ),
)
def oil_prices(spark, d):
    before, after = (s.withColumnRenamed("oil_price", "dcoilwtico") for s in oil_states(spark, d))
    name = "silver_dim_oil_prices"
    merged = silver.upsert(name, _first(name, silver.prepare(name, before)), silver.prepare(name, after), staged=True)
    return as_double(merged, "oil_price")


@query(
    "f4_fact_train",
    sql(
        """SELECT * FROM fx_train_v2 UNION ALL SELECT a.* FROM fx_train_v1 a LEFT JOIN fx_train_v2 b ON a.id = b.id
        WHERE b.id IS NULL""",
        "train_v1",
        "train_v2",
    ),
)
def fact_train(spark, d):
    name = "silver_fact_train"
    before, after = (silver.prepare(name, s(spark, d)) for s in (retail.train_v1, retail.train_v2))
    return as_double(silver.upsert(name, _first(name, before), after, staged=True), "sales")


FAMILIES = """SELECT family, ROW_NUMBER() OVER (ORDER BY family) AS product_family_nbr
FROM (SELECT DISTINCT family FROM fx_train) u"""


@query(
    "f4_fact_sales",
    sql(
        """SELECT x.id, x.date, x.store_nbr, f.product_family_nbr, x.sales, x.onpromotion FROM (
        SELECT * FROM fx_train_v2 UNION ALL SELECT a.* FROM fx_train_v1 a LEFT JOIN fx_train_v2 b ON a.id = b.id
        WHERE b.id IS NULL) x JOIN f ON x.family = f.family""",
        "train_v1",
        "train_v2",
        f=FAMILIES,
    ),
)
def fact_sales(spark, d):
    families = keys.assign(
        retail.train(spark, d).select("family").distinct(), None, "product_family_nbr", ["family"]
    )
    name = "silver_fact_sales"
    before, after = (silver.fact_sales(s(spark, d), families) for s in (retail.train_v1, retail.train_v2))
    return as_double(silver.upsert(name, _first(name, before), after, staged=True), "sales")


@query(
    "f4_stores",
    _upserted_sql(
        ["stores_v1", "stores_v2"],
        {},
        columns="store_nbr, city, state, type, cluster",
        key="id",
        order="store_nbr, city, state",
        merged="a.store_nbr, a.city, a.state, COALESCE(b.type, a.type) AS type, COALESCE(b.cluster, a.cluster) AS cluster",
        old="SELECT * FROM fx_stores_v1",
        new="SELECT * FROM fx_stores_v2",
        match="a.store_nbr = b.store_nbr AND a.city = b.city AND a.state = b.state",
    ),
)
def stores(spark, d):
    name = "silver_dim_store"
    return silver.upsert(name, _first(name, retail.stores_v1(spark, d)), retail.stores_v2(spark, d), staged=True)


@query(
    "f4_transactions",
    _upserted_sql(
        ["transactions"],
        {"x1": VISIT_1, "x2": VISIT_2},
        columns="date, store_nbr, transactions",
        key="id",
        order="date, store_nbr",
        merged="a.date, a.store_nbr, COALESCE(b.transactions, a.transactions) AS transactions",
        old="SELECT * FROM x1",
        new="SELECT * FROM x2",
        match="a.date = b.date AND a.store_nbr = b.store_nbr",
    ),
)
def transactions(spark, d):
    name = "silver_dim_transactions"
    before, after = visit_states(spark, d)
    return silver.upsert(name, _first(name, before), after, staged=True)


HOLIDAY_SIX = ", ".join(HOLIDAY_KEYS) + ", description, transferred"


@query(
    "f4_holidays_six_keys",
    _upserted_sql(
        ["holidays_events"],
        {
            "b1": "SELECT DISTINCT * FROM fx_holidays_events WHERE DAY(date) % 3 <> 0",
            "b2": "SELECT DISTINCT * FROM fx_holidays_events WHERE DAY(date) % 4 <> 0",
        },
        columns=HOLIDAY,
        key="id",
        order=HOLIDAY_SIX,
        merged=", ".join(f"a.{c}" for c in HOLIDAY.split(", ")),
        old="SELECT * FROM b1",
        new="SELECT * FROM b2",
        match=" AND ".join(f"a.{c} = b.{c}" for c in HOLIDAY.split(", ")),
    ),
)
def holidays_six(spark, d):
    """Duplicates leave the batch before the merge."""
    name = "silver_dim_holidays_events"
    rows = retail.holidays(spark, d)
    rows = rows.unionByName(rows)
    before, after = (silver.prepare(name, rows.filter(F.dayofmonth("date") % n != 0)) for n in (3, 4))
    return silver.upsert(name, _first(name, before), after, staged=True)


ONE_PER_FOUR = f"""SELECT {HOLIDAY} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {", ".join(HOLIDAY_KEYS)}
ORDER BY description, transferred) AS rn FROM {{t}}) q WHERE rn = 1"""


@query(
    "f4_holidays_four_keys",
    sql(
        """SELECT a.date, a.type, a.locale, a.locale_name, COALESCE(b.description, a.description) AS description,
        COALESCE(b.transferred, a.transferred) AS transferred FROM b1 a LEFT JOIN b2 b ON a.date = b.date AND a.type = b.type
        AND a.locale = b.locale AND a.locale_name = b.locale_name
        UNION ALL SELECT b.* FROM b2 b WHERE NOT EXISTS (SELECT 1 FROM b1 a WHERE a.date = b.date AND a.type = b.type
        AND a.locale = b.locale AND a.locale_name = b.locale_name)""",
        "holidays_events",
        one=ONE_PER_FOUR.format(t="fx_holidays_events"),
        b1="SELECT * FROM one WHERE DAY(date) % 3 <> 0",
        b2="""SELECT date, type, locale, locale_name, description || '!' AS description, NOT transferred AS transferred
        FROM one WHERE DAY(date) % 4 <> 0""",
    ),
)
def holidays_four(spark, d):
    rows = silver.one_per_key(retail.holidays(spark, d), tuple(HOLIDAY_KEYS))
    changed = {"description": F.concat("description", F.lit("!")), "transferred": ~F.col("transferred")}
    before = rows.filter(F.dayofmonth("date") % 3 != 0)
    after = rows.withColumns(changed).filter(F.dayofmonth("date") % 4 != 0)
    return merge.merge(
        before,
        after,
        HOLIDAY_KEYS,
        [merge.update({"description": "s.description", "transferred": "s.transferred"})],
        [merge.insert_all()],
        staged=True,
    )


@query(
    "f4_holidays_one_per_date",
    sql(
        """SELECT COALESCE(b.date, a.date) AS date, COALESCE(b.type, a.type) AS type, COALESCE(b.locale, a.locale) AS locale,
        COALESCE(b.locale_name, a.locale_name) AS locale_name, COALESCE(b.description, a.description) AS description,
        COALESCE(b.transferred, a.transferred) AS transferred
        FROM (SELECT * FROM fx_holidays_events WHERE DAY(date) % 3 <> 0) a FULL JOIN (SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY type, locale, locale_name, description, transferred) AS rn
        FROM fx_holidays_events WHERE DAY(date) % 4 <> 0) q WHERE rn = 1) b ON a.date = b.date""",
        "holidays_events",
    ),
)
def holidays_one_per_date(spark, d):
    """The target may hold several rows per date; each takes the one source row."""
    rows = retail.holidays(spark, d)
    source = silver.one_per_key(rows.filter(F.dayofmonth("date") % 4 != 0), ("date",))
    target = rows.filter(F.dayofmonth("date") % 3 != 0)
    return merge.merge(target, source, ["date"], [merge.update_all()], [merge.insert_all()], staged=True)


REGIONAL = "SELECT * FROM one WHERE locale <> 'National' AND NOT transferred"


@query(
    "f4_regional_holiday",
    sql(
        f"""SELECT {HOLIDAY} FROM b2 UNION ALL SELECT {HOLIDAY} FROM b1 a WHERE NOT EXISTS (SELECT 1 FROM b2 b
        WHERE a.date = b.date AND a.type = b.type AND a.locale = b.locale AND a.locale_name = b.locale_name)""",
        "holidays_events",
        kept="SELECT * FROM fx_holidays_events WHERE locale <> 'National' AND NOT transferred",
        one=ONE_PER_FOUR.format(t="kept"),
        b1="SELECT * FROM one WHERE DAY(date) % 3 <> 0",
        b2="SELECT * REPLACE (description || '!' AS description) FROM one WHERE DAY(date) % 4 <> 0",
    ),
)
def regional_holiday(spark, d):
    name = "silver_dim_regional_holiday"
    rows = retail.holidays(spark, d)
    before = silver.prepare(name, rows.filter(F.dayofmonth("date") % 3 != 0))
    later = rows.filter(F.dayofmonth("date") % 4 != 0).withColumn("description", F.concat("description", F.lit("!")))
    return silver.upsert(name, _first(name, before), silver.prepare(name, later), staged=True)


@query(
    "f4_dim_date",
    sql(
        """SELECT d.date, DAY(d.date) = 15 OR d.date = LAST_DAY(d.date) AS is_payday, STRFTIME(d.date, '%A') AS day_of_week,
        DAYOFWEEK(d.date) IN (0, 6) AS is_weekend,
        d.date BETWEEN DATE '1996-04-16' AND DATE '1996-04-16' + 50 AS is_earthquake_recovery,
        CAST(CASE WHEN d.date BETWEEN DATE '1996-04-16' AND DATE '1996-04-16' + 50
            THEN DATEDIFF('day', DATE '1996-04-16', d.date) END AS INT) AS days_since_earthquake,
        COALESCE(h.a, FALSE) AS is_national_holiday, COALESCE(h.b, FALSE) AS is_national_holiday_transferred
        FROM days d LEFT JOIN h ON d.date = h.date""",
        "oil",
        "holidays_events",
        days="""SELECT CAST(UNNEST(GENERATE_SERIES(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM fx_oil""",
        h="""SELECT date, BOOL_OR(NOT transferred) AS a, BOOL_OR(transferred) AS b FROM fx_holidays_events
        WHERE locale = 'National' GROUP BY date""",
    ),
)
def dim_date(spark, d):
    """A shorter calendar with an older holiday list, merged with the full one."""
    days = calendar_dim.dates_between(retail.oil(spark, d), "date")
    holidays = retail.holidays(spark, d)
    early = calendar_dim.dates_between(retail.oil(spark, d).filter(F.year("date") < 1998), "date")
    before = silver.dim_date(early, holidays.filter(F.year("date") < 1996), event_day="1996-04-16")
    after = silver.dim_date(days, holidays, event_day="1996-04-16")
    return silver.upsert("silver_dim_date", before, after, staged=True)


@query(
    "f4_sales_by_store",
    sql(
        """SELECT s.store_nbr, s.city AS store_city, s.state AS store_state,
        CAST(SUM(CAST(t.sales AS DECIMAL(14,2))) AS DOUBLE) AS total_sales FROM fx_stores s JOIN fx_train t
        ON s.store_nbr = t.store_nbr GROUP BY 1, 2, 3""",
        "stores",
        "train",
    ),
)
def sales_by_store(spark, d):
    """Totals per store merged on the store number into an older summary."""
    total = F.sum(F.col("sales").cast("decimal(14,2)")).alias("total_sales")
    places = retail.stores(spark, d).select("store_nbr", F.col("city").alias("store_city"), F.col("state").alias("store_state"))

    def summary(rows):
        return places.join(rows.groupBy("store_nbr").agg(total), "store_nbr")

    train = retail.train(spark, d)
    old = summary(train.filter((F.year("date") < 1998) & (F.col("store_nbr") % 3 != 0)))
    merged = merge.merge(
        old,
        summary(train),
        ["store_nbr"],
        [merge.update({"total_sales": "s.total_sales"})],
        [merge.insert_all()],
        staged=True,
    )
    return as_double(merged, "total_sales")
