"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.functions.dates import year_month
from millpond.operators import merge
from millpond.operators.features import labels
from millpond.operators.silver import text_to_boolean
from millpond.plans.registry import query, sql
from millpond.sources import retail


@query(
    "p1_select_rename",
    sql(
        """SELECT t.store_nbr, t.family, t.date AS ds, t.sales AS y, s.city, s.state, s.type, s.cluster
        FROM fx_train t JOIN fx_stores s ON t.store_nbr = s.store_nbr""",
        "train",
        "stores",
    ),
)
def p1(spark, d):
    train = retail.train(spark, d).withColumnsRenamed({"date": "ds", "sales": "y"})
    joined = train.alias("t").join(retail.stores(spark, d).alias("s"), "store_nbr")
    return joined.select("store_nbr", "t.family", "t.ds", "t.y", "s.city", "s.state", "s.type", "s.cluster")


@query(
    "p2_add_drop_columns",
    sql(
        "SELECT date, locale, description, transferred, locale_name AS city, locale_name AS state FROM fx_holidays_events",
        "holidays_events",
    ),
)
def p2(spark, d):
    h = retail.holidays(spark, d).withColumns({"city": F.col("locale_name"), "state": F.col("locale_name")})
    return h.drop("type", "locale_name", "no_such_column")


@query("p3_equal", sql("SELECT * FROM fx_holidays_events WHERE locale = 'Local'", "holidays_events"))
def p3(spark, d):
    return retail.holidays(spark, d).filter(F.col("locale") == "Local")


@query(
    "p4_range",
    sql(
        """SELECT * FROM fx_train WHERE store_nbr >= 4 AND store_nbr <= 18
        AND date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""",
        "train",
    ),
)
def p4(spark, d):
    date = F.col("date").between(F.lit("1997-01-01").cast("date"), F.lit("1998-12-31").cast("date"))
    return retail.train(spark, d).filter(F.col("store_nbr").between(4, 18) & date)


@query(
    "p5_not_equal",
    sql("SELECT * FROM fx_oil WHERE dcoilwtico <> 25.5", "oil"),
)
def p5(spark, d):
    return retail.oil(spark, d).filter(F.col("dcoilwtico") != 25.5)


@query(
    "p6_in_list",
    sql(
        "SELECT * FROM fx_holidays_events WHERE type IN ('Event', 'Bridge') AND locale NOT IN ('Local', 'Regional')",
        "holidays_events",
    ),
)
def p6(spark, d):
    wanted = F.col("type").isin("Event", "Bridge") & ~F.col("locale").isin("Local", "Regional")
    return retail.holidays(spark, d).filter(wanted)


@query(
    "p7_boolean_logic",
    sql(
        """SELECT date, locale, transferred, cheap FROM (
            SELECT h.date, h.locale, h.transferred, o.dcoilwtico < 20 AS cheap
            FROM fx_holidays_events h LEFT JOIN fx_oil o ON h.date = o.date) x
        WHERE (locale <> 'National' AND NOT transferred) OR NOT cheap""",
        "holidays_events",
        "oil",
    ),
)
def p7(spark, d):
    h = retail.holidays(spark, d).join(retail.oil(spark, d), "date", "left")
    h = h.select("date", "locale", "transferred", (F.col("dcoilwtico") < 20).alias("cheap"))
    return h.filter(((F.col("locale") != "National") & ~F.col("transferred")) | ~F.col("cheap"))


@query(
    "p8_null_tests",
    sql(
        """SELECT date, dcoilwtico IS NULL AS unknown, (dcoilwtico > 30) IS TRUE AS dear FROM fx_oil
        WHERE dcoilwtico IS NULL OR (dcoilwtico IS NOT NULL AND (dcoilwtico > 30) IS TRUE)""",
        "oil",
    ),
)
def p8(spark, d):
    price = F.col("dcoilwtico")
    dear = F.coalesce(price > 30, F.lit(False))
    rows = retail.oil(spark, d).select("date", price.isNull().alias("unknown"), dear.alias("dear"))
    return rows.filter(F.col("unknown") | F.col("dear"))


@query(
    "p9_conditionals",
    sql(
        """SELECT date, CASE WHEN dcoilwtico > 30 THEN 'dear' WHEN dcoilwtico > 20 THEN 'fair' ELSE 'low' END AS band,
        CASE WHEN dcoilwtico > 30 THEN 0 ELSE 1 END AS calm FROM fx_oil""",
        "oil",
    ),
)
def p9(spark, d):
    price = F.col("dcoilwtico")
    band = F.when(price > 30, "dear").when(price > 20, "fair").otherwise("low")
    return retail.oil(spark, d).select("date", band.alias("band"), F.expr("IF(dcoilwtico > 30, 0, 1)").alias("calm"))


@query(
    "p10_text_boolean",
    sql(
        """SELECT description, CASE WHEN txt = 'TRUE' THEN TRUE WHEN txt = 'FALSE' THEN FALSE END AS transferred FROM (
            SELECT description, CASE WHEN type = 'Bridge' THEN 'unknown' WHEN type = 'Event' THEN NULL
            WHEN transferred THEN 'TRUE' ELSE 'FALSE' END AS txt FROM fx_holidays_events) x""",
        "holidays_events",
    ),
)
def p10(spark, d):
    text = (
        F.when(F.col("type") == "Bridge", "unknown")
        .when(F.col("type") == "Event", None)
        .when(F.col("transferred"), "TRUE")
        .otherwise("FALSE")
    )
    raw = retail.holidays(spark, d).select("description", text.alias("txt"))
    return raw.select("description", text_to_boolean("txt").alias("transferred"))


@query(
    "p11_in_subquery",
    sql(
        "SELECT * FROM fx_stores WHERE store_nbr IN (SELECT store_nbr FROM fx_train WHERE sales > 120000)",
        "stores",
        "train",
    ),
)
def p11(spark, d):
    big = retail.train(spark, d).filter(F.col("sales") > 120000)
    return retail.stores(spark, d).join(big, "store_nbr", "left_semi")


@query(
    "p12_not_in_subquery",
    sql(
        """SELECT store_nbr, city FROM fx_stores WHERE city NOT IN
        (SELECT locale_name FROM fx_holidays_events WHERE locale = 'Local' AND locale_name < 'NATION_2')""",
        "stores",
        "holidays_events",
    ),
)
def p12(spark, d):
    early = (F.col("locale") == "Local") & (F.col("locale_name") < "NATION_2")
    named = retail.holidays(spark, d).filter(early).select("locale_name")
    return merge.not_in(retail.stores(spark, d).select("store_nbr", "city"), "city", named)


@query(
    "p13_commit_day",
    sql(
        """SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'""",
    ),
)
def p13(spark, d):
    events = retail.table(spark, d, "events")
    return events.filter(F.to_date("ts") == F.lit("2024-01-05").cast("date")).select("event_id", "event_type")


@query(
    "p14_parameter",
    sql(
        """SELECT STRFTIME(date, '%Y-%m') AS yr_mnt, CAST(SUM(transactions) AS BIGINT) AS transactions
        FROM fx_transactions WHERE store_nbr = 7 GROUP BY 1""",
        "transactions",
    ),
)
def p14(spark, d):
    rows = retail.transactions(spark, d).select("store_nbr", "transactions", year_month("date").alias("yr_mnt"))
    return spark.sql(
        "SELECT yr_mnt, SUM(transactions) AS transactions FROM {rows} WHERE store_nbr = :store GROUP BY yr_mnt",
        args={"store": 7},
        rows=rows,
    )


@query(
    "p15_fill_nulls",
    sql("SELECT date, COALESCE(dcoilwtico, 0) AS dcoilwtico FROM fx_oil", "oil"),
)
def p15(spark, d):
    return retail.oil(spark, d).fillna(0, ["dcoilwtico"])


@query(
    "p16_array_to_columns",
    sql(
        """SELECT store_nbr, CAST(type = 'A' AS INT) AS type_A, CAST(type = 'B' AS INT) AS type_B,
        CAST(type = 'C' AS INT) AS type_C, CAST(type = 'D' AS INT) AS type_D, CAST(type = 'E' AS INT) AS type_E
        FROM fx_stores""",
        "stores",
    ),
)
def p16(spark, d):
    stores = retail.stores(spark, d)
    known = sorted(labels(stores, ["type"])["type"])
    flags = F.array(*[(F.col("type") == v).cast("int") for v in known])
    packed = stores.select("store_nbr", flags.alias("flags"))
    return packed.select("store_nbr", *[F.col("flags")[i].alias(f"type_{v}") for i, v in enumerate(known)])
