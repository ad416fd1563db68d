"""Joins. Small sides carry no hint: the planner broadcasts what it has measured."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators import merge
from millpond.operators.gold import monthly_oil, monthly_sales
from millpond.operators.keys import assign
from millpond.operators.silver import fact_sales
from millpond.plans.registry import query, sql
from millpond.sources import retail


@query(
    "j1_star_using",
    sql(
        """SELECT date, store_nbr, t.id, t.family, t.sales, t.onpromotion, s.city, s.state, s.type, s.cluster, o.dcoilwtico
        FROM fx_train t LEFT JOIN fx_stores s USING (store_nbr) LEFT JOIN fx_oil o USING (date)""",
        "train",
        "stores",
        "oil",
    ),
)
def j1(spark, d):
    joined = retail.train(spark, d).join(retail.stores(spark, d), "store_nbr", "left")
    return joined.join(retail.oil(spark, d), "date", "left")


@query(
    "j2_star_on",
    sql(
        """SELECT t.id, t.date, t.store_nbr, t.sales, s.store_nbr AS s_store_nbr, s.city, o.date AS o_date, o.dcoilwtico,
        h.date AS h_date, h.entries, h.first_description, x.store_nbr AS x_store_nbr, x.transactions
        FROM fx_train t LEFT JOIN fx_stores s ON t.store_nbr = s.store_nbr
        LEFT JOIN fx_oil o ON o.date = t.date LEFT JOIN hol h ON h.date = t.date
        LEFT JOIN fx_transactions x ON x.date = t.date AND x.store_nbr = t.store_nbr""",
        "train",
        "stores",
        "oil",
        "holidays_events",
        "transactions",
        hol="SELECT date, COUNT(*) AS entries, MIN(description) AS first_description FROM fx_holidays_events GROUP BY date",
    ),
)
def j2(spark, d):
    """Holidays fold to one row per day first: several entries on a day would
    otherwise repeat every sale of that day."""
    t = retail.train(spark, d).alias("t")
    s, o = retail.stores(spark, d).alias("s"), retail.oil(spark, d).alias("o")
    x = retail.transactions(spark, d).alias("x")
    h = (
        retail.holidays(spark, d)
        .groupBy("date")
        .agg(F.count("*").alias("entries"), F.min("description").alias("first_description"))
        .alias("h")
    )
    col = F.col
    return (
        t.join(s, col("t.store_nbr") == col("s.store_nbr"), "left")
        .join(o, col("t.date") == col("o.date"), "left")
        .join(h, col("t.date") == col("h.date"), "left")
        .join(x, (col("t.date") == col("x.date")) & (col("t.store_nbr") == col("x.store_nbr")), "left")
        .select(
            *("t.id", "t.date", "t.store_nbr", "t.sales"),
            *(col("s.store_nbr").alias("s_store_nbr"), "s.city"),
            *(col("o.date").alias("o_date"), "o.dcoilwtico"),
            *(col("h.date").alias("h_date"), "h.entries", "h.first_description"),
            *(col("x.store_nbr").alias("x_store_nbr"), "x.transactions"),
        )
    )


@query(
    "j2_star_by_date",
    sql(
        """SELECT t.id, t.sales, s.city, o.dcoilwtico, x.stores_open, x.transactions
        FROM fx_train t LEFT JOIN fx_stores s ON t.store_nbr = s.store_nbr LEFT JOIN fx_oil o ON o.date = t.date
        LEFT JOIN x ON x.date = t.date""",
        "train",
        "stores",
        "oil",
        "transactions",
        x="""SELECT date, COUNT(*) AS stores_open, CAST(SUM(transactions) AS BIGINT) AS transactions
        FROM fx_transactions GROUP BY date""",
    ),
)
def j2_by_date(spark, d):
    """Transactions matched by date alone: summed per day before the join, as every
    sale would otherwise meet every store's row of that day."""
    per_day = (
        retail.transactions(spark, d)
        .groupBy("date")
        .agg(F.count("*").alias("stores_open"), F.sum("transactions").alias("transactions"))
    )
    joined = retail.train(spark, d).join(retail.stores(spark, d), "store_nbr", "left")
    joined = joined.join(retail.oil(spark, d), "date", "left").join(per_day, "date", "left")
    return joined.select("id", "sales", "city", "dcoilwtico", "stores_open", "transactions")


@query(
    "j3_left_join_on_condition",
    sql(
        """SELECT o.date, o.dcoilwtico, COUNT(h.date) AS national_entries FROM fx_oil o
        LEFT JOIN fx_holidays_events h ON o.date = h.date AND (h.date IS NULL OR h.locale = 'National')
        GROUP BY o.date, o.dcoilwtico""",
        "oil",
        "holidays_events",
    ),
)
def j3(spark, d):
    """The right-side condition is a filter under the join; entries are counted
    per day before it, so a day with many entries stays one row."""
    national = retail.holidays(spark, d).filter(F.col("locale") == "National")
    per_day = national.groupBy("date").agg(F.count("*").alias("national_entries"))
    return retail.oil(spark, d).join(per_day, "date", "left").fillna(0, ["national_entries"])


def _families(spark, d):
    return assign(retail.train(spark, d).select("family").distinct(), None, "product_family_nbr", ["family"])


@query(
    "j4_lookup",
    sql(
        """SELECT t.date, t.store_nbr, f.product_family_nbr, t.sales, t.onpromotion
        FROM fx_train t JOIN f ON t.family = f.family""",
        "train",
        f="SELECT family, ROW_NUMBER() OVER (ORDER BY family) AS product_family_nbr FROM (SELECT DISTINCT family FROM fx_train) u",
    ),
)
def j4(spark, d):
    facts = fact_sales(retail.train(spark, d), _families(spark, d))
    return facts.select("date", "store_nbr", "product_family_nbr", F.col("sales").cast("double"), "onpromotion")


@query(
    "j5_computed_keys",
    sql(
        """SELECT o.date, o.dcoilwtico, CAST(m.oil_price AS DOUBLE) AS month_price FROM fx_oil o JOIN m
        ON MONTH(o.date) = m.mon AND YEAR(o.date) = m.yr""",
        "oil",
        m="""SELECT MONTH(date) AS mon, YEAR(date) AS yr,
        CAST(SUM(CAST(dcoilwtico AS DECIMAL(14,2))) / COUNT(dcoilwtico) AS DECIMAL(14,2)) AS oil_price
        FROM fx_oil GROUP BY 1, 2""",
    ),
)
def j5(spark, d):
    oil = retail.oil(spark, d)
    months = monthly_oil(oil.withColumnRenamed("dcoilwtico", "oil_price"))
    dated = oil.withColumns({"month_oil_price": F.month("date"), "year_oil_price": F.year("date")})
    joined = dated.join(months, ["month_oil_price", "year_oil_price"])
    return joined.select("date", "dcoilwtico", F.col("oil_price").cast("double").alias("month_price"))


@query(
    "j6_four_keys",
    sql(
        """SELECT t.id, t.sales, c.n FROM fx_train t JOIN c ON t.store_nbr = c.store_nbr AND t.family = c.family
        AND MONTH(t.date) = c.mon AND YEAR(t.date) = c.yr""",
        "train",
        "train_v2",
        c="""SELECT store_nbr, family, MONTH(date) AS mon, YEAR(date) AS yr, COUNT(*) AS n FROM fx_train_v2
        GROUP BY 1, 2, 3, 4""",
    ),
)
def j6(spark, d):
    place = {"mon": F.month("date"), "yr": F.year("date")}
    keys = ["store_nbr", "family", "mon", "yr"]
    counts = retail.train_v2(spark, d).withColumns(place).groupBy(*keys).agg(F.count("*").alias("n"))
    return retail.train(spark, d).withColumns(place).join(counts, keys).select("id", "sales", "n")


@query(
    "j7_three_keys_left",
    sql(
        """SELECT t.row_id, t.data_block_id, t.county, t.product_type, t.target, c.clients FROM fx_energy_train t
        LEFT JOIN fx_energy_client c ON t.data_block_id = c.data_block_id AND t.county = c.county
        AND t.product_type = c.product_type""",
        "energy_train",
        "energy_client",
    ),
)
def j7(spark, d):
    keys = ["data_block_id", "county", "product_type"]
    return retail.energy_train(spark, d).join(retail.energy_client(spark, d), keys, "left")


@query(
    "j8_left_join_active",
    sql(
        """SELECT t.store_nbr, t.family, s.city, s.type FROM (SELECT DISTINCT store_nbr, family FROM fx_train) t
        LEFT JOIN (SELECT DISTINCT * FROM fx_stores WHERE type <> 'E') s ON t.store_nbr = s.store_nbr""",
        "train",
        "stores",
    ),
)
def j8(spark, d):
    kept = retail.stores(spark, d).filter(F.col("type") != "E").distinct().select("store_nbr", "city", "type")
    return retail.train(spark, d).select("store_nbr", "family").distinct().join(kept, "store_nbr", "left")


@query(
    "j9_null_aware_anti",
    sql(
        """SELECT DISTINCT date FROM fx_train WHERE date NOT IN (SELECT date FROM fx_holidays_events WHERE locale = 'National')""",
        "train",
        "holidays_events",
    ),
)
def j9(spark, d):
    national = retail.holidays(spark, d).filter(F.col("locale") == "National").select("date")
    return merge.not_in(retail.train(spark, d).select("date").distinct(), "date", national)


@query(
    "j10_semi",
    sql(
        "SELECT * FROM fx_train WHERE date IN (SELECT date FROM fx_holidays_events WHERE locale = 'National' AND NOT transferred)",
        "train",
        "holidays_events",
    ),
)
def j10(spark, d):
    days = retail.holidays(spark, d).filter((F.col("locale") == "National") & ~F.col("transferred"))
    return retail.train(spark, d).join(days, "date", "left_semi")


@query(
    "j11_independent_memberships",
    sql(
        """SELECT * FROM fx_holidays_events WHERE date IN (SELECT date FROM x) AND type IN (SELECT type FROM x)
        AND locale IN (SELECT locale FROM x) AND locale_name IN (SELECT locale_name FROM x)""",
        "holidays_events",
        x="SELECT * FROM fx_holidays_events WHERE transferred",
    ),
)
def j11(spark, d):
    rows = retail.holidays(spark, d)
    gone = rows.filter("transferred")
    for name in ("date", "type", "locale", "locale_name"):
        rows = rows.join(gone.select(name).distinct(), name, "left_semi")
    return rows


@query(
    "j11_tuple_membership",
    sql(
        """SELECT h.* FROM fx_holidays_events h WHERE EXISTS (SELECT 1 FROM fx_holidays_events x WHERE x.transferred
        AND x.date = h.date AND x.type = h.type AND x.locale = h.locale AND x.locale_name = h.locale_name)""",
        "holidays_events",
    ),
)
def j11_tuple(spark, d):
    rows = retail.holidays(spark, d)
    return rows.join(rows.filter("transferred"), ["date", "type", "locale", "locale_name"], "left_semi")


@query(
    "j12_match_join",
    sql(
        """SELECT COALESCE(a.store_nbr, b.store_nbr) AS store_nbr, a.store_nbr IS NOT NULL AS in_target,
        b.store_nbr IS NOT NULL AS in_source, a.type AS old_type, b.type AS new_type
        FROM fx_stores_v1 a FULL JOIN fx_stores_v2 b ON a.store_nbr = b.store_nbr""",
        "stores_v1",
        "stores_v2",
    ),
)
def j12(spark, d):
    old = retail.stores_v1(spark, d).select("store_nbr", F.col("type").alias("old_type"), F.lit(True).alias("a"))
    new = retail.stores_v2(spark, d).select("store_nbr", F.col("type").alias("new_type"), F.lit(True).alias("b"))
    both = old.join(new, "store_nbr", "full_outer")
    return both.select(
        "store_nbr",
        F.col("a").isNotNull().alias("in_target"),
        F.col("b").isNotNull().alias("in_source"),
        "old_type",
        "new_type",
    )


@query(
    "j13_or_condition",
    sql(
        """SELECT a.store_nbr, a.type AS type, b.type AS new_type, b.cluster FROM fx_stores_v1 a JOIN fx_stores_v2 b
        ON (a.store_nbr = b.store_nbr AND a.type = b.type) OR (a.store_nbr = b.store_nbr AND b.cluster > 10)""",
        "stores_v1",
        "stores_v2",
    ),
)
def j13(spark, d):
    a, b = retail.stores_v1(spark, d).alias("a"), retail.stores_v2(spark, d).alias("b")
    same = F.col("a.store_nbr") == F.col("b.store_nbr")
    match = (same & (F.col("a.type") == F.col("b.type"))) | (same & (F.col("b.cluster") > 10))
    return a.join(b, match).select("a.store_nbr", "a.type", F.col("b.type").alias("new_type"), "b.cluster")


@query(
    "j14_text_date",
    sql(
        """SELECT o.date, o.dcoilwtico, f.dt FROM fx_oil o JOIN f ON o.date = TRY_CAST(f.dt AS DATE)""",
        "oil",
        f="SELECT CASE WHEN EXTRACT(DAY FROM date) = 31 THEN 'n/a' ELSE CAST(date AS VARCHAR) END AS dt FROM fx_oil",
    ),
)
def j14(spark, d):
    oil = retail.oil(spark, d)
    text = F.when(F.dayofmonth("date") == 31, "n/a").otherwise(F.col("date").cast("string"))
    feed = oil.select(text.alias("dt")).withColumn("date", F.col("dt").try_cast("date"))
    return oil.join(feed, "date")


@query(
    "j15_changed_groups",
    sql(
        """SELECT x.store_nbr, x.date, x.transactions FROM fx_transactions x WHERE EXISTS (SELECT 1 FROM c
        WHERE c.store_nbr = x.store_nbr AND c.mon = MONTH(x.date) AND c.yr = YEAR(x.date))""",
        "transactions",
        c="""SELECT store_nbr, MONTH(date) AS mon, YEAR(date) AS yr FROM fx_transactions
        WHERE transactions >= 2 AND EXTRACT(DAY FROM date) = 15""",
    ),
)
def j15(spark, d):
    place = {"mon": F.month("date"), "yr": F.year("date")}
    rows = retail.transactions(spark, d).withColumns(place)
    changed = rows.filter((F.col("transactions") >= 2) & (F.dayofmonth("date") == 15))
    keys = ["store_nbr", "mon", "yr"]
    return rows.join(changed.select(keys).distinct(), keys, "left_semi").select("store_nbr", "date", "transactions")


@query(
    "j16_audit",
    sql(
        """SELECT c.store_nbr, c.family, c.date, g.total FROM (SELECT store_nbr, family, date FROM fx_train_v2
        EXCEPT SELECT store_nbr, family, date FROM fx_train_v1) c LEFT JOIN (SELECT store_nbr, family, YEAR(date) AS yr,
        MONTH(date) AS mon, CAST(SUM(CAST(sales AS DECIMAL(14,2))) AS DOUBLE) AS total FROM fx_train_v1 GROUP BY 1, 2, 3, 4) g
        ON c.store_nbr = g.store_nbr AND c.family = g.family AND YEAR(c.date) = g.yr AND MONTH(c.date) = g.mon""",
        "train_v1",
        "train_v2",
    ),
)
def j16(spark, d):
    before = retail.train_v1(spark, d)
    keys = ["store_nbr", "family", "date"]
    fresh = retail.train_v2(spark, d).select(keys).join(before, keys, "left_anti")
    gold = monthly_sales(before)
    dated = fresh.withColumns({"month_train_date": F.month("date"), "year_train_date": F.year("date")})
    joined = dated.join(gold, ["store_nbr", "family", "month_train_date", "year_train_date"], "left")
    return joined.select(*keys, F.col("total_sales").cast("double").alias("total"))
