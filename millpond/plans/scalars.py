"""Scalar function families and the calendar dimension."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millpond.operators import calendar_dim
from millpond.plans.registry import query, sql
from millpond.sources import retail


@query(
    "fn_date_parts",
    sql(
        """SELECT date, CAST(YEAR(date) AS INT) AS yr, CAST(MONTH(date) AS INT) AS mon, CAST(DAY(date) AS INT) AS dom,
        LAST_DAY(date) AS month_end, CAST(DAYOFWEEK(date) + 1 AS INT) AS dow, CAST(WEEKOFYEAR(date) AS INT) AS week FROM fx_oil""",
        "oil",
    ),
)
def date_parts(spark, d):
    return retail.oil(spark, d).select(
        "date",
        F.year("date").alias("yr"),
        F.extract(F.lit("MONTH"), "date").alias("mon"),
        F.dayofmonth("date").alias("dom"),
        F.last_day("date").alias("month_end"),
        F.dayofweek("date").alias("dow"),
        F.weekofyear("date").alias("week"),
    )


@query(
    "fn_date_format_parse",
    sql(
        """SELECT event_id, STRFTIME(ts, '%A') AS day_name, CAST(ts AS DATE) AS day,
        CAST(STRPTIME(STRFTIME(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed FROM events""",
    ),
)
def date_format_parse(spark, d):
    text = F.date_format("ts", "dd/MM/yyyy")
    return retail.table(spark, d, "events").select(
        "event_id",
        F.date_format("ts", "EEEE").alias("day_name"),
        F.to_date("ts").alias("day"),
        F.to_date(text, "dd/MM/yyyy").alias("parsed"),
    )


@query(
    "fn_date_arithmetic",
    sql(
        """SELECT date, date + 50 AS later, CAST(DATEDIFF('day', DATE '1996-04-16', date) AS INT) AS since,
        CAST(date - INTERVAL 12 MONTH AS DATE) AS year_ago, date + 7 AS next_week FROM fx_oil""",
        "oil",
    ),
)
def date_arithmetic(spark, d):
    return retail.oil(spark, d).select(
        "date",
        (F.col("date") + F.expr("interval 50 days")).alias("later"),
        F.datediff("date", F.lit("1996-04-16").cast("date")).alias("since"),
        F.add_months("date", -12).alias("year_ago"),
        F.date_add("date", 7).alias("next_week"),
    )


@query(
    "fn_clock",
    sql(
        """SELECT store_nbr, DATE '2024-03-01' AS proc_dt, TRUE AS clock_is_later FROM fx_stores""",
        "stores",
    ),
)
def clock(spark, d):
    """The processing day is an argument; the session clock only has to be past it."""
    as_of = F.lit("2024-03-01").cast("date")
    later = (F.current_date() >= as_of) & (F.current_timestamp() >= as_of.cast("timestamp"))
    return retail.stores(spark, d).select("store_nbr", as_of.alias("proc_dt"), later.alias("clock_is_later"))


@query(
    "fn_math",
    sql(
        """SELECT id, ABS(sales - 30000) AS off, GREATEST(sales, 30000) AS at_least,
        CAST(FLOOR(sales / 1000) AS BIGINT) AS thousands FROM fx_train""",
        "train",
    ),
)
def math(spark, d):
    sales = F.col("sales")
    return retail.train(spark, d).select(
        "id",
        F.abs(sales - 30000).alias("off"),
        F.greatest(sales, F.lit(30000.0)).alias("at_least"),
        F.floor(sales / 1000).alias("thousands"),
    )


@query(
    "fn_cast",
    sql(
        """SELECT id, CAST(TRUNC(sales) AS INT) AS sales_int, CAST(CAST(sales AS DECIMAL(14,2)) AS DOUBLE) AS sales_dec,
        CAST(CAST(date AS VARCHAR) AS DATE) AS again, TRY_CAST(family AS INT) AS bad FROM fx_train""",
        "train",
    ),
)
def cast(spark, d):
    return retail.train(spark, d).select(
        "id",
        F.col("sales").cast("int").alias("sales_int"),
        F.col("sales").cast("decimal(14,2)").cast("double").alias("sales_dec"),
        F.col("date").cast("string").cast("date").alias("again"),
        F.col("family").try_cast("int").alias("bad"),
    )


@query(
    "fn_string",
    sql(
        """SELECT id, CONCAT(store_nbr, '_', family) AS series_id, CONCAT(store_nbr, '_', family, '_model') AS model_name,
        LPAD(CAST(onpromotion AS VARCHAR), 2, '0') AS padded FROM fx_train""",
        "train",
    ),
)
def string(spark, d):
    series = F.concat_ws("_", "store_nbr", "family")
    return retail.train(spark, d).select(
        "id",
        series.alias("series_id"),
        F.concat(series, F.lit("_model")).alias("model_name"),
        F.lpad(F.col("onpromotion").cast("string"), 2, "0").alias("padded"),
    )


@query(
    "fn_json",
    sql("SELECT id, CAST(onpromotion AS INT) AS onpromotion, 50 AS oil_price FROM fx_train", "train"),
)
def json(spark, d):
    """Feature bag to text and back: the fields, not the text, are compared."""
    bag = F.to_json(F.struct("onpromotion", F.lit(50).alias("oil_price")))
    rows = retail.train(spark, d).select("id", bag.alias("features"))
    fields = F.from_json("features", "onpromotion INT, oil_price INT")
    return rows.select("id", fields.alias("f")).select("id", "f.onpromotion", "f.oil_price")


@query(
    "fn_array",
    sql("SELECT id, sales AS first_value, CAST(onpromotion AS DOUBLE) AS second_value, 2 AS n FROM fx_train", "train"),
)
def array(spark, d):
    """A feature vector turned into an array and read by position."""
    rows = retail.train(spark, d).select("id", "sales", F.col("onpromotion").cast("double"))
    packed = VectorAssembler(inputCols=["sales", "onpromotion"], outputCol="v").transform(rows)
    values = packed.select("id", vector_to_array("v").alias("a"))
    return values.select(
        "id", F.col("a")[0].alias("first_value"), F.col("a")[1].alias("second_value"), F.size("a").alias("n")
    )


def _calendar(weekend: str) -> str:
    return sql(
        f"""SELECT d.date, EXTRACT(DAY FROM d.date) = 15 OR d.date = LAST_DAY(d.date) AS is_payday,
        STRFTIME(d.date, '%A') AS day_of_week, DAYOFWEEK(d.date) + 1 IN ({weekend}) AS is_weekend,
        d.date BETWEEN DATE '1996-04-16' AND DATE '1996-04-16' + 50 AS is_earthquake_recovery,
        CAST(CASE WHEN d.date BETWEEN DATE '1996-04-16' AND DATE '1996-04-16' + 50
            THEN DATEDIFF('day', DATE '1996-04-16', d.date) END AS INT) AS days_since_earthquake,
        COALESCE(h.a, FALSE) AS is_national_holiday, COALESCE(h.b, FALSE) AS is_national_holiday_transferred
        FROM days d LEFT JOIN h ON d.date = h.date""",
        "holidays_events",
        days="""SELECT CAST(UNNEST(GENERATE_SERIES(MIN(CAST(l_shipdate AS DATE)), MAX(CAST(l_shipdate AS DATE)),
        INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem""",
        h="""SELECT date, BOOL_OR(NOT transferred) AS a, BOOL_OR(transferred) AS b FROM fx_holidays_events
        WHERE locale = 'National' GROUP BY date""",
    )


def _days(spark, d):
    lines = retail.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return calendar_dim.dates_between(lines, "date")


@query("c1_dim_date", _calendar("1, 7"))
def dim_date(spark, d):
    return calendar_dim.build(_days(spark, d), retail.holidays(spark, d), event_day="1996-04-16")


@query("c1_dim_date_friday_saturday", _calendar("6, 7"))
def dim_date_literal(spark, d):
    return calendar_dim.build(
        _days(spark, d), retail.holidays(spark, d), event_day="1996-04-16", weekend_days=(6, 7)
    )


@query(
    "c1_national_holidays",
    sql(
        """SELECT date FROM fx_holidays_events WHERE locale = 'National'
        AND date BETWEEN (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem) AND (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem)
        GROUP BY date HAVING BOOL_OR(NOT transferred)""",
        "holidays_events",
    ),
)
def national_holidays(spark, d):
    return dim_date(spark, d).filter("is_national_holiday IS TRUE").select("date")


@query(
    "s11_calendar_days",
    sql(
        """SELECT CAST(UNNEST(GENERATE_SERIES(MIN(CAST(l_shipdate AS DATE)), MAX(CAST(l_shipdate AS DATE)),
        INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem"""
    ),
)
def calendar_days(spark, d):
    return _days(spark, d)
