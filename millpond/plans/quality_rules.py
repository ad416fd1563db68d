"""Data-quality rules over the retail tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators import quality
from millpond.plans.registry import query, sql
from millpond.sources import retail

# The sets and bounds the constraints are stated with. "abc" stands
# in the sample list on purpose, in the place of "Work Day".
HOLIDAY_TYPES = ("Event", "Holiday", "Transfer", "Bridge", "Additional", "abc")
STORE_TYPES = ("A", "B", "C", "D", "E")


def _one(rule: str, bad: str, table: str) -> str:
    return f"""SELECT '{rule}' AS rule, COUNT(*) AS checked, COUNT(*) FILTER (WHERE {bad}) AS failed,
    COUNT(*) FILTER (WHERE {bad}) = 0 AS success FROM {table}"""


@query("q1_not_null", sql(_one("not_null(dcoilwtico)", "dcoilwtico IS NULL", "fx_oil"), "oil"))
def q1(spark, d):
    return quality.validate(retail.oil(spark, d), [quality.not_null("dcoilwtico")])


@query(
    "q2_in_set",
    sql(
        _one("in_set(type)", "type NOT IN ('Event', 'Holiday', 'Transfer', 'Bridge', 'Additional', 'abc')", "fx_holidays_events"),
        "holidays_events",
    ),
)
def q2(spark, d):
    return quality.validate(retail.holidays(spark, d), [quality.in_set("type", HOLIDAY_TYPES)])


@query(
    "q2_unexpected_values",
    sql(
        """SELECT type, COUNT(*) AS n_rows FROM fx_holidays_events WHERE type NOT IN ('Event', 'Holiday') GROUP BY type""",
        "holidays_events",
    ),
)
def q2_values(spark, d):
    return quality.unexpected(retail.holidays(spark, d), "type", ["Event", "Holiday"])


@query("q3_check_date", sql(_one("dateWithinRange", "NOT (date >= DATE '1995-03-02')", "fx_holidays_events"), "holidays_events"))
def q3(spark, d):
    return quality.validate(
        retail.holidays(spark, d), [quality.check("dateWithinRange", "date >= DATE '1995-03-02'")]
    )


@query("q4_check_store", sql(_one("validIds", "NOT (store_nbr >= 1)", "fx_stores"), "stores"))
def q4(spark, d):
    return quality.validate(retail.stores(spark, d), [quality.check("validIds", "store_nbr >= 1")])


@query("q5_check_type", sql(_one("in_set(type)", "type NOT IN ('A', 'B', 'C', 'D', 'E')", "fx_stores"), "stores"))
def q5(spark, d):
    return quality.validate(retail.stores(spark, d), [quality.in_set("type", STORE_TYPES)])


TRAIN_RULES = [
    quality.not_null("family"),
    quality.check("cheap_enough", "sales < 60000"),
    quality.check("since_1996", "date >= DATE '1996-01-01'"),
    quality.check("store_range", "store_nbr >= 1"),
]
TRAIN_BAD = {
    "not_null(family)": "family IS NULL",
    "cheap_enough": "NOT (sales < 60000)",
    "since_1996": "NOT (date >= DATE '1996-01-01')",
    "store_range": "NOT (store_nbr >= 1)",
}


@query(
    "q6_gate_report",
    sql(" UNION ALL ".join(_one(rule, bad, "fx_train") for rule, bad in TRAIN_BAD.items()), "train"),
)
def q6(spark, d):
    return quality.validate(retail.train(spark, d), TRAIN_RULES)


@query(
    "q6_split_bad_rows",
    sql(f"SELECT * FROM fx_train WHERE {' OR '.join(TRAIN_BAD.values())}", "train"),
)
def q6_split(spark, d):
    return quality.split(retail.train(spark, d), TRAIN_RULES)[1]


@query(
    "q6_split_good_rows",
    sql(f"SELECT * FROM fx_train WHERE NOT ({' OR '.join(TRAIN_BAD.values())})", "train"),
)
def q6_good(spark, d):
    return quality.split(retail.train(spark, d), TRAIN_RULES)[0]


PROFILED = ("date", "store_nbr", "family", "sales", "onpromotion")


@query(
    "s13_profile",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null,
            COUNT(DISTINCT {c}) AS n_distinct, CAST(MIN({c}) AS VARCHAR) AS lowest, CAST(MAX({c}) AS VARCHAR) AS highest FROM t"""
            for c in PROFILED
        ),
        "train",
        t="SELECT date, store_nbr, family, CAST(sales AS DECIMAL(14,2)) AS sales, onpromotion FROM fx_train",
    ),
)
def s13(spark, d):
    rows = retail.train(spark, d).withColumn("sales", F.col("sales").cast("decimal(14,2)"))
    return quality.profile(rows.select(*PROFILED))
