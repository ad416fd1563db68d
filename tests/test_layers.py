from datetime import date

import pytest
from helpers import rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from millpond.functions.series import back_fill, lags, rolling, with_group_total
from millpond.operators import calendar_dim, changes, gold, quality, silver, tables
from millpond.schemas import SILVER, TABLES
from millpond.session import new_folder
from millpond.sources import files
from millpond.sources.synthetic import synthetic_sales

HOLIDAY = "date DATE, type STRING, locale STRING, locale_name STRING, description STRING, transferred BOOLEAN"


def day(text):
    return date.fromisoformat(text)


# -- calendar -----------------------------------------------------------------
@pytest.fixture(scope="module")
def calendar(spark):
    entries = [
        (day("2016-04-15"), "Holiday", "National", "ALL", "a", False),
        (day("2016-04-15"), "Holiday", "National", "ALL", "b", True),
        (day("2016-04-16"), "Holiday", "National", "ALL", "c", None),
        (day("2016-04-17"), "Holiday", "Local", "Q", "d", False),
    ]
    days = calendar_dim.date_range(spark, "2016-02-01", "2016-06-30")
    built = calendar_dim.build(days, spark.createDataFrame(entries, HOLIDAY))
    return {str(r["date"]): r for r in built.collect()}


def test_calendar_has_one_row_per_day(calendar):
    assert len(calendar) == 151


@pytest.mark.parametrize("text, payday", [("2016-02-15", True), ("2016-02-29", True), ("2016-02-28", False)])
def test_payday(calendar, text, payday):
    assert calendar[text].is_payday is payday


@pytest.mark.parametrize(
    "text, name, weekend", [("2016-04-15", "Friday", False), ("2016-04-16", "Saturday", True), ("2016-04-17", "Sunday", True)]
)
def test_weekday(calendar, text, name, weekend):
    assert (calendar[text].day_of_week, calendar[text].is_weekend) == (name, weekend)


def test_weekend_days_can_be_friday_and_saturday(spark):
    days = calendar_dim.date_range(spark, "2016-04-15", "2016-04-17")
    flags = calendar_dim.with_flags(days, weekend_days=(6, 7)).orderBy("date").collect()
    assert [r.is_weekend for r in flags] == [True, True, False]


@pytest.mark.parametrize("text, since", [("2016-04-15", None), ("2016-04-16", 0), ("2016-06-05", 50), ("2016-06-06", None)])
def test_recovery_period_has_both_ends(calendar, text, since):
    assert calendar[text].days_since_earthquake == since
    assert calendar[text].is_earthquake_recovery is (since is not None)


def test_two_national_entries_fold_into_one_row(calendar):
    both, unknown, local = (calendar[f"2016-04-1{n}"] for n in (5, 6, 7))
    assert (both.is_national_holiday, both.is_national_holiday_transferred) == (True, True)
    assert (unknown.is_national_holiday, unknown.is_national_holiday_transferred) == (False, False)
    assert (local.is_national_holiday, local.is_national_holiday_transferred) == (False, False)


# -- gold refresh ---------------------------------------------------------------
TRAIN = "id BIGINT, date DATE, store_nbr INT, family STRING, sales DOUBLE, onpromotion INT"


def sale(n, text, amount, store=1):
    return (n, day(text), store, "EGGS", amount, 0)


def refreshed(spark, before, after, **options):
    old, new = spark.createDataFrame(before, TRAIN), spark.createDataFrame(after, TRAIN)
    summary = gold.monthly_sales(old).withColumn("proc_dt", F.lit("2024-01-01").cast("date"))
    result = gold.refresh(
        summary,
        new,
        changes.diff(old, new, ["id"]),
        gold.monthly_sales,
        ("month_train_date", "year_train_date"),
        "2024-02-01",
        by=["store_nbr", "family"],
        **options,
    )
    return rows(
        result.select("month_train_date", F.col("total_sales").cast("double"), F.col("proc_dt").cast("string"))
    )


BEFORE = [sale(1, "1997-01-05", 10.0), sale(2, "1997-02-05", 20.0), sale(3, "1997-03-05", 30.0)]


def test_new_day_in_a_known_month_refreshes_it(spark):
    got = refreshed(spark, BEFORE, [*BEFORE, sale(4, "1997-01-06", 5.0)])
    assert got == [(1, 15.0, "2024-02-01"), (2, 20.0, "2024-01-01"), (3, 30.0, "2024-01-01")]


def test_changed_day_new_month_and_emptied_month(spark):
    after = [sale(1, "1997-01-05", 11.0), BEFORE[2], sale(5, "1997-04-01", 7.0)]
    assert refreshed(spark, BEFORE, after) == [
        (1, 11.0, "2024-02-01"),
        (3, 30.0, "2024-01-01"),
        (4, 7.0, "2024-02-01"),
    ]


def test_update_only_rule_leaves_inserted_days_out(spark):
    after = [*BEFORE, sale(4, "1997-01-06", 5.0)]
    got = refreshed(spark, BEFORE, after, update_on=["update_postimage"])
    assert got[0] == (1, 10.0, "2024-01-01")


def test_deleted_day_lowers_the_total(spark):
    before = [*BEFORE, sale(4, "1997-01-06", 5.0)]
    assert refreshed(spark, before, BEFORE)[0] == (1, 10.0, "2024-02-01")


def test_oil_average_rounds_half_up(spark):
    oil = spark.createDataFrame([(day("1997-01-01"), 1.0), (day("1997-01-02"), 1.01), (day("1997-01-03"), None)], "date DATE, oil_price DOUBLE")
    assert str(gold.monthly_oil(oil).first().oil_price) == "1.01"


# -- silver -------------------------------------------------------------------
def test_text_boolean(spark):
    df = spark.createDataFrame([("TRUE",), ("FALSE",), ("true",), ("",), (None,)], "x STRING")
    got = [r.b for r in df.select("x", silver.text_to_boolean("x").alias("b")).collect()]
    assert got == [True, False, None, None, None]


def test_one_per_key_takes_the_smallest_row(spark):
    entries = [(1, "b", 1), (1, "a", 9), (2, None, 3), (2, "z", 1)]
    df = spark.createDataFrame(entries, "k INT, x STRING, y INT")
    assert rows(silver.one_per_key(df, ("k",))) == [(1, "a", 9), (2, None, 3)]


def test_regional_holidays_drop_national_transferred_and_unknown(spark):
    entries = [
        (day("2016-01-01"), "Holiday", "Local", "Q", "a", False),
        (day("2016-01-02"), "Holiday", "Regional", "R", "b", True),
        (day("2016-01-03"), "Holiday", "National", "ALL", "c", False),
        (day("2016-01-04"), "Holiday", "Local", "Q", "d", None),
    ]
    kept = silver.regional_holidays(spark.createDataFrame(entries, HOLIDAY))
    assert [r.description for r in kept.collect()] == ["a"]


def test_every_silver_table_has_its_keys_in_the_schema():
    for name, table in SILVER.items():
        assert set(table.keys) | set(table.values) <= set(table.schema.names), name
    assert len(TABLES) == 22


# -- series -------------------------------------------------------------------
def series(spark, n, gap=None):
    values = [(1, day("2016-01-01"), float(i)) for i in range(0)]
    values = [(1, date.fromordinal(day("2016-01-01").toordinal() + i), float(i) if i != gap else None) for i in range(n)]
    return spark.createDataFrame(values, "k INT, ds DATE, y DOUBLE")


def test_rolling_is_null_until_four_values(spark):
    got = series(spark, 13).select("ds", *rolling("y", 4, ["k"], "ds"), *lags("y", [8, 12], ["k"], "ds")).orderBy("ds").collect()
    assert [r.rolling_mean_lag1_window4 for r in got[:5]] == [None, None, None, None, 1.5]
    assert (got[4].rolling_min_lag1_window4, got[4].rolling_max_lag1_window4) == (0.0, 3.0)
    assert (got[11].lag12, got[12].lag12, got[8].lag8) == (None, 0.0, 0.0)


def test_rolling_skips_windows_with_an_unknown_value(spark):
    got = series(spark, 8, gap=2).select("ds", *rolling("y", 4, ["k"], "ds")).orderBy("ds").collect()
    assert [r.rolling_mean_lag1_window4 for r in got] == [None] * 7 + [4.5]


def test_back_fill_crosses_months_and_leaves_the_tail(spark):
    entries = [
        (day("2016-01-30"), None),
        (day("2016-01-31"), None),
        (day("2016-02-10"), None),
        (day("2016-03-01"), 5.0),
        (day("2016-03-02"), None),
        (day("2016-03-03"), 6.0),
        (day("2016-04-01"), None),
    ]
    got = back_fill(spark.createDataFrame(entries, "date DATE, p DOUBLE"), "date", "p").orderBy("date").collect()
    assert [r.p for r in got] == [5.0, 5.0, 5.0, 5.0, 6.0, 6.0, None]


def test_back_fill_per_key(spark):
    entries = [(1, day("2016-01-30"), None), (2, day("2016-01-31"), 2.0), (1, day("2016-02-01"), 7.0)]
    got = rows(back_fill(spark.createDataFrame(entries, "k INT, date DATE, p DOUBLE"), "date", "p", ["k"]).select("k", "p"))
    assert got == [(1, 7.0), (1, 7.0), (2, 2.0)]


def test_group_total_beside_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 4), (None, 5)], "g STRING, x INT")
    assert rows(with_group_total(df, ["g"], "x", "t")) == sorted(
        [("a", 1, 3), ("a", 2, 3), (None, 4, 9), (None, 5, 9)], key=repr
    )


# -- quality ------------------------------------------------------------------
def test_rules_report_split_and_gate(spark):
    df = spark.createDataFrame([(1, "A"), (0, "B"), (None, None), (2, "Z")], "n INT, t STRING")
    rules = [quality.not_null("t"), quality.in_set("t", ["A", "B"]), quality.check("n >= 1", "n >= 1")]
    report = {r.rule: (r.checked, r.failed, r.success) for r in quality.validate(df, rules).collect()}
    assert report == {
        "not_null(t)": (4, 1, False),
        "in_set(t)": (4, 1, False),
        "n >= 1": (4, 1, False),
    }
    good, bad = quality.split(df, rules)
    assert rows(good) == [(1, "A")] and good.count() + bad.count() == 4
    with pytest.raises(quality.QualityError, match="n >= 1"):
        quality.enforce(df, rules)
    assert quality.enforce(good, rules) is good


def test_profile(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (3, "a")], "n INT, t STRING")
    assert rows(quality.profile(df)) == [("n", 3, 0, 2, "1", "3"), ("t", 3, 1, 2, "a", "b")]


# -- tables and files -----------------------------------------------------------
@pytest.fixture
def database(spark):
    folder = new_folder(spark, "db")
    name = "db_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, name, folder)
    return name


def test_write_modes(spark, database):
    name = f"{database}.t"
    tables.write(spark.range(2), name)
    with pytest.raises(AnalysisException):
        tables.write(spark.range(2), name)
    tables.write(spark.range(1), name, "append")
    assert spark.table(name).count() == 3
    tables.write(spark.range(5), name, "overwrite")
    assert spark.table(name).count() == 5


def test_varchar_length_is_enforced(spark, database):
    tables.create(spark, f"{database}.v", "t VARCHAR(3)")
    tables.append(spark.createDataFrame([("abc",)], "t STRING"), f"{database}.v")
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        tables.append(spark.createDataFrame([("abcd",)], "t STRING"), f"{database}.v")


def test_conform_orders_casts_and_defaults(spark):
    df = spark.createDataFrame([(2.9, "x")], "b DOUBLE, a STRING")
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("a STRING, b INT, c STRING, d STRING")
    assert rows(tables.conform(df, schema, {"c": "'dflt'"})) == [("x", 2, "dflt", None)]


def test_drop_and_replace(spark, database):
    tables.create(spark, f"{database}.t", "a INT")
    with pytest.raises(AnalysisException):
        tables.create(spark, f"{database}.t", "a INT")
    tables.create(spark, f"{database}.t", "a INT, b STRING", replace=True)
    assert spark.table(f"{database}.t").columns == ["a", "b"]


def test_views_and_name_patterns(spark, database):
    tables.create(spark, f"{database}.bronze_a", "a INT")
    tables.create(spark, f"{database}.silver_a", "a INT")
    assert [t.name for t in spark.catalog.listTables(database, "bronze*") if not t.isTemporary] == ["bronze_a"]
    spark.range(1).createTempView("only_once")
    with pytest.raises(AnalysisException):
        spark.range(1).createTempView("only_once")
    spark.range(2).createOrReplaceTempView("only_once")
    assert spark.table("only_once").count() == 2
    spark.catalog.dropTempView("only_once")


def test_csv_round_trip_and_kinds_of_schema(spark):
    path = new_folder(spark, "csv")
    files.write_csv(spark.createDataFrame([(1, day("2016-01-01"), "x,y")], "a INT, d DATE, t STRING"), path)
    assert files.read_csv(spark, path).dtypes == [("a", "int"), ("d", "date"), ("t", "string")]
    assert {t for _, t in files.read_csv(spark, path, "string").dtypes} == {"string"}
    assert rows(files.read_csv(spark, path, files.infer_schema(spark, path))) == [(1, day("2016-01-01"), "x,y")]


def test_synthetic_rows_depend_on_the_id_alone(spark):
    many = synthetic_sales(spark.range(2000).repartition(7), "id", 3, "2024-01-01")
    again = synthetic_sales(spark.range(2000).repartition(2), "id", 3, "2024-01-01")
    assert rows(many) == rows(again)
    other = synthetic_sales(spark.range(2000), "id", 4, "2024-01-01")
    assert rows(other) != rows(many)
    ends = many.agg(
        F.min("store_nbr"), F.max("store_nbr"), F.min("sales"), F.max("sales"), F.countDistinct("family"), F.avg("onpromotion"), F.countDistinct("date")
    ).first()
    assert ends[0] == 1 and ends[1] == 54 and ends[2] >= 0 and ends[3] <= 500 and ends[4] == 6 and ends[6] == 10
    assert 0.03 < ends[5] < 0.07


def test_a_clone_keeps_lengths_defaults_and_layout(spark):
    folder = new_folder(spark, "clone")
    name = "c_" + folder.rsplit("-", 1)[1]
    for db in (name, name + "_copy"):
        tables.create_database(spark, db, f"{folder}/{db}")
    tables.create(spark, f"{name}.t", "k INT, v VARCHAR(3), n INT DEFAULT 7, part STRING", partition_by=["part"])
    spark.sql(f"INSERT INTO {name}.t VALUES (1, 'ab', 3, 'x'), (2, 'c', 4, 'y')")
    for _ in range(2):  # a second clone replaces the first
        assert tables.clone_all(spark, name, name + "_copy") == ["t"]
    copy = f"{name}_copy.t"
    assert rows(spark.table(copy)) == [(1, "ab", 3, "x"), (2, "c", 4, "y")]
    assert [c.name for c in spark.catalog.listColumns(copy) if c.isPartition] == ["part"]
    spark.sql(f"INSERT INTO {copy} (k, v, part) VALUES (3, 'd', 'x')")
    assert (3, "d", 7, "x") in rows(spark.table(copy))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {copy} (k, v, part) VALUES (3, 'long', 'x')")
