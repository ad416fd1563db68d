"""Change rows, merges, surrogate keys and history tables on two states of the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators import changes, keys, merge, scd2
from millpond.operators.gold import monthly_sales
from millpond.operators.silver import one_per_key
from millpond.operators.tables import Lake
from millpond.plans.aggregates import MONTHLY_SALES
from millpond.plans.registry import query, sql
from millpond.session import new_folder
from millpond.sources import retail

TRAIN_KEYS = ["date", "store_nbr", "family"]
TRAIN = "id, date, store_nbr, family, sales, onpromotion"
STORE = "store_nbr, city, state, type, cluster"


def _pre(columns: str, alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in columns.split(","))


def diff_sql(columns: str, old: str, new: str, on: list[str], values: list[str], deletes: bool = True) -> str:
    """Change rows between two states as a union of four selects."""
    match = " AND ".join(f"a.{k} = b.{k}" for k in on)
    changed = " OR ".join(f"a.{v} IS DISTINCT FROM b.{v}" for v in values)
    gone = f"""UNION ALL SELECT {_pre(columns, "a")}, 'delete' FROM {old} a LEFT JOIN {new} b ON {match}
    WHERE b.{on[0]} IS NULL"""
    return f"""SELECT {_pre(columns, "b")}, 'insert' AS _change_type FROM {new} b LEFT JOIN {old} a ON {match}
    WHERE a.{on[0]} IS NULL {gone if deletes else ""}
    UNION ALL SELECT {_pre(columns, "a")}, 'update_preimage' FROM {old} a JOIN {new} b ON {match} WHERE {changed}
    UNION ALL SELECT {_pre(columns, "b")}, 'update_postimage' FROM {old} a JOIN {new} b ON {match} WHERE {changed}"""


TRAIN_DIFF = diff_sql(TRAIN, "fx_train_v1", "fx_train_v2", ["id"], ["sales"])
STORE_DIFF = diff_sql(STORE, "fx_stores_v1", "fx_stores_v2", ["store_nbr"], ["type"])
STORE_BACK = diff_sql(STORE, "fx_stores_v2", "fx_stores_v1", ["store_nbr"], ["type"])


def logged(rows, label):
    """Change rows as jobs meet them: written to a log, read back from their version on."""
    path = new_folder(rows.sparkSession, label)
    changes.append(rows, path, 2, "2024-02-01")
    return changes.read(rows.sparkSession, path, 2)


def train_changes(spark, d):
    rows = changes.diff(retail.train_v1(spark, d), retail.train_v2(spark, d), TRAIN_KEYS)
    return logged(rows, "train-log")


def store_changes(spark, d):
    rows = changes.diff(retail.stores_v1(spark, d), retail.stores_v2(spark, d), ["store_nbr"])
    return logged(rows, "store-log")


# -- change rows --------------------------------------------------------------
@query("f1_diff_train", sql(TRAIN_DIFF, "train_v1", "train_v2"))
def f1_train(spark, d):
    return changes.diff(retail.train_v1(spark, d), retail.train_v2(spark, d), TRAIN_KEYS)


@query("f1_diff_stores", sql(STORE_DIFF, "stores_v1", "stores_v2"))
def f1_stores(spark, d):
    return changes.diff(retail.stores_v1(spark, d), retail.stores_v2(spark, d), ["store_nbr"], unique=True)


@query("f1_apply_changes", sql("SELECT * FROM fx_train_v2", "train_v2"))
def f1_apply(spark, d):
    return changes.apply(retail.train_v1(spark, d), train_changes(spark, d), TRAIN_KEYS)


def store_log(spark, d):
    """Version 1 loads the first state, 2 changes it to the second, 3 changes it back."""
    path = new_folder(spark, "store-log")
    first, second = retail.stores_v1(spark, d), retail.stores_v2(spark, d)
    changes.append(first.withColumn("_change_type", F.lit("insert")), path, 1, "2024-01-01")
    changes.append(changes.diff(first, second, ["store_nbr"]), path, 2, "2024-01-02")
    changes.append(changes.diff(second, first, ["store_nbr"]), path, 3, "2024-01-03")
    return path


LOG_2 = f"SELECT *, CAST(2 AS BIGINT) AS _commit_version, DATE '2024-01-02' AS commit_day FROM ({STORE_DIFF}) x"
LOG_3 = f"SELECT *, CAST(3 AS BIGINT) AS _commit_version, DATE '2024-01-03' AS commit_day FROM ({STORE_BACK}) y"


def _with_day(log):
    return log.withColumn("commit_day", F.to_date("_commit_timestamp")).drop("_commit_timestamp")


@query("f2_changes_from_version", sql(f"{LOG_2} UNION ALL {LOG_3}", "stores_v1", "stores_v2"))
def f2_from(spark, d):
    return _with_day(changes.read(spark, store_log(spark, d), 2))


@query("f2_changes_between_versions", sql(LOG_2, "stores_v1", "stores_v2"))
def f2_between(spark, d):
    return _with_day(changes.read(spark, store_log(spark, d), 2, 2))


@query("p13_changes_of_day", sql(LOG_3, "stores_v1", "stores_v2"))
def p13_changes(spark, d):
    log = changes.read(spark, store_log(spark, d), 0)
    return _with_day(log.filter(F.to_date("_commit_timestamp") == F.lit("2024-01-03").cast("date")))


def _versions(spark, d) -> tuple[Lake, str]:
    lake = Lake(spark, new_folder(spark, "lake"))
    old, new = retail.stores_v1(spark, d), retail.stores_v2(spark, d)
    lake.create("stores", old.schema, "2024-01-01")
    lake.commit("stores", old.withColumn("_change_type", F.lit("insert")), ["store_nbr"], "2024-01-01")
    lake.commit("stores", changes.diff(lake.read("stores"), new, ["store_nbr"]), ["store_nbr"], "2024-01-02")
    return lake, "stores"


@query(
    "f3_snapshot_versions",
    sql(
        "SELECT 1 AS version, * FROM fx_stores_v1 UNION ALL SELECT 2, * FROM fx_stores_v2",
        "stores_v1",
        "stores_v2",
    ),
)
def f3(spark, d):
    lake, name = _versions(spark, d)
    parts = [lake.read(name, v).select(F.lit(v).alias("version"), "*") for v in (1, 2)]
    return lake.read(name, 0).select(F.lit(0).alias("version"), "*").unionByName(parts[0]).unionByName(parts[1])


@query(
    "k18_history",
    sql(
        f"""SELECT _commit_version, COUNT(*) FILTER (_change_type = 'insert') AS insert,
        COUNT(*) FILTER (_change_type = 'update_preimage') AS update_preimage,
        COUNT(*) FILTER (_change_type = 'update_postimage') AS update_postimage,
        COUNT(*) FILTER (_change_type = 'delete') AS delete
        FROM (SELECT _commit_version, _change_type FROM ({LOG_2}) p UNION ALL
        SELECT CAST(1 AS BIGINT), 'insert' FROM fx_stores_v1) z GROUP BY _commit_version""",
        "stores_v1",
        "stores_v2",
    ),
)
def k18(spark, d):
    lake, name = _versions(spark, d)
    return lake.history(name)


# -- merges -------------------------------------------------------------------
@query(
    "f4_merge_upsert",
    sql(
        """SELECT COALESCE(a.id, b.id) AS id, COALESCE(a.date, b.date) AS date, COALESCE(a.store_nbr, b.store_nbr) AS store_nbr,
        COALESCE(a.family, b.family) AS family, CASE WHEN b.id IS NOT NULL THEN b.sales ELSE a.sales END AS sales,
        CASE WHEN b.id IS NOT NULL THEN b.onpromotion ELSE a.onpromotion END AS onpromotion
        FROM fx_train_v1 a FULL JOIN fx_train_v2 b ON a.date = b.date AND a.store_nbr = b.store_nbr AND a.family = b.family""",
        "train_v1",
        "train_v2",
    ),
)
def f4(spark, d):
    return merge.merge(
        retail.train_v1(spark, d),
        retail.train_v2(spark, d),
        TRAIN_KEYS,
        matched=[merge.update({"sales": "s.sales", "onpromotion": "s.onpromotion"})],
        not_matched=[merge.insert_all()],
        staged=True,
    )


@query(
    "f4_merge_change_rows",
    sql(
        diff_sql(TRAIN, "fx_train_v1", "fx_train_v2", ["id"], ["sales"], deletes=False), "train_v1", "train_v2"
    ),
)
def f4_changes(spark, d):
    return merge.merge_changes(
        retail.train_v1(spark, d),
        retail.train_v2(spark, d),
        TRAIN_KEYS,
        matched=[merge.update_all()],
        not_matched=[merge.insert_all()],
        staged=True,
    )


@query(
    "f4_merge_null_keys",
    sql(
        """SELECT a.date, CASE WHEN b.date IS NOT NULL THEN b.dcoilwtico ELSE a.dcoilwtico END AS dcoilwtico
        FROM fx_oil a LEFT JOIN s b ON a.date = b.date
        UNION ALL SELECT s.date, s.dcoilwtico FROM s WHERE s.date IS NULL""",
        "oil",
        s="SELECT CASE WHEN DAY(date) % 5 <> 0 THEN date END AS date, dcoilwtico + 1 AS dcoilwtico FROM fx_oil",
    ),
)
def f4_null_keys(spark, d):
    """A null key matches nothing, so such rows are inserted."""
    oil = retail.oil(spark, d)
    day = F.when(F.dayofmonth("date") % 5 != 0, F.col("date"))
    source = oil.select(day.alias("date"), (F.col("dcoilwtico") + 1).alias("dcoilwtico"))
    return merge.merge(oil, source, ["date"], [merge.update_all()], [merge.insert_all()])


@query(
    "f5_merge_star",
    sql(
        """SELECT * FROM fx_stores_v2 UNION ALL SELECT a.* FROM fx_stores_v1 a
        WHERE NOT EXISTS (SELECT 1 FROM fx_stores_v2 b WHERE a.store_nbr = b.store_nbr)""",
        "stores_v1",
        "stores_v2",
    ),
)
def f5(spark, d):
    return merge.merge(
        retail.stores_v1(spark, d),
        retail.stores_v2(spark, d),
        ["store_nbr"],
        [merge.update_all()],
        [merge.insert_all()],
    )


MONTH_KEYS = ["store_nbr", "family", "month_train_date", "year_train_date"]
MONTH_MATCH = " AND ".join(f"a.{k} = b.{k}" for k in MONTH_KEYS)
KIND = "CASE WHEN month_train_date % 3 = 0 THEN 'update_postimage' WHEN month_train_date % 3 = 1 THEN 'delete' ELSE 'insert' END"
G1 = f"SELECT *, DATE '2024-01-01' AS proc_dt FROM ({MONTHLY_SALES.format(t='fx_train_v1')}) x"
G2 = f"SELECT *, {KIND} AS kind FROM ({MONTHLY_SALES.format(t='fx_train_v2')}) x"


def _gold(spark, d):
    totals = monthly_sales(retail.train_v1(spark, d))
    return totals.select("*", F.lit("2024-01-01").cast("date").alias("proc_dt"))


def _kinds(spark, d):
    return monthly_sales(retail.train_v2(spark, d)).withColumn("kind", F.expr(KIND))


def _double(df):
    return df.withColumn("total_sales", F.col("total_sales").cast("double"))


NEW_TOTAL = {"total_sales": "s.total_sales", "proc_dt": "DATE '2024-02-01'"}
KEY_VALUES = {k: f"s.{k}" for k in MONTH_KEYS}


@query(
    "f6_merge_conditional",
    sql(
        f"""SELECT {", ".join(f"COALESCE(a.{k}, b.{k}) AS {k}" for k in MONTH_KEYS)},
        CASE WHEN a.store_nbr IS NULL OR b.kind = 'update_postimage' THEN b.total_sales ELSE a.total_sales END AS total_sales,
        CASE WHEN a.store_nbr IS NULL OR b.kind = 'update_postimage' THEN DATE '2024-02-01' ELSE a.proc_dt END AS proc_dt
        FROM g1 a FULL JOIN g2 b ON {MONTH_MATCH}""",
        "train_v1",
        "train_v2",
        g1=G1,
        g2=G2,
    ),
)
def f6(spark, d):
    merged = merge.merge(
        _gold(spark, d),
        _kinds(spark, d),
        MONTH_KEYS,
        matched=[merge.update(NEW_TOTAL, when="s.kind = 'update_postimage'")],
        not_matched=[merge.insert(KEY_VALUES | NEW_TOTAL)],
        staged=True,
    )
    return _double(merged)


@query(
    "f9_merge_with_delete",
    sql(
        f"""SELECT {", ".join(f"COALESCE(a.{k}, b.{k}) AS {k}" for k in MONTH_KEYS)},
        CASE WHEN a.store_nbr IS NULL OR b.kind = 'update_postimage' THEN b.total_sales ELSE a.total_sales END AS total_sales,
        CASE WHEN a.store_nbr IS NULL OR b.kind = 'update_postimage' THEN DATE '2024-02-01' ELSE a.proc_dt END AS proc_dt
        FROM g1 a FULL JOIN g2 b ON {MONTH_MATCH} WHERE a.store_nbr IS NULL OR b.kind IS NULL OR b.kind <> 'delete'""",
        "train_v1",
        "train_v2",
        g1=G1,
        g2=G2,
    ),
)
def f9(spark, d):
    merged = merge.merge(
        _gold(spark, d),
        _kinds(spark, d),
        MONTH_KEYS,
        matched=[
            merge.update(NEW_TOTAL, when="s.kind = 'update_postimage'"),
            merge.delete(when="s.kind = 'delete'"),
        ],
        not_matched=[merge.insert(KEY_VALUES | NEW_TOTAL)],
        staged=True,
    )
    return _double(merged)


# -- surrogate keys -----------------------------------------------------------
@query(
    "f7_surrogate_keys",
    sql(
        """SELECT ROW_NUMBER() OVER (ORDER BY date, type, locale, locale_name) AS id, date, type, locale, locale_name
        FROM (SELECT DISTINCT date, type, locale, locale_name FROM fx_holidays_events) h""",
        "holidays_events",
    ),
)
def f7(spark, d):
    names = ["date", "type", "locale", "locale_name"]
    return keys.assign(retail.holidays(spark, d).select(names).distinct(), None, "id", names)


OLD_DIM = """SELECT ROW_NUMBER() OVER (ORDER BY family) AS product_family_nbr, family FROM
(SELECT DISTINCT family FROM fx_train WHERE family < 'M') u"""


@query(
    "f8_insert_unseen",
    sql(
        """SELECT * FROM dim UNION ALL SELECT (SELECT MAX(product_family_nbr) FROM dim) + ROW_NUMBER() OVER (ORDER BY family),
        family FROM (SELECT DISTINCT family FROM fx_train WHERE family NOT IN (SELECT family FROM dim)) n""",
        "train",
        dim=OLD_DIM,
    ),
)
def f8(spark, d):
    families = retail.train(spark, d).select("family")
    early = families.filter(F.col("family") < "M").distinct()
    dim = keys.assign(early, None, "product_family_nbr", ["family"])
    return keys.insert_unseen(dim, families, "product_family_nbr", "family")


# -- updates and deletes ------------------------------------------------------
@query(
    "f12_update_where",
    sql(
        "SELECT store_nbr, city, state, CASE WHEN cluster > 10 THEN 'X' ELSE type END AS type, cluster FROM fx_stores",
        "stores",
    ),
)
def f12(spark, d):
    return merge.update_where(retail.stores(spark, d), "cluster > 10", {"type": "'X'"})


@query(
    "f12_update_in_subquery",
    sql(
        """SELECT store_nbr, city, state, CASE WHEN store_nbr IN (SELECT store_nbr FROM fx_stores_v1 WHERE store_nbr NOT IN
        (SELECT store_nbr FROM fx_stores_v2)) THEN 'X' ELSE type END AS type, cluster FROM fx_stores_v1""",
        "stores_v1",
        "stores_v2",
    ),
)
def f12_in(spark, d):
    gone = store_changes(spark, d).filter(F.col("_change_type") == "delete")
    return merge.update_in(retail.stores_v1(spark, d), gone, ["store_nbr"], {"type": "'X'"})


@query(
    "f13_delete_where",
    sql("SELECT * FROM fx_oil WHERE NOT COALESCE(dcoilwtico > 30, FALSE)", "oil"),
)
def f13(spark, d):
    return merge.delete_where(retail.oil(spark, d), "dcoilwtico > 30")


# -- history tables -----------------------------------------------------------
def _history(columns: str, table: str, active: str, until: str, day: str) -> str:
    return f"SELECT {columns}, '{active}' AS active_ind, DATE '{until}' AS expiry_timestmp, DATE '{day}' AS proc_dt FROM {table}"


def _opened_gold(state, key_columns):
    return scd2.first_load(state.withColumn("_change_type", F.lit("insert")), key_columns, "2024-01-01")


CLOSED = "SELECT store_nbr FROM ch WHERE _change_type IN ('update_preimage', 'delete')"
OPENED = "(SELECT * FROM ch WHERE _change_type IN ('insert', 'update_postimage')) o"


@query(
    "f10_scd2_stores",
    sql(
        f"""{_history(STORE, f"fx_stores_v1 WHERE store_nbr IN ({CLOSED})", "N", "2024-02-01", "2024-02-01")} UNION ALL
        {_history(STORE, f"fx_stores_v1 WHERE store_nbr NOT IN ({CLOSED})", "Y", "9999-12-31", "2024-01-01")} UNION ALL
        {_history(STORE, OPENED, "Y", "9999-12-31", "2024-02-01")}""",
        "stores_v1",
        "stores_v2",
        ch=STORE_DIFF,
    ),
)
def f10(spark, d):
    gold = _opened_gold(retail.stores_v1(spark, d), ["store_nbr"])
    return scd2.apply(gold, store_changes(spark, d), ["store_nbr"], "2024-02-01")


@query(
    "f10_scd2_two_versions",
    sql(
        f"""{_history(STORE, f"fx_stores_v1 WHERE store_nbr IN ({CLOSED})", "N", "2024-02-01", "2024-02-01")} UNION ALL
        {_history(STORE, f"fx_stores_v1 WHERE store_nbr NOT IN ({CLOSED})", "Y", "9999-12-31", "2024-01-01")} UNION ALL
        {_history(STORE, OPENED, "N", "2024-02-01", "2024-02-01")} UNION ALL
        {_history(STORE, "(SELECT * FROM back WHERE _change_type IN ('insert', 'update_postimage')) o", "Y", "9999-12-31", "2024-02-01")}""",
        "stores_v1",
        "stores_v2",
        ch=STORE_DIFF,
        back=STORE_BACK,
    ),
)
def f10_two(spark, d):
    """One run over two commits: what the first opened, the second closes."""
    gold = _opened_gold(retail.stores_v1(spark, d), ["store_nbr"])
    rows = changes.read(spark, store_log(spark, d), 2)
    return scd2.apply(gold, rows, ["store_nbr"], "2024-02-01")


@query(
    "f10_scd2_first_load",
    sql(
        f"""{_history(STORE, f"fx_stores_v1 WHERE store_nbr IN ({CLOSED})", "N", "2024-02-01", "2024-02-01")} UNION ALL
        {_history(STORE, "fx_stores_v2", "Y", "9999-12-31", "2024-02-01")}""",
        "stores_v1",
        "stores_v2",
        ch=STORE_DIFF,
    ),
)
def f10_first(spark, d):
    """The whole feed from version 0 in one run, updates and deletes included."""
    rows = changes.read(spark, store_log(spark, d), 0, 2)
    return scd2.first_load(rows, ["store_nbr"], "2024-02-01")


HOLIDAY_KEYS = ["date", "type", "locale", "locale_name"]
HOLIDAY = "date, type, locale, locale_name, description, transferred"
H0 = """SELECT date, type, locale, locale_name, description, transferred FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date,
type, locale, locale_name ORDER BY description) AS rn FROM fx_holidays_events) q WHERE rn = 1"""
H1 = "SELECT * FROM h0 WHERE DAY(date) % 10 <> 0"
H2 = """SELECT date, type, locale, locale_name, description, CASE WHEN DAY(date) % 7 = 0 THEN NOT transferred ELSE transferred END
AS transferred FROM h0 WHERE DAY(date) % 11 <> 0"""


def holiday_states(spark, d):
    base = one_per_key(retail.holidays(spark, d), tuple(HOLIDAY_KEYS))
    day = F.dayofmonth("date")
    flipped = F.when(day % 7 == 0, ~F.col("transferred")).otherwise(F.col("transferred"))
    return base.filter(day % 10 != 0), base.withColumn("transferred", flipped).filter(day % 11 != 0)


HOLIDAY_CLOSED = """EXISTS (SELECT 1 FROM ch WHERE _change_type IN ('update_preimage', 'delete') AND ch.date = h1.date
AND ch.type = h1.type AND ch.locale = h1.locale AND ch.locale_name = h1.locale_name)"""


@query(
    "f10_scd2_holidays",
    sql(
        f"""{_history(HOLIDAY, f"h1 WHERE {HOLIDAY_CLOSED}", "N", "2024-02-01", "2024-02-01")} UNION ALL
        {_history(HOLIDAY, f"h1 WHERE NOT {HOLIDAY_CLOSED}", "Y", "9999-12-31", "2024-01-01")} UNION ALL
        {_history(HOLIDAY, OPENED, "Y", "9999-12-31", "2024-02-01")}""",
        "holidays_events",
        h0=H0,
        h1=H1,
        h2=H2,
        ch=diff_sql(HOLIDAY, "h1", "h2", HOLIDAY_KEYS, ["transferred"]),
    ),
)
def f10_holidays(spark, d):
    before, after = holiday_states(spark, d)
    gold = _opened_gold(before, HOLIDAY_KEYS)
    rows = logged(changes.diff(before, after, HOLIDAY_KEYS, unique=True), "holiday-log")
    return scd2.apply(gold, rows, HOLIDAY_KEYS, "2024-02-01")


@query(
    "f11_scd2_with_stat",
    sql(
        f"""SELECT {_pre(STORE, "a")}, CASE WHEN c.k IS NULL THEN 'Y' ELSE 'N' END AS active_ind,
        CASE WHEN c.k IS NULL THEN DATE '9999-12-31' ELSE DATE '2024-02-01' END AS expiry_timestmp,
        CASE WHEN c.k IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS proc_dt,
        CASE WHEN c.k IS NULL THEN 'update_preimage' WHEN c.k = 'delete' THEN '2024-02-01' ELSE 'inactive' END AS stat
        FROM fx_stores_v1 a LEFT JOIN (SELECT store_nbr, _change_type AS k FROM ch WHERE _change_type IN
        ('update_preimage', 'delete')) c ON a.store_nbr = c.store_nbr
        UNION ALL SELECT {STORE}, 'Y', DATE '9999-12-31', DATE '2024-02-01', 'update_preimage' FROM {OPENED}""",
        "stores_v1",
        "stores_v2",
        ch=STORE_DIFF,
    ),
)
def f11(spark, d):
    opened = retail.stores_v1(spark, d).withColumn("_change_type", F.lit("insert"))
    gold = scd2.first_load(opened, ["store_nbr"], "2024-01-01", with_stat=True)
    return scd2.apply(gold, store_changes(spark, d), ["store_nbr"], "2024-02-01", with_stat=True)
