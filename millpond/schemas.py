"""Table schemas and merge keys of the layers, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    ddl: str
    keys: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    identity: str | None = None
    partition_by: str | None = None
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


HOLIDAY = "date DATE, type STRING, locale STRING, locale_name STRING, description STRING, transferred BOOLEAN"
STORE = "store_nbr INT, city STRING, state STRING, type STRING, cluster INT"
HISTORY = "active_ind STRING, expiry_timestmp DATE, proc_dt DATE"

# Table and column names users of the layered model rely on.
BRONZE = {
    "bronze_train": Table(
        "id BIGINT, date DATE, store_nbr INT, family STRING, sales DOUBLE, onpromotion INT"
    ),
    "bronze_stores": Table(STORE),
    "bronze_holidays_events": Table(HOLIDAY),
    "bronze_oil_prices": Table("date DATE, dcoilwtico DOUBLE"),
    "bronze_transactions": Table("date DATE, store_nbr INT, transactions INT"),
}

SILVER = {
    "silver_dim_product_family": Table(
        "product_family_nbr BIGINT, family STRING", keys=("family",), identity="product_family_nbr"
    ),
    "silver_fact_sales": Table(
        "id BIGINT, date DATE, store_nbr INT, product_family_nbr BIGINT, sales DECIMAL(14,2), onpromotion INT",
        keys=("date", "store_nbr", "product_family_nbr"),
        values=("sales", "onpromotion"),
        partition_by="trunc(date, 'month')",
    ),
    "silver_fact_train": Table(
        "id BIGINT, date DATE, store_nbr INT, family STRING, sales DECIMAL(14,2), onpromotion INT",
        keys=("date", "store_nbr", "family"),
        values=("sales", "onpromotion"),
        partition_by="trunc(date, 'month')",
    ),
    "silver_dim_store": Table(
        "id BIGINT, " + STORE,
        keys=("store_nbr", "city", "state"),
        values=("type", "cluster"),
        identity="id",
    ),
    "silver_dim_date": Table(
        "date DATE, is_payday BOOLEAN, day_of_week STRING, is_weekend BOOLEAN, "
        "is_earthquake_recovery BOOLEAN, days_since_earthquake INT, "
        "is_national_holiday BOOLEAN, is_national_holiday_transferred BOOLEAN",
        keys=("date",),
        values=(
            "is_payday",
            "day_of_week",
            "is_weekend",
            "is_earthquake_recovery",
            "days_since_earthquake",
            "is_national_holiday",
            "is_national_holiday_transferred",
        ),
    ),
    "silver_dim_regional_holiday": Table(
        HOLIDAY,
        keys=("date", "type", "locale", "locale_name"),
        values=("description", "transferred"),
    ),
    "silver_dim_holidays_events": Table(
        "id BIGINT, " + HOLIDAY,
        keys=("date", "type", "locale", "locale_name", "description", "transferred"),
        values=("description", "transferred"),
        identity="id",
    ),
    "silver_dim_transactions": Table(
        "id BIGINT, date DATE, store_nbr INT, transactions INT",
        keys=("date", "store_nbr"),
        values=("transactions",),
        identity="id",
        partition_by="trunc(date, 'month')",
    ),
    "silver_dim_oil_prices": Table(
        "id BIGINT, date DATE, oil_price DECIMAL(14,2)",
        keys=("date",),
        values=("oil_price",),
        identity="id",
    ),
}

GOLD = {
    "gold_sales_dtls": Table(
        "store_nbr INT, family STRING, month_train_date INT, year_train_date INT, "
        "total_sales DECIMAL(24,2), proc_dt DATE",
        keys=("store_nbr", "family", "month_train_date", "year_train_date"),
        values=("total_sales",),
    ),
    "gold_oil_price_dtls": Table(
        "month_oil_price INT, year_oil_price INT, oil_price DECIMAL(14,2), proc_dt DATE",
        keys=("month_oil_price", "year_oil_price"),
        values=("oil_price",),
    ),
    "gold_transactions_dtls": Table(
        "store_nbr INT, month_transactions_date INT, year_transactions_date INT, "
        "total_transactions BIGINT, proc_dt DATE",
        keys=("store_nbr", "month_transactions_date", "year_transactions_date"),
        values=("total_transactions",),
    ),
    "gold_stores_dtls": Table(f"{STORE}, {HISTORY}", keys=("store_nbr",)),
    "gold_holiday_events_dtls": Table(
        f"{HOLIDAY}, {HISTORY}", keys=("date", "type", "locale", "locale_name")
    ),
    "gold_store_products_dtls": Table(
        "store_nbr INT, family STRING, city STRING, state STRING, type STRING, cluster INT"
    ),
}

ML = {
    "prediction_results": Table(
        "ds DATE, series_id STRING, prediction DOUBLE, features STRING, prediction_date TIMESTAMP",
        defaults={"prediction_date": "current_timestamp()"},
    ),
    "prediction_log": Table(
        "model_name STRING, status BOOLEAN, rmse DOUBLE, error_msg STRING, prediction_date TIMESTAMP",
        defaults={"prediction_date": "current_timestamp()"},
    ),
}

TABLES = BRONZE | SILVER | GOLD | ML
