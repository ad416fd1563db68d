"""Model input: the star join, holiday flags and indicator columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators.tables import write
from millpond.session import materialise

FLAGS = {
    "national_holiday": ("National", ()),
    "regional_holiday": ("Regional", ("state",)),
    "local_holiday": ("Local", ("city",)),
}


def holiday_flags(holidays: DataFrame) -> dict[str, DataFrame]:
    """Three flag tables: by date, by date and state, by date and city.

    A transferred entry gives 0, any other 1. Several entries for one day and
    place fold into the largest flag, so the joins below multiply no sales row.
    """
    flag = F.max(F.when(F.col("transferred"), 0).otherwise(1))
    tables = {}
    for name, (locale, place) in FLAGS.items():
        keyed = holidays.filter(F.col("locale") == locale)
        keys = ["date", *[F.col("locale_name").alias(p) for p in place]]
        tables[name] = keyed.groupBy(*keys).agg(flag.alias(name))
    return tables


def model_input(
    train: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame, staged: bool = True
) -> DataFrame:
    """Sales rows with store, oil price and holiday columns.

    Left joins on unique dimension keys. The dimensions are reduced and written first (``staged``):
    the size of an aggregate is a guess, that of a file is not, so the planner broadcasts what is
    small before it has shuffled the sales, and joins by sort where a dimension has grown too large.
    """
    keep = materialise if staged else (lambda df, label: df)
    prices = keep(oil.select("date", F.col("dcoilwtico").alias("oil_price")), "oil")
    joined = train.join(keep(stores, "stores"), "store_nbr", "left").join(prices, "date", "left")
    for name, table in holiday_flags(holidays).items():
        joined = joined.join(keep(table, name), ["date", *FLAGS[name][1]], "left")
    joined = joined.fillna(0, list(FLAGS))
    return joined.withColumn("is_holiday", F.greatest(*FLAGS))


def sales_labels(train: DataFrame, stores: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """``labels`` of store columns by the number of sales rows that carry them.

    Sales are counted per store before they meet the stores, so the join sees a row per store; a
    sale whose store is unknown has no label.
    """
    counts = train.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("n"))
    values = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    pairs = counts.join(stores, "store_nbr").select("n", F.explode(F.array(*values)).alias("label"))
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for row in pairs.filter("label.value IS NOT NULL").groupBy("label").agg(F.sum("n").alias("n")).toLocalIterator():
        found[row["label"]["name"]].append((-row["n"], row["label"]["value"]))
    return {c: [value for _, value in sorted(pairs)] for c, pairs in found.items()}


def frequency_index(df: DataFrame, known: Mapping[str, Sequence[str]]) -> DataFrame:
    """``<column>_numeric``: the label's place by frequency, 0 for the most frequent; null where it has none."""
    added = {}
    for name, values in known.items():
        place = F.array_position(F.array(*[F.lit(v) for v in values]).cast("array<string>"), F.col(name).cast("string"))
        added[f"{name}_numeric"] = F.when(place > 0, (place - 1).cast("double"))
    return df.withColumns(added)


def write_modeling_input(
    train: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame, name: str, columns: Sequence[str] = ("type", "cluster")
) -> None:
    """Replace the table ``name`` by the model input, its store columns as indicators ranked by sales rows.

    A sales row of an unknown store keeps its place with all indicators 0.
    """
    known = sales_labels(train, stores, columns)
    write(one_hot(model_input(train, stores, oil, holidays), known), name, "overwrite")


def labels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Category labels per column, most frequent first, ties by label.

    Counted per column, in one aggregate over (column, value) pairs; the labels
    themselves become column names, so they all reach the driver.
    """
    values = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = df.select(F.explode(F.array(*values)).alias("label")).groupBy("label").count()
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for row in counts.filter("label.value IS NOT NULL").toLocalIterator():
        found[row["label"]["name"]].append((-row["count"], row["label"]["value"]))
    return {c: [value for _, value in sorted(pairs)] for c, pairs in found.items()}


def one_hot(df: DataFrame, known: Mapping[str, Sequence[str]], drop_last: bool = True) -> DataFrame:
    """Indicator columns ``<column>_<label>``, the source columns removed.

    Written as plain comparisons, which stay inside generated code; no vector
    is built and taken apart again. The least frequent label has no column.
    """
    columns = [F.col(c) for c in df.columns if c not in known]
    for name, values in known.items():
        kept = values[:-1] if drop_last else values
        text = F.col(name).cast("string")
        columns += [F.when(text == v, 1.0).otherwise(0.0).alias(f"{name}_{v}") for v in kept]
    return df.select(columns)
