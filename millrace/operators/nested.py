"""Structs, arrays, maps and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import collect_chunks


def flatten(df: DataFrame, paths: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Struct fields as columns: ``{"address.city": "city"}``.  A NULL struct gives NULLs."""
    kept = [c for c in df.columns if c not in {p.split(".")[0] for p in paths}] if keep is None else keep
    return df.select(*kept, *[F.col(p).alias(a) for p, a in paths.items()])


def explode_rows(df: DataFrame, column: str, alias: str, outer: bool = True) -> DataFrame:
    """One row per array element; with ``outer`` an empty or NULL array gives one NULL row."""
    items = F.explode_outer(column) if outer else F.explode(column)
    return df.withColumn(alias, items) if alias == column else df.withColumn(alias, items).drop(column)


def parse_json_column(df: DataFrame, column: str, schema: str, fields: dict[str, str]) -> DataFrame:
    """Typed fields of a JSON text column; text that is not JSON gives NULL fields."""
    parsed = F.from_json(column, schema)
    return df.withColumn("_json", parsed).select(
        *df.columns, *[F.col(f"_json.{p}").alias(a) for p, a in fields.items()]
    )


def map_summary(df: DataFrame, column: str, lookups: list[str], size_as: str, keys_as: str) -> DataFrame:
    """Sorted keys, number of entries and chosen values of a map; a missing key gives NULL."""
    return df.withColumns(
        {keys_as: F.sort_array(F.map_keys(column)), size_as: F.size(column)}
        | {k: F.try_element_at(column, F.lit(k)) for k in lookups}
    )


def map_and_filter(df: DataFrame, column: str, change, keep) -> DataFrame:
    """Filter the elements of an array, then change each of the rest, in place."""
    return df.withColumn(column, F.transform(F.filter(column, keep), change))


def flatten_orders(df: DataFrame, ids: list[str], orders: str, items: str) -> DataFrame:
    """One row per item of an array of orders that each hold an array of items.

    Rows without orders give nothing; orders without items give nothing."""
    one = df.withColumn("_o", F.explode(orders)).select(*ids, "_o")
    two = one.withColumn("_i", F.explode(f"_o.{items}"))
    order_fields = [f.name for f in one.schema["_o"].dataType.fields if f.name != items]
    item_fields = [f.name for f in two.schema["_i"].dataType.fields]
    return two.where("_i is not null").select(
        *ids, *[F.col(f"_o.{f}") for f in order_fields], *[F.col(f"_i.{f}") for f in item_fields]
    )


def nest(
    df: DataFrame, keys: list[str], head: dict[str, list[str]], items: list[str], order: list[str], name: str, **size
) -> DataFrame:
    """One row per key with structs of constant columns and an array of item structs.

    ``head`` maps a struct name to columns that are constant per key.  A key
    with very many items continues in further rows, see ``collect_chunks``."""
    constant = [c for columns in head.values() for c in columns]
    out = collect_chunks(df, keys + constant, order, F.struct(*items), name, **size)
    return out.select(
        *keys, *[F.struct(*columns).alias(s) for s, columns in head.items()], "chunk", name
    )


def items_summary(
    orders: DataFrame, items: DataFrame, key: str, quantity: str, price: Column, name: str = "items_summary"
) -> DataFrame:
    """Orders with a struct of their item count and value; zeros when an order has no items."""
    totals = items.groupBy(key).agg(
        F.sum(quantity).cast("bigint").alias("_items"), F.sum(price).cast("double").alias("_value")
    )
    return orders.join(totals, key, "left").withColumn(
        name,
        F.struct(
            F.coalesce("_items", F.lit(0)).alias("total_items"),
            F.coalesce("_value", F.lit(0.0)).alias("total_value"),
        ),
    ).drop("_items", "_value")
