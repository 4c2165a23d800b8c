"""Clickstream and sales questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import words
from tidemark.functions.times import weekday_label


def revenue_by_source(
    sales: DataFrame, users: DataFrame, key: str, source: str, revenue: str, k: int = 3
) -> DataFrame:
    """Total and mean revenue of the ``k`` best sources, a source being a property of the user.

    Sales are added up per user before the join, so the exchange carries one row
    per user and task, and a user with very many sales is no hot join key.
    """
    per_user = (
        sales.filter(F.col(revenue).isNotNull())
        .groupBy(key)
        .agg(F.sum(revenue).alias("_sum"), F.count(revenue).alias("_n"))
    )
    return (
        per_user.join(users.select(key, source), key)
        .groupBy(source)
        .agg(F.sum("_sum").alias("total_rev"), (F.sum("_sum") / F.sum("_n")).alias("avg_rev"))
        .orderBy(F.desc("total_rev"), source)
        .limit(k)
    )


def daily_active_users(events: DataFrame, time: str, user: str, exact: bool = True) -> DataFrame:
    """Distinct users per day; the approximate form keeps one small sketch per day.

    The exact form first groups by day and user, so no task holds all of a day's users.
    """
    day = F.to_date(time).alias("day")
    users = F.count_distinct(user) if exact else F.approx_count_distinct(user)
    return events.groupBy(day).agg(users.alias("active_users"))


def weekday_active_users(events: DataFrame, time: str, user: str, exact: bool = True) -> DataFrame:
    """Mean of the daily active users by weekday, Monday first."""
    label = weekday_label(F.date_format("day", "E")).alias("weekday")
    return (
        daily_active_users(events, time, user, exact)
        .groupBy(label)
        .agg(F.avg("active_users").alias("avg_users"))
        .orderBy("weekday")
    )


def abandoned_items(
    cart_items: DataFrame, purchases: DataFrame, cart: Sequence[str], item: str
) -> DataFrame:
    """How many abandoned carts hold each item.

    ``cart`` names the columns identifying one cart; a cart with a row in
    ``purchases`` was converted. Each (cart, item) pair counts once. Pairs stay
    rows throughout, so no cart is ever collected into one array.
    """
    pairs = cart_items.select(*cart, item).distinct()
    bought = purchases.select(*cart).distinct()
    left = pairs.join(bought, list(cart), "left_anti")
    return left.groupBy(item).agg(F.count(F.lit(1)).alias("n_carts"))


def product_options(
    products: DataFrame, name: str, family: str, quality_position: int, size_position: int
) -> DataFrame:
    """Size and quality words of the products whose name contains ``family``.

    Works on the product table, before it is joined to what was bought.
    """
    detailed = products.withColumn("details", words(F.col(name)))
    return (
        detailed.filter(F.array_contains("details", family))
        .withColumn("size", F.try_element_at("details", F.lit(size_position)))
        .withColumn("quality", F.try_element_at("details", F.lit(quality_position)))
        .drop("details")
    )


def options_per_customer(
    items: DataFrame, orders: DataFrame, order_key: str, customer: str
) -> DataFrame:
    """Sorted size and quality sets per customer.

    ``items`` holds (order key, size, quality), ``orders`` one row per order with
    its customer. Options are made distinct per order and again per customer by
    hashing, before anything is collected: an order or customer with very many
    items then brings a few rows to its task. (``collect_list`` because Spark
    drops a distinct in front of ``collect_set``, which would then see all rows.)
    """
    per_order = items.select(order_key, "size", "quality").distinct()
    bought = per_order.join(orders.select(order_key, customer), order_key)
    options = bought.select(customer, "size", "quality").distinct()
    return options.groupBy(customer).agg(
        *[
            F.array_sort(F.array_distinct(F.collect_list(c))).alias(f"{c}_options")
            for c in ("size", "quality")
        ]
    )


def converted_flags(users: DataFrame, buyers: DataFrame, key: str) -> DataFrame:
    """All users and buyers with a ``converted`` flag; rows without the key are dropped.

    They are dropped before the join: null keys would all meet in one task.
    """
    known = F.col(key).isNotNull()
    converted = buyers.select(key).filter(known).distinct().withColumn("converted", F.lit(True))
    return (
        users.filter(known)
        .join(converted, key, "full_outer")
        .na.fill(False, subset=["converted"])
    )


def with_revenue(sales: DataFrame, amount: Column, drop: str) -> DataFrame:
    """Add ``revenue``, keep the rows that have one, drop a column no longer needed."""
    return sales.withColumn("revenue", amount).filter(F.col("revenue").isNotNull()).drop(drop)
