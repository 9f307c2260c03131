"""Seed-style derived tables and the scalar-function family.

The reference seeds its demo tables with id-driven ``pmod`` / ``element_at``
/ ``date_add`` / ``timestampadd`` expressions over ``range``. Here the same
expressions are applied to the ids of the driver's tables, so the work grows
with the data instead of being fixed-size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The seed vocabularies and anchors of the reference's setup script.
CITIES = ("Chennai", "Bangalore", "Mumbai", "Delhi", "Pune")
TIERS = ("bronze", "silver", "gold")
ORDER_STATUSES = ("placed", "shipped", "delivered", "cancelled")
EVENT_TYPES = ("login", "view", "click", "purchase", "logout")
SIGNUP_ANCHOR = "2024-01-01"
TS_ANCHOR = "2025-06-01 00:00:00"
# Factor and modulus of the seed formulas (days of sign-up, hours of orders, minutes of events).
SIGNUP_STEP, SIGNUP_DAYS = 7, 600
ORDER_STEP, ORDER_HOURS = 13, 4000
EVENT_STEP, EVENT_MINUTES = 37, 90000


def pick(values, idx: Column) -> Column:
    """``element_at(array(values), pmod(idx, n) + 1)``: 1-based pick by id."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(idx, F.lit(len(values))) + 1).cast("int"))


def seed_customers(customer: DataFrame) -> DataFrame:
    """customers(customer_id, name, city, signup_date, tier) from ``customer``."""
    i = F.col("c_custkey")
    return customer.select(
        i.alias("customer_id"),
        F.concat(F.lit("customer_"), i.cast("string")).alias("name"),
        pick(CITIES, i).alias("city"),
        F.date_add(F.lit(SIGNUP_ANCHOR).cast("date"), F.pmod(i * SIGNUP_STEP, F.lit(SIGNUP_DAYS)).cast("int")).alias("signup_date"),
        pick(TIERS, i).alias("tier"),
    )


def seed_orders(orders: DataFrame) -> DataFrame:
    """orders(order_id, customer_id, amount, order_ts, status) from ``orders``."""
    i = F.col("o_orderkey")
    return orders.select(
        i.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.expr(f"timestampadd(HOUR, -cast(pmod(o_orderkey * {ORDER_STEP}, {ORDER_HOURS}) AS INT), TIMESTAMP_NTZ'{TS_ANCHOR}')")
        .alias("order_ts"),
        pick(ORDER_STATUSES, i).alias("status"),
    )


def seed_events(events: DataFrame) -> DataFrame:
    """events(event_id, customer_id, event_type, event_ts) from ``events``."""
    i = F.col("event_id")
    return events.select(
        i.alias("event_id"),
        F.col("user_id").alias("customer_id"),
        pick(EVENT_TYPES, i).alias("event_type"),
        F.expr(f"timestampadd(MINUTE, -cast(pmod(event_id * {EVENT_STEP}, {EVENT_MINUTES}) AS INT), TIMESTAMP_NTZ'{TS_ANCHOR}')")
        .alias("event_ts"),
    )


def scalar_family(orders_rows: DataFrame) -> DataFrame:
    """Every pure scalar function the reference uses, once each, over the rows."""
    return orders_rows.select(
        "order_id",
        F.concat(F.lit("order_"), F.col("order_id").cast("string")).alias("label"),
        F.lower(F.col("priority")).alias("priority_lower"),
        F.upper(F.lower(F.col("status"))).alias("status_upper"),
        F.lower(F.col("priority")).like("%urgent%").alias("is_urgent"),
        F.date_add(F.col("order_day"), 30).alias("due_day"),
        F.expr("timestampadd(HOUR, 36, CAST(order_day AS TIMESTAMP_NTZ))").alias("due_ts"),
        F.pmod(F.col("order_id"), F.lit(7)).alias("bucket7"),
        F.round(F.col("total"), 0).cast("decimal(18,2)").alias("total_round"),
        pick(TIERS, F.col("cust_id")).alias("tier"),
        F.coalesce(F.when(F.col("status") == "O", F.lit(None)).otherwise(F.col("status")), F.lit("open"))
        .alias("status_or_open"),
        F.when(F.col("total") >= 300000, F.lit("large")).when(F.col("total") >= 100000, F.lit("medium"))
        .otherwise(F.lit("small")).alias("size_class"),
        (~F.col("status").eqNullSafe(F.lit("F"))).alias("not_final"),
        F.col("total").cast("int").alias("total_int"),
        F.create_map(F.lit("status"), F.col("status"), F.lit("priority"), F.col("priority"))
        .getItem("priority").alias("map_priority"),
    )
