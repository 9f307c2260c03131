"""Readers for the driver's Parquet tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` projected to the keyed table the versioned queries use.

    ``o_totalprice`` has at most two decimals, so the decimal cast is exact.
    """
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.col("o_orderpriority").alias("priority"),
    )


# SQL text of the same projection, for the DuckDB oracle.
ORDERS_ROWS_SQL = (
    "SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_orderstatus AS status, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(o_orderdate AS DATE) AS order_day, "
    "o_orderpriority AS priority FROM orders"
)
