"""Customers and contracts bound to the star-schema test tables.

A contract is one line item: its order gives customer and date, its part category and class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.functions.dates import month_start
from nextpick.operators.joins import lookup_join

DEVELOPMENT = "199912"
LATER = "200012"
EXCLUDED_CLASSES = ["PROMO"]
EXCLUDED_CATEGORIES = ["Brand#1", "Brand#2"]
VARIANT = ["Brand#3"]
ALL_EXCLUDED = EXCLUDED_CATEGORIES + VARIANT
CATEGORICAL = ["segment", "nation"]
NUMERIC = ["balance"]


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a test table; its schema is inferred the first time only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """Shuffle a scan that has fewer splits than the cluster has cores; leave others alone."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores, *keys) if frame.rdd.getNumPartitions() < cores else frame


def identity_code(customer_key: Column) -> Column:
    """Second identity column of a customer, as the customer table spells it."""
    return F.concat(F.lit("Customer#"), F.lpad(customer_key.cast("string"), 9, "0"))


def customers(spark: SparkSession, sf_dir: str, ref_month: str) -> DataFrame:
    """Snapshot of one month. Some values are made null, one nation only in development."""
    nation = F.col("c_nationkey").cast("string")
    if ref_month == DEVELOPMENT:
        nation = F.when(F.col("c_nationkey") != 24, nation)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("identity_code"),
        F.lit(ref_month).alias("ref_month"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"),
        nation.alias("nation"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"))


def contracts(spark: SparkSession, sf_dir: str, until: str | None = None, since: str | None = None,
              order_columns: tuple[str, ...] = (), line_columns: tuple[str, ...] = (),
              part_columns: tuple[str, ...] = (), orders_where: Column | None = None,
              lines_where: Column | None = None) -> DataFrame:
    """Contracts of the months `since` to `until` (``yyyyMM``, both included).

    Conditions on orders or line items alone are applied before the joins.

    Parts and orders are lookups of the line items: broadcast if small, else joined by
    shuffle with hot parts and orders salted.
    """
    lines = table(spark, sf_dir, "lineitem")
    if lines_where is not None:
        lines = lines.filter(lines_where)
    lines = spread(lines.select("l_orderkey", "l_partkey", *line_columns), "l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product_class"),
        F.col("p_brand").alias("category"), *part_columns)
    orders = table(spark, sf_dir, "orders")
    if until:
        orders = orders.filter(F.col("o_orderdate") < F.lit(month_start(until, 1)).cast("timestamp_ntz"))
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(month_start(since)).cast("timestamp_ntz"))
    if orders_where is not None:
        orders = orders.filter(orders_where)
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
                           F.col("o_orderdate").cast("date").alias("contract_date"), *order_columns)
    # Orders first: they carry the filters.
    joined = lookup_join(lookup_join(lines, orders, "l_orderkey"), parts, "l_partkey", probe=lines)
    return joined.select(
        "customer_id", F.col("l_partkey").alias("product_code"), "product_class", "category", "contract_date",
        *order_columns, *line_columns, *part_columns)
