"""Contract-history features per customer.

All take encoded contract days (``customer_id``, ``category_code``, ``contract_date``), one
row per customer, category and date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextpick.defaults import LAST_PRODUCTS
from nextpick.functions.dates import elapsed_months


def product_columns(n: int = LAST_PRODUCTS) -> list[str]:
    return [f"product_{order}" for order in range(1, n + 1)]


def last_n_products(history: DataFrame, n: int = LAST_PRODUCTS) -> DataFrame:
    """Codes of the newest `n` contracts as product_1..product_n; 0 where there is none.

    Same-day contracts are ordered by code. The rank limit is applied before the shuffle
    too, so a customer sends at most `n` rows per task.
    """
    newest = Window.partitionBy("customer_id").orderBy(F.desc("contract_date"), "category_code")
    ranked = (history.select("customer_id", "contract_date", "category_code")
              .withColumn("_order", F.row_number().over(newest)).filter(F.col("_order") <= n))
    return ranked.groupBy("customer_id").agg(*[
        F.coalesce(F.max(F.when(F.col("_order") == order, F.col("category_code"))), F.lit(0)).alias(name)
        for order, name in enumerate(product_columns(n), 1)])


def history_summary(history: DataFrame, ref_month: str) -> DataFrame:
    """Number of contracts and least and most elapsed months."""
    months = elapsed_months(F.col("contract_date"), ref_month)
    return history.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("pre_contract_count"),
        F.min(months).alias("pre_contract_month_min"),
        F.max(months).alias("pre_contract_month_max"))


def held_flags(history: DataFrame, codes: Sequence[int]) -> DataFrame:
    """pre_yn_<code>: 1 if the customer ever held the category, else 0."""
    flags = (history.withColumn("_held", F.lit(1)).groupBy("customer_id")
             .pivot("category_code", list(codes)).agg(F.max("_held")).na.fill(0))
    return flags.toDF("customer_id", *[f"pre_yn_{code}" for code in codes])


def months_since_by_category(history: DataFrame, codes: Sequence[int], ref_month: str) -> DataFrame:
    """pre_m_<code>: elapsed months of the newest contract of the category, -1 if never."""
    months = elapsed_months(F.col("contract_date"), ref_month)
    since = (history.withColumn("_months", months).groupBy("customer_id")
             .pivot("category_code", list(codes)).agg(F.min("_months")).na.fill(-1))
    return since.toDF("customer_id", *[f"pre_m_{code}" for code in codes])


def attach_features(customers: DataFrame, *features: DataFrame) -> DataFrame:
    """Left-join per-customer feature tables; a customer without history has no products."""
    for table in features:
        customers = customers.join(table, "customer_id", "left")
    products = [column for column in customers.columns if column.startswith("product_")]
    return customers.na.fill(0, products) if products else customers
