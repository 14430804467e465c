"""Monthly category mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextpick.functions.dates import month_of
from nextpick.functions.values import not_in, round_to_fifth
from nextpick.operators.split import restrict_to


def with_month(contracts: DataFrame) -> DataFrame:
    return contracts.select(month_of(F.col("contract_date")).alias("month"),
                            "customer_id", "product_class", "category")


def monthly_purchases(contracts: DataFrame) -> DataFrame:
    """Distinct (month, customer, class, category)."""
    return with_month(contracts).distinct()


def monthly_customers(purchases: DataFrame, excluded_classes: Sequence[str],
                      cohort: DataFrame | None = None) -> DataFrame:
    """Distinct customers per month and category, optionally of a cohort only.

    `purchases` need not be distinct.
    Customers are reduced to one row per month and category before they are counted, so a
    cell that holds most rows is spread over all tasks.
    """
    kept = purchases.filter(not_in(F.col("product_class"), excluded_classes))
    distinct = kept.select("month", "category", "customer_id").distinct()
    if cohort is not None:
        distinct = restrict_to(distinct, cohort)
    return distinct.groupBy("month", "category").agg(F.count(F.lit(1)).alias("customers"))


def months_to_columns(cells: DataFrame, months: Sequence[str], value: str) -> DataFrame:
    """One column m<yyyyMM> per month; a cell without rows stays null."""
    wide = cells.groupBy("category").pivot("month", list(months)).agg(F.first(value))
    return wide.toDF("category", *[f"m{month}" for month in months])


def monthly_shares(cells: DataFrame) -> DataFrame:
    """Percent of the month's total over all categories, rounded to 0.2."""
    total = F.sum("customers").over(Window.partitionBy("month"))
    return cells.withColumn("share", round_to_fifth(F.try_divide("customers", total) * 100))


def monthly_trend(purchases: DataFrame, months: Sequence[str], sort_month: str,
                  excluded_classes: Sequence[str], cohort: DataFrame | None = None) -> DataFrame:
    """Category x month shares, highest share in `sort_month` first."""
    cells = monthly_customers(purchases, excluded_classes, cohort)
    wide = months_to_columns(monthly_shares(cells), months, "share")
    return wide.orderBy(F.col(f"m{sort_month}").desc_nulls_last(), "category")
