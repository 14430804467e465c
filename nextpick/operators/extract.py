"""Extraction of customers, contracts and reference tables from the source system's tables.

Source customers carry two identity columns; the extracts replace them by a surrogate ``id``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextpick.defaults import LAST_PRODUCTS, TARGET_MONTHS
from nextpick.functions.values import not_blank
from nextpick.operators.joins import lookup_join
from nextpick.operators.numbering import number_rows
from nextpick.operators.split import contracts_after, contracts_until
from nextpick.sources.stage import stage

IDENTITY = ["customer_id", "identity_code"]


def eligible_contracts(contracts: DataFrame, masters: DataFrame, condition: Column,
                       master_condition: Column, probe: DataFrame | None = None) -> DataFrame:
    """Contracts that satisfy `condition`, of customers that satisfy `master_condition`."""
    members = masters.filter(master_condition).select("customer_id")
    return lookup_join(contracts.filter(condition), members, "customer_id", "left_semi", probe)


def project(frame: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename-projection: new name -> source column."""
    return frame.select(*[F.col(source).alias(name) for name, source in columns.items()])


def distinct_pairs(frame: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct pairs in which both keys are non-empty text."""
    return frame.select(left, right).filter(not_blank(F.col(left)) & not_blank(F.col(right))).distinct()


def product_reference(products: DataFrame, coverages: DataFrame, pairs: DataFrame) -> DataFrame:
    """Product-coverage pairs with the attributes of both sides; unknown keys drop out."""
    with_coverage = lookup_join(pairs, coverages, "coverage_code")
    return lookup_join(with_coverage, products, "product_code", probe=pairs)


def base_population(customers: DataFrame, contracts: DataFrame, ref_month: str,
                    months: int = TARGET_MONTHS) -> DataFrame:
    """Snapshot customers that buy in the `months` months after, numbered 1..n in ``id``."""
    buyers = contracts_after(contracts, ref_month, months).select(*IDENTITY).distinct()
    found = customers.join(buyers, IDENTITY, "left_semi").distinct()
    return number_rows(stage(found, "population"), IDENTITY, "id")


def identity_map(population: DataFrame) -> DataFrame:
    return population.select("id", *IDENTITY)


def customer_table(population: DataFrame) -> DataFrame:
    return population.drop(*IDENTITY)


def training_extract(population: DataFrame, contracts: DataFrame, ref_month: str,
                     columns: Sequence[str], months: int = TARGET_MONTHS,
                     probe: DataFrame | None = None) -> DataFrame:
    """Contracts of the population up to `months` months after; customers without one stay.

    The contract side may be skewed, so it drives a salted join; customers without contracts
    are added by an anti join, which needs only their distinct keys.
    """
    window = contracts_until(contracts, ref_month, months)
    identities = identity_map(population)
    matched = lookup_join(window, identities, IDENTITY, probe=probe).select("id", *columns)
    alone = identities.join(window.select(*IDENTITY).distinct(), IDENTITY, "left_anti").select("id")
    return matched.unionByName(alone, allowMissingColumns=True)


def newest_contracts(contracts: DataFrame, order: Sequence[str], n: int = LAST_PRODUCTS) -> DataFrame:
    """The `n` newest contracts per customer, numbered in ``order_column``."""
    newest = Window.partitionBy(*IDENTITY).orderBy(F.desc("contract_date"), *order)
    return contracts.withColumn("order_column", F.row_number().over(newest)).filter(F.col("order_column") <= n)


def serving_input(customers: DataFrame, contracts: DataFrame, ref_month: str, columns: Sequence[str],
                  n: int = LAST_PRODUCTS, months: int = TARGET_MONTHS) -> DataFrame:
    """Newest `n` contracts of every snapshot customer, by surrogate ID.

    Like the extract it stands for, it keeps contracts up to `months` months after the reference
    month; pass ``months=0`` for a strict point in time. Contracts are cut to `n` per customer
    before they meet the customers.
    """
    numbered = identity_map(number_rows(customers.select(*IDENTITY).distinct(), IDENTITY, "id"))
    window = contracts_until(contracts, ref_month, months).filter(F.col("product_code").isNotNull())
    newest = newest_contracts(window, [c for c in columns if c != "contract_date"], n)
    return newest.join(numbered, IDENTITY).select("id", *columns, "order_column")


def baseline_picks(identities: DataFrame, picks: DataFrame) -> DataFrame:
    """The older recommender's pick per surrogate ID."""
    return identities.join(picks, "customer_id").select("id", "old_item")
