"""Point-in-time split of contracts, exclusions, common population, customer split.

Every step over all contracts is an aggregation that combines rows before the shuffle, so a
customer, category or group of copies that holds a large part of the rows sends only its distinct
rows from each task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.defaults import SEED, TARGET_MONTHS, TEST_SHARE
from nextpick.functions.dates import month_start
from nextpick.functions.values import not_in, sample_hash
from nextpick.operators.numbering import mark_lowest

CONTRACT_COLUMNS = ["customer_id", "product_code", "product_class", "category", "contract_date"]
ITEM_COLUMNS = ["customer_id", "category", "contract_date"]


def contracts_until(contracts: DataFrame, ref_month: str, months: int = TARGET_MONTHS) -> DataFrame:
    """Contracts up to the end of the month `months` after the reference month."""
    return contracts.filter(F.col("contract_date") < F.lit(month_start(ref_month, months + 1)))


def contracts_after(contracts: DataFrame, ref_month: str, months: int = TARGET_MONTHS) -> DataFrame:
    """Contracts of the `months` months that follow the reference month."""
    return contracts_until(contracts, ref_month, months).filter(
        F.col("contract_date") >= F.lit(month_start(ref_month, 1)))


def complete_contracts(contracts: DataFrame) -> DataFrame:
    """Contract columns, rows with a missing value left out."""
    return contracts.select(*CONTRACT_COLUMNS).na.drop("any")


def temporal_split(contracts: DataFrame, ref_month: str) -> tuple[DataFrame, DataFrame]:
    """(history, target): before the first day after the reference month, and from it on."""
    day, split_day = F.col("contract_date"), F.lit(month_start(ref_month, 1))
    return contracts.filter(day < split_day), contracts.filter(day >= split_day)


def eligible(classes: Sequence[str] = (), categories: Sequence[str] = ()) -> Column:
    """True unless class or category is excluded; a missing one is not."""
    return not_in(F.col("product_class"), classes) & not_in(F.col("category"), categories)


def exclude(frame: DataFrame, classes: Sequence[str] = (), categories: Sequence[str] = ()) -> DataFrame:
    return frame.filter(eligible(classes, categories))


def items(contracts: DataFrame, classes: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """One row per customer, category and day, made of complete contracts.

    ``contracts`` counts its rows, ``bought`` the distinct ones that can be a target. Rows are
    made distinct before customers meet, so a customer has no more rows than categories and days.
    """
    rows = contracts.groupBy(*CONTRACT_COLUMNS).agg(F.count(F.lit(1)).alias("_rows"))
    return rows.groupBy(*ITEM_COLUMNS).agg(F.sum("_rows").alias("contracts"),
                                           F.count_if(eligible(classes, categories)).alias("bought"))


def item_split(items: DataFrame, ref_month: str) -> tuple[DataFrame, DataFrame]:
    """(history, target) of items up to the end of the target window."""
    history, target = temporal_split(contracts_until(items, ref_month), ref_month)
    return history, target.filter("bought > 0")


def split_audit(contracts: DataFrame, ref_month: str, classes: Sequence[str], categories: Sequence[str],
                variant: Sequence[str]) -> DataFrame:
    """Row count, first and last date of history and target after each step of the split."""
    history, target = temporal_split(contracts, ref_month)
    by_class = not_in(F.col("product_class"), classes)
    by_category = by_class & not_in(F.col("category"), categories)
    by_variant = by_category & not_in(F.col("category"), variant)
    # Distinct rows, then distinct items (customer, category, date) made of them.
    rows = F.count(F.lit(1)).alias("_rows")
    history_items = history.groupBy(*ITEM_COLUMNS).agg(rows)
    target_rows = target.groupBy(*CONTRACT_COLUMNS).agg(rows)
    target_items = target_rows.groupBy(*ITEM_COLUMNS).agg(*[
        F.sum(F.when(kept, counted)).alias(name) for name, kept, counted in (
            ("loaded", F.lit(True), F.col("_rows")), ("class_excluded", by_class, F.col("_rows")),
            ("category_excluded", by_category, F.col("_rows")), ("variant_excluded", by_variant, F.col("_rows")),
            ("rows_distinct", by_variant, F.lit(1)))])
    return (_steps(history_items, "history", {"loaded": F.col("_rows"), "projected_distinct": F.lit(1)})
            .unionByName(_steps(target_items, "target", {
                **{c: F.col(c) for c in target_items.columns if c not in ITEM_COLUMNS},
                "projected_distinct": F.when(F.col("rows_distinct").isNotNull(), 1)})))


def _steps(items: DataFrame, side: str, steps: Mapping[str, Column]) -> DataFrame:
    """One row per step; a step counts the items for which its column is not null."""
    totals = []
    for step, counted in steps.items():
        day = F.when(counted.isNotNull(), F.col("contract_date"))
        totals.append(F.struct(F.lit(side).alias("split"), F.lit(step).alias("step"),
                               F.coalesce(F.sum(counted), F.lit(0)).alias("row_count"),
                               F.min(day).alias("first_date"), F.max(day).alias("last_date")))
    return items.agg(F.array(*totals).alias("_steps")).select(F.inline("_steps"))


def common_population(customers: DataFrame, contracts: DataFrame, ref_month: str, classes: Sequence[str],
                      categories: Sequence[str]) -> DataFrame:
    """IDs of customers in the snapshot, in the history and in the target."""
    split_day = month_start(ref_month, 1)
    in_target = (F.col("contract_date") >= F.lit(split_day)) & eligible(classes, categories)
    both = (contracts.groupBy("customer_id")
            .agg(F.max(F.col("contract_date") < F.lit(split_day)).alias("_history"),
                 F.max(in_target).alias("_target"))
            .filter("_history AND _target").select("customer_id"))
    return both.join(customers.select("customer_id"), "customer_id", "left_semi")


def common_item_population(customers: DataFrame, items: DataFrame, ref_month: str) -> DataFrame:
    """As `common_population`, from items."""
    history = F.col("contract_date") < F.lit(month_start(ref_month, 1))
    both = (contracts_until(items, ref_month).groupBy("customer_id")
            .agg(F.max(history).alias("_history"), F.max(~history & (F.col("bought") > 0)).alias("_target"))
            .filter("_history AND _target").select("customer_id"))
    return both.join(customers.select("customer_id"), "customer_id", "left_semi")


def population_audit(customers: DataFrame, items: DataFrame, ref_month: str) -> DataFrame:
    """Rows of customers, history and target before and after they are restricted to the common population.

    Both tables are scanned once: every customer's counts tell whether it is in the population, and are
    added up with and without that condition.
    """
    history, count = F.col("contract_date") < F.lit(month_start(ref_month, 1)), F.count(F.lit(1))
    parts = [customers.groupBy("customer_id").agg(count.alias("customers")),
             contracts_until(items, ref_month).groupBy("customer_id").agg(
                 F.count_if(history).alias("history"), F.count_if(~history & (F.col("bought") > 0)).alias("target"))]
    names = ["customers", "history", "target"]
    rows = parts[0].join(parts[1], "customer_id", "full").na.fill(0, names)
    common = F.least(*names) > 0
    counts = [F.struct(F.lit(name).alias("split"), F.lit(step).alias("step"), F.coalesce(F.sum(F.when(kept, F.col(name))), F.lit(0)).alias("row_count"))
              for name in names for step, kept in (("population_before", F.lit(True)), ("population_after", common))]
    return rows.agg(F.array(*counts).alias("_steps")).select(F.inline("_steps"))


def restrict_to(frame: DataFrame, ids: DataFrame) -> DataFrame:
    return frame.join(ids.select("customer_id"), "customer_id", "left_semi")


def group_split(frame: DataFrame, key: str = "customer_id", test_share: float = TEST_SHARE,
                seed: int = SEED, digits: int = 4) -> DataFrame:
    """``train`` or ``test`` per key: the ``ceil(test_share * keys)`` lowest hashes are test."""
    keys = frame.select(key).distinct().withColumn("_all", F.lit(0)).withColumn("_hash", sample_hash(seed, key))
    quota = keys.groupBy("_all").agg(F.ceil(F.count(F.lit(1)) * F.lit(test_share)).alias("quota"))
    marked = mark_lowest(keys, quota, "_all", "_hash", key, "_test", digits)
    return marked.select(key, F.when(F.col("_test"), "test").otherwise("train").alias("split"))
