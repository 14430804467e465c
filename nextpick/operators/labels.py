"""Category codes: learning, applying, reversing, and rule-based classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextpick.operators.joins import lookup_join

MAX_CODES = 5_000


def value_counts(frame: DataFrame, column: str, weight: Column | None = None) -> DataFrame:
    """Frequency of each value of `column`, most frequent first."""
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return frame.groupBy(column).agg(counted.alias("count")).orderBy(F.desc("count"), column)


def assign_codes(history: DataFrame, target: DataFrame) -> DataFrame:
    """Label dictionary (category, code, in_target) learned from contracts.

    Target categories get 1..k by falling number of distinct contracts, then the categories
    that only the history has get k+1.. by falling number of contracts; ties by name. 0 stays
    free for "none".
    """
    bought = target.distinct().groupBy("category").agg(F.count(F.lit(1)).alias("_bought"))
    held = history.groupBy("category").agg(F.count(F.lit(1)).alias("_held"))
    return _numbered(bought, held)


def assign_item_codes(history: DataFrame, target: DataFrame) -> DataFrame:
    """As `assign_codes`, from items with their numbers of contracts."""
    return _numbered(target.groupBy("category").agg(F.sum("bought").alias("_bought")),
                     history.groupBy("category").agg(F.sum("contracts").alias("_held")))


def _numbered(bought: DataFrame, held: DataFrame) -> DataFrame:
    counts = (bought.unionByName(held, allowMissingColumns=True).groupBy("category")
              .agg(F.max("_bought").alias("_bought"), F.max("_held").alias("_held")))
    # One row per category is left for the window.
    in_target = F.col("_bought").isNotNull()
    order = Window.orderBy(F.desc_nulls_last("_bought"), F.desc(F.when(~in_target, F.col("_held"))), "category")
    return counts.select("category", F.row_number().over(order).alias("code"), in_target.alias("in_target"))


def code_list(labels: DataFrame, target_only: bool = False) -> list[int]:
    """Codes of the dictionary in order, for column lists. Fails beyond MAX_CODES columns."""
    chosen = labels.filter("in_target") if target_only else labels
    codes = sorted(row.code for row in chosen.select("code").take(MAX_CODES + 1))
    if len(codes) > MAX_CODES:
        raise ValueError(f"more than {MAX_CODES} categories cannot become columns")
    return codes


def _look_up(frame: DataFrame, labels: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    # A dictionary kept as a local relation is small by construction, so it is not measured again.
    if labels.isLocal():
        return frame.join(F.broadcast(chosen), key, "left")
    return lookup_join(frame, chosen, key, "left")


def encode_category(frame: DataFrame, labels: DataFrame, target_only: bool = False) -> DataFrame:
    """Add ``category_code``; null where the dictionary does not have the category."""
    chosen = labels.filter("in_target") if target_only else labels
    return _look_up(frame, labels, chosen.select("category", F.col("code").alias("category_code")), "category")


def decode_category(frame: DataFrame, labels: DataFrame, code: str, name: str) -> DataFrame:
    """Add the category name of the code in `code` under `name`."""
    return _look_up(frame, labels, labels.select(F.col("code").alias(code), F.col("category").alias(name)), code)


@dataclass(frozen=True)
class Rule:
    """`label` for rows whose columns are in `within` and not in `outside`."""

    label: str
    within: Mapping[str, Sequence] = field(default_factory=dict)
    outside: Mapping[str, Sequence] = field(default_factory=dict)

    def condition(self) -> Column:
        matched = F.lit(True)
        for column, values in self.within.items():
            matched = matched & F.col(column).isin(list(values))
        for column, values in self.outside.items():
            matched = matched & ~F.col(column).isin(list(values))
        return matched


def classify_products(products: DataFrame, rules: Sequence[Rule], name: str, otherwise: str) -> DataFrame:
    """Add the label of the first rule that matches."""
    matches = [F.when(rule.condition(), F.lit(rule.label)) for rule in rules]
    return products.withColumn(name, F.coalesce(*matches, F.lit(otherwise)))
