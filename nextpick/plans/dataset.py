"""Dataset building: contracts and snapshots of two months to encoded modelling tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextpick.defaults import LAST_PRODUCTS, NEGATIVE_RATIO, SEED
from nextpick.operators import encode, features, labels, split, targets
from nextpick.operators.joins import fits_broadcast, lookup_join
from nextpick.sources.stage import keep, stage, stage_bucketed


@dataclass(frozen=True)
class Snapshot:
    """Customers, encoded history and encoded target of one month, on their common IDs."""

    ref_month: str
    ids: DataFrame
    customers: DataFrame
    history: DataFrame
    target: DataFrame


@dataclass(frozen=True)
class Encoders:
    categories: DataFrame
    ranges: DataFrame


@dataclass(frozen=True)
class ModelInput:
    """Encoded features, target pairs and their join for one month."""

    snapshot: Snapshot
    features: DataFrame
    pairs: DataFrame
    table: DataFrame


def stage_contracts(contracts: DataFrame) -> DataFrame:
    """Complete contracts, extracted once for everything that follows."""
    return stage(split.complete_contracts(contracts), "contracts")


def learn_labels(contracts: DataFrame, ref_month: str, classes: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Label dictionary of the development month, kept as a small table."""
    history, target = split.temporal_split(split.contracts_until(contracts, ref_month), ref_month)
    return keep(labels.assign_codes(history, split.exclude(target, classes, categories)), "labels")


def stage_items(contracts: DataFrame, classes: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Items of complete contracts, in buckets by customer.

    Population, history, target and the features of every month are then made without a
    shuffle by customer, and one customer's items are read without the others'.
    """
    return stage_bucketed(split.items(split.complete_contracts(contracts), classes, categories), "items", "customer_id")


def learn_item_labels(items: DataFrame, ref_month: str) -> DataFrame:
    """As `learn_labels`, from items."""
    return keep(labels.assign_item_codes(*split.item_split(items, ref_month)), "labels")


def item_snapshot(customers: DataFrame, items: DataFrame, ref_month: str, label_table: DataFrame) -> Snapshot:
    """As `build_snapshot`, from bucketed items; all its tables are partitioned by customer."""
    ids = stage_bucketed(split.common_item_population(customers, items, ref_month), "population", "customer_id")
    history, target = [part.select(*split.ITEM_COLUMNS).join(ids, "customer_id", "left_semi")
                       for part in split.item_split(items, ref_month)]
    return Snapshot(ref_month, ids, split.restrict_to(customers, ids), labels.encode_category(history, label_table),
                    labels.encode_category(target, label_table, target_only=True))


def encoded_parts(contracts: DataFrame, ref_month: str, label_table: DataFrame, classes: Sequence[str],
                  categories: Sequence[str], ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(history, target) with codes, one row per customer, category and date.

    With `ids`, contracts of other customers are dropped before rows are made distinct.
    """
    history, target = split.temporal_split(split.contracts_until(contracts, ref_month), ref_month)
    history = history.select(*split.ITEM_COLUMNS)
    target = split.exclude(target, classes, categories).select(*split.ITEM_COLUMNS)
    if ids is not None:
        small = fits_broadcast(ids)
        history = lookup_join(history, ids, "customer_id", "left_semi", small=small)
        target = lookup_join(target, ids, "customer_id", "left_semi", small=small)
    return (labels.encode_category(history.distinct(), label_table),
            labels.encode_category(target.distinct(), label_table, target_only=True))


def build_snapshot(customers: DataFrame, contracts: DataFrame, ref_month: str, label_table: DataFrame,
                   classes: Sequence[str], categories: Sequence[str]) -> Snapshot:
    """One month restricted to the customers found in snapshot, history and target."""
    until = split.contracts_until(contracts, ref_month)
    ids = stage(split.common_population(customers, until, ref_month, classes, categories), "population")
    history, target = encoded_parts(contracts, ref_month, label_table, classes, categories, ids)
    return Snapshot(ref_month, ids, split.restrict_to(customers, ids), history, target)


def raw_features(snapshot: Snapshot, last_products: int = LAST_PRODUCTS) -> DataFrame:
    """Customer attributes with recency and history features, not yet encoded."""
    return features.attach_features(
        snapshot.customers,
        features.last_n_products(snapshot.history, last_products),
        features.history_summary(snapshot.history, snapshot.ref_month))


SUMMARY_COLUMNS = ["pre_contract_count", "pre_contract_month_min", "pre_contract_month_max"]


def fit_encoders(raw: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> Encoders:
    return Encoders(keep(encode.fit_category_codes(raw, categorical), "categories"),
                    keep(encode.fit_min_max(raw, numeric), "ranges"))


def encode_features(raw: DataFrame, encoders: Encoders, categorical: Sequence[str],
                    numeric: Sequence[str]) -> DataFrame:
    coded = encode.apply_category_codes(raw, encoders.categories, categorical)
    return encode.apply_min_max(coded, encoders.ranges, numeric)


def make_features(snapshot: Snapshot, categorical: Sequence[str], numeric: Sequence[str],
                  encoders: Encoders | None = None, last_products: int = LAST_PRODUCTS) -> tuple[DataFrame, Encoders]:
    """Encoded features of one month; without `encoders` they are fitted on it."""
    raw = raw_features(snapshot, last_products)
    numeric = [*numeric, *SUMMARY_COLUMNS]
    if encoders is None:
        raw = stage(raw, "features")
        encoders = fit_encoders(raw, categorical, numeric)
    kept = ["customer_id", "ref_month", *categorical, *numeric, *features.product_columns(last_products)]
    return encode_features(raw, encoders, categorical, numeric).select(*kept), encoders


def make_pairs(snapshot: Snapshot, label_table: DataFrame, development: bool, ratio: int = NEGATIVE_RATIO,
               seed: int = SEED) -> DataFrame:
    """Target pairs of one month: with sampled negatives in development, else positives only."""
    positives = targets.positive_pairs(snapshot.target)
    if not development:
        return targets.target_pairs(positives)
    positives = stage(positives, "positives")
    codes = labels.code_list(label_table, target_only=True)
    return targets.target_pairs(positives, targets.sample_negatives(positives, codes, ratio, seed))


def make_input(snapshot: Snapshot, label_table: DataFrame, categorical: Sequence[str], numeric: Sequence[str],
               encoders: Encoders | None = None, last_products: int = LAST_PRODUCTS,
               ratio: int = NEGATIVE_RATIO, seed: int = SEED) -> tuple[ModelInput, Encoders]:
    """Modelling table of one month; without `encoders` it is the development month."""
    development = encoders is None
    encoded, encoders = make_features(snapshot, categorical, numeric, encoders, last_products)
    pairs = make_pairs(snapshot, label_table, development, ratio, seed)
    return ModelInput(snapshot, encoded, pairs, targets.modelling_table(encoded, pairs)), encoders


def staged(model_input: ModelInput) -> ModelInput:
    """The same month with history, target, features, pairs and table computed once and kept."""
    snapshot = model_input.snapshot
    snapshot = Snapshot(snapshot.ref_month, snapshot.ids, stage(snapshot.customers, "customers"),
                        stage(snapshot.history, "history"), stage(snapshot.target, "target"))
    encoded, pairs = stage(model_input.features, "encoded"), stage(model_input.pairs, "pairs")
    return ModelInput(snapshot, encoded, pairs, stage(targets.modelling_table(encoded, pairs), "table"))


def split_table(model_input: ModelInput, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Modelling table with ``split``; all rows of a customer are on one side."""
    sides = split.group_split(model_input.snapshot.ids, "customer_id", test_share, seed)
    return model_input.table.join(sides, "customer_id")


def unseen_categories(contracts: DataFrame, label_table: DataFrame) -> DataFrame:
    """Categories without a code, with their number of contracts."""
    return (contracts.groupBy("category").agg(F.count(F.lit(1)).alias("contracts"))
            .join(label_table, "category", "left_anti"))
