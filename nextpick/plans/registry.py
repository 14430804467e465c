"""Queries on the test tables: one per operator, each over whole tables."""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextpick.functions.dates import month_list, month_of, shifted, whole_periods
from nextpick.operators import candidates as cand
from nextpick.operators import (checks, encode, evaluate, extract, features, labels, models, profile, split,
                                targets, trend)
from nextpick.operators.joins import lookup_join
from nextpick.plans import artefact, dataset, evaluation
from nextpick.sources import files, tables
from nextpick.sources.stage import stage, stage_bucketed, stage_path
from nextpick.sources.tables import ALL_EXCLUDED, CATEGORICAL, DEVELOPMENT, EXCLUDED_CLASSES, LATER, NUMERIC

LAST = {DEVELOPMENT: "200006", LATER: "200106"}
FIRST_STAGE_CODES = 3
SECOND_STAGE_MINIMUM = 0.08
TREND_SINCE = "199909"
TREND_MONTHS = month_list(TREND_SINCE, 15)
FEATURES = [*CATEGORICAL, *NUMERIC, *dataset.SUMMARY_COLUMNS, *features.product_columns()]
# Categories the older recommender could pick on the test tables.
BASELINE_CATEGORIES = ["Brand#4", "Brand#7", "Brand#11", "Brand#15", "Brand#19", "Brand#21", "Brand#25"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Rules of the product classification on the test tables, first match wins.
PRODUCT_RULES = [
    labels.Rule("small promo", {"p_type": ["PROMO", "ECONOMY"], "p_brand": ["Brand#4", "Brand#5", "Brand#6"]}),
    labels.Rule("standard", {"p_type": ["STANDARD", "MEDIUM"]}, {"p_brand": ["Brand#7"], "p_size": [1, 2, 3]}),
    labels.Rule("large", {"p_type": ["LARGE"]}),
]


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


@dataclass(frozen=True)
class Base:
    """Staged items and the label dictionary of the development month."""

    items: DataFrame
    labels: DataFrame

    def snapshot(self, spark: SparkSession, sf_dir: str, ref_month: str = DEVELOPMENT) -> dataset.Snapshot:
        return dataset.item_snapshot(tables.customers(spark, sf_dir, ref_month), self.items, ref_month, self.labels)


def _base(spark: SparkSession, sf_dir: str, until: str = DEVELOPMENT) -> Base:
    items = dataset.stage_items(tables.contracts(spark, sf_dir, LAST[until]), EXCLUDED_CLASSES, ALL_EXCLUDED)
    return Base(items, dataset.learn_item_labels(items, DEVELOPMENT))


def _contracts(spark: SparkSession, sf_dir: str, until: str = DEVELOPMENT) -> tuple[DataFrame, DataFrame]:
    """Staged contracts and the labels learned from them."""
    contracts = dataset.stage_contracts(tables.contracts(spark, sf_dir, LAST[until]))
    return contracts, dataset.learn_labels(contracts, DEVELOPMENT, EXCLUDED_CLASSES, ALL_EXCLUDED)


def _history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base = _base(spark, sf_dir)
    return base.snapshot(spark, sf_dir).history, base.labels


def _inputs(spark: SparkSession, sf_dir: str, later: bool = False) -> tuple[Base, dataset.ModelInput]:
    base = _base(spark, sf_dir, LATER if later else DEVELOPMENT)
    development = base.snapshot(spark, sf_dir)
    if not later:
        return base, dataset.make_input(development, base.labels, CATEGORICAL, NUMERIC)[0]
    _, encoders = dataset.make_features(development, CATEGORICAL, NUMERIC)
    applied, _ = dataset.make_input(base.snapshot(spark, sf_dir, LATER), base.labels, CATEGORICAL, NUMERIC, encoders)
    return base, applied


@dataclass(frozen=True)
class HeldOut:
    """Positive pairs by split, and the scored candidates of the test customers."""

    labels: DataFrame
    codes: list[int]
    items: DataFrame
    history: DataFrame
    positives: DataFrame

    @property
    def customers(self) -> DataFrame:
        return self.test.select("customer_id").distinct()

    @property
    def scored(self) -> DataFrame:
        return evaluation.scored_candidates(self.customers, self.history, self.train, self.codes)

    @property
    def train(self) -> DataFrame:
        return self.positives.filter("split = 'train'").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.positives.filter("split = 'test'").drop("split")

    @property
    def bought(self) -> DataFrame:
        return labels.decode_category(self.test, self.labels, "target_category", "category")

    @property
    def evaluated(self) -> DataFrame:
        return evaluation.evaluate_picks(self.scored, self.bought, self.labels)


def _held_out(spark: SparkSession, sf_dir: str) -> HeldOut:
    base = _base(spark, sf_dir)
    snapshot = base.snapshot(spark, sf_dir)
    pairs = targets.target_pairs(targets.positive_pairs(snapshot.target)).drop("target")
    positives = stage(pairs.join(split.group_split(snapshot.ids), "customer_id"), "positives")
    return HeldOut(base.labels, labels.code_list(base.labels, target_only=True), base.items,
                   snapshot.history, positives)


# Dataset building

@query
def temporal_split_counts(spark, sf_dir):
    contracts = split.complete_contracts(tables.contracts(spark, sf_dir, LAST[DEVELOPMENT]))
    audit = split.split_audit(contracts, DEVELOPMENT, EXCLUDED_CLASSES, tables.EXCLUDED_CATEGORIES, tables.VARIANT)
    return audit.select("split", "step", "row_count", _day("first_date"), _day("last_date"))


@query
def population_audit(spark, sf_dir):
    return split.population_audit(tables.customers(spark, sf_dir, DEVELOPMENT), _base(spark, sf_dir).items, DEVELOPMENT)


@query
def category_codes(spark, sf_dir):
    return _base(spark, sf_dir).labels.select("category", "code", F.col("in_target").cast("int").alias("in_target"))


@query
def encoded_history(spark, sf_dir):
    contracts, label_table = _contracts(spark, sf_dir)
    history, _ = dataset.encoded_parts(contracts, DEVELOPMENT, label_table, EXCLUDED_CLASSES, ALL_EXCLUDED)
    return history.select("customer_id", "category", "category_code", _day("contract_date"))


@query
def encoded_target(spark, sf_dir):
    contracts, label_table = _contracts(spark, sf_dir, LATER)
    _, target = dataset.encoded_parts(contracts, LATER, label_table, EXCLUDED_CLASSES, ALL_EXCLUDED)
    return target.select("customer_id", "category", "category_code", _day("contract_date"))


@query
def target_window_contracts(spark, sf_dir):
    """Contracts of the later month's target window, read from a store with one folder per month."""
    store = stage_path(spark, "contract-months")
    files.write_contract_months(split.complete_contracts(tables.contracts(spark, sf_dir)), store)
    found = files.read_contract_months(spark, store, shifted(LATER, 1), LAST[LATER])
    return found.select("customer_id", "product_code", "product_class", "category", _day("contract_date"))


def _population_ids(spark: SparkSession, sf_dir: str, contracts: DataFrame) -> DataFrame:
    return split.common_population(tables.customers(spark, sf_dir, DEVELOPMENT), contracts, DEVELOPMENT,
                                   EXCLUDED_CLASSES, ALL_EXCLUDED)


@query
def common_population(spark, sf_dir):
    contracts = split.complete_contracts(tables.contracts(spark, sf_dir, LAST[DEVELOPMENT]))
    return _population_ids(spark, sf_dir, contracts)


@query
def last_n_products(spark, sf_dir):
    return features.last_n_products(_history(spark, sf_dir)[0])


@query
def history_summary(spark, sf_dir):
    contracts = dataset.stage_contracts(tables.contracts(spark, sf_dir, LAST[DEVELOPMENT]))
    ids = stage(_population_ids(spark, sf_dir, contracts), "population")
    history = split.temporal_split(contracts, DEVELOPMENT)[0].select(*split.ITEM_COLUMNS)
    history = lookup_join(history, ids, "customer_id", "left_semi")
    return features.history_summary(history.distinct(), DEVELOPMENT)


@query
def held_flags(spark, sf_dir):
    history, label_table = _history(spark, sf_dir)
    return features.held_flags(history, labels.code_list(label_table))


@query
def months_since_by_category(spark, sf_dir):
    history, label_table = _history(spark, sf_dir)
    return features.months_since_by_category(history, labels.code_list(label_table), DEVELOPMENT)


@query
def null_columns(spark, sf_dir):
    return encode.null_columns(tables.customers(spark, sf_dir, DEVELOPMENT))


@query
def categorical_encoder(spark, sf_dir):
    return encode.fit_category_codes(tables.customers(spark, sf_dir, DEVELOPMENT), CATEGORICAL)


@query
def numeric_encoder(spark, sf_dir):
    raw = dataset.raw_features(_base(spark, sf_dir).snapshot(spark, sf_dir))
    return encode.fit_min_max(raw, [*NUMERIC, *dataset.SUMMARY_COLUMNS])


@query
def encoded_features(spark, sf_dir):
    return _inputs(spark, sf_dir, later=True)[1].features


@query
def vocabulary_sizes(spark, sf_dir):
    base, model_input = _inputs(spark, sf_dir)
    return encode.vocabulary_sizes(model_input.features, CATEGORICAL, features.product_columns(), base.labels)


@query
def negative_samples(spark, sf_dir):
    base = _base(spark, sf_dir)
    positives = stage(targets.positive_pairs(base.snapshot(spark, sf_dir).target), "positives")
    return targets.sample_negatives(positives, labels.code_list(base.labels, target_only=True))


@query
def target_pairs(spark, sf_dir):
    base = _base(spark, sf_dir)
    return dataset.make_pairs(base.snapshot(spark, sf_dir), base.labels, development=True)


@query
def target_summary(spark, sf_dir):
    base = _base(spark, sf_dir)
    snapshot = base.snapshot(spark, sf_dir)
    pairs = stage(dataset.make_pairs(snapshot, base.labels, development=True), "pairs")
    return targets.target_summary(snapshot.customers, pairs).drop("target_mix")


@query
def category_mix(spark, sf_dir):
    target = _base(spark, sf_dir).snapshot(spark, sf_dir).target
    return targets.category_mix(targets.positive_pairs(target), "category_code")


@query
def modelling_table(spark, sf_dir):
    return _inputs(spark, sf_dir)[1].table


@query
def modelling_table_later(spark, sf_dir):
    return _inputs(spark, sf_dir, later=True)[1].table


@query
def group_split(spark, sf_dir):
    contracts = split.complete_contracts(tables.contracts(spark, sf_dir, LAST[DEVELOPMENT]))
    return split.group_split(stage(_population_ids(spark, sf_dir, contracts), "population"))


# Scoring and evaluation

@query
def candidate_scores(spark, sf_dir):
    return _held_out(spark, sf_dir).scored


@query
def ranked_candidates(spark, sf_dir):
    held_out = _held_out(spark, sf_dir)
    return evaluation.recommend(held_out.customers, held_out.history, held_out.train, held_out.codes, held_out.labels)


@query
def recommend_one(spark, sf_dir):
    held_out = _held_out(spark, sf_dir)
    customer_id = cand.one_customer(held_out.customers).first()["customer_id"]
    return evaluation.recommend_one(customer_id, held_out.items, DEVELOPMENT, held_out.train, held_out.codes,
                                    held_out.labels)


@query
def best_candidate(spark, sf_dir):
    return _held_out(spark, sf_dir).evaluated.select("customer_id", "pred_item", "score")


@query
def true_items(spark, sf_dir):
    items = cand.true_items(_held_out(spark, sf_dir).bought)
    return items.select("customer_id", F.array_join("true_item", ",").alias("true_item"))


@query
def hit_accuracy(spark, sf_dir):
    return evaluate.accuracy(_held_out(spark, sf_dir).evaluated)


@query
def hit_accuracy_later(spark, sf_dir):
    base = _base(spark, sf_dir, LATER)
    development, later = base.snapshot(spark, sf_dir), base.snapshot(spark, sf_dir, LATER)
    sides = split.group_split(development.ids).filter("split = 'train'")
    pairs = targets.target_pairs(targets.positive_pairs(development.target))
    train = pairs.join(sides.select("customer_id"), "customer_id", "left_semi")
    scored = evaluation.scored_candidates(later.ids, later.history, train,
                                          labels.code_list(base.labels, target_only=True))
    return evaluate.accuracy(evaluation.evaluate_picks(scored, later.target, base.labels))


def _baseline(held_out: HeldOut, allowed: list[str] | None = None) -> DataFrame:
    picks = evaluation.most_frequent_category(held_out.history)
    return evaluate.evaluate_baseline(cand.true_items(held_out.bought, allowed=allowed), picks)


@query
def baseline_accuracy(spark, sf_dir):
    return evaluate.accuracy(_baseline(_held_out(spark, sf_dir)))


@query
def baseline_accuracy_allowed(spark, sf_dir):
    return evaluate.accuracy(_baseline(_held_out(spark, sf_dir), BASELINE_CATEGORIES))


@query
def accuracy_by_category(spark, sf_dir):
    return evaluate.accuracy_by_category(_held_out(spark, sf_dir).evaluated)


@query
def baseline_accuracy_by_category(spark, sf_dir):
    return evaluate.accuracy_by_category(_baseline(_held_out(spark, sf_dir)))


@query
def train_test_mix(spark, sf_dir):
    held_out = _held_out(spark, sf_dir)
    train = labels.decode_category(held_out.train, held_out.labels, "target_category", "category")
    return evaluate.train_test_mix(train, held_out.evaluated)


def _matrix(held_out: HeldOut) -> DataFrame:
    return evaluate.multi_label_matrix(held_out.test.withColumn("target", F.lit(1)), held_out.codes)


def _predicted_matrix(held_out: HeldOut) -> DataFrame:
    wide = held_out.scored.groupBy("customer_id").pivot("target_category", held_out.codes).agg(F.max("score"))
    wide = wide.toDF("customer_id", *[f"prob_{code}" for code in held_out.codes])
    picked = evaluate.highest_label(wide, held_out.codes).select("customer_id", "pred_code")
    return _matrix(held_out).join(picked, "customer_id")


@query
def multi_label_matrix(spark, sf_dir):
    return _matrix(_held_out(spark, sf_dir))


@query
def multi_label_report(spark, sf_dir):
    held_out = _held_out(spark, sf_dir)
    return evaluate.multi_label_report(_predicted_matrix(held_out), held_out.codes)


@query
def exact_match_accuracy(spark, sf_dir):
    held_out = _held_out(spark, sf_dir)
    return evaluate.exact_match_accuracy(_predicted_matrix(held_out), held_out.codes)


@query
def multi_label_input(spark, sf_dir):
    base, model_input = _inputs(spark, sf_dir, later=True)
    codes = labels.code_list(base.labels, target_only=True)
    return evaluate.multi_label_input(cand.entity_rows(model_input.table), model_input.pairs, codes)


@query
def multi_class_input(spark, sf_dir):
    return evaluate.multi_class_input(cand.positives(_inputs(spark, sf_dir)[1].table), FIRST_STAGE_CODES)


@query
def multi_class_report(spark, sf_dir):
    held_out = _held_out(spark, sf_dir)
    first = FIRST_STAGE_CODES
    true = held_out.test.filter(F.col("target_category") > first).select(
        "customer_id", (F.col("target_category") - (first + 1)).alias("true_class"))
    best = cand.best_candidate(held_out.scored.filter(F.col("target_category") > first))
    predicted = best.select("customer_id", (F.col("target_category") - (first + 1)).alias("pred_class"))
    return evaluate.multi_class_report(true.join(predicted, "customer_id"), offset=first + 1)


def _hybrid_picks(held_out: HeldOut) -> DataFrame:
    """Best pick of every held-out customer, from the later codes where the first ones don't do; scores are staged once."""
    scored = stage(held_out.scored, "scored")
    later_codes = scored.filter((F.col("target_category") > FIRST_STAGE_CODES) & (F.col("score") >= SECOND_STAGE_MINIMUM))
    second = labels.decode_category(cand.best_candidate(later_codes), held_out.labels, "target_category",
                                    "second_item").select("customer_id", "second_item")
    kept = [row.category for row in held_out.labels.filter(F.col("code") <= FIRST_STAGE_CODES).collect()]
    return evaluate.hybrid_recommend(evaluation.evaluate_picks(scored, held_out.bought, held_out.labels), second, kept)


@query
def hybrid_recommend(spark, sf_dir):
    return _hybrid_picks(_held_out(spark, sf_dir)).select("customer_id", "pred_item", "source", "hit")


@query
def hybrid_accuracy_by_category(spark, sf_dir):
    return evaluate.accuracy_by_category(_hybrid_picks(_held_out(spark, sf_dir)))


def _scored_test_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    snapshot = base.snapshot(spark, sf_dir)
    pairs = dataset.make_pairs(snapshot, base.labels, development=True)
    pairs = stage(pairs.join(split.group_split(snapshot.ids), "customer_id"), "pairs")
    shares = cand.category_shares(pairs.filter("split = 'train' AND target = 1"))
    test = pairs.filter("split = 'test'").join(cand.holdings(snapshot.history), "customer_id", "left")
    return cand.affinity_score(test, shares).select("customer_id", "target_category", "target", "score")


@query
def log_loss(spark, sf_dir):
    return evaluate.log_loss(_scored_test_pairs(spark, sf_dir))


@query
def auc(spark, sf_dir):
    return evaluate.auc(_scored_test_pairs(spark, sf_dir))


# Trend

def _eligible(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None,
              part_columns: tuple[str, ...] = ()) -> DataFrame:
    condition = (F.col("l_returnflag") == "N") | F.col("o_orderstatus").isin("F")
    contracts = tables.contracts(spark, sf_dir, until, since, ("o_orderstatus",), ("l_returnflag",), part_columns,
                                 orders_where=F.col("o_orderpriority") != "5-LOW",
                                 lines_where=F.col("l_linestatus") == "O")
    masters = tables.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")
    eligible = extract.eligible_contracts(contracts, masters, condition, F.col("c_mktsegment") == "BUILDING",
                                          probe=tables.order_keys(spark, sf_dir))
    return eligible.select(*split.CONTRACT_COLUMNS, *part_columns)


@query
def eligible_contracts(spark, sf_dir):
    return _eligible(spark, sf_dir, since=TREND_SINCE).select(
        "customer_id", "product_code", "product_class", "category", _day("contract_date"))


@query
def monthly_purchases(spark, sf_dir):
    return trend.monthly_purchases(_eligible(spark, sf_dir, since=TREND_SINCE))


@query
def monthly_product_names(spark, sf_dir):
    month = TREND_MONTHS[-1]
    found = _eligible(spark, sf_dir, since=month, until=month, part_columns=("p_name",))
    return found.select(month_of(F.col("contract_date")).alias("month"), "customer_id",
                        F.col("p_name").alias("product_name"), "product_class", "category").distinct()


@query
def monthly_customers(spark, sf_dir):
    purchases = trend.with_month(_eligible(spark, sf_dir, since=TREND_SINCE))
    return trend.monthly_customers(purchases, EXCLUDED_CLASSES)


@query
def monthly_trend(spark, sf_dir):
    purchases = trend.with_month(_eligible(spark, sf_dir, TREND_SINCE, TREND_MONTHS[-1]))
    return trend.monthly_trend(purchases, TREND_MONTHS, "200005", EXCLUDED_CLASSES)


@query
def monthly_trend_cohort(spark, sf_dir):
    purchases = trend.with_month(_eligible(spark, sf_dir, TREND_SINCE, TREND_MONTHS[-1]))
    snapshot = tables.customers(spark, sf_dir, DEVELOPMENT).filter("balance IS NOT NULL")
    return trend.monthly_trend(purchases, TREND_MONTHS, "200005", EXCLUDED_CLASSES, snapshot)


# Extraction

def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.project(tables.table(spark, sf_dir, "part"), {
        "product_code": "p_partkey", "product_name": "p_name", "class_code": "p_type", "category_code": "p_brand",
        "size_code": "p_size"})


def _coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = tables.table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") != 1)
    return extract.project(main, {"coverage_code": "s_suppkey", "coverage_name": "s_name",
                                  "group_code": "s_nationkey"})


def _coverage_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Text keys, some of them empty, as in the source's pair table.
    lines = tables.table(spark, sf_dir, "lineitem")
    keys = lines.filter(F.col("l_linestatus") == "F").select(F.col("l_partkey").cast("string").alias("product_code"),
                        F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_suppkey").cast("string"))
                        .alias("coverage_code"))
    return extract.distinct_pairs(keys, "product_code", "coverage_code")


@query
def product_table(spark, sf_dir):
    return _products(spark, sf_dir)


@query
def main_coverages(spark, sf_dir):
    return _coverages(spark, sf_dir)


@query
def risk_rates(spark, sf_dir):
    return extract.project(tables.table(spark, sf_dir, "lineitem"), {
        "risk_code": "l_returnflag", "risk_type": "l_linestatus", "rate": "l_tax",
        "occurrence": "l_linenumber"}).distinct()


@query
def product_coverage_pairs(spark, sf_dir):
    return _coverage_pairs(spark, sf_dir)


@query
def coverage_risk_pairs(spark, sf_dir):
    return extract.project(tables.table(spark, sf_dir, "lineitem"), {
        "coverage_code": "l_suppkey", "risk_code": "l_returnflag"}).distinct()


@query
def product_reference(spark, sf_dir):
    pairs = stage(_coverage_pairs(spark, sf_dir), "pairs")
    products = _products(spark, sf_dir).withColumn("product_code", F.col("product_code").cast("string"))
    coverages = _coverages(spark, sf_dir).withColumn("coverage_code", F.col("coverage_code").cast("string"))
    return extract.product_reference(products, coverages, pairs).select(
        "product_code", "product_name", "class_code", "coverage_code", "coverage_name")


@query
def classify_products(spark, sf_dir):
    classified = labels.classify_products(tables.table(spark, sf_dir, "part"), PRODUCT_RULES, "group", "other")
    return classified.select(F.col("p_partkey").alias("product_code"), "group")


def _source_contracts(spark: SparkSession, sf_dir: str, ref_month: str) -> DataFrame:
    contracts = tables.contracts(spark, sf_dir, LAST[ref_month])
    return contracts.withColumn("identity_code", tables.identity_code(F.col("customer_id")))


def _population(spark: SparkSession, sf_dir: str, contracts: DataFrame | None = None) -> DataFrame:
    if contracts is None:
        contracts = _source_contracts(spark, sf_dir, DEVELOPMENT)
    return extract.base_population(tables.customers(spark, sf_dir, DEVELOPMENT), contracts, DEVELOPMENT)


@query
def base_population(spark, sf_dir):
    return extract.customer_table(_population(spark, sf_dir))


@query
def identity_map(spark, sf_dir):
    return extract.identity_map(_population(spark, sf_dir))


@query
def training_extract(spark, sf_dir):
    contracts = stage(_source_contracts(spark, sf_dir, DEVELOPMENT), "contracts")
    population = _population(spark, sf_dir, contracts)
    found = extract.training_extract(population, contracts, DEVELOPMENT,
                                     ["product_code", "product_class", "category", "contract_date"])
    return found.select("id", "product_code", "product_class", "category", _day("contract_date"))


@query
def serving_input(spark, sf_dir):
    served = extract.serving_input(tables.customers(spark, sf_dir, LATER), _source_contracts(spark, sf_dir, LATER),
                                   LATER, ["category", "product_code", "product_class", "contract_date"])
    return served.withColumn("contract_date", _day("contract_date"))


@query
def baseline_picks(spark, sf_dir):
    contracts = stage(_source_contracts(spark, sf_dir, DEVELOPMENT), "contracts")
    identities = extract.identity_map(_population(spark, sf_dir, contracts))
    history, _ = split.temporal_split(contracts, DEVELOPMENT)
    return extract.baseline_picks(identities, evaluation.most_frequent_category(history))


# Checks and profiles

@query
def duplicate_audit(spark, sf_dir):
    contracts = dataset.stage_contracts(tables.contracts(spark, sf_dir))
    customers = tables.customers(spark, sf_dir, DEVELOPMENT)
    return checks.combine([
        checks.duplicate_audit(contracts, "contracts", contracts.columns),
        checks.duplicate_audit(contracts, "items", split.ITEM_COLUMNS),
        checks.duplicate_audit(contracts, "buyers", ["customer_id"]),
        checks.duplicate_audit(customers, "customers", ["customer_id"])])


@query
def dataset_checks(spark, sf_dir):
    base, model_input = _inputs(spark, sf_dir)
    snapshot, encoded = model_input.snapshot, stage_bucketed(model_input.features, "encoded", "customer_id")
    codes = labels.code_list(base.labels, target_only=True)
    pairs = targets.modelling_table(encoded, model_input.pairs).groupBy("customer_id", "target_category").agg(
        F.count(F.lit(1)).alias("_n"), F.max("target").alias("target"))
    # Candidates of the test customers: the first of a row also stands for the row.
    sides = split.group_split(snapshot.ids).select("customer_id", "split", F.posexplode(
        F.when(F.col("split") == "test", F.array(*[F.lit(c) for c in codes])).otherwise(F.array(F.lit(0)))))
    row, is_test = F.col("pos") == 0, F.col("split") == "test"
    count = lambda condition: F.when(condition, 1).otherwise(0)
    measure, nulls = checks.Measure, [F.col(c).isNull() for c in [*CATEGORICAL, *dataset.SUMMARY_COLUMNS]]
    ledger = checks.ledger("customer_id", [
        (snapshot.customers, [checks.rows_of("customers"), measure("months", "set", F.col("ref_month"))]),
        (snapshot.history, [checks.rows_of("history"), measure("last", "max", F.col("contract_date"))]),
        (snapshot.target, [checks.rows_of("target"), measure("first", "min", F.col("contract_date")),
                           measure("latest", "max", F.col("contract_date"))]),
        (encoded, [checks.rows_of("features"), measure("nulls", "sum", count(reduce(operator.or_, nulls))),
                   measure("no_balance", "sum", count(F.col("balance").isNull())),
                   measure("no_product", "sum", count(F.col("product_1") == 0))]),
        (pairs, [measure("repeated", "sum", count(F.col("_n") > 1)),
                 measure("codes", "set", F.when(F.col("target") == 1, F.col("target_category")))]),
        (sides, [measure("train", "sum", count(row & ~is_test)), measure("test", "sum", count(row & is_test)),
                 measure("candidates", "sum", count(is_test))])])
    here = lambda name: F.coalesce(F.col(name), F.lit(0)) > 0
    total = lambda name: F.sum(name)
    bought = checks.values_of("codes")
    second = F.filter(bought, lambda code: code > FIRST_STAGE_CODES)
    return checks.verdicts(ledger, {
        "history before target": checks.unless(F.max("last") < F.min("first")),
        "target spans six periods": checks.unless(whole_periods(F.min("first"), F.max("latest")) == 6),
        "one reference month": F.abs(F.size(checks.values_of("months")) - 1),
        "customers unique": F.count_if(F.col("customers") > 1),
        "features keep rows": F.abs(total("features") - total("customers")),
        "no nulls in encoded features": total("nulls"),
        "no null balance": total("no_balance"),
        "a newest product for everyone": total("no_product"),
        "pairs unique": total("repeated"),
        "train and test disjoint": F.count_if(here("train") & here("test")),
        "candidates complete": F.abs(total("candidates") - total("test") * len(codes)),
        "split covers all": F.abs(total("train") + total("test") - total("customers")),
        "classes contiguous": checks.unless((F.array_min(second) == FIRST_STAGE_CODES + 1) & (
            F.array_max(second) == F.size(second) + FIRST_STAGE_CODES)),
        "target has all customers": F.count_if(here("customers") != here("target")),
        "history has all customers": F.count_if(here("customers") != here("history")),
        "every label occurs": F.size(F.array_except(F.array(*[F.lit(c) for c in codes]), bought))})


@query
def column_profile(spark, sf_dir):
    customers = tables.customers(spark, sf_dir, DEVELOPMENT).drop("identity_code")
    orders = tables.table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_totalprice", F.col("o_orderdate").cast("date").alias("contract_date"))
    result = profile.column_profile(customers).unionByName(profile.column_profile(orders, ()))
    return result.select("column_name", "kind", "value", F.round("share", 9).alias("share"),
                         F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"))


@query
def merged_profile(spark, sf_dir):
    """Profile of all orders, merged from the states of four parts of them as if they had come one by one."""
    orders = tables.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", F.col("o_orderdate").cast("date").alias("contract_date"))
    part = F.pmod("o_orderkey", F.lit(4))
    states = [stage(profile.profile_state(orders.filter(part == i), ("o_orderkey",)), "state") for i in range(4)]
    result = profile.profile_of_state(profile.merge_states(profile.merge_states(*states[:3]), states[3]))
    return result.select("column_name", "kind", "value", F.round("share", 9).alias("share"),
                         F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"))


CONTRACT_SAMPLE = {"category": "string", "contract_date": "date"}
CUSTOMER_SAMPLE = {"ref_month": "string", "segment": "string", "nation": "string", "balance": "double"}


def _sample(spark: SparkSession, sf_dir: str) -> tuple[Base, profile.Sample]:
    base = _base(spark, sf_dir)
    snapshot = base.snapshot(spark, sf_dir)
    found = {"customers": snapshot.customers.select(*CUSTOMER_SAMPLE), "history": snapshot.history.select(*CONTRACT_SAMPLE),
             "target": snapshot.target.select(*CONTRACT_SAMPLE)}
    profiles = {name: stage(profile.column_profile(frame), "profile") for name, frame in found.items()}
    columns = {"customers": CUSTOMER_SAMPLE, "history": CONTRACT_SAMPLE, "target": CONTRACT_SAMPLE}
    return base, profile.sample_month(spark, profiles, columns, snapshot.customers.count(), DEVELOPMENT)


@query
def synthesize(spark, sf_dir):
    base, sample = _sample(spark, sf_dir)
    coded = labels.encode_category(sample.target, base.labels, target_only=True)
    return coded.select("customer_id", "category", "category_code", _day("contract_date"))


@query
def synthesize_history(spark, sf_dir):
    base, sample = _sample(spark, sf_dir)
    coded = labels.encode_category(sample.history, base.labels)
    return coded.select("customer_id", "category", "category_code", _day("contract_date"))


@query
def synthesize_customers(spark, sf_dir):
    return _sample(spark, sf_dir)[1].customers.withColumn("balance", F.round("balance", 2))


@query
def synthesize_checks(spark, sf_dir):
    base, sample = _sample(spark, sf_dir)
    codes = labels.code_list(base.labels, target_only=True)
    coded = labels.encode_category(sample.target, base.labels, target_only=True)
    here = lambda name: F.coalesce(F.col(name), F.lit(0)) > 0
    ledger = checks.ledger("customer_id", [
        (sample.customers, [checks.rows_of("customers")]),
        (sample.history, [checks.rows_of("history"), checks.Measure("last", "max", F.col("contract_date"))]),
        (coded, [checks.rows_of("target"), checks.Measure("first", "min", F.col("contract_date")),
                 checks.Measure("codes", "set", F.col("category_code"))])])
    bought = checks.values_of("codes")
    return checks.verdicts(ledger, {
        "customers unique": F.count_if(F.col("customers") > 1),
        "target has all customers": F.count_if(here("customers") != here("target")),
        "history has all customers": F.count_if(here("customers") != here("history")),
        "history up to target": checks.unless(F.max("last") <= F.min("first")),
        "every label occurs": F.size(F.array_except(F.array(*[F.lit(c) for c in codes]), bought))})


# Models

SPARSE = [*CATEGORICAL, *features.product_columns(), "target_category"]
DENSE = [*NUMERIC, *dataset.SUMMARY_COLUMNS]


@query
def fm_recommend(spark, sf_dir):
    base, model_input = _inputs(spark, sf_dir)
    table = stage(dataset.split_table(model_input), "table")
    model = models.fit_first_stage(table.filter("split = 'train'"), SPARSE, DENSE)
    test = cand.entity_rows(table.filter("split = 'test'"))
    codes = labels.code_list(base.labels, target_only=True)
    scored = models.score(cand.candidates(test, codes), model, [*SPARSE, *DENSE])
    return labels.decode_category(cand.best_candidate(scored), base.labels, "target_category", "pred_item").select(
        "customer_id", "pred_item", "score")


@query
def second_stage_recommend(spark, sf_dir):
    base, model_input = _inputs(spark, sf_dir)
    table = stage(dataset.split_table(model_input), "table")
    train = evaluate.multi_class_input(cand.positives(table.filter("split = 'train'")), FIRST_STAGE_CODES)
    model = models.fit_multi_class(train, FEATURES)
    test = cand.entity_rows(table.filter("split = 'test'"))
    picked = models.predict_class(test, model, FEATURES).select(
        "customer_id", (F.col("pred_class") + FIRST_STAGE_CODES + 1).alias("target_category"))
    return labels.decode_category(picked, base.labels, "target_category", "second_item").select(
        "customer_id", "second_item")


@query
def second_stage_chain(spark, sf_dir):
    base, model_input = _inputs(spark, sf_dir)
    table = stage(dataset.split_table(model_input), "table")
    codes = [code for code in labels.code_list(base.labels, target_only=True) if code > FIRST_STAGE_CODES]
    wide = stage(evaluate.multi_label_input(cand.entity_rows(table), table, codes), "wide")
    model = models.fit_chain(wide.filter("split = 'train'"), FEATURES, codes)
    scores = models.predict_chain(wide.filter("split = 'test'"), model, FEATURES, codes)
    picked = evaluate.highest_label(scores, codes).select("customer_id", F.col("pred_code").alias("target_category"))
    return labels.decode_category(picked, base.labels, "target_category", "second_item").select(
        "customer_id", "second_item")


@dataclass(frozen=True)
class Reloaded:
    """A model as it was fitted, the same one saved and loaded again, and the table it was trained on."""

    fitted: artefact.Artefact
    loaded: artefact.Artefact
    base: Base
    table: DataFrame


def _reloaded(spark: SparkSession, sf_dir: str, forest: bool = False) -> Reloaded:
    base = _base(spark, sf_dir, LATER)
    model_input, encoders = dataset.make_input(base.snapshot(spark, sf_dir), base.labels, CATEGORICAL, NUMERIC)
    table = stage(dataset.split_table(model_input), "table")
    settings = artefact.Settings(DEVELOPMENT, CATEGORICAL, NUMERIC, second_after=FIRST_STAGE_CODES)
    fitted = artefact.fit(table.filter("split = 'train'"), settings, base.labels, encoders, forest)
    path = stage_path(spark, "models")
    artefact.save(spark, fitted, path)
    return Reloaded(fitted, artefact.load(spark, path), base, table)


@query
def saved_model_scores(spark, sf_dir):
    """Scores of the later month by the fitted and by the reloaded model: one row a candidate, equal or not."""
    models_ = _reloaded(spark, sf_dir)
    customers, contracts = tables.customers(spark, sf_dir, LATER), models_.base.items
    one = models_.fitted.candidates(customers, contracts, LATER).select("customer_id", "target_category", "score")
    two = models_.loaded.candidates(customers, contracts, LATER).select(
        "customer_id", "target_category", F.col("score").alias("again"))
    return one.join(two, ["customer_id", "target_category"], "full").select(
        "customer_id", "target_category", F.coalesce(F.col("score") == F.col("again"), F.lit(False)).alias("equal"))


@query
def saved_model_features(spark, sf_dir):
    """Features of all customers of the later month by the reloaded encoders and label table."""
    models_ = _reloaded(spark, sf_dir)
    return models_.loaded.encode(tables.customers(spark, sf_dir, LATER), models_.base.items, LATER)


@query
def saved_model_recommend(spark, sf_dir):
    """Ranked categories of all customers of the later month by the reloaded model."""
    models_ = _reloaded(spark, sf_dir)
    return models_.loaded.recommend(tables.customers(spark, sf_dir, LATER), models_.base.items, LATER)


@query
def saved_model_second_stage(spark, sf_dir):
    """Second-stage picks of the test customers, by the fitted and by the reloaded forest: equal or not."""
    models_ = _reloaded(spark, sf_dir, forest=True)
    test = cand.entity_rows(models_.table.filter("split = 'test'")).drop("split")
    again = models_.loaded.second_picks(test).withColumnRenamed("second_item", "again")
    return models_.fitted.second_picks(test).join(again, "customer_id", "full").select(
        "customer_id", F.coalesce(F.col("second_item") == F.col("again"), F.lit(False)).alias("equal"))
