"""Whole runs from extract files to saved tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextpick import defaults
from nextpick.functions.dates import whole_periods
from nextpick.operators import checks, labels, profile, split, targets
from nextpick.plans import artefact, dataset, evaluation
from nextpick.sources import files
from nextpick.sources.stage import stage_bucketed


def load_month(spark: SparkSession, folder: str, ref_month: str, numeric: Sequence[str],
               encoding: str = files.CHARSET) -> tuple[DataFrame, DataFrame]:
    """(customers, contracts) of one month from its two extract files."""
    customers = files.read_customers(spark, f"{folder}/CUST_BASE_{ref_month}.csv", numeric, encoding)
    contracts = files.read_contracts(spark, f"{folder}/PROD_BASE_{ref_month}.csv", encoding)
    return customers, dataset.stage_contracts(contracts)


def month_checks(model_input: dataset.ModelInput, periods: int | None) -> DataFrame:
    """Checks a month has to pass before it is saved; with `periods` also those of development.

    All of them in one pass: each table is scanned once.
    """
    snapshot, measure = model_input.snapshot, checks.Measure
    pairs = model_input.pairs.groupBy("customer_id", "target_category").agg(F.count(F.lit(1)).alias("_n"))
    count = lambda condition: F.when(condition, 1).otherwise(0)
    ledger = checks.ledger("customer_id", [
        (snapshot.customers, [checks.rows_of("customers"), measure("months", "set", F.col("ref_month"))]),
        (snapshot.history, [measure("last", "max", F.col("contract_date"))]),
        (snapshot.target, [measure("first", "min", F.col("contract_date")), measure("latest", "max", F.col("contract_date")),
                           measure("no_code", "sum", count(F.col("category_code").isNull()))]),
        (model_input.features, [checks.rows_of("features")]),
        (pairs, [measure("repeated", "sum", count(F.col("_n") > 1))])])
    found = {
        "history before target": checks.unless(F.max("last") < F.min("first")),
        "one reference month": F.abs(F.size(checks.values_of("months")) - 1),
        "customers unique": F.count_if(F.col("customers") > 1),
        "features keep rows": F.abs(F.sum("features") - F.sum("customers")),
        "pairs unique": F.sum("repeated")}
    if periods is not None:
        found |= {"target spans the expected periods": checks.unless(whole_periods(F.min("first"), F.max("latest")) == periods),
                  "categories have codes": F.sum("no_code")}
    return checks.verdicts(ledger, found)


def save_month(spark: SparkSession, snapshot: dataset.Snapshot, label_table: DataFrame, output: str,
               categorical: Sequence[str], numeric: Sequence[str], encoders: dataset.Encoders | None,
               check: Callable[[dataset.ModelInput], DataFrame]) -> dataset.Encoders:
    """Save the modelling table, splits, summary and profiles of one month; the first one's encoders too.

    Raises before anything is saved if a check is violated.
    """
    first, ref_month = encoders is None, snapshot.ref_month
    model_input, encoders = dataset.make_input(snapshot, label_table, categorical, numeric, encoders)
    # Checks, tables, summary and profiles all read what was computed once.
    model_input = dataset.staged(model_input)
    snapshot, table = model_input.snapshot, model_input.table
    checks.raise_on_violation(check(model_input))
    files.write_dataset(table, f"{output}/dataset")
    files.write_table(targets.target_summary(snapshot.customers, model_input.pairs), f"{output}/summary/{ref_month}")
    parts = {"customers": snapshot.customers.select("ref_month", *categorical, *numeric),
             "history": snapshot.history.select("category", "contract_date"),
             "target": snapshot.target.select("category", "contract_date")}
    for name, frame in parts.items():
        files.write_profile(profile.column_profile(frame), f"{output}/profiles/{ref_month}/{name}")
    if first:
        files.write_table(encoders.categories, f"{output}/encoders/categories")
        files.write_table(encoders.ranges, f"{output}/encoders/ranges")
        files.write_splits(table.join(split.group_split(snapshot.ids), "customer_id"), f"{output}/splits")
    else:
        files.write_splits(table.withColumn("split", F.lit("later")), f"{output}/splits")
    return encoders


def make_input(spark: SparkSession, folder: str, output: str, development: str = "202305", later: str = "202308",
               data_name: str = "del_variable", categorical: Sequence[str] = tuple(defaults.CUSTOMER_CATEGORICAL),
               numeric: Sequence[str] = tuple(defaults.CUSTOMER_NUMERIC), periods: int | None = 5,
               encoding: str = files.CHARSET) -> None:
    """Extract files of two months to modelling tables, codes, encoders, splits, summaries and profiles.

    Codes and encoders are learned on the development month and applied to the later one.
    Raises before the tables of a month are saved if one of its checks is violated. Categories that
    appear only later are reported under ``unseen``.
    """
    classes, variant = defaults.EXCLUDED_CLASSES, defaults.variant_categories(data_name)
    categories = [*defaults.EXCLUDED_CATEGORIES, *variant]
    label_table = encoders = None
    for ref_month in (development, later):
        customers, contracts = load_month(spark, folder, ref_month, numeric, encoding)
        items = dataset.stage_items(contracts, classes, categories)
        if label_table is None:
            label_table = dataset.learn_item_labels(items, ref_month)
            files.write_table(label_table, f"{output}/labels")
        snapshot = dataset.item_snapshot(customers, items, ref_month, label_table)
        expected = periods if encoders is None else None
        encoders = save_month(spark, snapshot, label_table, output, categorical, numeric, encoders,
                              lambda made, expected=expected: month_checks(made, expected))
        audit = split.split_audit(split.contracts_until(contracts, ref_month), ref_month, classes,
                                  defaults.EXCLUDED_CATEGORIES, variant)
        population = split.population_audit(customers, items, ref_month)
        files.write_table(audit.unionByName(population, allowMissingColumns=True), f"{output}/audit/{ref_month}")
        files.write_table(dataset.unseen_categories(contracts, label_table), f"{output}/unseen/{ref_month}")


def sample_checks(model_input: dataset.ModelInput, codes: Sequence[int]) -> DataFrame:
    """Checks of a sample month: the same IDs in all three tables, and every target code occurs."""
    snapshot = model_input.snapshot
    ledger = checks.ledger("customer_id", [
        (snapshot.customers, [checks.rows_of("customers")]), (snapshot.history, [checks.rows_of("history")]),
        (snapshot.target, [checks.rows_of("target"), checks.Measure("codes", "set", F.col("category_code"))])])
    here = lambda name: F.coalesce(F.col(name), F.lit(0)) > 0
    listed = F.array(*[F.lit(c) for c in codes])
    return checks.verdicts(ledger, {
        "customers unique": F.count_if(F.col("customers") > 1),
        "target has all customers": F.count_if(here("customers") != here("target")),
        "history has all customers": F.count_if(here("customers") != here("history")),
        "every label occurs": F.size(F.array_except(listed, checks.values_of("codes")))})


def make_sample_input(spark: SparkSession, source: str, output: str, rows: int, development: str = "202305",
                      later: str = "202308", categorical: Sequence[str] = tuple(defaults.CUSTOMER_CATEGORICAL),
                      numeric: Sequence[str] = tuple(defaults.CUSTOMER_NUMERIC), seed: int = defaults.SEED) -> None:
    """As `make_input`, from `rows` synthetic customers a month instead of extract files.

    They are drawn from the label table and the profiles that `make_input` saved under `source`, which hold no rows of
    a customer, so a data set of any size can be built where the extracts may not go.
    """
    label_table, encoders = read_labels(spark, source), None
    files.write_table(label_table, f"{output}/labels")
    codes = target_codes(spark, source)
    dated = {"category": "string", "contract_date": "date"}
    columns = {"customers": {"ref_month": "string", **dict.fromkeys(categorical, "string"), **dict.fromkeys(numeric, "double")},
               "history": dated, "target": dated}
    for place, ref_month in enumerate((development, later)):
        found = {name: files.read_profile(spark, f"{source}/profiles/{ref_month}/{name}", profile.PROFILE_SCHEMA) for name in columns}
        sample = profile.sample_month(spark, found, columns, rows, ref_month, seed=seed + 10 * place)
        customers = stage_bucketed(sample.customers, "customers", "customer_id")
        history, target = [stage_bucketed(labels.encode_category(frame.distinct(), label_table, target_only=only), "sample", "customer_id")
                           for frame, only in ((sample.history, False), (sample.target, True))]
        snapshot = dataset.Snapshot(ref_month, customers.select("customer_id"), customers, history, target)
        encoders = save_month(spark, snapshot, label_table, output, categorical, numeric, encoders,
                              lambda made: sample_checks(made, codes))


def read_labels(spark: SparkSession, output: str) -> DataFrame:
    return files.read_table(spark, f"{output}/labels")


def target_codes(spark: SparkSession, output: str) -> list[int]:
    return labels.code_list(read_labels(spark, output), target_only=True)


def train(spark: SparkSession, output: str, ref_month: str = "202305",
          categorical: Sequence[str] = tuple(defaults.CUSTOMER_CATEGORICAL),
          numeric: Sequence[str] = tuple(defaults.CUSTOMER_NUMERIC), second_after: int | None = None,
          chain: bool = False, **first_stage) -> int:
    """Fit the models on the saved training split and save them under ``models``; the version.

    With `second_after` a forest is fitted for the codes above it, with `chain` also a chain of trees.
    """
    rows = files.read_split(spark, f"{output}/splits", "train")
    codes = [c for c in target_codes(spark, output) if second_after is not None and c > second_after]
    settings = artefact.Settings(ref_month, list(categorical), list(numeric), second_after=second_after,
                                 chain_codes=codes if chain else [])
    encoders = dataset.Encoders(files.read_table(spark, f"{output}/encoders/categories"),
                                files.read_table(spark, f"{output}/encoders/ranges"))
    made = artefact.fit(rows, settings, read_labels(spark, output), encoders, second_after is not None, chain,
                        **first_stage)
    return artefact.save(spark, made, f"{output}/models", rows.count())


def evaluate(spark: SparkSession, output: str, side: str = "test", version: int | None = None,
             baseline: DataFrame | None = None, allowed: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Reports of a saved model on a saved split, ``test`` or ``later``, saved under ``reports``."""
    made = artefact.load(spark, f"{output}/models", version)
    found = evaluation.evaluate_split(files.read_split(spark, f"{output}/splits", side),
                                      files.read_split(spark, f"{output}/splits", "train"), made.labels, made,
                                      baseline, allowed)
    for name, report in found.items():
        files.write_table(report, f"{output}/reports/{side}/{name}")
    return {name: files.read_table(spark, f"{output}/reports/{side}/{name}") for name in found}


def recommend(spark: SparkSession, folder: str, output: str, ref_month: str, version: int | None = None,
              encoding: str = files.CHARSET) -> DataFrame:
    """Ranked categories of all customers in a later month's extract files, by a saved model."""
    made = artefact.load(spark, f"{output}/models", version)
    customers, contracts = load_month(spark, folder, ref_month, made.settings.numeric, encoding)
    return made.recommend(customers, contracts, ref_month)
