"""Fitted models with all that scoring needs, saved together under one version.

A version is a folder with the first stage, the second stages, the encoders, the label table and the
settings. Its row in the table of versions is written last: a save that was broken off leaves a
folder that no one finds, and the next save takes its number again. Everything is Spark ML's own format or
parquet, so another session, or a cluster of another size, loads it from shared storage.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextpick.defaults import LAST_PRODUCTS
from nextpick.operators import candidates as cand
from nextpick.operators import evaluate, features, labels, models, split
from nextpick.plans import dataset, evaluation
from nextpick.plans.dataset import Encoders
from nextpick.sources import files
from nextpick.sources.stage import keep

VERSION_SCHEMA = "version int, ref_month string, rows bigint"


@dataclass(frozen=True)
class Settings:
    """What the models were trained on: the month, the input columns and the codes of the second stage."""

    ref_month: str
    categorical: list[str]
    numeric: list[str]
    last_products: int = LAST_PRODUCTS
    second_after: int | None = None  # codes above it belong to the second stages
    chain_codes: list[int] = field(default_factory=list)

    @property
    def products(self) -> list[str]:
        return features.product_columns(self.last_products)

    @property
    def dense(self) -> list[str]:
        return [*self.numeric, *dataset.SUMMARY_COLUMNS]

    @property
    def sparse(self) -> list[str]:
        return [*self.categorical, *self.products, "target_category"]

    @property
    def inputs(self) -> list[str]:
        """Inputs of the second stages: those of the first without the candidate's code."""
        return [*self.categorical, *self.dense, *self.products]


@dataclass(frozen=True)
class Artefact:
    """Models of one month with their encoders and label table; called on candidates, it scores them."""

    settings: Settings
    labels: DataFrame
    encoders: Encoders
    first: PipelineModel
    forest: PipelineModel | None = None
    chain: Sequence[PipelineModel] = ()

    @property
    def codes(self) -> list[int]:
        return labels.code_list(self.labels, target_only=True)

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """Add ``score`` to encoded candidates."""
        return models.score(pairs, self.first, [*self.settings.sparse, *self.settings.dense])

    def encode(self, customers: DataFrame, contracts: DataFrame, ref_month: str) -> DataFrame:
        """Encoded features of all `customers` of a month from their contracts up to its end.

        Nothing is learned: values and categories that training did not see get the codes for
        unknown, and a customer without history has no products and a null summary.
        """
        history, _ = split.temporal_split(contracts, ref_month)
        items = labels.encode_category(history.select(*split.ITEM_COLUMNS).distinct(), self.labels)
        snapshot = dataset.Snapshot(ref_month, customers.select("customer_id"), customers, items, items.limit(0))
        made, _ = dataset.make_features(snapshot, self.settings.categorical, self.settings.numeric, self.encoders,
                                        self.settings.last_products)
        return made

    def candidates(self, customers: DataFrame, contracts: DataFrame, ref_month: str) -> DataFrame:
        """Scored candidates of a later month: every customer with every target code."""
        return self(cand.candidates(self.encode(customers, contracts, ref_month), self.codes))

    def recommend(self, customers: DataFrame, contracts: DataFrame, ref_month: str) -> DataFrame:
        """Ranked list of all target categories for each customer of a later month."""
        ranked = cand.rank_candidates(self.candidates(customers, contracts, ref_month))
        named = labels.decode_category(ranked, self.labels, "target_category", "prdct")
        return named.select("customer_id", "result_rank", "prdct", "score")

    def recommend_one(self, customer_id, customers: DataFrame, items: DataFrame, ref_month: str) -> DataFrame:
        """`recommend` for one customer by point look-ups: its row of `customers`, its items of bucketed `items`."""
        return self.recommend(evaluation.items_of(customers, customer_id), evaluation.items_of(items, customer_id), ref_month)

    def second_picks(self, encoded: DataFrame, chain: bool = False) -> DataFrame:
        """(customer_id, second_item): the second stage's pick by name, from the forest or the chain."""
        if chain:
            scores = models.predict_chain(encoded, self.chain, self.settings.inputs, self.settings.chain_codes)
            picked = evaluate.highest_label(scores, self.settings.chain_codes).select(
                "customer_id", F.col("pred_code").alias("target_category"))
        else:
            picked = models.predict_class(encoded, self.forest, self.settings.inputs).select(
                "customer_id", (F.col("pred_class") + self.settings.second_after + 1).alias("target_category"))
        return labels.decode_category(picked, self.labels, "target_category", "second_item").select(
            "customer_id", "second_item")


def fit(train: DataFrame, settings: Settings, label_table: DataFrame, encoders: Encoders, forest: bool = False,
        chain: bool = False, **first_stage) -> Artefact:
    """Fit the first stage, and the second stages that are asked for, on modelling-table rows."""
    first = models.fit_first_stage(train, settings.sparse, settings.dense, **first_stage)
    classes = links = None
    if forest:
        classes = models.fit_multi_class(evaluate.multi_class_input(cand.positives(train), settings.second_after),
                                         settings.inputs)
    if chain:
        wide = evaluate.multi_label_input(cand.entity_rows(train), train, settings.chain_codes)
        links = models.fit_chain(wide, settings.inputs, settings.chain_codes)
    return Artefact(settings, label_table, encoders, first, classes, links or ())


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, ref_month, rows) of everything saved under `path`."""
    try:
        return spark.read.schema(VERSION_SCHEMA).parquet(f"{path}/versions")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], VERSION_SCHEMA)


def save(spark: SparkSession, made: Artefact, path: str, rows: int | None = None) -> int:
    """Save under the next version number, which is returned. One writer at a time.

    `rows` is the number of training rows, for the record.
    """
    version = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    folder = f"{path}/{version}"
    files.write_table(made.labels, f"{folder}/labels")
    files.write_table(made.encoders.categories, f"{folder}/categories")
    files.write_table(made.encoders.ranges, f"{folder}/ranges")
    saved = {"first": made.first, "forest": made.forest,
             **{f"chain/{place}": model for place, model in enumerate(made.chain)}}
    for name, model in saved.items():
        if model is not None:
            model.write().overwrite().save(f"{folder}/{name}")
    settings = {**asdict(made.settings), "forest": made.forest is not None, "chain": len(made.chain)}
    spark.createDataFrame([(json.dumps(settings),)], "value string").write.mode("overwrite").text(f"{folder}/settings")
    spark.createDataFrame([(version, made.settings.ref_month, rows)], VERSION_SCHEMA).coalesce(1).write.mode(
        "append").parquet(f"{path}/versions")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> Artefact:
    """A saved version, by default the newest."""
    known = versions(spark, path)
    if version is None:
        version = known.agg(F.max("version")).first()[0]
    if version is None or known.filter(F.col("version") == version).isEmpty():
        raise ValueError(f"no version {'' if version is None else version} under {path}".replace("  ", " "))
    folder = f"{path}/{version}"
    settings = json.loads(spark.read.text(f"{folder}/settings").first().value)
    forest, links = settings.pop("forest"), settings.pop("chain")
    return Artefact(
        Settings(**settings), keep(files.read_table(spark, f"{folder}/labels"), "labels"),
        Encoders(keep(files.read_table(spark, f"{folder}/categories"), "categories"),
                 keep(files.read_table(spark, f"{folder}/ranges"), "ranges")),
        PipelineModel.load(f"{folder}/first"), PipelineModel.load(f"{folder}/forest") if forest else None,
        [PipelineModel.load(f"{folder}/chain/{place}") for place in range(links)])
