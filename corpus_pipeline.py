"""From documents to packed sequences: language ID, near-duplicates, secrets, mixing, packing.

Every stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of documents. An empty table gives an empty one, and columns beyond COLUMNS are not
looked at, whatever their names, in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextpick.llm import language, mixing, packing, secret_scan, simhash
from nextpick.llm.common import table
from nextpick.sources.stage import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the language found; those without text or a letter go.

    Repeated rows and null ids stay, row by row. Where the network knows no language the given one stays.
    """
    net, langs = language.fit(docs.filter(language.learnable(F.col("doc_id"))))
    found = language.predict(docs, net, langs, tuple(COLUMNS))
    spoken = F.col("text").rlike(r"\p{L}")
    told = F.when(F.col("lang_pred") != language.UNKNOWN, F.col("lang_pred")).otherwise(F.col("lang"))
    return found.filter(spoken).withColumn("lang", told).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: the one with the smallest id, null ids last.

    Links are those of the SimHash operator (three-word shingles, 2 bits). Of repeated rows, or rows without an id, one of
    the group stays. Texts without words (null, empty) are one group.
    """
    return simhash.one_of_each(docs, COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and their length counted again.

    A null text stays null, an empty one empty; repeated rows and null ids stay, row by row. Without a secret n_chars stays as it is.
    """
    clean = secret_scan.redact(docs, COLUMNS)
    counted = F.when(F.col("n_secrets") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", counted).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source, the last. Null and empty texts have no words and are taken never. Equal rows are
    ranked by seed and id, so which of them is taken more often doesn't matter.
    """
    return mixing.mixed(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their sequence and offset.

    A null text is an empty one: its closing id alone. Repeated rows, and rows without an id, have pieces of their own.
    """
    return packing.pack(docs)


STAGES = [("language", identify_language), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("mixing", mix_sources), ("packing", pack_sequences)]

ORACLE_SQL = None  # a trained network, tokens and a knapsack: tested stage by stage instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
