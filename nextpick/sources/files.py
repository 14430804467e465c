"""Readers for the extract files and round trips of fitted tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.functions.dates import month_of, parse_day
from nextpick.operators.checks import require_columns

CHARSET = "EUC-KR"
# Charsets Spark reads without further settings.
_BUILT_IN = {"US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32"}

# Spellings the extract files use for a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Column names of the extract files and the names used here.
CUSTOMER_COLUMNS = {"ID": "customer_id", "마감년월": "ref_month"}
CONTRACT_COLUMNS = {"ID": "customer_id", "상품코드": "product_code", "상품분류": "product_class",
                    "상품중분류2": "category", "판매상품코드": "sales_code", "계약일자": "contract_date"}
BASELINE_COLUMNS = {"ID": "customer_id", "OLD": "old_item"}


def read_text_table(spark: SparkSession, path: str, encoding: str = CHARSET, key: str = "ID") -> DataFrame:
    """CSV with a header, every column as text; missing-value spellings become null except in `key`."""
    if encoding.upper() not in _BUILT_IN and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        raise ValueError(f"{encoding} files need spark.sql.legacy.javaCharsets=true, or convert them to UTF-8")
    names = spark.read.csv(path, header=True, encoding=encoding, inferSchema=False).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    frame = spark.read.schema(schema).csv(path, header=True, encoding=encoding)
    return frame.select(*[
        F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) if name == key
        else F.when(~F.col(f"`{name}`").isin(MISSING), F.col(f"`{name}`")).alias(name) for name in names])


def _rename(frame: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return frame.withColumnsRenamed(dict(columns))


def read_customers(spark: SparkSession, path: str, numeric: Sequence[str] = (), encoding: str = CHARSET,
                   columns: Mapping[str, str] = CUSTOMER_COLUMNS) -> DataFrame:
    """Customer snapshot of one month; IDs stay text, `numeric` columns become doubles."""
    frame = read_text_table(spark, path, encoding)
    require_columns(frame, ["ID"], "customer")
    frame = _rename(frame, columns)
    return frame.withColumns({name: F.col(name).cast("double") for name in numeric}) if numeric else frame


def read_contracts(spark: SparkSession, path: str, encoding: str = CHARSET,
                   columns: Mapping[str, str] = CONTRACT_COLUMNS) -> DataFrame:
    """Contracts without missing values, dates parsed from ``yyyyMMdd``."""
    frame = _rename(read_text_table(spark, path, encoding), columns)
    require_columns(frame, ["customer_id", "contract_date", "product_class", "category"], "contract")
    return frame.na.drop("any").withColumn("contract_date", parse_day(F.col("contract_date")))


def read_baseline(spark: SparkSession, path: str, encoding: str = CHARSET,
                  columns: Mapping[str, str] = BASELINE_COLUMNS) -> DataFrame:
    """The older recommender's pick per customer."""
    frame = _rename(read_text_table(spark, path, encoding), columns)
    require_columns(frame, ["customer_id", "old_item"], "baseline")
    return frame.select("customer_id", "old_item")


def read_remote(spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str,
                partitions: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    """Remote table in parallel slices of `partition_column`; filters and columns push down."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(properties or {}))


def write_dataset(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Modelling table, one folder per reference month; other months are left alone."""
    (frame.write.option("partitionOverwriteMode", "dynamic").partitionBy("ref_month").mode(mode).parquet(path))


def read_dataset(spark: SparkSession, path: str, ref_month: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("ref_month") == ref_month)


def write_contract_months(contracts: DataFrame, path: str) -> None:
    """Contracts in one folder per month of their date; a month that is written again replaces the old one.

    A month goes to as many files as its size asks for, so that a busy one is not one task's work.
    """
    dated = contracts.withColumn("month", month_of(F.col("contract_date"))).hint("rebalance", "month")
    dated.write.option("partitionOverwriteMode", "dynamic").partitionBy("month").mode("overwrite").parquet(path)


def read_contract_months(spark: SparkSession, path: str, since: str | None = None, until: str | None = None,
                         months: DataFrame | None = None) -> DataFrame:
    """Contracts of the months `since` to `until`, or of the ``month`` values in a table of `months`.

    Only the folders of these months are read: bounds prune them when the query is planned, a table when it runs.
    """
    # The folders' names are text: as numbers they could not be compared with bounds without a cast.
    schema = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "month" else f for f in schema])
    frame = spark.read.schema(schema).parquet(path)
    if since is not None:
        frame = frame.filter(F.col("month") >= since)
    if until is not None:
        frame = frame.filter(F.col("month") <= until)
    if months is not None:
        frame = frame.join(F.broadcast(months.select(F.col("month").cast("string")).distinct()), "month", "left_semi")
    return frame.drop("month")


def write_splits(frame: DataFrame, path: str) -> None:
    """Train, test and later-month rows, one folder per value of ``split``."""
    (frame.write.option("partitionOverwriteMode", "dynamic").partitionBy("split").mode("overwrite").parquet(path))


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split).drop("split")


def write_table(frame: DataFrame, path: str) -> None:
    """Labels, encoders or scalers as a parquet table."""
    frame.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_profile(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").json(path)


def read_profile(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def export_shuffled(frame: DataFrame, path: str, seed: int, key: Sequence[str]) -> None:
    """Write rows in a seeded random order (for trainers that read files in sequence)."""
    from nextpick.functions.values import sample_hash

    frame.orderBy(sample_hash(seed, *key), *key).write.mode("overwrite").parquet(path)
