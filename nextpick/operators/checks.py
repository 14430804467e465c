"""Data-quality checks: each returns (check_name, violations) and raises nothing by itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.functions.dates import whole_periods


def require_columns(frame: DataFrame, columns: Sequence[str], table: str) -> None:
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ValueError(f"the {table} table must include {missing}")


def duplicate_audit(frame: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and rows beyond the first of each key.

    Rows are counted per key first, with a map-side combine.
    """
    counts = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                      F.count(F.lit(1)).alias("distinct_keys"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows")).select(
        F.lit(table).alias("table_name"), "row_count", "distinct_keys", "duplicate_rows")


def _result(frame: DataFrame, name: str, violations: Column) -> DataFrame:
    return frame.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations")


def expect_no_rows(frame: DataFrame, name: str) -> DataFrame:
    return _result(frame, name, F.count(F.lit(1)))


def expect_no_match(frame: DataFrame, condition: Column, name: str) -> DataFrame:
    return _result(frame, name, F.count_if(condition))


def expect_history_before_target(history: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """1 unless the last history date is before the first target date."""
    first = target.agg(F.min("contract_date")).scalar()
    return _result(history, name, (~(F.max("contract_date") < first)).cast("int"))


def expect_periods(target: DataFrame, expected: int, name: str) -> DataFrame:
    """1 unless the target dates span `expected` whole 30-day periods."""
    spanned = whole_periods(F.min("contract_date"), F.max("contract_date"))
    return _result(target, name, (spanned != expected).cast("int"))


def expect_single_value(frame: DataFrame, column: str, name: str) -> DataFrame:
    """Number of distinct values beyond one."""
    return _result(frame, name, F.abs(F.count_distinct(column) - 1))


def expect_unique(frame: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of keys that occur more than once."""
    return expect_no_rows(frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), name)


def expect_no_duplicates(frame: DataFrame, name: str) -> DataFrame:
    return expect_unique(frame, frame.columns, name)


def expect_row_count(frame: DataFrame, expected: Column, name: str) -> DataFrame:
    """Difference between the number of rows and `expected`."""
    return _result(frame, name, F.abs(F.count(F.lit(1)) - expected))


def row_count(frame: DataFrame) -> Column:
    """Row count of a table as a scalar for other checks."""
    return frame.agg(F.count(F.lit(1))).scalar()


def expect_same_ids(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """IDs that only one of the two tables has."""
    ids = (left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
           .unionByName(right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
           .groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r")))
    return expect_no_match(ids, F.col("_l") != F.col("_r"), name)


def expect_disjoint(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """IDs that both tables have."""
    return expect_no_rows(left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi"), name)


def expect_contiguous(frame: DataFrame, column: str, name: str) -> DataFrame:
    """1 unless the values are 0..n-1."""
    good = (F.min(column) == 0) & (F.max(column) == F.count_distinct(column) - 1)
    return _result(frame, name, (~good).cast("int"))


# Many checks in one pass: every table adds measures per key, and the checks are sums over the merged rows.

_MERGES = {"sum": F.sum, "min": F.min, "max": F.max, "set": lambda c: F.array_distinct(F.flatten(F.collect_list(c)))}


@dataclass(frozen=True)
class Measure:
    """`value` of a table's rows, put together per key: ``sum``, ``min``, ``max`` or ``set`` (keep sets small)."""

    name: str
    how: str
    value: Column

    def of_rows(self) -> Column:
        return (F.collect_set if self.how == "set" else _MERGES[self.how])(self.value).alias(self.name)

    def merged(self) -> Column:
        found = _MERGES[self.how](F.col(self.name))
        return (F.coalesce(found, F.lit(0)) if self.how == "sum" else found).alias(self.name)


def rows_of(name: str) -> Measure:
    return Measure(name, "sum", F.lit(1).cast("bigint"))


def ledger(key: str, parts: Sequence[tuple[DataFrame, Sequence[Measure]]]) -> DataFrame:
    """One row per key of any of the tables with the measures of all; each table is scanned once.

    A table partitioned by the key is put together where it lies; what meets then is one row per key and table.
    """
    each = [frame.groupBy(key).agg(*[m.of_rows() for m in measures]) for frame, measures in parts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
    return rows.groupBy(key).agg(*[m.merged() for _, measures in parts for m in measures])


def verdicts(rows: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """(check_name, violations) of aggregates over a ledger, in one pass over it."""
    found = F.array(*[F.struct(F.lit(name).alias("check_name"), F.coalesce(count, F.lit(0)).cast("bigint").alias("violations"))
                      for name, count in violations.items()])
    return rows.agg(found.alias("_found")).select(F.inline("_found"))


def values_of(sets: str) -> Column:
    """All values of a ledger's sets; for sets of few different values."""
    return F.array_distinct(F.flatten(F.collect_set(sets)))


def unless(good: Column) -> Column:
    """1 unless `good`."""
    return F.when(good, 0).otherwise(1)


def combine(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def raise_on_violation(checks: DataFrame) -> None:
    """Run the checks and raise if any is violated; there is one row per check."""
    failed = checks.filter("violations > 0").collect()
    if failed:
        raise ValueError("; ".join(f"{row.check_name}: {row.violations}" for row in failed))
