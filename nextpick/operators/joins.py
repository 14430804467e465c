"""Joins of a large fact table to a table that is unique on the join key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 250_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.001
SALTS = 64
_FLAT = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType)


def _bytes(lookup: DataFrame) -> Column:
    """Bytes of a row's columns without a fixed width; arrays, maps and structs count as their JSON."""
    sizes = [F.octet_length(f.name) if isinstance(f.dataType, _FLAT) else F.octet_length(F.to_json(F.struct(f.name)))
             for f in lookup.schema.fields if isinstance(f.dataType, (*_FLAT, *_NESTED))]
    return sum((F.coalesce(size, F.lit(0)) for size in sizes), F.lit(0).cast("bigint"))


def fits_broadcast(lookup: DataFrame) -> bool:
    """Measure a lookup in one pass: at most BROADCAST_ROWS rows and BROADCAST_BYTES of text and nested values."""
    found = lookup.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_bytes(lookup)), F.lit(0)).alias("size")).first()
    return found["rows"] <= BROADCAST_ROWS and found["size"] <= BROADCAST_BYTES


def hot_keys(frame: DataFrame, key: str, share: float | None = None) -> list:
    """Values of `key` that hold more than `share` (HOT_SHARE) of the rows; at most ``1 / share``.

    A frequent-item sketch names the suspects in one pass without a shuffle (it never
    misses one), a second pass counts only the suspects.
    """
    share = share or HOT_SHARE
    suspects = frame.select(key).stat.freqItems([key], share).first()[0] or []
    suspects = [value for value in suspects if value is not None]
    if not suspects:
        return []
    suspect = F.when(F.col(key).isin(suspects), F.col(key)).alias(key)
    counts = frame.select(suspect).groupBy(key).count().collect()
    total = sum(row["count"] for row in counts)
    return sorted(row[key] for row in counts if row[key] is not None and row["count"] > total * share)


def _salt(frame: DataFrame, hot: Column, salts: int) -> Column:
    # The task number keeps the salt the same when a lost task runs again; the row hash
    # spreads one key's rows inside a task.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *frame.columns), F.lit(salts)).cast("int")
    return F.when(hot, spread).otherwise(F.lit(0))


def salted_join(fact: DataFrame, lookup: DataFrame, key: str | Sequence[str], hot: list,
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join in which the rows of the `hot` key values are spread over `salts` tasks.

    Only the lookup rows of hot keys are repeated, once per salt. Fact rows without a key
    never match; they are spread too, since an outer join still has to carry them.
    """
    if not hot and how in ("inner", "left_semi"):
        return fact.join(lookup, key, how)
    keys = [key] if isinstance(key, str) else list(key)
    lead = F.col(keys[0])
    is_hot = lead.isin(hot) if hot else F.lit(False)
    left = fact.withColumn("_salt", _salt(fact, lead.isNull() | is_hot, salts))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.withColumn("_salt", F.explode(copies))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(fact: DataFrame, lookup: DataFrame, key: str | Sequence[str], how: str = "inner",
                probe: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """Join `fact` to `lookup`, which holds each key at most once.

    A lookup measured to fit is broadcast, so `fact` is not shuffled. A larger one is joined
    by shuffle, with the keys that are frequent in `probe` salted (by default `fact`; pass the
    base table when `fact` is the result of other joins). `small` is the measurement, if
    the caller has made it already.
    """
    if fits_broadcast(lookup) if small is None else small:
        return fact.join(F.broadcast(lookup), key, how)
    lead = key if isinstance(key, str) else key[0]
    return salted_join(fact, lookup, key, hot_keys(fact if probe is None else probe, lead), how)
