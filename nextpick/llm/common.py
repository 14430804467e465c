"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextpick.operators.joins import HOT_SHARE

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def hot_classes(classes: DataFrame, key: str, copies: str) -> list:
    """Keys of the classes (one row each) that hold more than HOT_SHARE of all rows, by their number of copies; at most 1 / HOT_SHARE."""
    total = classes.agg(F.sum(copies)).first()[0] or 0
    return sorted(r[0] for r in classes.filter(F.col(copies) > total * HOT_SHARE).select(key).collect())


def once(key: str, make: Callable):
    """Object that a Python worker makes once and keeps for its later tasks."""
    kept = sys.__dict__.setdefault("_nextpick_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column with each row's start and end; nulls are empty."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    starts, ends = at[:-1].copy(), at[1:].copy()
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        ends[gone] = starts[gone]
    return raw, starts, ends
