"""Embedding near-duplicates by spherical-cap filters.

Filters are directions made of CODES random product codes: each rotates the space, cuts it into
BLOCKS blocks with random codewords of their own, and a filter is one codeword per block. A vector
belongs to every filter whose direction it exceeds the cap's threshold for; list decoding finds
these by pruning codewords that the best remaining one can't lift over the threshold. Several
codes keep filters that share codewords from being missed together. Vectors of one label meet in filters, are compared there by cosine in double precision, and a pair counts in the first
filter it shares only.

Parameters follow the number of vectors: the threshold keeps a random vector's filters at about
BUCKET vectors, and the number of codewords gives a pair at the least cosine EXPECTED filters in
common on average, by integrating over the sphere. Missing all of them has a chance of a few in a
thousand; recall is measured in the tests.

Equal vectors of a label are one class with a number of copies, so a group of copies is one row.
A filter that holds more than BLOCK_ROWS classes is split into blocks, and pairs of blocks go to
separate tasks, so that no pair is lost and no task holds a whole group. A task gives one row per
class (links and a spanning forest), never pairs.

Edges: vectors that are null, empty, zero or hold null or non-finite components, and null labels,
link with nothing. Vectors of different lengths never link. An empty table gives none; columns beyond vec_id,
embedding and label are not looked at, whatever their names. Rows that repeat an id are vectors of
their own with one component; a null id is never a component's id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.llm.common import hot_classes, once, table
from nextpick.llm.components import components
from nextpick.llm.simhash import forest
from nextpick.operators.joins import hot_keys, salted_join
from nextpick.sources.stage import stage

THRESHOLD = 0.93
BLOCKS = 2
CODES = 16
EXPECTED = 12.0
BUCKET = 40
BLOCK_ROWS = 2048
LEAST_DIM = 12
_ROWS = 512
_PAIRS = 20_000


def _sphere(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid of a unit vector's first coordinate and its probabilities."""
    t = np.linspace(-1, 1, 4001)[1:-1]
    density = (1 - t * t) ** ((dim - 3) / 2)
    return t, density / density.sum()


def parameters(count: int, dim: int, threshold: float = THRESHOLD) -> tuple[float, int]:
    """Cap threshold (a cosine) and codewords per block for `count` vectors of one label."""
    t, mass = _sphere(dim)
    tail = np.cumsum(mass[::-1])[::-1]
    cap = float(t[np.searchsorted(-tail, -min(0.02, max(BUCKET / max(1, count), 1e-6)))])
    u, weight = _sphere(dim - 1)
    above = np.cumsum(weight[::-1])[::-1]
    inside = t >= cap
    need = (cap - threshold * t[inside]) / (math.sqrt(1 - threshold ** 2) * np.sqrt(1 - t[inside] ** 2))
    both = float((mass[inside] * above[np.minimum(np.searchsorted(u, need), len(u) - 1)] * (need < 1)).sum())
    return cap, max(2, math.ceil((EXPECTED / CODES / both) ** (1 / BLOCKS)))


class Code:
    """Product code of a dimension: rotation and codewords, the same on every machine."""

    def __init__(self, dim: int, words: int, seed: int = 3):
        rng = np.random.default_rng([seed, dim, words])
        self.dim, self.wide = dim, max(dim, LEAST_DIM)
        self.rotation = np.linalg.qr(rng.standard_normal((self.wide, self.wide)))[0][:dim]
        self.parts = np.array_split(np.arange(self.wide), BLOCKS)
        self.words = []
        for part in self.parts:
            drawn = rng.standard_normal((words, len(part)))
            self.words.append(drawn / np.linalg.norm(drawn, axis=1, keepdims=True) * math.sqrt(len(part) / self.wide))

    def decode(self, units: np.ndarray, cap: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter that a row's direction exceeds, in order of both."""
        turned = units @ self.rotation
        one, two = (turned[:, p] @ w.T for p, w in zip(self.parts, self.words, strict=True))
        rows, filters = [], []
        for at in range(0, len(units), _ROWS):
            s = slice(at, at + _ROWS)
            # A first codeword stays if the best second one can lift it over the cap.
            row, first = np.nonzero(one[s] >= cap - two[s].max(axis=1, keepdims=True))
            i, second = np.nonzero(one[s][row, first][:, None] + two[s][row] >= cap)
            rows.append(row[i] + at)
            filters.append(first[i] * one.shape[1] + second)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, filters = np.concatenate(rows), np.concatenate(filters)
        order = np.lexsort((filters, rows))
        return rows[order], filters[order]


def decode(units: np.ndarray, cap: float, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over all codes, in order of both; a filter's number tells its code too."""
    rows, filters = [], []
    for seed in range(CODES):
        code = once(f"caps-{units.shape[1]}-{words}-{seed}", lambda k=seed: Code(units.shape[1], words, k))
        row, own = code.decode(units, cap)
        rows.append(row)
        filters.append(own * CODES + seed)
    rows, filters = np.concatenate(rows), np.concatenate(filters)
    order = np.lexsort((filters, rows))
    return rows[order], filters[order]


def _decoder(settings: dict[int, tuple[float, int]]):
    """Arrow function: each class once per filter it belongs to, with those of its filters that come before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, np.float64) for v in batch.column("embedding").to_pylist()]
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                cap, words = settings[int(dim)]
                row, filters = decode(_units(np.array([vectors[i] for i in own])), cap, words)
                filters = filters.astype(np.int32)
                starts = np.searchsorted(row, row)
                for k in range(0, len(row), 4096):
                    part = np.arange(k, min(k + 4096, len(row)))
                    place = pa.array(own[row[part]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(n).take(place) for n in ("key", "label", "dim", "copies", "embedding")]
                        + [pa.array(filters[part]), pa.array([filters[starts[i]:i] for i in part], pa.list_(pa.int32()))],
                        names=["key", "label", "dim", "copies", "embedding", "filter", "earlier"])
    return run


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors at length 1; the largest component goes first, so that no norm overflows."""
    units = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return units / np.linalg.norm(units, axis=1, keepdims=True)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the offsets of its rows in them."""
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy(zero_copy_only=False)


def _met_before(earlier: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the classes a and b share a filter before this one, for each pair; `earlier` is padded by -1."""
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), _PAIRS):
        left, right = earlier[a[k:k + _PAIRS]], earlier[b[k:k + _PAIRS]]
        out[k:k + _PAIRS] = ((left[:, :, None] == right[:, None, :]) & (left >= 0)[:, :, None]).any(axis=(1, 2))
    return out


def _group_links(units: np.ndarray, copies: np.ndarray, side: np.ndarray, across: bool, earlier: np.ndarray,
                 threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked copies and root of each class of one filter, or of a pair of its blocks (`across`)."""
    linked, pairs = np.zeros(len(units), np.int64), []
    step = 1024
    for i in range(0, len(units), step):
        for j in range(i, len(units), step):
            a, b = np.nonzero(units[i:i + step] @ units[j:j + step].T >= threshold)
            a, b = a + i, b + j
            keep = a < b
            if across:
                keep &= side[a] != side[b]
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            first = ~_met_before(earlier, a, b)
            a, b = a[first], b[first]
            np.add.at(linked, a, copies[b])
            np.add.at(linked, b, copies[a])
            pairs.append((a, b))
    return linked, forest(len(units), iter(pairs)) if pairs else np.arange(len(units))


def _compare(threshold: float):
    """Arrow function over rows sorted by group: links of every group, many groups a batch.

    A group goes on in the next batch at most; it has no more rows than two blocks.
    """
    group = ["label", "dim", "filter", "low", "high"]

    def starts_of(rows: pa.RecordBatch) -> np.ndarray:
        changed = np.zeros(len(rows), bool)
        changed[:1] = True
        for name in group:
            column = rows.column(name).to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(changed)

    def compare(rows: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
        values, at = _lists(rows.column("embedding"))
        before, before_at = _lists(rows.column("earlier"))
        copies, side, low, high = (rows.column(n).to_numpy(zero_copy_only=False) for n in ("copies", "side", "low", "high"))
        found, roots, links_ = [], [], []
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s < 2:
                continue
            units = _units(values[at[s]:at[e]].reshape(e - s, -1).astype(np.float64))
            size = np.diff(before_at[s:e + 1])
            earlier = np.full((e - s, max(1, size.max())), -1, np.int32)
            earlier[np.arange(earlier.shape[1]) < size[:, None]] = before[before_at[s]:before_at[e]]
            linked, root = _group_links(units, copies[s:e], side[s:e], low[s] != high[s], earlier, threshold)
            own = np.flatnonzero(linked)
            found.append(own + s)
            roots.append(root[own] + s)
            links_.append(linked[own])
        own, root, linked = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (found, roots, links_))
        keys = rows.column("key")
        return pa.RecordBatch.from_arrays([keys.take(pa.array(own)), pa.array(linked), keys.take(pa.array(root))],
                                          names=["key", "linked", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            starts = starts_of(rows)
            if len(starts) > 1:
                yield compare(rows, starts)
            held = rows.slice(starts[-1])
        if held is not None:
            yield compare(held, np.array([0, len(held)]))

    return run


def links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, linked, root): copies linked to each class, and a forest of the links, filter by filter."""
    # Counts by length of vector and label size the filters; lengths are few.
    counts = classes.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    settings = {r["dim"]: parameters(r["n"], max(r["dim"], LEAST_DIM), threshold) for r in counts}
    schema = classes.select("key", "label", "dim", "copies", "embedding").schema
    schema = T.StructType([*schema.fields, T.StructField("filter", T.IntegerType()), T.StructField("earlier", T.ArrayType(T.IntegerType()))])
    members = classes.select("key", "label", "dim", "copies", "embedding").mapInArrow(_decoder(settings), schema)
    at = ["label", "dim", "filter"]
    crowded = members.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks")).filter("blocks > 1")
    crowded = stage(crowded, "crowded-filters")
    placed = members.join(crowded, at, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")}).drop("other", "blocks")
    # One pass over sorted rows: a filter holds some BUCKET rows, too few to pay for a call of its own.
    group = [*at, "low", "high"]
    return dealt.repartition(*group).sortWithinPartitions(*group, "key").mapInArrow(
        _compare(threshold), "key string, linked bigint, root string")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors`."""
    vector = F.col("embedding")
    sound = (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding", "label")
    usable = F.coalesce(sound & F.col("label").isNotNull(), F.lit(False))
    key = F.when(usable, F.concat(F.hex(F.xxhash64("label", "embedding")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "embedding", "label"))))
    keyed = rows.withColumn("key", key)
    classes = stage(keyed.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("first")).withColumn("dim", F.size("embedding")), "vector-classes")
    found = stage(links(classes, threshold), "vector-links")
    totals = found.groupBy("key").agg(F.sum("linked").alias("linked"))
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = classes.select("key", "copies", "first").join(totals, "key", "left").join(
        roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    results = salted_join(named, smallest, "root", hot_keys(roots, "root")).select(
        "key", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    joined = salted_join(keyed.select("vec_id", "key"), results, "key", hot_classes(classes, "key", "copies"), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
                         ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op9_caps(spark, sf_dir: str) -> DataFrame:
    """Links and component of every vector; see `near_duplicates`."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
