"""SimHash near-duplicates by vantage-point partition of 64-bit fingerprints.

Fingerprints: a bit is set if it is set in over half of the hashes of a text's three-word
shingles. Equal fingerprints are one point, so a group of copies is one row from there on.

Points are dealt to shards by a vantage-point tree: at every node the points within a radius of
the vantage point go to the near side, the others to the far side, and far points within the
radius plus `bits` are also given to the near side. By the triangle inequality any two points at
`bits` or fewer bits then meet in a shard: nothing is lost. The tree is built on the driver from
a bounded sample of points (SAMPLE); its size follows the number of points, so shards keep about
SHARD points. In a shard the same partition goes on down to LEAF points, whose pairs are compared
exactly, blockwise. A shard of more than CROWD points, which the tree could not split, is dealt to
blocks, and every pair of blocks is a group of its own. A group emits a spanning forest of its links, one row per point at most,
never all pairs; components of the forests are those of all links.

A vantage point splits only if that saves pairs (a sample at one distance doesn't); otherwise the
node ends in a shard, and the shard's own tree, with other vantage points, or the blocks handle it.

Edges: a text without words (null, empty, white space) has fingerprint zero and links like any
other. Rows that repeat an id get the same component. A null id is never a component's id; where
all ids are null the component is null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.llm.common import hot_classes, table, utf8
from nextpick.llm.components import components
from nextpick.operators.joins import hot_keys, salted_join
from nextpick.sources.stage import stage

BITS = 2
SHINGLE = 3
SEED = 42
SHARD = 4096
LEAF = 512
SAMPLE = 1 << 17
CROWD = 1 << 16
_CHUNK = 1 << 17


#: The bits of every byte value, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = np.arange(8) * 256


def bit_majority(digests: list[bytes]) -> int:
    """Bits that are set in over half of the 64-bit digests (big-endian); 0 for none."""
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, len(digests), _CHUNK):
        part = np.frombuffer(b"".join(digests[at:at + _CHUNK]), np.uint8).reshape(-1, 8)
        counts += np.bincount((part + _COLUMN).ravel(), minlength=2048).reshape(8, 256)
    return int.from_bytes(np.packbits((counts @ _BITS).ravel() * 2 > len(digests)).tobytes(), "big")


def fingerprint(text: bytes) -> int:
    """SimHash of a text's words, A-Z lower-cased, in three-word shingles."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    digest, join = xxhash.xxh64_digest, b" ".join
    if not words:
        return 0
    if len(words) < SHINGLE:
        return bit_majority([digest(join(words), SEED)])
    return bit_majority([digest(join(three), SEED) for three in zip(words, words[1:], words[2:], strict=False)])


def fingerprints(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns and fp, the 64 bits as a signed number, for every row of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, ends = utf8(batch.column("text"))
            made = [fingerprint(raw[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], pa.array(np.array(made, np.uint64).view(np.int64))],
                                             names=[*keep, "fp"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("fp", T.LongType())])
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)


def _distances(points: np.ndarray, one) -> np.ndarray:
    return np.bitwise_count(points ^ one)


def _radius(distances: np.ndarray, bits: int) -> int | None:
    """Radius that leaves the fewest pairs to compare on both sides. None unless it saves a tenth of
    them, so that splitting again and again never costs more than comparing all pairs."""
    inside = np.cumsum(np.bincount(distances, minlength=66)).astype(np.float64)
    best, found = 0.9 * len(distances) ** 2, None
    for r in range(64):
        near, far = inside[min(r + bits, 65)], len(distances) - inside[r]
        if inside[r] and far and near ** 2 + far ** 2 < best:
            best, found = near ** 2 + far ** 2, r
    return found


def build_tree(sample: np.ndarray, depth: int, bits: int = BITS, seed: int = 0) -> dict:
    """Tree of vantage points over a sample: inner nodes (vantage, radius, near, far), leaves numbered."""
    rng = np.random.default_rng(seed)
    number = iter(range(1 << 30))

    def grow(points: np.ndarray, left: int) -> dict:
        if left > 0 and len(points) >= 8:
            for vantage in rng.choice(points, 3):
                distances = _distances(points, vantage)
                radius = _radius(distances, bits)
                if radius is not None:
                    near = distances <= radius + bits
                    return {"vantage": vantage, "radius": radius, "near": grow(points[near], left - 1),
                            "far": grow(points[distances > radius], left - 1)}
        return {"leaf": next(number)}

    return grow(sample, depth)


def shards_of(tree: dict, points: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row of the point, shard) for every shard a point goes to."""
    rows, leaves = [], []

    def walk(node: dict, at: np.ndarray) -> None:
        if not len(at):
            return
        if "leaf" in node:
            rows.append(at)
            leaves.append(np.full(len(at), node["leaf"]))
            return
        distances = _distances(points[at], node["vantage"])
        walk(node["near"], at[distances <= node["radius"] + bits])
        walk(node["far"], at[distances > node["radius"]])

    walk(tree, np.arange(len(points)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(leaves)


def linked_pairs(points: np.ndarray, bits: int = BITS, leaf: int = LEAF) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of places (i, j) of all distinct points within `bits`; a pair may come more than once."""
    rng = np.random.default_rng(1)
    open_ = [np.arange(len(points))]
    while open_:
        at = open_.pop()
        if len(at) > leaf:
            distances = _distances(points[at], points[rng.choice(at)])
            radius = _radius(distances, bits)
            if radius is not None:
                open_ += [at[distances <= radius + bits], at[distances > radius]]
                continue
        for i in range(0, len(at), leaf):
            for j in range(i, len(at), leaf):
                a, b = np.nonzero(_distances(points[at[i:i + leaf], None], points[None, at[j:j + leaf]]) <= bits)
                a, b = at[i + a], at[j + b]
                keep = a < b if i == j else np.ones(len(a), bool)
                if keep.any():
                    yield a[keep], b[keep]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Root of each of n places, the smallest place it is linked with."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            low = np.minimum(ra, rb)
            if (ra == rb).all():
                break
            np.minimum.at(root, ra, low)
            np.minimum.at(root, rb, low)
            while (root[root] != root).any():
                root = root[root]
    return root


def _shard_links(group: pd.DataFrame) -> pd.DataFrame:
    points = np.unique(group["fp"].to_numpy(np.int64).view(np.uint64))
    root = forest(len(points), linked_pairs(points))
    at = np.flatnonzero(root != np.arange(len(points)))
    return pd.DataFrame({"a": points[at].view(np.int64), "b": points[root[at]].view(np.int64)})


def links(points: DataFrame) -> DataFrame:
    """(a, b): a spanning forest, shard by shard, of all points (fp, distinct) within BITS bits."""
    count = points.count()
    depth = max(0, int(np.ceil(np.log2(max(1, count / SHARD)))))
    share = min(1.0, max(64.0 * count / SHARD, 4096) / max(1, count), SAMPLE / max(1, count))
    # Points are hashes already; another hash of them draws the sample.
    drawn = points.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy("fp").limit(2 * SAMPLE) if depth else None
    tree = build_tree(drawn.toPandas()["fp"].to_numpy(np.int64).view(np.uint64), depth + 1) if depth else {"leaf": 0}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            row, shard = shards_of(tree, own.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(own[row])], names=["shard", "fp"])

    dealt = stage(points.mapInArrow(deal, "shard bigint, fp bigint"), "simhash-shards")
    # One row at most per leaf of the tree, which the bounded sample limits.
    crowded = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("blocks")).filter("blocks > 1")
    sided = dealt.join(F.broadcast(crowded), "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    sided = sided.withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    paired = sided.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    groups = paired.select("shard", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "fp")
    return groups.groupBy("shard", "low", "high").applyInPandas(_shard_links, "a bigint, b bigint")


def classes(prints: DataFrame, first: Column) -> DataFrame:
    """(fp, class, copies): for every fingerprint of `prints`, the smallest `first` among the rows of its component, and its rows."""
    points = stage(prints.groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies")), "simhash-points")
    roots = components(links(points.select("fp")))
    labelled = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "first", "copies", F.coalesce("root", "fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("class"))
    return salted_join(labelled, smallest, "root", hot_keys(roots, "root")).select("fp", "class", "copies")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id for every row of `docs`; a fingerprint that many rows share is dealt to several tasks."""
    prints = stage(fingerprints(docs), "simhash")
    found = stage(classes(prints, F.col("doc_id")), "simhash-classes")
    return salted_join(prints, found.drop("copies"), "fp", hot_classes(found, "fp", "copies")).select(
        "doc_id", "fp", F.col("class").alias("component_id"))


def one_of_each(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`columns` of one row of every component: the one with the smallest id, null ids last.

    Rows are staged with their fingerprint and a number that stays theirs, so that repeated rows
    and null ids can be told apart.
    """
    prints = stage(fingerprints(docs, columns).withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    kept = classes(prints.select("doc_id", "_row", "fp"), order).select(F.col("class.row").alias("_row")).distinct()
    return prints.join(kept, "_row", "left_semi").select(*columns)


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """Component of every document; see `near_duplicates`."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
