"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is its weight's share of all words, at most `most` times its own size; what is
over is shared again by weight. A source is taken in whole rounds as often as its target holds
it; the rest of the budget is fitted on counts of documents by exact length: a proportional share
of every length first, then the longest lengths that still fit, until less than DP_SPAN words
are open, and bounded-knapsack dynamic programming over those. It meets the target exactly
whenever the counts allow it. Which documents of a length are taken once more follows a seeded
hash.

Scale: documents are counted by (source, length) before any shuffle by source, so a group of the
fit holds a source's distinct lengths, not its documents. Documents are ranked in hash buckets of
about BUCKET_ROWS, so no length is sorted in one task. Only source totals are windowed whole.

Edges: null text has no words; null sources are one source, the last. Repeated rows (same id,
source and size) are counted once with their number and each gets its own take. Documents without
words are never taken. All targets are 0 if there are no words; they are 0 too for a source
without words.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextpick.llm.common import WORD, table
from nextpick.operators.numbering import number_rows
from nextpick.sources.stage import stage

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 11
DP_SPAN = 1 << 16
BUCKET_ROWS = 1000
BUCKETS = 1 << 20


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`totals` (source, source_size) with the target of each source.

    Sharing again until none is above its cap ends at one level: target = min(cap, level x
    weight). Sources are tried in the order of cap / weight; the first k are capped as long as
    the level of the rest stays above the next one's ratio.
    """
    named = totals.withColumn("_last", F.col("source").isNull().cast("int"))
    numbered = number_rows(named, ["_last", "source"], "_place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = numbered.withColumn("_weight", F.get(cycle, ((F.col("_place") - 1) % len(weights)).cast("int"))).withColumn(
        "_ratio", most * F.col("source_size") / F.col("_weight"))
    # One row per source; the level is one aggregate over running totals of that table.
    order = Window.orderBy("_ratio", "_place").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(most * F.col("source_size")).over(order), F.lit(0))) / (
        F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(order), F.lit(0.0)))
    levelled = weighted.withColumn("_level", level)
    found = levelled.filter(F.col("_level") <= F.col("_ratio")).agg(F.max("_level").alias("l")).scalar()
    return levelled.withColumn("target", F.least((most * F.col("source_size")).cast("double"), F.coalesce(
        found * F.col("_weight"), (most * F.col("source_size")).cast("double")))).select("source", "source_size", "target")


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their words come as near `budget` as the
    method allows, not over it. Sizes are distinct and positive."""
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.astype(np.int64)
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    left = counts - taken
    open_ = budget - int((taken * sizes).sum())
    for i in np.argsort(-sizes, kind="stable"):
        if open_ < DP_SPAN:
            break
        more = min(int(left[i]), (open_ - DP_SPAN // 2) // int(sizes[i]))
        if more > 0:
            taken[i] += more
            left[i] -= more
            open_ -= more * int(sizes[i])
    for i, more in _knapsack(sizes, left, open_):
        taken[i] += more
    return taken


def _knapsack(sizes: np.ndarray, left: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """Bounded knapsack by bit sets: what to take for the largest reachable sum up to `budget`."""
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in np.argsort(sizes, kind="stable"):
        size, rest, part = int(sizes[i]), min(int(left[i]), budget // int(sizes[i])), 1
        while rest > 0 and not reach >> budget & 1:
            part = min(part, rest)
            steps.append((int(i), part, size * part, reach))
            reach |= (reach << (size * part)) & mask
            rest -= part
            part *= 2
        if reach >> budget & 1:
            break
    at, out = reach.bit_length() - 1, []
    for i, part, words_, before in reversed(steps):
        if not before >> at & 1:
            out.append((i, part))
            at -= words_
    return out


def _fit(groups: pd.DataFrame) -> pd.DataFrame:
    """Quota of every size of one source: whole rounds, and documents taken once more."""
    target, whole = float(groups["target"].iloc[0]), int(groups["source_size"].iloc[0])
    sizes, counts = groups["size"].to_numpy(np.int64), groups["n"].to_numpy(np.int64)
    rounds = min(int(target // whole), MOST) if whole else 0
    more = np.zeros(len(sizes), np.int64)
    some = sizes > 0
    if whole and rounds < MOST:
        more[some] = fit_counts(sizes[some], counts[some], round(target) - rounds * whole)
    return pd.DataFrame({"source": groups["source"], "size": sizes, "n": counts, "rounds": rounds, "more": more,
                         "source_size": whole, "target": target})


def _takes(docs: DataFrame, weights: Sequence[float], seed: int) -> DataFrame:
    """One row per doc_id, source and size: its copies, the rounds all of them are taken and how
    many of them are taken once more (extra)."""
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    rows = stage(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "hash", F.xxhash64(F.lit(seed), "doc_id", "source")), "mix-sizes")
    cells = rows.groupBy("source", "size").agg(F.sum("copies").alias("n"))
    cells = stage(cells, "mix-cells")
    shares = targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights)
    same = lambda a, b, *names: [a[x].eqNullSafe(b[x]) for x in names]
    joined = cells.alias("c").join(shares.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        "c.source", "c.size", "c.n", "s.source_size", "s.target")
    quotas = stage(joined.groupBy("source").applyInPandas(
        _fit, "source string, size bigint, n bigint, rounds bigint, more bigint, source_size bigint, target double"), "mix-quotas")
    placed = rows.alias("r").join(quotas.alias("q"), (F.col("r.source").eqNullSafe(F.col("q.source"))) & (F.col("r.size") == F.col("q.size"))).select(
        "r.*", "q.n", "q.rounds", "q.more", "q.source_size", "q.target")
    placed = placed.withColumn("bucket", F.floor(F.pmod(F.col("hash"), F.lit(BUCKETS)) * F.ceil(F.col("n") / BUCKET_ROWS) / BUCKETS))
    part = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    settled = placed.filter(~part).withColumn("extra", F.when(F.col("more") > 0, F.col("copies")).otherwise(F.lit(0)).cast("bigint"))
    ranked = placed.filter(part)
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranked.groupBy("source", "size", "bucket").agg(F.sum("copies").alias("held"))
               .withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held"))
    inside = Window.partitionBy("source", "size", "bucket").orderBy("hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("earlier", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    ranked = ranked.alias("r").join(offsets.alias("o"), (F.col("r.source").eqNullSafe(F.col("o.source"))) & (F.col("r.size") == F.col("o.size")) & (
        F.col("r.bucket") == F.col("o.bucket"))).select("r.*", "o.offset")
    ranked = ranked.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("copies"), F.col("more") - F.col("offset") - F.col("earlier"))).cast("bigint")).drop("earlier", "offset")
    return settled.unionByName(ranked)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, one row per row of `docs`."""
    each = _takes(docs, weights, seed).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    times = F.when(F.col("size") > 0, F.col("rounds") + (F.col("nth") <= F.col("extra")).cast("bigint")).otherwise(F.lit(0))
    return each.select("doc_id", "source", "size", "source_size", "target", (times * F.col("size")).cast("bigint").alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their own columns only.

    Rows that repeat a key (id, source and size) share its takes. Only where some of them are taken
    once more than others are they numbered; that is one key at most of a source and size.
    """
    names = docs.columns
    key = ["_m_id", "_m_source", "_m_size"]
    takes = _takes(docs, weights, seed).filter((F.col("size") > 0) & (F.col("rounds") + F.col("extra") > 0)).select(
        *[F.col(c).alias(k) for c, k in zip(("doc_id", "source", "size"), key, strict=True)],
        *[F.col(c).alias(f"_m_{c}") for c in ("copies", "rounds", "extra")])
    rows = docs.withColumns({"_m_id": F.col("doc_id"), "_m_source": F.col("source"), "_m_size": words(F.col("text"))})
    on = [rows[k].eqNullSafe(takes[k]) for k in key]
    paired = rows.join(takes, on[0] & on[1] & on[2]).drop(*[takes[k] for k in key])
    partly = (F.col("_m_extra") > 0) & (F.col("_m_extra") < F.col("_m_copies"))
    inside = Window.partitionBy(*key).orderBy(F.xxhash64(*names))
    alike = paired.filter(~partly).withColumn("_m_more", F.col("_m_extra") > 0)
    unlike = paired.filter(partly).withColumn("_m_more", F.row_number().over(inside) <= F.col("_m_extra"))
    counted = alike.unionByName(unlike).withColumn("_m_times", F.col("_m_rounds") + F.col("_m_more").cast("bigint"))
    return counted.filter(F.col("_m_times") > 0).withColumn(
        "_m_each", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m_times")))).select(*names)


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents; see `mix`."""
    return mix(table(spark, sf_dir, "documents")).drop("source")
