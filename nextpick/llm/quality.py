"""Document quality by a byte-level convolutional network over overlapping chunks of the whole text.

Every chunk's filters are max-pooled into a logit; a document's probability is the logistic of
its chunks' mean logit, weighted by their bytes. The network learns from a bounded sample: up to
PER_CLASS labelled documents of each class, SNIPPET characters of each and of these up to
SNIPPET_WINDOWS chunks at even steps, chosen by a hash of the text among the rows the caller
allows; null, empty or letterless texts are among them.

Null text is empty text, which scores as one chunk of padding. Without any labelled row the
score is 0.5. A document with several labels counts once per label. Repeated rows and null ids
give one result row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.llm.bytecnn import Network, Scorer, cut, train, windows_of
from nextpick.llm.common import crc_of_id, table, utf8
from nextpick.llm.language import sample

PER_CLASS = 1500
SNIPPET = 1536
SNIPPET_WINDOWS = 4
CHUNK = 256
STRIDE = 192
THRESHOLD = 0.3


def fit(rows: DataFrame, per_class: int = PER_CLASS) -> Network | None:
    """Network learned from (text, quality) of `rows`; null if both classes don't occur."""
    learned = sample(rows.filter(F.col("quality").isin(0, 1)), "quality", per_class, 2 * per_class, SNIPPET)
    if len({label for label, _ in learned}) < 2:
        return None
    windows, origin = windows_of([text.encode() for _, text in learned], CHUNK, STRIDE, SNIPPET_WINDOWS)
    labels = np.array([int(learned[i][0]) for i in origin])
    # The rarer class is repeated, so that both weigh the same.
    rare = np.flatnonzero(labels == (0 if (labels == 0).sum() < (labels == 1).sum() else 1))
    more = np.tile(rare, max(0, round((len(labels) - len(rare)) / max(1, len(rare))) - 1))
    order = np.concatenate([np.arange(len(labels)), more])
    return train(windows[order], labels[order], 2, n_filters=12, epochs=6)


def score(docs: DataFrame, net: Network | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns with the probability that quality is 1, for every row of `docs`."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    schema = docs.select(*keep).schema.add("score", "double")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net is not None else None
        for batch in batches:
            raw, starts, ends = utf8(batch.column("_text"))
            probability = np.full(len(batch), 0.5)
            if scorer is not None and len(batch):
                row, first, last = cut(starts, ends, CHUNK, STRIDE)
                logits = scorer.logits(raw, first, last).astype(np.float64)
                weight = np.maximum(last - first, 1).astype(np.float64)
                turns = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                odds = np.add.reduceat((logits[:, 1] - logits[:, 0]) * weight, turns) / np.add.reduceat(weight, turns)
                probability = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], pa.array(probability, pa.float64())], names=names)

    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_of_id(doc_id) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(text, quality) of a bounded sample of the labelled documents outside the held-out fold.

    Ids are drawn by hash from the labels alone, at most 4 x `per_class` of them, so that the texts
    need no shuffle to meet their labels.
    """
    marks = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select(
        "doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    share = F.lit(0)
    for r in marks.groupBy("quality").count().collect():
        share = F.when(F.col("quality") == r["quality"], min(1 << 31, int((1 << 31) * 1.5 * per_class / r["count"]) + 1)).otherwise(share)
    drawn = marks.filter(hashed < share).orderBy(hashed, "doc_id", "quality").limit(4 * per_class)
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "quality")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document; see `score`."""
    docs = table(spark, sf_dir, "documents")
    net = fit(labelled(docs, table(spark, sf_dir, "labels")))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(rows, net, ("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
