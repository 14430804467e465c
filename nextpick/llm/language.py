"""Language ID by a byte convolutional network over fixed-length windows of the whole text.

The network learns every language from a bounded sample: up to PER_LANG documents of each, fewer
where that would make more than MOST_ROWS in all but never none, chosen by a hash of text alone
among the rows the caller allows, and SNIPPET characters of each, of which it sees up to
SNIPPET_WINDOWS windows at even steps. Prediction averages the windows' log probabilities, weighted
by their bytes, over all windows of a text.

Text that is null or has no letter is ``und`` with score 0. Without any learnable row all rows
are ``und``. Repeated rows and null ids give one result row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.llm.bytecnn import Network, Scorer, cut, train, windows_of
from nextpick.llm.common import crc_of_id, table, utf8

PER_LANG = 600
MOST_ROWS = 64 * PER_LANG
SNIPPET = 1024
SNIPPET_WINDOWS = 3
WINDOW = 128
UNKNOWN = "und"
_SPAN = 1 << 31


def sample(rows: DataFrame, label: str, per_label: int, most: int, snippet: int, spoken: bool = False) -> list[tuple[str, str]]:
    """(label, snippet) of about `per_label` rows of every label, in a repeatable order; `spoken`: of those with a letter.

    Null text is empty text. With many labels there are fewer of each, so that they are `most` in all,
    or one of each. Distinct texts are counted first (a sketch, 2% off), since copies count once in the sample too; then one
    pass keeps the rows whose text hash is under the label's share; about twice as many snippets as wanted reach
    the driver at most. Labels that this pass misses get a pass of their own. The snippet starts at a hashed place.
    """
    rows = rows.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.coalesce("text", F.lit("")).alias("text"))
    if spoken:
        rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    texts = F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("count")
    counts = rows.groupBy("label").agg(texts).orderBy(F.desc("count"), "label").collect()
    if not counts:
        return []
    per_label = max(1, min(per_label, most // len(counts)))
    wanted = max(1.2 * per_label, per_label + 16)  # by chance, a share holds fewer or more than it should
    shares = rows.sparkSession.createDataFrame(
        [(r["label"], min(_SPAN, int(_SPAN * wanted / r["count"]) + 1)) for r in counts], "label string, share bigint")
    hashed = F.pmod(F.xxhash64("text"), F.lit(_SPAN))
    place = (F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - snippet, F.lit(0)) + 1) + 1).cast("int")
    parts = ["label", hashed.alias("h"), F.substring("text", place, F.lit(snippet)).alias("part")]
    chosen = rows.join(F.broadcast(shares), "label").filter(hashed < F.col("share")).select(*parts)
    # Copies of one text count once, so that a group of copies cannot fill the sample.
    chosen = chosen.distinct().orderBy("h", "label", "part").limit(2 * (per_label + 16) * len(counts)).collect()
    found = {r["label"] for r in chosen}
    if len(found) < len(counts):
        missed = rows.sparkSession.createDataFrame([(r["label"],) for r in counts if r["label"] not in found], "label string")
        first = rows.join(F.broadcast(missed), "label").select(*parts).groupBy("label").agg(F.min(F.struct("h", "part")).alias("one"))
        chosen += first.select("label", "one.*").orderBy("h", "label").collect()
    taken: dict[str, int] = {}
    out = []
    for r in chosen:
        taken[r["label"]] = taken.get(r["label"], 0) + 1
        if taken[r["label"]] <= per_label:
            out.append((r["label"], r["part"]))
    return out


def fit(rows: DataFrame, per_lang: int = PER_LANG) -> tuple[Network | None, list[str]]:
    """Network and its languages, learned from (text, lang) of `rows`."""
    learned = sample(rows, "lang", per_lang, MOST_ROWS, SNIPPET, spoken=True)
    langs = sorted({lang for lang, _ in learned})
    if not learned:
        return None, langs
    windows, origin = windows_of([text.encode() for _, text in learned], WINDOW, WINDOW, SNIPPET_WINDOWS)
    number = {lang: i for i, lang in enumerate(langs)}
    labels = np.array([number[learned[i][0]] for i in origin])
    return train(windows, labels, len(langs), n_filters=8, epochs=4), langs


def predict(docs: DataFrame, net: Network | None, langs: list[str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns with lang_pred and score, for every row of `docs`."""
    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    more = [] if "text" in keep else ["text"]
    rows = docs.select(*keep, *more, spoken.alias("_spoken"))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net is not None else None
        for batch in batches:
            raw, starts, ends = utf8(batch.column("text"))
            spoken = batch.column("_spoken").to_numpy(zero_copy_only=False)
            found, score = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            known = np.flatnonzero(spoken)
            if scorer is not None and len(known):
                row, first, last = cut(starts[known], ends[known], net.window, net.window)
                logits = scorer.logits(raw, first, last).astype(np.float64)
                logits -= np.log(np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + logits.max(axis=1, keepdims=True)
                weight = (last - first).astype(np.float64)
                sums = np.add.reduceat(logits * weight[:, None], np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), axis=0)
                mean = np.exp(sums / (ends - starts)[known][:, None])
                mean /= mean.sum(axis=1, keepdims=True)
                best = mean.argmax(axis=1)
                found[known], score[known] = np.array(langs, object)[best], mean[np.arange(len(best)), best]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], pa.array(found, pa.string()),
                                              pa.array(score, pa.float64())], names=names)

    return rows.mapInArrow(run, schema)


def learnable(doc_id: Column) -> Column:
    """Rows the contract lets the network learn from: crc32 of the id is not 2 modulo 4."""
    return F.coalesce(crc_of_id(doc_id) % 4 != 2, F.lit(False))


def op2_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document; see `predict`."""
    docs = table(spark, sf_dir, "documents")
    net, langs = fit(docs.filter(learnable(F.col("doc_id"))))
    held = (~learnable(F.col("doc_id")) & F.col("doc_id").isNotNull()).alias("held_out")
    return predict(docs.select("doc_id", held, "text"), net, langs, ("doc_id", "held_out"))
