"""Packing documents into sequences by non-negative least squares.

A document is its token ids and id 0. Whole windows of it are sequences of their own; what is
left, its tail, is shorter than a window. Shallow combinations of lengths that fill a window
exactly (pairs and some triples) are the patterns; non-negative least squares over the histogram
of tail lengths says how often to use each; the counts are rounded down to what the histogram
holds. The remaining tails are packed greedily: longest first, next to each other, cut where a
window is full. Only the very last sequence can be short.

Scale: the histogram (fewer rows than the window is long) is all that reaches the driver, and the
plan is a few thousand rows. A tail finds its place from its rank among tails of its length;
ranks are made in hash buckets of about BUCKET_ROWS and offsets by bucket, so a length that a
third of all documents share is not one task's. Text is read and tokenized once; tails are
staged as ids in the shared folder, since a cut needs them again. They move once at most, with the
row that is ranked, and not at all where patterns take a whole bucket.

Edges: null and empty texts are the one id 0. Repeated rows, and rows of one id with different
texts, are packed each for itself; rows equal in id and text share a bucket. The empty table gives
no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextpick.llm.common import once, table
from nextpick.sources.stage import stage

WINDOW = 1024
END = 0
BUCKET_ROWS = 1000
BUCKETS = 1 << 20
STEPS = 400
SPECIAL = "<|endoftext|>"
#: Fixed value: the tokenizer's own split of a text, and the same for texts without two white
#: space characters in a row, where its look-ahead never matters.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
_SPACES = re.compile(r"\s\s")
#: A run of white space so long that the look-ahead's backtracking could exhaust the matcher's stack.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")

DOCUMENT = "doc_id bigint, doc_tokens bigint, full array<bigint>, tail binary, tail_crc bigint"


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones for themselves,
    the others for the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """Ids of a text as the byte-level BPE file `path` gives them."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ranks = {bytes(letters[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
        self.special = special
        self.marks = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.plain, self.whole, self.run = (tiktoken.Encoding(name, pat_str=words, mergeable_ranks=ranks, special_tokens=special)
                                            for name, words in (("plain", PLAIN_WORDS), ("whole", WORDS), ("run", r"\s+")))

    def ids(self, text: str) -> list[int]:
        if not any(s in text for s in self.special):
            return self._ordinary(text)
        return [i for part in self.marks.split(text) for i in ([self.special[part]] if part in self.special else self._ordinary(part))]

    def _ordinary(self, text: str) -> list[int]:
        if not _SPACES.search(text):
            return self.plain.encode_ordinary(text)
        out, at = [], 0
        for m in LONG_RUN.finditer(text):
            # The split ends a run before its last character, which belongs to what follows.
            end = m.end() - (m.end() < len(text))
            out += self.whole.encode_ordinary(text[at:m.start()]) + self.run.encode_ordinary(text[m.start():end])
            at = end
        return out + self.whole.encode_ordinary(text[at:])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenize(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, doc_tokens, the checksum of every full window, and the tail's ids and checksum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or default_path()
        tokens = once(f"tokens-{where}", lambda: Tokens(where))
        for batch in batches:
            counts, full, tails, sums = [], [], [], []
            for text in batch.column("text"):
                ids = np.array([*tokens.ids(text.as_py() or ""), END], "<u4")
                whole = len(ids) // WINDOW
                tail = ids[whole * WINDOW:].tobytes()
                counts.append(len(ids))
                full.append([zlib.crc32(ids[i * WINDOW:(i + 1) * WINDOW].tobytes()) for i in range(whole)])
                tails.append(tail)
                sums.append(zlib.crc32(tail))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(tails, pa.binary()), pa.array(sums, pa.int64())],
                names=["doc_id", "doc_tokens", "full", "tail", "tail_crc"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, DOCUMENT)


def patterns(lengths: set[int], window: int = WINDOW) -> list[tuple[int, ...]]:
    """Combinations of at most three of `lengths` that fill the window: all pairs, and triples (a, a, c),
    (a, b, b) and (a, 2a, c)."""
    found = {(a, window - a) for a in range(1, window // 2 + 1)}
    found |= {(a, a, window - 2 * a) for a in range(1, (window + 1) // 2)}
    found |= {(window - 2 * b, b, b) for b in range(1, (window + 1) // 2)}
    found |= {(a, 2 * a, window - 3 * a) for a in range(1, (window + 2) // 3) if window > 3 * a}
    return sorted({tuple(sorted(p)) for p in found if all(x in lengths for x in p)}, key=lambda p: (len(p), p))


def solve(histogram: np.ndarray, combos: list[tuple[int, ...]], steps: int = STEPS) -> np.ndarray:
    """Repeats x >= 0 of every pattern that minimise |A x - histogram|, by multiplicative steps."""
    if not combos:
        return np.zeros(0)
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.concatenate([np.array(c) for c in combos])
    wanted = np.bincount(column, histogram[row], len(combos))
    x = np.full(len(combos), max(1.0, histogram.sum() / max(1, len(row))))
    for _ in range(steps):
        used = np.bincount(row, x[column], len(histogram))
        x *= wanted / np.maximum(np.bincount(column, used[row], len(combos)), 1e-9)
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int], int]:
    """Ranges (length, first rank, count, first sequence, offset), ranks that patterns use by length,
    and the number of sequences they fill."""
    counts = np.zeros(window + 1)
    for length, n in histogram.items():
        counts[length] = n
    combos = patterns(set(histogram), window)
    repeats = solve(counts, combos)
    left, used, ranges, sequences = dict(histogram), dict.fromkeys(histogram, 0), [], 0
    for i in sorted(range(len(combos)), key=lambda i: (-repeats[i], combos[i])):
        combo = combos[i]
        times = min([int(repeats[i] + 0.5)] + [left[x] // combo.count(x) for x in set(combo)])
        if times <= 0:
            continue
        offset = 0
        for length in sorted(combo, reverse=True):
            ranges.append((length, used[length], times, sequences, offset))
            used[length] += times
            left[length] -= times
            offset += length
        sequences += times
    return ranges, used, sequences


def _spread() -> Column:
    return F.xxhash64("doc_id", "doc_tokens", "tail_crc")


def _bucketed(rows: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Rows with their hash bucket `_bucket` among rows of the same `key`, the rows `_held` in it and `_before` it;
    `counts` has (key, n).

    The table of buckets is staged: its size is known before the join, so whether rows have to move doesn't hang
    on which side of the join is ready first.
    """
    placed = rows.join(F.broadcast(counts), key).withColumn("_bucket", F.floor(
        F.pmod(_spread(), F.lit(BUCKETS)) * F.ceil(F.col("n") / BUCKET_ROWS) / BUCKETS)).drop("n")
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = placed.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_held")).withColumn(
        "_before", F.coalesce(F.sum("_held").over(before), F.lit(0)))
    return placed.join(stage(buckets, "buckets"), [key, "_bucket"])


def _ranked(bucketed: DataFrame, key: str) -> DataFrame:
    """Rows of `_bucketed` with their rank `_rank` from 0 among rows of the same `key`."""
    inside = Window.partitionBy(key, "_bucket").orderBy(_spread(), "doc_id", "doc_tokens", "tail_crc")
    return bucketed.withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1).drop("_bucket", "_held", "_before")


def _piece(start: Column, length: Column, crc: Column, sequence: Column, offset: Column) -> list[Column]:
    return [F.col("doc_id"), start.cast("bigint").alias("start"), length.cast("bigint").alias("length"),
            crc.cast("bigint").alias("ids_crc32"), F.col("doc_tokens"), sequence.cast("bigint").alias("sequence_id"),
            offset.cast("bigint").alias("offset")]


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of all rows of `docs`, each with its sequence and offset."""
    spark = docs.sparkSession
    held = stage(tokenize(docs, path), "tokens")
    sized = held.withColumns({"whole": F.floor(F.col("doc_tokens") / WINDOW), "rest": F.col("doc_tokens") % WINDOW})

    # Full windows: documents with the same number of them have consecutive blocks of sequences.
    wholes = sized.filter("whole > 0")
    by_whole = stage(wholes.groupBy("whole").agg(F.count(F.lit(1)).alias("n")), "wholes")
    earlier = Window.orderBy("whole").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_whole.withColumn("_base", F.coalesce(F.sum(F.col("n") * F.col("whole")).over(earlier), F.lit(0))).drop("n")
    first_tail = by_whole.agg(F.sum(F.col("n") * F.col("whole"))).first()[0] or 0
    bucketed = _bucketed(wholes.select("doc_id", "doc_tokens", "tail_crc", "full", "whole"), "whole", by_whole)
    ranked = _ranked(bucketed, "whole").join(bases, "whole")
    each = ranked.select("*", F.posexplode("full").alias("_i", "_crc"))
    full = each.select(*_piece(F.col("_i") * WINDOW, F.lit(WINDOW), F.col("_crc"),
                               F.col("_base") + F.col("_rank") * F.col("whole") + F.col("_i"), F.lit(0)))

    # Tails: the histogram has fewer rows than a window has tokens.
    tails = sized.filter("rest > 0")
    by_rest = stage(tails.groupBy("rest").agg(F.count(F.lit(1)).alias("n")), "rests")
    histogram = {r["rest"]: r["n"] for r in by_rest.collect()}
    ranges, used, sequences = plan(histogram)
    at, position = {}, 0  # where the remaining tails of each length begin, longest first
    for length in sorted(histogram, reverse=True):
        at[length] = position
        position += (histogram[length] - used[length]) * length
    left_from = first_tail + sequences
    patterned = spark.createDataFrame([(a, b, b + n, first_tail + s - b, o) for a, b, n, s, o in ranges],
                                      "_of bigint, _from bigint, _to bigint, _shift bigint, _at bigint")
    greedy = spark.createDataFrame([(length, used[length], at[length]) for length in histogram], "rest bigint, _used bigint, _start bigint")
    # Only a tail that no pattern takes can be cut: the ids of the others stay where they are.
    bucketed = _bucketed(tails.select("doc_id", "doc_tokens", "tail_crc", "rest", "tail"), "rest", by_rest).join(F.broadcast(greedy), "rest")
    needed = bucketed.withColumn("tail", F.when(F.col("_before") + F.col("_held") > F.col("_used"), F.col("tail")))
    ranked = _ranked(needed, "rest").join(F.broadcast(patterned), (F.col("rest") == F.col("_of")) & (
        F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")), "left")
    # What patterns leave, window after window; a tail that crosses a border is cut there.
    place = F.col("_start") + (F.col("_rank") - F.col("_used")) * F.col("rest")
    placed = ranked.withColumns({
        "_sequence": F.coalesce(F.col("_shift") + F.col("_rank"), F.lit(left_from) + F.floor(place / WINDOW)),
        "_offset": F.coalesce(F.col("_at"), place % WINDOW)}).withColumn("_room", WINDOW - F.col("_offset"))
    part = lambda skip, size: F.struct(skip.cast("int").alias("skip"), size.cast("int").alias("size"))
    room, rest = F.col("_room"), F.col("rest")
    parts = placed.withColumn("_p", F.explode(F.when(rest > room, F.array(part(F.lit(0), room), part(room, rest - room))).otherwise(
        F.array(part(F.lit(0), rest)))))
    skip, size = F.col("_p.skip"), F.col("_p.size")
    crc = F.when(size == rest, F.col("tail_crc")).otherwise(F.crc32(F.substring("tail", skip * 4 + 1, size * 4)))
    cut = parts.select(*_piece(F.col("doc_tokens") - rest + skip, size, crc, F.col("_sequence") + (skip > 0).cast("bigint"),
                               F.when(skip > 0, 0).otherwise(F.col("_offset"))))
    return full.unionByName(cut)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents; see `pack`."""
    return pack(table(spark, sf_dir, "documents"))
