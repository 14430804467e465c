"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

A text is cut into paragraphs; each is hashed to a wide vector, and the fingerprint is the sum of
the vectors: LANES signs, modulo 2**32 each, and STRONG uniform words, modulo 2**64 each. Sums
don't depend on order, a paragraph is inserted by adding and deleted by subtracting its vector,
and equal multisets have equal sums. The signs make the sums comparable: for texts with
paragraph multisets A and B the mean square of the difference estimates |A - B| (squared counts),
those of the sums |A| and |B|, and the likeness is the share that is left,
1 - |A - B| / (|A| + |B|), between 0 and 1.

A paragraph ends with a line break, a full stop, or after LONGEST characters: cuts depend on what
comes before them only, so an edit of a text's end leaves the earlier paragraphs alone.

Neighbours: documents are dealt to buckets of consecutive ids by sampled quantiles, and each
bucket also gets the first document of the bucket after it, so that one shuffle of the texts
brings every document beside its successor. Spark sorts a partition by bucket and id, spilling where
it must, and the sorted rows are read through one by one: a task holds an Arrow batch and one row,
however large a bucket or an id's share of the rows is. Only the buckets' smallest ids go through the
driver, BUCKETS_PER_PARTITION per shuffle partition and MOST_BUCKETS at most.

Edges: null text is empty text, whose fingerprint is zero; two empty texts are alike 1.0, an
empty and another one 0.0. The only document is its own successor. Rows that repeat an id are
ordered by text. A null id has no place in the order: its successor is empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.llm.common import table

LANES = 128
STRONG = 4
LONGEST = 100
PARAGRAPH = re.compile(r"[^\n.]{0,%d}[\n.]+|[^\n.]{1,%d}" % (LONGEST, LONGEST))
BUCKETS_PER_PARTITION = 16
MOST_BUCKETS = 8192  # bounds the plan's literals; a bucket's size is not bounded, and need not be

RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
         "near_edited double, near_next double"
NAMES = [field.split()[0] for field in RESULT.split(", ")]


def vectors(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signs (n, LANES) as int8 and words (n, STRONG) of each paragraph."""
    raw = [p.encode("utf-8", "surrogatepass") for p in paragraphs]
    wide = b"".join([xxhash.xxh3_128_digest(p) for p in raw])
    bits = np.unpackbits(np.frombuffer(wide, np.uint8)).reshape(len(raw), LANES)
    strong = np.frombuffer(b"".join([hashlib.blake2b(p, digest_size=8 * STRONG).digest() for p in raw]), np.uint64)
    return bits.astype(np.int8) * 2 - 1, strong.reshape(len(raw), STRONG)


class Fingerprint:
    """Sum of paragraph vectors; `insert` and `delete` change it in place."""

    def __init__(self, signs: np.ndarray | None = None, strong: np.ndarray | None = None):
        self.signs = np.zeros(LANES, np.uint32) if signs is None else signs
        self.strong = np.zeros(STRONG, np.uint64) if strong is None else strong

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        made = cls()
        made.insert(PARAGRAPH.findall(text))
        return made

    def copy(self) -> Fingerprint:
        return Fingerprint(self.signs.copy(), self.strong.copy())

    def insert(self, paragraphs: list[str]) -> None:
        if paragraphs:
            signs, strong = vectors(paragraphs)
            self.signs += signs.sum(axis=0, dtype=np.int64).astype(np.uint32)
            self.strong += strong.sum(axis=0, dtype=np.uint64)

    def delete(self, paragraphs: list[str]) -> None:
        if paragraphs:
            signs, strong = vectors(paragraphs)
            self.signs -= signs.sum(axis=0, dtype=np.int64).astype(np.uint32)
            self.strong -= strong.sum(axis=0, dtype=np.uint64)

    def text(self) -> str:
        return self.strong.astype(">u8").tobytes().hex() + self.signs.astype(">u4").tobytes().hex()


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of paragraphs in common, estimated from two fingerprints."""
    if np.array_equal(a.strong, b.strong) and np.array_equal(a.signs, b.signs):
        return 1.0
    size = lambda x: float((x.view(np.int32).astype(np.float64) ** 2).mean())
    whole = size(a.signs) + size(b.signs)
    return min(1.0, max(0.0, 1.0 - size(a.signs - b.signs) / whole)) if whole else 0.0


def edited(text: str, following: str) -> str:
    """`text` with its last quarter replaced by as much of the start of `following`."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _edited_fingerprint(text: str, new: str, own: Fingerprint) -> Fingerprint:
    """Fingerprint of an edited text: only paragraphs from the edit on are deleted and inserted."""
    kept = len(text) - len(text) // 4
    before, at = 0, 0
    for m in PARAGRAPH.finditer(text):
        if m.end() >= kept:  # its end may move
            break
        at, before = m.end(), before + 1
    made = own.copy()
    made.delete(PARAGRAPH.findall(text, at))
    made.insert(PARAGRAPH.findall(new, at))
    return made


def _rows(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in out], kind) for i, kind in enumerate(types)], names=NAMES)


def _result(doc_id: int | None, text: str, own: Fingerprint, following: str, next_: Fingerprint) -> tuple:
    new = edited(text, following)
    changed = _edited_fingerprint(text, new, own)
    return (doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own.text(), changed.text(),
            likeness(own, changed), likeness(own, next_))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of sorted rows, one row held until its successor comes; rows marked `tail` only serve as successors."""
    held, bucket = None, None
    for batch in batches:
        out = []
        for place, doc_id, text, tail in zip(*(batch.column(n) for n in ("bucket", "doc_id", "text", "tail")), strict=True):
            place, doc_id, text = place.as_py(), doc_id.as_py(), text.as_py()
            made = Fingerprint.of(text)
            if held is not None:
                follows = place == bucket and held[0] is not None
                out.append(_result(*held, *((text, made) if follows else ("", Fingerprint()))))
            held, bucket = None if tail.as_py() else (doc_id, text, made), place
        yield _rows(out)
    if held is not None:
        yield _rows([_result(*held, "", Fingerprint())])


def _place(doc_id: Column, cuts: list[int]) -> Column:
    """Number of `cuts` below an id, by binary search in an array."""
    bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts]).cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]).cast("array<int>"), F.lit(0), lambda at, step: F.when(
        F.get(bounds, at + step - 1) < doc_id, at + step).otherwise(at))


def with_successors(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, tail): rows by bucket of consecutive ids, and each bucket's successor."""
    wanted = min(MOST_BUCKETS, BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id").filter(F.col("doc_id").isNotNull())
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 0.2 / wanted)})
    # The buckets' smallest ids: at most `wanted` numbers, whatever the table's size.
    first = ids.groupBy(_place(F.col("doc_id"), cuts).alias("b")).agg(F.min("doc_id").alias("m")).orderBy("b").collect()
    before = {r["b"]: first[i - 1]["b"] for i, r in enumerate(first)}
    earlier = F.array(*[F.lit(before.get(b)).cast("int") for b in range(len(cuts) + 1)])
    apart = -1 - F.pmod(F.xxhash64("text"), F.lit(wanted)).cast("int")  # null ids, in no order
    place = F.when(F.col("doc_id").isNull(), apart).otherwise(_place(F.col("doc_id"), cuts))
    rows = rows.withColumn("own", place)
    here = F.struct(F.col("own").alias("bucket"), F.lit(0).alias("tail"))
    there = F.struct(F.get(earlier, F.col("own")).alias("bucket"), F.lit(1).alias("tail"))
    starts = F.coalesce(F.col("doc_id").isin([r["m"] for r in first]), F.lit(False))
    goes = F.explode(F.when(starts, F.array(here, there)).otherwise(F.array(here)))
    return rows.withColumn("goes", goes).select("goes.bucket", "doc_id", "text", "goes.tail")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and edited text, and their likeness."""
    dealt = with_successors(docs).repartition("bucket")
    return dealt.sortWithinPartitions("bucket", "tail", "doc_id", "text").mapInArrow(_neighbours, RESULT)


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; see `fingerprints`."""
    return fingerprints(table(spark, sf_dir, "documents"))
