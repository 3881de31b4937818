"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, for each k, the sum of its first k code points times rising powers of
a base modulo a prime (two bases, 62 bits together).  Differences of two entries, shifted by a
power, hash any span, so two spans of any texts are compared in constant time, and the longest
common extension of two positions is found by binary search.  A fingerprint keeps the hash of the
whole text and the hashes of its beginnings and ends of rising lengths (each about 19 % longer than
the last); the likeness of two fingerprints is the length of the longest common beginning and end
they show, found by binary search, over the longer text.

Edge cases: null is the empty text; two empty texts are alike (1.0), an empty and another text are
not (0.0); equal texts have equal fingerprints; texts of any length are hashed whole.  Documents
follow each other by descending id, equal ids by text, rows without an id last; after the last
comes the first (a single document follows itself).  Other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import shuffle_partitions

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_566_083_941)
#: Buckets of consecutive documents for each shuffle partition.
BUCKETS_EACH = 4

_TABLES: dict[int, np.ndarray] = {}
_LADDER = np.unique(np.concatenate([np.arange(1, 9), np.floor(8 * 2 ** (np.arange(1, 140) / 4))]).astype(np.int64))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME."""
    have = _TABLES.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        k = 1
        while k < size:
            have[k:2 * k] = have[:k] * np.uint64(pow(base, k, PRIME)) % np.uint64(PRIME)
            k *= 2
        if size <= 1 << 22:
            _TABLES[base] = have
    return have[:n]


class PrefixHashes:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums = []
        for base in BASES:
            out = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(codes * _powers(base, self.n) % np.uint64(PRIME), out=out[1:])
            self.sums.append(out % np.uint64(PRIME))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, end): equal spans have equal hashes wherever they stand."""
        out = np.zeros(len(starts), dtype=np.uint64)
        for base, sums in zip(BASES, self.sums):
            back = pow(base, -1, PRIME)
            p = np.uint64(PRIME)
            out = out << np.uint64(31) | (sums[ends] + p - sums[starts]) % p * _powers(back, self.n + 1)[starts] % p
        return out

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def equal(self, start: int, end: int, other: PrefixHashes, at: int) -> bool:
        """Is [start, end) the span of ``other`` that begins at ``at``?"""
        return at + end - start <= other.n and self.span(start, end) == other.span(at, at + end - start)

    def common_extension(self, start: int, other: PrefixHashes, at: int) -> int:
        """Length of the longest common extension of the two positions, by binary search."""
        lo, hi = 0, min(self.n - start, other.n - at)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(start, start + mid, other, at) else (lo, mid - 1)
        return lo

    def fingerprint(self) -> str:
        """Length, hash of the whole text, hashes of beginnings and of ends of the ladder's lengths."""
        rungs = _LADDER[: int(np.searchsorted(_LADDER, self.n, side="right"))]
        zero = np.zeros(len(rungs), dtype=np.int64)
        heads = self.spans(zero, rungs)
        tails = self.spans(self.n - rungs, zero + self.n)
        short = lambda x: (x & np.uint64(0xFFFFFFFF)).astype(">u4").tobytes().hex()
        return f"{self.n}:{self.span(0, self.n):016x}:{short(heads)}:{short(tails)}"


def likeness(a: str, b: str) -> float:
    """Common beginning and end of two fingerprints' texts over the longer text's length, 0 to 1."""
    if a == b:
        return 1.0
    pa_, pb = a.split(":"), b.split(":")
    shared = sum(_shared(pa_[k], pb[k]) for k in (2, 3))
    longest = max(int(pa_[0]), int(pb[0]))
    return min(shared, longest - 1) / longest


def _shared(a: str, b: str) -> int:
    """Longest rung that two ladders share; a shared rung implies the shorter ones."""
    lo, hi = 0, min(len(a), len(b)) // 8
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[8 * mid - 8:8 * mid] == b[8 * mid - 8:8 * mid] else (lo, mid - 1)
    return int(_LADDER[lo - 1]) if lo else 0


def followers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in partitions, each bucket of consecutive ids together and in order, and behind each
    bucket (``_tail``) the text of the document that follows its last one.

    The ids' quantiles cut the buckets, so texts are shuffled once and no task orders the whole table."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    buckets = n * BUCKETS_EACH
    probs = [k / buckets for k in range(1, buckets)]
    cuts = np.unique(np.array(docs.select("_id").approxQuantile("_id", probs, 0.25 / buckets), dtype=np.float64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        at = len(cuts) - np.searchsorted(cuts, ids.astype("float64").to_numpy(), side="left")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, at).astype("int32"))

    docs = docs.withColumn("_bucket", bucket("_id"))
    # one row for each bucket: its first document is what follows the bucket before
    firsts = sorted((r[0], r[1]) for r in docs.groupBy("_bucket").agg(F.max("_id")).collect())
    if not firsts:
        return docs.withColumn("_tail", F.lit(False))
    before = [(first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)]
    wanted = spark.createDataFrame(before, "_first long, _to int")
    tails = (docs.join(F.broadcast(wanted), F.col("_id").eqNullSafe(F.col("_first")))
             .groupBy("_to").agg(F.min("_text").alias("_text"))
             .select(F.lit(None).cast("long").alias("_id"), "_text", F.col("_to").alias("_bucket"), F.lit(True).alias("_tail")))
    return (docs.withColumn("_tail", F.lit(False)).unionByName(tails).repartition(n, "_bucket")
            .sortWithinPartitions("_bucket", "_tail", F.col("_id").desc_nulls_last(), "_text"))


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last half replaced by the beginning of the
    next document), and their likeness to it and to the next document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for i, text, bucket, tail in zip(*[c.to_pylist() for c in batch.columns]):
                hashes = PrefixHashes(text)
                mark = hashes.fingerprint()
                if held is not None and held[3] == bucket:
                    own, n = held[1], held[4]
                    edited = own[:n - n // 2] + text[:n // 2]
                    edited_mark = PrefixHashes(edited).fingerprint()
                    rows.append((held[0], n, hashlib.sha256(edited.encode("utf-8")).hexdigest(), held[2], edited_mark,
                                 likeness(held[2], edited_mark), likeness(held[2], mark)))
                held = None if tail else (i, text, mark, bucket, hashes.n)
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[f.split()[0] for f in _RESULT.split(", ")])

    return followers(docs, id_col, text_col).select("_id", "_text", "_bucket", "_tail").mapInArrow(run, _RESULT)
