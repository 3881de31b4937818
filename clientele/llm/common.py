"""Helpers shared by the corpus operators: Arrow batches in small chunks, word spans and 64-bit span hashes."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20

_SEED = np.random.default_rng(20240607)
_BYTE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, unless they find it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def row_key(df: DataFrame, *cols: str) -> Column:
    """64-bit key of a row's content; equal rows share it (their results are equal too)."""
    return F.xxhash64(*[c for col in cols for c in (F.col(col).isNull(), F.col(col))])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The text column with null as empty text."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.fill_null("") if col.null_count else col


def byte_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    if len(col) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables up to 4M entries are kept."""
    have = _POWERS.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    size = 1 << max(10, int(n - 1).bit_length())
    out = np.ones(size, dtype=np.uint64)
    k = 1
    while k < size:
        np.multiply(out[:k], np.uint64(pow(base, k, 1 << 64)), out=out[k:2 * k])
        k *= 2
    if size <= 1 << 22:
        _POWERS[base] = out
    return out[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte values times rising powers (modulo 2**64), one longer than the data."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end): equal bytes, equal hashes, wherever they stand."""
    shift = powers(_INV, len(sums))
    return mix64((sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64))


def window_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """:func:`span_hashes` of the span of ``size`` bytes from every place that has room for it."""
    x = sums[size:] - sums[:-size]
    x *= powers(_INV, len(sums))[:len(x)]
    x += np.uint64(size)
    rest = x >> np.uint64(33)  # mix64 in place
    x ^= rest
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x *= np.uint64(factor)
        np.right_shift(x, np.uint64(33), out=rest)
        x ^= rest
    return x


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside``, cut at the row offsets."""
    if len(inside) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def per_row(starts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each row the index of its first span; one longer than the rows."""
    return np.searchsorted(starts, offs)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i+1]]."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows with equal first ``keys`` integer columns, from batches sorted by them."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in range(keys):
            col = batch.column(k).to_numpy(zero_copy_only=False)
            change |= col[1:] != col[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)
        held = batch.slice(cuts[-1])
    if held is not None:
        yield held


def smallest_reachable(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (``a``, ``b``): each linked node ``v`` with the smallest node
    ``c`` it reaches.  Labels go to neighbours and then jump to their label's label, until nothing changes;
    every round is written, so no lineage grows."""
    from clientele.session import freeze
    sides = links.select(F.col("a").alias("v"), F.col("b").alias("u")).filter("v <> u")
    edges = freeze(sides.unionByName(sides.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct())
    labels = freeze(edges.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("c")))
    total = None
    while True:
        near = (edges.join(labels.select(F.col("v").alias("u"), "c"), "u").groupBy("v").agg(F.min("c").alias("n")))
        step = labels.join(near, "v").select("v", F.least("c", "n").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("j"))
        labels = freeze(step.join(jump, "c", "left").select("v", F.least("c", F.coalesce("j", "c")).alias("c")))
        now = labels.agg(F.sum(F.col("c").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
