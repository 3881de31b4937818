"""Approximate nearest neighbours by inner product over shifted space-filling curves.

Vectors are lifted to one length (one more coordinate), projected to a few random directions and
placed on a Hilbert curve of the shifted cells; CURVES such orderings differ in directions and shift.
Each ordering is cut into blocks at the quantiles of its keys.  A query looks, in every ordering, into
the blocks around its own key; within a block all inner products are computed, and the orderings'
finds are merged and ranked by the exact measure.

The window (blocks on either side) is the smallest one that reaches TARGET recall for a bounded sample
of queries, measured against brute force over all rows.  On data with structure it stays small; on
directionless data it widens until it covers much of the table, in blocks.  Every row is indexed.
Equal keys that fill several blocks are spread evenly over them, so common vectors make no large block.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components, rows without an
id and vectors whose length is not the table's most common one (the greater of two) take no part; with
fewer candidates than asked for all are returned; ties go to the smaller id; rows repeated with the
same id and vector count once; a query never finds its own id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import groups, shuffle_partitions
from clientele.session import freeze

CURVES = 4
DIRECTIONS = 8
BITS = 6
BLOCK_ROWS = 2048
#: Numbers in the sample of vectors that scales the cells, and queries whose recall sets the window.
SAMPLE_NUMBERS = 1 << 20
SAMPLE_QUERIES = 96
TARGET = 0.97
#: Queries that meet one copy of a block.
QUERIES_EACH = 8192


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of rows of cell numbers below 2**bits."""
    x = [c.astype(np.int64) for c in cells.T]
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level
        low = q - 1
        for k in range(len(x)):
            high = (x[k] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0]) ^ swap
            x[k] = x[k] ^ swap if k else x[0]
        q >>= 1
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for own in x:
            out = out << 1 | ((own ^ turn) >> b & 1)
    return out


class Curves:
    """The orderings: directions, cell edges and shifts, fitted on a bounded sample; then the cuts between blocks."""

    def __init__(self, sample: np.ndarray, longest: float):
        rng = np.random.default_rng(31)
        self.longest = longest
        self.turns = [np.linalg.qr(rng.normal(size=(sample.shape[1] + 1, sample.shape[1] + 1)))[0][:, :DIRECTIONS] for _ in range(CURVES)]
        self.edges, self.cuts = [], []
        for turn in self.turns:
            at = self._lift(sample) @ turn
            # cells of equal counts, shifted by a random part of a cell
            probs = (np.arange(1, 1 << BITS) - rng.uniform(0, 1, (turn.shape[1], 1))) / (1 << BITS)
            self.edges.append([np.quantile(at[:, k], np.clip(probs[k], 0, 1)) for k in range(turn.shape[1])])

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(0.0, self.longest ** 2 - (x * x).sum(axis=1, keepdims=True)))])

    def keys(self, x: np.ndarray, queries: bool = False) -> list[np.ndarray]:
        """Each ordering's keys; queries point in their direction with the greatest length."""
        if queries:
            x = x * (self.longest / np.sqrt((x * x).sum(axis=1, keepdims=True)))
        lifted = self._lift(x)
        out = []
        for turn, edges in zip(self.turns, self.edges):
            at = lifted @ turn
            out.append(hilbert(np.stack([np.searchsorted(e, at[:, k], side="right") for k, e in enumerate(edges)], axis=1), BITS))
        return out

    def blocks(self, x: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Each row's block in each ordering; ``spread`` deals equal keys over the blocks they fill."""
        out = []
        for keys, cuts in zip(self.keys(x), self.cuts):
            first, last = np.searchsorted(cuts, keys, side="left"), np.searchsorted(cuts, keys, side="right")
            out.append(first + spread % (last - first + 1))
        return np.stack(out, axis=1)

    def around(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last block that hold each query's key."""
        found = [(np.searchsorted(c, k, side="left"), np.searchsorted(c, k, side="right")) for k, c in zip(self.keys(x, True), self.cuts)]
        return np.stack([f for f, _ in found], axis=1), np.stack([f for _, f in found], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _spread(ids: np.ndarray) -> np.ndarray:
    return (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def _best(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the ids and exact inner products of its k best rows, best first, ties to the smaller id."""
    for lo in range(0, len(q), 256):
        rough = q[lo:lo + 256] @ x.T
        rough[own[lo:lo + 256, None] == ids] = -np.inf
        kth = -np.partition(-rough, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
        slack = 1e-9 * (1 + np.abs(kth))
        for i in range(len(rough)):
            at = np.flatnonzero((rough[i] >= kth[i] - slack[i]) & (rough[i] > -np.inf))
            score = (x[at] * q[lo + i]).sum(axis=1)
            order = np.lexsort((ids[at], -score))[:k]
            yield lo + i, ids[at][order], score[order]


def _found(rows: list[tuple[int, np.ndarray, np.ndarray]], own: np.ndarray) -> pa.RecordBatch:
    bounds = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r[1]) for r in rows], out=bounds[1:])
    flat = lambda k, kind: np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, kind)
    return pa.RecordBatch.from_arrays([pa.array(own[[r[0] for r in rows]] if rows else np.zeros(0, np.int64)),
                                       pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat(1, np.int64))),
                                       pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat(2, np.float64)))],
                                      names=["query_id", "ids", "scores"])


_FOUND = "query_id long, ids array<long>, scores array<double>"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Merge finds: each query's k best distinct rows, best first, ties to the smaller id."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for group in groups(batches, 1):
            ids, score = (group.column(c).flatten().to_numpy() for c in (1, 2))
            order = np.lexsort((ids, -score))
            ids, score = ids[order], score[order]
            new = np.ones(len(ids), dtype=bool)
            new[1:] = (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
            at = np.flatnonzero(new)[:k]
            held.append((np.full(len(at), group.column(0)[0].as_py()), np.arange(1, len(at) + 1, dtype=np.int32), ids[at], score[at]))
            if len(held) == 500:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    def batch(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["query_id", "rank", "vec_id", "score"])

    rows = found.repartition("query_id").sortWithinPartitions("query_id")
    return rows.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Ids and vectors (double) that take part, each id and vector once."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(~bad & F.exists(v, lambda x: x != 0)).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec"))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (common["n"] if common else 0)).dropDuplicates(["vec_id", "vec"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k rows of largest inner product found (``is_query`` on ``vec_id``)."""
    spark = vectors.sparkSession
    rows = freeze(usable(vectors, id_col, vec_col))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    total, queries, longest, width = rows.agg(F.count("*"), F.count_if(is_query), F.max(norm), F.max(F.size("vec"))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def some(frame: DataFrame, have: int, want: int, seed: int) -> list:
        part = min(1_000_000, max(1, int(1_000_000 * 1.2 * want / max(1, have))))
        return frame.filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000)) < part).orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(want).collect()

    sample = some(rows, total, max(64, SAMPLE_NUMBERS // width), 5)
    curves = Curves(np.array([r["vec"] for r in sample] or [rows.first()["vec"]]), longest)
    n_blocks = -(-total // BLOCK_ROWS)
    if n_blocks > 1:

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.float64)) for key in curves.keys(_matrix(batch.column(1)))],
                                                 names=[f"k{c}" for c in range(CURVES)])

        names = [f"k{c}" for c in range(CURVES)]
        keys = freeze(rows.mapInArrow(keyed, ", ".join(f"{n} double" for n in names)))
        curves.cuts = [np.array(c) for c in keys.approxQuantile(names, [i / n_blocks for i in range(1, n_blocks)], 0.1 / n_blocks)]
    else:
        curves.cuts = [np.zeros(0)] * CURVES
    window = _window(rows, curves, some(rows.filter(is_query), queries, SAMPLE_QUERIES, 6), k, n_blocks)
    copies = max(1, -(-queries * min(n_blocks, 2 * window + 1) // n_blocks // QUERIES_EACH))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            at = curves.blocks(x, _spread(ids))
            n = len(ids) * copies
            for c in range(CURVES):
                take = pa.array(np.repeat(np.arange(len(ids)), copies))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c, np.int32)), pa.array(np.repeat(at[:, c], copies).astype(np.int32)),
                                                  pa.array(np.tile(np.arange(copies, dtype=np.int32), len(ids))), pa.array(np.zeros(n, np.int32)),
                                                  batch.column(0).take(take), batch.column(1).take(take)], names=place_names)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            first, last = curves.around(x)
            copy = pa.array((_spread(ids) % copies).astype(np.int32))
            for c in range(CURVES):
                lo, hi = np.maximum(0, first[:, c] - window), np.minimum(n_blocks - 1, last[:, c] + window)
                who = np.repeat(np.arange(len(ids)), hi - lo + 1)
                block = np.arange(len(who)) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1) + lo[who]
                for part in range(0, len(who), 10_000):
                    take = pa.array(who[part:part + 10_000])
                    n = len(take)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c, np.int32)), pa.array(block[part:part + 10_000].astype(np.int32)),
                                                      copy.take(take), pa.array(np.ones(n, np.int32)), batch.column(0).take(take),
                                                      batch.column(1).take(take)], names=place_names)

    place_names = ["curve", "block", "copy", "query", "vec_id", "vec"]
    kind = "curve int, block int, copy int, query int, vec_id long, vec array<double>"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 3):
            query = group.column(3).to_numpy()
            cut = int(np.searchsorted(query, 1))
            if 0 < cut < len(query):
                ids, x = group.column(4).to_numpy(), _matrix(group.column(5))
                yield _found(list(_best(x[:cut], ids[:cut], x[cut:], ids[cut:], k)), ids[cut:])

    both = rows.mapInArrow(placed, kind).unionByName(rows.filter(is_query).mapInArrow(asked, kind))
    both = both.repartition(shuffle_partitions(spark), "curve", "block", "copy").sortWithinPartitions("curve", "block", "copy", "query")
    return _ranked(both.mapInArrow(search, _FOUND), k)


def _window(rows: DataFrame, curves: Curves, sample: list, k: int, n_blocks: int) -> int:
    """The smallest window in which the sample's true neighbours reach the target recall."""
    if n_blocks == 1 or not sample:
        return 0
    own = np.array([r["vec_id"] for r in sample], dtype=np.int64)
    q = np.array([r["vec"] for r in sample])

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            at = curves.blocks(x, _spread(ids))
            of = {int(i): n for n, i in enumerate(ids)}
            for i, found, score in _best(x, ids, q, own, k):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), i, np.int32)), pa.array(found), pa.array(score),
                                                  pa.array(at[[of[int(f)] for f in found]].tolist(), pa.list_(pa.int64()))],
                                                 names=["q", "vec_id", "score", "blocks"])

    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = (rows.mapInArrow(brute, "q int, vec_id long, score double, blocks array<long>")
            .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).collect())
    first, last = curves.around(q)
    i = np.array([t["q"] for t in true])
    at = np.array([t["blocks"] for t in true])
    away = np.maximum(0, np.maximum(first[i] - at, at - last[i])).min(axis=1)
    return int(np.sort(away)[min(len(away) - 1, int(np.ceil(TARGET * len(away))) - 1)])
