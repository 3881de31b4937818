"""Hard negatives by BOND's vertical scan.

Rows are packed into blocks that hold every dimension as a column, with the least and the greatest value of
each.  An anchor reads a block's dimensions in descending order of its own components' size.  After each step
the sum so far, plus the least and the most that the remaining dimensions can add (from those two values),
bounds every candidate's score; candidates that can no longer matter leave the bitmap, and the next columns are
read for the others alone.  What is left at the end has its exact integer score.

Two scans: the first keeps an anchor's best rows of its own label (its positives); the second resolves, for
each positive, the window ``low% .. high%`` of its score among rows of other labels.  A scan's lower bounds
carry over from block to block, so later blocks are cut sooner.

Spark deals blocks and groups of anchors over a grid: a stripe of blocks meets every group, an equi-join on
(group, stripe).  No task holds more than one group and one block, whatever label or vector is common.  All
anchors meet all rows, which is the stated query set; only each stripe's best few rows of an anchor are
shuffled on.

Scores are exact: float64 sums where they stay below 2**53, else 64-bit or unbounded integers (a score
beyond the 64-bit range counts as the range's end).

Edge cases: rows with a null id, label or vector, a null component, or a vector whose length is not the table's
most common one (the greater of two) take no part; rows repeated with id, label and vector count once; rows
that share an anchor's id are never its partners; rows that share an id but differ are rows of their own; ties
go to the smaller id; an anchor without positives, or a positive without negatives, gives no rows; an empty
table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import shuffle_partitions
from clientele.session import freeze, release

BLOCK_ROWS = 8192
GROUP_ANCHORS = 4096
#: Dimensions read between two looks at the bounds.
STEP = 8

_PACKED = "_at int, n int, width int, kind string, ids binary, labels binary, vectors binary"


def _pack(batches: Iterator[pa.RecordBatch], by_column: bool) -> Iterator[pa.RecordBatch]:
    """One block of a partition's rows: ids, labels and the vectors, as columns or as rows."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    t = pa.Table.from_batches(rows).combine_chunks()
    vectors = t.column("vector").combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.chunk(0)
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
    top = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    kind = next(k for k in ("int16", "int32", "int64") if k == "int64" or top <= np.iinfo(k).max)
    x = np.ascontiguousarray((x.T if by_column else x).astype(kind))
    ints = [t.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label")]
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([t.num_rows], pa.int32()),
         pa.array([x.size // t.num_rows], pa.int32()), pa.array([kind]), pa.array([ints[0]], pa.binary()),
         pa.array([ints[1]], pa.binary()), pa.array([x.tobytes()], pa.binary())],
        names=["_at", "n", "width", "kind", "ids", "labels", "vectors"])


def _packed(rows: DataFrame, n: int, size: int, by_column: bool) -> DataFrame:
    """``rows`` in packs of about ``size``, sorted by label inside a pack."""
    dealt = rows.repartition(max(1, -(-n // size))).sortWithinPartitions("label", "id")
    return freeze(dealt.mapInArrow(lambda it: _pack(it, by_column), _PACKED))


class Block:
    """A block's columns with their least and greatest values."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.columns = np.frombuffer(row["vectors"], row["kind"]).reshape(row["width"], row["n"])
        width = row["width"]
        self.least = self.columns.min(axis=1) if width else np.zeros(0, np.int64)
        self.most = self.columns.max(axis=1) if width else np.zeros(0, np.int64)
        self.top = max((abs(int(v)) for v in (*self.least, *self.most)), default=0)
        self._as = {}

    def typed(self, kind):
        """Columns and their limits in a number type that holds every score of an anchor exactly."""
        if kind not in self._as:
            self._as[kind] = tuple(a.astype(kind) for a in (self.columns, self.least, self.most))
        return self._as[kind]


def _number_type(width: int, a: int, b: int):
    bound = max(1, width) * max(1, a) * max(1, b)
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


def vertical_scan(anchor: np.ndarray, block: Block, alive: np.ndarray, matters) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (positions in the block) that ``matters`` lets through to the end, and their exact scores.

    ``matters(lower, upper)`` gets bounds of the scores of the candidates left and returns who stays."""
    kind = _number_type(len(anchor), max((abs(int(v)) for v in (anchor.min(), anchor.max())), default=0) if len(anchor) else 0,
                        block.top)
    columns, least, most = block.typed(kind)
    q = anchor.astype(kind)
    order = np.argsort(-np.abs(q), kind="stable")
    ends = np.stack([q * least, q * most])[:, order]
    # least and most that the dimensions from each place on can add
    rest_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
    rest_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
    score = np.zeros(len(alive), dtype=kind)
    done = 0
    while done < len(order) and len(alive):
        dims = order[done:done + STEP]
        done += len(dims)
        part = columns[dims] if len(alive) == columns.shape[1] else columns[np.ix_(dims, alive)]
        score = score + q[dims] @ part
        stays = matters(score + rest_low[done], score + rest_high[done])
        if not stays.all():
            alive, score = alive[stays], score[stays]
    return alive, score


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value; None if there are fewer."""
    return None if len(values) < k else np.partition(values, len(values) - k)[len(values) - k]


def _best(have: list, ids: np.ndarray, scores: np.ndarray, k: int) -> list:
    """The ``k`` best of (score, id) pairs held and found: higher scores first, then smaller ids."""
    if len(scores) > k:  # ties of the k-th stay
        near = scores >= _kth(scores, k)
        ids, scores = ids[near], scores[near]
    found = [(int(s), int(i)) for s, i in zip(scores, ids)]
    return sorted(have + found, key=lambda p: (-p[0], p[1]))[:k]


def positives(anchor_id: int, label: int, vector: np.ndarray, block: Block, have: list, k: int) -> list:
    """The best ``k`` (score, id) of ``have`` and the block's other rows of the anchor's label."""
    lo, hi = np.searchsorted(block.labels, [label, label + 1])  # a block is sorted by label
    alive = np.arange(lo, hi)
    alive = alive[block.ids[alive] != anchor_id]
    floor = have[-1][0] if len(have) >= k else None

    def matters(lower, upper):
        bounds = [b for b in (floor, _kth(lower, k)) if b is not None]
        return upper >= max(bounds) if bounds else np.ones(len(lower), bool)

    alive, scores = vertical_scan(vector, block, alive, matters)
    return _best(have, block.ids[alive], scores, k)


def negatives(anchor_id: int, label: int, vector: np.ndarray, block: Block, windows: list, have: list[list], k: int) -> list[list]:
    """For each window (least, greatest score) the best ``k`` (score, id) of ``have`` and the block's rows of other labels."""
    alive = np.flatnonzero((block.labels != label) & (block.ids != anchor_id))
    floors = [h[-1][0] if len(h) >= k else None for h in have]

    def matters(lower, upper):
        stays = np.zeros(len(lower), bool)
        for (low, high), floor in zip(windows, floors):
            sure = _kth(lower[(lower >= low) & (upper <= high)], k)
            least = max(b for b in (low, floor, sure) if b is not None)
            stays |= (upper >= least) & (lower <= high)
        return stays

    alive, scores = vertical_scan(vector, block, alive, matters)
    ids = block.ids[alive]
    out = []
    for (low, high), held in zip(windows, have):
        inside = (scores >= low) & (scores <= high)
        out.append(_best(held, ids[inside], scores[inside], k))
    return out


def _clip(v: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, v))


def _scan(batches: Iterator[pa.RecordBatch], k: int, limits: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """Best rows of every anchor (and window) of a group over the blocks of a stripe; rows of one (group,
    stripe) come one after another, else they are given out in parts."""
    at, found, blocks = None, {}, {}

    def given_out():
        rows = [(a, w, i, _clip(s)) for (a, w), best in found.items() for s, i in best]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                             names=["anchor", "window", "id", "score"])

    for batch in batches:
        for r in range(batch.num_rows):
            row = {n: batch.column(n)[r] for n in batch.schema.names}
            group, stripe = row["group"].as_py(), row["stripe"].as_py()
            if (group, stripe) != at:
                yield from given_out()
                at, found = (group, stripe), {}
                g = row["a"].as_py()
                ids, labels = np.frombuffer(g["ids"], np.int64), np.frombuffer(g["labels"], np.int64)
                vectors = np.frombuffer(g["vectors"], g["kind"]).reshape(g["n"], g["width"])
                windows = {}
                if limits:
                    for w in row["w"].as_py() or ():
                        low, high = -(-limits[0] * w["score"] // 100), limits[1] * w["score"] // 100
                        if low <= high:
                            windows.setdefault(w["anchor"], []).append((w["window"], low, high))
            block = Block(row["b"].as_py())
            base = group << 32
            for j in range(len(ids)) if not limits else [a - base for a in windows]:
                who = (int(ids[j]), int(labels[j]), vectors[j], block)
                if not limits:
                    found[base + j, 0] = positives(*who, found.get((base + j, 0), []), k)
                    continue
                mine = windows[base + j]
                keys = [(base + j, w) for w, _, _ in mine]
                for key, best in zip(keys, negatives(*who, [(lo, hi) for _, lo, hi in mine], [found.get(x, []) for x in keys], k)):
                    found[key] = best
    yield from given_out()


def _searched(anchors: DataFrame, blocks: DataFrame, n_groups: int, stripes: int, k: int, limits) -> DataFrame:
    """(anchor, window, id, score): the best ``k`` rows of every anchor and window over all blocks."""
    pack = lambda n: F.struct("n", "width", "kind", "ids", "labels", "vectors").alias(n)
    left = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"), (F.col("_at") % stripes).alias("stripe"), pack("b"))
    wins = F.col("w") if limits else F.lit(None).cast("array<struct<anchor:bigint,window:int,score:bigint>>").alias("w")
    right = anchors.select(F.col("_at").alias("group"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), pack("a"), wins)
    found = left.join(right.hint("merge"), ["group", "stripe"]).mapInArrow(
        lambda it: _scan(it, k, limits), "anchor long, window int, id long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def integer_vectors(vectors: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double; null if the vector is null or a component is null or not finite."""
    usable = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable, F.transform(vectors, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of ``rows`` (``id`` long, ``label`` long, ``vector`` array of long).

    For each anchor (``is_anchor``, over ``id``) and each of its ``n_positives`` best rows of its own label: the
    first ``n_negatives`` rows of other labels whose score is ``low`` to ``high`` per cent of the positive's.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    whole = (rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector")
             .filter("id is not null and label is not null and vector is not null and forall(vector, x -> x is not null)"))
    whole = freeze(whole.distinct())
    usual = whole.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None:
        return spark.createDataFrame([], empty)
    whole = whole.filter(F.size("vector") == usual["width"])
    queries = whole.filter(is_anchor)
    n_anchors = queries.count()
    if n_anchors == 0:
        return spark.createDataFrame([], empty)
    blocks = _packed(whole, usual["count"], BLOCK_ROWS, True)
    anchors = _packed(queries, n_anchors, GROUP_ANCHORS, False)
    n_groups, n_blocks = -(-n_anchors // GROUP_ANCHORS), -(-usual["count"] // BLOCK_ROWS)
    stripes = min(n_blocks, shuffle_partitions(spark))
    best = freeze(_searched(anchors, blocks, n_groups, stripes, n_positives, None).select(
        "anchor", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # an anchor's number is its group and its place in it; a group is a few thousand anchors
    wins = best.groupBy(F.shiftright("anchor", 32).cast("int").alias("_at")).agg(F.collect_list(F.struct("anchor", "window", F.col("positive_score").alias("score"))).alias("w"))
    found = freeze(_searched(anchors.join(wins, "_at"), blocks, n_groups, stripes, n_negatives, (low, high)).select(
        "anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    names = anchors.select("_at", "n", "ids").mapInArrow(_names, "anchor long, anchor_id long")
    out = (found.join(best, ["anchor", "window"]).join(names, "anchor")
           .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    release(whole, blocks)
    return out


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            ids = np.frombuffer(batch.column("ids")[r].as_py(), np.int64)
            start = batch.column("_at")[r].as_py() << 32
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(start, start + len(ids)), pa.int64()), pa.array(ids)],
                                             names=["anchor", "anchor_id"])
