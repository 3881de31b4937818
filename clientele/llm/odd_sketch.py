"""Near-duplicates by MinHash with odd sketches.

A document's set holds the hashes of its distinct word shingles.  MINHASHES samples of the set make
bands of BAND samples each; documents that share a band are candidates.  The samples are also folded
into a parity bitmap of SKETCH bits (an odd sketch): the XOR of two bitmaps counts the samples in
which two documents differ, which estimates their similarity closely where it is high.  Candidates
whose estimate is far below the threshold are left out, the others confirmed on the full sets.

No bucket's pairs are all emitted.  Equal sets are one class from the start.  First each class is
compared with the best (by sketch) of the smallest members of its buckets, and links make components.
Then, within buckets that still hold several components, members outside the bucket's largest
component are compared with members of other components by finer bitmaps (the parity in FINE bits of the
whole set or, above WHOLE shingles, of those in a part of the hash range, the same for both): first their three best, then, components renewed, all that the bitmaps allow.  So any link between two components is found.  Large buckets
are cut into blocks of about BLOCK members, in and outside the largest component; a group holds two of them.

Misses: two documents at the threshold share no band with probability (1 - 0.75**4)**32 = 5e-6 and fall
below the sketch's margin with less than 1e-6.  Hashes have 64 bits, a class's key 128.

Edge cases: null and texts without a word have size 0, are linked with nothing and are kept; a text
with fewer words than a shingle is one shingle; rows without an id take part, a component's id is its
smallest non-null one (null if it has none), and rows without an id are kept only in such a component;
repeated rows are linked with each other; texts of any length are read whole; an empty table gives an
empty result; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import (LOWER, SPACE, byte_chunks, groups, mix64, per_row, prefix_sums, row_key, shuffle_partitions,
                                  smallest_reachable, span_hashes, spans, utf8_column)
from clientele.session import freeze

MINHASHES = 128
BAND = 4
SKETCH = 512
#: Estimates this far below the threshold rule a pair out (five standard deviations).
MARGIN = 0.2
#: Bits of the finer parity bitmaps, and the margin of their estimates (over six standard deviations).
FINE = 8192
FINE_MARGIN = 0.05
#: Sets up to this size are folded whole; of larger ones a half, a quarter, ... of the hash range, so that
#: their bitmaps are never near saturation.
WHOLE = 2 * FINE
#: Members of a bucket, of its largest component or outside, that make one block.
BLOCK = 4096
BEST = 3
#: Ids from here on stand for classes without an id.
_NO_ID = 1 << 62

_RNG = np.random.default_rng(99)
_FACTOR = _RNG.integers(0, 1 << 31, MINHASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSET = _RNG.integers(0, 1 << 32, MINHASHES, dtype=np.uint32)
_PLACE = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles."""
    low = LOWER[data]
    starts, ends = spans(~SPACE[low], offs)
    words = span_hashes(prefix_sums(low), starts, ends)
    first = per_row(starts, offs)
    run = np.zeros(len(words), dtype=np.uint64)
    for k in range(size):
        if len(words) > k:
            run[:len(words) - k] += words[k:] * _PLACE[k]
    run = mix64(run)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(run[lo:hi - size + 1]))
        elif hi > lo:
            own = (words[lo:hi] * _PLACE[size:size + hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(mix64(np.array([own], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of one set."""
    codes = (shingles >> np.uint64(32)).astype(np.uint32)
    best = None
    for lo in range(0, len(codes), 2048):
        low = (codes[lo:lo + 2048, None] * _FACTOR + _OFFSET).min(axis=0)
        best = low if best is None else np.minimum(best, low)
    return best


def _bands_and_sketches(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and odd sketches (as 64-bit words) of rows of samples."""
    n = len(samples)
    wide = samples.astype(np.uint64)
    bands = np.zeros((n, MINHASHES // BAND), dtype=np.uint64)
    for k in range(BAND):
        bands = mix64(bands + wide[:, k::BAND] + np.uint64(k + 1))
    bands = mix64(bands ^ np.arange(1, MINHASHES // BAND + 1, dtype=np.uint64) * _PLACE[60])
    bit = mix64(wide | np.arange(MINHASHES, dtype=np.uint64) << np.uint64(32)) % np.uint64(SKETCH)
    flat = (bit.astype(np.int64) + SKETCH * np.arange(n)[:, None]).ravel()
    odd = (np.bincount(flat, minlength=n * SKETCH) & 1).astype(np.uint8)
    return bands, np.packbits(odd).view(np.uint64).reshape(n, SKETCH // 64)


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Row key, id, set size, set key, band hashes and sketch of every whole text.  No shuffle."""
    kinds = "_row long, _id long, _n long, _hi long, _lo long, _bands array<long>, _sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(utf8_column(batch, "_text")):
                sets = shingle_sets(data, offs, size)
                n = hi - lo
                count = np.array([len(s) for s in sets], dtype=np.int64)
                key_hi = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                key_lo = np.array([mix64(s ^ _PLACE[61]).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                full = np.flatnonzero(count)
                bands = np.zeros((n, MINHASHES // BAND), dtype=np.uint64)
                sketch = np.zeros((n, SKETCH // 64), dtype=np.uint64)
                if len(full):
                    bands[full], sketch[full] = _bands_and_sketches(np.array([_samples(sets[i]) for i in full]))
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * m.shape[1]), pa.array(m.view(np.int64).ravel()))
                         for m in (bands, sketch)]
                own = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(count), pa.array(key_hi), pa.array(key_lo), *lists],
                                                 names=["_row", "_id", "_n", "_hi", "_lo", "_bands", "_sketch"])

    return (docs.select(row_key(docs, id_col, text_col).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
            .mapInArrow(run, kinds))


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from two odd sketches."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    part = F.greatest(F.lit(1e-9), 1 - 2 * differ / SKETCH)
    return 1 + F.log(part) * (SKETCH / 4 / MINHASHES)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("_v").alias("a"), F.col("_set").alias("_sa"))
    right = sets.select(F.col("_v").alias("b"), F.col("_set").alias("_sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "_sa", "_sb").mapInArrow(run, "a long, b long")


def _level(size: np.ndarray) -> np.ndarray:
    """How often the hash range is halved for a set of this size."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(1, size) / WHOLE))).astype(np.int64)


def _folded(sets: DataFrame, least: float) -> DataFrame:
    """Each set's size and odd sketches, with the number of shingles in each: from its own level to that of the
    largest set whose similarity with it can be ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, counts, bits = [], [], []
            for s in batch.column(1):
                mixed = mix64(np.frombuffer(s.as_buffer(), dtype=np.uint64))
                low, top = _level(np.array([len(mixed), len(mixed) / least + 1]))
                parts = [mixed[mixed >> np.uint64(64 - k) == 0] if k else mixed for k in range(low, top + 1)]
                sizes.append(len(mixed))
                counts.append([len(part) for part in parts])
                bits.append(b"".join(np.packbits((np.bincount((part % np.uint64(FINE)).astype(np.int64), minlength=FINE) & 1).astype(np.uint8)).tobytes()
                                     for part in parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(counts, pa.list_(pa.int32())), pa.array(bits, pa.binary())],
                                             names=["_v", "_size", "_counts", "_fine"])

    return sets.mapInArrow(run, "_v long, _size int, _counts array<int>, _fine binary").dropDuplicates(["_v"])


def _blocks(members: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(members / BLOCK)).cast("int")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members with each group (``_block``) of their bucket in which they meet others, and their side of it.

    A hash deals members outside the largest component into ``_p`` parts and the others into ``_q``.  Each of
    the former meets each of the latter, and each part's pairs are made with the first of these; then the
    parts meet one another."""
    part = F.pmod(F.xxhash64("_v"), F.when(F.col("_other"), F.col("_p")).otherwise(F.col("_q"))).cast("int")
    p, q, at = F.col("_p"), F.col("_q"), F.col("_at")
    meets = lambda block, side, own: F.struct(block.cast("long").alias("_block"), side.alias("_left"), own.alias("_own"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    wide = p.cast("long")
    left = F.concat(F.transform(upto(q), lambda k: meets(at * q.cast("long") + k, F.lit(True), k == 0)),
                    F.transform(F.filter(upto(p), lambda k: k != at),
                                lambda k: meets(wide * q + F.least(at, k) * wide + F.greatest(at, k), at < k, F.lit(False))))
    right = F.transform(upto(p), lambda k: meets(k * q.cast("long") + at, F.lit(False), at == 0))
    return (members.withColumn("_at", part).select("_band", "_v", "_c", F.explode(F.when(F.col("_other"), left).otherwise(right)).alias("_m"))
            .select("_band", "_v", "_c", "_m.*"))


def _between(members: DataFrame, partitions: int, least: float, best: int | None) -> DataFrame:
    """Pairs (a < b) of different components within a bucket's block whose bitmaps allow a link; ``best``: only
    the best few for each member of its left side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 2):
            v, comp, left, size = (group.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            fine = np.frombuffer(b"".join(group.column(6).to_pylist()), dtype=np.uint64).reshape(-1, FINE // 64)
            counts, level = group.column(8).flatten().to_numpy(), _level(size)
            # where the sketch of each member's level 0 would stand
            zero = np.cumsum([0, *pc.list_value_length(group.column(8)).to_pylist()])[:-1] - level
            bands = group.column(7).flatten().to_numpy().reshape(len(v), -1)
            here, within = group.column(0)[0].as_py(), group.column(9)[0].as_py()
            place = np.arange(len(v))
            out_a, out_b = [], []
            for i in np.flatnonzero(left).tolist():
                # each pair of the left side once, but for a choice from both of its ends
                apart = np.flatnonzero((comp != comp[i]) & (~left | (within & ((place > i) | (best is not None)))))
                # sizes alone rule out most of a mixed bucket
                apart = apart[np.minimum(size[apart], size[i]) >= least * np.maximum(size[apart], size[i])]
                if not len(apart):
                    continue
                at = np.maximum(level[apart], level[i])
                theirs, own = zero[apart] + at, zero[i] + at
                mine = fine[own] if (at > level[i]).any() else fine[own[0]]
                odd = np.bitwise_count(fine[theirs] ^ mine).sum(axis=1, dtype=np.int64)
                differ = np.log(np.maximum(1e-9, 1 - 2 * odd / FINE)) * (-FINE / 2)
                total = counts[theirs] + counts[own]
                est = (total - differ) / (total + differ)
                good = np.flatnonzero(est >= least)
                # two members meet in each band they share: the first one gives the pair
                shared = bands[apart[good]] == bands[i]
                good = good[bands[i][shared.argmax(axis=1)] == here]
                if best is not None and len(good) > best:
                    good = good[np.argpartition(-est[good], best - 1)[:best]]
                hit = v[apart[good]]
                out_a.append(np.minimum(hit, v[i]))
                out_b.append(np.maximum(hit, v[i]))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return (members.repartition(partitions, "_band", "_block").sortWithinPartitions("_band", "_block")
            .select("_band", "_block", "_v", "_c", "_left", "_size", "_fine", "_bands", "_counts", "_own").mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """Each row's id, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``."""
    spark = docs.sparkSession
    least = percent / 100 - MARGIN
    sig = freeze(signatures(docs, id_col, text_col, size))
    some = sig.filter("_n > 0")
    last = F.coalesce("_id", F.lit(_NO_ID))
    node = F.coalesce(F.min("_id"), F.lit(_NO_ID) + F.shiftrightunsigned(F.min("_lo"), 3))
    classes = freeze(some.groupBy("_hi", "_lo", "_n").agg(node.alias("_v"), F.min_by("_row", last).alias("_row"),
                                                          F.first("_bands").alias("_bands"), F.first("_sketch").alias("_sketch")))
    rows = classes.select("_v", F.explode("_bands").alias("_band"))
    shared = rows.groupBy("_band").agg(F.min("_v").alias("_a"), F.count("*").alias("_k")).filter("_k > 1")
    member = freeze(rows.join(shared, "_band").select("_band", "_v", "_a", "_k"))
    sketches = classes.select("_v", "_sketch")
    nodes = member.select("_v").distinct()
    # full sets of the classes that share a band, from one of their rows
    source = docs.select(row_key(docs, id_col, text_col).alias("_row"), F.col(text_col).alias("_text"))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(utf8_column(batch, "_text")):
                sets = pa.array([s.tobytes() for s in shingle_sets(data, offs, size)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sets], names=["_v", "_set"])

    wanted = classes.join(nodes, "_v", "left_semi").select("_row", "_v")
    sets = freeze(source.join(wanted, "_row").select("_v", "_text").mapInArrow(full, "_v long, _set binary"))
    # first links: the best of the smallest members of its buckets
    star = member.filter("_v <> _a").select("_v", "_a").distinct()
    star = (star.join(sketches, "_v").join(sketches.select(F.col("_v").alias("_a"), F.col("_sketch").alias("_other")), "_a")
            .select("_v", "_a", estimate(F.col("_sketch"), F.col("_other")).alias("_est")).filter(F.col("_est") >= least))
    star = star.groupBy("_v").agg(F.max_by("_a", "_est").alias("_a")).select(F.col("_a").alias("a"), F.col("_v").alias("b"))
    links = freeze(_confirm(star, sets, percent).distinct())
    labels = smallest_reachable(links)
    fine = freeze(_folded(sets, percent / 100 - FINE_MARGIN))
    for best in (BEST, None):
        named = (member.select("_band", "_v", "_k").join(labels.select(F.col("v").alias("_v"), F.col("c").alias("_c")), "_v", "left")
                 .withColumn("_c", F.coalesce("_c", "_v")))
        mixed = (named.groupBy("_band", "_c").agg(F.count("*").alias("_n"), F.max("_k").alias("_k"))
                 .groupBy("_band").agg(F.max_by("_c", "_n").alias("_main"), F.max("_n").alias("_most"), F.count("*").alias("_parts"), F.max("_k").alias("_k"))
                 .filter("_parts > 1").select("_band", "_main", _blocks(F.col("_k") - F.col("_most")).alias("_p"),
                         _blocks(F.col("_most")).alias("_q")))
        placed = named.drop("_k").join(mixed, "_band").withColumn("_other", F.col("_c") != F.col("_main"))
        placed = _in_blocks(placed).join(fine, "_v")
        placed = placed.join(classes.select("_v", "_bands"), "_v")
        pairs = freeze(_between(placed, shuffle_partitions(spark), percent / 100 - FINE_MARGIN, best))
        found = _confirm(pairs, sets, percent)
        more = freeze(links.unionByName(found).distinct())
        if more.count() == links.count():
            continue
        links = more
        labels = smallest_reachable(links)
    named = (classes.select("_hi", "_lo", "_n", "_v").join(labels.select(F.col("v").alias("_v"), F.col("c").alias("_c")), "_v", "left")
             .select("_hi", "_lo", "_n", F.coalesce("_c", "_v").alias("_c")))
    out = sig.select("_row", "_id", "_n", "_hi", "_lo").join(named, ["_hi", "_lo", "_n"], "left")
    component = F.when(F.col("_n") == 0, F.col("_id")).when(F.col("_c") < _NO_ID, F.col("_c"))
    return out.select("_row", F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"),
                      ((F.col("_n") == 0) | F.col("_id").eqNullSafe(component)).alias("kept"))
