"""Quality classifier: random Fourier features, ridge from partition-summed normal equations, isotonic calibration.

Statistics of a whole text (lengths, shares of character classes, word and line repetition) are
standardised and mapped to random Fourier features, whose inner products approximate a Gaussian kernel.
Each partition sums its part of the normal equations; the sums are added in a tree and solved on the
driver (their size depends on the number of features alone).  Scores of rows that a half's model has
not seen are calibrated by isotonic regression over fine score bins, interpolated between its steps.

All labelled training rows take part; several labels of one document count as their mean.

Edge cases: null is the empty text, whose statistics are zero, and gets a score too; without usable
labels every score is 0.5; labels without a document and null labels are not used; texts of any length
are read whole; repeated rows give the same result; other columns pass through or are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import LOWER, SPACE, byte_chunks, per_row, prefix_sums, row_sums, span_hashes, spans, utf8_column
from clientele.session import freeze

FOURIER = 256
RIDGE = 3.0
BINS = 2048
SUMS_EACH = 16

_UPPER, _LETTERS, _DIGIT, _HIGH, _SIGN, _STOP, _LINE = (np.zeros(256, dtype=bool) for _ in range(7))
_UPPER[0x41:0x5B] = True
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_DIGIT[0x30:0x3A] = True
_HIGH[0x80:] = True
_SIGN[[ord(c) for c in "#$%&*<=>@[\\]^_`{|}~+/"]] = True
_STOP[[ord(c) for c in ".,;:!?"]] = True
_LINE[0x0A] = True
_LOUD = np.zeros(256, dtype=bool)
_LOUD[[ord(c) for c in "!?"]] = True
_BAR = np.zeros(256, dtype=bool)
_BAR[ord("|")] = True

STATISTICS = ("log_chars", "log_words", "upper", "letters", "digits", "high", "signs", "stops", "loud", "bars", "spaces",
              "word_length", "word_spread", "long_words", "short_words", "distinct_words", "repeat_words", "top_word",
              "log_lines", "line_words", "repeat_lines", "distinct_pairs", "loud_words", "sign_words")


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text."""
    n = len(offs) - 1
    size = np.diff(offs)
    one = np.maximum(size, 1)
    share = lambda table: row_sums(table[data], offs) / one
    starts, ends = spans(~SPACE[data], offs)
    first = per_row(starts, offs)
    words = np.diff(first)
    some = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    mean = row_sums(length, first) / some
    spread = np.sqrt(np.maximum(row_sums(length ** 2, first) / some - mean ** 2, 0))
    hashes = span_hashes(prefix_sums(LOWER[data]), starts, ends)
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) else hashes
    lines, line_ends = spans(~_LINE[data], offs)
    line_first = per_row(lines, offs)
    line_hash = span_hashes(prefix_sums(data), lines, line_ends)
    distinct, top, two, fresh = (np.zeros(n) for _ in range(4))
    for r in range(n):
        own = hashes[first[r]:first[r + 1]]
        if len(own):
            counts = np.unique(own, return_counts=True)[1]
            distinct[r], top[r] = len(counts) / len(own), counts.max() / len(own)
            two[r] = len(np.unique(pairs[first[r]:first[r + 1] - 1])) / max(1, len(own) - 1)
        own = line_hash[line_first[r]:line_first[r + 1]]
        fresh[r] = 1 - len(np.unique(own)) / max(1, len(own))
    n_lines = np.diff(line_first)
    loud = row_sums(_LOUD[data[ends - 1]], first) / some if len(ends) else np.zeros(n)
    sign = row_sums(_SIGN[data[ends - 1]], first) / some if len(ends) else np.zeros(n)
    cols = [np.log1p(size), np.log1p(words), share(_UPPER), share(_LETTERS), share(_DIGIT), share(_HIGH), share(_SIGN),
            share(_STOP), share(_LOUD), share(_BAR), share(SPACE), mean, spread, row_sums(length > 14, first) / some,
            row_sums(length <= 3, first) / some, distinct, 1 - distinct, top, np.log1p(n_lines), words / np.maximum(1, n_lines),
            fresh, two, loud, sign]
    return np.array(cols, dtype=np.float64).T


def with_statistics(docs: DataFrame, text_col: str = "text", out_col: str = "_stats") -> DataFrame:
    """Add the statistics of every whole text (an array); the text itself is dropped."""
    kept = [f for f in docs.schema.fields if f.name not in (text_col, out_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in byte_chunks(utf8_column(batch, text_col)):
                own = batch.slice(lo, hi - lo)
                flat = statistics(data, offs).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * len(STATISTICS)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[own.column(own.schema.get_field_index(x)) for x in names], lists], names=[*names, out_col])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.select(*[F.col(f"`{x}`") for x in names], text_col).mapInArrow(run, f"{fields}`{out_col}` array<double>")


class Model:
    """Standardisation, random features, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(7)
        self.mean, self.scale = mean, scale
        k = len(mean)
        self.turn = rng.normal(0.0, 1.0 / np.sqrt(k), (k, FOURIER))
        self.phase = rng.uniform(0, 2 * np.pi, FOURIER)
        self.weights: np.ndarray | None = None
        self.steps: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(x), 1)), x, np.sqrt(2.0 / FOURIER) * np.cos(x @ self.turn + self.phase)])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or self.steps is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), *self.steps), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares fit by pooling neighbours: mean place and value of each pool."""
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x, y, weight):
        pools.append([xi * wi, yi * wi, wi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def fit(stats: DataFrame, label_col: str, half: Column, stats_col: str = "_stats") -> Model | None:
    """Fit on rows with statistics and a label in 0..1; ``half`` (0 or 1) splits them for calibration."""
    rows = freeze(stats.filter(F.col(label_col).isNotNull())
                  .select(stats_col, F.col(label_col).cast("double").alias("_y"), half.cast("int").alias("_half")))
    k = len(STATISTICS)
    got = rows.select(F.count("*"), *[f(F.col(stats_col)[i]) for i in range(k) for f in (F.avg, F.stddev_pop)]).first()
    if not got[0]:
        return None
    mean, scale = np.array(got[1::2]), np.array(got[2::2])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            z, y, own = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for h in (0, 1):
                zh = z[own == h]
                part = np.hstack([zh.T @ zh, (zh.T @ y[own == h])[:, None]])
                total[h] = total[h] + part if h in total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                             names=["half", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            for h, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_py())
                total[h] = total[h] + part if h in total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                             names=["half", "sums"])

    kind = "half int, sums binary"
    parts = rows.rdd.getNumPartitions()
    added = rows.mapInArrow(sums, kind)
    while parts > SUMS_EACH:  # partial sums are added in a tree
        parts = -(-parts // SUMS_EACH)
        added = added.repartition(parts).mapInArrow(add, kind)
    total = {h: 0.0 for h in (0, 1)}
    for h, raw in added.collect():
        total[h] = total[h] + np.frombuffer(bytes(raw)).reshape(-1, 2 + k + FOURIER)

    def solve(part: np.ndarray | float) -> np.ndarray:
        if isinstance(part, float):
            return np.zeros(1 + k + FOURIER)
        gram = part[:, :-1] + RIDGE * np.eye(len(part))
        return np.linalg.solve(gram, part[:, -1])

    halves = [solve(total[1]), solve(total[0])]  # each half is scored by the other half's weights
    model.weights = solve(total[0] + total[1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, own = model.features(_matrix(batch.column(0))), batch.column(2).to_numpy()
            raw = np.where(own == 0, z @ halves[0], z @ halves[1])
            at = np.clip(np.floor((raw + 0.5) * (BINS / 2)), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw), batch.column(1)], names=["bin", "raw", "y"])

    bins = rows.mapInArrow(binned, "bin int, raw double, y double").groupBy("bin").agg(F.avg("raw"), F.avg("y"), F.count("*")).collect()
    bins = np.array(sorted((r[1], r[2], r[3]) for r in bins))
    model.steps = isotonic(bins[:, 0], bins[:, 1], bins[:, 2])
    return model


def scored(stats: DataFrame, model: Model | None, stats_col: str = "_stats") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (score >= 0.5) to every row; the statistics are dropped."""
    names = [f.name for f in stats.schema.fields if f.name not in (stats_col, "score", "predicted")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in stats.schema.fields if f.name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index(stats_col)))
            score = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(score),
                                              pa.array((score >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    return stats.select(*[F.col(f"`{n}`") for n in names], stats_col).mapInArrow(run, f"{fields}score double, predicted int")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of an id as text, by a modulus (a null id counts as crc32 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(0)) % modulus


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            held_out: Column | None = None, extra: tuple[Column, ...] = ()) -> tuple[DataFrame, Model | None]:
    """Statistics of every document (id, held_out, statistics; written once) and the model fitted on the labels
    of those not held out; ``extra`` columns go along."""
    held_out = remainder(id_col, 3) == 1 if held_out is None else held_out
    stats = freeze(with_statistics(docs.select(F.col(id_col), held_out.alias("held_out"), *extra, F.col(text_col)), text_col))
    marks = (labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_label_id"))
             .agg(F.avg(F.col("quality").cast("double")).alias("_label")))
    train = stats.filter(~F.col("held_out")).join(marks, F.col(id_col) == F.col("_label_id"))
    return stats, fit(train, "_label", remainder(id_col, 2))
