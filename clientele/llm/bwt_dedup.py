"""Removal of long repeated byte strings: suffix orders of shards merged by interleave refinement.

Every byte covered by a LENGTH-byte string that also starts anywhere else (in the same text too) is
removed, judged on the input.  A text's positions fall into runs that share the smallest hashed GRAM
(leftmost) within the LENGTH bytes from there; equal strings have equal smallest grams at equal
distance, so a string can repeat only among runs with an equal gram.  Whole runs are symbols: a symbol
that stands twice in the corpus marks all its strings as repeated, and only runs with a repeated gram
but a symbol of their own are looked into.

There the suffixes (the strings' starts) of the shards' distinct runs are merged.  A suffix's symbols
are hashes of its successive STEP-byte blocks, a coarse alphabet in which LENGTH bytes are four symbols
deep.  The merge starts from the shards one after the other, within intervals of one gram and distance,
and refines the interleaving symbol by symbol by stable counting: an interval splits where the next
symbols differ, one with a single suffix is done, and what is left after the last step are the repeated
intervals (common prefixes of LENGTH bytes).  No suffixes are sorted again as a whole.

Grams with more distinct runs than HOT are not brought together: their strings' hashes are counted
over the cluster instead (the same decision, one row for each string).

Hashes have 64 bits.  Edge cases: null is the empty text; texts shorter than LENGTH keep all bytes;
repeated rows are occurrences of their own; texts of any length are read whole; other columns pass
through unchanged (columns named like an output column are replaced); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import byte_chunks, mix64, prefix_sums, row_key, row_sums, shuffle_partitions, span_hashes, utf8_column, window_hashes
from clientele.session import freeze, release

LENGTH = 200
GRAM = 16
STEP = 50
#: Distinct runs of one gram above which its strings are counted over the cluster.
HOT = 4096
#: Runs that stand more often (and more than once in a thousand members, so at most a thousand of
#: them) are marked by a broadcast of their keys, not by a shuffle that brings their members together.
OFTEN = 50_000
#: Suffixes merged at a time.
MERGE = 1 << 20

_PLACE = (1 << 24) - 1


def _runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of string starts with the same smallest gram: row, first and last start, gram place, gram hash,
    symbol.  Texts longer than 2**23 bytes are read in overlapping parts."""
    rows, lo, hi, at, gram, symbol = [], [], [], [], [], []
    if len(data) > 1 << 23:
        part = 1 << 22
        for r in range(len(offs) - 1):
            for s in range(int(offs[r]), max(int(offs[r]) + 1, int(offs[r + 1]) - LENGTH + 1), part):
                e = min(int(offs[r + 1]), s + part + LENGTH - 1)
                got = _runs(data[s:e], np.array([0, e - s]))
                rows.append(np.full(len(got[0]), r))
                for out, own in zip((lo, hi, at), got[1:4]):
                    out.append(own + s)
                gram.append(got[4])
                symbol.append(got[5])
        return tuple(np.concatenate(x) for x in (rows, lo, hi, at, gram, symbol))
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    sums = prefix_sums(data)
    grams = window_hashes(sums, GRAM)
    low = grams & ~np.uint64(_PLACE)
    low |= np.arange(len(grams), dtype=np.uint64)
    width, want = 1, LENGTH - GRAM + 1
    while 2 * width <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (want - width)], low[want - width:])
    low &= np.uint64(_PLACE)
    n = len(low)
    inside = np.repeat(offs[1:] - LENGTH, np.diff(offs))[:n] >= np.arange(n)
    change = low[1:] != low[:-1]
    border = offs[1:-1] - 1
    change[border[(border >= 0) & (border < n - 1)]] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= change | ~inside[:-1]
    end[:-1] &= change | ~inside[1:]
    first, last = np.flatnonzero(start), np.flatnonzero(end)
    at = low[first].astype(np.int64)
    return np.searchsorted(offs, first, side="right") - 1, first, last, at, grams[at], span_hashes(sums, first, last + LENGTH)


def merge_interleaved(interval: np.ndarray, symbols: list[np.ndarray]) -> np.ndarray:
    """Which suffixes agree with another one in their interval and all symbols.

    The order begins with the shards' suffixes one after the other; each step refines the intervals by the
    next symbol (a stable distribution within each interval) and drops suffixes that stand alone."""
    order = np.argsort(interval, kind="stable")
    group = interval[order]
    for symbol in symbols:
        own = symbol[order]
        move = np.lexsort((own, group))
        order, own, group = order[move], own[move], group[move]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (group[1:] != group[:-1])
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        order = order[~alone]
    out = np.zeros(len(interval), dtype=bool)
    out[order] = True
    return out


def _ranges(flags: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each stretch of flags its runs of set ones, as pairs of first and last place (int32)."""
    edge = np.zeros(len(flags) + 1, dtype=bool)
    edge[bounds] = True
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1] | edge[1:-1]
    last[:-1] &= ~flags[1:] | edge[1:-1]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    cut = np.searchsorted(first, bounds)
    pairs = np.stack([first, last], axis=1)
    return [(pairs[a:b] - s).astype(np.int32).tobytes() for a, b, s in zip(cut[:-1], cut[1:], bounds[:-1])]


def _repeated_within(grams: np.ndarray, away: np.ndarray, times: np.ndarray, strings: list[bytes]) -> list[bytes]:
    """For each run (its gram, the gram's distance from its first start, its number in the corpus and its bytes)
    the ranges of starts whose strings also stand in another run of the batch or in a run that stands twice."""
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    size = np.array([len(s) for s in strings])
    begin = np.cumsum(size) - size
    count = size - LENGTH + 1
    bounds = np.concatenate([[0], np.cumsum(count)])
    run = np.repeat(np.arange(len(strings)), count)
    step = np.arange(bounds[-1]) - bounds[run]
    sums = prefix_sums(data)
    start = begin[run] + step
    distance = (away[run] - step).astype(np.uint64)
    interval = mix64(grams[run] + distance * np.uint64(0x9E3779B97F4A7C15))
    symbols = [span_hashes(sums, start + k, start + k + STEP) for k in range(0, LENGTH, STEP)]
    return _ranges(merge_interleaved(interval, symbols) | (times[run] > 1), bounds)


_LOOKED = "h long, r long, ranges binary"


def _marks(docs: DataFrame, partitions: int) -> tuple[DataFrame, list[DataFrame]]:
    """For each row with repeated strings its runs (number in the text) and their ranges (null: the whole run)."""

    def scan(wide: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key = batch.column(0).to_numpy()
                for lo, hi, data, offs in byte_chunks(utf8_column(batch, "_text")):
                    row, first, _, _, gram, symbol = _runs(data, offs)
                    if not wide:
                        grams, times = np.unique(gram, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(times)], names=["h", "n"])
                        continue
                    number = np.arange(len(row)) - np.searchsorted(row, np.arange(hi - lo))[row]
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(symbol.view(np.int64)), pa.array(key[lo:hi][row]),
                                                      pa.array(number.astype(np.int32))], names=["h", "r", "_row", "j"])
        return run

    grams = docs.mapInArrow(scan(False), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    grams = freeze(grams)
    members = freeze(docs.mapInArrow(scan(True), "h long, r long, _row long, j int").join(grams, "h"))
    release(grams)
    runs = freeze(members.groupBy("h", "r").agg(F.count("*").alias("n"), F.min(F.struct("_row", "j")).alias("at")))
    mixed = runs.groupBy("h").agg(F.count("*").alias("k"), F.min("n").alias("least")).filter("k > 1 AND least = 1").select("h", "k")
    wanted = (runs.join(mixed, "h").select("h", "r", "n", "k", F.col("at._row").alias("_row"), F.col("at.j").alias("j"))
              .groupBy("_row").agg(F.collect_list(F.struct("j", "h", "r", "n", "k")).alias("want")))
    kind = "h long, r long, n long, k long, away int, bytes binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column(2)
            field = {n: want.flatten().field(n).to_numpy() for n in ("j", "h", "r", "n", "k")}
            ends = np.concatenate([[0], np.cumsum(want.value_lengths().to_numpy())])
            for lo, hi, data, offs in byte_chunks(utf8_column(batch, "_text")):
                row, first, last, at, _, _ = _runs(data, offs)
                base = np.searchsorted(row, np.arange(hi - lo))
                own = slice(int(ends[lo]), int(ends[hi]))
                run = np.repeat(base, np.diff(ends[lo:hi + 1])) + field["j"][own]
                raw = [data[a:b].tobytes() for a, b in zip(first[run], last[run] + LENGTH)]
                yield pa.RecordBatch.from_arrays([*[pa.array(field[n][own]) for n in ("h", "r", "n", "k")],
                                                  pa.array((at - first)[run].astype(np.int32)), pa.array(raw, pa.binary())],
                                                 names=["h", "r", "n", "k", "away", "bytes"])

    pieces = freeze(docs.join(wanted, "_row").select("_row", "_text", "want").mapInArrow(cut, kind).dropDuplicates(["h", "r"]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:  # sorted by gram: cut only between grams
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            h = batch.column(0).to_numpy()
            if not len(h):
                continue
            whole = int(np.searchsorted(h, h[-1]))
            if whole:
                yield from looked(batch.slice(0, whole))
            held = batch.slice(whole)
        if held is not None and held.num_rows:
            yield from looked(held)

    def looked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h = batch.column(0).to_numpy()
        strings = batch.column(4).to_pylist()
        total = np.cumsum([len(s) for s in strings])
        cuts = np.flatnonzero(np.diff(h)) + 1
        lo = 0
        while lo < len(h):
            ends = cuts[cuts > lo]
            fit = ends[total[ends - 1] - (total[lo - 1] if lo else 0) <= MERGE]
            hi = int(fit[-1]) if len(fit) else int(ends[0]) if len(ends) else len(h)
            if len(ends) and len(fit) == len(ends) and total[-1] - (total[lo - 1] if lo else 0) <= MERGE:
                hi = len(h)
            found = _repeated_within(h[lo:hi].view(np.uint64), batch.column(3).to_numpy()[lo:hi], batch.column(2).to_numpy()[lo:hi], strings[lo:hi])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(found, pa.binary())],
                                             names=["h", "r", "ranges"])
            lo = hi

    cool = pieces.filter(F.col("k") <= HOT).select("h", "r", "n", "away", "bytes")
    looked_into = (cool.repartition(partitions, "h").sortWithinPartitions("h").mapInArrow(merge, _LOOKED)
                   .unionByName(_counted(pieces.filter(F.col("k") > HOT))))
    looked_into = freeze(looked_into.filter(F.length("ranges") > 0))
    release(pieces)
    # a run that stands twice is repeated as a whole; of the others what was found within
    decided = (runs.select("h", "r", "n").join(looked_into, ["h", "r"], "left").filter("n > 1 OR ranges IS NOT NULL")
               .select("h", "r", F.when(F.col("n") == 1, F.col("ranges")).alias("ranges")))
    often = F.broadcast(runs.filter(F.col("n") > max(OFTEN, members.count() // 1000)).select("h", "r"))
    whole = members.join(often, ["h", "r"]).select("_row", "j", F.lit(None).cast("binary").alias("ranges"))
    others = members.join(often, ["h", "r"], "left_anti").join(decided, ["h", "r"]).select("_row", "j", "ranges")
    marks = whole.unionByName(others).groupBy("_row").agg(F.collect_set(F.struct("j", "ranges")).alias("marks"))
    marks = freeze(marks)
    release(members, runs, looked_into)
    return marks, [marks]


def _counted(pieces: DataFrame) -> DataFrame:
    """The same decision for grams with very many distinct runs: hashes of all their strings, counted over the cluster."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column(3).to_pylist()):
                data = np.frombuffer(raw, dtype=np.uint8)
                first = np.arange(len(data) - LENGTH + 1)
                n = len(first)
                yield pa.RecordBatch.from_arrays([pa.array(span_hashes(prefix_sums(data), first, first + LENGTH).view(np.int64)),
                                                  *[pa.array(np.full(n, batch.column(k)[i].as_py())) for k in range(3)],
                                                  pa.array(first.astype(np.int32))], names=["s", "h", "r", "n", "at"])

    rows = pieces.select("h", "r", "n", "bytes").mapInArrow(strings, "s long, h long, r long, n long, at int")
    twice = rows.groupBy("s").agg(F.sum("n").alias("all")).filter("all > 1").select("s")
    places = rows.join(twice, "s").groupBy("h", "r").agg(F.array_sort(F.collect_set("at")).alias("at"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in batch.column(2).to_pylist():
                flags = np.zeros(max(at) + 1, dtype=bool)
                flags[at] = True
                out += _ranges(flags, np.array([0, len(flags)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["h", "r", "ranges"])

    return places.mapInArrow(joined, _LOOKED)


def _removed(data: np.ndarray, offs: np.ndarray, row: np.ndarray, number: np.ndarray, ranges: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Removed stretches of bytes (first place, end) of the texts, from their marks: the row, the run's number in it
    and its ranges (null: the whole run).  Stretches that touch are one, but none goes beyond its text."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of, begin, end = _runs(data, offs)[:3]
    run = np.searchsorted(of, row) + number
    whole = ranges.is_null().to_numpy(zero_copy_only=False)
    parts = ranges.drop_null()
    pairs = np.frombuffer(b"".join(parts.to_pylist()), dtype=np.int32).reshape(-1, 2)
    times = np.diff(np.frombuffer(parts.buffers()[1], np.int32)[parts.offset:parts.offset + len(parts) + 1]) // 8 if len(parts) else []
    shift = np.repeat(begin[run[~whole]], times)
    first = np.concatenate([begin[run[whole]], shift + pairs[:, 0]])
    last = np.concatenate([end[run[whole]], shift + pairs[:, 1]]) + LENGTH
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    text = np.searchsorted(offs, first, side="right")
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] > last[:-1]) | (text[1:] != text[:-1])
    return first[new], last[np.append(new[1:], True)]


def deduplicate(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with ``n_bytes``, ``kept`` (the remaining bytes) and ``spans`` (removed stretches of bytes, end exclusive), and the
    columns named in ``keep``."""
    names = [n for n in keep if n not in ("n_bytes", "kept", "spans")]
    key = row_key(docs, *names[:1], text_col)  # the result depends on the text; one more column spreads equal texts
    carried = F.struct(F.lit(0), *[F.col(f"`{n}`") for n in names])  # one column, so that no name clashes
    source = docs.select(carried.alias("_doc"), key.alias("_row"), F.col(text_col).alias("_text"))
    marks, _ = _marks(source.select("_row", "_text"), shuffle_partitions(docs.sparkSession))
    kind = source.schema["_doc"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = batch.column(batch.schema.get_field_index("marks"))
            ends = np.concatenate([[0], np.cumsum(marked.value_lengths().fill_null(0).to_numpy())])
            flat = marked.flatten()
            number, ranges = flat.field("j").to_numpy(), flat.field("ranges")
            for lo, hi, data, offs in byte_chunks(utf8_column(batch, "_text")):
                own = slice(int(ends[lo]), int(ends[hi]))
                row = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))
                first, last = _removed(data, offs, row, number[own], ranges[own])
                row = np.searchsorted(offs, first, side="right") - 1
                edge = np.zeros(len(data) + 1, dtype=np.int8)
                edge[first] += 1
                np.subtract.at(edge, last, 1)  # a span may end where the next text's begins
                rest = data[np.cumsum(edge[:-1], dtype=np.int8) == 0] if len(first) else data
                gone = row_sums(last - first, np.searchsorted(row, np.arange(hi - lo + 1)))
                kept = np.concatenate([[0], np.cumsum(np.diff(offs) - gone)]).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(first - offs[row]), pa.array(last - offs[row])], ["start", "end"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offs)),
                                                  pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(kept), pa.py_buffer(np.ascontiguousarray(rest))]),
                                                  pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)), spans)],
                                                 names=["_doc", "n_bytes", "kept", "spans"])

    return (source.join(marks, "_row", "left").select("_doc", "_text", "marks")
            .mapInArrow(remove, f"_doc {kind}, n_bytes long, kept binary, spans array<struct<start: bigint, end: bigint>>")
            .select(*[F.col(f"_doc.`{n}`") for n in names], "n_bytes", "kept", "spans"))


def report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text: its bytes, removed bytes and stretches, and the digest of what is kept."""
    out = deduplicate(docs, keep=(id_col,))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
