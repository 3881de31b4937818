"""Sharding over fixed virtual slots, with a versioned slot-to-shard map.

A record's slot is a hash of its id and text modulo SLOTS, which never changes.  Bytes and rows are summed for
each slot, and a map says which shard holds each slot.  A map is a small table (one row for each slot) kept in
versions: ``initial_map`` deals the slots round, ``rebalance`` edits it (moves of single slots from the fullest
shard to the emptiest until no move brings them nearer) and ``grow`` gives a new shard slots from the others and
moves nothing else.  Every edit is a new version; older ones stay readable (``save_map``, ``load_map``).

The law is ``bytes``: the shards' sizes are near equal.  A slot that holds more than HOT mean slots of bytes (a
record that stands many times, or a very long text) is split into PARTS parts, each a row of the map: its
records are spread by their place in the table as well, so copies of one record need not share a shard.

A record's place in its shard is gapless from 0, in the order of slots; it comes from one sort of the narrow
keys (id, size, checksum) spread over all tasks, whatever id, text or slot is common.  Only the sums of slots
and the maps (SLOTS rows, PARTS for hot ones) reach the driver.  Everything is native DataFrame code.

Edge cases: a null text has size 1 and the checksum of no bytes (0); a null id is hashed like any other; equal
rows are told apart by their place in the table, so they may go to different shards when their slot is hot;
ties in the edits go to the smaller slot and shard; an empty table gives no rows and a map whose slots are
empty; other columns pass through ``write`` unchanged, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators.ranking import global_rank
from clientele.session import freeze, frozen_path

SLOTS = 4096
HOT = 8.0
PARTS = 256
MAP = "version int, virtual_slot int, part int, shard int, bytes long, rows long"


def text_bytes(text: Column) -> Column:
    """The record's size: UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def virtual_slot(doc_id: Column, crc: Column, slots: int = SLOTS) -> Column:
    """The record's slot, from its id and its text's checksum alone."""
    return F.pmod(F.xxhash64(doc_id.isNull(), doc_id, crc), F.lit(slots)).cast("int")


def _part(parts: int) -> Column:
    """A record's part of a split slot: copies of one record are spread by their place in the table."""
    return F.pmod(F.xxhash64("doc_id", "text_crc32", "_place"), F.lit(parts)).cast("int")


def record_keys(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot and place in the table of every record, written once."""
    keys = docs.select(F.col("doc_id"), text_bytes(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("_place"))
    return freeze(keys.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots)))


def split_slots(keys: DataFrame, slots: int = SLOTS, hot: float = HOT, parts: int = PARTS) -> tuple[DataFrame, list]:
    """The keys with their ``part`` (0 but for hot slots), and (virtual_slot, part, bytes, rows) of every slot,
    empty ones included; at most ``slots`` + hot slots * ``parts`` rows, and at most slots / hot are hot."""
    sums = {r[0]: (r[1], r[2]) for r in keys.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect()}
    limit = hot * sum(b for b, _ in sums.values()) / slots
    large = sorted(s for s, (b, n) in sums.items() if b > limit and n > 1)
    part = F.when(F.col("virtual_slot").isin(large), _part(parts)).otherwise(F.lit(0)) if large else F.lit(0)
    keys = keys.withColumn("part", part)
    out = [(s, 0, *sums.get(s, (0, 0))) for s in range(slots) if s not in set(large)]
    if large:
        pieces = keys.filter(F.col("virtual_slot").isin(large)).groupBy("virtual_slot", "part").agg(F.sum("size"), F.count("*"))
        have = {(r[0], r[1]): (r[2], r[3]) for r in pieces.collect()}
        out += [(s, p, *have.get((s, p), (0, 0))) for s in large for p in range(parts)]
    return keys, sorted(out)


def initial_map(sums: list, shards: int) -> list:
    """Version 1: slots dealt round over the shards."""
    return [(1, s, p, (s + p) % shards, b, n) for s, p, b, n in sums]


def _edited(slot_map: list, shard: np.ndarray) -> list:
    version = slot_map[0][0] + 1 if slot_map else 1
    return [(version, s, p, int(to), b, n) for (_, s, p, _, b, n), to in zip(slot_map, shard)]


def rebalance(slot_map: list, shards: int) -> list:
    """The next version: single slots move from the fullest shard to the emptiest while that brings them nearer;
    where no move does, two slots swap.  Each edit takes the slot (or pair) nearest to half the difference."""
    size = np.array([r[4] for r in slot_map], np.int64)
    shard = np.array([r[3] for r in slot_map], np.int64)
    total = np.bincount(shard, weights=size, minlength=shards).astype(np.int64)
    while True:
        order = np.lexsort((np.arange(shards), total))
        for low, high in ((order[0], order[-1]), *((order[0], h) for h in order[-2:0:-1]), *((lo, order[-1]) for lo in order[1:-1])):
            gap = total[high] - total[low]
            mine, other = np.flatnonzero((shard == high) & (size > 0)), np.flatnonzero(shard == low)
            if gap <= 1 or not len(mine):
                continue
            best = mine[np.argmin(np.abs(2 * size[mine] - gap))]
            if 0 < size[best] < gap and 2 * min(size[best], gap - size[best]) > gap // 64:
                shard[best], moved = low, size[best]
            else:  # swap: the other slot nearest to each one's size less half the gap
                if not len(other):
                    continue
                there = other[np.argsort(size[other], kind="stable")]
                at = np.clip(np.searchsorted(size[there], size[mine] - gap // 2), 0, len(there) - 1)
                change = size[mine] - size[there[at]]
                k = int(np.argmin(np.abs(2 * change - gap)))
                moved = change[k]
                if not 0 < moved < gap or 2 * min(moved, gap - moved) <= gap // 64:
                    continue
                shard[mine[k]], shard[there[at[k]]] = low, high
            total[high] -= moved
            total[low] += moved
            break
        else:
            return _edited(slot_map, shard)


def grow(slot_map: list, shards: int) -> list:
    """The next version with one more shard, which takes its share of bytes slot by slot from the fullest
    shards; no other slot moves."""
    size = np.array([r[4] for r in slot_map], np.int64)
    shard = np.array([r[3] for r in slot_map], np.int64)
    total = np.bincount(shard, weights=size, minlength=shards + 1).astype(np.int64)
    share = int(total.sum()) // (shards + 1)
    while True:
        left = share - total[shards]
        moved = False
        for high in np.lexsort((np.arange(shards), -total[:shards])):
            mine = np.flatnonzero((shard == high) & (size > 0) & (size <= min(left, total[high] - share)))
            if len(mine):
                pick = mine[np.argmax(size[mine])]
                shard[pick] = shards
                total[high] -= size[pick]
                total[shards] += size[pick]
                moved = True
                break
        if not moved:
            return _edited(slot_map, shard)


def map_frame(spark: SparkSession, slot_map: list) -> DataFrame:
    return spark.createDataFrame(slot_map, MAP)


def save_map(spark: SparkSession, slot_map: list, folder: str) -> None:
    """Write a version beside the earlier ones; a version that stands there already is an error."""
    map_frame(spark, slot_map).drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={slot_map[0][0]}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> list:
    """A stored version, the latest if none is named."""
    table = spark.read.parquet(folder)
    version = version if version is not None else table.agg(F.max("version")).first()[0]
    rows = table.filter(F.col("version") == version).select("version", "virtual_slot", "part", "shard", "bytes", "rows").collect()
    return sorted(tuple(r) for r in rows)


def assign(keys: DataFrame, slot_map: list) -> DataFrame:
    """``keys`` (with ``part``) plus ``shard`` and ``slot``, the record's place in its shard, gapless from 0."""
    spark = keys.sparkSession
    slots, starts, used = [], 0, {}
    for _, s, p, shard, _, n in sorted(slot_map, key=lambda r: (r[1], r[2])):
        slots.append((s, p, shard, used.get(shard, 0) - starts))  # from the place among all records to that in the shard
        starts += n
        used[shard] = used.get(shard, 0) + n
    ranked = global_rank(keys, ["virtual_slot", "part", "doc_id", "text_crc32", "_place"])
    table = spark.createDataFrame(slots, "virtual_slot int, part int, shard int, _shift long")
    # the map is a few thousand rows by construction
    return (ranked.join(F.broadcast(table), ["virtual_slot", "part"])
            .withColumn("slot", F.col("_rank") - 1 + F.col("_shift")).drop("_shift", "_rank"))


def sharded(docs: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None) -> tuple[DataFrame, list]:
    """Every record's shard and place, and the map; versions 1 (dealt round) and 2 (rebalanced) are stored in
    ``folder`` (one of its own in the shared checkpoint folder if none is given)."""
    spark = docs.sparkSession
    keys, sums = split_slots(record_keys(docs, slots), slots)
    folder = folder or frozen_path(spark, "slots")
    first = initial_map(sums, shards)
    save_map(spark, first, folder)
    save_map(spark, rebalance(first, shards), folder)
    current = load_map(spark, folder)
    return assign(keys, current), current


def write(docs: DataFrame, slot_map: list, path: str, files_each: int = 1, slots: int = SLOTS) -> None:
    """Write ``docs`` under ``path`` as one folder for each shard of the map, each in up to ``files_each`` files.

    A record's part of a split slot is drawn from its place in the table, as in ``sharded``."""
    names = docs.columns
    crc = text_crc32(F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_doc"), F.col("doc_id").alias("doc_id"), crc.alias("text_crc32"),
                       F.monotonically_increasing_id().alias("_place"))
    hot = sorted({s for _, s, p, *_ in slot_map if p > 0})
    slot = virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots)
    rows = rows.withColumn("virtual_slot", slot).withColumn(
        "part", F.when(F.col("virtual_slot").isin(hot), _part(PARTS)).otherwise(F.lit(0)) if hot else F.lit(0))
    table = docs.sparkSession.createDataFrame([(s, p, to) for _, s, p, to, _, _ in slot_map], "virtual_slot int, part int, shard int")
    out = rows.join(F.broadcast(table), ["virtual_slot", "part"])
    out = out.repartition(F.col("shard"), F.pmod(F.xxhash64("_place"), F.lit(files_each)))
    out.select("_doc", "shard").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard (null: not that law), virtual_slot, part."""
    out, _ = sharded(docs, shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "part")
