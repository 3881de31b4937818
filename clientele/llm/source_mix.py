"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's target (in words) is its share by weight of the mix, at most ``max_repeats`` times its
size; what is above is shared out again by weight.  A hash deals a source's documents into blocks of
about ``block_words`` words, so blocks are exchangeable random parts of the source.  A target takes
whole passes over all blocks and, for the rest, the first blocks and, up to the target, documents of the
next FILL_BLOCKS, or of as many as it takes where long documents do not fit.  The blocks to draw are exact quotas by source; a tree splits them among the output shards:
at each node the left half's quotas are one multivariate hypergeometric draw from the node's, so shards
get disjoint random parts of equal size.  A shard takes its run of each source's permuted blocks (another
permutation for each pass), and its rows are shuffled locally, by a hash.  All draws are seeded: reruns agree.

Only sizes, sums of blocks and quotas are planned; the plan has one row for each source and shard or block.

Edge cases: null text has size 0; documents of size 0 are never taken; sources go by code point with
null last (null is a source of its own); a table without words gives targets of 0; repeated rows are
documents of their own (rows equal in id, source and text share their fate); texts of any length count
whole and may be longer than a block; other columns pass through unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.session import freeze

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 16_384
SHARD_WORDS = 4_000_000
#: Blocks whose documents may fill the rest of a target (more, if it stays larger than a block).
FILL_BLOCKS = 4
#: A target is filled when at most this part of a block is left.
FILLED = 64
#: Depth of the subtree that one step of the splitting tree expands.
DEPTH = 6
_GROUP = 1024
_SEED = 20_240_607


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, max_repeats: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row for each source (``_source``): source_size, weight and target words.

    In the order of limit by weight, the share a unit of weight gets if all sources before are at their
    limits rises while sources are below it and falls after; its largest value is the share of those
    that stay below their limits."""
    total = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(float(w)) for w in weights])
    rows = total.select("_source", "source_size", F.get(weight, F.pmod(place, F.lit(len(weights)))).alias("weight"))
    limit = F.col("source_size") * float(max_repeats)
    order = Window.orderBy(limit / F.col("weight"), F.col("_source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "_left": F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum(limit).over(upto), F.lit(0.0)),
        "_rest": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    level = F.max(F.col("_left") / F.col("_rest")).over(Window.partitionBy())
    return rows.select("_source", "source_size", "weight", F.least(limit, level * F.col("weight")).alias("target"))


def _fill(group: pd.DataFrame) -> pd.DataFrame:
    """Documents of a few blocks that fill what is left of a target, first fit."""
    group = group.sort_values(["_block", "_key", "_size"], kind="stable")
    left, kept = float(group["_left"].iloc[0]), []
    for size in group["_size"]:
        take = size <= left
        left -= size if take else 0
        kept.append(take)
    return group.loc[kept, ["_source", "_key", "_size"]]


def _filled(base: DataFrame, sources: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame]:
    """Documents that fill what is left of the targets (``_source``, ``_key``), and where their blocks end.

    First the FILL_BLOCKS blocks at the border; while more than a part (FILLED) of a block is left, as long
    documents stood there, the next blocks up to that many words of documents that still fit and FILL_BLOCKS more."""
    same = lambda name: F.col("_source").eqNullSafe(F.col(name))
    docs = base.select("_source", "_size", "_key", "_block").filter("_size > 0")
    state = (sources.filter("_left > 0")
             .select(F.col("_source").alias("_ls"), F.col("_blocks").alias("_all"), "_upto", F.col("_upto").alias("_from"),
                     F.least(F.col("_upto") + FILL_BLOCKS, F.col("_blocks")).alias("_to"), "_left"))
    chosen = None
    while True:
        fits = docs.join(state, same("_ls") & (F.col("_block") >= F.col("_from")) & (F.col("_block") < F.col("_to"))).filter("_size <= _left")
        part = freeze(fits.select("_source", "_block", "_key", "_size", "_left").groupBy("_source")
                      .applyInPandas(_fill, "_source string, _key long, _size long"))
        chosen = part if chosen is None else chosen.unionByName(part)
        took = part.groupBy(F.col("_source").alias("_ts")).agg(F.sum("_size").alias("_took"))
        state = freeze(state.join(took, F.col("_ls").eqNullSafe(F.col("_ts")), "left")
                       .select("_ls", "_all", "_upto", "_from", "_to", (F.col("_left") - F.coalesce("_took", F.lit(0))).alias("_left")))
        unfilled = state.filter((F.col("_left") * FILLED > block_words) & (F.col("_to") < F.col("_all")))
        if unfilled.isEmpty():
            break
        fits = docs.join(unfilled, same("_ls") & (F.col("_block") >= F.col("_to"))).filter("_size <= _left")
        done = _running(fits.groupBy("_source", "_block").agg(F.sum("_size").alias("_words"), F.first("_left").alias("_left")))
        reach = (done.filter(F.col("_done") < F.col("_left") + FILL_BLOCKS * block_words)
                 .groupBy(F.col("_source").alias("_rs")).agg((F.max("_block") + 1).alias("_reach")))
        more = (F.col("_left") * FILLED > block_words) & (F.col("_to") < F.col("_all"))
        state = freeze(state.join(reach, F.col("_ls").eqNullSafe(F.col("_rs")), "left")
                       .select("_ls", "_all", "_upto", F.col("_to").alias("_from"),
                               F.when(more, F.coalesce("_reach", "_all")).otherwise(F.col("_to")).alias("_to"), "_left"))
    # the smallest remaining document, if that comes nearer
    taken = chosen.select(F.col("_source").alias("_cs"), F.col("_key").alias("_ck")).distinct()
    rest = docs.join(state.filter("_left > 0"), same("_ls") & (F.col("_block") >= F.col("_upto")) & (F.col("_block") < F.col("_to")))
    rest = rest.filter(F.col("_size") < 2 * F.col("_left")).join(taken, same("_cs") & (F.col("_key") == F.col("_ck")), "left_anti")
    rest = rest.groupBy("_source").agg(F.min(F.struct("_size", "_block", "_key")).alias("_best")).select("_source", "_best._key")
    return freeze(chosen.select("_source", "_key").unionByName(rest)), state.select("_ls", F.col("_to").alias("_end"))


def _running(words: DataFrame) -> DataFrame:
    """Blocks with the words of their source's blocks before (``_done``), in two steps of bounded windows."""
    words = freeze(words.withColumn("_group", F.floor(F.col("_block") / _GROUP)))
    before = Window.partitionBy("_source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (words.groupBy("_source", "_group").agg(F.sum("_words").alias("_sum"))
              .select(F.col("_source").alias("_gs"), F.col("_group").alias("_g"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")))
    run = Window.partitionBy("_source", "_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return (words.withColumn("_run", F.coalesce(F.sum("_words").over(run), F.lit(0)))
            .join(groups, F.col("_source").eqNullSafe(F.col("_gs")) & (F.col("_group") == F.col("_g")))
            .withColumn("_done", F.col("_before") + F.col("_run")))


#: NumPy draws hypergeometric numbers below this many blocks.
_EXACT = 1_000_000_000


def _drawn(rng: np.random.Generator, own: np.ndarray, take: int) -> np.ndarray:
    """A multivariate hypergeometric draw of ``take`` blocks from ``own``.  While _EXACT or more blocks are left, a source's
    number comes from the normal limit (rounded, within what is possible); the total is exact."""
    out = np.zeros(len(own), dtype=np.int64)
    rest = int(own.sum())
    for i, n in enumerate(own.tolist()):
        if rest < _EXACT:
            out[i:] = rng.multivariate_hypergeometric(own[i:], take, method="marginals")
            break
        share = n / rest
        spread = math.sqrt(max(0.0, take * share * (1.0 - share) * ((rest - take) / max(1, rest - 1))))
        drawn = take * n // rest + round(spread * rng.standard_normal())
        out[i] = max(0, take - (rest - n), min(n, take, drawn))
        take, rest = take - int(out[i]), rest - n
    return out


def _split(quotas: pd.DataFrame) -> pd.DataFrame:
    """One node of the tree and the subtree below it: quotas by source of the nodes at its end."""
    quotas = quotas.sort_values("_source", na_position="last", kind="stable")
    out = []
    todo = [(int(quotas["_lo"].iloc[0]), int(quotas["_hi"].iloc[0]), quotas["_quota"].to_numpy(np.int64), 0)]
    while todo:
        lo, hi, own, depth = todo.pop()
        if hi - lo == 1 or depth == DEPTH:
            out.append(pd.DataFrame({"_source": quotas["_source"].to_numpy(), "_lo": lo, "_hi": hi, "_quota": own}))
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([_SEED, lo, hi])
        left = _drawn(rng, own, int(own.sum()) * (mid - lo) // (hi - lo))
        todo += [(lo, mid, left, depth + 1), (mid, hi, own - left, depth + 1)]
    return pd.concat(out, ignore_index=True)


def _permuted(at: Column, size: Column, turn: Column) -> Column:
    """The place of ``at`` in a permutation of 0..size-1 (an affine one: its factor, a prime above any
    size in use, has no common divisor with the size)."""
    prime = 2_147_483_647
    return F.pmod(F.pmod(at, size) * F.pmod(F.lit(prime), size) + F.pmod(F.xxhash64(turn, F.lit(_SEED)), size), size)


class Mix:
    """A planned mix: ``docs`` (all rows, with their source, size and block), ``sources`` and ``draws``."""

    def __init__(self, docs: DataFrame, sources: DataFrame, chosen: DataFrame, draws: DataFrame, shards: int):
        self.docs, self.sources, self.chosen, self.draws, self.shards = docs, sources, chosen, draws, shards

    def _marked(self) -> DataFrame:
        """Documents with their source's plan and whether the rest of the target takes them."""
        plan = self.sources.select(F.col("_source").alias("_s"), "source_size", "target", "_passes", "_upto")
        picked = self.chosen.select(F.col("_source").alias("_c"), F.col("_key").alias("_k")).distinct().withColumn("_hit", F.lit(True))
        docs = self.docs.join(plan, F.col("_source").eqNullSafe(F.col("_s")), "left")
        docs = docs.join(picked, F.col("_source").eqNullSafe(F.col("_c")) & (F.col("_key") == F.col("_k")), "left")
        return docs.withColumn("_rest", (F.col("_size") > 0) & ((F.col("_block") < F.col("_upto")) | F.coalesce(F.col("_hit"), F.lit(False))))

    def taken(self) -> DataFrame:
        """Every document once, with the words the mix takes of it (repeats counted): its drawn blocks."""
        drawn = (self.draws.groupBy(F.col("_source").alias("_ds"), F.col("_block").alias("_db"))
                 .agg(F.sum(F.when(F.col("_part"), 0).otherwise(1)).alias("_whole"), F.max("_part").alias("_parts")))
        docs = self._marked().join(drawn, F.col("_source").eqNullSafe(F.col("_ds")) & (F.col("_block") == F.col("_db")), "left")
        times = F.coalesce("_whole", F.lit(0)) + F.when(F.coalesce("_parts", F.lit(False)) & F.col("_rest"), 1).otherwise(0)
        return docs.withColumn("taken", F.col("_size") * times)

    def rows(self) -> DataFrame:
        """The mix: every drawn document, once for each draw, with its shard (``_shard``) and its place in the
        shard's local shuffle (``_place``)."""
        draws = self.draws.select(F.col("_source").alias("_ds"), F.col("_block").alias("_db"), "_part", "_pass", "_shard")
        docs = self._marked().join(draws, F.col("_source").eqNullSafe(F.col("_ds")) & (F.col("_block") == F.col("_db")))
        docs = docs.filter((F.col("_size") > 0) & (~F.col("_part") | F.col("_rest")))
        return docs.withColumn("_place", F.xxhash64("_key", "_pass", F.lit(_SEED)))

    def shuffled(self) -> DataFrame:
        """The mix with each shard's rows together, in the order of its local shuffle."""
        return self.rows().repartition(max(1, self.shards), "_shard").sortWithinPartitions("_shard", "_place")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5,
         max_repeats: float = 2.0, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS,
         shard_words: int = SHARD_WORDS, keep: tuple[str, ...] = ()) -> Mix:
    """Plan the mix; ``keep`` names columns that the planned documents carry on (ids for a report, all for a corpus)."""
    key = F.xxhash64(F.lit(_SEED), F.col(id_col), F.col(source_col), F.col(text_col))
    carried = F.struct(*[F.col(f"`{c}`") for c in keep])  # one column, so that no name clashes
    whole = docs.select(carried.alias("_doc"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"), key.alias("_key"))
    narrow = text_col not in keep
    base = freeze(whole if narrow else whole.select("_source", "_size", "_key"))  # read by every step
    sizes = base.select("_source", "_size")
    sources = freeze(targets(sizes, share, max_repeats, weights)
                     .withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")))
    blocks = sources.select(F.col("_source").alias("_bs"), "_blocks")

    def in_blocks(rows: DataFrame) -> DataFrame:
        return (rows.join(blocks, F.col("_source").eqNullSafe(F.col("_bs")), "left").drop("_bs")
                .withColumn("_block", F.pmod(F.col("_key"), F.col("_blocks"))))

    base = in_blocks(base)
    # words by block, and their running sums in two steps of bounded windows
    words = freeze(base.groupBy("_source", "_block").agg(F.sum("_size").alias("_words")))
    groups = words.groupBy("_source", F.floor(F.col("_block") / _GROUP).alias("_group")).agg(F.sum("_words").alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("_passes", passes).withColumn("_over", F.col("target") - F.col("_passes") * F.col("source_size"))
    over = sources.select(F.col("_source").alias("_os"), "_over")
    edge = (groups.join(over, F.col("_source").eqNullSafe(F.col("_os")))
            .filter((F.col("_before") <= F.col("_over")) & (F.col("_before") + F.col("_sum") > F.col("_over")))
            .select("_os", F.col("_group").alias("_edge"), "_before", "_over"))
    inner = (words.join(edge, F.col("_source").eqNullSafe(F.col("_os")) & (F.floor(F.col("_block") / _GROUP) == F.col("_edge"))))
    run = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.withColumn("_done", F.col("_before") + F.coalesce(F.sum("_words").over(run), F.lit(0)))
    last = (inner.filter((F.col("_done") <= F.col("_over")) & (F.col("_done") + F.col("_words") > F.col("_over")))
            .select(F.col("_source").alias("_ls"), F.col("_block").alias("_upto"), (F.col("_over") - F.col("_done")).alias("_left")))
    sources = freeze(sources.join(last, F.col("_source").eqNullSafe(F.col("_ls")), "left").drop("_ls")
                     .withColumn("_upto", F.coalesce("_upto", F.lit(0).cast("long"))))
    chosen, ends = _filled(base, sources, block_words)
    # exact quotas: whole passes over all blocks, and the last pass's blocks
    sources = freeze(sources.join(ends, F.col("_source").eqNullSafe(F.col("_ls")), "left").drop("_ls"))
    part = F.coalesce("_end", "_upto")
    quota = F.col("_passes") * F.col("_blocks") + part
    sources = sources.withColumn("_quota", F.when(F.col("source_size") > 0, quota).otherwise(0))
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, math.ceil(total / shard_words))
    tree = sources.select("_source", F.lit(0).alias("_lo"), F.lit(shards).alias("_hi"), "_quota")
    for _ in range(max(1, math.ceil(math.log2(shards) / DEPTH))):
        tree = tree.groupBy("_lo", "_hi").applyInPandas(_split, "_source string, _lo int, _hi int, _quota long")
    ends = F.sum("_quota").over(Window.partitionBy("_source").orderBy("_lo"))
    leaves = tree.select("_source", F.col("_lo").alias("_shard"), "_quota", ends.alias("_end")).filter("_quota > 0")
    units = leaves.select("_source", "_shard", F.explode(F.sequence(F.col("_end") - F.col("_quota"), F.col("_end") - 1)).alias("_unit"))
    sized = sources.select(F.col("_source").alias("_us"), "_blocks", "_passes", "_quota", "_upto")
    units = units.join(sized, F.col("_source").eqNullSafe(F.col("_us")))
    turn = F.floor(F.col("_unit") / F.col("_blocks"))
    full = turn < F.col("_passes")
    span = F.when(full, F.col("_blocks")).otherwise(F.col("_quota") - F.col("_passes") * F.col("_blocks"))
    draws = freeze(units.select("_source", "_shard", turn.alias("_pass"), (~full).alias("_part"),
                                _permuted(F.col("_unit") - turn * F.col("_blocks"), span, turn).alias("_block")))
    return Mix(base if narrow else in_blocks(whole), sources, chosen, draws, shards)


def report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """For each document its size, its source's size and target, and the words the mix takes of it."""
    mixed = plan(docs, id_col=id_col, keep=(id_col,), **options).taken()
    return mixed.select(F.col(f"_doc.`{id_col}`"), F.col("_size").alias("size"), "source_size", F.col("target").cast("double").alias("target"), "taken")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: rows of ``docs`` (all columns), repeated as drawn, shard by shard in shuffled order."""
    names = tuple(docs.columns)
    return plan(docs, keep=names, **options).shuffled().select(*[F.col(f"_doc.`{n}`") for n in names])
