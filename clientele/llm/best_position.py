"""Ranked lexical search by the Best Position Algorithm.

Documents stay where they are: each task reads its documents in chunks of about POSTINGS postings of query
terms and builds, for every term, an impact list (a chunk's documents by falling impact, then by row) with
direct access from a document to its places in all lists.  A query reads its terms' lists side by side.  Each
document met is scored whole by direct accesses, which also mark its places in the other lists as seen; a
list's best position is the end of the unbroken run of seen places from its head.  No document that is still
unseen can score more than the sum of the impacts right after the best positions, and the search of a chunk
stops when that sum is strictly below the k-th score (an equal score might belong to a smaller id).  The k-th
score carries over from chunk to chunk.  A task gives out its ``k`` best documents of each query; a
window over (query) keeps the ``k`` best of those.

Two passes.  The first reads the texts once and writes, for each document, its number of terms and the hashes
and counts of the query terms in it; counts of documents and terms, and each query term's documents, are sums
over all of that.  The second reads those numbers.  Queries come in blocks of about TERMS distinct terms, which
are shipped to the tasks; a larger query set makes further blocks, each against all documents.

Terms are compared by 64-bit hashes; two terms of one hash would count as one (chance about 1e-9 for 10**5
query terms and 10**5 distinct words).

Edge cases: a null text or one without terms is no document of the counts and is never returned; an item
without terms, or whose terms stand nowhere, returns nothing; a term that repeats in an item counts once; rows
that share a document id rank one by one, equal rows in any order; null ids rank after all others at equal
scores; rows that share an item id are items of their own (equal rows count once); texts of any length are read
whole; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import LOWER, byte_chunks, prefix_sums, span_hashes, spans, utf8_column
from clientele.session import freeze, release

#: Postings of a chunk, and distinct terms of a block of queries.
POSTINGS = 1 << 20
TERMS = 200_000
#: Places of a list read between two looks at the threshold; doubles up to the greatest.
DEPTH, GREATEST_DEPTH = 64, 4096
NO_ID = (1 << 63) - 1

_TERM = np.ones(256, bool)  # letters, digits and every byte of a character beyond ASCII
_TERM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False

_COUNTED = "doc_id long, n long, terms array<long>, counts array<long>"


def term_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the rows at ``offs``, and the row of each."""
    starts, ends = spans(_TERM[data], offs)
    return span_hashes(prefix_sums(LOWER[data]), starts, ends).view(np.int64), np.searchsorted(offs, starts, side="right") - 1


def _counted(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each document's number of terms, and its terms among ``wanted`` (sorted) with their counts."""
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offs in byte_chunks(utf8_column(batch, "text")):
            hashes, row = term_hashes(data, offs)
            n = np.bincount(row, minlength=hi - lo)
            at = np.searchsorted(wanted, hashes)
            hit = wanted[np.minimum(at, len(wanted) - 1)] == hashes if len(wanted) else np.zeros(len(hashes), bool)
            pairs, counts = np.unique(row[hit] * len(wanted) + at[hit], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(1, hi - lo + 1) * len(wanted))
            bounds = pa.array(np.append(0, ends).astype(np.int32))
            terms = wanted[pairs % max(1, len(wanted))]
            out = pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(terms, pa.int64())),
                 pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])
            yield out.filter(pa.array(n > 0))


class Chunk:
    """Impact lists of a chunk of documents, and direct access from its documents to their places in them.

    ``rows`` (sorted), ``terms`` (numbers below ``n_terms``) and ``impacts`` are its postings."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.ids, self.terms, self.impacts = ids, terms, impacts
        order = np.lexsort((rows, -impacts, terms))
        self.rows_by_list, self.impacts_by_list = rows[order], impacts[order]
        self.heads = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.first = np.searchsorted(rows, np.arange(len(ids) + 1))  # a document's postings
        self.place = np.empty(len(order), np.int64)  # a posting's place among all lists
        self.place[order] = np.arange(len(order))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all [start, end), one after another."""
    sizes = ends - starts
    return np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())


def best_positions(chunk: Chunk, query: np.ndarray, member: np.ndarray, k: int, kth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the chunk's documents met by ``query`` (term numbers, marked in ``member``) before no
    unseen one can reach ``kth`` (a score that ``k`` documents elsewhere reach already) or the k-th found."""
    query = query[chunk.heads[query] < chunk.heads[query + 1]]
    heads, ends = chunk.heads[query], chunk.heads[query + 1]
    base = np.append(0, np.cumsum(ends - heads))  # where a list's marks begin
    seen = np.zeros(base[-1], bool)
    list_of = np.full(len(member), -1)
    list_of[query] = np.arange(len(query))
    read, best = heads.copy(), heads.copy()
    met = np.zeros(len(chunk.ids), bool)
    found_rows, found_scores, depth = [], [], DEPTH
    found = 0
    while len(heads):
        upto = np.minimum(np.maximum(read, best) + depth, ends)
        new = chunk.rows_by_list[_ranges(read, upto)]
        read, depth = upto, min(2 * depth, GREATEST_DEPTH)
        new = np.unique(new[~met[new]])
        if len(new):
            met[new] = True
            postings = _ranges(chunk.first[new], chunk.first[new + 1])
            owner = np.repeat(np.arange(len(new)), chunk.first[new + 1] - chunk.first[new])
            mine = member[chunk.terms[postings]]
            postings, owner = postings[mine], owner[mine]
            scores = np.zeros(len(new), np.int64)
            np.add.at(scores, owner, chunk.impacts[postings])
            which = list_of[chunk.terms[postings]]
            seen[base[which] + chunk.place[postings] - heads[which]] = True
            found_rows.append(new)
            found_scores.append(scores)
            found += len(new)
            if found >= k:
                every = np.concatenate(found_scores)
                kth = max(kth, int(np.partition(every, len(every) - k)[len(every) - k]))
        bound = 0
        for i in range(len(heads)):
            run = seen[base[i] + best[i] - heads[i]:base[i + 1]]
            gap = int(run.argmin()) if len(run) else 0
            best[i] = ends[i] if len(run) == 0 or run[gap] else best[i] + gap
            if best[i] < ends[i]:
                bound += int(chunk.impacts_by_list[best[i]])
        if bound < kth or (best == ends).all():
            break
    if not found_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_rows), np.concatenate(found_scores)


def _search(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, weight: np.ndarray, queries: list[tuple[int, np.ndarray]],
            n_docs: int, n_words: int, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best documents of the partition for each query."""
    numbers = [np.searchsorted(wanted, hashes) for _, hashes in queries]
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]  # scores, ids

    def searched(held: list[pa.RecordBatch]) -> None:
        t = pa.Table.from_batches(held).combine_chunks()
        counts, terms = t.column("counts").combine_chunks(), t.column("terms").combine_chunks()
        sizes = np.diff(terms.offsets.to_numpy())
        rows = np.repeat(np.arange(len(sizes)), sizes)
        tf, term = counts.flatten().to_numpy().astype(np.int64), np.searchsorted(wanted, terms.flatten().to_numpy())
        n = t.column("n").to_numpy().astype(np.int64)
        m = 100 - 50 + (50 * n * n_docs) // n_words
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[rows]))
        ids = t.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy()
        chunk = Chunk(ids, rows, term, impact, len(wanted))
        member = np.zeros(len(wanted), bool)
        for q, number in enumerate(numbers):
            member[number] = True
            held_scores, held_ids = best[q]
            kth = int(held_scores[-1]) if len(held_scores) >= k else 1
            at, scores = best_positions(chunk, number, member, k, kth)
            member[number] = False
            keep = scores >= kth
            scores, these = np.append(held_scores, scores[keep]), np.append(held_ids, ids[at[keep]])
            order = np.lexsort((these, -scores))[:k]
            best[q] = scores[order], these[order]

    held, postings = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(batch.column("terms").offsets.to_numpy())
        lo, total = 0, np.append(0, np.cumsum(sizes))
        while lo < batch.num_rows:  # cut where the chunk is full
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + POSTINGS - postings, side="right")) - 1)
            held.append(batch.slice(lo, hi - lo))
            postings += int(total[hi] - total[lo])
            lo = hi
            if postings >= POSTINGS:
                searched(held)
                held, postings = [], 0
    if held:
        searched(held)
    for (item, _), (scores, ids) in zip(queries, best):
        if len(scores):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), item), pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                                             names=["item", "doc_id", "score"])


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct term hashes of each item."""
    for batch in batches:
        rows = [np.unique(term_hashes(data, offs - offs[0])[0]).tolist() for i in range(batch.num_rows)
                for _, _, data, offs in byte_chunks(utf8_column(batch.slice(i, 1), "text"))]
        yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id").cast(pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                                         names=["item", "item_id", "terms"])


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents (``doc_id``, ``text``) of every item (``item_id``, ``text``): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id())
    asked = freeze(asked.select("item", "item_id", "text").mapInArrow(_item_terms, "item long, item_id long, terms array<long>"))
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-size // TERMS)
    out = None
    for b in range(n_blocks):
        mine = asked.filter((F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b) & (F.size("terms") > 0))
        found = _ranked_block(docs, mine, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    best = freeze(out.withColumn("rank", place).filter(F.col("rank") <= k))
    return (best.join(asked.select("item", "item_id"), "item")
            .select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))


def _ranked_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item of a block (about TERMS terms in all)."""
    queries = [(r["item"], np.array(r["terms"], np.int64)) for r in items.select("item", "terms").collect()]
    wanted = np.unique(np.concatenate([h for _, h in queries])) if queries else np.zeros(0, np.int64)
    counted = freeze(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: _counted(it, wanted), _COUNTED))
    n_docs, n_words = counted.agg(F.count("*"), F.sum("n")).first()
    found_in = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most TERMS rows
    weight = np.array([term_weight(n_docs, found_in[t]) if t in found_in else 0 for t in wanted.tolist()], np.int64)
    hits = counted.filter(F.size("terms") > 0)
    found = freeze(hits.mapInArrow(lambda it: _search(it, wanted, weight, queries, n_docs, n_words or 1, k), "item long, doc_id long, score long"))
    release(counted)
    return found
