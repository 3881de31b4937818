"""Language identification with language-bitmask n-gram filters.

Training counts the byte 5-grams of each language (ASCII lower-cased, other ASCII signs as spaces)
and keeps for each n-gram the set of languages in which it is typical: its share of that language's
n-grams is at least half of its largest share in any language.  The sets go into a bit-sliced Bloom
filter: a table of language bitmasks, in which an n-gram sets its languages' bits at three places; the
AND of the three places returns all languages that hold an n-gram at once.  A text's language is the
one with the most hits, each language's count corrected for its filter's false positives.

The filter is fitted on a bounded sample of whole labelled texts (PER_LANGUAGE of each language, all
of a rarer one) and holds at most CAPACITY n-grams, the most frequent ones, so the broadcast is bounded.
Any number of languages is allowed; 64 of them share a slice.

Edge cases: a null text or one without a letter is ``und`` with score 0.0; a text whose n-grams no
language knows gets the most frequent learned language with score 1/languages; ties go to the first
language in code-point order; without training rows every text is ``und``; texts of any length are
read whole; repeated rows give the same result; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import byte_chunks, mix64, row_sums, utf8_column
from clientele.session import freeze

#: Labelled texts of each language that the filter is fitted on.
PER_LANGUAGE = 4_000
#: N-grams that the filter holds.
CAPACITY = 300_000
#: Places in the filter's table, a power of two.
PLACES = 1 << 21
GRAM = 5
MIN_COUNT = 3

_LETTER = regex.compile(r"\p{L}")
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[:0x80] = 0x20
_CLEAN[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLEAN[0x41:0x5B] = np.arange(0x61, 0x7B)


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """5-grams of each row between two spaces on either side, and the rows' bounds among them."""
    rows = len(offs) - 1
    shift = np.repeat(4 * np.arange(rows) + 2, np.diff(offs))
    padded = np.full(len(data) + 4 * rows, 0x20, dtype=np.uint8)
    padded[np.arange(len(data)) + shift] = _CLEAN[data]
    bounds = offs + 4 * np.arange(rows + 1)
    codes = np.zeros(len(padded), dtype=np.uint64)
    for k in range(GRAM):
        codes[:len(padded) - k] |= padded[k:].astype(np.uint64) << np.uint64(8 * k)
    inside = np.ones(len(padded), dtype=bool)
    for k in range(1, GRAM):
        inside[np.maximum(bounds[1:] - k, 0)] = False
    kept = np.zeros(len(padded) + 1, dtype=np.int64)
    np.cumsum(inside, out=kept[1:])
    return codes[inside], kept[bounds]


def _places(codes: np.ndarray) -> list[np.ndarray]:
    h = mix64(codes)
    mask = np.uint64(PLACES - 1)
    return [((h >> np.uint64(s)) & mask).astype(np.int64) for s in (0, 21, 42)]


class LanguageFilter:
    """Bit-sliced Bloom filter over n-grams with the languages' false-positive rates."""

    def __init__(self, languages: list[str], common: int, codes: np.ndarray, members: np.ndarray):
        """members: for each n-gram its row of language flags; common: the most frequent language."""
        self.languages, self.common = languages, common
        self.slices, self.wrong = [], []
        at = _places(codes)
        for lo in range(0, len(languages), 64):
            flags = members[:, lo:lo + 64]
            kind = next(np.dtype(f"u{b}") for b in (1, 2, 4, 8) if 8 * b >= flags.shape[1])
            masks = np.zeros(len(codes), dtype=kind)
            for k in range(flags.shape[1]):
                masks |= flags[:, k].astype(kind) << kind.type(k)
            table = np.zeros(PLACES, dtype=kind)
            for p in at:
                np.bitwise_or.at(table, p, masks)
            self.slices.append(table)
            self.wrong += [float(((table >> kind.type(k)) & kind.type(1)).mean()) ** len(at) for k in range(flags.shape[1])]

    def counts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """For each row and language the corrected number of n-grams found."""
        codes, bounds = _grams(data, offs)
        total = np.diff(bounds)
        at = _places(codes)
        out = []
        for table in self.slices:
            found = table[at[0]] & table[at[1]] & table[at[2]]
            for k in range(min(64, len(self.languages) - len(out))):
                hits = row_sums((found >> table.dtype.type(k)) & table.dtype.type(1), bounds)
                wrong = self.wrong[len(out)]
                out.append(np.maximum(0.0, hits - total * wrong) / (1.0 - min(wrong, 0.999999)))
        return np.array(out).T


def learn(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, capacity: int = CAPACITY) -> LanguageFilter | None:
    """Fit the filter on rows where ``train`` holds and the language is known; None without such rows."""
    known = docs.filter(train & F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1.0, per_language / sizes[k]) * 1_000_000))])
    sample = known.filter(F.pmod(F.xxhash64(F.col(text_col), F.lit(11)), F.lit(1_000_000)) < share[F.col(lang_col)])
    index = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([index[k] for k in batch.column(1).to_pylist()])
            for lo, hi, data, offs in byte_chunks(utf8_column(batch, text_col), 4 << 20):
                codes, bounds = _grams(data, offs)
                own = np.repeat(lang[lo:hi], np.diff(bounds)).astype(np.uint64)
                keys, n = np.unique(codes << np.uint64(16) | own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((keys >> np.uint64(16)).view(np.int64)),
                                                  pa.array((keys & np.uint64(0xFFFF)).astype(np.int32)), pa.array(n)],
                                                 names=["gram", "lang", "n"])

    counts = freeze(sample.select(text_col, lang_col).mapInArrow(count, "gram long, lang int, n long")
                    .groupBy("gram", "lang").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT))
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}
    if not totals:
        return LanguageFilter(languages, _most(languages, sizes), np.zeros(0, np.uint64), np.zeros((0, len(languages)), bool))
    total = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, float(n))])
    sets = (counts.withColumn("p", F.col("n") / total[F.col("lang")])
            .groupBy("gram").agg(F.collect_list(F.struct("lang", "p")).alias("all"), F.max("p").alias("top"))
            .select("gram", F.filter("all", lambda x: x["p"] >= F.col("top") / 2).alias("langs")))
    # every language has an equal part of the capacity for its most frequent n-grams
    order = Window.partitionBy("lang").orderBy(F.desc("p"), F.xxhash64("gram"), "gram")
    first = (sets.select("gram", F.explode("langs").alias("l")).select("gram", "l.*")
             .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max(1, capacity // len(languages))))
    kept = sets.join(first.select("gram").distinct(), "gram", "left_semi")
    rows = kept.select("gram", F.transform("langs", lambda x: x["lang"]).alias("langs")).orderBy("gram").collect()
    members = np.zeros((len(rows), len(languages)), dtype=bool)
    for i, r in enumerate(rows):
        members[i, r["langs"]] = True
    return LanguageFilter(languages, _most(languages, sizes), np.array([r["gram"] for r in rows], dtype=np.int64).view(np.uint64), members)


def _most(languages: list[str], sizes: dict[str, int]) -> int:
    return max(range(len(languages)), key=lambda i: sizes[languages[i]])


def identify(docs: DataFrame, model: LanguageFilter | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, from its whole text alone.  No shuffle."""
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = utf8_column(batch, text_col)
            for lo, hi, data, offs in byte_chunks(texts):
                own = batch.slice(lo, hi - lo)
                letters = np.array([bool(_LETTER.search(t)) for t in texts.slice(lo, hi - lo).to_pylist()])
                if model is None:
                    pred, score = ["und"] * (hi - lo), np.zeros(hi - lo)
                else:
                    counts = model.counts(data, offs)
                    best, total = counts.argmax(axis=1), counts.sum(axis=1)
                    best = np.where(total > 0, best, model.common)
                    score = np.where(total > 0, counts.max(axis=1) / np.where(total > 0, total, 1.0), 1.0 / len(model.languages))
                    pred = [model.languages[b] if ok else "und" for b, ok in zip(best, letters)]
                    score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays([*[own.column(own.schema.get_field_index(n)) for n in names],
                                                  pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 names=[*names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, f"{fields}, lang_pred string, score double")
