import random

import numpy as np
from edge import empty, rows, table
from pyspark.sql import functions as F

from clientele.llm import language_id

SYLLABLES = {"en": ["the", "ing", "and", "tion", "er"], "de": ["sch", "ung", "ein", "ich", "der"], "fr": ["eau", "ou", "ai", "que", "les"]}


def text(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_held_out_accuracy(spark):
    docs = [(k, text(lang, k), lang) for k in range(300) for lang in [list(SYLLABLES)[k % 3]]]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    model = language_id.learn(df, F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r for r in language_id.identify(df.drop("lang"), model).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in docs if i % 5 == 0]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_filter_returns_all_languages_of_a_gram(monkeypatch):
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 40, 3000, dtype=np.uint64))
    members = rng.random((len(codes), 70)) < 0.1  # more languages than one slice holds
    model = language_id.LanguageFilter([f"l{k:02d}" for k in range(70)], 0, codes, members)
    at = language_id._places(codes)
    for s, lo in enumerate(range(0, 70, 64)):
        found = model.slices[s][at[0]] & model.slices[s][at[1]] & model.slices[s][at[2]]
        for k in range(min(64, 70 - lo)):
            bit = (found >> model.slices[s].dtype.type(k)) & model.slices[s].dtype.type(1)
            assert (bit >= members[:, lo + k]).all()  # no false negatives
            assert bit[~members[:, lo + k]].mean() < 0.02


def test_grams_stay_within_rows():
    data = np.frombuffer(b"abcDEFg", dtype=np.uint8)
    codes, bounds = language_id._grams(data, np.array([0, 3, 3, 7]))
    shown = [int(c).to_bytes(8, "little")[:5] for c in codes]
    assert shown[:bounds[1]] == [b"  abc", b" abc ", b"abc  "]
    assert bounds[2] == bounds[1] and shown[bounds[2]:] == [b"  def", b" defg", b"defg ", b"efg  "]


def test_edge_table(spark):
    model = language_id.learn(table(spark), F.lit(True))
    got = language_id.identify(table(spark), model)
    assert got.columns[-2:] == ["lang_pred", "score"] and got.count() == len(rows())
    for r in got.collect():
        blank = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == blank and 0 <= r["score"] <= 1
    assert language_id.learn(empty(spark), F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.identify(table(spark), None).collect()} == {"und"}
    assert language_id.identify(empty(spark), model).collect() == []


def test_rare_language_keeps_its_texts_at_small_capacity(spark):
    rng = random.Random(12)

    def vocabulary(letters, n):
        return ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(n)]

    big, rare = vocabulary("abcdefghijklmno", 3000), vocabulary("abcdefghijklmno", 150)
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, text(big), "big") for i in range(1500)] + [(5000 + i, text(rare), "rare") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs, F.lit(True), capacity=1500)
    new = spark.createDataFrame([(i, text(rare), "rare") for i in range(8)] + [(9, text(big), "big")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.identify(new, model).orderBy("doc_id").collect()] == ["rare"] * 8 + ["big"]
