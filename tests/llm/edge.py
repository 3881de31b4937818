"""A small table with every awkward case: nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
import random

CLASHING = ["_row", "_text", "_size", "_key", "_block", "_doc", "_id", "_n", "_stats", "ids", "decoded", "score", "lang_pred",
            "kept", "spans", "base", "marks", "taken", "n_bytes", "candidates", "_source"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(n))


def rows():
    long = words(1, 30_000)
    texts = [(1, words(2, 60), "en", "a"), (2, words(2, 60) + " more", "en", "b"), (3, None, "de", "a"), (4, "", None, None),
             (5, "  \n\t ", "de", "b"), (6, long, "en", "a"), (7, words(3, 3), "fr", "b"), (8, words(3, 3), "fr", "b"),
             (9, words(4, 80), "de", None), (9, words(4, 80), "de", None), (None, words(5, 50), "fr", "a"),
             (None, None, None, None), (12, "é" * 300 + " 😀 " + words(6, 40), "fr", "a"), (13, "!!! ??? 123", "en", "b")]
    return [(i, t, la, so, len(t) if t else None, *["x"] * len(CLASHING)) for i, t, la, so in texts]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
