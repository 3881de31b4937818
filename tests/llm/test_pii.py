import hashlib
import random
import re

from edge import empty, rows, table
from pyspark.sql import functions as F

from clientele.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [d * 2 - 9 * (d > 4) if k % 2 else d for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def check(df, texts):
    got = pii.report(df).collect()
    assert len(got) == len(texts)
    for r in got:
        if r["doc_id"] is None:
            continue
        want = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (r, want)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k + ":") for w in want) for k in PATTERNS]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(want) <= set(spans)
        order = [(pii.ALL_KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order) and r["n_spans"] == len(spans)


def test_base_spans_equal_plain_patterns(spark):
    texts = ["a@b.c_x@d.e a@b@c.de x.y%z@q-r.s.t. @a.b a@b", "1.2.3.4.5.6.7.8 001.002.3.0255 256.1.1.1 1.1.1.1 0000.00.0.0",
             "4111 1111 1111 1111 4111-1111-1111-1111-5 4111111111111111  1 4111111111111111", "+1 (017) 555-7713 +49 30 1234567890123456 +1((( +12",
             "é" * 5 + " 😀 a@b.cd +1 234 567 890", "9" * 3000 + " " + "1 " * 3000, "x" * 50_000 + "@" + "y" * 10 + ".z", "a." * 20_000, "1." * 5000]
    rng = random.Random(8)
    texts += ["".join(rng.choice("0123456789.@ab -+()%é😀 1") for _ in range(rng.randrange(1, 80))) for _ in range(200)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), dict(enumerate(texts)))


def mixed(n):
    """Texts with base values, proposals of right and wrong reading, and the right added ones by id."""
    rng = random.Random(9)
    docs, want = [], {}
    for k in range(n):
        four, token = rng.randrange(1000, 9999), "".join(rng.choice("0123456789abcdef") for _ in range(40))
        kinds = [f"call +1 (212) 555-{four} or mail ab{k}@x.org now", f"reach us at (212) 555-{four} today", f"write to jo{k} (at) host{k} (dot) org please",
                 f'token = "{token}" end', f"order 2{four}-{four} code 12.{four}.1.1 ref {four}{four}{four}{four}", f"part 300 555 {four} of the list",
                 "Rindfleischetikettierungsueberwachung " * 2]
        docs.append((k, kinds[k % len(kinds)]))
        want[k] = {1: "phone", 2: "email", 3: "secret"}.get(k % len(kinds))
    return docs, want


def test_trees_add_spans_by_value_and_context(spark):
    docs, want = mixed(700)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(df, dict(docs))
    out = {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in pii.report(df).collect()}
    for k, text in docs:
        more = [s.split(":")[0] for s in out[k] if s not in base(text)]
        assert more == ([want[k]] if want[k] else []), (text, out[k])
    assert "source" not in pii.FEATURES


def test_many_matches_in_one_text(spark):
    """Work grows in step with the matches: 30,000 addresses and phones in one text."""
    text = " ".join(f"m{i}@ex.org (212) 555-{i % 9000 + 1000}" for i in range(15_000))
    df = spark.createDataFrame([(1, text), (2, "é" * 999 + "a@b.cd" + "é" * 2000 + "x@y.zz")], "doc_id long, text string")
    check(df, {1: text, 2: "é" * 999 + "a@b.cd" + "é" * 2000 + "x@y.zz"})
    got = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert got[2] == "é" * 999 + "<EMAIL>" + "é" * 2000 + "<EMAIL>"
    assert got[1] == " ".join(["<EMAIL> <PHONE>"] * 15_000)


def test_overlapping_spans_become_one_region(spark):
    text = "+1 4111 1111 1111 1111 and a1.2.3.4@b.co"
    got = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["text"]
    marks = [False] * len(text)
    for s in base(text):
        _, lo, hi = s.split(":")
        marks[int(lo):int(hi)] = [True] * (int(hi) - int(lo))
    assert re.sub("<[A-Z]+>", "#", got) == re.sub("\0+", "#", "".join("\0" if m else c for m, c in zip(marks, text)))


def test_redaction_and_edge_table(spark):
    df = spark.createDataFrame([(1, "a@b.co and +1 212 555 1234.", "q"), (2, None, None), (3, "plain", "q"), (3, "plain", "q")], "doc_id long, text string, _doc string")
    got = sorted(map(tuple, pii.redact(df).collect()))
    assert got == [(1, "<EMAIL> and <PHONE>.", "q"), (2, None, None), (3, "plain", "q"), (3, "plain", "q")]
    assert pii.redact(table(spark)).columns == table(spark).columns and pii.redact(table(spark)).count() == len(rows())
    check(table(spark), _all(rows()))
    assert pii.report(empty(spark)).collect() == [] and pii.redact(empty(spark)).collect() == []


def _all(edge_rows):
    """Texts by id, padded to the number of rows (repeated and null ids)."""
    out = {r[0]: r[1] for r in edge_rows if r[0] is not None}
    return out | {f"pad{k}": None for k in range(len(edge_rows) - len(out))}


def test_main_path_is_native(spark):
    plan = pii.detect(table(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_numbers_written_digit_by_digit(spark):
    """Cards and dotted quads without two adjacent digits, in texts that hold no other number."""
    card = "4111111111111111"
    texts = [" ".join(card), "-".join(card), "pay " + " ".join(card) + " now", "é " + " ".join(card[:8]) + "-" + "-".join(card[8:]),
             " ".join("4111111111111112"), "1.1.1.1", "1 . 2", "+1 2 3 4 5 6 7 8 9"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), dict(enumerate(texts)))
    assert sum(len(base(t)) for t in texts[:4]) == 4
    got = pii.redact(spark.createDataFrame([(1, "pay " + " ".join(card) + " now")], "doc_id long, text string")).collect()
    assert [r["text"] for r in got] == ["pay <CARD> now"]
    quad = pii.detect(spark.createDataFrame([("at 1 . 2 . 3 . 4 we",)], "text string")).collect()
    assert [(c["start"], c["end"]) for c in quad[0]["candidates"]] == [(3, 16)]
