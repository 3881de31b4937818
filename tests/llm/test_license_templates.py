import random
import re

from edge import empty, rows, table

from clientele.llm import license_templates as lt

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def plain(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if tuple(words[k:k + len(p)]) == p]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def check(df, texts):
    got = lt.scan(df).collect()
    assert len(got) == len(texts)
    want = sorted((plain(t) for t in texts), key=str)
    assert sorted(((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=str) == want
    return got


def test_places_equal_plain_search(spark):
    rng = random.Random(4)
    vocabulary = ["MIT", "license", "License", "apache", "general", "public", "é", "über", "x-y", "12", ",", "\n", "mit-license", "GNU"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), texts)


def test_templates(spark):
    cases = {"This work is licensed under the GNU General Public License, version 3.": "gpl,template-gpl",
             "Licensed under the Apache License, Version 2.0.": "apache,template-apache-2.0",
             "Licensed under the Apache License, Version 1.1.": "apache",
             "Licensed under CC BY-NC 4.0.": "template-cc-by-nc-4.0", "licensed under a Creative Commons CC BY-NC 4.0 International": "template-cc-by-nc-4.0",
             "Released under the terms of the MIT License": "mit,template-mit", "Released under a MIT License": "mit", "no licence": ""}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lt.scan(df).collect()}
    for k, want in enumerate(cases.values()):
        assert got[k]["labels"] == want
        assert got[k]["score"] == (1.0 if "template" in want else 0.5 if want else 0.0)


def test_automaton_equals_pattern():
    """Token automata against regular expressions over the words."""
    template = "a <<beginOptional>>b <<var;name=x;match=1-2>><<endOptional>> c <<var;name=y;match=0-1>> d"
    pattern = re.compile(r"(?:^| )a (?:b (?:\S+ ){1,2})?c (?:\S+ )?d(?= |$)")
    automaton = lt.TokenAutomaton(template)
    rng = random.Random(5)
    for _ in range(2000):
        words = [rng.choice("abcd") for _ in range(rng.randrange(0, 10))]
        assert automaton.accepts([w.encode() for w in words]) == bool(pattern.search(" ".join(words)))


def test_edge_table(spark):
    check(table(spark), [r[1] for r in rows()])
    assert lt.scan(empty(spark)).collect() == []
