"""License scans by template-markup matching.

A template is wording with markup: ``<<beginOptional>> .. <<endOptional>>`` around words that may be
left out, ``<<var;name=..;match=low-high>>`` for low to high words of any kind.  Templates are compiled
into token automata; a text gets a template's label where some run of its words is accepted, that is
where the mandatory wording stands exactly.  Plain phrases (see PHRASES) are looked up beside.

Words: A-Z lower-cased, then runs of ASCII letters and digits and of all other characters from U+0080 on.

Edge cases: null is the empty text; no words, no places and no labels (score 0.0); overlapping and
repeated places all count; texts of any length are scanned whole; repeated rows give the same result;
other columns are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import LOWER, byte_chunks, per_row, prefix_sums, span_hashes, spans, utf8_column

# fixed values: phrases and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: templates and their labels
TEMPLATES = {
    "template-apache-2.0": "<<beginOptional>>this <<var;name=work;match=1-3>> is<<endOptional>> licensed under the "
                           "Apache License, Version 2.0",
    "template-bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "template-cc-by-nc-4.0": "licensed under <<beginOptional>>a <<var;name=form;match=0-2>><<endOptional>> CC BY-NC 4.0 "
                             "<<beginOptional>>International<<endOptional>>",
    "template-gpl": "<<beginOptional>>this <<var;name=work;match=1-3>> is<<endOptional>> licensed under the GNU General "
                    "Public License, version <<var;name=number;match=1-1>>",
    "template-mit": "released under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "template-mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                          "<<var;name=thing;match=1-2>> and associated documentation files",
}

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").lower())


class TokenAutomaton:
    """Nondeterministic automaton over words: edges read one word (None: any), jumps read nothing."""

    def __init__(self, template: str):
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.jumps: list[list[int]] = [[]]
        mandatory, opened, at, depth = [], [], 0, 0
        for k, part in enumerate(_MARK.split(template)):
            if k % 2 == 0:
                for word in words_of(part):
                    if not depth:
                        mandatory.append(word)
                    at = self._read(at, word)
            elif part == "beginOptional":
                opened.append(at)
                depth += 1
            elif part == "endOptional":
                self.jumps[opened.pop()].append(at)
                depth -= 1
            else:
                low, high = map(int, re.search(r"match=(\d+)-(\d+)", part).groups())
                for _ in range(low):
                    at = self._read(at, None)
                first = at
                skips = [first]
                for _ in range(high - low):
                    at = self._read(at, None)
                    skips.append(at)
                for state in skips[:-1]:
                    self.jumps[state].append(at)
        self.final = at
        self.anchor = max(mandatory, key=len)  # a word that no accepted text lacks

    def _read(self, at: int, word: bytes | None) -> int:
        self.edges.append([])
        self.jumps.append([])
        self.edges[at].append((word, len(self.edges) - 1))
        return len(self.edges) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for to in self.jumps[todo.pop()]:
                if to not in out:
                    out.add(to)
                    todo.append(to)
        return out

    def accepts(self, words: list[bytes]) -> bool:
        """Does some run of the words match the template?"""
        begin = self._closed({0})
        states: set[int] = set()
        for word in words:
            states = self._closed({to for s in states | begin for own, to in self.edges[s] if own is None or own == word})
            if self.final in states:
                return True
        return False


def _hash(word: bytes) -> int:
    data = np.frombuffer(word, dtype=np.uint8)
    return int(span_hashes(prefix_sums(data), np.array([0]), np.array([len(data)]))[0])


_RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
         templates: dict[str, str] | None = None) -> DataFrame:
    """Phrase places, and labels of phrases and of accepted templates, of every whole text.

    Score: 1.0 where a template's mandatory wording matches, 0.5 for phrases alone, else 0.0.  No shuffle."""
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = {p: np.array([_hash(w) for w in words_of(p)], dtype=np.uint64) for p in phrases}
        automata = {label: TokenAutomaton(t) for label, t in templates.items()}
        anchors = {label: np.uint64(_hash(a.anchor)) for label, a in automata.items()}
        for batch in batches:
            texts = utf8_column(batch, text_col)
            for lo, hi, data, offs in byte_chunks(texts):
                low = LOWER[data]
                starts, ends = spans(_WORD_BYTE[low], offs)
                words = span_hashes(prefix_sums(low), starts, ends)
                first = per_row(starts, offs)
                row_of = np.repeat(np.arange(hi - lo), np.diff(first))
                n = hi - lo
                places = [[] for _ in range(n)]
                base = [set() for _ in range(n)]
                more = [set() for _ in range(n)]
                for phrase, key in keys.items():
                    size = len(key)
                    # the last word is the rarest of these phrases' words in most texts
                    at = np.flatnonzero(words[size - 1:] == key[-1])
                    for k in range(size - 1):
                        at = at[words[at + k] == key[k]]
                    at = at[row_of[at] == row_of[at + size - 1]] if len(at) else at
                    for p, r in zip(at.tolist(), row_of[at].tolist()):
                        places[r].append(p - int(first[r]))
                        base[r].add(phrases[phrase])
                for label, automaton in automata.items():
                    for r in np.unique(row_of[words == anchors[label]]).tolist():
                        own = slice(int(first[r]), int(first[r + 1]))
                        if automaton.accepts([low[s:e].tobytes() for s, e in zip(starts[own], ends[own])]):
                            more[r].add(label)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array([len(p) for p in places], pa.int64()),
                    pa.array([min(p) if p else None for p in places], pa.int64()),
                    pa.array([max(p) if p else None for p in places], pa.int64()),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()),
                    pa.array([",".join(sorted(b | m)) for b, m in zip(base, more)], pa.string()),
                    pa.array([1.0 if m else 0.5 if b else 0.0 for b, m in zip(base, more)], pa.float64()),
                ], names=[id_col, *[f.split()[0] for f in _RESULT.split(", ")]])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, {_RESULT}")
