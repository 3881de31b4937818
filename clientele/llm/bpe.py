"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a word BPE leaves exactly one last token.  An automaton over the
vocabulary, whose links run along suffixes, lists the tokens that end at a position; the one that fits is the one whose pair with the last token of the shorter prefix
survives BPE as it is.  The pair test undoes the two tokens' merges, latest first, and looks
whether an earlier merge would have joined across the border.  Back-pointers from the end
give the ids.

Edge cases: null and empty texts give no ids and an empty decoded text; the literal special
tokens of the vocabulary file are single ids, as the library has it; texts of any length are
encoded whole, chunk by chunk between white space; repeated rows are encoded alike; the other
columns pass through unchanged, and an input column called like an output column is replaced.
"""

from __future__ import annotations

import gc
import gzip
import io
import json
import pickle
import re
import unicodedata
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import mix64

#: Bytes of chunks from which one of the two generations of a worker's cache is full, and of an entry beside its texts.
CACHE_BYTES = 12 << 20
ENTRY_BYTES = 280
#: Bytes of words of one length that are read together.
GROUP_BYTES = 1 << 20
#: Bits of the table of pair tests.
FIT_BITS = 19

_LOADED: dict[str, Tokenizer] = {}
_PACKED: dict[str, Packed] = {}
_OF_PROCESS = ("pieces", "split_special", "fit_key", "fit", "young", "old", "young_bytes")
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_SPACES = regex.compile(r"[\s--[\x1c-\x1f]]+", flags=regex.V1)


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for the letters from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class SuffixLinks:
    """Automaton over the vocabulary's byte strings: after each byte of a word, the tokens that end there.

    ``step[step_row[state], byte]`` reads a byte within a word and ``stop[stop_row[state], byte]`` its last byte
    (the tokens that end words are apart).  ``first[state]`` is the longest token that ends in a state and
    ``shorter`` the next one, along suffix links.  A state that nothing continues shares the row of its suffix
    link, so a table has a row for each inner node only.  Rows are NumPy tables of the smallest number type, so
    that many words of one length are read together."""

    def __init__(self, inner: dict[bytes, int], final: dict[bytes, int]):
        kids: list[dict[int, int]] = [{}]
        token = [-1]
        depth = [0]

        def node(path: bytes) -> int:
            at = 0
            for byte in path:
                if byte not in kids[at]:
                    kids[at][byte] = len(kids)
                    kids.append({})
                    token.append(-1)
                    depth.append(depth[at] + 1)
                at = kids[at][byte]
            return at

        for body, i in inner.items():
            token[node(body)] = i
        ends = defaultdict(dict)
        for body, i in final.items():
            ends[node(body[:-1])][body[-1]] = i
        n = len(kids)
        fail = [0] * n
        first = [-1] * n
        out_token, out_size, shorter = [], [], []
        step_row, stop_row = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
        step = _table(1 + sum(map(bool, kids[1:])), n - 1)
        stop = _table(1 + len(ends.keys() - {0}), len(inner) + len(final) - 1)
        step[0] = 1
        used = [1, 1]

        def output(i: int, size: int, then: int) -> int:
            out_token.append(i)
            out_size.append(size)
            shorter.append(then)
            return len(out_token) - 1

        queue = deque([0])
        while queue:
            at = queue.popleft()
            up = fail[at]
            if at:
                first[at] = output(token[at], depth[at], first[up]) if token[at] >= 0 else first[up]
                for k, (rows, row, own) in enumerate(((step, step_row, kids[at]), (stop, stop_row, ends.get(at)))):
                    row[at] = row[up]
                    if own:
                        row[at] = used[k]
                        rows[used[k]] = rows[row[up]]
                        used[k] += 1
            above = step[step_row[up]]
            for byte, i in ends.get(at, {}).items():
                stop[stop_row[at], byte] = output(i, depth[at] + 1, int(stop[stop_row[up], byte]) - 1 if at else -1) + 1
            for byte, kid in kids[at].items():
                fail[kid] = int(above[byte]) - 1 if at else 0
            for byte, kid in kids[at].items():
                step[step_row[at], byte] = kid + 1
                queue.append(kid)
        self.step_row, self.stop_row, self.step, self.stop = step_row, stop_row, step, stop
        self.first = np.array(first, dtype=np.int32)
        self.token = np.array(out_token, dtype=np.int32)
        self.size = np.array(out_size, dtype=np.int32)
        self.shorter = np.array(shorter, dtype=np.int32)


def _table(rows: int, largest: int) -> np.ndarray:
    """A table for numbers from -1 on, kept shifted by one, in 16 bits if the largest allows it."""
    return np.zeros((rows, 256), dtype=np.uint16 if largest < 65_535 else np.int32)


class Merges:
    """A vocabulary's merges: ``pair`` -> (rank, joined token), and each token's first merge in ``parts``."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(merges):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            whole = vocab[a + b]
            self.pair[vocab[a], vocab[b]] = (rank, whole)
            self.parts.setdefault(whole, (rank, vocab[a], vocab[b]))

    def merged(self, symbols: list[int]) -> list[int]:
        """Plain BPE, merge by merge; only for the vocabulary's own tokens and for tests."""
        ids = list(symbols)
        while len(ids) > 1:
            best = min(((self.pair[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.pair), default=None)
            if best is None:
                break
            out, k = [], 0
            while k < len(ids):
                if k + 1 < len(ids) and self.pair.get((ids[k], ids[k + 1]), (-1,))[0] == best[0]:
                    out.append(self.pair[ids[k], ids[k + 1]][1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def reachable(self, token: int) -> bool:
        """Does BPE of the token's own symbols give the token?"""
        stack, base = [token], []
        while stack:
            t = stack.pop()
            if t in self.parts:
                stack += [self.parts[t][2], self.parts[t][1]]
            else:
                base.append(t)
        return self.merged(base) == [token]


class Tokenizer:
    """Word-end BPE read from a vocabulary file; ids and decoded text equal the library's."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (vocab | self.special).items()}
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        merges = Merges(vocab, model["merges"])
        byte = {x: b for b, x in _byte_letters().items()}
        inner, final = {}, {}
        for token, i in vocab.items():
            if not merges.reachable(i):  # a token that BPE never leaves is no candidate
                continue
            if suffix and token.endswith(suffix):
                final[bytes(byte[x] for x in token[: -len(suffix)])] = i
            else:
                inner[bytes(byte[x] for x in token)] = i
        self.links = SuffixLinks(inner, final if suffix else inner)
        self.length = np.zeros(max(self.names) + 1, dtype=np.int32)
        self.length[self.links.token] = self.links.size
        # merges by pair (sorted keys with their ranks), and each token's own merge: rank (-1: none), left, right
        keys = np.array([a << 20 | b for a, b in merges.pair], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_key = keys[order]
        self.pair_rank = np.array([rank for rank, _ in merges.pair.values()], dtype=np.int32)[order]
        self.own = np.full((3, len(self.length)), -1, dtype=np.int32)
        for whole, part in merges.parts.items():
            self.own[:, whole] = part
        self._fresh()

    def _fresh(self) -> None:
        """What a process keeps for itself: compiled patterns, the table of pair tests and the caches."""
        self.pieces = regex.compile("\n|" + self.pattern)
        self.split_special = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")")
        self.fit_key = np.full(1 << FIT_BITS, -1, dtype=np.int64)
        self.fit = np.zeros(1 << FIT_BITS, dtype=bool)
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}
        self.young_bytes = 0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in _OF_PROCESS}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._fresh()

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of tokens: would BPE of both tokens' symbols end with exactly these two?

        Undo merges from the latest back (of two with one rank the right one is later).  At each
        step the tokens that touch at the border are those that stood there before that merge; a
        merge of theirs that comes before the step undone would have joined them."""
        a, b = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(a), 1 << 60, dtype=np.int64)  # twice the rank undone, one more for the right token's
        out = np.ones(len(a), dtype=bool)
        todo = np.arange(len(a))
        while len(todo):
            key = a[todo] << 20 | b[todo]
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            joined = (self.pair_key[at] == key) & (2 * self.pair_rank[at].astype(np.int64) < limit[todo])
            out[todo[joined]] = False
            ra, rb = self.own[0, a[todo]].astype(np.int64), self.own[0, b[todo]].astype(np.int64)
            left_last = ra > rb
            on = ~joined & ((ra >= 0) | (rb >= 0))
            undo_left, undo_right = todo[on & left_last], todo[on & ~left_last]
            limit[undo_left], limit[undo_right] = 2 * ra[on & left_last], 2 * rb[on & ~left_last] + 1
            a[undo_left] = self.own[2, a[undo_left]]
            b[undo_right] = self.own[1, b[undo_right]]
            todo = todo[on]
        return out

    def _fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Pair tests; answers are kept in a table of fixed size, where a newer pair takes an older one's place."""
        key = before.astype(np.int64) << 20 | token
        slot = (mix64(key.view(np.uint64)) >> np.uint64(64 - FIT_BITS)).astype(np.int64)
        out = self.fit[slot]
        miss = np.flatnonzero(self.fit_key[slot] != key)
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            out[miss] = self.compatible(new >> 20, new & 0xFFFFF)[back]
            self.fit_key[slot[miss]] = key[miss]
            self.fit[slot[miss]] = out[miss]
        return out

    def _same_length(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (one after the other, word by word) and their number, of the words in a matrix of bytes.

        last[:, k] is the last token of the first k bytes; the bytes of a word that end there are
        read by the automaton, its tokens tried from the longest, and the first fitting one is kept."""
        n, size = words.shape
        links = self.links
        last = np.full((n, size + 1), -1, dtype=np.int32)
        state = np.zeros(n, dtype=np.int32)
        rows = np.arange(n)
        for k in range(size):
            if k < size - 1:
                state = links.step[links.step_row[state], words[:, k]].astype(np.int32) - 1
                at = links.first[state]
            else:
                at = links.stop[links.stop_row[state], words[:, k]].astype(np.int32) - 1
            todo = rows[at >= 0]
            at = at[todo]
            while len(todo):
                start = k + 1 - links.size[at]
                token = links.token[at]
                before = last[todo, start]
                good = start == 0
                ask = np.flatnonzero(before >= 0)
                if len(ask):
                    good[ask] = self._fits(before[ask], token[ask])
                last[todo[good], k + 1] = token[good]
                todo, at = todo[~good], links.shorter[at[~good]]
                todo, at = todo[at >= 0], at[at >= 0]
        steps, places = [], []
        left = rows
        at = np.full(n, size)
        while len(left):
            token = last[left, at]
            steps.append(token)
            places.append(left)
            at = at - self.length[token]
            left, at = left[at > 0], at[at > 0]
        row = np.concatenate(places)
        back = np.concatenate([np.full(len(p), -k) for k, p in enumerate(places)])
        order = np.lexsort((back, row))
        return np.concatenate(steps)[order], np.bincount(row, minlength=n)

    def _words(self, words: list[str]) -> list[tuple[bytes, str]]:
        """Ids (as bytes) and tokens joined by one space, of each piece (already normalised, not empty)."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(w) for w in raw], dtype=np.int64)
        out: list[tuple[bytes, str]] = [(b"", "")] * len(words)
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order], prepend=-1))
        name, join = self.names.__getitem__, " ".join
        for lo, hi in zip(cuts, [*cuts[1:], len(words)]):
            size = int(sizes[order[lo]])
            group = max(1, GROUP_BYTES // size)
            for at in range(lo, hi, group):
                own = order[at:min(at + group, hi)].tolist()
                ids, counts = self._same_length(np.frombuffer(b"".join([raw[i] for i in own]), dtype=np.uint8).reshape(len(own), size))
                tokens, flat = list(map(name, ids.tolist())), ids.astype(np.int32).tobytes()
                start = 0
                for i, end in zip(own, np.cumsum(counts).tolist()):
                    out[i] = (flat[4 * start:4 * end], tokens[start] if end == start + 1 else join(tokens[start:end]))
                    start = end
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each piece (already normalised, not empty)."""
        return [np.frombuffer(ids, dtype=np.int32).tolist() for ids, _ in self._words(words)]

    def _pattern(self, newer: list[str]) -> regex.Pattern:
        """The piece pattern with code points that no Unicode version known here assigns as symbols,
        as the library classes them (the regex module knows newer letters)."""
        own = "[" + "".join(f"\\U{ord(c):08x}" for c in newer) + "]"
        whole = self.pattern.replace("[^\\s\\p{L}\\p{N}]", f"[[^\\s\\p{{L}}\\p{{N}}]||{own}]").replace("[\\p{L}]", f"[\\p{{L}}--{own}]")
        return regex.compile("\n|" + whole.replace("[\\p{N}]", f"[\\p{{N}}--{own}]"), flags=regex.V1)

    def _new_chunks(self, chunks: list[str]) -> dict[str, tuple[bytes, str]]:
        """Ids (as bytes) and decoded tokens of runs without white space."""
        if not chunks:
            return {}
        text = unicodedata.normalize("NFC", "\n".join(chunks)).replace("Σ", "σ").lower()
        newer = [c for c in set(text) if unicodedata.category(c) == "Cn"]
        pieces = (self._pattern(newer) if newer else self.pieces).findall(text)
        words = list(dict.fromkeys(pieces))
        if "\n" in words:
            words.remove("\n")
        known = dict(zip(words, self._words(words)))
        out, got, k = {}, [], 0
        for piece in pieces:
            if piece != "\n":
                got.append(known[piece])
                continue
            out[chunks[k]] = got[0] if len(got) == 1 else _joined(got)
            got, k = [], k + 1
        out[chunks[k]] = _joined(got)
        return out

    def _split(self, text: str) -> list[list[str] | str]:
        """White-space separated chunks of the stretches between special tokens, and these tokens."""
        if not any(x in text for x in self.special):
            return [_chunks(text)]
        return [part if k % 2 else _chunks(part) for k, part in enumerate(self.split_special.split(text))]

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each whole text its ids as int32 bytes, and its tokens joined by one space.

        Cache entries make no cycles: the cycle collector, which would walk the caches again and again, waits meanwhile."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collecting:
                gc.enable()

    def _encoded(self, texts: list[str]) -> list[tuple[bytes, str]]:
        split = [self._split(t) for t in texts]
        need = set().union(*[part for parts in split for part in parts if isinstance(part, list)])
        young, old = self.young, self.old
        fresh = need.difference(young)
        have = fresh.intersection(old)
        fresh = self._new_chunks(list(fresh.difference(have)))
        long = [c for c in fresh if len(c) > 64]  # long ones are not kept
        fresh |= {c: old[c] for c in have}
        if self.young_bytes > CACHE_BYTES:
            self.old = young
            self.young = young = {c: young[c] for c in need.intersection(young)}
            self.young_bytes = _held(young)
        young |= fresh
        self.young_bytes += _held(fresh)
        find = young.__getitem__
        out = []
        for parts in split:
            got: list[tuple[bytes, str]] = []
            for part in parts:
                got += map(find, part) if isinstance(part, list) else [(np.int32(self.special[part]).tobytes(), part)]
            out.append(_joined(got))
        for c in long:
            ids, decoded = young.pop(c)
            self.young_bytes -= ENTRY_BYTES + 2 * len(c) + len(ids) + len(decoded)
        return out


def _joined(got: list[tuple[bytes, str]]) -> tuple[bytes, str]:
    """One entry of entries that follow each other; those without ids add nothing."""
    if not got:
        return b"", ""
    ids, tokens = zip(*got)
    return b"".join(ids), " ".join(filter(None, tokens))


def _held(entries: dict[str, tuple[bytes, str]]) -> int:
    """About the bytes that cache entries take."""
    return ENTRY_BYTES * len(entries) + 2 * sum(map(len, entries)) + sum([len(ids) + len(decoded) for ids, decoded in entries.values()])


def _chunks(text: str) -> list[str]:
    if _ODD_SPACE.search(text):  # control characters that str.split() drops but the pattern keeps
        return [c for c in _SPACES.split(text) if c]
    return text.split()


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a vocabulary file, built once for each process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


class Packed:
    """A tokenizer as compressed bytes; whoever unpickles it has the tokenizer."""

    def __init__(self, tok: Tokenizer):
        out = io.BytesIO()
        with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0) as f:
            pickle.dump(tok, f, protocol=5)
        self.data = out.getvalue()

    def __reduce__(self) -> tuple:
        return _unpacked, (self.data,)


def _unpacked(data: bytes) -> Tokenizer:
    with gzip.GzipFile(fileobj=io.BytesIO(data)) as f:
        return pickle.load(f)


def packed(path: str) -> Packed:
    """The packed tokenizer of a vocabulary file: built once for each driver, which keeps these bytes alone."""
    if path not in _PACKED:
        _PACKED[path] = Packed(Tokenizer(path))
    return _PACKED[path]


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str = "decoded") -> DataFrame:
    """Add the ids of every whole text and the text decoded from them.  No shuffle."""
    kept = [f for f in docs.schema.fields if f.name not in (ids_col, decoded_col)]
    schema = T.StructType([*kept, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)),
                           T.StructField(decoded_col, T.StringType())])
    names = [f.name for f in kept]

    shipped = docs.sparkSession.sparkContext.broadcast(packed(tokenizer_path))  # a few MB, of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = shipped.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                got = tok.encode_batch([t or "" for t in texts])
                offsets = np.zeros(len(got) + 1, dtype=np.int32)
                np.cumsum([len(g[0]) // 4 for g in got], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join([g[0] for g in got]), dtype=np.int32))
                ids = pa.ListArray.from_arrays(pa.array(offsets), values)
                decoded = pa.array([g[1] for g in got], pa.string())
                yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], ids, decoded],
                                                 names=[*names, ids_col, decoded_col])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text: number of ids, digest of the decimal ids, digest of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
