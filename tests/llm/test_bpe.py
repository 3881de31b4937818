import hashlib
import json
import pickle
import random

import numpy as np
import pytest
from edge import empty, rows, table
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import bpe

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids(raw):
    return np.frombuffer(raw, dtype=np.int32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeinthrsao 'tsé\n\x1c　Σß123!?"), st.characters(max_codepoint=0x24F)), max_size=60))
def test_equals_library_on_random_texts(library, text):
    own, = bpe.tokenizer(PATH).encode_batch([text])
    want = library.encode(text, add_special_tokens=False)
    assert ids(own[0]) == want.ids
    assert own[1] == library.decode(want.ids, skip_special_tokens=False)


def test_equals_library_on_special_cases(library):
    rng = random.Random(5)
    texts = ["", " ", "<|endoftext|>", "a<|startoftext|><|endoftext|>b I'll don't 's 'S", "ΣΑΣ İstanbul ́e", "a" * 5000, "ab" * 3000,
             "՘₏ x", "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(3000))]
    for text, own in zip(texts, bpe.tokenizer(PATH).encode_batch(texts)):
        want = library.encode(text, add_special_tokens=False)
        assert (ids(own[0]), own[1]) == (want.ids, library.decode(want.ids, skip_special_tokens=False))


def test_dynamic_programme_equals_merging():
    tok = bpe.tokenizer(PATH)
    with open(PATH, encoding="utf-8") as f:
        model = json.load(f)["model"]
    names, merges = model["vocab"], bpe.Merges(model["vocab"], model["merges"])
    rng = random.Random(6)
    words = ["".join(rng.choice("aeinothr") for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    for word, got in zip(words, tok.encode_words(words)):
        assert got == merges.merged([*[names[c] for c in word[:-1]], names[word[-1] + "</w>"]])


def test_cache_turns_over(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    tok = bpe.Tokenizer(PATH)
    tok = pickle.loads(pickle.dumps(tok))  # as it is shipped to workers
    for n in range(20):
        text = " ".join(f"w{k}x" for k in range(n * 7, n * 7 + 30)) + " " + "z" * 100
        assert ids(tok.encode_batch([text])[0][0]) == library.encode(text, add_special_tokens=False).ids


def test_edge_table(spark, library):
    out = bpe.encode(table(spark), PATH)
    assert out.columns[-2:] == ["ids", "decoded"] and out.count() == len(rows())
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(out).collect())
    want = []
    for r in rows():
        e = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0] or -1, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(bpe.encode(empty(spark), PATH)).collect() == []


def test_no_cycle_collection_while_encoding():
    import gc
    tok = bpe.Tokenizer(PATH)
    seen = []
    watch = lambda phase, info: seen.append(phase)
    gc.collect()
    gc.callbacks.append(watch)
    try:
        tok._encoded([" ".join(f"w{k}x{k % 7}" for k in range(30_000))])
        plain, seen[:] = len(seen), []
        tok.encode_batch([" ".join(f"v{k}y{k % 7}" for k in range(30_000))])
    finally:
        gc.callbacks.remove(watch)
    assert plain > 2 and len(seen) <= 2  # at most one, when it is on again
    assert gc.isenabled()


def test_driver_keeps_only_packed_tables(spark, monkeypatch, library):
    monkeypatch.setattr(bpe, "_LOADED", {})
    monkeypatch.setattr(bpe, "_PACKED", {})
    assert bpe.encode(table(spark), PATH).count() == len(rows())
    assert not bpe._LOADED and list(bpe._PACKED) == [PATH]
    whole = pickle.dumps(bpe._PACKED[PATH])
    assert len(whole) < 6 << 20
    tok = pickle.loads(whole)
    text = "An example, with 3 naïve words; 你好 "
    assert ids(tok.encode_batch([text])[0][0]) == library.encode(text, add_special_tokens=False).ids


def test_tables_are_built_in_place():
    import tracemalloc
    rng = random.Random(3)
    words = {bytes(rng.randrange(256) for _ in range(rng.randrange(2, 6))): i for i in range(3000)}
    tracemalloc.start()
    try:
        links = bpe.SuffixLinks(words, words)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert links.step.dtype == links.stop.dtype == np.uint16
    assert peak < 3 * (links.step.nbytes + links.stop.nbytes)
