import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe

ALPHABET = list("ab cde 12\n\t.,!'sé漢😀  \x85\x1c\x00ßñ") + ["'re", " the", "<|endoftext|>", "  ", "\r\n", "ing"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.DEFAULT_VOCABULARY))


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(400)]
    return made + ["", " ", "a" * 3000, "the cat " * 500, "x" * 70 + " " * 70, "<|endoftext|><|endoftext|>a"]


def test_ids_and_decoded_texts_equal_the_library(library):
    own = bpe.load(bpe.DEFAULT_VOCABULARY)
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == want, repr(t)
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_merges_skip_stale_entries():
    own = bpe.load(bpe.DEFAULT_VOCABULARY)
    for w in (b"aaaaaaaa", b"ababababab", b"\xff\xfe", b"z"):
        assert b"".join(own.strings[i] for i in own.merge_word(w)) == w


def test_frames(make, library):
    rows = [(1, "the cat"), (1, "the cat"), (None, "x"), (2, None), (3, ""), (4, "é" * 20_000)]
    got = sorted(map(tuple, bpe.round_trip(make(rows)).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert got == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(make(rows))).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert bpe.round_trip(make([])).count() == 0
