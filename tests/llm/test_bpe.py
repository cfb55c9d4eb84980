import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from costseries.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def codec():
    with open(PATH) as f:
        return bpe.Codec(bpe.Vocabulary(json.load(f)))


ODD = [
    "", " ", "\n\t", "<|startoftext|>hi <|endoftext|> <|endof", "<|STARTOFTEXT|>", "ΣΑΣ ΟΔΟΣ", "İstanbul ǅ ß", "Å é Å", "日本語 テスト 123 ١٢٣ ²½",
    "👩‍👩‍👧 emoji !!!", "x" * 3000, "it's we'll I'M 'S don't 've", "\x1c\x1f\x85\xa0᠎​　a", "\x00a\x00", "ﬁ ſ K", "the " * 500,
]


def test_equals_the_library(codec, library):
    rng = random.Random(5)
    letters = [chr(c) for c in [*range(32, 127), *range(0xC0, 0x250), *range(0x391, 0x3C9), *range(0x410, 0x44F), *range(0x4E00, 0x4E80), 0x1F600, 0x200D]]
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(600)]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == expected, text
        assert codec.decode(got) == library.decode(expected, skip_special_tokens=False), text


def test_cuts_are_safe(codec):
    """Fragments never change what merging the whole piece gives."""
    for piece in ("hello", "zqxjkv", "überraschung", "éèêë", "thndble", "日本語"):
        units = codec.v.units(piece.encode())
        parts = codec.v.fragments(units)
        assert [u for p in parts for u in p] == units
        assert [i for p in parts for i in codec.v.merged(p)] == codec.v.merged(tuple(units))


def test_query_on_all_documents(table, library):
    documents = table("documents")
    got = {r.doc_id: r for r in bpe.encode(documents, PATH).collect()}
    for row in documents.collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        one = got[row.doc_id]
        assert (one.n_tokens, one.ids) == (len(ids), ids)
        assert one.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert one.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd, no_docs):
    got = bpe.encode(odd, PATH).collect()
    assert len(got) == odd.count()
    empty = [r for r in got if r.doc_id in (1, 2, 3)]
    assert all(r.n_tokens == 0 and r.ids == [] and r.ids_sha256 == hashlib.sha256(b"").hexdigest() for r in empty)
    assert len({r.ids_sha256 for r in got if r.doc_id in (5, 6)}) == 1
    assert bpe.encode(no_docs, PATH).count() == 0


def test_long_words_take_time_in_proportion(codec):
    """A word of a megabyte in seconds, and the same ids from the heap as from the plain merges."""
    import time

    v = codec.v
    start = time.process_time()
    assert len(bpe.Codec(v).encode("etaoinshrdlu" * 90_000)) > 0
    assert time.process_time() - start < 30
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 199, 200, 500):
        units = tuple(v.units("".join(rng.choices("etaonhs", k=n)).encode()))
        plain = v.merged(units[:199]) if n > 199 else v.merged(units)
        assert v._merged_long(list(units[:199])) == plain


def test_long_pieces_are_not_remembered(codec):
    codec = bpe.Codec(codec.v)
    codec.encode("short words and " + "x" * 5000)
    assert max(map(len, codec.pieces)) <= bpe.CACHED and max(map(len, codec.parts)) <= bpe.CACHED
