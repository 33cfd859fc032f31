from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stayline.llm import bpe
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pair():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Codec(file.read()), Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(pair):
    codec, library = pair
    rng = random.Random(1)
    pool = [chr(i) for i in range(0x250)] + [
        "'s", "'LL", "<|endoftext|>", "<|STARTOFTEXT|>", "aaaa", "Σ", "İ", "ﬁ", "你", "é", "😀", "\x1c", "\x85", "ͅ", " ",
    ]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    texts += ["".join(rng.choice("abt") for _ in range(rng.randint(0, 40))) for _ in range(1000)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want, text
        assert codec.decode(packed) == library.decode(want, skip_special_tokens=False), text


def test_every_prefix_has_one_last_token(pair):
    """The encodings of all prefixes of a word agree with merging each on its own."""
    codec, library = pair
    for word in ("internationalization", "thththththe", "aaaaaaaaaaaaa"):
        for end in range(1, len(word) + 1):
            assert codec.word(word[:end].encode()) == library.encode(word[:end], add_special_tokens=False).ids


def test_caches_start_afresh_without_changing_ids(pair, monkeypatch):
    _, library = pair
    monkeypatch.setattr(bpe, "CACHE", 3)
    with open(PATH, encoding="utf-8") as file:
        small = bpe.Codec(file.read())
    for _, text in brute.documents()[:20]:
        assert np.frombuffer(small.encode(text or ""), "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_tables_with_awkward_rows(spark, pair):
    _, library = pair
    rows = brute.documents()
    docs = brute.table(spark, rows).withColumnRenamed("score", "token_ids")
    ids = bpe.encode(docs, PATH)
    assert sorted(ids.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "token_ids"])
    found = bpe.decode(ids, PATH, keep=["doc_id", "text", "token_ids"]).collect()
    assert len(found) == len(rows)
    for r in found:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(docs.filter("false"), PATH), PATH).count() == 0
