"""Registered queries, as the entry has them, on a small folder of awkward documents."""

from __future__ import annotations

import hashlib
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from stayline.llm import queries
from tests.llm import brute

ROWS = brute.documents(4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    brute.table(spark, ROWS).write.parquet(f"{out}/documents.parquet")
    return out


def remainder(doc_id, n):
    return crc32(str(doc_id if doc_id is not None else "").encode()) % n


def test_op2_equals_the_library(spark, folder):
    library = Tokenizer.from_file(queries.TOKENIZER)
    want = Counter()
    for d, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want[d, len(ids), hashlib.sha256(raw).hexdigest(), brute.sha(library.decode(ids, skip_special_tokens=False))] += 1
    found = queries.op2_bpe(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == want


def test_op4_marks_held_out_rows_and_texts_without_letters(spark, folder):
    found = queries.op4_langid(spark, folder)
    assert dict(found.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    lettered = lambda t: any(c.isalpha() for c in t or "")
    want = Counter((d, remainder(d, 5) == 0, "en" if lettered(t) else "und", 1.0 if lettered(t) else 0.0) for d, t in ROWS)
    assert Counter(tuple(r) for r in found.collect()) == want  # the only learned language is certain


def test_op7_keeps_sizes_and_checksums(spark, folder):
    found = queries.op7_sharding(spark, folder).collect()
    raw = lambda t: (t or "").encode()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((d, len(raw(t)) + 1) for d, t in ROWS)
    texts = {(d, crc32(raw(t))) for d, t in ROWS if t is not None}
    assert {(r["doc_id"], r["text_crc32"]) for r in found if r["size"] > 1} <= texts
    assert {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}
    assert sorted(r["slot"] for r in found if r["shard"] == 0) == list(range(sum(r["shard"] == 0 for r in found)))


def test_op10_equals_plain_counting(spark, folder):
    learned = [t for d, t in ROWS if remainder(d, 7) != 2]
    total, scores = brute.kneser_ney(learned, [t for _, t in ROWS])
    want = Counter(
        (d, remainder(d, 7) == 2, n, known, total, round(base, 6), round(score, 6))
        for (d, _), (n, known, base, score) in zip(ROWS, scores, strict=True)
    )
    found = queries.op10_lm(spark, folder)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert Counter((*tuple(r)[:5], round(r[5], 6), round(r[6], 6)) for r in found.collect()) == want
