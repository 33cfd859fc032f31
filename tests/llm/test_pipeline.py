from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from stayline.llm import decontaminate, langid
from tests.llm import brute


def test_every_stage_acts_on_what_the_last_one_kept(spark, tmp_path):
    rows = [r for r in brute.documents() if r[0] not in (3, None)]
    item = rows[0][1] if rows[0][1] and len(rows[0][1].split()) > 60 else next(t for _, t in rows if t and len(t.split()) > 60)
    item = " ".join(item.split()[5:50])
    rows += [(700, brute.prose(__import__("random").Random(70), 60, 9000) + " " + item)]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    full = [(d, t, ("l1", "l2")[(d or 0) % 2], None, len(t or "")) for d, t in dict.fromkeys(rows)]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, str(tmp_path)), name)
        kept[name] = docs.collect()
        assert name == "tokens" or docs.columns == columns

    lettered = {d: t for d, t in rows if t and any(c.isalpha() for c in t)}
    first = {r["doc_id"]: r["text"] for r in kept["language_id"]}
    assert set(first) <= set(lettered) and len(first) > 0.9 * len(lettered)

    pairs = list(first.items())
    least = {c for _, _, c in brute.classes(pairs, 5, 80)}
    second = {r["doc_id"]: r["text"] for r in kept["near_duplicates"]}
    assert set(second) == least

    third = {r["doc_id"]: r["text"] for r in kept["substring_dedup"]}
    for d, n, removed, text in brute.without_repeats(list(second.items()), 50):
        assert (d in third) == (removed < n)
        if d in third:
            assert third[d] == (text if removed else second[d])

    w = decontaminate.read_items([{"item_id": 1, "text": item}])
    checker = decontaminate.Checker(w)
    fourth = {r["doc_id"] for r in kept["decontamination"]}
    for d, t in third.items():
        h = decontaminate._hashes(t).tolist()
        leak = any(checker.check(0, h, s, 24) for s in range(0, max(1, len(h)), 12))
        assert (d in fourth) == (not leak)
    assert len(fourth) < len(third)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = {r["doc_id"]: r for r in kept["tokens"]}
    assert set(last) == fourth
    for d, r in last.items():
        ids = library.encode(third[d], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == brute.sha(library.decode(ids, skip_special_tokens=False))
    assert langid.UNKNOWN not in {r["lang"] for r in kept["tokens"]}
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} == fourth
