from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from stayline.llm import langid
from tests.llm import brute


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").repartition(3)


def sample(n=400):
    rng = random.Random(2)
    syllables = {"aa": ["ba", "lo", "mi"], "bb": ["xé", "zo", "qu"], "cc": ["ñi", "ka", "tu"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(syllables))
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 40))]
        rows.append((i, " ".join(words), lang, 0))
    return rows


def test_held_out_texts_are_recognised(spark):
    rows = sample()
    docs = texts(spark, rows)
    found = langid.predict(docs, langid.train(docs)).collect()
    assert set(found[0].asDict()) == {"doc_id", "text", "lang", "lang_pred", "score"}
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    held = {r["doc_id"] for r in out.filter(langid.held_out(out.doc_id)).collect()}
    assert 40 < len(held) < 120
    own = [r for r in found if r["doc_id"] in held]
    assert sum(r["lang"] == r["lang_pred"] for r in own) / len(own) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_labels_are_not_learned(spark):
    docs = texts(spark, sample(60))
    bent = docs.withColumn("lang", __import__("pyspark.sql.functions", fromlist=["x"]).expr("if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang)"))
    assert langid.train(bent).languages == ["aa", "bb", "cc"]


def test_awkward_rows(spark):
    model = langid.train(texts(spark, sample()))
    rows = [(1, None, "aa", 0), (2, "", "aa", 0), (3, "12 !? \n", None, 0), (None, "balo " * 30_000, None, 0), (5, "ÿþ你", None, 0), (5, "a", "bb", 0)]
    found = {(r["doc_id"], r["text"]): r for r in langid.predict(texts(spark, rows), model).collect()}
    assert len(found) == 6
    for row in rows[:3]:
        assert (found[row[:2]]["lang_pred"], found[row[:2]]["score"]) == ("und", 0)
    assert found[rows[3][:2]]["lang_pred"] == "aa"
    assert all(found[r[:2]]["lang_pred"] in model.languages for r in rows[3:])
    nothing = langid.train(texts(spark, rows).filter("false"))
    assert {r["lang_pred"] for r in langid.predict(texts(spark, rows), nothing).collect()} == {"und"}
    assert langid.predict(texts(spark, rows).filter("false"), model).count() == 0


def test_code_lengths_follow_the_escapes():
    """Against a direct walk down the contexts."""
    texts = {"p": [b"abracadabra", b"abab"], "q": [b"zzabz", b"bracz"]}
    counts: dict = {}
    for lang, some in texts.items():
        for t in some:
            for i, b in enumerate(t):
                run = [t[j] + 1 if j >= 0 else 0 for j in (i - 3, i - 2, i - 1)] + [b + 1]
                key = (lang, sum(x << s for x, s in zip(run, (27, 18, 9, 0), strict=True)))
                counts[key] = counts.get(key, 0) + 1
    trees = []
    for lang in ("p", "q"):
        own = {run: n for (x, run), n in counts.items() if x == lang}
        tree = langid.Tree.of(np.array(list(own)), np.array(list(own.values()), float))
        raw = b"".join(x.tobytes() for x in tree.parts())
        trees.append(langid.Tree.read(np.frombuffer(raw, np.uint8)))

    def bits(lang: str, text: bytes) -> float:
        total = 0.0
        for i, b in enumerate(text):
            context = [text[j] if j >= 0 else None for j in (i - 3, i - 2, i - 1)]
            p = 1.0
            for size in (3, 2, 1, 0):
                want = context[3 - size :]
                seen: dict[int, int] = {}
                for t in texts[lang]:
                    for j, x in enumerate(t):
                        before = [t[y] if y >= 0 else None for y in (j - 3, j - 2, j - 1)]
                        if before[3 - size :] == want:
                            seen[x] = seen.get(x, 0) + 1
                if not seen:
                    continue
                n, q = sum(seen.values()), len(seen)
                if b in seen:
                    p *= seen[b] / (n + q)
                    break
                p *= q / (n + q)
            else:
                p /= 256
            total -= np.log2(p)
        return total

    for text in (b"abra", b"zzz", b"cabz", b"a"):
        got = langid.code_lengths(trees, np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert np.allclose(got, [bits("p", text), bits("q", text)], atol=1e-9), text


def plain_prediction(rows, text):
    """Language and probability from contexts counted in dictionaries, over all training rows."""
    best = []
    for lang in sorted({r[2] for r in rows}):
        seen: dict[bytes, dict[int, int]] = {}
        for t in (r[1].encode() for r in rows if r[2] == lang):
            padded = [-1, -1, -1, *t]
            for i in range(3, len(padded)):
                for size in range(4):
                    follow = seen.setdefault(tuple(padded[i - size : i]), {})
                    follow[padded[i]] = follow.get(padded[i], 0) + 1
        padded, bits = [-1, -1, -1, *text.encode()], 0.0
        for i in range(3, len(padded)):
            for size in (3, 2, 1, 0):
                follow = seen.get(tuple(padded[i - size : i]))
                if follow is None:
                    continue
                whole = sum(follow.values()) + len(follow)
                if padded[i] in follow:
                    bits -= np.log2(follow[padded[i]] / whole)
                    break
                bits -= np.log2(len(follow) / whole)
            else:
                bits += 8
        best.append((bits, lang))
    least = min(best)
    return least[1], 1 / sum(2 ** (least[0] - b) for b, _ in best)


def test_predictions_equal_plain_counting(spark):
    rows = [(i, " ".join(t.split()[:4]), lang, 0) for i, t, lang, _ in sample(90)]
    docs = texts(spark, rows)
    learned = [tuple(r) for r in docs.filter(~langid.held_out(docs.doc_id)).collect()]
    for r in langid.predict(docs, langid.train(docs)).collect():
        lang, score = plain_prediction(learned, r["text"])
        assert (r["lang_pred"], round(r["score"], 9)) == (lang, round(score, 9))


def test_a_language_of_three_texts_is_learned(spark):
    """Two languages of hundreds of texts leave room for a third with hardly any, in a script of its own."""
    rows = [r for r in sample(900) if r[2] != "cc"]
    rare = [(5000 + i, "дом лес река", "zz", 0) for i in range(12)]
    held = {r["doc_id"] for r in texts(spark, rare).filter(langid.held_out(F.col("doc_id"))).collect()}
    known = [r for r in rare if r[0] not in held][:3]
    model = langid.train(texts(spark, rows + known))
    assert model.languages == ["aa", "bb", "zz"]
    asked = [(1, "река лес", None, 0), (2, "дом", None, 0), (3, "balo mi", None, 0)]
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(texts(spark, asked), model).collect()}
    assert found == {1: "zz", 2: "zz", 3: "aa"}


def test_forty_languages(spark):
    rng = random.Random(3)
    alphabet = [chr(0x61 + i) for i in range(26)] + [chr(0x430 + i) for i in range(32)]
    own = {f"l{i:02}": rng.sample(alphabet, 6) for i in range(40)}
    text = lambda lang, n: " ".join("".join(rng.choice(own[lang]) for _ in range(rng.randint(2, 6))) for _ in range(n))
    rows = [(i, text(f"l{i % 40:02}", 12), f"l{i % 40:02}", 0) for i in range(800)]
    model = langid.train(texts(spark, rows))
    assert model.languages == sorted(own)
    asked = [(i, text(lang, 15), lang, 0) for i, lang in enumerate(sorted(own))]
    found = langid.predict(texts(spark, asked), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 39


def test_columns_with_the_names_of_internal_ones(spark):
    rows = sample(60)
    names = ["lettered", "source_text", "_text", "_lettered", "run", "n", "_h", "_n"]
    docs = texts(spark, rows).select("doc_id", "text", "lang", *[F.lit(c).alias(c) for c in names])
    found = langid.predict(docs, langid.train(docs)).collect()
    assert len(found) == 60 and all(r[c] == c for r in found for c in names)


def test_documents_of_brute_table_keep_their_columns(spark):
    docs = brute.table(spark, brute.documents())
    found = langid.predict(docs, langid.train(docs))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    assert found.count() == docs.count()


def test_texts_of_no_learned_language_are_strange(spark):
    rows = sample(600)
    docs = texts(spark, rows)
    model = langid.train(docs)
    limits = langid.strange_from(docs, model)
    assert sorted(limits) == ["aa", "bb", "cc"]
    asked = [*rows, (9001, "дом лес река поле снег " * 4, None, 0), (9002, "def f(x): return {y: 2}; " * 4, None, 0), (9003, "дом", None, 0), (9004, None, None, 0), (9005, "", None, 0)]
    found = langid.predict(texts(spark, asked), model, bits="score bits")
    strange = langid.is_strange(F.col("score bits"), F.col("lang_pred"), F.col("text"), limits)
    got = {r["doc_id"]: r for r in found.select("*", strange.alias("strange")).collect()}
    assert {d for d, r in got.items() if r["strange"]} == {9001, 9002}
    assert got[9004]["score bits"] is None and got[9005]["score bits"] is None
    few = langid.strange_from(docs.limit(30), model)
    assert few == {} and not any(r[0] for r in found.select(langid.is_strange(F.col("score bits"), F.col("lang_pred"), F.col("text"), few)).collect())


def test_bits_per_byte_are_the_code_length(spark):
    rows = [(i, " ".join(t.split()[:4]), lang, 0) for i, t, lang, _ in sample(60)]
    docs = texts(spark, rows)
    model = langid.train(docs)
    trees = [langid.Tree.read(langid.load(f)) for f in model.files]
    for r in langid.predict(docs, model, keep=["text"], bits="b").collect():
        raw = np.frombuffer(r["text"].encode(), np.uint8)
        own = langid.code_lengths(trees, raw, np.array([0, len(raw)]))[0].min()
        assert abs(r["b"] - own / len(raw)) < 1e-9


def test_trees_hold_every_training_text(spark):
    """More texts of a language than any sample had, each with bytes of its own; equal rows count once."""
    rows = [(d, f"word{d:05d}", "l1") for d in range(3000)]
    docs = spark.createDataFrame(rows + rows[:100], "doc_id long, text string, lang string").repartition(4)
    learned = [r["text"] for r in docs.filter(~langid.held_out(F.col("doc_id"))).distinct().collect()]
    assert len(learned) > 2000
    model = langid.train(docs)
    tree = langid.Tree.read(langid.load(model.files[0]))
    data, offs = langid.flat(langid.pa.array(sorted(learned)))
    want = langid.Tree.of(*np.unique(langid._runs(data, offs), return_counts=True))
    for own, other in zip(tree.orders, want.orders):
        assert all(np.allclose(a, b) for a, b in zip(own, other))
