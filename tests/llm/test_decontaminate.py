from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from stayline.llm import decontaminate
from tests.llm import brute


def tables(spark, rows, items):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, leaks string").repartition(4)
    return docs, spark.createDataFrame(items, "item_id long, text string")


def planted(seed=3):
    rng = random.Random(seed)
    items = [(i, brute.prose(rng, rng.randint(14, 58), 3000)) for i in range(30)]
    rows, want = [], set()
    for d in range(120):
        text = brute.prose(rng, rng.randint(40, 300), 3000)
        if d % 3 == 0:
            item = items[d // 3 % 30]
            passage = item[1].split()
            if d % 2:  # a paraphrase: every eighth word is another
                passage[3::8] = [f"y{rng.randrange(10**6)}" for _ in passage[3::8]]
            w = text.split()
            at = rng.randrange(len(w))
            text = " ".join([*w[:at], *(x.upper() + "," if rng.random() < 0.2 else x for x in passage), *w[at:]])
            want.add((d, item[0]))
        rows.append((d, text))
    return rows, items, want


def test_planted_passages_and_paraphrases_are_found(spark):
    rows, items, want = planted()
    docs, benchmark = tables(spark, rows, items)
    found = decontaminate.find_leaks(docs, benchmark)
    assert found.columns == ["doc_id", "text", "leaks"]
    got = {(r["doc_id"], x["item_id"]) for r in found.collect() for x in r["leaks"]}
    assert got == want


def test_candidates_reach_the_recall_of_brute_force(spark):
    """Every pair that the order check alone would confirm anywhere in the text."""
    rows, items, _ = planted(8)
    docs, benchmark = tables(spark, rows, items)
    got = {(r["doc_id"], x["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect() for x in r["leaks"]}
    wanted = decontaminate.read_items([{"item_id": i, "text": t} for i, t in items])
    checker = decontaminate.Checker(wanted)
    every = set()
    for d, t in rows:
        w = decontaminate._hashes(t).tolist()
        for i, item in enumerate(wanted):
            if any(checker.check(i, w, s, 24) for s in range(0, max(1, len(w)), 12)):
                every.add((d, item.item_id))
    assert len(got & every) >= 0.9 * len(every) and got <= every


def test_answer_decides_on_loose_paraphrases():
    words = [f"q{i}" for i in range(40)]
    item = decontaminate.read_items([{"item_id": 1, "text": " ".join(words) + " Answer: blue green whale"}])
    assert len(item[0].answer) == 3
    checker = decontaminate.Checker(item)
    hashes = lambda w: decontaminate._hashes(" ".join(w)).tolist()
    loose = [x if i % 3 else f"z{i}" for i, x in enumerate(words)]
    assert checker.check(0, hashes([*loose, "so", "blue", "green", "whale"]), 0, 24)
    assert checker.check(0, hashes([*loose, "so", "red", "brown", "shark"]), 0, 24) is None


def test_awkward_rows_and_blocks(spark, monkeypatch):
    rows, items, want = planted()
    rows += [(900, None), (901, ""), (902, "one"), (None, rows[0][1]), rows[0], (903, "zz " * 20_000)]
    items += [(50, None), (51, ""), (52, "too short an item"), (0, items[0][1])]
    docs, benchmark = tables(spark, rows, items)
    whole = decontaminate.find_leaks(docs, benchmark, keep=["doc_id"])
    leaks = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, sorted(x["item_id"] for x in r["leaks"])) for r in df.collect())
    got = leaks(whole)
    assert len(got) == len(rows)
    assert {(d, i) for null, d, x in got if not null for i in x} == want
    assert (True, 0, [0, 0]) in got and (False, 902, []) in got
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    parts = decontaminate.find_leaks(docs, benchmark, keep=["doc_id"])
    assert parts.columns == ["doc_id", "leaks"] and leaks(parts) == got
    assert decontaminate.find_leaks(docs, benchmark.filter("false")).filter("size(leaks) > 0").count() == 0
    assert decontaminate.find_leaks(docs.filter("false"), benchmark).count() == 0


def test_latent_space_keeps_the_benchmark_apart(spark):
    rows, items, _ = planted()
    docs, _ = tables(spark, rows, items)
    wanted = decontaminate.read_items([{"item_id": i, "text": t} for i, t in items])
    vocabulary = np.unique(np.array([w for i in wanted for w in i.words], np.uint64))
    space = decontaminate._fit(docs, decontaminate._weights(docs, vocabulary), wanted, len(rows))
    assert np.allclose(space.basis.T @ space.basis, np.eye(space.basis.shape[1]), atol=1e-3)


def test_leaks_below_the_cosine_are_found(spark):
    """Items with every sixth word replaced among words of no other document, of which there are many."""
    rng = random.Random(5)
    items = [(i, brute.prose(rng, rng.randint(18, 24), 60) + f" k{i} l{i}") for i in range(12)]
    rows = [(1000 + d, brute.prose(rng, 30, 60)) for d in range(400)]
    for d in range(48):
        passage = items[d % 12][1].split()
        passage[d % 6 :: 6] = [f"y{rng.randrange(10**6)}" for _ in passage[d % 6 :: 6]]
        new = [f"n{rng.randrange(10**6)}" for _ in range(60)]
        rows.append((d, " ".join([*new[: 20 + d % 12], *passage, *new[20 + d % 12 :]])))
    docs, benchmark = tables(spark, rows, items)
    got = {(r["doc_id"], x["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect() for x in r["leaks"]}
    wanted = decontaminate.read_items([{"item_id": i, "text": t} for i, t in items])
    checker = decontaminate.Checker(wanted)
    every = set()
    for d, t in rows:
        w = decontaminate._hashes(t).tolist()
        for i, item in enumerate(wanted):
            if any(checker.check(i, w, s, 24) for s in range(0, max(1, len(w)), 12)):
                every.add((d, item.item_id))
    assert got == every and {(d, d % 12) for d in range(48)} <= every


def test_columns_with_the_names_of_internal_ones(spark, monkeypatch):
    rows, items, want = planted()
    docs, benchmark = tables(spark, rows, items)
    names = ["_text", "_more", "text_", "_kept_0", "item_id"]
    wide = docs.select("*", *[F.lit(c).alias(c) for c in names])
    for size in (decontaminate.BLOCK_BYTES, 2000):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        found = decontaminate.find_leaks(wide, benchmark)
        assert found.columns == [c for c in wide.columns if c != "leaks"] + ["leaks"]
        got = found.collect()
        assert {(r["doc_id"], x["item_id"]) for r in got for x in r["leaks"]} == want
        assert len(got) == len(rows) and all(r[c] == c for r in got for c in names)


def test_short_items_are_found_word_for_word(spark):
    rng = random.Random(11)
    rows, items, want = planted(11)
    short = [(200 + n, " ".join(f"s{n}x{i}" for i in range(n))) for n in range(1, 8)]
    short.append((300, short[6][1]))  # equal items are each reported
    by_id = dict(short)
    for d, (i, t) in enumerate(short, 2000):
        w = [f"z{rng.randrange(10**6)}" for _ in range(50)]
        rows.append((d, " ".join([*w[:d % 7], t.upper().replace(" ", ", "), *w[d % 7 :], t])))
    # One word apart, cut between two rows, and in another order.
    t = by_id[207].split()
    rows += [(3000, " ".join([*t[:3], "and", *t[3:]])), (3001, " ".join(t[:4])), (3002, " ".join(t[4:])), (3003, " ".join(t[::-1]))]
    docs, benchmark = tables(spark, rows, [*items, *short])
    got = {(r["doc_id"], x["item_id"]): x for r in decontaminate.find_leaks(docs, benchmark).collect() for x in r["leaks"]}
    hashed = lambda t: decontaminate._hashes(t or "").tolist()
    plain = set()
    for d, text in rows:
        h = hashed(text)
        for i, item in short:
            w = hashed(item)
            if len(w) >= 4 and any(h[s : s + len(w)] == w for s in range(len(h))):
                plain.add((d, i))
    assert {k for k in got if k[1] >= 200} == plain and {k for k in got if k[1] < 200} == want
    assert {i for _, i in plain} == {204, 205, 206, 207, 300}
    assert all(x["shared_words"] == x["item_words"] == i - 200 and x["start"] == d % 7 for (d, i), x in got.items() if 200 < i < 300 and d == 2000 + i - 201)
    only = decontaminate.find_leaks(docs, spark.createDataFrame(short, "item_id long, text string"), keep=["doc_id"])
    assert {(r["doc_id"], x["item_id"]) for r in only.collect() for x in r["leaks"]} == plain


def test_the_latent_space_is_fitted_on_every_document(spark, monkeypatch):
    """More documents than any sample had; the same from pairs held in a table and in sorted arrays."""
    rng = random.Random(5)
    items = [(i, brute.prose(rng, 30, 60)) for i in range(12)]
    rows = [(d, brute.prose(rng, rng.randint(0, 60), 90)) for d in range(6000)] + [(6000, None), (6001, "")]
    docs, _ = tables(spark, rows, items)
    wanted = decontaminate.read_items([{"item_id": i, "text": t} for i, t in items])
    space = decontaminate._weights(docs, np.unique(np.array([w for i in wanted for w in i.words], np.uint64)))
    data, offs = decontaminate.flat(decontaminate.pa.array([t for _, t in rows]))
    h, cuts = decontaminate._words(data, offs)
    test = np.random.default_rng(1).standard_normal((len(space.vocabulary), 5)).astype(np.float32)
    want, passages = space.gram(h, cuts, test)
    fitted = []
    for small in (1 << 22, 500):
        monkeypatch.setattr(decontaminate, "SMALL", small)
        got, n, keys = np.zeros(want.shape), 0, []
        for r in decontaminate._corpus_gram(docs, space).collect():
            n += r["n"]
            keys += np.frombuffer(r["keys"], np.int64).tolist()
            a, b = np.divmod(np.frombuffer(r["keys"], np.int64), len(space.vocabulary))
            v = np.frombuffer(r["sums"], np.float32) * space.weight[a] * space.weight[b]
            np.add.at(got, a, v[:, None] * test[b])
            np.add.at(got, b, v[:, None] * test[a])
        assert n == passages and len(set(keys)) == len(keys)
        assert np.allclose(got, want, rtol=1e-3, atol=1e-3 * np.abs(want).max())
        basis = decontaminate._fit(docs, space, wanted).basis
        fitted.append(basis @ basis.T)
    assert np.allclose(*fitted, atol=1e-3)


def test_sums_of_many_kinds_of_pairs_are_not_sorted_again_and_again(monkeypatch):
    """Frequent keys have slots, so that what is held besides them does not grow with the text."""
    monkeypatch.setattr(decontaminate, "SMALL", 1 << 12)
    rng = np.random.default_rng(4)
    sums, want = decontaminate.Sums(1 << 40), {}
    frequent = rng.integers(0, 1 << 40, 500)
    for _ in range(40):
        keys = np.concatenate([rng.choice(frequent, 1000), rng.integers(0, 1 << 40, 20)])
        values = rng.random(len(keys))
        sums.add(keys, values)
        for k, v in zip(keys.tolist(), values.tolist()):
            want[k] = want.get(k, 0) + v
        assert sum(map(len, sums.keys)) < 7000
    keys, values = sums.found()
    assert keys.tolist() == sorted(want)
    assert np.allclose(values, [want[k] for k in keys.tolist()])


def test_places_are_those_of_a_search():
    rng = np.random.default_rng(6)
    some = rng.integers(0, 1 << 64, 700, dtype=np.uint64)
    near = (np.uint64(1) << np.uint64(60)) + rng.integers(0, 5000, 300, dtype=np.uint64)  # with equal first bits
    ends = np.array([0, (1 << 64) - 1], np.uint64)
    for vocabulary in (some, near, np.concatenate([some, near, ends]), some[:1], some[:0], ends):
        vocabulary = np.unique(vocabulary)
        space = decontaminate.Space(vocabulary, np.ones(len(vocabulary)), 1.0)
        h = np.concatenate([some, near, near + np.uint64(1), ends, rng.integers(0, 1 << 64, 500, dtype=np.uint64)])
        column = {v: i for i, v in enumerate(vocabulary.tolist())}
        assert space.places(h).tolist() == [column.get(x, -1) for x in h.tolist()]


def test_pairs_of_passages_are_numbered_without_gaps():
    """A benchmark of some thousand words has a number for each pair in a table no larger than the slots."""
    rng = np.random.default_rng(7)
    vocabulary = np.unique(rng.integers(0, 1 << 64, 40, dtype=np.uint64))
    space = decontaminate.Space(vocabulary, rng.random(len(vocabulary)) + 1, 3.0)
    other = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
    sizes = [0, 1, 11, 12, 13, 24, 25, 36, 37, 200, 0, 5]
    h, cuts = rng.choice(np.concatenate([vocabulary, other]), sum(sizes)), np.concatenate([[0], np.cumsum(sizes)])
    want = np.zeros((len(vocabulary),) * 2)
    passages = 0
    for a, n in zip(cuts, sizes):
        for begin in range(0, max(n - 12, min(n, 1)), 12):
            passage = space.places(h[a + begin : a + min(begin + 24, n)])
            length = np.where(passage >= 0, space.weight[passage], space.other)
            times = np.bincount(passage[passage >= 0], minlength=len(vocabulary))
            want += np.outer(times, times) / (length**2).sum()
            passages += 1
    keys, values, n = space.pairs(h, cuts)
    every = np.arange(len(vocabulary) * (len(vocabulary) + 1) // 2)
    assert n == passages and keys.min() >= 0 and keys.max() <= every[-1]
    a, b = np.divmod(space.spread(keys), len(vocabulary))
    got = np.zeros_like(want)
    np.add.at(got, (a, b), values)
    np.add.at(got, (b, a), values)
    assert np.allclose(got, want)
    assert np.all(np.diff(space.spread(every)) > 0) and (a <= b).all()
    assert decontaminate.Sums(3905 * 3906 // 2).direct
