from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayline.llm import periodic, queries
from tests.llm import brute


def plain_runs(w) -> list[tuple[int, int, int]]:
    """(start, length, period) by comparing the sequence with itself at every lag."""
    n = len(w)
    best: dict[tuple[int, int], int] = {}
    for d in range(1, n // 2 + 1):
        i = d
        while i < n:
            if w[i] != w[i - d]:
                i += 1
                continue
            first = i
            while i < n and w[i] == w[i - d]:
                i += 1
            start, length = first - d, i - first + d
            if length >= max(12, 2 * d):
                best.setdefault((start, length), d)  # the least lag comes first
    return sorted((s, length, d) for (s, length), d in best.items())


def collapsed(w, runs) -> list:
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [x for i, x in enumerate(w) if i not in gone]


def planted(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def sequences():
    rng = random.Random(4)
    for _ in range(1500):
        yield [rng.randrange(rng.choice((1, 2, 2, 3, 9))) for _ in range(rng.randint(0, 90))]
    for _ in range(700):  # powers of short blocks, broken in places, side by side
        out = []
        for _ in range(rng.randint(1, 4)):
            block = [rng.randrange(rng.choice((2, 3, 30))) for _ in range(rng.randint(1, 30))]
            part = block * rng.randint(1, 9)
            out += part[: rng.randint(1, len(part))]
            if rng.random() < 0.4:
                out[rng.randrange(len(out))] = 77
        yield out
    a = [0] * 40
    yield from (a + [1] + a, (a + [1]) * 3, [0, 1] * 50 + [0, 0] + [0, 1] * 50, [5] * 400)
    for _ in range(60):  # Fibonacci and Thue-Morse words and shuffled mixtures of them
        x, y = [0], [0, 1]
        while len(y) < 300:
            x, y = y, y + x
        at = rng.randrange(200)
        yield y[at : at + rng.randint(20, 180)]
        m = [bin(i).count("1") % 2 for i in range(256)]
        yield m[: rng.randint(20, 256)] + y[: rng.randint(1, 60)]


def test_equal_to_every_lag():
    for w in sequences():
        assert periodic.runs(w) == plain_runs(w), w


def test_long_uniform_and_nested_texts_stay_fast():
    n = 200_000
    assert periodic.runs([0] * n) == [(0, n, 1)]
    nested = ([0] * 30 + [1]) * 2000
    found = periodic.runs(nested)
    assert (0, len(nested), 31) in found and len(found) == 2001


def test_prose_with_planted_tail():
    rng = random.Random(8)
    w = brute.words(brute.prose(rng, 6000))
    w = w[:3000] + w[2500:3000] * 3 + w[3000:]
    assert periodic.runs([hash(x) % 10**9 for x in w]) == plain_runs(w)


def texts():
    rng = random.Random(6)
    rows = [r for r in brute.documents() if len(r[1] or "") < 30_000]
    rows += [(1000 + i, brute.prose(rng, rng.randint(1, 90), rng.choice((2, 400)))) for i in range(150)]
    return rows + [(None, "a b " * 20), (8, "é\u00a0x\x1cy " * 15), (9, "x\x00 \x0b\x0cx\x00\r\n" * 9)]


def test_tables_with_awkward_rows(spark):
    rows = texts()
    docs = brute.table(spark, rows)
    found = periodic.find_runs(docs).collect()
    want = Counter()
    for d, t in rows:
        w = brute.words(t)
        r = plain_runs(w)
        want[d, t, len(w), tuple(r), " ".join(collapsed(w, r))] += 1
    got = Counter((r["doc_id"], r["text"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in found)
    assert got == want
    names = ["source_text", "n_words", "runs", "words", "a", "n", "p"]
    wide = docs.select("doc_id", "text", *[F.lit(c).alias(c) for c in names])
    kept = periodic.find_runs(periodic.with_repeated_tails(wide)).collect()
    assert len(kept) == len(rows) and all(r[c] == c for r in kept for c in ("source_text", "words", "a", "n", "p"))
    assert periodic.find_runs(docs.filter("false"), keep=[]).count() == 0


def test_query_has_the_plain_result(spark, tmp_path):
    rows = texts()
    brute.table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic(spark, str(tmp_path))
    want = Counter()
    for d, t in rows:
        w = planted(d, brute.words(t))
        r = plain_runs(w)
        top = min(r, key=lambda x: (-x[1], x[0], x[2]), default=None)
        first = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in r)
        want[d, len(r), *first, brute.sha(lines), brute.sha(" ".join(collapsed(w, r)))] += 1
    assert Counter(tuple(r) for r in found.collect()) == want
    assert sum(n for k, n in want.items() if k[1]) > 10


@pytest.mark.parametrize("n, found, want", [(5, [], [0] * 5), (6, [(1, 4, 2)], [0, 0, 0, 1, 1, 0]), (0, [], [])])
def test_dropped_words(n, found, want):
    assert periodic.dropped(n, found).tolist() == want
