"""Plain versions of what the operators compute, and small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return (text or "").encode().translate(LOWER).decode()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    w = words(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def classes(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    """(doc_id, shingles, least doc_id of the class) of each row (doc_id, text)."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least: dict[int, list] = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)].append(d)
    return [
        (d, len(sets[i]), min(least[root(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows)
    ]


def without_repeats(rows: list[tuple], window: int) -> list[tuple]:
    """(doc_id, words, removed, kept text) of each row (doc_id, text)."""
    place = lambda d: math.inf if d is None else d
    first: dict[tuple, float] = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, math.inf), place(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < place(d):
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), kept))
    return out


def quality(text: str | None) -> tuple:
    t = text or ""
    w = words(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = [False] * len(w)
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            covered[i : i + 3] = [True] * 3
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, r = len(w), sum(covered)
    return (
        n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r,
        n < 50 or 100 * r > 50 * n,
    )


def kneser_ney(train: list[str | None], texts: list[str | None], order: int = 3) -> tuple[int, list[tuple]]:
    """Training tokens, and (tokens, known, base score, score) of each text."""
    begin = "<begin>"
    tokens = lambda t: [*words(lower(t)), None]
    grams = lambda x, n: list(zip(*([*[begin] * (n - 1), *x][i:] for i in range(n)), strict=False))
    learned = [tokens(t) for t in train]
    one = Counter(w for x in learned for w in x)
    total, kinds = sum(one.values()), len(one)
    counts = {order: Counter(g for x in learned for g in grams(x, order))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter()
        for g, c in counts[n + 1].items():
            counts[n][g[1:]] += c if g[1] == begin else 1

    def discounts(counts) -> list[float]:
        n = [sum(1 for c in counts if c == i) for i in range(5)]
        d = [0, 0.5, 1.0, 1.5]
        for i in (1, 2, 3):
            if n[1] and n[2] and n[i]:
                x = i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i]
                d[i] = x if 0 < x <= i else d[i]
        return d

    cut = {n: discounts(counts[n].values()) for n in counts}
    used, spare = Counter(), defaultdict(float)
    for n in counts:
        for g, c in counts[n].items():
            used[n, g[:-1]] += c
            spare[n, g[:-1]] += cut[n][min(c, 3)]

    def chance(g: tuple) -> float:
        n = len(g)
        if not n:
            return 1 / (kinds + 1)
        low = chance(g[1:])
        if not used[n, g[:-1]]:
            return low
        c = counts[n][g]
        return (max(c - cut[n][min(c, 3)], 0) + spare[n, g[:-1]] * low) / used[n, g[:-1]]

    out = []
    for t in texts:
        x = tokens(t)
        base = sum(math.log10((one[w] + 1) / (total + kinds + 1)) for w in x)
        score = sum(math.log10(chance(g)) for g in grams(x, order))
        out.append((len(x), sum(one[w] > 0 for w in x), base, score))
    return total, out


def prose(rng: random.Random, n: int, kinds: int = 400) -> str:
    """Words with a few frequent ones, as lines."""
    out = [f"w{int(kinds * rng.random() ** 3)}" for _ in range(n)]
    return " ".join(x + ("\n" if rng.random() < 0.05 else "") for x in out)


def edited(rng: random.Random, text: str, changes: int) -> str:
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text): plain, copied, edited, empty, null, short, long and repeated rows."""
    rng = random.Random(seed)
    rows: list[tuple] = [(i, prose(rng, rng.randint(60, 200))) for i in range(30)]
    base = rows[3][1]
    passage = prose(rng, 70)
    rows += [(100 + i, base) for i in range(4)]
    rows += [(200 + i, edited(rng, prose(random.Random(9), 150), i % 6)) for i in range(40)]
    rows += [(300 + i, prose(rng, 40) + " " + passage + " " + prose(rng, 30)) for i in range(6)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one"), (405, "One two"), (406, "...")]
    rows += [(500, prose(rng, 20_000)), (501, "x" * 50_000), (None, base), (None, None), (502, "ÉÈ é ß 你好 <|endoftext|>")]
    rows += [rows[5], rows[5], (3, prose(rng, 80))]
    rng.shuffle(rows)
    return rows


def table(spark, rows: list[tuple]):
    """The rows as a documents table with more columns, some called like those of results."""
    full = [(d, t, "en" if i % 3 else None, None, 0, f"c{i}") for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(
        full,
        "doc_id long, text string, lang string, source string, n_chars long, `score` string",
    ).repartition(5)
