"""Periodic runs of words: passages that repeat themselves with a fixed lag.

A run is a stretch of consecutive words whose smallest period is q (words q apart
are equal), at least twice q and LEAST words long, and that no neighbouring word
extends. Runs are found online by a sparse dynamic program over diagonals: a
diagonal is a lag, its state the word where its current match began. Going through
the words, every active lag is carried on or ended by one comparison, and the
earlier occurrences of the word open further lags. A lag that ends with enough
matches emits its run at once.

What makes it sparse, without losing a run: a run of lag d has at least
max(d, LEAST - d) matches in a row. So lags are dealt to levels, [1, 2m) for the first
level and [m, 2m) for each doubled m, and on a level an occurrence is one of a word
together with the m - 1 words before it. Prose has hardly any. Within a stretch of a period
p of at most m / 2 the occurrences lie p apart, and a lag whose whole match lies in that
stretch ends where the stretch ends and has its period, so these are stepped over at once.
Equal contexts are named by doubling, exactly, without hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.arrow import pieces, small_batches
from stayline.llm.names import unused

#: Least words of a run.
LEAST = 12

WORDS = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORDS), 0)


def _named(pairs: np.ndarray) -> np.ndarray:
    """Equal numbers get the same name, names are 0, 1, 2, ..."""
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _named(left * (int(right.max()) + 1) + right)


def _earlier(names: np.ndarray) -> np.ndarray:
    """For each entry the index of the entry before it with the same name, or -1."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    out = np.full(len(names), -1, np.int64)
    out[order[1:][same]] = order[:-1][same]
    return out


def _level(ids: list[int], at: np.ndarray, names: np.ndarray, m: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of all maximal stretches that are long enough for a run, low <= lag < high.

    ``names`` tells the contexts of m words that end at the words ``at`` (ascending) apart. A
    stretch may also have a smaller period.
    """
    index = _earlier(names)
    lag = np.where(index >= 0, at - at[index], 0)
    before = np.where(index >= 0, at[index], -1)
    # Places where a stretch of a short period begins: there its first match lies m - 1 words back.
    short = (lag > 0) & (2 * lag <= m)
    new = short.copy()
    new[1:] &= ~(short[:-1] & (lag[1:] == lag[:-1]) & (at[1:] == at[:-1] + 1))
    begin = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    stretch = at[begin] - (m - 1) - lag
    hits = np.flatnonzero((lag > 0) & (lag < high))
    place, back = dict(zip(at.tolist(), range(len(at)))), before.tolist()
    active: dict[int, int] = {}
    last = -2

    def ended(lags: list[int], end: int) -> Iterator[tuple[int, int, int]]:
        for d in lags:
            first = active.pop(d)
            if end - first + 1 >= max(d, LEAST - d):
                yield first - d, end, d

    for k, i, near, is_short, start in zip(
        hits.tolist(), at[hits].tolist(), lag[hits].tolist(), short[hits].tolist(), stretch[hits].tolist()
    ):
        if i != last + 1:
            yield from ended(list(active), last)
        elif active:
            yield from ended([d for d in active if ids[i] != ids[i - d]], last)
        last = i
        j = back[k]
        if is_short:
            # All equal contexts inside the stretch lie ``near`` apart; only the lag itself counts there.
            if near >= low and near not in active:
                active[near] = i - m + 1
            first = start + m - 1
            j = back[place[first + (i - first) % near]]
        while j >= 0 and i - j < high:
            d = i - j
            if d >= low and d not in active:
                active[d] = i - m + 1
            j = back[place[j]]
    yield from ended(list(active), last)


def runs(ids: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < LEAST:
        return []
    ids = list(ids)
    word = np.asarray(ids, np.int64)
    two = _joined(word[:-1], word[1:])  # entry i ends at word i + 1
    four = _joined(two[:-2], two[2:])
    m, low = LEAST // 2, 1
    names = _joined(two[:-4], four[2:])
    at = np.arange(m - 1, n)
    found: dict[tuple[int, int], int] = {}
    while True:
        counts = np.bincount(names)
        often = counts[names] > 1
        at, names = at[often], names[often]
        if len(at) == 0:
            break
        for start, end, d in _level(ids, at, names, m, low, 2 * m):
            # Of the lags with the same stretch the least is its period.
            found[start, end] = min(d, found.get((start, end), d))
        # Contexts twice as long: this one, and the one that ends m words before.
        there = np.searchsorted(at, at - m)
        both = np.flatnonzero((there < len(at)) & (at[np.minimum(there, len(at) - 1)] == at - m))
        if len(both) == 0:
            break
        at, names = at[both], _joined(names[there[both]], names[both])
        m, low = 2 * m, 2 * m
    return sorted((start, end - start + 1, d) for (start, end), d in found.items())


def dropped(n: int, found: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


RUNS = "array<struct<start:long,length:long,period:long>>"


def find_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs``, n_words, runs and collapsed.

    runs holds start (a word's number, from 0), length and period of each run, by start,
    then period. collapsed is the text without the words that lie in a run after its first
    period, joined by single spaces. A null or empty text has no words, no runs and an empty
    collapsed text; equal rows are treated alike. A kept column that has the name of a
    new one is replaced by it.
    """
    small_batches(docs.sparkSession)
    new = ["n_words", "runs", "collapsed"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = unused(docs, "source_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(source))
    fields = [f for f in rows.schema.fields if f.name != source]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields])
    schema = f"{schema}{', ' if fields else ''}n_words long, runs {RUNS}, collapsed string"
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, source, 1 << 20):
            sizes, found, texts = [], [], []
            for value in batch.column(source):
                # Bytes are split at just the six characters that part words.
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                number: dict[bytes, int] = {}
                here = runs([number.setdefault(w, len(number)) for w in words])
                if here:
                    gone = dropped(len(words), here)
                    words_left = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    words_left = words
                sizes.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in here])
                texts.append(b" ".join(words_left))
            columns = [batch.column(f.name) for f in fields]
            columns += [pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields] + new)

    return rows.mapInArrow(run, schema)


def with_repeated_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where about a tenth of the texts repeat a passage from some word to their end.

    Known runs to look for. h is the CRC-32 of the decimal key and g = floor(h / 10). Where
    h % 10 = 0 and the text has n > 0 words, each word i >= a becomes the word a + (i - a) % p, with
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), and words are joined by single spaces.
    All other texts, and those with a null key, are unchanged.
    """
    words, n, a, p = (unused(docs, name) for name in ("words", "n", "a", "p"))
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = docs.withColumn(words, F.when(h % 10 == 0, words_of(F.col(f"`{text}`"))))
    split = split.withColumn(n, F.size(words))
    split = split.withColumn(a, F.when(F.col(n) > 0, (g % F.col(n)).cast("int")))
    rest = F.col(n) - F.col(a)
    split = split.withColumn(p, (1 + F.floor(rest / (3 + g % 8))).cast("int"))
    passage = F.slice(words, F.col(a) + 1, F.col(p))
    tail = F.slice(F.flatten(F.array_repeat(passage, F.ceil(rest / F.col(p)).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), F.col(a)), tail), " ")
    return split.withColumn(text, F.coalesce(planted, F.col(f"`{text}`"))).drop(words, n, a, p)
