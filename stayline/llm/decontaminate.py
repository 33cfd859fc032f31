"""Benchmark passages in documents, found by latent semantic retrieval.

Benchmark items and documents are cut into passages of 24 words, one every 12, so
that a passage of an item meets one that has 18 of its words at least. Passages
are weighted by TF-IDF with document frequencies of the whole corpus. A randomised
SVD of all corpus passages together with all benchmark passages gives the latent
space: the pairs of benchmark words that share a passage are summed once over the
corpus, and the steps of the SVD work on these sums. Every passage of every document
is projected and compared with the benchmark passages by cosine. A leak shares a
longest common subsequence of SURE of the item's words in a stretch little longer
than the item, or of LIKELY of them together with the item's answer.

No cosine decides what is found: a stretch that shares LIKELY of the words must
hold some of the item's rarest ones, so all stretches that hold enough of those go
to the order check, too, whatever their cosine.

Only words of the benchmark add to a cosine, so they are the columns of the
matrix; the other words of a passage count in its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.arrow import pieces, release, small_batches
from stayline.llm.names import aside, back
from stayline.llm.words import U64, chunks, flat, gram_hashes, spans, word_hashes
from stayline.sources.staging import stage

#: Words from one passage to the next; a passage has two of these blocks.
STRIDE = 12
#: Weight of all corpus passages together in the fit, the benchmark's being 1.
CORPUS_WEIGHT = 0.1
DIMENSIONS = 128
OVERSAMPLE = 16
POWER_STEPS = 2
#: Sums that a task holds at least before it passes them on, bytes of text whose pairs it makes at once,
#: and columns of a band of sums.
SMALL = 1 << 22
PAIR_BYTES = 1 << 17
BAND = 64
#: Least cosine in the latent space, as a share of what the item's passage has with itself there,
#: and least cosine in the full space.
LATENT_COSINE = 0.4
COSINE = 0.5
SURE = 0.8
LIKELY = 0.6
#: Share of an item's words that a stretch must hold of its rarest words at least.
RARE = 0.1
#: Shorter items are phrases: they are searched for as they stand, all their words in a row. With
#: fewer than LEAST_WORDS they are found in any text and are not searched for.
MIN_WORDS = 8
LEAST_WORDS = 4
#: Bytes of benchmark text that one search handles; a larger benchmark is searched for in blocks.
BLOCK_BYTES = 4 << 20

#: How an item marks its answer; without a mark the last words count as the answer.
ANSWER_MARK = re.compile(r"(?i)\b(?:answer|a)\s*:\s*(?!.*\b(?:answer|a)\s*:)", re.S)

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20

LEAK = "array<struct<item_id:long,cosine:double,shared_words:int,item_words:int,answer_found:boolean,start:int>>"
_LEAK_ARROW = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("cosine", pa.float64()), ("shared_words", pa.int32()),
         ("item_words", pa.int32()), ("answer_found", pa.bool_()), ("start", pa.int32())]
    )
)


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of letters and digits, lower-cased, and the texts' word offsets."""
    plain = _PLAIN[data]
    starts, ends, cuts = spans(plain, offs)
    return word_hashes(plain, starts, ends, lower=True), cuts


def _hashes(text: str) -> np.ndarray:
    data, offs = flat(pa.array([text]))
    return _words(data, offs)[0]


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: list[int]

    @property
    def stretch(self) -> int:
        """Words of a document that the item is looked for in at a time."""
        return len(self.words) + max(4, len(self.words) // 4)

    @property
    def least(self) -> int:
        """Words in order that every leak of the item shares."""
        return int(np.ceil(LIKELY * len(self.words)))


def read_items(rows: list) -> list[Item]:
    """Items with at least MIN_WORDS words; a null text has none."""
    items = []
    for row in rows:
        words = _hashes(row["text"] or "").tolist()
        if len(words) < MIN_WORDS:
            continue
        mark = ANSWER_MARK.search(row["text"])
        answer = _hashes(row["text"][mark.end() :]).tolist() if mark else []
        items.append(Item(row["item_id"], words, answer or words[-max(3, len(words) // 5) :]))
    return items


def read_phrases(rows: list) -> list[Item]:
    """Items with LEAST_WORDS words or more, but fewer than MIN_WORDS; the answer is one of the words."""
    found = [Item(row["item_id"], _hashes(row["text"] or "").tolist(), []) for row in rows]
    return [i for i in found if LEAST_WORDS <= len(i.words) < MIN_WORDS]


@dataclass
class Space:
    """Vocabulary with weights, and once fitted, the projection of each word."""

    vocabulary: np.ndarray
    weight: np.ndarray
    other: float  # weight of words outside the vocabulary
    basis: np.ndarray | None = None

    def __post_init__(self) -> None:
        # Where the words with each value of the first bits begin; most of them have one word or none.
        bits = min(20, (8 * len(self.vocabulary)).bit_length())
        self._shift = U64(64 - bits)
        self._begin = np.searchsorted(self.vocabulary >> self._shift, np.arange((1 << bits) + 1, dtype=U64))
        self._most = int(np.diff(self._begin).max())
        self._words = np.append(self.vocabulary, U64(0))

    def places(self, h: np.ndarray) -> np.ndarray:
        """Column of each word, -1 outside the vocabulary."""
        at = self._begin[(h >> self._shift).astype(np.int64)]
        for _ in range(self._most - 1):
            at += (self._words[at] < h) & (at < len(self.vocabulary))
        return np.where((self._words[at] == h) & (at < len(self.vocabulary)), at, -1)

    @property
    def triangle(self) -> np.ndarray:
        """What a column adds to another, not smaller one to number the pairs of columns without gaps, in order."""
        column = np.arange(len(self.vocabulary))
        return column * len(column) - column * (column + 1) // 2

    def spread(self, keys: np.ndarray) -> np.ndarray:
        """column * columns + other column for numbers of pairs."""
        triangle = self.triangle
        column = np.searchsorted(triangle + np.arange(len(triangle)), keys, "right") - 1
        return keys - triangle[column] + column * len(triangle)

    def passages(self, h: np.ndarray, cuts: np.ndarray, values: np.ndarray, at: np.ndarray | None = None):
        """(text, first word, unit-length sum of ``values`` over the words) of all passages; ``at``: places(h)."""
        n = np.diff(cuts)
        blocks = -(-n // STRIDE)
        row = np.repeat(np.arange(len(n)), blocks)
        first = np.cumsum(blocks) - blocks
        place = np.arange(len(row)) - first[row]
        begin = cuts[row] + place * STRIDE
        sums = np.zeros((len(row) + 1, values.shape[1]), np.float32)
        square = np.zeros(len(row) + 1, np.float32)
        if len(h):
            at = self.places(h) if at is None else at
            known = np.flatnonzero(at >= 0)
            weight = np.full(len(h), self.other, np.float32)
            weight[known] = self.weight[at[known]]
            square[:-1] = np.add.reduceat(weight * weight, begin)
            edge = np.searchsorted(known, np.append(begin, len(h)))
            number = np.diff(edge)
            # The first word of all blocks, then the second, ...: blocks with most words come first.
            order = np.argsort(-number, kind="stable")
            first_known, number, column = edge[order], number[order], at[known]
            part = np.zeros((int((number > 0).sum()), values.shape[1]), np.float32)
            for i in range(int(number[0]) if len(number) else 0):
                more = int(np.searchsorted(-number, -i, "left"))
                part[:more] += np.take(values, column[first_known[:more] + i], axis=0)
            sums[order[: len(part)]] = part
        # A passage is two blocks; the last one of a text only where it is alone.
        start = np.flatnonzero((place + 1 < blocks[row]) | (place == 0))
        after = np.where(place[start] + 1 < blocks[row[start]], start + 1, len(row))
        vector = sums[start] + sums[after]
        vector /= np.sqrt(np.maximum(square[start] + square[after], 1e-9))[:, None]
        return row[start], place[start] * STRIDE, vector

    def pairs(self, h: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """A^T A for the passages A of some texts, before the weights of columns, and the number of passages.

        Numbers of pairs (see ``triangle``), values to add to both orders of the pair.
        """
        if len(h) == 0:
            return np.zeros(0, np.int64), np.zeros(0), 0
        n = np.diff(cuts)
        blocks = -(-n // STRIDE)
        row = np.repeat(np.arange(len(n)), blocks)
        place = np.arange(len(row)) - (np.cumsum(blocks) - blocks)[row]
        begin = cuts[row] + place * STRIDE
        at = self.places(h)
        square = np.add.reduceat(np.where(at >= 0, self.weight[at], self.other) ** 2, begin)
        more = place + 1 < blocks[row]
        start = more | (place == 0)
        # What the passage that begins with a block weighs, and all passages with the block.
        own = np.where(start, 1 / np.maximum(square + np.where(more, np.append(square[1:], 0), 0), 1e-9), 0)
        whole = own + np.where(place > 0, np.append(0, own[:-1]), 0)
        known = np.flatnonzero(at >= 0)
        column = at[known]
        edge = np.searchsorted(known, np.append(begin, len(h)))
        number = np.diff(edge)
        # Known words from each one to the end of its block, and of the passage that begins there.
        inside = (np.repeat(edge[1:], number) - np.arange(len(known))).astype(np.int8)
        room = inside + np.repeat(np.where(more, np.append(number[1:], 0), 0), number).astype(np.int8)
        own, whole = np.repeat(own, number), np.repeat(whole, number)
        triangle = self.triangle
        keys, values = [triangle[column] + column], [whole / 2]
        for step in range(1, 2 * STRIDE):
            left = np.flatnonzero(room > step)
            if len(left) == 0:
                break
            one, other = column[left], column[left + step]
            keys.append(triangle[np.minimum(one, other)] + np.maximum(one, other))
            values.append(np.where(inside[left] > step, whole[left], own[left]))
        return np.concatenate(keys), np.concatenate(values), int(start.sum())

    def gram(self, h: np.ndarray, cuts: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, int]:
        """A^T (A test) for the passages A of some texts, and their number."""
        row, start, image = self.passages(h, cuts, (test * self.weight[:, None]).astype(np.float32))
        out = np.zeros(test.shape)
        ends = np.minimum(cuts[row] + start + 2 * STRIDE, cuts[row + 1])
        begins = cuts[row] + start
        n = ends - begins
        passage = np.repeat(np.arange(len(row)), n)
        word = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = self.places(h)
        every = np.where(at >= 0, self.weight[at], self.other)
        length = np.sqrt(np.maximum(np.bincount(passage, every[word] ** 2, len(row)), 1e-9))
        known = at[word] >= 0
        passage, column = passage[known], at[word[known]]
        order = np.argsort(column, kind="stable")
        passage, column = passage[order], column[order]
        scale = self.weight[column] / length[passage]
        if len(column):
            for a in range(0, len(column), 200_000):
                part = slice(a, a + 200_000)
                kinds, begin = np.unique(column[part], return_index=True)
                out[kinds] += np.add.reduceat(image[passage[part]] * scale[part, None], begin, axis=0)
        return out, len(row)


def _weights(docs: DataFrame, vocabulary: np.ndarray) -> Space:
    """Inverse document frequencies of the benchmark's words over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(shared.value, np.ones(len(shared.value)), 1.0)
        seen, total = np.zeros(len(shared.value) + 1, np.int64), 0
        for batch in pieces(batches, "text"):
            data, offs = flat(batch.column("text"))
            for a, b, part, cut in chunks(data, offs):
                h, cuts = _words(part, cut)
                at = space.places(h)
                row = np.repeat(np.arange(b - a), np.diff(cuts))
                pairs = np.unique((row * len(seen) + at)[at >= 0])
                seen += np.bincount(pairs % len(seen), minlength=len(seen))
                total += b - a
        seen[-1] = total
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["at", "n"])

    counted = docs.select("text").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # one row per word of the benchmark block
    frequency = np.zeros(len(vocabulary) + 1)
    frequency[found["at"]] = found["n"]
    total = frequency[-1]
    weight = np.log((total + 1) / (frequency[:-1] + 1)) + 1
    return Space(vocabulary, weight, float(np.log(total + 1) + 1))


class Sums:
    """Sums of values by key; keys below ``n``, in a table where that takes no more than the slots.

    Else the first keys that come, mostly the frequent ones, get a slot each by hash;
    the others, whose slot is taken, are kept sorted.
    """

    def __init__(self, n: int):
        self.direct = n <= 2 * SMALL
        self.bits = max(1, SMALL.bit_length() - 1)
        self.table = np.zeros(n if self.direct else 1 << self.bits)
        self.owner = None if self.direct else np.zeros(1 << self.bits, np.int64)  # key + 1
        self.used = 0
        self.keys, self.values = [np.zeros(0, np.int64)], [np.zeros(0)]

    def add(self, keys: np.ndarray, values: np.ndarray) -> int:
        """Keys held now, about."""
        if self.direct:
            np.add.at(self.table, keys, values)
            return 0
        slot = ((keys.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)
        held = self.owner[slot]
        free = np.flatnonzero(held == 0)
        if len(free):
            self.owner[slot[free]] = keys[free] + 1  # of keys with one slot the last gets it
            self.used += len(np.unique(slot[free]))
            held[free] = self.owner[slot[free]]
        mine = held == keys + 1
        np.add.at(self.table, slot, np.where(mine, values, 0))
        late = np.flatnonzero(~mine)
        if len(late):
            self.keys.append(keys[late])
            self.values.append(values[late])
            if sum(map(len, self.keys)) > 2 * max(SMALL // 4, len(self.keys[0])):
                self._sort()
        return self.used + len(self.keys[0])

    def _sort(self) -> None:
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        self.keys, self.values = [keys], [np.bincount(at, np.concatenate(self.values), len(keys))]

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """The keys, sorted, and their sums."""
        if self.direct:
            keys = np.flatnonzero(self.table)
            return keys, self.table[keys]
        self._sort()
        slot = np.flatnonzero(self.owner)
        keys = np.concatenate([self.owner[slot] - 1, self.keys[0]])
        order = np.argsort(keys)
        return keys[order], np.concatenate([self.table[slot], self.values[0]])[order]


def _corpus_gram(docs: DataFrame, space: Space) -> DataFrame:
    """A^T A for the passages A of all documents: rows of keys and values, and passages n.

    A key is column * columns + other column, not smaller; its value is to be added to both orders of the
    pair. The keys of a row lie in one band of columns, and no key is in two rows.
    """
    columns = len(space.vocabulary)
    width = min(BAND, max(1, SMALL // columns))
    shared = docs.sparkSession.sparkContext.broadcast(space)
    names = ["band", "keys", "sums", "n"]
    pairs = columns * (columns + 1) // 2

    def rows(sums: Sums, n: int, full: bool) -> Iterator[pa.RecordBatch]:
        """A row per band, some at a time; ``full``: with keys as they are wanted, else with the numbers of pairs."""
        keys, values = sums.found()
        edges = np.searchsorted(keys, np.append((shared.value.triangle + np.arange(columns))[::width], pairs))
        for a in range(0, len(edges) - 1, 8):
            some = [b for b in range(a, min(a + 8, len(edges) - 1)) if edges[b] < edges[b + 1]]
            packs = [keys[edges[b] : edges[b + 1]] for b in some]
            packs = [(shared.value.spread(k) if full else k).tobytes() for k in packs]
            added = [values[edges[b] : edges[b + 1]].astype(np.float32).tobytes() for b in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(packs, pa.binary()), pa.array(added, pa.binary()),
                 pa.array([0] * len(some), pa.int64())], names
            )
        # The passages travel beside the pairs, in a band of their own.
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), *(pa.array([b""], pa.binary()),) * 2, pa.array([n], pa.int64())], names
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = Sums(pairs), 0
        for batch in pieces(batches, "text"):
            data, offs = flat(batch.column("text"))
            for _, _, part, cut in chunks(data, offs, PAIR_BYTES):
                keys, values, more = shared.value.pairs(*_words(part, cut))
                n += more
                if sums.add(keys, values) > SMALL:
                    yield from rows(sums, n, False)
                    sums, n = Sums(pairs), 0
        yield from rows(sums, n, False)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = Sums(pairs), 0
        for batch in batches:
            for keys, values, more in zip(*(batch.column(c).to_pylist() for c in names[1:])):
                sums.add(np.frombuffer(keys, np.int64), np.frombuffer(values, np.float32))
                n += more
        yield from rows(sums, n, True)
        sums = None
        release()

    schema = "band int, keys binary, sums binary, n long"
    counted = docs.select("text").mapInArrow(count, schema)
    return stage(counted.repartition("band").mapInArrow(unite, schema), "passage_pairs")


def _fit(docs: DataFrame, space: Space, items: list[Item], total: int | None = None) -> Space:
    """The latent space of all documents and the items, by subspace iteration on a random start.

    ``total``, the number of documents, is not needed.
    """
    spark = docs.sparkSession
    gram = _corpus_gram(docs, space)
    corpus_passages = gram.agg(F.sum("n")).first()[0] or 0
    size = min(DIMENSIONS + OVERSAMPLE, len(space.vocabulary))
    test = np.random.default_rng(7).standard_normal((len(space.vocabulary), size)).astype(np.float32)
    h = np.array([w for i in items for w in i.words], U64)
    cuts = np.concatenate([[0], np.cumsum([len(i.words) for i in items])])

    def image(test: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((space.weight, test))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, start = shared.value
            columns, out = len(weight), np.zeros(start.shape)
            for batch in batches:
                for packed, sums in zip(batch.column("keys").to_pylist(), batch.column("sums").to_pylist()):
                    if not packed:
                        continue
                    a, b = np.divmod(np.frombuffer(packed, np.int64), columns)
                    low, rows = a[0], a[-1] - a[0] + 1
                    values = np.frombuffer(sums, np.float32) * weight[a] * weight[b]
                    block = np.bincount((a - low) * columns + b, values, rows * columns).reshape(rows, columns)
                    block = block.astype(np.float32)
                    # Each pair stands for both of its orders.
                    out[low : low + rows] += block @ start
                    out += block.T @ start[low : low + rows]
            yield pa.RecordBatch.from_arrays([pa.array(range(columns), pa.int32()), pa.array(
                [x.tobytes() for x in out.astype(np.float32)], pa.binary())], ["at", "part"])

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, part in zip(batch.column("at").to_pylist(), batch.column("part").to_pylist()):
                    out[at] = out.get(at, 0) + np.frombuffer(part, np.float32).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array(
                [x.astype(np.float32).tobytes() for x in out.values()], pa.binary())], ["at", "part"])

        schema = "at int, part binary"
        parts = gram.mapInArrow(run, schema).repartition("at").mapInArrow(total, schema).collect()  # one per column
        corpus = np.zeros(test.shape)
        for p in parts:
            corpus[p["at"]] = np.frombuffer(p["part"], np.float32)
        own, n = space.gram(h, cuts, test)
        # The weights are of all passages of a kind, so the corpus' size does not shape the space.
        return own + corpus * (CORPUS_WEIGHT * n / max(1, corpus_passages))

    for _ in range(POWER_STEPS):
        test = np.linalg.qr(image(test))[0].astype(np.float32)
    values, turn = np.linalg.eigh(test.T @ image(test))
    best = np.argsort(-values)[:DIMENSIONS]
    return Space(space.vocabulary, space.weight, space.other, (test @ turn[:, best]).astype(np.float32))


def common_subsequence(bits: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``bits`` has the places of each of n words."""
    whole = (1 << n) - 1
    v = whole
    for w in words:
        u = v & bits.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & whole
    return n - v.bit_count()


def _bits(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


class FullSpace:
    """Cosines of document passages with benchmark passages over all their words."""

    def __init__(self, space: Space, h: np.ndarray, cuts: np.ndarray):
        n = np.diff(cuts)
        blocks = -(-n // STRIDE)
        count = np.maximum(1, blocks - 1)  # passages of each item, in the order of Space.passages
        row = np.repeat(np.arange(len(n)), count)
        begin = cuts[row] + (np.arange(len(row)) - (np.cumsum(count) - count)[row]) * STRIDE
        size = np.minimum(begin + 2 * STRIDE, cuts[row + 1]) - begin
        passage = np.repeat(np.arange(len(row)), size)
        column = space.places(h)[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        length = np.sqrt(np.bincount(passage, space.weight[column] ** 2, len(row)))
        self.columns = len(space.vocabulary)
        self.keys = np.unique(passage * self.columns + column)
        self.value = space.weight[self.keys % self.columns] ** 2 / length[self.keys // self.columns]

    def cosines(self, passage: np.ndarray, columns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``columns``: the words of each candidate, one row each, -1 for none or outside the vocabulary."""
        keys = passage[:, None] * self.columns + columns
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (columns >= 0)
        return np.where(hit, self.value[at], 0).sum(axis=1) / lengths


class Checker:
    """Confirms candidates by word order."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.bits = [_bits(i.words) for i in items]
        self.answers = [_bits(i.answer) for i in items]

    def check(self, i: int, words: list[int], start: int, size: int) -> tuple[int, bool, int] | None:
        """(shared words, answer found, where) of item i near a passage, None where it is not there."""
        n = len(self.items[i].words)
        return self.within(i, words, max(0, start - n), min(len(words), start + size + n))

    def within(self, i: int, words: list[int], lo: int, hi: int) -> tuple[int, bool, int] | None:
        """The same for all stretches between two words: of those that confirm the item, the first with most words."""
        item, bits = self.items[i], self.bits[i]
        n, stretch, least = len(item.words), item.stretch, item.least
        held = [0, *accumulate(w in bits for w in words[lo:hi])]
        if held[-1] < least or common_subsequence(bits, n, words[lo:hi]) < least:
            return None
        best = None
        for at in range(max(0, hi - lo - stretch) + 1):
            end = min(at + stretch, hi - lo)
            if held[end] - held[at] < (best[0] + 1 if best else least):
                continue
            shared = common_subsequence(bits, n, words[lo + at : lo + end])
            if shared < (best[0] + 1 if best else least):
                continue
            answer = item.answer
            near = words[lo + at : lo + at + stretch + len(answer)]
            has = common_subsequence(self.answers[i], len(answer), near) >= SURE * len(answer)
            if shared >= SURE * n or has:
                best = shared, has, lo + at
        return best


class RareWords:
    """Finds every stretch that can share enough words with an item, by the item's rarest words.

    A stretch that has ``least`` of an item's n words lacks n - least of them at
    most, so it holds ``count`` of any n - least + count of them.
    """

    def __init__(self, space: Space, items: list[Item]):
        column, owner = [], []
        self.count, self.stretch = np.ones((2, len(items)), np.int64)
        for i, item in enumerate(items):
            n = len(item.words)
            kinds, times = np.unique(space.places(np.array(item.words, U64)), return_counts=True)
            order = np.argsort(-space.weight[kinds], kind="stable")
            total = np.cumsum(times[order])
            size = np.searchsorted(total, n - item.least + max(1, int(np.ceil(RARE * n)))) + 1
            size = min(size, len(order))
            self.count[i], self.stretch[i] = item.least - n + total[size - 1], item.stretch
            column.append(kinds[order[:size]])
            owner.append(np.full(size, i))
        column, owner = np.concatenate(column), np.concatenate(owner)
        order = np.argsort(column, kind="stable")
        self.owner = owner[order]
        self.begin = np.searchsorted(column[order], np.arange(len(space.vocabulary) + 1))

    def regions(self, at: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, end) that the stretches to check lie in; ``at``: the column of each word."""
        word = np.flatnonzero(at >= 0)
        number = np.diff(self.begin)[at[word]]
        word, number = word[number > 0], number[number > 0]
        place = np.repeat(word, number)
        item = self.owner[np.repeat(self.begin[at[word]] - (np.cumsum(number) - number), number) + np.arange(len(place))]
        key = (np.searchsorted(cuts, place, "right") - 1) * len(self.count) + item
        order = np.argsort(key, kind="stable")
        key, place, item = key[order], place[order], item[order]
        last = np.arange(len(key)) + self.count[item] - 1
        inside = last < len(key)
        last = np.minimum(last, len(key) - 1)
        near = np.flatnonzero(inside & (key[last] == key) & (place[last] - place < self.stretch[item]))
        row, item = key[near] // len(self.count), item[near]
        lo = np.maximum(place[last[near]] + 1 - self.stretch[item], cuts[row]) - cuts[row]
        hi = np.minimum(place[near] + self.stretch[item], cuts[row + 1]) - cuts[row]
        # Regions of a text and item that overlap are one.
        new = np.ones(len(near), bool)
        new[1:] = (key[near][1:] != key[near][:-1]) | (lo[1:] >= hi[:-1])
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(near)) - 1 if len(near) else first
        yield from zip(row[first].tolist(), item[first].tolist(), lo[first].tolist(), hi[end].tolist(), strict=True)


def _schema(docs: DataFrame, keep: list[str], target: str) -> str:
    fields = [docs.schema[c] for c in keep]
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{target}` {LEAK}"])


def _search_phrases(docs: DataFrame, phrases: list[Item], keep: list[str], target: str) -> DataFrame:
    """The first place of each phrase in each text, with cosine 1."""
    by_size: dict[int, tuple[np.ndarray, list[Item]]] = {}
    for n in sorted({len(p.words) for p in phrases}):
        own = [p for p in phrases if len(p.words) == n]
        keys = np.array([gram_hashes(np.array(p.words, U64), n)[0] for p in own], U64)
        order = np.argsort(keys, kind="stable")
        by_size[n] = keys[order], [own[i] for i in order.tolist()]
    shared = docs.sparkSession.sparkContext.broadcast(by_size)  # one block of the benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            data, offs = flat(batch.column("_text"))
            leaks: list[dict[tuple[int, int], dict]] = [{} for _ in range(batch.num_rows)]
            for a, _, part, cut in chunks(data, offs):
                h, cuts = _words(part, cut)
                for n, (keys, own) in shared.value.items():
                    grams = gram_hashes(h, n)
                    lo, hi = np.searchsorted(keys, grams), np.searchsorted(keys, grams, "right")
                    place = np.flatnonzero(hi > lo)
                    row = np.searchsorted(cuts, place, "right") - 1
                    inside = place + n <= cuts[row + 1]
                    for p, r in zip(place[inside].tolist(), row[inside].tolist(), strict=True):
                        words = h[p : p + n].tolist()
                        for i in range(lo[p], hi[p]):
                            if own[i].words == words:
                                leak = {"item_id": own[i].item_id, "cosine": 1.0, "shared_words": n, "item_words": n,
                                        "answer_found": True, "start": p - int(cuts[r])}
                                leaks[a + r].setdefault((n, i), leak)
            found = pa.array([list(x.values()) for x in leaks], _LEAK_ARROW)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), found], [*keep, target])

    columns = [F.col(f"`{c}`") for c in keep]
    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(run, _schema(docs, keep, target))


def _search(docs: DataFrame, items: list[Item], keep: list[str], target: str) -> DataFrame:
    spark = docs.sparkSession
    schema = _schema(docs, keep, target)
    vocabulary = np.unique(np.array([w for i in items for w in i.words], U64))
    space = None
    if items:
        weighted = _weights(docs, vocabulary)
        space = _fit(docs, weighted, items)
        h = np.array([w for i in items for w in i.words], U64)
        cuts = np.concatenate([[0], np.cumsum([len(i.words) for i in items])])
        values = (space.basis * space.weight[:, None]).astype(np.float32)
        owner, _, vectors = space.passages(h, cuts, values)
        # The squared length is the cosine of the passage with itself in the latent space.
        vectors /= np.maximum((vectors * vectors).sum(axis=1, keepdims=True), 1e-9)
        full = FullSpace(space, h, cuts)
        # A short item fills only part of a document's passage, so its cosines count for more.
        size = np.minimum([len(i.words) for i in items], 2 * STRIDE)
        more = np.sqrt(2 * STRIDE / size)[owner]
        vectors *= more[:, None].astype(np.float32)
        full.value *= more[full.keys // full.columns]
        rare = RareWords(space, items)
        shared = spark.sparkContext.broadcast((space, values, owner, vectors, full, rare, items))  # one block of the benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, values, owner, vectors, full, rare, wanted = shared.value
        checker = Checker(wanted)
        for batch in pieces(batches, "_text"):
            data, offs = flat(batch.column("_text"))
            leaks: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for a, _, part, cut in chunks(data, offs, 1 << 17):
                h, cuts = _words(part, cut)
                at, every = own.places(h), np.arange(2 * STRIDE)
                row, start, found = own.passages(h, cuts, values, at)
                length = np.append(np.where(at >= 0, own.weight[at], own.other), 0) ** 2
                hits = []
                for x in range(0, len(vectors), 4096):
                    p, q = np.nonzero(found @ vectors[x : x + 4096].T >= LATENT_COSINE)
                    word = (cuts[row[p]] + start[p])[:, None] + every
                    word = np.where(word < cuts[row[p] + 1][:, None], word, len(h))
                    cosine = full.cosines(x + q, np.append(at, -1)[word], np.sqrt(length[word].sum(axis=1)))
                    near = cosine >= COSINE
                    hits.append((p[near], owner[x + q[near]], cosine[near]))
                p, q, cosine = (np.concatenate(c) for c in zip(*hits, strict=True))
                order = np.lexsort((-cosine, q, row[p]))
                words, done, tried = None, set(), set()

                def report(r: int, item: int, close: float, got: tuple[int, bool, int]) -> None:
                    done.add((r, item))
                    leaks[a + r].append(
                        {"item_id": wanted[item].item_id, "cosine": close, "shared_words": got[0],
                         "item_words": len(wanted[item].words), "answer_found": got[1], "start": got[2]}
                    )

                for i in order.tolist():
                    r, item, s = int(row[p[i]]), int(q[i]), int(start[p[i]])
                    if (r, item) in done or (r, item, s) in tried:
                        continue
                    tried.add((r, item, s))
                    if words is None or words[0] != r:
                        words = r, h[cuts[r] : cuts[r + 1]].tolist()
                    got = checker.check(item, words[1], s, 2 * STRIDE)
                    if got:
                        report(r, item, float(cosine[i]), got)
                for r, item, lo, hi in rare.regions(at, cuts):
                    if (r, item) in done:
                        continue
                    # The region alone, with room for an answer behind it.
                    behind = h[cuts[r] + lo : min(cuts[r] + hi + len(wanted[item].answer), cuts[r + 1])].tolist()
                    got = checker.within(item, behind, 0, hi - lo)
                    if got:
                        near = np.flatnonzero((row == r) & (start < hi) & (start + 2 * STRIDE > lo))
                        mine = np.flatnonzero(owner == item)
                        word = (cuts[r] + start[near])[:, None] + every
                        word = np.repeat(np.where(word < cuts[r + 1], word, len(h)), len(mine), axis=0)
                        close = full.cosines(np.tile(mine, len(near)), np.append(at, -1)[word], np.sqrt(length[word].sum(axis=1)))
                        report(r, item, float(close.max()), (got[0], got[1], got[2] + lo))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(leaks, _LEAK_ARROW)], [*keep, target]
            )

    columns = [F.col(f"`{c}`") for c in keep]
    if not items:
        return docs.select(*columns, F.array().cast(LEAK).alias(target))
    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all where None) and ``leaks``: the benchmark items in each document.

    A leak has item_id, the cosine of the passage that led to it, the words shared
    in order and all words of the item, whether the answer is there too, and the
    word where the stretch begins. All leaks are found, at any cosine. Words are runs of letters and digits, A-Z as
    a-z. A null or empty text has no leaks; items of fewer than MIN_WORDS words count only
    where they stand word for word, those that are null or have fewer than LEAST_WORDS
    nowhere; equal items are each reported. A column called leaks is replaced.

    A benchmark beyond BLOCK_BYTES is searched for block by block.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c != "leaks"]
    docs, names = aside(docs, kept, ["doc_id", "text"])
    texts = benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    columns = list(dict.fromkeys(["doc_id", "text", *names, "leaks"]))
    out = None
    for block in range(blocks):
        rows = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = rows.orderBy("item_id", "text").collect()
        phrases = read_phrases(rows)
        if out is None and blocks == 1 and not phrases:
            out = _search(docs, read_items(rows), names, "leaks")
            break
        out = docs.withColumn("leaks", F.array().cast(LEAK)) if out is None else out
        for search, items in ((_search, read_items(rows)), (_search_phrases, phrases)):
            if items:
                found = search(out.select(*columns), items, columns, "_more")
                out = found.withColumn("leaks", F.concat("leaks", "_more")).drop("_more")
    return out.select(*back(kept, names), "leaks")
