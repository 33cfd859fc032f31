"""An interpolated modified Kneser-Ney n-gram model, counted and applied in Spark.

Vocabulary: words are counted by hash and numbered in sorted files that workers map,
frequent ones first, so most numbers are small.

Counting: each task turns its texts into distinct n-grams of word numbers with
counts and deals them out by their context, or by the whole n-gram where all words
of the context are so frequent that the context could fill a bucket. A bucket merges
what it got, writes sorted hashes and counts as one file, and passes on, level by
level, what the next lower order needs: of each n-gram without its first word how
many words precede it (how often it occurs, where a text begins with it), and of
each context how often it was used and how many followers it had once, twice and
more. Numbers lie in the narrowest unsigned type that holds them, so counts are
exact, and travel in the order of the words, as differences, byte by byte and compressed.
A file holds only the bytes of its hashes that tell them apart, and instead of an
entry's counts the place of these in a list of all that occur.

Scoring: workers map the files and look up the distinct n-grams of a batch.
p(w | h) = (max(c(hw) - D, 0) + g(h) p(w | h without its first word)) / c(h), down to
a uniform chance for unseen words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.arrow import pieces, small_batches
from stayline.llm.files import Shelf, save
from stayline.llm.words import U64, flat, mix, spans, word_hashes
from stayline.sources.staging import checkpoint_root, stage

#: Hash of the mark after the last word (fixed value); it is a word of the vocabulary.
END = U64(0x27D4EB2F165667C5)
#: Numbers of the mark before the first word, of words that training lacks, and of the first word.
BEGIN, UNSEEN, FIRST = 0, 1, 2
#: Tokens that a task collects before it sorts and sends them, and tokens per bucket.
CHUNK = 3_000_000
PER_BUCKET = 4_000_000

#: Entries of a file for each of the groups that a search begins with, and entries whose counts have one byte.
PER_GROUP = 16
SHORT = 255

_KINDS = "bucket int, words binary, counts binary, path string, size long, kinds int, total long"
_STATISTICS = ("used", "once", "twice", "more")
_GRAMS = pa.schema(
    [("bucket", pa.int32())]
    + [(c, pa.binary()) for c in ("grams", "counts", "contexts", *_STATISTICS)]
    + [("level", pa.int32()), ("path", pa.string()), ("size", pa.int64())]
    + [("tally", pa.list_(pa.int64()))]
)
_GRAM_ROWS = (
    "bucket int, grams binary, counts binary, contexts binary, used binary, once binary, twice binary, more binary, "
    "level int, path string, size long, tally array<long>"
)


def in_training(doc_id: Column) -> Column:
    """Documents to learn from: six of seven by checksum of the id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in the narrowest unsigned type that holds them all."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max))


def _pack(x: np.ndarray) -> bytes:
    """Width, number and compressed bytes of narrow numbers: all lowest bytes first, then the next ones."""
    x = narrow(x.ravel())
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return bytes([x.itemsize]) + len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _numbers(packed: bytes) -> np.ndarray:
    width, n = packed[0], int.from_bytes(packed[1:9], "little")
    raw = pa.decompress(packed[9:], width * n, "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _unpack(table: pa.Table, name: str) -> np.ndarray:
    """All packed numbers of a column."""
    return np.concatenate([np.zeros(0, np.int64), *(_numbers(x) for x in table.column(name).to_pylist() if x is not None)])


def pack_grams(grams: np.ndarray) -> bytes:
    """Columns of numbers in the order of the numbers: each but for the column before, where all rows above are equal."""
    parts, same = [], np.ones(grams.shape[1], bool)
    for row in grams:
        step = np.where(same, np.diff(row, prepend=0), row)
        same &= step == 0
        packed = _pack(step)
        parts += [len(packed).to_bytes(8, "little"), packed]
    return b"".join(parts)


def unpack_grams(packed: bytes, rows: int) -> np.ndarray:
    out, at = [], 0
    same = None
    for _ in range(rows):
        size = int.from_bytes(packed[at : at + 8], "little")
        step = _numbers(packed[at + 8 : at + 8 + size])
        at += 8 + size
        same = np.ones(len(step), bool) if same is None else same
        row, fresh = np.cumsum(step), ~same
        fresh[:1] = True
        begin = np.flatnonzero(fresh)
        row -= np.repeat(row[begin] - step[begin], np.diff(np.append(begin, len(step))))
        same &= step == 0
        out.append(row)
    return np.stack(out)


def _all_grams(table: pa.Table, name: str, rows: int) -> np.ndarray:
    """All packed n-grams of a column."""
    parts = [unpack_grams(x, rows) for x in table.column(name).to_pylist() if x is not None]
    return np.concatenate([np.zeros((rows, 0), np.int64), *parts], axis=1)


def _in_order(grams: np.ndarray, *first: np.ndarray) -> np.ndarray:
    """The order of the columns by ``first`` and then by their numbers, which are packed into few keys."""
    rows, n = [*first, *grams], grams.shape[1]
    sizes = [int(row.max(initial=0)).bit_length() for row in rows]
    place = n.bit_length()  # bits of what the keys before say of a column
    if max(sizes) + place > 63:
        return np.lexsort(rows[::-1])
    order, key, room = None, np.zeros(n, np.int64), 63
    for row, size in zip(rows, sizes, strict=True):
        if size > room:
            own = np.argsort(key)
            order, key = own if order is None else order[own], key[own]
            new = np.ones(n, bool)
            new[1:] = key[1:] != key[:-1]
            key, room = np.cumsum(new), 63 - place
        key = key << size | (row if order is None else row[order])
        room -= size
    own = np.argsort(key)
    return own if order is None else order[own]


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text ending in END; first token of each text."""
    data, offs = flat(batch.column("text"))
    starts, ends, cuts = spans(data, offs)
    n = len(offs) - 1
    at = np.arange(n)
    tokens = np.empty(len(starts) + n, U64)
    is_end = np.zeros(len(tokens), bool)
    is_end[cuts[1:] + at] = True
    tokens[is_end] = END
    tokens[~is_end] = word_hashes(data, starts, ends, lower=True)
    return tokens, cuts[:-1] + at


def _by_bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of sorted hashes begins, and the end."""
    edges = np.arange(1, 1 << bits, dtype=U64) << U64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, a place of each, and the sums of the columns."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys[at], order[at], [np.add.reduceat(c[order], at) if len(at) else c[:0] for c in columns]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, a place of each, and where each key is among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


def table_parts(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """What a file holds of sorted distinct hashes with the same first ``bits`` bits, and of their columns.

    The next bits name a group, whose places are listed; of a hash only the last bytes are kept
    that the bits before do not tell. Entries with the same values in all columns share one place in a
    list of these, most frequent first, so most entries need a byte for it.
    """
    n = len(keys)
    group_bits = min(max(0, (n // PER_GROUP).bit_length() - 1), 64 - bits)
    more = (64 - bits - group_bits) % 8
    if (4 << group_bits + more) - (4 << group_bits) < n:  # more groups take less room than one more byte an entry
        group_bits += more
    kept = max(1, -(-(64 - bits - group_bits) // 8))
    groups = _group(keys, bits, group_bits)
    begins = np.searchsorted(groups, np.arange((1 << group_bits) + 1, dtype=U64)).astype(np.uint32)
    low = np.zeros(kept * n + 8, np.uint8)
    low[: kept * n] = keys.view(np.uint8).reshape(n, 8)[:, :kept].ravel()
    _, first, back = _distinct(gram_hashes(np.stack(columns)))
    often = np.argsort(-np.bincount(back, minlength=len(first)), kind="stable")
    rank = np.empty(len(first), np.int64)
    rank[often] = np.arange(len(first))
    code = rank[back]
    long = np.flatnonzero(code >= SHORT)
    values = [narrow(c[first[often]]) for c in columns]
    sections = [begins, low, np.minimum(code, SHORT).astype(np.uint8), long.astype(np.uint32), narrow(code[long]), *values]
    head = [n, bits, group_bits, kept, len(sections), *(x for s in sections for x in (s.itemsize, len(s)))]
    out = [np.array(head, np.int64)]
    for s in sections:
        out += [s.view(np.uint8), np.zeros(-s.nbytes % 8, np.uint8)]
    return out


def _group(keys: np.ndarray, bits: int, group_bits: int) -> np.ndarray:
    return (keys << U64(bits)) >> U64(64 - group_bits) if group_bits else np.zeros(len(keys), U64)


class Table:
    """A file as ``table_parts`` has it."""

    def __init__(self, raw: np.ndarray):
        self.n, self.bits, self.group_bits, self.kept, count = raw[:40].view(np.int64).tolist()
        sizes = raw[40 : 40 + 16 * count].view(np.int64).reshape(count, 2).tolist()
        at, parts = 40 + 16 * count, []
        for width, n in sizes:
            parts.append(raw[at : at + width * n].view(f"u{width}"))
            at += -(-width * n // 8) * 8
        self.begins, low, self.codes, self.long, self.long_codes, *self.values = parts
        self.low = np.ndarray((self.n,), "<u8", low, 0, (self.kept,))  # each with bytes of the next ones

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not stored; all have the first bits of this file."""
        mask = U64((1 << 8 * self.kept) - 1)
        group, own = _group(keys, self.bits, self.group_bits).astype(np.int64), keys & mask
        # The last entry of the group known to be less, by halved steps; before the group where there is none.
        less, last = self.begins[group].astype(np.int64) - 1, self.begins[group + 1].astype(np.int64) - 1
        for bit in reversed(range(int((last - less).max(initial=0)).bit_length())):
            probe = np.minimum(less + (1 << bit), last)
            less = np.where(self.low[probe] & mask < own, probe, less)
        at = less + 1
        hit = (at <= last) & (self.low[np.minimum(at, self.n - 1)] & mask == own)
        return np.where(hit, at, -1)

    def codes_at(self, at: np.ndarray) -> np.ndarray:
        """Where the values of entries lie in the lists of ``values``."""
        code = self.codes[at].astype(np.int64)
        long = np.flatnonzero(code == SHORT)
        code[long] = self.long_codes[np.searchsorted(self.long, at[long])]
        return code


@dataclass
class Words:
    """The vocabulary: per bucket a file of sorted hashes, their ranks by count, and from which rank on a count holds."""

    bits: int
    files: dict[int, tuple[str, int, int]]  # bucket -> file, words, distinct counts
    tokens: int

    def __post_init__(self) -> None:
        self.kinds = sum(n for _, n, _ in self.files.values())

    def find(self, tokens: np.ndarray, shelf: Shelf) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of each token; UNSEEN and 0 for those that training lacks."""
        keys, _, back = _distinct(tokens)
        number, count = np.full(len(keys), UNSEEN, np.int64), np.zeros(len(keys), np.int64)
        cuts = _by_bucket(keys, self.bits)
        for bucket, (path, n, kinds) in self.files.items():
            a, b = cuts[bucket], cuts[bucket + 1]
            if a == b:
                continue
            raw = shelf.get(path)
            stored, first, held = (raw[8 * x : 8 * y].view(U64) for x, y in ((0, n), (n, n + kinds), (n + kinds, n + 2 * kinds)))
            ranks = raw[8 * (n + 2 * kinds) :]
            at = np.searchsorted(stored, keys[a:b])
            hit = np.flatnonzero(stored[np.minimum(at, n - 1)] == keys[a:b])
            rank = ranks.view(f"u{len(ranks) // n}")[at[hit]].astype(np.int64)
            number[a + hit] = FIRST + (rank << self.bits) + bucket
            count[a + hit] = held[np.searchsorted(first, rank.astype(U64), "right") - 1]
        return number[back], count[back]


def _word_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(parts: list) -> Iterator[pa.RecordBatch]:
            kinds, _, (counts,) = _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
            cuts = _by_bucket(kinds, bits)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                at = slice(cuts[b], cuts[b + 1])
                row = {"bucket": b, "words": kinds[at].tobytes(), "counts": _pack(counts[at])}
                yield pa.RecordBatch.from_pylist([row], _KINDS_ARROW)

        parts, held = [], 0
        for batch in pieces(batches, "text"):
            parts.append(np.unique(_tokens(batch)[0], return_counts=True))
            held += len(parts[-1][0])
            if held >= CHUNK:
                yield from send(parts)
                parts, held = [], 0
        if parts:
            yield from send(parts)

    return run


_KINDS_ARROW = pa.schema(
    [("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("path", pa.string()),
     ("size", pa.int64()), ("kinds", pa.int32()), ("total", pa.int64())]
)


def _merge_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        words = np.frombuffer(b"".join(table.column("words").to_pylist()), U64)
        kinds, _, (counts,) = _summed(words, _unpack(table, "counts"))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(kinds), np.int64)
        rank[order] = np.arange(len(kinds))
        held, many = np.unique(counts, return_counts=True)
        held, many = held[::-1], many[::-1]
        parts = [kinds, (np.cumsum(many) - many).astype(U64), held.astype(U64), narrow(rank)]
        row = {"bucket": table.column("bucket")[0].as_py(), "path": save(folder, parts)}
        row |= {"size": len(kinds), "kinds": len(held), "total": int(counts.sum())}
        return pa.Table.from_pylist([row], _KINDS_ARROW)

    return run


def _vocabulary(docs: DataFrame, folder: str, bits: int) -> Words:
    rows = docs.select("text").mapInArrow(_word_rows(bits), _KINDS)
    files = rows.groupBy("bucket").applyInArrow(_merge_words(folder), _KINDS)
    found = stage(files, "word_files").collect()  # one row per bucket
    return Words(bits, {r["bucket"]: (r["path"], r["size"], r["kinds"]) for r in found}, sum(r["total"] for r in found))


def gram_hashes(grams: np.ndarray) -> np.ndarray:
    """Hash of each column of a matrix of word numbers."""
    out = np.zeros(grams.shape[1], U64)
    for row in grams:
        out = mix((out + row.astype(U64)) * U64(0x9FB21C651E98DF25) + U64(0x632BE59BD9B4E019))
    return out


def _grams(numbers: np.ndarray, counts: np.ndarray, heads: np.ndarray, order: int, begins: int):
    """The n-gram that ends at each token as a column of numbers, and the least count of its context's words."""
    place = np.arange(len(numbers)) - np.repeat(heads, np.diff(np.append(heads, len(numbers))))
    rows, least = [numbers], np.full(len(numbers), np.iinfo(np.int64).max)
    for back in range(1, order):
        inside = np.flatnonzero(place >= back)
        before, count = np.full(len(numbers), BEGIN, np.int64), np.full(len(numbers), begins)
        before[inside], count[inside] = numbers[inside - back], counts[inside - back]
        rows.append(before)
        least = np.minimum(least, count)
    return np.stack(rows[::-1]), least


def _dealt(grams: np.ndarray, least: np.ndarray, limit: int) -> np.ndarray:
    """What decides the bucket of each n-gram of the highest order."""
    if len(grams) == 1:
        return gram_hashes(grams)
    return np.where(least > limit, gram_hashes(grams), gram_hashes(grams[:-1]))


def _gram_rows(shared, order: int, bits: int, limit: int, begins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = Shelf()

        def send(parts: list) -> Iterator[pa.RecordBatch]:
            grams = np.concatenate([p[0] for p in parts], axis=1)
            least = np.concatenate([p[1] for p in parts])
            _, at, (counts,) = _summed(gram_hashes(grams), np.ones(len(least), np.int64))
            grams, least = np.take(grams, at, axis=1), least[at]
            bucket = (_dealt(grams, least, limit) >> U64(64 - bits)).astype(np.int64)
            # In the order of the words, equal numbers lie together and compress.
            at = _in_order(grams, bucket)
            edges = np.searchsorted(bucket[at], np.arange((1 << bits) + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                mine = at[edges[b] : edges[b + 1]]
                row = {"bucket": b, "grams": pack_grams(np.take(grams, mine, axis=1)), "counts": _pack(counts[mine])}
                yield pa.RecordBatch.from_pylist([row], _GRAMS)

        parts, held = [], 0
        for batch in pieces(batches, "text"):
            tokens, heads = _tokens(batch)
            parts.append(_grams(*shared.value.find(tokens, shelf), heads, order, begins))
            held += len(tokens)
            if held >= CHUNK:
                yield from send(parts)
                parts, held = [], 0
        if parts:
            yield from send(parts)

    return run


def _merge(level: int, folder: str, bits: int, common: int):
    """One bucket of n-grams with ``level`` words: its file, and what the level below needs.

    All hashes of the bucket have the same first ``common`` bits.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        done = table.select(["bucket", "level", "path", "size", "tally"]).to_pylist()
        rows = [x for x in done if x["path"] is not None]  # files of the levels above stay with their bucket
        grams, counts = _all_grams(table, "grams", level), _unpack(table, "counts")
        contexts = _all_grams(table, "contexts", level)
        known, _, statistics = _summed(gram_hashes(contexts), *(_unpack(table, c) for c in _STATISTICS))
        keys, at, (counts,) = _summed(gram_hashes(grams), counts)
        grams = np.take(grams, at, axis=1)
        every = np.sort(np.concatenate([keys, known]))
        every = every[np.append(True, every[1:] != every[:-1])[: len(every)]]
        if not len(every):
            return pa.Table.from_pylist(rows, _GRAMS)
        columns = [(keys, counts), *((known, x) for x in statistics if len(known))]
        stored = []
        for where, values in columns:
            full = np.zeros(len(every), np.int64)
            full[np.searchsorted(every, where)] = values
            stored.append(full)
        tally = [int((counts == i).sum()) for i in range(1, 5)] + [int((counts > 2).sum()), int(counts.sum())]
        rows.append(
            {"bucket": bucket, "level": level, "path": save(folder, table_parts(every, stored, common)),
             "size": len(every), "tally": tally}
        )
        if level > 1:
            weight = np.where(grams[1] == BEGIN, counts, 1)
            lower, at, (weight,) = _summed(gram_hashes(grams[1:]), weight)
            tails = np.take(grams[1:], at, axis=1)
            heads, at, sums = _summed(
                gram_hashes(grams[:-1]), counts, *(x.astype(np.int64) for x in (counts == 1, counts == 2, counts > 2))
            )
            used = np.take(grams[:-1], at, axis=1)
            a, b = _by_bucket(lower, bits), _by_bucket(heads, bits)
            for i in range(1 << bits):
                row = {}
                if a[i] < a[i + 1]:
                    x = a[i] + _in_order(tails[:, a[i] : a[i + 1]])
                    row |= {"grams": pack_grams(np.take(tails, x, axis=1)), "counts": _pack(weight[x])}
                if b[i] < b[i + 1]:
                    x = b[i] + _in_order(used[:, b[i] : b[i + 1]])
                    row |= {"contexts": pack_grams(np.take(used, x, axis=1))}
                    row |= {c: _pack(v[x]) for c, v in zip(_STATISTICS, sums, strict=True)}
                if row:
                    rows.append({"bucket": i, **row})
        return pa.Table.from_pylist(rows, _GRAMS)

    return run


def discounts(tally: list[int]) -> np.ndarray:
    """Discounts for counts 0, 1, 2, 3 and more from the numbers of counts 1 to 4.

    Where the formula has no value (a number is 0), or one that is not above 0 and at
    most the count, half, one and one and a half are taken: with a discount of 0 an
    unseen follower would have no chance.
    """
    n1, n2, n3, n4 = tally
    out = np.array([0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0]
        for count, d in enumerate(found, 1):
            if 0 < d <= count:
                out[count] = d
    return out


@dataclass
class Model:
    order: int
    bits: int
    limit: int  # count above which all words of a context are frequent
    begins: int  # training texts
    words: Words
    files: dict[int, dict[int, str]]  # level -> bucket -> file
    tallies: dict[int, list[int]]

    def discounts(self, level: int) -> np.ndarray:
        return discounts(self.tallies[level][:4])


def train(docs: DataFrame, folder: str | None = None, order: int = 3) -> Model:
    """Count all n-grams of up to ``order`` words of ``text`` in ``docs`` (null: empty), 2 or more; write the files.

    Buckets grow with the tokens and with the session's shuffle partitions. Before
    a text stand order - 1 marks; an n-gram that begins with a mark keeps its count
    on all levels, as nothing else can precede it.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or f"{checkpoint_root(spark).rstrip('/')}/ngrams-{uuid.uuid4().hex[:12]}"
    least = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = _vocabulary(docs, folder, (least - 1).bit_length())
    begins = int(words.find(np.array([END]), Shelf())[1][0])
    bits = (max(least, words.tokens // PER_BUCKET) - 1).bit_length()
    limit = words.tokens >> (bits + 2)
    shared = spark.sparkContext.broadcast(words)  # a path per bucket
    rows = docs.select("text").mapInArrow(_gram_rows(shared, order, bits, limit, begins), _GRAM_ROWS)
    for level in range(order, 0, -1):
        # Only the highest order is dealt out by other words than an n-gram's own.
        rows = rows.groupBy("bucket").applyInArrow(_merge(level, folder, bits, bits if level < order else 0), _GRAM_ROWS)
    files, tallies = {k: {} for k in range(1, order + 1)}, {k: [0] * 6 for k in range(1, order + 1)}
    for r in stage(rows, "ngram_files").collect():  # a row per level and bucket
        files[r["level"]][r["bucket"]] = r["path"]
        tallies[r["level"]] = [x + y for x, y in zip(tallies[r["level"]], r["tally"], strict=True)]
    return Model(order, bits, limit, begins, words, files, tallies)


class Scorer:
    """Looks up batches in the model's files."""

    def __init__(self, model: Model):
        self.model, self.shelf = model, Shelf()

    def _find(self, level: int, keys: np.ndarray, dealt: np.ndarray, columns: list[int]) -> list[np.ndarray]:
        """Stored columns of n-grams with ``level`` words; 0 where one is not stored."""
        keys, first, back = _distinct(keys)
        bucket = (dealt[first] >> U64(64 - self.model.bits)).astype(np.int64)
        out = [np.zeros(len(keys), np.float64) for _ in columns]
        order = np.argsort(narrow(bucket), kind="stable")
        edges = np.searchsorted(bucket[order], np.arange((1 << self.model.bits) + 1))
        for b, path in self.model.files[level].items():
            mine = order[edges[b] : edges[b + 1]]
            if not len(mine):
                continue
            table = Table(self.shelf.get(path))
            at = table.find(keys[mine])
            hit = np.flatnonzero(at >= 0)
            code = table.codes_at(at[hit])
            for values, c in zip(out, columns, strict=True):
                if c < len(table.values):
                    values[mine[hit]] = table.values[c][code]
        return [x[back] for x in out]

    def chances(self, grams: np.ndarray, least: np.ndarray, heads: np.ndarray | None = None) -> np.ndarray:
        """Chance of the last word of each column of ``grams`` after those before it.

        With ``heads`` the columns are those of all tokens of texts that begin there.
        """
        m = self.model
        p = np.full(grams.shape[1], 1 / (m.words.kinds + 1))
        context = []
        for level in range(1, m.order + 1):
            gram, d = grams[-level:], m.discounts(level)
            own = gram_hashes(gram)
            if level < m.order:
                count, *found = self._find(level, own, own, [0, 1, 2, 3, 4])
            else:
                (count,) = self._find(level, own, _dealt(gram, least, m.limit), [0])
            held = np.maximum(count - d[np.minimum(count, 3).astype(int)], 0)
            if level == 1:
                n1, n2, _, _, more, total = m.tallies[1]
                if total:
                    p = (held + (d[1] * n1 + d[2] * n2 + d[3] * more) * p) / total
            else:
                used, once, twice, more = context
                spare = d[1] * once + d[2] * twice + d[3] * more
                p = np.where(used > 0, (held + spare * p) / np.maximum(used, 1), p)
            if level < m.order:
                if heads is None:
                    before = gram_hashes(grams[-level - 1 : -1])
                    context = self._find(level, before, before, [1, 2, 3, 4])
                    continue
                # A token's context is what ends at the token before, or the marks before a text.
                marks = gram_hashes(np.full((level, 1), BEGIN))
                context = [np.append(first, x[:-1]) for x, first in zip(found, self._find(level, marks, marks, [1, 2, 3, 4]))]
                for x in context:
                    x[heads] = x[0]
        return p

    def score(self, tokens: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, ...]:
        """Known tokens, base score and log10 probability of each text."""
        m = self.model
        numbers, counts = m.words.find(tokens, self.shelf)
        base = np.log10((counts + 1) / (m.words.tokens + (m.words.kinds + 1)))
        p = self.chances(*_grams(numbers, counts, heads, m.order, m.begins), heads)
        return (
            np.add.reduceat((counts > 0).astype(np.int64), heads),
            np.add.reduceat(base, heads),
            np.add.reduceat(np.log10(p), heads),
        )


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep``, n_tokens, n_known, base_score and score of each document.

    Tokens are the words of ``text`` with A-Z lower-cased and one end; a null or
    empty text is the end alone. ``score`` is the log10 probability of the whole
    text, ``base_score`` that of an add-one unigram model.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a path per level and bucket
    fields = [docs.schema[c] for c in keep]
    added = ["n_tokens long", "n_known long", "base_score double", "score double"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in pieces(batches, "text", 12 << 20):
            tokens, heads = _tokens(batch)
            n = np.diff(np.append(heads, len(tokens)))
            found = scorer.score(tokens, heads)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(n), *map(pa.array, found)],
                [*keep, *(x.split()[0] for x in added)],
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def perplexity(log10_probability: Column, tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -log10_probability / tokens)
