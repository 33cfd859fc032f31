"""Byte-pair encoding by dynamic programming over the prefixes of a word.

The encoding of a prefix ends in exactly one token. It is the token t that is a
suffix of the prefix and that may follow the last token of the prefix before t.
An automaton over all tokens reports the suffixes of every prefix; a pair test
picks the one that is compatible; its length is the back-pointer. Following the
pointers from the end gives the ids that merging in rank order would give.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from stayline.llm.arrow import pieces, release, small_batches

#: Words and pairs a worker remembers before it starts afresh.
CACHE = 400_000
_NONE = 1 << 60

#: The split pattern and normalizers that have a fast path (fixed values of the tokenizer file).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_LATIN = [chr(i) for i in range(0x250)]
_SPACES = "\\t-\\r \\x85\\xa0"
_LETTERS = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
_WORD = re.compile(
    f"[{_LETTERS}]+|[{_NUMBERS}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)
_ASCII_WORD = re.compile(r"[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\t-\r a-z0-9]+")
_NOT_LATIN = re.compile("[^\x00-ɏ]")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Codec:
    """Encoder and decoder made from the JSON text of a tokenizer file.

    A word is handled as a string of symbols: one per byte, and where the
    vocabulary marks word ends, the last symbol of a word is another one.
    """

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.json = text
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.joiner = " " if spec["decoder"] is None else ""
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        n = max(self.strings) + 1
        self.rank = [-1] * n
        self.left = [-1] * n
        self.right = [-1] * n
        self.merged: dict[int, int] = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank[z], self.left[z], self.right[z] = rank, x, y
            self.merged[x << 32 | y] = rank
        normalizers = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.simple = (
            normalizers == WORD_NORMALIZERS
            and splits[0].get("pattern") == {"Regex": WORD_PATTERN}
            and [x["type"] for x in splits] == ["Split", "ByteLevel"]
        )
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.json)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Reports, for every end in a string of symbols, all tokens that end there."""
        found = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            body = token.removesuffix(self.suffix) if self.suffix else token
            symbols = "".join(chr(self.byte_of[c]) for c in body)
            if self.suffix and body != token:
                symbols = symbols[:-1] + chr(ord(symbols[-1]) + 256)
            found.add_word(symbols, (len(symbols), i))
        found.make_automaton()
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the symbols of tokens a and b ends in just these two.

        Goes back in time along the right edge of a and the left edge of b: two
        edge parts that exist together and have a merge that comes before each of
        them is used up would have been merged. Of equal ranks the left goes first.
        """
        key = a << 32 | b
        rank, merged = self.rank, self.merged
        left_until = right_until = _NONE
        good = True
        while True:
            r = merged.get(a << 32 | b, _NONE)
            if r < left_until and r <= right_until and r != _NONE:
                good = False
                break
            if rank[a] < 0 and rank[b] < 0:
                break
            if rank[a] > rank[b]:
                left_until = rank[a]
                a = self.right[a]
            else:
                right_until = rank[b]
                b = self.left[b]
        if len(self.pairs) >= CACHE * 2:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word given as bytes."""
        symbols = raw.decode("latin-1")
        if self.suffix:
            symbols = symbols[:-1] + chr(raw[-1] + 256)
        n = len(symbols)
        last = [-1] * (n + 1)  # the last token of the encoding of each prefix
        back = [0] * (n + 1)
        pairs, compatible, done = self.pairs, self.compatible, -1
        for end, (size, token) in self.automaton.iter(symbols):
            if end == done:  # this prefix has its token; shorter suffixes follow
                continue
            before = end + 1 - size
            if before:
                key = last[before] << 32 | token
                fits = pairs[key] if key in pairs else compatible(last[before], token)
            else:
                fits = True
            if fits:
                last[end + 1], back[end + 1], done = token, before, end
        if done != n - 1:
            raise ValueError("no token fits; the vocabulary lacks single symbols")
        ids = []
        while n:
            ids.append(last[n])
            n = back[n]
        return ids[::-1]

    def split(self, text: str) -> list[str] | None:
        """The words of a text that the fast path covers, else None."""
        if not self.simple:
            return None
        if text.isascii():
            return _ASCII_WORD.findall(text.lower())
        if _NOT_LATIN.search(text):
            return None
        low = text.lower()
        return None if _NOT_LATIN.search(low) else _WORD.findall(low)

    def _packed(self, word: str) -> bytes:
        return np.array(self.word(word.encode()), "<u4").tobytes()

    def _part(self, text: str) -> bytes:
        words = self.split(text)
        if words is None:
            normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
            found = self.library.pre_tokenizer.pre_tokenize_str(normal)
            return b"".join(
                np.array(self.word(bytes(self.byte_of[c] for c in w)), "<u4").tobytes() for w, _ in found
            )
        known = self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        if len(known) >= CACHE:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = self._packed(w)
        return b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.special_split is None or "<" not in text:
            return self._part(text)
        out = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.append(self._part(part))
        return b"".join(out)

    @cached_property
    def table(self) -> list[str]:
        return [self.strings.get(i, "") for i in range(max(self.strings) + 1)]

    def decode(self, ids: bytes) -> str:
        """Tokens as the file writes them, joined as the library does without a decoder."""
        return self.joiner.join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[str, Codec] = {}


def codec(text: str) -> Codec:
    """One codec per worker and tokenizer file."""
    if text not in _codecs:
        _codecs[text] = Codec(text)
    return _codecs[text]


def _mapped(df: DataFrame, source: str, target: str, kind: str, tokenizer: str, keep: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())  # one vocabulary file, a few MB at most
    kept = [c for c in (df.columns if keep is None else keep) if c != target]
    fields = [df.schema[c] for c in kept]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{target}` {kind}"])
    method = "encode" if kind == "binary" else "decode"
    arrow = pa.binary() if kind == "binary" else pa.large_string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = getattr(codec(spec.value), method)
        empty = "" if method == "encode" else b""
        try:
            for batch in pieces(batches, source):
                done = [one(x or empty) for x in batch.column(source).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(done, arrow)], [*kept, target]
                )
        finally:
            del one
            _codecs.clear()
            release()

    columns = list(dict.fromkeys([*kept, source]))
    return df.select(*[f"`{c}`" for c in columns]).mapInArrow(run, schema)


def encode(
    df: DataFrame, tokenizer: str, source: str = "text", target: str = "token_ids", keep: list[str] | None = None
) -> DataFrame:
    """Columns ``keep`` (all where None) and ``target``: the ids of ``source``.

    Ids are packed as little-endian unsigned 32-bit integers. A null or empty
    text has none. A column already called ``target`` is replaced.
    """
    return _mapped(df, source, target, "binary", tokenizer, keep)


def decode(
    df: DataFrame, tokenizer: str, source: str = "token_ids", target: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """Columns ``keep`` (all where None) and ``target``: the text of packed ids; null gives an empty text."""
    return _mapped(df, source, target, "string", tokenizer, keep)
