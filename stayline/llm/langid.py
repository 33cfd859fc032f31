"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to ORDER bytes long holds how often
each byte followed. The probability of a byte comes from the longest context
that has seen it; every shorter step pays an escape (method C: with T symbols of
q kinds seen, an escape costs q / (T + q)). Statistics are frozen after training,
so the code length of a byte depends only on its context and itself. A text gets
the language with the shortest code for all its bytes.

A language's tree is one file of sorted arrays in the shared folder, made by one
task, that workers map: all contexts of all training texts are kept, and none pass the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stayline.llm.arrow import pieces, small_batches
from stayline.llm.files import load, save
from stayline.llm.names import unused
from stayline.llm.words import chunks, flat
from stayline.sources.staging import checkpoint_root, stage

ORDER = 3
#: Languages a model may have; more in the labels is an error.
MAX_LANGUAGES = 128
UNKNOWN = "und"
#: A text is strange to its language with more than so many times the bits a byte that USUAL of the held-out
#: texts stay under. Shorter texts (in bytes), and languages with fewer such texts, say too little for that.
STRANGE = 3.0
USUAL = 0.99
LEAST_BYTES = 40
LEAST_TEXTS = 20
#: Bits of a byte in a run of context and byte: a byte is written as byte + 1, the start of a text as 0.
_DIGIT = 9


@dataclass
class Model:
    languages: list[str]
    files: list[str]


class Tree:
    """The context tree of one language.

    Per order, longest first: sorted runs (context and byte) with their code lengths, and sorted
    contexts with the code lengths of their escapes.
    """

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.orders = orders

    @classmethod
    def of(cls, run: np.ndarray, n: np.ndarray) -> Tree:
        """From the counts of runs of the longest order."""
        orders = []
        for size in range(ORDER, -1, -1):
            keys, at = np.unique(run & ((1 << _DIGIT * (size + 1)) - 1), return_inverse=True)
            seen = np.bincount(at, n, len(keys))
            contexts, first, own = np.unique(keys >> _DIGIT, return_index=True, return_inverse=True)
            kinds = np.diff(np.append(first, len(keys)))
            whole = np.add.reduceat(seen, first) + kinds
            orders.append((keys, -np.log2(seen / whole[own]), contexts, -np.log2(kinds / whole)))
        return cls(orders)

    def parts(self) -> list[np.ndarray]:
        """Arrays to write one after the other: their sizes, then they themselves."""
        arrays = [x for order in self.orders for x in order]
        return [np.array([len(x) for x in arrays], np.int64), *arrays]

    @classmethod
    def read(cls, raw: np.ndarray) -> Tree:
        n = 4 * (ORDER + 1)
        edges = np.cumsum([n, *raw[: 8 * n].view(np.int64).tolist()]) * 8
        arrays = [raw[a:b].view(np.float64 if i % 2 else np.int64) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
        return cls([tuple(arrays[i : i + 4]) for i in range(0, n, 4)])

    def bits(self, run: np.ndarray) -> np.ndarray:
        """Code length of the byte of each run after its context."""
        total = np.zeros(len(run))
        left = np.arange(len(run))
        for size, (keys, lengths, contexts, escapes) in zip(range(ORDER, -1, -1), self.orders):
            key = run[left] & ((1 << _DIGIT * (size + 1)) - 1)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            total[left[hit]] += lengths[at[hit]]
            left, context = left[~hit], key[~hit] >> _DIGIT
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            met = contexts[at] == context
            total[left[met]] += escapes[at[met]]
        total[left] += 8
        return total


def _bucket(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: every fifth by checksum of the id."""
    return _bucket(doc_id) % 5 == 0


def training_sample(docs: DataFrame, per_language: int | None = None) -> DataFrame:
    """lang and text of all labelled documents that are not held out; equal rows count once.

    With ``per_language`` at most so many a language: a first cut by hash leaves few
    more than that, so the ranking that makes the bound exact sees a bounded number of
    rows per language.
    """
    known = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("_h"))
    sizes = known.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return known.select("lang", "text")
    if per_language is None:
        return known.distinct().select("lang", "text")
    share = F.lit(0.0)
    for row in sizes:
        rate = min(1.0, (1.2 * per_language + 100) / row["count"])
        share = F.when(F.col("lang") == row["lang"], F.lit(rate)).otherwise(share)
    some = known.filter(F.pmod("_h", F.lit(1_000_000)) < share * 1_000_000).distinct()
    order = Window.partitionBy("lang").orderBy("_h", "text")
    return (
        some.withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= per_language)
        .select("lang", "text")
    )


def _histories(symbols: np.ndarray, offs: np.ndarray, start: int) -> list[np.ndarray]:
    """For each byte the one before it, two before, three before; ``start`` before a text."""
    out = []
    heads = offs[:-1]
    for back in range(1, ORDER + 1):
        h = np.empty_like(symbols)
        h[back:] = symbols[:-back] if back < len(symbols) + 1 else symbols[:0]
        for k in range(back):
            at = heads[heads + k < offs[1:]] + k
            h[at] = start
        out.append(h)
    return out


def _runs(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER before it, as one number, the oldest first."""
    symbols = data.astype(np.int64) + 1
    run = symbols.copy()
    for back, before in enumerate(_histories(symbols, offs, 0), 1):
        run |= before << (_DIGIT * back)
    return run


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (context, byte) per language."""
    for batch in pieces(batches, "text"):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            chosen = batch.filter(pa.array(langs == lang))
            data, offs = flat(chosen.column("text"))
            if len(data) == 0:
                continue
            found = [np.unique(_runs(part, cuts), return_counts=True) for _, _, part, cuts in chunks(data, offs) if len(part)]
            runs, at = np.unique(np.concatenate([r for r, _ in found]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([n for _, n in found]), len(runs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(runs)), pa.array(runs), pa.array(counts)], ["lang", "run", "n"]
            )


def train(docs: DataFrame, per_language: int | None = None) -> Model:
    """Learn from text and lang of all documents that are not held out, or of some as ``training_sample`` says.

    All contexts of these texts are kept, however few a language has. No labelled document
    gives a model without languages, which answers ``und``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = f"{checkpoint_root(spark).rstrip('/')}/languages-{uuid.uuid4().hex[:12]}"

    def write(table: pa.Table) -> pa.Table:
        tree = Tree.of(table.column("run").to_numpy(), table.column("n").to_numpy().astype(np.float64))
        return pa.table([table.column("lang").slice(0, 1), pa.array([save(folder, tree.parts())])], ["lang", "file"])

    runs = training_sample(docs, per_language).mapInArrow(_count_runs, "lang string, run long, n long")
    counted = runs.groupBy("lang", "run").agg(F.sum("n").alias("n"))
    # A language has one row per run of bytes that occurs, however often it does.
    written = stage(counted.groupBy("lang").applyInArrow(write, "lang string, file string"), "languages")
    found = sorted((r["lang"], r["file"]) for r in written.collect())
    return Model([lang for lang, _ in found], [file for _, file in found])


def code_lengths(trees: list[Tree], data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bits of each text (row) under each language (column)."""
    out = np.zeros((len(offs) - 1, len(trees)))
    if len(data) == 0:
        return out
    full = np.flatnonzero(offs[1:] > offs[:-1])
    runs, at = np.unique(_runs(data, offs), return_inverse=True)
    for i, tree in enumerate(trees):
        out[full, i] = np.add.reduceat(tree.bits(runs)[at], offs[:-1][full])
    return out


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, bits: str | None = None) -> DataFrame:
    """Columns ``keep`` (all where None), lang_pred and score of each document.

    ``bits`` names a further column: the code length a byte under that language, null for ``und``.

    ``score`` is the probability of the language given equal chances beforehand.
    A text that is null or has no letter is ``und`` with score 0. Of equal code
    lengths the first language in the alphabet wins. Columns called lang_pred, score or
    like ``bits`` are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    lettered, text = unused(docs, "lettered"), unused(docs, "source_text")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", bits)]
    fields = [docs.schema[c] for c in kept]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string", "score double"])
    schema += f", `{bits}` double" if bits else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree.read(load(file)) for file in model.files]
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in pieces(batches, text):
            data, offs = flat(batch.column(text))
            best = np.full(batch.num_rows, len(trees))
            score, rate = np.zeros((2, batch.num_rows))
            if trees:
                for a, b, part, cuts in chunks(data, offs):
                    length = code_lengths(trees, part, cuts)
                    best[a:b] = length.argmin(axis=1)
                    score[a:b] = 1 / np.exp2(length.min(axis=1, keepdims=True) - length).sum(axis=1)
                    rate[a:b] = length.min(axis=1) / np.maximum(np.diff(cuts), 1)
                known = pa.compute.fill_null(batch.column(lettered), False).to_numpy(zero_copy_only=False)
                best[~known], score[~known] = len(trees), 0
            found = [pa.array(names[best], pa.string()), pa.array(score)]
            if bits:
                found.append(pa.array(rate, mask=best == len(trees)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *found],
                [*kept, "lang_pred", "score", *([bits] if bits else [])],
            )

    columns = [F.col(f"`{c}`") for c in kept]
    return docs.select(
        *columns, F.col("text").alias(text), F.col("text").rlike(r"\p{L}").alias(lettered)
    ).mapInArrow(run, schema)


def strange_from(docs: DataFrame, model: Model) -> dict[str, float]:
    """Per language the bits a byte from which a text is strange to it, by all held-out texts with its label.

    Only texts that get their label again count. A language with fewer than LEAST_TEXTS
    of them has no entry; without labels there is none at all.
    """
    held = docs.filter(F.col("lang").isNotNull() & held_out(F.col("doc_id")) & (F.octet_length("text") >= LEAST_BYTES))
    found = predict(held.select("lang", "text"), model, keep=["lang"], bits="bits").filter("lang = lang_pred")
    usual = found.groupBy("lang").agg(F.percentile_approx("bits", USUAL, 10_000).alias("bits"), F.count("*").alias("n"))
    # At most as many rows as the model has languages.
    return {r["lang"]: STRANGE * r["bits"] for r in usual.filter(F.col("n") >= LEAST_TEXTS).collect()}


def is_strange(bits: Column, lang_pred: Column, text: Column, limits: dict[str, float]) -> Column:
    """Whether a text of LEAST_BYTES or more has more bits a byte than its language allows; never null."""
    out = F.lit(False)
    for lang, limit in sorted(limits.items()):
        out = out | ((lang_pred == lang) & (bits > limit))
    return F.coalesce(out & (F.octet_length(text) >= LEAST_BYTES), F.lit(False))
