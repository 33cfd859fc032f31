"""Fill-in-the-middle training text, by a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that
never change: the document's own text and SENTINELS, which holds the three
sentinels once. Cutting splits a descriptor in two, arranging permutes descriptors
and puts sentinels between them, and the inverse permutation restores the
document; no text is copied for any of these. Digests stream over descriptors.
Starts and lengths count UTF-8 bytes.

``transform`` makes the descriptors, ``render`` spells them out, ``restore`` finds
the descriptors of a rendered text again and undoes the arrangement.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.arrow import pieces, small_batches
from stayline.llm.names import unused
from stayline.llm.words import flat

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARK = 0, 1
#: Order of (prefix, middle, suffix) in the output of each form, and the sentinel before each part.
ARRANGED = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
SENTINEL = (PREFIX, MIDDLE, SUFFIX)
PLAIN = "plain"

#: Share of texts, in percent, that are rearranged; and of these, the share with the suffix first.
RATE = 90
SPM_RATE = 20

Piece = tuple[int, int, int]
PIECES = "array<struct<buffer:byte,start:long,length:long>>"


def _mark(sentinel: bytes) -> Piece:
    return MARK, SENTINELS.index(sentinel), len(sentinel)


def cut(table: Sequence[Piece], at: Iterable[int]) -> list[Piece]:
    """Split descriptors so that one begins at each offset (bytes from the table's start, ascending).

    An offset where a descriptor already begins makes an empty one, so n offsets give n more.
    """
    out, left, done = [], list(table), 0
    for offset in at:
        while left and done + left[0][2] < offset:
            done += left[0][2]
            out.append(left.pop(0))
        buffer, start, length = left.pop(0) if left else (TEXT, 0, 0)
        out.append((buffer, start, offset - done))
        left.insert(0, (buffer, start + offset - done, length - offset + done))
        done = offset
    return out + left


def arrange(parts: Sequence[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the form's order, each behind its sentinel."""
    return [p for i in ARRANGED[form] for p in (_mark(SENTINEL[i]), parts[i])]


def undo(table: Sequence[Piece], form: str) -> list[Piece]:
    """The descriptors of ``arrange`` without sentinels, in the document's order."""
    order = ARRANGED[form]
    parts = list(table)[1::2]
    return [parts[order.index(i)] for i in range(3)]


def parse(output: bytes, form: str) -> list[Piece]:
    """Descriptors over ``output``, sentinels included, of a text written in ``form``."""
    marks = [SENTINEL[i] for i in ARRANGED[form]]
    starts = [0]
    for mark in marks[1:]:
        starts.append(output.index(mark, starts[-1] + len(mark)))
    table = []
    for mark, start, end in zip(marks, starts, [*starts[1:], len(output)]):
        if output[start : start + len(mark)] != mark:
            raise ValueError(f"text is not in the form {form}")
        table += [(TEXT, start, len(mark)), (TEXT, start + len(mark), end - start - len(mark))]
    return table


def stream(table: Iterable[Piece], text: memoryview) -> Iterator[memoryview]:
    """The bytes of each descriptor, not copied."""
    buffers = (text, memoryview(SENTINELS))
    return (buffers[buffer][start : start + length] for buffer, start, length in table)


def digest(table: Iterable[Piece], text: memoryview) -> str:
    """Hex SHA-256 of what the descriptors spell."""
    h = hashlib.sha256()
    for part in stream(table, text):
        h.update(part)
    return h.hexdigest()


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all units (a run of A-Z and a-z, or any other code point) of the texts that
    end at ``offs`` in ``data``, and the n + 1 offsets of the texts among them."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    letter = _LETTER[data]
    first = (data & 0xC0) != 0x80
    inner = letter[1:] & letter[:-1]
    first[1:] &= ~inner
    heads = offs[:-1][offs[1:] > offs[:-1]]
    first[heads] = True
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, offs)


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four reproducible numbers below 2**32 for each row, from its key."""
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hexes, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
    seed: int = 1,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` and, per row:

    n (units of the text), form (plain, psm or spm), prefix_chars and middle_chars
    (code points, null in a plain text), pieces (the output's descriptors) and
    output_sha256 (of the text that they spell).

    A null text counts as empty and a null key as the empty string. Empty texts and
    those that hold a sentinel stay plain. Equal rows are treated alike. A kept column
    that has the name of a new one is replaced by it.
    """
    small_batches(docs.sparkSession)
    kept = list(docs.columns if keep is None else keep)
    names = ["n", "form", "prefix_chars", "middle_chars", "pieces", "output_sha256"]
    fields = [f for f in docs.select(*[F.col(f"`{c}`") for c in kept]).schema.fields if f.name not in names]
    drawn = [unused(docs, f"draw{i}") for i in range(4)]
    source = unused(docs, "source_text")
    rows = docs.select(
        *[F.col(f"`{f.name}`") for f in fields],
        F.col(f"`{text}`").alias(source),
        *[d.alias(name) for d, name in zip(draws(F.col(f"`{key}`"), seed), drawn)],
    )
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
        + ["n long, form string, prefix_chars long, middle_chars long", f"pieces {PIECES}", "output_sha256 string"]
    )
    width = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, source):
            data, offs = flat(batch.column(source))
            starts, cuts = units(data, offs)
            counts = np.diff(cuts)
            h = [batch.column(name).to_numpy(zero_copy_only=False) for name in drawn]
            one, two = h[0] % (counts + 1), h[1] % (counts + 1)
            ends = np.append(starts, len(data))
            leads = np.cumsum(np.append(0, (data & 0xC0) != 0x80))
            out: list[tuple] = []
            for i in range(batch.num_rows):
                lo, hi, n = int(offs[i]), int(offs[i + 1]), int(counts[i])
                view = memoryview(data[lo:hi])
                whole = [(TEXT, 0, hi - lo)]
                held = bytes(view)
                if n == 0 or h[2][i] % 100 >= rate or any(s in held for s in SENTINEL):
                    out.append((n, PLAIN, None, None, whole, digest(whole, view)))
                    continue
                form = "spm" if h[3][i] % 100 < spm_rate else "psm"
                at = [hi if k == n else int(ends[cuts[i] + k]) for k in sorted((int(one[i]), int(two[i])))]
                table = arrange(cut(whole, [x - lo for x in at]), form)
                chars = [int(leads[b] - leads[a]) for a, b in ((lo, at[0]), (at[0], at[1]))]
                out.append((n, form, *chars, table, digest(table, view)))
            columns = [batch.column(i) for i in range(width)]
            for values, kind in zip(zip(*out), _KINDS):
                if kind is _PIECE_LIST:
                    values = [[dict(zip(("buffer", "start", "length"), p)) for p in table] for table in values]
                columns.append(pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields] + names)

    return rows.mapInArrow(run, schema)


_PIECE_LIST = pa.list_(pa.struct([("buffer", pa.int8()), ("start", pa.int64()), ("length", pa.int64())]))
_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), _PIECE_LIST, pa.string())


def _rewritten(
    df: DataFrame, text: str, name: str, work: Callable[[dict, memoryview], tuple], needs: Sequence[str]
) -> DataFrame:
    """``df`` with ``name`` (a text) and ``name``_sha256 from each row's text; a null text counts as empty."""
    small_batches(df.sparkSession)
    new = [name, f"{name}_sha256"]
    fields = [f for f in df.schema.fields if f.name not in new]
    source = unused(df, "source_text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{c}` string" for c in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, source):
            data, offs = flat(batch.column(source))
            rows = batch.select(list(needs)).to_pylist()
            found = [work(row, memoryview(data[offs[i] : offs[i + 1]])) for i, row in enumerate(rows)]
            texts = pa.array([b"".join(stream(table, view)) for table, view in found], pa.binary()).cast(pa.string())
            hashes = pa.array([digest(table, view) for table, view in found], pa.string())
            columns = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*columns, texts, hashes], [f.name for f in fields] + new)

    columns = [F.col(f"`{f.name}`") for f in fields]
    return df.select(*columns, F.col(f"`{text}`").alias(source)).mapInArrow(run, schema)


def render(transformed: DataFrame, text: str = "text") -> DataFrame:
    """``transformed`` (which keeps the text) with output, the text that its pieces spell, and its digest."""

    def work(row: dict, view: memoryview) -> tuple:
        return [(p["buffer"], p["start"], p["length"]) for p in row["pieces"] or []], view

    return _rewritten(transformed, text, "output", work, ["pieces"])


def restore(rendered: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``rendered`` with restored, the document's text, and its digest, from output and form alone.

    A null form counts as plain. A text that is not in its form is an error.
    """

    def work(row: dict, view: memoryview) -> tuple:
        if row[form] in (None, PLAIN):
            return [(TEXT, 0, len(view))], view
        return undo(parse(bytes(view), row[form]), row[form]), view

    return _rewritten(rendered, output, "restored", work, [form])
