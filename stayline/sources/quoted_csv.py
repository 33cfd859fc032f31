"""CSV files with line breaks inside quotes, read by many tasks.

Whether a line break ends a record depends on all quotes before it in the file. So the
lines of every block of a file (the pieces that Spark deals to tasks) are read twice:

1. Each block's number of quotes. Summed over the blocks before it, their parity tells
   whether a block begins inside quotes.
2. Each block from that state: its lines become records. The lines before its first
   record end, and those after its last, are fragments; those of neighbouring blocks are
   put together (a record may span many blocks).

Quotes must be as RFC 4180 has them: only around whole fields, doubled inside. Then the
records are those of Spark's ``multiLine`` reader, which reads a file in one task; only,
a carriage return before a line break inside quotes always stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a row of ``_split`` is: a record, or the last, a whole or the first part of a block's lines.
RECORD, TAIL, MIDDLE, HEAD = 0, 1, 2, 3
_SPLIT = "path string, start long, first boolean, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    )


def blocks_inside_quotes(lines: DataFrame) -> list[tuple[str, int, int]]:
    """(path, start, start of the block before) of the blocks that begin inside quotes.

    At most one row per block comes to the driver, which has planned the same blocks.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("path", "start").agg(F.sum(quotes).alias("quotes"))
    order = Window.partitionBy("path").orderBy("start")
    before = F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    inside = blocks.withColumns({"before": before, "last": F.lag("start").over(order)}).where("before % 2 = 1")
    return [tuple(r) for r in inside.select("path", "start", "last").collect()]


def _split(inside: set[tuple[str, int]]):
    """Lines of a partition, in the order of its blocks, to records and fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple[str, int] | None = None
        held: list[str] = []  # lines of the record that is open
        odd = False  # inside quotes
        headless = False  # the block began inside a record that has not ended yet
        fresh = True  # no record has ended in this block

        def rows(kind: int, texts: pa.Array) -> pa.RecordBatch:
            n = len(texts)
            first = np.zeros(n, bool)
            first[:1] = fresh and block[1] == 0
            columns = [pa.array([block[0]] * n, pa.string()), pa.array(np.full(n, block[1])), pa.array(first)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(n, kind, np.int32)), texts], ["path", "start", "first", "kind", "text"]
            )

        def rest_of_block() -> Iterator[pa.RecordBatch]:
            if held or headless:
                yield rows(MIDDLE if headless else TAIL, pa.array(["\n".join(held)]))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            paths, starts, values = batch.columns
            counts = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
            start, path = starts.to_numpy(), paths.dictionary_encode()
            codes = path.indices.to_numpy()
            new = np.flatnonzero((np.diff(start) != 0) | (np.diff(codes) != 0)) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
                here = (path.dictionary[codes[a]].as_py(), int(start[a]))
                if here != block:
                    if block is not None:
                        yield from rest_of_block()
                    block, held, odd = here, [], here in inside
                    headless, fresh = odd, True
                # A line that leaves no quote open ends a record.
                even = (np.cumsum(counts[a:b]) + odd) % 2 == 0
                odd = not even[-1]
                texts = values.slice(a, b - a)
                ends = np.flatnonzero(even) + 1
                if len(ends) == 0:
                    held += texts.to_pylist()
                    continue
                if held or headless:
                    line = "\n".join([*held, *texts.slice(0, ends[0]).to_pylist()])
                    yield rows(HEAD if headless else RECORD, pa.array([line]))
                    headless, fresh = False, False
                    cuts = ends
                else:
                    cuts = np.append(0, ends)
                if len(cuts) > 1:
                    lines = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), texts)
                    yield rows(RECORD, pc.binary_join(lines, "\n"))
                    fresh = False
                held = texts.slice(ends[-1]).to_pylist()
        if block is not None:
            yield from rest_of_block()

    return run


def _stitched(fragments: DataFrame) -> DataFrame:
    """Records from the fragments of neighbouring blocks: a TAIL, MIDDLEs, and a HEAD."""
    place = Window.partitionBy("path").orderBy("start", F.col("kind") == TAIL)
    chain = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(place)
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    return (
        fragments.withColumn("chain", chain)
        .groupBy("path", "chain")
        .agg(F.bool_or("first").alias("first"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """text of every record of the files at ``path``, line breaks inside quotes kept, and first: whether it begins its file.

    Empty lines are no records; a carriage return at a record's end is dropped.
    """
    lines = _lines(spark, path)
    blocks = blocks_inside_quotes(lines)
    split = _split({(file, start) for file, start, _ in blocks})
    found = lines.mapInArrow(split, _SPLIT).where(F.col("kind") == RECORD).select("first", "text")
    if blocks:
        # Fragments lie only in these blocks and in those before them: at most two rows per block.
        touched = spark.createDataFrame(
            sorted({(file, at) for file, start, last in blocks for at in (start, last)}), "path string, start long"
        )
        some = lines.join(F.broadcast(touched), ["path", "start"], "left_semi").mapInArrow(split, _SPLIT)
        found = found.unionByName(_stitched(some.where(F.col("kind") != RECORD)).select("first", "text"))
    text = F.when(F.endswith("text", F.lit("\r")), F.left("text", F.length("text") - 1)).otherwise(F.col("text"))
    text = F.when(F.col("first"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    return found.select("first", text.alias("text")).where("text <> ''")


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """The files at ``path``, all with the same header line, with all columns as text.

    Quotes are escaped by doubling. A file whose header differs from the first one's fails.
    """
    options = {"escape": '"', "multiLine": "true"}
    names = spark.read.options(header="true", **options).csv(path).columns
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    fields = F.from_csv("text", schema, options)

    def differs() -> Column:
        expected = F.array(*[F.lit(n) for n in names])
        found = F.array(*[fields[f"c{i}"] for i in range(len(names))])
        return F.when(found == expected, False).otherwise(
            F.raise_error(F.concat(F.lit("the header is not that of the first file: "), F.col("text")))
        )

    rows = records(spark, path).where(F.when(F.col("first"), differs().cast("boolean")).otherwise(True))
    return rows.select(fields.alias("f")).select(*[F.col(f"f.c{i}").alias(n) for i, n in enumerate(names)])
