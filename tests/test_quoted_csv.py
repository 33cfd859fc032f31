"""Files with line breaks inside quotes: any cut into blocks gives the rows of one task."""

from __future__ import annotations

import csv
import io
import random
from collections import Counter

import pytest

from stayline.sources.quoted_csv import read_quoted_csv, records
from stayline.sources.tables import read_csv_text, typed
from tests.test_plans import settings


def cell(r: random.Random) -> str:
    parts = ["a", "longer words", "\n", "\n\n", '"', ",", "", " ", "é", "\r\n", "\r", "NA", "5 \" x", "\t"]
    return "".join(r.choice(parts) for _ in range(r.choice((0, 1, 1, 2, 3, 8, 40))))


def text_of(rows, end="\n", quoting=csv.QUOTE_MINIMAL) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    return out.getvalue()


def whole_files(spark, path):
    return spark.read.options(header=True, multiLine=True, escape='"', enforceSchema=False).csv(path)


def blocks(spark, size):
    return settings(
        spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1"
    )


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_rows_as_written_and_as_the_one_task_reader_has_them(spark, tmp_path, size):
    r = random.Random(size)
    header = ["id", "said here", "note"]
    written = Counter()
    for i, end in enumerate(("\n", "\r\n", "\n")):
        rows = [(f"{i}-{k}", cell(r), cell(r)) for k in range(120)]
        written.update((a, b or None, c or None) for a, b, c in rows)
        text = text_of([header, *rows], end)
        text = text if i else text.removesuffix("\n") + "\n\n\n"  # empty lines at the end
        (tmp_path / f"part{i}.csv").write_bytes(text.encode())
    (tmp_path / "part3.csv").write_text(text_of([header]))
    with blocks(spark, size):
        got = read_quoted_csv(spark, str(tmp_path))
        want = whole_files(spark, str(tmp_path))
        assert got.columns == want.columns
        rows = Counter(map(tuple, got.collect()))
        assert rows == written
        # Spark's reader changes line breaks inside quotes where the file's lines end in both characters.
        plain = lambda found: Counter(tuple(x and x.replace("\r", "") for x in row) for row in found.elements())
        assert plain(rows) == plain(Counter(map(tuple, want.collect())))


def test_a_record_over_many_blocks_and_no_last_line_break(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    long = "\n".join(f"line {i}" for i in range(400))
    path.write_text('﻿id,comment\n1,"' + long + '"\n2,x\n3,"' + long + '"', encoding="utf-8")
    with blocks(spark, 50):
        rows = sorted(map(tuple, read_quoted_csv(spark, str(path)).collect()))
        assert rows == [("1", long), ("2", "x"), ("3", long)]
        assert records(spark, str(path)).count() == 4


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    r = random.Random(1)
    rows = [(str(i), str(r.randint(1, 5)), cell(r)) for i in range(20_000)]
    path.write_text(text_of([("order_id", "review_score", "comment"), *rows]), newline="")
    with blocks(spark, path.stat().st_size // 12):
        df = read_quoted_csv(spark, str(path))
        assert df.rdd.getNumPartitions() >= 12
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, whole_files(spark, str(path)).collect()))


def test_other_headers_fail_and_the_loader_uses_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text('order_id,review_score,comment\no1,5,"two\nlines"\no2,1,NA\n')
    rows = typed(read_csv_text(spark, str(tmp_path), multi_line=True)).orderBy("order_id").collect()
    assert [tuple(x) for x in rows] == [("o1", 5, "two\nlines"), ("o2", 1, None)]
    (tmp_path / "b.csv").write_text("order_id,comment,review_score\no3,x,5\n")
    with pytest.raises(Exception, match="header"):
        read_csv_text(spark, str(tmp_path), multi_line=True).collect()


def test_plain_and_empty_files(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("id,x\n1,a\n\n2,\n")
    assert sorted(map(tuple, read_quoted_csv(spark, str(path)).collect())) == [("1", "a"), ("2", None)]
    path.write_text("id,x\n")
    assert read_quoted_csv(spark, str(path)).collect() == []
