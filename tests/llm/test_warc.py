from __future__ import annotations

import base64
import hashlib

from stayline.llm import warc


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


ROWS = [
    (5, "http://a/", "<p>é\r\n\r\nWARC/1.1</p>"), (3, "http://b/ x\r\ny", "<p>é\r\n\r\nWARC/1.1</p>"),
    (9, None, "<p>é\r\n\r\nWARC/1.1</p>"), (1, "http://c/", None), (2, "http://d/", ""), (7, "http://e/", "x" * 300_000),
    (8, "http://f/", "one"), (8, "http://f/", "one"), (8, "http://f/", "one"), (10, "http://g/", "one"), (None, "http://h/", "one"),
    (None, "http://i/", "alone"),
]


def pages(spark, rows=ROWS):
    full = [(*r, f"sha{i}", -1) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "page_id long, url string, html string, digest string, `offset` int").repartition(3)


def test_pages_come_back_from_the_archives(spark):
    found = warc.read_records(warc.archive_pages(pages(spark)), max_gap=10, max_range=1000).collect()
    first = {}
    for page, _, html in ROWS:
        p = (html or "").encode()
        if page is not None:
            first[p] = min(first.get(p, page), page)
    got = sorted(
        (r["page_id"] or -1, r["record_type"], r["payload_bytes"], r["digest"], r["refers_to"] or -1) for r in found
    )
    want = []
    for page, _, html in ROWS:
        p = (html or "").encode()
        own = first.get(p) == page
        want.append((page or -1, "response" if own else "revisit", len(p), digest(p), -1 if own else first[p]))
    assert got == sorted(want)
    for r in found:
        if r["record_type"] == "response":
            assert digest(bytes(r["payload"])) == r["digest"] and len(r["payload"]) == r["payload_bytes"]
        else:
            assert r["payload"] is None


def test_index_rows_read_any_selection(spark):
    index = warc.archive_pages(pages(spark))
    assert index.columns == ["archive", "offset", "length", "page_id", "url", "digest", "record_type"]
    some = warc.read_records(index.filter("page_id in (7, 8) and record_type = 'response'")).collect()
    assert sorted(r["page_id"] for r in some) == [7, 8, 8, 8]
    assert {r["url"] for r in some} == {"http://e/", "http://f/"}
    places = sorted((r["archive"], r["offset"], r["length"]) for r in index.collect())
    for (a, x, n), (b, y, _) in zip(places, places[1:], strict=False):
        assert a != b or x + n == y


def test_payloads_below_the_bound_are_kept_and_empty_tables_work(spark):
    index = warc.archive_pages(pages(spark), min_bytes=4)
    kinds = [r["record_type"] for r in index.filter(f"digest = '{digest(b'one')}'").collect()]
    assert kinds == ["response"] * 5
    assert warc.read_records(warc.archive_pages(pages(spark).filter("false"))).count() == 0


def test_archives_roll_over(spark):
    rows = [(i, f"http://x/{i}", f"{i}" * 500) for i in range(40)]
    records = warc.deduplicated(pages(spark, rows))
    index = warc.write_archives(records, warc.checkpoint_root(spark) + "/rolled", roll_bytes=2000)
    assert index.select("archive").distinct().count() > 3
    assert {r["page_id"] for r in warc.read_records(index).collect()} == set(range(40))
