from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayline.llm import queries, url_rules
from tests.llm import brute

SITES = [*queries.SITES, ("b.example.net", "", "block"), ("net", "/x", "allow"), ("Example.NET", "/x/Y", "block")]
PATTERNS = [("casino", "block"), ("ca*no", "allow"), ("/login", "block"), ("x-y", "block"), ("*", "block"), ("é", "allow"), ("--", "block")]

URLS = [
    None, "", "no scheme", "://", "http://", "https://example.org", "https://example.org/", "http://example.org/es/1",
    "http://a.b.EXAMPLE.org/es/1", "http://example.org/es", "http://example.org/en/1", "http://example.org/en/123?q=/es/",
    "http://example.org/en/2", "http://myexample.org/es/2", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/FR/1",
    "http://x.com/en/", "http://com/fr/", "http://xcom/fr/", "http://b.example.net", "http://c.b.example.net/x/Y",
    "http://example.net/x/Y#a", "http://example.net/x/y", "http://example.org:80/es/", "http://casino-win.example.com/en/1",
    "http://mycasino.example.com/", "http://example.com/Casino", "http://example.com/caXXno/login", "http://e.com/loginx",
    "HTTP://u@x-y.de/a", "http://z.de/é", "http://z.de/a--b", "http://z.de/?casino", "a\nb://example.org/es/\nz", "x://y://z.org/",
    "http://z.org#/es/", "http://z.org?x/", "http://org/", "http://İorg/",
]


def plain(url, sites, patterns):
    """host, path, rule, verdict, pattern with every rule tried on the URL."""
    u = url or ""
    at = u.find("://")
    rest = u[at + 3 :] if at >= 0 else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = brute.lower(host)
    fits = []
    for h, p, verdict in sites:
        h = h.lower()
        if (host == h or host.endswith(f".{h}")) and path.startswith(p):
            fits.append((-len(h + p), -len(h), verdict == "allow", h + p))
    if fits:
        best = min(fits)
        return host, path, best[3], "allow" if best[2] else "block", None
    subject = brute.lower(host + path)
    for text, verdict in patterns:
        body = ".*".join(map(re.escape, text.split("*")))
        left = "(?:^|[^a-z0-9])" if re.match("[a-z0-9]", text) else ""
        right = "(?:$|[^a-z0-9])" if re.search("[a-z0-9]$", text) else ""
        if re.search(left + body + right, subject, re.S):
            fits.append((-len(text), verdict == "allow", text))
    if fits:
        best = min(fits)
        return host, path, None, "allow" if best[1] else "block", best[2]
    return host, path, None, "allow", None


def pages(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(900 + i, "http://casino.example.org/es/", "h") for i in range(50)]
    rows += [(None, "http://x.com/de/1", None), (3, "http://x.com/de/1", None)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_equal_to_trying_every_rule(spark, broadcast):
    rows, table = pages(spark)
    patterns = [p for p in PATTERNS if p[0] != "*"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = url_rules.judge(table, url_rules.compile_rules(spark, SITES, patterns)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = Counter((i, u, html, *plain(u, SITES, patterns)) for i, u, html in rows)
    assert Counter(tuple(r) for r in found) == want
    assert {"allow", "block"} == {r["verdict"] for r in found}


def test_rules_are_filed_under_their_rarest_token(spark):
    _, table = pages(spark)
    patterns = [p for p in PATTERNS if p[0] != "*"]
    filed = url_rules.file_rules(url_rules.compile_rules(spark, SITES, patterns), table).collect()
    found = {r["rule"]: r["token"] for r in filed}
    # An open end is no token: /en/1 also fits /en/123.
    assert found["example.org/en/1"] == "en" and found["com/fr/"] == "fr" and found["org/"] == "org"
    assert found["ca*no"] == "" and found["é"] == "" and found["--"] == "" and found["/login"] == "login"
    assert found["x-y"] in ("x", "y") and found["casino"] == "casino"


def test_only_candidates_meet_a_regular_expression(spark):
    """A rule that cannot be compiled is never tried on URLs without its token."""
    rules = url_rules.compile_rules(spark, [("nowhere", "/", "block")]).filter("kind = 'site'")
    broken = rules.withColumn("regex", F.lit("("))
    _, table = pages(spark)
    assert {r["verdict"] for r in url_rules.judge(table, broken).collect()} == {"allow"}


def test_no_python_and_one_shuffle_of_the_pages(spark):
    _, table = pages(spark)
    judged = url_rules.judge(table, url_rules.compile_rules(spark, SITES))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_tables_clashing_names_and_bad_rules(spark):
    rows, table = pages(spark)
    names = ["url_text", "token", "rule", "verdict", "hit", "kind", "regex", "host", "kept0", "top"]
    wide = table.select("page_id", "url", *[F.lit(c).alias(c) for c in names])
    rules = url_rules.compile_rules(spark, SITES)
    found = url_rules.judge(wide, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["pattern"]) == plain(r["url"], SITES, url_rules.PATTERNS)
        assert all(r[c] == c for c in ("url_text", "token", "hit", "kind", "regex", "kept0", "top"))
    assert url_rules.judge(wide.filter("false"), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge(table, rules.filter("false")).collect()} == {"allow"}
    assert url_rules.judge(table, rules.union(rules)).count() == len(rows)
    for bad in ([("", "/", "block")], [("a/b", "", "block")], [("a", "b", "block")], [("a", "/", "maybe")]):
        with pytest.raises(ValueError):
            url_rules.compile_rules(spark, bad)
    with pytest.raises(ValueError):
        url_rules.compile_rules(spark, patterns=[("*", "block")])


def test_query_has_the_plain_result(spark, tmp_path):
    rows, table = pages(spark)
    table.write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op12_urls(spark, str(tmp_path)).collect()
    want = Counter((i, *plain(u, queries.SITES, url_rules.PATTERNS)[:4]) for i, u, _ in rows)
    assert Counter(tuple(r) for r in found) == want
