"""URL rules, found by the rarest literal token of each.

Two kinds of rules. A site rule names a host and the start of a path; it fits that
host and its subdomains. A pattern is literal text with ``*`` for anything, found
anywhere in host and path, A-Z read as a-z. Every rule becomes one regular
expression over host and path.

A rule can only fit a URL that has all of the rule's literal tokens (runs of
letters and digits that the rule bounds on both sides). Each rule is filed under
the one of its tokens that the fewest URLs have; URLs look up their tokens, and only
the rules found so are tried as regular expressions. Rules without a token are filed
under the empty token, which every URL looks up.

Everything is DataFrame functions. URLs are judged once each: equal URLs, however
many, meet before the look-up.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.names import unused
from stayline.sources.staging import stage

ALLOW, BLOCK = "allow", "block"
SITE, PATTERN = "site", "pattern"

#: Words of gambling, pharmacy, adult, advertising and link-farm sites, as whole tokens.
PATTERNS = tuple(
    (word, BLOCK)
    for word in (
        "adult", "ads", "adserver", "bets", "betting", "casino", "doubleclick", "escort", "gambling", "jackpot",
        "pills", "poker", "porn", "slots", "spam", "viagra", "xxx",
    )
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_EDGE = "[^a-z0-9]"


def lower(text: Column) -> Column:
    """A-Z as a-z, all else unchanged."""
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; else empty."""
    return lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def tokens(text: Column) -> Column:
    """Distinct runs of a-z and 0-9."""
    return F.array_distinct(F.filter(F.split(text, f"{_EDGE}+"), lambda t: t != ""))


def _site(host: str, path: str, verdict: str) -> tuple:
    host = host.translate(_TO_LOWER)
    if "/" in host or not host or (path and not path.startswith("/")):
        raise ValueError(f"no site rule: {host!r}, {path!r}")
    end = re.escape(path) if path else r"(?:/|\z)"
    literal = f" {host}/{path[1:]}\0" if path else f" {host} "
    return f"{host}{path}", SITE, verdict, rf"\A(?:[^/]*\.)?{re.escape(host)}{end}", literal, len(host)


def _pattern(text: str, verdict: str) -> tuple:
    """A pattern that starts or ends with a letter or digit must do so at the edge of a token."""
    text = text.translate(_TO_LOWER)
    if not text.strip("*"):
        raise ValueError("a pattern needs literal text")
    body = "(?s:.*)".join(re.escape(p) for p in text.split("*"))
    left = rf"(?:\A|{_EDGE})" if re.match("[a-z0-9]", text) else ""
    right = rf"(?:\z|{_EDGE})" if re.search("[a-z0-9]$", text) else ""
    return text, PATTERN, verdict, f"{left}{body}{right}", f" {text} ".replace("*", "\0"), 0


def compile_rules(
    spark: SparkSession,
    sites: Sequence[tuple[str, str, str]] = (),
    patterns: Sequence[tuple[str, str]] = PATTERNS,
) -> DataFrame:
    """One row per rule from (host, path, verdict) and (text, verdict).

    rule, kind, verdict, regex, its complete tokens, and host_length. Larger lists of rules can
    be any DataFrame of these columns.
    """
    rows = []
    for rule, kind, verdict, regex, literal, host_length in [_site(*s) for s in sites] + [_pattern(*p) for p in patterns]:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"no verdict: {verdict}")
        # A run next to a wildcard or to a path's open end may be part of a longer token.
        closed = re.findall(r"(?<![a-z0-9\0])[a-z0-9]+(?![a-z0-9\0])", literal.translate(_TO_LOWER))
        rows.append((rule, kind, verdict, regex, sorted(set(closed)), host_length))
    return spark.createDataFrame(
        rows, "rule string, kind string, verdict string, regex string, tokens array<string>, host_length int"
    )


def _looked_up(url: Column) -> Column:
    """The tokens of a URL's host and path, the empty one first."""
    return F.concat(F.array(F.lit("")), tokens(lower(F.concat(host_of(url), path_of(url)))))


def file_rules(rules: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """``rules`` with token: of the rule's tokens the one in the fewest rows of ``pages``, ties by the alphabet.

    A token in no row is the rarest; a rule without tokens gets the empty one. Stored, so that
    what joins it knows its size.
    """
    # Stored first, so that the look-up below knows how few they are and moves no URLs.
    rules = stage(rules, "url_rules")
    asked = rules.select(F.explode("tokens").alias("token")).distinct()
    met = pages.select(F.explode(_looked_up(F.col(f"`{url}`"))).alias("token"))
    counts = met.join(asked, "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    wanted = rules.select("rule", "kind", F.explode("tokens").alias("token"))
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("rule", "kind")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))["token"].alias("token"))
    )
    filed = rules.join(rarest, ["rule", "kind"], "left").withColumn("token", F.coalesce("token", F.lit("")))
    return stage(filed.drop("tokens"), "filed_url_rules")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of ``pages``, then host, path, rule, verdict and pattern.

    Of the site rules that fit, the longest decides (ties: the longer host, then the
    alphabet) and is named in rule. Else the longest pattern that fits decides (ties:
    block, then the alphabet) and is named in pattern. Else the URL is allowed. A URL that is null or
    has no ``://`` has an empty host and path, and so no rule. ``rules`` (see ``compile_rules``) may be
    empty and hold a rule twice. A kept column that has the name of a new one is replaced by it.
    """
    new = ["host", "path", "rule", "verdict", "pattern"]
    kept = [c for c in (pages.columns if keep is None else keep) if c not in new]
    filed = file_rules(rules, pages, url)
    key = unused(pages, "url_text")
    text = F.coalesce(F.col(f"`{url}`"), F.lit("")).alias(key)
    site = F.col("kind") == SITE
    subject = F.concat("host", "path")
    first = F.struct(
        (~site).alias("no_site"),
        (-F.length("rule")).alias("size"),
        (-F.col("host_length")).alias("host_size"),
        (F.col("verdict") == ALLOW).alias("allows"),
        "rule",
    )
    # Tokens and hits of a URL stay in the partition that its equals met in.
    hits = (
        pages.select(text)
        .distinct()
        .select(key, host_of(F.col(key)).alias("host"), path_of(F.col(key)).alias("path"), F.explode(_looked_up(F.col(key))).alias("token"))
        .join(filed, "token")
        .filter(F.rlike(F.when(site, subject).otherwise(lower(subject)), F.col("regex")))
        .groupBy(key)
        .agg(F.min(first).alias("hit"))
    )
    rows = pages.select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(kept)], text)
    return rows.join(hits, key, "left").select(
        *[F.col(f"kept{i}").alias(c) for i, c in enumerate(kept)],
        host_of(F.col(key)).alias("host"),
        path_of(F.col(key)).alias("path"),
        F.when(~F.col("hit.no_site"), F.col("hit.rule")).alias("rule"),
        F.when(F.col("hit.allows") | F.col("hit").isNull(), ALLOW).otherwise(BLOCK).alias("verdict"),
        F.when(F.col("hit.no_site"), F.col("hit.rule")).alias("pattern"),
    )
