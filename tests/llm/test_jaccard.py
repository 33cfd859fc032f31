from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from stayline.llm import jaccard
from stayline.llm.components import components
from tests.llm import brute


def result(df) -> list[tuple]:
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=key)


def expected(rows, k, percent):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted(brute.classes(rows, k, percent), key=key)


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_classes_match_brute_force_on_awkward_rows(spark, k, percent):
    rows = brute.documents()
    found = jaccard.near_duplicates(brute.table(spark, rows), k, percent)
    assert set(found.columns) == {"doc_id", "text", "lang", "source", "n_chars", "score", "n_shingles", "component_id"}
    assert result(found) == expected(rows, k, percent)


def test_crowded_space_is_joined_through_pivots_and_windows(spark, monkeypatch):
    """Chains of edits reach from ball to ball; none may be lost."""
    rng = random.Random(5)
    rows, number = [], 0
    for group in range(3):
        text = brute.prose(random.Random(group), 160)
        for _ in range(60):
            rows.append((number, text))
            number += 1
            if rng.random() < 0.6:
                text = brute.edited(rng, text, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "SAMPLE", 24)
    assert result(jaccard.near_duplicates(docs, 4, 85)) == expected(rows, 4, 85)


@pytest.mark.parametrize("steps", [(1, 4, 16), (1,)])
def test_crowded_regions_are_parted_without_sampled_pivots(spark, monkeypatch, steps):
    """Chains of edits that no sampled pivot holds, and texts that share one passage only."""
    rng = random.Random(11)
    rows, number = [], 0
    for group in range(3):
        text = brute.prose(random.Random(group + 50), 120)
        for _ in range(50):
            rows.append((number, text))
            number += 1
            if rng.random() < 0.7:
                text = brute.edited(rng, text, 2)
    passage = brute.prose(random.Random(99), 12)
    rows += [(number + i, f"{brute.prose(random.Random(1000 + i), 14)} {passage}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "CROWDED", 4)
    monkeypatch.setattr(jaccard, "STEPS", steps)
    assert result(jaccard.near_duplicates(docs, 4, 85)) == expected(rows, 4, 85)


def test_a_missed_group_makes_no_pairs(spark, monkeypatch):
    """Candidate pairs of a group grow with its members, not with their square."""
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "CROWDED", 32)
    counted = []
    real = jaccard._pair_links
    monkeypatch.setattr(jaccard, "_pair_links", lambda d, met, *a: counted.append(met.count()) or real(d, met, *a))
    for copies in (100, 400):
        text = brute.prose(random.Random(1), 200).split()
        rows = [(i, " ".join([*text[:150], f"x{i}", *text[150:]])) for i in range(copies)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = jaccard.near_duplicates(docs, 5, 80)
        assert {r["component_id"] for r in found.collect()} == {0}
    assert counted[1] <= 5 * counted[0] + 400 < 400 * 399 // 2


def test_pivots_report_all_sets_in_their_window():
    rng = np.random.default_rng(3)
    pool = np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in rng.integers(150, 290, 60)]
    pivots = jaccard.choose_pivots(list(range(1, 61)), sets, 85)
    assert len(pivots.names) > 1
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    x, q, common = pivots.near(np.concatenate(sets), cuts)
    got = {(int(a), int(pivots.names[b])): int(c) for a, b, c in zip(x, q, common, strict=True)}
    for i, s in enumerate(sets):
        for name in pivots.names.tolist():
            t = sets[name - 1]
            same = len(np.intersect1d(s, t))
            assert ((i, name) in got) == (100 * same >= 70 * (len(s) + len(t) - same))
            assert got.get((i, name), same) == same


def test_one_document_of_each_class_stays(spark):
    rows = [r for r in brute.documents(4) if r[0] != 3]  # an id on two different texts
    kept = jaccard.one_per_class(brute.table(spark, rows), 5, 80)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    want = {c for _, n, c in brute.classes(rows, 5, 80) if n}
    got = [r["doc_id"] for r in kept.collect() if brute.words(r["text"])]
    assert sorted(got) == sorted(want)
    empty = sum(1 for _, t in rows if not brute.words(t))
    assert sum(1 for r in kept.collect() if not brute.words(r["text"])) == empty


def test_empty_table_and_bounds(spark):
    docs = brute.table(spark, brute.documents()).filter("false")
    assert jaccard.near_duplicates(docs).count() == 0
    assert jaccard.one_per_class(docs).count() == 0
    with pytest.raises(ValueError):
        jaccard.near_duplicates(docs, percent=50)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["label"]) for r in found} == {(i, 0) for i in range(301)} | {(1000, 1000), (1001, 1000)}


def test_columns_with_the_names_of_internal_ones(spark):
    rows = brute.documents()[:70]
    names = ["id", "label", "least", "set_name", "node", "set", "n_shingles", "component_id", "_kept_0"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(c).alias(c) for c in names])
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    stays = jaccard.one_per_class(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in stays) == sorted(
        (r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in jaccard.one_per_class(plain).collect()
    )
    assert all(r[c] == c for r in stays for c in names)
    found = jaccard.near_duplicates(docs).collect()
    assert len(found) == len(rows) and all(r[c] == c for r in found for c in names if c not in ("n_shingles", "component_id"))
