from __future__ import annotations

import hashlib
import math
import random
import struct
import time
import uuid

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stayline.operators import metrics, quantile
from stayline.operators.fanout import Weights, cents
from stayline.operators.generate import AnswerStore, add_generated_text, answer
from stayline.operators.quantile import quantile_values, quantiles, sortable, unsorted
from stayline.operators.split import stratified_split


@pytest.mark.parametrize("p", [0.0, 0.5, 0.9, 1.0])
def test_quantiles_equal_pandas(spark, p):
    r = random.Random(7)
    hot = [12.34] * 300
    a = hot + [round(r.uniform(-500, 60000), 2) for _ in range(601)]
    b = [r.randint(1, 5) if r.random() < 0.8 else None for _ in a]
    c = [None] * len(a)
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b int, c double")
    got = quantiles(df, ["a", "b", "c"], p).first()
    assert got.a == pytest.approx(pd.Series(a).quantile(p), rel=1e-12)
    assert got.b == pd.Series(b, dtype="float").quantile(p)
    assert got.c is None
    assert quantiles(df.select("b"), ["b"], p).first().b == got.b


def test_quantile_of_digits_across_passes(spark):
    values = [20971.51, 20971.52, 20971.53, 41943.04, 41943.05, 1e9, -20971.53]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.25, 0.5, 0.6, 1.0):
        assert quantiles(df, ["x"], p).first().x == pytest.approx(pd.Series(values).quantile(p))


def test_quantile_of_any_range(spark):
    values = [1.0, 2.0, 1e12, 4e12, -3e12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.3, 0.5, 1.0):
        assert quantiles(df, ["x"], p).first().x == pytest.approx(pd.Series(values).quantile(p), rel=1e-15)
    assert quantiles(df.where("false"), ["x"], 0.5).first().x is None


ANY = [0.125, 1e-300, 1e300, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
       1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 0.1, 1 / 3, 8.0, math.nextafter(8.0, 0), 1e22, 0.0, float("inf")]


def test_sortable_numbers_are_the_bits_of_doubles(spark):
    r = random.Random(5)
    values = ANY + [struct.unpack("<d", struct.pack("<q", r.getrandbits(63)))[0] for _ in range(3000)]
    values += [2.0**e for e in range(-1074, 1024)] + [math.nextafter(2.0**e, 0) for e in range(-1073, 1024)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v, -v) for v in values], "x double, y double")
    got = df.select("x", "y", sortable(F.col("x")).alias("up"), sortable(F.col("y")).alias("down")).collect()
    for row in got:
        bits = struct.unpack("<q", struct.pack("<d", row.x))[0]
        assert (row.up, row.down) == (bits, -bits)
        assert unsorted(row.up) == row.x and unsorted(row.down) == row.y


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.77, 1.0])
def test_quantile_of_any_double(spark, p):
    finite = [v for v in ANY if v != float("inf")]
    for values in (finite, [-v for v in finite] + finite, [*finite, None, float("nan")], [0.125], [-0.0, 0.0, -1e-300]):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
        want = pd.Series(values, dtype="float").quantile(p)
        assert quantiles(df, ["x"], p).first().x == pytest.approx(want, rel=1e-15, abs=0)
    infinite = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "x double")
    assert quantiles(infinite, ["x"], 0.5).first().x == 1.0
    assert quantiles(infinite, ["x"], 1.0).first().x == float("inf")
    with pytest.raises(ValueError):
        quantiles(infinite, ["x"], 1.5)


def test_quantile_passes_end_on_single_values(spark):
    """Cents under a thousand need one pass after the ranges; far apart doubles need more."""
    passes = []
    real = quantile._narrow
    r = random.Random(3)
    cents = spark.createDataFrame([(r.randrange(100_000) / 100,) for _ in range(2000)], "x double")
    close = spark.createDataFrame([(1 + i * 2.0**-52,) for i in range(50)] + [(1e300,), (-1e300,)], "x double")
    try:
        quantile._narrow = lambda *a: (passes.append(1), real(*a))
        quantile_values(cents, ["x"], 0.5)
        assert len(passes) == 1
        passes.clear()
        assert quantile_values(close, ["x"], 0.5) == [1 + 24.5 * 2.0**-52]
        assert 1 < len(passes) <= 4
    finally:
        quantile._narrow = real


def test_auc_of_fine_scores(spark):
    r = random.Random(11)
    rows = [(int(r.random() < 0.4), round(r.random(), 6)) for _ in range(400)] + [(1, 1234.5), (0, -7.25)]
    positive = [s for l, s in rows if l == 1]
    negative = [s for l, s in rows if l == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    df = spark.createDataFrame([*rows, (1, None)], "label int, score double").repartition(5)
    auc = metrics.auc_of_scores(df, "label", "score").first().auc_roc
    assert auc == pytest.approx(wins / len(positive) / len(negative), rel=1e-12)


def test_cents_of_doubles_are_not_cut(spark):
    values = [0.29, 1.15, 4.35, 10.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(cents(F.col("x"))).collect()] == [29, 115, 435, 1000, None]


def test_sums_beyond_exact_doubles(spark):
    rows = [(2**53, 1, 1), (1, 1, 1), (1, 1, 1)]
    df = spark.createDataFrame(rows, "price_cents long, review_rows long, payment_rows long")
    w = Weights()
    assert df.agg(w.lines("price_cents")).first()[0] == 2**53 + 2


def test_split_equals_ranking_by_hash(spark):
    r = random.Random(3)
    rows = [(f"u{i}", int(r.random() < 1 / 3)) for i in range(1003)] + [("rare", 2), (None, 0)]
    df = spark.createDataFrame(rows, "id string, label int")
    got = {
        row.id: row.is_test
        for row in stratified_split(df.repartition(5), "label", "id", 0.2, 42).collect()
    }
    expected = {}
    for label in (0, 1, 2):
        ids = [i for i, l in rows if l == label]
        ids.sort(key=lambda i: hashlib.md5(f"{i or ''}42".encode()).hexdigest())
        size = int(0.2 * len(ids) + 0.5)
        expected |= {i: place < size for place, i in enumerate(ids)}
    assert got == expected
    other = stratified_split(df, "label", "id", 0.2, 7).where("is_test").select("id")
    assert {x.id for x in other.collect()} != {i for i, t in got.items() if t}


def _predictions(spark):
    r = random.Random(5)
    rows = []
    for _ in range(400):
        label = int(r.random() < 0.6)
        rows.append((label, float(min(100, max(0, round(r.gauss(45 + 15 * label, 20)))))))
    df = spark.createDataFrame(rows, "label int, score double")
    return rows, df.withColumn("predicted", (F.col("score") >= 50).cast("int"))


def test_auc_counts_pairs(spark):
    rows, df = _predictions(spark)
    positive = [s for l, s in rows if l == 1]
    negative = [s for l, s in rows if l == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    auc = metrics.auc_of_scores(df, "label", "score").first().auc_roc
    assert auc == pytest.approx(wins / len(positive) / len(negative), rel=1e-12)
    one_class = df.where("label = 1")
    assert metrics.auc_of_scores(one_class, "label", "score").first().auc_roc is None


def test_confusion_and_report(spark):
    rows, df = _predictions(spark)
    cells = {(a, p): 0 for a in (0, 1) for p in (0, 1)}
    for label, score in rows:
        cells[label, int(score >= 50)] += 1
    confusion = metrics.confusion_matrix(df, "label", "predicted").collect()
    assert {(r.actual, r.predicted): r.row_count for r in confusion} == cells
    assert sum(r.row_count for r in confusion) == len(rows)

    report = {r.class_name: r for r in metrics.classification_report(df, "label", "predicted").collect()}
    assert list(report) == ["Active", "Churned", "accuracy", "macro avg", "weighted avg"]
    churned = report["Churned"]
    assert churned.precision == cells[1, 1] / (cells[1, 1] + cells[0, 1])
    assert churned.recall == cells[1, 1] / (cells[1, 1] + cells[1, 0])
    assert churned.support == cells[1, 0] + cells[1, 1]
    assert report["accuracy"].f1_score == (cells[0, 0] + cells[1, 1]) / len(rows)
    assert report["weighted avg"].recall == pytest.approx(report["accuracy"].recall)


def test_report_without_predicted_positives(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, predicted int")
    churned = metrics.classification_report(df, "label", "predicted").collect()[1]
    assert (churned.precision, churned.recall, churned.f1_score) == (0.0, 0.0, 0.0)


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "y int")
    row = metrics.class_balance(df, "y").first()
    assert (row.positives, row.negatives, row.positive_pct) == (3, 1, 75.0)
    assert row.positive_weight == 1 / 3


def test_generator_failure_and_strip(spark):
    def generate(prompt: str) -> str:
        if prompt == "b":
            raise RuntimeError("no answer")
        return f"\n  {prompt.upper()} \n"

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, prompt string")
    got = add_generated_text(df, "prompt", "text", generate, "Brief unavailable")
    assert got.columns == ["id", "text"]
    assert {r.id: r.text for r in got.collect()} == {1: "A", 2: "Brief unavailable", 3: "C"}


def calls_in(folder) -> list[str]:
    """Prompts that were asked for, in files of their own as workers share nothing else."""
    return sorted(p.read_text() for p in folder.iterdir())


def asked(folder, prompt: str) -> None:
    (folder / f"{time.time_ns()}-{uuid.uuid4().hex}").write_text(prompt)


def test_a_task_that_dies_repeats_no_answered_call(spark, tmp_path):
    """The generator kills its task after three answers; the rerun asks for the others only."""
    calls, store = tmp_path / "calls", AnswerStore(f"file://{tmp_path}/answers")
    calls.mkdir()
    df = spark.range(8).select("id", F.concat(F.lit("p"), "id").alias("prompt")).coalesce(1)

    def dying(prompt: str) -> str:
        asked(calls, prompt)
        if len(list(calls.iterdir())) > 3:
            raise SystemExit("lost")
        return f" {prompt}! "

    def sound(prompt: str) -> str:
        asked(calls, prompt)
        return f" {prompt}! "

    with pytest.raises(PySparkException):
        add_generated_text(df, "prompt", "text", dying, "none", answers=store).collect()
    before = calls_in(calls)
    assert before[:3] == ["p0", "p1", "p2"]
    got = add_generated_text(df, "prompt", "text", sound, "none", answers=store)
    assert {r.id: r.text for r in got.collect()} == {i: f"p{i}!" for i in range(8)}
    after = calls_in(calls)
    assert all(after.count(p) == 1 for p in ("p0", "p1", "p2"))
    got.collect()
    assert calls_in(calls) == after
    assert not [p for p in (tmp_path / "answers").rglob("*") if "." in p.name]


def test_failed_calls_are_tried_again_and_not_stored(tmp_path, monkeypatch):
    store, waits, tries = AnswerStore(str(tmp_path / "answers")), [], []
    monkeypatch.setattr(time, "sleep", waits.append)

    def flaky(prompt: str) -> str:
        tries.append(prompt)
        if len(tries) < 3:
            raise TimeoutError
        return "done é\n"

    assert answer("a", flaky, "none", 0.5, store, attempts=2, backoff_seconds=1.0) == "none"
    assert waits == [1.0] and store.find("a") is None
    assert answer("a", flaky, "none", 0.5, store, attempts=2) == "done é" and waits == [1.0, 0.5]
    assert answer("a", flaky, "none", 0.5, store) == "done é" and len(tries) == 3
    assert store.find("a") == "done é" and store.find("b") is None


def test_the_pace_is_that_of_all_tasks(spark):
    """Two tasks at a pause of 0.1 s: each waits 0.2 s after its calls."""
    df = spark.range(6).select("id", F.lit("x").alias("prompt"))
    start = time.time()
    add_generated_text(df, "prompt", "text", lambda p: p, "none", pause_seconds=0.1, tasks=2).collect()
    assert time.time() - start >= 0.59
