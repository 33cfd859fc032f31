from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.stub_score import add_stub_score
from checks.views import AS_OF, StarShop
from stayline.plans import briefs, churn, features, marts
from stayline.sources.staging import stage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feature_table(spark):
    return stage(features.customer_features(StarShop(spark, SF_DIR), AS_OF), "features")


@pytest.fixture(scope="module")
def trained(feature_table):
    return churn.train(feature_table, trees=3)


def test_features_have_no_gaps(feature_table):
    assert feature_table.columns == list(features.FEATURE_COLUMNS)
    gaps = feature_table.agg(*[F.count_if(F.col(c).isNull()) for c in feature_table.columns]).first()
    assert not any(gaps)
    assert feature_table.count() == feature_table.select("customer_unique_id").distinct().count()


def test_training_scores_everyone(spark, feature_table, trained, tmp_path):
    assert 0 <= trained.auc() <= 1
    held_out = trained.held_out.count()
    assert sum(r.row_count for r in trained.confusion().collect()) == held_out
    assert held_out == pytest.approx(0.2 * feature_table.count(), abs=1)

    scored = churn.score(trained.model, feature_table)
    assert scored.columns == [
        *feature_table.columns,
        "top_category_encoded",
        "churn_risk_score",
        "risk_segment",
    ]
    assert scored.count() == feature_table.count()
    bad = "churn_risk_score < 0 or churn_risk_score > 100 or churn_risk_score is null"
    assert scored.where(bad).count() == 0

    churn.save_model(trained.model, str(tmp_path / "model"))
    again = churn.score(churn.load_model(str(tmp_path / "model")), feature_table)
    assert sorted(scored.collect()) == sorted(again.collect())


def test_importance(trained):
    rows = trained.importance().collect()
    assert {r.feature for r in rows} == set(churn.MODEL_FEATURES)
    assert sum(r.importance for r in rows) == pytest.approx(1)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert churn.feature_importance(trained.model, 5).count() == 5


def test_training_needs_both_classes(feature_table):
    with pytest.raises(ValueError):
        churn.train(feature_table.where("is_churned = 1"), trees=1)


def test_codes_follow_the_alphabet(feature_table):
    codes = {r.top_category: r.top_category_encoded for r in churn.category_codes(feature_table).collect()}
    assert [codes[c] for c in sorted(codes)] == list(range(len(codes)))


def test_topk_ties_go_by_id(spark):
    scored = spark.createDataFrame(
        [("b", 90.0, "Critical"), ("a", 90.0, "Critical"), ("c", 70.0, "High"), ("d", 60.0, "Medium")],
        "customer_unique_id string, churn_risk_score double, risk_segment string",
    )
    assert [r[0] for r in briefs.high_risk_topk(scored, 2).collect()] == ["a", "b"]
    assert [r[0] for r in briefs.high_risk_topk(scored, 9).collect()] == ["a", "b", "c"]


def test_briefs_and_churn_mart(feature_table):
    scored = stage(add_stub_score(feature_table), "scored")
    chosen = briefs.high_risk_topk(scored, 2)
    victim = chosen.orderBy("customer_unique_id").first().customer_unique_id
    score = next(r.churn_risk_score for r in chosen.collect() if r.customer_unique_id == victim)

    def generate(prompt: str) -> str:
        if f"- Churn risk score         : {score:.0f} / 100" in prompt:
            raise TimeoutError
        return f" {len(prompt)} characters\n"

    written = stage(briefs.ai_briefs(chosen, generate, tasks=2), "briefs")
    assert written.columns == [*briefs.BRIEF_COLUMNS, "ai_brief"]
    texts = {r.customer_unique_id: r.ai_brief for r in written.collect()}
    assert texts[victim] == briefs.UNAVAILABLE
    assert all(t == t.strip() for t in texts.values())

    mart = marts.churn_mart(scored, written)
    assert mart.columns == list(marts.CHURN_COLUMNS)
    rows = mart.collect()
    assert len(rows) == scored.count()
    unwritten = [r for r in rows if r.customer_unique_id not in texts]
    assert {r.ai_brief for r in unwritten} == {marts.NO_BRIEF}
    assert any(r.risk_segment in briefs.HIGH_RISK for r in unwritten)


def test_prompt_text(spark):
    row = spark.createDataFrame(
        [("u" * 20, 3, 120.5, 4.25, 2.0, 12.5, 2, 4, "toys", 1.35, 72.5, "High")],
        "customer_unique_id string, frequency bigint, monetary double, avg_review_score double, "
        "min_review_score double, late_delivery_pct double, late_delivery_count bigint, "
        "category_diversity bigint, top_category string, avg_installments double, "
        "churn_risk_score double, risk_segment string",
    )
    got = briefs.brief_prompts(row).first()
    assert got.headline == "Customer uuuuuuuu...  risk=72  segment=High"
    for line in (
        "- Total orders placed      : 3",
        "- Lifetime spend           : $120.50",
        "- Average review score     : 4.2 / 5",
        "- Lowest review ever given : 2 / 5",
        "- Late delivery rate       : 12% of their orders arrived late",
        "- Avg payment installments : 1.4",
        "- Churn risk score         : 72 / 100",
    ):
        assert line in got.prompt.splitlines()
    assert briefs.template_brief(got.prompt) == (
        "12% of their orders arrived late and the average review is 4.2 / 5. "
        "Offer a discount on toys this week. Doing nothing puts $120.50 of spend at risk."
    )
    with pytest.raises(ValueError):
        briefs.template_brief("no figures")


def test_gaps_and_new_categories_are_scored(spark, feature_table, tmp_path):
    gap = F.when(F.col("recency_days") % 3 > 0, F.col("avg_freight_paid"))
    table = stage(feature_table.withColumn("avg_freight_paid", gap), "with_gaps")
    trained = churn.train(table, trees=2)
    assert 0 <= trained.auc() <= 1
    churn.save_model(trained.model, str(tmp_path / "model"))
    new = table.withColumn("top_category", F.lit("never seen"))
    scored = churn.score(churn.load_model(str(tmp_path / "model")), new)
    codes = churn.category_codes(table).count()
    assert {r.top_category_encoded for r in scored.collect()} == {codes}
    assert scored.columns[: len(table.columns)] == table.columns
    assert scored.where("churn_risk_score is null").isEmpty()
    kept = scored.select("customer_unique_id", "avg_freight_paid").where("avg_freight_paid is null")
    assert kept.count() == table.where("avg_freight_paid is null").count()


def test_held_out_rows_do_not_change_the_model(feature_table):
    """Medians, flags and trees see training rows only."""
    rule = F.xxhash64("customer_unique_id") % 4 != 0
    gaps = stage(feature_table.withColumn("monetary", F.when(rule, F.col("monetary"))), "gaps")
    first = churn.train(gaps, trees=3)
    held_out = first.held_out.select("customer_unique_id", F.lit(True).alias("out"))
    other = gaps.join(held_out, "customer_unique_id", "left")
    changed = [
        F.when(F.col("out"), F.lit(v)).otherwise(F.col(c)).alias(c)
        if (v := {"monetary": 1e9, "avg_freight_paid": None, "avg_review_score": -5.0}.get(c, 0)) != 0
        else F.col(c)
        for c in gaps.columns
    ]
    second = churn.train(stage(other.select(*changed), "changed"), trees=3)
    assert second.model.stages[-1].toDebugString == first.model.stages[-1].toDebugString.replace(
        first.model.stages[-1].uid, second.model.stages[-1].uid
    )
    assert second.model.stages[-3].getStatement() == first.model.stages[-3].getStatement()
    assert "monetary_missing" in first.model.stages[-2].getInputCols()
    assert "avg_freight_paid_missing" not in first.model.stages[-2].getInputCols()
    importance = {r.feature: r.importance for r in first.importance().collect()}
    assert set(importance) == set(churn.MODEL_FEATURES) and sum(importance.values()) == pytest.approx(1)


def test_missing_values_are_seen_as_such(spark):
    """Whether a value is missing decides the label: the model finds it, though the median hides it."""
    rows = [(f"c{i}", i % 40, None if i % 3 == 0 else float(i % 40), int(i % 3 == 0)) for i in range(600)]
    table = spark.createDataFrame(rows, "customer_unique_id string, recency_days int, monetary double, is_churned int")
    for c in churn.MODEL_FEATURES:
        if c not in ("monetary", "top_category_encoded"):
            table = table.withColumn(c, F.lit(1.0))
    table = stage(table.withColumn("top_category", F.lit("toys")), "missing")
    trained = churn.train(table, trees=3)
    assert trained.auc() == 1.0
    scored = churn.score(trained.model, table)
    assert scored.columns == [*table.columns, "top_category_encoded", "churn_risk_score", "risk_segment"]
    assert trained.importance().first().feature == "monetary"


def test_briefs_are_written_side_by_side(spark):
    columns = {c: F.lit(1.0) for c in briefs.BRIEF_COLUMNS if c != "customer_unique_id"}
    chosen = spark.range(40).select(F.concat(F.lit("c" * 9), "id").alias("customer_unique_id")).coalesce(1)
    chosen = chosen.withColumns(columns | {"risk_segment": F.lit("High"), "top_category": F.lit("toys")})
    for name in ("min_review_score", "late_delivery_count", "category_diversity", "avg_installments"):
        if name not in chosen.columns:
            chosen = chosen.withColumn(name, F.lit(1.0))
    written = briefs.ai_briefs(chosen, lambda prompt: "text", tasks=4)
    sizes = written.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sorted(r["count"] for r in sizes) == [10, 10, 10, 10]
