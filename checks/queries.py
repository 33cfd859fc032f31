"""Every registered query: (spark, folder of check tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.stub_score import add_stub_prediction, add_stub_score
from checks.views import AS_OF, StarShop, text_dated_orders
from stayline.operators import metrics
from stayline.operators.generate import add_generated_text
from stayline.operators.quantile import quantiles
from stayline.operators.split import stratified_split
from stayline.plans import briefs, churn, explore, features, marts
from stayline.sources.sinks import export_marts, write_tables
from stayline.sources.staging import checkpoint_root, stage
from stayline.sources.tables import (
    CSV_FILES,
    ShopTables,
    date_quality,
    date_sample,
    read_csv_folder,
    read_parquet_folder,
)

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(build: Callable[[ShopTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(StarShop(spark, sf_dir))


def customer_features(t: ShopTables) -> DataFrame:
    return features.customer_features(t, AS_OF)


def _stored_features(t: ShopTables) -> DataFrame:
    return stage(customer_features(t), "customer_features")


def _scored(t: ShopTables) -> DataFrame:
    return add_stub_score(customer_features(t))


def _predicted(t: ShopTables) -> DataFrame:
    return add_stub_prediction(_scored(t))


def _median_impute(t: ShopTables) -> DataFrame:
    """Medians of the raw review columns, and how many gaps they fill."""
    raw = stage(features.rfm_base(t, AS_OF), "rfm_base")
    names = ("avg_review_score", "min_review_score")
    filled = features.fill_median(raw, names)
    medians = quantiles(raw, names, 0.5)
    one_row = raw.agg(*[F.count_if(F.col(n).isNull()).alias(f"{n}_gaps") for n in names])
    for n in names:
        total = F.sum(F.col(n).cast("decimal(18,3)")).cast("double")
        one_row = one_row.withColumns(
            {
                f"{n}_sum": filled.agg(total.alias("total")).scalar(),
                f"{n}_median": medians.select(n).scalar(),
            }
        )
    return one_row


def _rfm_segments(t: ShopTables) -> DataFrame:
    return marts.customer_behavior_mart(t, AS_OF).groupBy("rfm_segment").agg(
        F.count("*").alias("customers"),
        F.sum(F.col("lifetime_value").cast("decimal(18,2)")).cast("double").alias("value"),
    )


def _spend_tiers(t: ShopTables) -> DataFrame:
    base = marts.customer_behavior_base(t, AS_OF)
    return (
        base.groupBy(marts.spend_tier(F.col("lifetime_value")).alias("spend_tier"))
        .agg(F.count("*").alias("customers"), F.max("lifetime_value").alias("highest_value"))
    )


def _revenue_at_risk(t: ShopTables) -> DataFrame:
    risk = marts.revenue_at_risk(F.col("churn_risk_score"), F.col("monetary"))
    return _scored(t).select(
        "customer_unique_id", "churn_risk_score", "monetary", risk.alias("revenue_at_risk")
    )


def _risk_segments(t: ShopTables) -> DataFrame:
    return _scored(t).select("customer_unique_id", "churn_risk_score", "risk_segment")


def _churn_mart(t: ShopTables) -> DataFrame:
    scored = stage(_scored(t), "scored")
    return marts.churn_mart(scored, briefs.ai_briefs(briefs.high_risk_topk(scored)))


def _stratified_split(t: ShopTables) -> DataFrame:
    split = stratified_split(_stored_features(t), churn.TARGET, "customer_unique_id")
    return split.select("customer_unique_id", "is_churned", F.col("is_test").cast("int"))


def _churn_scores(t: ShopTables) -> DataFrame:
    table = _stored_features(t)
    trained = churn.train(table)
    return churn.score(trained.model, table)


def _feature_importance(t: ShopTables) -> DataFrame:
    return churn.train(_stored_features(t)).importance()


def _model_checks(t: ShopTables) -> DataFrame:
    """Facts that hold for any model of these rows; a third of them lack the freight."""
    gap = F.when(F.col("recency_days") % 3 != 0, F.col("avg_freight_paid"))
    table = stage(_stored_features(t).withColumn("avg_freight_paid", gap), "features_with_gaps")
    trained = churn.train(table)
    scored = stage(churn.score(trained.model, table), "scored")
    score, segment = F.col("churn_risk_score"), F.col("risk_segment")
    importance = trained.importance().agg(
        F.count("*").alias("inputs"), (F.abs(F.sum("importance") - 1) < 1e-9).cast("int").alias("adds_up")
    )
    ranked = metrics.auc_of_scores(trained.held_out, churn.TARGET, "churn_probability")
    agrees = int(abs(ranked.first()["auc_roc"] - trained.auc()) < 1e-9)
    cut = (F.col("churn_probability") >= 0.5).cast("int")
    folder = f"{checkpoint_root(table.sparkSession).rstrip('/')}/model-{uuid.uuid4().hex[:12]}"
    churn.save_model(trained.model, folder)
    stored = churn.score(churn.load_model(folder), table)
    flags = [c for c in trained.model.stages[-2].getInputCols() if c in churn.MISSING.values()]
    return scored.agg(
        F.count("*").alias("customers_scored"),
        F.lit(trained.held_out.count()).cast("bigint").alias("held_out_rows"),
        F.count_if(~score.between(0, 100)).alias("scores_outside"),
        F.count_if(~segment.eqNullSafe(churn.risk_segment(score))).alias("segments_off"),
        importance.select("inputs").scalar().alias("inputs"),
        importance.select("adds_up").scalar().alias("importance_adds_up"),
        F.lit(agrees).alias("auc_agrees"),
        F.lit(trained.held_out.where(~F.col("predicted").eqNullSafe(cut)).count()).cast("bigint").alias("cuts_off"),
        F.lit(scored.exceptAll(stored).count()).cast("bigint").alias("stored_model_off"),
        F.count_if(F.col("avg_freight_paid").isNull()).alias("gaps_kept"),
        F.lit(len(flags)).alias("gap_inputs"),
    )


def _sample_checks(t: ShopTables) -> DataFrame:
    """A few orders without an order of rows: how many, and how many of them are orders."""
    sample = stage(date_sample(t.orders), "date_sample")
    same = [sample[c].eqNullSafe(t.orders[c]) for c in sample.columns]
    return sample.agg(
        F.count("*").alias("sampled"),
        F.lit(sample.join(t.orders, same, "left_semi").count()).cast("bigint").alias("found"),
    )


def _generated_text(t: ShopTables) -> DataFrame:
    """What a generator pads is stripped."""
    asked = t.products.select("product_id", F.col("product_category_name").alias("prompt"))
    return add_generated_text(asked, "prompt", "text", lambda prompt: f" \n\tabout {prompt} \r\n ", "none")


def _csv_round_trip(t: StarShop) -> DataFrame:
    """The shop written as CSV, read back, stored and queried through views."""
    folder = f"{checkpoint_root(t.spark).rstrip('/')}/round-trip-{uuid.uuid4().hex[:12]}"
    sources = {
        name: getattr(t, name)
        for name in ("customers", "orders", "order_items", "payments", "reviews", "products", "category_translation")
    }
    sources["sellers"] = t.spark.read.parquet(f"{t.sf_dir}/supplier.parquet").select("s_suppkey")
    sources["geolocation"] = t.spark.read.parquet(f"{t.sf_dir}/nation.parquet").select("n_nationkey")
    export_marts({CSV_FILES[name]: df for name, df in sources.items()}, f"{folder}/csv")
    write_tables(read_csv_folder(t.spark, f"{folder}/csv").named(), f"{folder}/tables")
    read_parquet_folder(t.spark, f"{folder}/tables").register()
    no_amount, no_dates = "cast(null as double)", "cast(null as string), cast(null as string)"
    amounts = {
        "customers": no_amount,
        "order_items": "cast(sum(price) as double)",
        "payments": "cast(sum(payment_installments) as double)",
        "reviews": "cast(sum(review_score) as double)",
        "products": no_amount,
    }
    parts = [f"select '{n}', count(*), {amount}, {no_dates} from {n}" for n, amount in amounts.items()]
    text = "substring(cast({}(order_purchase_timestamp) as string), 1, 19)"
    parts.append(f"select 'orders', count(*), {no_amount}, {text.format('min')}, {text.format('max')} from orders")
    return t.spark.sql(" union all ".join(parts)).toDF("table_name", "total_rows", "amount", "first_date", "last_date")


ON_TABLES: dict[str, Callable[[ShopTables], DataFrame]] = {
    "date_quality": lambda t: date_quality(text_dated_orders(t.orders)),
    # Exploration
    "unique_customers": explore.unique_customers,
    "orders_by_status": explore.orders_by_status,
    "top_categories_by_revenue": explore.top_categories_by_revenue,
    "review_summary": explore.review_summary,
    "repeat_vs_one_time": explore.repeat_vs_one_time,
    "late_delivery_rate": explore.late_delivery_rate,
    # Features
    "rfm_base": lambda t: features.rfm_base(t, AS_OF),
    "rfm_base_dedupe": lambda t: features.rfm_base(t, AS_OF, dedupe=True),
    "category_diversity": features.category_diversity,
    "top_category": features.top_category,
    "median_impute": _median_impute,
    "customer_features": customer_features,
    # Marts
    "executive_overview_mart": marts.executive_overview_mart,
    "executive_overview_dedupe": lambda t: marts.executive_overview_mart(t, dedupe=True),
    "preferred_payment": marts.preferred_payment,
    "sales_product_mart": marts.sales_product_mart,
    "customer_behavior_mart": lambda t: marts.customer_behavior_mart(t, AS_OF),
    "rfm_segments": _rfm_segments,
    "spend_tiers": _spend_tiers,
    "churn_mart": _churn_mart,
    "revenue_at_risk": _revenue_at_risk,
    # Risk and briefs, on the stub score
    "risk_segments": _risk_segments,
    "segment_distribution": lambda t: churn.segment_distribution(_scored(t)),
    "high_risk_topk": lambda t: briefs.high_risk_topk(_scored(t)),
    "brief_prompts": lambda t: briefs.brief_prompts(briefs.high_risk_topk(_scored(t))),
    "ai_briefs": lambda t: briefs.ai_briefs(briefs.high_risk_topk(_scored(t))),
    # Model data and metrics
    "class_balance": lambda t: metrics.class_balance(customer_features(t), churn.TARGET),
    "category_codes": lambda t: churn.category_codes(_stored_features(t)),
    "stratified_split": _stratified_split,
    "auc_roc": lambda t: metrics.auc_of_scores(_scored(t), churn.TARGET, "churn_risk_score"),
    "classification_report": lambda t: metrics.classification_report(
        _predicted(t), churn.TARGET, "predicted"
    ),
    "confusion_matrix": lambda t: metrics.confusion_matrix(
        _predicted(t), churn.TARGET, "predicted"
    ),
    # Ingest and sinks
    "csv_round_trip": _csv_round_trip,
    # The real model: its scores have no SQL equivalent, facts about them do
    "model_checks": _model_checks,
    "sample_checks": _sample_checks,
    "generated_text": _generated_text,
    "churn_scores": _churn_scores,
    "feature_importance": _feature_importance,
}

QUERIES: dict[str, Query] = {name: _on_tables(build) for name, build in ON_TABLES.items()}
