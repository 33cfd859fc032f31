"""Plans on random shops with gaps, repeated keys and hot keys, against plain SQL joins."""

from __future__ import annotations

import pytest

from checks.compare import mismatch
from checks.views import AS_OF
from stayline.plans import explore, features, marts
from tests.shops import duckdb_tables, random_shop, spark_tables, sql_rows

PLANS = {
    "unique_customers": explore.unique_customers,
    "orders_by_status": explore.orders_by_status,
    "top_categories_by_revenue": explore.top_categories_by_revenue,
    "review_summary": explore.review_summary,
    "repeat_vs_one_time": explore.repeat_vs_one_time,
    "late_delivery_rate": explore.late_delivery_rate,
    "rfm_base": lambda t: features.rfm_base(t, AS_OF),
    "rfm_base_dedupe": lambda t: features.rfm_base(t, AS_OF, dedupe=True),
    "executive_overview_dedupe": lambda t: marts.executive_overview_mart(t, dedupe=True),
    "preferred_payment": marts.preferred_payment,
    "category_diversity": features.category_diversity,
    "top_category": features.top_category,
    "customer_features": lambda t: features.customer_features(t, AS_OF),
    "executive_overview_mart": marts.executive_overview_mart,
    "sales_product_mart": marts.sales_product_mart,
    "customer_behavior_mart": lambda t: marts.customer_behavior_mart(t, AS_OF),
}


@pytest.mark.parametrize("seed, hot", [(1, "c o pr"), (2, "")])
def test_plans_equal_plain_joins(spark, seed, hot):
    rows = random_shop(seed, hot=hot)
    tables = spark_tables(spark, rows)
    with duckdb_tables(rows) as con:
        wrong = {
            name: difference
            for name, plan in PLANS.items()
            if (difference := mismatch(plan(tables).toPandas(), sql_rows(con, name)))
        }
    assert wrong == {}


def test_empty_shop(spark):
    rows = {name: [] for name in random_shop(1)}
    tables = spark_tables(spark, rows)
    with duckdb_tables(rows) as con:
        for name, plan in PLANS.items():
            if name in ("late_delivery_rate", "repeat_vs_one_time"):
                continue  # sums over nothing, asserted below
            ours, theirs = plan(tables).toPandas(), sql_rows(con, name)
            assert len(ours) == len(theirs), name
    assert explore.late_delivery_rate(tables).first().asDict() == {
        "total_delivered": 0,
        "late_deliveries": None,
        "late_delivery_pct": None,
    }
    assert explore.repeat_vs_one_time(tables).first().total_customers == 0
