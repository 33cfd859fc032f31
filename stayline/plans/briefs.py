"""Retention briefs for the customers most at risk."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import fixed
from stayline.operators.generate import AnswerStore, add_generated_text

# Selection, prompt text and fallback.
HIGH_RISK = ("Critical", "High")
MAX_CUSTOMERS = 50
UNAVAILABLE = "Brief unavailable"
PROMPT = """You are a senior CRM analyst at a large e-commerce company.
Write a churn brief for the retention team about this customer.

Customer data:
- Total orders placed      : %s
- Lifetime spend           : $%s
- Average review score     : %s / 5
- Lowest review ever given : %s / 5
- Late delivery rate       : %s%% of their orders arrived late
- Number of late deliveries: %s
- Product categories bought: %s different categories
- Top category             : %s
- Avg payment installments : %s
- Churn risk score         : %s / 100
- Risk segment             : %s

Write exactly 3 sentences, plain paragraph, no bullet points, no headers:
Sentence 1 - WHY AT RISK: Specific reason based on their data, not generic.
Sentence 2 - RECOMMENDED ACTION: One precise retention action for this week.
Sentence 3 - REVENUE IMPACT: Cost of inaction in dollar terms.

Maximum 80 words total."""

BRIEF_COLUMNS = (
    "customer_unique_id",
    "churn_risk_score",
    "risk_segment",
    "frequency",
    "monetary",
    "avg_review_score",
    "late_delivery_pct",
    "top_category",
)


def high_risk_topk(scored: DataFrame, k: int = MAX_CUSTOMERS) -> DataFrame:
    """The ``k`` High or Critical customers with the highest score."""
    return (
        scored.where(F.col("risk_segment").isin(*HIGH_RISK))
        .orderBy(F.desc("churn_risk_score"), "customer_unique_id")
        .limit(k)
    )


def prompt_text() -> Column:
    return F.format_string(
        PROMPT,
        F.col("frequency").cast("string"),
        fixed(F.col("monetary"), 2),
        fixed(F.col("avg_review_score"), 1),
        fixed(F.col("min_review_score"), 0),
        fixed(F.col("late_delivery_pct"), 0),
        fixed(F.col("late_delivery_count"), 0),
        fixed(F.col("category_diversity"), 0),
        F.col("top_category"),
        fixed(F.col("avg_installments"), 1),
        fixed(F.col("churn_risk_score"), 0),
        F.col("risk_segment"),
    )


def headline() -> Column:
    """One line per customer for progress output."""
    return F.concat(
        F.lit("Customer "),
        F.substring("customer_unique_id", 1, 8),
        F.lit("...  risk="),
        fixed(F.col("churn_risk_score"), 0),
        F.lit("  segment="),
        F.col("risk_segment"),
    )


def brief_prompts(selected: DataFrame) -> DataFrame:
    return selected.select(
        "customer_unique_id", headline().alias("headline"), prompt_text().alias("prompt")
    )


def template_brief(prompt: str) -> str:
    """Three sentences from the prompt's own numbers; stands in for a text service."""

    def value(label: str) -> str:
        found = re.search(rf"^- {label}\s*: (.*)$", prompt, re.MULTILINE)
        if found is None:
            raise ValueError(f"prompt lacks {label!r}")
        return found.group(1)

    return (
        f"{value('Late delivery rate')} and the average review is "
        f"{value('Average review score')}. "
        f"Offer a discount on {value('Top category')} this week. "
        f"Doing nothing puts {value('Lifetime spend')} of spend at risk."
    )


def ai_briefs(
    selected: DataFrame,
    generate: Callable[[str], str] = template_brief,
    pause_seconds: float = 0.0,
    tasks: int = 1,
    answers: AnswerStore | None = None,
    attempts: int = 1,
    backoff_seconds: float = 1.0,
) -> DataFrame:
    """Nine columns: the customer's figures and the brief.

    The top-k arrives in one task; ``tasks`` spreads it when the generator is slow, at the same
    pace of calls. Without a store of ``answers``, every read of the result generates anew.
    """
    rows = selected.select(*BRIEF_COLUMNS, prompt_text().alias("prompt"))
    return add_generated_text(
        rows, "prompt", "ai_brief", generate, UNAVAILABLE, pause_seconds, tasks, answers, attempts, backoff_seconds
    )
