"""The whole batch: load, features, training, briefs, marts.

    python -m stayline.plans.batch --input CSV_FOLDER --output FOLDER

Every run writes a version of its own below FOLDER, which is published when all of it
is there: until then readers see the version before (``publish.published``). Every stage
writes its tables before the next one reads them; a run that failed goes on, when it is
started again with the same files and parameters, after the last finished stage.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.generate import AnswerStore
from stayline.plans import churn, marts
from stayline.plans.briefs import MAX_CUSTOMERS, ai_briefs, high_risk_topk, template_brief
from stayline.plans.features import AS_OF, CHURN_DAYS, customer_features
from stayline.session import build_session
from stayline.sources.bucketed import BucketStore
from stayline.sources.publish import KEEP, Folder, Version, open_version, published
from stayline.sources.sinks import export_marts, write_csv, write_table
from stayline.sources.staging import scratch
from stayline.sources.tables import (
    CSV_FILES,
    MULTI_LINE_TABLES,
    ShopTables,
    StoredShop,
    read_csv_text,
    read_parquet_folder,
    typed_and_checked,
)

# Shuffled bytes a task should handle, and how much larger joined rows are than their files.
TASK_BYTES = 128 << 20
GROWTH = 4
# Calls of the generator per brief, if they fail.
BRIEF_ATTEMPTS = 3


@dataclass(frozen=True)
class BatchResult:
    """``skipped`` names the stages that an earlier run had finished; ``path`` holds the outputs."""

    table_rows: dict[str, int]
    unparsed_dates: dict[str, int]
    feature_rows: int
    auc: float
    scored_rows: int
    brief_rows: int
    mart_shapes: dict[str, tuple[int, int]]
    path: str = ""
    skipped: tuple[str, ...] = ()


def load(spark: SparkSession, csv_folder: str, folder: str) -> tuple[dict[str, int], dict[str, int]]:
    """CSV files to Parquet tables; their row counts, and per date column the texts that name no moment.

    Each file is read once: the dates are checked as the rows pass.
    """
    rows, unparsed = {}, {}
    for name, file in CSV_FILES.items():
        raw = read_csv_text(spark, f"{csv_folder.rstrip('/')}/{file}", name in MULTI_LINE_TABLES)
        table, seen = typed_and_checked(raw)
        rows[name] = write_table(table, f"{folder}/{name}")
        if seen is not None:
            unparsed |= seen.get
    return rows, unparsed


def size_shuffles(tables: ShopTables) -> int:
    """Raise the session's shuffle partitions to the size of the stored tables.

    Adaptive execution merges partitions that are too small, but makes no more.
    """
    spark = tables.orders.sparkSession
    size = sum(
        int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        for df in tables.named().values()
    )
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), GROWTH * size // TASK_BYTES)
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def _stored(df: DataFrame, path: str) -> int:
    """Write a table and its CSV copy; its rows."""
    rows = write_table(df, path)
    write_csv(df.sparkSession.read.schema(df.schema).parquet(path), f"{path}.csv")
    return rows


def build_marts(
    t: ShopTables, scored: DataFrame, briefs: DataFrame, as_of: datetime, folder: str
) -> dict[str, DataFrame]:
    """The four marts by file name; two of them share one stored fact table."""
    facts = marts.sales_facts(t)
    write_table(facts, f"{folder}/sales_facts")
    facts = scored.sparkSession.read.schema(facts.schema).parquet(f"{folder}/sales_facts")
    return {
        marts.EXECUTIVE_FILE: marts.executive_overview_mart(t),
        marts.SALES_FILE: marts.sales_product_mart(t, facts),
        marts.BEHAVIOR_FILE: marts.customer_behavior_mart(t, as_of, facts),
        marts.CHURN_FILE: marts.churn_mart(scored, briefs),
    }


def changed_orders(t: ShopTables) -> DataFrame:
    """The orders that any of the tables names."""
    named = [df.select("order_id") for df in (t.orders, t.order_items, t.payments, t.reviews)]
    return reduce(DataFrame.unionByName, named).where(F.col("order_id").isNotNull()).distinct()


def run_batch(
    spark: SparkSession,
    csv_folder: str,
    out_folder: str,
    as_of: datetime = AS_OF,
    churn_days: float = CHURN_DAYS,
    trees: int = churn.TREES,
    max_customers: int = MAX_CUSTOMERS,
    generate: Callable[[str], str] = template_brief,
    pause_seconds: float = 0.0,
    brief_tasks: int = 1,
    keep: int = KEEP,
    changes_only: bool = False,
) -> BatchResult:
    """The whole batch into a new version of ``out_folder``, published at the end.

    Stages that a failed run with the same files and parameters has finished are skipped.
    ``brief_tasks`` generator calls run side by side, ``pause_seconds`` apart over all of them; no
    answer is asked for twice. ``keep`` published versions are kept, older ones removed.

    With ``changes_only`` the CSV files hold new and changed orders only, each with all its items,
    payments and reviews, and the customers, products and categories that these name. Their totals
    are added to those of the published version, whose files are read where they lie; an order
    that a delivery names replaces the earlier one. The version's ``tables`` are then the delivery's.
    """
    # What changes the outputs. The generator is code: a rerun with another one keeps finished briefs.
    run = {
        "files": Folder(spark, csv_folder).listing(),
        "as_of": as_of.isoformat(),
        "churn_days": churn_days,
        "trees": trees,
        "max_customers": max_customers,
    }
    earlier = None
    if changes_only:
        earlier = published(spark, out_folder)
        if earlier is None:
            raise FileNotFoundError(f"no published batch in {out_folder} to add changes to")
        run["uses"] = [*earlier.uses(), earlier.name]
    version = open_version(spark, out_folder, run)
    with scratch(spark):
        result = _run_stages(
            spark, version, earlier, csv_folder, as_of, churn_days, trees, max_customers, generate, pause_seconds, brief_tasks
        )
    version.publish(keep)
    return result


def _run_stages(
    spark: SparkSession,
    version: Version,
    earlier: Version | None,
    csv_folder: str,
    as_of: datetime,
    churn_days: float,
    trees: int,
    max_customers: int,
    generate: Callable[[str], str],
    pause_seconds: float,
    brief_tasks: int,
) -> BatchResult:
    out = version.path
    before = earlier.facts("tables") if earlier else None

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}")

    def tables_stage() -> dict:
        rows, unparsed = load(spark, csv_folder, f"{out}/tables")
        facts = {"rows": rows, "unparsed": unparsed}
        if before:
            return {**facts, "buckets": before["buckets"], "delivery": before["delivery"] + 1}
        return {**facts, "buckets": size_shuffles(read_parquet_folder(spark, f"{out}/tables")), "delivery": 0}

    loaded = version.stage("tables", tables_stage)
    # A rerun, or a run on changes, goes on with the buckets of the run before.
    spark.conf.set("spark.sql.shuffle.partitions", str(loaded["buckets"]))
    tables = read_parquet_folder(spark, f"{out}/tables")
    # Features and marts start from the same joins and totals; each is made once.
    store = BucketStore(
        spark,
        f"{out}/base",
        "order_id",
        loaded["buckets"],
        loaded["delivery"],
        f"{earlier.path}/base" if earlier else None,
        partial(changed_orders, tables) if earlier else None,
    )
    tables = StoredShop.over(tables, store)

    def features_stage() -> dict:
        return {"rows": _stored(customer_features(tables, as_of, churn_days), f"{out}/customer_features")}

    def model_stage() -> dict:
        trained = churn.train(read("customer_features"), trees)
        churn.save_model(trained.model, f"{out}/churn_model")
        write_table(trained.report(), f"{out}/classification_report")
        write_table(trained.confusion(), f"{out}/confusion_matrix")
        write_table(trained.importance(), f"{out}/feature_importance")
        return {"auc": trained.auc()}

    def scores_stage() -> dict:
        model = churn.load_model(f"{out}/churn_model")
        return {"rows": _stored(churn.score(model, read("customer_features")), f"{out}/customer_scores")}

    def briefs_stage() -> dict:
        selected = high_risk_topk(read("customer_scores"), max_customers)
        # A run that goes on finds the answers that this one has received.
        answers = AnswerStore(f"{out}/answers")
        written = ai_briefs(selected, generate, pause_seconds, brief_tasks, answers, BRIEF_ATTEMPTS)
        return {"rows": _stored(written, f"{out}/churn_briefs")}

    def marts_stage() -> dict:
        built = build_marts(tables, read("customer_scores"), read("churn_briefs"), as_of, out)
        return {"shapes": export_marts(built, f"{out}/marts", marts.mart_order())}

    try:
        features = version.stage("features", features_stage)
        model = version.stage("model", model_stage)
        scores = version.stage("scores", scores_stage)
        briefs = version.stage("briefs", briefs_stage)
        exported = version.stage("marts", marts_stage)
    finally:
        store.close()
    return BatchResult(
        loaded["rows"],
        loaded["unparsed"],
        features["rows"],
        model["auc"],
        scores["rows"],
        briefs["rows"],
        {name: tuple(shape) for name, shape in exported["shapes"].items()},
        out,
        tuple(version.skipped),
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder with the nine CSV files")
    parser.add_argument("--output", required=True, help="folder for tables, model and marts")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=AS_OF)
    parser.add_argument("--churn-days", type=float, default=CHURN_DAYS)
    parser.add_argument("--trees", type=int, default=churn.TREES)
    parser.add_argument("--max-customers", type=int, default=MAX_CUSTOMERS)
    parser.add_argument("--changes-only", action="store_true", help="input holds new and changed orders only")
    parser.add_argument("--brief-tasks", type=int, default=1, help="generator calls side by side")
    args = parser.parse_args()
    spark = build_session("retention batch")
    result = run_batch(
        spark,
        args.input,
        args.output,
        args.as_of,
        args.churn_days,
        args.trees,
        args.max_customers,
        brief_tasks=args.brief_tasks,
        changes_only=args.changes_only,
    )
    print(result)


if __name__ == "__main__":
    main()
