"""Score customers with the model of the last published batch, without training.

    python -m stayline.plans.scoring --model BATCH_FOLDER --input CSV_FOLDER --output FOLDER
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from stayline.plans import churn
from stayline.plans.batch import load, size_shuffles
from stayline.plans.features import AS_OF, customer_features
from stayline.session import build_session
from stayline.sources.publish import KEEP, Folder, Version, open_version, published
from stayline.sources.sinks import write_csv, write_table
from stayline.sources.staging import scratch
from stayline.sources.tables import read_parquet_folder


def score_batch(
    spark: SparkSession, model_folder: str, csv_folder: str, out_folder: str, as_of: datetime = AS_OF, keep: int = KEEP
) -> Version:
    """Features and scores of the customers in ``csv_folder``, published as a version of ``out_folder``.

    The model is that of the version of ``model_folder`` published when the run begins; a run that
    failed goes on with the same model, as long as no other has been published since.
    """
    trained = published(spark, model_folder)
    if trained is None:
        raise FileNotFoundError(f"no published batch in {model_folder}")
    run = {"model": trained.path, "files": Folder(spark, csv_folder).listing(), "as_of": as_of.isoformat()}
    version = open_version(spark, out_folder, run)
    out = version.path

    def tables_stage() -> dict:
        rows, _ = load(spark, csv_folder, f"{out}/tables")
        return {"rows": rows}

    def features_stage() -> dict:
        tables = read_parquet_folder(spark, f"{out}/tables")
        size_shuffles(tables)
        return {"rows": write_table(customer_features(tables, as_of), f"{out}/customer_features")}

    def scores_stage() -> dict:
        model = churn.load_model(f"{trained.path}/churn_model")
        scored = churn.score(model, spark.read.parquet(f"{out}/customer_features"))
        rows = write_table(scored, f"{out}/customer_scores")
        write_csv(spark.read.parquet(f"{out}/customer_scores"), f"{out}/customer_scores.csv")
        return {"rows": rows}

    with scratch(spark):
        version.stage("tables", tables_stage)
        version.stage("features", features_stage)
        version.stage("scores", scores_stage)
    version.publish(keep)
    return version


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--model", required=True, help="output folder of the batch")
    parser.add_argument("--input", required=True, help="folder with the nine CSV files")
    parser.add_argument("--output", required=True, help="folder for features and scores")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=AS_OF)
    args = parser.parse_args()
    print(score_batch(build_session("retention scoring"), args.model, args.input, args.output, args.as_of).path)


if __name__ == "__main__":
    main()
