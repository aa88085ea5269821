"""Timings at the published row counts.

Repeats the supplied orders under new keys until the rejected feed has about 27.6 million
rows and the accepted one 2.3 million. Step ``etl`` writes both as CSV (not timed), then
times the cleaning of each feed into Parquet and the building of all marts. Step ``fit``
prepares the balanced training rows (timed apart) and times the classifiers in
``BENCH_FIT`` (default ``lr,rf``; also ``gbt``). Choose steps with ``BENCH_STEPS``. Needs
about 8 GB of disk in ``BENCH_WORK`` (a new temporary folder by default). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import session  # noqa: E402
from creditmart.operators import clean, features, models, sampling  # noqa: E402
from creditmart.plans import warehouse  # noqa: E402
from creditmart.sources import feeds, files  # noqa: E402
from creditmart.sources.stage import clear_stage, stage  # noqa: E402

REJECTED_ROWS, ACCEPTED_ROWS = 27_636_929, 2_260_701


def repeated(df: DataFrame, rows: int, tasks: int) -> DataFrame:
    """About ``rows`` rows: copies of the feed with new keys and shifted amounts."""
    copies = max(1, round(rows / df.count()))
    amount = "loan_amnt_raw" if "loan_amnt_raw" in df.columns else "loan_amnt"
    columns = {c: c for c in df.columns} | {
        "app_id": "app_id * 1000 + _copy AS app_id",
        amount: f"CAST(CAST({amount} AS double) + _copy * 0.5D AS string) AS {amount}",
    }
    spread = df.repartition(tasks).selectExpr("*", f"explode(sequence(0, {copies - 1})) AS _copy")
    return spread.selectExpr(*columns.values())


def etl(spark: SparkSession, rejected: DataFrame, accepted: DataFrame, work: str, timed) -> dict[str, object]:
    for name, feed in (("rejected", rejected), ("accepted", accepted)):
        feed.drop("app_id").write.mode("overwrite").option("header", True).csv(f"{work}/{name}_csv")
    raw_rejected = files.read_rejected_csv(spark, f"{work}/rejected_csv")
    columns = [c for c in accepted.columns if c != "app_id"]
    raw_accepted = files.read_accepted_csv(spark, f"{work}/accepted_csv", columns)
    n_rejected = timed(
        "clean_rejected_sec", lambda: files.write_layer(clean.clean_rejected(raw_rejected), f"{work}/rejected")
    )
    n_accepted = timed(
        "clean_accepted_sec", lambda: files.write_layer(clean.clean_accepted(raw_accepted), f"{work}/accepted")
    )
    timed("marts_15_sec", lambda: warehouse.build_marts(raw_rejected, raw_accepted, f"{work}/marts"))
    return {"clean_rejected_rows_out": n_rejected, "clean_accepted_rows_out": n_accepted}


def fit(rejected: DataFrame, accepted: DataFrame, names: list[str], timed) -> dict[str, object]:
    def training_rows() -> DataFrame:
        detail = stage(
            clean.combine(
                clean.clean_rejected(rejected, carry=["app_id"]), clean.clean_accepted(accepted, carry=["app_id"])
            ),
            "scale-detail",
        )
        rated = features.model_input(detail, carry=["app_id"])
        split = sampling.split_hash(sampling.undersample_hash(rated, "app_id"), "app_id")
        return stage(split.where("split = 'train'").drop("split"), "scale-train")

    train = timed("prepare_training_sec", training_rows)
    makers = {"lr": models.logistic_regression, "rf": models.random_forest, "gbt": models.boosted_trees}
    for name in names:
        pipeline = models.one_hot_features(models.WITH_RATES)
        timed(f"fit_{name}_sec", lambda p=pipeline, n=name: models.fit_all(train, p, {n: makers[n]()}))
    return {"training_rows": train.count()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    steps = os.environ.get("BENCH_STEPS", "etl,fit").split(",")
    names = os.environ.get("BENCH_FIT", "lr,rf").split(",")
    work = os.environ.get("BENCH_WORK") or tempfile.mkdtemp(prefix="creditmart-scale-")
    spark = session(cpus)
    report: dict[str, object] = {"cpus": cpus}

    def timed(name: str, task):
        start = time.perf_counter()
        result = task()
        report[name] = round(time.perf_counter() - start, 1)
        print(name, report[name], file=sys.stderr, flush=True)
        return result

    rejected, accepted = feeds.feeds(spark, sf_dir)
    rejected, accepted = repeated(rejected, REJECTED_ROWS, 32), repeated(accepted, ACCEPTED_ROWS, 8)
    if "etl" in steps:
        report |= etl(spark, rejected, accepted, work, timed)
    if "fit" in steps:
        report |= fit(rejected, accepted, names, timed)
    clear_stage(spark)
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
