"""``spark-submit``-able jobs: ``python -m martwright --root <folder> bronze silver gold quality``."""

from __future__ import annotations

import argparse
import logging
import sys

from martwright.plans import history, jobs, quality
from martwright.session import build_session
from martwright.sources.layout import Layout, new_run_id

STAGES = ("bronze", "silver", "gold", "quality", "references", "counts", "history", "publish")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="martwright", description=__doc__)
    parser.add_argument("--root", required=True, help="folder that holds raw/ and receives the layers")
    parser.add_argument("--master", help="Spark master, if not set by spark-submit")
    parser.add_argument("--infer", action="store_true", help="infer raw column types instead of using the contract")
    parser.add_argument("--strict", action="store_true", help="leave records that do not fit the contract out of bronze")
    parser.add_argument("--resume", action="store_true", help="leave tables that are made from the inputs as they are now")
    parser.add_argument("--partition-facts", action="store_true", help="store the facts by month of purchase")
    parser.add_argument("--no-buckets", action="store_true", help="do not store silver orders, items and payments in buckets")
    parser.add_argument("--database", help="database to publish the gold tables in")
    parser.add_argument("stages", nargs="+", choices=STAGES)
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session(master=args.master)
    layout, run_id, failed = Layout(args.root.rstrip("/")), new_run_id(), 0
    for stage in args.stages:
        if stage == "publish":
            jobs.publish_gold(spark, layout, args.database)
            continue
        if stage == "references":
            jobs.check_references(spark, layout).show(50, truncate=False)
            continue
        if stage == "history":
            history.run_changes(history.stored_metrics(spark, layout)).orderBy("stage", "dataset", "run_id").show(200, truncate=False)
            history.rule_changes(history.stored_reports(spark, layout)).orderBy("dataset", "rule", "run_id").show(200, truncate=False)
            continue
        if stage == "counts":
            jobs.check_record_counts(spark, layout).show(truncate=False)
            continue
        if stage == "quality":
            report = jobs.run_quality(spark, layout, run_id)
            summary = quality.summary(report)
            summary.write.mode("overwrite").parquet(layout.quality_metrics(run_id))
            summary.show()
            quality.failure_messages(report).show(50, truncate=False)
            continue
        if stage == "bronze":
            metrics = jobs.run_bronze(spark, layout, infer=args.infer, strict=args.strict, resume=args.resume)
        elif stage == "silver":
            metrics = jobs.run_silver(spark, layout, colocate=not args.no_buckets, resume=args.resume)
        else:
            metrics = jobs.run_gold(spark, layout, partition_facts=args.partition_facts, resume=args.resume)
        metrics.write.mode("overwrite").parquet(layout.run_metrics(run_id, stage))
        metrics.show(truncate=False)
        summary = jobs.run_summary(metrics)
        summary.show()
        failed += summary.first()["failed_jobs"]
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
