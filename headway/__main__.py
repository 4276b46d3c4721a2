"""The jobs from the command line, for spark-submit or ``python -m headway``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import catalog as C
from headway.operators.pairs import benchmark_metadata
from headway.operators.scoring import score_report
from headway.plans.benchmark_items import build_benchmark
from headway.plans.clean_feeds import clean_feeds, load_tables
from headway.plans.question_pairs import generate_dataset
from headway.plans.score_runs import compare_runs, score_benchmark
from headway.plans.summarise import FeedSummary
from headway.plans.validate_pairs import load_numbered, validate_pairs
from headway.schema import FEED
from headway.sources import archives as A
from headway.sources import documents as D
from headway.sources.catalog import read_catalog
from headway.streaming.arrivals import clean_new_feeds


def _metadata(spark: SparkSession, folder: str | None) -> DataFrame | None:
    """Provider and country per feed from the archives' metadata documents."""
    if folder is None:
        return None
    found = D.read_feed_documents(spark, folder)
    named = [
        (F.col(c) if c in found.columns else F.lit("")).alias(c)
        for c in ("provider", "country_code")
    ]
    return found.select(FEED, *named)


def _summary(spark: SparkSession, a) -> FeedSummary:
    feeds = _metadata(spark, a.metadata)
    return FeedSummary(load_tables(spark, a.store, feeds, a.feed_id), order=a.order)


def select(spark, a):
    catalog = C.usable_feeds(read_catalog(spark, a.catalog))
    targets = C.target_table(spark)
    D.write_seed_feeds(C.select_seed_feeds(catalog, targets), a.out)
    C.unmatched_targets(catalog, targets).show(truncate=False)


def check_archives(spark, a):
    entries = A.list_archives(A.archive_paths(spark, a.archives))
    A.validate_archives(entries).write.mode("overwrite").json(a.out)


def clean(spark, a):
    done = clean_feeds(
        spark, a.archives, a.raw, a.out, a.feed_id, _metadata(spark, a.metadata),
        replace=a.feed_id is not None,
    )
    done.write(f"{a.out}/_cleaning")


def clean_new(spark, a):
    clean_new_feeds(spark, a.archives, a.raw, a.out, a.checkpoint, a.force)


def summarise(spark, a):
    summary = _summary(spark, a).stored()
    summary.route_stats.write.mode("overwrite").parquet(f"{a.out}/route_stats")
    summary.feed_stats.write.mode("overwrite").parquet(f"{a.out}/feed_stats")
    summary.nested().write.mode("overwrite").json(f"{a.out}/feeds")


def generate(spark, a):
    known = D.read_pairs(spark, a.knowledge) if a.knowledge else None
    pairs = generate_dataset(_summary(spark, a), known, a.seed, a.expanded)
    D.write_pairs(pairs, a.out)


def check_pairs(spark, a):
    stats = spark.read.parquet(f"{a.statistics}/feed_stats")
    pairs = load_numbered(spark, a.pairs)
    validate_pairs(pairs, stats, a.split_ratio, a.seed, line="value").write(a.out)


def benchmark(spark, a):
    items = build_benchmark(_summary(spark, a))
    D.write_benchmark(items, benchmark_metadata(items), a.out, a.name)


def score(spark, a):
    run = score_benchmark(spark.read.json(a.predictions), spark.read.json(a.benchmark))
    run.answers.write.mode("overwrite").parquet(f"{a.out}/answers")
    # the answers are scored once
    report = score_report(spark.read.parquet(f"{a.out}/answers"))
    report.write.mode("overwrite").json(f"{a.out}/report")


def compare(spark, a):
    done = compare_runs(spark.read.json(a.base), spark.read.json(a.candidate))
    for part in (done.overall, done.categories, done.verdict):
        part.show(100, truncate=False)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="headway", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)

    def add(job, *positional, store: bool = False):
        command = commands.add_parser(job.__name__.replace("_", "-"))
        command.set_defaults(job=job)
        for name in positional:
            command.add_argument(name)
        if store:
            command.add_argument("--metadata", help="folder with mdb-*/metadata.json")
            command.add_argument("--feed-id", nargs="+")
        return command

    add(select, "catalog", "out")
    add(check_archives, "archives", "out")
    add(clean, "archives", "raw", "out", store=True)
    add(clean_new, "archives", "raw", "out", "checkpoint").add_argument(
        "--force", action="store_true"
    )
    for job in (summarise, generate, benchmark):
        command = add(job, "store", "out", store=True)
        command.add_argument("--order", choices=["text", "seconds"], default="text")
        if job is generate:
            command.add_argument("--knowledge", help="JSON lines of fixed pairs")
            command.add_argument("--seed", type=int, default=42)
            command.add_argument("--expanded", action="store_true")
        if job is benchmark:
            command.add_argument("--name", default="Transit benchmark")
    command = add(check_pairs, "pairs", "statistics", "out")
    command.add_argument("--split-ratio", type=float, default=0.9)
    command.add_argument("--seed", type=int, default=42)
    add(score, "predictions", "benchmark", "out")
    add(compare, "base", "candidate")
    return root


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    a.job(SparkSession.builder.appName(f"headway {a.command}").getOrCreate(), a)


if __name__ == "__main__":
    main()
