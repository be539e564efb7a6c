"""The seven steps from a command line: ``python -m textloom STEP --store FOLDER ...``.

Outside models are named as ``module:function``; the function is the one that the step takes.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from textloom.operators.scoring import model_service
from textloom.pipeline import CurationPipeline
from textloom.plans.store import Store
from textloom.profile import DEFAULT
from textloom.sources import messages


def named(spec: str):
    """What ``module:function`` names."""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="textloom", description="Curate a corpus of short texts, step by step.")
    steps = out.add_subparsers(dest="step", required=True)

    def add(name: str, help: str, *options: tuple) -> None:
        one = steps.add_parser(name, help=help)
        one.add_argument("--store", required=True, help="folder of the tables")
        one.add_argument("--report", help="file for the counters, as JSON")
        for flag, settings in options:
            one.add_argument(flag, **settings)

    def option(flag: str, default=None, **settings) -> tuple:
        kind = {} if default is None or "type" in settings or "action" in settings else {"type": type(default)}
        return flag, {"default": default} | kind | settings

    number = {"type": int}
    add(
        "ingest", "clean, segment and filter new messages", option("--dataset", required=True, help="path of the messages"), option("--split", "train"), option("--order", "seq", help="column that orders the messages"),
        option("--text-field", "text"), option("--url-field", "url"), option("--names", help="JSON file of stand-in names"), option("--markers", help="folder that keeps dataset revisions"),
        option("--limit", **number), option("--output-table", "clean_segments"),
    )
    add(
        "dedup", "keep the first of exact and near duplicates", option("--source-table", "clean_segments"), option("--output-table", "dedup_segments"), option("--distance", DEFAULT.near_distance),
        option("--short-distance", DEFAULT.short_distance), option("--short-token-threshold", DEFAULT.short_tokens),
    )
    add(
        "toxicity", "score texts with a classifier", option("--model", required=True, help="module:function"), option("--source-table", "dedup_segments"), option("--output-table", "toxicity_segments"),
        option("--threshold", type=float), option("--mode", "score", choices=("score", "toxic_score")),
    )
    add(
        "label", "ask a labelling service", option("--service", help="module:function that connects to a service"), option("--model", help="module:function that gives send(key, prompt, settings)"), option("--prompt", help="file of the prompt for --model"),
        option("--keys", required=True, help="file of keys by account"), option("--expired-keys", help="file that keeps expired keys"), option("--source-table", "toxicity_segments"), option("--output-table", "llm_segments"),
        option("--batch-size", 64), option("--max-batch-size", 512), option("--workers", **number), option("--max-rows", **number),
    )
    add("export-parquet", "id and text of what isn't toxic", option("--path", required=True), option("--source-table", "toxicity_segments"), option("--fallback-table", "dedup_segments"))
    add(
        "export-labelled", "labelled rows in files of bounded size", option("--path", required=True), option("--source-table", "llm_segments"), option("--toxicity-table", "toxicity_segments"), option("--max-file-size-mb", 512),
        option("--batch-size", 2000), option("--limit", **number), option("--overwrite", False, action="store_true"),
    )
    add(
        "prepare-import", "choose a batch for annotation", option("--path", required=True), option("--source-table", "llm_segments"), option("--limit", **number), option("--share", 0.15),
        option("--free-fill", False, action="store_true", help="fill up from other buckets"), option("--dry-run", False, action="store_true"), option("--seed", 0), option("--lines", False, action="store_true", help="JSON lines, written in parallel"),
    )
    return out


def run(spark: SparkSession, argv: list[str]) -> dict:
    a = parser().parse_args(argv)
    profile, names = DEFAULT, ()
    if a.step == "ingest" and a.names:
        names = messages.load_names(a.names)
    if a.step == "dedup":
        profile = replace(DEFAULT, near_distance=a.distance, short_distance=a.short_distance, short_tokens=a.short_token_threshold)
    pipe, report = CurationPipeline(Store(spark, a.store), profile, names), {"report": a.report}
    if a.step == "ingest":
        revision = messages.check_revision(a.dataset, a.split, a.markers)[1] if a.markers else "local"
        rows = messages.read_any(spark, a.dataset)
        if a.order not in rows.columns:
            rows = rows.withColumn(a.order, F.monotonically_increasing_id())
        return pipe.ingest(rows, a.order, a.dataset, a.split, revision, a.output_table, a.text_field, a.url_field, a.limit, **report)
    if a.step == "dedup":
        return pipe.dedup(a.source_table, a.output_table, **report)
    if a.step == "toxicity":
        return pipe.toxicity(named(a.model), a.source_table, a.output_table, a.threshold, a.mode, **report)
    if a.step == "label":
        if bool(a.service) == bool(a.model):
            raise SystemExit("label needs either --service or --model")
        prompt = open(a.prompt, encoding="utf-8").read() if a.prompt else None
        connect = named(a.service) if a.service else model_service(named(a.model), prompt)
        return pipe.label(
            messages.load_accounts(a.keys), connect, a.source_table, a.output_table, a.max_rows, expired_path=a.expired_keys, batch=a.batch_size, max_batch=a.max_batch_size, workers=a.workers, **report
        )
    if a.step == "export-parquet":
        return {"path": pipe.export_parquet(a.path, a.source_table, a.fallback_table, **report)}
    if a.step == "export-labelled":
        return pipe.export_labelled(a.path, a.source_table, a.toxicity_table, a.max_file_size_mb << 20, a.batch_size, a.limit, a.overwrite, **report)
    return pipe.prepare_import(a.path, a.source_table, a.limit, a.share, not a.free_fill, a.dry_run, a.seed, lines=a.lines, **report)


def main() -> None:
    spark = SparkSession.builder.appName("textloom").getOrCreate()
    try:
        print(json.dumps(run(spark, sys.argv[1:]), ensure_ascii=False, indent=2))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
