"""python -m velatura COMMAND: the programs from a shell."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans import programs
from .sources.jsonl import thresholds


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="velatura")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, flags: tuple[str, ...] = (), **options) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for f in flags:
            p.add_argument(f"--{f}", action="store_true")
        for k, v in options.items():
            p.add_argument(f"--{k}", default=v, required=v is ..., type=str if v is ... or v is None else type(v))
        return p

    review = ("normalize", "migrate-company-ids", "validate-values")
    command("extract", (*review, "pii-only"), input=..., output=...)
    command("apply", (*review, "add-missing", "require-all-labels", "allow-value-in-multiple-labels"), input=..., review=..., output=...)
    windows = {"max_length": 512, "stride": 64, "boundary_backoff": 32}
    command("chunk", input=..., output=..., **windows)
    command("prepare", input=..., output=..., max_length=512, validation_split=0.1, seed=42)
    infer = command(
        "infer", text="none", text_file="none", jsonl_in="none", jsonl_out="none", text_column="text", emissions="none", decode="bio_viterbi", aggregate_overlaps="mean_logits", span_conf_agg="mean",
        span_conf_threshold=0.0, span_conf_threshold_by_type="none", min_span_tokens=0, min_span_tokens_by_type="none", **windows,
    )
    infer.add_argument("--no_resolve_overlaps", action="store_true")
    command("eval", dataset_path=..., emissions="none", report_path="eval_report.md", max_rows=-1, max_chars=200, decode="bio_viterbi", text_column="text", entities_column="entities", **windows)
    return top


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("velatura").getOrCreate()
    if a.command == "extract":
        programs.extract(spark, a.input, a.output, a.normalize, a.migrate_company_ids, a.validate_values, a.pii_only)
    elif a.command == "apply":
        programs.apply(spark, a.input, a.review, a.output, a.normalize, a.migrate_company_ids, a.validate_values, a.add_missing, a.require_all_labels, a.allow_value_in_multiple_labels)
    elif a.command == "chunk":
        print(programs.chunk(spark, a.input, a.output, a.max_length, a.stride, a.boundary_backoff))
    elif a.command == "prepare":
        programs.prepare(spark, a.input, a.output, a.max_length, a.validation_split, a.seed)
    elif a.command == "infer":
        line = programs.infer(
            spark, a.text, a.text_file, a.jsonl_in, a.jsonl_out, a.emissions, a.text_column, how=a.decode, aggregate=a.aggregate_overlaps, conf=a.span_conf_agg, threshold=a.span_conf_threshold,
            threshold_by_type=thresholds(a.span_conf_threshold_by_type), min_tokens=a.min_span_tokens, min_tokens_by_type=thresholds(a.min_span_tokens_by_type, int), resolve=not a.no_resolve_overlaps,
            max_length=a.max_length, stride=a.stride, backoff=a.boundary_backoff,
        )
        if line:
            print(line)
    else:
        found = programs.evaluate_model(spark, a.dataset_path, a.emissions, a.report_path, a.max_rows, a.max_chars, a.decode, a.text_column, a.entities_column, a.max_length, a.stride, a.boundary_backoff)
        print(json.dumps(found, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
