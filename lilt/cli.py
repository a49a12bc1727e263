"""Command line: ``python -m lilt.cli label|enrich``."""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lilt import schema as S


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lilt")
    jobs = top.add_subparsers(dest="job", required=True)
    label = jobs.add_parser("label", help="measure recordings and label them by calibrated cuts")
    label.add_argument("input")
    label.add_argument("output")
    label.add_argument("--stage", choices=("all", "extract", "calibrate"), default="all")
    label.add_argument("--features")
    label.add_argument("--errors")
    label.add_argument("--limit", type=int)
    label.add_argument("--group-by", default="dataset", help="grouping field; empty for one group")
    label.add_argument("--percentiles", type=float, nargs=2, default=S.PERCENTILES)
    label.add_argument("--min-group-size", type=int, default=S.MIN_GROUP)
    label.add_argument("--thresholds", help="where thresholds and report go")
    label.add_argument("--saved-thresholds", help="label by the thresholds of an earlier run")
    label.add_argument("--workers", help="Spark master, such as local[4]")
    label.add_argument("--speaker-model", help="module:function that makes the speaker model; takes device")
    label.add_argument("--stress-model", help="module:function that makes the stress model; takes device and folder")
    label.add_argument("--device", default="cuda", help="where models run")
    label.add_argument("--whistress-dir", help="folder of the stress model")
    label.add_argument("--skip-models", action="store_true", help="ask no models, even if they are named")
    enrich = jobs.add_parser("enrich", help="add generated text to records")
    enrich.add_argument("input")
    enrich.add_argument("output")
    enrich.add_argument("--field", default="reasoning")
    enrich.add_argument("--api-key", default=os.environ.get("OPENAI_API_KEY"))
    enrich.add_argument("--base-url")
    enrich.add_argument("--model", default="gpt-4o")
    enrich.add_argument("--temperature", type=float, default=1.0)
    enrich.add_argument("--max-tokens", type=int, default=512)
    enrich.add_argument("--max-retries", type=int, default=5)
    enrich.add_argument("--timeout", type=float, default=60.0)
    enrich.add_argument("--workers", type=int, default=8)
    enrich.add_argument("--limit", type=int)
    enrich.add_argument("--errors", help="where failures go")
    enrich.add_argument("--chunk", type=int, default=2_000, help="records appended at a time")
    enrich.add_argument("--no-resume", action="store_true")
    enrich.add_argument("--dry-run", type=int, nargs="?", const=1)
    return top


def main(arguments: list[str] | None = None) -> int:
    from lilt.functions import providers
    from lilt.operators import augment, report
    from lilt.plans import enriching, labelling
    from lilt.sources import jsonl

    a = parser().parse_args(arguments)
    builder = SparkSession.builder.appName("lilt")
    spark = (builder.master(a.workers) if a.job == "label" and a.workers else builder).getOrCreate()
    if a.job == "label":
        saved = json.loads(Path(a.saved_thresholds).read_text(encoding="utf-8"))["thresholds"] if a.saved_thresholds else None
        options = {} if a.stage == "extract" else {"group_field": a.group_by or None, "percentiles": tuple(a.percentiles), "min_group": a.min_group_size, "saved": saved}
        use = lambda name, **given: providers.named_factory(name, **given) if name and not a.skip_models else None
        speaker, stress = use(a.speaker_model, device=a.device), use(a.stress_model, device=a.device, folder=a.whistress_dir)
        document = labelling.run(spark, a.input, a.output, a.stage, a.limit, a.features, a.errors, a.thresholds, speaker, stress, **options)
        if document:
            print("\n".join(report.as_lines(document["report"])))
        return 0
    records = jsonl.read(spark, a.input, limit=a.limit)
    if a.dry_run is not None:
        for r in augment.dry_run(records.withColumn("_row", F.monotonically_increasing_id()), a.dry_run).collect():
            print(r["text"])
        return 0
    if a.base_url and not a.api_key:
        print("no API key", file=sys.stderr)
        return 2
    provider = providers.chat(a.base_url, a.model, a.api_key, a.temperature, a.max_tokens, a.max_retries, a.timeout) if a.base_url else providers.echo
    return 1 if enriching.run(spark, records, a.output, provider, a.field, not a.no_resume, a.workers, errors=a.errors, chunk=a.chunk) else 0


if __name__ == "__main__":
    sys.exit(main())
