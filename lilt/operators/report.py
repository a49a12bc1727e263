"""Summaries of labelled records: label counts, spread of ranges, pitch by gender, totals, failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lilt import schema as S
from lilt.functions.scalar import failure_reason
from lilt.operators.quantiles import percentiles

NONE = "None"


def label_counts(records: DataFrame, fields: Sequence[str] = S.REPORT_FIELDS) -> DataFrame:
    """(field, label, n): one pass; null labels count under "None"."""
    present = [f for f in fields if f in records.columns]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit(NONE)).alias("label")) for f in present])
    return records.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.label").agg(F.count(F.lit(1)).alias("n"))


def range_spread(records: DataFrame, digits: int = 2) -> DataFrame:
    """(p5, p25, p50, p75, p95) of f0_range_st; no row without a value."""
    steps = (5, 25, 50, 75, 95)
    got = percentiles(records.select(F.lit(True).alias("all"), "f0_range_st"), ["all"], "f0_range_st", [q / 100 for q in steps]).where("n > 0")
    return got.select(*[F.round(F.col("cuts")[i], digits).alias(f"p{q}") for i, q in enumerate(steps)])


def f0_by_gender(records: DataFrame, digits: int = 1) -> DataFrame:
    """(gender, n, p10, median, p90) of f0_median_hz; genders without a value are left out."""
    rows = records.select(F.coalesce(F.col("gender").cast("string"), F.lit(NONE)).alias("gender"), "f0_median_hz")
    got = percentiles(rows, ["gender"], "f0_median_hz", [0.1, 0.5, 0.9]).where("n > 0")
    return got.select("gender", "n", *[F.round(F.col("cuts")[i], digits).alias(c) for i, c in enumerate(("p10", "median", "p90"))])


def totals(records: DataFrame) -> DataFrame:
    """(n_records, n_f0_unreliable); a null reliability isn't counted."""
    return records.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.col("f0_reliable") == F.lit(False)).alias("n_f0_unreliable"))


def top_failures(failed: DataFrame, k: int = 5) -> DataFrame:
    """(reason, n): the k most frequent failure reasons, ties by first appearance. Needs _error and _row."""
    counts = failed.groupBy(failure_reason(F.col("_error")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_first"))
    return counts.orderBy(F.col("n").desc(), "_first").limit(k).select("reason", "n")


def as_document(records: DataFrame) -> dict:
    """The report of the JSON file; every part is a small aggregate."""
    labels: dict = {}
    for r in label_counts(records).orderBy("field", "label").collect():
        labels.setdefault(r["field"], {})[r["label"]] = r["n"]
    out = {"labels": labels, "f0_range_st": {}, "f0_by_gender": {}}
    if "f0_range_st" in records.columns:
        out["f0_range_st"] = next((r.asDict() for r in range_spread(records).collect()), {})
    if {"gender", "f0_median_hz"} <= set(records.columns):
        out["f0_by_gender"] = {r["gender"]: {"n": r["n"], "p10": r["p10"], "median": r["median"], "p90": r["p90"]} for r in f0_by_gender(records).orderBy("gender").collect()}
    if "f0_reliable" in records.columns:
        out |= totals(records).first().asDict()
    return out


def as_lines(report: dict) -> list[str]:
    """The console form of a report."""
    lines = [f"{field}: " + ", ".join(f"{k}={v}" for k, v in sorted(counts.items())) for field, counts in report["labels"].items()]
    if report["f0_range_st"]:
        lines.append("f0 range (st): " + ", ".join(f"{k}={v}" for k, v in report["f0_range_st"].items()))
    lines += [f"f0 {g}: n={v['n']} p10={v['p10']} median={v['median']} p90={v['p90']}" for g, v in sorted(report["f0_by_gender"].items())]
    return lines
