"""Percentiles of groups by narrowed ranks against Spark's own, and labels without dealing records by group."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lilt import queries
from lilt.operators import calibration, quantiles, report
from tests.conftest import SF

SHARES = (0.0, 0.05, 1 / 3, 0.5, 2 / 3, 1.0)
RECORD = "id long, dataset string, gender string, f0_median_hz double, energy_dbfs double, articulation_rate_pps double"


def odd_groups():
    r = np.random.default_rng(3)
    groups = {
        "even": r.uniform(60, 400, 3000).round(2).tolist(),
        "hot": [7.0] * 2000 + r.normal(7, 1, 300).tolist(),
        "scales": (10.0 ** r.uniform(-300, 300, 900)).tolist() + [0.0, 5e-324, 1.7e308, -1.7e308],
        "signs": [-0.0, 0.0] * 40 + r.normal(0, 1, 200).tolist(),
        "endless": [math.inf, -math.inf, math.nan] * 30 + r.normal(0, 1, 200).tolist(),
        "huge": [1.1e308, 1.2e308, 1.3e308, 1.4e308] * 40,
        "one": [3.5],
        "two": [1.0, 2.0],
        "same": [4.25] * 300,
        None: r.integers(0, 50, 500).astype(float).tolist() + [None] * 20,
        "nulls": [None] * 5,
    }
    return [(k, i % 3, v) for k, values in groups.items() for i, v in enumerate(values)]


def shown(rows):
    return sorted(((repr(r.k), repr(r.p), r.n, None if r.c is None else [repr(x + 0.0) for x in r.c]) for r in rows), key=str)


@pytest.mark.parametrize(("parts", "few", "passes"), [(1000, 200_000, 12), (1000, 20, 12), (8, 20, 12), (8, 0, 3)])
def test_percentiles_are_those_of_the_aggregate(spark, monkeypatch, parts, few, passes):
    for name, x in (("PARTS", parts), ("FEW", few), ("PASSES", passes)):
        monkeypatch.setattr(quantiles, name, x)
    df = spark.createDataFrame(odd_groups(), "k string, p int, v double").repartition(3).cache()
    aggregate = F.percentile(F.col("v") + F.lit(0.0), F.array(*map(F.lit, SHARES)))
    own = df.groupBy("k", "p").agg(F.count("v").alias("n"), aggregate.alias("c"))
    pools = df.groupBy("k").agg(F.count("v").alias("n"), aggregate.alias("c")).withColumn("p", F.lit(None).cast("int"))
    got = quantiles.percentiles(df, ["k", "p"], "v", SHARES, pooled=["k"]).withColumnRenamed("cuts", "c").collect()
    assert shown(got) == shown(own.unionByName(pools).collect())
    assert all(r.pool == (r.p is None) for r in got)


def test_small_groups_have_no_cuts(spark):
    df = spark.createDataFrame([("a", 1.0)] * 9 + [("b", 2.0)] * 10, "k string, v double")
    assert sorted((r.k, r.n, r.cuts) for r in quantiles.percentiles(df, ["k"], "v", [0.5], 10).collect()) == [("a", 9, None), ("b", 10, [2.0])]
    assert quantiles.percentiles(df.limit(0), ["k"], "v", [0.5]).collect() == []


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast_rows", [250_000, 0])
def test_records_of_few_groups_are_not_dealt_by_group(spark, monkeypatch, broadcast_rows):
    rows = [(i, "ab"[i % 2], "x", float(i), float(i % 7), float(i % 50)) for i in range(600)]
    df = spark.createDataFrame(rows, RECORD)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", broadcast_rows)
    try:
        out = calibration.apply_labels(df, calibration.fit(df)).select("id", "pitch_level", "energy_level", "speed_level")
        assert ("SortMergeJoin" in plan(out)) == (not broadcast_rows)
        levels = {r.id: r.pitch_level for r in out.collect()}
        assert (levels[0], levels[300], levels[599]) == ("low", "normal", "high")
        if broadcast_rows:
            labelled = queries.calib_label_lineitem(spark, SF)
            assert "SortMergeJoin" not in plan(labelled) and plan(labelled).count("Exchange hashpartitioning") <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_no_task_reads_all_values_of_a_group(spark):
    """No aggregate holds a group's values."""
    rows = [(i, "a", "x", float(i), None, None) for i in range(200)]
    df = spark.createDataFrame(rows, RECORD).withColumn("f0_range_st", F.col("f0_median_hz"))
    for made in (calibration.fit(df), report.range_spread(df), report.f0_by_gender(df), queries.percentile_linear(spark, SF)):
        assert "percentile(" not in plan(made)
    assert [r.asDict() for r in report.range_spread(df).collect()] == [{"p5": 9.95, "p25": 49.75, "p50": 99.5, "p75": 149.25, "p95": 189.05}]
