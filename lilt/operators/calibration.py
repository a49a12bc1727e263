"""Percentile calibration: cut points of each group with a pooled fallback, and three-way labels.

Cuts are exact percentiles with linear interpolation. Both tiers are fitted in the same passes over the records, which carry
counts alone, so a group or a pool may hold all records. Labelling broadcasts the cuts once they are counted: dealt by group,
the records of a few groups would go to as few tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lilt import schema as S
from lilt.functions.scalar import group_key, three_way
from lilt.operators.quantiles import once, percentiles as exact_percentiles, small


def long_form(records: DataFrame, group_field: str | None = "dataset", features: Sequence[S.Feature] = S.FEATURES) -> DataFrame:
    """(feature, ds, g, v): a row for each measure of a record that isn't null or NaN; g is null without an extra key."""
    ds = group_key(F.col(group_field), S.ALL) if group_field and group_field in records.columns else F.lit(S.ALL)
    entries = []
    for f in features:
        g = group_key(F.col(f.extra), S.UNKNOWN) if f.extra and f.extra in records.columns else F.lit(S.UNKNOWN if f.extra else None).cast("string")
        entries.append(F.struct(F.lit(f.measure).alias("feature"), g.alias("g"), F.col(f.measure).cast("double").alias("v")))
    rows = records.select(ds.alias("ds"), F.explode(F.array(*entries)).alias("e")).select("e.feature", "ds", "e.g", "e.v")
    return rows.where(F.col("v").isNotNull() & ~F.isnan("v"))


def fit(records: DataFrame, group_field: str | None = "dataset", percentiles: Sequence[float] = S.PERCENTILES, min_group: int = S.MIN_GROUP, features: Sequence[S.Feature] = S.FEATURES) -> DataFrame:
    """(feature, tier, ds, g, n, cuts): tier "group" has every group, cuts null below min_group; tier "pooled" only large ones."""
    if len(percentiles) != 2 or not 0 <= percentiles[0] < percentiles[1] <= 100:
        raise ValueError("two ascending percentiles are needed")
    rows = long_form(records, group_field, features).withColumn("g", F.coalesce("g", F.lit("")))
    fitted = exact_percentiles(rows, ["feature", "ds", "g"], "v", [q / 100 for q in percentiles], min_group, ["feature", "g"])
    tier, cuts = F.when(F.col("pool"), "pooled").otherwise("group"), F.transform("cuts", lambda x: F.round(x, 4))
    fitted = fitted.select("feature", tier.alias("tier"), "ds", F.nullif("g", F.lit("")).alias("g"), "n", cuts.alias("cuts"))
    return once(fitted.where((F.col("tier") == "group") | F.col("cuts").isNotNull()))


def look_up(records: DataFrame, thresholds: DataFrame, group_field: str | None = "dataset", features: Sequence[S.Feature] = S.FEATURES) -> DataFrame:
    """records with <measure>_cuts: the group's cuts, else the pooled ones, else null.

    Two left joins a feature on normalised keys. Only groups with cuts count, and they are broadcast if they are few, so
    the records aren't dealt by group.
    """
    out = records.withColumn("_ds", group_key(F.col(group_field), S.ALL) if group_field and group_field in records.columns else F.lit(S.ALL))
    fitted = thresholds.where(F.col("cuts").isNotNull())
    sizes = {(r["feature"], r["tier"]): r["count"] for r in fitted.groupBy("feature", "tier").count().collect()}
    for f in features:
        own = fitted.where(F.col("feature") == f.measure).withColumn("_g", F.coalesce("g", F.lit("")))
        g = group_key(F.col(f.extra), S.UNKNOWN) if f.extra and f.extra in records.columns else F.lit(S.UNKNOWN if f.extra else "")
        group = small(own.where("tier = 'group'").select(F.col("ds").alias("_ds"), "_g", F.col("cuts").alias("_group")), sizes.get((f.measure, "group"), 0))
        pooled = small(own.where("tier = 'pooled'").select("_g", F.col("cuts").alias("_pooled")), sizes.get((f.measure, "pooled"), 0))
        out = out.withColumn("_g", g).join(group, ["_ds", "_g"], "left").join(pooled, "_g", "left")
        out = out.withColumn(f"{f.measure}_cuts", F.coalesce("_group", "_pooled")).drop("_g", "_group", "_pooled")
    return out.drop("_ds")


def apply_labels(records: DataFrame, thresholds: DataFrame, group_field: str | None = "dataset", features: Sequence[S.Feature] = S.FEATURES) -> DataFrame:
    """records with their pitch, energy and speed levels; null without a measure or cuts."""
    out = look_up(records, thresholds, group_field, features)
    for f in features:
        cuts = F.col(f"{f.measure}_cuts")
        out = out.withColumn(f.label, three_way(F.col(f.measure).cast("double"), F.get(cuts, F.lit(0)), F.get(cuts, F.lit(1)), f.values))
    return out.drop(*[f"{f.measure}_cuts" for f in features])


def as_document(thresholds: DataFrame, percentiles: Sequence[float] = S.PERCENTILES, min_group: int = S.MIN_GROUP, group_field: str | None = "dataset") -> dict:
    """Thresholds as the nested mapping of the JSON file, keys sorted. One row a group comes to the driver."""
    out: dict = {"percentiles": list(percentiles), "min_group_size": min_group, "group_by": group_field, "features": {}}
    for r in thresholds.orderBy("feature", "tier", "ds", "g").collect():
        key = (r["ds"] if r["tier"] == "group" else S.ALL) + (f"|{r['g']}" if r["g"] is not None else "")
        part = out["features"].setdefault(r["feature"], {"groups": {}, "fallback": {}})["groups" if r["tier"] == "group" else "fallback"]
        part[key] = {"n": r["n"], "cuts": r["cuts"]}
    return out


def from_document(spark, document: dict) -> DataFrame:
    """Thresholds from as_document(), so saved cuts can label new records."""
    rows = []
    for feature, tiers in document["features"].items():
        for name, tier in (("groups", "group"), ("fallback", "pooled")):
            for key, entry in tiers[name].items():
                split = key.rpartition("|") if any(f.measure == feature and f.extra for f in S.FEATURES) else (key, "", None)
                rows.append((feature, tier, split[0] if tier == "group" else None, split[2], entry["n"], entry["cuts"]))
    return spark.createDataFrame(rows, "feature string, tier string, ds string, g string, n long, cuts array<double>")
