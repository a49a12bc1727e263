"""Incremental labelling: with thresholds fixed, labelling has no state, so a stream is joined with them as it comes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lilt.operators import calibration


def label_stream(records: DataFrame, thresholds: DataFrame, group_field: str | None = "dataset") -> DataFrame:
    """A streaming frame of records with their levels, by stream-static joins."""
    return calibration.apply_labels(records, thresholds, group_field)


def start(records: DataFrame, thresholds: DataFrame, path: str, checkpoint: str, group_field: str | None = "dataset") -> StreamingQuery:
    """Appends labelled records to JSON files, each once."""
    labelled = label_stream(records, thresholds, group_field)
    return labelled.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).option("ignoreNullFields", "false").outputMode("append").trigger(availableNow=True).start()
