"""Incremental form of cleaning and appending. The text functions keep no state, so the batch
expressions run unchanged; file sinks with a checkpoint append each row exactly once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from verbatide.plans.prepare import clean_table, from_five_levels


def clean_stream(rows: DataFrame, abbreviations: Mapping[str, str] | None = None) -> DataFrame:
    """Five-level rows as they arrive, in the saved projection."""
    return clean_table(from_five_levels(rows), abbreviations)


def score_stream(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with a prediction; no label is needed."""
    return model.transform(rows)


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, kind: str = "parquet", until_done: bool = False
) -> StreamingQuery:
    """Append to files; a restart with the same ``checkpoint`` goes on where the last one stopped.
    ``until_done`` takes what is there and stops."""
    writer = rows.writeStream.format(kind).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if until_done:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
