"""The stateless steps on unbounded input: the same functions, a stream as frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tillsight.models.scoring import SpendPredictor
from tillsight.operators.routing import accepted_header, rejected, tag_header
from tillsight.session import shared_folder
from tillsight.sources.files import write_table


def route_header_stream(raw: DataFrame, folder: str, name: str = "route_header") -> StreamingQuery:
    """Split raw headers into accepted and rejected files, batch by batch.

    A repeated batch after a failure replaces its own two folders, so a row is
    never written twice.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_header(batch)
        write_table(accepted_header(tagged), f"{folder}/accepted", f"batch={batch_id}")
        write_table(rejected(tagged), f"{folder}/rejected", f"batch={batch_id}")

    return (
        raw.writeStream.foreachBatch(split)
        .option("checkpointLocation", shared_folder(raw.sparkSession, name))
        .trigger(availableNow=True)
        .start()
    )


def score_stream(features: DataFrame, predictor: SpendPredictor, folder: str, name: str = "score") -> StreamingQuery:
    """Score a stream of feature rows into parquet files."""
    return (
        predictor.predict_with_details(features)
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", shared_folder(features.sparkSession, name))
        .trigger(availableNow=True)
        .start()
    )
