"""What each micro-batch of a stream did, kept as small files: rows read, rows dropped as late, the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tradewind.sources.files import Folder

_FIELDS = (
    "batchId bigint, numInputRows bigint, eventTime struct<watermark: timestamp>, "
    "stateOperators array<struct<operatorName: string, numRowsDroppedByWatermark: bigint>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the stream called ``name`` to ``folder``, a file for each batch.

    A batch that runs again after a restart replaces its file. Spark counts late rows where a stateful operator
    drops them: that is rows for a dedup, a join or a state processor, and partial sums for an aggregate.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str) -> None:
        self.name, self.folder = name, Folder(spark, folder)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.folder.write(f"{event.progress.batchId}.json", " ".join(event.progress.json.split()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """batch_id, input_rows, accepted_rows, dropped_rows and watermark of each batch."""
    dropped = F.aggregate("stateOperators.numRowsDroppedByWatermark", F.lit(0).cast("bigint"), lambda total, n: total + F.coalesce(n, F.lit(0)))
    return spark.read.schema(_FIELDS).json(folder).select(
        F.col("batchId").alias("batch_id"), F.col("numInputRows").alias("input_rows"),
        (F.col("numInputRows") - dropped).alias("accepted_rows"), dropped.alias("dropped_rows"), F.col("eventTime.watermark").alias("watermark"))
