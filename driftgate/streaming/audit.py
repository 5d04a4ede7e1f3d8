"""Audit log for every load cycle of a stream (SNK2 on Structured Streaming).

Each micro-batch is one load cycle: it is profiled with the same one-pass batch operator
and written to the audit history, partitioned by (table_name, batch_id). The write uses
dynamic partition overwrite, so a micro-batch that Spark replays after a failure replaces
its own rows instead of appending them twice (the stream's checkpoint gives the batch id).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from driftgate.operators.profile import profile_tables, with_measurement
from driftgate.sources.sinks import AUDIT_SCHEMA

STREAM_AUDIT_SCHEMA = StructType(AUDIT_SCHEMA.fields + [StructField("batch_id", LongType(), False)])


def _writer(table_name: str, target: str, columns, exclude_columns, fmt: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ts = _dt.datetime.now(_dt.timezone.utc)
        prof = with_measurement(profile_tables({table_name: batch}, columns, exclude_columns), F.lit(ts).cast("timestamp"))
        rows = prof.withColumn("batch_id", F.lit(batch_id).cast("long")).select(STREAM_AUDIT_SCHEMA.fieldNames())
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .format(fmt)
            .partitionBy("table_name", "batch_id")
            .save(target)
        )

    return write_batch


def audit_stream(
    stream: DataFrame,
    table_name: str,
    target: str,
    checkpoint_location: str,
    columns: Sequence[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Start a streaming query that logs a profile of every micro-batch to ``target``.

    ``checkpoint_location`` belongs to the target: batch ids go on from it after a restart, so
    a new one would overwrite the rows of the earlier batches.

    ``available_now`` processes what is there and stops (a scheduled load cycle); set it
    to False for a continuously running query with the default trigger.
    """
    writer = stream.writeStream.foreachBatch(_writer(table_name, target, columns, exclude_columns, fmt))
    writer = writer.option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_stream_audit(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(STREAM_AUDIT_SCHEMA).load(target).select(STREAM_AUDIT_SCHEMA.fieldNames())
